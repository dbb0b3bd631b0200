"""Keeping the stored tables up to date without redoing what has not changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vardelta.operators import digests
from vardelta.operators.family import in_snapshot
from vardelta.schemas import KEY

RECORD = ["clinvar_sig", "clinvar_revstat", "clinvar_disease", "clinvar_alleleid"]
DIGESTS = ["vcf_digest", "cache_version", "clinvar_date"]


def clinvar_changes(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """Keys whose record was added, removed or changed in any of four fields (absent is not empty)."""
    p = prev.select(*KEY, *[F.col(c).alias(f"p_{c}") for c in RECORD])
    c = curr.select(*KEY, *[F.col(c).alias(f"c_{c}") for c in RECORD])
    differs = F.lit(False)
    for name in RECORD:
        differs = differs | ~F.col(f"p_{name}").eqNullSafe(F.col(f"c_{name}"))
    return p.join(c, KEY, "full_outer").where(differs).select(*KEY)


def match_rows(changes: DataFrame) -> DataFrame:
    """Changes as rows to match stored variants by: substitutions exactly, indels by position at pos and pos + 1."""
    same = F.length("ref") == F.length("alt")
    exact = F.array(F.struct(F.col("pos").alias("at"), F.col("ref").alias("r"), F.col("alt").alias("a")))
    free = lambda p: F.struct(p.alias("at"), F.lit(None).cast("string").alias("r"), F.lit(None).cast("string").alias("a"))
    rows = F.when(F.coalesce(same, F.lit(False)), exact).otherwise(F.array(free(F.col("pos")), free(F.col("pos") + 1)))
    return changes.select("chrom", F.explode(rows).alias("m")).select(
        "chrom", F.col("m.at").alias("pos"), F.col("m.r").alias("m_ref"), F.col("m.a").alias("m_alt")
    )


def carried_changed(v: DataFrame, changes: DataFrame) -> DataFrame:
    """Distinct stored keys per sample that a changed record may concern: an equi-join with a residual test."""
    rows = v.join(match_rows(changes).distinct(), ["chrom", "pos"])
    exact = (F.col("ref") == F.col("m_ref")) & (F.col("alt") == F.col("m_alt"))
    return rows.where(F.col("m_ref").isNull() | exact).select("sample_id", *KEY).distinct()


def site_lookups(keys: DataFrame) -> DataFrame:
    """Positions to look up in a VCF for stored keys: an indel's record may sit one base before."""
    indel = (F.col("ref") == "-") | (F.col("alt") == "-")
    places = F.when(indel, F.array(F.col("pos"), F.col("pos") - 1)).otherwise(F.array("pos"))
    return keys.select("chrom", F.explode(places).alias("pos")).distinct()


def merge_subset(base: DataFrame, subset: DataFrame) -> DataFrame:
    """``base`` with the rows of the subset's (sample, key) replaced."""
    on = ["sample_id", *KEY]
    return base.join(subset.select(*on).distinct(), on, "left_anti").unionByName(subset)


def copy_forward(v: DataFrame, prev: str, curr: str) -> DataFrame:
    """The rows of ``prev`` stamped as ``curr``, which must be later."""
    if prev >= curr:
        raise ValueError(f"{prev} is not earlier than {curr}")
    return in_snapshot(v, prev).withColumn("snapshot_id", F.lit(curr))


def reannotate_delta(v: DataFrame, prev: str, curr: str, changes: DataFrame, records: DataFrame) -> DataFrame:
    """``curr`` from ``prev``: everything copied, rows whose record moved joined to the new records.

    ``records``: the new release keyed as stored variants are. Gives what a full annotation would.
    """
    copied = copy_forward(v, prev, curr)
    moved = copied.join(carried_changed(copied, changes), ["sample_id", *KEY], "left_semi")
    fresh = moved.drop(*RECORD).join(records.select(*KEY, *RECORD), KEY, "left").select(*copied.columns)
    return merge_subset(copied, fresh)


def incremental_kind(ledger: DataFrame, samples: DataFrame, prev: str, curr: str) -> DataFrame:
    """What each sample needs: ``full``, ``copy_forward`` or ``clinvar_delta``."""
    side = lambda s, m: in_snapshot(ledger, s).select("sample_id", *[F.col(d).alias(f"{m}_{d}") for d in DIGESTS])
    rows = samples.join(side(prev, "p"), "sample_id", "left").join(side(curr, "c"), "sample_id", "left")
    same = {d: F.col(f"p_{d}").eqNullSafe(F.col(f"c_{d}")) for d in DIGESTS}
    known = F.col("p_vcf_digest").isNotNull()
    kind = (
        F.when(~known, "full")
        .when(same["vcf_digest"] & same["cache_version"] & same["clinvar_date"], "copy_forward")
        .when(same["vcf_digest"] & same["cache_version"], "clinvar_delta")
        .otherwise("full")
    )
    return rows.select("sample_id", kind.alias("kind"))


def scan_mode(snapshots: DataFrame, anchors: DataFrame, force: bool = False) -> DataFrame:
    """Per snapshot ``full`` or ``incremental``: full if forced, first, after a version bump, or first of its month.

    ``anchors``: snapshots that had a full scan.
    """
    from pyspark.sql import Window

    order = Window.orderBy("snapshot_id")  # a row a snapshot: a few hundred in ten years
    month = F.substring("snapshot_id", 1, 7)
    months = anchors.select(F.substring("snapshot_id", 1, 7).alias("m"), F.col("snapshot_id").alias("anchor"))
    before = snapshots.withColumn("prev_version", F.lag("cache_version").over(order)).withColumn("n", F.row_number().over(order))
    joined = before.withColumn("m", month).join(months, "m", "left")
    earlier = F.coalesce(F.bool_or(F.col("anchor") < F.col("snapshot_id")), F.lit(False))
    grouped = joined.groupBy("snapshot_id", "cache_version", "prev_version", "n").agg(earlier.alias("anchored"))
    mode = F.when(
        F.lit(force) | (F.col("n") == 1) | (F.col("prev_version") != F.col("cache_version")) | ~F.col("anchored"), "full"
    ).otherwise("incremental")
    return grouped.select("snapshot_id", mode.alias("mode"))


def unscanned_samples(samples: DataFrame, scan_log: DataFrame) -> DataFrame:
    """Samples that the last completed scan did not hold."""
    last = scan_log.where("status = 'done'").agg(F.max("snapshot_id").alias("snapshot_id"))
    held = scan_log.where("status = 'done'").join(F.broadcast(last), "snapshot_id").select("sample_id")
    return samples.join(held, "sample_id", "left_anti")


def scan_due(snapshots: DataFrame, scan_log: DataFrame, samples: DataFrame, newest_upstream: str) -> DataFrame:
    """One row: whether a scan is due, and why."""
    done = scan_log.where("status = 'done'").agg(F.max("snapshot_id").alias("done"))
    pinned = snapshots.agg(F.max("snapshot_id").alias("newest"), F.max(F.regexp_replace("clinvar_date", "[^0-9]", "")).alias("pinned"))
    waiting = unscanned_samples(samples, scan_log).agg(F.count("*").alias("waiting"))
    upstream = "".join(ch for ch in newest_upstream if ch.isdigit())
    one = done.join(F.broadcast(pinned)).join(F.broadcast(waiting))  # three rows of one
    reason = (
        F.when(F.col("done").isNull(), "never scanned").when(F.col("done") < F.col("newest"), "unfinished")
        .when(F.col("waiting") > 0, "samples waiting").when(F.lit(upstream) > F.col("pinned"), "new release")
    )
    return one.select(reason.isNotNull().alias("due"), reason.alias("reason"), "waiting")


def predecessor(scan_log: DataFrame, curr: str) -> DataFrame:
    """The newest completed snapshot before ``curr``; failing that the newest earlier one."""
    older = scan_log.where(F.col("snapshot_id") < curr)
    done = F.max(F.when(F.col("status") == "done", F.col("snapshot_id")))
    return older.agg(F.coalesce(done, F.max("snapshot_id")).alias("predecessor"))


def rekey_samples(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Sample ids renamed by ``mapping`` (old, new); others stay."""
    names = mapping.select(F.col("old").alias("sample_id"), "new")
    renamed = df.join(names, "sample_id", "left")
    return renamed.withColumn("sample_id", F.coalesce("new", "sample_id")).drop("new").select(*df.columns)


def upsert_scores(cache: DataFrame, fresh: DataFrame, key: list[str]) -> DataFrame:
    """``fresh`` rows in place of cached ones of the same key."""
    return cache.join(fresh.select(*key).distinct(), key, "left_anti").unionByName(fresh)


def scan_tally(v: DataFrame) -> DataFrame:
    return v.groupBy("snapshot_id", "sample_id").agg(F.count("*").alias("n_rows"))


def input_digests(rows: DataFrame, by: str = "sample_id") -> DataFrame:
    """(``by``, n, digest): an order-free digest of each sample's rows, copies counted (see :mod:`digests`)."""
    return digests.multiset_digest(rows, [by]).select(by, "n", digests.digest_text(F.col("digest")).alias("digest"))


def stale_reports(
    reports: DataFrame, panel: DataFrame, resolved: DataFrame, category: str, cap: int | None = None, gate: bool = True
) -> DataFrame:
    """(sample_id, panel_current, consent_current, stale) of every report there is.

    ``reports``: sample_id, person, panel_stamp and consent_stamp as they were when the report was made, null where it has
    none. A report holds while its panel stamp equals that of ``panel`` (any rows: what is scored and printed) under ``cap``, and
    while what it shows is what ``resolved`` consent (person, category, granted) lets it show. A report without a panel
    stamp is stale; one without a consent stamp may have shown everything.
    """
    now = digests.multiset_digest(panel, []).select(panel_stamp(F.col("digest"), cap).alias("now"))
    ok = resolved.where((F.col("category") == category) & F.col("granted")).select("person", F.lit(True).alias("ok")).distinct()
    rows = reports.join(ok, "person", "left").join(F.broadcast(now))  # one row
    state = F.when(F.lit(gate) & F.col("ok").isNull(), "withheld").otherwise("shown")
    panel_current = F.coalesce(F.col("panel_stamp") == F.col("now"), F.lit(False))
    consent_current = F.coalesce("consent_stamp", F.lit("shown")) == state
    found = rows.select("sample_id", panel_current.alias("panel_current"), consent_current.alias("consent_current"))
    return found.withColumn("stale", ~(F.col("panel_current") & F.col("consent_current")))


def panel_stamp(digest: Column, cap: int | None = None) -> Column:
    """What a report was scored against: the panel's content, and the cap on variants, as a capped report is a partial one."""
    return F.concat(F.lit("panel="), digests.digest_text(digest), F.lit(f";cap={'none' if cap is None else cap}"))
