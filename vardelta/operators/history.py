"""Provenance, history and retrospective validation of calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vardelta.functions.significance import path_ordinal, review_stars
from vardelta.operators import classify
from vardelta.operators.family import in_snapshot
from vardelta.schemas import KEY
from vardelta.sources import store


def relevant_variants(v: DataFrame, panel: DataFrame) -> DataFrame:
    """Classified or panel-gene variants per snapshot, one row a key; a panel gene is preferred."""
    genes = panel.select("gene").distinct().withColumn("on_panel", F.lit(True))
    rows = v.join(F.broadcast(genes), "gene", "left").where("clinvar_sig is not null or on_panel")
    least = [F.min(c).alias(c) for c in ("consequence", "clinvar_sig", "clinvar_revstat", "gnomad_af", "sift", "polyphen")]
    best = F.coalesce(F.max(F.when(F.col("on_panel"), F.col("gene"))), F.min("gene"))
    return rows.groupBy("snapshot_id", *KEY).agg(best.alias("gene"), *least)


def _evaluated(v: DataFrame, panel: DataFrame, missense, splice, regulatory, constraint) -> DataFrame:
    rows = classify.attach_genes(relevant_variants(v, panel), panel)
    rows = classify.attach_model_scores(rows, missense, splice, regulatory)
    done = classify.evaluate(classify.attach_constraint(rows, constraint))
    for c in ("scope", "acmg_tier", "codes"):
        done = done.withColumn(c, F.when(F.col("in_panel"), F.col(c)))
    return done


def history(v: DataFrame, panel: DataFrame, missense=None, splice=None, regulatory=None, constraint=None) -> DataFrame:
    """A row for each relevant variant and snapshot, with frequency, tier and model band. All snapshots in one job.

    A snapshot's date is the one that its name begins with; null where it does not.
    """
    done = _evaluated(v, panel, missense, splice, regulatory, constraint)
    return done.select(
        "snapshot_id", *KEY, "gene", "clinvar_sig", "clinvar_revstat", "acmg_tier", F.col("reg_band").alias("model_band"),
        "gnomad_af", F.try_to_date(F.substring("snapshot_id", 1, 10), "yyyy-MM-dd").alias("snapshot_date"),
    )


def in_force(versions: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(snapshot_id, source, version, as_of): what was the newest version of each source when a snapshot was made.

    ``versions``: source, version, since (a date as text); of one day the last by name. A version of the snapshot's own day
    is in force; before a source's first version there is no row. An as-of join: both sides are put in one order a source and
    the last version is carried on.
    """
    told = versions.select("source", F.col("since").alias("at"), F.lit(0).alias("asked"), "version", F.lit(None).cast("string").alias("snapshot_id"))
    asked = snapshots.select("snapshot_id").distinct().join(F.broadcast(versions.select("source").distinct()))  # a row a source
    asked = asked.select("source", F.substring("snapshot_id", 1, 10).alias("at"), F.lit(1).alias("asked"), F.lit(None).cast("string").alias("version"), "snapshot_id")
    upto = Window.partitionBy("source").orderBy("at", "asked", "version").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("asked") == 0, F.struct("version", F.col("at").alias("as_of"))), ignorenulls=True).over(upto)
    rows = told.union(asked).withColumn("last", last).where("asked = 1 and last is not null")
    return rows.select("snapshot_id", "source", "last.version", "last.as_of")


def pin_versions(versions: DataFrame, snapshots: DataFrame, root: str) -> None:
    """Write down which version of each source a snapshot was made with (:func:`in_force`), a partition a snapshot.

    Snapshots that have a manifest keep it: what a later list of versions says about an earlier day changes nothing.
    """
    spark = snapshots.sparkSession
    rows = in_force(versions, snapshots)
    if store.exists(spark, f"{root}/manifests"):
        rows = rows.join(store.read_companion(spark, root, "manifests").select("snapshot_id").distinct(), "snapshot_id", "left_anti")
    store.write_companion(rows, root, "manifests", ["snapshot_id"])


def provenance(
    v: DataFrame, panel: DataFrame, missense=None, splice=None, regulatory=None, constraint=None, versions: DataFrame | None = None
) -> DataFrame:
    """A row for each relevant variant and source that said something about it.

    With ``versions`` (source, version, since) a row names the version in force when the snapshot was made. ``sample_id`` is
    null: annotation is that of the variant, whoever carries it.
    """
    done = _evaluated(v, panel, missense, splice, regulatory, constraint)
    used = lambda *codes: F.coalesce(
        F.arrays_overlap("codes", F.array(*[F.lit(c) for c in codes])), F.lit(False)
    )
    stars = review_stars(F.col("clinvar_revstat"))
    by_stars = F.when(stars >= 3, "High").when(stars == 2, "Medium").when(stars == 1, "Low").otherwise("Very Low")
    called = F.col("scope") == "call"

    def said(name: str, value: Column, band: Column, in_code: Column, when: Column) -> Column:
        return F.when(
            when & value.isNotNull(),
            F.struct(F.lit(name).alias("source"), value.alias("value"), band.alias("confidence"), in_code.alias("used_in_code")),
        )

    sources = F.array(
        said("clinvar", F.col("clinvar_sig"), by_stars, F.lit(False), F.lit(True)),
        said("consequence", F.col("consequence"), F.lit("High"), used("PVS1", "PVS1_moderate"), F.lit(True)),
        said("gnomad_af", F.col("gnomad_af").cast("decimal(9,6)").cast("string"), F.lit("High"), used("BA1", "BS1", "PM2"), F.lit(True)),
        said("missense", F.col("am_class"), F.lit("Medium"), used("PP3", "BP4"), called),
        said("splice", F.col("splice_effect"), F.lit("Medium"), used("PP3", "BP4"), called),
        said("regulatory", F.col("reg_band"), F.lit("Low"), F.lit(False), called),
        said("constraint", F.col("constrained").cast("string"), F.lit("Medium"), used("PVS1", "PVS1_moderate"), called),
    )
    rows = done.select("snapshot_id", *KEY, F.explode(F.array_compact(sources)).alias("s"))
    rows = rows.select("snapshot_id", F.lit(None).cast("string").alias("sample_id"), *KEY, "s.*")
    if versions is None:
        return rows.withColumn("version", F.lit(None).cast("string")).withColumn("as_of", F.lit(None).cast("string"))
    force = in_force(versions, v.select("snapshot_id"))  # a row a snapshot and source
    return rows.join(F.broadcast(force), ["snapshot_id", "source"], "left")


def truth_join(findings: DataFrame, v: DataFrame, truth: str) -> DataFrame:
    """Findings with the later significance; ``present`` tells an absent variant from an unclassified one."""
    later = in_snapshot(v, truth).groupBy(*KEY).agg(F.min("clinvar_sig").alias("truth_sig"))
    joined = findings.join(later.withColumn("present", F.lit(True)), KEY, "left")
    return joined.withColumn("present", F.coalesce("present", F.lit(False)))


def outcome(judged: DataFrame) -> DataFrame:
    """Adds ``outcome``: whether the later release bore the finding out."""
    r, t = path_ordinal(F.col("curr_clinvar_sig")), path_ordinal(F.col("truth_sig"))
    kind = F.col("change_kind")
    word = lambda good: F.when(good, "confirmed").otherwise("reverted")
    out = (
        F.when(~F.col("present"), "unknown")
        .when(kind.isin("new_pathogenic", "upgraded"), word(t >= 1))
        .when(kind == "downgraded", word(t <= 0))
        .when(t > r, "confirmed").when(t < r, "reverted").otherwise("stable_noise")
    )
    return judged.withColumn("outcome", out)


def outcome_matrix(judged: DataFrame) -> DataFrame:
    """Outcomes by tier."""
    names = ["confirmed", "reverted", "stable_noise", "unknown"]
    return judged.groupBy("tier").agg(*[F.count_if(F.col("outcome") == n).alias(n) for n in names])


def validation_summary(judged: DataFrame) -> DataFrame:
    """One row, also for no findings: useful, noise, and precision of the top tier (null without verdicts)."""
    top = F.col("tier") == "actionable_now"
    hit = F.count_if(top & (F.col("outcome") == "confirmed"))
    miss = F.count_if(top & (F.col("outcome") == "reverted"))
    return judged.agg(
        F.count("*").alias("n_deltas"), F.count_if(F.col("outcome") == "confirmed").alias("useful"),
        F.count_if(F.col("outcome").isin("reverted", "stable_noise")).alias("noise"),
        F.try_divide(hit.cast("double"), (hit + miss).cast("double")).alias("precision"),
    )
