"""What changed between two snapshots, and how loudly to say so."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vardelta import schemas as S
from vardelta.functions.significance import is_actionable, is_uncertain, path_ordinal, review_stars
from vardelta.operators.family import in_snapshot
from vardelta.schemas import KEY

FIELDS = ["clinvar_sig", "clinvar_revstat", "gnomad_af"]
CARRIED = ["zygosity", "clinvar_disease", "consequence", "sift", "polyphen"]


def common_samples(v: DataFrame, prev: str, curr: str) -> DataFrame:
    return in_snapshot(v, curr).select("sample_id").intersect(in_snapshot(v, prev).select("sample_id"))


def new_samples(v: DataFrame, prev: str, curr: str) -> DataFrame:
    before = in_snapshot(v, prev).select("sample_id")
    return in_snapshot(v, curr).select("sample_id").distinct().join(before, "sample_id", "left_anti")


def version_bump(snapshots: DataFrame, prev: str, curr: str) -> bool:
    """Whether the two snapshots were annotated with different caches (unknown versions: no)."""
    rows = snapshots.where(F.col("snapshot_id").isin(prev, curr) & F.col("cache_version").isNotNull())
    return rows.agg(F.countDistinct("cache_version").alias("n")).first().n > 1


def snapshot_delta(v: DataFrame, prev: str, curr: str, bump: bool = False) -> DataFrame:
    """Rows of samples in both snapshots whose significance, review status or frequency differ.

    Filtered and projected before a null-safe full outer join, so an unchanged genome leaves the join at
    once and nothing downstream sees it. After a version bump the gene is not part of the key.
    """
    both = common_samples(v, prev, curr)
    on = ["sample_id", *KEY] if bump else ["sample_id", *KEY, "gene"]
    extra = ["gene"] if bump else []

    def side(snapshot: str, mark: str) -> DataFrame:
        rows = in_snapshot(v, snapshot).join(both, "sample_id", "left_semi")
        return rows.select(*[F.col(c).alias(f"{mark}_{c}") for c in [*on, *extra, *FIELDS, *CARRIED]])

    match = F.lit(True)
    for c in on:
        match = match & F.col(f"c_{c}").eqNullSafe(F.col(f"p_{c}"))
    differs = F.lit(False)
    for c in FIELDS:
        differs = differs | ~F.col(f"c_{c}").eqNullSafe(F.col(f"p_{c}"))
    joined = side(curr, "c").join(side(prev, "p"), match, "full_outer").where(differs)
    return joined.select(
        *[F.coalesce(f"c_{c}", f"p_{c}").alias(c) for c in ["sample_id", "gene", *KEY]],
        *[F.col(f"p_{c}").alias(f"prev_{c}") for c in FIELDS],
        *[F.col(f"c_{c}").alias(f"curr_{c}") for c in FIELDS],
        *[F.col(f"c_{c}").alias(c) for c in CARRIED],
    )


def change_kind(prev_sig: Column, curr_sig: Column, prev_rev: Column, curr_rev: Column, prev_af: Column, curr_af: Column) -> Column:
    """What kind of change this is; null if none that matters."""
    was, now = is_actionable(prev_sig), is_actionable(curr_sig)
    text = lambda c: F.coalesce(c, F.lit(""))
    return (
        F.when(now & ~was, F.when(is_uncertain(prev_sig), "new_pathogenic").otherwise("upgraded"))
        .when(was & ~now, "downgraded")
        .when(text(prev_sig) != text(curr_sig), "reclassified")
        .when(now & (review_stars(curr_rev) > review_stars(prev_rev)), "reclassified")
        .when((prev_af < S.RARE_AF) != (curr_af < S.RARE_AF), "af_shift")
    )


def with_change(delta: DataFrame) -> DataFrame:
    """Rows of a delta that are notable, with their kind: the gate before anything costly."""
    kind = change_kind(*[F.col(f"{side}_{c}") for c in FIELDS for side in ("prev", "curr")])
    return delta.withColumn("change_kind", kind).where("change_kind is not null")


def model_band_changes(history: DataFrame, prev: str, curr: str) -> DataFrame:
    """Variants whose model and band both changed."""
    cut = ["model_band", "model_epoch"]
    p = in_snapshot(history, prev).select(*KEY, *[F.col(c).alias(f"prev_{c}") for c in cut])
    c = in_snapshot(history, curr).select(*KEY, *[F.col(c).alias(f"curr_{c}") for c in cut])
    return p.join(c, KEY).where("prev_model_epoch <> curr_model_epoch and prev_model_band <> curr_model_band")


def recent_snapshots(snapshots: DataFrame, curr: str, window: int = S.STABILITY_WINDOW) -> DataFrame:
    """The last ``window`` snapshots up to ``curr``."""
    ids = snapshots.select("snapshot_id").where(F.col("snapshot_id") <= curr).distinct()
    return ids.orderBy(F.col("snapshot_id").desc()).limit(window)


def stability(
    history: DataFrame, curr: str, recent: DataFrame | None = None, window: int = S.STABILITY_WINDOW
) -> DataFrame:
    """Per variant how steady its significance was over the last snapshots, in thousandths.

    -500 after two turns or more, 500 if it only rose, else 0 (also without a change). ``recent``: the snapshots that
    count (read off the history if not given).
    """
    if recent is None:
        recent = recent_snapshots(history, curr, window)
    rows = history.join(F.broadcast(recent), "snapshot_id", "left_semi")
    rows = rows.withColumn("level", path_ordinal(F.col("clinvar_sig")))
    trail = rows.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("snapshot_id", "level"))).alias("t"))
    levels = F.transform("t", lambda x: x["level"])
    steps = F.filter(
        F.zip_with(F.slice(levels, 2, window), F.slice(levels, 1, window), lambda b, a: b - a),
        lambda d: d.isNotNull() & (d != 0),
    )
    turns = F.filter(
        F.zip_with(F.slice("s", 2, window), F.slice("s", 1, window), lambda b, a: (b > 0) != (a > 0)),
        lambda x: x,
    )
    out = trail.select(*KEY, steps.alias("s")).withColumn("turns", F.size(turns))
    rising = (F.size("s") > 0) & F.forall("s", lambda d: d > 0)
    return out.select(*KEY, F.when(F.col("turns") >= 2, -500).when(rising, 500).otherwise(0).alias("stability"))


def triage_factors(df: DataFrame) -> DataFrame:
    """Adds ``f_acmg``, ``f_model``, ``f_freq``, ``f_stability`` and ``f_gene`` in thousandths.

    ``df``: rows of :func:`with_change` with acmg_tier, divergence, am_milli, splice_centi, reg_band, in_panel,
    constrained, is_null and stability (any may be null).
    """
    evidence = F.when(
        is_actionable(F.col("curr_clinvar_sig")), F.least(F.lit(1000), 500 + 125 * review_stars(F.col("curr_clinvar_revstat")))
    ).otherwise(0)
    tier = F.lit(None).cast("int")
    for name, score in S.TIER_SCORES.items():
        tier = F.when(F.col("acmg_tier") == name, score).otherwise(tier)
    bonus = F.when(F.col("acmg_tier").isNotNull() & (F.col("divergence") != ""), S.DIVERGENCE_BONUS).otherwise(0)
    clamp = lambda x: F.greatest(F.lit(0), F.least(F.lit(1000), x))
    missense = clamp((F.col("am_milli") - 500) * 2)
    splice = clamp((F.col("splice_centi") - 50) * 20)
    regulatory = F.when(F.col("reg_band") == "high", 1000).when(F.col("reg_band") == "moderate", 500).when(
        F.col("reg_band") == "low", 100
    )
    some = lambda x: F.coalesce(x, F.lit(0))
    af = F.col("curr_gnomad_af")
    freq = (
        F.when(af.isNull() | (af < S.ULTRA_RARE_AF), 1000).when(af < S.RARE_AF, 600).when(af >= S.COMMON_AF, -1000).otherwise(0)
    )
    gene = F.when(F.coalesce("in_panel", F.lit(False)), 700).otherwise(0) + F.when(
        F.coalesce("is_null", F.lit(False)) & F.coalesce("constrained", F.lit(False)), 300
    ).otherwise(0)
    return (
        df.withColumn("f_acmg", (F.greatest(evidence, some(tier)) + bonus).cast("bigint"))
        .withColumn("f_model", F.greatest(some(F.when(F.col("am_milli").isNotNull(), missense)),
                                          some(F.when(F.col("splice_centi").isNotNull(), splice)), some(regulatory)).cast("bigint"))
        .withColumn("f_freq", freq.cast("bigint"))
        .withColumn("f_stability", some(F.col("stability")).cast("bigint"))
        .withColumn("f_gene", gene.cast("bigint"))
    )


def triage_score(df: DataFrame) -> DataFrame:
    """Adds ``score_micro`` (exact weighted sum), ``tier`` and ``top_factor`` from the factors."""
    score = F.lit(0).cast("bigint")
    for name, weight in S.TRIAGE_WEIGHTS.items():
        score = score + F.col(f"f_{name}") * weight
    context = F.coalesce("in_panel", F.lit(False)) | is_actionable(F.col("curr_clinvar_sig"))
    cuts = S.TRIAGE_CUTS
    s = F.col("score_micro")
    tier = (
        F.when((s >= cuts["actionable_now"]) & context, "actionable_now").when(s >= cuts["monitor"], "monitor")
        .when(s >= cuts["log_only"], "log_only").otherwise("ignore")
    )
    largest = F.greatest(*[F.abs(F.col(f"f_{n}")) for n in S.TRIAGE_WEIGHTS])
    top = F.lit(None).cast("string")
    for name in reversed(S.TRIAGE_WEIGHTS):
        top = F.when(F.abs(F.col(f"f_{name}")) == largest, F.lit(name)).otherwise(top)
    return df.withColumn("score_micro", score).withColumn("tier", tier).withColumn("top_factor", top)


def tier_rank(tier: Column) -> Column:
    return F.array_position(F.array(*[F.lit(t) for t in S.TIERS]), tier)


def order_delta(df: DataFrame) -> DataFrame:
    return df.orderBy(
        tier_rank(F.col("tier")), F.col("score_micro").desc(), F.col("stars").desc(), "sample_id",
        F.coalesce("gene", F.lit("")), *KEY,
    )


def delta_summary(findings: DataFrame) -> DataFrame:
    """Findings and distinct variants per tier and sample."""
    return findings.groupBy("tier", "sample_id").agg(
        F.count("*").alias("n"), F.countDistinct(*KEY).alias("n_variants"), F.max("score_micro").alias("best")
    )
