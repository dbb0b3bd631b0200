"""The delta job and the full findings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vardelta import schemas as S
from vardelta.functions.consequences import primary_consequence
from vardelta.functions.significance import disease_name, is_actionable, rarity, review_stars, sig_rank
from vardelta.operators import classify
from vardelta.operators import delta as changes
from vardelta.operators.genotypes import attach_allele_balance
from vardelta.schemas import KEY
from vardelta.sources.store import written


def changed(v: DataFrame, snapshots: DataFrame, prev: str, curr: str) -> tuple[DataFrame, bool]:
    """Notable changes between two snapshots; after a version bump without frequency shifts."""
    bump = changes.version_bump(snapshots, prev, curr)
    rows = changes.with_change(changes.snapshot_delta(v, prev, curr, bump))
    return (rows.where("change_kind <> 'af_shift'") if bump else rows), bump


def delta(
    v: DataFrame, snapshots: DataFrame, prev: str, curr: str, panel: DataFrame, missense: DataFrame | None,
    splice: DataFrame | None, regulatory: DataFrame | None, constraint: DataFrame | None,
    trails: Callable[[DataFrame], DataFrame] | None,
) -> DataFrame:
    """Every notable change, scored and put into a tier.

    The changed rows are written first. Scores are cut to their keys, and so are the variants from which ``trails`` makes the
    significance of each (snapshot, key): only changed keys in the few snapshots that count are ever grouped.
    """
    rows, _ = changed(v, snapshots, prev, curr)
    rows = written(rows, "changed")
    keys = rows.select(*KEY).distinct()
    only = lambda df: None if df is None else df.join(keys, KEY, "left_semi")
    missense, splice, regulatory = only(missense), only(splice), only(regulatory)
    rows = rows.withColumn("clinvar_sig", F.col("curr_clinvar_sig")).withColumn("gnomad_af", F.col("curr_gnomad_af"))
    rows = classify.attach_models_and_genes(rows, panel, missense, splice, regulatory, constraint)
    judged = classify.evaluate(rows)
    null_variant = (F.col("scope") != "none") & primary_consequence(F.col("consequence")).isin(S.NULL_TERMS)
    judged = judged.withColumn("is_null", null_variant)
    if trails is None:
        judged = judged.withColumn("stability", F.lit(0))
    else:
        recent = changes.recent_snapshots(snapshots, curr)
        counted = v.join(F.broadcast(recent), "snapshot_id", "left_semi").join(keys, KEY, "left_semi")
        judged = judged.join(changes.stability(trails(counted), curr, recent), KEY, "left")
    return changes.triage_score(changes.triage_factors(judged)).withColumn(
        "stars", review_stars(F.col("curr_clinvar_revstat"))
    )


def full_findings(
    v: DataFrame, genotypes: DataFrame | None = None, missense: DataFrame | None = None, splice: DataFrame | None = None
) -> DataFrame:
    """Actionable rows with stars, rarity and disease, the reads that carry the variant, and what models say of it.

    ``low_balance`` flags heterozygous calls that too few reads bear out. A splice score too low to matter is left out.
    Columns of a table that is not given are null. Scores and genotypes are cut to the findings before they are joined.
    """
    rows = v.where(is_actionable(F.col("clinvar_sig")))
    rows = (
        rows.withColumn("stars", review_stars(F.col("clinvar_revstat")))
        .withColumn("rarity", rarity(F.col("gnomad_af")))
        .withColumn("disease", disease_name(F.col("clinvar_disease")))
    )
    none = lambda **kinds: {c: F.lit(None).cast(k) for c, k in kinds.items()}
    if genotypes is None:
        rows = rows.withColumns(none(alt_reads="int", total_reads="int", low_balance="boolean"))
    else:
        rows = attach_allele_balance(rows, genotypes)
    keys = rows.select(*KEY).distinct()
    if missense is None:
        rows = rows.withColumns(none(am_milli="bigint", am_class="string"))
    else:
        rows = rows.join(classify.best_missense(missense.join(keys, KEY, "left_semi")), KEY, "left")
    if splice is None:
        return rows.withColumns(none(splice_centi="bigint", splice_effect="string"))
    told = classify.best_splice(splice.join(keys, KEY, "left_semi")).where(F.col("splice_centi") >= 100 * S.SPLICE_POSSIBLE)
    return rows.join(told, KEY, "left")


def full_order() -> list:
    return [sig_rank(F.col("clinvar_sig")), F.col("stars").desc(), F.coalesce("gene", F.lit("zzz")), F.col("sample_id"), *map(F.col, KEY)]


def order_full(df: DataFrame) -> DataFrame:
    return df.orderBy(*full_order())


def full_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("sample_id").agg(
        F.count("*").alias("actionable"), F.count_if(F.col("stars") >= 1).alias("reviewed"),
        F.count_if(F.col("stars") == 0).alias("unreviewed"),
    )
