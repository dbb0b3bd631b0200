"""Score tables of models: latest values, candidates, calibration by a null."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vardelta.functions.alleles import is_snv
from vardelta.functions.consequences import is_noncoding
from vardelta.operators.ranks import running_totals
from vardelta.schemas import KEY


def latest_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``."""
    last = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("__r", F.row_number().over(last)).where("__r = 1").drop("__r")


def current_scores(long: DataFrame, epoch: str, key: list[str]) -> DataFrame:
    """The latest non-empty score of each natural key within one epoch."""
    rows = long.where((F.col("epoch") == epoch) & F.col("raw_score").isNotNull())
    return latest_per_key(rows, key, ["ingested"])


def regulatory_candidates(v: DataFrame, max_af: float = 0.05) -> DataFrame:
    """Distinct carried regulatory variants that are rare or unseen, with their least frequency and carriers."""
    rows = v.where(F.col("zygosity").isin("HET", "HOM") & (F.col("gnomad_af").isNull() | (F.col("gnomad_af") <= max_af)))
    rows = rows.where(is_noncoding(F.col("consequence")))
    return rows.groupBy(*KEY).agg(
        F.min("gene").alias("gene"), F.min("consequence").alias("consequence"), F.min("gnomad_af").alias("af"),
        F.array_join(F.sort_array(F.collect_set("sample_id")), ",").alias("carriers"),
    )


def top_candidates(candidates: DataFrame, scored: DataFrame, most: int = 256) -> DataFrame:
    """The first candidates that have no score yet: unseen ones, then by frequency. ``most`` is the report's size."""
    rest = candidates.join(scored.select(*KEY).distinct(), KEY, "left_anti")
    return rest.orderBy(F.col("af").asc_nulls_first(), *KEY).limit(most)


def null_sample(v: DataFrame, n: int = 400, common: float = 0.2) -> DataFrame:
    """Common regulatory variants as a null: ``n`` single-base and ``n`` other ones, in a stable hash order."""
    rows = v.where((F.col("gnomad_af") >= common) & is_noncoding(F.col("consequence"))).select(*KEY).distinct()
    name = F.concat_ws(":", "chrom", F.col("pos").cast("string"), "ref", "alt")
    rows = rows.withColumn("snv", is_snv(F.col("ref"), F.col("alt"))).withColumn("__h", F.md5(name))
    first = [rows.where(kind).orderBy("__h").limit(n) for kind in (F.col("snv"), ~F.col("snv"))]  # n rows of each task at most
    order = Window.partitionBy("snv").orderBy("__h")
    return first[0].union(first[1]).withColumn("place", F.row_number().over(order)).drop("__h")


def null_percentile(scores: DataFrame, null: DataFrame) -> DataFrame:
    """Share (percent) of the stratum's null values at or below each score; null for an empty stratum.

    Both sides are one ordered sequence a stratum. ``scores``: key, snv, value; ``null``: snv, value.
    """
    asked = scores.select(*KEY, "snv", "value", F.lit(0).alias("b"))
    base = null.select(
        F.lit(None).cast("string").alias("chrom"), F.lit(None).cast("bigint").alias("pos"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("string").alias("alt"), "snv", "value", F.lit(1).alias("b"),
    )
    rows = running_totals(asked.union(base), "snv", "value", ["b"], strict=False)
    share = F.when(F.col("b_all") > 0, F.col("b_below") * 100.0 / F.col("b_all"))
    return rows.where("b = 0").select(*KEY, "snv", "value", share.alias("percentile"))


def score_summary(long: DataFrame, genes: DataFrame) -> DataFrame:
    """Per variant and gene the greatest absolute value of its own RNA tracks; only without any, of DNase ones.

    ``genes``: key, gene of interest. ``long``: key, scorer, gene, raw_score.
    """
    rows = genes.select(*KEY, F.col("gene").alias("target")).join(long, KEY).where(~F.isnan("raw_score") & (F.abs("raw_score") < float("inf")))
    own = (F.col("scorer") == "RNA_SEQ") & (F.col("gene") == F.col("target"))
    rna = F.max(F.when(own, F.abs("raw_score")))
    dnase = F.max(F.when(F.col("scorer") == "DNASE", F.abs("raw_score")))
    out = rows.groupBy(*KEY, "target").agg(rna.alias("rna"), dnase.alias("dnase"))
    kind = F.when(F.col("rna").isNotNull(), "RNA_SEQ").otherwise("DNASE")
    return out.select(*KEY, "target", F.coalesce("rna", "dnase").alias("value"), kind.alias("scorer")).where("value is not null")


def splice_evidence(long: DataFrame, splice: DataFrame) -> DataFrame:
    """Greatest absolute value per splice scorer of variants without a precomputed splice score."""
    rows = long.where(F.col("scorer").startswith("SPLICE")).join(splice.select(*KEY).distinct(), KEY, "left_anti")
    return rows.groupBy(*KEY, "scorer").agg(F.max(F.abs("raw_score")).alias("value"))


def epoch_check(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """One row: whether two sets of sentinel values have the same keys and close values."""
    a = old.select(*key, F.col("raw_score").alias("a"))
    b = new.select(*key, F.col("raw_score").alias("b"))
    tolerance = F.greatest(F.greatest(F.abs("a"), F.abs("b")) * 1e-6, F.lit(1e-7))
    close = F.coalesce(F.abs(F.col("a") - F.col("b")) <= tolerance, F.lit(False))
    return a.join(b, key, "full_outer").agg(F.coalesce(F.bool_and(close), F.lit(False)).alias("same"), F.count("*").alias("n"))


def sv_expression(long: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per (variant, gene) the signed value of its largest own-gene RNA row. ``pairs``: key, gene."""
    rows = pairs.join(long.where("scorer = 'RNA_SEQ'"), [*KEY, "gene"])
    size = F.struct(F.abs("raw_score").alias("s"), F.col("raw_score").alias("v"))
    return rows.groupBy(*KEY, "gene").agg(F.max_by("raw_score", size).alias("value"))
