"""Disease panels, carrier status and the risk of children."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vardelta import schemas as S
from vardelta.functions.alleles import is_male, norm_zyg
from vardelta.functions.significance import is_actionable
from vardelta.schemas import KEY


def status_rank(status: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in S.PANEL_STATUS]), status)


def gene_status(v: DataFrame, panel: DataFrame, sexes: DataFrame) -> DataFrame:
    """Status per (sample, disease, gene) from actionable variants. ``sexes``: sample_id, sex."""
    act = v.where(is_actionable(F.col("clinvar_sig")) & F.col("gene").isNotNull()).withColumn("z", norm_zyg(F.col("zygosity")))
    hits = act.groupBy("sample_id", "gene").agg(
        F.bool_or(F.col("z") == "HOM").alias("hom"), F.count_if(F.col("z") == "HET").alias("hets"),
        F.count_distinct(F.when(F.col("z") == "HET", F.struct(*KEY))).alias("het_keys"), F.count("*").alias("n_variants"),
    )
    rows = hits.join(F.broadcast(panel), "gene").join(sexes, "sample_id", "left")
    any_ = F.col("hom") | (F.col("hets") > 0)
    one_copy = F.when(F.col("hom"), "affected").when(F.col("het_keys") >= 2, "compound").when(F.col("hets") > 0, "carrier")
    status = (
        F.when(F.col("inh") == "AR", one_copy)
        .when((F.col("inh") == "XL") & is_male(F.col("sex")), F.when(any_, "affected"))
        .when(F.col("inh") == "XL", one_copy)
        .otherwise(F.when(any_, "at-risk"))
    )
    return rows.withColumn("status", status).where("status is not null").select(
        "sample_id", "disease", "inh", "gene", "status", "n_variants"
    )


def panel_status(by_gene: DataFrame) -> DataFrame:
    """Status per (sample, disease): the most severe of its genes."""
    worst = by_gene.groupBy("sample_id", "disease").agg(
        F.min(status_rank(F.col("status"))).alias("rank"), F.count("*").alias("n_genes")
    )
    names = F.array(*[F.lit(s) for s in S.PANEL_STATUS])
    return worst.select("sample_id", "disease", F.element_at(names, F.col("rank").cast("int")).alias("status"), "n_genes")


def ar_index(by_gene: DataFrame) -> DataFrame:
    """The most severe recessive status per (gene, sample)."""
    rows = by_gene.where("inh = 'AR'").groupBy("gene", "sample_id").agg(F.min(status_rank(F.col("status"))).alias("rank"))
    names = F.array(*[F.lit(s) for s in S.PANEL_STATUS])
    return rows.select("gene", "sample_id", F.element_at(names, F.col("rank").cast("int")).alias("status"))


def member_pairs(index: DataFrame, families: DataFrame) -> DataFrame:
    """Unordered pairs of members of one family within a gene. ``families``: sample_id, family; others have no pairs."""
    own = index.join(families.select("sample_id", "family"), "sample_id")
    a = own.select("gene", "family", F.col("sample_id").alias("a"), F.col("status").alias("a_status"))
    b = own.select("gene", "family", F.col("sample_id").alias("b"), F.col("status").alias("b_status"))
    return a.join(b, ["gene", "family"]).where("a < b").drop("family")


def family_risk(index: DataFrame) -> DataFrame:
    """Per gene with two members or more: lowest and highest risk of a child, in percent, and the number of couples.

    No couple is formed: the lowest risk is that of the two members with the lowest chances to pass an allele on, the
    highest that of the two with the highest, and both follow from how many members have which status.
    """
    counts = [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in S.PASS_PERCENT]
    members = index.groupBy("gene").agg(F.count_if(F.col("status").isin(*S.PASS_PERCENT)).alias("n"), *counts).where("n >= 2")

    def couple(k: int, ascending: bool) -> Column:
        two = [F.array_repeat(F.lit(p[k]), F.least(F.col(f"n_{s}"), F.lit(2)).cast("int")) for s, p in S.PASS_PERCENT.items()]
        ranked = F.sort_array(F.concat(*two), asc=ascending)
        return F.bround(F.get(ranked, F.lit(0)) * F.get(ranked, F.lit(1)) / 100.0, 0).cast("int")

    pairs = F.expr("n * (n - 1) div 2")
    return members.select("gene", pairs.alias("n_pairs"), couple(0, True).alias("low_percent"), couple(1, False).alias("high_percent"))


def panel_report(by_gene: DataFrame, penetrance: DataFrame | None) -> DataFrame:
    """Disease rows with a note of penetrance and whether only carriers are meant.

    The note is that of the first of the row's genes, by name, that has one.
    """
    rows = panel_status(by_gene)
    generic = F.lit("penetrance not listed")
    if penetrance is None:
        noted = rows.withColumn("note", generic)
    else:
        notes = by_gene.join(F.broadcast(penetrance), "gene").groupBy("sample_id", "disease").agg(F.min_by("note", "gene").alias("note"))
        noted = rows.join(notes, ["sample_id", "disease"], "left").withColumn("note", F.coalesce("note", generic))
    return noted.withColumn("section", F.when(F.col("status") == "carrier", "carrier").otherwise("primary"))
