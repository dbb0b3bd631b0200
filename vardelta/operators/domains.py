"""Small domains: rule traits, tags, repeats, typed alleles, haplogroups, mitochondria, drug genes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vardelta.functions.alleles import decode_genotype, is_male, is_pass

# Locus, least premutation size (if any), least pathogenic size.
REPEAT_LOCI = [
    ("HTT", 27, 36), ("FMR1", 55, 200), ("C9orf72", 24, 30), ("DMPK", 35, 50), ("FXN", None, 66), ("AR", None, 38),
    ("ATXN1", None, 39), ("ATXN2", None, 33), ("ATXN3", None, 56), ("ATXN7", None, 37), ("CACNA1A", None, 20),
    ("TBP", None, 49), ("ATN1", None, 48),
]
# Subtypes without the association, and alpha chains of the first celiac heterodimer.
B27_EXCEPTIONS = ["B*27:06", "B*27:09"]
DQ25_ALPHA = ["DQA1*05:01", "DQA1*05:05"]
HOMOPLASMIC, LEAST_HETEROPLASMIC = 0.95, 0.03
LEAST_QUALITY = 0.85
# Words of an unremarkable phenotype.
NORMAL_HINTS = ["normal", "n/a", "uncertain", "no result", "indeterminate", "negative", "reference", "not called"]


def rule_genotypes(rules: DataFrame, samples: DataFrame, genotypes: DataFrame) -> DataFrame:
    """Every rule for every sample: an absent record is the reference twice, a no-call stays open.

    ``rules``: trait, chrom, pos, ref, effect, interp0, interp1, interp2 (a bounded list, broadcast).
    """
    every = samples.select("sample_id").join(rules)
    alleles = decode_genotype(F.col("g_ref"), F.col("g_alt"), F.col("gt"))
    records = genotypes.where(is_pass(F.col("filter"))).select(
        "sample_id", "chrom", "pos", F.col("ref").alias("g_ref"), F.col("alt").alias("g_alt"), "gt", F.lit(True).alias("seen")
    )
    rows = every.join(records, ["sample_id", "chrom", "pos"], "left")
    pair = F.when(F.col("seen"), alleles).otherwise(F.array("ref", "ref"))
    rows = rows.withColumn("pair", pair)
    n = F.size(F.filter("pair", lambda a: a == F.col("effect")))
    said = F.when(F.col("pair").isNull(), "indeterminate").otherwise(F.element_at(F.array("interp0", "interp1", "interp2"), n + 1))
    return rows.select(
        "sample_id", "trait", F.coalesce(F.array_join("pair", "/"), F.lit("./.")).alias("genotype"),
        F.when(F.col("pair").isNotNull(), n).alias("n_effect"), said.alias("interpretation"),
    )


def tag_summary(tagged: DataFrame) -> DataFrame:
    """Per sample whether any tag is present, none, or one is open."""
    seen, open_ = F.bool_or(F.col("n_effect") > 0), F.bool_or(F.col("n_effect").isNull())
    word = F.when(F.coalesce(seen, F.lit(False)), "present").when(open_, "indeterminate").otherwise("absent")
    return tagged.groupBy("sample_id").agg(word.alias("tag"))


def repeat_thresholds(spark) -> DataFrame:
    return spark.createDataFrame(REPEAT_LOCI, "locus string, premutation int, pathogenic int")


def repeat_status(calls: DataFrame, thresholds: DataFrame, consented: DataFrame) -> DataFrame:
    """Loci with their largest size and range; without consent the whole category is withheld, not only hits.

    ``calls``: sample_id, varid, sizes (array<int>); ``consented``: sample_id.
    """
    known = thresholds.select(F.lower("locus").alias("low"), "locus", "premutation", "pathogenic")
    rows = calls.withColumn("low", F.lower("varid")).join(known, "low", "left")
    top = F.array_max("sizes")
    status = (
        F.when(F.col("locus").isNull() | top.isNull(), "none").when(top >= F.col("pathogenic"), "expanded")
        .when(F.coalesce(top >= F.col("premutation"), F.lit(False)), "premutation").otherwise("normal")
    )
    ok = consented.select("sample_id", F.lit(True).alias("ok"))
    rows = rows.withColumn("top", top).withColumn("status", status).join(ok, "sample_id", "left")
    return rows.where(F.col("locus").isNull() | F.col("ok")).select("sample_id", "varid", "top", "status")


def two_fields(allele: Column) -> Column:
    """``A*01:01:02`` to ``A*01:01``."""
    return F.regexp_replace(allele, r"^([^:]+:[^:]+):.*$", "$1")


def hla_risk(typed: DataFrame) -> DataFrame:
    """Risk calls from typed alleles. ``typed``: sample_id, b, dqa1, dqb1 (arrays)."""
    cut = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), two_fields)
    b, alpha, beta = cut(F.col("b")), cut(F.col("dqa1")), cut(F.col("dqb1"))
    b27 = F.filter(b, lambda a: a.startswith("B*27"))
    linked = F.exists(b27, lambda a: ~a.isin(B27_EXCEPTIONS))
    call = F.when(linked, "present").when(F.size(b27) > 0, "non-associated").otherwise("absent")
    dq25 = F.arrays_overlap(alpha, F.array(*[F.lit(a) for a in DQ25_ALPHA])) & F.array_contains(beta, "DQB1*02:01")
    dq8 = F.array_contains(beta, "DQB1*03:02")
    celiac = F.concat_ws(" + ", F.when(dq25, F.lit("DQ2.5")), F.when(dq8, F.lit("DQ8")))
    return typed.select("sample_id", call.alias("b27"), F.when(celiac == "", "neither").otherwise(celiac).alias("celiac"))


def haplogroup_qc(calls: DataFrame, people: DataFrame) -> DataFrame:
    """Maternal groups below the quality are unresolved; paternal groups are of males only.

    ``calls``: sample_id, person, mt_group, mt_quality (text), y_group.
    """
    rows = calls.join(people.select(F.col("id").alias("person"), "sex"), "person", "left")
    good = F.coalesce(F.col("mt_quality").try_cast("double") >= LEAST_QUALITY, F.lit(False))
    return rows.select(
        "sample_id", F.when(good, F.col("mt_group")).otherwise("unresolved").alias("mt_group"),
        F.when(is_male(F.col("sex")), F.col("y_group")).alias("y_group"),
    )


def mito_calls(rows: DataFrame, curated: DataFrame) -> DataFrame:
    """Mitochondrial calls with their level and whether they are on the curated list; unreadable shares go."""
    share = F.col("af").try_cast("double")
    level = F.when(share >= HOMOPLASMIC, "homoplasmic").when(share >= LEAST_HETEROPLASMIC, "heteroplasmic").otherwise("low")
    known = curated.select("pos", "ref", "alt", "disease")
    return rows.where(share.isNotNull()).withColumn("level", level).join(known, ["pos", "ref", "alt"], "left")


def mito_summary(calls: DataFrame) -> DataFrame:
    ok = F.coalesce(F.col("filter") == "PASS", F.lit(False))
    each = [F.count_if(ok & (F.col("level") == n)).alias(n) for n in ("homoplasmic", "heteroplasmic", "low")]
    return calls.groupBy("sample_id").agg(
        *each, F.count_if(ok & F.col("disease").isNotNull()).alias("known"), F.count_if(~ok).alias("filtered_out")
    )


def pgx_summary(genes: DataFrame) -> DataFrame:
    """Per sample genes called, and those whose phenotype holds none of the unremarkable words."""
    words = F.lower(F.coalesce("phenotype", F.lit("")))
    usual = F.lit(False)
    for hint in NORMAL_HINTS:
        usual = usual | words.contains(hint)
    return genes.groupBy("sample_id").agg(F.count("*").alias("called"), F.count_if(~usual).alias("non_normal"))
