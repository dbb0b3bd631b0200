"""Rule-based evidence classification of variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vardelta import schemas as S
from vardelta.functions.alleles import minimal_key
from vardelta.functions.bands import is_constrained, regulatory_band
from vardelta.functions.consequences import class_scope, csq_terms, is_noncoding, primary_consequence
from vardelta.functions.significance import clinvar_class
from vardelta.schemas import KEY


def best_missense(scores: DataFrame) -> DataFrame:
    """Per key the highest transcript score with its class; of equal ones the first transcript."""
    first = F.min(F.struct((-F.col("score_milli")).alias("low"), "transcript", "score_milli", "am_class")).alias("m")
    return scores.groupBy(*KEY).agg(first).select(*KEY, F.col("m.score_milli").alias("am_milli"), "m.am_class")


def best_splice(scores: DataFrame) -> DataFrame:
    """The largest of four delta scores (hundredths) and its effect; of equal ones the first."""
    names = ["ag", "al", "dg", "dl"]
    deltas = F.array(*names)
    top = F.array_max(deltas)
    effect = F.element_at(F.array(*[F.lit(n.upper()) for n in names]), F.array_position(deltas, top).cast("int"))
    return scores.select(*KEY, top.alias("splice_centi"), effect.alias("splice_effect"))


def attach_model_scores(
    v: DataFrame, missense: DataFrame | None, splice: DataFrame | None, regulatory: DataFrame | None
) -> DataFrame:
    """Adds each model's score where the consequence lets it speak; an absent model gives nulls.

    The gate is part of the join condition's left side, so other rows never reach the shuffle with a match.
    """
    terms = csq_terms(F.col("consequence"))
    fits = F.arrays_overlap(terms, F.array(*[F.lit(t) for t in S.MISSENSE_TERMS]))
    out = v
    if missense is not None:
        gated = best_missense(missense).withColumn("__m", F.lit(True))
        out = out.withColumn("__m", F.when(fits, True)).join(gated, [*KEY, "__m"], "left").drop("__m")
    else:
        out = out.withColumns({"am_milli": F.lit(None).cast("bigint"), "am_class": F.lit(None).cast("string")})
    if splice is not None:
        gated = best_splice(splice).withColumn("__s", F.lit(True))
        near = F.when(F.coalesce(F.col("consequence"), F.lit("")).contains("splice"), True)
        out = out.withColumn("__s", near).join(gated, [*KEY, "__s"], "left").drop("__s")
    else:
        out = out.withColumns({"splice_centi": F.lit(None).cast("bigint"), "splice_effect": F.lit(None).cast("string")})
    if regulatory is not None:
        band = regulatory_band(F.col("delta_centi") / 100.0, F.col("percentile"))
        gated = regulatory.select(*KEY, band.alias("reg_band")).withColumn("__r", F.lit(True))
        far = F.when(is_noncoding(F.col("consequence")), True)
        out = out.withColumn("__r", far).join(gated, [*KEY, "__r"], "left").drop("__r")
    else:
        out = out.withColumn("reg_band", F.lit(None).cast("string"))
    return out


def by_minimal_key(scores: DataFrame) -> DataFrame:
    """Score rows re-keyed to the shortest form of their alleles."""
    rest = [c for c in scores.columns if c not in KEY]
    keyed = scores.withColumn("__k", minimal_key(F.col("pos"), F.col("ref"), F.col("alt")))
    return keyed.select("chrom", "__k.pos", "__k.ref", "__k.alt", *rest)


def attach_constraint(df: DataFrame, constraint: DataFrame | None) -> DataFrame:
    """Adds ``constrained``: null for genes without metrics."""
    if constraint is None:
        return df.withColumn("constrained", F.lit(None).cast("boolean"))
    flags = constraint.select("gene", is_constrained(F.col("pli"), F.col("loeuf")).alias("constrained"))
    return df.join(F.broadcast(flags), "gene", "left")  # a row a gene: some twenty thousand at most


def gene_context(panel: DataFrame) -> DataFrame:
    """A row a panel gene: whether any of its diseases is dominant or X-linked."""
    return panel.groupBy("gene").agg(F.bool_or(F.col("inh").isin("AD", "XL")).alias("dominant"))


def attach_genes(df: DataFrame, panel: DataFrame) -> DataFrame:
    """Adds ``in_panel`` and ``dominant``."""
    genes = gene_context(panel).withColumn("in_panel", F.lit(True))
    joined = df.join(F.broadcast(genes), "gene", "left")
    no = F.lit(False)
    return joined.withColumn("in_panel", F.coalesce("in_panel", no)).withColumn("dominant", F.coalesce("dominant", no))


def attach_annotations(calls: DataFrame, clinvar: DataFrame | None, consequences: DataFrame | None) -> DataFrame:
    """Calls with the annotation of exactly their key; absent sources give no columns' worth of rows, only nulls."""
    out = calls
    if clinvar is not None:
        out = out.join(clinvar, KEY, "left")
    if consequences is not None:
        out = out.join(consequences, KEY, "left")
    return out


def acmg_codes(df: DataFrame) -> Column:
    """Evidence codes of a row: frequency, null variants in disease genes, predictions."""
    af, sift, polyphen = F.col("gnomad_af"), F.col("sift"), F.col("polyphen")
    csq = primary_consequence(F.col("consequence"))
    sa, am = F.col("splice_centi"), F.col("am_class")
    strong_splice = F.coalesce(sa >= 50, F.lit(False))
    predicted = lambda c, prefix: F.coalesce(c.startswith(prefix), F.lit(False))
    harmful = (
        strong_splice | F.coalesce(am == "likely_pathogenic", F.lit(False))
        | (predicted(sift, "deleterious") & predicted(polyphen, "probably_damaging"))
    )
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    alone = F.coalesce(sa < 20, F.lit(False)) & F.col("am_milli").isNull() & empty(sift) & empty(polyphen)
    harmless = ~strong_splice & (
        F.coalesce(am == "likely_benign", F.lit(False)) | alone | (predicted(sift, "tolerated") & predicted(polyphen, "benign"))
    )
    weak = F.col("dominant") & F.coalesce(~F.col("constrained"), F.lit(False))
    spoken = csq.isin(S.INSILICO_TERMS)
    return F.array_compact(
        F.array(
            F.when(af > S.BA1_AF, "BA1").when(af > S.BS1_AF, "BS1"),
            F.when(af.isNull() | (af < S.PM2_AF), "PM2"),
            F.when(csq.isin(S.NULL_TERMS) & F.col("in_panel"), F.when(weak, "PVS1_moderate").otherwise("PVS1")),
            F.when(spoken & harmful, "PP3").when(spoken & harmless, "BP4"),
        )
    )


def acmg_tier(codes: Column) -> Column:
    """Combines the codes; one supporting code alone stays uncertain."""
    has = lambda c: F.array_contains(codes, c)
    count = lambda *names: sum((has(n).cast("int") for n in names), F.lit(0))
    strong, moderate = has("PVS1"), has("PVS1_moderate")
    supporting, benign = count("PM2", "PP3"), count("BS1", "BP4")
    return (
        F.when(has("BA1"), "Benign")
        .when((strong | moderate) & (benign > 0), "VUS")
        .when(strong, F.when(supporting >= 2, "Pathogenic").otherwise("Likely pathogenic"))
        .when(moderate, F.when(supporting >= 1, "Likely pathogenic").otherwise("VUS"))
        .when((supporting > 0) & (benign > 0), "VUS")
        .when(benign >= 2, "Likely benign")
        .otherwise("VUS")
    )


def divergence(tier: Column, sig: Column) -> Column:
    """Which review the tier asks for against the recorded significance; empty if none."""
    kind = clinvar_class(sig)
    path, benign = tier.isin("Pathogenic", "Likely pathogenic"), tier.isin("Benign", "Likely benign")
    return (
        F.when(path & (kind == "benign"), "contradicts_benign")
        .when(benign & (kind == "path"), "weaker")
        .when(path & (kind == "conflicting"), "resolves_to_pathogenic")
        .when(benign & (kind == "conflicting"), "resolves_to_benign")
        .when(path & kind.isin("vus", "absent"), "stronger")
        .otherwise("")
    )


def evaluate(df: DataFrame) -> DataFrame:
    """Adds ``scope``, ``codes``, ``acmg_tier`` and ``divergence`` to rows with models, constraint and gene context.

    Rows out of scope have nulls; long indels are deferred and have no codes.
    """
    scope = class_scope(F.col("consequence"), F.col("ref"), F.col("alt"))
    coded = df.withColumn("scope", scope).withColumn("codes", F.when(F.col("scope") == "call", acmg_codes(df)))
    tiered = coded.withColumn("acmg_tier", F.when(F.col("scope") == "call", acmg_tier(F.col("codes"))))
    return tiered.withColumn(
        "divergence", F.when(F.col("scope") == "call", divergence(F.col("acmg_tier"), F.col("clinvar_sig")))
    )


def attach_models_and_genes(
    rows: DataFrame, panel: DataFrame, missense: DataFrame | None, splice: DataFrame | None,
    regulatory: DataFrame | None, constraint: DataFrame | None,
) -> DataFrame:
    """All that :func:`evaluate` looks at."""
    scored = attach_model_scores(attach_genes(rows, panel), missense, splice, regulatory)
    return attach_constraint(scored, constraint)


def acmg(
    v: DataFrame, panel: DataFrame, missense: DataFrame | None = None, splice: DataFrame | None = None,
    constraint: DataFrame | None = None,
) -> DataFrame:
    """The whole classification of panel-gene variants in scope."""
    rows = attach_genes(v, panel).where("in_panel")
    rows = rows.where(class_scope(F.col("consequence"), F.col("ref"), F.col("alt")) != "none")
    return evaluate(attach_constraint(attach_model_scores(rows, missense, splice, None), constraint))


def acmg_order() -> list[Column]:
    rank = F.array_position(F.array(*[F.lit(t) for t in S.ACMG_TIERS]), F.col("acmg_tier"))
    return [rank, F.col("gene").asc_nulls_last(), *map(F.col, KEY)]


def order_acmg(df: DataFrame) -> DataFrame:
    return df.orderBy(*acmg_order())


def acmg_summary(calls: DataFrame) -> DataFrame:
    """Calls per sample: by tier, divergent, deferred."""
    return calls.groupBy("sample_id").agg(
        F.count_if(F.col("scope") == "deferred").alias("deferred"),
        F.count_if(F.col("divergence") != "").alias("divergent"),
        *[F.count_if(F.col("acmg_tier") == t).alias(t.lower().replace(" ", "_")) for t in S.ACMG_TIERS],
    )
