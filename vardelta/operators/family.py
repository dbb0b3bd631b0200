"""Who carries what, and from whom: joins over the samples of a family.

All take the variants of one snapshot (filter the partition first) and join on the four-column key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vardelta.functions.alleles import norm_zyg
from vardelta.functions.consequences import is_damaging
from vardelta.functions.significance import is_actionable
from vardelta.schemas import KEY


def in_snapshot(v: DataFrame, snapshot: str) -> DataFrame:
    """The partition of one snapshot."""
    return v.where(F.col("snapshot_id") == snapshot)


def of_sample(v: DataFrame, sample: str) -> DataFrame:
    return v.where(F.col("sample_id") == sample)


def carried_by(v: DataFrame, *samples: str) -> DataFrame:
    """Keys that any of the samples carries."""
    return v.where(F.col("sample_id").isin(*samples)).select(*KEY)


def recessive(v: DataFrame, child: str, father: str, mother: str) -> DataFrame:
    """Variants that the child has twice and each parent once."""
    het = v.where("zygosity = 'HET'")
    return (
        of_sample(v, child).where("zygosity = 'HOM'")
        .join(carried_by(het, father).distinct(), KEY, "left_semi")
        .join(carried_by(het, mother).distinct(), KEY, "left_semi")
    )


def de_novo_candidates(v: DataFrame, child: str, father: str, mother: str) -> DataFrame:
    """Variants of the child that neither parent has; not called is not the same as reference."""
    return of_sample(v, child).join(carried_by(v, father, mother), KEY, "left_anti")


def unclassified_last(df: DataFrame) -> DataFrame:
    """Classified variants first, then by gene; unknown genes last."""
    return df.orderBy(F.col("clinvar_sig").isNull(), F.col("gene").asc_nulls_last(), *KEY)


def x_linked(v: DataFrame, son: str, mother: str) -> DataFrame:
    """Actionable X variants of a son that his mother carries once."""
    act = v.where(is_actionable(F.col("clinvar_sig")) & F.col("chrom").isin("X", "chrX"))
    carrier = of_sample(act, mother).where("zygosity = 'HET'").select(*KEY, F.col("zygosity").alias("mother_zyg"))
    return of_sample(act, son).withColumnRenamed("zygosity", "son_zyg").join(carrier, KEY)


def compound_het(v: DataFrame, child: str, father: str, mother: str) -> DataFrame:
    """Pairs of different actionable variants of one gene, one from each parent alone."""
    act = v.where(is_actionable(F.col("clinvar_sig")))
    own = of_sample(act, child).where("zygosity = 'HET' and gene is not null")

    def side(has: str, lacks: str, name: str) -> DataFrame:
        rows = own.join(carried_by(act, has), KEY, "left_semi").join(carried_by(act, lacks), KEY, "left_anti")
        label = F.concat("chrom", F.lit(":"), F.col("pos").cast("string"), F.lit(" "), "ref", F.lit(">"), "alt")
        return rows.select("gene", label.alias(f"{name}_variant"), F.col("clinvar_sig").alias(f"{name}_sig"))

    return side(father, mother, "paternal").join(side(mother, father, "maternal"), "gene").where(
        "paternal_variant <> maternal_variant"
    )


def carriers(v: DataFrame) -> DataFrame:
    """Per variant of three exact significances: its carriers in order, and their number.

    The list is what a family's report prints: its length is the number of samples in ``v`` at most (some bytes each), so a
    whole cohort's rows belong in :func:`carrier_rows`, which has a row a carrier.
    """
    exact = v.where(F.col("clinvar_sig").isin("Pathogenic", "Likely_pathogenic", "Pathogenic/Likely_pathogenic"))
    each = F.concat("sample_id", F.lit("("), "zygosity", F.lit(")"))
    return exact.groupBy("gene", *KEY, "clinvar_sig").agg(
        F.array_join(F.sort_array(F.collect_list(each)), ", ").alias("carriers"), F.count("*").alias("n_carriers")
    )


def carrier_rows(v: DataFrame) -> DataFrame:
    """:func:`carriers` in long form: a row for each variant and carrier, with the number of the variant's carriers."""
    exact = v.where(F.col("clinvar_sig").isin("Pathogenic", "Likely_pathogenic", "Pathogenic/Likely_pathogenic"))
    key = ["gene", *KEY, "clinvar_sig"]
    counts = exact.groupBy(*key).agg(F.count("*").alias("n_carriers"))
    same = F.lit(True)
    for c in key:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return exact.alias("l").join(counts.alias("r"), same).select(*[f"l.{c}" for c in [*key, "sample_id", "zygosity"]], "r.n_carriers")


def parent_carriage(v: DataFrame, keys: DataFrame, callsets: DataFrame, father: str, mother: str) -> DataFrame:
    """For each key whether any callset of each parent records it. ``callsets``: sample_id, person."""
    seen = v.join(keys.select(*KEY).distinct(), KEY, "left_semi").join(callsets, "sample_id")
    flags = seen.groupBy(*KEY).agg(
        F.bool_or(F.col("person") == father).alias("in_father"), F.bool_or(F.col("person") == mother).alias("in_mother")
    )
    none = F.lit(False)
    return keys.select(*KEY).distinct().join(flags, KEY, "left").select(
        *KEY, F.coalesce("in_father", none).alias("in_father"), F.coalesce("in_mother", none).alias("in_mother")
    )


def transmission(carriage: DataFrame) -> DataFrame:
    """How each variant came to the child, from nullable parental flags."""
    f, m = F.col("in_father"), F.col("in_mother")
    way = (
        F.when(f.isNull() | m.isNull(), "unresolved").when(f & m, "both").when(f, "paternal").when(m, "maternal")
        .otherwise("neither")
    )
    return carriage.withColumn("transmission", way)


def resolve_genes(transmitted: DataFrame) -> DataFrame:
    """Phase of a gene's variants from their transmissions: one row a gene."""
    way = F.col("transmission")
    seen = transmitted.groupBy("gene").agg(
        F.bool_or(way.isin("unresolved", "neither", "both")).alias("open"),
        F.bool_or(way == "paternal").alias("pat"), F.bool_or(way == "maternal").alias("mat"),
        F.count("*").alias("n_variants"),
    )
    phase = F.when(F.col("open"), "unresolved").when(F.col("pat") & F.col("mat"), "in-trans").otherwise("in-cis")
    return seen.select("gene", "n_variants", phase.alias("phase"))


def double_het_genes(v: DataFrame, panel: DataFrame, sample: str) -> DataFrame:
    """Damaging heterozygous variants of panel genes that have two or more of them on one contig."""
    damaging = is_damaging(F.col("consequence"), F.col("sift"), F.col("polyphen"))
    rows = of_sample(v, sample).where((F.col("zygosity") == "HET") & damaging)
    rows = rows.join(F.broadcast(panel.select("gene").distinct()), "gene", "left_semi")
    together = Window.partitionBy("gene", "chrom")
    return rows.withColumn("n_hets", F.count("*").over(together)).where("n_hets >= 2")


def second_hits(v: DataFrame, panel: DataFrame, most: int = 50, max_af: float = 0.01) -> DataFrame:
    """Other heterozygous variants of recessive genes with exactly one actionable one, unseen ones first."""
    genes = panel.where("inh = 'AR'").select("gene").distinct()
    hets = v.where("zygosity = 'HET'").join(F.broadcast(genes), "gene", "left_semi")
    group = Window.partitionBy("sample_id", "gene")
    act = is_actionable(F.col("clinvar_sig"))
    counted = hets.withColumn("act", act).withColumn("n_act", F.sum(F.col("act").cast("int")).over(group))
    rest = counted.where(~F.col("act") & (F.col("n_act") == 1) & (F.col("gnomad_af").isNull() | (F.col("gnomad_af") <= max_af)))
    order = group.orderBy(F.col("gnomad_af").asc_nulls_first(), *KEY)
    return rest.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def second_hit_order() -> list:
    """On one copy with the first hit last; scored ones first, by value."""
    return [F.col("phase") == "cis", F.col("value").isNull(), F.col("value").desc_nulls_last()]


def parental_phase(pairs: DataFrame) -> DataFrame:
    """Phase of two variants from which parents carry them: ``a_father``, ``a_mother``, ``b_father``, ``b_mother``."""
    one = (F.col("a_father") != F.col("a_mother")) & (F.col("b_father") != F.col("b_mother"))
    phase = F.when(~one, "unknown").when(F.col("a_father") == F.col("b_father"), "cis").otherwise("trans")
    return pairs.withColumn("phase", phase)


def family_carriers(v: DataFrame, callset_person: DataFrame) -> DataFrame:
    """Per actionable variant and person: the stronger zygosity and the callsets that show it."""
    act = v.where(is_actionable(F.col("clinvar_sig"))).join(callset_person, "sample_id")
    return act.groupBy(*KEY, "person").agg(
        F.when(F.bool_or(norm_zyg(F.col("zygosity")) == "HOM"), "HOM").otherwise("HET").alias("zyg"),
        F.array_join(F.sort_array(F.collect_set("sample_id")), ",").alias("callsets"),
        F.countDistinct("sample_id").alias("n_callsets"),
    )


def origins(found: DataFrame, people: DataFrame, sequenced: DataFrame) -> DataFrame:
    """Where each carrier's copy came from. ``sequenced``: persons with any callset."""
    known = people.select(F.col("id").alias("person"), "father", "mother")
    read = sequenced.select("person").distinct()
    has = found.select(*KEY, F.col("person").alias("p")).distinct()
    joined = found.join(known, "person", "left")
    for side in ("father", "mother"):
        carriers_ = has.select(*KEY, F.col("p").alias(side), F.lit(True).alias(f"{side}_has"))
        was_read = read.select(F.col("person").alias(side), F.lit(True).alias(f"{side}_read"))
        joined = joined.join(carriers_, [*KEY, side], "left").join(was_read, side, "left")
    both_read = F.col("father_read").isNotNull() & F.col("mother_read").isNotNull()
    f, m = F.coalesce("father_has", F.lit(False)), F.coalesce("mother_has", F.lit(False))
    origin = (
        F.when(F.col("father").isNull() | F.col("mother").isNull(), "founder").when(~both_read, "unresolved")
        .when(f & m, "both").when(f, "father").when(m, "mother").otherwise("de_novo")
    )
    return joined.withColumn("origin", origin).select(*found.columns, "origin")


def discordant(found: DataFrame, callset_person: DataFrame) -> DataFrame:
    """Carriers whom some of their callsets do not show."""
    total = callset_person.groupBy("person").agg(F.countDistinct("sample_id").alias("n_all"))
    return found.join(total, "person").where("n_callsets < n_all")
