"""Jobs over genotype records in VCF form: de-novo calls, phase, allele balance, quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vardelta import schemas as S
from vardelta.functions.alleles import (
    ad_counts,
    decode_genotype,
    is_autosome,
    is_low_balance,
    is_pass,
    is_snv,
    reject_reason,
    total_reads,
    trimmed_key,
    vaf,
)
from vardelta.schemas import KEY

STRETCH = 1_000_000  # bases of a contig in one window


def has_alt(gt: Column) -> Column:
    """Whether a genotype holds any alternative allele."""
    return F.coalesce(F.exists(F.split(gt, "[/|]"), lambda a: ~a.isin("0", ".", "")), F.lit(False))


def is_het(gt: Column) -> Column:
    parts = F.split(gt, "[/|]")
    called = ~F.exists(parts, lambda a: a.isin(".", ""))
    return F.coalesce(called & (F.size(parts) == 2) & (F.get(parts, F.lit(0)) != F.get(parts, F.lit(1))), F.lit(False))


def split_multiallelic(g: DataFrame) -> DataFrame:
    """One row per alternative allele: read counts of reference and allele, genotype renumbered to 0 and 1."""
    alts = F.split("alt", ",")
    rows = g.select("*", F.posexplode(alts).alias("place", "one"))
    own = (F.col("place") + 1).cast("string")
    gt = F.transform(F.split("gt", "[/|]"), lambda a: F.when(a == own, "1").when(a == ".", ".").otherwise("0"))
    sep = F.when(F.col("gt").contains("|"), "|").otherwise("/")
    counts = F.split("ad", ",")
    ad = F.concat_ws(",", F.get(counts, F.lit(0)), F.coalesce(F.get(counts, F.col("place") + 1), F.lit(".")))
    rest = [c for c in g.columns if c not in ("alt", "gt", "ad")]
    return rows.select(
        *rest, F.col("one").alias("alt"), F.when(sep == "|", F.array_join(gt, "|")).otherwise(F.array_join(gt, "/")).alias("gt"), ad.alias("ad")
    )


def attach_allele_balance(v: DataFrame, g: DataFrame) -> DataFrame:
    """Adds alternative and total reads from the genotype record of the same (trimmed) key, and the low-balance flag."""
    counts = ad_counts(F.col("ad"))
    k = trimmed_key(F.col("pos"), F.col("ref"), F.col("alt"))
    reads = g.select(
        "sample_id", "chrom", k.alias("k"), F.get(counts, F.lit(1)).alias("alt_reads"), total_reads(counts).alias("total_reads")
    ).where("total_reads > 0")
    keyed = reads.select("sample_id", "chrom", "k.pos", "k.ref", "k.alt", "alt_reads", "total_reads")
    joined = v.join(keyed, ["sample_id", *KEY], "left")
    return joined.withColumn("low_balance", is_low_balance(F.col("zygosity"), F.col("alt_reads"), F.col("total_reads")))


def median_het_depth(g: DataFrame) -> DataFrame:
    """Per sample the upper median depth of heterozygous calls: element n // 2 of the sorted depths.

    Counted by depth first, so a genome of millions of calls becomes a few hundred rows a sample.
    """
    counts = g.where(is_het(F.col("gt")) & F.col("dp").isNotNull()).groupBy("sample_id", "dp").agg(F.count("*").alias("n"))
    order = Window.partitionBy("sample_id").orderBy("dp")
    placed = counts.withColumn("upto", F.sum("n").over(order)).withColumn("total", F.sum("n").over(Window.partitionBy("sample_id")))
    reached = placed.where("upto > cast(floor(total / 2) as bigint)")
    return reached.groupBy("sample_id").agg(F.min("dp").alias("median_dp"))


def private_to_child(g: DataFrame, child: str, parents: DataFrame) -> DataFrame:
    """Heterozygous calls of the child at keys where no parental callset carries an alternative allele."""
    own = g.where((F.col("sample_id") == child) & is_het(F.col("gt")) & is_pass(F.col("filter")))
    carriers = g.where(has_alt(F.col("gt"))).join(F.broadcast(parents.select("sample_id")), "sample_id", "left_semi")
    return own.join(carriers.select(*KEY).distinct(), KEY, "left_anti")


def judged_candidates(g: DataFrame, child: str, parents: DataFrame) -> DataFrame:
    """Private calls on autosomes with the first test each fails (null: passes)."""
    cap = median_het_depth(g).select("sample_id", (F.col("median_dp") * F.lit(S.DP_FACTOR)).alias("most_dp"))
    rows = private_to_child(g, child, parents).where(is_autosome(F.col("chrom"))).join(F.broadcast(cap), "sample_id", "left")
    share = vaf(F.col("ad"))
    reason = reject_reason(F.col("dp"), F.col("gq"), share, F.coalesce("most_dp", F.lit(0.0)), F.col("ref"), F.col("alt"))
    return rows.withColumn("vaf", share).withColumn("reason", reason)


def filter_funnel(judged: DataFrame) -> DataFrame:
    return judged.groupBy(F.coalesce("reason", F.lit("pass")).alias("reason")).agg(F.count("*").alias("n"))


def parent_verdict(gt: Column, dp: Column, alt_reads: Column) -> Column:
    """What one parent's genotype says: confirmed (reference), inherited or indeterminate."""
    silent = F.coalesce(F.get(F.split(gt, "[/|]"), F.lit(0)).isin(".", ""), F.lit(True))
    return (
        F.when(silent | F.coalesce(dp < S.MIN_PARENT_DP, F.lit(True)), "indeterminate")
        .when(has_alt(gt) | (alt_reads > S.MAX_PARENT_ALT), "inherited")
        .otherwise("confirmed")
    )


def de_novo_status(cands: DataFrame, evidence: DataFrame, parents: list[str]) -> DataFrame:
    """Status of each candidate over both parents: inherited > indeterminate > confirmed.

    ``evidence``: chrom, pos, parent, gt, dp, alt_reads, nonref (pileup reads, may be null). A parent without
    evidence is indeterminate.
    """
    verdict = F.when(F.coalesce(F.col("nonref") >= S.PILEUP_MIN_ALT, F.lit(False)), "inherited").otherwise(
        parent_verdict(F.col("gt"), F.col("dp"), F.col("alt_reads"))
    )
    wanted = F.array(*[F.lit(p) for p in parents])
    rows = cands.select("*", F.explode(wanted).alias("parent")).join(
        evidence.select("chrom", "pos", "parent", verdict.alias("verdict")), ["chrom", "pos", "parent"], "left"
    )
    order = F.array(F.lit("inherited"), F.lit("indeterminate"), F.lit("confirmed"))
    rank = F.array_position(order, F.coalesce("verdict", F.lit("indeterminate")))
    best = rows.groupBy(*KEY).agg(F.min(rank).cast("int").alias("r"))
    return cands.join(best.select(*KEY, F.element_at(order, F.col("r")).alias("status")), KEY)


def flag_clusters(calls: DataFrame, window: int = S.CLUSTER_WINDOW, width: int = STRETCH) -> DataFrame:
    """Confirmed calls within ``window`` of another confirmed one on the contig become ``clustered``.

    Contigs are cut into stretches of ``width``; calls near an edge also stand in the stretch beyond it.
    """
    width = max(width, window + 1)
    stretch = lambda pos: F.floor(pos / F.lit(width))
    copies = F.sequence(stretch(F.col("pos") - window), stretch(F.col("pos") + window))
    rows = calls.withColumn("__at", F.explode_outer(copies))
    near = Window.partitionBy("chrom", "status", "__at").orderBy("pos")
    gap_before = F.col("pos") - F.lag("pos").over(near)
    gap_after = F.lead("pos").over(near) - F.col("pos")
    close = F.coalesce(F.least(gap_before, gap_after) <= window, F.lit(False))
    rows = rows.withColumn("__close", close).where(F.col("__at").eqNullSafe(stretch(F.col("pos"))))
    status = F.when((F.col("status") == "confirmed") & F.col("__close"), "clustered").otherwise(F.col("status"))
    return rows.withColumn("status", status).drop("__at", "__close")


def plausibility(calls: DataFrame) -> DataFrame:
    """Number of confirmed single-base calls against what a generation brings."""
    n = F.count_if((F.col("status") == "confirmed") & is_snv(F.col("ref"), F.col("alt")))
    low, high = S.EXPECTED_DE_NOVO
    word = F.when(F.col("n_confirmed") < low, "low").when(F.col("n_confirmed") > high, "high").otherwise("plausible")
    return calls.agg(n.alias("n_confirmed")).withColumn("verdict", word)


def genotyping_qc(g: DataFrame) -> DataFrame:
    """Per sample: sites, called share, no-calls, reference, variant, thin sites."""
    alleles = decode_genotype(F.col("ref"), F.col("alt"), F.col("gt"))
    rows = g.withColumn("called", alleles.isNotNull()).withColumn("varies", has_alt(F.col("gt")))
    counted = rows.groupBy("sample_id").agg(
        F.count("*").alias("sites"), F.count_if(~F.col("called")).alias("no_calls"),
        F.count_if(F.col("called") & ~F.col("varies")).alias("hom_ref"),
        F.count_if(F.col("called") & F.col("varies")).alias("variant"), F.count_if(F.col("dp") < 8).alias("thin"),
    )
    share = (F.col("sites") - F.col("no_calls")) * 100.0 / F.col("sites")
    return counted.withColumn("called_percent", share)


def titv(g: DataFrame) -> DataFrame:
    """Transitions over transversions of single-base variants, per sample."""
    pair = F.concat("ref", "alt")
    transition = pair.isin("AG", "GA", "CT", "TC")
    rows = g.where(is_snv(F.col("ref"), F.col("alt")) & has_alt(F.col("gt"))).groupBy("sample_id").agg(
        F.count_if(transition).alias("ti"), F.count_if(~transition).alias("tv")
    )
    return rows.withColumn("ratio", F.try_divide(F.col("ti").cast("double"), F.col("tv").cast("double")))


def phased_positions(g: DataFrame) -> DataFrame:
    """(chrom, pos) to block and haplotype of the alternative allele; conflicting records are ambiguous.

    An indel also answers one base to the right, where stored variants have it, unless a record is there.
    """
    het = g.where(F.size(F.split("gt", "[/|]")) == 2)
    het = het.where(F.get(F.split("gt", "[/|]"), F.lit(0)) != F.get(F.split("gt", "[/|]"), F.lit(1)))
    phased = F.col("gt").contains("|")
    rec = het.select(
        "chrom", "pos", F.when(phased, F.col("ps")).alias("ps"),
        F.when(phased, F.when(F.get(F.split("gt", r"\|"), F.lit(0)) != "0", 0).otherwise(1)).alias("hap"),
        (F.length("ref") != F.length("alt")).alias("indel"),
    )
    own = rec.select("chrom", "pos", "ps", "hap", F.lit(0).alias("anchor"))
    moved = rec.where("indel").select("chrom", (F.col("pos") + 1).alias("pos"), "ps", "hap", F.lit(1).alias("anchor"))
    place = F.struct(F.coalesce(F.col("ps").cast("string"), F.lit("")).alias("p"), F.coalesce("hap", F.lit(-1)).alias("h"))
    rows = own.union(moved).groupBy("chrom", "pos", "anchor").agg(
        F.count_distinct(place).alias("n"), F.min("ps").alias("ps"), F.min("hap").alias("hap")
    )
    first = Window.partitionBy("chrom", "pos").orderBy("anchor")
    best = rows.withColumn("r", F.row_number().over(first)).where("r = 1")
    clear = F.col("n") == 1
    return best.select("chrom", "pos", F.when(clear, F.col("ps")).alias("ps"), F.when(clear, F.col("hap")).alias("hap"), (~clear).alias("ambiguous"))


def phase_verdict(hets: DataFrame, phased: DataFrame) -> DataFrame:
    """Per gene and contig whether its damaging variants lie on both copies. ``hets``: gene, chrom, pos."""
    placed = hets.select("gene", "chrom", "pos").join(phased, ["chrom", "pos"], "left")
    known = F.col("ps").isNotNull() & F.col("hap").isNotNull()
    blocks = placed.groupBy("gene", "chrom", F.when(known, F.col("ps")).alias("block")).agg(
        F.count("*").alias("n"), F.count_distinct(F.when(known, F.col("hap"))).alias("sides"),
        F.count_if(F.coalesce("ambiguous", F.lit(False))).alias("n_ambiguous"),
    )
    real = F.col("block").isNotNull()
    genes = blocks.groupBy("gene", "chrom").agg(
        F.sum("n").alias("n"), F.sum(F.when(real, F.col("n")).otherwise(0)).alias("n_phased"), F.count_if(real).alias("blocks"),
        F.bool_or(real & (F.col("sides") == 2)).alias("trans"), F.bool_or(real & (F.col("sides") == 1) & (F.col("n") >= 2)).alias("one"),
        F.sum("n_ambiguous").alias("n_ambiguous"),
    )
    whole = (F.col("n_phased") == F.col("n")) & (F.col("blocks") == 1)
    verdict = F.when(F.col("trans"), "in-trans").when(F.col("one") & whole, "in-cis").when(F.col("one"), "partial").otherwise("unphased")
    return genes.select("gene", "chrom", "n", "n_phased", "blocks", "n_ambiguous", verdict.alias("verdict"))


def merge_windows(sites: DataFrame, pad: int = 1000, width: int = STRETCH) -> DataFrame:
    """Windows of ``pad`` around each site, clipped at 1 and merged where they touch.

    Sites are merged within stretches of ``width``; only the first and last run of a stretch can go on beyond it, so
    the pass over a whole contig sees two rows a stretch at most.
    """
    spot = sites.select("chrom", "pos").distinct().withColumn("__at", F.floor(F.col("pos") / F.lit(width)))
    runs = _runs(spot.select("chrom", "__at", F.col("pos").alias("first"), F.col("pos").alias("last")), ["chrom", "__at"], pad)
    ends = Window.partitionBy("chrom", "__at")
    edge = (F.col("first") == F.min("first").over(ends)) | (F.col("last") == F.max("last").over(ends))
    marked = runs.withColumn("__edge", edge)
    merged = _runs(marked.where("__edge").select("chrom", "first", "last"), ["chrom"], pad)
    whole = marked.where("not __edge").select("chrom", "first", "last").union(merged.select("chrom", "first", "last"))
    return whole.select("chrom", F.greatest(F.col("first") - pad, F.lit(1)).alias("start"), (F.col("last") + pad).alias("stop"))


def _runs(rows: DataFrame, group: list[str], pad: int) -> DataFrame:
    """Disjoint stretches from ``first`` to ``last``, joined while the next begins within two pads."""
    order = Window.partitionBy(*group).orderBy("first")
    apart = F.coalesce(F.col("first") - F.lag("last").over(order) > 2 * pad, F.lit(True))
    numbered = rows.withColumn("__new", apart.cast("int")).withColumn("__run", F.sum("__new").over(order))
    return numbered.groupBy(*group, "__run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("__run")


def same_event(v: DataFrame, g: DataFrame) -> DataFrame:
    """The VCF record of each stored variant, across the two notations: an indel's record first one base before."""
    anchored = (F.col("ref") == "-") | (F.col("alt") == "-") | (F.length("ref") != F.length("alt"))
    tries = F.when(anchored, F.array(F.struct(F.lit(1).alias("n"), (F.col("pos") - 1).alias("at")), F.struct(F.lit(2).alias("n"), F.col("pos").alias("at")))).otherwise(
        F.array(F.struct(F.lit(1).alias("n"), F.col("pos").alias("at")))
    )
    keys = v.select(*KEY).distinct().select(*KEY, anchored.alias("anchored"), F.explode(tries).alias("t")).select(*KEY, "anchored", "t.*")
    recs = g.select(F.col("chrom"), F.col("pos").alias("at"), F.col("ref").alias("vcf_ref"), F.col("alt").alias("vcf_alt")).distinct()
    first = lambda c: F.substring(c, 1, 1)
    rest = lambda c: F.substring(c, 2, 1_000_000)
    r, a, vr, va = F.col("ref"), F.col("alt"), F.col("vcf_ref"), F.col("vcf_alt")
    event = F.when(a == "-", (va == first(vr)) & (rest(vr) == r)).when(r == "-", (vr == first(va)) & (rest(va) == a)).otherwise(
        (rest(vr) == r) & (rest(va) == a)
    )
    hit = F.when(F.col("anchored"), event).otherwise((vr == r) & (va == a))
    order = Window.partitionBy(*KEY).orderBy("n", "vcf_ref", "vcf_alt")
    found = keys.join(recs, ["chrom", "at"]).where(hit).withColumn("rn", F.row_number().over(order)).where("rn = 1")
    return found.select(*KEY, F.col("at").alias("vcf_pos"), "vcf_ref", "vcf_alt")


def attach_position_annotation(cands: DataFrame, v: DataFrame) -> DataFrame:
    """Gene, consequence and significance recorded at a candidate's position (least values of several rows)."""
    wanted = cands.select("chrom", "pos").distinct()
    notes = v.join(wanted, ["chrom", "pos"], "left_semi").groupBy("chrom", "pos").agg(
        *[F.min(c).alias(c) for c in ("gene", "consequence", "clinvar_sig")]
    )
    return cands.join(notes, ["chrom", "pos"], "left")
