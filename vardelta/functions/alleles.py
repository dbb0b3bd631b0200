"""Alleles, genotypes and read counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vardelta import schemas as S


def is_pass(filter_: Column) -> Column:
    return F.coalesce(filter_.isin("PASS", "."), F.lit(False))


def plain_contig(chrom: Column) -> Column:
    """``chr7`` to ``7``, ``chrM`` to ``MT``; others stay."""
    return F.when(chrom == "chrM", "MT").otherwise(F.regexp_replace(chrom, "^chr([0-9]{1,2}|X|Y)$", "$1"))


def is_snv(ref: Column, alt: Column) -> Column:
    return ref.rlike("^[ACGT]$") & alt.rlike("^[ACGT]$")


def is_autosome(chrom: Column) -> Column:
    return F.coalesce(chrom.isin([str(i) for i in range(1, 23)]), F.lit(False))


def contig_order(chrom: Column) -> Column:
    """Numbers first, then X, Y, MT, then the rest."""
    return F.coalesce(chrom.try_cast("int"), F.when(chrom == "X", 23).when(chrom == "Y", 24).when(chrom == "MT", 25).otherwise(99))


def trimmed_key(pos: Column, ref: Column, alt: Column) -> Column:
    """Table form of a VCF record: an indel loses its shared first base."""
    anchored = (F.length(ref) != F.length(alt)) & (F.substring(ref, 1, 1) == F.substring(alt, 1, 1))
    cut = lambda a: F.when(F.length(a) > 1, F.substring(a, 2, 1_000_000)).otherwise("-")
    return F.struct(
        F.when(anchored, pos + 1).otherwise(pos).alias("pos"),
        F.when(anchored, cut(ref)).otherwise(ref).alias("ref"),
        F.when(anchored, cut(alt)).otherwise(alt).alias("alt"),
    )


def _shared(a: Column, b: Column) -> Column:
    """Length of the common prefix."""
    steps = F.sequence(F.lit(1), F.greatest(F.least(F.length(a), F.length(b)), F.lit(1)))
    same = F.filter(steps, lambda n: (n <= F.length(a)) & (n <= F.length(b)) & (F.substring(a, F.lit(1), n) == F.substring(b, F.lit(1), n)))
    return F.size(same)


def minimal_key(pos: Column, ref: Column, alt: Column) -> Column:
    """Shortest form: common prefix off (the position moves), then common suffix; nothing left is ``-``."""
    r0 = F.when(ref == "-", "").otherwise(ref)
    a0 = F.when(alt == "-", "").otherwise(alt)
    front = _shared(r0, a0)
    r1, a1 = (F.substring(x, front + 1, F.lit(1_000_000)) for x in (r0, a0))
    back = _shared(F.reverse(r1), F.reverse(a1))
    short = lambda x: F.substring(x, F.lit(1), F.length(x) - back)
    dash = lambda x: F.when(F.length(x) == 0, "-").otherwise(x)
    return F.struct((pos + front).alias("pos"), dash(short(r1)).alias("ref"), dash(short(a1)).alias("alt"))


def ad_counts(ad: Column) -> Column:
    """Read counts of a comma list; a dot counts 0 in its place."""
    return F.transform(F.split(ad, ","), lambda x: F.when(x == ".", 0).otherwise(x.try_cast("int")))


def total_reads(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0), lambda a, x: a + x)


def vaf(ad: Column) -> Column:
    """Share of alternative reads; 0 if it cannot be told."""
    counts = ad_counts(ad)
    total = total_reads(counts)
    return F.coalesce(F.when(total > 0, (total - F.get(counts, F.lit(0))) / total), F.lit(0.0))


def is_low_balance(zygosity: Column, alt_reads: Column, total: Column) -> Column:
    """A heterozygous call on few alternative reads: a flag, never a filter."""
    return F.coalesce((F.upper(zygosity) == "HET") & (total > 0) & (alt_reads / total < S.LOW_BALANCE), F.lit(False))


def decode_genotype(ref: Column, alt: Column, gt: Column) -> Column:
    """Allele pair of a GT; null for a no-call; a haploid call is doubled."""
    alleles = F.concat(F.array(ref), F.split(alt, ","))
    calls = F.split(gt, "[/|]")
    named = F.transform(calls, lambda c: F.get(alleles, c.try_cast("int")))
    unknown = F.exists(named, lambda a: a.isNull())
    return F.when(unknown | gt.isNull(), None).when(F.size(named) == 1, F.concat(named, named)).otherwise(named)


def is_homopolymer_indel(ref: Column, alt: Column) -> Column:
    """An indel (VCF form) whose changed bases are one letter repeated."""
    grows = F.length(alt) > F.length(ref)
    longer, shorter = F.when(grows, alt).otherwise(ref), F.when(grows, ref).otherwise(alt)
    rest = F.substring(longer, F.length(shorter) + 1, F.lit(1_000_000))
    changed = F.when(longer.startswith(shorter), rest).otherwise(longer)
    return (F.length(ref) != F.length(alt)) & changed.rlike(r"^(.)\1*$")


def reject_reason(dp: Column, gq: Column, share: Column, most_dp: Column, ref: Column, alt: Column) -> Column:
    """The first test that a de-novo candidate fails; null if none. A depth cap of 0 is none."""
    single = (F.length(ref) == 1) & (F.length(alt) == 1)
    return (
        F.when(gq < S.MIN_GQ, "low_gq")
        .when(dp < S.MIN_DP, "low_depth")
        .when((most_dp > 0) & (dp > most_dp), "excess_depth")
        .when(~single & is_homopolymer_indel(ref, alt), "homopolymer_indel")
        .when(~single & (share < S.MIN_VAF_INDEL), "low_vaf_indel")
        .when(single & (share < S.MIN_VAF), "low_vaf")
        .when(share > S.MAX_VAF, "high_vaf")
    )


def norm_zyg(zygosity: Column) -> Column:
    return F.upper(F.coalesce(zygosity, F.lit("")))


def is_male(sex: Column) -> Column:
    return F.coalesce(F.lower(sex).isin("male", "m", "1"), F.lit(False))


def hard_filter(info: Column, ref: Column, alt: Column) -> Column:
    """Names of the failed hard filters joined by ``;``, or PASS. ``info``: map of strings."""
    number = lambda name: F.element_at(info, F.lit(name)).try_cast("double")
    snp = is_snv(ref, alt)
    # fixed values: tests of single-base variants, then of indels
    tests = [
        (snp, "QD2", number("QD") < 2), (snp, "FS60", number("FS") > 60), (snp, "MQ40", number("MQ") < 40),
        (snp, "MQRankSum-12.5", number("MQRankSum") < -12.5),
        (snp, "ReadPosRankSum-8", number("ReadPosRankSum") < -8), (snp, "SOR3", number("SOR") > 3),
        (~snp, "QD2", number("QD") < 2), (~snp, "FS200", number("FS") > 200),
        (~snp, "ReadPosRankSum-20", number("ReadPosRankSum") < -20), (~snp, "SOR10", number("SOR") > 10),
    ]
    failed = F.array_compact(F.array(*[F.when(kind & test, F.lit(name)) for kind, name, test in tests]))
    return F.when(F.size(failed) == 0, "PASS").otherwise(F.array_join(failed, ";"))


def info_map(info: Column) -> Column:
    """``A=1;B=2;FLAG`` as a map; a flag has an empty value, of repeated keys the first counts."""
    parts = F.filter(F.split(F.coalesce(info, F.lit("")), ";"), lambda p: p != "")
    name = lambda p: F.split_part(p, F.lit("="), F.lit(1))
    keys = F.transform(parts, name)
    firsts = F.filter(parts, lambda p, i: F.array_position(keys, name(p)) == i + 1)
    entry = lambda p: F.struct(name(p).alias("key"), F.regexp_replace(p, "^[^=]*=?", "").alias("value"))
    return F.map_from_entries(F.transform(firsts, entry))
