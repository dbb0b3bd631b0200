"""Interval jobs: structural variants against genes, coverage of genes.

A range join without a cross join: intervals are put into bins of the level of their length and joined on (chrom,
level, bin); a pair counts only in the first bin that both touch.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vardelta.functions.alleles import is_pass

#: Lengths of the bins of each level; the last is longer than any contig.
SIZES = [1 << (14 + 3 * k) for k in range(6)]
FOCAL = 3_000_000
NEAR = 100_000
#: Bases that one task sweeps at a time, and the name of all contigs together.
STRETCH, TOTAL = 1 << 18, "total"


def read_sv(rows: DataFrame) -> DataFrame:
    """Called structural variants that pass, of four kinds, with their length."""
    gt = F.replace("gt", F.lit("|"), F.lit("/"))
    kept = rows.where(is_pass(F.col("filter")) & ~gt.isin("0/0", "./.", ".") & F.col("kind").isin("DEL", "DUP", "INV", "INS"))
    return kept.withColumn("length", F.abs(F.col("end_pos") - F.col("start_pos")) + 1)


def level_of(length: Column) -> Column:
    """The finest level whose bins are as long as an interval, so that it touches two of them at most."""
    return sum((F.when(length > size, 1).otherwise(0) for size in SIZES[:-1]), F.lit(0))


def _placed(df: DataFrame, start: Column, stop: Column, own: bool) -> DataFrame:
    """Adds ``level``, ``bin`` and ``first_bin``: at an interval's own level, or at all coarser ones."""
    level = level_of(stop - start + 1)
    coarser = F.when(level < len(SIZES) - 1, F.sequence(level + 1, F.lit(len(SIZES) - 1)))
    rows = df.withColumn("level", level) if own else df.withColumn("level", F.explode(coarser))
    size = F.element_at(F.array(*[F.lit(x) for x in SIZES]), F.col("level") + 1)
    low, high = F.floor(start / size).cast("bigint"), F.floor(stop / size).cast("bigint")
    return rows.withColumn("first_bin", low).withColumn("bin", F.explode(F.sequence(low, high)))


def overlap_join(a: DataFrame, b: DataFrame, pad: int = 0) -> DataFrame:
    """Pairs of intervals on a contig that overlap, or come within ``pad``. Each side: chrom, start_pos, end_pos, own columns.

    Bins come in levels, each eight times as long as the one before. A pair meets at the level of its longer interval,
    where both touch two bins at most; an interval has a few rows however long it is. A pair in two bins counts in
    the first.
    """
    low, high = F.greatest(F.col("start_pos") - pad, F.lit(0)), F.col("end_pos") + pad
    right = b.withColumnRenamed("start_pos", "b_start").withColumnRenamed("end_pos", "b_end")

    def met(left_own: bool, right_own: bool) -> DataFrame:
        one = _placed(a, low, high, left_own)
        two = _placed(right, F.col("b_start"), F.col("b_end"), right_own).withColumnRenamed("first_bin", "b_first")
        joined = one.join(two, ["chrom", "level", "bin"]).where(F.col("bin") == F.greatest("first_bin", "b_first"))
        return joined.where((F.col("start_pos") - pad <= F.col("b_end")) & (F.col("b_start") <= F.col("end_pos") + pad)).drop(
            "level", "bin", "first_bin", "b_first"
        )

    return met(True, True).union(met(True, False)).union(met(False, True))


def sv_gene_overlap(svs: DataFrame, genes: DataFrame, most: int = FOCAL) -> DataFrame:
    """Focal variants with the genes they touch; arm-scale ones are left out."""
    return overlap_join(svs.where(F.col("length") <= most), genes)


def sv_gene_nearby(svs: DataFrame, genes: DataFrame, reach: int = NEAR, most: int = FOCAL) -> DataFrame:
    """Focal variants and genes within ``reach``, with the gap (0: they overlap)."""
    pairs = overlap_join(svs.where(F.col("length") <= most), genes, pad=reach)
    gap = F.greatest(F.col("b_start") - F.col("end_pos"), F.col("start_pos") - F.col("b_end"), F.lit(0))
    return pairs.withColumn("gap", gap).where(F.col("gap") <= reach)


def sv_summary(rows: DataFrame) -> DataFrame:
    """Passing calls per kind: all, focal, arm-scale; breakends are only counted."""
    gt = F.replace("gt", F.lit("|"), F.lit("/"))
    kept = rows.where(is_pass(F.col("filter")) & ~gt.isin("0/0", "./.", "."))
    length = F.abs(F.col("end_pos") - F.col("start_pos")) + 1
    focal = (F.col("kind") != "BND") & (length <= FOCAL)
    return kept.groupBy("kind").agg(
        F.count("*").alias("n"), F.count_if(focal).alias("focal"), F.count_if((F.col("kind") != "BND") & ~focal).alias("arm_scale")
    )


def callability(depth: DataFrame, genes: DataFrame, min_depth: int = 10, least_percent: int = 95) -> DataFrame:
    """Per gene: bases at the depth or above, mean depth in hundredths, and whether too few are callable."""
    pairs = overlap_join(depth, genes)
    overlap = F.least("end_pos", "b_end") - F.greatest("start_pos", "b_start") + 1
    sums = pairs.withColumn("bases", overlap).groupBy("gene").agg(
        F.sum(F.when(F.col("depth") >= min_depth, F.col("bases")).otherwise(0)).alias("callable"),
        F.sum(F.col("bases") * F.col("depth")).alias("reads"),
    )
    rows = genes.withColumn("length", F.col("end_pos") - F.col("start_pos") + 1).join(sums, "gene", "left")
    zero = F.lit(0).cast("bigint")
    rows = rows.withColumn("callable", F.coalesce("callable", zero)).withColumn("reads", F.coalesce("reads", zero))
    return rows.select(
        "gene", "length", "callable", F.floor(F.col("reads") * 100 / F.col("length")).alias("mean_centi"),
        (F.col("callable") * 100 < F.col("length") * least_percent).alias("flagged"),
    )


def genome_callability(depth: DataFrame, min_depth: int = 10) -> DataFrame:
    """Per contig: bases, callable bases and depth sum of the covered runs."""
    bases = F.col("end_pos") - F.col("start_pos") + 1
    return depth.groupBy("chrom").agg(
        F.sum(bases).alias("bases"), F.sum(F.when(F.col("depth") >= min_depth, bases).otherwise(0)).alias("callable"),
        F.sum(bases * F.col("depth")).alias("reads"),
    )


def depth_histogram(depth: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(chrom, depth, bases): how many bases have which depth; a base in several runs counts once, with the greatest.

    Contigs are cut into stretches, and runs at their ends; a stretch is swept in a task of its own, with a number for
    each of its bases and no more, and gives a row a depth.
    """
    runs = depth.where("start_pos is not null and end_pos >= start_pos and depth is not null and start_pos >= 0")
    low, high = (F.floor(F.col(c) / stretch).cast("bigint") for c in ("start_pos", "end_pos"))
    cut = runs.withColumn("part", F.explode(F.sequence(low, high)))
    first = F.greatest(F.col("start_pos") - F.col("part") * stretch, F.lit(0)).cast("int")
    last = F.least(F.col("end_pos") - F.col("part") * stretch, F.lit(stretch - 1)).cast("int")
    pieces = cut.select("chrom", "part", first.alias("first"), last.alias("last"), F.col("depth").cast("bigint").alias("depth"))
    once = pieces.groupBy("chrom", "part", "first", "last").agg(F.max("depth").alias("depth"))

    def sweep(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("depth")
        at = np.full(stretch, -1, dtype=np.int64)
        for first, last, value in zip(rows["first"], rows["last"], rows["depth"], strict=True):
            at[first : last + 1] = value  # deeper runs come later
        found, bases = np.unique(at[at >= 0], return_counts=True)
        return pd.DataFrame({"chrom": rows["chrom"].iloc[0], "depth": found, "bases": bases})

    swept = once.groupBy("chrom", "part").applyInPandas(sweep, "chrom string, depth long, bases long")
    return swept.groupBy("chrom", "depth").agg(F.sum("bases").alias("bases"))


def depth_distribution(depth: DataFrame, lengths: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(chrom, depth, bases, share): bases at each depth that occurs or above, a contig and in all (``total``).

    ``lengths``: chrom, length. Shares are of the whole contig, covered or not, and depth 0 has all of it; a contig without
    runs has that row only. Runs of a contig without a length are left out.
    """
    counts = depth_histogram(depth, stretch).where("depth > 0").join(lengths.select("chrom"), "chrom", "left_semi")
    both = counts.unionByName(counts.withColumn("chrom", F.lit(TOTAL)).groupBy("chrom", "depth").agg(F.sum("bases").alias("bases")))
    above = Window.partitionBy("chrom").orderBy(F.col("depth").desc())  # a row a depth: a few thousand
    reached = both.select("chrom", "depth", F.sum("bases").over(above).alias("bases"))
    every = lengths.select("chrom", "length").union(lengths.agg(F.lit(TOTAL).alias("chrom"), F.sum("length").alias("length")))
    ground = every.select("chrom", F.lit(0).cast("bigint").alias("depth"), F.col("length").alias("bases"))
    rows = reached.unionByName(ground).join(every, "chrom")
    return rows.select("chrom", "depth", "bases", F.try_divide(F.col("bases").cast("double"), F.col("length").cast("double")).alias("share"))
