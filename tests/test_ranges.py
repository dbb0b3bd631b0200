"""Windows cut into ranges give what one window over the whole contig or score gives."""

import random

import pytest
from pyspark.sql import functions as F

from vardelta.operators import genotypes, intervals, ranks


def places(seed, n, top):
    r = random.Random(seed)
    return [(c, r.randint(1, top)) for c in ("1", "X") for _ in range(n)]


@pytest.mark.parametrize("width", [50, 333, 10_000, 1_000_000])
def test_merged_windows_do_not_depend_on_the_stretch(spark, width):
    sites = [*places(3, 120, 20_000), ("2", 5), ("2", 5)]
    want = []
    for chrom in ("1", "2", "X"):
        for pos in sorted({p for c, p in sites if c == chrom}):
            start, stop = max(pos - 40, 1), pos + 40
            if want and want[-1][0] == chrom and start <= want[-1][2]:
                want[-1] = (chrom, want[-1][1], stop)
            else:
                want.append((chrom, start, stop))
    got = genotypes.merge_windows(spark.createDataFrame(sites, "chrom string, pos long"), 40, width).collect()
    assert sorted((r.chrom, r.start, r.stop) for r in got) == sorted(want)
    assert genotypes.merge_windows(spark.createDataFrame([], "chrom string, pos long"), 40, width).count() == 0


@pytest.mark.parametrize("width", [1, 101, 1_000_000])
def test_clusters_do_not_depend_on_the_stretch(spark, width):
    calls = [(c, p, "confirmed" if i % 3 else "inherited") for i, (c, p) in enumerate(places(5, 100, 30_000))]
    calls += [("1", 777, "confirmed"), ("1", 777, "confirmed"), ("1", None, "confirmed")]

    def status(i):
        c, p, s = calls[i]
        near = p is not None and any(k == "confirmed" and d == c and q is not None and abs(q - p) <= 100 and j != i for j, (d, q, k) in enumerate(calls))
        return "clustered" if s == "confirmed" and near else s

    want = sorted((c, p or 0, status(i)) for i, (c, p, _) in enumerate(calls))
    got = genotypes.flag_clusters(spark.createDataFrame(calls, "chrom string, pos long, status string"), 100, width)
    assert got.columns == ["chrom", "pos", "status"]
    assert sorted((r.chrom, r.pos or 0, r.status) for r in got.collect()) == want


@pytest.mark.parametrize("strict", [True, False])
def test_running_totals_against_all_pairs(spark, strict):
    r = random.Random(9)
    rows = [(g, int(r.gauss(0, 400)), r.randint(0, 3), i) for i, g in enumerate(["a"] * 300 + ["b"] * 40)] + [("one", 7, 2, -1), (None, 1, 1, -2), (None, 2, 1, -3)]
    df = spark.createDataFrame(rows, "g string, v long, n int, id int")
    got = {x.id: (x.n_below, x.n_all) for x in ranks.running_totals(df, "g", "v", ["n"], strict).collect()}
    lower = (lambda a, b: a < b) if strict else (lambda a, b: a <= b)
    assert got == {i: (sum(m for h, u, m, _ in rows if h == g and lower(u, v)), sum(m for h, _, m, _ in rows if h == g)) for g, v, _, i in rows}


def test_running_totals_of_odd_values(spark):
    rows = [("a", v, i) for i, v in enumerate([None, -1.0, 0.5, 0.5, 3.0])] + [("n", v, 10 + i) for i, v in enumerate([1.0, float("nan"), float("inf"), float("-inf")])] + [("z", None, 20)]
    df = spark.createDataFrame(rows, "g string, v double, id int").withColumn("n", F.lit(1))
    got = {x.id: x.n_below for x in ranks.running_totals(df, "g", "v", ["n"], False).collect()}
    assert got == {0: 1, 1: 2, 2: 4, 3: 4, 4: 5, 10: 2, 11: 4, 12: 3, 13: 1, 20: 1}


def test_parts_are_of_equal_size_whatever_the_values(spark):
    """One value far out, a heavy tail and one value that half of the rows have: no part has over 2 / 256 of the values."""
    value = F.when(F.col("id") == 0, 1e15).when(F.col("id") % 2 == 0, 5.0).otherwise(F.exp(F.col("id") / 1000.0))
    rows = spark.range(20_000).select(F.lit("a").alias("g"), value.alias("v"), F.lit(1).alias("n"))
    values = rows.select("g", "v").distinct()
    cuts = ranks.depth_cuts(values, "g", "v")
    sizes = values.join(cuts, "g").groupBy(ranks.part_of(F.col("cuts"), F.col("v")).alias("part")).count().collect()
    total = sum(r["count"] for r in sizes)
    assert max(r["count"] for r in sizes) <= 2 * total / ranks.RANGES
    assert max(r.part for r in sizes) <= ranks.RANGES - 1
    five = ranks.running_totals(rows, "g", "v", ["n"], True).where("v = 5").select("n_below", "n_all").distinct().collect()
    assert [tuple(r) for r in five] == [(sum(1 for k in range(1, 20_000, 2) if k / 1000 < 1.6094379), 20_000)]


def spans(seed, n):
    r = random.Random(seed)
    for k in range(n):
        start = r.randrange(0, 3_000_000)
        yield r.choice("12"), start, start + int(10 ** r.uniform(0, 6.6)), k


@pytest.mark.parametrize("pad", [0, 100_000])
def test_overlaps_of_all_lengths_against_all_pairs(spark, pad):
    a, b = list(spans(1, 120)), list(spans(2, 150)) + [("1", 0, 200_000_000, 900), ("2", 5, 5, 901)]
    left = spark.createDataFrame(a, "chrom string, start_pos long, end_pos long, x int")
    right = spark.createDataFrame(b, "chrom string, start_pos long, end_pos long, y int")
    got = sorted((r.x, r.y) for r in intervals.overlap_join(left, right, pad).collect())
    want = sorted((x, y) for c, s, e, x in a for d, t, f, y in b if c == d and s - pad <= f and t <= e + pad)
    assert got == want


def test_rows_of_an_interval_do_not_grow_with_its_length(spark):
    long_ = spark.createDataFrame([("1", 1_000, 150_000_000)], "chrom string, start_pos long, end_pos long")
    for own in (True, False):
        assert intervals._placed(long_, F.col("start_pos"), F.col("end_pos"), own).count() <= 2 * len(intervals.SIZES)


@pytest.mark.parametrize("stretch", [7, 64, 1 << 18])
def test_depth_counts_each_base_once(spark, stretch):
    r = random.Random(4)
    runs = [(r.choice("12"), s := r.randrange(300), s + r.randrange(40), r.randrange(6)) for _ in range(60)]
    runs += [runs[0]] * 3 + [("1", None, 5, 3), ("1", 9, 3, 3), ("3", 0, 9, 4), (None, 0, 9, 4)]
    depth = spark.createDataFrame(runs, "chrom string, start_pos long, end_pos long, depth int")
    lengths = spark.createDataFrame([("1", 400), ("2", 400), ("4", 50)], "chrom string, length long")
    base = {}
    for c, s, e, d in runs:
        for p in range(s, e + 1) if s is not None else ():
            base[c, p] = max(d, base.get((c, p), 0))
    want = {}
    for c in ("1", "2", "4", "total"):
        own = [d for (k, _), d in base.items() if k in ("1", "2") and c in (k, "total")]
        size = {"1": 400, "2": 400, "4": 50, "total": 850}[c]
        want |= {(c, d): (n := sum(x >= d for x in own), n / size) for d in set(own) - {0}}
        want[c, 0] = (size, 1.0)
    got = {(x.chrom, x.depth): (x.bases, x.share) for x in intervals.depth_distribution(depth, lengths, stretch).collect()}
    assert got == want
