"""Polygenic queries cover every individual of the cohort."""

import collections

import duckdb
import pytest

from vardelta.derive import GIVEN
from vardelta.operators import polygenic
from vardelta.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize(
    "name",
    ["j18_genotype_fallback", "a09_prs_exact", "a10_calibration_moments", "a13_ref_effect_supplement", "w08_empirical_percentile", "c18_prs"],
)
def test_whole_cohort_equals_brute_force(spark, sf_dir, duck, name):
    sql = ORACLES[name]
    got = QUERIES[name](spark, sf_dir)
    found = duck.execute(sql)
    order = [d[0] for d in found.description]
    assert sorted(order) == sorted(got.columns)
    want = collections.Counter(found.fetchall())
    assert collections.Counter(tuple(r) for r in got.select(*order).collect()) == want
    n = duck.execute("SELECT count(DISTINCT o_custkey) FROM orders JOIN lineitem ON l_orderkey = o_orderkey").fetchone()[0]
    assert len({r[order.index("sample_id")] for r in want}) == n


def test_calibrated_percentiles_of_every_individual(spark, sf_dir, duck):
    rows = QUERIES["a10_prs_calibrate"](spark, sf_dir).select("sample_id", "percentile").collect()
    n = duck.execute("SELECT count(DISTINCT o_custkey) FROM orders JOIN lineitem ON l_orderkey = o_orderkey").fetchone()[0]
    assert len({r.sample_id for r in rows}) == n and all(r.percentile is not None for r in rows)


def test_epoch_check_tells_two_runs_apart(spark, sf_dir):
    r = QUERIES["a33_epoch_check"](spark, sf_dir).first()
    assert r.same is False and r.n > 0


def test_sums_from_records_equal_sums_over_all_markers(spark):
    """No-calls, a second source, a site without a reference, a site listed twice, and a sample without records."""
    scoring = spark.createDataFrame(
        [("P", "1", 10, "A", 3), ("P", "1", 20, "G", -5), ("P", "1", 20, "A", 7), ("P", "2", 30, "G", 11), ("Q", "1", 10, "G", 2), ("Q", "3", 5, "T", 1)],
        "pgs_id string, chrom string, pos bigint, effect string, weight_milli bigint",
    )
    calls = "sample_id string, chrom string, pos bigint, ref string, alt string, gt string"
    first = [("a", "1", 10, "A", "G", "0/1"), ("a", "1", 20, "A", "G", "./."), ("b", "2", 30, "A", "G", "1/1"), ("b", "1", 99, "A", "G", "1/1")]
    second = [("a", "1", 10, "A", "G", "1/1"), ("a", "1", 20, "A", "G", "1/1"), ("b", "1", 20, "A", "G", "./1"), ("b", "1", 20, "A", "G", "0|1")]
    sources = [spark.createDataFrame(first, calls), spark.createDataFrame(second, calls)]
    reference = spark.createDataFrame([("1", 10, "A"), ("1", 20, "A"), ("3", 5, None)], "chrom string, pos bigint, base string")
    people = spark.createDataFrame([("a",), ("b",), ("none",)], "sample_id string")
    frequencies = spark.createDataFrame(
        [("1", 10, "A", "G", 100), ("1", 20, "A", "G", 400), ("2", 30, "A", "C", 50), ("3", 5, "A", "T", 20)],
        "chrom string, pos bigint, ref string, alt string, af_milli bigint",
    )
    markers = scoring.select("chrom", "pos").distinct().join(people)
    dense = polygenic.contributions(scoring, polygenic.genotype_fallback(markers, sources, reference))

    def same(got, want):
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))

    same(polygenic.prs_exact_from_calls(scoring, sources, reference, people), polygenic.prs_exact(dense))
    moments = polygenic.moments_from_calls(scoring, sources, reference, people, frequencies)
    same(moments, polygenic.calibration_moments(dense, frequencies))
    assert polygenic.prs_exact_from_calls(scoring.limit(0), sources, reference, people).isEmpty()
