"""Registered queries against their SQL on the smallest tables: a spread over all of them."""

import collections

import duckdb
import pytest

from vardelta.derive import GIVEN
from vardelta.queries import ORACLES, QUERIES

SPREAD = sorted(
    set(sorted(ORACLES)[::4])
    | {"c08_delta", "c12_validate", "j01_recessive", "j04_compound_het", "j05_snapshot_delta", "j27_kinship", "m04_reannotate_delta"}
    | {"m05_mark_anchor", "q03_absent_sources", "t06_order_prs", "t08_order_second_hits", "w04_second_hits", "w11_family_generation"}
)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", SPREAD)
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    found = duck.execute(ORACLES[name])
    order = [d[0] for d in found.description]
    assert sorted(order) == columns
    want = collections.Counter(tuple(r[order.index(c)] for c in columns) for r in found.fetchall())
    assert collections.Counter(tuple(r[c] for c in columns) for r in got.collect()) == want and want


def test_delta_cuts_history_and_scores_to_changed_keys(spark, sf_dir):
    """Every grouping of variants by snapshot and key stands above a semi-join with the changed keys."""
    plan = QUERIES["c08_delta"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    grouped = [k for k, line in enumerate(plan) if "Aggregate [snapshot_id" in line and "chrom" in line]
    assert grouped
    for k in grouped:
        below = [line for line, d in zip(plan[k + 1 :], depth[k + 1 :], strict=True) if d > depth[k]]
        assert sum("LeftSemi" in line for line in below) >= 2


def test_every_query_has_a_name_of_its_kind():
    assert all(n[0] in "spjawtucmrq" for n in QUERIES) and set(ORACLES) <= set(QUERIES)


def test_no_cartesian_product_in_the_delta(spark, sf_dir, capsys):
    QUERIES["c08_delta"](spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_snapshot_filter_prunes_partitions(spark, sf_dir, capsys):
    QUERIES["j01_recessive"](spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(snapshot_id" in plan or "PartitionFilters: [(cast(snapshot_id" in plan
