"""Results that appear whole, versions in force, deliveries, couples' risks and the status of scores."""

import datetime
import itertools

import pytest

from vardelta import schemas as S
from vardelta.operators import history, panel, polygenic
from vardelta.plans import validation
from vardelta.sources import published
from vardelta.streaming import jobs

RUN = "run_id string, replay_snapshot string, truth_snapshot string, n_deltas long, n_useful long, n_noise long, precision_actionable double"


def run_rows(spark, n):
    return spark.createDataFrame([("r", "a", "b", n, 0, 0, None)], RUN)


def found_rows(spark, n):
    return spark.createDataFrame([("r", "1", k, "A", "G", "ignore", "unknown", None) for k in range(n)], S.COMPANIONS["validation_findings"])


def counts(spark, root):
    return [published.read_published(spark, root, t).count() for t in ("validation_runs", "validation_findings")]


def test_a_broken_first_write_leaves_nothing_to_see(spark, tmp_path):
    root = str(tmp_path / "results")

    def breaks():
        raise RuntimeError("no summary")

    with pytest.raises(RuntimeError):
        published.publish(spark, root, "r", {"validation_findings": lambda: found_rows(spark, 3), "validation_runs": breaks})
    assert counts(spark, root) == [0, 0]
    published.publish(spark, root, "r", {"validation_findings": lambda: found_rows(spark, 2), "validation_runs": lambda: run_rows(spark, 2)})
    assert counts(spark, root) == [1, 2]
    with pytest.raises(RuntimeError):
        published.publish(spark, root, "r", {"validation_findings": lambda: found_rows(spark, 9), "validation_runs": breaks})
    assert counts(spark, root) == [1, 2]
    published.publish(spark, root, "r", {"validation_findings": lambda: found_rows(spark, 0), "validation_runs": lambda: run_rows(spark, 0)})
    published.publish(spark, root, "other", {"validation_runs": lambda: run_rows(spark, 5)})
    assert counts(spark, root) == [2, 0]
    assert published.hidden(spark, root, "validation_findings").count() == 3


def test_truth_must_be_later(spark):
    for truth in ("2024-02-01", "2024-01-01"):
        with pytest.raises(ValueError, match="not later"):
            validation.judged(None, None, "2024-02-01", truth)


def test_versions_in_force(spark):
    versions = spark.createDataFrame(
        [("a", "a1", "2024-01-01"), ("a", "a2", "2024-01-05"), ("a", "a3", "2024-01-05"), ("b", "b1", "2024-02-01")],
        "source string, version string, since string",
    )
    days = ["2023-12-31", "2024-01-01", "2024-01-04", "2024-01-05", "2024-01-05", "2024-03-01"]
    snapshots = spark.createDataFrame([(d,) for d in days], "snapshot_id string")
    got = {(r.snapshot_id, r.source): (r.version, r.as_of) for r in history.in_force(versions, snapshots).collect()}
    assert got == {
        ("2024-01-01", "a"): ("a1", "2024-01-01"), ("2024-01-04", "a"): ("a1", "2024-01-01"), ("2024-01-05", "a"): ("a3", "2024-01-05"),
        ("2024-03-01", "a"): ("a3", "2024-01-05"), ("2024-03-01", "b"): ("b1", "2024-02-01"),
    }


def test_deliveries_by_time_and_not_by_arrival(spark):
    at = lambda minute: datetime.datetime(2024, 1, 1, 0, minute)
    files = [("x", "x1", at(1)), ("x", "x2", at(3)), ("x", "x2", at(2)), ("y", "y1", at(5)), ("y", "y2", at(5)), ("z", "z1", at(1)), ("w", "w1", at(4))]
    newest = jobs.newest_deliveries(spark.createDataFrame(files, "sample_id string, delivery string, modified timestamp"))
    assert {(r.sample_id, r.delivery, r.modified) for r in newest.collect()} == {("x", "x2", at(3)), ("y", "y2", at(5)), ("z", "z1", at(1)), ("w", "w1", at(4))}
    loaded = spark.createDataFrame(
        [("x", "x9", at(4)), ("y", "y2", at(5)), ("z", "z0", at(0)), ("z", "older", at(0))], "sample_id string, delivery string, modified timestamp"
    )
    kept = jobs.accepted(newest, loaded)  # x is older than what is there, y the same again, z newer, w unknown
    assert {r.sample_id for r in kept.collect()} == {"y", "z", "w"}
    assert jobs.accepted(newest, None).count() == 4


def test_risk_of_couples_by_counts_equals_that_of_all_pairs(spark):
    kinds = ["carrier", "affected", "compound"]
    rows, want = [], {}
    for k, mix in enumerate(itertools.chain.from_iterable(itertools.combinations_with_replacement(kinds, n) for n in (1, 2, 3, 4))):
        rows += [(f"g{k}", f"s{j}", status) for j, status in enumerate(mix)]
        pairs = list(itertools.combinations(mix, 2))
        if pairs:
            risk = [[S.PASS_PERCENT[a][e] * S.PASS_PERCENT[b][e] / 100 for a, b in pairs] for e in (0, 1)]
            want[f"g{k}"] = (len(pairs), round(min(risk[0])), round(max(risk[1])))
    index = spark.createDataFrame(rows, "gene string, sample_id string, status string")
    risk = panel.family_risk(index)
    assert {r.gene: (r.n_pairs, r.low_percent, r.high_percent) for r in risk.collect()} == want
    assert "Join" not in risk._jdf.queryExecution().toString()


def test_pairs_only_within_a_family(spark):
    index = spark.createDataFrame([("g", s, "carrier") for s in "abcd"], "gene string, sample_id string, status string")
    families = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("e", 2)], "sample_id string, family int")
    assert [(r.a, r.b) for r in panel.member_pairs(index, families).collect()] == [("a", "b")]


def test_bad_and_withheld_scores_cost_no_other(spark):
    lines = spark.createDataFrame(
        [("ok", "1", "5", "A", "0.5"), ("ok", "1", "x", "A", "1"), ("ok", "1", "7", "A", "inf"), ("bad", "1", "5", "A", "n/a"), ("bad", "1", None, "A", None),
         ("gated", "1", "5", "A", "1"), ("huge", "1", "5", "A", "1")], "pgs_id string, chrom string, pos string, effect string, weight string",
    )
    usable = polygenic.usable_lines(lines)
    assert sorted((r.pgs_id, r.pos, r.weight) for r in usable.collect()) == [("gated", 5, 1.0), ("huge", 5, 1.0), ("ok", 5, 0.5)]
    listed = spark.createDataFrame([(p, p, "yes" if p == "gated" else "no", 99 if p == "huge" else 3) for p in ("ok", "bad", "gated", "huge", "none")],
                                   "pgs_id string, trait string, s1_gate string, n_variants int")
    scores = spark.createDataFrame([(p, s, 10, 1) for p in ("ok", "gated", "huge", "bad") for s in ("x", "y")] , "pgs_id string, sample_id string, score_milli long, n_used long")
    samples = spark.createDataFrame([("x", "px"), ("y", "py"), ("z", "px")], "sample_id string, person string")
    consent = spark.createDataFrame([("px", "c", True), ("py", "c", False)], "person string, category string, granted boolean")
    rows = polygenic.panel_scores(listed, usable, scores, samples, consent, "c", cap=50).collect()
    got = {(r.pgs_id, r.sample_id): r.status for r in rows}
    assert len(rows) == 15 and all((r.score_milli is None) == (r.status != "scored") for r in rows)
    assert [got["ok", s] for s in "xyz"] == ["scored", "scored", "no calls"]
    assert [got["gated", s] for s in "xyz"] == ["scored", "withheld", "no calls"]
    assert {got[p, s] for p in ("bad", "none") for s in "xyz"} == {"malformed"} and {got["huge", s] for s in "xyz"} == {"too large"}
    free = polygenic.panel_scores(listed, usable, scores, samples, consent, "c", gate=False)
    assert {r.status for r in free.where("pgs_id in ('gated', 'huge')").collect()} == {"scored", "no calls"}
