"""Multiset digests: what they tell apart, and that they follow changes."""

import itertools

from pyspark.sql import functions as F

from vardelta.operators import digests, incremental

PAIR = "sample_id string, a string, b string"


def of(spark, rows):
    frame = spark.createDataFrame([("s", *r) for r in rows], PAIR)
    return incremental.input_digests(frame).first()


def test_copies_do_not_cancel_and_fields_are_framed(spark):
    x, y, q = ("x", "1"), ("y", "1"), ("q", "1")
    kinds = [[x, x, q], [y, y, q], [x, y, q], [x, q], [x, x, x, q], [("a|b", "c")], [("a", "b|c")], [("ab", "c")], [("a", "bc")],
             [(None, "c")], [("", "c")], [("-", "c")], [("~", "c")], [("c", None)], [("1:c", "")], [("", "1:c")]]
    found = [of(spark, k).digest for k in kinds]
    assert len(set(found)) == len(kinds)
    assert all(len(d) == 60 for d in found)


def test_order_and_partitions_do_not_matter(spark):
    rows = [("s", f"v{k % 7}", None if k % 3 else str(k)) for k in range(50)]
    a = spark.createDataFrame(rows, PAIR).repartition(5)
    b = spark.createDataFrame(rows[::-1], PAIR).coalesce(1)
    assert incremental.input_digests(a).first() == incremental.input_digests(b).first()


def test_digest_follows_changes(spark):
    frame = lambda rows: digests.multiset_digest(spark.createDataFrame(rows, PAIR), ["sample_id"])
    before = [("s", "x", "1")] * 3 + [("t", "y", None), ("u", "z", "2")]
    came, went = [("s", "w", "9"), ("v", "n", "0")], [("s", "x", "1"), ("u", "z", "2")]
    after = [("s", "x", "1")] * 2 + [("t", "y", None), ("s", "w", "9"), ("v", "n", "0")]
    got = digests.updated_digest(frame(before), frame(came), frame(went), ["sample_id"])
    assert {tuple(r[:2]) + tuple(r[2]) for r in got.collect()} == {tuple(r[:2]) + tuple(r[2]) for r in frame(after).collect()}


def test_sums_wrap_and_no_rows_are_zeros(spark):
    many = spark.range(3000).select(F.col("id").cast("string").alias("a"))
    d = digests.multiset_digest(many, []).first()
    assert d.n == 3000 and all(0 <= x < digests.MODULUS for x in d.digest)
    empty = digests.multiset_digest(many.limit(0), []).first()
    assert (empty.n, empty.digest) == (0, [0] * digests.LIMBS)


def test_stale_reports(spark):
    panel = spark.createDataFrame([("PGS1", "trait", 3), ("PGS1", "trait", 3)], "pgs_id string, trait string, n int")
    now = digests.multiset_digest(panel, []).select(incremental.panel_stamp(F.col("digest")).alias("s")).first().s
    rows = [(f"{p}{c}{k}", who, p, c) for k, (p, c, who) in enumerate(itertools.product([now, now + "0", None], ["shown", "withheld", None], ["yes", "no", "silent"]))]
    reports = spark.createDataFrame(rows, "sample_id string, person string, panel_stamp string, consent_stamp string")
    consent = spark.createDataFrame([("yes", "c", True), ("no", "c", False), ("no", "other", True)], "person string, category string, granted boolean")
    got = {r.sample_id: r for r in incremental.stale_reports(reports, panel, consent, "c").collect()}
    for sample, who, p, c in rows:
        fresh = p == now and (c or "shown") == ("shown" if who == "yes" else "withheld")
        assert got[sample].stale is not fresh
    capped = incremental.stale_reports(reports, panel, consent, "c", cap=500)
    assert capped.where("panel_current").count() == 0
    open_ = incremental.stale_reports(reports, panel, consent, "c", gate=False)
    assert {r.sample_id for r in open_.where("consent_current").collect()} == {s for s, _, _, c in rows if c != "withheld"}
