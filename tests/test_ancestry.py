"""Levels and cycles of pedigrees against plain searches over random graphs."""

import random

from pyspark.sql import functions as F

from vardelta.operators import ancestry, pedigree

EDGE = "child string, parent string"
PERSON = "id string, sex string, father string, mother string, partner string"


def ancestors(edges, start):
    seen, stack = set(), [start]
    while stack:
        for child, parent in edges:
            if child == stack[-1] and parent not in seen:
                seen.add(parent)
                stack.append(parent)
                break
        else:
            stack.pop()
    return seen


def graphs():
    rng = random.Random(8)
    yield {(f"n{k}", f"n{rng.randrange(40)}") for k in range(40)}  # as many edges as nodes: a few long cycles
    yield {(f"n{max(a, b)}", f"n{min(a, b)}") for a, b in (rng.sample(range(30), 2) for _ in range(45))}  # no cycle
    # two cycles with a path between them, a loop, persons above and below
    yield {("a", "b"), ("b", "a"), ("c", "a"), ("d", "c"), ("e", "d"), ("f", "e"), ("e", "f"), ("g", "g"), ("h", "f"), ("b", "top"), ("i", "top")}


def test_cycles_and_levels_equal_plain_search(spark):
    for edges in graphs():
        frame = spark.createDataFrame(sorted(edges), EDGE)
        nodes = {x for e in edges for x in e}
        above = {n: ancestors(edges, n) for n in nodes}
        cyclic = {n for n in nodes if n in above[n]}
        assert {r.id for r in ancestry.on_cycles(frame).collect()} == cyclic
        want, rest = {}, {n for n in nodes if n not in cyclic and not above[n] & cyclic}
        while len(want) < len(rest):
            for n in rest - set(want):
                parents = [p for c, p in edges if c == n]
                if all(p in want for p in parents):
                    want[n] = 1 + max((want[p] for p in parents), default=-1)
        ids = spark.createDataFrame([(n,) for n in sorted(nodes)], "id string")
        assert {r.id: r.level for r in ancestry.levels(ids, frame).collect()} == want


def test_no_edges(spark):
    none, ids = spark.createDataFrame([], EDGE), spark.createDataFrame([("x",), ("x",)], "id string")
    assert ancestry.on_cycles(none).count() == 0
    assert [tuple(r) for r in ancestry.levels(ids, none).collect()] == [("x", 0)]


def test_long_line_ends_and_cycle_below_a_founder_is_named(spark):
    """A line longer than any fixed bound, and a couple who are each other's child below a founder."""
    line = [("p0", "male", None, None, None)] + [(f"p{k}", "male", f"p{k - 1}", None, None) for k in range(1, 15)]
    loop = [("f", "male", None, None, None), ("a", "male", "f", "z", None), ("z", "female", "a", None, None), ("q", "male", "z", None, None)]
    people = spark.createDataFrame(line + loop, PERSON)
    got = {r.id: r.generation for r in pedigree.generations(people).collect()}
    assert got == {f"p{k}": k for k in range(15)} | {"f": 0, "a": None, "z": None, "q": None}
    issues = {(r.id, r.issue) for r in pedigree.pedigree_issues(people).collect()}
    assert {i for i, x in issues if x == "is its own ancestor"} == {"a", "z"}


def test_callsets_of_two_suffixes_and_unknown_sex(spark):
    rows = [("ann", None, None, None, None), ("ann_b", "female", None, None, None), ("ann_x_y", None, None, None, None), ("ann_b_c_d", None, None, None, None),
            ("bob", "male", "carl", "ann", None), ("annabel", None, None, None, None), ("_", None, None, None, None)]
    got = {(r.id, r.issue) for r in pedigree.pedigree_issues(spark.createDataFrame(rows, PERSON)).collect()}
    assert got == {("ann_b", "callset of ann"), ("ann_x_y", "callset of ann"), ("ann_b_c_d", "callset of ann_b"), ("bob", "father unknown: carl")}


def test_levels_are_cut_from_one_another(spark):
    """Every round is read from files, so the plan does not grow with the depth."""
    edges = spark.createDataFrame([(f"n{k}", f"n{k - 1}") for k in range(1, 6)], EDGE)
    plan = ancestry.levels(edges.select(F.col("child").alias("id")).union(edges.select("parent")), edges)._jdf.queryExecution().toString()
    assert "Join" not in plan
