"""Filter interaction audit: what each filter removes in every order of the filters.

The orders of k filters are the paths through the lattice of subsets, from no filter applied to all of them.
What a filter removes depends on the state it meets, not on the path there, so an audit needs one count for each of
the ``k * 2 ** (k - 1)`` edges: documents that pass every filter of the state and fail the next. Counting
paths forward (orders that reach a state) and backward (orders that leave it) gives the number of orders through each
edge; with it as weight, the edges' removals add up to a filter's Shapley sum, and the steps of any single
order are read from the edges it takes.

Documents are reduced to a mask of the filters they fail and counted by mask, so nothing after the first
aggregation grows with them: a part has at most ``4 * 2 ** k`` rows. Built-in functions only.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vardelta.llm._shared import constant_array

#: More filters would make more orders than a report can hold.
MOST_FILTERS = 7
#: Characters (Java's \\s would take others) that separate words.
SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def path_counts(filters: int) -> tuple[list[int], list[int]]:
    """For every state (a mask of applied filters): orders that reach it, and orders that lead from it to the end."""
    states = 1 << filters
    reaching, leaving = [1] + [0] * (states - 1), [0] * (states - 1) + [1]
    for state in range(states):
        for f in range(filters):
            if not state >> f & 1:
                reaching[state | 1 << f] += reaching[state]
    for state in reversed(range(states)):
        leaving[state] += sum(leaving[state | 1 << f] for f in range(filters) if not state >> f & 1)
    return reaching, leaving


def edges(filters: int) -> list[tuple[int, int, int]]:
    """(state, next filter, orders through this edge)."""
    reaching, leaving = path_counts(filters)
    return [
        (s, f, reaching[s] * leaving[s | 1 << f]) for s in range(1 << filters) for f in range(filters) if not s >> f & 1
    ]


def edge_counts(masks: DataFrame, filters: int) -> DataFrame:
    """Counts of every edge, zeros included, for each part of ``masks`` (part, mask, n, good, toxic).

    ``kept`` are those that the state behind the edge keeps, ``removed`` those that the edge takes away, ``redundant``
    those that fail its filter but are gone before, ``unique_fails`` those that fail no other filter.
    """
    listed = edges(filters)
    columns = {
        "state": [s for s, _, _ in listed],
        "filter": [f for _, f, _ in listed],
        "weight": [w for _, _, w in listed],
    }
    edge = F.arrays_zip(*[constant_array(v, "bigint").alias(k) for k, v in columns.items()])
    each = masks.select("part", "mask", "n", "good", "toxic", F.explode(edge).alias("e")).select("*", "e.*")
    own = F.expr("shiftleft(1L, cast(filter as int))")
    mask, gone = F.col("mask"), F.col("mask").bitwiseAND(F.col("state")) != 0
    fails = mask.bitwiseAND(own) != 0
    removed = fails & ~gone

    def total(what: str, where: Column) -> Column:
        return F.sum(F.when(where, F.col(what)).otherwise(0))

    return each.groupBy("part", "state", "filter", "weight").agg(
        total("n", mask.bitwiseAND(F.col("state").bitwiseOR(own)) == 0).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", fails & gone).alias("redundant"),
        total("n", mask == own).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
    )


def order_steps(counts: DataFrame, names: str) -> DataFrame:
    """A row for each part, order of the filters and step, read from the edge counts."""
    rows = []
    for order in itertools.permutations(range(len(names))):
        state = 0
        for step, f in enumerate(order, 1):
            rows.append(("".join(names[k] for k in order), step, state, f))
            state |= 1 << f
    steps = counts.sparkSession.createDataFrame(rows, "filter_order string, step int, state long, filter long")
    share = Window.partitionBy("part", "filter")
    weighed = counts.withColumn("shapley", F.sum(F.col("removed") * F.col("weight")).over(share))
    return weighed.join(F.broadcast(steps), ["state", "filter"]).select(  # k * k! rows
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit(masks: DataFrame, names: str) -> DataFrame:
    """The whole report from masks of failed filters; ``names`` has a letter for each bit, from the lowest.

    ``masks`` has part, mask, n and of these the good and the toxic documents; rows of a part and mask are added up. No
    rows give no rows.
    """
    if not 1 <= len(names) <= MOST_FILTERS or len(set(names)) < len(names):
        raise ValueError(f"1 to {MOST_FILTERS} filters with names of their own")
    summed = masks.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    return order_steps(edge_counts(summed, len(names)), names)


def text_marks(text: Column) -> Column:
    """Bits of the failed text rules: A few words, B few distinct ones, C capitals, D symbols. Null is empty."""
    words = F.filter(F.split(text, SPACES), lambda w: w != F.lit(""))
    few = F.size(words) < 50
    alike = F.size(F.array_distinct(words)) * 100 < F.size(words) * 65
    chars = F.length(text)
    loud = (chars - F.length(F.translate(text, UPPER, ""))) * 100 > chars * 5
    marked = text.rlike(r"[#$%&*|]")
    return sum((F.when(rule, 1 << k).otherwise(0) for k, rule in enumerate((few, alike, loud, marked))), F.lit(0))


def failed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic) of documents under the five rules A to E; E is a text that a smaller doc_id has.

    ``docs`` has doc_id, text and source, ``labels`` doc_id, quality and toxic; other columns do no harm. A null
    text is empty, a null source the part ''. A null doc_id is smaller and greater than none, so its row never fails
    E and has no label; rows that share doc_id and text do not fail E for each other. A document counts once as good
    (toxic) if any of its labels says so.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("key"),
        text_marks(text).alias("mask"),
    )
    said = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id")).agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("good"),
        F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("toxic"),
    )
    group = ["key", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")]
    known = rows.join(said, F.col("doc_id") == F.col("__id"), "left").groupBy("doc_id", *group).agg(F.count("*").alias("n"))
    # copies are counted up before they meet, so a text has a row for each part and label, however many copies there are
    copies = known.groupBy("key", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("least"),
        F.coalesce(F.min_by("n", "doc_id"), F.lit(0)).alias("n_least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
    )
    first = F.min("least").over(Window.partitionBy("key"))
    fresh = F.col("n_null") + F.when(F.col("least") == first, F.col("n_least")).otherwise(0)
    split = copies.withColumn("fresh", fresh).select(
        "part", "good", "toxic",
        F.explode(
            F.array(
                F.struct(F.col("mask").alias("mask"), F.col("fresh").alias("n")),
                F.struct(F.col("mask").bitwiseOR(F.lit(16)).alias("mask"), (F.col("n") - F.col("fresh")).alias("n")),
            )
        ).alias("m"),
    )
    n = F.col("m.n")
    return split.groupBy("part", F.col("m.mask").cast("long").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic")
    )
