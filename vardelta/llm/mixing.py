"""Mixing sources to target weights by Poisson replication.

The rows of a source are wanted ``rate = weight * total / size of the source`` times each. A hash of
(seed, doc_id) gives every document a fixed uniform number; inverting the Poisson distribution with the
source's rate turns it into a count of copies, and the copies are put into one global order by another
hash. The same seed gives the same mix on any cluster, and a larger rate never takes copies away.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vardelta.llm._shared import constant_array, without

#: Hash draws are integers below this.
GRID = 1 << 52
REST = "\0rest"


def poisson_steps(rate: float) -> list[int]:
    """``steps[k]``: the draws below it stand for k copies or fewer; ends where the grid is used up."""
    steps, k = [], 0
    term = total = math.exp(-rate)
    while (step := math.floor(total * GRID)) < GRID and not (k > rate and steps and step == steps[-1]):
        steps.append(step)
        k += 1
        # the recurrence starts from zero where exp(-rate) is below the least float
        term = term * rate / k if rate < 700 else math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        total += term
    return steps


def draw(seed: int, purpose: str, *keys: Column) -> Column:
    """A uniform integer below :data:`GRID` from the keys: 13 hex digits of an MD5."""
    digest = F.md5(F.concat_ws("|", F.lit(f"{seed}|{purpose}"), *keys))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def rates(docs: DataFrame, weights: dict[str, float], source: str = "source", total: int | None = None) -> dict[str, float]:
    """Copies wanted of each row, by source; sources without a weight share the key :data:`REST`.

    Weights are shares of the mix; what they leave of 1 goes to the other sources (and null ones), in
    proportion to their sizes; a negative weight, or more than 1 in all, is an error. ``total`` rows are wanted, as many as there are if not given.
    """
    if min(weights.values(), default=0.0) < 0 or sum(weights.values()) > 1 + 1e-9:
        raise ValueError("weights are shares: none below 0, and 1 at most in all")
    named = F.when(F.col(source).isin(*weights), F.col(source)).otherwise(F.lit(REST))
    counts = {r.s: r.n for r in docs.groupBy(named.alias("s")).agg(F.count("*").alias("n")).collect()}
    wanted = total if total is not None else sum(counts.values())
    present = {s: w for s, w in weights.items() if counts.get(s)}
    rest = max(0.0, 1.0 - sum(weights.values()))
    if counts.get(REST):
        present[REST] = rest
    scale = sum(present.values())
    if not scale:
        return {s: 0.0 for s in present}
    return {s: w / scale * wanted / counts[s] for s, w in present.items()}


def copies(draw_column: Column, source: Column, by_source: dict[str, float]) -> Column:
    """The Poisson count of a row: how many steps of its source its draw has passed."""

    steps = constant_array(poisson_steps(by_source.get(REST, 0.0)), "bigint")
    for name, rate in by_source.items():
        if name != REST:
            steps = F.when(source == F.lit(name), constant_array(poisson_steps(rate), "bigint")).otherwise(steps)
    return F.size(F.filter(steps, lambda step: draw_column >= step))


def mix(
    docs: DataFrame,
    weights: dict[str, float],
    seed: int,
    total: int | None = None,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Every document as often as its draw says, with ``copy`` (from 0) and ``mix_key``, in mix order.

    ``mix_key`` (copy and document hashed) is the global order. Rows that share a doc_id share the draw;
    a row without doc_id is drawn by its text. A null source counts among the rest. An empty table stays
    empty; input columns called ``copy`` or ``mix_key`` are replaced.
    """
    base = without(docs, "copy", "mix_key")
    by_source = rates(base, weights, source, total)
    if not by_source:
        by_source = {REST: 0.0}
    name = F.coalesce(F.col(key).cast("string"), F.md5(F.coalesce(F.col(text), F.lit(""))))
    count = copies(F.col("__draw"), F.coalesce(F.col(source), F.lit("")), by_source)
    counted = (
        base.withColumn("__name", name)
        .withColumn("__draw", draw(seed, "copies", F.col("__name")))
        .withColumn("__n", count)
        .where("__n > 0")
    )
    taken = counted.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    return (
        taken.withColumn("mix_key", draw(seed, "order", F.col("__name"), F.col("copy").cast("string")))
        .drop("__name", "__draw", "__n")
        .orderBy("mix_key", key, "copy")
    )
