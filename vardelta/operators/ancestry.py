"""Levels and cycles of a graph of (child, parent) edges.

Everything works by rounds over the edges that are left: a round is a few semi-joins whose result is written,
so a graph of any size takes as many rounds as its longest path and none of them holds a whole line of descent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vardelta.sources.store import written


def levels(ids: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, level) of those that descend from no cycle: 0 without parents, else 1 + the greatest of the parents'.

    A level is placed when all parents of its members are. Members of cycles and their descendants wait for ever and have
    no row.
    """
    waiting = written(edges.select("child", "parent").distinct(), "waiting")
    level = ids.select("id").distinct().join(waiting.select(F.col("child").alias("id")), "id", "left_anti")
    level = written(level.withColumn("level", F.lit(0)), "level")
    found = [level]
    while not level.isEmpty():
        placed = level.select(F.col("id").alias("parent"))
        touched = waiting.join(placed, "parent", "left_semi").select("child").distinct()
        waiting = written(waiting.join(placed, "parent", "left_anti").select("child", "parent"), "waiting")
        ready = touched.join(waiting, "child", "left_anti").select(F.col("child").alias("id"))
        level = written(ready.withColumn("level", F.lit(len(found))), "level")
        found.append(level)
    return reduce(DataFrame.union, found)


def core(edges: DataFrame) -> DataFrame:
    """The edges that are left when those without an edge before or behind them go, again and again.

    What is left are the cycles and the paths between them; nothing where there is no cycle.
    """
    now = written(edges.select("child", "parent").distinct(), "core")
    size = now.count()
    while size:
        above = now.select(F.col("child").alias("parent")).distinct()
        below = now.select(F.col("parent").alias("child")).distinct()
        kept = now.join(above, "parent", "left_semi").join(below, "child", "left_semi")
        after = written(kept.select("child", "parent"), "core")
        left = after.count()
        if left == size:
            return after
        now, size = after, left
    return now


def _greatest_ancestors(edges: DataFrame) -> DataFrame:
    """(id, colour): the greatest id among each node and its ancestors."""
    nodes = edges.select(F.col("child").alias("id")).union(edges.select("parent")).distinct()
    now = written(nodes.withColumn("colour", F.col("id")), "colour")
    while True:
        told = edges.join(now.withColumnRenamed("id", "parent"), "parent").groupBy(F.col("child").alias("id"))
        heard = told.agg(F.max("colour").alias("heard"))
        joined = now.join(heard, "id", "left").select("id", F.greatest("colour", "heard").alias("colour"), (F.col("heard") > F.col("colour")).alias("new"))
        after = written(joined, "colour")
        if after.where("new").isEmpty():
            return after.select("id", "colour")
        now = after.select("id", "colour")


def on_cycles(edges: DataFrame) -> DataFrame:
    """(id) of every node that is its own ancestor; paths between two cycles are not part of one.

    Nodes are coloured by their greatest ancestor. A node of its own colour, together with those of its colour that are
    its ancestors, is strongly connected; these are taken out, and what is left is trimmed and coloured anew.
    """
    found = [edges.select(F.col("child").alias("id")).where("1 = 0")]
    left = core(edges)
    while not left.isEmpty():
        colour = _greatest_ancestors(left)
        same = left.join(colour.select(F.col("id").alias("child"), "colour"), "child").join(
            colour.select(F.col("id").alias("parent"), "colour"), ["parent", "colour"]
        )
        same = written(same.select("child", "parent"), "same-colour")
        front = written(colour.where("id = colour").select("id"), "strong")
        strong = front
        while not front.isEmpty():
            up = same.join(front.withColumnRenamed("id", "child"), "child", "left_semi").select(F.col("parent").alias("id"))
            front = written(up.distinct().join(strong, "id", "left_anti"), "strong")
            strong = strong.union(front)
        inside = same.join(strong.withColumnRenamed("id", "child"), "child", "left_semi")
        inside = inside.join(strong.withColumnRenamed("id", "parent"), "parent", "left_semi")
        found.append(inside.select(F.col("child").alias("id")).distinct())
        rest = left.join(strong.withColumnRenamed("id", "child"), "child", "left_anti")
        left = core(rest.join(strong.withColumnRenamed("id", "parent"), "parent", "left_anti"))
    return reduce(DataFrame.union, found).distinct()
