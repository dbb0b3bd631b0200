"""Running totals along an ordered value, where a few groups hold all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Steps of a group, the square of the number of coarse ones.
COARSE = 16
RANGES = COARSE**2
#: Ranks of the cuts are right up to this share of a group's values.
ACCURACY = 20 * RANGES


def depth_cuts(values: DataFrame, group: str, value: str) -> DataFrame:
    """(``group``, cuts): ``RANGES`` - 1 values that cut each group's values into parts of about equal size.

    The cuts come from a quantile sketch that each task fills and merges, so no group is sorted.
    """
    shares = F.array(*[F.lit(k / RANGES) for k in range(1, RANGES)])
    return values.groupBy(group).agg(F.percentile_approx(value, shares, F.lit(ACCURACY)).alias("cuts"))


def part_of(cuts: Column, value: Column) -> Column:
    """How many of the sorted cuts lie below a value: first among every sixteenth, then among those in between."""
    coarse = F.transform(F.sequence(F.lit(1), F.lit(COARSE - 1)), lambda j: F.get(cuts, j * COARSE - 1))
    below = F.size(F.filter(coarse, lambda c: c < value))
    fine = F.size(F.filter(F.slice(cuts, below * COARSE + 1, COARSE - 1), lambda c: c < value))
    return below * COARSE + fine


def running_totals(rows: DataFrame, group: str, value: str, sums: list[str], strict: bool) -> DataFrame:
    """Adds ``{c}_below`` (sum of ``c`` over the group's lower values, its equals too unless ``strict``) and ``{c}_all``.

    Rows of equal value are added up first. The values of a group are cut into parts of about equal number, each a
    window of its own, whatever their distribution; the totals of the parts, ``RANGES`` + 1 rows a group, carry over.
    Null values come first, NaN last.
    """
    added = [F.sum(c).alias(f"__{c}") for c in sums]
    values = rows.groupBy(F.col(group).alias("__g"), F.col(value).alias("__v")).agg(*added)
    asked = values.select("__g", F.col("__v").cast("double").alias("__x"))
    bounds = depth_cuts(asked, "__g", "__x").withColumnRenamed("__g", "__of")
    cut = values.join(bounds, F.col("__g").eqNullSafe(F.col("__of")))
    part = F.when(F.col("__v").isNull() | F.col("cuts").isNull(), -1).otherwise(part_of(F.col("cuts"), F.col("__v").cast("double")))
    cut = cut.withColumn("__part", part.cast("bigint")).drop("__of", "cuts")
    before = Window.partitionBy("__of").orderBy("__nth").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut.groupBy(F.col("__g").alias("__of"), F.col("__part").alias("__nth")).agg(*[F.sum(f"__{c}").alias(f"__{c}_sum") for c in sums])
    parts = parts.select(
        "__of", "__nth",
        *[F.coalesce(F.sum(f"__{c}_sum").over(before), F.lit(0)).alias(f"__{c}_before") for c in sums],
        *[F.sum(f"__{c}_sum").over(Window.partitionBy("__of")).alias(f"{c}_all") for c in sums],
    )
    upto = Window.partitionBy("__g", "__part").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    inside = cut.select("__g", "__v", "__part", *[F.coalesce(F.sum(f"__{c}").over(upto), F.lit(0)).alias(f"__{c}_in") for c in sums])
    same = F.col("__g").eqNullSafe(F.col("__of")) & (F.col("__part") == F.col("__nth"))
    placed = inside.join(parts, same).select(
        "__g", "__v", *[(F.col(f"__{c}_before") + F.col(f"__{c}_in")).alias(f"{c}_below") for c in sums], *[f"{c}_all" for c in sums]
    )
    own = F.col(group).eqNullSafe(F.col("__g")) & F.col(value).eqNullSafe(F.col("__v"))
    return rows.join(placed, own).drop("__g", "__v")
