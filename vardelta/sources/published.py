"""Results of a run that become visible together or not at all.

A run writes its tables as attempts: folders that no reader looks at. Only when all of them are complete is one row put
into the list of published runs, by a single file that a commit renames into place; readers take the rows of the newest
published attempt of each run. A run that breaks leaves nothing to see, and one that is done again replaces the earlier one
at once in all its tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vardelta import schemas as S
from vardelta.sources import store

#: The list of published runs: one appended row a publication.
RUNS, LISTED = "published_runs", "run_id string, attempt string, place long, tables array<string>"


def _attempt(df: DataFrame, root: str, table: str, run_id: str, attempt: str) -> None:
    fields = [f.split() for f in S.COMPANIONS[table].split(", ")]
    typed = df.select(*[F.col(name).cast(kind).alias(name) for name, kind in fields])
    marked = typed.withColumn("of_run", F.lit(run_id)).withColumn("attempt", F.lit(attempt))
    marked.write.mode("append").partitionBy("of_run", "attempt").parquet(f"{root}/{table}")


def publish(spark: SparkSession, root: str, run_id: str, tables: dict[str, Callable[[], DataFrame]]) -> str:
    """Write the companion ``tables`` of a run and show them together; gives the attempt's name.

    Tables come as functions, worked out one after the other; whatever one of them raises goes to the caller, and nothing
    of the run can be seen. Two runs with different names do not wait for one another; of two publications of the same
    run the later one in the list holds.
    """
    attempt = uuid.uuid4().hex
    for table, rows in tables.items():
        _attempt(rows(), root, table, run_id, attempt)
    place = 0
    if store.exists(spark, f"{root}/{RUNS}"):
        place = (spark.read.schema(LISTED).parquet(f"{root}/{RUNS}").agg(F.max("place")).first()[0] or 0) + 1
    row = spark.createDataFrame([(run_id, attempt, place, sorted(tables))], LISTED)
    row.coalesce(1).write.mode("append").parquet(f"{root}/{RUNS}")
    return attempt


def current(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, attempt, tables): what is shown of each run."""
    if not store.exists(spark, f"{root}/{RUNS}"):
        return spark.createDataFrame([], LISTED).drop("place")
    last = F.max_by(F.struct("attempt", "tables"), F.struct("place", "attempt")).alias("m")
    return spark.read.schema(LISTED).parquet(f"{root}/{RUNS}").groupBy("run_id").agg(last).select("run_id", "m.*")


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows of a companion table that belong to published attempts."""
    shown = current(spark, root).where(F.array_contains("tables", table))
    schema = f"{S.COMPANIONS[table]}, of_run string, attempt string"
    if not store.exists(spark, f"{root}/{table}"):
        return spark.createDataFrame([], S.COMPANIONS[table])
    rows = spark.read.schema(schema).parquet(f"{root}/{table}")
    visible = shown.select(F.col("run_id").alias("of_run"), "attempt")
    return rows.join(visible, ["of_run", "attempt"], "left_semi").drop("of_run", "attempt")


def hidden(spark: SparkSession, root: str, table: str) -> DataFrame:
    """(of_run, attempt) of rows that no reader sees: broken or replaced attempts, which may be cleared away."""
    rows = spark.read.schema(f"{S.COMPANIONS[table]}, of_run string, attempt string").parquet(f"{root}/{table}")
    visible = current(spark, root).select(F.col("run_id").alias("of_run"), "attempt")
    return rows.select("of_run", "attempt").distinct().join(visible, ["of_run", "attempt"], "left_anti")
