"""Registration: a query is a function of (spark, sf_dir) with, where SQL can express it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vardelta.derive import ctes, derived

PREV, CURR, LATER = "2024-01-01", "2024-02-01", "2024-03-01"
CHILD, FATHER, MOTHER, SON = "daughter", "father", "mother", "grandson"
SON_FATHER = "partner"

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Derived tables of one run, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return derived(self.spark, self.sf_dir, name)

    def at(self, snapshot: str) -> DataFrame:
        return self.variants.where(f"snapshot_id = '{snapshot}'")


def query(name: str, *tables: str, sql: str | None = None):
    """Register the function under ``name``; ``sql`` may use the derived ``tables``."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            head = ctes(*tables) if tables else ""
            if head and sql.lstrip().upper().startswith("WITH "):
                body = sql.lstrip()[5:]
                head = head.rstrip() + ",\n"
                ORACLES[name] = (head + body) if "RECURSIVE" not in body[:12] else head.replace("WITH ", "WITH RECURSIVE ", 1) + body[10:]
            else:
                ORACLES[name] = head + sql
        return f

    return register
