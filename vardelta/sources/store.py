"""The partitioned store: tables of Parquet files, replaced a partition at a time."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vardelta import schemas as S


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder under the one that driver and executors share, ``spark.checkpoint.dir``.

    Only a local session may name none; it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as written to a scratch folder and read back: worked out once, and safe from lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder within its file system; it keeps its modification time."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def replace_partition(df: DataFrame, path: str, by: list[str]) -> None:
    """Overwrite only the partitions that ``df`` holds; readers see the old or the new files of each."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def load_partition(df: DataFrame, path: str, snapshot: str, sample: str) -> None:
    """Replace the variants of one sample in one snapshot."""
    columns = [c.split()[0] for c in S.VARIANTS.split(", ")]
    rows = df.withColumn("snapshot_id", F.lit(snapshot)).withColumn("sample_id", F.lit(sample))
    replace_partition(rows.select(*columns), path, ["snapshot_id", "sample_id"])


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.VARIANTS).parquet(path)


def write_companion(df: DataFrame, root: str, table: str, by: list[str]) -> None:
    """A companion table in its declared types, partition by partition."""
    fields = [f.split() for f in S.COMPANIONS[table].split(", ")]
    typed = df.select(*[F.col(name).cast(kind).alias(name) for name, kind in fields])
    replace_partition(typed, f"{root}/{table}", by)


#: Stands for the snapshot itself in the ledger of inputs.
ANCHOR = "*"


def mark_anchor(spark: SparkSession, root: str, snapshot: str) -> None:
    """Note in the ledger that a snapshot had a full scan: one row of a sample that cannot exist."""
    row = spark.range(1).select(F.lit(snapshot).alias("snapshot_id"), F.lit(ANCHOR).alias("sample_id"))
    empty = [F.lit(None).cast("string").alias(c) for c in ("vcf_digest", "cache_version", "clinvar_date")]
    write_companion(row.select("*", *empty), root, "scan_inputs", ["snapshot_id", "sample_id"])


def anchors(spark: SparkSession, root: str) -> DataFrame:
    """Snapshots that had a full scan."""
    return read_companion(spark, root, "scan_inputs").where(F.col("sample_id") == ANCHOR).select("snapshot_id")


def read_companion(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.schema(S.COMPANIONS[table]).parquet(f"{root}/{table}")


def append_scores(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def export(df: DataFrame, path: str) -> None:
    """Tab-separated text with a header; null is empty."""
    df.write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="", emptyValue="", quote="")


def run_sql(spark: SparkSession, text: str, variants: DataFrame, **params: str) -> DataFrame:
    """A query text over ``variants`` with named markers (``:child``): values are never spliced into the SQL."""
    variants.createOrReplaceTempView("variants")
    return spark.sql(text, args=params)
