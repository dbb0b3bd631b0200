"""Two incremental jobs: new ClinVar releases, and annotated calls that arrive per sample.

Both read a folder as a stream and handle each micro-batch as a batch job; the checkpoint remembers which
files were handled, so a restart neither skips nor repeats one, and writing replaces partitions by key,
so a repeated batch gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vardelta import schemas as S
from vardelta.operators import incremental
from vardelta.schemas import KEY
from vardelta.sources import readers, store


def newest_deliveries(files: DataFrame) -> DataFrame:
    """(sample_id, delivery, modified): each sample's newest delivery; of equally new ones the last by name.

    ``files``: sample_id, delivery and modified of every file, or row of one. A delivery is as new as its newest file.
    """
    each = files.groupBy("sample_id", "delivery").agg(F.max("modified").alias("modified"))
    newest = each.groupBy("sample_id").agg(F.max(F.struct("modified", "delivery")).alias("m"))
    return newest.select("sample_id", "m.delivery", "m.modified")


def accepted(newest: DataFrame, loaded: DataFrame | None) -> DataFrame:
    """Those of ``newest`` that are not older than what ``loaded`` says a sample's rows came from.

    A delivery that is the loaded one counts as not older, so a batch that failed half-way does the same again.
    """
    if loaded is None:
        return newest
    known = loaded.groupBy("sample_id").agg(F.max(F.struct("modified", "delivery")).alias("known"))
    rows = newest.join(known, "sample_id", "left")
    fresh = F.col("known").isNull() | (F.struct("modified", "delivery") >= F.col("known"))
    return rows.where(fresh).drop("known")


def call_stream(
    spark: SparkSession, source: str, table: str, checkpoint: str, snapshot: str, by_folder: bool = False, state: str | None = None
) -> StreamingQuery:
    """Load annotated files as they come; a later file of a sample replaces the rows of the earlier one.

    A file is named after its sample, or lies with others in a folder that is (``by_folder``); all files of a folder
    come together. Which file is the later one is decided by its time, not by when it arrives: the newest time of each
    sample of a snapshot is kept in the companion table ``deliveries`` under ``state`` (by default beside ``table``), a row
    a sample, and a file older than that is left out in whatever batch it comes. The state is written after the rows, so a
    batch that breaks in between is simply done again.
    """
    raw = spark.readStream.schema(S.ANNOTATED).option("sep", "\t").option("comment", "#").csv(source)
    named = raw.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"))
    name = r"([^/]+?)\.[^/]*/[^/]*$" if by_folder else r"([^/]+?)\.[^/]*$"
    delivery = F.regexp_replace("file", "/[^/]*$", "") if by_folder else F.col("file")
    root = state or f"{table.rstrip('/')}-state"

    def load(batch: DataFrame, _: int) -> None:
        own = batch.sparkSession
        rows = batch.withColumn("sample_id", F.regexp_extract("file", name, 1)).withColumn("delivery", delivery)
        known = store.read_companion(own, root, "deliveries") if store.exists(own, f"{root}/deliveries") else None
        if known is not None:
            known = known.where(F.col("snapshot_id") == snapshot)
        fresh = store.written(accepted(newest_deliveries(rows), known), "deliveries")
        taken = rows.join(fresh.select("sample_id", "delivery"), ["sample_id", "delivery"], "left_semi")
        shaped = readers.shape_annotated(taken, "sample_id").where("pos is not null")
        columns = [c.split()[0] for c in S.VARIANTS.split(", ")]
        stamped = shaped.withColumn("snapshot_id", F.lit(snapshot)).select(*columns)
        store.replace_partition(stamped, table, ["snapshot_id", "sample_id"])
        store.write_companion(fresh.withColumn("snapshot_id", F.lit(snapshot)), root, "deliveries", ["snapshot_id", "sample_id"])

    return (
        named.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def release_stream(
    spark: SparkSession, source: str, table: str, releases: str, checkpoint: str, stamp: Callable[[int], str]
) -> StreamingQuery:
    """Apply each new release: copy the last snapshot forward and re-annotate what its changes concern.

    ``table``: the variants store; ``releases``: the releases applied so far, by ``snapshot_id`` (both hold the
    start). ``stamp`` names the snapshot of a batch. What came before is read from the two tables, so a
    restarted job goes on where it was.
    """
    raw = spark.readStream.schema(S.CLINVAR).option("sep", "\t").option("comment", "#").csv(source)

    def apply(batch: DataFrame, number: int) -> None:
        session, curr = batch.sparkSession, stamp(number)
        store.replace_partition(readers.shape_clinvar(batch).withColumn("snapshot_id", F.lit(curr)), releases, ["snapshot_id"])
        known = session.read.parquet(releases).withColumn("snapshot_id", F.col("snapshot_id").cast("string"))
        prev = known.where(F.col("snapshot_id") < curr).agg(F.max("snapshot_id").alias("s")).first().s
        before, after = (known.where(F.col("snapshot_id") == s).drop("snapshot_id") for s in (prev, curr))
        rows = incremental.reannotate_delta(
            store.read_variants(session, table), prev, curr, incremental.clinvar_changes(before, after), keyed_like_variants(after)
        )
        store.replace_partition(rows, table, ["snapshot_id", "sample_id"])

    return raw.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def keyed_like_variants(release: DataFrame) -> DataFrame:
    """Release records under the trimmed keys of stored variants; empty fields are null there."""
    from vardelta.functions.alleles import trimmed_key

    k = trimmed_key(F.col("pos"), F.col("ref"), F.col("alt"))
    fields = [F.nullif(F.col(c), F.lit("")).alias(c) for c in incremental.RECORD]
    keyed = release.select("chrom", k.alias("k"), *fields).select("chrom", "k.pos", "k.ref", "k.alt", *incremental.RECORD)
    return keyed.dropDuplicates(KEY)
