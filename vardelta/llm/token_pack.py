"""Token ids on disk, compressed by Re-Pair.

The texts are dealt into shards by ranges of doc_id and sorted there. Each shard is encoded and cut
into blocks of about 2 ** 18 ids; a block becomes a grammar (rules and their expansion lengths)
and a bit-packed symbol sequence. A row of the Parquet files is one block, so Spark's writer
commits them, any store will do, and a lost executor's shard is simply encoded again.

File format, one row a block: ``shard``, ``block`` (from 0 in its shard), ``first_id`` (ids of the shard
before it), ``n_ids``, ``first_doc`` (number of its first document in the shard), ``doc_ids``,
``doc_ends`` (ends of the documents, in ids of the block), ``resumed``, ``open``,
``bits``, ``rules`` and ``symbols`` (packed with so many bits each), ``n_rules``, ``length_bits`` and ``lengths``
(how many ids each rule stands for: any range of ids is decoded without the rest), ``n_symbols``. A very
long document can continue in the next block: ``open`` says that the last one goes on, ``resumed`` that the
first one does.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vardelta.llm import _repair
from vardelta.llm._pieces import GROUP, shared_encoder
from vardelta.llm._shared import materialize, shuffle_partitions

BLOCK_IDS = 1 << 18
BLOCKS = pa.schema(
    [
        ("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
        ("first_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int64())),
        ("resumed", pa.bool_()), ("open", pa.bool_()),
        ("bits", pa.int32()), ("n_rules", pa.int32()), ("rules", pa.binary()),
        ("length_bits", pa.int32()), ("lengths", pa.binary()), ("n_symbols", pa.int64()), ("symbols", pa.binary()),
    ]
)
BLOCKS_DDL = (
    "shard int, block int, first_id long, n_ids long, first_doc long, doc_ids array<long>, doc_ends array<long>, "
    "resumed boolean, open boolean, "
    "bits int, n_rules int, rules binary, length_bits int, lengths binary, n_symbols long, symbols binary"
)


def pack_block(ids: np.ndarray, base: int, least: int) -> dict:
    """The grammar columns of one block."""
    grammar = _repair.compress(ids, base, least)
    bits = max(1, int(base + len(grammar.rules) - 1).bit_length())
    length_bits = max(1, int(grammar.lengths.max(initial=1)).bit_length())
    return {
        "bits": bits, "n_rules": len(grammar.rules), "rules": _repair.pack_bits(grammar.rules.reshape(-1), bits),
        "length_bits": length_bits, "lengths": _repair.pack_bits(grammar.lengths, length_bits),
        "n_symbols": len(grammar.symbols), "symbols": _repair.pack_bits(grammar.symbols, bits),
    }


def load_block(row: dict, base: int) -> _repair.Grammar:
    """The grammar of a stored row."""
    rules = _repair.unpack_bits(row["rules"], row["bits"], 2 * row["n_rules"]).reshape(-1, 2)
    lengths = _repair.unpack_bits(row["lengths"], row["length_bits"], row["n_rules"])
    return _repair.Grammar(base, rules, lengths, _repair.unpack_bits(row["symbols"], row["bits"], row["n_symbols"]))


def document_slice(row: dict, base: int, doc: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of the block's ``doc``-th document, decoded without the rest of the block."""
    left = row["doc_ends"][doc - 1] if doc else 0
    right = row["doc_ends"][doc]
    to = right if stop is None else min(right, left + stop)
    return _repair.expand_range(load_block(row, base), left + start, to)


def encode_blocks(
    docs: DataFrame, tokenizer: str, end_id: int, base: int, least: int = _repair.PAYS, shards: int | None = None
) -> DataFrame:
    """Blocks (:data:`BLOCKS`) of ``docs`` (doc_id, an integer, and text), in ascending doc_id order.

    Null doc_ids come first; rows that share a doc_id are ordered by a hash of their text, equal rows as
    they come. A null text is an empty one: only its end id is stored.
    """
    count = shards or shuffle_partitions(docs.sparkSession)
    order = ["doc_id", "__tie"]
    dealt = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("__tie"))
        .repartitionByRange(count, *order)
        .sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("shard"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    )

    def shard_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        held, names, ends = [], [], []
        size = done = block = shard = number = first_doc = 0
        resumed = False

        def flush(goes_on: bool) -> pa.RecordBatch:
            row = {
                "shard": shard, "block": block, "first_id": done, "n_ids": size, "first_doc": first_doc,
                "doc_ids": names, "doc_ends": ends, "resumed": resumed, "open": goes_on,
            }
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            return pa.RecordBatch.from_pylist([row | pack_block(ids, base, least)], schema=BLOCKS)

        for group in _groups(batches, encoder.blocks):
            coded = encoder.encode_many([part for *_, part, _, _ in group])
            for (shard, doc_id, _, opens, last), raw in zip(group, coded, strict=True):
                if last:
                    raw += end
                held.append(raw)
                size += len(raw) // 4
                if not opens and names:  # the document goes on in the same block
                    ends[-1] = size
                else:
                    names.append(doc_id)
                    ends.append(size)
                if size >= BLOCK_IDS:
                    yield flush(not last)
                    done, block, resumed = done + size, block + 1, not last
                    first_doc = number + last
                    held, size, names, ends = [], 0, [], []
                number += last
        if size:
            yield flush(False)

    return dealt.mapInArrow(shard_blocks, BLOCKS_DDL)


def _groups(batches: Iterator[pa.RecordBatch], cut: Callable[[str], list[str]]) -> Iterator[list[tuple]]:
    """Parts of documents (shard, doc_id, text, whether it is the first, the last), some megabytes at a time."""
    group, held = [], 0
    for batch in batches:
        for place, doc_id, text in zip(*batch.columns, strict=True):
            parts = cut(text.as_py() or "")
            for k, part in enumerate(parts):
                group.append((place.as_py(), doc_id.as_py(), part, k == 0, k + 1 == len(parts)))
                held += len(part)
                if held >= GROUP:
                    yield group
                    group, held = [], 0
    if group:
        yield group


def decode_documents(blocks: DataFrame, base: int) -> DataFrame:
    """A row for each document of each block: ``shard``, ``doc_no`` (place in the shard), ``block``,
    ``doc_id``, ``start`` (ids of the shard before it), ``n_tokens``, ``partial`` (the document lies in
    several blocks), ``ids_crc32``, and for partial ones the ``ids``. Blocks are decoded one by one."""
    kinds = [
        ("shard", pa.int32()), ("doc_no", pa.int64()), ("block", pa.int32()), ("doc_id", pa.int64()),
        ("start", pa.int64()), ("n_tokens", pa.int64()), ("partial", pa.bool_()), ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            grammar = load_block(row, base)
            raw = _repair.expand(grammar, grammar.symbols).astype("<u4").tobytes()
            ends = row["doc_ends"]
            starts, last = [0, *ends[:-1]], len(ends) - 1
            parts = [raw[4 * s : 4 * e] for s, e in zip(starts, ends, strict=True)]
            partial = [row["resumed"] and k == 0 or row["open"] and k == last for k in range(len(ends))]
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": [row["shard"]] * len(ends),
                    "doc_no": [row["first_doc"] + k for k in range(len(ends))],
                    "block": [row["block"]] * len(ends),
                    "doc_id": row["doc_ids"],
                    "start": [row["first_id"] + s for s in starts],
                    "n_tokens": [len(x) // 4 for x in parts],
                    "partial": partial,
                    "ids_crc32": [zlib.crc32(x) for x in parts],
                    "ids": [x if p else None for x, p in zip(parts, partial, strict=True)],
                },
                schema=pa.schema(kinds),
            )

    return blocks.mapInArrow(
        read,
        "shard int, doc_no long, block int, doc_id long, start long, n_tokens long, partial boolean, "
        "ids_crc32 long, ids binary",
    )


def _joined(rows: pa.Table) -> pa.Table:
    """One document from its parts."""
    rows = rows.sort_by("block")
    crc = 0
    for part in rows["ids"]:
        crc = zlib.crc32(part.as_py(), crc)
    first = rows.slice(0, 1).to_pylist()[0]
    total = sum(rows["n_tokens"].to_pylist())
    return pa.table(
        {
            "shard": pa.array([first["shard"]], pa.int32()), "doc_id": pa.array([first["doc_id"]], pa.int64()),
            "start": pa.array([first["start"]], pa.int64()), "n_tokens": pa.array([total], pa.int64()),
            "ids_crc32": pa.array([crc], pa.int64()),
        }
    )


def shard_starts(blocks: DataFrame) -> DataFrame:
    """Ids of all shards before each one; as many rows as the shuffle that dealt the shards had partitions."""
    rows = sorted((r.shard, r.n) for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())
    out, before = [], 0
    for shard, n in rows:
        out.append((shard, before))
        before += n
    return blocks.sparkSession.createDataFrame(out, "shard int, before long")


def digest(blocks: DataFrame, base: int) -> DataFrame:
    """Per document, as read back from the blocks: doc_id, start, n_tokens and the CRC-32 of its ids.

    Only documents that lie in several blocks (very long ones) are brought together, each on its own.
    """
    found = decode_documents(blocks, base)
    columns = ["shard", "doc_id", "start", "n_tokens", "ids_crc32"]
    # only blocks that a document runs out of or into are read a second time
    joined = (
        decode_documents(blocks.where("resumed or open"), base)
        .where("partial")
        .groupBy("shard", "doc_no")
        .applyInArrow(_joined, "shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    )
    rows = found.where("not partial").select(*columns).unionByName(joined)
    placed = rows.join(F.broadcast(shard_starts(blocks)), "shard")
    return placed.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def write(docs: DataFrame, tokenizer: str, end_id: int, base: int, **options) -> DataFrame:
    """Encode, write the files to the shared folder and give the blocks as read back."""
    return materialize(encode_blocks(docs, tokenizer, end_id, base, **options), "token-blocks")
