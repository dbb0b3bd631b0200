"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0 to n - 1 in doc_id order, the number goes through a keyed permutation of 0 to n - 1,
and the permuted number gives shard (remainder) and slot (quotient). So the shuffle is reproducible, shard
sizes differ by one at most, and place and row can be computed from each other without any table.

Numbering without one global sort: rows are dealt by ranges of (key, tie, a mix of the row's place in the
input), so that no doc_id, null or copy fills a task, sorted inside a range, and written with their place in
it. Counts of the ranges, one for each partition, then give every range its first number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vardelta.llm._shared import constant_array, materialize, shuffle_partitions, without

ROUNDS = 6
MASK = (1 << 32) - 1
#: Fixed values of the round function: a multiply-and-shift mix of 32-bit words.
MIX_A, MIX_B, KEY_STEP = 0x85EBCA6B, 0xC2B2AE35, 0x9E3779B9


def half_bits(n: int) -> int:
    """Bits of each half of the smallest even-width domain that holds 0 to n - 1."""
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def _mix(half: np.ndarray, key: int) -> np.ndarray:
    m = np.uint64(MASK)
    x = (half ^ np.uint64(key)) & m
    x = (x * np.uint64(MIX_A)) & m
    x ^= x >> np.uint64(13)
    x = (x * np.uint64(MIX_B)) & m
    return x ^ (x >> np.uint64(16))


def round_keys(seed: int) -> list[int]:
    return [((seed + 1) * KEY_STEP * (k + 1) + k) & MASK for k in range(ROUNDS)]


def _once(x: np.ndarray, n: int, keys: list[int], forward: bool) -> np.ndarray:
    bits = np.uint64(half_bits(n))
    low = np.uint64((1 << int(bits)) - 1)
    left, right = x >> bits, x & low
    for key in keys if forward else reversed(keys):
        if forward:
            left, right = right, left ^ (_mix(right, key) & low)
        else:
            left, right = right ^ (_mix(left, key) & low), left
    return (left << bits) | right


def permute(rows: np.ndarray, n: int, seed: int, forward: bool = True) -> np.ndarray:
    """The permutation of 0 to n - 1 (or its inverse) at ``rows``.

    Values that leave the range are sent through again (cycle walking) until all are inside; the domain
    is less than four times n, so few rounds are needed and each ends.
    """
    keys = round_keys(seed)
    out = _once(np.asarray(rows, dtype=np.uint64), n, keys, forward)
    while len(outside := np.flatnonzero(out >= n)):
        out[outside] = _once(out[outside], n, keys, forward)
    return out.astype(np.int64)


def place_of(row: int, n: int, shards: int, seed: int) -> tuple[int, int]:
    """Shard and slot of a row number."""
    at = int(permute(np.array([row]), n, seed)[0])
    return at % shards, at // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """The row number at a place."""
    return int(permute(np.array([slot * shards + shard]), n, seed, forward=False)[0])


def numbered(df: DataFrame, key: str, tie: Column, name: str, ranges: int | None = None) -> tuple[DataFrame, int]:
    """``df`` with row numbers from 0 by ascending ``key`` (nulls first), then ``tie``; and the row count.

    ``key`` may be of any type that sorts. Rows with the same key and tie get their numbers in any order. What
    reaches the driver: the count of each range, as many as there are shuffle partitions.
    """
    parts = ranges or shuffle_partitions(df.sparkSession)
    held = df.withColumn("__t", tie).withColumn("__m", F.xxhash64(F.monotonically_increasing_id()))
    order = [F.col(key).asc_nulls_first(), F.col("__t").asc_nulls_first(), F.col("__m").asc()]
    # the number that Spark gives a row of a partition: the partition's above 33 bits for the row's place
    placed = (
        held.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .drop("__t", "__m")
        .withColumn("__p", F.monotonically_increasing_id())
    )
    written = materialize(placed, "numbered")
    part = F.shiftright("__p", 33)
    counts = sorted((r.p, r["count"]) for r in written.groupBy(part.alias("p")).count().collect())
    firsts, total = {}, 0
    for p, n in counts:
        firsts[p] = total
        total += n
    before = constant_array([firsts.get(p, 0) for p in range(max(firsts, default=0) + 1)], "bigint")
    number = F.get(before, part.cast("int")) + F.col("__p").bitwiseAND((1 << 33) - 1)
    return written.withColumn(name, number).drop("__p"), total


def assign(docs: DataFrame, shards: int, seed: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with ``row_no``, ``shard`` and ``slot``.

    Null doc_ids are numbered first; rows with equal doc_ids are ordered by a hash of their text (a null
    text counts as empty), equal rows in any order. Copies of a text are dealt like any other rows. An
    empty table stays empty; input columns with the new names are replaced.
    """
    base = without(docs, "row_no", "shard", "slot", "__p", "__t", "__m")
    rows, total = numbered(base, key, F.xxhash64(F.coalesce(F.col(text), F.lit(""))), "row_no")

    def permuted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for numbers in batches:
            yield pd.Series(permute(numbers.to_numpy(), total, seed))

    permuted.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    moved = rows.withColumn("__p", F.pandas_udf(permuted, "long")("row_no"))
    return (
        moved.withColumn("shard", F.pmod("__p", F.lit(shards)).cast("int"))
        .withColumn("slot", F.expr(f"__p div {int(shards)}"))
        .drop("__p")
    )
