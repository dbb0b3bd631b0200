"""Benchmark decontamination by a prefix-filtered set join.

Items are cut into windows, a window is a set of word shingles, and a document contains a window if
some stretch of the same number of words holds (enough of) its shingles. Containing at least ``c`` of
``k`` shingles means sharing one of any ``k - c + 1`` of them, so only that many, the rarest in the corpus,
are joined (the prefix). A shared shingle fixes where the stretch would start; positional and length
bounds discard starts outside the document, and what is left is verified word for word.

Built-in functions only. The corpus is read once: each document is reduced to the positions whose
shingle hash falls into a bit table of the items' shingles (at most 1 MB), with the words around
them, and these candidates are written to the shared folder. Rarity counts, join and verification run on
that table; where a phrase is so common that its join partition is large, Spark's skew join splits it. Documents are never grouped by shingle; a passage that many documents share only gives each
of them its own few rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vardelta.llm._shared import ascii_lower, constant_array, materialize

#: Characters that separate words: ASCII other than digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Size of the bit table: about so many bits a shingle, a power of two between the two bounds.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 23


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words; none for null."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.filter(parts, lambda w: w != F.lit(""))


def shingle_hashes(words: Column, length: int) -> Column:
    """Hash of each run of ``length`` words, by its position."""
    count = F.size(words) - F.lit(length - 1)
    return F.transform(
        F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.lit(length), *[F.get(words, i + k) for k in range(length)]),
    )


def item_windows(items: DataFrame, window: int, shingle: int, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows: ``item_id``, ``words``, ``n`` and their shingles (``length``, offset and hash)."""
    worded = items.select(F.col(item).cast("string").alias("item_id"), words_of(F.col(text)).alias("w")).where(
        F.size("w") > 0
    )
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    cut = worded.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s + 1, window))).alias("words"))
    distinct = cut.distinct().withColumn("n", F.size("words"))
    hashes = F.lit(None)
    for length in range(shingle, 0, -1):
        hashes = F.when(F.least(F.col("n"), F.lit(shingle)) == length, shingle_hashes(F.col("words"), length)).otherwise(
            hashes.cast("array<bigint>")
        )
    return distinct.withColumn("length", F.least(F.col("n"), F.lit(shingle))).withColumn("hashes", hashes)


def _bits(h: Column, bits: int) -> tuple[Column, Column]:
    """The two bits of a hash: from its low and from its high end."""
    return F.pmod(h, F.lit(bits)).cast("int"), F.pmod(F.shiftright(h, 32), F.lit(bits)).cast("int")


def table_bits(shingles: int) -> int:
    """Size of the bit table for so many shingles."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * shingles - 1).bit_length()))


def bit_table(hashes: DataFrame, bits: int) -> list[int]:
    """The bits of column ``h`` as 64-bit words, ``bits / 64`` of them whatever the number of hashes."""
    words = (
        hashes.select(F.explode(F.array(*_bits(F.col("h"), bits))).alias("b"))
        .distinct()
        .groupBy(F.shiftright("b", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, b & 63)")).alias("bits"))
    )
    table = [0] * (bits // 64)
    for row in words.collect():
        table[row.word] = row.bits
    return table


def candidates(docs: DataFrame, windows: DataFrame, window: int) -> DataFrame:
    """``doc_id``, a key of the row, ``n_words``, and ``found``: (length, position, hash, words around)."""
    lengths = sorted(r.length for r in windows.select("length").distinct().collect())
    shingles = windows.select(F.explode("hashes").alias("h"))
    bits = table_bits(shingles.count())
    table = constant_array(bit_table(shingles, bits), "bigint")
    rows = docs.select(
        "doc_id", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("row_key"), words_of(F.col("text")).alias("w")
    )
    def seen(h: Column) -> Column:
        low, high = (
            F.call_function("bit_get", F.get(table, F.shiftright(b, 6)), b.bitwiseAND(63)) == 1 for b in _bits(h, bits)
        )
        return low & high

    def near(length: int) -> Column:
        marked = F.transform(
            shingle_hashes(F.col("w"), length), lambda h, i: F.when(seen(h), F.struct(i.alias("at"), h.alias("h")))
        )
        back = window - length

        def with_words(x: Column) -> Column:
            first = F.greatest(x["at"] - back, F.lit(0))
            return F.struct(
                F.lit(length).alias("length"), x["at"].alias("at"), x["h"].alias("h"), first.alias("first"),
                F.slice(F.col("w"), first + 1, F.lit(2 * window - length)).alias("around"),
            )

        return F.transform(F.filter(marked, lambda x: x.isNotNull()), with_words)

    none = F.array().cast("array<struct<length:int,at:int,h:bigint,first:int,around:array<string>>>")
    found = [none, *map(near, lengths)]
    return rows.select("doc_id", "row_key", F.size("w").alias("n_words"), F.concat(*found).alias("found"))


def prefixes(windows: DataFrame, hits: DataFrame, share: float) -> DataFrame:
    """The shingles of each window to join by: its ``k - c + 1`` rarest, ties by offset."""
    frequency = hits.groupBy("h").agg(F.count("*").alias("df"))
    shingles = windows.select(
        "item_id", "words", "n", "length", "hashes", F.posexplode("hashes").alias("offset", "h")
    ).join(frequency, "h", "left")
    order = Window.partitionBy("item_id", "words").orderBy(F.coalesce("df", F.lit(0)), "offset")
    ranked = shingles.withColumn("rank", F.row_number().over(order))
    k = F.size("hashes")
    needed = F.ceil(F.lit(float(share)) * k)
    return ranked.where((F.col("rank") <= k - needed + 1) & F.col("df").isNotNull()).drop("rank", "df")


def occurrences(found: DataFrame, windows: DataFrame, share: float) -> DataFrame:
    """Verified stretches: ``doc_id``, ``row_key``, ``item_id``, ``start`` and ``n``, each once."""
    hits = found.select("doc_id", "row_key", "n_words", F.explode("found").alias("f")).select(
        "doc_id", "row_key", "n_words", "f.*"
    )
    chosen = prefixes(windows, hits.select("h"), share)
    chosen_lengths = windows.select("length").distinct().collect()  # from 1 to the shingle length at most
    joined = hits.join(chosen.withColumnRenamed("length", "item_length"), "h").where(
        F.col("length") == F.col("item_length")
    )
    start = F.col("at") - F.col("offset")
    placed = joined.withColumn("start", start).where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
    stretch = F.slice("around", F.col("start") - F.col("first") + 1, F.col("n"))
    if share >= 1.0:
        holds = stretch == F.col("words")
    else:
        own = F.lit(None).cast("array<bigint>")
        for (length,) in chosen_lengths:
            own = F.when(F.col("length") == length, shingle_hashes(F.col("stretch"), length)).otherwise(own)
        placed = placed.withColumn("stretch", stretch)
        holds = F.size(F.array_intersect(own, F.col("hashes"))) >= F.ceil(
            F.lit(float(share)) * F.size(F.array_distinct("hashes"))
        )
    return placed.where(holds).select("doc_id", "row_key", "item_id", "start", "n").distinct()


def contamination(
    docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5, share: float = 1.0
) -> DataFrame:
    """A row for each document: words, words inside occurrences, items found.

    ``docs`` has doc_id and text, ``items`` item_id and text. A window is ``window`` words of an item, or
    the whole of a shorter one; an item without words has none. With ``share`` below 1 a stretch need hold
    only that share of a window's shingles. Null texts have no words. Rows are told apart by doc_id and
    text, so repeated doc_ids with different texts keep their own results, and equal rows get equal ones.
    """
    windows = materialize(item_windows(items, window, shingle), "item-windows")
    # a bit table has room for so many shingles; a larger benchmark is searched for part by part
    total = windows.agg(F.sum(F.size("hashes"))).first()[0] or 0
    passes = max(1, -(-total * BITS_EACH // MOST_BITS))
    parts = [windows.where(F.pmod(F.xxhash64("words"), F.lit(passes)) == k) for k in range(passes)]
    each = [materialize(candidates(docs, part, window), "item-candidates") for part in parts]
    found = each[0]
    hits = occurrences(functools.reduce(DataFrame.unionByName, each), windows, share)
    spans = hits.groupBy("doc_id", "row_key", "start").agg(F.max(F.col("start") + F.col("n")).alias("stop"))
    before = (
        Window.partitionBy("doc_id", "row_key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    )
    covered = (
        spans.withColumn("reach", F.coalesce(F.max("stop").over(before), F.lit(0)))
        .groupBy("doc_id", "row_key")
        .agg(F.sum(F.greatest(F.col("stop") - F.greatest("start", "reach"), F.lit(0))).alias("n_hit"))
    )
    named = (
        hits.select("doc_id", "row_key", "item_id")
        .distinct()
        .groupBy("doc_id", "row_key")
        .agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    )
    per_doc = covered.join(
        named, covered["doc_id"].eqNullSafe(named["doc_id"]) & (covered["row_key"] == named["row_key"])
    ).select(covered["doc_id"].alias("__d"), covered["row_key"].alias("__k"), "n_hit", "items")
    out = found.select("doc_id", "row_key", "n_words").join(
        per_doc, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("row_key") == F.col("__k")), "left"
    )
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id",
        "row_key",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce(F.col("n_hit").cast("long"), F.lit(0).cast("long")).alias("n_hit"),
        listed.alias("items"),
    )


def remove_contaminated(
    docs: DataFrame, items: DataFrame, most_share: float = 0.0, window: int = 10, shingle: int = 5
) -> DataFrame:
    """The rows of ``docs`` of whose words at most ``most_share`` lie inside benchmark windows."""
    marks = contamination(docs, items, window, shingle).where(
        F.col("n_hit") > F.lit(float(most_share)) * F.col("n_words")
    )
    gone = marks.select(F.col("doc_id").alias("__d"), F.col("row_key").alias("__k")).distinct()
    keyed = docs.withColumn("__own", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    kept = keyed.join(gone, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("__own") == F.col("__k")), "left_anti")
    return kept.drop("__own")
