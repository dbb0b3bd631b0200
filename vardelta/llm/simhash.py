"""SimHash near-dedup by tiled exact comparison.

A fingerprint has bit b set if more than half of the document's shingle hashes have it. Distinct
fingerprints are sorted into tiles by the population counts of their two halves; since the counts of
fingerprints that differ in at most r bits differ by r at most in all, only such pairs of tiles are
compared. A pair of tiles is one group of bounded size: inside it rows are ordered by the counts of their
four quarters, pairs of blocks beyond the radius are skipped, the others are compared by exclusive-or
and bit count. What leaves a group is not its links but a spanning forest of them, so a dense group of
copies costs as many rows as it has members. Components are then found by hooking to the smallest
neighbour, with each round's edges written to the shared folder.

The comparison is exact, so its work grows with the square of the number of distinct fingerprints, over
the share of pairs that the population counts leave (5 % at radius 3).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vardelta.llm._shared import constant_array, materialize

#: Most and fewest fingerprints of a tile; between them a tile is a share of all fingerprints.
MOST_TILE, LEAST_TILE, TILE_SHARE = 1 << 17, 1 << 13, 12
BLOCK = 512
SEED = 42
SALTS = 16
#: Shingle hashes of a tile, about.
TILE_BYTES = 96 << 20
#: Words hashed at once, for bounded memory on very long texts.
STRETCH = 1 << 16


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint_bytes(raw: bytes, shingle: int) -> int:
    """Unsigned fingerprint of one text: words at ASCII white space, A-Z lower-cased, XXH64 of UTF-8 shingles."""
    import xxhash

    words = raw.lower().split()
    if not words:
        return 0
    total, counts = max(1, len(words) - shingle + 1), np.zeros(64, dtype=np.int64)
    for start in range(0, total, STRETCH):
        part = words[start : start + STRETCH + shingle - 1]
        runs = zip(*(part[k:] for k in range(shingle)), strict=False) if len(part) >= shingle else [part]
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(r), SEED) for r in runs), dtype=np.uint64)
        counts += _bit_counts(hashes)
    return int(sum(1 << b for b in np.flatnonzero(2 * counts > total).tolist()))


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """Fingerprint as a long (the unsigned bits); 0 for null and for texts without words."""

    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [fingerprint_bytes(t.as_py() or b"", shingle) for t in texts.cast(pa.binary())]
            yield pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    rows.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(rows, returnType="long")(text)


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _quarters(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def _forest(a: np.ndarray, b: np.ndarray, parent: np.ndarray) -> None:
    """Merge the ends of all edges (a, b) in ``parent`` (smallest index leads)."""
    while len(a):
        ra, rb = parent[a], parent[b]
        differ = ra != rb
        if not differ.any():
            return
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]


def linked_inside(prints: np.ndarray, side: np.ndarray, radii: tuple[int, ...]) -> np.ndarray:
    """For each row of ``prints`` (n, k) the index of the leader of its component.

    Rows of ``side`` 0 are compared with rows of side 1 (all with all if there is only one side); rows link if
    fingerprint i of both differs in at most ``radii[i]`` bits, for every i.
    """
    parent = np.arange(len(prints))
    for a, b in _near_pairs(prints, side, radii):
        _forest(a, b, parent)
    return parent


def alike_inside(
    prints: np.ndarray, side: np.ndarray, radii: tuple[int, ...], sets: list[bytes], least: float
) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs of rows that link as in :func:`linked_inside` and whose sets are alike.

    ``sets``: sorted unsigned 32-bit shingle hashes of each row; alike is a Jaccard similarity of ``least`` or more.
    Pairs that earlier links have joined are not compared.
    """
    parent, found = np.arange(len(prints)), []
    hashes = [np.frombuffer(x, dtype="<u4") for x in sets]
    sizes = np.fromiter(map(len, hashes), dtype=np.int64, count=len(hashes))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in _near_pairs(prints, side, radii):
        a, b = np.minimum(a, b), np.maximum(a, b)
        fits = (a != b) & (np.minimum(sizes[a], sizes[b]) >= least * np.maximum(sizes[a], sizes[b]))
        if not fits.any():
            continue
        a, b = np.unique(np.stack([a[fits], b[fits]]), axis=1)
        cuts = np.flatnonzero(np.r_[True, a[1:] != a[:-1], True])
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            one, root = a[start], find(a[start])
            others = np.array([x for x in b[start:stop].tolist() if find(x) != root], dtype=np.int64)
            if not len(others):
                continue
            common = _common(hashes[one], [hashes[x] for x in others.tolist()])
            for x in others[common >= least * (sizes[one] + sizes[others] - common)].tolist():
                low, high = sorted((find(one), find(x)))
                if low != high:
                    parent[high] = low
                    found.append((one, x))
    pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _common(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many members each of ``others`` has in common with ``one``; all are sorted sets."""
    ends = np.cumsum([0, *map(len, others)])
    if not len(one) or not ends[-1]:
        return np.zeros(len(others), dtype=np.int64)
    every = np.concatenate(others)
    at = np.searchsorted(one, every)
    hits = np.r_[0, np.cumsum(one[np.minimum(at, len(one) - 1)] == every)]
    return hits[ends[1:]] - hits[ends[:-1]]


def _near_pairs(
    prints: np.ndarray, side: np.ndarray, radii: tuple[int, ...]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    quarter = _quarters(np.ascontiguousarray(prints[:, 0]))
    parts = []
    for s in np.unique(side):
        rows = np.flatnonzero(side == s)
        rows = rows[np.lexsort(quarter[rows].T)]
        parts.append([rows[i : i + BLOCK] for i in range(0, len(rows), BLOCK)])
    left, right = (parts[0], parts[-1]) if len(parts) > 1 else (parts[0], parts[0])
    bounds = [[(quarter[r].min(axis=0), quarter[r].max(axis=0)) for r in p] for p in (left, right)]
    for i, rows in enumerate(left):
        low, high = bounds[0][i]
        for j in range(i if left is right else 0, len(right)):
            other_low, other_high = bounds[1][j]
            gap = np.maximum(0, np.maximum(low - other_high, other_low - high)).sum()
            if gap > radii[0]:
                continue
            yield _compare(prints, quarter, rows, right[j], radii)


def _compare(
    prints: np.ndarray, quarter: np.ndarray, rows: np.ndarray, others: np.ndarray, radii: tuple[int, ...]
) -> tuple[np.ndarray, np.ndarray]:
    first = np.ascontiguousarray(prints[rows, 0]), np.ascontiguousarray(prints[others, 0])
    near = np.bitwise_count(first[0][:, None] ^ first[1][None, :]) <= radii[0]
    a, b = np.nonzero(near)
    a, b = rows[a], others[b]
    for k in range(1, len(radii)):
        stays = np.bitwise_count(prints[a, k] ^ prints[b, k]) <= radii[k]
        a, b = a[stays], b[stays]
    return a, b


def band_steps(radius: int) -> tuple[int, list[tuple[int, int]]]:
    """Width of the bands of population counts, and the steps between bands that may hold links."""
    width = 2 if radius <= 4 else radius + 1
    gap = lambda step: (abs(step) - 1) * width + 1 if step else 0  # noqa: E731  least difference of the counts
    reach = range(-33, 34)
    return width, [(x, y) for x in reach for y in reach if gap(x) + gap(y) <= radius]


def tile_links(
    prints: DataFrame, columns: list[str], radii: tuple[int, ...], tile: int | None = None, ends: bool = False,
    sets: str | None = None, least: float = 0.0,
) -> DataFrame:
    """Edges (``u``, ``v``) between values of ``id``: a spanning forest of the links of each pair of tiles.

    With ``ends``, rows that have any link instead, each as an edge to itself. With ``sets`` (a column of sorted
    shingle hashes) only links whose sets are alike by ``least`` count (:func:`alike_inside`).
    ``prints``: distinct rows of ``id`` (long) and fingerprints. Tiles are bands of the population counts of
    both halves of the first fingerprint, cut by hash into pieces. What reaches the driver: one count for
    each band, 17 * 17 at most.
    """
    first = columns[0]
    width, steps = band_steps(radii[0])
    across = 32 // width + 1
    high = F.bit_count(F.shiftrightunsigned(first, 32))
    low = F.bit_count(F.col(first).bitwiseAND(F.lit(0xFFFFFFFF)))
    placed = prints.withColumn("__hi", high).withColumn("__lo", low)
    placed = placed.withColumn("cell", F.expr(f"cast(__hi div {width} * {across} + __lo div {width} as int)"))
    sizes = {r.cell: r["count"] for r in placed.groupBy("cell").count().collect()}
    most = tile or min(MOST_TILE, max(LEAST_TILE, -(-sum(sizes.values()) // TILE_SHARE)))
    pieces = constant_array([-(-sizes.get(c, 0) // most) for c in range(across * across)], "int")
    offsets = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in steps])
    own = F.concat_ws(".", F.lpad(F.col("cell").cast("string"), 4, "0"), F.lpad(F.col("piece").cast("string"), 6, "0"))

    def neighbours(step: Column) -> Column:
        x, y = F.expr(f"cast(cell div {across} as int)") + step["x"], F.expr(f"cell % {across}") + step["y"]
        inside = (x >= 0) & (x < across) & (y >= 0) & (y < across)
        cell = F.when(inside, x * across + y)
        count = F.coalesce(F.get(pieces, cell), F.lit(0))
        return F.transform(
            F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")),
            lambda p: F.concat_ws(
                ".", F.lpad(cell.cast("string"), 4, "0"), F.lpad(p.cast("string"), 6, "0")
            ),
        )

    cut = placed.withColumn("piece", F.pmod(F.xxhash64("id"), F.get(pieces, F.col("cell"))).cast("int"))
    dealt = (
        cut.withColumn("own", own)
        .withColumn("other", F.explode(F.flatten(F.transform(offsets, neighbours))))
        .withColumn("pair", F.concat_ws("-", F.least("own", "other"), F.greatest("own", "other")))
        .withColumn("side", (F.col("own") > F.col("other")).cast("int"))
        .select("pair", "side", "id", *columns, *([sets] if sets else []))
    )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        name = rows["pair"].iloc[0].split("-")
        side = rows["side"].to_numpy()
        if name[0] != name[1] and side.min() == side.max():  # the other tile turned out empty
            return pd.DataFrame({"u": [], "v": []}).astype("int64")
        ids = rows["id"].to_numpy()
        values = np.stack([rows[c].to_numpy().view(np.uint64) for c in columns], axis=1)
        if sets:
            a, b = alike_inside(values, side, radii, rows[sets].tolist(), least)
            return pd.DataFrame({"u": ids[a], "v": ids[b]})
        if ends:
            linked = np.zeros(len(ids), dtype=bool)
            for a, b in _near_pairs(values, side, radii):
                apart = a != b
                linked[a[apart]], linked[b[apart]] = True, True
            return pd.DataFrame({"u": ids[linked], "v": ids[linked]})
        leader = linked_inside(values, side, radii)
        moved = leader != np.arange(len(ids))
        return pd.DataFrame({"u": ids[leader[moved]], "v": ids[moved]})

    return dealt.groupBy("pair").applyInPandas(compare, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(``id``, ``root``): the smallest id that each end of an edge reaches.

    Alternating large-star and small-star steps; each round is two grouped minima and joins on the
    edges that are left, written to the shared folder, until nothing changes.
    """
    now = materialize(edges.select(F.greatest("u", "v").alias("v"), F.least("u", "v").alias("u")).distinct(), "edges")
    while True:
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).union(now.select("v", "u"))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(down, "v")
        small = small.select("v", F.col("m").alias("u")).union(small.select(F.col("u").alias("v"), F.col("m").alias("u")))
        after = materialize(small.where("u <> v").distinct(), "edges")
        stars = after.groupBy("v").agg(F.count("*").alias("n"), F.min("u").alias("u"))
        hubs = after.select("u").distinct().join(after.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        if stars.where("n > 1").isEmpty() and hubs.isEmpty():
            return after.select(F.col("v").alias("id"), F.col("u").alias("root"))
        now = after


def fingerprints(docs: DataFrame, shingles: tuple[int, ...], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp0, fp1, ...), one row for each row of ``docs``; written, as it is read several times."""
    found = [fingerprint(F.col(text), n).alias(f"fp{k}") for k, n in enumerate(shingles)]
    return materialize(docs.select(F.col(key).alias("doc_id"), *found), "fingerprints")


def groups(
    docs: DataFrame, shingles: tuple[int, ...] = (3,), radii: tuple[int, ...] = (3,), key: str = "doc_id",
    text: str = "text", tile: int | None = None,
) -> DataFrame:
    """(doc_id, fp0, ..., component_id): the smallest doc_id that links of the fingerprints reach.

    Rows with equal fingerprints count as one until the end, so copies, and texts without words (their
    fingerprint is 0), cost nothing in the comparison. A null doc_id never names a component unless it has
    no other; repeated doc_ids are rows of their own. An empty table gives no rows.
    """
    columns = [f"fp{k}" for k in range(len(shingles))]
    prints = fingerprints(docs, shingles, key, text)
    same = [F.col(f"__{c}") == F.col(c) for c in columns]
    code = F.col("fp0") if len(columns) == 1 else F.xxhash64(*columns)
    # equal codes of different fingerprints are as good as impossible and would only join two groups
    distinct = materialize(
        prints.groupBy(*columns).agg(F.min("doc_id").alias("least")).withColumn("id", code), "distinct-fingerprints"
    )
    linked = components(tile_links(distinct.select("id", *columns), columns, radii, tile))
    named = distinct.join(linked, "id", "left").withColumn("root", F.coalesce("root", "id"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    # one component may hold a large share of all fingerprints: its name is joined by salted keys
    salted = named.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    spread = names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = salted.join(spread, ["root", "salt"]).select(*[F.col(c).alias(f"__{c}") for c in columns], "component_id")
    on = same[0]
    for extra in same[1:]:
        on = on & extra
    return prints.join(placed, on, "left").select("doc_id", *columns, "component_id")


def shingle_set(raw: bytes, shingle: int) -> set[bytes]:
    """Distinct shingles of a text, by the words that :func:`fingerprint_bytes` takes."""
    words = raw.lower().split()
    if not words:
        return set()
    return {b" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))}


def shingle_hashes(text: Column, shingle: int) -> Column:
    """Sorted unsigned 32-bit hashes of a text's distinct shingles, as bytes."""

    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import xxhash

        for texts in batches:
            out = []
            for t in texts.cast(pa.binary()):
                found = {xxhash.xxh32_intdigest(s, SEED) for s in shingle_set(t.as_py() or b"", shingle)}
                out.append(np.array(sorted(found), dtype="<u4").tobytes())
            yield pa.array(out, type=pa.binary())

    rows.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(rows, returnType="binary")(text)


def verified_groups(
    docs: DataFrame, shingles: tuple[int, ...], radii: tuple[int, ...], least: float, key: str = "doc_id",
    text: str = "text", tile: int | None = None,
) -> DataFrame:
    """(doc_id, id, root, component_id) over links of the fingerprints whose texts are alike by ``least`` or more.

    ``id`` is the hash of the row's text and ``root`` that of its group, ``component_id`` the group's smallest doc_id.

    The similarity is taken over all shingles of the last length, by 32-bit hashes, and between distinct texts. A first
    pass over the tiles only names the texts that have a candidate at all; a second one brings the shingles of
    these into the tiles, where each candidate is verified. So pairs never leave a tile unless they link.
    """
    columns = [f"fp{k}" for k in range(len(shingles))]
    own = text_hash(text)
    found = [fingerprint(F.col(text), n).alias(c) for n, c in zip(shingles, columns, strict=True)]
    prints = materialize(docs.select(F.col(key).alias("doc_id"), own.alias("id"), *found), "fingerprints")
    distinct = materialize(prints.groupBy("id", *columns).agg(F.min("doc_id").alias("least")), "distinct-texts")
    texts = docs.select(own.alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ends = materialize(tile_links(distinct.select("id", *columns), columns, radii, tile, ends=True).select("u").distinct(), "ends")
    some = texts.join(ends.withColumnRenamed("u", "id"), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    some = some.select("id", shingle_hashes(F.col("text"), shingles[-1]).alias("shingles"))
    near = materialize(distinct.drop("least").join(some, "id"), "near-texts")
    size = near.agg(F.avg(F.octet_length("shingles"))).first()[0] or 1.0
    fitting = tile or int(max(LEAST_TILE // 8, min(MOST_TILE, TILE_BYTES / size)))
    linked = components(tile_links(near, columns, radii, fitting, sets="shingles", least=least))
    named = distinct.select("id", "least").join(linked, "id", "left").withColumn("root", F.coalesce("root", "id"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    salted = named.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    spread = names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = salted.join(spread, ["root", "salt"]).select("id", "root", "component_id")
    return prints.join(placed, "id", "left").select("doc_id", "id", "root", "component_id")


def keep_one(
    docs: DataFrame, shingles: tuple[int, ...], radii: tuple[int, ...], least: float, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of each group (:func:`verified_groups`), with the columns of ``docs``: that with the smallest doc_id.

    A null doc_id is the last choice. Of rows of a group that share the doc_id the one stays whose text has the
    smallest hash, and of rows that share both any one. An empty table stays empty.
    """
    return one_of_each(docs, verified_groups(docs, shingles, radii, least, key, text), key, text)


def text_hash(text: str) -> Column:
    """By which rows of equal texts are known; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def one_of_each(docs: DataFrame, grouped: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, as :func:`keep_one` says. ``grouped``: doc_id, id (:func:`text_hash`) and root of every row of ``docs``."""
    found = materialize(grouped.select("doc_id", "id", "root"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "id")).alias("m")
    leaders = found.groupBy("root").agg(first).select(F.col("m.doc_id").alias("__keep"), F.col("m.id").alias("__id"))
    own = text_hash(text)
    on = F.col(key).eqNullSafe(F.col("__keep")) & (own == F.col("__id"))
    kept = docs.join(leaders, on, "left_semi")
    same = found.groupBy("doc_id", "id").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    doubled = same.join(leaders, F.col("doc_id").eqNullSafe(F.col("__keep")) & (F.col("id") == F.col("__id")), "left_semi")
    if doubled.isEmpty():
        return kept
    again = F.col(key).eqNullSafe(F.col("doc_id_")) & (own == F.col("id_"))
    twice = doubled.select(F.col("doc_id").alias("doc_id_"), F.col("id").alias("id_"))
    one_each = kept.join(twice, again, "left_semi").withColumn("__own", own).dropDuplicates([key, "__own"]).drop("__own")
    return kept.join(twice, again, "left_anti").unionByName(one_each)
