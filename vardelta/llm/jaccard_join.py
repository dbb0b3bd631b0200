"""Exact n-gram Jaccard join by rare-first prefixes.

Two sets that are alike by 80 % share one of their rarest fifth. So each text's shingles are put into one global order,
rarest first, and only texts that meet in a shingle of their prefixes are looked at again. Length and
position in the order bound the overlap a pair can still have; pairs that stay are verified once, from the first
shingle they share: their signs first (parities, which bound how far the sets differ), a suffix filter then (both rests
are split at the same places, the overlap is no more than the smaller halves together), and the intersection last.

How the rarity is known without a row for every shingle:

1. A task turns a stretch of texts (a million shingles, copies left out) into a message for each bucket of
   the hash space: the hashes and the number of the text in its stretch. A shingle that many texts of the
   stretch share is sent once, with its count.
2. A bucket counts in how many texts a shingle is, and answers each stretch for those in two or more. Others can
   make no link; they only stand at the head of their text's order.
3. A stretch puts its answers together. Texts whose prefix has only shingles of their own are done.

Groups of copies count as one text. In a large group of near copies the texts of a shingle are first paired with one of
them only, another one in each round, which joins nearly all. Then texts that are still apart are compared, all of
them, so no link is lost: one by one where the groups are small, and with a wide group as a whole, which ends at the
first link. No group is paired with itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vardelta.llm._shared import materialize
from vardelta.llm.simhash import SALTS, SEED, components, one_of_each, text_hash

#: Words whose hashes a task remembers.
REMEMBERED = 1 << 19
#: Bits of a shingle's hash that a message keeps, and that the order keeps below the class of its rarity.
SENT_BITS, TOKEN_BITS = np.uint64(48), np.uint64(56)
LOW = (np.uint64(1) << TOKEN_BITS) - np.uint64(1)
#: Odd multipliers that mix hashes.
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Rounds of stars at most, and texts that a round takes as their middles in tokens of the same texts.
ROUNDS, HUBS = 4, 4
#: A largest group of a token of at least so many texts is met as a whole, in parts of about so many bytes of sets.
WIDE, TILE_BYTES = 32, 16 << 20
#: Longs of a text's sign: a bit for each class of its shared shingles, set if it has an odd number of them.
SIGN_LONGS = 8
#: Places at which a suffix is split for its filter.
SPLITS = 16


@dataclass(frozen=True)
class Sizes:
    """What bounds the memory of a task; results do not depend on it.

    ``stretch`` and ``bucket`` are shingles, about; ``rows`` the most rows of a stretch, whose texts are numbered in 16 bits. A
    shingle in more than ``hot`` texts of a stretch is sent as a count.
    """

    stretch: int = 1 << 20
    bucket: int = 3 << 19
    rows: int = 60_000
    hot: int = 32


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value


def shingle_hashes(words: list[bytes], shingle: int, known: dict[bytes, int]) -> np.ndarray:
    """Distinct hashes of the runs of ``shingle`` words; of fewer words, one hash of them all."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    length = min(shingle, len(words))
    runs = len(words) - length + 1
    out = np.full(runs, length, np.uint64)
    for k in range(length):
        out = (out ^ (out >> np.uint64(29))) * MIX_A + hashes[k : k + runs]
    out = (out ^ (out >> np.uint64(32))) * MIX_B
    return np.unique(out ^ (out >> np.uint64(31)))


def tokens_of(sent: np.ndarray, bucket: np.ndarray | int, buckets: int) -> np.ndarray:
    """What a shingle is known by, from what was sent of its hash and its bucket."""
    return (sent * np.uint64(buckets) + np.uint64(bucket)) & LOW


def _planes(values: np.ndarray) -> bytes:
    """48-bit numbers as their low 32 and then their high 16 bits."""
    return values.astype(np.uint32).tobytes() + (values >> np.uint64(32)).astype(np.uint16).tobytes()


def _numbers(raw: bytes) -> np.ndarray:
    n = len(raw) // 6
    low, high = np.frombuffer(raw, np.uint32, n), np.frombuffer(raw, np.uint16, n, 4 * n)
    return low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)


def _messages(id_type: pa.DataType) -> pa.Schema:
    return pa.schema(
        [
            ("bucket", pa.int64()), ("stretch", pa.int64()),
            # to a bucket: texts and hashes, shared hashes and counts, texts and their names
            ("docs", pa.binary()), ("sent", pa.binary()), ("hot", pa.binary()), ("counts", pa.binary()),
            ("named", pa.binary()), ("names", pa.binary()),
            # from a stretch to itself
            ("ids", pa.list_(id_type)), ("nodes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
        ]
    )


class _Stretch:
    """Texts of a task that are turned into messages together."""

    def __init__(self) -> None:
        self.ids: list = []
        self.nodes: list[int | None] = []
        self.sizes: list[int] = []
        self.order: dict[int, int] = {}
        self.sets: list[np.ndarray] = []
        self.shingles = 0

    def add(self, doc_id, node: int | None, size: int) -> bool:
        """Whether the text is a new one, whose set is wanted."""
        self.ids.append(doc_id)
        self.nodes.append(node)
        self.sizes.append(size)
        if node is None or node in self.order:
            return False
        self.order[node] = len(self.order)
        return True

    def messages(self, stretch: int, buckets: int, most: int) -> Iterator[dict]:
        hashes = np.concatenate(self.sets) if self.sets else np.zeros(0, np.uint64)
        docs = np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets]).astype(np.uint16)
        names = np.array(list(self.order), dtype=np.int64).view(np.uint64)
        b = np.uint64(buckets)
        distinct, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        cold = counts[inverse] <= most
        hot_docs, hot_own = docs[~cold], hashes[~cold]
        own = np.argsort(hot_own, kind="stable")
        yield {
            "bucket": -1 - stretch, "stretch": stretch, "ids": self.ids, "nodes": self.nodes, "sizes": self.sizes,
            "docs": hot_docs[own].tobytes(), "sent": hot_own[own].tobytes(),
        }
        parts = []
        for values, also in (
            (hashes[cold], docs[cold]),
            (distinct[counts > most], counts[counts > most].astype(np.uint32)),
            (names, np.arange(len(names), dtype=np.uint16)),
        ):
            bucket = (values % b).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            parts.append((bucket[order], values[order], also[order]))
        used = np.unique(np.concatenate([p[0] for p in parts]))
        at = [(np.searchsorted(p[0], used), np.searchsorted(p[0], used, side="right")) for p in parts]
        for k, bucket in enumerate(used.tolist()):
            (cold_h, cold_d), (hot_h, hot_n), (name_h, name_d) = (
                (p[1][x[0][k] : x[1][k]], p[2][x[0][k] : x[1][k]]) for p, x in zip(parts, at, strict=True)
            )
            mask = (np.uint64(1) << SENT_BITS) - np.uint64(1)
            yield {
                "bucket": bucket, "stretch": stretch, "docs": cold_d.tobytes(), "sent": _planes(cold_h // b & mask),
                "hot": _planes(hot_h // b & mask), "counts": hot_n.tobytes(), "named": name_d.tobytes(), "names": name_h.tobytes(),
            }


def _asks(shingle: int, buckets: int, sizes: Sizes, schema: pa.Schema):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        stretch = TaskContext.get().partitionId() << 24
        known, now = _WordHashes(), _Stretch()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(list(now.messages(stretch, buckets, sizes.hot)), schema)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()), strict=True):
                words = (text.as_py() or b"").lower().split()
                node = xxhash.xxh64_intdigest(b" ".join(words), SEED) if words else None
                node = node - (1 << 64) if node is not None and node >> 63 else node
                copy = node in now.order
                found = now.sets[now.order[node]] if copy else shingle_hashes(words, shingle, known)
                if now.add(doc_id, node, len(found)):
                    now.sets.append(found)
                    now.shingles += len(found)
                if now.shingles >= sizes.stretch or len(now.ids) >= sizes.rows:
                    yield flush()
                    stretch, now = stretch + 1, _Stretch()
        if now.ids:
            yield flush()

    return rows


def rarity(texts: np.ndarray) -> np.ndarray:
    """Class of a number of texts, from 16 for two to 255: what the order sorts by first."""
    return np.minimum(255, np.floor(16 * np.log2(texts))).astype(np.uint64)


def _answers(buckets: int, schema: pa.Schema):
    def rows(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        if bucket < 0:
            return table.select(schema.names)
        messages = sorted(table.to_pylist(), key=lambda m: m["stretch"])
        cold, hot = [_numbers(m["sent"]) for m in messages], [_numbers(m["hot"]) for m in messages]
        weights = [np.ones(len(c), np.int64) for c in cold] + [np.frombuffer(m["counts"], np.uint32) for m in messages]
        distinct, inverse = np.unique(np.concatenate(cold + hot), return_inverse=True)
        texts = np.bincount(inverse, np.concatenate(weights), len(distinct))[inverse]
        names = [np.frombuffer(m["names"], np.uint64) for m in messages]
        first = np.zeros(sum(map(len, names)), bool)
        first[np.unique(np.concatenate(names), return_index=True)[1]] = True
        out, at, hot_at, name_at = [], 0, sum(map(len, cold)), 0

        def keys(sent: np.ndarray, n: np.ndarray) -> np.ndarray:
            return rarity(n) << TOKEN_BITS | tokens_of(sent, bucket, buckets)

        for m, c, h, named in zip(messages, cold, hot, names, strict=True):
            n, hot_n = texts[at : at + len(c)], texts[hot_at : hot_at + len(h)]
            copies = ~first[name_at : name_at + len(named)]
            at, hot_at, name_at = at + len(c), hot_at + len(h), name_at + len(named)
            shared = n >= 2
            row = {
                "stretch": m["stretch"],
                "docs": np.frombuffer(m["docs"], np.uint16)[shared].tobytes(), "sent": keys(c[shared], n[shared]).tobytes(),
                "hot": keys(h, hot_n).tobytes(), "named": np.frombuffer(m["named"], np.uint16)[copies].tobytes(),
            }
            if row["docs"] or row["hot"] or row["named"]:
                out.append(row)
        return pa.Table.from_pylist(out, schema)

    return rows


def least_overlap(size, percent: int):
    """Shingles that two sets of ``size`` shingles together must share."""
    return (size * percent + 99 + percent) // (100 + percent)


def _needed(a: str, b: str, percent: int) -> Column:
    return F.expr(f"(({a} + {b}) * {percent} + {99 + percent}) div {100 + percent}")


def sign(keys: np.ndarray) -> list[int]:
    """Parities of the classes of a set. Two sets differ in at least so many elements as their signs do in bits."""
    place = (keys * MIX_A) >> np.uint64(64 - (SIGN_LONGS * 64).bit_length() + 1)
    odd = np.bincount(place.astype(np.int64), minlength=SIGN_LONGS * 64) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64).tolist()


def _orders(percent: int, buckets: int, schema: pa.Schema):
    def rows(table: pa.Table) -> pa.Table:
        messages = table.to_pylist()
        own = next(m for m in messages if m["ids"] is not None)
        told = [m for m in messages if m["ids"] is None]

        def joined(what: str, kind) -> np.ndarray:
            return np.concatenate([np.zeros(0, kind), *(np.frombuffer(m[what], kind) for m in told)])

        docs, keys = joined("docs", np.uint16), joined("sent", np.uint64)
        hot = joined("hot", np.uint64)
        if len(hot):
            full, holders = np.frombuffer(own["sent"], np.uint64), np.frombuffer(own["docs"], np.uint16)
            sent = full // np.uint64(buckets) & ((np.uint64(1) << SENT_BITS) - np.uint64(1))
            tokens = tokens_of(sent, full % np.uint64(buckets), buckets)
            hot = hot[np.argsort(hot & LOW)]
            docs = np.concatenate([docs, holders])
            keys = np.concatenate([keys, hot[np.searchsorted(hot & LOW, tokens)]])
        copies = set(joined("named", np.uint16).tolist())
        order = np.lexsort((keys, docs))
        docs, keys = docs[order], keys[order]
        size_of = dict(zip(own["nodes"], own["sizes"], strict=True))
        nodes = [n for n in dict.fromkeys(own["nodes"]) if n is not None]
        starts = np.searchsorted(docs, np.arange(len(nodes) + 1))
        out = [{k: own[k] for k in ("ids", "nodes", "sizes")}]
        for k, node in enumerate(nodes):
            mine, n = keys[starts[k] : starts[k + 1]], size_of[node]
            alone = n - len(mine)
            prefix = n - (n * percent + 99) // 100 + 1 - alone
            if prefix > 0 and k not in copies:
                out.append(
                    {"node": node, "n": n, "alone": alone, "keys": mine.tobytes(), "prefix": mine[:prefix].view(np.int64).tolist(), "sign": sign(mine)}
                )
        return pa.Table.from_pylist(out, schema)

    return rows


def ordered_sets(docs: DataFrame, shingle: int, percent: int, sizes: Sizes = Sizes()) -> DataFrame:  # noqa: B008
    """Rows of two kinds, written: ``ids``, ``nodes`` and ``sizes`` of all rows of a stretch; or a text that may have links.

    Such a text has ``node`` (the hash of its words), ``n`` shingles, ``alone`` (those that no other text has, the first of
    its order), ``keys`` (the others in order, as bytes), ``prefix`` (those of them in the prefix) and :func:`sign` of them.
    """
    from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

    kind = docs.schema["doc_id"].dataType
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, min(1 << 30, size // 6 // sizes.bucket))  # a word and its space have about six bytes
    first = _messages(to_arrow_type(kind))
    second = pa.schema([f for f in first if f.name not in ("bucket", "counts", "names")])
    third = pa.schema(
        [
            *(first.field(c) for c in ("ids", "nodes", "sizes")), ("node", pa.int64()), ("n", pa.int32()),
            ("alone", pa.int32()), ("keys", pa.binary()), ("prefix", pa.list_(pa.int64())), ("sign", pa.list_(pa.int64())),
        ]
    )
    asked = docs.select("doc_id", "text").mapInArrow(_asks(shingle, buckets, sizes, first), from_arrow_schema(first))
    told = asked.groupBy("bucket").applyInArrow(_answers(buckets, second), from_arrow_schema(second))
    found = told.groupBy("stretch").applyInArrow(_orders(percent, buckets, third), from_arrow_schema(third))
    return materialize(found, "ordered-sets")


def overlap_bound(a: np.ndarray, b: np.ndarray) -> int:
    """Most elements that two sorted sets can share, from splitting both at the same places."""
    places = a[np.linspace(0, len(a) - 1, SPLITS).astype(np.int64)] if len(a) else a
    sizes = [np.diff(np.searchsorted(x, places), prepend=0, append=len(x)) for x in (a, b)]
    return int(np.minimum(*sizes).sum()) if len(a) else 0


def _verifier(percent: int):
    def rows(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for left, right, sizes, from_left, from_right in batches:
            out = []
            for a, b, n, i, j in zip(left, right, sizes.to_pylist(), from_left.to_pylist(), from_right.to_pylist(), strict=True):
                x = np.frombuffer(a.as_buffer(), np.uint64)[i:]
                y = np.frombuffer(b.as_buffer(), np.uint64)[j:]
                least = least_overlap(n, percent)
                out.append(overlap_bound(x, y) >= least and len(np.intersect1d(x, y, assume_unique=True)) >= least)
            yield pa.array(out, pa.bool_())

    rows.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    return F.arrow_udf(rows, returnType="boolean")


#: Of a text in a token: what a pair of them is judged by before it becomes a row.
SIDE = ("node", "n", "pos", "alone", "sign")


def _side(name: str) -> list[Column]:
    return [F.col(c).alias(f"{name}_{c}") for c in SIDE]


def _pairs(met: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (``a`` below ``b``) with the positions of the first shingle they share, within all bounds.

    ``met`` has two sides that share a shingle of both prefixes. The first one they share has their whole overlap at and
    behind it, so a row where either side has too few shingles left is not the first of a pair that is alike. Nor is one
    whose sets differ in too many shingles: in all that only one text has, and at least in so many as the signs in bits.
    """
    small, large = F.least("u_n", "v_n"), F.greatest("u_n", "v_n")
    rest = F.least(F.col("u_n") - F.col("u_pos"), F.col("v_n") - F.col("v_pos"))
    needed = _needed("u_n", "v_n", percent)
    bits = [F.bit_count(F.get("u_sign", F.lit(k)).bitwiseXOR(F.get("v_sign", F.lit(k)))) for k in range(SIGN_LONGS)]
    differ = reduce(Column.__add__, bits, F.col("u_alone") + F.col("v_alone"))
    fits = (small * 100 >= large * percent) & (rest >= needed) & (differ <= F.col("u_n") + F.col("v_n") - 2 * needed)
    low = F.col("u_node") < F.col("v_node")
    ordered = met.where(fits).select(
        F.least("u_node", "v_node").alias("a"), F.greatest("u_node", "v_node").alias("b"),
        F.when(low, F.col("u_pos")).otherwise(F.col("v_pos")).alias("a_pos"),
        F.when(low, F.col("v_pos")).otherwise(F.col("u_pos")).alias("b_pos"),
        F.when(low, F.col("u_n")).otherwise(F.col("v_n")).alias("a_n"),
        F.when(low, F.col("v_n")).otherwise(F.col("u_n")).alias("b_n"),
    )
    return ordered.groupBy("a", "b", "a_n", "b_n").agg(F.min("a_pos").alias("a_pos"), F.min("b_pos").alias("b_pos"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges ``u``, ``v``: pairs whose sets are alike, looked at from the first shingle they share."""
    sides = [sets.select(F.col("node").alias(x), F.col("keys").alias(f"{x}_keys"), F.col("alone").alias(f"{x}_alone")) for x in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    alike = _verifier(percent)(
        F.col("a_keys"), F.col("b_keys"), F.col("a_n") + F.col("b_n"),
        F.col("a_pos") - F.col("a_alone"), F.col("b_pos") - F.col("b_alone"),
    )
    return both.where(alike).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _grouped(grams: DataFrame, joined: DataFrame | None) -> DataFrame:
    """``grams`` with the group of each node so far, of those tokens that lie in more than one group; written."""
    if joined is None:
        rooted = grams.withColumn("group", F.col("node"))
    else:
        rooted = grams.join(joined.select(F.col("id").alias("node"), "root"), "node", "left")
        rooted = rooted.withColumn("group", F.coalesce("root", "node")).drop("root")
    several = rooted.groupBy("token").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high")
    return materialize(rooted.join(several.select("token"), "token", "left_semi"), "mixed-grams")


def _told(mixed: DataFrame) -> DataFrame:
    """``mixed`` with the largest group of each token, and whether it is a wide one."""
    groups = mixed.groupBy("token", "group").agg(F.count("*").alias("c"))
    largest = groups.groupBy("token").agg(F.max(F.struct("c", "group")).alias("m"))
    return mixed.join(largest.select("token", F.col("m.group").alias("largest"), (F.col("m.c") >= WIDE).alias("wide")), "token")


def _across(told: DataFrame) -> DataFrame:
    """Of every token all pairs of texts in different groups, but for those of which one lies in a wide largest group.

    The largest group is never paired with itself, however large it is.
    """
    others = told.where(F.col("group") != F.col("largest")).select("token", F.col("group").alias("u_group"), *_side("u"))
    facing = told.where(~(F.col("wide") & (F.col("group") == F.col("largest"))))
    facing = facing.select("token", F.col("group").alias("v_group"), "largest", *_side("v"))
    once = (F.col("v_group") == F.col("largest")) | (F.col("u_node") < F.col("v_node"))
    return others.join(facing, "token").where((F.col("u_group") != F.col("v_group")) & once)


def _against_group(percent: int):
    def rows(table: pa.Table) -> pa.Table:
        sides = [table.filter(pc.equal(table["inside"], x)) for x in (True, False)]
        members, texts = ({c: t[c].to_numpy() for c in ("node", "n")} for t in sides)
        held, asked = ([np.frombuffer(k.as_buffer(), np.uint64) for k in t["keys"]] for t in sides)
        edges: list[tuple[int, int]] = []
        if held and asked:
            every = np.concatenate(held)
            owner = np.repeat(np.arange(len(held)), [len(k) for k in held])
            for node, n, keys in zip(texts["node"], texts["n"], asked, strict=True):
                at = np.minimum(np.searchsorted(keys, every), len(keys) - 1)
                both = np.bincount(owner[keys[at] == every], minlength=len(held))
                linked = np.flatnonzero(both >= least_overlap(members["n"].astype(np.int64) + int(n), percent))
                edges += [(node, members["node"][k]) for k in linked[:1]]
        return pa.table({"u": pa.array([e[0] for e in edges], pa.int64()), "v": pa.array([e[1] for e in edges], pa.int64())})

    return rows


def _to_groups(told: DataFrame, joined: DataFrame | None, sets: DataFrame, percent: int) -> DataFrame:
    """Edges (``u``, ``v``): a link of each text to each wide group that it meets in a token but is not part of.

    One link is enough to join them, so a text is held against the whole group at once and no pair is a row. Both
    sides are cut by the bytes of their sets; a part of one meets every part of the other.
    """
    meets = told.where(F.col("wide") & (F.col("group") != F.col("largest"))).select(F.col("largest").alias("g"), "node").distinct()
    inside = joined.select(F.col("root").alias("g"), F.col("id").alias("node")).join(meets.select("g").distinct(), "g", "left_semi")
    own = sets.select("node", "n", "keys")
    both = meets.withColumn("inside", F.lit(False)).union(inside.withColumn("inside", F.lit(True))).join(own, "node")
    both = materialize(both.select("g", "inside", "node", "n", "keys"), "facing-groups")
    size = lambda side: F.sum(F.when(side, F.octet_length("keys")).otherwise(0))
    cuts = lambda total: F.greatest(F.ceil(total / TILE_BYTES), F.lit(1)).cast("bigint")
    parts = both.groupBy("g").agg(cuts(size(F.col("inside"))).alias("m"), cuts(size(~F.col("inside"))).alias("k"))
    deal = both.join(parts, "g").withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("inside"), F.col("m")).otherwise(F.col("k"))))
    met = F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(F.col("inside"), F.col("k")).otherwise(F.col("m")) - 1))
    deal = deal.withColumn("met", met)
    tile = F.when(F.col("inside"), F.struct(F.col("own").alias("m"), F.col("met").alias("k"))).otherwise(F.struct(F.col("met").alias("m"), F.col("own").alias("k")))
    dealt = deal.select("g", tile.alias("t"), "inside", "node", "n", "keys").select("g", "t.m", "t.k", "inside", "node", "n", "keys")
    return dealt.groupBy("g", "m", "k").applyInArrow(_against_group(percent), "u long, v long")


def _stars(mixed: DataFrame, number: int) -> DataFrame:
    """Of every token all texts with one of them, another one in each round; a few tokens in a row share the choice."""
    lot = F.xxhash64("node", F.pmod("token", F.lit(HUBS)), F.lit(number))
    hub = F.min_by(F.struct(*SIDE, "group"), lot).alias("hub")
    hubs = mixed.groupBy("token").agg(hub).select("token", "hub.*")
    hubs = hubs.select("token", F.col("group").alias("v_group"), *_side("v"))
    own = mixed.select("token", F.col("group").alias("u_group"), *_side("u"))
    return own.join(hubs, "token").where("u_group <> v_group")


def links(sets: DataFrame, percent: int) -> DataFrame:
    """(``id``, ``root``) of nodes that have links: the smallest node that they reach."""
    grams = materialize(
        sets.select("node", "n", "alone", "sign", F.posexplode("prefix").alias("at", "token")).select(
            "token", "node", "n", (F.col("alone") + F.col("at")).alias("pos"), "alone", "sign"
        ),
        "grams",
    )
    edges, joined, mixed, number, before = None, None, _grouped(grams, None), 0, None
    while True:
        left = mixed.groupBy("token", "group").agg(F.count("*").alias("c")).groupBy("token").agg(
            F.sum("c").alias("all"), F.max("c").alias("most"), F.count("*").alias("groups")
        )
        pairs, rows = left.agg(F.sum(F.expr("(all - most) * all")), F.sum("all")).first()
        if number == ROUNDS or not rows or pairs <= 4 * rows or (before and pairs > 0.9 * before):
            break
        before = pairs
        found = materialize(_verified(_pairs(_stars(mixed, number), percent), sets, percent), "star-links")
        edges = found if edges is None else edges.unionByName(found)
        joined = components(edges)
        mixed, number = _grouped(grams, joined), number + 1
    told = materialize(_told(mixed), "told-grams")
    more = _verified(_pairs(_across(told), percent), sets, percent)
    if edges is None:
        return components(more)
    return components(edges.unionByName(more).unionByName(_to_groups(told, joined, sets, percent)))


def similar_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80, sizes: Sizes = Sizes()  # noqa: B008
) -> DataFrame:
    """(doc_id, n_shingles, component_id): groups of texts whose sets of shingles are alike by ``percent`` or more.

    Words are what lies between ASCII white space, A-Z lower-cased; a set has the distinct runs of ``shingle`` words, or of
    fewer words the one run of them all. A null or wordless text has an empty set and is a group of its own, named by
    its doc_id. ``component_id`` is the smallest doc_id of the group; a null doc_id names none unless there is no
    other. Repeated rows and doc_ids are rows of their own, a text may be of any length, other columns are left out, and
    an empty table gives no rows. Sets are compared by 56-bit hashes of their shingles, texts known by 64-bit ones.
    """
    if not 50 <= percent <= 100 or shingle < 1:
        raise ValueError("percent lies between 50 and 100, shingle is 1 or more")
    found = ordered_sets(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), shingle, percent, sizes)
    rows = found.where("ids is not null").select(F.explode(F.arrays_zip("ids", "nodes", "sizes")).alias("r"))
    rows = rows.select(F.col("r.ids").alias("doc_id"), F.col("r.nodes").alias("node"), F.col("r.sizes").cast("long").alias("n_shingles"))
    linked = links(found.where("node is not null").drop("ids", "nodes", "sizes"), percent)
    named = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = named.join(linked.withColumnRenamed("id", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    # one group may hold a large share of all texts: its name is joined by salted keys
    salted = named.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    spread = names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = salted.join(spread, ["root", "salt"]).select("node", "component_id")
    return rows.join(placed, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group (:func:`similar_groups`), with the columns of ``docs``: that with the smallest doc_id.

    Texts without words are one group here. A null doc_id is the last choice, and of rows of a group that share the
    doc_id the one stays whose text has the smallest hash. An empty table stays empty.
    """
    named = docs.select(F.struct(F.col(key).alias("doc_id"), text_hash(text).alias("id")).alias("__row"), F.col(text).alias("text"))
    found = similar_groups(named, "__row", "text", shingle, percent)
    root = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    return one_of_each(docs, found.select("doc_id.doc_id", "doc_id.id", root.alias("root")), key, text)
