"""Near-dedup by the Jaccard join: whole groups, odd rows, and no text dealt out to tiles."""

import itertools
import random

import numpy as np

from vardelta.llm import jaccard_join, simhash

from .test_near_dedup import shingles, similarity
from .test_text_operators import DOCS


def test_keep_one_by_brute_force(spark, monkeypatch):
    import corpus_pipeline as p

    def dealt(*args, **named):
        raise AssertionError("texts go to every tile that they may be near to: more bytes than any multiple of the input")

    monkeypatch.setattr(simhash, "tile_links", dealt)
    rng = random.Random(8)
    texts = []
    for _ in range(40):
        one = [str(rng.randrange(3000)) for _ in range(rng.randrange(5, 120))]
        at = rng.randrange(len(one))
        texts += [one, one + [str(rng.randrange(3000)) for _ in range(len(one) // 5)], one[:at] + ["x"] + one[at + 1 :]]
    rows = [(i, " ".join(t), "en", "src0", 0) for i, t in enumerate(texts)]
    sets, root = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for _ in rows:
        for i, j in itertools.combinations(range(len(rows)), 2):
            if root[i] != root[j] and similarity(sets[i], sets[j]) >= 0.8:
                root[i] = root[j] = min(root[i], root[j])
    kept = p.near_dedup(spark, spark.createDataFrame(rows, DOCS), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))


def test_keep_one_of_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(7, None), (6, ""), (5, " \n"), (3, long), (3, long), (3, "a b"), (None, long.upper()), (None, "c d"), (9, "C D "), (8, "alone")]
    docs = spark.createDataFrame([(i, t, "en", "src0", 0) for i, t in rows], DOCS)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert found == sorted([(5, " \n"), (3, long), (3, "a b"), (9, "C D "), (8, "alone")], key=str)
    assert jaccard_join.keep_one(docs.limit(0)).count() == 0


def test_signs_never_differ_in_more_bits_than_sets_in_elements():
    rng = np.random.default_rng(4)
    for n in (0, 1, 30, 400, 3000):
        every = rng.integers(0, 1 << 62, 2 * n + 8).astype(np.uint64)
        for share in (0.0, 0.02, 0.3, 1.0):
            a, b = every[:n], every[int(share * n) :][: n + 3]
            bits = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(jaccard_join.sign(a), jaccard_join.sign(b), strict=True))
            assert bits <= len(np.setxor1d(a, b)) and (n != 400 or share != 1.0 or bits > 150)
        assert jaccard_join.sign(every) == jaccard_join.sign(every[::-1])
