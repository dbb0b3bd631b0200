"""The Jaccard join against all pairs compared, with odd rows, hot shingles, copies and chains of near copies."""

import itertools
import random

import numpy as np
import pytest

from vardelta.llm import jaccard_join

SCHEMA = "doc_id long, text string, node string, n int"


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, k=5, percent=80):
    """(doc_id, size, component) of every row, by comparing all pairs."""
    sets = [shingles(t, k) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            root[find(j)] = find(i)
    names = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            names[find(i)] = min(d, names.get(find(i), d))
    return sorted(
        ((d, len(s), (names.get(find(i)) if s else d)) for i, ((d, *_), s) in enumerate(zip(rows, sets, strict=True))), key=repr
    )


def made(rng, n, words=400):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    texts = [None, "", " \n\t", "one", "One", "two words", "a b c d", "A B\tC  D", "a b c d e", "x " * 40, "x " * 400]
    for n in (12, 30, 60, 61, 200, 500):
        base = made(rng, n)
        texts.append(" ".join(base))
        for cuts in range(1, 9):  # about both sides of the limit
            near = list(base)
            for _ in range(cuts):
                near[rng.randrange(n)] = "changed"
            texts.append(" ".join(near))
        texts.append(" ".join(base + made(rng, n // 5)))
        texts.append(" ".join(base[n // 6 :]))
        texts += [" ".join(base).upper()] * 3
    passage = made(rng, 40)
    texts += [" ".join(passage + made(rng, rng.randrange(3, 12))) for _ in range(70)]  # a hot passage
    chain = made(rng, 300)
    for k in range(25):  # neighbours are alike, the ends are not
        chain = chain[9:] + made(rng, 9)
        texts.append(" ".join(chain))
    texts.append(" ".join(made(rng, 30_000, 10**6)))
    texts.append(texts[-1] + " and more")
    rng.shuffle(texts)
    out = [(k, t, "theirs", 3) for k, t in enumerate(texts)]
    return [*out, (None, texts[5], None, None), (None, None, "x", 1), (3, texts[3], "x", 1), (3, "other words than before", "x", 1), (-7, texts[9], "x", 1)]


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_equals_all_pairs(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(jaccard_join.similar_groups(docs)) == brute(rows)


@pytest.mark.parametrize(("stretch", "bucket", "hot"), [(300, 100, 2), (5000, 1000, 1)])
def test_small_stretches_and_buckets_change_nothing(spark, rows, stretch, bucket, hot):
    """Copies and shared shingles lie in different stretches; many shingles are sent as counts."""
    sizes = jaccard_join.Sizes(stretch, bucket, 40, hot)
    some = [r for r in rows if len(r[1] or "") < 20_000]
    docs = spark.createDataFrame(some, SCHEMA).repartition(3)
    assert result(jaccard_join.similar_groups(docs, shingle=3, percent=70, sizes=sizes)) == brute(some, 3, 70)


def test_no_pairs_inside_a_large_group(spark):
    rng = random.Random(3)
    base = made(rng, 120)
    texts = []
    for k in range(300):
        near = list(base)
        near[rng.randrange(120)] = f"own{k}"
        texts.append((k, " ".join(near), "", 0))
    docs = spark.createDataFrame(texts, SCHEMA)
    assert {r.component_id for r in jaccard_join.similar_groups(docs).collect()} == {0}
    sets = jaccard_join.ordered_sets(docs.select("doc_id", "text"), 5, 80).where("node is not null")
    assert sets.count() == 300


def test_empty_table_and_strings_as_ids(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert jaccard_join.similar_groups(docs).count() == 0
    named = spark.createDataFrame([("b", "some words in here twice"), ("a", "some words in here twice"), ("c", None)], "doc_id string, text string")
    assert result(jaccard_join.similar_groups(named)) == [("a", 1, "a"), ("b", 1, "a"), ("c", 0, "c")]


def test_overlap_bound_never_falls_short():
    rng = np.random.default_rng(4)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 200, rng.integers(0, 120))).astype(np.uint64) for _ in range(2))
        assert jaccard_join.overlap_bound(a, b) >= len(np.intersect1d(a, b))
    far = np.arange(1000, 1100, dtype=np.uint64)
    assert jaccard_join.overlap_bound(far, far + np.uint64(5000)) <= 1


def test_hashes_of_shingles():
    known = jaccard_join._WordHashes()
    rng = random.Random(1)
    for n in (0, 1, 4, 5, 6, 50, 700):
        words = [w.encode() for w in made(rng, n, 30)]
        assert len(jaccard_join.shingle_hashes(words, 5, known)) == len(shingles(b" ".join(words).decode()))
