"""Counts of every prefix against the library, on texts with odd white space, marks and added tokens."""

import random

import numpy as np
import public_tokenizers
import pytest

from vardelta.llm import token_counts
from vardelta.llm._pieces import PieceEncoder
from vardelta.llm._prefix_counts import PrefixCounter

BPE = public_tokenizers.path("byte_bpe_50k.json")
BITS = [
    "a", "the", " ", "  ", "\n", "\n\n", "\t", "\r", "\x1c", "\x1f", "\x85", " ", " ", "　", "​", "!", "'s", "'re", "'v",
    "''", "9", "2024", "漢", "é", "ß", "😀", "don't", "word", "ing", "ALL", "x" * 70, "===", "_", "<|endoftext|>", "<|endo",
]


@pytest.fixture(scope="module")
def library():
    return PieceEncoder(BPE).library


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_every_prefix_of_odd_texts(library):
    encoder, counter, rng = PieceEncoder(BPE, keep=50), PrefixCounter(BPE, keep=50), random.Random(4)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randrange(14))) for _ in range(3000)]
    spaces = [chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)]
    texts += [f"a{s}{t}b{s}" for s in spaces for t in ("", " ", s, "\n")]
    coded = encoder.encode_many(texts)
    for text, raw, steps in zip(texts, coded, counter.steps(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == ids_of(library, text), repr(text)
        want = [len(ids_of(library, text[: k + 1])) for k in range(len(text))]
        assert token_counts.counts(np.frombuffer(steps, np.int8)).tolist() == want, repr(text)


def test_budgets_and_long_texts(spark, library):
    rng = random.Random(6)
    words = " ".join(f"word{i}" for i in range(1500))
    texts = [words + gap + words for gap in ("\n    indented ", "\n\n\n", "<|endoftext|>", " \t\t <|endoftext|>  ")] + [words + "  "]
    texts += ["".join(rng.choice("abcdeé漢 ") for _ in range(3000)).replace(" ", ""), "=" * 700, " " * 900, "word" * 50_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, ""])], "steps long, text string").repartition(3)
    found = token_counts.with_prefixes(df, BPE, budgets=(0, 7, 1024)).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        text = r.text or ""
        assert r.n_tokens == len(ids_of(library, text)) and len(r.steps) == len(text)
        counts = token_counts.counts(r.steps)
        for k in {*rng.sample(range(len(text)), min(40, len(text))), *range(max(0, len(text) - 5), len(text))}:
            if k < 20_000 or k > len(text) - 3:
                assert counts[k] == len(ids_of(library, text[: k + 1]))
        for budget, fits in zip((0, 7, 1024), r.within, strict=True):
            assert fits == max([0, *(np.flatnonzero(counts <= budget) + 1).tolist()])
            assert token_counts.truncate(text, r.steps, budget) == text[:fits]
            assert len(ids_of(library, text[:fits])) <= budget


def test_other_tokenizers_are_refused_or_encoded_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    with pytest.raises(ValueError, match="byte-level"):
        PrefixCounter(path)
    encoder = PieceEncoder(path)
    for text in ("Hello  world, don't", "", " x\n\ny "):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids_of(encoder.library, text)
