"""The piece encoder works on columns: ids against the library, and no Python call for each piece."""

import cProfile
import pstats
import random

import numpy as np
import public_tokenizers

from vardelta.llm._pieces import PieceEncoder

BPE = public_tokenizers.path("byte_bpe_50k.json")
SYLLABLES = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "é", "ß", "ción", "Øre"]


def made_up(rng, n):
    """Words that mostly come once, some with marks or on a new line."""
    words = ("".join(rng.choices(SYLLABLES, k=rng.randrange(1, 7))) + rng.choice(["", "", "", ".", ",", "&&&", "'"]) for _ in range(n))
    return "".join(rng.choice([" ", " ", " ", " ", "\n"]) + w for w in words)


def test_ids_are_those_of_the_library_while_memory_turns_over():
    rng = random.Random(21)
    odd = ["", " ", "\n", " a", "a ", "a\n", "a  b\t\n c", "\n\n.x", "a \n", " 's", "a's b'", "\n'", "x\x1ey z", "x \x1f\x1f z", "a ÿþ b", "ǅa ɐ.", "9.5 漢字 😀!", "<|endoftext|> a"]
    for keep in (0, 30, 100_000):
        encoder = PieceEncoder(BPE, keep=keep)
        for _ in range(4):
            texts = [made_up(rng, 300) for _ in range(5)] + rng.sample(odd, len(odd)) + [made_up(rng, 40) + " " + "long" * 80 + "."]
            for text, raw in zip(texts, encoder.encode_many(texts), strict=True):
                assert np.frombuffer(raw, "<u4").tolist() == encoder.library.encode(text, add_special_tokens=False).ids, repr(text)
            assert len(encoder.known) == len(encoder.ids) <= keep
        assert encoder.encode_many([]) == []


def test_no_python_call_for_each_piece():
    rng = random.Random(22)
    texts = [made_up(rng, 1000) for _ in range(60)]
    encoder, profile = PieceEncoder(BPE), cProfile.Profile()
    profile.enable()
    encoder.encode_many(texts)
    profile.disable()
    assert pstats.Stats(profile).total_calls < 60_000 / 5
