"""Token ids of whole texts from the tokenizers library, piece by piece.

Byte-level BPE never merges across the start of a run of white space that follows a non-space, because its
splitter starts a new word there. So a text can be cut there, each distinct piece encoded once by the
library, and the results joined: the same ids as for the whole text, at a fraction of the time. Texts that
hold an added token, or white space other than spaces, newlines and tabs, are handed to the library as they are; so
are all texts if the file is not byte-level BPE with the usual splitter and no normalizer.

Texts are cut and pieces counted, remembered and joined as Arrow columns, many texts at a time. Pieces that the splitter
takes apart at known places (:data:`PLAIN_PIECE`) go to the library's model many in one string; between them
stands a byte that UTF-8 does not have and no merge holds.

Where pieces have names (:meth:`PieceEncoder.names`), a piece is named by its own string if that starts with white space,
except that one space before a non-space is left out of the name; the name "" is a single space.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What the library takes for white space besides space, newline and tab, and four separators
#: that Python takes for white space and the library does not. None of them is cut at.
OTHER_SPACES = "\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
#: Two plain spaces together, or a tab: then the text is cut by :data:`PIECE`, else at every space or newline.
RUNS = [*(x + y for x in " \n" for y in " \n"), "\t"]
PIECE = re.compile(r"[ \n\t]+[^ \n\t]*|[^ \n\t]+")
#: Letters, then marks: the splitter cuts such a name (and a newline before it) into exactly these parts.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-/:-@\[-`{-~"
PLAIN = re.compile(rf"(\n?)([{LETTERS}]*)([{MARKS}]*)")
#: The same for a piece as it stands in the text, and the place in it where the splitter cuts letters from marks.
PLAIN_PIECE = rf"^[ \n][{LETTERS}]*[{MARKS}]*$"
LETTER_MARK = rf"([{LETTERS}])([{MARKS}])"
#: Stand before pieces and inside them; texts that hold them are not cut (:data:`OTHER_SPACES`).
BETWEEN, WITHIN = "\x1f", "\x1e"
#: Bytes that UTF-8 does not have.
NO_TEXT = (0xC0, 0xC1, *range(0xF5, 0x100))
LONGEST_KEPT = 64
CHUNK = 1 << 20
#: Characters of texts that are cut and joined together, and pieces in one string for the library.
GROUP, SHARED = 1 << 23, 500


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where it prints, else one
    from 256 on, in order."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in prints else next(others)) for b in range(256)]


def piece_text(name: str) -> str:
    return name if name[:1] in (" ", "\n", "\t") and name else " " + name


class PieceEncoder:
    """Encodes texts; remembers at most ``keep`` pieces."""

    def __init__(self, path: str, keep: int = 1_000_000, block: int = CHUNK):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.described = json.loads(self.library.to_str())
        self.byte_level = _is_byte_level(self.described)
        added = self.library.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        self.torn = any(t.lstrip or t.rstrip or t.single_word for t in added)
        self.keep, self.block = keep, block
        self.known, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.used = np.zeros(0, dtype=bool)
        if self.byte_level:
            vocabulary = self.library.get_vocab(with_added_tokens=False)
            self.sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
            for token, i in vocabulary.items():
                self.sizes[i] = len(token)
            self.model = Tokenizer(self.library.model)  # without the splitter: its words come ready spelled and parted
            alphabet = byte_alphabet()
            merged = set("".join(map("".join, self.described["model"]["merges"])))
            free = [alphabet[b] for b in NO_TEXT if alphabet[b] not in merged][-2:]
            self.parted = len(free) == 2  # always, if the merges were learned from text
            if self.parted:
                self.between, self.within = (vocabulary[c] for c in free)
                alphabet[ord(BETWEEN)], alphabet[ord(WITHIN)] = free
                self.spelling = np.array(list(map(ord, alphabet)), dtype="<u2")

    def whole(self, text: str) -> bool:
        """Whether only the library itself may cut this text."""
        return not self.byte_level or any(map(text.__contains__, OTHER_SPACES)) or any(map(text.__contains__, self.added))

    def names(self, text: str) -> tuple[str, list[str]] | None:
        """What stands before the first white space, and the names of all pieces; None if not to be cut."""
        if self.whole(text):
            return None
        if not any(map(text.__contains__, RUNS)):
            first, *rest = text.replace("\n", " \n").split(" ")
            return first, rest
        found = PIECE.findall(text)
        first = "" if not found or found[0][0] in " \n\t" else found.pop(0)
        return first, [p[1:] if p[0] == " " and p[1:2] not in ("", " ", "\n", "\t") else "" if p == " " else p for p in found]

    def _encode(self, texts: Iterable[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _learn(self, missing: pa.Array) -> pa.Array:
        """The ids of pieces, and of what stands before the first white space of a text."""
        plain = pc.match_substring_regex(missing, PLAIN_PIECE) if self.parted else pa.array([False] * len(missing))
        others = missing.filter(pc.invert(plain)).to_pylist()
        ids = dict.fromkeys(others, b"")
        alone = [p for p in others if not p.strip(" \n\t") or p[0] not in " \n\t"]  # white space must end, the others begin a text
        ids.update(zip(alone, self._encode(alone), strict=True))
        odd = list(ids.keys() - set(alone))
        for i in range(0, len(odd), SHARED):
            ids.update(self._share(odd[i : i + SHARED]))
        learned = pa.concat_arrays([self._parted(missing.filter(plain)), pa.array(list(ids.values()), pa.large_binary())])
        plain = plain.to_numpy(zero_copy_only=False)
        place = np.where(plain, np.cumsum(plain) - 1, plain.sum() + np.cumsum(~plain) - 1)
        return learned.take(pa.array(place))

    def _parted(self, plain: pa.Array) -> pa.Array:
        """The ids of plain pieces by the model alone, as the words that the splitter makes of them."""
        words = pc.replace_substring(pc.replace_substring_regex(plain, LETTER_MARK, rf"\1{WITHIN}\2"), "\n", "\n" + WITHIN)
        found = [np.zeros(0, dtype="<u4")]
        for i in range(0, len(words), SHARED):
            part = words.slice(i, SHARED)
            lists = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part)
            text = pc.binary_join(lists, pa.scalar(BETWEEN, pa.large_string()))[0].as_py() + BETWEEN
            text = self.spelling[np.frombuffer(text.encode(), dtype=np.uint8)].tobytes().decode("utf-16-le")
            found.append(np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4"))
        ids = np.concatenate(found)
        ends = np.flatnonzero(ids == self.between)
        stays = (ids != self.between) & (ids != self.within)
        if len(ends) != len(plain):
            raise ValueError("a piece of text holds a byte that UTF-8 does not have")
        return _binary(ids[stays], np.cumsum(stays)[ends])

    def _share(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        """Encode pieces that are not bare white space together; the ids are dealt by the bytes that each token stands for."""
        ids = np.array(self.library.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0].ids, dtype="<u4")
        reach, ends = np.cumsum(self.sizes[ids]), np.cumsum([len(p.encode()) for p in pieces])
        at = np.searchsorted(reach, ends) + 1
        if not (len(reach) and np.array_equal(reach[at - 1], ends) and at[-1] == len(ids)):
            raise ValueError("tokens of neighbouring pieces overlap: not a byte-level vocabulary")
        raw, at = ids.tobytes(), (4 * at).tolist()
        return ((p, raw[a:b]) for p, a, b in zip(pieces, [0, *at[:-1]], at, strict=True))

    def _cut(self, texts: list[str]) -> list[bytes]:
        """All ids of texts that can be cut."""
        marked = pa.array(texts, pa.large_string())
        for space in " \n\t":
            marked = pc.replace_substring(marked, space, BETWEEN + space)
        marked = pc.replace_substring_regex(marked, rf"([ \n\t]){BETWEEN}", r"\1")  # a run begins one piece
        lists = pc.split_pattern(marked, BETWEEN)
        coded, bounds = lists.values.dictionary_encode(), lists.offsets.to_numpy()
        del marked, lists
        pieces = coded.dictionary
        found = pc.index_in(self.known, value_set=pieces)  # hashes these pieces, however many are known
        held, place = np.flatnonzero(found.is_valid()), np.full(len(pieces), -1)
        place[found.drop_null().to_numpy()] = held
        self.used[held] = True
        missing = place < 0
        place[missing] = len(self.known) + np.arange(missing.sum())
        ids = pa.concat_arrays([self.ids, self._learn(pieces.filter(pa.array(missing)))])
        joined = ids.take(pa.array(place[coded.indices.to_numpy()]))
        self._remember(pieces, ids, place)
        raw, ends = joined.buffers()[2], np.frombuffer(joined.buffers()[1], dtype=np.int64)
        bounds = ends[bounds].tolist()
        return [raw[a:b].to_pybytes() for a, b in zip(bounds, bounds[1:], strict=False)]

    def _remember(self, pieces: pa.Array, ids: pa.Array, place: np.ndarray) -> None:
        """Add these pieces, whose ids are at ``place``. If that is too many, half of ``keep`` stay: these, then what was used of late."""
        new = place >= len(self.known)
        if len(self.known) + new.sum() <= self.keep:
            kept, room = np.arange(len(self.known)), self.keep
        else:
            own = place[~new]
            self.used[own] = False
            kept, room = np.concatenate([own, np.flatnonzero(self.used)]), self.keep // 2
        new = np.flatnonzero(new & (pc.binary_length(pieces).to_numpy() <= LONGEST_KEPT))[:room]
        kept = kept[: room - len(new)]
        self.ids = ids.take(pa.array(np.concatenate([place[new], kept])))
        self.known = pa.concat_arrays([pieces.take(pa.array(new)), self.known.take(pa.array(kept))])
        used = self.used[kept] if room == self.keep else np.zeros(len(kept), dtype=bool)  # "of late": since the last time
        self.used = np.concatenate([np.zeros(len(new), dtype=bool), used])

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """All ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for part in chunks(texts, GROUP):
            whole = list(map(self.whole, part))
            cut = [text for text, w in zip(part, whole, strict=True) if not w]
            found = iter(self._cut(cut) if cut else [])
            out += [self._encode([text])[0] if w else next(found) for text, w in zip(part, whole, strict=True)]
            pa.default_memory_pool().release_unused()
        return out

    def blocks(self, text: str) -> list[str]:
        """The text in parts of about ``block`` characters, cut only before spaces between non-spaces."""
        if len(text) <= self.block or self.whole(text):
            return [text]
        parts, at = [], 0
        while len(text) - at > self.block:
            cut = at + self.block
            while (cut := text.find(" ", cut)) > 0 and (
                text[cut - 1].isspace() or cut + 1 >= len(text) or text[cut + 1].isspace()
            ):
                cut += 1
            if cut < 0:
                break
            parts.append(text[at:cut])
            at = cut
        return [*parts, text[at:]]

    def encode(self, text: str) -> bytes:
        """All ids of one text."""
        return b"".join(self.encode_many(self.blocks(text)))


def chunks(texts: list[str], size: int) -> Iterator[list[str]]:
    """Consecutive texts of about ``size`` characters together."""
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text)
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


def _binary(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A value for each of ``ends``: the ids up to there as bytes."""
    offsets = np.concatenate([[0], 4 * ends]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids.tobytes())])


def _is_byte_level(described: dict) -> bool:
    """Whether the file is byte-level BPE as this module takes it to be."""
    model, splitter = described["model"], described["pre_tokenizer"] or {}
    return (
        model["type"] == "BPE"
        and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and described["normalizer"] is None
        and splitter.get("type") == "ByteLevel"
        and splitter.get("use_regex", True)
        and not splitter.get("add_prefix_space")
        and set(byte_alphabet()) <= model["vocab"].keys()
    )


@functools.lru_cache(maxsize=2)
def shared_encoder(path: str) -> PieceEncoder:
    """The encoder of this Python worker: its memory of pieces serves task after task."""
    return PieceEncoder(path)
