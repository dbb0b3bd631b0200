"""Token counts of all prefixes by dynamic programming over byte-level BPE.

The last token of a prefix decides the rest: the encoding of a word's first i bytes ends in the one token t
whose bytes end there and which may follow the last token of the first ``i - len(t)`` bytes. So
``count[i] = count[i - len(t)] + 1``. Two tokens may follow each other if no merge across their border would have
been made while both of its sides existed; that is read off the ranks of the merges.

Many words are worked through together in numpy: all tokens that stand in them are found by walking a trie from
every byte at once, then the counts are filled in by position. What is stored of a text is its steps: for each
character, by how much the count changes with it.
"""

from __future__ import annotations

import functools
import re

import numpy as np

from vardelta.llm._pieces import LONGEST_KEPT, OTHER_SPACES, PLAIN, PieceEncoder, byte_alphabet, chunks, piece_text

#: Words of more bytes are counted one by one, so that a batch has few positions.
LONGEST_BATCHED = 64
CHUNK = 1 << 20
NEVER = 1 << 40
#: White space as the library takes it.
SPACES = set(" \n\t" + OTHER_SPACES) - set("\x1c\x1d\x1e\x1f")


class IntTable:
    """Non-negative integers looked up by integer keys, many at once; -1 for keys that are not there."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(8, (4 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, -1, dtype=np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.keys[slot[placed]], self.values[slot[placed]] = keys[placed], values[placed]
            left = np.setdiff1d(left, placed)
            slot[left] = (slot[left] + 1) & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], -1)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.last
            there = self.keys[slot[left]]
            hit = there == keys[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out


class Vocabulary:
    """Tokens, their trie, and which of them may follow each other."""

    def __init__(self, described: dict):
        model = described["model"]
        of_char = {c: b for b, c in enumerate(byte_alphabet())}
        ids = model["vocab"]
        n = max(ids.values()) + 1
        self.born, self.left, self.right = np.full(n, -1, dtype=np.int64), np.arange(n), np.arange(n)
        self.ranks: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pair, made = (ids[a], ids[b]), ids[a + b]
            self.ranks.setdefault(pair, rank)
            if self.born[made] < 0:
                self.born[made], self.left[made], self.right[made] = rank, *pair
        self.width = n.bit_length()
        pairs = np.array(list(self.ranks), dtype=np.int64).reshape(-1, 2)
        self.pairs = IntTable((pairs[:, 0] << self.width) | pairs[:, 1], np.array(list(self.ranks.values()), dtype=np.int64))
        # tokens that no merge makes are never produced, except single bytes
        tokens = [(bytes(map(of_char.__getitem__, t)), i) for t, i in ids.items() if len(t) == 1 or self.born[i] >= 0]
        self.of_byte = np.zeros(256, dtype=np.int64)
        edges: dict[tuple[int, int], int] = {}
        token_at, depth_one = [-1], np.zeros(256, dtype=np.int64)
        for raw, i in tokens:
            node = 0
            for b in raw:
                if (step := edges.get((node, b))) is None:
                    step = edges[node, b] = len(token_at)
                    token_at.append(-1)
                node = step
            token_at[node] = i
            if len(raw) == 1:
                self.of_byte[raw[0]], depth_one[raw[0]] = i, node
        self.first_node, self.token_at = depth_one, np.array(token_at, dtype=np.int64)
        keys = np.array(list(edges), dtype=np.int64)
        self.edges = IntTable((keys[:, 0] << 8) | keys[:, 1], np.array(list(edges.values()), dtype=np.int64))
        self.longest = max(len(raw) for raw, _ in tokens)
        # pairs already decided, one to a slot; a later pair may take the slot
        self.seen, self.verdict = np.full(1 << 20, -1, dtype=np.int64), np.zeros(1 << 20, dtype=bool)
        self.follows = functools.lru_cache(maxsize=1 << 16)(self._follows)

    def may_follow(self, first: np.ndarray, then: np.ndarray) -> np.ndarray:
        """For each pair whether BPE leaves both tokens side by side."""
        key = (first << self.width) | then
        slot = ((key * 0x2545F4914F6CDD1D) >> 20) & (len(self.seen) - 1)
        out, new = self.verdict[slot], np.flatnonzero(self.seen[slot] != key)
        if len(new):
            out[new] = self._decide(first[new], then[new])
            self.seen[slot[new]] = key[new]
            self.verdict[slot[new]] = out[new]
        return out

    def _decide(self, first: np.ndarray, then: np.ndarray) -> np.ndarray:
        x, y = first.copy(), then.copy()
        x_gone, y_gone = np.full(len(x), NEVER), np.full(len(x), NEVER)
        out, left = np.ones(len(x), dtype=bool), np.arange(len(x))
        while len(left):
            a, b = x[left], y[left]
            rank = self.pairs.get((a << self.width) | b)
            # at equal ranks the merge further to the left comes first
            crossed = (rank >= 0) & (rank < x_gone[left]) & (rank <= y_gone[left])
            out[left[crossed]] = False
            older = (self.born[a] < 0) & (self.born[b] < 0)
            left = left[~crossed & ~older]
            a, b = x[left], y[left]
            undo = self.born[a] > self.born[b]
            u, v = left[undo], left[~undo]
            x_gone[u], x[u] = self.born[x[u]], self.right[x[u]]
            y_gone[v], y[v] = self.born[y[v]], self.left[y[v]]
        return out

    def _follows(self, x: int, y: int) -> bool:
        return bool(self._decide(np.array([x]), np.array([y]))[0])

    def prefix_steps(self, words: list[bytes]) -> list[bytes]:
        """For each word (whole UTF-8 characters) a signed byte per character: the change of the count."""
        out: list[bytes] = [b""] * len(words)
        short = [k for k, w in enumerate(words) if len(w) <= LONGEST_BATCHED]
        for part in (short[i : i + 50_000] for i in range(0, len(short), 50_000)):
            for k, steps in zip(part, self._batch([words[k] for k in part]), strict=True):
                out[k] = steps
        for k, w in enumerate(words):
            if len(w) > LONGEST_BATCHED:
                out[k] = self._batch([w])[0]
        return out

    def _batch(self, words: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        buffer = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        total = len(buffer)
        if not total:
            return [b""] * len(words)
        begins = np.cumsum(sizes) - sizes
        word_of = np.repeat(np.arange(len(words)), sizes)
        offset = np.arange(total) - begins[word_of]
        room = sizes[word_of] - offset
        starts, tokens, lengths = [np.arange(total)], [self.of_byte[buffer]], [np.ones(total, dtype=np.int64)]
        alive, node, k = np.arange(total), self.first_node[buffer], 1
        while len(alive):
            fits = room[alive] > k
            alive, node = alive[fits], node[fits]
            node = self.edges.get((node << 8) | buffer[alive + k]).astype(np.int64)
            alive, node, k = alive[node >= 0], node[node >= 0], k + 1
            token = self.token_at[node]
            found = token >= 0
            starts.append(alive[found])
            tokens.append(token[found])
            lengths.append(np.full(found.sum(), k))
        start, token, length = map(np.concatenate, (starts, tokens, lengths))
        # state p + word + 1 is the prefix that ends with byte p; the state before a word's first byte is empty
        from_state = start + word_of[start]
        to_state = from_state + length
        last, count = np.full(total + len(words), -1, dtype=np.int64), np.zeros(total + len(words), dtype=np.int64)
        end = offset[start] + length
        order = np.argsort(end, kind="stable")
        cuts = np.searchsorted(end[order], np.arange(1, sizes.max() + 2))
        if sizes.max() > LONGEST_BATCHED:
            self._fill_one(order, from_state, to_state, token, last, count)
        else:
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                at = order[a:b]
                before = last[from_state[at]]
                good = before < 0  # the word's first token
                rest = np.flatnonzero(~good)
                good[rest] = self.may_follow(before[rest], token[at[rest]])
                at = at[good]
                last[to_state[at]] = token[at]
                count[to_state[at]] = count[from_state[at]] + 1
        whole = np.r_[(buffer[1:] & 0xC0) != 0x80, True]  # bytes that end a character
        whole |= room == 1
        ends = np.flatnonzero(whole)
        owner = word_of[ends]
        reached = count[ends + owner + 1]
        opens = np.r_[True, owner[1:] != owner[:-1]]
        steps = np.diff(reached, prepend=0)
        steps[opens] = reached[opens]
        if np.abs(steps).max() > 127:
            raise ValueError("a step of more than 127 tokens")
        raw = steps.astype(np.int8).tobytes()
        stops = np.cumsum(np.bincount(owner, minlength=len(words))).tolist()
        return [raw[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def _fill_one(self, order, from_state, to_state, token, last, count) -> None:
        """The same for one very long word, position by position."""
        ended, counted = last.tolist(), count.tolist()
        for f, t, k in zip(from_state[order].tolist(), to_state[order].tolist(), token[order].tolist(), strict=True):
            if ended[t] < 0 and (f == 0 or self.follows(ended[f], k)):
                ended[t], counted[t] = k, counted[f] + 1
        last[:], count[:] = ended, counted


class PrefixCounter:
    """Steps of whole texts; remembers pieces in two generations of at most ``keep`` entries each."""

    def __init__(self, path: str, keep: int = 500_000):
        self.cutter = PieceEncoder(path, keep=0)
        if not self.cutter.byte_level or self.cutter.torn:
            raise ValueError("prefix counts need byte-level BPE whose added tokens do not take in their surroundings")
        self.vocabulary = Vocabulary(self.cutter.described)
        self.splitter = self.cutter.library.pre_tokenizer
        self.keep = keep
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}  # by words of the splitter
        added = sorted(self.cutter.added, key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")" if added else r"(?!)")
        self.added_texts = added

    def _count(self, words: set[str]) -> None:
        """Put words of the splitter that are not remembered yet into ``parts``."""
        new = [w for w in words if w not in self.parts]
        self.parts.update(zip(new, self.vocabulary.prefix_steps([w.encode("utf-8", "replace") for w in new]), strict=True))
        for w in {"'re", "'ve", "'ll"} & words:  # two characters of these are split into two words
            total = sum(np.frombuffer(self.parts[w], dtype=np.int8).tolist())
            self.parts[w] = np.array([1, 1, total - 2], dtype=np.int8).tobytes()

    def _words(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def _runs(self, words: list[str]) -> dict[int, str]:
        """By place of a word: the run of white space that ends with its first character, if it is longer."""
        spaces = [w[0] in SPACES and all(map(SPACES.__contains__, w)) for w in words]
        return {k + 1: w + words[k + 1][0] for k, w in enumerate(words[:-1]) if spaces[k] and words[k + 1][0] in SPACES}

    def _steps(self, words: list[str], runs: dict[int, str]) -> bytes:
        """Steps of a text from its words. Where a run of white space ends a prefix it is a single word; what
        comes after it gives its last character to the next word."""
        joined = b"".join(map(self.parts.__getitem__, words))
        if not runs:
            return joined
        steps, at = np.frombuffer(joined, dtype=np.int8).astype(np.int64), 0
        for k, w in enumerate(words):
            if k in runs:
                alone = int(np.frombuffer(self.parts[runs[k]], dtype=np.int8)[-1])
                carried = steps[at] - alone
                steps[at] = alone
                steps[at + 1] += carried
            at += len(w)
        return steps.astype(np.int8).tobytes()

    def _split_all(self, texts: list[str]) -> list[bytes]:
        """Steps of texts without added tokens, by the library's own splitter."""
        worded = list(map(self._words, texts))
        runs = list(map(self._runs, worded))
        self._count(set().union(*worded, *(r.values() for r in runs)))
        return [self._steps(w, r) for w, r in zip(worded, runs, strict=True)]

    def _learn(self, missing: set[str]) -> None:
        young, old = self.young, self.old
        plain, odd, needed = [], [], set()
        for p in missing:
            if (known := old.get(p)) is not None:
                young[p] = known
            elif m := PLAIN.fullmatch(p):
                lead, word, marks = m.groups()
                cut = (lead, word, marks) if lead else (" " + word, marks) if word else (" " + marks, "")
                plain.append((p, cut))
                needed.update(cut)
            else:
                odd.append(p)
        needed.discard("")
        if len(self.parts) > self.keep:
            self.parts = {}
        self.parts[""] = b""
        self._count(needed)
        parts = self.parts
        young.update((p, b"".join(map(parts.__getitem__, cut))) for p, cut in plain)
        young.update(zip(odd, self._split_all(list(map(piece_text, odd))), strict=True))

    def _with_added(self, text: str) -> bytes:
        """A text with added tokens: until its last character such a token is text like any other."""
        cut, out = self.added.split(text), []
        for k in range(0, len(cut) - 1, 2):
            before, token = cut[k], cut[k + 1]
            done, open_ = self._plain_texts([before, before + token[:-1]])
            total = lambda s: int(np.frombuffer(s, dtype=np.int8).sum(dtype=np.int64))
            out += [open_, np.array([total(done) + 1 - total(open_)], dtype=np.int8).tobytes()]
        return b"".join(out) + self._plain_texts([cut[-1]])[0]

    def _plain_texts(self, texts: list[str]) -> list[bytes]:
        """Steps of texts without added tokens."""
        named = list(map(self.cutter.names, texts))
        if len(self.young) > self.keep:
            self.old, self.young = self.young, {}
        missing = set().union(*(n[1] for n in named if n)).difference(self.young)
        if missing:
            self._learn(missing)
        firsts = list({n[0] for n in named if n} - {""})
        first = dict(zip(firsts, self._split_all(firsts), strict=True)) | {"": b""}
        whole = iter(self._split_all([t for t, n in zip(texts, named, strict=True) if n is None]))
        out = [b"".join([first[n[0]], *map(self.young.__getitem__, n[1])]) if n else next(whole) for n in named]
        for p in missing:
            if len(p) > LONGEST_KEPT:
                self.young.pop(p, None)
        if len(self.parts) > self.keep:
            self.parts = {}
        return out

    def steps(self, texts: list[str]) -> list[bytes]:
        """A signed byte for each character of each text."""
        out: list[bytes] = []
        for part in chunks(texts, CHUNK):
            marked = [any(map(t.__contains__, self.added_texts)) for t in part]
            plain = iter(self._plain_texts([t for t, m in zip(part, marked, strict=True) if not m]))
            out += [self._with_added(t) if m else next(plain) for t, m in zip(part, marked, strict=True)]
        return out


@functools.lru_cache(maxsize=2)
def shared_counter(path: str) -> PrefixCounter:
    """The counter of this Python worker: its memory of pieces serves task after task."""
    return PrefixCounter(path)
