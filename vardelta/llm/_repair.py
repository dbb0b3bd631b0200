"""Re-Pair: a sequence of ids as a grammar, one shard (block) at a time.

In each round all pairs of neighbours are counted, the frequent ones become nonterminals, and their
occurrences (left to right, without overlap) are replaced. A rule's two symbols are older than the
rule, so expansion lengths follow in one pass and any range of ids can be decoded without the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


SLOT_BITS = 18
#: A rule is two symbols and saves one at each use: from the third use on it pays for itself.
PAYS = 3


@dataclass
class Grammar:
    """``symbols`` below ``base`` are ids; ``base + k`` stands for the pair ``rules[k]``."""

    base: int
    rules: np.ndarray  # (n, 2) uint32
    lengths: np.ndarray  # uint32: ids that rule k expands to
    symbols: np.ndarray  # uint32


def _opens(differ: np.ndarray) -> np.ndarray:
    """Where runs begin, by whether each value but the first differs from the one before."""
    out = np.ones(len(differ) + 1, dtype=bool)
    out[1:] = differ
    return out


def _apart(opens: np.ndarray) -> np.ndarray:
    """Of neighbouring places every second one, from the left of each run; ``opens`` marks where runs begin."""
    places = np.arange(len(opens))
    run = np.maximum.accumulate(np.where(opens, places, 0))
    return (places - run) & 1 == 0


def compress(ids: np.ndarray, base: int, least: int = PAYS) -> Grammar:
    """Grammar of ``ids`` (all below ``base``): rounds go on until no pair is apart ``least`` times or more.

    All pairs are counted exactly in the first round. Later only such pairs can be frequent as hold a symbol
    of the round before, or were frequent then and lost some occurrences to their neighbours; only these are
    counted again. What is sorted to count it are the pairs whose hash slot is that full at least, so that no
    frequent pair is missed. A pair of which other pairs took so many occurrences that fewer are left gets no rule and is
    counted again.

    A replaced symbol stays where it is and is passed over by links, so a round costs what it counts. Links and symbols
    are closed up when a third of them is gone.
    """
    sequence = ids.astype(np.int32)
    room = len(sequence) // max(1, least) + 1  # each rule takes so many symbols away
    lengths = np.ones(base + room, dtype=np.uint32)
    rules, next_symbol = [], base
    gone = 0

    def linked() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        places = np.arange(len(sequence), dtype=np.int32)
        return places + 1, places - 1, np.full(len(sequence), -1, dtype=np.int32)

    after, before, seen = linked()  # neighbours; the number of the frequent pair that begins here, else -1
    at = np.arange(len(sequence) - 1)  # where pairs to be counted begin
    while len(at) >= least:
        width, places = int(next_symbol - 1).bit_length(), len(sequence).bit_length()
        if 2 * width + places > 63:
            raise ValueError("a block of so many ids and symbols can't be counted")
        keys = (sequence[at].astype(np.int64) << width) | sequence[after[at]]
        packed = (keys << places) | at
        if len(at) > 1 << SLOT_BITS - 3:
            slots = ((keys * 0x1E3779B97F4A7C15) >> 40) & ((1 << SLOT_BITS) - 1)
            packed = packed[np.bincount(slots, minlength=1 << SLOT_BITS)[slots] >= least]
        if not len(packed):
            break
        packed.sort()
        pair = packed >> places
        first = np.flatnonzero(_opens(pair[1:] != pair[:-1]))
        counts = np.diff(first, append=len(pair))
        frequent = counts >= least
        if not frequent.any():
            break
        where = packed[np.repeat(frequent, counts)] & ((1 << places) - 1)
        seen[where] = np.repeat(np.arange(frequent.sum(), dtype=np.int32), counts[frequent])
        where.sort()
        kind = seen[where]
        chosen = _apart(_opens(after[where[:-1]] != where[1:]))
        used = np.bincount(kind[chosen], minlength=frequent.sum()) >= least
        if not used.any():  # neighbours leave each other too few: one pair alone may still have enough
            for k in np.argsort(-counts[frequent], kind="stable"):
                own = np.flatnonzero(kind == k)
                alone = own[_apart(_opens(after[where[own[:-1]]] != where[own[1:]]))]
                if len(alone) >= least:
                    chosen[:] = False
                    chosen[alone], used[k] = True, True
                    break
            else:
                break
        chosen &= used[kind]  # a pair that neighbours left too few gets no rule yet
        taken, number = where[chosen], next_symbol + np.cumsum(used) - 1
        lost = after[taken]
        sequence[taken], sequence[lost] = number[kind[chosen]], -1
        after[taken] = after[lost]
        inside = taken[after[taken] < len(sequence)]
        before[after[inside]] = inside
        made = pair[first[frequent][used]]
        table = np.stack([made >> width, made & ((1 << width) - 1)], axis=1)
        rules.append(table)
        lengths[next_symbol : next_symbol + len(table)] = lengths[table[:, 0]] + lengths[table[:, 1]]
        next_symbol += len(table)
        # next: what holds a new symbol, and what was frequent while a neighbour was taken
        left = before[taken]
        left = left[left >= 0]
        at = np.concatenate([left[seen[left] < 0], where[sequence[where] >= 0]])
        at = at[after[at] < len(sequence)]
        seen[where] = -1
        gone += len(taken)
        if 3 * gone > len(sequence):
            stays = sequence >= 0
            at = (np.cumsum(stays) - 1)[at]
            sequence, gone = sequence[stays], 0
            after, before, seen = linked()
    table = np.concatenate(rules) if rules else np.zeros((0, 2))
    return Grammar(base, table.astype(np.uint32), lengths[base:next_symbol], sequence[sequence >= 0].astype(np.uint32))


def _unfold(base: int, rules: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The ids of ``symbols``, level by level."""
    out = symbols
    while len(out) and (inner := out >= base).any():
        ends = np.cumsum(inner.astype(np.int64) + 1)
        grown = np.empty(ends[-1], dtype=np.uint32)
        grown[ends[~inner] - 1] = out[~inner]
        pairs = rules[out[inner] - base]
        grown[ends[inner] - 2], grown[ends[inner] - 1] = pairs[:, 0], pairs[:, 1]
        out = grown
    return out


def expand(grammar: Grammar, symbols: np.ndarray) -> np.ndarray:
    """All ids that ``symbols`` stand for: the rules are unfolded once and then copied."""
    base = grammar.base
    text = np.concatenate([np.arange(base, dtype=np.uint32), _unfold(base, grammar.rules, grammar.rules.reshape(-1))])
    sizes = np.concatenate([np.ones(base, dtype=np.int64), grammar.lengths])
    begins = np.cumsum(sizes) - sizes
    wanted = sizes[symbols]
    ends = np.cumsum(wanted)
    shift = np.repeat(begins[symbols] - (ends - wanted), wanted)
    return text[np.arange(len(shift)) + shift]


def expand_range(grammar: Grammar, start: int, stop: int) -> np.ndarray:
    """The ids at ``start`` to ``stop`` (exclusive); only symbols that reach into the range are expanded."""
    symbols = grammar.symbols
    plain = symbols < grammar.base
    sizes = np.ones(len(symbols), dtype=np.int64)
    sizes[~plain] = grammar.lengths[symbols[~plain] - grammar.base]
    ends = np.cumsum(sizes)
    first, last = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left")
    part = expand(grammar, symbols[first : last + 1])
    skip = start - (ends[first] - sizes[first]) if first < len(ends) else 0
    return part[skip : skip + max(0, stop - start)]


def pack_bits(values: np.ndarray, bits: int) -> bytes:
    """Values of up to 24 bits, packed without gaps: eight values to ``bits`` bytes."""
    padded = np.zeros(-(-len(values) // 8) * 8, dtype=np.uint64)
    padded[: len(values)] = values
    groups = padded.reshape(-1, 8)
    out = np.zeros((len(groups), bits), dtype=np.uint8)
    for k in range(8):
        low = k * bits
        for byte in range(low // 8, (low + bits - 1) // 8 + 1):
            shift = byte * 8 - low
            moved = groups[:, k] >> np.uint64(shift) if shift >= 0 else groups[:, k] << np.uint64(-shift)
            out[:, byte] |= (moved & np.uint64(0xFF)).astype(np.uint8)
    return out.tobytes()


def unpack_bits(raw: bytes, bits: int, count: int) -> np.ndarray:
    groups = np.frombuffer(raw, dtype=np.uint8).reshape(-1, bits)
    out = np.zeros((len(groups), 8), dtype=np.uint32)
    for k in range(8):
        low = k * bits
        for byte in range(low // 8, (low + bits - 1) // 8 + 1):
            shift = byte * 8 - low
            column = groups[:, byte].astype(np.uint32)
            out[:, k] |= column << np.uint32(shift) if shift >= 0 else column >> np.uint32(-shift)
        out[:, k] &= np.uint32((1 << bits) - 1)
    return out.reshape(-1)[:count]
