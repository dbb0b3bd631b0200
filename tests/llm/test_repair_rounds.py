"""Re-Pair with the production defaults."""

import numpy as np

from vardelta.llm import _repair


def test_rounds_go_on_until_no_pair_is_frequent():
    passage = np.random.default_rng(2).integers(0, 50_257, 1000).astype(np.uint32)
    for ids in (np.tile(passage, 260), np.full(1 << 18, 7, dtype=np.uint32), np.random.default_rng(3).integers(0, 90, 1 << 18).astype(np.uint32)):
        grammar = _repair.compress(ids, 50_257)
        assert (_repair.expand(grammar, grammar.symbols) == ids).all()
        s = grammar.symbols.astype(np.uint64)
        assert len(s) < 2 or np.unique((s[:-1] << np.uint64(32)) | s[1:], return_counts=True)[1].max() < 16
        for k in range(0, len(grammar.rules), 97):  # stored lengths are those of the expansions
            assert len(_repair.expand(grammar, np.array([50_257 + k]))) == grammar.lengths[k]
    assert len(_repair.compress(np.tile(passage, 260), 50_257).symbols) < 260 * 1000 / 100
    assert len(np.unique(_repair.compress(np.tile(passage, 260), 50_257).rules, axis=0)) > 900


def places_apart(symbols):
    """How often each pair stands without overlapping itself, from the left."""
    last, count = {}, {}
    for k, pair in enumerate(zip(symbols, symbols[1:], strict=False)):
        if last.get(pair, -2) < k - 1:
            last[pair], count[pair] = k, count.get(pair, 0) + 1
    return count


def test_few_copies_of_a_passage_shrink():
    """Fifteen, and three, copies of a passage between ids that never come again."""
    rng = np.random.default_rng(11)
    for copies in (3, 15):
        passage = rng.integers(0, 20_000, 200)
        between = np.split(20_000 + rng.permutation(30_000)[:1000], np.sort(rng.choice(999, copies - 1, replace=False)) + 1)
        ids = np.concatenate([x for b in between for x in (b, passage)]).astype(np.uint32)
        grammar = _repair.compress(ids, 50_257)
        assert (_repair.expand(grammar, grammar.symbols) == ids).all()
        assert len(grammar.symbols) <= 1000 + 2 * copies
        assert len(grammar.symbols) + 2 * len(grammar.rules) < len(ids)


def test_ends_where_no_rule_would_pay():
    rng = np.random.default_rng(12)
    for top, n in ((3, 300), (30, 2000), (400, 5000), (1, 40)):
        ids = rng.integers(0, top, n).astype(np.uint32)
        grammar = _repair.compress(ids, 50_257)
        assert (_repair.expand(grammar, grammar.symbols) == ids).all()
        assert max(places_apart(grammar.symbols.tolist()).values(), default=0) < _repair.PAYS
