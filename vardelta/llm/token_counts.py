"""Token counts of every prefix.

For each character of a text its *step* is stored: by how much the exact number of tokens changes when the
prefix grows by it. The running sum of the steps is the count of each prefix, the library's count of that
very text; it may fall, as a longer token can take the place of several. Truncation and budget questions are
answered from the steps alone, nothing is encoded again. The counts come from dynamic programming
(:mod:`vardelta.llm._prefix_counts`). Local to a row: no shuffle, a byte a character.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vardelta.llm._prefix_counts import shared_counter
from vardelta.llm._shared import without


def counts(steps: Sequence[int]) -> np.ndarray:
    """The token count of every prefix, that of the first character first."""
    return np.cumsum(np.asarray(steps, dtype=np.int8), dtype=np.int64)


def fitting(steps: Sequence[int], budget: int) -> int:
    """Length in characters of the longest prefix of at most ``budget`` tokens."""
    found = np.flatnonzero(counts(steps) <= budget)
    return int(found[-1]) + 1 if len(found) else 0


def truncate(text: str, steps: Sequence[int], budget: int) -> str:
    """The longest prefix of the text within ``budget`` tokens."""
    return text[: fitting(steps, budget)]


def prefixes(text: Column, tokenizer: str, budgets: Sequence[int] = ()) -> Column:
    """Struct of ``steps``, ``n_tokens`` and ``within`` (characters that fit each budget); null counts as empty."""

    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = shared_counter(tokenizer)
        for texts in batches:
            steps = counter.steps([t or "" for t in texts.to_pylist()])
            read = [np.frombuffer(s, dtype=np.int8) for s in steps]
            at = pa.array(np.cumsum([0, *map(len, steps)]), type=pa.int32())
            within = [[fitting(s, b) for b in budgets] for s in read]
            yield pa.StructArray.from_arrays(
                [
                    pa.ListArray.from_arrays(at, pa.Array.from_buffers(pa.int8(), at[-1].as_py(), [None, pa.py_buffer(b"".join(steps))])),
                    pa.array([int(s.sum(dtype=np.int64)) for s in read], type=pa.int64()),
                    pa.array(within, type=pa.list_(pa.int64())),
                ],
                names=["steps", "n_tokens", "within"],
            )

    rows.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(rows, returnType="struct<steps:array<tinyint>,n_tokens:bigint,within:array<bigint>>")(text)


def with_prefixes(docs: DataFrame, tokenizer: str, budgets: Sequence[int] = (), text: str = "text") -> DataFrame:
    """Every row with ``steps``, ``n_tokens`` and ``within``.

    A null or empty text has no steps and 0 tokens. Rows are independent, so ties and repeats need no care; input
    columns called like the new ones are replaced; an empty table stays empty. The tokenizer file must be
    byte-level BPE with the usual splitter; another one is refused with an error.
    """
    kept = [F.col(f"`{c}`") for c in without(docs, "steps", "n_tokens", "within").columns]
    found = docs.select(*kept, prefixes(F.col(text), tokenizer, budgets).alias("__p"))
    return found.select(*kept, *[F.col(f"__p.{c}").alias(c) for c in ("steps", "n_tokens", "within")])
