"""Quality rules by compression bands.

Text that zstandard shrinks far more than prose of its length is repetitive; text that it hardly
shrinks is noise. The ratio (raw bytes / compressed bytes) is taken over the whole document and over
fixed chunks of it, and held against limits for the document's length. Everything is local to a row:
one Arrow UDF, no shuffle, memory of one batch.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vardelta.llm._shared import without

SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

#: Type of the struct that :func:`measure` gives.
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_bytes long, ratio double, n_chunks long, n_chunks_out long, base_failed boolean, kept boolean"
)


@dataclass(frozen=True)
class Bands:
    """Limits of the compression ratio.

    ``whole``: (from so many bytes on, least ratio, greatest ratio); the last entry that the length
    reaches holds. ``chunk_bytes`` long pieces (a shorter rest of under half of that goes with the piece before it, so all of a
    text is in some piece unless all of it is shorter than that) must lie in ``chunk_band``; a document goes if more than ``chunk_share`` of its pieces lie outside.

    The least ratios lie below those of all rows with 50 words or more of the documents at sf0.1 (1.34, 1.43,
    1.69, 1.92, 2.21 and 2.57 from the lengths on; 1.69 for pieces) and above those of random printable
    ASCII, base64 and CJK (1.09 to 1.39); from 2 KB on also above those of random lower-case letters (1.72).
    """

    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 3.0),
        (256, 1.25, 3.2),
        (512, 1.35, 3.2),
        (1024, 1.5, 3.8),
        (2048, 1.75, 3.8),
        (8192, 1.8, 5.0),
        (65536, 1.8, 6.0),
    )
    chunk_bytes: int = 2048
    chunk_band: tuple[float, float] = (1.6, 4.0)
    chunk_share: float = 0.2
    level: int = 3
    min_words: int = 50
    max_repeat_percent: int = 50


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in the text, the first one included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, end = 0, 0
    for start, window in enumerate(windows):
        if counts[window] > 1:
            covered += start + 3 - max(start, end)
            end = start + 3
    return covered


def duplicate_lines(raw: bytes) -> int:
    """Lines (split at newlines) that hold a word and equal an earlier line."""
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def _measure_rows(batches: Iterator[pa.Array], bands: Bands) -> Iterator[pa.Array]:
    import zstandard

    packer = zstandard.ZstdCompressor(level=bands.level)
    low, high = bands.chunk_band
    kinds = {"double": pa.float64(), "boolean": pa.bool_(), "long": pa.int64()}
    fields = [(name, kinds[kind]) for name, kind in (f.split() for f in MEASURES.split(", "))]

    def one(raw: bytes) -> tuple:
        words = raw.split()
        n_words, size = len(words), len(raw)
        chars = size - sum(raw.count(bytes([s])) for s in SPACES)
        if not raw.isascii():
            chars = len(b"".join(words).decode("utf-8", "replace"))
        repeats = repeated_words(words)
        del words
        ratio = size / len(packer.compress(raw)) if size else 0.0
        step = bands.chunk_bytes
        pieces = [raw[i : i + step] for i in range(0, size, step)]
        if len(pieces) > 1 and len(pieces[-1]) * 2 < step:  # a short tail is judged with the piece before it
            tail = pieces.pop()
            pieces[-1] += tail
        elif pieces and len(pieces[-1]) * 2 < step:  # a short text is judged as a whole only
            pieces = []
        out = sum(not low <= len(p) / len(packer.compress(p)) <= high for p in pieces)
        base_failed = n_words < bands.min_words or 100 * repeats > bands.max_repeat_percent * n_words
        least, greatest = [(a, b) for start, a, b in bands.whole if size >= start][-1]
        kept = not base_failed and least <= ratio <= greatest and out <= bands.chunk_share * len(pieces)
        return (
            n_words, chars, size - len(raw.translate(None, SYMBOLS)), duplicate_lines(raw), repeats,
            size, ratio, len(pieces), out, base_failed, kept,
        )

    for texts in batches:
        rows = [one(t.as_py() or b"") for t in texts.cast(pa.binary())]
        columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
        yield pa.StructArray.from_arrays(
            [pa.array(list(c), type=kind) for c, (_, kind) in zip(columns, fields, strict=True)],
            names=[name for name, _ in fields],
        )


def measure(text: Column, bands: Bands = Bands()) -> Column:
    """Struct of the base measures, the ratios and the verdict (:data:`MEASURES`) of a text column.

    A null text counts as an empty one: no words, so it fails the base rules.
    """

    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _measure_rows(batches, bands)

    rows.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(rows, returnType=f"struct<{MEASURES.replace(' ', ':').replace(',:', ',')}>")(text)


def judge(docs: DataFrame, text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """Every row of ``docs`` with its measures and verdict as further columns.

    Null or empty text: all counts 0, ``base_failed``. Repeated rows are judged one by one and alike;
    an input column that has the name of a measure is replaced; an empty table gives an empty table.
    """
    names = [f.split()[0] for f in MEASURES.split(", ")]
    kept = [c for c in without(docs, *names).columns]
    rated = docs.select(*[F.col(f"`{c}`") for c in kept], measure(F.col(text), bands).alias("__m"))
    return rated.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"__m.{n}").alias(n) for n in names])


def accept(docs: DataFrame, text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The rows that pass, with the columns of ``docs``."""
    marked = docs.withColumn("__m", measure(F.col(text), bands))
    return marked.where("__m.kept").drop("__m")
