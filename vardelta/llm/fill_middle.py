"""Fill-in-middle transformation: a text is cut in three and its middle is moved behind the rest.

A batch of texts is worked on as whole Arrow columns: a mark that UTF-8 never has is put behind every unit,
texts are split at it into lists, the lists are flattened with the index of their text, each unit's ordinal
decides its role, the units of a role are filtered out, lists are rebuilt from them and joined, and the pieces
are put together with their sentinels. Everything is local to a row: no shuffle, and memory is that of a
stretch of rows with a few megabytes of text (or of one longer text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Units over UTF-8 bytes: a run of letters, or any other character (all of its bytes).
UNITS = r"([A-Za-z]+|[\x00-\x40\x5b-\x60\x7b-\x7f]|[\x{80}-\x{ff}][\x{80}-\x{bf}]*)"
#: A byte that UTF-8 never has.
MARK = b"\xff"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ANY_SENTINEL = "<[PSM]>"
#: Text bytes that are worked on at once.
STRETCH = 4 << 20
COLUMNS = ("n", "form", "prefix_chars", "middle_chars", "output")


def _modulo(value: pa.Array, by: pa.Array | pa.Scalar) -> pa.Array:
    """Remainder of numbers that are not negative."""
    return pc.subtract(value, pc.multiply(pc.divide(value, by), by))


def _offsets(counts: pa.Array) -> pa.Array:
    return pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(counts).cast(pa.int32())])


def cut(texts: pa.Array, draws: list[pa.Array], plain_from: int, spm_below: int) -> pa.StructArray:
    """One stretch of texts (binary, no nulls): ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``."""
    units = pc.split_pattern(pc.replace_substring_regex(texts, pattern=UNITS, replacement=b"\\1" + MARK), pattern=MARK)
    # the mark behind the last unit leaves an empty string after it, which goes with the suffix
    n = pc.subtract(pc.list_value_length(units).cast(pa.int64()), 1)
    ends = [_modulo(d, pc.add(n, 1)) for d in draws[:2]]
    first, last = pc.min_element_wise(*ends), pc.max_element_wise(*ends)
    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
    starts = units.offsets.slice(0, len(units)).cast(pa.int64())
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(starts, parent))
    before, until = (pc.less(ordinal, pc.take(x, parent)) for x in (first, last))
    roles = (
        (before, first),
        (pc.and_not(until, before), pc.subtract(last, first)),
        (pc.invert(until), pc.subtract(pc.add(n, 1), last)),
    )
    prefix, middle, suffix = (
        pc.binary_join(pa.ListArray.from_arrays(_offsets(size), pc.filter(flat, mine)), b"") for mine, size in roles
    )
    plain = pc.or_(
        pc.or_(pc.equal(n, 0), pc.match_substring_regex(texts, ANY_SENTINEL)),
        pc.greater_equal(_modulo(draws[2], pa.scalar(100, pa.int64())), plain_from),
    )
    swapped = pc.less(_modulo(draws[3], pa.scalar(100, pa.int64())), spm_below)
    p, s, m = (pa.scalar(x.encode(), pa.binary()) for x in (PREFIX, SUFFIX, MIDDLE))
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, b"")
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, b"")
    none = pa.scalar(None, pa.int64())
    chars = [pc.if_else(plain, none, pc.utf8_length(x.cast(pa.string())).cast(pa.int64())) for x in (prefix, middle)]
    form = pc.if_else(plain, "plain", pc.if_else(swapped, "spm", "psm"))
    output = pc.if_else(plain, texts, pc.if_else(swapped, spm, psm)).cast(pa.string())
    return pa.StructArray.from_arrays([n, form, *chars, output], names=list(COLUMNS))


def stretches(texts: pa.Array, most: int = STRETCH) -> Iterator[tuple[int, int]]:
    """(first row, rows) of stretches with about ``most`` bytes; a longer text is one of its own."""
    start, total = 0, 0
    for at, size in enumerate(pc.binary_length(texts).to_pylist()):
        if at > start and total + size > most:
            yield start, at - start
            start, total = at, 0
        total += size
    if start < len(texts):
        yield start, len(texts) - start


def _cutter(plain_from: int, spm_below: int):
    def rows(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, *draws in batches:
            raw = pc.fill_null(texts.cast(pa.binary()), b"")
            parts = [
                cut(pa.concat_arrays([raw.slice(at, k)]), [d.slice(at, k) for d in draws], plain_from, spm_below)
                for at, k in stretches(raw)
            ]
            yield pa.concat_arrays(parts)

    rows.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    return F.arrow_udf(rows, returnType="n long, form string, prefix_chars long, middle_chars long, output string")


def draws_of(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2 ** 32 that ``seed`` and ``key`` decide; a null key draws as the empty string does."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, plain_percent: int = 10, spm_percent: int = 20
) -> DataFrame:
    """``docs`` with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    A unit is a run of letters A-Z, a-z or any other character. Both cuts lie at ordinals drawn from the key, so rows
    with equal keys and texts are cut alike, whatever else is in the table. ``plain_percent`` of the texts stay
    as they are, and so do empty texts and those that hold a sentinel: only then can every output be turned back.
    Of the others ``spm_percent`` begin with the suffix. A null text is an empty one (n 0, plain), a null key
    draws as an empty one. Texts may be of any length below 2 GB; an empty table gives no rows. Input columns that bear the
    name of an output column give way to it.
    """
    if not 0 <= plain_percent <= 100 or not 0 <= spm_percent <= 100:
        raise ValueError("percents lie between 0 and 100")
    found = _cutter(100 - plain_percent, spm_percent)(F.col(text), *draws_of(F.col(key), seed))
    marked = docs.withColumn("__fim", found)
    taken = [F.col(f"__fim.{c}").alias(c) for c in COLUMNS]
    return marked.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in COLUMNS], *taken)


def restore(output: Column, form: Column) -> Column:
    """The text that an output of :func:`transform` was made from."""
    parts = F.split(output, ANY_SENTINEL, 4)
    one, two, three = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return (
        F.when(form == "psm", F.concat(one, three, two))
        .when(form == "spm", F.concat(two, three, one))
        .otherwise(output)
    )
