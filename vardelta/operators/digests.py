"""Digests of sets of rows in which a row may stand several times.

A row's fields are framed (length before content, nulls marked), so no two different rows give the same text; its
SHA-256 is taken as four numbers of 60 bits, and a digest is their sums modulo 2 ** 60. Sums do not depend on the
order, copies do not cancel one another, and a digest follows changes: the digests of rows that came are added,
those of rows that went subtracted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMBS, DIGITS = 4, 15
MODULUS = 16**DIGITS


def framed(*columns: str) -> Column:
    """The fields of a row as one text that no other fields give."""
    cells = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in cells])


def multiset_digest(rows: DataFrame, by: list[str]) -> DataFrame:
    """(``by``, n, digest) of the rows of each group, over all columns; ``digest`` is an array of :data:`LIMBS` numbers.

    Without ``by`` there is one row, that of no rows being zeros.
    """
    h = F.sha2(framed(*rows.columns), 256)
    limb = lambda k: F.conv(F.substring(h, DIGITS * k + 1, DIGITS), 16, 10).cast("decimal(20,0)")
    sums = rows.select(*by, *[limb(k).alias(f"__{k}") for k in range(LIMBS)]).groupBy(*by)
    total = lambda k: (F.coalesce(F.sum(f"__{k}"), F.lit(0)) % MODULUS).cast("bigint")
    return sums.agg(F.count("*").alias("n"), F.array(*[total(k) for k in range(LIMBS)]).alias("digest"))


def updated_digest(before: DataFrame, came: DataFrame, went: DataFrame, by: list[str]) -> DataFrame:
    """Digests (as :func:`multiset_digest` gives) of ``before`` after rows ``came`` and ``went``; emptied groups go."""
    def signed(rows: DataFrame, sign: int) -> DataFrame:
        limbs = F.transform("digest", lambda x: x.cast("decimal(20,0)") * sign)
        return rows.select(*by, (F.col("n") * sign).alias("n"), limbs.alias("digest"))

    every = signed(before, 1).unionByName(signed(came, 1)).unionByName(signed(went, -1))
    limb = lambda k: F.pmod(F.sum(F.get("digest", F.lit(k))), F.lit(MODULUS).cast("decimal(20,0)")).cast("bigint")
    summed = every.groupBy(*by).agg(F.sum("n").alias("n"), F.array(*[limb(k) for k in range(LIMBS)]).alias("digest"))
    return summed.where("n > 0")


def digest_text(digest: Column) -> Column:
    """A digest as 60 hexadecimal digits."""
    return F.array_join(F.transform(digest, lambda x: F.lower(F.lpad(F.hex(x), DIGITS, "0"))), "")
