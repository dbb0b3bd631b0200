"""Consequence terms and what they say about a gene's product."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vardelta import schemas as S


def _array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def csq_terms(csq: Column) -> Column:
    """Terms of a list joined by ``&`` or ``,``."""
    return F.split(F.coalesce(csq, F.lit("")), "[&,]")


def is_damaging(csq: Column, sift: Column, polyphen: Column) -> Column:
    null_like = csq.rlike("stop_gained|frameshift|splice_acceptor|splice_donor|start_lost")
    predicted = sift.startswith("deleterious") | polyphen.startswith("probably_damaging")
    return F.coalesce(null_like | (csq.contains("missense") & predicted), F.lit(False))


def short_consequence(csq: Column) -> Column:
    text = F.coalesce(csq, F.lit(""))
    out = F.split_part(text, F.lit(","), F.lit(1))
    for term in reversed(S.SHORT_TERMS):
        out = F.when(text.contains(term), F.lit(term)).otherwise(out)
    return out


def primary_consequence(csq: Column) -> Column:
    """The most severe known term, else the first one."""
    terms = csq_terms(csq)
    return F.coalesce(F.get(F.array_intersect(_array(S.SEVERITY), terms), F.lit(0)), F.get(terms, F.lit(0)))


def severity_rank(csq: Column) -> Column:
    """Place of the primary consequence in the order of severity; behind all for unknown ones."""
    place = F.array_position(_array(S.SEVERITY), primary_consequence(csq))
    return F.when(place > 0, place - 1).otherwise(len(S.SEVERITY)).cast("int")


def is_noncoding(csq: Column) -> Column:
    return F.arrays_overlap(csq_terms(csq), _array(S.REGULATORY_TERMS))


def bases(allele: Column) -> Column:
    return F.when(allele == "-", 0).otherwise(F.length(allele))


def class_scope(csq: Column, ref: Column, alt: Column) -> Column:
    """``none`` (not coding), ``deferred`` (an indel of more than 50 bases) or ``call``."""
    coding = primary_consequence(csq).isin(S.SEVERITY)
    return F.when(~coding, "none").when(F.abs(bases(alt) - bases(ref)) > S.MOST_INDEL, "deferred").otherwise("call")
