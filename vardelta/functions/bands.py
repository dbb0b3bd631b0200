"""Bands of model scores and of gene constraint."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vardelta import schemas as S


def splice_band(delta: Column) -> Column:
    return (
        F.when(delta >= S.SPLICE_HIGH, "high").when(delta >= S.SPLICE_LIKELY, "likely")
        .when(delta >= S.SPLICE_POSSIBLE, "possible").when(delta.isNotNull(), "low")
    )


def regulatory_band(delta: Column, percentile: Column) -> Column:
    """By percentile where there is one, else by the raw change."""
    by_rank = F.when(percentile >= S.PERCENT_HIGH, "high").when(percentile >= S.PERCENT_MODERATE, "moderate")
    by_size = F.when(F.abs(delta) >= S.DELTA_HIGH, "high").when(F.abs(delta) >= S.DELTA_MODERATE, "moderate")
    return F.when(delta.isNull(), None).when(
        percentile.isNotNull(), F.coalesce(by_rank, F.lit("low"))
    ).otherwise(F.coalesce(by_size, F.lit("low")))


def is_constrained(pli: Column, loeuf: Column) -> Column:
    """Whether the gene hardly tolerates loss; null (unknown) without any metric."""
    hit = F.coalesce(pli >= S.PLI_CONSTRAINED, F.lit(False)) | F.coalesce(loeuf < S.LOEUF_CONSTRAINED, F.lit(False))
    return F.when(pli.isNull() & loeuf.isNull(), None).otherwise(hit)


def sv_scorable(kind: Column, start: Column, end: Column, pos: Column, contig_length: Column) -> Column:
    """A deletion or duplication of at most 50 kb whose half-megabase window lies inside the contig."""
    inside = window_fits(pos, contig_length)
    return F.coalesce(kind.isin("DEL", "DUP") & (end - start <= 50_000) & inside, F.lit(False))


def window_fits(pos: Column, contig_length: Column) -> Column:
    return F.coalesce((pos > 524_288) & (pos + 524_288 <= contig_length), F.lit(False))
