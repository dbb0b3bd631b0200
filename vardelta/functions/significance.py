"""Compound clinical significances, review status, disease names, rarity.

A significance joins assertions by ``/`` and appends further ones by ``|``; it is read term by term.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vardelta import schemas as S


def _text(sig: Column) -> Column:
    return F.coalesce(sig, F.lit(""))


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def sig_terms(sig: Column) -> Column:
    """Terms of a significance, qualifiers attached; none for null."""
    return F.filter(F.split(_text(sig), "[/|]"), lambda t: t != "")


def plain(term: Column) -> Column:
    return F.regexp_replace(term, S.LOW_PENETRANCE + "$", "")


def is_actionable(sig: Column) -> Column:
    return _text(sig).rlike(S.ACTIONABLE_PATTERN)


def is_uncertain(sig: Column) -> Column:
    """Not actionable, and without a term or with an uncertain one."""
    terms = sig_terms(sig)
    return ~is_actionable(sig) & ((F.size(terms) == 0) | F.arrays_overlap(terms, _strings(S.UNCERTAIN_TERMS)))


def sig_flags(sig: Column) -> Column:
    """Qualifiers in words: low penetrance, then every other assertion once."""
    terms = sig_terms(sig)
    low = F.exists(terms, lambda t: t.endswith(S.LOW_PENETRANCE))
    mixed = F.exists(terms, lambda t: t.isin(S.ACTIONABLE_TERMS))
    note = F.when(low & mixed, F.array(F.lit("low penetrance (some submitters)"))).when(
        low, F.array(F.lit("low penetrance"))
    )
    others = F.transform(
        F.filter(terms, lambda t: ~plain(t).isin(S.ACTIONABLE_TERMS)),
        lambda t: F.replace(F.replace(t, F.lit("_"), F.lit(" ")), F.lit(" ,"), F.lit(",")),
    )
    empty = F.array().cast("array<string>")
    return F.concat(F.coalesce(note, empty), F.array_distinct(others))


def sig_rank(sig: Column) -> Column:
    """0: only Pathogenic; 1: a Pathogenic term; 2: the rest."""
    terms = sig_terms(sig)
    only = (F.size(terms) > 0) & F.forall(terms, lambda t: t == "Pathogenic")
    return F.when(only, 0).when(F.exists(terms, lambda t: plain(t) == "Pathogenic"), 1).otherwise(2)


def sig_cell(sig: Column) -> Column:
    """Display value: assertions joined by ``; ``, with a low-penetrance note."""
    text = F.replace(_text(sig), F.lit("|"), F.lit("; "))
    note = F.get(F.filter(sig_flags(sig), lambda f: f.startswith("low penetrance")), F.lit(0))
    return F.when(note.isNull(), text).otherwise(F.concat(text, F.lit(" ⚠️ "), note))


def path_ordinal(sig: Column) -> Column:
    """-1 benign, 1 pathogenic without conflict, else 0."""
    s = F.lower(_text(sig))
    return (
        F.when(s.contains("benign"), -1).when(s.contains("pathogenic") & ~s.contains("conflict"), 1).otherwise(0)
    )


def clinvar_class(sig: Column) -> Column:
    s = F.lower(_text(sig))
    return (
        F.when(s.contains("conflict"), "conflicting")
        .when(s.contains("pathogenic"), "path")
        .when(s.contains("benign"), "benign")
        .when(s.contains("uncertain") | s.contains("vus"), "vus")
        .when(s.isin("", "-"), "absent")
        .otherwise("other")
    )


def review_stars(revstat: Column) -> Column:
    """0 to 4 stars; unknown and null have none."""
    status = F.replace(_text(revstat), F.lit(" "), F.lit("_"))
    out = F.lit(0)
    for name, stars in S.REVIEW_STARS.items():
        out = F.when(status == name, F.lit(stars)).otherwise(out)
    return out


def disease_name(names: Column) -> Column:
    """The first telling name of a ``|`` list, cut at 55 characters; a dash for none."""
    parts = F.split(names, r"\|")
    telling = F.filter(
        parts, lambda p: ~F.lower(F.trim(p)).isin("not_provided", "not_specified", "see_cases", "")
    )
    name = F.replace(F.coalesce(F.get(telling, F.lit(0)), F.get(parts, F.lit(0))), F.lit("_"), F.lit(" "))
    cut = F.when(F.length(name) > 55, F.concat(F.substring(name, 1, 55), F.lit("…"))).otherwise(name)
    return F.when(_text(names) == "", F.lit("—")).otherwise(cut)


def rarity(af: Column) -> Column:
    return F.when(af.isNull(), "novel").when(af < S.RARE_AF, "rare").otherwise("common")
