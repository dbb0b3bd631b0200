"""Line dedup by site-relative frequency.

For each host: the share of its pages that hold a line. Lines above a ratio are boilerplate of that host
and are dropped from all its pages. Only DataFrame functions: pages are reduced to (host, digest of
line) pairs, each once a page, and counted with map-side sums; the boilerplate digests of a host (fewer
than distinct lines a page / ratio) come back to the pages as one array, so the texts themselves are
never shuffled by line. Lines are cut from the pages once and written to the shared folder, from where both
the counting and the dropping read them. Pages of a host are dealt over salts by their row, as one host may
hold a third of all pages; a salt that is still too large is split by Spark's skew join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vardelta.llm._shared import ascii_lower, materialize, without

SALTS = 32


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


#: Elements whose start or end breaks a line, and elements without visible text.
BREAKS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h[1-6]|head|header|hr|html|"
    "li|main|nav|ol|p|pre|section|table|tbody|td|th|thead|title|tr|ul"
)
HIDDEN = ("script", "style", "noscript", "template")
#: Comments, and hidden elements up to their own end tag.
UNSEEN = "(?is)" + "|".join(["<!--.*?-->", *(rf"<{tag}\b[^>]*>.*?</{tag}[\t-\r ]*>" for tag in HIDDEN)])


def html_lines(html: Column) -> Column:
    """The visible text of a page, a line for each block element. Entities stay as they are written."""
    text = F.regexp_replace(html, UNSEEN, " ")
    text = F.regexp_replace(text, r"[\t-\r ]+", " ")
    text = F.regexp_replace(text, r"(?i)</?(" + BREAKS + r")\b[^>]*>", "\n")
    return F.regexp_replace(text, r"<[^>]*>", "")


def clean_line(line: Column) -> Column:
    """What two lines are compared by: inner and outer spaces reduced."""
    return F.trim(F.regexp_replace(line, r"[ \t\r]+", " "))


def drop_boilerplate(
    pages: DataFrame, host: str, text: str, ratio: float = 0.3, salts: int = SALTS
) -> DataFrame:
    """Every page, its text column apart, with ``n_lines``, ``n_dropped`` and ``kept_text`` (its other lines, in order).

    A line counts once a page however often it stands there; all its copies go. Blank lines are never
    counted or kept. A line on one page only stays, so hosts with a single page lose nothing. A null text
    has no lines; a null host is a host of its own. Repeated rows count as pages of their own; input columns
    with the new names are replaced; an empty table stays empty.
    """
    base = without(pages, "n_lines", "n_dropped", "kept_text")
    lines = F.filter(
        F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), clean_line), lambda x: F.length(x) > 0
    )
    names = {c: f"__{k}" for k, c in enumerate(c for c in base.columns if c != text)}
    named = F.coalesce(F.concat(F.lit("="), F.col(host)), F.lit("null"))
    shown = [F.col(f"`{c}`").alias(n) for c, n in names.items()]
    lined = materialize(
        base.select(*shown, named.alias("__host"), lines.alias("__lines"), F.monotonically_increasing_id().alias("__row")),
        "page-lines",
    )
    digests = F.transform(F.array_distinct("__lines"), lambda x: F.unhex(F.md5(x)))
    counted = (
        lined.select("__host", F.explode(digests).alias("line"))
        .groupBy("__host", "line")
        .agg(F.count("*").alias("n"))
    )
    totals = lined.groupBy("__host").agg(F.count("*").alias("pages"))
    frequent = (
        counted.where(F.col("n") >= F.lit(2))
        .join(totals, "__host")
        .where(F.col("n") > F.lit(float(ratio)) * F.col("pages"))
        .groupBy("__host")
        .agg(F.collect_set("line").alias("__drop"))
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    salted = lined.withColumn("__salt", F.pmod(F.xxhash64("__row"), F.lit(salts)).cast("int"))
    joined = salted.join(frequent, ["__host", "__salt"], "left")
    drops = F.coalesce(F.col("__drop"), F.array().cast("array<binary>"))
    kept = F.when(F.col("__drop").isNull(), F.col("__lines")).otherwise(
        F.filter("__lines", lambda x: ~F.array_contains(drops, F.unhex(F.md5(x))))
    )
    return joined.withColumn("__kept", kept).select(
        *[F.col(n).alias(c) for c, n in names.items()],
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size("__kept")).cast("long").alias("n_dropped"),
        F.array_join("__kept", "\n").alias("kept_text"),
    )
