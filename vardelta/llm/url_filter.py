"""URL filter: rules first, else logistic regression on hashed character n-grams of host and path.

Features: character 3- and 4-grams of the marked host and the marked path, hashed to ``DIMENSIONS``
buckets, each once, the vector scaled to length 1. The model is fitted by the DataFrame API of Spark's own machine
learning library on a small labelled table, and applied as a plain column expression: the weights
are one constant array, so scoring is a projection of the scan without join, shuffle or UDF.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, Normalizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vardelta.llm._shared import ascii_lower, constant_array, without

DIMENSIONS = 4096
LENGTHS = (3, 4)
#: Most rows of the labelled table that are used in fitting.
MOST_LABELS = 10_000

#: The labelled table, by topics that public block lists and site directories are ordered by.
UNWANTED = (
    # gambling
    "casino poker roulette blackjack baccarat slots jackpot betting bets wager bookie lottery bingo sportsbet gambling "
    # adult
    "porn porno xxx sex sexy erotic nude naked webcam camgirl escort fetish hentai milf adult "
    # pills and miracle cures
    "viagra cialis levitra pharmacy pills tablets steroids slimming dietpill detox anabolic opioid tramadol xanax "
    # fraud, malicious software, piracy
    "phishing malware spyware trojan ransomware keylogger botnet warez keygen serialz cracked nulled torrent piracy "
    "scam hoax fraud fakeid counterfeit replica knockoff payday quickloan cashnow getrich ponzi pyramid doubler airdrop "
    # advertising, search spam
    "adserver adclick popup popunder banner clicks tracker tracking affiliate backlink linkfarm seo spam bulkmail traffic"
).split()
WANTED = (
    # news, reference, teaching
    "news weather journal magazine gazette tribune archive library encyclopedia dictionary wiki atlas almanac university "
    "college school academy institute faculty research science physics chemistry biology astronomy geology history "
    # public life, health
    "museum gallery theatre opera council city county ministry parliament court police embassy charity church parish "
    "hospital clinic nursing dentist medicine health safety transport railway airport harbour postal weatherman "
    # trade and work
    "bakery butcher florist grocer market furniture hardware plumbing carpentry architect engineering surveyor insurance "
    "accounting lawyer notary printing publisher translation software developer data robotics electronics energy water "
    # leisure
    "garden cooking recipes travel camping hiking cycling sailing fishing football cricket chess music guitar piano choir "
    "books poetry photography painting pottery knitting film radio family wedding birds horses forest mountain island"
).split()
#: Neutral companions, used with both kinds.
COMPANIONS = "online site web page home world group center point store".split()
SHAPES = (
    "http://www.{0}.com/", "https://{0}.net/en/12", "http://blog.{0}.org/{0}/3.html", "https://m.{0}.de/1",
    "http://{1}.org/{0}/index.html", "https://{0}-{1}.com/", "http://{1}{0}.net/a/b", "https://{0}{1}.org/de/{1}",
)


@dataclass(frozen=True)
class Rule:
    """``host`` and all its subdomains, paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; a null url, or one without ``://``, has neither (both empty)."""
    match = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, match, 1), F.lit(""))
    return ascii_lower(host), F.coalesce(F.regexp_extract(url, match, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else nulls; of equally long ones the first."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = (host == rule.host) | host.endswith("." + rule.host)
        fits = fits & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _grams(mark: str, part: Column, n: int) -> Column:
    """Buckets of the n-grams of ``^part$``."""
    framed, count = F.concat(F.lit("^"), part, F.lit("$")), F.length(part) + 3 - n
    starts = F.when((count >= 1) & (F.length(part) > 0), F.sequence(F.lit(1), F.greatest(count, F.lit(1))))
    return F.transform(
        F.coalesce(starts, F.array().cast("array<int>")),
        lambda i: F.pmod(F.xxhash64(F.lit(mark), framed.substr(i, F.lit(n))), F.lit(DIMENSIONS)).cast("int"),
    )


def buckets(host: Column, path: Column) -> Column:
    """Bucket numbers of the n-grams, each once; none if host and path are empty."""
    grams = [_grams(mark, part, n) for mark, part in (("h", host), ("p", path)) for n in LENGTHS]
    return F.array_distinct(F.concat(*grams))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table (url, label, word): 1 is unwanted. Every word stands in every shape."""
    rows = [
        (shape.format(word, COMPANIONS[(k + m) % len(COMPANIONS)]), label, word)
        for words, label in ((UNWANTED, 1), (WANTED, 0)) for k, word in enumerate(words) for m, shape in enumerate(SHAPES)
    ]
    return spark.createDataFrame(rows, "url string, label int, word string")


def fit(labelled: DataFrame, most: int = MOST_LABELS, penalty: float = 5e-5) -> tuple[list[float], float]:
    """Weights and intercept from (url, label); at most ``most`` rows, by hash of the url, are used.

    The model has :data:`DIMENSIONS` weights whatever the input, and rows are brought into one fixed
    order first, so equal tables give equal models.
    """
    host, path = url_parts(F.col("url"))
    rows = labelled.where("url is not null and label is not null").orderBy(F.xxhash64("url"), "url", "label").limit(most)
    counted = rows.select("label", buckets(host, path).alias("b")).where(F.size("b") > 0).coalesce(1)
    share = counted.agg(F.avg("label")).first()[0] or 0.0
    weight = F.when(F.col("label") == 1, 0.5 / max(share, 1e-9)).otherwise(0.5 / max(1 - share, 1e-9))  # both classes alike
    named = counted.select(F.col("label").cast("double").alias("label"), weight.alias("weight"), F.col("b").cast("array<string>").alias("b"))
    vocabulary = CountVectorizer(inputCol="b", outputCol="counts", vocabSize=DIMENSIONS, binary=True).fit(named)
    units = Normalizer(inputCol="counts", outputCol="features", p=2.0).transform(vocabulary.transform(named))
    model = LogisticRegression(maxIter=40, regParam=penalty, standardization=False, weightCol="weight").fit(units.cache())
    units.unpersist()
    weights = [0.0] * DIMENSIONS
    for bucket, weight in zip(vocabulary.vocabulary, model.coefficients, strict=True):
        weights[int(bucket)] = round(float(weight), 6)
    return weights, round(float(model.intercept), 6)


def probability(host: Column, path: Column, weights: list[float], intercept: float) -> Column:
    """Model probability that the url is unwanted."""
    table = constant_array(weights, "double")
    found = buckets(host, path)
    total = F.aggregate(found, F.lit(0.0), lambda acc, b: acc + F.get(table, b))
    margin = F.lit(intercept) + total / F.sqrt(F.greatest(F.size(found), F.lit(1)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def judge(
    pages: DataFrame, rules: list[Rule], weights: list[float], intercept: float, url: str = "url", cut: float = 0.7
) -> DataFrame:
    """Every row with ``host``, ``path``, ``rule``, ``probability`` and ``verdict`` (allow or block).

    ``cut`` and the penalty of :func:`fit` were chosen by cross-validation on the labelled table alone, so that 0.99 of
    its wanted urls are allowed. A null or malformed url has an empty host and path and is left to the model, whose intercept then
    decides alone. Repeated urls get equal verdicts; input columns with the new names are replaced.
    """
    kept = without(pages, "host", "path", "rule", "probability", "verdict").columns
    host, path = url_parts(F.col(url))
    parted = pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("__host"), path.alias("__path"))
    rule, ruled = longest_rule(F.col("__host"), F.col("__path"), rules)
    scored = parted.select(
        "*", rule.alias("__rule"), ruled.alias("__ruled"),
        probability(F.col("__host"), F.col("__path"), weights, intercept).alias("__probability"),
    )
    model = F.when(F.col("__probability") > cut, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule"),
        F.col("__probability").alias("probability"), F.coalesce("__ruled", model).alias("verdict"),
    )
