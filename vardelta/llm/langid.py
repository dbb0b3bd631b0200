"""Language identification by nearest centroid.

A text is a vector of hashed byte n-grams (1 to 4 bytes of the lower-cased words), weighted by TF-IDF and
scaled to length 1. Each language has several centroids, clustered on the sphere from a bounded sample of
labelled texts; a text gets the language of the centroid with the greatest cosine, and is rejected if even
that is further away than the language's own training texts nearly always are.

Document frequencies are counted over all labelled texts in one distributed pass; only vectors of the
sample, and sums of fixed size, leave a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vardelta.llm._shared import without

DIMENSIONS = 1 << 13
ORDERS = (1, 2, 3, 4)
#: Labelled texts of a language that centroids are clustered from, the first by a hash of their text.
MOST_SAMPLE = 2_000
CENTROIDS = 4
#: Bytes of a text that are counted at once.
STRETCH = 1 << 20
UNDETERMINED = "und"


#: What stands between letters says little about a language and much about the layout: it becomes a space.
NO_LETTERS = re.compile(r"[\W\d_]+")


@dataclass
class Model:
    """``centroids`` (n, dimensions) of unit length, their languages, the IDF and the least cosines."""

    languages: list[str]
    owner: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    least: dict[str, float]


def counts(text: str) -> np.ndarray:
    """Occurrences of the hashed n-grams of the whole text."""
    raw = (" " + NO_LETTERS.sub(" ", text.lower()) + " ").encode("utf-8", "replace")
    total = np.zeros(DIMENSIONS, dtype=np.float64)
    for start in range(0, len(raw), STRETCH):
        part = np.frombuffer(raw[start : start + STRETCH + ORDERS[-1] - 1], dtype=np.uint8).astype(np.uint32)
        for n in ORDERS:
            size = min(len(part) - n + 1, STRETCH)
            if size <= 0:
                continue
            h = np.full(size, 0x811C9DC5 + n, dtype=np.uint32)
            for k in range(n):
                h = (h ^ part[k : k + size]) * np.uint32(0x01000193)
            total += np.bincount((h ^ (h >> np.uint32(15))) & np.uint32(DIMENSIONS - 1), minlength=DIMENSIONS)
    return total


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return vectors / np.where(length > 0, length, 1.0)


def vector(text: str, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vector, term frequencies damped by the logarithm."""
    return _unit(np.log1p(counts(text)) * idf)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def inverse_frequencies(labelled: DataFrame, text: str) -> np.ndarray:
    """IDF over all rows: one array of fixed size leaves each task, and they are summed."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(DIMENSIONS, dtype=np.int64), 0
        for batch in batches:
            for t in batch.column(0):
                seen += counts(t.as_py()) > 0
                rows += 1
        at = [*np.flatnonzero(seen).tolist(), -1]
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "n": pa.array([*seen[seen > 0].tolist(), rows], pa.int64())})

    found = labelled.select(text).mapInArrow(sums, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    by_bucket = {r.bucket: r.n for r in found.collect()}
    rows = by_bucket.pop(-1, 0)
    idf = np.full(DIMENSIONS, np.log(1.0 + rows))
    for bucket, n in by_bucket.items():
        idf[bucket] = np.log((1.0 + rows) / (1.0 + n)) + 0.05
    return idf


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from vectors far from each other, so it is the same each time."""
    mean = _unit(vectors.mean(axis=0))
    centres = [mean]
    nearest = vectors @ mean
    while len(centres) < min(k, len(vectors)):
        centres.append(vectors[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, vectors @ centres[-1])
    table = np.stack(centres)
    for _ in range(rounds):
        owner = np.argmax(vectors @ table.T, axis=1)
        table = np.stack([_unit(vectors[owner == c].sum(axis=0)) if (owner == c).any() else table[c] for c in range(len(table))])
    sizes = np.bincount(np.argmax(vectors @ table.T, axis=1), minlength=len(table))
    return table[sizes >= max(1, len(vectors) // 50)] if len(vectors) >= 50 else table


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang", most: int = MOST_SAMPLE, k: int = CENTROIDS,
    reject_share: float = 0.005,
) -> Model:
    """Model from labelled rows; rows without text, letters or label are passed over.

    The sample of a language are its ``most`` first distinct texts by hash (copies count once, however many there are).
    A text leaves its row as a vector of fixed size, so the task that clusters a language is bounded whatever the
    lengths of the texts; a sample in which several centroids are equally near gives a text to the first of them.
    ``reject_share`` of a language's sample lies below its least cosine.
    """
    usable = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    idf = inverse_frequencies(usable, text)
    hashed = usable.select(F.col(lang).alias("lang"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    edges = {r.lang: r.top for r in _first_hashes(hashed, most).collect()}
    keep = F.lit(False)
    for name, top in edges.items():
        keep = keep | ((F.col("lang") == F.lit(name)) & (F.col("h") <= F.lit(top)))
    sample = hashed.where(keep).dropDuplicates(["lang", "h"]).select("lang", "h", _vectors(F.col("text"), idf).alias("vector"))

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("h").head(most)
        vectors = np.stack([np.frombuffer(v, dtype=np.float32) for v in rows["vector"]])
        table = cluster(vectors, k)
        best = np.sort((vectors @ table.T).max(axis=1))
        least = float(best[int(reject_share * len(best))])
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "least": least, "centroid": [c.astype("float32").tobytes() for c in table]})

    found = sample.groupBy("lang").applyInPandas(one, "lang string, least double, centroid binary").collect()
    found = sorted(found, key=lambda r: (r.lang, r.centroid))
    languages = sorted({r.lang for r in found})
    table = [np.frombuffer(r.centroid, dtype=np.float32) for r in found]
    return Model(
        languages,
        np.array([languages.index(r.lang) for r in found], dtype=np.int64),
        np.stack(table) if table else np.zeros((0, DIMENSIONS), dtype=np.float32),
        idf,
        {r.lang: r.least for r in found},
    )


def _vectors(text: Column, idf: np.ndarray) -> Column:
    """The vector of each text, as bytes."""

    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([vector(t.as_py(), idf).astype(np.float32).tobytes() for t in texts], pa.binary())

    rows.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(rows, returnType="binary")(text)


#: A hash up to which so many times the wanted number of texts are expected holds that number all but surely.
MARGIN = 1.2


def _first_hashes(hashed: DataFrame, most: int) -> DataFrame:
    """For each language the hash up to which about :data:`MARGIN` times ``most`` distinct texts lie (all, if there are few).

    Copies are put together before anything is counted. Hashes are even, so a share of their range holds that share of them;
    a language of under twice as many texts is taken whole.
    """
    once = hashed.select("lang", "h").distinct()
    found = once.groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("low"), F.max("h").alias("high"))
    span = F.col("high").cast("double") - F.col("low").cast("double")
    share = F.lit(MARGIN * most) / F.col("n")
    top = F.when(F.col("n") <= 2 * most, F.col("high")).otherwise((F.col("low").cast("double") + span * share).cast("long"))
    return found.select("lang", top.alias("top"))


def predict(text: Column, model: Model) -> Column:
    """Struct ``lang``, ``score`` (cosine), ``rejected``; ``und`` for null and for texts without a letter."""
    fields = [("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())]

    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = model.centroids.astype(np.float64).T
        for texts in batches:
            out = [(UNDETERMINED, 0.0, True)] * len(texts)
            for i, t in enumerate(texts):
                t = t.as_py()
                if t is None or not model.languages or not has_letter(t):
                    continue
                cosines = vector(t, model.idf) @ table
                best = int(np.argmax(cosines))
                lang, score = model.languages[model.owner[best]], float(min(1.0, max(0.0, cosines[best])))
                out[i] = (lang, score, score < model.least[lang])
            yield pa.StructArray.from_arrays(
                [pa.array([r[k] for r in out], type=kind) for k, (_, kind) in enumerate(fields)],
                names=[n for n, _ in fields],
            )

    rows.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(rows, returnType="struct<lang:string,score:double,rejected:boolean>")(text)


def identify(docs: DataFrame, model: Model, text: str = "text", reject: bool = True) -> DataFrame:
    """Every row with ``lang_pred``, ``score`` and ``rejected``.

    With ``reject`` a rejected text is ``und``; without, it keeps the nearest language and only the flag
    tells. Input columns with the new names are replaced; empty tables stay empty.
    """
    kept = [F.col(f"`{c}`") for c in without(docs, "lang_pred", "score", "rejected").columns]
    found = docs.select(*kept, predict(F.col(text), model).alias("__l"))
    lang = F.col("__l.lang")
    if reject:
        lang = F.when(F.col("__l.rejected"), F.lit(UNDETERMINED)).otherwise(lang)
    return found.select(*kept, lang.alias("lang_pred"), F.col("__l.score").alias("score"), F.col("__l.rejected").alias("rejected"))
