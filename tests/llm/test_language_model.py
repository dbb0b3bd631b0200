"""The language model against a plain version of its sample, IDF, centroids and predictions."""

import random

import numpy as np

from vardelta.llm import langid

LABELLED = "text string, lang string, extra int"


def prose(rng, stem, n=30):
    return " ".join(rng.choice(stem) + rng.choice(["an", "el", "io", "um"]) for _ in range(n))


def rows(seed=3):
    rng = random.Random(seed)
    out = [(prose(rng, ["ka", "tor", "mi"]), "aa", 1) for _ in range(70)] + [(prose(rng, ["schw", "zwei", "pf"]), "bb", 1) for _ in range(60)]
    return [*out, out[0], (None, "aa", 1), ("12 34", "bb", 1), ("letters", None, 1), ("", "aa", 1)]


def test_many_copies_of_one_text_leave_room_for_all_others(spark):
    rng = random.Random(1)
    texts = [(prose(rng, ["ka", "lo", "mi", "ne"]), "aa", 0) for _ in range(300)]
    copies = spark.range(20_000).selectExpr("'one text again and again' as text", "'aa' as lang", "0 as extra")
    labelled = spark.createDataFrame(texts, LABELLED).unionByName(copies)
    hashed = labelled.selectExpr("lang", "xxhash64(text) as h", "text")
    top = langid._first_hashes(hashed, 2000).first().top
    assert hashed.where(f"h <= {top}").select("h").distinct().count() == 301
    top = langid._first_hashes(hashed, 100).first().top
    assert 100 <= hashed.where(f"h <= {top}").select("h").distinct().count() < 160


def test_model_equals_plain_version(spark):
    data = rows()
    model = langid.fit(spark.createDataFrame(data, LABELLED).repartition(3), most=40)
    usable = [(t, g) for t, g, _ in data if t and g and any(map(str.isalpha, t))]
    seen = sum((langid.counts(t) > 0).astype(int) for t, _ in usable)
    idf = np.where(seen > 0, np.log((1.0 + len(usable)) / (1.0 + seen)) + 0.05, np.log(1.0 + len(usable)))
    assert np.allclose(model.idf, idf) and model.languages == ["aa", "bb"]
    hashes = {r.text: r.h for r in spark.createDataFrame(data, LABELLED).selectExpr("text", "xxhash64(text) as h").collect()}
    for k, language in enumerate(model.languages):
        first = sorted({t for t, g in usable if g == language}, key=hashes.get)[:40]
        vectors = np.stack([langid.vector(t, idf).astype(np.float32) for t in first])
        table = langid.cluster(vectors, langid.CENTROIDS)
        own = model.centroids[model.owner == k]
        assert sorted(c.tobytes() for c in own) == sorted(c.astype(np.float32).tobytes() for c in table)
        best = np.sort((vectors @ table.T).max(axis=1))
        assert model.least[language] == float(best[int(0.005 * len(best))])
    asked = [(t,) for t, *_ in data] + [("ka mian toran " * 80_000,), ("x",), ("Schwan zweiel",)]  # over a megabyte, one letter
    found = langid.identify(spark.createDataFrame(asked, "text string"), model, reject=False).collect()
    for row in found:
        if not row.text or not any(map(str.isalpha, row.text)):
            assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
            continue
        cosines = model.centroids.astype(np.float64) @ langid.vector(row.text, model.idf)
        best = int(np.argmax(cosines))
        assert row.lang_pred == model.languages[model.owner[best]] and abs(row.score - min(1, max(0, cosines[best]))) < 1e-9


def test_a_tie_goes_to_the_first_language(spark):
    same = [("exactly the same words", g, 0) for g in ("zz", "cc", "mm")]
    model = langid.fit(spark.createDataFrame(same, LABELLED))
    found = langid.identify(spark.createDataFrame([("exactly the same words",)], "text string"), model, reject=False).first()
    assert found.lang_pred == "cc"


def test_vectors_of_fixed_size_leave_the_rows(spark):
    long_ = [("ka toran " * 150_000, "aa", 0), ("short text", "aa", 0)]
    frame = spark.createDataFrame(long_, LABELLED)
    sizes = frame.select(langid._vectors(frame.text, np.ones(langid.DIMENSIONS)).alias("v"))
    assert {len(r.v) for r in sizes.collect()} == {4 * langid.DIMENSIONS}
