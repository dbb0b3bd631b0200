"""The production bands reject printable noise and keep prose."""

import random
import string

from vardelta.llm import quality

ALPHABETS = {
    "ascii": [chr(c) for c in range(33, 127)],
    "base64": [*string.ascii_letters, *string.digits, "+", "/"],
    "cjk": [chr(c) for c in range(0x4E00, 0x9FFF)],
}


def noise(rng, alphabet, size):
    out, n = [], 0
    while n < size or len(out) < 55:
        out.append("".join(rng.choice(alphabet) for _ in range(rng.randrange(3, 10))))
        n += len(out[-1].encode()) + 1
    return " ".join(out)


def test_production_bands_reject_noise_and_keep_clean_rows(spark, sf_dir):
    rng = random.Random(8)
    texts = [noise(rng, a, n) for a in ALPHABETS.values() for n in (300, 700, 1500, 3000, 12_000, 70_000)]
    texts += [noise(rng, list(string.ascii_lowercase), n) for n in (2500, 9000, 70_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = quality.judge(df).collect()
    assert len(rows) == len(texts) and not any(r.base_failed or r.kept for r in rows)
    clean = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    low = quality.judge(clean).where("not base_failed").collect()
    loose = quality.Bands(whole=tuple((a, 0.0, c) for a, _, c in quality.Bands().whole), chunk_band=(0.0, 4.0))
    before = {r.doc_id: r.kept for r in quality.judge(clean, bands=loose).collect()}
    assert low and all(r.kept == before[r.doc_id] for r in low)
