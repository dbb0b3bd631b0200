"""Fill-in-middle against a plain version over code points, exact round trips and odd rows."""

import hashlib
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from vardelta.llm import fill_middle

TEXTS = [
    None, "", "a", " ", "Hello, world\n\nnext\r\nline", "Ünï漢字 😀 é  x", "<<<P text >S> <M", "has <P> inside",
    "\u0000\u0001 low", "word " * 40_000, "漢" * 3000, "abc" * 5000, "<S", ">M><", "tail\n",
]
SCHEMA = "doc_id long, text string, form string, output int"


def plainly(doc_id, text, seed=1, plain=10, spm=20):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    one, two = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:one], units[one:two], units[two:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 100 - plain:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_equals_plain_version_on_odd_rows(spark):
    rows = [(k, t, "theirs", 7) for k in range(12) for t in TEXTS] + [(None, t, None, None) for t in TEXTS]
    rows = [(d if d is None else d * 100 + i, *r) for i, (d, *r) in enumerate(rows)] + [(5, "same row again", "x", 1)] * 3
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    made = fill_middle.transform(docs)
    assert made.columns == ["doc_id", "text", *fill_middle.COLUMNS]
    back = made.withColumn("back", fill_middle.restore(made.output, made.form)).collect()
    assert len(back) == len(rows)
    assert {r.form for r in back} == {"plain", "psm", "spm"}
    for r in back:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plainly(r.doc_id, r.text)
        assert r.back == (r.text or "")


def test_shares_and_bounds(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('some words of text ', id) as text")
    forms = {r.form: r["count"] for r in fill_middle.transform(docs).groupBy("form").count().collect()}
    assert 300 < forms["plain"] < 500 and 600 < forms["spm"] < 840
    assert {r.form for r in fill_middle.transform(docs, plain_percent=0, spm_percent=100).select("form").distinct().collect()} == {"spm"}
    assert fill_middle.transform(docs.limit(0)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from("<>PSM ab\n")), *[st.integers(0, 2**32 - 1)] * 4), min_size=1, max_size=8))
def test_any_texts(rows):
    texts = pa.array([r[0].encode() for r in rows], pa.binary())
    draws = [pa.array([r[k] for r in rows], pa.int64()) for k in range(1, 5)]
    for (text, *h), got in zip(rows, fill_middle.cut(texts, draws, 90, 20).to_pylist(), strict=True):
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        one, two = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
        assert got["n"] == len(units)
        p, m, s = ("".join(x) for x in (units[:one], units[one:two], units[two:]))
        whole = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}
        assert got["output"] == whole[got["form"]]


def test_stretches_cover_every_row():
    texts = pa.array([b"x" * k for k in (5, 0, 30, 1, 1, 9, 0)], pa.binary())
    assert list(fill_middle.stretches(texts, 10)) == [(0, 2), (2, 1), (3, 2), (5, 2)]
    assert list(fill_middle.stretches(texts.slice(0, 0), 10)) == []
