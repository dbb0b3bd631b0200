"""Brute-force checks of the text operators, with nulls, empty and long texts, repeats and extra columns."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from vardelta.llm import (
    _repair,
    decontam,
    langid,
    line_dedup,
    mixing,
    quality,
    queries,
    sharding,
    simhash,
    sql,
    token_counts,
    token_pack,
    url_filter,
)
from vardelta.llm._pieces import PieceEncoder

BPE = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta Über naïve 漢字 the, of. 12 x7 #tag $$ ¿qué? a\u00a0b".split(" ")


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = [prose(rng, n) for n in (1, 2, 3, 9, 60, 80, 120, 300)]
    near = base[7].split(" ")
    near[150] = "changed"
    texts = [
        *base, None, "", "   ", "\n\n\t", base[6], base[6], " ".join(near), "spam " * 200, "one line\none line\none line",
        prose(rng, 4000), "a  b   c \n  d  ", "x<|endoftext|>y  <|endoftext|>", "word" * 500, "\u00e9" * 300, base[4].upper(),
    ]
    out = [(i, t, ("en", "de", None)[i % 3], ("src0", "src1", None, "src0")[i % 4], 0) for i, t in enumerate(texts)]
    return [*out, (None, base[5], "en", "src0", 0), (None, None, None, None, None), (3, base[3], "de", "src1", 0), (3, "other", "de", "src1", 0)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def bag(df, *columns):
    return collections.Counter(tuple(r) for r in df.select(*columns).collect())


# quality rules


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit), failed)


def test_quality_base_measures(docs, rows):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = bag(quality.judge(docs), "doc_id", *names)
    assert got == collections.Counter((r[0], *brute_base(r[1])) for r in rows)


def brute_verdict(text, bands):
    """Ratio, pieces outside the band and verdict, from a fresh compressor for each piece."""
    import zstandard

    raw = (text or "").encode()
    shrunk = lambda b: len(b) / len(zstandard.ZstdCompressor(level=bands.level).compress(b))
    pieces = [raw[i : i + bands.chunk_bytes] for i in range(0, len(raw), bands.chunk_bytes)]
    if pieces and 2 * len(pieces[-1]) < bands.chunk_bytes:
        tail = pieces.pop()
        pieces = [*pieces[:-1], pieces[-1] + tail] if pieces else []
    out = sum(not bands.chunk_band[0] <= shrunk(x) <= bands.chunk_band[1] for x in pieces)
    ratio = shrunk(raw) if raw else 0.0
    low, high = next((a, b) for start, a, b in reversed(bands.whole) if len(raw) >= start)
    return ratio, len(pieces), out, not brute_base(text)[-1] and low <= ratio <= high and out <= bands.chunk_share * len(pieces)


def test_quality_verdicts_by_brute_force(spark, docs, rows, sf_dir):
    names = ["ratio", "n_chunks", "n_chunks_out", "kept"]
    got = bag(quality.judge(docs), "doc_id", *names)
    assert got == collections.Counter((r[0], *brute_verdict(r[1], quality.Bands())) for r in rows)
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = [tuple(r) for r in given.collect()] + [(-1, prose(random.Random(2), 60_000))]
    found = bag(quality.judge(spark.createDataFrame(texts, "doc_id long, text string")), "doc_id", *names)
    assert found == collections.Counter((d, *brute_verdict(t, quality.Bands())) for d, t in texts)


def test_quality_bands_reject_repetition_and_noise(spark, nothing):
    rng = random.Random(1)
    noise = "".join(chr(rng.randrange(0x4E00, 0x9FFF)) + " " * (rng.random() < 0.2) for _ in range(3000))
    clean = prose(rng, 900)
    half = clean[:4000] + " ".join("buy now today only" + str(i % 2) for i in range(400))
    df = spark.createDataFrame([(1, clean), (2, noise), (3, half)], "doc_id long, text string").withColumn("kept", F.lit("x"))
    verdict = {r.doc_id: r.kept for r in quality.judge(df).collect()}
    assert verdict[1] is True and verdict[3] is False
    strict = quality.Bands(whole=((0, 1.9, 9.0),), chunk_share=1.0)
    assert {r.doc_id: r.kept for r in quality.judge(df, bands=strict).collect()}[2] is False
    assert quality.judge(nothing).count() == 0 and quality.accept(nothing).columns == nothing.columns


# token counts and token files


@pytest.fixture(scope="module")
def library():
    return PieceEncoder(BPE).library


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_pieces_equal_the_library(library, rows):
    encoder = PieceEncoder(BPE, keep=40, block=500)
    alphabet = ["a", "the", " ", "  ", "\n", "\t", "\u00a0", ".", ",", "'s", " '", "9", "é", "漢", "<|endoftext|>", "x" * 70, "!!"]
    rng = random.Random(9)
    texts = [r[1] or "" for r in rows] + ["".join(rng.choices(alphabet, k=rng.randrange(1, 40))) for _ in range(1500)]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids_of(library, text), repr(text)


def test_token_counts_of_rows(docs, rows, library, nothing):
    found = token_counts.with_prefixes(docs.withColumn("n_tokens", F.lit("x")), BPE, budgets=(7,)).collect()
    assert collections.Counter((r.doc_id, r.n_tokens) for r in found) == collections.Counter(
        (r[0], len(ids_of(library, r[1]))) for r in rows
    )
    for r in found:
        counts = token_counts.counts(r.steps)
        for k in range(0, len(r.text or ""), max(1, len(r.text or "") // 25)):
            assert counts[k] == len(ids_of(library, r.text[: k + 1]))
        assert len(ids_of(library, token_counts.truncate(r.text or "", r.steps, 7))) <= 7
    assert token_counts.with_prefixes(nothing, BPE).count() == 0


def expected_tokens(rows, library):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for doc_id, text, *_ in order:
        ids = [*ids_of(library, text), 2]
        raw = np.array(ids, "<u4").tobytes()
        out.append((doc_id, start, len(ids), zlib.crc32(raw)))
        start += len(ids)
    return out


def test_token_files_round_trip(docs, rows, library, nothing, monkeypatch):
    clear = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    known = [tuple(r) for r in clear.collect()]
    blocks = token_pack.write(clear, BPE, 2, 50_257, shards=3)
    got = bag(token_pack.digest(blocks, 50_257), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == collections.Counter(expected_tokens(known, library))
    everything = token_pack.digest(token_pack.write(docs, BPE, 2, 50_257), 50_257)
    assert everything.count() == len(rows)
    spans = sorted((r.start, r.n_tokens) for r in everything.collect())
    assert [s for s, _ in spans] == np.cumsum([0, *(n for _, n in spans)])[:-1].tolist()
    ids_in_order = [r.doc_id for r in sorted(everything.collect(), key=lambda r: r.start)]
    assert ids_in_order == sorted(ids_in_order, key=lambda d: (d is not None, d or 0))
    assert bag(everything, "doc_id", "n_tokens") == collections.Counter((r[0], len(ids_of(library, r[1])) + 1) for r in rows)
    assert token_pack.digest(token_pack.write(nothing, BPE, 2, 50_257), 50_257).count() == 0


def test_token_files_of_long_documents(spark, library):
    rng = random.Random(3)
    long = prose(rng, 250_000)
    df = spark.createDataFrame([(1, "before it"), (2, long), (3, "after")], "doc_id long, text string")
    blocks = token_pack.write(df, BPE, 2, 50_257, shards=1)
    assert blocks.count() > 1
    got = bag(token_pack.digest(blocks, 50_257), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == collections.Counter(expected_tokens([(1, "before it"), (2, long), (3, "after")], library))
    row = blocks.orderBy("block").first().asDict()
    assert token_pack.document_slice(row, 50_257, 0).tolist() == [*ids_of(library, "before it"), 2]


@pytest.mark.parametrize("n,high", [(0, 5), (1, 5), (50, 1), (5000, 3), (60_000, 40), (20_000, 50_000)])
def test_repair_round_trip_and_slices(n, high):
    ids = np.random.default_rng(n).integers(0, high, n).astype(np.uint32)
    grammar = _repair.compress(ids, 50_257, least=4)
    assert (_repair.expand(grammar, grammar.symbols) == ids).all()
    for start, stop in ((0, n), (n // 3, n // 2), (n - 1, n), (0, 1)):
        if 0 <= start < stop <= n:
            assert (_repair.expand_range(grammar, start, stop) == ids[start:stop]).all()
    for bits in (1, 7, 17, 24):
        values = ids & np.uint32((1 << bits) - 1)
        assert (_repair.unpack_bits(_repair.pack_bits(values, bits), bits, n) == values).all()


# sharding


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_feistel_is_a_permutation(n):
    out = sharding.permute(np.arange(n), n, seed=4)
    assert sorted(out.tolist()) == list(range(n))
    assert (sharding.permute(out, n, seed=4, forward=False) == np.arange(n)).all()
    for row in range(min(n, 20)):
        assert sharding.row_at(*sharding.place_of(row, n, 5, 4), n, 5, 4) == row


def test_sharding_law_and_order(spark, docs, rows, nothing):
    placed = sharding.assign(docs.withColumn("slot", F.lit("old")), 4, seed=1).collect()
    assert sorted(r.row_no for r in placed) == list(range(len(rows)))
    for r in placed:
        assert (r.shard, r.slot) == sharding.place_of(r.row_no, len(rows), 4, 1)
    ids = [r.doc_id for r in sorted(placed, key=lambda r: r.row_no)]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    slots = collections.defaultdict(list)
    for r in placed:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sharding.assign(nothing, 4, 1).count() == 0
    hot = spark.range(2000).select((F.col("id") % 3 * 5).alias("doc_id"), F.col("id").cast("string").alias("text"))
    hot = sharding.assign(hot, 7, 2)
    assert hot.select("row_no").distinct().count() == 2000
    same = spark.range(3000).select(F.lit(2**63 - 1).alias("doc_id"), F.lit(None).cast("string").alias("text"))
    placed, total = sharding.numbered(same, "doc_id", F.xxhash64("text"), "n", ranges=6)
    assert total == 3000 and placed.select("n").distinct().count() == 3000 and placed.agg(F.max("n")).first()[0] == 2999
    named = spark.createDataFrame([("b", "x"), ("a", None), (None, "z"), ("a", "y")], "doc_id string, text string")
    assert [r.doc_id for r in sharding.assign(named, 3, 5).orderBy("row_no").collect()] == [None, "a", "a", "b"]


def test_sharding_equals_its_sql(spark, sf_dir):
    columns = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({sql.SHARDING_SQL})").fetchall()
    assert bag(queries.op2_sharding(spark, sf_dir), *columns) == collections.Counter(want)


# mixing


def test_poisson_steps_invert_the_distribution():
    for rate in (0.0, 0.3, 1.0, 4.5, 900.0):
        steps = mixing.poisson_steps(rate)
        mean = sum(1 - s / mixing.GRID for s in steps)
        assert math.isclose(mean, rate, rel_tol=1e-9, abs_tol=1e-9)
        assert steps == sorted(steps)


def test_mixing_reaches_the_weights(spark, nothing):
    df = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"),
        F.when(F.col("id") % 3 > 0, "big").when(F.col("id") % 2 == 0, "small").alias("source"),
    )
    mixed = mixing.mix(df, {"big": 0.2, "small": 0.5, "absent": 0.1}, seed=3, total=10_000)
    count = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(count["big"] - 2222) < 250 and abs(count["small"] - 5555) < 350 and abs(count[None] - 2222) < 250
    again = mixing.mix(df.repartition(7), {"big": 0.2, "small": 0.5, "absent": 0.1}, seed=3, total=10_000)
    assert bag(mixed, "doc_id", "copy", "mix_key") == bag(again, "doc_id", "copy", "mix_key")
    keys = [r.mix_key for r in mixed.collect()]
    assert keys == sorted(keys)
    assert mixing.mix(nothing, {"big": 1.0}, 1).count() == 0


def test_mixing_handles_odd_rows(docs, rows):
    out = mixing.mix(docs.withColumn("copy", F.lit("c")), {"src0": 0.9}, 7, total=400)
    sizes = collections.Counter(r[3] if r[3] == "src0" else mixing.REST for r in rows)
    want = collections.Counter()
    for doc_id, text, _, source, _ in rows:
        group = source if source == "src0" else mixing.REST
        steps = mixing.poisson_steps((0.9 if group == "src0" else 0.1) * 400 / sizes[group])
        name = str(doc_id) if doc_id is not None else hashlib.md5((text or "").encode()).hexdigest()
        drawn = int(hashlib.md5(f"7|copies|{name}".encode()).hexdigest()[:13], 16)
        want.update((doc_id, text, k) for k in range(sum(drawn >= s for s in steps)))
    assert bag(out, "doc_id", "text", "copy") == want and want.total() > 100
    for weights in ({"src0": 1.2}, {"src0": -0.1}, {"src0": 0.7, "src1": 0.7}):
        with pytest.raises(ValueError, match="weights"):
            mixing.mix(docs, weights, 7)


# line dedup


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        host = rng.choice(["a", "a", "b", "c", None, ""])
        lines = [rng.choice(["menu", " menu ", "footer of " + str(host), "ad", "", "x" + str(rng.randrange(60))]) for _ in range(8)]
        rows.append((i, host, "\n".join(lines), "old"))
    rows += [(500, "a", None, "o"), (501, "b", "", "o"), (502, "one", "menu\nmenu", "o"), (7, "a", rows[7][2], "o")]
    rows.append((600, "b", "\n".join(["menu", *(f"long line {k} " + "x" * 50 for k in range(20_000))]), "o"))
    df = spark.createDataFrame(rows, "page_id long, host string, text string, n_lines string").withColumn("__host", F.lit(1)).withColumn("line", F.lit(2))
    clean = lambda t: [re.sub("[ \t\r]+", " ", x).strip(" ") for x in (t or "").split("\n") if x.strip()]
    pages, seen = collections.Counter(r[1] for r in rows), collections.Counter()
    for r in rows:
        seen.update((r[1], x) for x in set(clean(r[2])))
    want = collections.Counter()
    for r in rows:
        lines = clean(r[2])
        kept = [x for x in lines if not (seen[r[1], x] >= 2 and seen[r[1], x] > 0.3 * pages[r[1]])]
        want[r[0], len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    got = line_dedup.drop_boilerplate(df, "host", "text", salts=3)
    assert bag(got, "page_id", "n_lines", "n_dropped", "kept_text") == want
    assert line_dedup.drop_boilerplate(df.limit(0), "host", "text").count() == 0


def test_html_lines(spark):
    page = "<html><head><title>T</title><noscript>a</style>b</noscript><script>x</p></script></head><body><!-- c --><p>a <b>b</b>\n c<br>d</p></body>"
    out = spark.createDataFrame([(page,), (None,)], "html string").select(line_dedup.html_lines(F.col("html"))).collect()
    assert [x.strip() for x in out[0][0].split("\n") if x.strip()] == ["T", "a b c", "d"] and out[1][0] is None


# url filter


def test_url_filter_rules_and_parts(spark):
    cases = {
        "http://A.example.com/en/7?x": ("a.example.com", "/en/7", "example.com/en/7", "allow"),
        "http://x.com/en/": ("x.com", "/en/", "com/en/", "block"),
        "http://xcom/en/": ("xcom", "/en/", None, None),
        "https://s.example.net/de/81#f": ("s.example.net", "/de/81", "example.net/de/8", "block"),
        "https://s.example.net/de/1": ("s.example.net", "/de/1", "net/de/", "allow"),
        "a://b.org/es/": ("b.org", "/es/", "org/es/", "block"),
        "http://host?q=/en/": ("host", "", None, None),
        "no scheme.com/en/": ("", "", None, None),
        "http://ÄB.com#x": ("Äb.com", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
    }
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(cases)], "page_id long, url string, host string")
    rules = [url_filter.Rule(*r) for r in sql.URL_RULES]
    weights, intercept = url_filter.fit(url_filter.labelled_urls(spark))
    got = {r.url: r for r in url_filter.judge(df, rules, weights, intercept).collect()}
    for url, (host, path, rule, verdict) in cases.items():
        r = got[url]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        margin = brute_margin(host, path, weights, intercept)
        assert math.isclose(r.probability, 1 / (1 + math.exp(-margin)), rel_tol=1e-9)
        assert r.verdict == (verdict or ("block" if r.probability > 0.7 else "allow"))
    long = spark.createDataFrame([("http://" + "x" * 30_000 + ".com/en/" + "y/" * 30_000,)], "url string")
    assert url_filter.judge(long, rules, weights, intercept).first().rule == "com/en/"
    probe = spark.createDataFrame([("http://best-casino-slots.com/",), ("http://city-library.org/books",)], "url string")
    judged = {r.host: r.verdict for r in url_filter.judge(probe, [], weights, intercept).collect()}
    assert judged == {"best-casino-slots.com": "block", "city-library.org": "allow"}
    assert url_filter.judge(df.limit(0), rules, weights, intercept).count() == 0


@pytest.mark.parametrize("by,least_blocked,least_allowed", [("url", 0.7, 0.97), ("word", 0.1, 0.85)])
def test_url_model_on_held_out_rows(spark, by, least_blocked, least_allowed):
    """Rates in five folds: on new hosts that hold known words, and on words that no row of the fit has."""
    labelled = url_filter.labelled_urls(spark).withColumn("fold", F.pmod(F.xxhash64(by), F.lit(5))).cache()
    right = collections.Counter()
    for fold in range(5):
        weights, intercept = url_filter.fit(labelled.where(F.col("fold") != fold))
        held = labelled.where(F.col("fold") == fold)
        for r in url_filter.judge(held, [], weights, intercept).groupBy("label", "verdict").count().collect():
            right[r.label, r.verdict] += r["count"]
    blocked = right[1, "block"] / (right[1, "block"] + right[1, "allow"])
    allowed = right[0, "allow"] / (right[0, "block"] + right[0, "allow"])
    print(f"held out by {by}: blocked {blocked:.3f} of unwanted, allowed {allowed:.3f} of wanted urls")
    assert allowed > least_allowed and blocked > max(least_blocked, 1 - allowed)


def brute_margin(host, path, weights, intercept):
    found = set()
    for mark, part in (("h", host), ("p", path)):
        framed = f"^{part}$"
        for size in url_filter.LENGTHS:
            for i in range(len(framed) - size + 1 if part else 0):
                seed = xxhash.xxh64_intdigest(mark.encode(), 42)
                value = xxhash.xxh64_intdigest(framed[i : i + size].encode(), seed)
                found.add((value - ((value >> 63) << 64)) % url_filter.DIMENSIONS)
    return intercept + sum(weights[b] for b in found) / math.sqrt(max(len(found), 1))


# decontamination


def brute_contamination(text, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = split(text), set(), set()
    for item, body in items:
        w = split(body)
        n = min(window, len(w))
        wanted = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in wanted:
                hit.update(range(i, i + n))
                found.add(item)
    return len(words), len(hit), tuple(sorted(map(str, found)))


def test_decontamination_against_brute_force(spark, nothing):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(12)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate((30, 12, 10, 9, 5, 4, 1, 40))] + [(20, None), (21, "--"), (7, say(3)), (11, "Zebra zebra ZEBRA")]
    items.append((30, items[0][1]))
    texts = [say(rng.randrange(0, 150)) for _ in range(60)]
    texts += [f"{say(4)}, {items[k][1].upper()}! {say(6)}" for k in (0, 1, 2, 3, 4, 7)]
    texts += [None, "", items[0][1][:-4], items[7][1] + " " + items[7][1], "zebra zebra zebra zebra"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, items[0][1]), (None, "clean"), (5, texts[5]), (5, items[1][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = collections.Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontam.contamination(df, bench).collect())
    assert got == collections.Counter((d, *brute_contamination(t, items)) for d, t in rows)
    kept = decontam.remove_contaminated(df, bench)
    assert kept.columns == df.columns
    assert bag(kept, "doc_id", "text") == collections.Counter((d, t) for d, t in rows if not brute_contamination(t, items)[1])
    assert decontam.contamination(nothing, bench).count() == 0
    assert decontam.contamination(df, bench.limit(0)).where("n_hit > 0").count() == 0


def test_decontamination_with_a_share(spark):
    item = " ".join(f"i{k}" for k in range(10))
    near = item.replace("i0 ", "other ")
    df = spark.createDataFrame([(1, f"a b {near} c"), (2, "nothing here")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [r.n_hit for r in decontam.contamination(df, bench, share=0.8).orderBy("doc_id").collect()] == [10, 0]
    assert [r.n_hit for r in decontam.contamination(df, bench).orderBy("doc_id").collect()] == [0, 0]
    long = " ".join(f"i{k}" for k in range(30))
    exact = spark.createDataFrame([(1, f"{long} and {long.replace('i3 ', 'x ')}")], "doc_id long, text string")
    for shingle in (15, 16, 20):
        args = {"window": 30, "shingle": shingle, "share": 0.9}
        assert decontam.contamination(exact, spark.createDataFrame([(1, long)], "item_id long, text string"), **args).first().n_hit == 30


def test_bit_table_and_long_texts(spark, monkeypatch):
    assert [decontam.table_bits(n) for n in (0, 1, 65_536, 70_000, 10**9)] == [1 << 20, 1 << 20, 1 << 20, 1 << 21, 1 << 23]
    rng = random.Random(12)
    long = " ".join(f"w{rng.randrange(3000)}" for _ in range(60_000))
    item = " ".join(long.split(" ")[40_000:40_014])
    df = spark.createDataFrame([(1, long), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit) for r in decontam.contamination(df, bench).collect()}
    assert got == {1: (60_000, 14), 2: (0, 0)}
    monkeypatch.setattr(decontam, "MOST_BITS", 64)  # several passes
    got = {r.doc_id: (r.n_words, r.n_hit) for r in decontam.contamination(df, bench).collect()}
    assert got == {1: (60_000, 14), 2: (0, 0)}


# SimHash


def brute_fingerprint(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radii):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(prints)), 2):
        if all((a ^ b).bit_count() <= r for a, b, r in zip(prints[i], prints[j], radii, strict=True)):
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("shingles,radii", [((3,), (3,)), ((3, 5), (11, 14))])
def test_simhash_groups(docs, rows, nothing, shingles, radii):
    found = simhash.groups(docs, shingles, radii, tile=4)
    prints = [tuple(brute_fingerprint(r[1], n) for n in shingles) for r in rows]
    leaders = brute_components(prints, radii)
    names = collections.defaultdict(list)
    for r, leader in zip(rows, leaders, strict=True):
        if r[0] is not None:
            names[leader].append(r[0])
    want = collections.Counter(
        (r[0], f"{p[0]:016x}", min(names[leader], default=None)) for r, p, leader in zip(rows, prints, leaders, strict=True)
    )
    assert bag(found, "doc_id", simhash.hex_digits(F.col("fp0")), "component_id") == want
    assert simhash.groups(nothing, shingles, radii).count() == 0


def test_simhash_links_of_random_clusters(spark):
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 1 << 63, 300, dtype=np.uint64).tolist()
    for value in prints[:40]:  # chains and dense groups
        for _ in range(6):
            value ^= 1 << int(rng.integers(64))
            value ^= 1 << int(rng.integers(64))
            prints.append(value)
    prints = sorted(set(prints))
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)), int(np.uint64(p).astype(np.int64))) for p in prints], "id long, fp0 long")
    linked = {r.id: r.root for r in simhash.components(simhash.tile_links(df, ["fp0"], (3,), tile=16)).collect()}
    leaders = brute_components([(p,) for p in prints], (3,))
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    groups = collections.defaultdict(set)
    for s, leader in zip(signed, leaders, strict=True):
        groups[leader].add(s)
    assert {frozenset(g) for g in groups.values()} == {
        frozenset(g) for g in _by_value({s: linked.get(s, s) for s in signed}).values()
    }


def _by_value(mapping):
    out = collections.defaultdict(set)
    for k, v in mapping.items():
        out[v].add(k)
    return out


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200 + i, 200) for i in range(1, 30)] + [(400, 401), (401, 400)]
    got = {r.id: r.root for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 101)} | {200 + i: 200 for i in range(1, 30)} | {401: 400}


def test_long_text_fingerprint(monkeypatch):
    text = prose(random.Random(1), 3000)
    whole = simhash.fingerprint_bytes(text.encode(), 3)
    monkeypatch.setattr(simhash, "STRETCH", 64)
    assert simhash.fingerprint_bytes(text.encode(), 3) == whole == brute_fingerprint(text, 3)


# language


def test_language_on_held_out_rows(spark):
    found = queries.op10_language(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    hits = found.where("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert hits > 0.97
    assert found.where("score < 0 or score > 1").count() == 0 and found.count() == truth.count()


def test_language_of_odd_rows(spark, docs, rows, nothing):
    labelled = spark.createDataFrame([("the house and the garden of the town", "en"), ("das haus und der garten der stadt", "de"), (None, "de"), ("123", "fr"), ("x", None)], "text string, lang string")
    model = langid.fit(labelled)
    assert model.languages == ["de", "en"]
    out = langid.identify(docs.withColumn("score", F.lit("s")), model, reject=False).collect()
    assert len(out) == len(rows)
    for r in out:
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in ("de", "en")) if letter else (r.lang_pred == "und" and r.score == 0.0)
    assert langid.identify(nothing, model).count() == 0
    far = spark.createDataFrame([("zzqx qqzx",)], "text string")
    assert langid.identify(far, model).first().lang_pred == "und"
    assert {r.lang_pred for r in langid.identify(docs, langid.fit(labelled.limit(0))).collect()} == {"und"}
