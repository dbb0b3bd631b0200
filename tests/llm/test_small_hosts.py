"""Line dedup on hosts of few pages."""

from vardelta.llm import line_dedup


def test_small_hosts_lose_their_shared_header(spark):
    rows = [(10 * n + k, f"h{n}", f"header\nown {k}") for n in (1, 2, 3, 4) for k in range(n)]
    df = spark.createDataFrame(rows, "page_id long, host string, text string")
    got = {r.page_id: (r.n_dropped, r.kept_text) for r in line_dedup.drop_boilerplate(df, "host", "text").collect()}
    assert got == {i: (0, t) if h == "h1" else (1, t.split("\n")[1]) for i, h, t in rows}
