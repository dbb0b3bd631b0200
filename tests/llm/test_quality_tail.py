"""A tail shorter than half a piece is judged too."""

import random
import string

from vardelta.llm import quality


def test_short_tail_goes_with_the_piece_before_it(spark):
    rng = random.Random(5)
    words = [w for w in "some plain words of a text that goes on about nothing much at all and ends".split()]
    prose = " ".join(rng.choice(words) + str(rng.randrange(9)) for _ in range(900))[:2048]
    noise = "".join(rng.choice(string.printable[:94]) for _ in range(1000))
    assert len(prose) == 2048
    texts = [prose, prose + noise, prose + " " + prose[:500], noise[:1000]]
    bands = quality.Bands(whole=((0, 0.0, 99.0),), chunk_band=(1.9, 9.0), chunk_share=0.0, min_words=0, max_repeat_percent=100)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    rows = sorted(quality.judge(docs, bands=bands).collect(), key=lambda r: r.doc_id)
    assert [r.n_chunks for r in rows] == [1, 1, 1, 0]
    assert [r.n_chunks_out for r in rows] == [0, 1, 0, 0]
    assert [r.kept for r in rows] == [True, False, True, True]
