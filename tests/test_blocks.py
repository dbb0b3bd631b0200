"""Block-compressed files: the same lines whatever the ranges, in several tasks."""

import gzip
import io
import random

import pytest
from pyspark.sql import functions as F

from vardelta.sources import blocks, readers


def sample(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice("acgt\té漢0123456789") for _ in range(r.choice([0, 1, 7, 60, 400]))) for _ in range(n)] + ["x" * 200_000, "", "end"]


@pytest.mark.parametrize("size", [1, 500, 5_000, 70_000, 1 << 30])
@pytest.mark.parametrize("ends", [True, False])
def test_every_line_once(size, ends):
    text = "\n".join(sample(1, 900)) + ("\n" if ends else "")
    data = blocks.blocks(text.encode()) + blocks.END
    assert gzip.decompress(data).decode() == text
    step = max(size, len(data) // 300)
    got = []
    for start in range(0, len(data), step):
        for some in blocks.lines(io.BytesIO(data), start, min(start + step, len(data)), len(data)):
            got += some
    assert [x.decode() for x in got] == text.removesuffix("\n").split("\n")


def test_false_headers_inside_blocks_are_passed_over():
    noise = b"\x1f\x8b\x08\x04" + bytes(8) + b"BC\x02\x00\x10\x00" + random.Random(2).randbytes(3000)
    data = blocks.blocks(noise * 40) + blocks.END
    found = [k for k in range(0, len(data), 997)]
    real, at = [], 0
    while at < len(data):
        real.append(at)
        at += blocks.block_size(data[at : at + blocks.HEADER])
    for start in found:
        want = next((p for p in real if p >= start), None)
        assert blocks.first_block(data, start, True) == want


def test_one_file_several_tasks_same_rows(spark, tmp_path):
    lines = [f"{k % 5}\t{k}\t{'acgt' * (k % 40)}" for k in range(60_000)]
    (tmp_path / "one.vcf.gz").write_bytes(blocks.blocks(("\n".join(lines) + "\n").encode()) + blocks.END)
    read = blocks.read_lines(spark, str(tmp_path / "one.vcf.gz"), size=20_000)
    parts = read.withColumn("part", F.spark_partition_id()).groupBy("part").count().collect()
    assert len(parts) > 5 and max(p["count"] for p in parts) < len(lines) / 3
    assert sorted(r.value for r in read.collect()) == sorted(lines)


def test_folder_of_all_kinds(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(gzip.compress(b"one\ntwo\r\n") + gzip.compress(b"three\n"))
    (tmp_path / "b.txt").write_bytes(b"four\nfive")
    (tmp_path / "c.gz").write_bytes(blocks.blocks(b"six\n") + blocks.END)
    (tmp_path / "d.gz").write_bytes(blocks.END)
    (tmp_path / "e.txt").write_bytes(b"")
    (tmp_path / "_hidden").write_bytes(b"no\n")
    got = [(r.value, r.file.rsplit("/", 1)[1]) for r in blocks.read_lines(spark, str(tmp_path)).collect()]
    assert sorted(got) == [("five", "b.txt"), ("four", "b.txt"), ("one", "a.gz"), ("six", "c.gz"), ("three", "a.gz"), ("two", "a.gz")]
    with pytest.raises(Exception, match="nothing_there"):
        blocks.read_lines(spark, str(tmp_path / "nothing_there")).collect()


def test_written_files_are_read_back(spark, tmp_path):
    rows = spark.range(5000).select(F.concat(F.lit("line "), F.col("id").cast("string")).alias("value")).repartition(3)
    path = f"file://{tmp_path}/out"
    blocks.write_lines(rows, path)
    assert len(list((tmp_path / "out").glob("part-*.gz"))) == 3 and not list((tmp_path / "out").glob("_*"))
    assert blocks.read_lines(spark, path, size=2000).select("value").exceptAll(rows).count() == 0
    assert gzip.decompress(sorted((tmp_path / "out").glob("*.gz"))[0].read_bytes()).startswith(b"line ")


def test_annotated_rows_from_blocks_equal_those_of_the_text_reader(spark, tmp_path):
    cells = lambda k: [f"{k % 3 + 1}_{k}_A/G", "-", "G", "GENE", "missense_variant", "0.1&0.2", "-", "-", "-", "het", "Benign", "-", "-", str(k)]
    text = "# comment\n" + "\n".join("\t".join(cells(k)) for k in range(3000)) + "\n"
    (tmp_path / "dad.gz").write_bytes(blocks.blocks(text.encode()) + blocks.END)
    from_blocks = readers.read_annotated_blocks(spark, str(tmp_path / "dad.gz"), size=3000)
    plain = readers.read_annotated(spark, str(tmp_path / "dad.gz"))
    assert from_blocks.count() == 3000 and from_blocks.exceptAll(plain).isEmpty() and plain.exceptAll(from_blocks).isEmpty()
