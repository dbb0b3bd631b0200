"""Readers on real files, the partitioned store and the streams."""

import pytest

from vardelta import schemas as S
from vardelta.operators import incremental
from vardelta.sources import readers, store
from vardelta.streaming import jobs

ROW = "{up}\t-\t{a}\tG1\tmissense_variant\t0.01&0.02\t0.05\t-\t-\thet\tPathogenic\t-\t-\t77\n"


def annotated(path, *keys):
    path.write_text("# comment\n" + "".join(ROW.format(up=k, a=k.split("/")[1]) for k in keys))


def test_annotated_files(spark, tmp_path):
    annotated(tmp_path / "dad.x.tsv", "1_100_A/G", "2_801_A/-")
    rows = readers.read_annotated(spark, str(tmp_path / "dad.x.tsv")).orderBy("pos").collect()
    assert [(r.chrom, r.pos, r.ref, r.alt, r.gnomad_af, r.clinvar_revstat, r.zygosity) for r in rows] == [("1", 100, "A", "G", 0.05, None, "HET"), ("2", 801, "A", "-", 0.05, None, "HET")]
    everyone = readers.load_all(spark, str(tmp_path), "s1")
    assert {(r.snapshot_id, r.sample_id) for r in everyone.collect()} == {("s1", "dad")}
    annotated(tmp_path / "bad.tsv", "rs1_x/y", "1_5_A/G")
    with pytest.raises(ValueError, match="1 of 2"):
        readers.read_annotated(spark, str(tmp_path / "bad.tsv"))


def test_genotype_lines(spark, tmp_path):
    (tmp_path / "kid.vcf").write_text("##x\n#CHROM\tPOS\n1\t10\t.\tA\tG\t50\tPASS\tDB;QD=3\tGT:AD:DP\t0/1:9,8:17\n1\t11\tshort\n2\t5\t.\tC\tT\t.\t.\t.\tGT:PS\t0|1:.\n")
    rows = readers.read_genotypes(spark, str(tmp_path / "kid.vcf")).orderBy("chrom").collect()
    assert [(r.sample_id, r.pos, r.gt, r.ad, r.dp, r.ps) for r in rows] == [("kid", 10, "0/1", "9,8", 17, None), ("kid", 5, "0|1", None, None, None)]
    assert rows[0]["info"] == {"DB": "", "QD": "3"}


def variants(spark, snapshot, sample, *positions):
    columns = [c.split()[0] for c in S.VARIANTS.split(", ")]
    row = lambda p: tuple({"snapshot_id": snapshot, "sample_id": sample, "chrom": "1", "pos": p, "ref": "A", "alt": "G"}.get(c) for c in columns)
    return spark.createDataFrame([row(p) for p in positions], S.VARIANTS)


def test_partitions_are_replaced_alone(spark, tmp_path):
    root = str(tmp_path / "v")
    store.load_partition(variants(spark, "2024-01-01", "a", 1, 2), root, "2024-01-01", "a")
    store.load_partition(variants(spark, "2024-01-01", "b", 3), root, "2024-01-01", "b")
    store.load_partition(variants(spark, "2024-01-01", "a", 9), root, "2024-01-01", "a")
    rows = store.read_variants(spark, root)
    assert sorted((r.sample_id, r.pos) for r in rows.collect()) == [("a", 9), ("b", 3)]
    assert dict(rows.dtypes)["snapshot_id"] == "string"


def test_call_stream_takes_the_later_file(spark, tmp_path):
    import os

    source, table = tmp_path / "in", str(tmp_path / "t")
    source.mkdir()
    annotated(source / "dad.1.tsv", "1_100_A/G", "1_200_A/G")
    os.utime(source / "dad.1.tsv", (1_000_000, 1_000_000))
    annotated(source / "mum.1.tsv", "1_100_A/G")
    run = lambda: jobs.call_stream(spark, str(source), table, str(tmp_path / "c"), "2024-01-01").awaitTermination()
    run()
    annotated(source / "dad.2.tsv", "1_300_A/G")
    run()
    run()
    assert sorted((r.sample_id, r.pos) for r in store.read_variants(spark, table).collect()) == [("dad", 300), ("mum", 100)]


def test_release_stream(spark, tmp_path):
    table, releases, source = str(tmp_path / "v"), str(tmp_path / "r"), tmp_path / "in"
    source.mkdir()
    store.load_partition(variants(spark, "2024-01-01", "a", 100, 500), table, "2024-01-01", "a")
    line = "1\t{}\t.\tA\tG\t.\t.\tALLELEID=1;CLNSIG={}\n"
    old = spark.createDataFrame([("1", "100", "1", "A", "G", ".", ".", "CLNSIG=Benign")], S.CLINVAR)
    from pyspark.sql import functions as F

    store.replace_partition(readers.shape_clinvar(old).withColumn("snapshot_id", F.lit("2024-01-01")), releases, ["snapshot_id"])
    stamp = lambda n: f"2024-0{n + 2}-01"
    for n, sig in enumerate(("Pathogenic", "Likely_benign")):
        (source / f"{n}.vcf").write_text("##fileDate=2024\n" + line.format(100, sig))
        jobs.release_stream(spark, str(source), table, releases, str(tmp_path / "c"), stamp).awaitTermination()
    got = {(r.snapshot_id, r.pos): r.clinvar_sig for r in store.read_variants(spark, table).collect()}
    assert got == {("2024-01-01", 100): None, ("2024-01-01", 500): None, ("2024-02-01", 100): "Pathogenic", ("2024-02-01", 500): None, ("2024-03-01", 100): "Likely_benign", ("2024-03-01", 500): None}


def test_export_writes_nulls_as_nothing(spark, tmp_path):
    store.export(variants(spark, "s", "a", 1).select("sample_id", "pos", "gene").coalesce(1), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*")).read_text()
    assert text == "sample_id\tpos\tgene\na\t1\t\n"


def test_sql_parameters_are_values(spark):
    v = variants(spark, "s", "a'; drop", 1, 2)
    got = store.run_sql(spark, "SELECT count(*) AS n FROM variants WHERE sample_id = :who", v, who="a'; drop").first().n
    assert got == 2


def test_digest_ignores_order(spark):
    a, b = variants(spark, "s", "a", 1, 2, 3), variants(spark, "s", "a", 3, 1, 2)
    assert incremental.input_digests(a).collect() == incremental.input_digests(b).collect()
    assert incremental.input_digests(a).collect() != incremental.input_digests(variants(spark, "s", "a", 1, 2, 4)).collect()
