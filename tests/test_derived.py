"""What is written for a query: the grouped rows it needs, not every derived table; and deliveries that are compressed."""

import os
from pathlib import Path

from vardelta import derive
from vardelta.queries import QUERIES


def test_only_what_a_query_needs_is_written(spark, sf_dir, tmp_path):
    own = str(tmp_path / "own")
    os.symlink(sf_dir, own)
    kept = lambda: {name for _, folder, name in derive._kept if folder == own}
    derive.derived(spark, own, "kin").count()
    assert kept() == set()
    QUERIES["p15_is_noncoding"](spark, own).count()
    assert kept() == {"scanned"}
    QUERIES["a11_prs_cohort"](spark, own).count()
    assert kept() == {"scanned", "cohort"}
    wide = spark.read.parquet(derive._kept[(spark.sparkContext.applicationId, own, "scanned")])
    assert set(wide.columns) == {"k", "n", "q", "si", "snapshot_id", "sidx"}


def test_tables_over_stored_rows_equal_those_over_the_given_ones(spark, sf_dir):
    for name in ("annotated", "variants", "genotypes", "missense", "splice", "regulatory", "clinvar", "panel", "cohort"):
        want = spark.sql(derive.ctes(name, paths=sf_dir) + f"SELECT * FROM {name}")
        got = derive.derived(spark, sf_dir, name)
        assert [f.name for f in got.schema] == [f.name for f in want.schema] or set(got.columns) == set(want.columns)
        got = got.select(*want.columns)
        assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
        assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty() and not got.isEmpty()


def test_deliveries_are_compressed(spark, sf_dir):
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(root.glob("arriving-*"))
    for name in ("r02_call_stream", "r02_late_files"):
        assert QUERIES[name](spark, sf_dir).count() == 6
    files = [f for d in set(root.glob("arriving-*")) - before for f in d.rglob("part-*")]
    assert files and all(f.name.endswith(".gz") for f in files)
