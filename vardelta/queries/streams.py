"""Queries that write files first: bulk loading, ledgers, streams; and the remaining orders."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from vardelta.operators import classify, digests, family, incremental, polygenic
from vardelta.queries import sqltext as q
from vardelta.queries._base import CURR, LATER, PREV, QUERIES, query
from vardelta.queries.delta import DV, EVAL, V
from vardelta.queries.family import SECOND
from vardelta.queries.genotypes import SCORES, SHARE
from vardelta.queries.upkeep import LEDGER, digest_sql, ledger, shared
from vardelta.schemas import KEY
from vardelta.sources import blocks, readers, store
from vardelta.streaming import jobs


def text_rows(v):
    """Variants as lines of an annotated table."""
    dash = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    up = F.concat("chrom", F.lit("_"), F.col("pos").cast("string"), F.lit("_"), "ref", F.lit("/"), "alt")
    cells = [
        up, F.lit("-"), F.col("alt"), dash("gene"), dash("consequence"), dash("gnomad_af"), F.lit("-"), dash("sift"), dash("polyphen"),
        F.lower("zygosity"), dash("clinvar_sig"), dash("clinvar_revstat"), dash("clinvar_disease"), dash("clinvar_alleleid"),
    ]
    return v.select("sample_id", F.concat_ws("\t", *cells).alias("value"))


def write_files(v, root):
    """Compressed text files under ``root``, a folder a sample, all in one job; gives the folder of folders."""
    text_rows(v).write.partitionBy("sample_id").option("compression", "gzip").text(root)
    return root


def write_sample(v, name, folder):
    """One sample's rows as compressed text files, as deliveries are; no file takes a whole sample."""
    text_rows(v.where(F.col("sample_id") == name)).select("value").write.option("compression", "gzip").text(folder)


LOADED = "sample_id, chrom, pos, ref, alt, gene, clinvar_sig, gnomad_af, zygosity"


@query("s05_load_all", "variants", sql=f"SELECT {LOADED} FROM variants WHERE snapshot_id = '{LATER}'")
def s05(t):
    """Files of all samples in one job; here a folder a sample, so the sample is the folder's name."""
    root = write_files(t.at(LATER), store.scratch(t.spark, "annotated"))
    raw = t.spark.read.schema(readers.S.ANNOTATED).csv(f"{root}/*", sep="\t", comment="#", quote="")
    named = raw.withColumn("sample_id", F.regexp_extract(F.input_file_name(), r"sample_id=([^/]+)/[^/]*$", 1))
    return readers.shape_annotated(named, "sample_id").where("pos is not null").select(*LOADED.split(", "))


@query("s01_block_annotated", "variants", sql=f"SELECT chrom, pos, ref, alt, gene, clinvar_sig, gnomad_af, zygosity FROM variants WHERE snapshot_id = '{LATER}'")
def s01_blocks(t):
    """Block-compressed annotated files, each read by several tasks."""
    root = store.scratch(t.spark, "block-files")
    blocks.write_lines(text_rows(t.at(LATER)).select("value"), root)
    rows = readers.read_annotated_blocks(t.spark, root, size=1 << 18)
    return rows.select("chrom", "pos", "ref", "alt", "gene", "clinvar_sig", "gnomad_af", "zygosity")


@query("r02_call_stream", "variants", sql=f"SELECT snapshot_id, sample_id, count(*) AS n, count(DISTINCT gene) AS n_genes FROM variants WHERE snapshot_id = '{LATER}' GROUP BY ALL")
def r02(t):
    """Files arrive in two rounds; each round loads its samples' partitions."""
    source, root = store.scratch(t.spark, "arriving"), store.scratch(t.spark, "stream-store")
    for names in (["father", "mother", "daughter"], ["partner", "grandson", "granddaughter"]):
        part = t.at(LATER).where(F.col("sample_id").isin(names))
        for name in names:
            write_sample(part, name, f"{source}/{name}.parts")
        jobs.call_stream(t.spark, f"{source}/*", f"{root}/v", f"{root}/checkpoint", LATER, by_folder=True).awaitTermination()
    return store.read_variants(t.spark, f"{root}/v").groupBy("snapshot_id", "sample_id").agg(F.count("*").alias("n"), F.countDistinct("gene").alias("n_genes"))


@query("r02_late_files", "variants", sql=f"""SELECT snapshot_id, sample_id, count(*) AS n, sum(pos) AS places FROM variants WHERE snapshot_id = '{LATER}'
  AND CASE sample_id WHEN 'father' THEN pos % 3 > 0 WHEN 'mother' THEN pos % 2 = 0 ELSE true END GROUP BY ALL""")
def r02_late(t):
    """Three rounds: all samples; a newer file of father and one of mother; then older ones of father, mother and daughter.

    The stale files were written before the others and arrive after them. They are left out, in a batch of their own.
    """
    early, source, root = (store.scratch(t.spark, x) for x in ("staged", "arriving", "late-store"))
    names = ["father", "mother", "daughter", "partner", "grandson", "granddaughter"]

    def deliver(folder, name, rows, mark):
        write_sample(rows, name, f"{folder}/{mark}/{name}.parts")

    at = t.at(LATER)
    for name in names[:3]:
        deliver(early, name, at.where("pos % 5 = 0"), "stale")
    rounds = [[(n, at, "first") for n in names], [("father", at.where("pos % 3 > 0"), "second"), ("mother", at.where("pos % 2 = 0"), "second")], []]
    for number, files in enumerate(rounds):
        for name, rows, mark in files:
            deliver(source, name, rows, mark)
        if number == 2:
            for name in names[:3]:
                store.move(t.spark, f"{early}/stale/{name}.parts", f"{source}/stale/{name}.parts")
        jobs.call_stream(t.spark, f"{source}/*/*", f"{root}/v", f"{root}/checkpoint", LATER, by_folder=True).awaitTermination()
    return store.read_variants(t.spark, f"{root}/v").groupBy("snapshot_id", "sample_id").agg(F.count("*").alias("n"), F.sum("pos").alias("places"))


@query("r01_release_stream", "variants", "clinvar", sql=f"SELECT '{CURR}' AS snapshot_id, sample_id, count(*) AS n FROM variants WHERE snapshot_id = '{PREV}' GROUP BY ALL UNION ALL SELECT '{PREV}', sample_id, count(*) FROM variants WHERE snapshot_id = '{PREV}' GROUP BY sample_id")
def r01(t):
    """A new release arrives; the store gets the next snapshot."""
    root = store.scratch(t.spark, "release-store")
    store.replace_partition(t.at(PREV), f"{root}/v", ["snapshot_id", "sample_id"])
    raw = lambda n: t.clinvar.where(f"release = {n}").select(
        "chrom", F.col("pos").cast("string").alias("pos"), F.lit(".").alias("id"), "ref", "alt", F.lit(".").alias("qual"), F.lit(".").alias("filter"), "info"
    )
    store.replace_partition(readers.shape_clinvar(raw(0)).withColumn("snapshot_id", F.lit(PREV)), f"{root}/releases", ["snapshot_id"])
    raw(1).coalesce(1).write.csv(f"{root}/incoming", sep="\t", quote="")
    jobs.release_stream(t.spark, f"{root}/incoming", f"{root}/v", f"{root}/releases", f"{root}/checkpoint", lambda _: CURR).awaitTermination()
    return store.read_variants(t.spark, f"{root}/v").groupBy("snapshot_id", "sample_id").agg(F.count("*").alias("n"))


@query("m05_record_inputs", "callsets", "snapshots", sql=f"WITH {LEDGER} SELECT snapshot_id, sample_id, CASE WHEN snapshot_id = '{PREV}' AND sample_id = 'father' THEN 'again' ELSE vcf_digest END AS vcf_digest FROM ledger")
def m05(t):
    """Ledger rows replace those of their sample and snapshot only."""
    root = store.scratch(t.spark, "ledger")
    store.write_companion(ledger(t), root, "scan_inputs", ["snapshot_id", "sample_id"])
    again = ledger(t).where(f"snapshot_id = '{PREV}' and sample_id = 'father'").withColumn("vcf_digest", F.lit("again"))
    store.write_companion(again, root, "scan_inputs", ["snapshot_id", "sample_id"])
    return store.read_companion(t.spark, root, "scan_inputs").select("snapshot_id", "sample_id", "vcf_digest")


@query("m05_mark_anchor", "callsets", "snapshots", sql=f"WITH {LEDGER} SELECT snapshot_id, count(*) FILTER (snapshot_id = '{CURR}') > 0 AS anchor, count(*) AS n_inputs FROM ledger GROUP BY snapshot_id")
def m05_anchor(t):
    """A snapshot is marked twice; the mark stays one row and no input of it is lost."""
    root = store.scratch(t.spark, "anchors")
    store.write_companion(ledger(t), root, "scan_inputs", ["snapshot_id", "sample_id"])
    for _ in range(2):
        store.mark_anchor(t.spark, root, CURR)
    rows = store.read_companion(t.spark, root, "scan_inputs")
    own = F.col("sample_id") == store.ANCHOR
    return rows.groupBy("snapshot_id").agg((F.count_if(own) == 1).alias("anchor"), F.count_if(~own).alias("n_inputs"))


@query("m06_replace_partition", "variants", sql=f"SELECT snapshot_id, sample_id, count(*) AS n FROM variants WHERE NOT (snapshot_id = '{CURR}' AND sample_id = 'father' AND pos % 2 = 1) GROUP BY ALL")
def m06(t):
    root = store.scratch(t.spark, "replaced")
    store.replace_partition(t.variants, root, ["snapshot_id", "sample_id"])
    store.replace_partition(t.at(CURR).where("sample_id = 'father' and pos % 2 = 0"), root, ["snapshot_id", "sample_id"])
    return store.read_variants(t.spark, root).groupBy("snapshot_id", "sample_id").agg(F.count("*").alias("n"))


@query("m08_stale_scores", "scoring", sql="SELECT pgs_id, pgs_id = 'PGS2' AS stale FROM scoring GROUP BY pgs_id")
def m08(t):
    """Reports whose score file has changed since: digests of the rows then and now."""
    then = incremental.input_digests(t.scoring, "pgs_id").withColumnRenamed("digest", "was")
    now = t.scoring.withColumn("weight_milli", F.when((F.col("pgs_id") == "PGS2") & (F.col("pos") % 7 == 0), F.col("weight_milli") + 1).otherwise(F.col("weight_milli")))
    joined = then.join(incremental.input_digests(now, "pgs_id"), "pgs_id")
    return joined.select("pgs_id", (F.col("was") != F.col("digest")).alias("stale"))


#: A panel of scores as it is and as it was, and a report of every person: stamped with either panel or none, shown,
#: withheld or unstamped.
REPORTS = """panel_now AS (SELECT pgs_id, 'Trait ' || pgs_id AS trait, cast(count(*) as bigint) AS n_variants, CASE WHEN pgs_id = 'PGS3' THEN 'licence' END AS licence FROM scoring GROUP BY pgs_id),
panel_then AS (SELECT pgs_id, trait, CASE WHEN pgs_id = 'PGS2' THEN n_variants - 1 ELSE n_variants END AS n_variants, licence FROM panel_now),
report AS (SELECT CASE WHEN c % 8 = 3 THEN id || '_vendor' ELSE id END AS sample_id, id AS person, c % 4 AS panel_kind,
    CASE WHEN c % 5 < 2 THEN 'shown' WHEN c % 5 < 4 THEN 'withheld' END AS consent_stamp FROM kin WHERE c % 9 > 0),
agreed AS (SELECT id AS person, 'adult_onset' AS category, c % 3 = 0 AS granted FROM kin WHERE c % 3 < 2)"""


@query("m08_stale_reports", "scoring", "kin", sql=f"""WITH {REPORTS}, stamps AS (
  SELECT 0 AS kind, 'panel=' || digest || ';cap=none' AS stamp FROM ({digest_sql("pgs_id, trait, n_variants, licence", "panel_now")})
  UNION ALL SELECT 1, 'panel=' || digest || ';cap=none' FROM ({digest_sql("pgs_id, trait, n_variants, licence", "panel_then")})
  UNION ALL SELECT 2, 'panel=' || digest || ';cap=500' FROM ({digest_sql("pgs_id, trait, n_variants, licence", "panel_now")})),
judged AS (SELECT sample_id, coalesce(s.stamp = (SELECT stamp FROM stamps WHERE kind = 0), false) AS panel_current,
    coalesce(consent_stamp, 'shown') = CASE WHEN person IN (SELECT person FROM agreed WHERE granted) THEN 'shown' ELSE 'withheld' END AS consent_current
  FROM report LEFT JOIN stamps s ON s.kind = panel_kind)
SELECT *, NOT (panel_current AND consent_current) AS stale FROM judged""")
def m08_reports(t):
    """Reports against the panel of scores and the consent of today."""
    one = lambda name: shared(t, name, REPORTS, "scoring", "kin")
    now, then = (digests.multiset_digest(one(p), []) for p in ("panel_now", "panel_then"))
    kinds = [(now, None), (then, None), (now, 500)]
    stamps = [d.select(F.lit(k).cast("bigint").alias("panel_kind"), incremental.panel_stamp(F.col("digest"), cap).alias("panel_stamp")) for k, (d, cap) in enumerate(kinds)]
    reports = one("report").join(stamps[0].union(stamps[1]).union(stamps[2]), "panel_kind", "left")
    return incremental.stale_reports(reports, one("panel_now"), one("agreed"), "adult_onset")


@query("t03_order_acmg", *DV, sql=f"""WITH {V}, {q.MODELS}, src AS (SELECT * FROM v WHERE gene IN (SELECT gene FROM panel)), done AS ({EVAL})
SELECT sample_id, chrom, pos, ref, alt, acmg_tier, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY
  list_position(['Pathogenic', 'Likely pathogenic', 'VUS', 'Likely benign', 'Benign'], acmg_tier), gene NULLS LAST, chrom, pos, ref, alt) AS INTEGER) AS place
FROM done WHERE scope = 'call'""")
def t03(t):
    rows = classify.acmg(t.at(CURR), t.panel, t.missense, t.splice, t.gene_constraint).where("scope = 'call'")
    order = Window.partitionBy("sample_id").orderBy(*classify.acmg_order())
    return rows.withColumn("place", F.row_number().over(order)).select("sample_id", *KEY, "acmg_tier", "place")


@query("t06_order_prs", "scoring", "cohort", "populations", sql=f"""WITH {SCORES}, {SHARE},
p AS (SELECT a.pgs_id, a.sample_id, count(*) FILTER (b.score_milli < a.score_milli) * 100.0::DOUBLE / count(*) AS percentile
  FROM asked a JOIN base b ON a.pgs_id = b.pgs_id GROUP BY a.pgs_id, a.sample_id)
SELECT *, CAST(row_number() OVER (PARTITION BY pgs_id ORDER BY percentile DESC NULLS LAST, sample_id) AS INTEGER) AS place FROM p""")
def t06(t):
    rows = QUERIES["w08_empirical_percentile"](t.spark, t.sf_dir).select("pgs_id", "sample_id", F.col("overall_percent").alias("percentile"))
    order = Window.partitionBy("pgs_id").orderBy(*polygenic.prs_order())
    return rows.withColumn("place", F.row_number().over(order))


@query("t08_order_second_hits", "variants", "panel", sql=f"""WITH v AS (SELECT * FROM variants WHERE snapshot_id = '{LATER}'), {SECOND},
o AS (SELECT *, CASE WHEN pos % 3 = 0 THEN 'cis' ELSE 'trans' END AS phase, CASE WHEN pos % 4 = 0 THEN NULL ELSE pos % 10 END AS value FROM second)
SELECT sample_id, gene, chrom, pos, ref, alt, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY phase = 'cis', value IS NULL, value DESC NULLS LAST, gene, chrom, pos, ref, alt) AS INTEGER) AS place FROM o""")
def t08(t):
    rows = family.second_hits(t.at(LATER), t.panel).drop("place")
    rows = rows.withColumn("phase", F.when(F.col("pos") % 3 == 0, "cis").otherwise("trans")).withColumn("value", F.when(F.col("pos") % 4 == 0, None).otherwise(F.col("pos") % 10))
    order = Window.partitionBy("sample_id").orderBy(*family.second_hit_order(), "gene", *KEY)
    return rows.withColumn("place", F.row_number().over(order)).select("sample_id", "gene", *KEY, "place")
