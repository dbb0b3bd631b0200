"""Queries of genotype jobs, polygenic scores, intervals, score tables and small domains."""

from pyspark.sql import functions as F

from vardelta.derive import spark_ctes
from vardelta.operators import domains, genotypes, intervals, polygenic, scores
from vardelta.queries import sqltext as q
from vardelta.queries._base import CHILD, LATER, query
from vardelta.schemas import KEY

HET = "gt IN ('0/1', '1/0', '0|1', '1|0')"
ALT = "regexp_matches(gt, '[1-9]')"
PASS = "filter IN ('PASS', '.')"
AD = "list_transform(string_split(ad, ','), lambda x: CASE WHEN x = '.' THEN 0 ELSE CAST(x AS INT) END)"
VAF = f"CASE WHEN list_sum({AD}) > 0 THEN CAST(list_sum({AD}) - ({AD})[1] AS DOUBLE) / list_sum({AD}) ELSE 0.0 END"
SIDES = "('father'), ('mother'), ('father_vendor'), ('mother_vendor_rerun')"


def parents(t):
    return t.callsets.where("sample_id like 'father%' and sample_id <> 'fatherly' or sample_id like 'mother%'")


@query("a15_median_het_depth", "genotypes", sql=f"""SELECT sample_id, list_sort(list(dp))[count(*) // 2 + 1] AS median_dp
FROM genotypes WHERE {HET} GROUP BY sample_id""")
def a15(t):
    return genotypes.median_het_depth(t.genotypes)


PRIVATE = f"""private AS (SELECT * FROM genotypes c WHERE sample_id = '{CHILD}' AND {HET} AND {PASS}
  AND NOT EXISTS (SELECT 1 FROM genotypes p WHERE p.sample_id IN (SELECT * FROM (VALUES {SIDES})) AND regexp_matches(p.gt, '[1-9]') AND {q.on("p", "c")}))"""


@query("j20_private_to_child", "genotypes", sql=f"WITH {PRIVATE} SELECT chrom, pos, ref, alt, gt, dp, gq FROM private")
def j20(t):
    return genotypes.private_to_child(t.genotypes, CHILD, parents(t)).select(*KEY, "gt", "dp", "gq")


JUDGED = f"""{PRIVATE}, med AS (SELECT list_sort(list(dp))[count(*) // 2 + 1] AS m FROM genotypes WHERE sample_id = '{CHILD}' AND {HET}),
judged AS (SELECT *, CASE WHEN gq < 20 THEN 'low_gq' WHEN dp < 10 THEN 'low_depth' WHEN m > 0 AND dp > m * 2.5 THEN 'excess_depth'
  WHEN length(ref) <> length(alt) AND list_count(list_distinct(string_split(CASE WHEN length(ref) > length(alt) THEN substr(ref, length(alt) + 1) ELSE substr(alt, length(ref) + 1) END, ''))) = 1 THEN 'homopolymer_indel'
  WHEN length(ref) + length(alt) > 2 AND vaf < 0.4 THEN 'low_vaf_indel' WHEN length(ref) + length(alt) = 2 AND vaf < 0.4 THEN 'low_vaf' WHEN vaf > 0.75 THEN 'high_vaf' END AS reason
  FROM (SELECT *, {VAF} AS vaf FROM private, med WHERE chrom <> 'X'))"""


@query("p29_reject_reason", "genotypes", sql=f"WITH {JUDGED} SELECT chrom, pos, ref, alt, vaf, reason FROM judged")
def p29(t):
    return genotypes.judged_candidates(t.genotypes, CHILD, parents(t)).select(*KEY, "vaf", "reason")


@query("a16_filter_funnel", "genotypes", sql=f"WITH {JUDGED} SELECT coalesce(reason, 'pass') AS reason, count(*) AS n FROM judged GROUP BY ALL")
def a16(t):
    return genotypes.filter_funnel(genotypes.judged_candidates(t.genotypes, CHILD, parents(t)))


EVIDENCE = """evidence AS (SELECT chrom, pos, sample_id AS parent, CASE WHEN pos % 3 = 0 THEN gt ELSE '0/0' END AS gt, dp,
  cast(pos % 4 as bigint) AS alt_reads, CASE WHEN pos % 11 = 0 THEN cast(pos % 5 as bigint) END AS nonref
  FROM (SELECT DISTINCT g.chrom, g.pos, p.sample_id, first_gt AS gt, g.dp FROM
    (SELECT chrom, pos, min(gt) AS first_gt, max(dp) AS dp FROM genotypes GROUP BY chrom, pos) AS g
    CROSS JOIN (SELECT * FROM (VALUES ('father'), ('mother')) AS v(sample_id)) AS p) AS x WHERE pos % 13 > 0)"""


def evidence(t):
    from vardelta.derive import spark_ctes

    head = spark_ctes(t.spark, t.sf_dir, "genotypes").rstrip()
    return t.spark.sql(f"{head},\n{EVIDENCE}\nSELECT * FROM evidence")


STATUS = """verdicts AS (SELECT j.chrom, j.pos, j.ref, j.alt, p.s AS parent, CASE
    WHEN e.chrom IS NULL THEN 'indeterminate' WHEN coalesce(nonref >= 3, false) THEN 'inherited'
    WHEN e.gt LIKE '.%' OR e.dp < 10 THEN 'indeterminate' WHEN regexp_matches(e.gt, '[1-9]') OR alt_reads > 1 THEN 'inherited' ELSE 'confirmed' END AS verdict
  FROM (SELECT * FROM judged WHERE reason IS NULL OR reason <> 'low_depth') j CROSS JOIN (VALUES ('father'), ('mother')) p(s)
  LEFT JOIN evidence e ON e.chrom = j.chrom AND e.pos = j.pos AND e.parent = p.s),
status AS (SELECT chrom, pos, ref, alt, CASE WHEN bool_or(verdict = 'inherited') THEN 'inherited' WHEN bool_or(verdict = 'indeterminate') THEN 'indeterminate'
  ELSE 'confirmed' END AS status FROM verdicts GROUP BY ALL)"""


def status(t):
    cands = genotypes.judged_candidates(t.genotypes, CHILD, parents(t)).where("reason is null or reason <> 'low_depth'")
    return genotypes.de_novo_status(cands.select(*KEY), evidence(t), ["father", "mother"])


@query("a17_de_novo_status", "genotypes", sql=f"WITH {JUDGED}, {EVIDENCE}, {STATUS} SELECT * FROM status")
def a17(t):
    return status(t)


CLUSTER = """flagged AS (SELECT chrom, pos, ref, alt, CASE WHEN status = 'confirmed' AND EXISTS (SELECT 1 FROM status o WHERE o.status = 'confirmed'
  AND o.chrom = s.chrom AND abs(o.pos - s.pos) <= 1000 AND (o.pos, o.ref, o.alt) <> (s.pos, s.ref, s.alt)) THEN 'clustered' ELSE status END AS status FROM status s)"""


@query("w02_flag_clusters", "genotypes", sql=f"WITH {JUDGED}, {EVIDENCE}, {STATUS}, {CLUSTER} SELECT * FROM flagged")
def w02(t):
    return genotypes.flag_clusters(status(t))


@query("c17_de_novo_confirmed", "genotypes", "variants", sql=f"""WITH {JUDGED}, {EVIDENCE}, {STATUS}, {CLUSTER},
notes AS (SELECT chrom, pos, min(gene) AS gene, min(consequence) AS consequence, min(clinvar_sig) AS clinvar_sig FROM variants GROUP BY chrom, pos)
SELECT f.*, gene, consequence, clinvar_sig FROM flagged f LEFT JOIN notes n ON f.chrom = n.chrom AND f.pos = n.pos WHERE status IN ('confirmed', 'clustered')""")
def c17(t):
    rows = genotypes.flag_clusters(status(t)).where("status in ('confirmed', 'clustered')")
    return genotypes.attach_position_annotation(rows, t.variants).select(*KEY, "status", "gene", "consequence", "clinvar_sig")


@query("j23_attach_position_annotation", "genotypes", "variants", sql=f"""WITH {PRIVATE},
notes AS (SELECT chrom, pos, min(gene) AS gene, min(consequence) AS consequence, min(clinvar_sig) AS clinvar_sig FROM variants GROUP BY chrom, pos)
SELECT p.chrom, p.pos, p.ref, p.alt, gene, consequence, clinvar_sig FROM private p LEFT JOIN notes n ON p.chrom = n.chrom AND p.pos = n.pos""")
def j23(t):
    rows = genotypes.private_to_child(t.genotypes, CHILD, parents(t)).select(*KEY)
    return genotypes.attach_position_annotation(rows, t.variants).select(*KEY, "gene", "consequence", "clinvar_sig")


@query("a18_plausibility", "genotypes", sql=f"""WITH {JUDGED}, {EVIDENCE}, {STATUS}
SELECT n AS n_confirmed, CASE WHEN n < 40 THEN 'low' WHEN n > 150 THEN 'high' ELSE 'plausible' END AS verdict
FROM (SELECT count(*) FILTER (status = 'confirmed' AND length(ref) = 1 AND length(alt) = 1) AS n FROM status)""")
def a18(t):
    return genotypes.plausibility(status(t))


@query("a28_genotyping_qc", "genotypes", sql=f"""SELECT sample_id, count(*) AS sites, count(*) FILTER (gt LIKE '%.%') AS no_calls,
  count(*) FILTER (gt NOT LIKE '%.%' AND NOT {ALT}) AS hom_ref, count(*) FILTER (gt NOT LIKE '%.%' AND {ALT}) AS variant,
  count(*) FILTER (dp < 8) AS thin, (count(*) - count(*) FILTER (gt LIKE '%.%')) * 100.0::DOUBLE / count(*) AS called_percent FROM genotypes GROUP BY sample_id""")
def a28(t):
    rows = genotypes.genotyping_qc(t.genotypes)
    return rows.withColumn("called_percent", F.col("called_percent").cast("double"))


@query("a34_titv", "genotypes", sql=f"""SELECT sample_id, ti, tv, CASE WHEN tv > 0 THEN ti::DOUBLE / tv END AS ratio FROM (
  SELECT sample_id, count(*) FILTER (ref || alt IN ('AG', 'GA', 'CT', 'TC')) AS ti, count(*) FILTER (ref || alt NOT IN ('AG', 'GA', 'CT', 'TC')) AS tv
  FROM genotypes WHERE length(ref) = 1 AND length(alt) = 1 AND {ALT} GROUP BY sample_id)""")
def a34(t):
    return genotypes.titv(t.genotypes)


TRIM = """CASE WHEN length(ref) <> length(alt) AND ref[1] = alt[1] THEN pos + 1 ELSE pos END AS pos,
  CASE WHEN length(ref) <> length(alt) AND ref[1] = alt[1] THEN coalesce(nullif(substr(ref, 2), ''), '-') ELSE ref END AS ref,
  CASE WHEN length(ref) <> length(alt) AND ref[1] = alt[1] THEN coalesce(nullif(substr(alt, 2), ''), '-') ELSE alt END AS alt"""


@query("j15_attach_allele_balance", "variants", "genotypes", sql=f"""WITH k AS (SELECT sample_id, chrom, {TRIM}, ({AD})[2] AS alt_reads, list_sum({AD}) AS total_reads FROM genotypes)
SELECT v.sample_id, v.chrom, v.pos, v.ref, v.alt, k.alt_reads, CAST(k.total_reads AS INTEGER) AS total_reads,
  coalesce(v.zygosity = 'HET' AND k.alt_reads::DOUBLE / k.total_reads < 0.25, false) AS low_balance
FROM variants v LEFT JOIN k ON v.sample_id = k.sample_id AND {q.on("v", "k")} AND k.total_reads > 0 WHERE v.snapshot_id = '{LATER}'""")
def j15(t):
    rows = genotypes.attach_allele_balance(t.at(LATER), t.genotypes)
    return rows.select("sample_id", *KEY, "alt_reads", "total_reads", "low_balance")


@query("p19_trimmed_key", "genotypes", sql=f"SELECT DISTINCT chrom, {TRIM} FROM genotypes")
def p19(t):
    from vardelta.functions.alleles import trimmed_key

    return t.genotypes.select("chrom", trimmed_key(F.col("pos"), F.col("ref"), F.col("alt")).alias("k")).select("chrom", "k.*").distinct()


MULTI = """multi AS (SELECT a.sample_id, a.chrom, a.pos, a.ref, a.alt || ',' || CASE WHEN a.k % 2 = 0 THEN 'N' ELSE 'NN' END AS alt,
  CASE WHEN a.k % 5 = 0 THEN '1/2' WHEN a.k % 5 = 1 THEN '0|2' WHEN a.k % 5 = 2 THEN './1' ELSE a.gt END AS gt,
  a.ad || ',' || cast(a.k % 20 as string) AS ad FROM genotypes AS a)"""


@query("p18_split_multiallelic", "genotypes", sql=f"""WITH {MULTI}
SELECT sample_id, chrom, pos, ref, string_split(alt, ',')[i] AS alt,
  CASE WHEN gt LIKE '%|%' THEN array_to_string(list_transform(regexp_split_to_array(gt, '[/|]'), lambda g: CASE WHEN g = CAST(i AS VARCHAR) THEN '1' WHEN g = '.' THEN '.' ELSE '0' END), '|') ELSE array_to_string(list_transform(regexp_split_to_array(gt, '[/|]'), lambda g: CASE WHEN g = CAST(i AS VARCHAR) THEN '1' WHEN g = '.' THEN '.' ELSE '0' END), '/') END AS gt, string_split(ad, ',')[1] || ',' || string_split(ad, ',')[i + 1] AS ad
FROM multi, (VALUES (1), (2)) v(i)""")
def p18(t):
    from vardelta.derive import spark_ctes

    multi = t.spark.sql(spark_ctes(t.spark, t.sf_dir, "genotypes").rstrip() + f",\n{MULTI}\nSELECT * FROM multi")
    return genotypes.split_multiallelic(multi).select("sample_id", *KEY, "gt", "ad")


@query("j22_same_event", "variants", "genotypes", sql=f"""WITH v AS (SELECT DISTINCT chrom, pos, ref, alt FROM variants WHERE snapshot_id = '{LATER}' AND sample_id = '{CHILD}'),
g AS (SELECT DISTINCT chrom, pos, ref, alt FROM genotypes WHERE sample_id = '{CHILD}'),
m AS (SELECT v.*, g.pos AS vcf_pos, g.ref AS vcf_ref, g.alt AS vcf_alt FROM v JOIN g ON v.chrom = g.chrom AND (
  (v.ref <> '-' AND v.alt <> '-' AND g.pos = v.pos AND g.ref = v.ref AND g.alt = v.alt)
  OR (v.alt = '-' AND g.pos IN (v.pos - 1, v.pos) AND g.alt = g.ref[1] AND substr(g.ref, 2) = v.ref)
  OR (v.ref = '-' AND g.pos IN (v.pos - 1, v.pos) AND g.ref = g.alt[1] AND substr(g.alt, 2) = v.alt)))
SELECT chrom, pos, ref, alt, vcf_pos, vcf_ref, vcf_alt FROM (SELECT *, row_number() OVER (PARTITION BY chrom, pos, ref, alt ORDER BY vcf_pos, vcf_ref, vcf_alt) AS rn FROM m) WHERE rn = 1""")
def j22(t):
    return genotypes.same_event(t.at(LATER).where(f"sample_id = '{CHILD}'"), t.genotypes.where(f"sample_id = '{CHILD}'"))


PHASE = f"""hets AS (SELECT DISTINCT gene, chrom, pos FROM variants WHERE snapshot_id = '{LATER}' AND sample_id = '{CHILD}' AND zygosity = 'HET' AND gene IS NOT NULL),
rec AS (SELECT chrom, pos, CASE WHEN gt LIKE '%|%' THEN ps END AS ps, CASE WHEN gt LIKE '%|%' THEN CASE WHEN gt[1] <> '0' THEN 0 ELSE 1 END END AS hap,
  length(ref) <> length(alt) AS indel FROM genotypes WHERE sample_id = '{CHILD}' AND gt IN ('0/1', '0|1', '1|0', '1/0')),
al AS (SELECT chrom, pos, ps, hap, 0 AS anchor FROM rec UNION ALL SELECT chrom, pos + 1, ps, hap, 1 FROM rec WHERE indel),
gr AS (SELECT chrom, pos, anchor, count(DISTINCT (coalesce(CAST(ps AS VARCHAR), ''), coalesce(hap, -1))) AS n, min(ps) AS ps, min(hap) AS hap FROM al GROUP BY ALL),
ph AS (SELECT chrom, pos, CASE WHEN n = 1 THEN ps END AS ps, CASE WHEN n = 1 THEN hap END AS hap, n > 1 AS ambiguous FROM gr
  QUALIFY row_number() OVER (PARTITION BY chrom, pos ORDER BY anchor) = 1)"""


@query("a07_phased_positions", "variants", "genotypes", sql=f"WITH {PHASE} SELECT * FROM ph")
def a07_positions(t):
    return genotypes.phased_positions(t.genotypes.where(f"sample_id = '{CHILD}'"))


@query("a07_phase_verdict", "variants", "genotypes", sql=f"""WITH {PHASE},
pl AS (SELECT h.gene, h.chrom, p.ps, p.hap, coalesce(p.ambiguous, false) AS amb FROM hets h LEFT JOIN ph p ON h.chrom = p.chrom AND h.pos = p.pos),
bl AS (SELECT gene, chrom, CASE WHEN ps IS NOT NULL AND hap IS NOT NULL THEN ps END AS b, count(*) AS n, count(DISTINCT CASE WHEN ps IS NOT NULL THEN hap END) AS sides,
  count(*) FILTER (amb) AS amb FROM pl GROUP BY ALL),
gn AS (SELECT gene, chrom, sum(n) AS n, coalesce(sum(n) FILTER (b IS NOT NULL), 0) AS n_phased, count(*) FILTER (b IS NOT NULL) AS blocks, sum(amb) AS n_ambiguous,
  bool_or(b IS NOT NULL AND sides = 2) AS tr, bool_or(b IS NOT NULL AND sides = 1 AND n >= 2) AS one FROM bl GROUP BY ALL)
SELECT gene, chrom, CAST(n AS BIGINT) AS n, CAST(n_phased AS BIGINT) AS n_phased, blocks, CAST(n_ambiguous AS BIGINT) AS n_ambiguous,
  CASE WHEN tr THEN 'in-trans' WHEN one AND n_phased = n AND blocks = 1 THEN 'in-cis' WHEN one THEN 'partial' ELSE 'unphased' END AS verdict FROM gn""")
def a07(t):
    hets = t.at(LATER).where(f"sample_id = '{CHILD}' and zygosity = 'HET' and gene is not null").select("gene", "chrom", "pos").distinct()
    return genotypes.phase_verdict(hets, genotypes.phased_positions(t.genotypes.where(f"sample_id = '{CHILD}'")))


@query("w03_merge_windows", "variants", sql=f"""WITH s AS (SELECT DISTINCT chrom, greatest(pos - 1000, 1) AS a, pos + 1000 AS b FROM variants WHERE snapshot_id = '{LATER}'),
m AS (SELECT *, max(b) OVER (PARTITION BY chrom ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
i AS (SELECT *, sum(CASE WHEN a <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY chrom ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT chrom, min(a) AS start, max(b) AS stop FROM i GROUP BY chrom, island""")
def w03(t):
    return genotypes.merge_windows(t.at(LATER).select("chrom", "pos"))


# polygenic scores

GENO = f"""geno AS (SELECT m.sample_id, m.chrom, m.pos, CASE WHEN c.individual IS NULL THEN ['A', 'A'] WHEN c.pos % 19 = 0 THEN NULL
  WHEN c.dosage = 1 THEN ['A', 'G'] ELSE ['G', 'G'] END AS alleles
  FROM (SELECT DISTINCT i AS individual, 'c' || i AS sample_id, chrom, pos FROM scoring, (SELECT DISTINCT individual AS i FROM cohort)) m
  LEFT JOIN cohort c ON c.individual = m.individual AND c.chrom = m.chrom AND c.pos = m.pos),
contrib AS (SELECT s.*, g.sample_id, CAST(list_count(list_filter(g.alleles, lambda a: a = s.effect)) AS BIGINT) AS dosage FROM scoring s JOIN geno g USING (chrom, pos) WHERE g.alleles IS NOT NULL)"""


def called(t):
    """Two sources of calls of the whole cohort, the reference at the sites, and the samples."""
    people = t.cohort.select(F.concat(F.lit("c"), "individual").alias("sample_id")).distinct()
    calls = t.cohort.selectExpr(
        "concat('c', individual) as sample_id", "chrom", "pos", "ref", "alt",
        "case when pos % 19 = 0 then '1/.' when dosage = 1 then '0/1' else '1' end as gt",
    )
    base = t.scoring.select("chrom", "pos").distinct().withColumn("base", F.lit("A"))
    return [calls.where("pos % 2 = 0"), calls], base, people


def contrib(t):
    sources, base, people = called(t)
    markers = base.select("chrom", "pos").join(people)  # a row a marker and person: the result
    return polygenic.contributions(t.scoring, polygenic.genotype_fallback(markers, sources, base))


@query("j18_genotype_fallback", "scoring", "cohort", sql=f"WITH {GENO} SELECT pgs_id, sample_id, chrom, pos, dosage, dosage * weight_milli AS contribution FROM contrib")
def j18(t):
    return contrib(t).select("pgs_id", "sample_id", "chrom", "pos", "dosage", "contribution")


@query("a09_prs_exact", "scoring", "cohort", sql=f"""WITH {GENO}
SELECT pgs_id, sample_id, CAST(sum(dosage * weight_milli) AS BIGINT) AS score_milli, count(*) AS n_used, count(*) FILTER (dosage > 0) AS n_carrying FROM contrib GROUP BY ALL""")
def a09(t):
    return polygenic.prs_exact_from_calls(t.scoring, *called(t))


MOMENTS = """m AS (SELECT c.*, CASE WHEN effect = alt THEN af_milli WHEN effect = ref THEN 1000 - af_milli END AS f FROM contrib c JOIN frequencies USING (chrom, pos)),
mom AS (SELECT pgs_id, sample_id, CAST(sum(dosage * weight_milli) AS BIGINT) AS raw_milli, CAST(sum(2 * f * weight_milli) AS BIGINT) AS mean_micro,
  CAST(sum(2 * f * (1000 - f) * weight_milli * weight_milli) AS BIGINT) AS variance_pico, count(*) AS n FROM m WHERE f IS NOT NULL GROUP BY ALL)"""


@query("a10_calibration_moments", "scoring", "cohort", "frequencies", sql=f"WITH {GENO}, {MOMENTS} SELECT * FROM mom")
def a10(t):
    return polygenic.moments_from_calls(t.scoring, *called(t), t.frequencies)


@query("a10_prs_calibrate")
def a10_percentile(t):
    return polygenic.prs_calibrate(a10(t))


SCORES = """single AS (SELECT * FROM scoring QUALIFY count(*) OVER (PARTITION BY pgs_id, chrom, pos) = 1),
co AS (SELECT pgs_id, individual, CAST(sum(CASE WHEN effect = alt THEN dosage ELSE 2 - dosage END * weight_milli) AS BIGINT) AS score_milli, count(*) AS n_used
  FROM single JOIN cohort USING (chrom, pos) WHERE effect IN (ref, alt) GROUP BY ALL)"""


@query("a11_prs_cohort", "scoring", "cohort", sql=f"WITH {SCORES} SELECT * FROM co")
def a11(t):
    return polygenic.prs_cohort(t.scoring, t.cohort)


TWICE = "scoring2 AS (SELECT * FROM scoring UNION ALL SELECT * FROM scoring WHERE pos % 50 = 0)"


@query("a12_drop_duplicate_coords", "scoring", sql=f"""WITH {TWICE}
SELECT pgs_id, chrom, pos, effect, weight_milli FROM scoring2 QUALIFY count(*) OVER (PARTITION BY pgs_id, chrom, pos) = 1""")
def a12(t):
    rows = t.scoring.union(t.scoring.where("pos % 50 = 0"))
    return polygenic.drop_duplicate_coords(rows).select("pgs_id", "chrom", "pos", "effect", "weight_milli")


@query("a13_ref_effect_supplement", "scoring", "cohort", "frequencies", sql="""WITH cov AS (SELECT DISTINCT 'c' || individual AS sample_id, chrom, pos FROM cohort),
due AS (SELECT s.* FROM scoring s JOIN frequencies f USING (chrom, pos) WHERE s.effect = f.ref)
SELECT d.pgs_id, s.sample_id, CAST(coalesce(sum(2 * weight_milli) FILTER (c.pos IS NULL), 0) AS BIGINT) AS owed_milli, count(*) FILTER (c.pos IS NULL) AS n
FROM due d CROSS JOIN (SELECT DISTINCT sample_id FROM cov) s LEFT JOIN cov c ON c.sample_id = s.sample_id AND c.chrom = d.chrom AND c.pos = d.pos GROUP BY ALL""")
def a13(t):
    covered = t.cohort.select(F.concat(F.lit("c"), "individual").alias("sample_id"), "chrom", "pos")
    return polygenic.ref_effect_supplement(t.scoring, covered, t.frequencies)


@query("a14_cohort_complete", "scoring", "cohort", sql="""WITH named AS (SELECT DISTINCT pgs_id, chrom FROM scoring)
SELECT pgs_id, count(*) AS n_contigs, bool_and(chrom IN (SELECT chrom FROM cohort WHERE chrom <> '7' OR pos > 0)) AS complete FROM named GROUP BY pgs_id""")
def a14(t):
    return polygenic.cohort_complete(t.scoring, t.cohort)


SHARE = """asked AS (SELECT pgs_id, 'c' || individual AS sample_id, score_milli FROM co),
base AS (SELECT co.*, superpopulation FROM co JOIN populations USING (individual))"""


@query("w08_empirical_percentile", "scoring", "cohort", "populations", sql=f"""WITH {SCORES}, {SHARE}
SELECT a.pgs_id, a.sample_id, a.score_milli,
  CASE WHEN count(*) FILTER (superpopulation = 'EUROPE') > 0 THEN count(*) FILTER (superpopulation = 'EUROPE' AND b.score_milli < a.score_milli) * 100.0::DOUBLE / count(*) FILTER (superpopulation = 'EUROPE') END AS matched_percent,
  count(*) FILTER (b.score_milli < a.score_milli) * 100.0::DOUBLE / count(*) AS overall_percent
FROM asked a JOIN base b ON a.pgs_id = b.pgs_id GROUP BY a.pgs_id, a.sample_id, a.score_milli""")
def w08(t):
    all_ = polygenic.prs_cohort(t.scoring, t.cohort)
    asked = all_.select("pgs_id", F.concat(F.lit("c"), "individual").alias("sample_id"), "score_milli")
    rows = polygenic.empirical_percentile(asked, all_, t.populations, "EUROPE")
    return rows.withColumns({c: F.col(c).cast("double") for c in ("matched_percent", "overall_percent")})


@query("c18_prs", "scoring", "cohort", "populations", sql=f"""WITH {SCORES}, {SHARE},
p AS (SELECT a.pgs_id, a.sample_id, a.score_milli, count(*) FILTER (b.score_milli < a.score_milli) * 100.0::DOUBLE / count(*) AS overall_percent
  FROM asked a JOIN base b ON a.pgs_id = b.pgs_id GROUP BY a.pgs_id, a.sample_id, a.score_milli)
SELECT p.pgs_id, p.sample_id, p.score_milli, CASE WHEN n <= 200 THEN 'exact' ELSE 'genome-wide' END AS route,
  CASE WHEN overall_percent >= 90 THEN 'high' WHEN overall_percent >= 75 THEN 'above average' WHEN overall_percent > 25 THEN 'average' WHEN overall_percent > 10 THEN 'below average' ELSE 'low' END AS band
FROM p JOIN (SELECT pgs_id, count(*) AS n FROM scoring GROUP BY ALL) USING (pgs_id)""")
def c18(t):
    routes = polygenic.route(t.scoring, size=200)
    rows = w08(t).join(F.broadcast(routes), "pgs_id")
    return rows.select("pgs_id", "sample_id", "score_milli", "route", polygenic.band(F.col("overall_percent")).alias("band"))


#: Scoring files as lines of text: three sound ones with some broken lines, one without a single sound line and one beyond the
#: size cap; the panel that lists them and one more that has no file; consent of two thirds of the individuals.
PANEL_RUN = """lines AS (SELECT pgs_id, chrom, cast(pos as string) AS pos, effect, cast(weight_milli as string) AS weight FROM scoring
  UNION ALL SELECT pgs_id, chrom, 'unknown', effect, '1' FROM scoring WHERE pos % 40 = 0
  UNION ALL SELECT pgs_id, chrom, cast(pos as string), effect, CASE WHEN pos % 80 = 0 THEN 'NaN' ELSE '' END FROM scoring WHERE pos % 40 = 8
  UNION ALL SELECT 'PGS8', chrom, cast(pos as string), effect, '1' FROM scoring
  UNION ALL SELECT 'PGS9', chrom, 'x' || cast(pos as string), effect, 'n/a' FROM scoring WHERE pgs_id = 'PGS1'),
listed AS (SELECT pgs_id, 'Trait ' || pgs_id AS trait, CASE WHEN pgs_id IN ('PGS2', 'PGS9') THEN 'yes' ELSE 'no' END AS s1_gate, cast(count(*) as bigint) AS n_variants
  FROM (SELECT pgs_id FROM lines UNION ALL SELECT 'PGS7') AS x GROUP BY pgs_id),
cap AS (SELECT count(*) - 1 AS most FROM lines WHERE pgs_id = 'PGS8'),
agreed AS (SELECT 'c' || cast(c as string) AS person, 'adult_onset' AS category, c % 3 = 0 AS granted FROM kin WHERE c % 3 < 2)"""


@query("c18_panel_status", "scoring", "cohort", "kin", sql=f"""WITH {SCORES}, {PANEL_RUN},
people AS (SELECT DISTINCT 'c' || individual AS sample_id FROM cohort),
good AS (SELECT pgs_id, count(*) AS n FROM lines WHERE try_cast(pos AS BIGINT) IS NOT NULL AND isfinite(try_cast(weight AS DOUBLE)) GROUP BY pgs_id),
st AS (SELECT l.pgs_id, l.trait, sample_id, CASE WHEN s1_gate = 'yes' AND sample_id NOT IN (SELECT person FROM agreed WHERE granted) THEN 'withheld'
    WHEN l.n_variants > (SELECT most FROM cap) THEN 'too large' WHEN coalesce(good.n, 0) = 0 THEN 'malformed' ELSE 'scored' END AS status
  FROM listed l CROSS JOIN people LEFT JOIN good USING (pgs_id))
SELECT st.pgs_id, trait, st.sample_id, CASE WHEN status = 'scored' AND n_used IS NULL THEN 'no calls' ELSE status END AS status,
  CASE WHEN status = 'scored' THEN score_milli END AS score_milli, CASE WHEN status = 'scored' THEN n_used END AS n_used
FROM st LEFT JOIN co ON co.pgs_id = st.pgs_id AND 'c' || co.individual = st.sample_id""")
def c18_status(t):
    """Every score of the panel for every individual: those that cannot be had have a status, the others go on."""
    one = lambda name: t.spark.sql(spark_ctes(t.spark, t.sf_dir, "scoring", "kin").rstrip() + f",\n{PANEL_RUN}\nSELECT * FROM {name}")
    lines = one("lines")
    usable = polygenic.usable_lines(lines)
    weights = usable.join(t.scoring.select("pgs_id", "chrom", "pos", "other").distinct(), ["pgs_id", "chrom", "pos"])
    scores = polygenic.prs_cohort(weights.withColumn("weight_milli", F.col("weight").cast("bigint")).drop("weight"), t.cohort)
    scores = scores.withColumn("sample_id", F.concat(F.lit("c"), "individual")).drop("individual")
    people = t.cohort.select(F.concat(F.lit("c"), "individual").alias("sample_id")).distinct()
    most = one("cap").first().most
    return polygenic.panel_scores(one("listed"), usable, scores, people.withColumn("person", F.col("sample_id")), one("agreed"), "adult_onset", most)


@query("a29_site_union", "scoring", "frequencies", sql="""WITH l AS (SELECT chrom, pos, effect AS a FROM scoring UNION SELECT chrom, pos, CASE WHEN pos % 3 = 0 THEN 'T' WHEN pos % 3 = 1 THEN 'TT' ELSE 'A' END FROM scoring),
g AS (SELECT chrom, pos, list_sort(list_filter(list_distinct(list(a)), lambda x: x <> 'A')) AS alts FROM l WHERE a IN ('A', 'C', 'G', 'T') GROUP BY ALL)
SELECT g.chrom, g.pos, 'A' AS ref, array_to_string(alts, ',') AS alt FROM g JOIN (SELECT DISTINCT chrom, pos FROM frequencies) USING (chrom, pos) WHERE len(alts) > 0""")
def a29(t):
    one = t.scoring.selectExpr("chrom", "pos", "effect as allele")
    two = t.scoring.selectExpr("chrom", "pos", "case when pos % 3 = 0 then 'T' when pos % 3 = 1 then 'TT' else 'A' end as allele")
    return polygenic.site_union([one, two], t.frequencies.selectExpr("chrom", "pos", "ref as base").distinct())


EVALS = """evals AS (SELECT 'PGS' || cast(p_partkey as string) AS pgs_id, 'EFO_' || cast(p_partkey % 17 as string) || ',EFO_' || cast(p_partkey % 5 + 20 as string) AS traits,
  CASE WHEN p_size % 3 = 0 THEN 'East Asian' ELSE 'European' END AS ancestry, CASE WHEN p_size % 4 = 0 THEN 'age,sex' END AS covariates, cast(p_size * 100 as bigint) AS n,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE cast(p_partkey * 37 % 1100 as double) / cast(1000 as double) END AS auroc, cast(p_partkey * 13 % 1000 as double) / cast(1000 as double) AS cindex FROM {part})"""


@query("a30_best_score_per_trait", sql=f"""WITH {EVALS.format(part="part")}, e AS (SELECT *, coalesce(auroc, cindex) AS metric, CASE WHEN auroc IS NOT NULL THEN 'AUROC' ELSE 'C-index' END AS metric_kind FROM evals
  WHERE ancestry = 'European' AND coalesce(covariates, '') = '' AND n >= 1000),
x AS (SELECT unnest(string_split(traits, ',')) AS trait, pgs_id, metric, metric_kind, n FROM e WHERE metric > 0.5 AND metric < 1)
SELECT trait, pgs_id, metric, metric_kind, n FROM x QUALIFY row_number() OVER (PARTITION BY trait ORDER BY metric DESC, n DESC, pgs_id) = 1""")
def a30(t):
    evals = t.spark.sql(f"WITH {EVALS.format(part=f'parquet.`{t.sf_dir}/part.parquet`')} SELECT * FROM evals")
    return polygenic.best_score_per_trait(evals)


# intervals

LEN = "abs(end_pos - start_pos) + 1"
SV = f"sv AS (SELECT *, {LEN} AS length FROM svs WHERE {PASS} AND replace(gt, '|', '/') NOT IN ('0/0', './.', '.') AND kind IN ('DEL', 'DUP', 'INV', 'INS'))"


@query("s12_read_sv", "svs", sql=f"WITH {SV} SELECT sv_id, chrom, start_pos, end_pos, kind, length FROM sv")
def s12(t):
    return intervals.read_sv(t.svs).select("sv_id", "chrom", "start_pos", "end_pos", "kind", "length")


@query("j16_sv_gene_overlap", "svs", "gene_regions", sql=f"""WITH {SV} SELECT s.sv_id, s.kind, g.gene FROM sv s JOIN gene_regions g
ON s.chrom = g.chrom AND s.start_pos <= g.end_pos AND g.start_pos <= s.end_pos WHERE s.length <= 3000000""")
def j16(t):
    return intervals.sv_gene_overlap(intervals.read_sv(t.svs), t.gene_regions).select("sv_id", "kind", "gene")


@query("j17_sv_gene_nearby", "svs", "gene_regions", sql=f"""WITH {SV} SELECT s.sv_id, g.gene, greatest(g.start_pos - s.end_pos, s.start_pos - g.end_pos, 0) AS gap
FROM sv s JOIN gene_regions g ON s.chrom = g.chrom WHERE s.length <= 3000000 AND greatest(g.start_pos - s.end_pos, s.start_pos - g.end_pos, 0) <= 100000""")
def j17(t):
    return intervals.sv_gene_nearby(intervals.read_sv(t.svs), t.gene_regions).select("sv_id", "gene", "gap")


@query("a25_sv_summary", "svs", sql=f"""SELECT kind, count(*) AS n, count(*) FILTER (kind <> 'BND' AND {LEN} <= 3000000) AS focal, count(*) FILTER (kind <> 'BND' AND {LEN} > 3000000) AS arm_scale
FROM svs WHERE {PASS} AND replace(gt, '|', '/') NOT IN ('0/0', './.', '.') GROUP BY kind""")
def a25(t):
    return intervals.sv_summary(t.svs)


@query("a27_callability", "depth", "gene_regions", sql="""WITH o AS (SELECT g.gene, least(d.end_pos, g.end_pos) - greatest(d.start_pos, g.start_pos) + 1 AS b, d.depth
  FROM depth d JOIN gene_regions g ON d.chrom = g.chrom AND d.start_pos <= g.end_pos AND g.start_pos <= d.end_pos),
s AS (SELECT gene, sum(CASE WHEN depth >= 10 THEN b ELSE 0 END) AS callable, sum(b * depth) AS reads FROM o GROUP BY gene)
SELECT g.gene, g.end_pos - g.start_pos + 1 AS length, CAST(coalesce(callable, 0) AS BIGINT) AS callable, CAST(floor(coalesce(reads, 0) * 100.0 / (g.end_pos - g.start_pos + 1)) AS BIGINT) AS mean_centi,
  coalesce(callable, 0) * 100 < (g.end_pos - g.start_pos + 1) * 95 AS flagged FROM gene_regions g LEFT JOIN s USING (gene)""")
def a27(t):
    return intervals.callability(t.depth, t.gene_regions)


@query("s15_genome_callability", "depth", sql="""SELECT chrom, CAST(sum(end_pos - start_pos + 1) AS BIGINT) AS bases, CAST(sum(CASE WHEN depth >= 10 THEN end_pos - start_pos + 1 ELSE 0 END) AS BIGINT) AS callable,
  CAST(sum((end_pos - start_pos + 1) * depth) AS BIGINT) AS reads FROM depth GROUP BY chrom""")
def s15(t):
    return intervals.genome_callability(t.depth)


LENGTHS = "lengths AS (SELECT chrom, max(end_pos) + 5000 AS length FROM depth GROUP BY chrom)"


@query("s15_depth_distribution", "depth", sql=f"""WITH {LENGTHS}, base AS (SELECT chrom, p, max(depth) AS depth FROM (SELECT chrom, depth, unnest(range(start_pos, end_pos + 1)) AS p FROM depth) GROUP BY chrom, p),
h AS (SELECT chrom, depth, count(*) AS n FROM base WHERE depth > 0 GROUP BY ALL), both_ AS (SELECT * FROM h UNION ALL SELECT 'total', depth, sum(n) FROM h GROUP BY depth),
every AS (SELECT * FROM lengths UNION ALL SELECT 'total', sum(length) FROM lengths),
r AS (SELECT chrom, depth, sum(n) OVER (PARTITION BY chrom ORDER BY depth DESC) AS bases FROM both_ UNION ALL SELECT chrom, 0, length FROM every)
SELECT r.chrom, r.depth, CAST(r.bases AS BIGINT) AS bases, CAST(r.bases AS DOUBLE) / CAST(length AS DOUBLE) AS share FROM r JOIN every USING (chrom)""")
def s15_distribution(t):
    """Share of the bases at any depth or above."""
    lengths = t.depth.groupBy("chrom").agg((F.max("end_pos") + 5000).alias("length"))
    return intervals.depth_distribution(t.depth, lengths)


# score tables

CAND = f"""cand AS (SELECT chrom, pos, ref, alt, min(gene) AS gene, min(consequence) AS consequence, min(gnomad_af) AS af, string_agg(DISTINCT sample_id, ',' ORDER BY sample_id) AS carriers
  FROM variants WHERE snapshot_id = '{LATER}' AND zygosity IN ('HET', 'HOM') AND (gnomad_af IS NULL OR gnomad_af <= 0.05) AND {q.noncoding("consequence")} GROUP BY chrom, pos, ref, alt)"""


@query("a39_regulatory_candidates", "variants", sql=f"WITH {CAND} SELECT * FROM cand")
def a39(t):
    return scores.regulatory_candidates(t.at(LATER))


@query("w09_top_candidates", "variants", "regulatory", sql=f"""WITH {CAND} SELECT chrom, pos, ref, alt, af FROM cand c WHERE NOT EXISTS
(SELECT 1 FROM regulatory r WHERE r.pos % 2 = 0 AND {q.on("r", "c")}) ORDER BY af NULLS FIRST, chrom, pos, ref, alt LIMIT 256""")
def w09(t):
    return scores.top_candidates(scores.regulatory_candidates(t.at(LATER)), t.regulatory.where("pos % 2 = 0")).select(*KEY, "af")


NULL = f"""nul AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY snv ORDER BY md5(chrom || ':' || pos || ':' || ref || ':' || alt)) AS place
  FROM (SELECT DISTINCT chrom, pos, ref, alt, regexp_matches(ref, '^[ACGT]$') AND regexp_matches(alt, '^[ACGT]$') AS snv FROM variants
    WHERE snapshot_id = '{LATER}' AND gnomad_af >= 0.2 AND {q.noncoding("consequence")})) WHERE place <= 400)"""


@query("w06_null_sample", "variants", sql=f"WITH {NULL} SELECT chrom, pos, ref, alt, snv, CAST(place AS INTEGER) AS place FROM nul")
def w06(t):
    return scores.null_sample(t.at(LATER))


@query("w07_null_percentile", "variants", "regulatory", sql=f"""WITH {NULL}, r AS (SELECT *, regexp_matches(ref, '^[ACGT]$') AND regexp_matches(alt, '^[ACGT]$') AS snv FROM regulatory),
n AS (SELECT nul.snv, r.delta_centi AS value FROM nul JOIN r ON {q.on("nul", "r")})
SELECT r.chrom, r.pos, r.ref, r.alt, r.snv, r.delta_centi AS value, (SELECT CASE WHEN count(*) > 0 THEN count(*) FILTER (n.value <= r.delta_centi) * 100.0::DOUBLE / count(*) END FROM n WHERE n.snv = r.snv) AS percentile FROM r""")
def w07(t):
    from vardelta.functions.alleles import is_snv

    rows = t.regulatory.select(*KEY, is_snv(F.col("ref"), F.col("alt")).alias("snv"), F.col("delta_centi").alias("value"))
    null = scores.null_sample(t.at(LATER)).select(*KEY).join(rows, KEY).select("snv", "value")
    return scores.null_percentile(rows, null).withColumn("percentile", F.col("percentile").cast("double"))


LONG = """long_scores AS (SELECT chrom, pos, ref, alt, CASE t WHEN 0 THEN 'RNA_SEQ' WHEN 1 THEN 'RNA_SEQ' WHEN 2 THEN 'DNASE' ELSE 'SPLICE_SITES' END AS scorer,
  CASE WHEN t = 1 OR pos % 3 = 0 THEN 'OTHER' ELSE 'G' || cast(pos % 60 as string) END AS gene, 'G' || cast(pos % 60 as string) AS target,
  CASE WHEN (pos + t) % 11 = 0 THEN NULL ELSE cast((pos * (t + 7)) % 2001 - 1000 as double) / cast(1000 as double) END AS raw_score,
  CASE WHEN pos % 4 = 0 THEN 'e1' ELSE 'e2' END AS epoch, cast(r as bigint) AS ingested, cast(t as bigint) AS track
  FROM regulatory CROSS JOIN (SELECT * FROM (VALUES (0), (1), (2), (3)) AS v(t)) AS x CROSS JOIN (SELECT * FROM (VALUES (1), (2)) AS w(r)) AS y
  WHERE r = 1 OR pos % 2 = 0)"""


def long_scores(t):
    from vardelta.derive import spark_ctes

    return t.spark.sql(spark_ctes(t.spark, t.sf_dir, "regulatory").rstrip() + f",\n{LONG}\nSELECT * FROM long_scores")


@query("s18_current_scores", "regulatory", sql=f"""WITH {LONG} SELECT chrom, pos, ref, alt, track, raw_score, ingested FROM long_scores WHERE epoch = 'e2' AND raw_score IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY chrom, pos, ref, alt, track ORDER BY ingested DESC) = 1""")
def s18(t):
    rows = scores.current_scores(long_scores(t), "e2", [*KEY, "track"])
    return rows.select(*KEY, "track", "raw_score", "ingested")


@query("w10_latest_per_key", "regulatory", sql=f"""WITH {LONG} SELECT chrom, pos, ref, alt, track, ingested FROM long_scores
QUALIFY row_number() OVER (PARTITION BY chrom, pos, ref, alt, track ORDER BY ingested DESC) = 1""")
def w10(t):
    return scores.latest_per_key(long_scores(t), [*KEY, "track"], ["ingested"]).select(*KEY, "track", "ingested")


@query("a31_score_summary", "regulatory", sql=f"""WITH {LONG}, s AS (SELECT chrom, pos, ref, alt, target, max(abs(raw_score)) FILTER (scorer = 'RNA_SEQ' AND gene = target) AS rna,
  max(abs(raw_score)) FILTER (scorer = 'DNASE') AS dn FROM long_scores WHERE raw_score IS NOT NULL GROUP BY ALL)
SELECT chrom, pos, ref, alt, target, coalesce(rna, dn) AS value, CASE WHEN rna IS NOT NULL THEN 'RNA_SEQ' ELSE 'DNASE' END AS scorer FROM s WHERE coalesce(rna, dn) IS NOT NULL""")
def a31(t):
    rows = long_scores(t)
    genes = rows.select(*KEY, F.col("target").alias("gene")).distinct()
    return scores.score_summary(rows.drop("target").where("raw_score is not null"), genes)


@query("a32_splice_evidence", "regulatory", "splice", sql=f"""WITH {LONG} SELECT chrom, pos, ref, alt, scorer, max(abs(raw_score)) AS value FROM long_scores l
WHERE scorer LIKE 'SPLICE%' AND NOT EXISTS (SELECT 1 FROM splice s WHERE {q.on("s", "l")}) GROUP BY ALL""")
def a32(t):
    return scores.splice_evidence(long_scores(t), t.splice)


@query("a33_epoch_check", "regulatory", sql=f"""WITH {LONG}, a AS (SELECT max(raw_score) FILTER (ingested = 1) AS x, max(raw_score) FILTER (ingested = 2) AS y FROM long_scores GROUP BY chrom, pos, ref, alt, track)
SELECT bool_and(coalesce(abs(x - y) <= greatest(greatest(abs(x), abs(y)) * 1e-6, 1e-7), false)) AS same, count(*) AS n FROM a""")
def a33(t):
    key = [*KEY, "track"]
    runs = [long_scores(t).where(f"ingested = {r}").groupBy(*key).agg(F.max("raw_score").alias("raw_score")) for r in (1, 2)]
    return scores.epoch_check(*runs, key)


@query("a40_sv_expression", "regulatory", sql=f"""WITH {LONG} SELECT chrom, pos, ref, alt, gene, arg_max(raw_score, (abs(raw_score), raw_score)) AS value FROM long_scores
WHERE scorer = 'RNA_SEQ' AND gene = target AND raw_score IS NOT NULL GROUP BY ALL""")
def a40(t):
    rows = long_scores(t).where("raw_score is not null")
    pairs = rows.select(*KEY, F.col("target").alias("gene")).distinct()
    return scores.sv_expression(rows.drop("target"), pairs)


# small domains

RULES = "SELECT DISTINCT 'trait of ' || chrom || ':' || cast(pos as string) AS trait, chrom, pos, ref, CASE WHEN pos % 2 = 0 THEN alt ELSE ref END AS effect, 'none' AS interp0, 'one' AS interp1, 'two' AS interp2 FROM genotypes WHERE k % 40 = 0 AND length(ref) = 1 AND length(alt) = 1"
RULED = f"""rules AS ({RULES}), smp AS (SELECT DISTINCT sample_id FROM genotypes),
rg AS (SELECT s.sample_id, r.*, g.gt, g.alt AS galt, g.ref AS gref FROM smp s CROSS JOIN rules r LEFT JOIN genotypes g ON g.sample_id = s.sample_id AND g.chrom = r.chrom AND g.pos = r.pos AND {PASS}),
pr AS (SELECT *, CASE WHEN gt IS NULL THEN [ref, ref] WHEN gt LIKE '%.%' THEN NULL ELSE list_transform(regexp_split_to_array(gt, '[/|]'), lambda a: CASE WHEN a = '0' THEN gref ELSE galt END) END AS pair FROM rg),
ruled AS (SELECT sample_id, trait, coalesce(array_to_string(pair, '/'), './.') AS genotype, CAST(CASE WHEN pair IS NOT NULL THEN list_count(list_filter(pair, lambda a: a = effect)) END AS INTEGER) AS n_effect,
  CASE WHEN pair IS NULL THEN 'indeterminate' ELSE [interp0, interp1, interp2][list_count(list_filter(pair, lambda a: a = effect)) + 1] END AS interpretation FROM pr)"""


def ruled(t):
    g = t.genotypes
    rules = g.where("k % 40 = 0 and length(ref) = 1 and length(alt) = 1").selectExpr(
        "concat('trait of ', chrom, ':', pos) as trait", "chrom", "pos", "ref", "case when pos % 2 = 0 then alt else ref end as effect",
        "'none' as interp0", "'one' as interp1", "'two' as interp2",
    ).distinct()
    return domains.rule_genotypes(rules, g.select("sample_id").distinct(), g)


@query("j19_rule_genotypes", "genotypes", sql=f"WITH {RULED} SELECT * FROM ruled")
def j19(t):
    return ruled(t)


@query("c20_tag_report", "genotypes", sql=f"""WITH {RULED} SELECT sample_id, CASE WHEN coalesce(bool_or(n_effect > 0), false) THEN 'present' WHEN bool_or(n_effect IS NULL) THEN 'indeterminate' ELSE 'absent' END AS tag FROM ruled GROUP BY sample_id""")
def c20(t):
    return domains.tag_summary(ruled(t))


LOCI = ", ".join(f"('{n}', {p or 'NULL'}, {x})" for n, p, x in domains.REPEAT_LOCI)
REPEATS = "SELECT sample_id, CASE WHEN k % 15 < 13 THEN (ARR)[k % 15 + 1] ELSE 'OTHER' || cast(k % 15 as string) END AS varid, cast(k % 90 as int) AS a, cast(q % 220 as int) AS b FROM genotypes"
NAMES = [n.upper() if i % 2 else n for i, (n, _, _) in enumerate(domains.REPEAT_LOCI)]


@query("c19_repeat_status", "genotypes", sql=f"""WITH loci(locus, pre, path) AS (VALUES {LOCI}),
c AS ({REPEATS.replace("(ARR)", str(NAMES))})
SELECT sample_id, varid, greatest(a, b) AS top, CASE WHEN locus IS NULL THEN 'none' WHEN greatest(a, b) >= path THEN 'expanded' WHEN coalesce(greatest(a, b) >= pre, false) THEN 'premutation' ELSE 'normal' END AS status
FROM c LEFT JOIN loci ON lower(locus) = lower(varid) WHERE locus IS NULL OR sample_id IN ('father', 'daughter')""")
def c19(t):
    names = F.array(*[F.lit(n) for n in NAMES])
    calls = t.genotypes.select(
        "sample_id", "k",
        F.array((F.col("k") % 90).cast("int"), (F.col("q") % 220).cast("int")).alias("sizes"),
    )
    varid = F.when(F.col("k") % 15 < 13, F.get(names, (F.col("k") % 15).cast("int"))).otherwise(F.concat(F.lit("OTHER"), F.col("k") % 15))
    consented = t.people.selectExpr("id as sample_id").where("sample_id in ('father', 'daughter')")
    return domains.repeat_status(calls.select("sample_id", varid.alias("varid"), "sizes"), domains.repeat_thresholds(t.spark), consented)


B = ["B*27:05:02", "B*27:06", "B*07:02:01", "B*27:09:01", "B*44:02"]
A1, B1 = ["DQA1*05:01:01", "DQA1*05:05", "DQA1*01:02"], ["DQB1*02:01:01", "DQB1*03:02", "DQB1*06:02"]


@query("c21_hla_risk", sql=f"""WITH t AS (SELECT cast(c_custkey as varchar) AS sample_id, [({B})[c_custkey % 5 + 1], ({B})[c_custkey // 5 % 5 + 1]] AS b,
  [({A1})[c_custkey % 3 + 1]] AS dqa1, [({B1})[c_custkey // 3 % 3 + 1], ({B1})[c_custkey // 9 % 3 + 1]] AS dqb1 FROM customer),
f AS (SELECT sample_id, list_transform(b, lambda x: regexp_replace(x, '^([^:]+:[^:]+):.*$', '\\1')) AS b, list_transform(dqa1, lambda x: regexp_replace(x, '^([^:]+:[^:]+):.*$', '\\1')) AS a,
  list_transform(dqb1, lambda x: regexp_replace(x, '^([^:]+:[^:]+):.*$', '\\1')) AS d FROM t),
h AS (SELECT *, list_has_any(a, ['DQA1*05:01', 'DQA1*05:05']) AND list_contains(d, 'DQB1*02:01') AS dq25, list_contains(d, 'DQB1*03:02') AS dq8 FROM f)
SELECT sample_id, CASE WHEN len(list_filter(b, lambda x: x LIKE 'B*27%' AND x NOT IN ('B*27:06', 'B*27:09'))) > 0 THEN 'present' WHEN len(list_filter(b, lambda x: x LIKE 'B*27%')) > 0 THEN 'non-associated' ELSE 'absent' END AS b27,
  CASE WHEN dq25 AND dq8 THEN 'DQ2.5 + DQ8' WHEN dq25 THEN 'DQ2.5' WHEN dq8 THEN 'DQ8' ELSE 'neither' END AS celiac FROM h""")
def c21(t):
    customers = t.spark.read.parquet(f"{t.sf_dir}/customer.parquet")
    pick = lambda names, by: F.get(F.array(*[F.lit(n) for n in names]), by.cast("int"))
    k = F.col("c_custkey")
    div = lambda n: F.floor(k / n)
    typed = customers.select(
        k.cast("string").alias("sample_id"), F.array(pick(B, k % 5), pick(B, div(5) % 5)).alias("b"), F.array(pick(A1, k % 3)).alias("dqa1"),
        F.array(pick(B1, div(3) % 3), pick(B1, div(9) % 3)).alias("dqb1"),
    )
    return domains.hla_risk(typed)


@query("c22_haplogroup_qc", "callsets", "people", sql="""WITH c AS (SELECT sample_id, CASE sample_id WHEN 'father_vendor' THEN 'father' ELSE sample_id END AS person, 'H' || length(sample_id) AS mt,
  CASE WHEN length(sample_id) % 3 = 0 THEN 'n/a' WHEN length(sample_id) % 3 = 1 THEN '0.91' ELSE '0.80' END AS quality, 'R1b' AS y FROM callsets)
SELECT sample_id, CASE WHEN coalesce(try_cast(quality AS DOUBLE) >= 0.85, false) THEN mt ELSE 'unresolved' END AS mt_group, CASE WHEN sex = 'male' THEN y END AS y_group FROM c LEFT JOIN people p ON p.id = c.person""")
def c22(t):
    n = F.length("sample_id")
    calls = t.callsets.select(
        "sample_id", F.when(F.col("sample_id") == "father_vendor", "father").otherwise(F.col("sample_id")).alias("person"), F.concat(F.lit("H"), n).alias("mt_group"),
        F.when(n % 3 == 0, "n/a").when(n % 3 == 1, "0.91").otherwise("0.80").alias("mt_quality"), F.lit("R1b").alias("y_group"),
    )
    return domains.haplogroup_qc(calls, t.people)


MITO = """mito AS (SELECT sample_id, pos % 16569 + 1 AS pos, ref, alt, filter, CASE WHEN k % 23 = 0 THEN '.' ELSE cast(cast(k % 101 as double) / cast(100 as double) as string) END AS af FROM genotypes)"""


@query("j24_mito_known", "genotypes", sql=f"""WITH {MITO}, cur AS (SELECT DISTINCT pos, ref, alt, 'disease ' || (pos % 3) AS disease FROM mito WHERE pos % 20 = 0),
m AS (SELECT m.*, try_cast(af AS DOUBLE) AS share, disease FROM mito m LEFT JOIN cur USING (pos, ref, alt))
SELECT sample_id, pos, ref, alt, CASE WHEN share >= 0.95 THEN 'homoplasmic' WHEN share >= 0.03 THEN 'heteroplasmic' ELSE 'low' END AS level, disease FROM m WHERE share IS NOT NULL""")
def j24(t):
    return mito(t).select("sample_id", "pos", "ref", "alt", "level", "disease")


def mito(t):
    from vardelta.derive import spark_ctes

    rows = t.spark.sql(spark_ctes(t.spark, t.sf_dir, "genotypes").rstrip() + f",\n{MITO}\nSELECT * FROM mito")
    curated = rows.where("pos % 20 = 0").select("pos", "ref", "alt", F.concat(F.lit("disease "), F.col("pos") % 3).alias("disease")).distinct()
    return domains.mito_calls(rows, curated)


@query("a26_mito_summary", "genotypes", sql=f"""WITH {MITO}, cur AS (SELECT DISTINCT pos, ref, alt, 'd' AS disease FROM mito WHERE pos % 20 = 0),
m AS (SELECT m.*, try_cast(af AS DOUBLE) AS s, disease FROM mito m LEFT JOIN cur USING (pos, ref, alt))
SELECT sample_id, count(*) FILTER (filter = 'PASS' AND s >= 0.95) AS homoplasmic, count(*) FILTER (filter = 'PASS' AND s >= 0.03 AND s < 0.95) AS heteroplasmic,
  count(*) FILTER (filter = 'PASS' AND s < 0.03) AS low, count(*) FILTER (filter = 'PASS' AND disease IS NOT NULL) AS known, count(*) FILTER (filter <> 'PASS') AS filtered_out
FROM m WHERE s IS NOT NULL GROUP BY sample_id""")
def a26(t):
    return domains.mito_summary(mito(t))


@query("a38_pgx_summary", sql="""WITH g AS (SELECT 'c' || (l_suppkey % 50) AS sample_id, ['Normal Metabolizer', 'Poor Metabolizer', NULL, 'No Result', 'Intermediate Metabolizer'][l_partkey % 5 + 1] AS ph FROM lineitem)
SELECT sample_id, count(*) AS called, count(*) FILTER (NOT regexp_matches(lower(coalesce(ph, '')), 'normal|n/a|uncertain|no result|indeterminate|negative|reference|not called')) AS non_normal FROM g GROUP BY sample_id""")
def a38(t):
    names = F.array(F.lit("Normal Metabolizer"), F.lit("Poor Metabolizer"), F.lit(None), F.lit("No Result"), F.lit("Intermediate Metabolizer"))
    rows = t.spark.read.parquet(f"{t.sf_dir}/lineitem.parquet")
    return domains.pgx_summary(rows.select(F.concat(F.lit("c"), F.col("l_suppkey") % 50).alias("sample_id"), F.get(names, (F.col("l_partkey") % 5).cast("int")).alias("phenotype")))

