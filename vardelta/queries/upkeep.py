"""Queries of sources, incremental maintenance, pedigree, consent, orders and set operations."""

from pyspark.sql import functions as F

from vardelta.derive import spark_ctes
from vardelta.operators import classify, delta, family, incremental, pedigree
from vardelta.plans import findings
from vardelta.queries import sqltext as q
from vardelta.queries._base import CHILD, CURR, FATHER, LATER, MOTHER, PREV, SON, SON_FATHER, query
from vardelta.queries.family import PERSONS
from vardelta.schemas import KEY
from vardelta.sources import readers, store

FIELD = "regexp_extract(info, '(?:^|;){}=([^;]*)', 1)"
RECORDS = f"""rec AS (SELECT release, chrom, pos, ref, alt, {FIELD.format("CLNSIG")} AS clinvar_sig, {FIELD.format("CLNREVSTAT")} AS clinvar_revstat,
  {FIELD.format("CLNDN")} AS clinvar_disease, {FIELD.format("ALLELEID")} AS clinvar_alleleid FROM clinvar)"""
RC = "clinvar_sig, clinvar_revstat, clinvar_disease, clinvar_alleleid"


def release(t, n):
    raw = t.clinvar.where(f"release = {n}").selectExpr("chrom", "cast(pos as string) as pos", "ref", "alt", "info")
    return readers.shape_clinvar(raw)


@query("s06_read_clinvar", "clinvar", sql=f"WITH {RECORDS} SELECT chrom, pos, ref, alt, {RC} FROM rec WHERE release = 0")
def s06(t):
    return release(t, 0)


CHANGES = f"""{RECORDS}, p AS (SELECT * FROM rec WHERE release = 0), c AS (SELECT * FROM rec WHERE release = 1),
changes AS (SELECT coalesce(c.chrom, p.chrom) AS chrom, coalesce(c.pos, p.pos) AS pos, coalesce(c.ref, p.ref) AS ref, coalesce(c.alt, p.alt) AS alt
  FROM p FULL OUTER JOIN c ON {q.on("p", "c")} WHERE p.clinvar_sig IS DISTINCT FROM c.clinvar_sig OR p.clinvar_revstat IS DISTINCT FROM c.clinvar_revstat
    OR p.clinvar_disease IS DISTINCT FROM c.clinvar_disease OR p.clinvar_alleleid IS DISTINCT FROM c.clinvar_alleleid)"""


@query("j07_clinvar_changes", "clinvar", sql=f"WITH {CHANGES} SELECT * FROM changes")
def j07(t):
    return incremental.clinvar_changes(release(t, 0), release(t, 1))


TOUCHED = f"""touched AS (SELECT DISTINCT v.sample_id, v.chrom, v.pos, v.ref, v.alt FROM variants v JOIN changes d ON v.chrom = d.chrom AND
  ((length(d.ref) = length(d.alt) AND v.pos = d.pos AND v.ref = d.ref AND v.alt = d.alt) OR (length(d.ref) <> length(d.alt) AND v.pos IN (d.pos, d.pos + 1)))
  WHERE v.snapshot_id = '{PREV}')"""


def touched(t):
    return incremental.carried_changed(t.at(PREV), incremental.clinvar_changes(release(t, 0), release(t, 1)))


@query("j08_carried_changed", "clinvar", "variants", sql=f"WITH {CHANGES}, {TOUCHED} SELECT * FROM touched")
def j08(t):
    return touched(t)


@query("j09_site_lookups", "clinvar", "variants", sql=f"""WITH {CHANGES}, {TOUCHED} SELECT chrom, pos FROM touched UNION
SELECT chrom, pos - 1 FROM touched WHERE ref = '-' OR alt = '-'""")
def j09(t):
    return incremental.site_lookups(touched(t))


TRIMMED = """new AS (SELECT chrom, CASE WHEN length(ref) <> length(alt) THEN pos + 1 ELSE pos END AS pos, CASE WHEN length(ref) <> length(alt) THEN coalesce(nullif(substr(ref, 2), ''), '-') ELSE ref END AS ref,
  CASE WHEN length(ref) <> length(alt) THEN coalesce(nullif(substr(alt, 2), ''), '-') ELSE alt END AS alt, nullif(clinvar_sig, '') AS clinvar_sig, nullif(clinvar_revstat, '') AS clinvar_revstat,
  nullif(clinvar_disease, '') AS clinvar_disease, nullif(clinvar_alleleid, '') AS clinvar_alleleid FROM rec WHERE release = 1)"""


@query("m04_reannotate_delta", "clinvar", "variants", sql=f"""WITH {CHANGES}, {TOUCHED}, {TRIMMED}
SELECT '{CURR}' AS snapshot_id, v.sample_id, v.chrom, v.pos, v.ref, v.alt, v.gene, CASE WHEN t.pos IS NULL THEN v.clinvar_sig ELSE n.clinvar_sig END AS clinvar_sig,
  CASE WHEN t.pos IS NULL THEN v.clinvar_disease ELSE n.clinvar_disease END AS clinvar_disease, v.zygosity
FROM variants v LEFT JOIN touched t ON v.sample_id = t.sample_id AND {q.on("v", "t")} LEFT JOIN new n ON {q.on("v", "n")} WHERE v.snapshot_id = '{PREV}'""")
def m04(t):
    from vardelta.streaming.jobs import keyed_like_variants

    changes = incremental.clinvar_changes(release(t, 0), release(t, 1))
    rows = incremental.reannotate_delta(t.variants, PREV, CURR, changes, keyed_like_variants(release(t, 1)))
    return rows.select("snapshot_id", "sample_id", *KEY, "gene", "clinvar_sig", "clinvar_disease", "zygosity")


@query("m03_copy_forward", "variants", sql=f"SELECT * REPLACE ('2024-04-01' AS snapshot_id) FROM variants WHERE snapshot_id = '{LATER}'")
def m03(t):
    return incremental.copy_forward(t.variants, LATER, "2024-04-01")


@query("s04_merge_subset", "variants", sql=f"""WITH base AS (SELECT * FROM variants WHERE snapshot_id = '{PREV}'), sub AS (SELECT * REPLACE ('NEW' AS gene) FROM base WHERE pos % 7 = 0)
SELECT * FROM base b WHERE NOT EXISTS (SELECT 1 FROM sub s WHERE s.sample_id = b.sample_id AND {q.on("s", "b")}) UNION ALL SELECT * FROM sub""")
def s04(t):
    base = t.at(PREV)
    return incremental.merge_subset(base, base.where("pos % 7 = 0").withColumn("gene", F.lit("NEW")))


LEDGER = """ledger AS (SELECT DISTINCT s.snapshot_id, c.sample_id, CASE WHEN c.sample_id = 'mother' THEN 'd' || s.snapshot_id ELSE 'd' || c.sample_id END AS vcf_digest,
  CASE WHEN c.sample_id = 'partner' THEN s.cache_version || s.snapshot_id ELSE s.cache_version END AS cache_version,
  CASE WHEN c.sample_id = 'grandson' THEN 'same' ELSE s.clinvar_date END AS clinvar_date
  FROM callsets AS c CROSS JOIN snapshots AS s WHERE NOT (c.sample_id = 'stranger_x' AND s.si = 0))"""


def shared(t, name, text, *tables):
    return t.spark.sql(spark_ctes(t.spark, t.sf_dir, *tables).rstrip() + f",\n{text}\nSELECT * FROM {name}")


def ledger(t):
    return shared(t, "ledger", LEDGER, "callsets", "snapshots")


@query("m01_incremental_kind", "callsets", "snapshots", sql=f"""WITH {LEDGER}
SELECT c.sample_id, CASE WHEN p.sample_id IS NULL THEN 'full' WHEN p.vcf_digest = n.vcf_digest AND p.cache_version = n.cache_version THEN
  CASE WHEN p.clinvar_date = n.clinvar_date THEN 'copy_forward' ELSE 'clinvar_delta' END ELSE 'full' END AS kind
FROM callsets c LEFT JOIN ledger p ON p.sample_id = c.sample_id AND p.snapshot_id = '{PREV}' LEFT JOIN ledger n ON n.sample_id = c.sample_id AND n.snapshot_id = '{CURR}'""")
def m01(t):
    return incremental.incremental_kind(ledger(t), t.callsets, PREV, CURR)


@query("m02_scan_mode", "releases", sql="""WITH a AS (SELECT snapshot_id FROM releases WHERE substr(snapshot_id, 9, 2) IN ('03', '17')),
s AS (SELECT snapshot_id, cache_version, lag(cache_version) OVER (ORDER BY snapshot_id) AS pv, row_number() OVER (ORDER BY snapshot_id) AS n FROM releases)
SELECT snapshot_id, CASE WHEN n = 1 OR pv <> cache_version OR NOT EXISTS (SELECT 1 FROM a WHERE substr(a.snapshot_id, 1, 7) = substr(s.snapshot_id, 1, 7) AND a.snapshot_id < s.snapshot_id) THEN 'full' ELSE 'incremental' END AS mode FROM s""")
def m02(t):
    full = t.releases.where("substr(snapshot_id, 9, 2) in ('03', '17')").select("snapshot_id")
    return incremental.scan_mode(t.releases, full)


LOG = """log AS (SELECT s.snapshot_id, c.sample_id, CASE WHEN s.si = 2 THEN 'started' WHEN c.sample_id = 'partner' AND s.si = 1 THEN 'skipped' ELSE 'done' END AS status
  FROM callsets AS c CROSS JOIN snapshots AS s WHERE NOT (c.sample_id = 'stranger_x' AND s.si = 1))"""


def log(t):
    return shared(t, "log", LOG, "callsets", "snapshots")


@query("m07_unscanned_samples", "callsets", "snapshots", sql=f"""WITH {LOG} SELECT sample_id FROM callsets WHERE sample_id NOT IN
(SELECT sample_id FROM log WHERE status = 'done' AND snapshot_id = (SELECT max(snapshot_id) FROM log WHERE status = 'done'))""")
def m07(t):
    return incremental.unscanned_samples(t.callsets, log(t))


@query("m11_scan_due", "callsets", "snapshots", sql=f"""WITH {LOG}, w AS (SELECT count(*) AS waiting FROM callsets WHERE sample_id NOT IN (SELECT sample_id FROM log WHERE status = 'done' AND snapshot_id = (SELECT max(snapshot_id) FROM log WHERE status = 'done')))
SELECT (SELECT max(snapshot_id) FROM log WHERE status = 'done') < (SELECT max(snapshot_id) FROM snapshots) OR waiting > 0 AS due,
  CASE WHEN (SELECT max(snapshot_id) FROM log WHERE status = 'done') < (SELECT max(snapshot_id) FROM snapshots) THEN 'unfinished' ELSE 'samples waiting' END AS reason, waiting FROM w""")
def m11(t):
    return incremental.scan_due(t.snapshots, log(t), t.callsets, "2024-02-24")


@query("j30_predecessor", "callsets", "snapshots", sql=f"WITH {LOG} SELECT max(snapshot_id) AS predecessor FROM log WHERE snapshot_id < '2024-06-01' AND status = 'done'")
def j30(t):
    return incremental.predecessor(log(t), "2024-06-01")


@query("m09_rekey_samples", "variants", sql="SELECT * REPLACE (CASE sample_id WHEN 'father' THEN 'adam' WHEN 'mother' THEN 'eva' ELSE sample_id END AS sample_id) FROM variants")
def m09(t):
    names = t.people.where("id in ('father', 'mother')").select(F.col("id").alias("old"), F.when(F.col("id") == "father", "adam").otherwise("eva").alias("new"))
    return incremental.rekey_samples(t.variants, names)


@query("m10_upsert_scores", "regulatory", sql=f"""WITH fresh AS (SELECT * REPLACE (CAST(0 AS BIGINT) AS delta_centi) FROM regulatory WHERE pos % 9 = 0)
SELECT * FROM regulatory r WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE {q.on("f", "r")}) UNION ALL SELECT * FROM fresh""")
def m10(t):
    fresh = t.regulatory.where("pos % 9 = 0").withColumn("delta_centi", F.lit(0).cast("bigint"))
    return incremental.upsert_scores(t.regulatory, fresh, KEY)


@query("a36_scan_tally", "variants", sql="SELECT snapshot_id, sample_id, count(*) AS n_rows FROM variants GROUP BY ALL")
def a36(t):
    return incremental.scan_tally(t.variants)


DIGESTED = "sample_id, k, n, q, chrom, pos, ref, alt, filter, gt, ad, dp, gq, ps"


def digest_sql(columns, source, by=None):
    """SQL of :func:`digests.multiset_digest` and its text: framed fields, summed parts of SHA-256."""
    text = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns.split(", "))
    part = lambda k: f"CAST(coalesce(sum(CAST('0x' || substr(h, {15 * k + 1}, 15) AS BIGINT)), 0) % 1152921504606846976 AS BIGINT)"
    digits = " || ".join(f"lower(lpad(hex({part(k)}), 15, '0'))" for k in range(4))
    own = f"{by}, " if by else ""
    return f"SELECT {own}count(*) AS n, {digits} AS digest FROM (SELECT *, sha256({text}) AS h FROM {source}) AS hashed" + (f" GROUP BY {by}" if by else "")


@query("a35_input_digests", "genotypes", sql=digest_sql(DIGESTED, "genotypes", "sample_id"))
def a35(t):
    return incremental.input_digests(t.genotypes.select(*DIGESTED.split(", ")))


@query("u02_set_difference", "variants", sql=f"SELECT DISTINCT chrom, pos, ref, alt FROM variants WHERE sample_id = '{CHILD}' EXCEPT SELECT chrom, pos, ref, alt FROM variants WHERE sample_id = '{FATHER}'")
def u02(t):
    v = t.variants
    return family.of_sample(v, CHILD).select(*KEY).subtract(family.of_sample(v, FATHER).select(*KEY))


@query("u03_union", "variants", "genotypes", sql="SELECT chrom, pos FROM variants UNION ALL SELECT chrom, pos FROM genotypes")
def u03(t):
    return t.variants.select("chrom", "pos").unionByName(t.genotypes.select("pos", "chrom"))


@query("j12_attach_annotations", "clinvar", "genotypes", "variants", sql=f"""WITH {RECORDS}, {TRIMMED}, csq AS (SELECT DISTINCT chrom, pos, ref, alt, consequence, gnomad_af FROM variants WHERE snapshot_id = '{LATER}')
SELECT v.sample_id, v.chrom, v.pos, v.ref, v.alt, n.clinvar_sig, c.consequence, c.gnomad_af FROM (SELECT DISTINCT sample_id, chrom, pos, ref, alt FROM variants WHERE snapshot_id = '{LATER}') v
LEFT JOIN new n ON {q.on("v", "n")} LEFT JOIN csq c ON {q.on("v", "c")}""")
def j12(t):
    from vardelta.streaming.jobs import keyed_like_variants

    v = t.at(LATER)
    csq = v.select(*KEY, "consequence", "gnomad_af").distinct()
    rows = classify.attach_annotations(v.select("sample_id", *KEY).distinct(), keyed_like_variants(release(t, 1)), csq)
    return rows.select("sample_id", *KEY, "clinvar_sig", "consequence", "gnomad_af")


# pedigree

UP = "up AS (SELECT id AS c, father AS p FROM people WHERE father IS NOT NULL UNION ALL SELECT id, mother FROM people WHERE mother IS NOT NULL)"
KIN = f"""{UP}, mate AS (SELECT id AS a, partner AS b FROM people WHERE partner IS NOT NULL), sib AS (SELECT DISTINCT x.c AS a, y.c AS b FROM up x JOIN up y ON x.p = y.p AND x.c <> y.c),
un AS (SELECT DISTINCT u.c AS a, s.b FROM up u JOIN sib s ON s.a = u.p),
r(a, b, k, m, f) AS (SELECT id, id, 0, 'self', 'self' FROM people UNION ALL SELECT c, p, 1, 'father', 'mother' FROM up UNION ALL SELECT p, c, 2, 'son', 'daughter' FROM up UNION ALL SELECT a, b, 3, 'partner', 'partner' FROM mate
  UNION ALL SELECT a, b, 4, 'brother', 'sister' FROM sib UNION ALL SELECT x.c, y.p, 5, 'grandfather', 'grandmother' FROM up x JOIN up y ON x.p = y.c UNION ALL SELECT y.p, x.c, 6, 'grandson', 'granddaughter' FROM up x JOIN up y ON x.p = y.c
  UNION ALL SELECT a, p, 7, 'father-in-law', 'mother-in-law' FROM mate JOIN up ON b = c UNION ALL SELECT mate.a, sib.b, 8, 'brother-in-law', 'sister-in-law' FROM mate JOIN sib ON mate.b = sib.a
  UNION ALL SELECT p, b, 9, 'son-in-law', 'daughter-in-law' FROM up JOIN mate ON a = c UNION ALL SELECT sib.a, mate.b, 10, 'brother-in-law', 'sister-in-law' FROM sib JOIN mate ON mate.a = sib.b
  UNION ALL SELECT a, b, 11, 'uncle', 'aunt' FROM un UNION ALL SELECT sib.a, c, 12, 'nephew', 'niece' FROM sib JOIN up ON p = sib.b UNION ALL SELECT un.a, c, 13, 'cousin', 'cousin' FROM un JOIN up ON p = un.b)"""


@query("j27_kinship", "kin", sql=f"""WITH {KIN.replace("people", "kin")}, best AS (SELECT a, b, arg_min(m, k) AS m, arg_min(f, k) AS f FROM r GROUP BY ALL)
SELECT x.id AS ego, y.id AS other, coalesce(CASE y.sex WHEN 'male' THEN m WHEN 'female' THEN f END, 'relative') AS term FROM kin x JOIN kin y ON x.family = y.family LEFT JOIN best ON a = x.id AND b = y.id""")
def j27(t):
    return pedigree.kinship(t.kin)


@query("j29_trio", "people", "callsets", sql=f"""WITH {PERSONS} SELECT id AS child, father, mother, id IN (SELECT person FROM persons) AND father IN (SELECT person FROM persons) AND mother IN (SELECT person FROM persons) AS sequenced
FROM people WHERE father IN (SELECT id FROM people) AND mother IN (SELECT id FROM people)""")
def j29(t):
    return pedigree.trio(t.people, pedigree.callset_to_person(t.callsets, t.people))


#: Pedigrees with planted faults: lines of descent that close after one, two and three steps, two cycles one below the
#: other, persons below a cycle, references to nobody, parents of the wrong sex, callsets of one and two suffixes.
ODD = """odd AS (SELECT id, CASE WHEN c % 10 = 3 THEN CASE sex WHEN 'male' THEN 'female' ELSE 'male' END ELSE sex END AS sex,
    CASE WHEN family % 7 = 1 AND r = 0 THEN 'p' || cast(c + 2 AS string) WHEN family % 13 = 3 AND r = 0 THEN 'p' || cast(c + 4 AS string)
      WHEN family % 7 = 1 AND family % 2 = 0 AND r = 4 THEN 'p' || cast(c + 1 AS string) WHEN family % 7 = 1 AND family % 2 = 0 AND r = 5 THEN 'p' || cast(c - 1 AS string)
      WHEN c % 10 = 7 THEN mother ELSE father END AS father,
    CASE WHEN family % 11 = 5 AND r = 1 THEN id WHEN c % 14 = 5 THEN 'nobody' ELSE mother END AS mother, partner
  FROM (SELECT *, c % 6 AS r FROM kin) AS k
  UNION ALL SELECT id || '_x', sex, NULL, NULL, NULL FROM kin WHERE c % 9 = 0
  UNION ALL SELECT id || '_x_y', sex, NULL, NULL, NULL FROM kin WHERE c % 15 = 0
  UNION ALL SELECT id || '_a_b', sex, NULL, NULL, NULL FROM kin WHERE c % 12 = 1)"""
ANCESTORS = """edge AS (SELECT o.id AS c, p.id AS p FROM odd o JOIN odd p ON p.id = o.father OR p.id = o.mother),
anc(id, a) AS (SELECT c, p FROM edge UNION SELECT anc.id, edge.p FROM anc JOIN edge ON edge.c = anc.a)"""


@query("w11_family_generation", "kin", sql=f"""WITH RECURSIVE {ODD}, {ANCESTORS},
lost AS (SELECT DISTINCT x.id FROM anc x WHERE x.a = x.id OR x.a IN (SELECT id FROM anc WHERE id = a)),
walk(id, g) AS (SELECT id, 0 FROM odd WHERE id NOT IN (SELECT c FROM edge) UNION SELECT e.c, w.g + 1 FROM walk w JOIN edge e ON e.p = w.id WHERE e.c NOT IN (SELECT id FROM lost)),
best AS (SELECT id, max(g) AS g FROM walk GROUP BY id),
mate AS (SELECT a, arg_min(b, w) AS b FROM (SELECT id AS a, partner AS b, 0 AS w FROM odd WHERE partner IS NOT NULL UNION ALL SELECT partner, id, 1 FROM odd WHERE partner IS NOT NULL) AS t GROUP BY a)
SELECT o.id, CASE WHEN o.id IN (SELECT c FROM edge) THEN b.g ELSE greatest(b.g, coalesce(m.g, 0)) END AS generation
FROM odd o LEFT JOIN best b ON b.id = o.id LEFT JOIN mate ON mate.a = o.id LEFT JOIN best m ON m.id = mate.b""")
def w11(t):
    return pedigree.generations(shared(t, "odd", ODD, "kin"))


@query("c25_pedigree_issues", "kin", sql=f"""WITH RECURSIVE {ODD}, {ANCESTORS},
n AS (SELECT id, 'father' AS role, father AS named FROM odd UNION ALL SELECT id, 'mother', mother FROM odd UNION ALL SELECT id, 'partner', partner FROM odd)
SELECT n.id, n.role || ' unknown: ' || named AS issue FROM n LEFT JOIN odd o ON o.id = named WHERE named IS NOT NULL AND o.id IS NULL
UNION ALL SELECT n.id, n.role || ' has the other sex: ' || named FROM n JOIN odd o ON o.id = named WHERE (role = 'father' AND o.sex = 'female') OR (role = 'mother' AND o.sex = 'male')
UNION ALL SELECT o.id, 'callset of ' || arg_max(p.id, length(p.id)) FROM odd o JOIN odd p ON starts_with(o.id, p.id || '_') GROUP BY o.id
UNION ALL SELECT id, 'is its own ancestor' FROM anc WHERE id = a""")
def c25(t):
    return pedigree.pedigree_issues(shared(t, "odd", ODD, "kin"))


@query("c24_pedigree_export", "people", "callsets", sql=f"""WITH {PERSONS}, r AS (SELECT c.sample_id, c.person, p.sex, p.father, p.mother, substr(c.sample_id, length(c.person) + 1) AS suffix FROM persons c JOIN people p ON p.id = c.person)
SELECT sample_id, person, CASE WHEN father || suffix IN (SELECT sample_id FROM callsets) THEN father || suffix ELSE coalesce(father, '0') END AS father,
  CASE WHEN mother || suffix IN (SELECT sample_id FROM callsets) THEN mother || suffix ELSE coalesce(mother, '0') END AS mother, CASE sex WHEN 'male' THEN 1 WHEN 'female' THEN 2 ELSE 0 END AS sex_code FROM r""")
def c24(t):
    return pedigree.pedigree_export(t.people, pedigree.callset_to_person(t.callsets, t.people))


CONSENTED = f"""{PERSONS}, cr AS (SELECT coalesce(p.person, c.sample_id) AS person, category, lower(consent) = 'yes' AS yes, c.sample_id <> coalesce(p.person, c.sample_id) AS alias FROM consent c LEFT JOIN persons p ON p.sample_id = c.sample_id),
granted AS (SELECT person, category, yes AS granted FROM cr QUALIFY row_number() OVER (PARTITION BY person, category ORDER BY alias, yes) = 1)"""


def granted(t):
    return pedigree.resolved_consent(t.consent, pedigree.callset_to_person(t.callsets, t.people))


@query("c23_resolved_consent", "consent", "callsets", sql=f"WITH {CONSENTED} SELECT * FROM granted")
def c23_resolved(t):
    return granted(t)


@query("c23_consent_gate", "consent", "callsets", "variants", sql=f"""WITH {CONSENTED} SELECT v.sample_id, p.person, count(*) AS n FROM variants v JOIN persons p USING (sample_id)
WHERE p.person IN (SELECT person FROM granted WHERE category = 'cancer' AND granted) GROUP BY ALL""")
def c23(t):
    persons = pedigree.callset_to_person(t.callsets, t.people)
    rows = t.variants.join(persons, "sample_id")
    return pedigree.consent_gate(rows, granted(t), "cancer").groupBy("sample_id", "person").agg(F.count("*").alias("n"))


@query("j26_fully_consented", "consent", "callsets", "variants", sql=f"""WITH {CONSENTED}, v AS (SELECT * FROM variants WHERE snapshot_id = '{LATER}'),
c AS (SELECT DISTINCT chrom, pos, ref, alt, person FROM v JOIN persons USING (sample_id)),
ok AS (SELECT chrom, pos, ref, alt FROM c LEFT JOIN granted g ON g.person = c.person AND g.category = 'cancer' GROUP BY ALL HAVING bool_and(coalesce(granted, false)))
SELECT DISTINCT chrom, pos, ref, alt FROM ok""")
def j26(t):
    persons = pedigree.callset_to_person(t.callsets, t.people)
    v = t.at(LATER)
    carriers = v.join(persons, "sample_id").select(*KEY, "person").distinct()
    return pedigree.fully_consented(v.select(*KEY).distinct(), carriers, granted(t), "cancer", KEY)


@query("m12_fold_consent", "consent", "callsets", sql=f"""WITH {CONSENTED} SELECT person, category, CASE WHEN person = 'father' AND category = 'cancer' THEN 'no' WHEN granted THEN 'yes' ELSE 'no' END AS consent FROM granted
UNION ALL SELECT 'granddaughter', 'neuro', 'yes'""")
def m12(t):
    change = t.people.where("id in ('father', 'granddaughter')").select(
        F.when(F.col("id") == "father", "father_vendor").otherwise(F.col("id")).alias("sample_id"), F.when(F.col("id") == "father", "cancer").otherwise("neuro").alias("category"),
        F.when(F.col("id") == "father", "no").otherwise("yes").alias("consent"),
    )
    return pedigree.fold_consent(t.consent, change, pedigree.callset_to_person(t.callsets, t.people))


PAIRS = f"""v AS (SELECT * FROM variants WHERE snapshot_id = '{LATER}'), own AS (SELECT DISTINCT gene, chrom, pos, ref, alt FROM v WHERE sample_id = '{SON}' AND gene IS NOT NULL AND {q.act("clinvar_sig")}),
w AS (SELECT o.*, EXISTS (SELECT 1 FROM v WHERE sample_id = '{SON_FATHER}' AND {q.on("v", "o")}) AS f, EXISTS (SELECT 1 FROM v WHERE sample_id = '{CHILD}' AND {q.on("v", "o")}) AS m FROM own o)"""


@query("w05_parental_phase", "variants", sql=f"""WITH {PAIRS} SELECT a.gene, a.pos AS a_pos, b.pos AS b_pos, CASE WHEN a.f = a.m OR b.f = b.m THEN 'unknown' WHEN a.f = b.f THEN 'cis' ELSE 'trans' END AS phase
FROM w a JOIN w b ON a.gene = b.gene AND a.pos < b.pos""")
def w05(t):
    from vardelta.functions.significance import is_actionable

    v = t.at(LATER)
    own = family.of_sample(v, SON).where(is_actionable(F.col("clinvar_sig")) & F.col("gene").isNotNull())
    persons = t.callsets.select("sample_id", F.col("sample_id").alias("person"))
    rows = own.select("gene", *KEY).distinct().join(family.parent_carriage(v, own, persons, SON_FATHER, CHILD), KEY)
    side = lambda s: rows.select("gene", F.col("pos").alias(f"{s}_pos"), F.col("in_father").alias(f"{s}_father"), F.col("in_mother").alias(f"{s}_mother"))
    pairs = side("a").join(side("b"), "gene").where("a_pos < b_pos")
    return family.parental_phase(pairs).select("gene", "a_pos", "b_pos", "phase")


# orders: the place of a row makes the order visible


def placed(df, *order):
    from pyspark.sql import Window

    return df.withColumn("place", F.row_number().over(Window.partitionBy("sample_id").orderBy(*order)))


@query("t04_order_unclassified_last", "variants", sql=f"""SELECT sample_id, chrom, pos, ref, alt, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY clinvar_sig IS NULL, gene NULLS LAST, chrom, pos, ref, alt) AS INTEGER) AS place
FROM variants WHERE snapshot_id = '{LATER}'""")
def t04(t):
    rows = placed(t.at(LATER), F.col("clinvar_sig").isNull(), F.col("gene").asc_nulls_last(), *KEY)
    return rows.select("sample_id", *KEY, "place")


@query("t01_order_full", "variants", sql=f"""WITH f AS (SELECT *, {q.stars("clinvar_revstat")} AS stars, CASE WHEN clinvar_sig = 'Pathogenic' THEN 0 WHEN regexp_matches(clinvar_sig, '(^|[/|])Pathogenic(,_low_penetrance)?($|[/|])') THEN 1 ELSE 2 END AS rk
  FROM variants WHERE snapshot_id = '{CURR}' AND {q.act("clinvar_sig")})
SELECT sample_id, chrom, pos, ref, alt, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY rk, stars DESC, coalesce(gene, 'zzz'), chrom, pos, ref, alt) AS INTEGER) AS place FROM f""")
def t01(t):
    return placed(findings.full_findings(t.at(CURR)), *findings.full_order()).select("sample_id", *KEY, "place")


@query("t07_head", "variants", sql=f"SELECT sample_id, chrom, pos, ref, alt FROM variants WHERE snapshot_id = '{LATER}' ORDER BY gnomad_af DESC NULLS LAST, sample_id, chrom, pos, ref, alt LIMIT 200")
def t07(t):
    return t.at(LATER).orderBy(F.col("gnomad_af").desc_nulls_last(), "sample_id", *KEY).limit(200).select("sample_id", *KEY)


@query("t02_order_delta", "variants", sql=f"""WITH {q.delta(PREV, CURR)}, o AS (SELECT *, {q.stars("curr_rev")} AS stars FROM changed)
SELECT sample_id, chrom, pos, ref, alt, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY change_kind, stars DESC, coalesce(gene, ''), chrom, pos, ref, alt) AS INTEGER) AS place FROM o""")
def t02(t):
    from vardelta.functions.significance import review_stars

    rows = delta.with_change(delta.snapshot_delta(t.variants, PREV, CURR))
    rows = rows.withColumn("stars", review_stars(F.col("curr_clinvar_revstat")))
    return placed(rows, "change_kind", F.col("stars").desc(), F.coalesce("gene", F.lit("")), *KEY).select("sample_id", *KEY, "place")


@query("q01_sql_surface", "variants", sql=f"""SELECT chrom, pos, ref, alt, max(gene) FILTER (sample_id = '{SON}') AS gene FROM variants
WHERE snapshot_id = '{LATER}' AND sample_id IN ('{SON}', '{MOTHER}') GROUP BY chrom, pos, ref, alt HAVING count(DISTINCT sample_id) = 2""")
def q01(t):
    text = """SELECT c.chrom, c.pos, c.ref, c.alt, c.gene FROM variants c LEFT SEMI JOIN variants m
      ON m.snapshot_id = :snapshot AND m.sample_id = :relative AND m.chrom = c.chrom AND m.pos = c.pos AND m.ref = c.ref AND m.alt = c.alt
      WHERE c.snapshot_id = :snapshot AND c.sample_id = :child"""
    return store.run_sql(t.spark, text, t.variants, snapshot=LATER, child=SON, relative=MOTHER)


# sources, over text rows derived from the tables

RAW = """raw AS (SELECT CASE WHEN k % 97 = 0 THEN 'rs' || cast(k as string) ELSE chrom || '_' || cast(pos as string) || '_' || ref || '/' || alt END AS uploaded, '-' AS location, alt AS allele,
  coalesce(gene, '-') AS symbol, consequence, CASE WHEN k % 2 = 0 THEN coalesce(cast(gnomad_af as string), '-') || '&0.5' ELSE '-' END AS gnomade, CASE WHEN k % 3 = 0 THEN '0.25' ELSE '-' END AS gnomadg,
  coalesce(sift, '-') AS sift, coalesce(polyphen, '-') AS polyphen, lower(zygosity) AS zyg, coalesce(clinvar_sig, '-') AS clnsig, clinvar_revstat AS clnrevstat, coalesce(clinvar_disease, '-') AS clndn,
  clinvar_alleleid AS alleleid, sample_id FROM annotated WHERE si = 0)"""
AFE = "try_cast(split_part(nullif(gnomade, '-'), '&', 1) AS DOUBLE)"


@query("s01_read_annotated", "annotated", sql=f"""WITH {RAW}, x AS (SELECT *, split_part(uploaded, '_', 3) AS al FROM raw)
SELECT sample_id, split_part(uploaded, '_', 1) AS chrom, try_cast(split_part(uploaded, '_', 2) AS BIGINT) AS pos, split_part(al, '/', 1) AS ref, split_part(al, '/', 2) AS alt, nullif(symbol, '-') AS gene,
  nullif(clnsig, '-') AS clinvar_sig, nullif(clndn, '-') AS clinvar_disease, greatest({AFE}, try_cast(nullif(gnomadg, '-') AS DOUBLE)) AS gnomad_af, upper(zyg) AS zygosity FROM x WHERE try_cast(split_part(uploaded, '_', 2) AS BIGINT) IS NOT NULL""")
def s01(t):
    rows = readers.shape_annotated(shared(t, "raw", RAW, "annotated"), "sample_id").where("pos is not null")
    return rows.select("sample_id", *KEY, "gene", "clinvar_sig", "clinvar_disease", "gnomad_af", "zygosity")


@query("s02_guard_parsed", "annotated", sql=f"""WITH {RAW} SELECT count(*) FILTER (try_cast(split_part(uploaded, '_', 2) AS BIGINT) IS NULL) AS bad, count(*) AS total,
  min(CASE WHEN try_cast(split_part(uploaded, '_', 2) AS BIGINT) IS NULL THEN uploaded END) AS example FROM raw""")
def s02(t):
    return readers.unparsed(readers.shape_annotated(shared(t, "raw", RAW, "annotated")))


@query("s03_load_partition", "variants", sql=f"SELECT '{LATER}' AS snapshot_id, sample_id, count(*) AS n FROM variants WHERE (snapshot_id, sample_id) IN (('{LATER}', '{FATHER}'), ('{PREV}', '{MOTHER}')) GROUP BY sample_id")
def s03(t):
    root = store.scratch(t.spark, "variants-store")
    for sample in (FATHER, MOTHER):  # two samples of one snapshot, the second twice
        store.load_partition(t.at(LATER).where(f"sample_id = '{sample}'"), root, LATER, sample)
    store.load_partition(t.at(PREV).where(f"sample_id = '{MOTHER}'"), root, LATER, MOTHER)
    return store.read_variants(t.spark, root).groupBy("snapshot_id", "sample_id").agg(F.count("*").alias("n"))


LINES = """vcf AS (SELECT sample_id, CASE WHEN k % 71 = 0 THEN '##header' WHEN k % 73 = 0 THEN chrom || chr(9) || 'short' ELSE chrom || chr(9) || cast(pos as string) || chr(9) || '.' || chr(9) || ref || chr(9) || alt || chr(9) || '50' || chr(9) || filter || chr(9) || 'DB;QD=3' || chr(9)
  || CASE WHEN k % 2 = 0 THEN 'GT:AD:DP:GQ' ELSE 'GT:DP:GQ:PS' END || chr(9) || CASE WHEN k % 2 = 0 THEN gt || ':' || ad || ':' || cast(dp as string) || ':.' ELSE gt || ':' || cast(dp as string) || ':' || cast(gq as string) || ':' || cast(ps as string) END END AS value, k, chrom, pos, ref, alt, gt, dp, gq, ps, ad FROM genotypes)"""


@query("s07_read_genotypes", "genotypes", sql=f"""WITH {LINES} SELECT sample_id, chrom, pos, ref, alt, nullif(gt, '.') AS gt, CAST(dp AS INTEGER) AS dp, CASE WHEN k % 2 = 1 THEN CAST(gq AS INTEGER) END AS gq,
  CASE WHEN k % 2 = 1 THEN CAST(ps AS VARCHAR) END AS ps, CASE WHEN k % 2 = 0 THEN ad END AS ad FROM vcf WHERE k % 71 > 0 AND k % 73 > 0""")
def s07(t):
    lines = shared(t, "vcf", LINES, "genotypes").select("sample_id", "value")
    return readers.shape_genotypes(lines).select("sample_id", *KEY, "gt", "dp", "gq", "ps", "ad")


PANEL_RAW = "praw AS (SELECT disease, min(gene) || ', ' || max(gene) || ',' AS genes, lower(inh) AS inheritance, 'n' AS note FROM panel GROUP BY disease, inh)"


@query("s08_read_rules", "panel", sql=f"WITH {PANEL_RAW} SELECT disease, trim(g) AS gene, upper(inheritance) AS inh FROM (SELECT disease, inheritance, unnest(string_split(genes, ',')) AS g FROM praw) WHERE trim(g) <> ''")
def s08(t):
    return readers.shape_panel(shared(t, "praw", PANEL_RAW, "panel")).select("disease", "gene", "inh")


SCORE_RAW = """sraw AS (SELECT pgs_id, CASE WHEN pos % 31 = 0 THEN '' ELSE chrom END AS hm_chr, CASE WHEN pos % 37 = 0 THEN 'x' ELSE cast(pos as string) END AS hm_pos, effect AS effect_allele,
  CASE WHEN pos % 2 = 0 THEN '' ELSE other END AS other_allele, other AS hm_inferOtherAllele, CASE WHEN pos % 41 = 0 THEN 'n/a' ELSE cast(weight_milli as string) END AS effect_weight FROM scoring)"""


@query("s09_read_scoring", "scoring", sql=f"""WITH {SCORE_RAW} SELECT pgs_id, hm_chr AS chrom, CAST(hm_pos AS BIGINT) AS pos, effect_allele AS effect, coalesce(nullif(other_allele, ''), hm_inferOtherAllele) AS other,
  CAST(effect_weight AS DOUBLE) AS weight FROM sraw WHERE hm_chr <> '' AND hm_pos <> 'x' AND effect_weight <> 'n/a'""")
def s09(t):
    rows = readers.guard_usable(readers.shape_scoring(shared(t, "sraw", SCORE_RAW, "scoring")))
    return rows.withColumn("weight", F.col("weight").cast("double"))


REP_RAW = """rraw AS (SELECT sample_id, CASE WHEN k % 3 = 0 THEN 'REPID=L' || cast(k % 20 as string) ELSE 'VARID=V' || cast(k % 20 as string) END || ';RU=CAG' AS info, CASE WHEN k % 19 = 0 THEN 'GT' ELSE 'GT:REPCN' END AS format,
  CASE WHEN k % 19 = 0 THEN '0/1' ELSE '0/1:' || cast(k % 50 as string) || CASE WHEN k % 5 = 0 THEN '' ELSE '/' || cast(q % 60 as string) END END AS sample FROM genotypes)"""


@query("s13_read_repeats", "genotypes", sql=f"""WITH {REP_RAW} SELECT sample_id, regexp_extract(info, '(VARID|REPID)=([^;]*)', 2) AS varid, 'CAG' AS unit, split_part(sample, ':', 2) AS sizes FROM rraw WHERE format = 'GT:REPCN'""")
def s13(t):
    rows = readers.shape_repeats(shared(t, "rraw", REP_RAW, "genotypes"))
    return rows.withColumn("sizes", F.array_join(F.col("sizes").cast("array<string>"), "/"))


@query("s14_read_mito", "genotypes", sql="""SELECT sample_id, chrom, pos, CAST(k % 101 AS DOUBLE) / 100 AS share FROM genotypes WHERE k % 23 > 0""")
def s14(t):
    raw = t.genotypes.select("sample_id", "chrom", "pos", F.when(F.col("k") % 23 == 0, ".").otherwise((F.col("k") % 101 / 100).cast("string")).alias("af"))
    return raw.withColumn("share", F.col("af").try_cast("double")).where("share is not null").drop("af")


@query("s16_read_pgx_json", sql="""SELECT CAST(c_custkey AS VARCHAR) AS sample_id, 'G' || (c_custkey % 7) AS gene, CASE WHEN c_custkey % 3 = 0 THEN '*1/*4' ELSE '*1/*2' END AS diplotype,
  CASE WHEN c_custkey % 3 = 0 THEN 'Poor' ELSE 'Normal; x' END AS phenotype FROM customer""")
def s16(t):
    body = F.concat(
        F.lit('{"genes":{"G'), F.col("c_custkey") % 7, F.lit('":{"recommendationDiplotypes":'),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("[]")).otherwise(F.lit('[{"label":"*1/*2","phenotypes":["Normal","x"]}]')),
        F.lit(',"sourceDiplotypes":[{"label":"*1/*4","phenotypes":["Poor"]}]}}}'),
    )
    rows = t.spark.read.parquet(f"{t.sf_dir}/customer.parquet").select(F.col("c_custkey").cast("string").alias("sample_id"), body.alias("report"))
    return readers.shape_pgx(rows)


@query("s17_read_typed_alleles", sql="""SELECT CAST(c_custkey AS VARCHAR) AS sample_id, 'A' AS locus, 'A*0' || (c_custkey % 5) || ':01' AS allele FROM customer UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'A', 'A*24:02' FROM customer""")
def s17(t):
    body = F.concat(F.lit('{"A":["A*0'), F.col("c_custkey") % 5, F.lit(':01:03","A*24:02"]}'))
    rows = t.spark.read.parquet(f"{t.sf_dir}/customer.parquet").select(F.col("c_custkey").cast("string").alias("sample_id"), body.alias("typed"))
    return readers.shape_typed_alleles(rows)


HEADS = """heads AS (SELECT 'f' || cast(s_suppkey as string) AS file, CASE WHEN s_suppkey % 4 = 3 THEN '##x' ELSE '##contig=<ID=' || CASE WHEN s_suppkey % 2 = 0 THEN 'chr' ELSE '' END || '1,assembly=a,length=' || CASE WHEN s_suppkey % 3 = 0 THEN '249250621' ELSE '248956422' END || '>' END AS value FROM {supplier}
  UNION ALL SELECT 'f' || cast(s_suppkey as string), '#CHROM' || chr(9) || 'POS' || chr(9) || 'ID' || chr(9) || 'REF' || chr(9) || 'ALT' || chr(9) || 'QUAL' || chr(9) || 'FILTER' || chr(9) || 'INFO' || chr(9) || 'FORMAT' || chr(9) || 's' || CASE WHEN s_suppkey % 5 = 0 THEN chr(9) || 'two' ELSE '' END FROM {supplier}
  UNION ALL SELECT 'f' || cast(s_suppkey as string), '##fileDate=2024-01-' || cast(10 + s_suppkey % 9 as string) FROM {supplier} WHERE s_suppkey % 3 > 0)"""


def heads(t):
    return t.spark.sql("WITH " + HEADS.replace("{supplier}", f"parquet.`{t.sf_dir}/supplier.parquet`") + " SELECT * FROM heads")


@query("s19_check_build", sql="""SELECT 'f' || s_suppkey AS file, CASE WHEN s_suppkey % 4 = 3 THEN NULL WHEN s_suppkey % 3 = 0 THEN 249250621 ELSE 248956422 END AS chr1_length, CASE WHEN s_suppkey % 5 = 0 THEN 2 ELSE 1 END AS n_samples,
  CASE WHEN s_suppkey % 5 = 0 THEN 'not one sample' WHEN s_suppkey % 4 = 3 THEN 'unknown build' WHEN s_suppkey % 3 = 0 THEN 'wrong build' ELSE 'ok' END AS verdict FROM supplier""")
def s19(t):
    return readers.check_build(heads(t))


@query("s20_snapshot_dates", sql="SELECT 'f' || s_suppkey AS file, CASE WHEN s_suppkey % 3 > 0 THEN '2024-01-' || (10 + s_suppkey % 9) END AS clinvar_date FROM supplier")
def s20(t):
    return readers.snapshot_dates(heads(t))


@query("s22_write_companion", "variants", sql=f"""SELECT snapshot_id, chrom, pos, ref, alt, gene, clinvar_sig FROM (SELECT DISTINCT snapshot_id, chrom, pos, ref, alt, gene, clinvar_sig FROM variants WHERE snapshot_id = '{LATER}' OR (snapshot_id = '{PREV}' AND pos % 2 = 0)) AS x""")
def s22(t):
    root = store.scratch(t.spark, "companions")
    keep = ["snapshot_id", *KEY, "gene", "clinvar_sig", "clinvar_revstat"]
    rows = t.variants.select(*keep).distinct().withColumns({c: F.lit(None).cast("string") for c in ("snapshot_date", "gnomad_af", "acmg_tier", "model_band", "model_epoch")})
    store.write_companion(rows.where(f"snapshot_id in ('{PREV}', '{LATER}')"), root, "variant_history", ["snapshot_id"])
    store.write_companion(rows.where(f"snapshot_id = '{PREV}' and pos % 2 = 0"), root, "variant_history", ["snapshot_id"])
    return store.read_companion(t.spark, root, "variant_history").select("snapshot_id", *KEY, "gene", "clinvar_sig")


@query("s21_export", "variants", sql=f"SELECT sample_id, count(*) AS n, count(gene) AS n_gene FROM variants WHERE snapshot_id = '{LATER}' GROUP BY ALL")
def s21(t):
    root = store.scratch(t.spark, "export")
    store.export(t.at(LATER).select("sample_id", "pos", "gene"), root)
    back = t.spark.read.schema("sample_id string, pos long, gene string").csv(root, sep="\t", header=True, nullValue="")
    return back.groupBy("sample_id").agg(F.count("*").alias("n"), F.count("gene").alias("n_gene"))


@query("s23_reduce_constraint", sql="""WITH r AS (SELECT 'G' || (l_partkey % 500) AS gene, l_suppkey % 7 = 0 AS mane, l_suppkey % 3 = 0 AS canonical, l_orderkey * 8 + l_linenumber AS line, l_discount AS pli, l_tax AS loeuf FROM lineitem)
SELECT gene, pli, loeuf, line FROM r QUALIFY row_number() OVER (PARTITION BY gene ORDER BY CASE WHEN mane THEN 2 WHEN canonical THEN 1 ELSE 0 END DESC, line, pli, loeuf) = 1""")
def s23(t):
    rows = t.spark.read.parquet(f"{t.sf_dir}/lineitem.parquet").selectExpr(
        "concat('G', l_partkey % 500) as gene", "l_suppkey % 7 = 0 as mane", "l_suppkey % 3 = 0 as canonical",
        "l_orderkey * 8 + l_linenumber as line", "l_discount as pli", "l_tax as loeuf",
    )
    rows = rows.groupBy("gene", "mane", "canonical", "line").agg(F.min(F.struct("pli", "loeuf")).alias("v")).select("gene", "mane", "canonical", "line", "v.*")
    return readers.reduce_constraint(rows)


@query("s24_read_population", "populations", sql="SELECT CAST(individual AS VARCHAR) AS individual, superpopulation FROM populations WHERE individual % 10 > 0")
def s24(t):
    body = F.concat_ws(" ", F.lit("fam"), F.col("individual").cast("string"), F.when(F.col("individual") % 10 > 0, F.regexp_replace("superpopulation", " ", "_")).otherwise(""))
    lines = t.populations.select((F.col("individual") + 1).alias("line_no"), body.alias("value"))
    head = t.spark.range(1).select(F.lit(0).cast("bigint").alias("line_no"), F.lit("FamilyID SampleID Superpopulation").alias("value"))
    rows = readers.shape_population(lines.unionByName(head))
    return rows.withColumn("superpopulation", F.regexp_replace("superpopulation", "_", " "))


@query("s25_read_frequencies", "frequencies", "scoring", sql="""SELECT f.chrom, f.pos, f.ref, f.alt, CAST(f.af_milli AS VARCHAR) AS matched, 'x' AS overall FROM frequencies f
WHERE EXISTS (SELECT 1 FROM scoring s WHERE s.chrom = f.chrom AND s.pos = f.pos)""")
def s25(t):
    raw = t.frequencies.select("chrom", "pos", "ref", "alt", F.concat(F.lit("AF=x;AF_MATCHED="), F.col("af_milli").cast("string")).alias("info"))
    rows = readers.shape_frequencies(raw, t.scoring, [str(i) for i in range(1, 23)])
    return rows.select("chrom", "pos", "ref", "alt", "matched", "overall")
