"""Queries of family joins, panels and inheritance."""

from pyspark.sql import functions as F

from vardelta.operators import family, panel, pedigree
from vardelta.queries import sqltext as q
from vardelta.queries._base import CHILD, CURR, FATHER, LATER, MOTHER, SON, query

V = f"v AS (SELECT * FROM variants WHERE snapshot_id = '{LATER}')"
ACT = q.act("clinvar_sig")
LABEL = "chrom || ':' || pos || ' ' || ref || '>' || alt"


#: One row a variant: who of the family carries it how.
BY_VARIANT = """by_variant AS (SELECT chrom, pos, ref, alt, max(gene) AS gene, max(clinvar_sig) AS clinvar_sig, max(consequence) AS consequence, max(gnomad_af) AS gnomad_af,
""" + ",\n".join(f"  max(zygosity) FILTER (sample_id = '{who}') AS {role}" for role, who in (("of_child", CHILD), ("of_father", FATHER), ("of_mother", MOTHER), ("of_son", SON))) + """
  FROM v GROUP BY chrom, pos, ref, alt)"""


@query("j01_recessive", "variants", sql=f"""WITH {V}, {BY_VARIANT}
SELECT chrom, pos, ref, alt, gene, clinvar_sig FROM by_variant WHERE (of_child, of_father, of_mother) = ('HOM', 'HET', 'HET')""")
def j01(t):
    return family.recessive(t.at(LATER), CHILD, FATHER, MOTHER).select("chrom", "pos", "ref", "alt", "gene", "clinvar_sig")


@query("j02_de_novo_candidates", "variants", sql=f"""WITH {V}, {BY_VARIANT}
SELECT gene, chrom, pos, ref, alt, clinvar_sig, consequence, of_child AS zygosity, gnomad_af FROM by_variant
WHERE of_child IS NOT NULL AND coalesce(of_father, of_mother) IS NULL""")
def j02(t):
    rows = family.unclassified_last(family.de_novo_candidates(t.at(LATER), CHILD, FATHER, MOTHER))
    return rows.select("gene", "chrom", "pos", "ref", "alt", "clinvar_sig", "consequence", "zygosity", "gnomad_af")


@query("j03_x_linked", "variants", sql=f"""WITH {V}, {BY_VARIANT}
SELECT gene, chrom, pos, ref, alt, clinvar_sig, of_son AS son_zyg, of_child AS mother_zyg FROM by_variant
WHERE replace(chrom, 'chr', '') = 'X' AND {ACT} AND of_son IS NOT NULL AND of_child = 'HET'""")
def j03(t):
    rows = family.x_linked(t.at(LATER), SON, CHILD)
    return rows.select("gene", "chrom", "pos", "ref", "alt", "clinvar_sig", "son_zyg", "mother_zyg")


@query("j04_compound_het", "variants", sql=f"""WITH {V}, {BY_VARIANT},
by_gene AS (SELECT gene, list(side) FILTER (of_mother IS NULL) AS paternal, list(side) FILTER (of_father IS NULL) AS maternal
  FROM (SELECT *, {{'name': {LABEL}, 'sig': clinvar_sig}} AS side FROM by_variant
    WHERE {ACT} AND of_child = 'HET' AND (of_father IS NULL) <> (of_mother IS NULL)) GROUP BY gene HAVING gene IS NOT NULL),
one AS (SELECT gene, maternal, unnest(paternal) AS p FROM by_gene), two AS (SELECT gene, p, unnest(maternal) AS m FROM one)
SELECT gene, p.name AS paternal_variant, p.sig AS paternal_sig, m.name AS maternal_variant, m.sig AS maternal_sig FROM two""")
def j04(t):
    return family.compound_het(t.at(LATER), CHILD, FATHER, MOTHER)


@query("a01_carrier_rows", "variants", sql=f"""SELECT gene, chrom, pos, ref, alt, clinvar_sig, sample_id, zygosity, count(*) OVER (PARTITION BY gene, chrom, pos, ref, alt, clinvar_sig) AS n_carriers
FROM variants WHERE snapshot_id = '{LATER}' AND clinvar_sig IN ('Pathogenic', 'Likely_pathogenic', 'Pathogenic/Likely_pathogenic')""")
def a01_rows(t):
    return family.carrier_rows(t.at(LATER))


@query("a01_carriers", "variants", sql=f"""WITH {V},
shown AS (SELECT * EXCLUDE (sample_id, zygosity), printf('%s(%s)', sample_id, zygosity) AS who FROM v
  WHERE list_contains(['Pathogenic', 'Likely_pathogenic', 'Pathogenic/Likely_pathogenic'], clinvar_sig))
SELECT gene, chrom, pos, ref, alt, clinvar_sig, array_to_string(list_sort(list(who)), ', ') AS carriers, len(list(who)) AS n_carriers
FROM shown GROUP BY gene, chrom, pos, ref, alt, clinvar_sig""")
def a01(t):
    return family.carriers(t.at(LATER))


PERSONS = """persons AS (SELECT sample_id, CASE sample_id WHEN 'father_vendor' THEN 'father' WHEN 'mother_vendor_rerun' THEN 'mother'
  ELSE sample_id END AS person FROM callsets)"""


@query("j28_callset_to_person", "callsets", "people", sql=f"WITH {PERSONS} SELECT sample_id, person FROM persons")
def j28(t):
    return pedigree.callset_to_person(t.callsets, t.people)


@query("j21_parent_carriage", "variants", "callsets", sql=f"""WITH {V}, {PERSONS},
k AS (SELECT DISTINCT chrom, pos, ref, alt FROM v WHERE sample_id = '{CHILD}'),
s AS (SELECT v.*, p.person FROM v JOIN persons p USING (sample_id))
SELECT k.*, coalesce(bool_or(s.person = '{FATHER}'), false) AS in_father, coalesce(bool_or(s.person = '{MOTHER}'), false) AS in_mother
FROM k LEFT JOIN s ON {q.on("k", "s")} GROUP BY ALL""")
def j21(t):
    v = t.at(LATER)
    persons = pedigree.callset_to_person(t.callsets, t.people)
    return family.parent_carriage(v, family.of_sample(v, CHILD), persons, FATHER, MOTHER)


HETS = f"""hets AS (SELECT * FROM (SELECT v.*, count(*) OVER (PARTITION BY gene, chrom) AS n_hets FROM v
  WHERE sample_id = '{CHILD}' AND zygosity = 'HET' AND {q.damaging()} AND gene IN (SELECT gene FROM panel)) WHERE n_hets >= 2)"""


@query("a06_double_het_genes", "variants", "panel", sql=f"""WITH {V}, {HETS}
SELECT gene, chrom, pos, ref, alt, n_hets FROM hets""")
def a06(t):
    return family.double_het_genes(t.at(LATER), t.panel, CHILD).select("gene", "chrom", "pos", "ref", "alt", "n_hets")


@query("c16_trio_segregation", "variants", "panel", sql=f"""WITH {V}, {HETS},
w AS (SELECT h.gene, EXISTS (SELECT 1 FROM v WHERE sample_id = '{FATHER}' AND {q.on("v", "h")}) AS f,
  EXISTS (SELECT 1 FROM v WHERE sample_id = '{MOTHER}' AND {q.on("v", "h")}) AS m FROM hets h)
SELECT gene, count(*) AS n_variants, CASE WHEN bool_or(f = m) THEN 'unresolved' WHEN bool_or(f) AND bool_or(m) THEN 'in-trans'
  ELSE 'in-cis' END AS phase FROM w GROUP BY gene""")
def c16(t):
    v = t.at(LATER)
    persons = t.callsets.select("sample_id", F.col("sample_id").alias("person"))
    hets = family.double_het_genes(v, t.panel, CHILD)
    carriage = family.parent_carriage(v, hets, persons, FATHER, MOTHER)
    return family.resolve_genes(family.transmission(hets.join(carriage, ["chrom", "pos", "ref", "alt"])))


@query("a08_transmission", "variants", sql=f"""WITH {V}
SELECT chrom, pos, ref, alt, CASE WHEN f AND m THEN 'both' WHEN f THEN 'paternal' WHEN m THEN 'maternal' ELSE 'neither' END AS transmission
FROM (SELECT DISTINCT chrom, pos, ref, alt, EXISTS (SELECT 1 FROM v WHERE sample_id = '{FATHER}' AND {q.on("v", "c")}) AS f,
  EXISTS (SELECT 1 FROM v WHERE sample_id = '{MOTHER}' AND {q.on("v", "c")}) AS m FROM v c WHERE sample_id = '{CHILD}')""")
def a08(t):
    v = t.at(LATER)
    persons = t.callsets.select("sample_id", F.col("sample_id").alias("person"))
    rows = family.transmission(family.parent_carriage(v, family.of_sample(v, CHILD), persons, FATHER, MOTHER))
    return rows.select("chrom", "pos", "ref", "alt", "transmission")


SECOND = f"""second AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, gene ORDER BY gnomad_af NULLS FIRST, chrom, pos, ref, alt) AS place
  FROM (SELECT *, {ACT} AS act, sum(({ACT})::INT) OVER (PARTITION BY sample_id, gene) AS n_act FROM v
    WHERE zygosity = 'HET' AND gene IN (SELECT gene FROM panel WHERE inh = 'AR'))
  WHERE NOT act AND n_act = 1 AND (gnomad_af IS NULL OR gnomad_af <= 0.01)) WHERE place <= 50)"""


@query("w04_second_hits", "variants", "panel", sql=f"""WITH {V}, {SECOND}
SELECT sample_id, gene, chrom, pos, ref, alt, gnomad_af, CAST(place AS INTEGER) AS place FROM second""")
def w04(t):
    return family.second_hits(t.at(LATER), t.panel).select("sample_id", "gene", "chrom", "pos", "ref", "alt", "gnomad_af", "place")


CARRIED = f"""found AS (SELECT chrom, pos, ref, alt, person, CASE WHEN bool_or(zygosity = 'HOM') THEN 'HOM' ELSE 'HET' END AS zyg,
  string_agg(DISTINCT sample_id, ',' ORDER BY sample_id) AS callsets, count(DISTINCT sample_id) AS n_callsets
  FROM v JOIN persons USING (sample_id) WHERE {ACT} GROUP BY ALL)"""


@query("a19_family_carriers", "variants", "callsets", sql=f"WITH {V}, {PERSONS}, {CARRIED} SELECT * FROM found")
def a19(t):
    return family.family_carriers(t.at(LATER), pedigree.callset_to_person(t.callsets, t.people))


ORIGIN = f"""traced AS (SELECT f.*, CASE WHEN p.father IS NULL OR p.mother IS NULL THEN 'founder'
  WHEN p.father NOT IN (SELECT person FROM persons) OR p.mother NOT IN (SELECT person FROM persons) THEN 'unresolved'
  WHEN a.person IS NOT NULL AND b.person IS NOT NULL THEN 'both' WHEN a.person IS NOT NULL THEN 'father'
  WHEN b.person IS NOT NULL THEN 'mother' ELSE 'de_novo' END AS origin
  FROM found f LEFT JOIN people p ON p.id = f.person
  LEFT JOIN found a ON a.person = p.father AND {q.on("a", "f")} LEFT JOIN found b ON b.person = p.mother AND {q.on("b", "f")})"""


@query("a20_origin", "variants", "callsets", "people", sql=f"""WITH {V}, {PERSONS}, {CARRIED}, {ORIGIN}
SELECT chrom, pos, ref, alt, person, zyg, origin FROM traced""")
def a20(t):
    persons = pedigree.callset_to_person(t.callsets, t.people)
    rows = family.origins(family.family_carriers(t.at(LATER), persons), t.people, persons)
    return rows.select("chrom", "pos", "ref", "alt", "person", "zyg", "origin")


@query("a21_discordant", "variants", "callsets", sql=f"""WITH {V}, {PERSONS}, {CARRIED}
SELECT chrom, pos, ref, alt, person FROM found f WHERE n_callsets < (SELECT count(DISTINCT sample_id) FROM persons p WHERE p.person = f.person)""")
def a21(t):
    persons = pedigree.callset_to_person(t.callsets, t.people)
    rows = family.discordant(family.family_carriers(t.at(LATER), persons), persons)
    return rows.select("chrom", "pos", "ref", "alt", "person")


@query("c15_inheritance", "variants", "callsets", "people", sql=f"""WITH {V}, {PERSONS}, {CARRIED}, {ORIGIN}
SELECT person, origin, count(*) AS n, count(*) FILTER (zyg = 'HOM') AS n_hom FROM traced GROUP BY ALL""")
def c15(t):
    persons = pedigree.callset_to_person(t.callsets, t.people)
    rows = family.origins(family.family_carriers(t.at(LATER), persons), t.people, persons)
    return rows.groupBy("person", "origin").agg(F.count("*").alias("n"), F.count_if(F.col("zyg") == "HOM").alias("n_hom"))


STATUS = f"""hit AS (SELECT sample_id, gene, bool_or(zygosity = 'HOM') AS hom, count(*) FILTER (zygosity = 'HET') AS hets,
    count(DISTINCT CASE WHEN zygosity = 'HET' THEN {LABEL} END) AS keys, count(*) AS n_variants
  FROM v WHERE gene IS NOT NULL AND {ACT} GROUP BY ALL),
by_gene AS (SELECT * FROM (SELECT h.sample_id, p.disease, p.inh, h.gene, CASE
    WHEN p.inh = 'AD' OR (p.inh = 'XL' AND s.sex = 'male') THEN CASE WHEN hom OR hets > 0 THEN CASE WHEN p.inh = 'AD' THEN 'at-risk' ELSE 'affected' END END
    WHEN hom THEN 'affected' WHEN keys >= 2 THEN 'compound' WHEN hets > 0 THEN 'carrier' END AS status, n_variants
  FROM hit h JOIN panel p ON h.gene = p.gene LEFT JOIN people s ON s.id = h.sample_id) WHERE status IS NOT NULL)"""
NAMES = "['affected', 'compound', 'at-risk', 'carrier']"


def by_gene(t):
    return panel.gene_status(t.at(CURR), t.panel, t.people.selectExpr("id AS sample_id", "sex"))


V2 = V.replace(LATER, CURR)


@query("a03_panel_gene_status", "variants", "panel", "people", sql=f"WITH {V2}, {STATUS} SELECT * FROM by_gene")
def a03_gene(t):
    return by_gene(t)


@query("a03_panel_status", "variants", "panel", "people", sql=f"""WITH {V2}, {STATUS}
SELECT sample_id, disease, {NAMES}[min(list_position({NAMES}, status))] AS status, count(*) AS n_genes FROM by_gene GROUP BY ALL""")
def a03(t):
    return panel.panel_status(by_gene(t))


INDEX = f"""idx AS (SELECT gene, sample_id, {NAMES}[min(list_position({NAMES}, status))] AS status FROM by_gene WHERE inh = 'AR' GROUP BY ALL)"""


@query("a04_ar_index", "variants", "panel", "people", sql=f"WITH {V2}, {STATUS}, {INDEX} SELECT * FROM idx")
def a04(t):
    return panel.ar_index(by_gene(t))


@query("j31_member_pairs", "variants", "panel", "people", sql=f"""WITH {V2}, {STATUS}, {INDEX}
SELECT x.gene, x.sample_id AS a, y.sample_id AS b, x.status AS a_status, y.status AS b_status FROM idx x JOIN idx y ON x.gene = y.gene AND x.sample_id < y.sample_id""")
def j31(t):
    return panel.member_pairs(panel.ar_index(by_gene(t)), t.people.select(F.col("id").alias("sample_id"), F.lit(1).alias("family")))


@query("a05_family_risk", "variants", "panel", "people", sql=f"""WITH {V2}, {STATUS}, {INDEX},
c AS (SELECT *, CASE status WHEN 'affected' THEN 100 ELSE 50 END AS lo, CASE status WHEN 'carrier' THEN 50 ELSE 100 END AS hi FROM idx)
SELECT x.gene, count(*) AS n_pairs, CAST(round_even(min(x.lo * y.lo) / 100.0, 0) AS INTEGER) AS low_percent,
  CAST(round_even(max(x.hi * y.hi) / 100.0, 0) AS INTEGER) AS high_percent
FROM c x JOIN c y ON x.gene = y.gene AND x.sample_id < y.sample_id GROUP BY x.gene""")
def a05(t):
    return panel.family_risk(panel.ar_index(by_gene(t)))


@query("c14_panel_report", "variants", "panel", "people", sql=f"""WITH {V2}, {STATUS},
notes AS (SELECT DISTINCT gene, 'note of ' || gene AS note FROM panel WHERE gene LIKE '%3'),
best AS (SELECT sample_id, disease, {NAMES}[min(list_position({NAMES}, status))] AS status, count(*) AS n_genes FROM by_gene GROUP BY ALL),
n AS (SELECT sample_id, disease, arg_min(note, gene) AS note FROM by_gene JOIN notes USING (gene) GROUP BY ALL)
SELECT sample_id, disease, status, n_genes, coalesce(note, 'penetrance not listed') AS note,
  CASE WHEN status = 'carrier' THEN 'carrier' ELSE 'primary' END AS section FROM best LEFT JOIN n USING (sample_id, disease)""")
def c14(t):
    notes = t.panel.where("gene like '%3'").select("gene", F.concat(F.lit("note of "), "gene").alias("note")).distinct()
    return panel.panel_report(by_gene(t), notes)
