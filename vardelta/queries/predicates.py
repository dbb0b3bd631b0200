"""Queries of single column expressions: distinct inputs with their results."""

from pyspark.sql import functions as F

from vardelta.functions import alleles, bands, consequences, significance
from vardelta.operators import delta
from vardelta.queries import sqltext as q
from vardelta.queries._base import query

T = q.terms("clinvar_sig")
PLAIN = "regexp_replace(t, ',_low_penetrance$', '')"
ACTS = "['Likely_pathogenic', 'Pathogenic']"


def expression(name: str, table: str, columns: str, out: dict, sql: dict[str, str], where: str = "true"):
    """Register a query of distinct ``columns`` of a derived table with expressions over them."""
    fields = ", ".join(f"{e} AS {n}" for n, e in sql.items())

    @query(name, table, sql=f"SELECT {columns}, {fields} FROM (SELECT DISTINCT {columns} FROM {table} WHERE {where}) AS x")
    def run(t):
        rows = getattr(t, table).where(where).selectExpr(*columns.split(", ")).distinct()
        return rows.withColumns({n: f(*[F.col(c) for c in columns.split(", ")]) for n, f in out.items()})

    return run


SIG = "clinvar_sig"
expression("p01_is_actionable", "variants", SIG, {"out": significance.is_actionable}, {"out": q.act(SIG)})
expression("p02_is_uncertain", "variants", SIG, {"out": significance.is_uncertain}, {"out": q.uncertain(SIG)})
expression(
    "p03_sig_terms", "variants", SIG,
    {"terms": lambda c: F.array_join(significance.sig_terms(c), ";"), "flags": lambda c: F.array_join(significance.sig_flags(c), ";")},
    {
        "terms": f"array_to_string({T}, ';')",
        "flags": f"""array_to_string(list_concat(CASE WHEN len(list_filter({T}, lambda t: t LIKE '%,_low_penetrance')) = 0 THEN []
          WHEN list_has_any({T}, {ACTS}) THEN ['low penetrance (some submitters)'] ELSE ['low penetrance'] END,
          list_distinct(list_transform(list_filter({T}, lambda t: NOT list_contains({ACTS}, {PLAIN})), lambda t: replace(replace(t, '_', ' '), ' ,', ',')))), ';')""",
    },
)
RANK = f"""CASE WHEN len({T}) > 0 AND len(list_filter({T}, lambda t: t <> 'Pathogenic')) = 0 THEN 0
  WHEN len(list_filter({T}, lambda t: {PLAIN} = 'Pathogenic')) > 0 THEN 1 ELSE 2 END"""
expression("p04_sig_rank", "variants", SIG, {"out": significance.sig_rank}, {"out": RANK})
expression(
    "p05_sig_cell", "variants", SIG, {"out": significance.sig_cell},
    {"out": f"""replace(coalesce({SIG}, ''), '|', '; ') || CASE WHEN len(list_filter({T}, lambda t: t LIKE '%,_low_penetrance')) = 0 THEN ''
      WHEN list_has_any({T}, {ACTS}) THEN ' ⚠️ low penetrance (some submitters)' ELSE ' ⚠️ low penetrance' END"""},
)
expression("p06_path_ordinal", "variants", SIG, {"out": significance.path_ordinal}, {"out": q.ordinal(SIG)})
expression("p07_clinvar_class", "variants", SIG, {"out": significance.clinvar_class}, {"out": q.clinvar_class(SIG)})
expression("p08_review_stars", "variants", "clinvar_revstat", {"out": significance.review_stars}, {"out": q.stars("clinvar_revstat")})
NAME = """replace(coalesce(list_filter(string_split(clinvar_disease, '|'), lambda p: lower(trim(p)) NOT IN ('not_provided', 'not_specified', 'see_cases', ''))[1],
  string_split(clinvar_disease, '|')[1]), '_', ' ')"""
expression(
    "p09_disease_name", "variants", "clinvar_disease", {"out": significance.disease_name},
    {"out": f"CASE WHEN coalesce(clinvar_disease, '') = '' THEN '—' WHEN length({NAME}) > 55 THEN substr({NAME}, 1, 55) || '…' ELSE {NAME} END"},
)
expression(
    "p10_rarity", "variants", "gnomad_af", {"out": significance.rarity},
    {"out": "CASE WHEN gnomad_af IS NULL THEN 'novel' WHEN gnomad_af < 0.001 THEN 'rare' ELSE 'common' END"},
)
expression("p11_is_damaging", "variants", "consequence, sift, polyphen", {"out": consequences.is_damaging}, {"out": q.damaging()})
SHORT = "coalesce(list_filter(['stop_gained', 'frameshift', 'splice_acceptor', 'splice_donor', 'start_lost', 'missense'], lambda s: contains(coalesce(consequence, ''), s))[1], split_part(coalesce(consequence, ''), ',', 1))"
expression("p12_short_consequence", "variants", "consequence", {"out": consequences.short_consequence}, {"out": SHORT})
expression("p13_primary_consequence", "variants", "consequence", {"out": consequences.primary_consequence}, {"out": q.primary("consequence")})
BASES = "(CASE WHEN {0} = '-' THEN 0 ELSE length({0}) END)"
expression(
    "p14_class_scope", "variants", "consequence, ref, alt", {"out": consequences.class_scope},
    {"out": f"CASE WHEN NOT list_contains({q.SEVERITY}, {q.primary('consequence')}) THEN 'none' WHEN abs({BASES.format('alt')} - {BASES.format('ref')}) > 50 THEN 'deferred' ELSE 'call' END"},
)
expression("p15_is_noncoding", "variants", "consequence", {"out": consequences.is_noncoding}, {"out": q.noncoding("consequence")})
expression("p16_is_pass", "genotypes", "filter", {"out": alleles.is_pass}, {"out": "coalesce(filter IN ('PASS', '.'), false)"})
expression("p23_is_snv", "genotypes", "ref, alt", {"out": alleles.is_snv}, {"out": "length(ref) = 1 AND length(alt) = 1 AND ref IN ('A', 'C', 'G', 'T') AND alt IN ('A', 'C', 'G', 'T')"})
expression("p24_is_autosome", "variants", "chrom", {"out": alleles.is_autosome}, {"out": "coalesce(try_cast(chrom AS INT) BETWEEN 1 AND 22, false)"})
AD = "list_transform(string_split(ad, ','), lambda x: CASE WHEN x = '.' THEN 0 ELSE CAST(x AS INT) END)"
expression(
    "p25_ad_counts", "genotypes", "ad", {"counts": lambda c: F.array_join(alleles.ad_counts(c).cast("array<string>"), ","), "vaf": alleles.vaf},
    {"counts": f"array_to_string(CAST({AD} AS VARCHAR[]), ',')", "vaf": f"CASE WHEN list_sum({AD}) > 0 THEN CAST(list_sum({AD}) - ({AD})[1] AS DOUBLE) / list_sum({AD}) ELSE 0.0 END"},
)
expression(
    "p26_is_low_balance", "annotated", "zygosity, n, q", {"out": lambda z, n, total: alleles.is_low_balance(z, n * 10, total)},
    {"out": "coalesce(zygosity = 'HET' AND q > 0 AND CAST(n * 10 AS DOUBLE) / q < 0.25, false)"},
)
GT = "regexp_split_to_array(gt, '[/|]')"
PAIR = f"list_transform({GT}, lambda g: CASE WHEN g = '0' THEN ref WHEN g = '1' THEN alt END)"
expression(
    "p27_decode_genotype", "genotypes", "ref, alt, gt", {"out": lambda r, a, g: F.array_join(alleles.decode_genotype(r, a, g), "/")},
    {"out": f"CASE WHEN contains(gt, '.') THEN NULL ELSE array_to_string({PAIR}, '/') END"},
)
LONGER, SHORTER = "CASE WHEN length(alt) > length(ref) THEN alt ELSE ref END", "CASE WHEN length(alt) > length(ref) THEN ref ELSE alt END"
expression(
    "p28_is_homopolymer_indel", "genotypes", "ref, alt", {"out": alleles.is_homopolymer_indel},
    {"out": f"length(ref) <> length(alt) AND len(list_distinct(string_split(CASE WHEN starts_with({LONGER}, {SHORTER}) THEN substr({LONGER}, length({SHORTER}) + 1) ELSE {LONGER} END, ''))) = 1"},
)
expression("p30_norm_zyg", "variants", "zygosity", {"out": alleles.norm_zyg}, {"out": "upper(coalesce(zygosity, ''))"})
expression("p30_is_male", "kin", "sex", {"out": alleles.is_male}, {"out": "coalesce(lower(sex) IN ('male', 'm', '1'), false)"})
expression(
    "p31_splice_band", "splice", "dg", {"out": lambda d: bands.splice_band(d / 100.0)},
    {"out": "CASE WHEN dg >= 80 THEN 'high' WHEN dg >= 50 THEN 'likely' WHEN dg >= 20 THEN 'possible' ELSE 'low' END"},
)
expression(
    "p31_regulatory_band", "regulatory", "delta_centi, percentile", {"out": lambda d, p: bands.regulatory_band(d / 100.0, p)},
    {"out": "CASE WHEN percentile IS NOT NULL THEN CASE WHEN percentile >= 99 THEN 'high' WHEN percentile >= 95 THEN 'moderate' ELSE 'low' END WHEN delta_centi >= 300 THEN 'high' WHEN delta_centi >= 100 THEN 'moderate' ELSE 'low' END"},
)
expression(
    "p32_is_constrained", "gene_constraint", "gene, pli, loeuf", {"out": lambda g, p, x: bands.is_constrained(p, x)},
    {"out": "CASE WHEN pli IS NULL AND loeuf IS NULL THEN NULL ELSE coalesce(pli >= 0.9, false) OR coalesce(loeuf < 0.6, false) END"},
)
expression(
    "p33_sv_scorable", "svs", "kind, start_pos, end_pos",
    {"scorable": lambda k, a, b: bands.sv_scorable(k, a, b, a, F.lit(3_000_000)), "fits": lambda k, a, b: bands.window_fits(a, F.lit(3_000_000))},
    {"scorable": "kind IN ('DEL', 'DUP') AND end_pos - start_pos <= 50000 AND start_pos > 524288 AND start_pos + 524288 <= 3000000", "fits": "start_pos > 524288 AND start_pos + 524288 <= 3000000"},
)


@query("p17_plain_contig", "variants", sql="SELECT DISTINCT c, CASE WHEN c = 'chrM' THEN 'MT' WHEN regexp_matches(c, '^chr([0-9]{1,2}|X|Y)$') THEN substr(c, 4) ELSE c END AS out FROM (SELECT 'chr' || chrom AS c FROM variants UNION ALL SELECT chrom FROM variants UNION ALL SELECT 'chrM') AS x")
def p17(t):
    v = t.variants
    names = v.select(F.concat(F.lit("chr"), "chrom").alias("c")).union(v.select("chrom")).union(v.select(F.lit("chrM"))).distinct()
    return names.withColumn("out", alleles.plain_contig(F.col("c")))


MIN = "SELECT DISTINCT pos, ref || CASE WHEN k % 3 = 0 THEN 'TG' ELSE '' END AS ref, alt || CASE WHEN k % 3 = 0 THEN 'CG' WHEN k % 3 = 1 THEN 'A' ELSE '' END AS alt FROM genotypes"


@query("p20_minimal_key", "genotypes", sql=f"""WITH m AS ({MIN}),
f AS (SELECT *, (SELECT max(n) FROM range(0, 9) r(n) WHERE n <= least(length(ref), length(alt)) AND ref[1:n] = alt[1:n]) AS p FROM m),
g AS (SELECT *, substr(ref, p + 1) AS r1, substr(alt, p + 1) AS a1 FROM f),
h AS (SELECT *, (SELECT max(n) FROM range(0, 9) r(n) WHERE n <= least(length(r1), length(a1)) AND right(r1, n) = right(a1, n)) AS s FROM g)
SELECT pos, ref, alt, pos + p AS m_pos, coalesce(nullif(substr(r1, 1, length(r1) - s), ''), '-') AS m_ref, coalesce(nullif(substr(a1, 1, length(a1) - s), ''), '-') AS m_alt FROM h""")
def p20(t):
    from vardelta.derive import spark_ctes

    rows = t.spark.sql(spark_ctes(t.spark, t.sf_dir, "genotypes") + MIN)
    k = alleles.minimal_key(F.col("pos"), F.col("ref"), F.col("alt"))
    return rows.withColumn("k", k).select("pos", "ref", "alt", F.col("k.pos").alias("m_pos"), F.col("k.ref").alias("m_ref"), F.col("k.alt").alias("m_alt"))


@query("p21_pick_consequence", "variants", sql=f"""WITH x AS (SELECT DISTINCT chrom, pos, ref, alt, c FROM (SELECT chrom, pos, ref, alt, consequence AS c FROM variants UNION ALL
  SELECT chrom, pos, ref, alt, CASE WHEN pos % 2 = 0 THEN 'intron_variant' ELSE 'stop_lost' END FROM variants) AS y)
SELECT chrom, pos, ref, alt, c AS consequence FROM x QUALIFY row_number() OVER (PARTITION BY chrom, pos, ref, alt
  ORDER BY coalesce(list_position({q.SEVERITY}, {q.primary("c")}), 13), c) = 1""")
def p21(t):
    from pyspark.sql import Window

    v = t.variants.select("chrom", "pos", "ref", "alt", "consequence")
    more = v.withColumn("consequence", F.when(F.col("pos") % 2 == 0, "intron_variant").otherwise("stop_lost"))
    order = Window.partitionBy("chrom", "pos", "ref", "alt").orderBy(consequences.severity_rank(F.col("consequence")), "consequence")
    return v.union(more).distinct().withColumn("r", F.row_number().over(order)).where("r = 1").drop("r")


INFO = "SELECT DISTINCT ref, alt, 'QD=' || cast(k % 7 as string) || ';FS=' || cast(k % 230 as string) || ';MQ=' || cast(k % 61 as string) || CASE WHEN k % 2 = 0 THEN ';MQRankSum=-' || cast(k % 20 as string) ELSE '' END || ';ReadPosRankSum=-' || cast(k % 25 as string) || ';SOR=' || cast(k % 13 as string) || ';DB' AS info FROM genotypes"


def _num(n: str) -> str:
    return f"try_cast(nullif(regexp_extract(info, '(^|;){n}=([^;]*)', 2), '') AS DOUBLE)"


@query("p22_hard_filter", "genotypes", sql=f"""WITH i AS ({INFO}), s AS (SELECT *, length(ref) = 1 AND length(alt) = 1 AS snp FROM i)
SELECT ref, alt, info, coalesce(nullif(array_to_string(list_filter([CASE WHEN snp AND {_num("QD")} < 2 THEN 'QD2' END, CASE WHEN snp AND {_num("FS")} > 60 THEN 'FS60' END,
  CASE WHEN snp AND {_num("MQ")} < 40 THEN 'MQ40' END, CASE WHEN snp AND {_num("MQRankSum")} < -12.5 THEN 'MQRankSum-12.5' END, CASE WHEN snp AND {_num("ReadPosRankSum")} < -8 THEN 'ReadPosRankSum-8' END,
  CASE WHEN snp AND {_num("SOR")} > 3 THEN 'SOR3' END, CASE WHEN NOT snp AND {_num("QD")} < 2 THEN 'QD2' END, CASE WHEN NOT snp AND {_num("FS")} > 200 THEN 'FS200' END,
  CASE WHEN NOT snp AND {_num("ReadPosRankSum")} < -20 THEN 'ReadPosRankSum-20' END, CASE WHEN NOT snp AND {_num("SOR")} > 10 THEN 'SOR10' END], lambda x: x IS NOT NULL), ';'), ''), 'PASS') AS out FROM s""")
def p22(t):
    from vardelta.derive import spark_ctes

    rows = t.spark.sql(spark_ctes(t.spark, t.sf_dir, "genotypes") + INFO)
    return rows.withColumn("out", alleles.hard_filter(alleles.info_map(F.col("info")), F.col("ref"), F.col("alt")))


@query("t05_contig_order", "variants", sql="SELECT chrom, CASE WHEN chrom = 'X' THEN 23 ELSE CAST(chrom AS INTEGER) END AS place FROM (SELECT DISTINCT chrom FROM variants) AS x")
def t05(t):
    rows = t.variants.select("chrom").distinct().withColumn("place", alleles.contig_order(F.col("chrom")))
    return rows.orderBy("place")


GRID_SIG = "SELECT DISTINCT clinvar_sig AS s FROM variants"
GRID_REV = "SELECT DISTINCT clinvar_revstat AS r FROM variants WHERE clinvar_revstat <> 'practice_guideline'"
GRID_AF = "SELECT * FROM (VALUES (CAST(NULL AS DOUBLE)), (CAST(0.0 AS DOUBLE)), (CAST(0.0005 AS DOUBLE)), (CAST(0.001 AS DOUBLE)), (CAST(0.2 AS DOUBLE))) AS v(a)"
GRID = f"""grid AS (SELECT p.s AS prev_sig, c.s AS curr_sig, x.r AS prev_rev, y.r AS curr_rev, f.a AS prev_af, g.a AS curr_af
  FROM ({GRID_SIG}) AS p, ({GRID_SIG}) AS c, ({GRID_REV}) AS x, ({GRID_REV}) AS y, ({GRID_AF}) AS f, ({GRID_AF}) AS g)"""


@query("c05_change_grid", "variants", sql=f"WITH {GRID} SELECT {q.change_kind()} AS kind, count(*) AS n FROM grid GROUP BY ALL")
def c05_grid(t):
    """Every combination of significance, review status and frequency on both sides."""
    from vardelta.derive import spark_ctes

    rows = t.spark.sql(spark_ctes(t.spark, t.sf_dir, "variants").rstrip() + f",\n{GRID}\nSELECT * FROM grid")
    kind = delta.change_kind(*[F.col(f"{side}_{c}") for c in ("sig", "rev", "af") for side in ("prev", "curr")])
    return rows.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))
