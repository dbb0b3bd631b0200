"""Queries of the delta between snapshots, triage, classification, history and validation."""

from pyspark.sql import functions as F

from vardelta.derive import spark_ctes
from vardelta.functions.consequences import primary_consequence
from vardelta.operators import classify, delta, history
from vardelta.plans import findings, validation
from vardelta.queries import sqltext as q
from vardelta.queries._base import CURR, LATER, PREV, query
from vardelta.schemas import KEY
from vardelta.sources import published, store

D = q.delta(PREV, CURR)
DV = ["variants", "panel", "missense", "splice", "regulatory", "gene_constraint"]
V = f"v AS (SELECT * FROM variants WHERE snapshot_id = '{CURR}')"


@query("j10_common_samples", "variants", sql=f"""
SELECT sample_id FROM variants WHERE snapshot_id = '{CURR}' INTERSECT SELECT sample_id FROM variants WHERE snapshot_id = '{PREV}'""")
def j10(t):
    return delta.common_samples(t.variants, PREV, CURR)


NEWER = "(snapshot_id <> '2024-01-01' OR sample_id <> 'partner')"


@query("j10_new_samples", "variants", sql=f"""WITH w AS (SELECT * FROM variants WHERE {NEWER})
SELECT DISTINCT sample_id FROM w WHERE snapshot_id = '{CURR}' AND sample_id NOT IN (SELECT sample_id FROM w WHERE snapshot_id = '{PREV}')""")
def j10_new(t):
    return delta.new_samples(t.variants.where(NEWER), PREV, CURR)


COLUMNS = "sample_id, gene, chrom, pos, ref, alt, prev_sig, curr_sig, prev_rev, curr_rev, prev_af, curr_af, zygosity"


def named(rows):
    short = {"clinvar_sig": "sig", "clinvar_revstat": "rev", "gnomad_af": "af"}
    for c, s in short.items():
        for side in ("prev", "curr"):
            rows = rows.withColumnRenamed(f"{side}_{c}", f"{side}_{s}")
    return rows


@query("j05_snapshot_delta", "variants", sql=f"WITH {D} SELECT {COLUMNS} FROM delta")
def j05(t):
    return named(delta.snapshot_delta(t.variants, PREV, CURR)).select(*COLUMNS.split(", "))


@query("j06_version_bump", "variants", "snapshots", sql=f"""WITH {q.delta(CURR, LATER, bump=True)}
SELECT {COLUMNS}, change_kind FROM changed WHERE change_kind <> 'af_shift'""")
def j06(t):
    rows, _ = findings.changed(t.variants, t.snapshots, CURR, LATER)
    return named(rows).select(*COLUMNS.split(", "), "change_kind")


@query("c05_change_kind", "variants", sql=f"WITH {D} SELECT {COLUMNS}, change_kind FROM changed")
def c05(t):
    return named(delta.with_change(delta.snapshot_delta(t.variants, PREV, CURR))).select(*COLUMNS.split(", "), "change_kind")


EVAL = q.evaluated("src")
CODED = "sample_id, gene, chrom, pos, ref, alt, array_to_string(codes, ';') AS codes, acmg_tier, divergence, scope"


@query("c04_acmg", *DV, sql=f"""WITH {V}, {q.MODELS}, src AS (SELECT * FROM v WHERE gene IN (SELECT gene FROM panel)),
done AS ({EVAL}) SELECT {CODED} FROM done WHERE scope <> 'none'""")
def c04(t):
    rows = classify.order_acmg(classify.acmg(t.at(CURR), t.panel, t.missense, t.splice, t.gene_constraint))
    return rows.select("sample_id", "gene", *KEY, F.array_join("codes", ";").alias("codes"), "acmg_tier", "divergence", "scope")


NO_MODELS = q.MODELS.replace("FROM missense)", "FROM missense WHERE false)").replace("FROM splice)", "FROM splice WHERE false)").replace("FROM gene_constraint)", "FROM gene_constraint WHERE false)")


@query("q03_absent_sources", *DV, sql=f"""WITH {V}, {NO_MODELS}, src AS (SELECT * FROM v WHERE gene IN (SELECT gene FROM panel)),
done AS ({EVAL}) SELECT {CODED} FROM done WHERE scope <> 'none'""")
def q03(t):
    """Without model and constraint tables their columns are null and the rules go on with what there is."""
    rows = classify.acmg(t.at(CURR), t.panel, None, None, None)
    return rows.select("sample_id", "gene", *KEY, F.array_join("codes", ";").alias("codes"), "acmg_tier", "divergence", "scope")


@query("c01_acmg_codes", *DV, sql=f"""WITH {V}, {q.MODELS}, src AS (SELECT * FROM v WHERE gene IN (SELECT gene FROM panel)),
done AS ({EVAL}) SELECT array_to_string(codes, ';') AS codes, csq, count(*) AS n FROM done WHERE scope = 'call' GROUP BY ALL""")
def c01(t):
    rows = classify.acmg(t.at(CURR), t.panel, t.missense, t.splice, t.gene_constraint).where("scope = 'call'")
    return rows.groupBy(F.array_join("codes", ";").alias("codes"), primary_consequence(F.col("consequence")).alias("csq")).agg(F.count("*").alias("n"))


@query("c02_acmg_tier", *DV, sql=f"""WITH {V}, {q.MODELS}, src AS (SELECT * FROM v WHERE gene IN (SELECT gene FROM panel)),
done AS ({EVAL}) SELECT DISTINCT array_to_string(codes, ';') AS codes, acmg_tier FROM done WHERE scope = 'call'""")
def c02(t):
    rows = classify.acmg(t.at(CURR), t.panel, t.missense, t.splice, t.gene_constraint).where("scope = 'call'")
    return rows.select(F.array_join("codes", ";").alias("codes"), "acmg_tier").distinct()


@query("c03_divergence", *DV, sql=f"""WITH {V}, {q.MODELS}, src AS (SELECT * FROM v WHERE gene IN (SELECT gene FROM panel)),
done AS ({EVAL}) SELECT acmg_tier, clinvar_sig, divergence, count(*) AS n FROM done WHERE scope = 'call' GROUP BY ALL""")
def c03(t):
    rows = classify.acmg(t.at(CURR), t.panel, t.missense, t.splice, t.gene_constraint).where("scope = 'call'")
    return rows.groupBy("acmg_tier", "clinvar_sig", "divergence").agg(F.count("*").alias("n"))


@query("a24_acmg_summary", *DV, sql=f"""WITH {V}, {q.MODELS}, src AS (SELECT * FROM v WHERE gene IN (SELECT gene FROM panel)),
done AS ({EVAL}) SELECT sample_id, count(*) FILTER (scope = 'deferred') AS deferred, count(*) FILTER (divergence <> '') AS divergent,
  count(*) FILTER (acmg_tier = 'Pathogenic') AS pathogenic, count(*) FILTER (acmg_tier = 'Likely pathogenic') AS likely_pathogenic,
  count(*) FILTER (acmg_tier = 'VUS') AS vus, count(*) FILTER (acmg_tier = 'Likely benign') AS likely_benign,
  count(*) FILTER (acmg_tier = 'Benign') AS benign FROM done WHERE scope <> 'none' GROUP BY sample_id""")
def a24(t):
    return classify.acmg_summary(classify.acmg(t.at(CURR), t.panel, t.missense, t.splice, t.gene_constraint))


@query("s11_best_missense", "missense", sql=f"WITH {q.MODELS.split('sa AS')[0].rstrip().rstrip(',')} SELECT * FROM am")
def s11(t):
    return classify.best_missense(t.missense)


@query("s10_best_splice", "splice", sql="""
SELECT chrom, pos, ref, alt, greatest(ag, al, dg, dl) AS splice_centi,
  CASE greatest(ag, al, dg, dl) WHEN ag THEN 'AG' WHEN al THEN 'AL' WHEN dg THEN 'DG' ELSE 'DL' END AS splice_effect FROM splice""")
def s10(t):
    return classify.best_splice(t.splice)


@query("j13_attach_model_scores", *DV, sql=f"""WITH {V}, {q.MODELS}
SELECT v.sample_id, v.chrom, v.pos, v.ref, v.alt, am_milli, am_class, splice_centi, splice_effect, reg_band FROM v
LEFT JOIN am ON {q.on("v", "am")} AND list_has_any({q.csq_terms("consequence")}, ['missense_variant', 'protein_altering_variant'])
LEFT JOIN sa ON {q.on("v", "sa")} AND consequence LIKE '%splice%' LEFT JOIN rg ON {q.on("v", "rg")} AND {q.noncoding("consequence")}""")
def j13(t):
    rows = classify.attach_model_scores(t.at(CURR), t.missense, t.splice, t.regulatory)
    return rows.select("sample_id", *KEY, "am_milli", "am_class", "splice_centi", "splice_effect", "reg_band")


@query("j14_attach_constraint", "variants", "gene_constraint", "panel", sql=f"""WITH {V}, {q.MODELS.split("genes AS")[1].join(["genes AS", ""])}
SELECT sample_id, chrom, pos, ref, alt, constrained, g.gene IS NOT NULL AS in_panel, coalesce(dominant, false) AS dominant
FROM v LEFT JOIN cons ON v.gene = cons.gene LEFT JOIN genes g ON v.gene = g.gene""")
def j14(t):
    rows = classify.attach_genes(classify.attach_constraint(t.at(CURR), t.gene_constraint), t.panel)
    return rows.select("sample_id", *KEY, "constrained", "in_panel", "dominant")


HISTORY = f"""relevant AS (SELECT snapshot_id, chrom, pos, ref, alt, coalesce(max(CASE WHEN on_panel THEN gene END), min(gene)) AS gene,
    min(consequence) AS consequence, min(clinvar_sig) AS clinvar_sig, min(clinvar_revstat) AS clinvar_revstat, min(gnomad_af) AS gnomad_af,
    min(sift) AS sift, min(polyphen) AS polyphen
  FROM (SELECT *, gene IN (SELECT gene FROM panel) AS on_panel FROM variants) WHERE clinvar_sig IS NOT NULL OR on_panel
  GROUP BY snapshot_id, chrom, pos, ref, alt),
judged AS ({q.evaluated("relevant", regulatory=True)}),
hist AS (SELECT snapshot_id, chrom, pos, ref, alt, gene, clinvar_sig, clinvar_revstat, CASE WHEN in_panel THEN acmg_tier END AS acmg_tier,
  reg_band AS model_band, gnomad_af, substr(snapshot_id, 1, 10) AS snapshot_date FROM judged)"""


def the_history(t):
    return history.history(t.variants, t.panel, t.missense, t.splice, t.regulatory, t.gene_constraint)


def dated(rows):
    """The date as text, which every engine compares alike."""
    return rows.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


@query("a02_relevant_variants", "variants", "panel", sql=f"WITH {HISTORY.split('judged AS')[0].rstrip().rstrip(',')} SELECT * FROM relevant")
def a02(t):
    return history.relevant_variants(t.variants, t.panel)


@query("c10_history", *DV, sql=f"WITH {q.MODELS}, {HISTORY} SELECT * FROM hist WHERE snapshot_id = '{CURR}'")
def c10(t):
    return dated(history.history(t.at(CURR), t.panel, t.missense, t.splice, t.regulatory, t.gene_constraint))


@query("c11_backfill_history", *DV, sql=f"WITH {q.MODELS}, {HISTORY} SELECT * FROM hist")
def c11(t):
    return dated(the_history(t))


def _said(source: str, value: str, conf: str, used: str, when: str = "true") -> str:
    return f"""SELECT snapshot_id, chrom, pos, ref, alt, '{source}' AS source, {value} AS value, {conf} AS confidence,
      coalesce({used}, false) AS used_in_code FROM j WHERE {when} AND {value} IS NOT NULL"""


CALLED = "coalesce(scope = 'call', false)"
USED = lambda *c: f"list_has_any(codes, {list(c)})"


#: Versions of the sources, by the day from which they hold: one source a day of the given orders.
SOURCES = ["clinvar", "consequence", "gnomad_af", "missense", "splice", "constraint"]
VERSIONS = f"""versions AS (SELECT source, source || ' of ' || snapshot_id AS version, CASE WHEN cast(substr(snapshot_id, 4, 1) as int) % 2 = 0 THEN '2023' ELSE '2024' END || substr(snapshot_id, 5, 6) AS since
  FROM (SELECT snapshot_id, CASE (cast(substr(snapshot_id, 9, 2) as int) * 5 + cast(substr(snapshot_id, 6, 2) as int)) % 7 {" ".join(f"WHEN {k} THEN '{s}'" for k, s in enumerate(SOURCES))} END AS source FROM releases) AS x WHERE source IS NOT NULL)"""


def versions(t):
    return t.spark.sql(spark_ctes(t.spark, t.sf_dir, "releases").rstrip() + f",\n{VERSIONS}\nSELECT * FROM versions")


@query("c09_provenance", *DV, "releases", sql=f"""WITH {q.MODELS}, {HISTORY}, {VERSIONS}, j AS (SELECT * REPLACE (CASE WHEN in_panel THEN scope END AS scope, CASE WHEN in_panel THEN codes END AS codes) FROM judged WHERE snapshot_id = '{CURR}'),
said AS ({_said("clinvar", "clinvar_sig", f"CASE WHEN ({q.stars('clinvar_revstat')}) >= 3 THEN 'High' WHEN ({q.stars('clinvar_revstat')}) = 2 THEN 'Medium' WHEN ({q.stars('clinvar_revstat')}) = 1 THEN 'Low' ELSE 'Very Low' END", "false")}
UNION ALL {_said("consequence", "consequence", "'High'", USED("PVS1", "PVS1_moderate"))}
UNION ALL {_said("gnomad_af", "CAST(CAST(gnomad_af AS DECIMAL(9,6)) AS VARCHAR)", "'High'", USED("BA1", "BS1", "PM2"))}
UNION ALL {_said("missense", "am_class", "'Medium'", USED("PP3", "BP4"), CALLED)}
UNION ALL {_said("splice", "splice_effect", "'Medium'", USED("PP3", "BP4"), CALLED)}
UNION ALL {_said("regulatory", "reg_band", "'Low'", "false", CALLED)}
UNION ALL {_said("constraint", "CAST(constrained AS VARCHAR)", "'Medium'", USED("PVS1", "PVS1_moderate"), CALLED)}),
force AS (SELECT source, arg_max(version, since || version) AS version, max(since) AS as_of FROM versions WHERE since <= '{CURR}' GROUP BY source)
SELECT said.*, CAST(NULL AS VARCHAR) AS sample_id, version, as_of FROM said LEFT JOIN force USING (source)""")
def c09(t):
    return history.provenance(t.at(CURR), t.panel, t.missense, t.splice, t.regulatory, t.gene_constraint, versions(t))


@query("s20_pinned_versions", "releases", "snapshots", sql=f"""WITH {VERSIONS}
SELECT s.snapshot_id, v.source, arg_max(v.version, v.since || v.version) AS version, max(v.since) AS as_of FROM snapshots s JOIN versions v ON v.since <= s.snapshot_id GROUP BY ALL""")
def s20_pinned(t):
    """Two snapshots are pinned with the versions of their time; a third follows when later versions are known too."""
    root, every = store.scratch(t.spark, "manifests"), versions(t)
    history.pin_versions(every.where(f"since <= '{CURR}'"), t.snapshots.where(f"snapshot_id <= '{CURR}'"), root)
    altered = every.withColumn("version", F.when(F.col("since") <= PREV, F.concat("version", F.lit(" (renamed)"))).otherwise(F.col("version")))
    history.pin_versions(altered, t.snapshots.where(f"snapshot_id <= '{CURR}'"), root)
    history.pin_versions(every, t.snapshots, root)
    return store.read_companion(t.spark, root, "manifests")


STABLE = f"""lv AS (SELECT {q.KEYS}, snapshot_id, {q.ordinal("clinvar_sig")} AS lev FROM hist WHERE snapshot_id <= '{LATER}'),
st AS (SELECT {q.KEYS}, snapshot_id, lev - lag(lev) OVER (PARTITION BY {q.KEYS} ORDER BY snapshot_id) AS d FROM lv),
ch AS (SELECT *, sign(d) <> sign(lag(d) OVER (PARTITION BY {q.KEYS} ORDER BY snapshot_id)) AS turn FROM st WHERE d <> 0),
stab AS (SELECT l.chrom, l.pos, l.ref, l.alt, CASE WHEN coalesce(t.turns, 0) >= 2 THEN -500 WHEN t.low > 0 THEN 500 ELSE 0 END AS stability
  FROM (SELECT DISTINCT {q.KEYS} FROM lv) l LEFT JOIN (SELECT {q.KEYS}, count(*) FILTER (turn) AS turns, min(d) AS low FROM ch GROUP BY ALL) t ON {q.on("l", "t")})"""


@query("w01_stability", *DV, sql=f"WITH {q.MODELS}, {HISTORY}, {STABLE} SELECT * FROM stab")
def w01(t):
    return delta.stability(trails(t), LATER)


@query("j11_model_band_changes", *DV, sql=f"""WITH {q.MODELS}, {HISTORY},
e AS (SELECT *, CASE WHEN pos % 6 = 0 THEN NULL WHEN pos % 2 = 0 THEN 'e' || snapshot_id ELSE 'e' END AS ep,
  CASE WHEN pos % 3 = 1 AND snapshot_id = '{CURR}' THEN 'none' ELSE coalesce(model_band, 'low') END AS band FROM hist)
SELECT p.chrom, p.pos, p.ref, p.alt, p.band AS prev_model_band, c.band AS curr_model_band FROM e p JOIN e c ON {q.on("p", "c")}
WHERE p.snapshot_id = '{PREV}' AND c.snapshot_id = '{CURR}' AND p.ep <> c.ep AND p.band <> c.band""")
def j11(t):
    h = the_history(t)
    h = h.withColumn("model_epoch", F.expr("CASE WHEN pos % 6 = 0 THEN NULL WHEN pos % 2 = 0 THEN 'e' || snapshot_id ELSE 'e' END"))
    h = h.withColumn("model_band", F.expr(f"CASE WHEN pos % 3 = 1 AND snapshot_id = '{CURR}' THEN 'none' ELSE coalesce(model_band, 'low') END"))
    return delta.model_band_changes(h, PREV, CURR).select(*KEY, "prev_model_band", "curr_model_band")


def scored(prev: str, curr: str) -> str:
    """``scored``: the whole delta job in SQL."""
    src = """src AS (SELECT *, curr_sig AS clinvar_sig, curr_af AS gnomad_af FROM changed)"""
    ev = f"CASE WHEN {q.act('curr_sig')} THEN least(1000, 500 + 125 * ({q.stars('curr_rev')})) ELSE 0 END"
    tier = "CASE acmg_tier WHEN 'Pathogenic' THEN 1000 WHEN 'Likely pathogenic' THEN 700 WHEN 'VUS' THEN 300 WHEN 'Likely benign' THEN 100 WHEN 'Benign' THEN 0 END"
    stab = STABLE.replace(f"<= '{LATER}'", f"<= '{curr}'")
    return f"""{q.delta(prev, curr)}, {q.MODELS}, {HISTORY}, {stab}, {src},
ev AS ({q.evaluated("src", regulatory=True)}),
fac AS (SELECT e.*, greatest({ev}, coalesce({tier}, 0)) + CASE WHEN acmg_tier IS NOT NULL AND divergence <> '' THEN 300 ELSE 0 END AS f_acmg,
  greatest(least(1000, (coalesce(am_milli, 0) - 500) * 2), least(1000, (coalesce(splice_centi, 0) - 50) * 20),
    CASE reg_band WHEN 'high' THEN 1000 WHEN 'moderate' THEN 500 WHEN 'low' THEN 100 ELSE 0 END) AS f_model,
  CASE WHEN curr_af IS NULL OR curr_af < 0.0001 THEN 1000 WHEN curr_af < 0.001 THEN 600 WHEN curr_af >= 0.01 THEN -1000 ELSE 0 END AS f_freq,
  coalesce(s.stability, 0) AS f_stability,
  CASE WHEN in_panel THEN 700 ELSE 0 END + CASE WHEN scope <> 'none' AND list_contains({q.SEVERITY}[1:6], csq) AND coalesce(constrained, false) THEN 300 ELSE 0 END AS f_gene
  FROM ev e LEFT JOIN stab s ON {q.on("s", "e")}),
sc AS (SELECT *, CAST(350 * f_acmg + 200 * f_model + 200 * f_freq + 100 * f_stability + 150 * f_gene AS BIGINT) AS score_micro FROM fac),
scored AS (SELECT *, CASE WHEN score_micro >= 600000 AND (in_panel OR {q.act("curr_sig")}) THEN 'actionable_now' WHEN score_micro >= 350000 THEN 'monitor'
  WHEN score_micro >= 150000 THEN 'log_only' ELSE 'ignore' END AS tier,
  CASE greatest(abs(f_acmg), abs(f_model), abs(f_freq), abs(f_stability), abs(f_gene)) WHEN abs(f_acmg) THEN 'acmg' WHEN abs(f_model) THEN 'model'
    WHEN abs(f_freq) THEN 'freq' WHEN abs(f_stability) THEN 'stability' ELSE 'gene' END AS top_factor, {q.stars("curr_rev")} AS stars FROM sc)"""


OUT = "sample_id, gene, chrom, pos, ref, alt, change_kind, tier, score_micro, top_factor, stars"


def trails(t):
    """What the delta needs of the history: the significance of each relevant variant in each snapshot."""
    return history.relevant_variants(t.variants, t.panel)


def the_delta(t, prev=PREV, curr=CURR):
    return findings.delta(
        t.variants, t.snapshots, prev, curr, t.panel, t.missense, t.splice, t.regulatory, t.gene_constraint,
        lambda v: history.relevant_variants(v, t.panel),
    )


@query("c08_delta", *DV, sql=f"WITH {scored(PREV, CURR)} SELECT {OUT} FROM scored")
def c08(t):
    return delta.order_delta(the_delta(t)).select(*OUT.split(", "))


@query("c06_triage_factors", *DV, sql=f"""WITH {scored(PREV, CURR)}
SELECT sample_id, chrom, pos, ref, alt, CAST(f_acmg AS BIGINT) AS f_acmg, CAST(f_model AS BIGINT) AS f_model, CAST(f_freq AS BIGINT) AS f_freq,
  CAST(f_stability AS BIGINT) AS f_stability, CAST(f_gene AS BIGINT) AS f_gene FROM scored""")
def c06(t):
    return the_delta(t).select("sample_id", *KEY, "f_acmg", "f_model", "f_freq", "f_stability", "f_gene")


@query("c07_triage_score", *DV, sql=f"WITH {scored(PREV, CURR)} SELECT tier, top_factor, count(*) AS n, max(score_micro) AS best FROM scored GROUP BY ALL")
def c07(t):
    return the_delta(t).groupBy("tier", "top_factor").agg(F.count("*").alias("n"), F.max("score_micro").alias("best"))


@query("a23_delta_summary", *DV, sql=f"""WITH {scored(PREV, CURR)}
SELECT tier, sample_id, count(*) AS n, count(DISTINCT (chrom, pos, ref, alt)) AS n_variants, max(score_micro) AS best FROM scored GROUP BY ALL""")
def a23(t):
    return delta.delta_summary(the_delta(t))


TRUTH = f"""truth AS (SELECT chrom, pos, ref, alt, min(clinvar_sig) AS truth_sig FROM variants WHERE snapshot_id = '{LATER}' AND pos % 50 > 0 GROUP BY ALL),
jud AS (SELECT s.*, t.truth_sig, t.chrom IS NOT NULL AS present, {q.ordinal("curr_sig")} AS r, {q.ordinal("truth_sig")} AS tr
  FROM scored s LEFT JOIN truth t ON {q.on("s", "t")}),
outc AS (SELECT *, CASE WHEN NOT present THEN 'unknown' WHEN change_kind IN ('new_pathogenic', 'upgraded') THEN CASE WHEN tr >= 1 THEN 'confirmed' ELSE 'reverted' END
  WHEN change_kind = 'downgraded' THEN CASE WHEN tr <= 0 THEN 'confirmed' ELSE 'reverted' END
  WHEN tr > r THEN 'confirmed' WHEN tr < r THEN 'reverted' ELSE 'stable_noise' END AS outcome FROM jud)"""


def judged(t):
    known = t.variants.where("pos % 50 > 0")
    return history.outcome(history.truth_join(the_delta(t), known, LATER))


@query("j25_truth_join", *DV, sql=f"WITH {scored(PREV, CURR)}, {TRUTH} SELECT sample_id, chrom, pos, ref, alt, truth_sig, present FROM jud")
def j25(t):
    return judged(t).select("sample_id", *KEY, "truth_sig", "present")


@query("c12_validate", *DV, sql=f"WITH {scored(PREV, CURR)}, {TRUTH} SELECT sample_id, chrom, pos, ref, alt, tier, change_kind, outcome FROM outc")
def c12(t):
    return judged(t).select("sample_id", *KEY, "tier", "change_kind", "outcome")


@query("a22_validation_summary", *DV, sql=f"""WITH {scored(PREV, CURR)}, {TRUTH}
SELECT count(*) AS n_deltas, count(*) FILTER (outcome = 'confirmed') AS useful, count(*) FILTER (outcome IN ('reverted', 'stable_noise')) AS noise,
  CAST(count(*) FILTER (tier = 'actionable_now' AND outcome = 'confirmed') AS DOUBLE) /
    nullif(count(*) FILTER (tier = 'actionable_now' AND outcome IN ('confirmed', 'reverted')), 0) AS precision FROM outc""")
def a22(t):
    return history.validation_summary(judged(t))


@query("a22_outcome_matrix", *DV, sql=f"""WITH {scored(PREV, CURR)}, {TRUTH}
SELECT tier, count(*) FILTER (outcome = 'confirmed') AS confirmed, count(*) FILTER (outcome = 'reverted') AS reverted,
  count(*) FILTER (outcome = 'stable_noise') AS stable_noise, count(*) FILTER (outcome = 'unknown') AS unknown FROM outc GROUP BY tier""")
def a22_matrix(t):
    return history.outcome_matrix(judged(t))


PUBLISHED = f"""{TRUTH}, r AS (SELECT '{CURR}_vs_{LATER}' AS run_id, count(*) AS n, count(*) FILTER (outcome = 'confirmed') AS useful FROM outc)
SELECT 'triage_results' AS table_name, run_id, n, useful FROM r UNION ALL SELECT 'validation_findings', run_id, n, useful FROM r
UNION ALL SELECT 'validation_runs', run_id, n, useful FROM r"""


@query("s22_published_results", *DV, sql=f"WITH {scored(PREV, CURR)}, {PUBLISHED}")
def s22_published(t):
    """A run is published with half of its findings and then again with all; another breaks at its last table and is not seen."""
    root = store.scratch(t.spark, "results")
    found, known = store.written(the_delta(t), "findings"), t.variants.where("pos % 50 > 0")
    for rows in (found.where("pos % 2 = 0"), found):
        validation.validate(t.spark, root, rows, known, PREV, CURR, LATER)

    def breaks():
        raise RuntimeError("the summary could not be made")

    one = published.read_published(t.spark, root, "validation_findings").withColumn("run_id", F.lit("broken"))
    try:
        published.publish(t.spark, root, "broken", {"validation_findings": lambda: one, "validation_runs": breaks})
    except RuntimeError:
        pass
    read = lambda name: published.read_published(t.spark, root, name)
    useful = F.count_if(F.col("outcome") == "confirmed").alias("useful")
    findings_ = read("validation_findings").groupBy("run_id").agg(F.count("*").alias("n"), useful)
    triage = read("triage_results").agg(F.count("*").alias("n")).join(F.broadcast(findings_.select("run_id", "useful")))  # one row each
    parts = [triage.select(F.lit("triage_results").alias("table_name"), "run_id", "n", "useful"), findings_.select(F.lit("validation_findings"), "run_id", "n", "useful"),
             read("validation_runs").select(F.lit("validation_runs"), "run_id", F.col("n_deltas"), F.col("n_useful"))]
    return parts[0].union(parts[1]).union(parts[2])


DISEASE = """CASE WHEN coalesce(clinvar_disease, '') = '' THEN '—' ELSE
  (SELECT CASE WHEN length(nm) > 55 THEN substr(nm, 1, 55) || '…' ELSE nm END FROM (SELECT replace(coalesce(
    list_filter(string_split(clinvar_disease, '|'), lambda p: lower(trim(p)) NOT IN ('not_provided', 'not_specified', 'see_cases', ''))[1],
    string_split(clinvar_disease, '|')[1]), '_', ' ') AS nm)) END"""
RARITY = "CASE WHEN gnomad_af IS NULL THEN 'novel' WHEN gnomad_af < 0.001 THEN 'rare' ELSE 'common' END"


TRIM_READS = """reads AS (SELECT sample_id, chrom, CASE WHEN cut THEN pos + 1 ELSE pos END AS pos, CASE WHEN cut THEN coalesce(nullif(substr(ref, 2), ''), '-') ELSE ref END AS ref,
    CASE WHEN cut THEN coalesce(nullif(substr(alt, 2), ''), '-') ELSE alt END AS alt, counts[2] AS alt_reads, list_sum(counts) AS total_reads
  FROM (SELECT *, length(ref) <> length(alt) AND ref[1] = alt[1] AS cut, list_transform(string_split(ad, ','), lambda x: CASE WHEN x = '.' THEN 0 ELSE CAST(x AS INT) END) AS counts FROM genotypes))"""


@query("c13_full_findings", *DV, "genotypes", sql=f"""WITH {q.MODELS}, {TRIM_READS}
SELECT v.sample_id, v.chrom, v.pos, v.ref, v.alt, v.gene, clinvar_sig, {q.stars("clinvar_revstat")} AS stars, {RARITY} AS rarity, {DISEASE} AS disease,
  r.alt_reads, CAST(r.total_reads AS INTEGER) AS total_reads, coalesce(zygosity = 'HET' AND r.alt_reads::DOUBLE / r.total_reads < 0.25, false) AS low_balance,
  am_milli, am_class, CASE WHEN splice_centi >= 20 THEN splice_centi END AS splice_centi, CASE WHEN splice_centi >= 20 THEN splice_effect END AS splice_effect
FROM variants v LEFT JOIN reads r ON r.sample_id = v.sample_id AND {q.on("r", "v")} AND r.total_reads > 0 LEFT JOIN am ON {q.on("am", "v")} LEFT JOIN sa ON {q.on("sa", "v")}
WHERE snapshot_id = '{CURR}' AND {q.act("clinvar_sig")}""")
def c13(t):
    rows = findings.order_full(findings.full_findings(t.at(CURR), t.genotypes, t.missense, t.splice))
    return rows.select(
        "sample_id", *KEY, "gene", "clinvar_sig", "stars", "rarity", "disease", "alt_reads", "total_reads", "low_balance",
        "am_milli", "am_class", "splice_centi", "splice_effect",
    )


@query("a37_full_counts", "variants", sql=f"""
SELECT sample_id, count(*) AS actionable, count(*) FILTER (({q.stars("clinvar_revstat")}) >= 1) AS reviewed,
  count(*) FILTER (({q.stars("clinvar_revstat")}) = 0) AS unreviewed FROM variants WHERE snapshot_id = '{CURR}' AND {q.act("clinvar_sig")} GROUP BY ALL""")
def a37(t):
    return findings.full_counts(findings.full_findings(t.at(CURR)))

