"""SQL (DuckDB) of the column expressions, for the oracles."""

from vardelta.schemas import ACTIONABLE_PATTERN as ACT


def act(c: str) -> str:
    return f"regexp_matches(coalesce({c}, ''), '{ACT}')"


def terms(c: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({c}, ''), '[/|]'), lambda t: t <> '')"


def uncertain(c: str) -> str:
    names = "['Uncertain_significance', 'Conflicting_classifications_of_pathogenicity', 'not_provided']"
    return f"(NOT {act(c)} AND (len({terms(c)}) = 0 OR list_has_any({terms(c)}, {names})))"


def stars(c: str) -> str:
    return (
        f"CASE replace(coalesce({c}, ''), ' ', '_') WHEN 'criteria_provided,_single_submitter' THEN 1 "
        "WHEN 'criteria_provided,_conflicting_classifications' THEN 1 "
        "WHEN 'criteria_provided,_multiple_submitters,_no_conflicts' THEN 2 "
        "WHEN 'reviewed_by_expert_panel' THEN 3 WHEN 'practice_guideline' THEN 4 ELSE 0 END"
    )


def ordinal(c: str) -> str:
    return (
        f"CASE WHEN lower(coalesce({c}, '')) LIKE '%benign%' THEN -1 WHEN lower(coalesce({c}, '')) LIKE '%pathogenic%' "
        f"AND lower(coalesce({c}, '')) NOT LIKE '%conflict%' THEN 1 ELSE 0 END"
    )


def clinvar_class(c: str) -> str:
    s = f"lower(coalesce({c}, ''))"
    return (
        f"CASE WHEN {s} LIKE '%conflict%' THEN 'conflicting' WHEN {s} LIKE '%pathogenic%' THEN 'path' "
        f"WHEN {s} LIKE '%benign%' THEN 'benign' WHEN {s} LIKE '%uncertain%' OR {s} LIKE '%vus%' THEN 'vus' "
        f"WHEN {s} IN ('', '-') THEN 'absent' ELSE 'other' END"
    )


def damaging(csq: str = "consequence", sift: str = "sift", polyphen: str = "polyphen") -> str:
    return (
        f"coalesce(regexp_matches({csq}, 'stop_gained|frameshift|splice_acceptor|splice_donor|start_lost') OR "
        f"({csq} LIKE '%missense%' AND ({sift} LIKE 'deleterious%' OR {polyphen} LIKE 'probably_damaging%')), false)"
    )


SEVERITY = (
    "['transcript_ablation','splice_acceptor_variant','splice_donor_variant','stop_gained','frameshift_variant',"
    "'start_lost','stop_lost','inframe_deletion','inframe_insertion','missense_variant',"
    "'protein_altering_variant','splice_region_variant']"
)


def csq_terms(c: str) -> str:
    return f"regexp_split_to_array(coalesce({c}, ''), '[&,]')"


def primary(c: str) -> str:
    t = csq_terms(c)
    return f"coalesce(list_filter({SEVERITY}, lambda s: list_contains({t}, s))[1], {t}[1])"


def noncoding(c: str) -> str:
    names = (
        "['regulatory_region_variant','TF_binding_site_variant','TFBS_ablation','TFBS_amplification',"
        "'5_prime_UTR_variant','3_prime_UTR_variant','upstream_gene_variant','downstream_gene_variant',"
        "'non_coding_transcript_exon_variant','mature_miRNA_variant']"
    )
    return f"list_has_any({csq_terms(c)}, {names})"


def change_kind() -> str:
    return f"""CASE WHEN {act("curr_sig")} AND NOT {act("prev_sig")} THEN
        CASE WHEN {uncertain("prev_sig")} THEN 'new_pathogenic' ELSE 'upgraded' END
      WHEN {act("prev_sig")} AND NOT {act("curr_sig")} THEN 'downgraded'
      WHEN coalesce(prev_sig, '') <> coalesce(curr_sig, '') THEN 'reclassified'
      WHEN {act("curr_sig")} AND ({stars("curr_rev")}) > ({stars("prev_rev")}) THEN 'reclassified'
      WHEN (prev_af < 0.001) <> (curr_af < 0.001) THEN 'af_shift' END"""


KEYS = "chrom, pos, ref, alt"


def on(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in ("chrom", "pos", "ref", "alt"))


#: From variants at :prev and :curr: ``delta`` (all differing rows) and ``changed`` (with change_kind).
def delta(prev: str, curr: str, bump: bool = False) -> str:
    """Both snapshots in one pass, a group for each sample and key (and gene); ``in_p``, ``in_c``: rows of either."""
    gene = "coalesce(max(gene) FILTER (now), max(gene))" if bump else "gene"
    sides = ", ".join(
        f"max({c}) FILTER ({'now' if s == 'curr' else 'NOT now'}) AS {s}_{n}"
        for c, n in (("clinvar_sig", "sig"), ("clinvar_revstat", "rev"), ("gnomad_af", "af")) for s in ("prev", "curr")
    )
    kept = ", ".join(f"max({c}) FILTER (now) AS {c}" for c in ("zygosity", "clinvar_disease", "consequence", "sift", "polyphen"))
    return f"""
both_ AS (SELECT sample_id FROM variants WHERE snapshot_id IN ('{prev}', '{curr}') GROUP BY sample_id HAVING count(DISTINCT snapshot_id) = 2),
delta AS MATERIALIZED (SELECT * FROM (
    SELECT sample_id, {gene} AS gene, chrom, pos, ref, alt, {sides}, {kept}, bool_or(now) AS in_c, bool_or(NOT now) AS in_p
    FROM (SELECT *, snapshot_id = '{curr}' AS now FROM variants WHERE snapshot_id IN ('{prev}', '{curr}') AND sample_id IN (SELECT sample_id FROM both_))
    GROUP BY sample_id, chrom, pos, ref, alt{"" if bump else ", gene"})
  WHERE (prev_sig, prev_rev, prev_af) IS DISTINCT FROM (curr_sig, curr_rev, curr_af)),
changed AS (SELECT * FROM (SELECT *, {change_kind()} AS change_kind FROM delta) WHERE change_kind IS NOT NULL)"""


#: Model scores, one row a key.
MODELS = f"""
am AS (SELECT {KEYS}, score_milli AS am_milli, am_class FROM (
  SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY score_milli DESC, transcript) AS rn FROM missense) WHERE rn = 1),
sa AS (SELECT {KEYS}, greatest(ag, al, dg, dl) AS splice_centi,
  CASE greatest(ag, al, dg, dl) WHEN ag THEN 'AG' WHEN al THEN 'AL' WHEN dg THEN 'DG' ELSE 'DL' END AS splice_effect FROM splice),
rg AS (SELECT {KEYS}, CASE WHEN percentile IS NOT NULL THEN CASE WHEN percentile >= 99 THEN 'high' WHEN percentile >= 95 THEN 'moderate' ELSE 'low' END
  WHEN abs(delta_centi) >= 300 THEN 'high' WHEN abs(delta_centi) >= 100 THEN 'moderate' ELSE 'low' END AS reg_band FROM regulatory),
genes AS (SELECT gene, bool_or(inh IN ('AD', 'XL')) AS dominant FROM panel GROUP BY gene),
cons AS (SELECT gene, CASE WHEN pli IS NULL AND loeuf IS NULL THEN NULL
  ELSE coalesce(pli >= 0.9, false) OR coalesce(loeuf < 0.6, false) END AS constrained FROM gene_constraint)"""


def evaluated(source: str, regulatory: bool = False, extra: str = "") -> str:
    """A SELECT that evaluates all rows of ``source`` (with gene, key, consequence, clinvar_sig, gnomad_af, sift, polyphen)."""
    p = primary("consequence")
    miss = f"list_has_any({csq_terms('consequence')}, ['missense_variant', 'protein_altering_variant'])"
    joined = f"""SELECT v.*, am.am_milli, am.am_class, sa.splice_centi, sa.splice_effect, rg.reg_band, g.gene IS NOT NULL AS in_panel,
      coalesce(g.dominant, false) AS dominant, cons.constrained, {p} AS csq,
      CASE WHEN NOT list_contains({SEVERITY}, {p}) THEN 'none'
        WHEN abs((CASE WHEN v.alt = '-' THEN 0 ELSE length(v.alt) END) - (CASE WHEN v.ref = '-' THEN 0 ELSE length(v.ref) END)) > 50 THEN 'deferred'
        ELSE 'call' END AS scope
    FROM {source} v LEFT JOIN genes g ON v.gene = g.gene LEFT JOIN cons ON v.gene = cons.gene
      LEFT JOIN am ON {on("v", "am")} AND {miss}
      LEFT JOIN sa ON {on("v", "sa")} AND coalesce(consequence, '') LIKE '%splice%'
      LEFT JOIN rg ON {on("v", "rg")} AND {noncoding("consequence")} AND {str(regulatory).lower()}"""
    s = lambda c, x: f"coalesce({c} LIKE '{x}%', false)"
    harmful = f"(coalesce(splice_centi >= 50, false) OR coalesce(am_class = 'likely_pathogenic', false) OR ({s('sift', 'deleterious')} AND {s('polyphen', 'probably_damaging')}))"
    harmless = (
        "(NOT coalesce(splice_centi >= 50, false) AND (coalesce(am_class = 'likely_benign', false) OR "
        "(coalesce(splice_centi < 20, false) AND am_milli IS NULL AND coalesce(sift, '') = '' AND coalesce(polyphen, '') = '') "
        f"OR ({s('sift', 'tolerated')} AND {s('polyphen', 'benign')})))"
    )
    coded = f"""SELECT *, CASE WHEN scope = 'call' THEN list_filter([
        CASE WHEN gnomad_af > 0.05 THEN 'BA1' WHEN gnomad_af > 0.01 THEN 'BS1' END,
        CASE WHEN gnomad_af IS NULL OR gnomad_af < 0.0001 THEN 'PM2' END,
        CASE WHEN list_contains({SEVERITY}[1:6], csq) AND in_panel THEN CASE WHEN dominant AND constrained = false THEN 'PVS1_moderate' ELSE 'PVS1' END END,
        CASE WHEN csq IN ('missense_variant', 'protein_altering_variant', 'splice_region_variant') AND {harmful} THEN 'PP3'
          WHEN csq IN ('missense_variant', 'protein_altering_variant', 'splice_region_variant') AND {harmless} THEN 'BP4' END],
        lambda x: x IS NOT NULL) END AS codes FROM ({joined})"""
    has = lambda c: f"list_contains(codes, '{c}')"
    sup = f"({has('PM2')}::INT + {has('PP3')}::INT)"
    ben = f"({has('BS1')}::INT + {has('BP4')}::INT)"
    tiered = f"""SELECT *, CASE WHEN scope <> 'call' THEN NULL WHEN {has("BA1")} THEN 'Benign'
        WHEN ({has("PVS1")} OR {has("PVS1_moderate")}) AND {ben} > 0 THEN 'VUS'
        WHEN {has("PVS1")} THEN CASE WHEN {sup} >= 2 THEN 'Pathogenic' ELSE 'Likely pathogenic' END
        WHEN {has("PVS1_moderate")} THEN CASE WHEN {sup} >= 1 THEN 'Likely pathogenic' ELSE 'VUS' END
        WHEN {sup} > 0 AND {ben} > 0 THEN 'VUS' WHEN {ben} >= 2 THEN 'Likely benign' ELSE 'VUS' END AS acmg_tier FROM ({coded})"""
    k = clinvar_class("clinvar_sig")
    path, benign = "acmg_tier IN ('Pathogenic', 'Likely pathogenic')", "acmg_tier IN ('Benign', 'Likely benign')"
    return f"""SELECT *, CASE WHEN scope <> 'call' THEN NULL WHEN {path} AND ({k}) = 'benign' THEN 'contradicts_benign'
        WHEN {benign} AND ({k}) = 'path' THEN 'weaker' WHEN {path} AND ({k}) = 'conflicting' THEN 'resolves_to_pathogenic'
        WHEN {benign} AND ({k}) = 'conflicting' THEN 'resolves_to_benign'
        WHEN {path} AND ({k}) IN ('vus', 'absent') THEN 'stronger' ELSE '' END AS divergence {extra} FROM ({tiered})"""
