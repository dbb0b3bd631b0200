"""Schemas of the stored tables and the fixed values of the domain."""

from __future__ import annotations

KEY = ["chrom", "pos", "ref", "alt"]

VARIANTS = (
    "snapshot_id string, sample_id string, chrom string, pos long, ref string, alt string, gene string, "
    "consequence string, clinvar_sig string, clinvar_revstat string, clinvar_alleleid string, "
    "clinvar_disease string, gnomad_af double, sift string, polyphen string, zygosity string"
)
ANNOTATED = (
    "uploaded string, location string, allele string, symbol string, consequence string, gnomade string, "
    "gnomadg string, sift string, polyphen string, zyg string, clnsig string, clnrevstat string, clndn string, "
    "alleleid string"
)
CLINVAR = "chrom string, pos string, id string, ref string, alt string, qual string, filter string, info string"
# The companion tables and their columns.
COMPANIONS = {
    "triage_results": (
        "prev_snapshot string, snapshot_id string, sample_id string, chrom string, pos long, ref string, alt string, "
        "gene string, change_kind string, tier string, score double, factors string, stars int"
    ),
    "annotation_provenance": (
        "snapshot_id string, sample_id string, chrom string, pos long, ref string, alt string, source string, version string, "
        "value string, confidence string, used_in_code boolean, as_of string"
    ),
    "variant_history": (
        "snapshot_id string, snapshot_date date, chrom string, pos long, ref string, alt string, gene string, clinvar_sig string, "
        "clinvar_revstat string, gnomad_af double, acmg_tier string, model_band string, model_epoch string"
    ),
    "scan_inputs": "snapshot_id string, sample_id string, vcf_digest string, cache_version string, clinvar_date string",
    "manifests": "snapshot_id string, source string, version string, as_of string",
    "deliveries": "snapshot_id string, sample_id string, delivery string, modified timestamp",
    "validation_runs": (
        "run_id string, replay_snapshot string, truth_snapshot string, n_deltas long, n_useful long, n_noise long, "
        "precision_actionable double"
    ),
    "validation_findings": (
        "run_id string, chrom string, pos long, ref string, alt string, predicted_tier string, outcome string, truth_sig string"
    ),
}

# Terms of a significance that call for action, and that leave it open.
ACTIONABLE_TERMS = ["Likely_pathogenic", "Pathogenic"]
UNCERTAIN_TERMS = ["Uncertain_significance", "Conflicting_classifications_of_pathogenicity", "not_provided"]
ACTIONABLE_PATTERN = "(^|[/|])(Likely_pathogenic|Pathogenic)(,_low_penetrance)?($|[/|])"
LOW_PENETRANCE = ",_low_penetrance"

# Review status to stars (others have none).
REVIEW_STARS = {
    "criteria_provided,_single_submitter": 1,
    "criteria_provided,_conflicting_classifications": 1,
    "criteria_provided,_multiple_submitters,_no_conflicts": 2,
    "reviewed_by_expert_panel": 3,
    "practice_guideline": 4,
}

# Consequence terms, most severe first; the first six abolish the gene's product.
NULL_TERMS = [
    "transcript_ablation", "splice_acceptor_variant", "splice_donor_variant", "stop_gained",
    "frameshift_variant", "start_lost",
]
SEVERITY = [
    *NULL_TERMS, "stop_lost", "inframe_deletion", "inframe_insertion", "missense_variant",
    "protein_altering_variant", "splice_region_variant",
]
MISSENSE_TERMS = ["missense_variant", "protein_altering_variant"]
INSILICO_TERMS = [*MISSENSE_TERMS, "splice_region_variant"]
REGULATORY_TERMS = [
    "regulatory_region_variant", "TF_binding_site_variant", "TFBS_ablation", "TFBS_amplification",
    "5_prime_UTR_variant", "3_prime_UTR_variant", "upstream_gene_variant", "downstream_gene_variant",
    "non_coding_transcript_exon_variant", "mature_miRNA_variant",
]
SHORT_TERMS = ["stop_gained", "frameshift", "splice_acceptor", "splice_donor", "start_lost", "missense"]

# Cut-offs.
RARE_AF, ULTRA_RARE_AF, COMMON_AF = 0.001, 0.0001, 0.01
BA1_AF, BS1_AF, PM2_AF = 0.05, 0.01, 0.0001
LOW_BALANCE = 0.25
MOST_INDEL = 50
SPLICE_HIGH, SPLICE_LIKELY, SPLICE_POSSIBLE = 0.8, 0.5, 0.2
DELTA_MODERATE, DELTA_HIGH, PERCENT_MODERATE, PERCENT_HIGH = 1.0, 3.0, 95.0, 99.0
PLI_CONSTRAINED, LOEUF_CONSTRAINED = 0.9, 0.6
MIN_GQ, MIN_DP, MIN_VAF, MIN_VAF_INDEL, MAX_VAF, DP_FACTOR = 20, 10, 0.40, 0.40, 0.75, 2.5
MIN_PARENT_DP, MAX_PARENT_ALT, PILEUP_MIN_ALT, CLUSTER_WINDOW = 10, 1, 3, 1000
EXPECTED_DE_NOVO = (40, 150)
STABILITY_WINDOW = 5

# Triage in thousandths, so sums and cut-offs are exact.
TRIAGE_WEIGHTS = {"acmg": 350, "model": 200, "freq": 200, "stability": 100, "gene": 150}
TRIAGE_CUTS = {"actionable_now": 600_000, "monitor": 350_000, "log_only": 150_000}
TIERS = ["actionable_now", "monitor", "log_only", "ignore"]
TIER_SCORES = {"Pathogenic": 1000, "Likely pathogenic": 700, "VUS": 300, "Likely benign": 100, "Benign": 0}
DIVERGENCE_BONUS = 300
ACMG_TIERS = ["Pathogenic", "Likely pathogenic", "VUS", "Likely benign", "Benign"]

# Panel status, most severe first, and the chance in percent (low, high) to pass an allele on.
PANEL_STATUS = ["affected", "compound", "at-risk", "carrier"]
PASS_PERCENT = {"carrier": (50, 50), "affected": (100, 100), "compound": (50, 100)}
