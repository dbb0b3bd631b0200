"""Column expressions against expected values."""

import pytest
from pyspark.sql import functions as F

from vardelta.functions import alleles, bands, consequences, significance


def values(spark, rows, schema, build):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(build(*[F.col(c) for c in df.columns]).alias("out")).collect()]


COMPOUND = "Pathogenic/Pathogenic,_low_penetrance|risk_factor"


@pytest.mark.parametrize(
    "build,cases",
    [
        (significance.is_actionable, [("Pathogenic", True), (COMPOUND, True), ("Likely_pathogenic,_low_penetrance", True), ("Conflicting_classifications_of_pathogenicity", False), ("Benign", False), (None, False), ("", False), ("not_Pathogenic", False)]),
        (significance.is_uncertain, [(None, True), ("", True), ("Uncertain_significance|risk_factor", True), ("Pathogenic|not_provided", False), ("Benign", False)]),
        (significance.sig_rank, [("Pathogenic", 0), ("Pathogenic/Pathogenic", 0), (COMPOUND, 1), ("Likely_pathogenic", 2), (None, 2)]),
        (significance.sig_cell, [(COMPOUND, "Pathogenic/Pathogenic,_low_penetrance; risk_factor ⚠️ low penetrance (some submitters)"), ("Benign", "Benign"), (None, "")]),
        (significance.path_ordinal, [("Benign/Likely_benign", -1), ("Pathogenic", 1), ("Conflicting_classifications_of_pathogenicity", 0), (None, 0)]),
        (significance.clinvar_class, [("Conflicting_interpretations_of_pathogenicity", "conflicting"), ("Likely_pathogenic", "path"), ("Likely_benign", "benign"), ("VUS", "vus"), ("-", "absent"), (None, "absent"), ("drug_response", "other")]),
        (significance.review_stars, [("practice guideline", 4), ("criteria_provided,_single_submitter", 1), ("odd", 0), (None, 0)]),
        (significance.disease_name, [("not_provided|Some_disease", "Some disease"), ("not_specified", "not specified"), (None, "—"), ("", "—"), ("x" * 60, "x" * 55 + "…")]),
        (consequences.primary_consequence, [("missense_variant&splice_region_variant", "missense_variant"), ("intron_variant,stop_gained", "stop_gained"), ("odd", "odd"), (None, "")]),
        (consequences.short_consequence, [("frameshift_variant", "frameshift"), ("intron_variant,x", "intron_variant"), (None, "")]),
        (alleles.plain_contig, [("chr7", "7"), ("chrX", "X"), ("chrM", "MT"), ("MT", "MT"), ("chrUn_1", "chrUn_1")]),
        (alleles.vaf, [("10,30", 0.75), (".,5", 1.0), ("0,0", 0.0), ("7", 0.0)]),
        (alleles.is_male, [("Male", True), ("m", True), ("1", True), ("female", False), (None, False)]),
        (bands.splice_band, [(0.8, "high"), (0.5, "likely"), (0.2, "possible"), (0.1, "low"), (None, None)]),
    ],
)
def test_one_argument(spark, build, cases):
    kind = "double" if isinstance(cases[0][0], float) else "string"
    assert values(spark, [(c,) for c, _ in cases], f"x {kind}", build) == [want for _, want in cases]


def test_sig_flags(spark):
    got = values(spark, [(COMPOUND,), ("Pathogenic,_low_penetrance",), ("Benign|drug_response",), (None,)], "x string", significance.sig_flags)
    assert got == [["low penetrance (some submitters)", "risk factor"], ["low penetrance"], ["Benign", "drug response"], []]


def test_keys(spark):
    cases = [(800, "GA", "G", (801, "A", "-")), (100, "G", "GA", (101, "-", "A")), (5, "C", "T", (5, "C", "T")), (9, "AT", "GC", (9, "AT", "GC"))]
    assert [tuple(k) for k in values(spark, [c[:3] for c in cases], "p long, r string, a string", alleles.trimmed_key)] == [c[3] for c in cases]
    cases = [(10, "ATG", "ACG", (11, "T", "C")), (10, "AAA", "AA", (12, "A", "-")), (10, "-", "T", (10, "-", "T")), (10, "GTC", "GC", (11, "T", "-")), (3, "A", "A", (4, "-", "-"))]
    assert [tuple(k) for k in values(spark, [c[:3] for c in cases], "p long, r string, a string", alleles.minimal_key)] == [c[3] for c in cases]


def test_genotypes(spark):
    cases = [("A", "G", "0/1", ["A", "G"]), ("A", "G,T", "1|2", ["G", "T"]), ("A", "G", "./.", None), ("A", "G", "1/.", None), ("A", "G", "1", ["G", "G"]), ("A", "G", "0/7", None), ("A", "G", None, None)]
    assert values(spark, [c[:3] for c in cases], "r string, a string, g string", alleles.decode_genotype) == [c[3] for c in cases]


def test_reject_reasons(spark):
    cases = [
        (30, 50, 0.5, 100.0, "A", "G", None), (30, 10, 0.5, 100.0, "A", "G", "low_gq"), (5, 50, 0.5, 100.0, "A", "G", "low_depth"),
        (300, 50, 0.5, 100.0, "A", "G", "excess_depth"), (300, 50, 0.5, 0.0, "A", "G", None), (30, 50, 0.5, 100.0, "CT", "C", "homopolymer_indel"),
        (30, 50, 0.3, 100.0, "CTA", "C", "low_vaf_indel"), (30, 50, 0.3, 100.0, "A", "G", "low_vaf"), (30, 50, 0.9, 100.0, "A", "G", "high_vaf"),
    ]
    got = values(spark, [c[:6] for c in cases], "d int, g int, v double, m double, r string, a string", alleles.reject_reason)
    assert got == [c[6] for c in cases]


def test_constraint_is_three_valued(spark):
    cases = [(0.95, None, True), (0.1, 0.5, True), (0.1, 0.9, False), (None, None, None), (None, 0.9, False)]
    assert values(spark, [c[:2] for c in cases], "p double, l double", bands.is_constrained) == [c[2] for c in cases]


def test_hard_filter(spark):
    rows = [("QD=1;FS=70;DB", "A", "G"), ("QD=1;FS=70", "AT", "A"), ("QD=9", "A", "G"), (None, "A", "G")]
    got = values(spark, rows, "i string, r string, a string", lambda i, r, a: alleles.hard_filter(alleles.info_map(i), r, a))
    assert got == ["QD2;FS60", "QD2", "PASS", "PASS"]
