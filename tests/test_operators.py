"""Operators on small tables with known answers."""

import statistics

import pytest
from pyspark.sql import functions as F

from vardelta import schemas as S
from vardelta.operators import delta, domains, family, genotypes, incremental, panel, pedigree, polygenic
from vardelta.schemas import KEY

ALL = [c.split()[0] for c in S.VARIANTS.split(", ")]


def variants(spark, rows):
    blank = dict.fromkeys(ALL)
    return spark.createDataFrame([tuple((blank | {"chrom": "1", "ref": "A", "alt": "G", "zygosity": "HET", "snapshot_id": "s1"} | r)[c] for c in ALL) for r in rows], S.VARIANTS)


def keys(df):
    return sorted((r.chrom, r.pos, r.ref, r.alt) for r in df.collect())


def test_recessive_and_de_novo(spark):
    v = variants(spark, [
        {"sample_id": "c", "pos": 1, "zygosity": "HOM"}, {"sample_id": "f", "pos": 1}, {"sample_id": "m", "pos": 1},
        {"sample_id": "c", "pos": 2}, {"sample_id": "c", "pos": 3}, {"sample_id": "f", "pos": 3}, {"sample_id": "c", "pos": 4, "zygosity": "HOM"}, {"sample_id": "f", "pos": 4, "zygosity": "HOM"}, {"sample_id": "m", "pos": 4},
    ])
    assert [k[1] for k in keys(family.recessive(v, "c", "f", "m"))] == [1]
    assert [k[1] for k in keys(family.de_novo_candidates(v, "c", "f", "m"))] == [2]


def test_delta_treats_nulls_as_values(spark):
    v = variants(spark, [
        {"sample_id": "a", "pos": 1, "snapshot_id": "s1", "clinvar_sig": "Benign"}, {"sample_id": "a", "pos": 1, "snapshot_id": "s2", "clinvar_sig": "Pathogenic"},
        {"sample_id": "a", "pos": 2, "snapshot_id": "s1"}, {"sample_id": "a", "pos": 2, "snapshot_id": "s2"},
        {"sample_id": "a", "pos": 3, "snapshot_id": "s1", "gene": "G"}, {"sample_id": "a", "pos": 3, "snapshot_id": "s2", "gene": "H", "clinvar_sig": "Benign"},
        {"sample_id": "b", "pos": 1, "snapshot_id": "s2", "clinvar_sig": "Pathogenic"},
    ])
    rows = delta.with_change(delta.snapshot_delta(v, "s1", "s2"))
    assert sorted((r.pos, r.change_kind) for r in rows.collect()) == [(1, "upgraded"), (3, "reclassified")]
    bumped = delta.snapshot_delta(v, "s1", "s2", bump=True)
    assert sorted(r.pos for r in bumped.collect()) == [1, 3]
    assert [r.sample_id for r in delta.new_samples(v, "s1", "s2").collect()] == ["b"]


@pytest.mark.parametrize("trail,want", [(["Benign", "Uncertain_significance", "Pathogenic"], 500), (["Benign", "Pathogenic", "Benign", "Pathogenic"], -500), (["Benign"], 0), (["Pathogenic", "Benign"], 0), ([None, None], 0)])
def test_stability(spark, trail, want):
    rows = [(f"s{i}", "1", 5, "A", "G", sig) for i, sig in enumerate(trail)]
    history = spark.createDataFrame(rows, "snapshot_id string, chrom string, pos long, ref string, alt string, clinvar_sig string")
    assert [r.stability for r in delta.stability(history, "s9").collect()] == [want]


def test_panel_status_and_risk(spark):
    v = variants(spark, [{"clinvar_sig": "Pathogenic"} | r for r in [
        {"sample_id": "a", "gene": "R", "pos": 1}, {"sample_id": "a", "gene": "R", "pos": 2}, {"sample_id": "b", "gene": "R", "pos": 1},
        {"sample_id": "b", "gene": "D", "pos": 3}, {"sample_id": "a", "gene": "X", "pos": 4}, {"sample_id": "b", "gene": "X", "pos": 4}, {"sample_id": "c", "gene": "R", "pos": 1, "zygosity": "HOM"},
    ]])
    rules = spark.createDataFrame([("R", "r", "AR"), ("D", "d", "AD"), ("X", "x", "XL")], "gene string, disease string, inh string")
    sexes = spark.createDataFrame([("a", "female"), ("b", "male"), ("c", None)], "sample_id string, sex string")
    rows = panel.gene_status(v, rules, sexes)
    assert sorted((r.sample_id, r.gene, r.status) for r in rows.collect()) == [
        ("a", "R", "compound"), ("a", "X", "carrier"), ("b", "D", "at-risk"), ("b", "R", "carrier"), ("b", "X", "affected"), ("c", "R", "affected")
    ]
    risk = panel.family_risk(panel.ar_index(rows)).collect()
    assert [(r.gene, r.n_pairs, r.low_percent, r.high_percent) for r in risk] == [("R", 3, 25, 100)]


CLINVAR = "chrom string, pos long, ref string, alt string, clinvar_sig string, clinvar_revstat string, clinvar_disease string, clinvar_alleleid string"


def test_clinvar_delta_reaches_indels(spark):
    def release(*rows):
        return spark.createDataFrame([(*r, "", "", "1") for r in rows], CLINVAR)

    old = release(("4", 512, "G", "A", "VUS"), ("8", 90, "TCC", "T", "VUS"), ("11", 77, "C", "A", "Benign"), ("12", 5, "A", "T", "VUS"))
    new = release(("4", 512, "G", "A", "Pathogenic"), ("8", 90, "TCC", "T", "Likely_pathogenic"), ("13", 6060, "T", "G", "Pathogenic"), ("12", 5, "A", "T", "VUS"))
    changes = incremental.clinvar_changes(old, new)
    assert keys(changes) == [("11", 77, "C", "A"), ("13", 6060, "T", "G"), ("4", 512, "G", "A"), ("8", 90, "TCC", "T")]
    carried = [("4", 512, "G", "A"), ("4", 512, "G", "C"), ("13", 6060, "T", "G"), ("8", 91, "CC", "-"), ("12", 5, "A", "T"), ("20", 3, "T", "C")]
    v = variants(spark, [{"sample_id": "one"} | dict(zip(KEY, k, strict=True)) for k in carried])
    got = incremental.carried_changed(v, changes)
    assert keys(got) == [("13", 6060, "T", "G"), ("4", 512, "G", "A"), ("8", 91, "CC", "-")]
    assert sorted((r.chrom, r.pos) for r in incremental.site_lookups(got).collect()) == [("13", 6060), ("4", 512), ("8", 90), ("8", 91)]


def test_incremental_equals_full(spark):
    from vardelta.streaming.jobs import keyed_like_variants

    before = [("1", 10, "A", "G", "VUS"), ("2", 20, "CA", "C", "Benign"), ("4", 7, "T", "G", "VUS")]
    after = [("1", 10, "A", "G", "Pathogenic"), ("2", 20, "CA", "C", "Pathogenic"), ("9", 1, "A", "C", "VUS")]
    stored = [("1", 10, "A", "G"), ("2", 21, "A", "-"), ("4", 7, "T", "G"), ("5", 5, "G", "C"), ("9", 1, "A", "C")]

    def annotate(snapshot, release):
        records = keyed_like_variants(spark.createDataFrame([(*r, "", "", "1") for r in release], CLINVAR))
        calls = variants(spark, [{"sample_id": s, "snapshot_id": snapshot} | dict(zip(KEY, k, strict=True)) for k in stored for s in "ab"])
        return calls.drop(*incremental.RECORD).join(records, KEY, "left").select(*ALL), records

    old, _ = annotate("s1", before)
    full, records = annotate("s2", after)
    releases = [spark.createDataFrame([(*r, "", "", "1") for r in rel], CLINVAR) for rel in (before, after)]
    quick = incremental.reannotate_delta(old, "s1", "s2", incremental.clinvar_changes(*releases), records)
    assert sorted(map(str, quick.select(*ALL).collect())) == sorted(map(str, full.collect()))
    with pytest.raises(ValueError):
        incremental.copy_forward(old, "s2", "s1")


PEOPLE = [("gf", "male", None, None, "gm"), ("gm", "female", None, None, None), ("dad", "male", "gf", "gm", "mom"), ("mom", "female", None, None, None), ("aunt", "female", "gf", "gm", "uncle"), ("uncle", "male", None, None, None), ("kid", "male", "dad", "mom", None), ("cous", "female", "uncle", "aunt", None), ("solo", None, None, None, None)]


def test_kinship_and_generations(spark):
    people = spark.createDataFrame(PEOPLE, "id string, sex string, father string, mother string, partner string")
    terms = {(r.ego, r.other): r.term for r in pedigree.kinship(people.withColumn('family', F.lit(1))).collect()}
    assert len(terms) == 81
    want = {("kid", "dad"): "father", ("dad", "kid"): "son", ("dad", "mom"): "partner", ("mom", "dad"): "partner", ("dad", "aunt"): "sister", ("kid", "gm"): "grandmother", ("gf", "cous"): "granddaughter", ("mom", "gf"): "father-in-law", ("mom", "aunt"): "sister-in-law", ("gf", "mom"): "daughter-in-law", ("aunt", "mom"): "sister-in-law", ("kid", "aunt"): "aunt", ("aunt", "kid"): "nephew", ("kid", "cous"): "cousin", ("kid", "solo"): "relative", ("kid", "kid"): "self", ("kid", "uncle"): "relative"}
    assert {k: terms[k] for k in want} == want
    assert {r.id: r.generation for r in pedigree.generations(people).collect()} == {"gf": 0, "gm": 0, "dad": 1, "mom": 1, "aunt": 1, "uncle": 1, "kid": 2, "cous": 2, "solo": 0}


def test_callsets_and_consent(spark):
    people = spark.createDataFrame([("pia",), ("lo_u",)], "id string")
    callsets = spark.createDataFrame([("pia",), ("pia_second",), ("piano",), ("lo_u_x_y",), ("lo_u",)], "sample_id string")
    persons = pedigree.callset_to_person(callsets, people)
    assert {r.sample_id: r.person for r in persons.collect()} == {"pia": "pia", "pia_second": "pia", "piano": "piano", "lo_u_x_y": "lo_u", "lo_u": "lo_u"}
    consent = spark.createDataFrame([("pia_second", "x", "yes"), ("pia", "x", "no"), ("lo_u_x_y", "x", "yes")], "sample_id string, category string, consent string")
    assert {(r.person, r.granted) for r in pedigree.resolved_consent(consent, persons).collect()} == {("pia", False), ("lo_u", True)}


def test_phase_verdicts(spark):
    g = spark.createDataFrame([
        ("1", 100, "A", "G", "0|1", "7"), ("1", 200, "C", "T", "1|0", "7"), ("2", 100, "A", "G", "0|1", "8"), ("2", 200, "CA", "C", "0|1", "8"),
        ("3", 100, "A", "G", "0|1", "9"), ("3", 200, "A", "G", "0/1", None), ("4", 100, "A", "G", "0|1", "5"), ("4", 100, "A", "T", "1|0", "5"),
    ], "chrom string, pos long, ref string, alt string, gt string, ps string")
    hets = spark.createDataFrame([("T", "1", 100), ("T", "1", 200), ("C", "2", 100), ("C", "2", 201), ("U", "3", 100), ("U", "3", 200), ("M", "4", 100), ("M", "4", 300)], "gene string, chrom string, pos long")
    got = {r.gene: (r.verdict, r.n_ambiguous) for r in genotypes.phase_verdict(hets, genotypes.phased_positions(g)).collect()}
    assert got == {"T": ("in-trans", 0), "C": ("in-cis", 0), "U": ("unphased", 0), "M": ("unphased", 1)}


def test_de_novo_evidence_and_clusters(spark):
    cands = spark.createDataFrame([("1", 100, "A", "G"), ("1", 900, "A", "G"), ("1", 5000, "A", "G"), ("2", 1, "A", "G")], "chrom string, pos long, ref string, alt string")
    evidence = spark.createDataFrame(
        [(c, p, who, "0/0", 30, 0, None) for c, p in (("1", 100), ("1", 900), ("2", 1)) for who in ("f", "m")] + [("1", 5000, "f", "0/1", 30, 9, None), ("1", 5000, "m", "./.", 30, 0, None)],
        "chrom string, pos long, parent string, gt string, dp int, alt_reads int, nonref int",
    )
    status = genotypes.flag_clusters(genotypes.de_novo_status(cands, evidence, ["f", "m"]))
    assert {(r.chrom, r.pos): r.status for r in status.collect()} == {("1", 100): "clustered", ("1", 900): "clustered", ("1", 5000): "inherited", ("2", 1): "confirmed"}


def test_percentile_counts_strictly_below(spark):
    cohort = spark.createDataFrame([("p", i, s) for i, s in enumerate([1, 2, 3, 3, 4, 5])], "pgs_id string, individual long, score_milli long")
    pops = spark.createDataFrame([(i, "E" if i < 4 else "O") for i in range(6)], "individual long, superpopulation string")
    mine = spark.createDataFrame([("p", "s", 3)], "pgs_id string, sample_id string, score_milli long")
    r = polygenic.empirical_percentile(mine, cohort, pops, "E").first()
    assert float(r.matched_percent) == 50.0 and abs(float(r.overall_percent) - 100 / 3) < 1e-9


def test_normal_percentile(spark):
    got = [r[0] for r in spark.createDataFrame([(0.0,), (1.96,), (None,)], "z double").select(polygenic.normal_percentile(F.col("z"))).collect()]
    assert got[0] == 50 and abs(got[1] - 97.5) < 0.01 and got[2] is None


def test_calibration_against_plain_sums(spark):
    """Percentiles of a few genomes from moments worked out one by one, the reference where there is no record."""
    markers = [("p", "1", k, "A" if k % 2 else "G", 37 * k % 90 - 40) for k in range(1, 30)] + [("q", "1", 3, "T", 5)]
    af = {k: 31 * k % 1000 for k in range(1, 30) if k % 7}
    scoring = spark.createDataFrame(markers, "pgs_id string, chrom string, pos long, effect string, weight_milli long")
    frequencies = spark.createDataFrame([("1", k, "A", "G", f) for k, f in af.items()], "chrom string, pos long, ref string, alt string, af_milli long")
    calls = [(s, "1", k, "A", "G", ("0/1", "1/1", "./.")[(k + i) % 3]) for i, s in enumerate("xy") for k in range(1, 30, 2 + i)]
    source = spark.createDataFrame(calls, "sample_id string, chrom string, pos long, ref string, alt string, gt string")
    base = spark.createDataFrame([("1", k, "A") for k in range(1, 30)], "chrom string, pos long, base string")
    people = spark.createDataFrame([("x",), ("y",), ("z",)], "sample_id string")
    got = polygenic.prs_calibrate(polygenic.moments_from_calls(scoring, [source], base, people, frequencies)).collect()
    pair = {(s, k): {"0/1": "AG", "1/1": "GG", "./.": None}[g] for s, _, k, _, _, g in calls}
    for r in got:
        raw = mean = variance = n = 0
        for _, _, k, effect, w in (m for m in markers if m[0] == r.pgs_id):
            alleles = pair.get((r.sample_id, k), "AA")
            if k not in af or alleles is None or effect not in "AG":
                continue
            f = af[k] / 1000 if effect == "G" else 1 - af[k] / 1000
            raw, mean, variance, n = raw + w * alleles.count(effect), mean + 2 * f * w, variance + 2 * f * (1 - f) * w * w, n + 1
        assert n == r.n and abs(r.percentile - 100 * statistics.NormalDist(mean, variance**0.5).cdf(raw)) < 1e-6
    assert {(r.pgs_id, r.sample_id) for r in got} == {("p", s) for s in "xyz"}


def test_hla_calls(spark):
    rows = [("a", ["B*27:05:02"], ["DQA1*05:05"], ["DQB1*02:01:01"]), ("b", ["B*27:06"], None, ["DQB1*03:02"]), ("c", None, None, None)]
    typed = spark.createDataFrame(rows, "sample_id string, b array<string>, dqa1 array<string>, dqb1 array<string>")
    assert [(r.b27, r.celiac) for r in domains.hla_risk(typed).orderBy("sample_id").collect()] == [("present", "DQ2.5"), ("non-associated", "DQ8"), ("absent", "neither")]
