"""Genomic tables derived from the given relational ones.

The given tables hold no genomes, so the queries' inputs are derived from them by integer arithmetic. The
text is written in the SQL that Spark and DuckDB share: Spark runs it as a view of the Parquet files, and
the oracle SQL starts with the same text as common table expressions. Row counts follow the given tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from vardelta.sources.store import scratch

#: Read by several others: DuckDB works these out once.
ONCE = ("calls", "annotated")
GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _pick(index: str, *values: str | None) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {index} {cases} END"


_SIG = _pick(
    "gi", "Pathogenic", "Likely_pathogenic", "Uncertain_significance", "Benign", "Pathogenic/Likely_pathogenic",
    "Conflicting_classifications_of_pathogenicity", "Pathogenic/Pathogenic,_low_penetrance|risk_factor", None,
)
_REV = _pick(
    "ri", "no_assertion_criteria_provided", "criteria_provided,_single_submitter",
    "criteria_provided,_multiple_submitters,_no_conflicts", "reviewed_by_expert_panel", "practice_guideline",
)
_CSQ = _pick(
    "k % 12", "missense_variant", "synonymous_variant", "stop_gained", "frameshift_variant", "splice_donor_variant",
    "missense_variant&splice_region_variant", "intron_variant", "5_prime_UTR_variant", "upstream_gene_variant",
    "splice_region_variant", "inframe_deletion", "regulatory_region_variant",
)
_SIFT = _pick("k % 3", "deleterious(0.01)", "tolerated(0.4)", None)
_POLYPHEN = _pick("k % 5", "probably_damaging(0.99)", "benign(0.01)", "possibly_damaging(0.6)", None, "benign(0.2)")
_DISEASE = _pick("k % 6", "not_provided|Some_disease_A", "Disease_B", "not_specified", None, "A_very_long_name_of_a_hereditary_disease_with_many_more_words_than_fit|x", "See_cases|not_provided")
_SAMPLE = _pick("sidx", "father", "mother", "daughter", "partner", "grandson", "granddaughter")
EIGHTH = "cast(floor(k / 8) as bigint)"
TWENTIETH = "cast(floor(k / 20) as bigint)"

#: Name to SQL; ``{table}`` stands for a given table, other names for other entries.
TABLES = {
    "calls": """
        SELECT cast(l_partkey * 7 + l_orderkey % 7 as bigint) AS k,
          cast((l_suppkey + l_linenumber) % 6 as bigint) AS sidx,
          cast(count(*) as bigint) AS n, cast(sum(l_quantity) as bigint) AS q
        FROM {lineitem} GROUP BY 1, 2""",
    "sites": "SELECT DISTINCT k FROM calls",
    "snapshots": """
        SELECT * FROM (VALUES (0, '2024-01-01', '112', '2023-12-30'), (1, '2024-02-01', '112', '2024-01-27'),
          (2, '2024-03-01', '113', '2024-02-24')) AS t(si, snapshot_id, cache_version, clinvar_date)""",
    "people": """
        SELECT * FROM (VALUES ('father', 'Father', 'male', NULL, NULL, 'mother'),
          ('mother', 'Mother', 'female', NULL, NULL, 'father'), ('daughter', 'Daughter', 'female', 'father', 'mother', 'partner'),
          ('partner', 'Partner', 'male', NULL, NULL, 'daughter'), ('grandson', 'Grandson', 'male', 'partner', 'daughter', NULL),
          ('granddaughter', 'Granddaughter', 'female', 'partner', 'daughter', NULL))
          AS t(id, display_name, sex, father, mother, partner)""",
    "annotated": f"""
        SELECT snapshot_id, si, k, sidx, n, q, {_SAMPLE} AS sample_id,
          CASE WHEN k % 23 = 22 THEN 'X' ELSE cast(k % 23 + 1 as string) END AS chrom, k AS pos,
          {_pick("k % 4", "A", "C", "G", "-")} AS ref, {_pick("k % 4", "G", "T", "-", "AT")} AS alt,
          CASE WHEN k % 41 = 0 THEN NULL WHEN k % 9 = 4 THEN 'G' || cast(1000 + {TWENTIETH} as string)
            ELSE 'G' || cast(k % 60 as string) END AS gene,
          {_CSQ} AS consequence, {_SIG} AS clinvar_sig, {_REV} AS clinvar_revstat,
          cast(k as string) AS clinvar_alleleid, {_DISEASE} AS clinvar_disease,
          CASE WHEN k % 7 = 0 THEN NULL WHEN k % 13 = 0 THEN cast((k + si * 97) % 1000 as double) / cast(100000 as double)
            WHEN k % 10 = 3 THEN cast(k % 1000 as double) / cast(1000 as double)
            ELSE cast(k % 1000 as double) / cast(100000 as double) END AS gnomad_af,
          {_SIFT} AS sift, {_POLYPHEN} AS polyphen, CASE WHEN n >= 2 THEN 'HOM' ELSE 'HET' END AS zygosity
        FROM (SELECT c.*, s.si, s.snapshot_id,
            CASE WHEN k % 5 = 0 THEN (k + si) % 8 ELSE k % 8 END AS gi,
            CASE WHEN k % 11 = 0 THEN ({EIGHTH} + si) % 5 ELSE {EIGHTH} % 5 END AS ri
          FROM calls c CROSS JOIN snapshots s) AS x""",
    "variants": """
        SELECT snapshot_id, sample_id, chrom, pos, ref, alt, gene, consequence, clinvar_sig, clinvar_revstat,
          clinvar_alleleid, clinvar_disease, gnomad_af, sift, polyphen, zygosity FROM annotated""",
    "panel": f"""
        SELECT 'G' || cast(g as string) AS gene, 'D' || cast(g % 14 as string) AS disease, {_pick("g % 14 % 3", "AD", "AR", "XL")} AS inh
        FROM (SELECT DISTINCT k % 60 AS g FROM sites) AS x WHERE g < 45
        UNION ALL
        SELECT 'G' || cast(g as string), 'D20', 'AR' FROM (SELECT DISTINCT k % 60 AS g FROM sites) AS y WHERE g % 9 = 0
        UNION ALL
        SELECT 'G' || cast(1000 + h as string), 'D21', 'AR' FROM (SELECT DISTINCT {TWENTIETH} AS h FROM sites) AS z WHERE h % 3 = 0""",
    "kin": f"""
        SELECT 'p' || cast(c as string) AS id, 'Person ' || cast(c as string) AS display_name,
          {_pick("r", "male", "female", "female", "male", "male", "female")} AS sex,
          CASE WHEN r = 2 THEN 'p' || cast(c - 2 as string) WHEN r > 3 THEN 'p' || cast(c - r + 3 as string) END AS father,
          CASE WHEN r = 2 THEN 'p' || cast(c - 1 as string) WHEN r > 3 THEN 'p' || cast(c - r + 2 as string) END AS mother,
          CASE WHEN r IN (0, 2) THEN 'p' || cast(c + 1 as string) WHEN r IN (1, 3) THEN 'p' || cast(c - 1 as string) END AS partner,
          cast(floor(c / 6) as bigint) AS family, c
        FROM (SELECT cast(c_custkey as bigint) AS c, cast(c_custkey % 6 as bigint) AS r FROM {{customer}}) AS x""",
    "releases": """
        SELECT DISTINCT substr(cast(o_orderdate as string), 1, 10) AS snapshot_id, '1' || substr(cast(o_orderdate as string), 3, 2) AS cache_version
        FROM {orders}""",
    "gene_constraint": """
        SELECT 'G' || cast(g as string) AS gene,
          CASE WHEN g % 5 = 0 THEN NULL ELSE cast(g * 37 % 100 as double) / cast(100 as double) END AS pli,
          CASE WHEN g % 5 < 2 THEN NULL ELSE cast(g * 53 % 120 as double) / cast(100 as double) END AS loeuf
        FROM (SELECT DISTINCT k % 60 AS g FROM sites) AS x WHERE g % 6 > 0""",
    "missense": f"""
        SELECT chrom, pos, ref, alt, t AS transcript, cast((k * 31 + t * 17) % 1000 as bigint) AS score_milli,
          CASE WHEN (k * 31 + t * 17) % 1000 >= 564 THEN 'likely_pathogenic'
            WHEN (k * 31 + t * 17) % 1000 < 340 THEN 'likely_benign' ELSE 'ambiguous' END AS am_class
        FROM (SELECT DISTINCT k, chrom, pos, ref, alt FROM annotated) AS x
          CROSS JOIN (SELECT * FROM (VALUES (0), (1), (2)) AS v(t)) AS y WHERE k % 4 < 2 AND k % 3 > 0""",
    "splice": """
        SELECT DISTINCT chrom, pos, ref, alt, cast(k * 7 % 100 as bigint) AS ag, cast(k * 11 % 60 as bigint) AS al,
          cast(k * 13 % 100 as bigint) AS dg, cast(k * 17 % 40 as bigint) AS dl FROM annotated WHERE k % 3 > 0""",
    "regulatory": """
        SELECT DISTINCT chrom, pos, ref, alt, cast(k * 19 % 500 as bigint) AS delta_centi,
          CASE WHEN k % 2 = 0 THEN NULL ELSE cast(k * 23 % 101 as double) END AS percentile FROM annotated WHERE k % 5 > 0""",
    "genotypes": f"""
        SELECT sample_id, k, n, q, chrom, CASE WHEN k % 4 < 2 THEN pos ELSE pos - 1 END AS pos,
          {_pick("k % 4", "A", "C", "AG", "T")} AS ref, {_pick("k % 4", "G", "T", "A", "TAT")} AS alt,
          CASE WHEN k % 17 = 0 THEN 'LowQual' WHEN k % 19 = 0 THEN '.' ELSE 'PASS' END AS filter,
          CASE WHEN k % 29 = 0 THEN './.' WHEN n >= 2 THEN '1/1' WHEN k % 31 = 0 THEN '0/0' WHEN k % 3 = 0 THEN '0|1' ELSE '0/1' END AS gt,
          CASE WHEN k % 37 = 0 THEN '.,' || cast(q as string) ELSE cast(q % 40 + 3 as string) || ',' || cast((q + k) % 37 + 1 as string) END AS ad,
          cast(q % 70 as bigint) AS dp, cast(k % 99 as bigint) AS gq, cast(floor(k / 100) as bigint) AS ps
        FROM annotated WHERE si = 2""",
    "callsets": """
        SELECT DISTINCT sample_id FROM annotated
        UNION ALL SELECT * FROM (VALUES ('father_vendor'), ('mother_vendor_rerun'), ('fatherly'), ('stranger_x')) AS t(sample_id)""",
    "consent": """
        SELECT * FROM (VALUES ('father', 'cancer', 'yes'), ('father_vendor', 'cancer', 'no'), ('mother_vendor_rerun', 'cancer', 'yes'),
          ('daughter', 'neuro', 'yes'), ('partner', 'cancer', 'no'), ('grandson', 'cancer', 'YES')) AS t(sample_id, category, consent)""",
    "clinvar": f"""
        SELECT si AS release, CASE WHEN k % 23 = 22 THEN 'X' ELSE cast(k % 23 + 1 as string) END AS chrom,
          CASE WHEN k % 4 < 2 THEN k ELSE k - 1 END AS pos, {_pick("k % 4", "A", "C", "AG", "T")} AS ref,
          {_pick("k % 4", "G", "T", "A", "TAT")} AS alt,
          'ALLELEID=' || cast(k as string) || coalesce(';CLNSIG=' || ({_SIG}), '') ||
            CASE WHEN k % 3 = 0 THEN '' ELSE ';CLNREVSTAT=' || ({_REV}) END || ';CLNDN=D' || cast(k % 9 as string) AS info
        FROM (SELECT k, si, CASE WHEN k % 5 = 0 THEN (k + si) % 8 ELSE k % 8 END AS gi, {EIGHTH} % 5 AS ri
          FROM sites CROSS JOIN snapshots) AS x WHERE NOT (k % 43 = 0 AND si = 1) AND NOT (k % 47 = 0 AND si = 0)""",
    "scoring": """
        SELECT 'PGS' || cast(s as string) AS pgs_id, cast(p_partkey % 22 + 1 as string) AS chrom, cast(p_partkey as bigint) AS pos,
          CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'G' END AS effect, CASE WHEN p_partkey % 2 = 0 THEN 'G' ELSE 'A' END AS other,
          cast(p_partkey * 37 % 200 + s - 100 as bigint) AS weight_milli
        FROM {part} CROSS JOIN (SELECT * FROM (VALUES (1), (2), (3)) AS v(s)) AS y WHERE p_partkey % (s + 1) = 0""",
    "cohort": """
        SELECT cast(o_custkey as bigint) AS individual, cast(l_partkey % 22 + 1 as string) AS chrom, cast(l_partkey as bigint) AS pos,
          'A' AS ref, 'G' AS alt, CASE WHEN count(*) > 2 THEN 2 ELSE count(*) END AS dosage
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""",
    "populations": """
        SELECT cast(c_custkey as bigint) AS individual, r_name AS superpopulation FROM {customer}
          JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "frequencies": """
        SELECT cast(p_partkey % 22 + 1 as string) AS chrom, cast(p_partkey as bigint) AS pos, 'A' AS ref, 'G' AS alt,
          cast(p_partkey * 41 % 1000 as bigint) AS af_milli FROM {part} WHERE p_partkey % 10 > 0""",
    "depth": """
        SELECT cast(user_id % 23 + 1 as string) AS chrom, cast(event_id * 40 as bigint) AS start_pos,
          cast(event_id * 40 + 25 + event_id % 30 as bigint) AS end_pos, cast(floor(value) as bigint) AS depth FROM {events}""",
    "gene_regions": """
        SELECT 'G' || cast(p_partkey as string) AS gene, cast(p_partkey % 23 + 1 as string) AS chrom,
          cast(p_partkey * 1500 as bigint) AS start_pos, cast(p_partkey * 1500 + 900 + p_size * 40 as bigint) AS end_pos
        FROM {part}""",
    "svs": """
        SELECT cast(l_orderkey * 8 + l_linenumber as bigint) AS sv_id, cast(l_partkey % 23 + 1 as string) AS chrom,
          cast(l_partkey * 1500 + l_quantity * 30 as bigint) AS start_pos,
          cast(l_partkey * 1500 + l_quantity * 30 + 50 + (l_orderkey % 50) * (l_orderkey % 50) * (l_orderkey % 70) * 20 as bigint) AS end_pos,
          CASE l_suppkey % 5 WHEN 0 THEN 'DEL' WHEN 1 THEN 'DUP' WHEN 2 THEN 'INV' WHEN 3 THEN 'INS' ELSE 'BND' END AS kind,
          CASE WHEN l_orderkey % 9 = 0 THEN 'MinQUAL' WHEN l_orderkey % 9 = 1 THEN '.' ELSE 'PASS' END AS filter,
          CASE l_partkey % 5 WHEN 0 THEN '0|0' WHEN 1 THEN '0/1' WHEN 2 THEN '1/1' WHEN 3 THEN './.' ELSE '1|0' END AS gt
        FROM {lineitem}""",
}


def _needs(name: str, kept: dict[str, str]) -> list[str]:
    """Derived tables that ``name`` reads, itself last; ``kept`` ones need no others."""
    order: list[str] = []

    def visit(one: str) -> None:
        for other in TABLES if one not in kept else ():
            if other != one and other not in order and re.search(rf"\b{other}\b", _reads(one)):
                visit(other)
        if one not in order:
            order.append(one)

    visit(name)
    return order


def _reads(name: str) -> str:
    return " ".join(re.findall(r"(?:FROM|JOIN)\s+\(*(\w+)", TABLES[name]))


#: Tables that Spark derives once per folder and keeps as Parquet, with their columns and partitioning: those that group or join
#: the given rows. ``scanned`` has each call once a snapshot, as a store would; its annotations, and all other tables, follow
#: row by row (or as distinct rows), so they are never written: they are many times as wide.
STORED = {
    "scanned": ("k, n, q, si, snapshot_id, sidx", ["snapshot_id", "sidx"]),
    "cohort": ("individual, chrom, pos, ref, alt, dosage", []),
    "panel": ("gene, disease, inh", []),
    "gene_constraint": ("gene, pli, loeuf", []),
}
#: Any one snapshot has all calls.
FIRST = "2024-01-01"
SCANNED = "FROM calls c CROSS JOIN snapshots s"
_kept: dict[tuple[str, str, str], str] = {}


def ctes(*names: str, paths: str | None = None, kept: dict[str, str] | None = None) -> str:
    """``WITH`` clause that defines the derived tables; ``paths``: folder of the Parquet files (Spark).

    ``kept``: SQL of tables that are read from where they were stored instead.
    """
    order: list[str] = []
    for name in names:
        order += [n for n in _needs(name, kept or {}) if n not in order]
    given = {t: f"parquet.`{paths}/{t}.parquet`" if paths else t for t in GIVEN}
    once = lambda n: "MATERIALIZED " if n in ONCE and not paths else ""
    body = ",\n".join(f"{n} AS {once(n)}({(kept or {}).get(n) or TABLES[n].format(**given)})" for n in order)
    return f"WITH {body}\n"


def stored(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, str]:
    """SQL of what comes from those tables of :data:`STORED` that ``names`` need (all, if none are given); written on first use.

    They go to the folder that driver and executors share.
    """
    found: dict[str, str] = {}
    for name, (columns, by) in STORED.items():
        uses = {"calls", "annotated"} if name == "scanned" else {name}
        if names and not any(uses & set(_needs(n, found)) for n in names):
            continue
        key = (spark.sparkContext.applicationId, sf_dir, name)
        if key not in _kept:
            path = scratch(spark, f"derived-{name}")
            head = ctes(*("calls", "snapshots") if by else (name,), paths=sf_dir, kept=found)
            rows = spark.sql(f"{head}SELECT {columns} {SCANNED if by else f'FROM {name}'}")
            rows.write.partitionBy(*by).option("compression", "zstd").parquet(path)
            _kept[key] = path
        if by:
            found |= _from_scanned(f"parquet.`{_kept[key]}`")
        else:
            found[name] = f"SELECT {columns} FROM parquet.`{_kept[key]}`"
    return found


def _from_scanned(place: str) -> dict[str, str]:
    """The calls and their annotations over the stored table; a filter of snapshot or sample reads its partitions only."""
    typed = f"SELECT k, cast(sidx as bigint) AS sidx, n, q, si, cast(snapshot_id as string) AS snapshot_id FROM {place}"
    calls = f"SELECT k, sidx, n, q FROM ({typed}) AS t WHERE snapshot_id = '{FIRST}'"
    annotated = TABLES["annotated"].replace("c.*, s.si, s.snapshot_id", "c.*").replace(SCANNED, f"FROM ({typed}) AS c")
    each = "CROSS JOIN (SELECT * FROM (VALUES (0), (1), (2)) AS v(t)) AS y"
    missense = TABLES["missense"].replace("FROM annotated", f"FROM ({annotated}) AS a").replace(each, "LATERAL VIEW explode(array(0, 1, 2)) y AS t")
    return {"calls": calls, "annotated": annotated, "missense": missense}


def spark_ctes(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """The ``WITH`` clause for Spark, over the stored tables."""
    return ctes(*names, paths=sf_dir, kept=stored(spark, sf_dir, *names))


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a DataFrame over the given Parquet files."""
    return spark.sql(spark_ctes(spark, sf_dir, name) + f"SELECT * FROM {name}")
