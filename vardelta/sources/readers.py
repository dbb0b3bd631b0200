"""Readers. Each has a shape function over a DataFrame of raw columns and a thin reader of files.

Schemas are always given. A gzip file is one task for Spark's own readers; large ones are better block-compressed, which
the readers by blocks cut into several.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vardelta import schemas as S
from vardelta.functions.alleles import info_map
from vardelta.sources import blocks


def dash(c: str) -> Column:
    """A dash stands for no value."""
    return F.nullif(F.col(c), F.lit("-"))


def first_number(c: str) -> Column:
    """The first of several frequencies joined by ``&``."""
    return F.split_part(dash(c), F.lit("&"), F.lit(1)).try_cast("double")


def shape_annotated(raw: DataFrame, *extra: str) -> DataFrame:
    """Rows of an annotated table: ``uploaded`` is ``chrom_pos_ref/alt``; the frequency is the greater of two.

    Columns named in ``extra`` are carried along.
    """
    up = F.col("uploaded")
    alleles = F.split_part(up, F.lit("_"), F.lit(3))
    return raw.select(
        F.split_part(up, F.lit("_"), F.lit(1)).alias("chrom"),
        F.split_part(up, F.lit("_"), F.lit(2)).try_cast("long").alias("pos"),
        F.split_part(alleles, F.lit("/"), F.lit(1)).alias("ref"),
        F.split_part(alleles, F.lit("/"), F.lit(2)).alias("alt"),
        dash("symbol").alias("gene"), dash("consequence").alias("consequence"), dash("clnsig").alias("clinvar_sig"),
        dash("clnrevstat").alias("clinvar_revstat"), dash("alleleid").alias("clinvar_alleleid"),
        dash("clndn").alias("clinvar_disease"), F.greatest(first_number("gnomade"), first_number("gnomadg")).alias("gnomad_af"),
        dash("sift").alias("sift"), dash("polyphen").alias("polyphen"), F.upper(dash("zyg")).alias("zygosity"), "uploaded",
        *extra,
    )


def read_annotated(spark: SparkSession, path: str, guard: bool = True) -> DataFrame:
    """An annotated table (tab-separated, no header, ``#`` comments, may be compressed)."""
    raw = spark.read.schema(S.ANNOTATED).csv(path, sep="\t", comment="#", quote="")
    rows = shape_annotated(raw)
    if guard:
        guard_parsed(rows)
    return rows.where("pos is not null").drop("uploaded")


def read_annotated_blocks(spark: SparkSession, path: str, guard: bool = True, size: int = blocks.RANGE) -> DataFrame:
    """:func:`read_annotated` of block-compressed files, which several tasks read together."""
    lines = blocks.read_lines(spark, path, size).where(~F.col("value").startswith("#") & (F.col("value") != ""))
    names = [f.split()[0] for f in S.ANNOTATED.split(", ")]
    cells = F.split("value", "\t")
    rows = shape_annotated(lines.select(*[F.nullif(F.get(cells, F.lit(k)), F.lit("")).alias(n) for k, n in enumerate(names)]))
    if guard:
        guard_parsed(rows)
    return rows.where("pos is not null").drop("uploaded")


def read_genotype_blocks(spark: SparkSession, path: str, size: int = blocks.RANGE) -> DataFrame:
    """:func:`read_genotypes` of block-compressed files, one sample each and named after it."""
    lines = blocks.read_lines(spark, path, size)
    return shape_genotypes(lines.select(F.regexp_extract("file", r"([^/]+?)\.[^/]*$", 1).alias("sample_id"), "value"))


def unparsed(rows: DataFrame) -> DataFrame:
    """One row: how many coordinates could not be read, of how many, and the least of them."""
    bad = F.col("pos").isNull()
    return rows.agg(F.count_if(bad).alias("bad"), F.count("*").alias("total"), F.min(F.when(bad, F.col("uploaded"))).alias("example"))


def guard_parsed(rows: DataFrame) -> None:
    """Fail, with an example, rather than drop rows whose coordinate cannot be read."""
    seen = unparsed(rows).first()
    if seen.bad:
        raise ValueError(f"{seen.bad} of {seen.total} rows have no readable coordinate, such as {seen.example!r}")


def load_all(spark: SparkSession, pattern: str, snapshot: str) -> DataFrame:
    """All annotated tables of a snapshot in one job; the sample is the file's name up to the first dot."""
    raw = spark.read.schema(S.ANNOTATED).csv(pattern, sep="\t", comment="#", quote="")
    named = raw.withColumn("sample_id", F.regexp_extract(F.input_file_name(), r"([^/]+?)\.[^/]*$", 1))
    rows = shape_annotated(named, "sample_id").where("pos is not null").drop("uploaded")
    return rows.withColumn("snapshot_id", F.lit(snapshot))


def shape_clinvar(raw: DataFrame) -> DataFrame:
    """Records with four INFO fields by pattern; a record without a field has an empty one, never null."""
    field = lambda n: F.regexp_extract(F.coalesce("info", F.lit("")), f"(?:^|;){n}=([^;]*)", 1)
    return raw.select(
        "chrom", F.col("pos").try_cast("long").alias("pos"), "ref", "alt", field("CLNSIG").alias("clinvar_sig"),
        field("CLNREVSTAT").alias("clinvar_revstat"), field("CLNDN").alias("clinvar_disease"), field("ALLELEID").alias("clinvar_alleleid"),
    ).where("pos is not null")


def read_clinvar(spark: SparkSession, path: str) -> DataFrame:
    return shape_clinvar(spark.read.schema(S.CLINVAR).csv(path, sep="\t", comment="#", quote=""))


def shape_genotypes(lines: DataFrame) -> DataFrame:
    """Genotype records from VCF lines (``sample_id``, ``value``); headers and short lines are passed over."""
    f = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#")).withColumn("f", f).where(F.size("f") >= 10)
    keys, values = F.split(F.get("f", F.lit(8)), ":"), F.split(F.get("f", F.lit(9)), ":")
    cell = lambda n: F.nullif(F.get(values, (F.array_position(keys, F.lit(n)) - 1).cast("int")), F.lit("."))
    known = lambda n: F.when(F.array_contains(keys, n), cell(n))
    at = lambda i: F.get("f", F.lit(i))
    return rows.select(
        "sample_id", at(0).alias("chrom"), at(1).try_cast("long").alias("pos"), at(3).alias("ref"), at(4).alias("alt"), at(6).alias("filter"),
        known("GT").alias("gt"), known("AD").alias("ad"), known("DP").try_cast("int").alias("dp"), known("GQ").try_cast("int").alias("gq"),
        known("PS").alias("ps"), info_map(at(7)).alias("info"),
    )


def read_genotypes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """VCF files of one sample each, named after it."""
    lines = spark.read.text(paths).withColumn("sample_id", F.regexp_extract(F.input_file_name(), r"([^/]+?)\.[^/]*$", 1))
    return shape_genotypes(lines)


def shape_panel(raw: DataFrame) -> DataFrame:
    """Rule rows: a gene list becomes a row a gene, the mode is upper-cased."""
    gene = F.explode(F.filter(F.transform(F.split("genes", ","), lambda g: F.trim(g)), lambda g: g != ""))
    return raw.select("disease", gene.alias("gene"), F.upper("inheritance").alias("inh"), "note")


def read_rules(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep="\t", header=True, quote="")


def shape_scoring(raw: DataFrame) -> DataFrame:
    """Scoring rows; the other allele falls back to the inferred one; rows without place or weight are dropped."""
    rows = raw.select(
        "pgs_id", F.col("hm_chr").alias("chrom"), F.col("hm_pos").try_cast("long").alias("pos"), F.col("effect_allele").alias("effect"),
        F.coalesce(F.nullif("other_allele", F.lit("")), F.nullif("hm_inferOtherAllele", F.lit(""))).alias("other"),
        F.col("effect_weight").try_cast("decimal(18,6)").alias("weight"),
    )
    return rows.where("coalesce(chrom, '') <> '' and pos is not null and weight is not null")


def guard_usable(rows: DataFrame) -> DataFrame:
    """Fails for a score without any usable row."""
    if rows.isEmpty():
        raise ValueError("no usable row in the scoring file")
    return rows


def shape_repeats(rows: DataFrame) -> DataFrame:
    """Repeat calls (``info``, ``format``, ``sample``): locus, unit and sizes; records without sizes are dropped."""
    info = info_map(F.col("info"))
    keys, values = F.split("format", ":"), F.split("sample", ":")
    sizes = F.get(values, (F.array_position(keys, F.lit("REPCN")) - 1).cast("int"))
    numbers = F.filter(F.transform(F.split(sizes, "[/|]"), lambda x: x.try_cast("int")), lambda x: x.isNotNull())
    locus = F.coalesce(F.nullif(F.element_at(info, F.lit("VARID")), F.lit("")), F.element_at(info, F.lit("REPID")), F.lit(""))
    kept = rows.where(F.array_contains(keys, "REPCN") & sizes.isNotNull())
    return kept.select("sample_id", locus.alias("varid"), F.element_at(info, F.lit("RU")).alias("unit"), numbers.alias("sizes"))


def shape_pgx(rows: DataFrame) -> DataFrame:
    """Drug-gene reports (JSON: gene to diplotypes) as a row a gene: recommendations first, else source calls."""
    one = "struct<label:string,phenotypes:array<string>>"
    schema = f"struct<genes:map<string,struct<recommendationDiplotypes:array<{one}>,sourceDiplotypes:array<{one}>>>>"
    genes = F.map_entries(F.from_json("report", schema)["genes"])
    each = rows.select("sample_id", F.explode(genes).alias("g")).select("sample_id", F.col("g.key").alias("gene"), "g.value.*")
    some = lambda c: F.when(F.size(c) > 0, F.get(c, F.lit(0)))
    pick = F.coalesce(some("recommendationDiplotypes"), some("sourceDiplotypes"))
    rows = each.withColumn("d", pick)
    return rows.select("sample_id", "gene", F.col("d.label").alias("diplotype"), F.array_join("d.phenotypes", "; ").alias("phenotype"))


def shape_typed_alleles(rows: DataFrame) -> DataFrame:
    """Typed alleles (JSON: locus to list), cut to two fields, as a row an allele."""
    from vardelta.operators.domains import two_fields

    loci = F.map_entries(F.from_json("typed", "map<string,array<string>>"))
    each = rows.select("sample_id", F.explode(loci).alias("l")).select("sample_id", F.col("l.key").alias("locus"), F.explode("l.value").alias("allele"))
    return each.withColumn("allele", two_fields(F.col("allele")))


def check_build(headers: DataFrame, chr1_length: int = 248_956_422) -> DataFrame:
    """Per file (``file``, ``value`` header lines): declared length of contig 1, sample columns, verdict."""
    line = F.col("value")
    length = F.regexp_extract(line, r"^##contig=<ID=(?:chr)?1,.*?length=(\d+)", 1).try_cast("long")
    samples = F.when(line.startswith("#CHROM"), F.greatest(F.size(F.split(line, "\t")) - 9, F.lit(0)))
    seen = headers.groupBy("file").agg(F.max(length).alias("chr1_length"), F.max(samples).alias("n_samples"))
    verdict = (
        F.when(F.coalesce("n_samples", F.lit(0)) != 1, "not one sample").when(F.col("chr1_length").isNull(), "unknown build")
        .when(F.col("chr1_length") == chr1_length, "ok").otherwise("wrong build")
    )
    return seen.withColumn("verdict", verdict)


def reduce_constraint(rows: DataFrame) -> DataFrame:
    """One transcript per gene: the preferred one, then the canonical one, then the first in the file.

    ``rows``: gene, mane, canonical (booleans), line, pli, loeuf.
    """
    grade = F.when(F.col("mane"), 2).when(F.col("canonical"), 1).otherwise(0)
    order = Window.partitionBy("gene").orderBy(grade.desc(), "line")
    return rows.withColumn("r", F.row_number().over(order)).where("r = 1").select("gene", "pli", "loeuf", "line")


def shape_population(lines: DataFrame) -> DataFrame:
    """(individual, superpopulation) from white-space separated lines (``line_no``, ``value``).

    The header says where the columns are (two spellings); without either they are the first and the sixth.
    """
    words = F.split(F.trim("value"), r"\s+")
    head = lines.where("line_no = 0").select(words.alias("h"))
    found = head.select(
        F.greatest(F.array_position("h", F.lit("SampleID")), F.array_position("h", F.lit("sample"))).alias("i"),
        F.greatest(F.array_position("h", F.lit("Superpopulation")), F.array_position("h", F.lit("super_pop"))).alias("s"),
    ).first()
    i, s = (found.i, found.s) if found and found.i and found.s else (1, 6)
    rows = lines if (i, s) == (1, 6) and not (found and found.i and found.s) else lines.where("line_no > 0")
    picked = rows.select(F.get(words, F.lit(i - 1)).alias("individual"), F.get(words, F.lit(s - 1)).alias("superpopulation"))
    return picked.where("coalesce(superpopulation, '') <> ''")


def shape_frequencies(rows: DataFrame, markers: DataFrame, expected: list[str]) -> DataFrame:
    """Frequencies of wanted sites; nothing if any expected contig brought no record at all.

    ``rows``: chrom, pos, ref, alt, info with AF_MATCHED and AF.
    """
    info = info_map(F.col("info"))
    kept = rows.select(
        "chrom", "pos", "ref", "alt", F.element_at(info, F.lit("AF_MATCHED")).alias("matched"), F.element_at(info, F.lit("AF")).alias("overall")
    ).join(markers.select("chrom", "pos").distinct(), ["chrom", "pos"], "left_semi")
    seen = rows.where(F.col("chrom").isin(expected)).agg(F.count_distinct("chrom").alias("n_seen"))
    return kept.join(F.broadcast(seen.where(F.col("n_seen") == len(set(expected)))))  # one row or none


def snapshot_dates(headers: DataFrame) -> DataFrame:
    """Release date per file from its ``##fileDate=`` header line."""
    date = F.regexp_extract("value", r"^##fileDate=([0-9-]+)", 1)
    return headers.groupBy("file").agg(F.max(F.nullif(date, F.lit(""))).alias("clinvar_date"))

