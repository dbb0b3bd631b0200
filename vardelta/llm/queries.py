"""One production query for each operator of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vardelta.llm import (
    decontam,
    fill_middle,
    filter_audit,
    jaccard_join,
    langid,
    line_dedup,
    mixing,
    quality,
    sharding,
    simhash,
    token_counts,
    token_pack,
    url_filter,
)
from vardelta.llm._shared import table
from vardelta.llm.sql import MIX_WEIGHTS, ORACLE_SQL, SEED, SHARDS, URL_RULES

BYTE_BPE, BYTE_BPE_IDS, END_ID = "byte_bpe_50k.json", 50_257, 2
LIMIT = 1024


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        line_dedup.url_host(F.col("url")).alias("host"),
        line_dedup.html_lines(F.col("html")).alias("text"),
    )
    return line_dedup.drop_boilerplate(pages, "host", "text")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = sharding.assign(docs, SHARDS, SEED, text="text_crc32")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights, intercept = url_filter.fit(url_filter.labelled_urls(spark))
    rules = [url_filter.Rule(*r) for r in URL_RULES]
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules, weights, intercept).drop("url")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, MIX_WEIGHTS, SEED).select("doc_id", "source", "lang", "n_chars", "text", "copy", "mix_key")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"), shingles=(3,), radii=(3,))
    return found.select("doc_id", simhash.hex_digits(F.col("fp0")).alias("fingerprint"), "component_id")


def op7_token_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    blocks = token_pack.write(docs, public_tokenizers.path(BYTE_BPE), END_ID, BYTE_BPE_IDS)
    return token_pack.digest(blocks, BYTE_BPE_IDS)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs).drop("text")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_prefixes(docs, public_tokenizers.path(BYTE_BPE), budgets=(LIMIT,))
    return counted.select(
        "doc_id",
        F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
        F.get("within", F.lit(0)).alias("chars_within_limit"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (fold == 2).alias("held_out"))
    model = langid.fit(docs.where("not held_out and lang is not null").select("text", "lang"))
    return langid.identify(docs.select("doc_id", "held_out", "text"), model, reject=False).drop("text")


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"), shingle=5, percent=80)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = filter_audit.failed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit(masks, "ABCDE")


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            op1_line_dedup, op2_sharding, op3_url_filter, op4_mix_sources, op5_decontaminate, op6_simhash,
            op7_token_pack, op8_quality, op9_token_counts, op10_language, op11_jaccard_join, op12_filter_audit, op13_fill_middle,
        )
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
