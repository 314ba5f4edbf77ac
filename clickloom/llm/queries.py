"""The training-data operators as named queries over the test tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from clickloom.llm import (
    collocations, decontaminate, html_extract, language_id, licenses, near_dedup, packing, quality_rules,
    secret_scan, sharding, spelling, toxicity, url_filter)
from clickloom.llm.sampling import fold
from clickloom.llm.sql import SQL
from clickloom.llm.workers import ready

Query = Callable[[SparkSession, str], DataFrame]

URL_ENTRIES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
               ("block", "net/es/"), ("block", "net/fr/")]

_QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ready(spark)
        return fn(spark, sf_dir)

    _QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def llm_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def llm_sql() -> dict[str, str]:
    return dict(SQL)


@_query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_ENTRIES).select(
        "page_id", "host", "path", "rule", "verdict")


@_query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("word_bpe_49k.json"))


@_query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = near_dedup.Sizes(width=3, percent=85, coordinates=64, matches=40)
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), sizes)


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@_query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measured(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@_query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.find_secrets(docs, texts=False).select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(secret_scan.span_text("base"), 256).alias("base_sha256"),
        secret_scan.span_text("secrets").alias("spans"))


@_query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"),
                                       table(spark, sf_dir, "benchmark"))


@_query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn(
        "held_out", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)))
    model = language_id.Model.learn(docs.where("not held_out"),
                                    public_tokenizers.path("piece_bpe_32k.model"))
    return language_id.predict(docs, model).select("doc_id", "held_out", "lang_pred", "score")


@_query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn(
        "held_out", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)))
    model = toxicity.Model.learn(docs.where("not held_out"), table(spark, sf_dir, "labels"))
    return toxicity.predict(docs, model).select("doc_id", "held_out", "score", "predicted")


@_query
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.Weights.learn(pages)).select(
        "page_id", "url", "text", "n_chars")


@_query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", "license", "dice", "n_matches")


@_query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents")).select(
        "word", "n", "n_near", "form", "form_n", "root")


@_query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@_query
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.places(table(spark, sf_dir, "documents"))
