"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op1_mixing, op10_topk, op2_ngram_join, op3_substring, op4_secrets, op5_exact, op6_urls, op7_toxicity, op8_bpe, op9_langid, sql
from .common import read


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_mixing.mix_sources(read(spark, sf_dir, "documents"), columns=["doc_id", "source", "text"], copy="copy")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_exact.exact_duplicates(read(spark, sf_dir, "documents"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_ngram_join.jaccard_classes(read(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op3_substring.repeated_passages(read(spark, sf_dir, "documents"))
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), " ").alias(c)
    return found.select("doc_id", shown("spans"), "repeated_words", shown("cut_spans"), "cut_words")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_secrets.scan_secrets(read(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_urls.filter_urls(read(spark, sf_dir, "pages"))


def op7_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return op7_toxicity.score_toxicity(docs, op7_toxicity.fit_lexicon(docs, read(spark, sf_dir, "labels")))


def op8_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_bpe.encode(read(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return op9_langid.identify(docs, op9_langid.fit_dictionaries(docs))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_topk.top_k(read(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mix_sources, op2_ngram_jaccard, op3_substring_dedup, op4_secret_scan, op5_exact_dedup, op6_url_filter, op7_toxicity_scores, op8_bpe_tokens, op9_language_id, op10_top_k)}


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": sql.OP1_MIX, "op2_ngram_jaccard": sql.OP2_NGRAM_JOIN, "op3_substring_dedup": sql.OP3_SUBSTRING, "op5_exact_dedup": sql.OP5_EXACT_DEDUP, "op6_url_filter": sql.op6_urls(op6_urls.RULES), "op10_top_k": sql.OP10_TOP_K}
