"""Shard plans: next-fit packing of documents by source and of orders by year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.texts import json_payload, numbered
from ..functions.values import rounded, size_text
from ..operators.packing import pack
from .registry import query, table

SAMPLES, CHARS, CENTS = 20, 60_000, 5_000_000


def _fold(rows: str, most: int) -> str:
    """Recursive SQL of the packing: rows has (g, rn, size, ...)."""
    full = f"p.cnt >= {SAMPLES} OR p.bytes + o.size > {most}"
    return f"""
WITH RECURSIVE o AS ({rows}),
p AS (
  SELECT g, rn, 0 AS shard, 1 AS cnt, size AS bytes FROM o WHERE rn = 1
  UNION ALL
  SELECT o.g, o.rn, CASE WHEN {full} THEN p.shard + 1 ELSE p.shard END, CASE WHEN {full} THEN 1 ELSE p.cnt + 1 END, CASE WHEN {full} THEN o.size ELSE p.bytes + o.size END
  FROM p JOIN o ON o.g = p.g AND o.rn = p.rn + 1
)
"""


_DOCS = "SELECT source AS g, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn, n_chars AS size FROM documents"
_ORDERS = "SELECT substr(o_orderdate::VARCHAR, 1, 4) AS g, row_number() OVER (PARTITION BY substr(o_orderdate::VARCHAR, 1, 4) ORDER BY o_orderdate, o_orderkey) AS rn, round(o_totalprice * 100)::BIGINT AS size FROM orders"


def _packed(spark: SparkSession, d: str) -> DataFrame:
    return pack(table(spark, d, "documents").select("doc_id", "source", "n_chars"), "source", ["doc_id"], "n_chars", SAMPLES, CHARS)


@query(_fold(_DOCS, CHARS) + "SELECT p.g AS source, p.shard, count(*) AS samples, sum(o.size)::BIGINT AS bytes FROM p JOIN o ON o.g = p.g AND o.rn = p.rn GROUP BY p.g, p.shard")
def shard_plan(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d).groupBy("source", "shard").agg(F.count("*").alias("samples"), F.sum("n_chars").alias("bytes"))


@query(
    _fold(_DOCS, CHARS)
    + "SELECT o.doc_id, p.shard, p.rn - 1 AS sample_index, printf('%s-%05d.tar', p.g, p.shard) AS shard_name, printf('%s-%06d.opus', p.g, p.rn - 1) AS audio_member, printf('%s-%06d.json', p.g, p.rn - 1) AS json_member FROM p JOIN o ON o.g = p.g AND o.rn = p.rn"
)
def shard_members(spark: SparkSession, d: str) -> DataFrame:
    name = lambda pattern, c: numbered(pattern, F.col("source"), F.col(c))
    return _packed(spark, d).select("doc_id", "shard", "sample_index", name("%s-%05d.tar", "shard").alias("shard_name"), name("%s-%06d.opus", "sample_index").alias("audio_member"), name("%s-%06d.json", "sample_index").alias("json_member"))


@query(_fold(_ORDERS, CENTS * 100) + "SELECT p.g AS year, p.shard, count(*) AS samples, sum(o.size)::BIGINT AS cents FROM p JOIN o ON o.g = p.g AND o.rn = p.rn GROUP BY p.g, p.shard")
def shard_pack_orders_year(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy").alias("year"), "o_orderdate", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    packed = pack(orders, "year", ["o_orderdate", "o_orderkey"], "cents", SAMPLES, CENTS * 100)
    return packed.groupBy("year", "shard").agg(F.count("*").alias("samples"), F.sum("cents").alias("cents"))


@query("SELECT n_nationkey, '{\"id\": \"' || n_nationkey || '\", \"name\": \"' || n_name || '\", \"region\": ' || coalesce('\"' || r_name || '\"', 'null') || '}' AS payload FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def json_payloads(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return both.select("n_nationkey", json_payload({"id": F.col("n_nationkey"), "name": F.col("n_name"), "region": F.col("r_name")}).alias("payload"))


@query("SELECT source, count(*) AS files, sum(n_chars)::BIGINT AS bytes, round(sum(n_chars) / 1073741824.0, 2) AS gb FROM documents GROUP BY source")
def source_bytes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("files"), F.sum("n_chars").alias("bytes")).withColumn("gb", rounded(F.col("bytes") / 1073741824.0, 2))


_UNIT = " ".join(f"WHEN x < {1024.0 ** (k + 1)} THEN printf('%.2f {u}', x / {1024.0 ** k})" for k, u in enumerate(("KB", "MB", "GB"), 1))


@query(f"SELECT l_orderkey, bytes, CASE WHEN x < 1024 THEN bytes || ' B' {_UNIT} ELSE printf('%.2f TB', x / {1024.0**4}) END AS size FROM (SELECT l_orderkey, sum(round(l_extendedprice))::BIGINT * sum(l_partkey) // 3 AS bytes, bytes::DOUBLE AS x FROM lineitem GROUP BY 1)")
def fmt_size(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(F.round("l_extendedprice").cast("bigint")).alias("a"), F.sum("l_partkey").alias("b"))
    return n.select("l_orderkey", F.expr("a * b div 3").alias("bytes")).withColumn("size", size_text(F.col("bytes")))
