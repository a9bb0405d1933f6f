"""Intervals: gap merge, splits, windows, statistics, rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import mono, rounded, segment_length
from ..operators import intervals as iv
from .registry import query, table

GAP, PIECE, WINDOW = 1800.0, 256.0, 1024.0


def _seconds(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    start = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    return e.select("event_id", "user_id", "event_type", start.alias("start"), (start + F.col("value")).alias("end"))


_EVENTS = "SELECT event_id, user_id, event_type, epoch_us(ts) / 1000000.0::DOUBLE AS s, epoch_us(ts) / 1000000.0::DOUBLE + value AS e FROM events"


@query(
    f"""
WITH i AS ({_EVENTS}),
f AS (SELECT *, CASE WHEN s - max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {GAP} THEN 0 ELSE 1 END AS opens FROM i),
g AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM f)
SELECT user_id, round(min(s), 6) AS start, round(max(e), 6) AS end, count(*) AS n FROM g GROUP BY user_id, island
"""
)
def gap_merge_events(spark: SparkSession, d: str) -> DataFrame:
    m = iv.gap_merge(_seconds(spark, d), ["user_id"], GAP)
    return m.select("user_id", rounded(F.col("start"), 6).alias("start"), rounded(F.col("end"), 6).alias("end"), "n")


@query(f"SELECT doc_id, i * {PIECE} AS start, least((i + 1) * {PIECE}, n_chars)::DOUBLE AS end FROM documents, unnest(range(0, ceil(n_chars / {PIECE})::BIGINT)) u(i)")
def bounded_split(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.lit(0.0).alias("start"), F.col("n_chars").cast("double").alias("end"))
    return iv.bounded_split(docs, PIECE)


@query(f"SELECT doc_id, i + 1 AS idx, i * {WINDOW} AS start, least((i + 1) * {WINDOW}, n_chars)::DOUBLE AS end FROM documents, unnest(range(0, ceil(n_chars / {WINDOW})::BIGINT)) u(i)")
def fixed_windows(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    each = docs.select("doc_id", F.posexplode(iv.fixed_windows(F.col("n_chars"), WINDOW)).alias("idx", "w"))
    return each.select("doc_id", (F.col("idx") + 1).cast("bigint").alias("idx"), F.col("w.start").alias("start"), F.col("w.end").alias("end"))


@query(
    """
WITH c AS (SELECT c_custkey, count(o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS urgent, count(o_orderkey) * 16.0 AS total FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT c_custkey, 0::DOUBLE AS start, urgent::DOUBLE AS end FROM c WHERE urgent > 0
UNION ALL SELECT c_custkey, i * 32.0::DOUBLE, least((i + 1) * 32.0, total)::DOUBLE FROM c, unnest(range(0, ceil(total / 32)::BIGINT)) u(i) WHERE urgent = 0
"""
)
def fallback_windows(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"), F.count("*").alias("n"))
    c = table(spark, d, "customer").select("c_custkey").join(orders, "c_custkey", "left").fillna(0)
    own = F.when(F.col("urgent") > 0, F.array(F.struct(F.lit(0.0).alias("start"), F.col("urgent").cast("double").alias("end"))))
    found = c.select("c_custkey", F.explode(iv.fallback_windows(own, F.col("n") * 16.0, 32.0)).alias("w"))
    return found.select("c_custkey", F.col("w.start").alias("start"), F.col("w.end").alias("end"))


@query(f"SELECT event_type, count(*) AS n, round(avg(greatest(e - s, 0)), 6) AS mean, round(median(greatest(e - s, 0)), 6) AS median FROM ({_EVENTS}) GROUP BY 1")
def segment_stats(spark: SparkSession, d: str) -> DataFrame:
    stats = iv.length_stats(_seconds(spark, d), ["event_type"], segment_length(F.col("start"), F.col("end")))
    return stats.select("event_type", "n", rounded(F.col("mean"), 6).alias("mean"), rounded(F.col("median"), 6).alias("median"))


@query(
    """
SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS idx, l_quantity AS length,
  round(avg(l_quantity) OVER (PARTITION BY l_orderkey), 6) AS mean, median(l_quantity) OVER (PARTITION BY l_orderkey) AS median
FROM lineitem
"""
)
def duration_series(spark: SparkSession, d: str) -> DataFrame:
    s = iv.length_series(table(spark, d, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"], F.col("l_quantity"))
    return s.withColumn("idx", F.col("idx").cast("bigint")).withColumn("mean", rounded(F.col("mean"), 6))


@query("SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) AS in_window FROM events")
def rate_window_audit(spark: SparkSession, d: str) -> DataFrame:
    return iv.rolling_starts(table(spark, d, "events"), ["user_id"], "ts").select("event_id", "user_id", "in_window")


@query("SELECT vec_id, list_transform(range(1, len(embedding) // 2 + 1), lambda i: round((embedding[i]::DOUBLE + embedding[len(embedding) // 2 + i]::DOUBLE) / 2, 6)) AS mono FROM embeddings")
def mono_downmix(spark: SparkSession, d: str) -> DataFrame:
    e, half = F.col("embedding"), F.expr("size(embedding) div 2")
    both = mono(F.slice(e, F.lit(1), half), F.slice(e, half + 1, half))
    return table(spark, d, "embeddings").select("vec_id", F.transform(both, lambda x: rounded(x, 6)).alias("mono"))


@query(
    f"""
WITH i AS ({_EVENTS}),
f AS (SELECT *, CASE WHEN s - max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 0.45 THEN 0 ELSE 1 END AS opens FROM i),
g AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM f),
m AS (SELECT user_id, min(s) AS s, max(e) AS e FROM g GROUP BY user_id, island),
p AS (SELECT user_id, s + k * 64.0 AS a, least(s + (k + 1) * 64.0, e) AS b FROM m, unnest(range(0, ceil((e - s) / 64.0)::BIGINT)) u(k))
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY a) AS idx, round(a, 6) AS start, round(b, 6) AS end FROM p
"""
)
def speech_segments(spark: SparkSession, d: str) -> DataFrame:
    s = iv.speech_segments(_seconds(spark, d).select("user_id", "start", "end"), ["user_id"], 450, 64.0)
    return s.select("user_id", F.col("idx").cast("bigint").alias("idx"), rounded(F.col("start"), 6).alias("start"), rounded(F.col("end"), 6).alias("end"))
