"""Scalar functions over values derived from the tables' columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..adapters.retry import backoff_column
from ..functions import durations as du
from ..functions import texts, urls, values
from .registry import query, table


@query(r"SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]*)', 1)), '') AS host FROM pages")
def url_host(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", urls.host(F.col("url")).alias("host"))


@query(r"SELECT page_id, nullif(regexp_extract(regexp_extract(url, '\?([^#]*)', 1), '(?:^|&)page=([^&]+)', 1), '') AS page FROM pages")
def url_param(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", urls.query_param(F.col("url"), "page").alias("page"))


def _pick(key: Column, forms: list[Column]) -> Column:
    return F.element_at(F.array(*forms), F.pmod(key, F.lit(len(forms))).cast("int") + 1)


def _id(c: str) -> Column:
    return F.concat(F.lit("v"), F.col(c).cast("string"))


_ID = "'v' || page_id"


@query(
    f"""
SELECT page_id,
  CASE page_id % 6 WHEN 0 THEN {_ID} || '-x' WHEN 4 THEN {_ID} END AS exact_id,
  CASE page_id % 6 WHEN 0 THEN {_ID} || '-x' WHEN 1 THEN {_ID} WHEN 4 THEN {_ID} END AS id,
  CASE page_id % 6 WHEN 0 THEN {_ID} || '-x' WHEN 1 THEN {_ID} WHEN 4 THEN {_ID} END AS lenient_id
FROM pages
"""
)
def video_id_long(spark: SparkSession, d: str) -> DataFrame:
    v = _id("page_id")
    forms = [
        F.concat(F.lit("https://www.youtube.com/watch?v="), v, F.lit("%2Dx&t=9")),
        F.concat(F.lit("https://youtube.com/watch?t=9&v="), v),
        F.concat(F.lit("https://m.youtube.com/watch?v="), v),
        F.lit("https://www.youtube.com/watch?v="),
        F.concat(F.lit("HTTPS://WWW.YouTube.com:443/watch?x=&v="), v, F.lit("#v=no")),
        F.lit(None).cast("string"),
    ]
    url = _pick(F.col("page_id"), forms)
    return table(spark, d, "pages").select("page_id", urls.watch_id_exact(url).alias("exact_id"), urls.watch_id(url).alias("id"), urls.watch_id_lenient(url).alias("lenient_id"))


@query(
    f"""
SELECT page_id,
  CASE page_id % 3 WHEN 0 THEN {_ID} WHEN 1 THEN {_ID} || '?t=1' ELSE '' END AS exact_id,
  CASE page_id % 3 WHEN 2 THEN '' ELSE {_ID} END AS id, {_ID} AS lenient_id,
  'https://www.youtube.com/watch?v=' || {_ID} AS canonical
FROM pages
"""
)
def video_id_short(spark: SparkSession, d: str) -> DataFrame:
    v = _id("page_id")
    url = F.concat(F.lit("https://youtu.be/"), v, _pick(F.col("page_id"), [F.lit(""), F.lit("?t=1"), F.lit("/")]))
    lenient = urls.watch_id_lenient(url)
    return table(spark, d, "pages").select("page_id", urls.watch_id_exact(url).alias("exact_id"), urls.watch_id(url).alias("id"), lenient.alias("lenient_id"), urls.watch_url(lenient).alias("canonical"))


_H, _M, _S = "o_orderkey % 30", "o_orderkey % 50", "o_orderkey % 59"


def _hms() -> tuple[Column, Column, Column]:
    k = F.col("o_orderkey")
    return k % 30, k % 50, k % 59


@query(
    f"""
SELECT o_orderkey, CASE o_orderkey % 4
  WHEN 0 THEN printf('%02d:%02d:%02d', {_H}, {_M}, {_S}) WHEN 1 THEN printf('%02d:00:%02d', {_H}, {_S}) WHEN 2 THEN printf('00:%02d:00', {_M}) ELSE '00:00:00' END AS duration
FROM orders
"""
)
def iso_duration(spark: SparkSession, d: str) -> DataFrame:
    h, m, s = _hms()
    part = lambda n, unit: F.concat(n.cast("string"), F.lit(unit))
    forms = [F.concat(F.lit("PT"), part(h, "H"), part(m, "M"), part(s, "S")), F.concat(F.lit("PT"), part(h, "H"), part(s, "S")), F.concat(F.lit("PT"), part(m, "M")), F.concat(F.lit("P1DT"), part(h, "H"))]
    return table(spark, d, "orders").select("o_orderkey", du.iso_duration(_pick(F.col("o_orderkey"), forms)).alias("duration"))


def _texts() -> Column:
    h, m, s = _hms()
    two = lambda *c: F.concat_ws(":", *[F.format_string("%02d", x) for x in c])
    return _pick(F.col("o_orderkey"), [two(h, m, s), two(m, s), s.cast("string"), F.concat(F.lit("x:"), two(m, s)), F.concat(two(h, m, s), F.lit(":1")), F.lit(None).cast("string")])


@query(f"SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN ({_H}) * 3600 + ({_M}) * 60 + {_S} WHEN 1 THEN ({_M}) * 60 + {_S} WHEN 2 THEN {_S} END::BIGINT AS seconds FROM orders")
def hms_parse_null(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", du.hms_or_null(_texts()).alias("seconds"))


@query(f"SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN ({_H}) * 3600 + ({_M}) * 60 + {_S} ELSE 0 END::BIGINT AS seconds, CASE WHEN o_orderkey % 5 < 2 THEN o_custkey ELSE seconds END::BIGINT AS declared FROM orders")
def hms_parse_zero(spark: SparkSession, d: str) -> DataFrame:
    own = _pick(F.col("o_orderkey"), [F.col("o_custkey").cast("string"), F.col("o_custkey").cast("string"), F.lit(None).cast("string"), F.lit("none"), F.lit("")])
    return table(spark, d, "orders").select("o_orderkey", du.hms_or_zero(_texts()).alias("seconds"), du.declared_seconds(own, _texts()).alias("declared"))


@query(
    """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN floor(o_totalprice) WHEN o_orderkey % 5 = 1 THEN o_custkey WHEN o_orderkey % 5 = 2 THEN floor(o_totalprice / 1000)
  WHEN o_orderkey % 5 = 3 THEN (o_custkey // 60) * 60 + o_custkey % 60 END::BIGINT AS seconds
FROM orders
"""
)
def duration_coalesce(spark: SparkSession, d: str) -> DataFrame:
    k, n = F.col("o_orderkey") % 5, F.lit(None).cast("string")
    pick = lambda i, c: F.when(k == i, c)
    duration = F.coalesce(pick(0, F.col("o_totalprice").cast("string")), pick(1, F.lit("-1")), pick(2, F.lit("NaN")), n)
    seconds = F.coalesce(pick(1, F.col("o_custkey").cast("string")), pick(2, F.lit("Infinity")), n)
    ms = F.coalesce(pick(2, F.col("o_totalprice").cast("string")), n)
    text = F.coalesce(pick(3, F.concat(F.expr("cast(o_custkey div 60 as string)"), F.lit(":"), (F.col("o_custkey") % 60).cast("string"))), pick(4, F.lit("1:x")), n)
    return table(spark, d, "orders").select("o_orderkey", du.entry_duration(duration, seconds, ms, text).alias("seconds"))


_P = "l_extendedprice"
_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _lines(spark: SparkSession, d: str, *cols: Column) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *cols)


@query(f"SELECT {_ORDER}, printf('%02d:%02d:%02d', (x // 3600)::INT, (x % 3600 // 60)::INT, (x % 60)::INT) AS hms FROM (SELECT *, floor({_P} * 5)::BIGINT AS x FROM lineitem)")
def fmt_hms(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d, du.hms(F.floor(F.col("l_extendedprice") * 5)).alias("hms"))


@query(f"SELECT {_ORDER}, CASE WHEN x >= 3600 THEN printf('%dh %dm %ds', (x // 3600)::INT, (x % 3600 // 60)::INT, (x % 60)::INT) WHEN x >= 60 THEN printf('%dm %ds', (x // 60)::INT, (x % 60)::INT) ELSE printf('%ds', x::INT) END AS human FROM (SELECT *, floor({_P} / 16)::BIGINT AS x FROM lineitem)")
def fmt_human(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d, du.human(F.col("l_extendedprice") / 16).alias("human"))


@query(f"SELECT {_ORDER}, CASE WHEN l_partkey % 11 = 0 THEN '?' WHEN x >= 3600 THEN printf('%d:%02d:%02d', (x // 3600)::INT, (x % 3600 // 60)::INT, (x % 60)::INT) ELSE printf('%d:%02d', (x // 60)::INT, (x % 60)::INT) END AS clock FROM (SELECT *, greatest(floor({_P} / 16) - 100, 0)::BIGINT AS x FROM lineitem)")
def fmt_clock(spark: SparkSession, d: str) -> DataFrame:
    x = F.when(F.col("l_partkey") % 11 != 0, F.floor(F.col("l_extendedprice") / 16) - 100)
    return _lines(spark, d, du.clock(x).alias("clock"))


@query(f"SELECT {_ORDER}, printf('%02d:%02d:%02d.%03d', (x // 3600000)::INT, (x % 3600000 // 60000)::INT, (x % 60000 // 1000)::INT, (x % 1000)::INT) AS cue FROM (SELECT *, round({_P} * 125)::BIGINT AS x FROM lineitem)")
def fmt_vtt(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d, du.cue_time(F.round(F.col("l_extendedprice") * 125) / 1000).alias("cue"))


_RATE = " ".join(f"WHEN x < {1024.0 ** (k + 1)} THEN printf('%.1f{u}/s', x / {1024.0 ** k})" for k, u in enumerate(("KB", "MB"), 1))


@query(f"SELECT {_ORDER}, CASE WHEN l_discount = 0 OR x = 0 THEN '?' WHEN x < 1024 THEN printf('%.1fB/s', x) {_RATE} ELSE printf('%.1fGB/s', x / {1024.0**3}) END AS rate FROM (SELECT *, floor(l_partkey * l_suppkey * 7) + 0.03 AS x FROM lineitem)")
def fmt_rate(spark: SparkSession, d: str) -> DataFrame:
    x = F.when(F.col("l_discount") != 0, (F.floor(F.col("l_partkey") * F.col("l_suppkey") * 7) + F.lit(0.03)).cast("double"))
    return _lines(spark, d, values.rate_text(x).alias("rate"))


_FLAG = "CASE event_type WHEN 'click' THEN ' Yes ' WHEN 'view' THEN 'TRUE' WHEN 'error' THEN NULL WHEN 'signup' THEN 'y' ELSE '0' END"


@query(
    """
SELECT event_id, event_type IN ('click', 'view', 'signup') AS downloaded, event_type IN ('click', 'view') AS completed, event_type IN ('click', 'signup') AS confirmed,
  CASE event_type WHEN 'error' THEN false WHEN 'view' THEN false ELSE true END AS pending
FROM events
"""
)
def truthy_flags(spark: SparkSession, d: str) -> DataFrame:
    f = F.expr(_FLAG)
    known = F.when(F.col("event_type") != "error", F.col("event_type") == "view")
    return table(spark, d, "events").select("event_id", values.is_downloaded(f).alias("downloaded"), values.is_completed(f).alias("completed"), values.is_confirmed(f).alias("confirmed"), values.pending(known).alias("pending"))


@query(
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '1999' ELSE strftime(o_orderdate, '%Y') END AS year, strftime(o_orderdate, '%Y') AS first_part, strftime(o_orderdate, '%Y-%m-%d') AS published FROM orders
"""
)
def infer_year(spark: SparkSession, d: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    date = F.when(F.col("o_orderstatus") == "F", F.lit("n/a")).otherwise(F.concat(F.lit("  "), day))
    path = F.concat(F.lit("raw/12345/1999/"), F.col("o_orderkey").cast("string"), F.lit(".opus"))
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return table(spark, d, "orders").select("o_orderkey", du.infer_year(date, path).alias("year"), du.year_of(day).alias("first_part"), du.published_on(stamp).alias("published"))


@query("SELECT p_partkey, 'T: ' || replace(replace('{' || p_name || '}', '{', '{{'), '}', '}}') || ' / ' || replace(replace(p_brand || '}', '{', '{{'), '}', '}}') AS prompt FROM part")
def prompt_render(spark: SparkSession, d: str) -> DataFrame:
    prompt = texts.system_prompt("T: {title} / {description}", F.concat(F.lit("{"), F.col("p_name"), F.lit("}")), F.concat(F.col("p_brand"), F.lit("}")))
    return table(spark, d, "part").select("p_partkey", prompt.alias("prompt"))


@query(r"SELECT doc_id, length(replace(text, chr(10), '\n')) AS escaped_length, md5(trim(regexp_replace(replace(replace(text, chr(160), ' '), chr(8239), ' '), '\s+', ' ', 'g'))) AS collapsed FROM documents")
def text_cleanup(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.length(texts.escape_newlines(t)).cast("bigint").alias("escaped_length"), F.md5(texts.collapse_whitespace(t)).alias("collapsed"))


RULES = [("que", "ke"), ("([aeiou])n([ .,;])", "$1m$2"), ("<\\|[a-z]+\\|>", "")]


@query(r"SELECT doc_id, md5(regexp_replace(regexp_replace(replace(coalesce(text, ''), 'que', 'ke'), '([aeiou])n([ .,;])', '\1m\2', 'g'), '<\|[a-z]+\|>', '', 'g')) AS corrected FROM documents")
def rule_correct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(texts.correct(F.col("text"), RULES)).alias("corrected"))


CANTONESE = ["俾路支俾你", "曬太陽曝曬衣曬相", "好翻去翻到", "唔該曬翻曬 多謝曬", "<|粵語|>a<|zh|>b<||>", "咁系系統", "嚇，嚇人", "噶姥爺"]


@query()
def rule_correct_cantonese(spark: SparkSession, d: str) -> DataFrame:
    """All default rules on every turn of the conversations between two fixed phrases; DuckDB's regexes have no lookaround."""
    phrase = F.element_at(F.array(*map(F.lit, CANTONESE)), F.pmod(F.col("turn"), F.lit(len(CANTONESE))).cast("int") + 1)
    return table(spark, d, "conversations").select("conv_id", "turn", texts.correct(F.concat(phrase, F.coalesce("text", F.lit("")), phrase)).alias("text"))


@query("SELECT i::INT AS attempt, least(8.0, 0.8 * 2 ** (i - 1))::DOUBLE AS request_wait, least(15.0, 0.8 * 2 ** (i - 1))::DOUBLE AS round_wait, least(60.0, 5.0 * 2 ** (i - 1))::DOUBLE AS extract_wait FROM range(1, 8) t(i)")
def backoff_schedule(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("id").cast("int")
    return spark.range(1, 8).select(n.alias("attempt"), backoff_column(n, 0.8, 8.0).alias("request_wait"), backoff_column(n, 0.8, 15.0).alias("round_wait"), backoff_column(n, 5.0, 60.0).alias("extract_wait"))


@query(
    """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'https://www.youtube.com/playlist?list=UU' || c_custkey WHEN c_custkey % 3 = 1 THEN 'https://www.youtube.com/playlist?list=UUx' || c_custkey END AS uploads_url FROM customer
"""
)
def uploads_url(spark: SparkSession, d: str) -> DataFrame:
    k, key = F.col("c_custkey") % 3, F.col("c_custkey").cast("string")
    playlist = F.when(k == 0, F.concat(F.lit(" UU"), key)).when(k == 1, F.concat(F.lit("PL"), key))
    channel = F.when(k == 1, F.concat(F.lit("UCx"), key)).when(k == 2, F.lit("HC1"))
    return table(spark, d, "customer").select("c_custkey", urls.uploads_url(playlist, channel).alias("uploads_url"))
