"""Catalog, integrity, metadata, publishing, playlist and subtitle queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.durations import hms, year_of
from ..functions.status import probe_error
from ..functions.texts import basename, parent, stem
from ..functions.values import percent_off, rounded
from ..operators import catalog as cat
from ..operators import integrity, metadata, playlist, publish, subtitle
from ..schemas import ENTRY
from .registry import query, table


def _day(c: str) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd")


# --- catalog


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS place FROM orders WHERE o_orderstatus = 'P'")
def pending_sorted(spark: SparkSession, d: str) -> DataFrame:
    flag = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "P", False)
    rows = cat.pending_rows(table(spark, d, "orders").withColumn("downloaded", flag)).withColumn("day", _day("o_orderdate"))
    ranked = cat.row_number_by(rows.withColumn("_o", F.struct(-F.unix_date(F.to_date("day")), F.col("o_orderkey"))), "_o", "place")
    return ranked.select("o_orderkey", "day", "place")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'F' ORDER BY o_orderkey LIMIT 25")
def candidates_limit(spark: SparkSession, d: str) -> DataFrame:
    """The first 25 rows that aren't completed; the limit is the operator's own."""
    rows = table(spark, d, "orders").withColumn("completed", F.when(F.col("o_orderstatus") == "F", "TRUE").otherwise("FALSE"))
    return cat.candidates(rows, "o_orderkey", 25).select("o_orderkey", "o_custkey")


@query(
    """
WITH t AS (SELECT DISTINCT l_orderkey FROM lineitem),
o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'P' THEN false END AS flag, l_orderkey IS NOT NULL AS found FROM orders LEFT JOIN t ON l_orderkey = o_orderkey)
SELECT o_orderkey, CASE WHEN found THEN true ELSE flag END AS downloaded, found, found AND NOT coalesce(flag, true) AS updated, NOT found AND coalesce(flag, true) AS missing FROM o
"""
)
def progress_reconcile(spark: SparkSession, d: str) -> DataFrame:
    flag = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "P", False)
    orders = table(spark, d, "orders").select("o_orderkey", flag.alias("downloaded"))
    return cat.reconcile(orders, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query(
    """
WITH t AS (SELECT DISTINCT l_orderkey FROM lineitem),
o AS (SELECT CASE o_orderstatus WHEN 'F' THEN true WHEN 'P' THEN false END AS flag, l_orderkey IS NOT NULL AS found FROM orders LEFT JOIN t ON l_orderkey = o_orderkey)
SELECT count(*) FILTER (found AND NOT coalesce(flag, true)) AS updated, count(*) FILTER (NOT found AND coalesce(flag, true)) AS missing, count(*) FILTER (found) AS found FROM o
"""
)
def progress_counts(spark: SparkSession, d: str) -> DataFrame:
    return cat.progress_counts(progress_reconcile(spark, d))


@query(
    """
WITH y AS (SELECT o_custkey, arg_max(strftime(o_orderdate, '%Y'), o_orderkey) AS year FROM orders GROUP BY 1)
SELECT c_custkey, year, 'dl/' || year || '/' || c_custkey || '.opus' AS target FROM customer LEFT JOIN y ON o_custkey = c_custkey
"""
)
def year_assign_lastwins(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), _day("o_orderdate").alias("day"), "o_orderkey")
    files = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("dl/"), F.col("c_custkey").cast("string"), F.lit(".opus")).alias("path"))
    assigned = cat.assign_years(files, orders, "c_custkey", "day", "o_orderkey")
    return assigned.join(cat.move_plan(assigned, "dl"), "path", "left").select("c_custkey", "year", "target")


def _order_files(spark: SparkSession, d: str) -> DataFrame:
    """Files that orders left behind: in a year's folder, flat or nested, by status."""
    o = table(spark, d, "orders")
    name = F.concat(F.col("o_custkey").cast("string"), F.lit(".opus"))
    place = F.when(F.col("o_orderstatus") == "O", F.concat_ws("/", F.lit("dl"), F.date_format("o_orderdate", "yyyy"), name)).when(F.col("o_orderstatus") == "F", F.concat_ws("/", F.lit("dl"), F.col("o_custkey").cast("string"), name))
    return o.select(place.alias("path")).filter("path IS NOT NULL").distinct()


_FILES = "SELECT DISTINCT CASE o_orderstatus WHEN 'O' THEN 'dl/' || strftime(o_orderdate, '%Y') || '/' || o_custkey || '.opus' ELSE 'dl/' || o_custkey || '/' || o_custkey || '.opus' END AS path FROM orders WHERE o_orderstatus <> 'P'"


@query(
    f"""
WITH f AS ({_FILES}),
c AS (SELECT o_orderkey, pos, path FROM orders, unnest([0, 1, 2]) u(pos), LATERAL (SELECT CASE pos WHEN 0 THEN 'dl/' || strftime(o_orderdate, '%Y') || '/' || o_custkey || '.opus' WHEN 1 THEN 'dl/' || o_custkey || '.opus' ELSE 'dl/' || o_custkey || '/' || o_custkey || '.opus' END AS path)),
h AS (SELECT o_orderkey, arg_min(path, pos) AS path FROM c SEMI JOIN f USING (path) GROUP BY 1)
SELECT o_orderkey, path FROM orders LEFT JOIN h USING (o_orderkey)
"""
)
def path_resolve(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("id"), _day("o_orderdate").alias("day"))
    return cat.resolve_paths(rows, _order_files(spark, d), "o_orderkey", cat.download_paths("dl", F.col("id"), F.col("day"))).select("o_orderkey", "path")


@query(
    """
WITH f AS (SELECT DISTINCT CASE c_mktsegment WHEN 'BUILDING' THEN 'meta/pub/' || c_custkey WHEN 'MACHINERY' THEN 'audio/' || c_custkey WHEN 'HOUSEHOLD' THEN 'audio/pub/' || c_custkey ELSE '/abs/' || c_custkey END AS path FROM customer)
SELECT o_orderkey, CASE WHEN '/abs/' || o_custkey IN (SELECT path FROM f) AND o_orderstatus = 'F' THEN '/abs/' || o_custkey
  WHEN o_orderstatus = 'F' THEN NULL
  WHEN 'meta/pub/' || o_custkey IN (SELECT path FROM f) THEN 'meta/pub/' || o_custkey
  WHEN 'audio/pub/' || o_custkey IN (SELECT path FROM f) THEN 'audio/pub/' || o_custkey
  WHEN 'audio/' || o_custkey IN (SELECT path FROM f) THEN 'audio/' || o_custkey END AS path
FROM orders
"""
)
def upload_path_resolve(spark: SparkSession, d: str) -> DataFrame:
    s, k = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    at = F.when(s == "BUILDING", F.concat(F.lit("meta/pub/"), k)).when(s == "MACHINERY", F.concat(F.lit("audio/"), k)).when(s == "HOUSEHOLD", F.concat(F.lit("audio/pub/"), k)).otherwise(F.concat(F.lit("/abs/"), k))
    files = table(spark, d, "customer").select(at.alias("path"))
    cell = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("/abs/"), F.col("o_custkey").cast("string"))).otherwise(F.concat(F.lit(" pub/"), F.col("o_custkey").cast("string")))
    rows = table(spark, d, "orders").select("o_orderkey", cell.alias("cell"))
    return cat.resolve_paths(rows, files, "o_orderkey", cat.upload_paths(F.col("cell"), "meta", "audio", "pub")).select("o_orderkey", "path")


@query("SELECT o_orderkey, CASE WHEN bool_or(l_returnflag = 'R') THEN true ELSE any_value(o_orderstatus) = 'F' END AS downloaded FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def download_results(spark: SparkSession, d: str) -> DataFrame:
    results = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_returnflag") == "R").alias("ok"))
    orders = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("downloaded"))
    return cat.apply_results(orders, results, "o_orderkey")


# --- integrity


def _probes(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    seconds = F.col("p_retailprice") - 900.0
    return p.select(F.concat(F.lit("dl/"), F.col("p_partkey").cast("string"), F.lit(".opus")).alias("path"), (F.col("p_type") != "PROMO").alias("ok"), seconds.alias("duration"), F.lit(None).cast("string").alias("error"), F.col("p_partkey").cast("string").alias("key"), F.col("p_size").alias("size"))


def _checked(spark: SparkSession, d: str) -> DataFrame:
    probes = _probes(spark, d)
    text = F.when(F.col("size") % 7 == 0, F.lit("unknown")).otherwise(hms(F.col("size") * 2))
    listed = probes.select(F.col("key").alias("id"), text.alias("duration"), F.col("size"))
    return integrity.check(probes.drop("key", "size"), cat.expected_seconds(listed, "id", "duration", "size"))


_CHECKED = """
WITH p AS (SELECT p_partkey, 'dl/' || p_partkey || '.opus' AS path, p_type <> 'PROMO' AS ok, p_retailprice - 900.0 AS actual, CASE WHEN p_size % 7 <> 0 THEN p_size * 2 END AS expected FROM part),
c AS (SELECT *, CASE WHEN NOT ok THEN 'corrupted' WHEN expected IS NOT NULL THEN CASE WHEN abs(actual - expected) > 1.0 THEN 'truncated' ELSE 'valid' END WHEN actual < 60 THEN 'suspicious' ELSE 'valid' END AS status FROM p)
"""


@query(_CHECKED + "SELECT path, status, expected::BIGINT AS expected, CASE status WHEN 'truncated' THEN round(abs(actual - expected), 6) END AS duration_diff, CASE status WHEN 'truncated' THEN round(abs(actual - expected) / expected * 100, 6) END AS percent_off FROM c")
def integrity_status(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d).select("path", "status", "expected", rounded(F.col("duration_diff"), 6).alias("duration_diff"), rounded(F.col("percent_off"), 6).alias("percent_off"))


@query(
    _CHECKED
    + "SELECT count(*) AS total, count(*) FILTER (status = 'valid') AS valid, count(*) FILTER (status = 'corrupted') AS corrupted, count(*) FILTER (status = 'truncated') AS truncated, count(*) FILTER (status = 'suspicious') AS suspicious, count(*) FILTER (status <> 'valid') AS problems, round(sum(actual) FILTER (status = 'valid'), 6) AS valid_seconds, round(avg(actual) FILTER (status = 'valid'), 6) AS mean_seconds FROM c"
)
def integrity_summary(spark: SparkSession, d: str) -> DataFrame:
    s = integrity.summary(_checked(spark, d))
    return s.withColumn("valid_seconds", rounded(F.col("valid_seconds"), 6)).withColumn("mean_seconds", rounded(F.col("mean_seconds"), 6))


@query(_CHECKED + "SELECT p_partkey::VARCHAR AS id FROM c WHERE status <> 'valid' UNION SELECT ps FROM (SELECT s_suppkey::VARCHAR AS ps FROM supplier)")
def redownload_ids(spark: SparkSession, d: str) -> DataFrame:
    orphans = table(spark, d, "supplier").select(F.concat(F.lit("dl/"), F.col("s_suppkey").cast("string"), F.lit(".m4a")).alias("path"))
    return integrity.redownload_ids(_checked(spark, d), orphans)


@query(_CHECKED + "SELECT path, status AS reason FROM c WHERE status <> 'valid' UNION ALL SELECT 'dl/' || s_suppkey || '.m4a', 'orphan' FROM supplier")
def delete_plan(spark: SparkSession, d: str) -> DataFrame:
    orphans = table(spark, d, "supplier").select(F.concat(F.lit("dl/"), F.col("s_suppkey").cast("string"), F.lit(".m4a")).alias("path"))
    return integrity.delete_plan(_checked(spark, d), orphans)


@query(_CHECKED + "SELECT CASE status WHEN 'corrupted' THEN 1 WHEN 'truncated' THEN 2 ELSE 3 END AS rank, path, p_partkey::VARCHAR AS id, status FROM c WHERE status <> 'valid'")
def problem_list(spark: SparkSession, d: str) -> DataFrame:
    return integrity.problems(_checked(spark, d))


@query(
    """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'probe error: broken' WHEN p_size % 10 = 0 THEN 'Cannot parse duration' WHEN p_retailprice - 900.0 < 1.0 THEN 'Duration too short (< 1 second)' WHEN p_brand = 'Brand#3' THEN 'Cannot read format information' END AS error FROM part
"""
)
def probe_errors(spark: SparkSession, d: str) -> DataFrame:
    seconds = F.when(F.col("p_size") % 10 != 0, F.col("p_retailprice") - 900.0)
    return table(spark, d, "part").select("p_partkey", probe_error(F.col("p_type") != "PROMO", seconds, F.col("p_brand") != "Brand#3", F.lit("broken")).alias("error"))


@query("WITH b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT o_custkey FROM b) THEN false ELSE true END AS downloaded FROM orders")
def cleanup_flags(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").withColumn("downloaded", F.lit(True))
    bad = orders.filter(F.col("o_orderpriority") == "1-URGENT")
    return cat.clear_flags(orders, bad, "o_orderkey", "o_custkey").select("o_orderkey", "downloaded")


@query("WITH b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') SELECT count(*) AS flags_before, count(*) FILTER (o_custkey NOT IN (SELECT o_custkey FROM b)) AS flags_after FROM orders")
def cleanup_counts(spark: SparkSession, d: str) -> DataFrame:
    return integrity.flag_counts(table(spark, d, "orders").withColumn("downloaded", F.lit(True)), cleanup_flags(spark, d))


# --- metadata


def _built(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    path = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.concat(F.lit("dl/"), F.col("o_custkey").cast("string"), F.lit(".opus")))
    rows = o.select(F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderkey").cast("string")).alias("id"), (F.col("o_orderstatus") != "P").alias("downloaded"), path.alias("path"), F.col("o_orderpriority").alias("title"), F.lit(None).cast("string").alias("description"), _day("o_orderdate").alias("publish_date"))
    customers = table(spark, d, "customer").select(F.concat(F.lit("dl/"), F.col("c_custkey").cast("string"), F.lit(".opus")).alias("path"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("duration"))
    probed = customers.join(metadata.paths_to_probe(rows), "path", "left_semi")
    return metadata.build(rows, probed)


_BUILT = """
WITH b AS (
  SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderkey::VARCHAR END AS id, o_orderstatus <> 'P' AS downloaded, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 'dl/' || o_custkey || '.opus' END AS path,
    o_orderpriority AS title, strftime(o_orderdate, '%Y-%m-%d') AS publish_date, CASE WHEN c_acctbal > 0 THEN round_even(c_acctbal, 0)::BIGINT END AS secs
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey),
r AS (SELECT *, CASE WHEN id IS NULL THEN 'missing_id' WHEN NOT downloaded THEN 'not_downloaded' WHEN path IS NULL THEN 'missing_file' WHEN secs IS NULL THEN 'probe_failed' END AS reason FROM b)
"""


@query(_BUILT + "SELECT id, path AS audio, title, '' AS description, publish_date, printf('%02d:%02d:%02d', (secs // 3600)::INT, (secs % 3600 // 60)::INT, (secs % 60)::INT) AS duration, secs AS duration_seconds FROM r WHERE reason IS NULL")
def metadata_rows(spark: SparkSession, d: str) -> DataFrame:
    return metadata.kept(_built(spark, d))


@query(_BUILT + "SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason")
def metadata_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    return metadata.diagnostics(_built(spark, d))


@query(_BUILT + "SELECT path, id FROM r WHERE reason = 'probe_failed'")
def metadata_failed(spark: SparkSession, d: str) -> DataFrame:
    return metadata.failed_ids(_built(spark, d))


@query(
    """
WITH f AS (SELECT p_partkey, 'a/' || p_partkey AS path, p_size * 1000 AS size_bytes FROM part)
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, strftime(l_shipdate, '%Y') AS year, size_bytes::BIGINT AS size_bytes
FROM lineitem JOIN f ON p_partkey = l_partkey WHERE l_returnflag <> 'N' AND strftime(l_shipdate, '%Y') IN ('1996', '1998')
"""
)
def shard_samples(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "part").select(F.concat(F.lit("a/"), F.col("p_partkey").cast("string")).alias("path"), (F.col("p_size") * 1000).cast("bigint").alias("length"), F.lit("2024-01-01").cast("timestamp").alias("modificationTime"))
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    audio = F.when(F.col("l_returnflag") != "N", F.concat(F.lit(" a/"), F.col("l_partkey").cast("string"))).otherwise("  ")
    rows = table(spark, d, "lineitem").select(key.alias("id"), audio.alias("audio"), _day("l_shipdate").alias("publish_date"))
    return metadata.samples(rows, files, ["1996", "1998"]).select("id", "year", "size_bytes")


# --- publishing


@query("SELECT o_orderkey FROM orders WHERE starts_with(o_orderdate::VARCHAR, '1998')")
def year_prefix(spark: SparkSession, d: str) -> DataFrame:
    return publish.of_year(table(spark, d, "orders").select("o_orderkey", _day("o_orderdate").alias("publish_date")), 1998).select("o_orderkey")


@query("SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def expected_minus_available(spark: SparkSession, d: str) -> DataFrame:
    return publish.minus(table(spark, d, "orders"), table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")


@query("SELECT p_partkey AS l_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 40")
def available_minus_expected(spark: SparkSession, d: str) -> DataFrame:
    return publish.minus(table(spark, d, "part").withColumnRenamed("p_partkey", "l_partkey"), table(spark, d, "lineitem").filter("l_quantity > 40"), "l_partkey")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def present_rows(spark: SparkSession, d: str) -> DataFrame:
    return publish.present(table(spark, d, "orders"), table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey").select("o_orderkey", "o_totalprice")


@query(f"WITH f AS ({_FILES}) SELECT count(DISTINCT regexp_replace(path, '/[^/]*$', '')) AS parents FROM f")
def parent_guard(spark: SparkSession, d: str) -> DataFrame:
    return publish.parents(_order_files(spark, d))


@query(f"WITH f AS ({_FILES}) SELECT path, regexp_extract(path, '[^/]*$') AS name, regexp_extract(path, '([^/]*)\\.[^.]*$', 1) AS stem, regexp_replace(path, '/[^/]*$', '') AS parent FROM f")
def path_parts(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("path")
    return _order_files(spark, d).select(p, basename(p).alias("name"), stem(p).alias("stem"), parent(p).alias("parent"))


_MERGED = """
WITH old AS (SELECT c_custkey::VARCHAR AS id, 'old/' || c_custkey AS file_path, c_mktsegment AS title, NULL::VARCHAR AS publish_date, NULL::BIGINT AS secs FROM customer),
new AS (SELECT o_custkey::VARCHAR AS id, arg_max('pub/1998/' || o_orderkey || '.opus', o_orderkey) AS file_path, arg_max(o_orderpriority, o_orderkey) AS title, arg_max(strftime(o_orderdate, '%Y-%m-%d'), o_orderkey) AS publish_date, arg_max(floor(o_totalprice)::BIGINT, o_orderkey) AS secs FROM orders GROUP BY 1),
m AS (SELECT coalesce(new.id, old.id) AS id, coalesce(new.file_path, old.file_path) AS file_path, coalesce(new.title, old.title) AS title, coalesce(new.publish_date, '') AS publish_date, coalesce(new.secs, 0) AS duration_seconds FROM old FULL JOIN new ON old.id = new.id)
"""


def _merged(spark: SparkSession, d: str) -> DataFrame:
    old = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.concat(F.lit("old/"), F.col("c_custkey").cast("string")).alias("audio"), F.col("c_mktsegment").alias("title"), F.lit(None).cast("string").alias("publish_date"))
    rows = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("id"), F.concat(F.lit("x/"), F.col("o_orderkey").cast("string"), F.lit(".opus")).alias("path"), F.col("o_orderpriority").alias("title"), _day("o_orderdate").alias("publish_date"), F.col("o_totalprice").alias("duration_seconds"), F.col("o_orderkey").alias("_pos"))
    new = publish.manifest_rows(rows, "pub", 1998).withColumn("_pos", F.lit(None).cast("long")).limit(0).unionByName(publish.manifest_rows(rows.drop("_pos"), "pub", 1998).withColumn("_pos", F.regexp_extract("file_path", r"(\d+)\.opus", 1).cast("long")))
    return publish.normalise(publish.upsert(publish.normalise(old), new, order="_pos")).drop("_pos")


@query(_MERGED + "SELECT id, file_path, title, publish_date, duration_seconds FROM m")
def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d).select("id", "file_path", "title", "publish_date", "duration_seconds")


@query(_MERGED + "SELECT id, row_number() OVER (ORDER BY publish_date DESC, duration_seconds DESC, id) AS place FROM m")
def manifest_order(spark: SparkSession, d: str) -> DataFrame:
    m = _merged(spark, d)
    key = F.struct(-F.coalesce(F.unix_date(F.expr("try_to_date(publish_date)")), F.lit(-1 << 30)), -F.col("duration_seconds"), F.col("id"))
    return cat.row_number_by(m.withColumn("_o", key), "_o", "place").select("id", "place")


@query("SELECT doc_id, lang, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 3")
def preview_head(spark: SparkSession, d: str) -> DataFrame:
    """A preview of three rows; the limit is the operator's own."""
    return table(spark, d, "documents").select("doc_id", "lang", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(3)


@query("SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS n, count(DISTINCT o_custkey) AS ids FROM orders GROUP BY 1")
def years_grouped(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(year_of(_day("o_orderdate")).alias("year")).agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("ids"))


@query("SELECT s_suppkey, round(abs(s_acctbal - n * 100) / (n * 100) * 100, 6) AS percent FROM supplier JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey")
def percent_differences(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg((F.count("*") * 100).alias("expected"))
    return table(spark, d, "supplier").join(n, "s_suppkey").select("s_suppkey", rounded(percent_off(F.col("s_acctbal"), F.col("expected")), 6).alias("percent"))


# --- playlists


def _extractions(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    turn = F.col("turn").cast("string")
    url = F.concat_ws("/", F.lit("https://example.com"), F.col("conv_id").cast("string"), turn)
    got = {"title": F.concat(F.lit(" "), F.col("role"), F.lit(" ")), "duration": turn, "id": F.when(F.col("role") == "system", F.col("conv_id").cast("string")), "url": F.when(F.col("role") == "user", url), "webpage_url": F.when(F.col("role") == "assistant", url), "_type": F.when(F.col("role") == "user", F.lit("url"))}
    entry = F.struct(*[got.get(f.name, F.lit(None)).cast("string").alias(f.name) for f in ENTRY.fields])
    lists = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("turn"), F.col("role"), F.when(F.length("text") > 0, entry).alias("e")))).alias("l"))
    own = [F.lit(None).cast("string").alias(f.name) for f in ENTRY.fields]
    return lists.select("conv_id", *own, F.transform("l", lambda x: x["e"]).alias("entries"))


@query(
    """
WITH t AS (SELECT DISTINCT ON (conv_id, turn, role, text) * FROM conversations),
e AS (SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) - 1)::INT AS pos, turn, role, text FROM conversations)
SELECT conv_id, CASE role WHEN 'system' THEN 'https://www.youtube.com/watch?v=' || conv_id ELSE 'https://example.com/' || conv_id || '/' || turn END AS url,
  CASE WHEN role = 'user' AND turn = 0 THEN 'full' ELSE role END AS title, turn::BIGINT AS duration_seconds, count(*) AS n
FROM e WHERE length(text) > 0 GROUP BY ALL
"""
)
def playlist_flatten(spark: SparkSession, d: str) -> DataFrame:
    flat = playlist.entries(_extractions(spark, d), ["conv_id"])
    first = table(spark, d, "conversations").filter("role = 'user' AND turn = 0").select(F.concat_ws("/", F.lit("https://example.com"), F.col("conv_id").cast("string"), F.lit("0")).alias("url")).distinct()
    got = {"webpage_url": F.col("url"), "title": F.lit("full"), "duration": F.lit("0.9")}
    full = first.select("url", F.struct(*[got.get(f.name, F.lit(None)).cast("string").alias(f.name) for f in ENTRY.fields]).alias("full"))
    rows = playlist.rows(playlist.resolve_stubs(flat, full), ["conv_id"])
    return rows.groupBy("conv_id", "url", "title", "duration_seconds").agg(F.count("*").alias("n"))


# --- subtitles


def _cues(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as cues: a turn begins at its number times 8 seconds and lasts as long as it has characters, 5 at most."""
    start = F.col("turn").cast("double") * 8
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")
    return table(spark, d, "conversations").groupBy("conv_id", "turn").agg(F.min("text").alias("text")).select("conv_id", F.col("turn").alias("idx"), start.alias("start"), (start + F.least(F.length(text), F.lit(5))).alias("end"), text.alias("text"))


_CUES = "SELECT conv_id, turn AS idx, turn * 8 AS s, turn * 8 + least(length(t), 5) AS e, t AS text FROM (SELECT conv_id, turn, regexp_replace(coalesce(min(text), ''), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g') AS t FROM conversations GROUP BY 1, 2)"
_TIME = "printf('%02d:%02d:%02d.000', ({0} // 3600)::INT, ({0} % 3600 // 60)::INT, ({0} % 60)::INT)"


@query(
    f"""
WITH c AS ({_CUES}), n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY idx) AS i FROM c)
SELECT conv_id, md5('WEBVTT' || chr(10) || chr(10) || string_agg(i || chr(10) || {_TIME.format("s")} || ' --> ' || {_TIME.format("e")} || chr(10) || trim(text) || chr(10) || chr(10), '' ORDER BY i)) AS vtt FROM n GROUP BY conv_id
"""
)
def vtt_render(spark: SparkSession, d: str) -> DataFrame:
    return subtitle.render(_cues(spark, d), "conv_id").withColumn("vtt", F.md5("vtt"))


@query(f"WITH c AS ({_CUES}) SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY idx)::INT AS idx, s::DOUBLE AS start, e::DOUBLE AS end, trim(text) AS text FROM c WHERE trim(text) <> ''")
def vtt_parse(spark: SparkSession, d: str) -> DataFrame:
    """What is read back of the rendered documents: every cue that has text."""
    return subtitle.parse(subtitle.render(_cues(spark, d), "conv_id"), "conv_id")


@query(
    f"""
WITH c AS ({_CUES}), n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY idx) AS i FROM c),
k AS (SELECT *, row_number() OVER (ORDER BY conv_id, i) AS g FROM n WHERE trim(text) <> '' AND e > s)
SELECT 'clips/' || printf('%s_%04d.opus', conv_id::VARCHAR, i) AS audio, printf('talk-%04d', g) AS id, (e - s)::DOUBLE AS duration, 'speech' AS genre, 'all' AS album, trim(text) AS text FROM k
"""
)
def cue_clips(spark: SparkSession, d: str) -> DataFrame:
    return subtitle.clips(subtitle.cut_plan(_cues(spark, d), "conv_id"), "conv_id", "talk", "speech", "all", "clips")


@query("SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F'")
def missing_subtitles(spark: SparkSession, d: str) -> DataFrame:
    vtt = table(spark, d, "lineitem").filter("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return subtitle.pair_audio(table(spark, d, "orders").select("o_orderkey"), vtt, "o_orderkey")[1]


@query(f"WITH c AS ({_CUES}) SELECT c.conv_id, c.idx, CASE WHEN c.idx % 2 = 1 THEN c.text ELSE '' END AS text FROM c")
def attach_results(spark: SparkSession, d: str) -> DataFrame:
    cues = _cues(spark, d)
    return subtitle.attach(cues.filter("idx % 2 = 1"), cues.drop("text"), ["conv_id", "idx"]).select("conv_id", "idx", "text")
