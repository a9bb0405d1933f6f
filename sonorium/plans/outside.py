"""Round trips through files and services: what sinks write is read back, what adapters do is held against the tables.

Everything is written to a folder of its own below the shared one. Services are stand-ins over the test tables.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..adapters import media as mediasvc
from ..adapters import retry, services
from ..functions import durations as du
from ..functions import texts, values
from ..operators import catalog as cat
from ..operators import packing, publish, subtitle
from ..schemas import MANIFEST
from ..shared import shared_dir, spread, written
from ..sources import csvs, media, tars, vtts
from ..streaming import progress
from .registry import query, table


def folder(spark: SparkSession, name: str) -> str:
    """A new folder, as a path that Python can open."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def _files(rows: DataFrame, root: str) -> DataFrame:
    """(path, bytes): a file of so many bytes for each (name, bytes) row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            paths = [os.path.join(root, n) for n in f["name"]]
            for p, n in zip(paths, f["bytes"]):
                os.makedirs(os.path.dirname(p), exist_ok=True)
                with open(p, "wb") as out:
                    out.write(b"x" * int(n))
            yield pd.DataFrame({"path": paths, "bytes": f["bytes"]})

    return spread(rows.select("name", "bytes")).mapInPandas(run, "path string, bytes long")


def _waves(rows: DataFrame, root: str, rate: int = 16_000, channels: int = 2) -> DataFrame:
    """(path, frames): a silent wave file of so many frames for each (name, frames) row.

    Its samples are a hole where the file system has holes: they read as zeros and take no disk.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(root, exist_ok=True)
        for f in frames:
            paths = [os.path.join(root, n) for n in f["name"]]
            for p, n in zip(paths, f["frames"]):
                size = 2 * channels * int(n)
                with open(p, "wb") as out:
                    out.write(struct.pack("<4sI8sIHHIIHH4sI", b"RIFF", 36 + size, b"WAVEfmt ", 16, 1, channels, rate, 2 * channels * rate, 2 * channels, 16, b"data", size))
                    out.truncate(44 + size)
            yield pd.DataFrame({"path": paths, "frames": f["frames"]})

    return spread(rows.select("name", "frames")).mapInPandas(run, "path string, frames long")


_NAME = "CASE WHEN s_suppkey % 3 = 0 THEN s_name || ', \"so\"' || chr(10) || 'called' ELSE s_name END"


def _suppliers(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("s_suppkey") % 3 == 0, F.concat("s_name", F.lit(', "so"\ncalled'))).otherwise(F.col("s_name"))
    return table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), name.alias("title"), F.when(F.col("s_suppkey") % 5 != 0, F.lit("x")).alias("note"))


# --- tables in CSV


@query(f"SELECT s_suppkey::VARCHAR AS id, {_NAME} AS title, CASE WHEN s_suppkey % 5 <> 0 THEN 'x' END AS note FROM supplier")
def csv_catalog(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "csv")
    csvs.write(_suppliers(spark, d), path)
    return csvs.read(spark, path)


@query("SELECT s_suppkey::BIGINT AS id, s_acctbal::DOUBLE AS balance, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey % 3 = 0 END AS flag, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS title FROM supplier")
def csv_catalog_typed(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "typed")
    k = F.col("s_suppkey")
    csvs.write(table(spark, d, "supplier").select(k.alias("id"), F.col("s_acctbal").cast("string").alias("balance"), F.when(k % 2 == 0, (k % 3 == 0).cast("string")).otherwise("NaN").alias("flag"), F.when(k % 4 != 0, F.col("s_name")).otherwise("NA").alias("title")), path)
    return csvs.read_typed(spark, path)


@query(f"SELECT s_suppkey::VARCHAR AS id, {_NAME} AS title, (SELECT count(*) FROM supplier) AS written FROM supplier")
def csv_playlist(spark: SparkSession, d: str) -> DataFrame:
    path, none = folder(spark, "playlist"), folder(spark, "none")
    rows = _suppliers(spark, d).select("id", "title")
    if csvs.write_unless_empty(rows.limit(0), none) or os.path.exists(none):
        raise AssertionError("a file without rows")
    n = csvs.write_unless_empty(rows, path, single=True)
    return csvs.read(spark, path).withColumn("written", F.lit(n).cast("long"))


@query("SELECT id, completed, changed, backed FROM (SELECT s_suppkey::VARCHAR AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS completed), (SELECT count(*) FILTER (s_suppkey % 2 = 0) AS changed, count(*) AS backed FROM supplier)".replace("AS completed)", "AS completed FROM supplier)"))
def csv_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """A table is backed up and rewritten where rows change, and left as it is where none do."""
    path = folder(spark, "rewrite")
    csvs.write(_suppliers(spark, d).select("id", F.lit("FALSE").alias("completed")), path)
    now = csvs.progress(csvs.read(spark, path))
    csvs.backup(now, path)
    even = F.col("id").cast("int") % 2 == 0
    marked = now.withColumn("changed", even & (F.col("completed") == "FALSE")).withColumn("completed", F.when(even, "TRUE").otherwise(F.col("completed")))
    n = csvs.replace_if_changed(marked, "changed", path)
    if csvs.replace_if_changed(csvs.read(spark, path).withColumn("changed", F.lit(False)), "changed", path):
        raise AssertionError("nothing has changed")
    saved = csvs.read(spark, path + ".bak").filter("completed = 'FALSE'").count()
    return csvs.read(spark, path).withColumns({"changed": F.lit(n).cast("long"), "backed": F.lit(saved).cast("long")})


@query("SELECT 'o' || o_custkey AS id, max(o_orderdate::TIMESTAMP) AS at, CASE WHEN arg_max(o_orderkey % 2, (o_orderdate, o_orderkey % 2)) = 1 THEN 'TRUE' ELSE 'FALSE' END AS completed FROM orders GROUP BY o_custkey")
def progress_log(spark: SparkSession, d: str) -> DataFrame:
    """Outcomes appended in two goes; the latest of each key counts."""
    path = folder(spark, "log")
    rows = table(spark, d, "orders").select(F.concat(F.lit("o"), "o_custkey").alias("id"), F.when(F.col("o_orderkey") % 2 == 1, "TRUE").otherwise("FALSE").alias("completed"), F.col("o_orderdate").cast("timestamp").alias("at"), "o_orderkey")
    progress.append(rows.filter("o_orderkey % 3 = 0"), path)
    progress.append(rows.filter("o_orderkey % 3 <> 0"), path)
    return progress.latest(spark.read.schema(progress.LOG).parquet(path))


@query("SELECT s_suppkey::VARCHAR AS id, CASE WHEN s_suppkey % 3 = 0 THEN 'FALSE' ELSE 'TRUE' END AS completed, (SELECT count(*) FROM supplier WHERE s_suppkey % 3 = 0) AS failures FROM supplier")
def blank_url_rows(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select(k.cast("string").alias("id"), F.when(k % 6 == 0, "  ").when(k % 3 != 0, F.concat(F.lit("u"), k)).alias("url"), F.lit("TRUE").alias("completed"))
    marked, failures = cat.skip_blank_urls(rows)
    return marked.select("id", "completed").crossJoin(F.broadcast(failures))


@query("SELECT o_orderkey % 4 AS jobs, CASE o_orderkey % 4 WHEN 0 THEN 8 WHEN 3 THEN 8 ELSE o_orderkey % 4 END::INT AS workers, count(*) AS n FROM orders GROUP BY 1, 2")
def worker_counts(spark: SparkSession, d: str) -> DataFrame:
    jobs = F.col("o_orderkey") % 4
    wish = F.when(jobs < 3, jobs)
    return table(spark, d, "orders").groupBy(jobs.alias("jobs"), values.worker_count(wish, 8).alias("workers")).agg(F.count("*").alias("n"))


# --- files


@query("SELECT 's' || s_suppkey AS id, s_suppkey % 50 + 1 AS length, s_suppkey % 2 = 0 AS deep FROM supplier WHERE s_suppkey % 3 < 2 ORDER BY 1")
def opus_listing(spark: SparkSession, d: str) -> DataFrame:
    root = folder(spark, "opus")
    k = F.col("s_suppkey")
    name = F.concat(F.when(k % 2 == 0, "in/deep/").otherwise(""), F.lit("s"), k, F.when(k % 3 < 2, ".opus").otherwise(".m4a"))
    _files(table(spark, d, "supplier").select(name.alias("name"), (k % 50 + 1).alias("bytes")), root).count()
    return media.files(spark, root).select("id", F.col("length").cast("long"), F.col("path").contains("/deep/").alias("deep"))


@query("SELECT 's' || s_suppkey AS id, (s_suppkey % 50 + 1)::BIGINT AS length FROM supplier WHERE s_suppkey % 4 < 3")
def media_listing(spark: SparkSession, d: str) -> DataFrame:
    root = folder(spark, "media")
    k = F.col("s_suppkey")
    name = F.concat(F.lit("s"), k, F.element_at(F.array(F.lit(".MP3"), F.lit(".webm"), F.lit(".Opus"), F.lit(".txt")), (k % 4).cast("int") + 1))
    _files(table(spark, d, "supplier").select(name.alias("name"), (k % 50 + 1).alias("bytes")), root).count()
    if media.media(spark, root + "-missing").count():
        raise AssertionError("a folder that isn't there")
    return media.media(spark, root).select("id", "length")


@query("SELECT 'f' || doc_id AS file, row_number() OVER (PARTITION BY doc_id ORDER BY i)::INT AS idx, (i * 2)::DOUBLE AS start, (i * 2 + 1.5)::DOUBLE AS \"end\", lang || ' cue ' || i AS text FROM documents, range(0, 3) t(i)")
def vtt_files(spark: SparkSession, d: str) -> DataFrame:
    root = folder(spark, "vtt")
    cues = table(spark, d, "documents").select(F.concat(F.lit("f"), "doc_id").alias("file"), "lang", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("i"))
    cues = cues.select("file", F.col("i").alias("idx"), (F.col("i") * 2.0).alias("start"), (F.col("i") * 2 + 1.5).alias("end"), F.concat("lang", F.lit(" cue "), "i").alias("text"))
    vtts.write_documents(subtitle.render(cues, "file"), root).count()
    return vtts.read_cues(spark, root)


def _shards(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """Supplier samples with sizes; their files, too, if there is a folder for them."""
    k = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select(F.concat(F.lit("s"), k).alias("id"), F.concat(F.lit("s"), k, F.lit(".opus")).alias("audio"), F.concat(F.lit(" t"), k % 7).alias("title"), F.concat(F.lit("20"), F.lpad((k % 3).cast("string"), 2, "0"), F.lit("-01-01")).alias("publish_date"), F.concat(F.lit("20"), F.lpad((k % 3).cast("string"), 2, "0")).alias("year"), (k % 90 + 1).alias("size_bytes"))
    path = F.concat(F.lit((root or "") + "/"), "audio")
    return rows.withColumns({"path": path, "mtime": F.lit(1_000_000).cast("long")})


_SHARDS = """
WITH RECURSIVE o AS (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY publish_date, trim(title), id, audio) AS rn
  FROM (SELECT 's' || s_suppkey AS id, 's' || s_suppkey || '.opus' AS audio, ' t' || s_suppkey % 7 AS title, '20' || lpad((s_suppkey % 3)::VARCHAR, 2, '0') AS year, '20' || lpad((s_suppkey % 3)::VARCHAR, 2, '0') || '-01-01' AS publish_date, s_suppkey % 90 + 1 AS size FROM supplier)
),
p AS (
  SELECT year, rn, 0 AS shard, 1 AS cnt, size AS bytes FROM o WHERE rn = 1
  UNION ALL
  SELECT o.year, o.rn, CASE WHEN p.cnt >= 20 OR p.bytes + o.size > 800 THEN p.shard + 1 ELSE p.shard END, CASE WHEN p.cnt >= 20 OR p.bytes + o.size > 800 THEN 1 ELSE p.cnt + 1 END, CASE WHEN p.cnt >= 20 OR p.bytes + o.size > 800 THEN o.size ELSE p.bytes + o.size END
  FROM p JOIN o ON o.year = p.year AND o.rn = p.rn + 1
),
m AS (
  SELECT o.*, p.shard, '{"id": "' || id || '", "audio": "' || printf('x-%s-%06d.opus', o.year, o.rn - 1) || '", "title": "' || title || '", "publish_date": "' || publish_date || '"}' AS payload
  FROM o JOIN p ON p.year = o.year AND p.rn = o.rn
)
"""


@query(_SHARDS + "SELECT year, rn - 1 AS place, id FROM m")
def sample_order(spark: SparkSession, d: str) -> DataFrame:
    return packing.plan_shards(_shards(spark, d), "x", 20, 800).select("year", F.col("sample_index").alias("place"), "id")


@query(_SHARDS + "SELECT year, shard, count(*) AS samples, sum(size + strlen(payload))::BIGINT AS bytes FROM m GROUP BY year, shard")
def shard_bytes(spark: SparkSession, d: str) -> DataFrame:
    return packing.shard_sizes(packing.plan_shards(_shards(spark, d), "x", 20, 800))


@query(_SHARDS + "SELECT printf('x-%s-%05d.tar', year, shard) AS archive, printf('x-%s-%06d', year, rn - 1) AS key, payload AS json, size::BIGINT AS bytes FROM m")
def tar_shards(spark: SparkSession, d: str) -> DataFrame:
    """Archives written and read back through the data source, sample by sample."""
    root, out = folder(spark, "samples"), folder(spark, "tars")
    samples = _shards(spark, d, root)
    _files(samples.select(F.col("audio").alias("name"), F.col("size_bytes").alias("bytes")), root).count()
    tars.write_shards(packing.plan_shards(samples, "x", 20, 800), out).count()
    spark.dataSource.register(tars.TarSource)
    return spark.read.format("samples_tar").load(out + "/*.tar").select(F.element_at(F.split("archive", "/"), -1).alias("archive"), "key", "json", F.octet_length("audio").cast("long").alias("bytes"))


@query("SELECT 's' || s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN 'gone' WHEN s_suppkey % 2 = 0 THEN '2020' ELSE '2021' END AS place FROM supplier WHERE s_suppkey % 3 <> 0")
def moved_and_deleted(spark: SparkSession, d: str) -> DataFrame:
    """Files are moved to a year's folder or deleted, each plan run dry first and then twice."""
    root = folder(spark, "acts")
    k = F.col("s_suppkey")
    made = _files(table(spark, d, "supplier").select(F.concat(F.lit("s"), k, F.lit(".opus")).alias("name"), F.lit(1).alias("bytes")), root)
    made.count()
    keyed = media.files(spark, root).select("path", "id", F.substring("id", 2, 20).cast("int").alias("k"))
    plan = keyed.select("path", "k", F.concat(F.lit(root + "/"), F.when(F.col("k") % 2 == 0, "2020").otherwise("2021"), F.lit("/"), "id", F.lit(".opus")).alias("target"))
    for act, some in ((services.remove, "k % 3 = 0"), (services.move, "k % 3 <> 0")):
        services.execute(plan.filter(some), act)
        services.execute(plan.filter(some), act, dry_run=False)
    if services.execute(plan.filter("k % 3 <> 0"), services.move, dry_run=False)[1]:
        raise AssertionError("a move that was done counts as done")
    return media.files(spark, root).select("id", F.element_at(F.split("path", "/"), -2).alias("place"))


@query("SELECT 's' || s_suppkey || '.opus' AS name, s_suppkey % 9 + 1 AS length FROM supplier")
def hub_staging(spark: SparkSession, d: str) -> DataFrame:
    root, hub = folder(spark, "source"), folder(spark, "hub")
    k = F.col("s_suppkey")
    made = _files(table(spark, d, "supplier").select(F.concat(F.lit("s"), k, F.lit(".opus")).alias("name"), (k % 9 + 1).alias("bytes")), root)
    plan = publish.staging_plan(made, "cfg", 2024).withColumn("target", F.concat(F.lit(hub + "/"), "target"))
    services.execute(plan, services.stage, dry_run=False)
    return media.files(spark, hub).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").cast("long"))


@query("SELECT s_suppkey::VARCHAR AS id, s_name AS title, n AS uploaded, false AS left_over FROM supplier, (SELECT count(*) AS n FROM supplier)")
def hub_manifest(spark: SparkSession, d: str) -> DataFrame:
    """A manifest is published, an obsolete file goes, and what was published is fetched again."""
    hub = services.FolderHub(folder(spark, "manifest"))
    if services.previous_manifest(spark, hub, "metadata.csv").columns != MANIFEST.names:
        raise AssertionError("no manifest is an empty one")
    hub.put("old.csv", b"1")
    n = services.publish_manifest(table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("title")), hub, "metadata.csv", ["old.csv", "never.csv"])
    return services.previous_manifest(spark, hub, "metadata.csv").withColumns({"uploaded": F.lit(n).cast("long"), "left_over": F.lit(hub.fetch("old.csv") is not None)})


# --- services


@query("SELECT s_suppkey::VARCHAR AS id, s_name AS title FROM supplier WHERE s_suppkey % 2 = 0")
def video_details(spark: SparkSession, d: str) -> DataFrame:
    """Ids page by page, details in batches; those that the service doesn't know are left out."""
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("title")).collect()
    api = services.MemoryVideoApi({"@all": "UU1"}, {"UU1": [r["id"] for r in rows]}, {r["id"]: r.asDict() for r in rows if int(r["id"]) % 2 == 0})
    ids = spark.createDataFrame([(i,) for i in services.list_ids(api, "@all")], "id string")
    return services.lookup(ids, api, "id string, title string")


@query("SELECT n_nationkey AS nation, s_suppkey::VARCHAR AS id, n_nationkey % 2 = 1 AS fell_back FROM nation JOIN supplier ON s_nationkey = n_nationkey")
def playlist_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Playlists of nations: an odd one has no entries of its own and falls back to its uploads; without either it is an error."""
    pairs = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.collect_list(F.col("s_suppkey").cast("string")).alias("ids")).collect()
    ids = {r["s_nationkey"]: r["ids"] for r in pairs}
    nations = [r["n_nationkey"] for r in table(spark, d, "nation").select("n_nationkey").collect()]

    class Channels:
        def extract(self, url: str) -> dict | None:
            kind, key = url.split(":")
            return {"n": int(key), "entries": ids.get(int(key), []) if (kind == "up") == (int(key) % 2 == 1) else []}

    out = []
    for n in nations:
        said: list[str] = []
        try:
            found = services.fetch_playlist(Channels(), f"list:{n}", lambda info: f"up:{info['n']}", lambda info: info["entries"], status=said.append)
        except ValueError:
            continue
        out += [(n, i, bool(said)) for i in found]
    return spark.createDataFrame(out, "nation long, id string, fell_back boolean").withColumn("nation", F.col("nation").cast(table(spark, d, "nation").schema["n_nationkey"].dataType))


@query("SELECT 's' || s_suppkey AS id, s_suppkey % 4 <> 3 AS downloaded, s_suppkey % 4 = 0 AS reused, CASE s_suppkey % 4 WHEN 3 THEN NULL WHEN 1 THEN 'm4a' ELSE 'opus' END AS extension FROM supplier")
def downloads(spark: SparkSession, d: str) -> DataFrame:
    """Some files are there, some come with another extension, some don't come."""
    root = folder(spark, "downloads")
    k = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select(F.concat(F.lit("s"), k).alias("id"), k.cast("string").alias("url"))
    _files(rows.filter("url % 4 = 0").select(F.concat("id", F.lit(".opus")).alias("name"), F.lit(1).alias("bytes")), root).count()

    class Service:
        def download(self, url: str, target: str, rate: int) -> bool:
            if int(url) % 4 == 3:
                raise OSError("refused")
            with open(target.replace(".opus", ".m4a") if int(url) % 4 == 1 else target, "wb") as f:
                f.write(b"x" * rate)
            return True

    got = written(mediasvc.download(rows, Service(), root), "downloaded")  # once: asked again, all would be there
    return got.select("id", "downloaded", "reused", F.element_at(F.split("path", r"\."), -1).alias("extension"))


@query("SELECT 's' || s_suppkey AS id, s_suppkey % 5 <> 4 AS ok, CASE WHEN s_suppkey % 5 <> 4 THEN s_suppkey % 40 / 4.0 END AS duration FROM supplier")
def wave_probe(spark: SparkSession, d: str) -> DataFrame:
    root = folder(spark, "probe")
    k = F.col("s_suppkey")
    rows = table(spark, d, "supplier")
    good = _waves(rows.filter("s_suppkey % 5 <> 4").select(F.concat(F.lit("s"), k, F.lit(".wav")).alias("name"), (k % 40 * 4000).alias("frames")), root)
    bad = _files(rows.filter("s_suppkey % 5 = 4").select(F.concat(F.lit("s"), k, F.lit(".wav")).alias("name"), F.lit(3).alias("bytes")), root)
    paths = good.select("path").unionByName(bad.select("path"))
    return services.probe(paths, mediasvc.WaveProbe()).select(texts.stem(F.col("path")).alias("id"), "ok", "duration")


@query("SELECT 's' || s_suppkey || '_' || i || '.wav' AS clip_name, CASE WHEN i = 0 THEN 'reused' WHEN s_suppkey % 2 = 0 THEN 'copy' ELSE 'libopus' END AS made, 0.25 AS duration FROM supplier, range(0, 3) t(i)")
def cut_and_extract(spark: SparkSession, d: str) -> DataFrame:
    """Files are brought to one channel and cut: by copying, else with the fallback codec; clips that are there stay."""
    root, mono, clips = folder(spark, "stereo"), folder(spark, "mono"), folder(spark, "clips")
    k = F.col("s_suppkey")
    _waves(table(spark, d, "supplier").select(F.concat(F.lit("s"), k, F.lit(".wav")).alias("name"), F.lit(48_000).alias("frames")), root, 48_000).count()
    codec = mediasvc.WaveCodec(lambda path: int(os.path.basename(path)[1:-4]) % 2 == 0)
    mediasvc.extract(media.files(spark, root, "*.wav").select("path"), codec, mono).count()
    plan = media.files(spark, mono, "*.wav").select("path", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("i"), "id").select("path", F.concat("id", F.lit("_"), "i", F.lit(".wav")).alias("clip_name"), (F.col("i") * 0.25).alias("start"), F.lit(0.25).alias("duration"), "i")
    mediasvc.cut_clips(plan.filter("i = 0"), codec, clips).count()
    made = written(mediasvc.cut_clips(plan, codec, clips), "made")  # once: cut again, all would be there
    length = services.probe(media.files(spark, clips, "*.wav").select("path"), mediasvc.WaveProbe()).select(F.element_at(F.split("path", "/"), -1).alias("clip_name"), "duration")
    return made.join(length, "clip_name")


@query("SELECT 'd' || doc_id AS file, i::INT AS idx, CASE WHEN (doc_id + i) % 7 = 6 THEN '' ELSE lang || ' ' || i END AS text FROM documents, range(0, 2) t(i)")
def transcripts(spark: SparkSession, d: str) -> DataFrame:
    """A recogniser that is busy at first, sometimes refuses for good, and is asked from a pool of threads; order is restored by index."""
    rows = table(spark, d, "documents").select(F.concat(F.lit("d"), "doc_id").alias("file"), F.explode(F.sequence(F.lit(0), F.lit(1))).alias("idx"), "lang", "doc_id")

    def client(row: dict, **_: object) -> tuple[int, str]:
        if (row["doc_id"] + row["idx"]) % 7 == 6:
            return 400, ""
        tried = client.__dict__.setdefault((row["file"], row["idx"]).__repr__(), [])
        tried.append(1)
        return (503, "") if len(tried) == 1 and row["doc_id"] % 5 == 0 else (200, f" {row['lang']} {row['idx']} ")

    said = services.transcribe(rows, ["file", "idx"], client, max_rpm=1_000_000, tasks=4, sleep=_no_wait)
    return subtitle.attach(said, rows.select("file", "idx"), ["file", "idx"])


def _no_wait(_: float) -> None:
    """Tests don't wait."""


@query("SELECT 'd' || doc_id AS file, i::DOUBLE AS start, i + 0.5::DOUBLE AS \"end\" FROM documents, range(0, 3) t(i) WHERE doc_id % 4 <> 0 AND i < doc_id % 4")
def speech(spark: SparkSession, d: str) -> DataFrame:
    """A detector that fails on every fourth file, which then has no speech."""

    def detector(path: str) -> list[tuple[float, float]]:
        n = int(path[1:]) % 4
        if n == 0:
            raise RuntimeError("no model")
        return [(i, i + 0.5) for i in range(n)]

    return services.voice_activity(table(spark, d, "documents").select(F.concat(F.lit("d"), "doc_id").alias("path")), detector)


@query("SELECT 'SECRET' || count(*) AS key, 1 AS missing FROM supplier")
def api_settings(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "supplier").count()
    key = services.api_key("TOKEN", {"TOKEN": f" SECRET{n} "})
    return spark.createDataFrame([(key, len(services.missing_tools("no-such-tool")))], "key string, missing int")


@query("SELECT o_orderkey, least(60.0, 5.0 * power(2, o_orderkey % 6)) AS wait, CASE WHEN o_orderkey % 6 < 5 THEN o_orderkey % 6 + 1 END::INT AS attempts FROM orders")
def extraction_attempts(spark: SparkSession, d: str) -> DataFrame:
    """How often a source that fails so many times is asked, null after the last attempt, beside the wait that follows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for k in f["o_orderkey"]:
                asked: list[int] = []

                def call(k: int = k, asked: list[int] = asked) -> int | None:
                    asked.append(1)
                    return len(asked) if len(asked) > k % 6 else None

                out.append(retry.extract(call, allow_failure=True, sleep=_no_wait))
            yield pd.DataFrame({"o_orderkey": f["o_orderkey"], "attempts": pd.array(out, "Int32")})

    rows = table(spark, d, "orders").select(F.col("o_orderkey").cast("long"))
    return rows.mapInPandas(run, "o_orderkey long, attempts int").withColumn("wait", retry.backoff_column(F.col("o_orderkey") % 6 + 1, 5.0, 60.0))


# --- expressions


@query("SELECT s_suppkey, place FROM (SELECT s_suppkey, row_number() OVER (ORDER BY date DESC NULLS LAST, seconds DESC NULLS LAST, s_suppkey) AS place FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 4 > 0 THEN '2024-0' || s_suppkey % 4 END AS date, CASE WHEN s_suppkey % 5 > 0 THEN s_suppkey % 5 END AS seconds FROM supplier))")
def newest_order(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select("s_suppkey", F.when(k % 4 > 0, F.concat(F.lit("2024-0"), k % 4)).alias("publish_date"), F.when(k % 5 > 0, k % 5).alias("duration_seconds"))
    return cat.row_number_by(publish.newest(rows, "s_suppkey").withColumn("_at", F.monotonically_increasing_id()), "_at", "place").select("s_suppkey", "place")


@query("SELECT count(*) FILTER (doc_id % 3 > 0) AS resolved, count(*) FILTER (doc_id % 3 = 0) AS unresolved, round(sum(n_chars * 1000000::BIGINT) / 1024.0 ^ 3, 2)::DOUBLE AS gb FROM documents")
def unresolved_paths(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").withColumn("path", F.when(F.col("doc_id") % 3 > 0, F.lit("p")))
    kept, counts = publish.drop_unresolved(rows)
    total = rows.agg(F.sum(F.col("n_chars") * F.lit(1_000_000).cast("long")).alias("bytes"))
    return counts.crossJoin(total).select("resolved", "unresolved", values.gigabytes(F.col("bytes")).alias("gb"))


@query("SELECT o_orderkey, o_orderkey % 90000 / 8.0 AS seconds, printf('%.3f', greatest(o_orderkey % 90000 / 8.0 - 3, 0)) AS rest FROM orders")
def cue_times(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("o_orderkey") % 90000 / 8.0
    whole = F.floor(s).cast("long")
    text = F.concat(du.hms(whole), F.when(F.col("o_orderkey") % 2 == 0, ",").otherwise("."), F.lpad(F.round((s - whole) * 1000).cast("int").cast("string"), 3, "0"))
    back = du.cue_seconds(text)
    return table(spark, d, "orders").select("o_orderkey", back.alias("seconds"), values.segment_length_text(F.lit(3.0), back).alias("rest"))


@query("SELECT doc_id, 1.5::DOUBLE AS start, replace(replace(lang, 'e', 'E'), 'En', 'xx') AS text FROM documents")
def corrected_cues(spark: SparkSession, d: str) -> DataFrame:
    cues = table(spark, d, "documents").select("doc_id", F.lit(1.5).alias("start"), F.col("lang").alias("text"))
    return subtitle.correct_cues(cues, [("e", "E"), ("(E)n", "xx")])


@query("SELECT vec_id, round(list_sum(list_transform(embedding[1:4]::DOUBLE[], lambda x: (x + x * 3) / 2)), 6) AS total, 4::INT AS n FROM embeddings")
def channel_downmix(spark: SparkSession, d: str) -> DataFrame:
    """Two channels, the second three times as loud, brought to one and cut to half a second at 8 samples a second."""
    one = F.col("embedding").cast("array<double>")
    mixed = values.head_seconds(values.downmix(F.array(one, F.transform(one, lambda x: x * 3.0))), 8, 0.5)
    return table(spark, d, "embeddings").select("vec_id", values.rounded(F.aggregate(mixed, F.lit(0.0), lambda a, x: a + x), 6).alias("total"), F.size(mixed).alias("n"))


@query("SELECT doc_id, replace(replace(replace(t, chr(13) || chr(10), chr(92) || 'n'), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'n') AS line FROM (SELECT doc_id, replace(text, ' the ', chr(13) || chr(10)) AS t FROM documents)")
def one_line_texts(spark: SparkSession, d: str) -> DataFrame:
    t = F.replace(F.col("text"), F.lit(" the "), F.lit("\r\n"))
    return table(spark, d, "documents").select("doc_id", texts.escape_newlines(t).alias("line"))
