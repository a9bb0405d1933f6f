"""Sources, sinks and adapters with in-memory or temporary stand-ins."""

from __future__ import annotations

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sonorium.adapters import retry, services
from sonorium.operators import packing
from sonorium.schemas import CATALOG_PROGRESS
from sonorium.sources import csvs, media, tars, vtts
from sonorium.streaming import progress


def test_csv_round_trip(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_bytes("﻿url,title,description\r\nu,\"say \"\"hi\"\"\",\"two\nlines\"\r\nv,NA,\r\n".encode())
    df = csvs.read(spark, str(path))
    assert [tuple(r) for r in df.collect()] == [("u", 'say "hi"', "two\nlines"), ("v", "NA", None)]
    assert [r["row_index"] for r in csvs.with_position(df).collect()] == [0, 1]
    csvs.write(df, str(tmp_path / "out"), single=True)
    assert sorted(map(tuple, csvs.read(spark, str(tmp_path / "out")).collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    assert set(csvs.progress(df).select("completed").collect()) == {("FALSE",)}
    csvs.replace(df.limit(1), str(tmp_path / "out"))
    assert csvs.read(spark, str(tmp_path / "out")).count() == 1
    csvs.backup(df, str(tmp_path / "out"))
    assert (tmp_path / "out.bak").exists()


def test_progress_flags(spark):
    df = spark.createDataFrame([tuple("1" if c == "completed" else None for c in CATALOG_PROGRESS.names)], CATALOG_PROGRESS)
    assert csvs.progress(df).first()["completed"] == "TRUE"


def test_empty_writes(spark, tmp_path):
    none = spark.createDataFrame([], "a string")
    assert csvs.write_unless_empty(none, str(tmp_path / "x")) == 0 and not (tmp_path / "x").exists()
    with pytest.raises(ValueError):
        csvs.write_unless_empty(none, str(tmp_path / "x"), required=True)


def test_media_listing(spark, tmp_path):
    for n in ("2024/a.opus", "b.opus", "c.M4A", "d.txt"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_bytes(b"x" * 3)
    assert {r["id"] for r in media.files(spark, str(tmp_path)).collect()} == {"a", "b"}
    assert {r["id"] for r in media.files(spark, str(tmp_path), recursive=False).collect()} == {"b"}
    assert {r["id"] for r in media.media(spark, str(tmp_path)).collect()} == {"b", "c"}


def test_tar_round_trip(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.opus").write_bytes(bytes([i]) * 10)
    df = spark.createDataFrame([(str(i), f"題{i}", "2024-01-01", str(tmp_path / f"{i}.opus"), "2024", 10, 77) for i in range(5)], "id string, title string, publish_date string, audio string, year string, size_bytes long, mtime long")
    plan = packing.plan_shards(df.withColumn("path", F.col("audio")), "set", per_shard=2)
    dry = tars.write_shards(plan, str(tmp_path / "none"), dry_run=True)
    assert sorted(r["samples"] for r in dry.collect()) == [1, 2, 2] and not (tmp_path / "none").exists()
    done = {r["shard_name"]: r["samples"] for r in tars.write_shards(plan, str(tmp_path / "out")).collect()}
    assert done == {"set-2024-00000.tar": 2, "set-2024-00001.tar": 2, "set-2024-00002.tar": 1}
    spark.dataSource.register(tars.TarSource)
    back = spark.read.format("samples_tar").load(str(tmp_path / "out/*.tar")).orderBy("key").collect()
    assert [bytes(r["audio"]) for r in back] == [bytes([i]) * 10 for i in range(5)]
    assert json.loads(back[3]["json"])["title"] == "題3" and back[3]["json"].startswith('{"id": "3"')


def test_vtt_files(spark, tmp_path):
    df = spark.createDataFrame([("x", "WEBVTT\n\n1\n00:00:00.000 --> 00:00:01.000\nhé\n\n")], "file string, vtt string")
    assert vtts.write_documents(df, str(tmp_path / "v")).collect()[0]["bytes"] > 40
    assert [tuple(r) for r in vtts.read_cues(spark, str(tmp_path / "v")).collect()] == [("x", 1, 0.0, 1.0, "hé")]


def test_paging_and_lookup(spark):
    ids = [f"v{i}" for i in range(120)]
    api = services.MemoryVideoApi({"@c": "UU1"}, {"UU1": [*ids, "v0"]}, {i: {"id": i, "title": i.upper()} for i in ids if i != "v7"})
    assert services.list_ids(api, "@c") == [*ids, "v0"]
    with pytest.raises(LookupError):
        services.list_ids(api, "@other")
    got = services.lookup(spark.createDataFrame([(i,) for i in ids], "id string"), api, "id string, title string")
    assert got.count() == 119


def test_fetch_playlist():
    class Fake:
        def __init__(self, pages):  # noqa: ANN001
            self.pages = pages

        def extract(self, url):  # noqa: ANN001, ANN201
            return self.pages.get(url)

    said, steps = [], []
    pages = {"c": {"channel_id": "UC123", "rows": []}, "up": {"rows": ["r"]}}
    got = services.fetch_playlist(Fake(pages), "c", lambda _: "up", lambda i: i["rows"], lambda *x: steps.append(x), said.append)
    assert got == ["r"] and steps == [(0, 1), (1, 1)] and len(said) == 1
    with pytest.raises(ValueError):
        services.fetch_playlist(Fake({"c": {"rows": []}}), "c", lambda _: None, lambda i: i["rows"])


def test_limiter_and_retries():
    now = [0.0]
    limiter = retry.Limiter(2, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    starts = []
    for _ in range(5):
        limiter.acquire()
        starts.append(now[0])
    assert starts[:2] == [0, 0] and starts[2] >= 60 and starts[4] >= 120
    waits, answers = [], iter([(500, ""), (429, ""), (200, " ok ")])
    assert retry.recognise(lambda: next(answers), sleep=waits.append) == "ok" and waits == [0.8, 1.6]
    with pytest.raises(retry.RateLimited):
        retry.recognise(lambda: (429, ""), 1, sleep=waits.append)
    assert retry.recognise(lambda: (400, ""), sleep=waits.append) == ""
    assert retry.recognise(lambda: 1 / 0, 2, sleep=waits.append) == ""
    tries: dict[str, int] = {}

    def call(s: str) -> str:
        tries[s] = tries.get(s, 0) + 1
        if s == "b" and tries[s] < 3 or s == "c":
            raise retry.RateLimited
        return s

    assert retry.recognise_all("abc", call, sleep=lambda _: None) == ["a", "b", ""]
    slept: list[float] = []
    with pytest.raises(RuntimeError):
        retry.extract(lambda: None, sleep=slept.append)
    assert slept == [5, 10, 20, 40] and retry.extract(lambda: None, True, sleep=slept.append) is None


def test_adapters_meet_frames(spark, tmp_path):
    class Prober:
        def duration(self, path):  # noqa: ANN001, ANN201
            return (False, 0.0, "no") if "bad" in path else (True, 2.0, None)

    got = services.probe(spark.createDataFrame([("a",), ("bad",)], "path string"), Prober())
    assert {tuple(r) for r in got.collect()} == {("a", True, 2.0, None), ("bad", False, 0.0, "no")}
    text = services.transcribe(spark.createDataFrame([("f", 1), ("f", 2)], "file string, idx int"), ["file", "idx"], lambda r, **o: (200, f"{r['idx']} {sorted(o)}"), language="auto", enable_itn=True)
    assert {r["text"] for r in text.collect()} == {"1 ['enable_itn']", "2 ['enable_itn']"}
    speech = services.voice_activity(spark.createDataFrame([("a",), ("b",)], "path string"), lambda p: [(0, 1)] if p == "a" else 1 / 0)
    assert [tuple(r) for r in speech.collect()] == [("a", 0.0, 1.0)]
    (tmp_path / "x").write_text("1")
    plan = spark.createDataFrame([(str(tmp_path / "x"), str(tmp_path / "y/x")), (str(tmp_path / "no"), str(tmp_path / "y/no"))], "path string, target string")
    assert services.execute(plan, services.move) == (2, 0) and (tmp_path / "x").exists()
    assert services.execute(plan, services.move, dry_run=False) == (1, 1) and (tmp_path / "y/x").exists()
    hub = services.MemoryHub()
    hub.put("m", b"1")
    hub.delete("m")
    hub.delete("m")
    assert hub.fetch("m") is None


def test_api_key(tmp_path):
    env = tmp_path / ".env"
    env.write_text("# KEY=no\nKEY='secret'\n")
    assert services.api_key("KEY", {}, env) == "secret" and services.api_key("KEY", {"KEY": "e"}, env) == "e"
    with pytest.raises(LookupError):
        services.api_key("OTHER", {}, env)
    assert services.missing_tools("no-such-tool-at-all") == ["no-such-tool-at-all"]


def test_progress_log(spark, tmp_path):
    log = str(tmp_path / "log")
    at = lambda s: datetime(2024, 1, 1, 0, 0, s)
    progress.append(spark.createDataFrame([("a", "FALSE", at(1)), ("b", "TRUE", at(1))], progress.LOG), log)
    progress.append(spark.createDataFrame([("a", "TRUE", at(2))], progress.LOG), log)
    want = {("a", "TRUE"), ("b", "TRUE"), ("c", "FALSE")}
    rows = spark.createDataFrame([("a", None), ("b", None), ("c", "TRUE")], "id string, completed string")
    assert {tuple(r) for r in progress.apply(rows, spark.read.parquet(log)).collect()} == want
    query = progress.follow(spark, log, "state", str(tmp_path / "cp"))
    query.awaitTermination(120)
    assert {(r["id"], r["completed"]) for r in spark.table("state").collect()} == {("a", "TRUE"), ("b", "TRUE")}
    assert os.path.isdir(tmp_path / "cp")


def test_media_services(spark, tmp_path):
    from sonorium.adapters import media as svc

    assert svc.ToolProbe(("sh", "-c", 'echo "{\\"format\\": {\\"duration\\": \\"2.5\\"}}"')).duration("x") == (True, 2.5, None)
    assert svc.ToolProbe(("sh", "-c", "echo no")).duration("x") == (True, 0.0, None)
    assert svc.ToolProbe(("sh", "-c", "echo bad >&2; exit 3")).duration("x") == (False, None, "bad")
    assert svc.ToolProbe(("no-such-tool",)).duration("x")[0] is False
    plan = spark.createDataFrame([("a.wav", "c.wav", 0.0, 0.0)], "path string, clip_name string, start double, duration double")
    with pytest.raises(Exception, match="no duration"):
        svc.cut_clips(plan, svc.WaveCodec(), str(tmp_path)).collect()


def test_guards(spark):
    from sonorium.functions import durations, values

    one = spark.range(1)
    with pytest.raises(Exception, match="negative"):
        one.select(values.worker_count(F.lit(-1), 8)).collect()
    with pytest.raises(Exception, match="not whole seconds"):
        one.select(durations.iso_duration(F.lit("PT1.5S"))).collect()
    assert one.select(durations.iso_duration(F.lit("PT1H2M3S"))).first()[0] == "01:02:03"


def test_recognition_keeps_its_order_in_threads():
    import time

    assert retry.recognise_all(range(20), lambda i: (time.sleep(0.001 * (20 - i)), str(i))[1], threads=8) == [str(i) for i in range(20)]


def test_downloads_look_at_their_own_file_only(spark, tmp_path):
    from sonorium.adapters import media as svc
    from sonorium.plans.outside import downloads

    class Service:
        def download(self, url, target, rate):  # noqa: ANN001, ANN201
            with open(target if url != "b" else target + ".part", "wb") as f:
                f.write(b"x" * len(os.listdir(os.path.dirname(target))))
            if url == "b":
                raise OSError("broken off")
            return True

    rows = spark.createDataFrame([(f"k{i}", "b" if i == 3 else "a") for i in range(20)], "id string, url string").coalesce(1)
    got = svc.download(rows, Service(), str(tmp_path / "d"))
    assert got.rdd.getNumPartitions() >= 4
    assert {r["id"] for r in got.collect() if not r["downloaded"]} == {"k3"}
    left = os.listdir(tmp_path / "d")
    assert sorted(left) == sorted(f"k{i}.opus" for i in range(20) if i != 3)  # nothing aside stays
    assert {os.path.getsize(tmp_path / "d" / n) for n in left} == {1}  # no file had others beside it
    once = downloads(spark, "/root/testdata/sf0.001")
    assert sorted(once.collect(), key=str) == sorted(once.collect(), key=str)


def test_listing_and_reading_do_not_grow_tasks_with_files(spark, tmp_path):
    names = [*(f"f{i}" for i in range(300)), "_id", "a b", "粵語"]
    df = spark.createDataFrame([(n, "WEBVTT\n\n1\n00:00:00.000 --> 00:00:01.000\nhé\n\n") for n in names], "file string, vtt string")
    written = vtts.write_documents(df.coalesce(1), str(tmp_path / "v"))
    assert written.rdd.getNumPartitions() >= 4 and written.count() == 303
    (tmp_path / "v/empty.vtt").write_text("")
    (tmp_path / "v/.hidden.vtt").write_text("x")
    (tmp_path / "v/in").mkdir()
    (tmp_path / "v/in/deep.vtt").write_text("x" * 7)
    docs = vtts.read_documents(spark, f"file://{tmp_path}/v")
    assert docs.rdd.getNumPartitions() <= 4
    assert {r["file"] for r in docs.collect()} == set(names)
    assert vtts.read_cues(spark, str(tmp_path / "v")).count() == 303
    assert [r["file"] for r in vtts.read_documents(spark, str(tmp_path / "v/f1?.vtt")).orderBy("file").collect()] == [f"f1{i}" for i in range(10)]
    listed = media.files(spark, str(tmp_path / "v"), "*.vtt")
    assert listed.rdd.getNumPartitions() <= 4
    os.remove(tmp_path / "v/f0.vtt")  # a listing is of its time
    found = {r["id"]: r for r in listed.collect()}
    assert set(found) == {*names, "deep"} and found["deep"]["length"] == 7 and found["deep"]["path"] == f"{tmp_path}/v/in/deep.vtt"
    assert abs(found["deep"]["modificationTime"].timestamp() - os.path.getmtime(tmp_path / "v/in/deep.vtt")) < 0.01
    assert {r["id"] for r in media.files(spark, str(tmp_path / "v"), "f{1,2}.vtt").collect()} == {"f1", "f2"}


def test_cutting_is_spread_and_in_pieces(spark, tmp_path, monkeypatch):
    import random
    import wave

    from sonorium.adapters import media as svc
    from sonorium.plans import outside

    waves = outside._waves(spark.createDataFrame([(f"s{i}.wav", 48_000) for i in range(8)], "name string, frames long").coalesce(1), str(tmp_path / "w"), 48_000)
    assert waves.rdd.getNumPartitions() >= 4 and waves.count() == 8
    with wave.open(str(tmp_path / "plain.wav"), "wb") as w:
        w.setparams((2, 2, 48_000, 0, "NONE", ""))
        w.writeframes(b"\0" * (4 * 48_000))
    assert (tmp_path / "w/s3.wav").read_bytes() == (tmp_path / "plain.wav").read_bytes()
    mono = svc.extract(waves.select("path").coalesce(1), svc.WaveCodec(), str(tmp_path / "m"))
    clips = svc.cut_clips(mono.selectExpr("wav AS path", "'c' AS clip_name", "0.0D AS start", "0.25D AS duration").coalesce(1), svc.WaveCodec(), str(tmp_path / "c"))
    assert mono.rdd.getNumPartitions() >= 4 and clips.rdd.getNumPartitions() >= 4
    plan = outside.cut_and_extract(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "LocalTableScan" not in plan  # what was made isn't gathered on the driver

    monkeypatch.setattr(svc, "HELD", 100)
    for channels, width, rate in ((1, 1, 16_000), (2, 2, 48_000), (3, 3, 44_100)):
        data = random.Random(rate).randbytes(1003 * channels * width)
        with wave.open(str(tmp_path / "x.wav"), "wb") as w:
            w.setparams((channels, width, rate, 0, "NONE", ""))
            w.writeframes(data)
        svc.WaveCodec().extract(str(tmp_path / "x.wav"), str(tmp_path / "y.wav"), 16_000)
        with wave.open(str(tmp_path / "y.wav")) as w:
            assert (w.getnchannels(), w.getframerate()) == (1, 16_000)
            assert w.readframes(5000) == b"".join(data[i : i + width] for i in range(0, len(data), channels * width * max(1, rate // 16_000)))


def test_writing_stays_spread_behind_a_grouping(spark, tmp_path):
    from sonorium.operators import subtitle

    cues = spark.createDataFrame([(f"f{i}", 1, 0.0, 1.0, "x") for i in range(40)], "file string, idx int, start double, end double, text string")
    assert vtts.write_documents(subtitle.render(cues, "file"), str(tmp_path / "v")).rdd.getNumPartitions() >= 4
