"""Relational operators on small tables, and against plain loops."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonorium.operators import catalog as cat
from sonorium.operators import integrity, metadata, packing, playlist, publish, subtitle
from sonorium.operators import intervals as iv
from sonorium.schemas import ENTRY, EXTRACTION


def rows(df, *cols):  # noqa: ANN001, ANN201
    return sorted((tuple(r) for r in df.select(*cols or df.columns).collect()), key=repr)


def test_gap_merge_equals_loop(spark):
    rnd = random.Random(3)
    data = [(k, s := rnd.randrange(400) / 4, s + rnd.randrange(12) / 4) for k in range(5) for _ in range(40)]
    want = []
    for k in range(5):
        merged = []
        for _, s, e in sorted(x for x in data if x[0] == k):
            if merged and s - merged[-1][1] <= 0.5:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        want += [(k, s, e) for s, e in merged]
    df = spark.createDataFrame(data, "k int, start double, end double")
    got = iv.gap_merge(df, ["k"], 0.5)
    assert rows(got, "k", "start", "end") == sorted(want, key=repr)
    again = iv.gap_merge(got.drop("n"), ["k"], 0.5)
    assert rows(again, "k", "start", "end") == sorted(want, key=repr)
    assert not iv.gap_merge(df.limit(0), ["k"], 0.5).count()


def test_splits_tile(spark):
    df = spark.createDataFrame([("a", 0.0, 10.0), ("b", 1.0, 1.0), ("c", 0.0, 4.0), ("d", 2.0, 1.0)], "k string, start double, end double")
    assert rows(iv.bounded_split(df, 4.0)) == [("a", 0.0, 4.0), ("a", 4.0, 8.0), ("a", 8.0, 10.0), ("c", 0.0, 4.0)]
    assert rows(iv.bounded_split(df, 0)) == [("a", 0.0, 10.0), ("c", 0.0, 4.0)]
    tenth = spark.createDataFrame([("a", 0.0, 1.0)], "k string, start double, end double")
    assert iv.exact_split(tenth, 0.1).count() == 11
    assert iv.bounded_split(tenth, 0.1).count() == 10
    with pytest.raises(ValueError):
        iv.fixed_windows(F.lit(1.0), 0)


def test_fallback(spark):
    seg = "array<struct<start:double,end:double>>"
    df = spark.createDataFrame([([(0.0, 1.0)], 70.0), ([], 70.0), (None, 0.0)], f"s {seg}, n double")
    got = [[tuple(x) for x in r[0]] for r in df.select(iv.fallback_windows(F.col("s"), F.col("n"), 10.0)).collect()]
    assert got == [[(0.0, 1.0)], [(0.0, 30.0), (30.0, 60.0), (60.0, 70.0)], []]
    assert df.select(F.size(iv.fallback_windows(F.col("s"), F.col("n"), 10.0, batch=False))).collect()[1][0] == 7


def test_rolling_starts_is_half_open(spark):
    df = spark.createDataFrame([(0.0,), (59.0,), (60.0,), (119.5,)], "t double").withColumn("ts", F.col("t").cast("timestamp")).withColumn("k", F.lit(1))
    assert rows(iv.rolling_starts(df, ["k"], "ts"), "t", "in_window") == [(0.0, 1), (119.5, 2), (59.0, 2), (60.0, 2)]


def test_packing_equals_loop(spark):
    rnd = random.Random(1)
    data = [(f"g{rnd.randrange(3)}", i, rnd.choice([0, 1, 5, 30, 99, 100, 101, 250])) for i in range(600)]
    want = []
    for g in ("g0", "g1", "g2"):
        shard, count, total = 0, 0, 0
        for n, (_, i, size) in enumerate(x for x in data if x[0] == g):
            if count and (count >= 7 or total + size > 100):
                shard, count, total = shard + 1, 0, 0
            want.append((g, i, shard, n))
            count, total = count + 1, total + size
    df = spark.createDataFrame(data, "g string, i long, size long")
    assert rows(packing.pack(df, "g", ["i"], "size", 7, 100), "g", "i", "shard", "sample_index") == sorted(want, key=repr)
    assert not packing.pack(df.limit(0), "g", ["i"], "size").count()
    wide = spark.createDataFrame([("g", i, size) for i, (_, _, size) in enumerate(data)], "g string, i long, size long")
    shard, count, total, want = 0, 0, 0, []
    for i, (_, _, size) in enumerate(data):
        if count and (count >= 7 or total + size > 100):
            shard, count, total = shard + 1, 0, 0
        want.append((i, shard, i))
        count, total = count + 1, total + size
    for parts in ("3", "40"):  # one group over several tasks, over chunks shorter than a shard
        before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            got = packing.pack(wide, "g", ["i"], "size", 7, 100)
            assert sorted(map(tuple, got.select("i", "shard", "sample_index").collect())) == want
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before[0])
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    odd = spark.createDataFrame([(None, 1, None), (None, 2, 50)], "g string, i long, size long")
    assert rows(packing.pack(odd, "g", ["i"], "size", 7, 100), "i", "shard") == [(1, 0), (2, 0)]


def test_plan_shards(spark):
    df = spark.createDataFrame([(" b", "t", "2024-01-02", " a/x.opus ", "2024", 10, 5), ("a", None, "2024-01-02", "a/y.opus", "2024", 10, 5)], "id string, title string, publish_date string, audio string, year string, size_bytes long, mtime long")
    got = packing.plan_shards(df, "set")
    assert rows(got, "sample_index", "shard_name", "audio_member", "json_member") == [(0, "set-2024-00000.tar", "set-2024-000000.opus", "set-2024-000000.json"), (1, "set-2024-00000.tar", "set-2024-000001.opus", "set-2024-000001.json")]
    assert '"audio": "set-2024-000000.opus"' in got.filter("sample_index = 0").first()["payload"]
    assert packing.shard_sizes(got).first()["samples"] == 2


def test_catalog(spark):
    c = spark.createDataFrame([(1, "a", False), (2, "b", True), (3, "c", None), (4, "a", True)], "id long, url string, downloaded boolean")
    got = cat.reconcile(c, spark.createDataFrame([(1,), (3,), (3,)], "id long"), "id")
    assert rows(got, "id", "downloaded", "updated", "missing") == [(1, True, True, False), (2, True, False, True), (3, True, False, False), (4, True, False, True)]
    assert rows(cat.pending_rows(c), "id") == [(1,)]
    cleared = cat.clear_flags(c, spark.createDataFrame([(1,)], "id long"), "id", "url")
    assert rows(cleared, "id", "downloaded") == [(1, False), (2, True), (3, None), (4, False)]
    assert rows(cat.last_by(c, "url", F.col("id"), F.col("id"), "last")) == [("a", 4), ("b", 2), ("c", 3)]
    n = cat.row_number_by(spark.range(0, 500, 1, 7), "id", "n")
    assert n.filter("n <> id + 1").isEmpty() and n.count() == 500


def test_candidates(spark):
    c = spark.createDataFrame([(i, "TRUE" if i % 2 else "FALSE") for i in range(6)], "i int, completed string")
    assert [r["i"] for r in cat.candidates(c, "i", 2).collect()] == [0, 2]
    assert cat.candidates(c, "i").count() == 3
    assert [r["i"] for r in cat.candidates(c, "i", 2, reprocess=True).collect()] == [0, 1]


def test_path_resolution(spark):
    files = spark.createDataFrame([("dl/2024/a.opus",), ("dl/a.opus",), ("dl/b/b.opus",)], "path string")
    r = spark.createDataFrame([("a", "2024-01-01"), ("b", None), ("c", "20x")], "id string, d string")
    assert rows(cat.resolve_paths(r, files, "id", cat.download_paths("dl", F.col("id"), F.col("d"))), "id", "path") == [("a", "dl/2024/a.opus"), ("b", "dl/b/b.opus"), ("c", None)]
    cells = spark.createDataFrame([(" /abs/x ",), ("pub/y",), ("",), (None,)], "c string")
    got = [r[0] for r in cells.select(cat.upload_paths(F.col("c"), "m", "r", "pub")).collect()]
    assert got == [["/abs/x"], ["m/pub/y", "r/pub/y", "r/y"], [], []]


def test_integrity(spark):
    probes = spark.createDataFrame([("d/a.opus", True, 10.0, None), ("d/b.opus", True, 30.0, None), ("d/c.opus", False, 0.0, "bad"), ("d/e.opus", True, 99.0, None)], "path string, ok boolean, duration double, error string")
    checked = integrity.check(probes, spark.createDataFrame([("a", 12)], "id string, expected long"))
    assert rows(checked, "id", "status", "duration_diff") == [("a", "truncated", 2.0), ("b", "suspicious", None), ("c", "corrupted", None), ("e", "valid", None)]
    assert list(integrity.summary(checked).first()) == [4, 1, 1, 1, 1, 3, 99.0, 99.0]
    assert [r["id"] for r in integrity.problems(checked).orderBy("rank", "path").collect()] == ["c", "a", "b"]
    orphans = spark.createDataFrame([("d/z.m4a",), ("d/a.m4a",)], "path string")
    assert rows(integrity.redownload_ids(checked, orphans)) == [("a",), ("b",), ("c",), ("z",)]
    assert integrity.delete_plan(checked, orphans).count() == 5
    empty = integrity.summary(integrity.check(probes.limit(0), None)).first()
    assert empty["total"] == 0 and empty["mean_seconds"] is None


def test_metadata_reasons(spark):
    r = spark.createDataFrame([(None, True, "p"), ("a", False, "p"), ("b", True, None), ("c", True, "q"), ("d", True, "p"), ("e", True, "p")], "id string, downloaded boolean, path string").withColumns({c: F.lit(None).cast("string") for c in ("title", "description", "publish_date")})
    built = metadata.build(r, spark.createDataFrame([("p", 2.5), ("q", None)], "path string, duration double"))
    assert rows(built, "id", "reason") == sorted([(None, "missing_id"), ("a", "not_downloaded"), ("b", "missing_file"), ("c", "probe_failed"), ("d", None), ("e", None)], key=repr)
    assert rows(metadata.kept(built)) == [("d", "p", "", "", "", "00:00:02", 2), ("e", "p", "", "", "", "00:00:02", 2)]
    assert metadata.paths_to_probe(r).count() == 2
    assert rows(metadata.diagnostics(built)) == [("missing_file", 1), ("missing_id", 1), ("not_downloaded", 1), ("probe_failed", 1)]


def test_publish(spark):
    old = publish.normalise(spark.createDataFrame([("a", "old/a", None), (None, "old/n", 3)], "id string, audio string, duration_seconds int"))
    new = spark.createDataFrame([("a", "new/a", 5, "u"), (None, "new/n", 6, "v"), ("b", "new/b", 7, "w")], "id string, file_path string, duration_seconds long, url string")
    merged = publish.upsert(old, new)
    assert rows(merged, "id", "file_path", "duration_seconds") == sorted([("a", "new/a", 5), ("b", "new/b", 7), (None, "new/n", 6)], key=repr)
    again = publish.upsert(merged, new)
    assert rows(again) == rows(merged)
    assert rows(publish.minus(new, old, "id"), "id") == sorted([("b",), (None,)], key=repr)
    with pytest.raises(ValueError):
        publish.validate(old)
    assert publish.validate(spark.createDataFrame([], "publish_date string, audio string")) == "audio"
    got = publish.manifest_rows(spark.createDataFrame([("x/1.opus", None, "01:00:00")], "path string, title string, duration string"), "pub", 2024).first().asDict()
    assert got == {"id": "1.opus", "file_path": "pub/2024/1.opus", "title": "", "description": "", "publish_date": "", "duration": "01:00:00", "duration_seconds": 3600}


def entry(**k):  # noqa: ANN003, ANN201
    return tuple(k.get(f.name) for f in ENTRY.fields)


def extraction(entries, **k):  # noqa: ANN001, ANN003, ANN201
    return tuple(entries if f.name == "entries" else k.get(f.name) for f in EXTRACTION.fields)


def test_playlists(spark):
    nested = [entry(webpage_url="https://clips.test/a", title=" Alpha ", description="about a", duration="61"), entry(_type="url", url="https://clips.test/b", id="2"), None, entry(title="nothing")]
    df = spark.createDataFrame([extraction(nested, id="p"), extraction([], id="empty"), extraction(None, id="own", url="https://clips.test/o", title="Own", duration_string="1:01")], EXTRACTION)
    flat = playlist.entries(df.withColumnRenamed("id", "pid").withColumn("id", F.col("pid")), ["pid"])
    full = spark.createDataFrame([("https://clips.test/b", entry(webpage_url="https://clips.test/b", title="Beta", description="about b", duration_ms="42900"))], f"url string, full {ENTRY.simpleString()}")
    got = playlist.rows(playlist.resolve_stubs(flat, full), ["pid"])
    assert rows(got) == [("own", 0, "https://clips.test/o", "Own", "", 61), ("p", 0, "https://clips.test/a", "Alpha", "about a", 61), ("p", 1, "https://clips.test/b", "Beta", "about b", 42)]
    kept = playlist.rows(playlist.resolve_stubs(flat, full.limit(0)), ["pid"])
    assert ("p", 1, "https://clips.test/b", "", "", None) in rows(kept)


def test_vtt(spark):
    cues = [("f", 2, 1.5, 2.0, " second "), ("f", 1, 0.0, 1.25, "first"), ("g", 1, 59.9996, 60.5, None)]
    df = spark.createDataFrame(cues, "file string, idx int, start double, end double, text string")
    docs = {r["file"]: r["vtt"] for r in subtitle.render(df, "file").collect()}
    assert docs["f"] == "WEBVTT\n\n1\n00:00:00.000 --> 00:00:01.250\nfirst\n\n2\n00:00:01.500 --> 00:00:02.000\nsecond\n\n"
    back = subtitle.parse(subtitle.render(df, "file"), "file")
    assert rows(back) == [("f", 1, 0.0, 1.25, "first"), ("f", 2, 1.5, 2.0, "second")]


def test_vtt_state_machine():
    text = "﻿WEBVTT\n\nNOTE x\n\n1\n00:00:01,000 --> 00:00:02.000 align:left\na\nWEBVTT inside\nb\n\n00:00:03.000 --> 00:00:04.000\nlost\n00:00:05.000 --> 00:00:06.000\nkept\n\n00:00:07.000 --> 00:00:08.000 --> 1\nignored\n\n00:00:09.000 --> 00:00:10.000\nlast"
    assert list(subtitle.parse_lines(text.removeprefix("﻿").splitlines())) == [(1.0, 2.0, "a b"), (5.0, 6.0, "kept"), (9.0, 10.0, "last")]
    with pytest.raises(ValueError):
        list(subtitle.parse_lines(["1:2 --> 00:00:01.000"]))


def test_clips(spark):
    cues = spark.createDataFrame([("b", 1, 0.0, 1.0, "x  y"), ("a", 1, 0.0, 1.0, " "), ("a", 2, 1.0, 1.0, "no"), ("a", 3, 1.0, 2.5, "z")], "file string, idx int, start double, end double, text string")
    plan = subtitle.cut_plan(cues, "file")
    got = subtitle.clips(plan, "file", "p", "g", "m", "out")
    assert rows(got, "audio", "id", "duration", "text") == [("out/a_0003.opus", "p-0001", 1.5, "z"), ("out/b_0001.opus", "p-0002", 1.0, "x y")]
    assert list(subtitle.skipped(plan).first()) == [2, 2]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_global_numbers_of_many_rows(spark, adaptive):
    """Distinct numbers without gaps in order, with columns that not every branch of the plan needs."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        n = 3_000_000
        rows = spark.range(n).select((F.col("id") * 7919 % n).alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
        got = cat.row_number_by(rows, "key", "place")
        bad, distinct, longest = got.agg(F.count_if(F.col("place") != F.col("key") + 1), F.count_distinct("place"), F.max(F.length("text"))).first()
        assert (bad, distinct, longest) == (0, n, 64)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_outlook_equals_packing_from_each_place():
    rnd = random.Random(6)
    for _ in range(300):
        sizes = [rnd.choice([0, 1, 20, 60, 99, 100, 101, 300]) for _ in range(rnd.randrange(1, 40))]
        for first, got in enumerate(packing.outlook(np.array(sizes), 5, 100)):
            packer = packing.Packer(5, 100)
            shards = packer.take(np.array(sizes[first:]))
            assert got == (len(set(shards.tolist())), packer.count, packer.total)
