"""Scalar functions on literal values."""

from __future__ import annotations

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sonorium.functions import durations as du
from sonorium.functions import texts, urls, values
from sonorium.functions.status import classify, probe_error


def run(spark: SparkSession, f, rows: list, kind: str = "string") -> list:  # noqa: ANN001
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def check(spark: SparkSession, f, cases: dict | list[tuple], kind: str = "string") -> None:  # noqa: ANN001
    pairs = list(cases.items()) if isinstance(cases, dict) else cases
    assert run(spark, f, [a for a, _ in pairs], kind) == [b for _, b in pairs]


def test_video_ids(spark):
    long = "https://www.youtube.com/watch?v=a%2Db&t=1"
    check(spark, urls.watch_id_exact, {long: "a-b", "https://youtube.com/watch?v=x": None, "https://youtu.be/q?t=1": "q?t=1", "": None})
    check(spark, urls.watch_id, {long: "a-b", "https://youtube.com/watch?v=x": "x", "https://youtu.be/q?t=1": "q", "https://youtu.be/q/": "", "https://m.youtube.com/watch?v=x": None, "https://www.youtube.com/watch?v=": None})
    check(spark, urls.watch_id_lenient, {"https://youtu.be/q/": "q", "https://WWW.youtube.com/watch?a=b&v=x#f": "x", "https://www.youtube.com/watch?v=a|b c": "a|b c", "https://www.youtube.com/watch?v=%zz": "%zz"})
    assert run(spark, urls.watch_id_lenient, [None]) == [None]


def test_uploads_and_entry_url(spark):
    df = spark.createDataFrame([("UUa", "UCb"), (" ", "UCb"), (None, "HC"), ("PLx", None)], "p string, c string")
    got = [r[0] for r in df.select(urls.uploads_url(F.col("p"), F.col("c"))).collect()]
    assert got == ["https://www.youtube.com/playlist?list=UUa", "https://www.youtube.com/playlist?list=UUb", None, None]
    df = spark.createDataFrame([("", "o", "u", "i"), (None, None, None, " i "), (None, "", None, "")], "w string, o string, u string, i string")
    assert [r[0] for r in df.select(urls.entry_url(*map(F.col, "woui"))).collect()] == ["o", "https://www.youtube.com/watch?v=i", None]


def test_parsing(spark):
    check(spark, du.iso_duration, {"PT1H2M3S": "01:02:03", "PT45S": "00:00:45", "PT100H": "100:00:00", "P1DT2H": "00:00:00", "": "00:00:00"})
    check(spark, du.hms_or_null, {"1:02:03": 3723, "02:03": 123, "9": 9, "1:2:3:4": None, "a:b": None, "1.5": None, " 7 ": 7, "": None})
    check(spark, du.hms_or_zero, {"1:02:03": 3723, "02:03": 0, "x": 0})
    assert run(spark, du.hms_or_zero, [None]) == [0]
    check(spark, du.coerce_duration, {"1.9": 1, "-1": None, "NaN": None, "Infinity": None, "x": None, "0": 0})
    check(spark, du.base60, {"1:2:3:4": ((1 * 60 + 2) * 60 + 3) * 60 + 4, "5": 5, "1:x": None})
    check(spark, du.cue_seconds, {"01:02:03.500": 3723.5, "00:00:01,250": 1.25})
    with pytest.raises(Exception, match="not a cue time"):
        run(spark, du.cue_seconds, ["1:2"])


def test_formatting(spark):
    check(spark, du.hms, {3723: "01:02:03", 360000: "100:00:00", 0: "00:00:00"}, "long")
    check(spark, du.human, {3723.9: "1h 2m 3s", 62.0: "1m 2s", 0.4: "0s"}, "double")
    check(spark, du.clock, [(3723, "1:02:03"), (62, "1:02"), (-5, "0:00"), (None, "?")], "long")
    check(spark, du.cue_time, {59.9996: "00:01:00.000", 3599.9999: "01:00:00.000", 1.2345: "00:00:01.234", 0.0005: "00:00:00.000", 360000.0: "100:00:00.000"}, "double")
    check(spark, values.size_text, {0: "0 B", 1023: "1023 B", 1536: "1.50 KB", 1024**3: "1.00 GB", 1024**5: "1024.00 TB"}, "long")
    check(spark, values.rate_text, [(None, "?"), (0.0, "?"), (512.0, "512.0B/s"), (1536.0, "1.5KB/s"), (1024.0**4, "1024.0GB/s")], "double")
    check(spark, values.half_even, {0.5: 0, 1.5: 2, 2.5: 2}, "double")


def test_years(spark):
    df = spark.createDataFrame([("2024-01-02", "a/1999/b"), (" 20x4", "a/1999/b"), (None, "/x/12345/2001/y.opus")], "d string, p string")
    assert [r[0] for r in df.select(du.infer_year(F.col("d"), F.col("p"))).collect()] == ["2024", "1999", "2001"]
    none = spark.createDataFrame([("", "a/b")], "d string, p string")
    assert none.select(du.infer_year(F.col("d"), F.col("p"), strict=False)).first()[0] is None
    with pytest.raises(Exception, match="no year"):
        none.select(du.infer_year(F.col("d"), F.col("p"))).collect()


def test_texts(spark):
    check(spark, texts.strip, {"\t a b　\n": "a b", "": ""})
    check(spark, texts.escape_newlines, {"a\r\nb\nc\rd": r"a\nb\nc\nd"})
    check(spark, texts.collapse_whitespace, {" a \n\t b ": "a b"})
    check(spark, texts.stem, {"a/b.c.opus": "b.c", "x/.hidden": ".hidden", "plain": "plain"})
    check(spark, lambda c: texts.numbered("%05d", c), {7: "00007", 1234567: "1234567"}, "long")
    assert run(spark, texts.coerce_text, [None, " x "]) == ["", "x"]
    prompt = lambda c: texts.system_prompt("<{title}|{description}>", c, F.lit(None).cast("string"))
    check(spark, prompt, {"a{b}": "<a{{b}}|>"})


def test_json_payload(spark):
    import json

    odd = 'q"\\\n粵語'
    got = run(spark, lambda c: texts.json_payload({"audio": c, "none": F.lit(None)}), [odd])[0]
    assert got == json.dumps({"audio": odd, "none": None}, ensure_ascii=False)


def test_corrections(spark):
    check(
        spark,
        texts.correct,
        {"俾路支俾你": "俾路支畀你", "曬太陽曝曬衣曬相": "晒陽曝曬衣晒", "好翻去翻到": "好返去翻到", "唔該曬翻曬 多謝曬": "唔該晒翻晒 多謝晒", "<|粵語|>a<|zh|>b<||>": "ab<||>", "咁系": "噉係", "唔該曬衣": "唔該晒", "聯關系統": "聯關系統", "嚇，嚇人": "吓，嚇人"},
    )
    assert run(spark, texts.correct, [None]) == [""]
    check(spark, lambda c: texts.correct(c, [("a", "b"), ("b+", "c")]), {"aab": "c"})


def test_flags(spark):
    check(spark, values.is_downloaded, [(" Yes ", True), ("TRUE", True), ("1", True), ("y", True), ("0", False), ("on", False), (None, False)])
    check(spark, values.is_completed, [("yes", True), ("1", True), ("Y", False), (None, False)])
    check(spark, values.pending, [(True, False), (False, True), (None, False)], "boolean")
    check(spark, values.number_flag, [(1.0, True), (0.4, False), (None, False)], "double")


def test_status(spark):
    rows = [(True, 10.0, 11.0), (True, 10.0, 11.01), (True, 12.0, 10.0), (True, 59.9, None), (True, 60.0, None), (True, 5.0, 0.0), (False, 100.0, 100.0), (None, None, None)]
    df = spark.createDataFrame(rows, "ok boolean, a double, e double")
    got = [r[0] for r in df.select(classify(F.col("ok"), F.col("a"), F.col("e"))).collect()]
    assert got == ["valid", "truncated", "truncated", "suspicious", "valid", "suspicious", "corrupted", "corrupted"]
    rows = [(False, 1.0, True, "x"), (True, None, True, None), (True, 0.5, True, None), (True, 2.0, False, None), (True, 1.0, True, None)]
    df = spark.createDataFrame(rows, "ok boolean, d double, f boolean, m string")
    got = [r[0] for r in df.select(probe_error(F.col("ok"), F.col("d"), F.col("f"), F.col("m"))).collect()]
    assert got == ["probe error: x", "Cannot parse duration", "Duration too short (< 1 second)", "Cannot read format information", None]


def test_downmix(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 6.0]],)], "c array<array<float>>")
    got = df.select(values.downmix(F.col("c")), values.mono(F.col("c")[0], F.col("c")[1]), values.head_seconds(F.col("c")[0], 1, 1)).first()
    assert list(got) == [[2.0, 4.0], [2.0, 4.0], [1.0]]




def test_rounded_as_sql_does(spark):
    """Bit for bit: what rounds to nothing keeps its sign, halves arise where the product with 10^6 is rounded."""
    import struct

    import duckdb

    xs = [-1e-7, 1e-7, -0.0, 0.0, 5e-7, -5e-7, 1.0000005, -2.5000005, 0.0078125, 1704067200.1234564, 1704067200.1234567, 1e300, float("inf"), float("nan"), None, 1e15 + 0.3]
    xs += [1704067200 + i / 2**22 for i in range(200)] + [(-1) ** i * (i + 0.5) / 1e6 for i in range(200)]
    want = [duckdb.execute("SELECT round(?::DOUBLE, 6)", [x]).fetchone()[0] for x in xs]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").coalesce(1).select(values.rounded(F.col("x"), 6)).collect()]
    bits = lambda v: [x if x is None or x != x else struct.pack("d", x) for x in v]
    assert list(map(repr, bits(got))) == list(map(repr, bits(want)))


def test_mono_downmix_keeps_the_sign_of_zero(spark, tmp_path):
    import math

    from sonorium.plans.spans import mono_downmix

    spark.createDataFrame([(1, [-1e-7, 0.5, -1e-7, 0.25])], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = mono_downmix(spark, str(tmp_path)).first()["mono"]
    assert got == [0.0, 0.375] and math.copysign(1, got[0]) == -1
