"""WebVTT: render, parse, cut into clips."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.durations import cue_time
from ..functions.texts import collapse_whitespace, correct, numbered, strip
from .catalog import row_number_by


def cue_block(idx: Column, start: Column, end: Column, text: Column) -> Column:
    return F.concat(idx.cast("string"), F.lit("\n"), cue_time(start), F.lit(" --> "), cue_time(end), F.lit("\n"), strip(F.coalesce(text, F.lit(""))), F.lit("\n\n"))


def render(cues: DataFrame, key: str) -> DataFrame:
    """(key, vtt): one document a key; cues (start, end, text) are numbered from 1 in the order of idx."""
    listed = cues.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("idx", "start", "end", "text"))).alias("_c"))
    blocks = F.transform("_c", lambda c, i: cue_block(i + 1, c["start"], c["end"], c["text"]))
    return listed.select(key, F.concat(F.lit("WEBVTT\n\n"), F.concat_ws("", blocks)).alias("vtt"))


def cue_seconds(text: str) -> float:
    h, m, s = text.replace(",", ".").strip().split(":")
    return int(h) * 3600 + int(m) * 60 + float(s)


def parse_lines(lines: Iterable[str]) -> Iterator[tuple[float, float, str]]:
    """Cues of a document's lines.

    A blank line ends a cue. Lines that begin with WEBVTT are ignored, also inside a cue; a timing line begins a
    cue and forgets the text of one that wasn't ended; lines ahead of a timing (numbers, notes) are ignored, as
    are timings with several arrows. Lines of a cue are joined by spaces; a time that can't be read is an error.
    """
    times: tuple[float, float] | None = None
    text: list[str] = []
    for line in (*(x.strip() for x in lines), ""):
        if not line:
            if times and text:
                yield (*times, " ".join(text))
            times, text = None, []
        elif line.startswith("WEBVTT"):
            continue
        elif "-->" in line:
            sides = line.split("-->")
            if len(sides) == 2:
                times, text = (cue_seconds(sides[0]), cue_seconds(sides[1].split()[0])), []
        elif times:
            text.append(line)


def parse(documents: DataFrame, key: str, text: str = "vtt") -> DataFrame:
    """(key, idx, start, end, text) of every cue, idx from 1 in each document; a state machine over lines, in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for k, doc in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = parse_lines((doc or "").removeprefix("﻿").splitlines())
                out += [(k, i, *cue) for i, cue in enumerate(found, 1)]
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (b.schema.field(0).type, pa.int32(), pa.float64(), pa.float64(), pa.string()))], [key, "idx", "start", "end", "text"])

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, idx int, start double, end double, text string")


def correct_cues(cues: DataFrame, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """cues with corrected text; times as they are."""
    return cues.withColumn("text", correct(F.col("text"), rules))


def attach(results: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """segments with the recognised text of their index, empty where there is none."""
    return segments.join(results.select(*keys, "text"), keys, "left").withColumn("text", F.coalesce("text", F.lit("")))


def pair_audio(audio: DataFrame, vtt: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(audio with a subtitle file, keys of audio without one)."""
    return audio.join(vtt, key), audio.join(vtt.select(key), key, "left_anti").select(key)


def cut_plan(cues: DataFrame, key: str, extension: str = ".opus", width: int = 4) -> DataFrame:
    """cues with clip_name, duration, collapsed text and skip: true without text or length.

    Clip names count all cues of a file, skipped ones too.
    """
    idx = F.row_number().over(Window.partitionBy(key).orderBy("idx"))
    out = cues.withColumn("idx", idx).withColumn("text", collapse_whitespace(F.coalesce("text", F.lit("")))).withColumn("duration", F.round(F.col("end") - F.col("start"), 6))
    name = numbered(f"%s_%0{width}d{extension}", F.col(key).cast("string"), F.col("idx"))
    return out.withColumn("clip_name", name).withColumn("skip", (F.col("text") == "") | (F.col("duration") <= 0))


def clips(plan: DataFrame, key: str, prefix: str, genre: str, album: str, folder: str, width: int = 4) -> DataFrame:
    """Metadata of the clips made: ids count successes only, over all files in the order of key and idx."""
    made = plan.filter(~F.col("skip")).withColumn("_at", F.struct(key, "idx"))
    n = row_number_by(made, "_at", "_id")
    return n.select(F.concat_ws("/", F.lit(folder), "clip_name").alias("audio"), numbered(f"{prefix}-%0{width}d", F.col("_id")).alias("id"), "duration", F.lit(genre).alias("genre"), F.lit(album).alias("album"), "text")


def skipped(plan: DataFrame) -> DataFrame:
    return plan.agg(F.count_if("skip").alias("skipped"), F.count_if(~F.col("skip")).alias("made"))
