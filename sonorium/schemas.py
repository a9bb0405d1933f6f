"""Schemas of the tables that the operators read and write. CSV is text at the edge and typed right behind it."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DoubleType, FloatType, IntegerType, LongType, StringType, StructType, TimestampType


def texts(*names: str) -> StructType:
    out = StructType()
    for n in names:
        out = out.add(n, StringType())
    return out


CATALOG = texts("url", "title", "description", "publish_date", "duration", "downloaded")
CATALOG_PROGRESS = texts(*CATALOG.names, "completed")
PLAYLIST = texts("url", "title", "description").add("duration_seconds", IntegerType())
#: Nested playlist entries; one level of entries, as an extractor returns them.
ENTRY = texts("_type", "webpage_url", "original_url", "url", "id", "title", "description", "duration", "duration_seconds", "duration_ms", "duration_string")
EXTRACTION = texts(*ENTRY.names, "channel_id", "playlist_id").add("entries", ArrayType(ENTRY))
FILES = StructType().add("path", StringType()).add("modificationTime", TimestampType()).add("length", LongType())
PROBE = StructType().add("path", StringType()).add("ok", BooleanType()).add("duration", DoubleType()).add("error", StringType())
METADATA = texts("id", "audio", "title", "description", "publish_date", "duration").add("duration_seconds", IntegerType())
MANIFEST = texts("id", "file_path", "title", "description", "publish_date", "duration").add("duration_seconds", IntegerType()).add("url", StringType())
SEGMENTS = StructType().add("file", StringType()).add("start", DoubleType()).add("end", DoubleType())
CUES = StructType().add("file", StringType()).add("idx", IntegerType()).add("start", DoubleType()).add("end", DoubleType()).add("text", StringType())
CLIPS = texts("audio", "id").add("duration", DoubleType()).add("genre", StringType()).add("album", StringType()).add("text", StringType())
AUDIO = ArrayType(ArrayType(FloatType()))
