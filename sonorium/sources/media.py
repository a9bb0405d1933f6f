"""Listings of media files: path, size and time, never their contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.texts import stem
from ..schemas import FILES, texts
from . import listing

EXTENSIONS = ("mp3", "wav", "opus", "m4a", "mp4", "webm", "flv", "mkv")


def files(spark: SparkSession, root: str, glob: str = "*.opus", recursive: bool = True) -> DataFrame:
    """(path, modificationTime, length, id) of the files below root, or in it, as they are now; id is the stem. Contents
    aren't read. Spark's file sources pass over empty files, and so does this. Executors list a mounted folder; for
    other file systems and patterns, Spark lists on the driver."""
    at = None if set("{}\\") & set(glob) else listing.mounted(root)
    if at is not None:
        found = listing.stats(spark, at, glob, recursive)
    else:
        reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
        found = reader.load(root).select(F.regexp_replace("path", "^file:/*", "/").alias("path"), "modificationTime", "length")
    return found.withColumn("id", stem(F.col("path")))


def media(spark: SparkSession, root: str) -> DataFrame:
    """Media files of a folder by extension, in any case, in the order of their paths; none if the folder can't be listed."""
    try:
        found = files(spark, root, "*", recursive=False)
    except AnalysisException:
        return spark.createDataFrame([], StructType([*FILES.fields, *texts("id").fields]))
    return found.filter(F.lower("path").rlike(rf"\.({'|'.join(EXTENSIONS)})$")).orderBy("path")
