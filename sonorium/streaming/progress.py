"""The per-row checkpoint of a resumable job: outcomes are appended, the latest of each key is the state.

Beyond the batch form this offers a stream: outcomes that arrive as files keep the state table up to date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LOG = "id string, completed string, at timestamp"


def append(outcomes: DataFrame, log: str) -> None:
    outcomes.select("id", "completed", "at").write.mode("append").parquet(log)


def latest(log: DataFrame) -> DataFrame:
    """(id, completed, at): each key's last outcome; of equal times TRUE wins. A hash aggregate."""
    return log.groupBy("id").agg(F.max(F.struct("at", "completed")).alias("m")).select("id", "m.completed", "m.at")


def apply(catalog: DataFrame, log: DataFrame, key: str = "id") -> DataFrame:
    """catalog with completed from the log, FALSE where there is no outcome."""
    state = latest(log).select(F.col("id").alias(key), F.col("completed").alias("_done"))
    return catalog.drop("completed").join(state, key, "left").withColumn("completed", F.coalesce("_done", F.lit("FALSE"))).drop("_done")


def follow(spark: SparkSession, log: str, sink: str, checkpoint: str) -> StreamingQuery:
    """Keeps the latest outcomes of a growing log in memory table ``sink``; runs through what is there and stops."""
    stream = spark.readStream.schema(LOG).parquet(log)
    return latest(stream).writeStream.outputMode("complete").format("memory").queryName(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
