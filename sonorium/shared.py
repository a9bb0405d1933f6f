"""Tables written once to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only on a local master, where it may be unset, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if getattr(shared_dir, "local", None) is None:
        shared_dir.local = tempfile.mkdtemp(prefix="sonorium-")
    return shared_dir.local


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df over as many tasks as shuffles have, or as there are cores: what is done for a row weighs more than the row.

    Rows of equal keys share a task. Sizes can't say this, for a row that names a file is small. The keys are hashed
    first: a grouping by the keys themselves would stand in for this, and its tasks are merged by size.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, F.xxhash64(*keys)) if keys else df.repartition(n)


def written(df: DataFrame, name: str) -> DataFrame:
    """df, computed once: written and read back, so that all that is made of it sees the same rows in the same places."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
