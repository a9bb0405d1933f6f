"""Playlists: nested entries to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.durations import entry_duration
from ..functions.texts import coerce_text
from ..functions.urls import entry_url, uploads_url
from ..schemas import ENTRY


def entries(extracted: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, entry): the entries in order without nulls; a record that has no entries is its own one.

    An empty list gives no row.
    """
    own = F.struct(*[F.col(f.name).alias(f.name) for f in ENTRY.fields])
    each = extracted.select(*keys, F.posexplode(F.coalesce(F.col("entries"), F.array(own))).alias("pos", "entry"))
    return each.filter("entry IS NOT NULL")


def resolve_stubs(flat: DataFrame, full: DataFrame) -> DataFrame:
    """flat with stubs (_type = url) replaced by the full record of their address (url, full); kept if there is none."""
    stub = F.coalesce(F.col("entry._type") == "url", F.lit(False))
    keyed = flat.withColumn("_url", F.when(stub, F.col("entry.url")))
    met = keyed.join(full.select(F.col("url").alias("_url"), F.col("full").alias("_full")), "_url", "left")
    return met.withColumn("entry", F.coalesce("_full", "entry")).drop("_url", "_full")


def rows(flat: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, url, title, description, duration_seconds); entries without address and id are dropped."""
    e = lambda c: F.col(f"entry.{c}")
    url = entry_url(e("webpage_url"), e("original_url"), e("url"), e("id"))
    seconds = entry_duration(e("duration"), e("duration_seconds"), e("duration_ms"), e("duration_string"))
    return flat.select(*keys, "pos", url.alias("url"), coerce_text(e("title")).alias("title"), coerce_text(e("description")).alias("description"), seconds.alias("duration_seconds")).filter("url IS NOT NULL")


def uploads(extracted: DataFrame) -> DataFrame:
    return extracted.withColumn("uploads_url", uploads_url(F.col("playlist_id"), F.col("channel_id")))
