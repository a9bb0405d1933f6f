"""Video ids and canonical addresses.

Three dialects of the video id are in use: ``watch_id_exact`` (one host, short links with their query), ``watch_id``
(two hosts) and ``watch_id_lenient`` (trailing slashes, any www.), which is the canonical one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .texts import coerce_text

WATCH, PLAYLIST = "https://www.youtube.com/watch?v=", "https://www.youtube.com/playlist?list="
#: What a URL's authority has before and after its host.
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host(url: Column) -> Column:
    """The host in lower case; null without one."""
    return F.nullif(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def query_param(url: Column, name: str) -> Column:
    """The first non-empty value of a query parameter, percent-decoded; null without one."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    raw = F.regexp_extract(query, rf"(?:^|&){name}=([^&]+)", 1)
    return F.nullif(F.coalesce(F.try_url_decode(raw), raw), F.lit(""))


def _last(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def watch_id_exact(url: Column) -> Column:
    short = F.contains(url, F.lit("youtu.be"))
    return F.when(short, _last(url)).when(host(url) == "www.youtube.com", query_param(url, "v"))


def watch_id(url: Column) -> Column:
    short = F.contains(url, F.lit("youtu.be"))
    return F.when(short, F.substring_index(_last(url), "?", 1)).when(host(url).isin("www.youtube.com", "youtube.com"), query_param(url, "v"))


def watch_id_lenient(url: Column) -> Column:
    short = F.contains(url, F.lit("youtu.be"))
    bare = F.substring_index(_last(F.regexp_replace(url, "/+$", "")), "?", 1)
    return F.when(short, bare).when(F.replace(host(url), F.lit("www."), F.lit("")) == "youtube.com", query_param(url, "v"))


def watch_url(video_id: Column) -> Column:
    return F.concat(F.lit(WATCH), video_id)


def uploads_url(playlist_id: Column, channel_id: Column) -> Column:
    """The address of a channel's uploads: UU... as it is, UC... made UU..., else null."""
    p, c = coerce_text(playlist_id), coerce_text(channel_id)
    found = F.when(p.startswith("UU"), p).when(c.startswith("UC"), F.concat(F.lit("UU"), F.substring(c, 3, 1 << 30)))
    return F.concat(F.lit(PLAYLIST), found)


def entry_url(webpage_url: Column, original_url: Column, url: Column, video_id: Column) -> Column:
    """The first address that isn't empty, else one made of the id; null if there is neither."""
    first = coerce_text(F.coalesce(*(F.nullif(c, F.lit("")) for c in (webpage_url, original_url, url))))
    return F.coalesce(F.nullif(first, F.lit("")), watch_url(F.nullif(coerce_text(video_id), F.lit(""))))
