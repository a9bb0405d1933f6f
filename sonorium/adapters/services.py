"""Protocols of the outside services, stand-ins for tests, and how they meet DataFrames."""

from __future__ import annotations

import io
import os
import shutil
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from pathlib import Path
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from ..schemas import MANIFEST, PROBE, texts
from ..shared import spread
from .retry import Limiter, extract, recognise, recognise_all, share


class VideoApi(Protocol):
    def uploads_playlist(self, handle: str) -> str | None: ...
    def page(self, playlist: str, token: str | None, size: int) -> tuple[list[str], str | None]: ...
    def details(self, ids: list[str]) -> list[dict]: ...


class Extractor(Protocol):
    def extract(self, url: str) -> dict | None: ...


class Probe(Protocol):
    def duration(self, path: str) -> tuple[bool, float | None, str | None]: ...


class Hub(Protocol):
    def fetch(self, name: str) -> bytes | None: ...
    def put(self, name: str, data: bytes) -> None: ...
    def delete(self, name: str) -> None: ...


@dataclass
class MemoryVideoApi:
    """Pages of ids and their details held in memory."""

    playlists: dict[str, str]
    ids: dict[str, list[str]]
    records: dict[str, dict]

    def uploads_playlist(self, handle: str) -> str | None:
        return self.playlists.get(handle)

    def page(self, playlist: str, token: str | None, size: int) -> tuple[list[str], str | None]:
        at = int(token or 0)
        ids = self.ids[playlist]
        return ids[at : at + size], str(at + size) if at + size < len(ids) else None

    def details(self, ids: list[str]) -> list[dict]:
        return [self.records[i] for i in ids if i in self.records]


@dataclass
class MemoryHub:
    files: dict[str, bytes] = field(default_factory=dict)

    def fetch(self, name: str) -> bytes | None:
        return self.files.get(name)

    def put(self, name: str, data: bytes) -> None:
        self.files[name] = data

    def delete(self, name: str) -> None:
        """A file that isn't there is no error."""
        self.files.pop(name, None)


@dataclass
class FolderHub:
    """Files of a hub kept in a folder."""

    folder: str

    def fetch(self, name: str) -> bytes | None:
        path = Path(self.folder, name)
        return path.read_bytes() if path.exists() else None

    def put(self, name: str, data: bytes) -> None:
        path = Path(self.folder, name)
        path.parent.mkdir(parents=True, exist_ok=True)
        aside = path.with_name(f".{path.name}.{os.getpid()}")
        aside.write_bytes(data)
        os.replace(aside, path)

    def delete(self, name: str) -> None:
        Path(self.folder, name).unlink(missing_ok=True)


def previous_manifest(spark: SparkSession, hub: Hub, name: str, schema: StructType = MANIFEST) -> DataFrame:
    """The published manifest, all columns as text; an empty table of that schema's columns if it can't be had or read."""
    try:
        frame = pd.read_csv(io.BytesIO(hub.fetch(name) or b""), dtype=str, keep_default_na=False)
    except Exception:  # noqa: BLE001 - whatever goes wrong, publishing starts from nothing
        return spark.createDataFrame([], texts(*schema.names))
    return spark.createDataFrame(frame.values.tolist(), texts(*map(str, frame.columns)))


def publish_manifest(manifest: DataFrame, hub: Hub, name: str, obsolete: Iterable[str] = ()) -> int:
    """Uploads the manifest as one CSV file, then removes obsolete files, missing ones silently. Returns the rows.

    The hub takes a manifest as one file: it is gathered on the driver, a line a published recording.
    """
    lines = [list(r) for r in manifest.collect()]
    hub.put(name, pd.DataFrame(lines, columns=manifest.columns).to_csv(index=False).encode())
    for other in obsolete:
        hub.delete(other)
    return len(lines)


def list_ids(api: VideoApi, handle: str, size: int = 50) -> list[str]:
    """All ids of a channel's uploads, page by page, repeats and all; an error if there is no such channel."""
    playlist = api.uploads_playlist(handle)
    if not playlist:
        raise LookupError(f"no uploads of {handle}")
    out, token = [], None
    while True:
        ids, token = api.page(playlist, token, size)
        out += ids
        if not token:
            return out


def lookup(ids: DataFrame, api: VideoApi, schema: str, key: str = "id", size: int = 50) -> DataFrame:
    """Details of the ids, asked for in batches; ids that the service doesn't return are left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            wanted = f[key].tolist()
            rows = [r for at in range(0, len(wanted), size) for r in api.details(wanted[at : at + size])]
            if rows:
                yield pd.DataFrame(rows)

    return ids.select(key).mapInPandas(run, schema)


def fetch_playlist(extractor: Extractor, url: str, uploads: Callable[[dict], str | None], rows_of: Callable[[dict], list], progress: Callable[[int, int], None] | None = None, status: Callable[[str], None] | None = None, sleep: Callable[[float], None] = lambda _: None) -> list:
    """Rows of a playlist; a channel without any falls back once to its uploads. No rows at all are a ValueError."""
    info = extract(lambda: extractor.extract(url), sleep=sleep)
    rows = rows_of(info)
    other = uploads(info)
    if not rows and other and other != url:
        if status:
            status(f"No entries in {url}; trying {other}")
        rows = rows_of(extract(lambda: extractor.extract(other), sleep=sleep))
    if not rows:
        raise ValueError(f"no entries in {url}")
    if progress:
        for i in range(len(rows) + 1):
            progress(i, len(rows))
    return rows


def probe(paths: DataFrame, prober: Probe) -> DataFrame:
    """(path, ok, duration, error) of distinct paths; filter first, for nothing moves a filter through this."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found = [(p, *prober.duration(p)) for p in f["path"]]
            yield pd.DataFrame(found, columns=["path", "ok", "duration", "error"])

    return spread(paths.select("path"), "path").mapInPandas(run, PROBE)


def transcribe(segments: DataFrame, keys: list[str], client: Callable[..., tuple[int, str]], max_rpm: int = 60, tasks: int = 1, retries: int = 3, base: float = 0.8, rounds: int = 3, threads: int = 4, sleep: Callable[[float], None] | None = None, **options: object) -> DataFrame:
    """(keys, text): client(row, **options) gives (status, text); tasks share the rate limit evenly, and each asks from
    so many threads.

    options hold language, system_prompt (None: the default, empty: no message) and the like; ``language="auto"`` is
    left out.
    """
    sent = {k: v for k, v in options.items() if not (k == "language" and v == "auto")}
    pause = {"sleep": sleep} if sleep else {}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = Limiter(share(max_rpm, tasks))
        for f in frames:
            rows = f.to_dict("records")
            text = recognise_all(rows, lambda r: recognise(lambda: client(r, **sent), retries, base, limiter, **pause), rounds, base, threads=threads, **pause)
            yield f[keys].assign(text=text)

    schema = segments.select(*keys).schema.add("text", "string")
    return segments.coalesce(tasks).mapInPandas(run, schema)


def voice_activity(files: DataFrame, detector: Callable[[str], list[tuple[float, float]]]) -> DataFrame:
    """(file, start, end) of speech; a file on which the detector fails has none."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for path in f["path"]:
                try:
                    out += [(path, float(a), float(b)) for a, b in detector(path)]
                except Exception:  # noqa: BLE001
                    continue
            yield pd.DataFrame(out, columns=["file", "start", "end"])

    return spread(files.select("path"), "path").mapInPandas(run, "file string, start double, end double")


def execute(plan: DataFrame, act: Callable[[dict], None], dry_run: bool = True) -> tuple[int, int]:
    """(done, failed) of a plan's rows, acted on by the executors; a dry run counts only.

    A task may run again, so act must take what an earlier run did for done.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            done = failed = 0
            for row in f.to_dict("records"):
                try:
                    if not dry_run:
                        act(row)
                    done += 1
                except OSError:
                    failed += 1
            yield pd.DataFrame({"done": [done], "failed": [failed]})

    found = spread(plan).mapInPandas(run, "done long, failed long").agg(F.coalesce(F.sum("done"), F.lit(0)), F.coalesce(F.sum("failed"), F.lit(0))).first()
    return found[0], found[1]


def move(row: dict) -> None:
    """A file whose target is there and which itself is gone was moved before."""
    if not os.path.exists(row["path"]) and os.path.exists(row["target"]):
        return
    Path(row["target"]).parent.mkdir(parents=True, exist_ok=True)
    shutil.move(row["path"], row["target"])


def stage(row: dict) -> None:
    """A hard link, or a copy where links aren't possible; what is there with the same size stays."""
    if os.path.exists(row["target"]) and os.path.getsize(row["target"]) == os.path.getsize(row["path"]):
        return
    Path(row["target"]).parent.mkdir(parents=True, exist_ok=True)
    try:
        os.link(row["path"], row["target"])
    except OSError:
        shutil.copy2(row["path"], row["target"])


def remove(row: dict) -> None:
    os.remove(row["path"])


def missing_tools(*names: str) -> list[str]:
    return [n for n in names if shutil.which(n) is None]


def api_key(name: str, env: dict[str, str] | None = None, dotenv: Path | None = None) -> str:
    """A key from the environment, else from KEY=VALUE lines; comments are skipped, quotes stripped. None is an error."""
    found = (os.environ if env is None else env).get(name, "").strip()
    if not found and dotenv and dotenv.exists():
        for line in dotenv.read_text().splitlines():
            k, eq, v = line.strip().partition("=")
            if eq and not k.startswith("#") and k.strip() == name:
                found = v.strip().strip("'\"")
    if not found:
        raise LookupError(f"{name} is not set")
    return found
