"""Downloads, extraction, cutting and probing of media: what a service does is a protocol, what is done when is a plan."""

from __future__ import annotations

import json
import os
import shutil
import subprocess
import tempfile
import wave
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..shared import spread

RATE, FALLBACK_BITRATE = 16_000, "96k"
HELD = 8 << 20  # bytes of samples read at once


class Downloader(Protocol):
    def download(self, url: str, target: str, rate: int) -> bool:
        """Writes the audio behind url at target, or at target with another extension; False if it can't."""


class Codec(Protocol):
    def extract(self, source: str, target: str, rate: int) -> None:
        """One channel of source at that rate."""

    def cut(self, source: str, target: str, start: float, duration: float, codec: str) -> bool:
        """A piece of source, with its stream copied or encoded anew; False if that codec can't do it."""


def download(rows: DataFrame, downloader: Downloader, folder: str, key: str = "id", extension: str = "opus", rate: int = RATE, skip_existing: bool = True, pause: Callable[[], None] = lambda: None) -> DataFrame:
    """(key, path, downloaded, reused) of (key, url) rows, files <key>.<extension> in a folder that all executors share.

    A file that is there is reused. A download that left another extension counts under its own name. What fails has
    no path. An interrupted task leaves nothing that looks whole: files are written aside and renamed. A task has a
    hidden folder for the one file it works on, so that finding its extension lists that file and not all others.
    """

    def fetch(name: str, url: str, aside: str) -> tuple[str | None, bool]:
        target = os.path.join(folder, f"{name}.{extension}")
        if skip_existing and os.path.exists(target):
            return target, True
        try:
            done = downloader.download(url, os.path.join(aside, f"{name}.{extension}"), rate)
        except Exception:  # noqa: BLE001 - a service's trouble is a failed row
            done = False
        pause()
        found = next((n for n in sorted(os.listdir(aside)) if n.startswith(f"{name}.")), None) if done else None
        if found is not None:
            target = os.path.join(folder, f"{name}{os.path.splitext(found)[1]}")
            os.replace(os.path.join(aside, found), target)
        for other in os.scandir(aside):
            shutil.rmtree(other.path) if other.is_dir() else os.remove(other.path)
        return (target if found is not None else None), False

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        aside = tempfile.mkdtemp(prefix=".", dir=folder)
        try:
            for f in frames:
                found = [fetch(str(k), u, aside) for k, u in zip(f[key], f["url"])]
                yield pd.DataFrame({key: f[key], "path": [p for p, _ in found], "downloaded": [p is not None for p, _ in found], "reused": [r for _, r in found]})
        finally:
            shutil.rmtree(aside, ignore_errors=True)

    kind = rows.schema[key].dataType.simpleString()
    return spread(rows.select(key, "url"), key).mapInPandas(run, f"`{key}` {kind}, path string, downloaded boolean, reused boolean")


def extract(files: DataFrame, codec: Codec, folder: str, rate: int = RATE) -> DataFrame:
    """(path, wav): one channel of each file at the rate, as <stem>.wav in a shared folder."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for f in frames:
            out = []
            for path in f["path"]:
                target = os.path.join(folder, os.path.splitext(os.path.basename(path))[0] + ".wav")
                codec.extract(path, f"{target}.{os.getpid()}", rate)
                os.replace(f"{target}.{os.getpid()}", target)
                out.append(target)
            yield pd.DataFrame({"path": f["path"], "wav": out})

    return spread(files.select("path"), "path").mapInPandas(run, "path string, wav string")


def cut_clips(plan: DataFrame, codec: Codec, folder: str, overwrite: bool = False) -> DataFrame:
    """(clip_name, made): how each clip of a plan (path, clip_name, start, duration) came about: reused, copy or its fallback codec.

    A clip that is there is reused unless it is to be overwritten. The stream is copied; where that fails it is
    encoded anew, and where that fails too the task does. A duration that isn't positive is an error.
    """

    def one(path: str, name: str, start: float, duration: float) -> str:
        if not duration > 0:
            raise ValueError(f"{name} has no duration")
        target = os.path.join(folder, name)
        if not overwrite and os.path.exists(target):
            return "reused"
        aside = os.path.join(folder, f".{os.getpid()}-{name}")
        for kind in ("copy", f"libopus {FALLBACK_BITRATE}"):
            if codec.cut(path, aside, start, duration, kind):
                os.replace(aside, target)
                return kind.split()[0]
        raise OSError(f"{name} can't be cut from {path}")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for f in frames:
            yield pd.DataFrame({"clip_name": f["clip_name"], "made": [one(*x) for x in zip(f["path"], f["clip_name"], f["start"], f["duration"])]})

    return spread(plan.select("path", "clip_name", "start", "duration"), "clip_name").mapInPandas(run, "clip_name string, made string")


@dataclass
class WaveCodec:
    """Extraction and cutting of PCM wave files with the standard library; ``copies`` says which sources allow a stream copy."""

    copies: Callable[[str], bool] = lambda _: True

    def extract(self, source: str, target: str, rate: int) -> None:
        with wave.open(source) as a, wave.open(target, "wb") as b:
            width, channels, step = a.getsampwidth(), a.getnchannels(), max(1, a.getframerate() // rate)
            b.setparams((1, width, rate, 0, "NONE", ""))
            held = max(1, HELD // (width * channels * step)) * step  # whole steps, so that each piece begins with a kept frame
            while data := a.readframes(held):
                b.writeframes(np.frombuffer(data, f"V{width}", len(data) // width)[:: channels * step].tobytes())

    def cut(self, source: str, target: str, start: float, duration: float, codec: str) -> bool:
        if codec == "copy" and not self.copies(source):
            return False
        with wave.open(source) as a, wave.open(target, "wb") as b:
            a.setpos(min(a.getnframes(), round(start * a.getframerate())))
            b.setparams(a.getparams())
            b.writeframes(a.readframes(round(duration * a.getframerate())))
        return True


class WaveProbe:
    """Durations of PCM wave files from their headers."""

    def duration(self, path: str) -> tuple[bool, float | None, str | None]:
        try:
            with wave.open(path) as w:
                return True, w.getnframes() / w.getframerate(), None
        except (OSError, EOFError, wave.Error) as e:
            return False, None, str(e) or type(e).__name__


@dataclass
class ToolProbe:
    """Durations that a command line tool reports as JSON {"format": {"duration": "1.5"}}; what can't be read is 0."""

    command: tuple[str, ...]
    timeout: float = 30.0

    def duration(self, path: str) -> tuple[bool, float | None, str | None]:
        try:
            done = subprocess.run([*self.command, path], capture_output=True, text=True, timeout=self.timeout)
        except (OSError, subprocess.TimeoutExpired) as e:
            return False, None, str(e)
        if done.returncode:
            return False, None, done.stderr.strip() or f"exit status {done.returncode}"
        try:
            return True, float(json.loads(done.stdout)["format"]["duration"]), None
        except (ValueError, KeyError, TypeError):
            return True, 0.0, None
