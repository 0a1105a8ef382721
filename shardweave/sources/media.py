"""Media of samples: files opened in the tasks that need them, without listing or joining."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codecs import encode_png
from ..functions.y4m import Y4M
from .openers import open_url

# Known misspellings of paths, and where a file lies if it is not at its own place.
FIXES = (("data//", "data/"),)
FALLBACKS = (("process_videos", "videos"),)
_BLACK = re.compile(r"Black background:[^0-9]*(\d+)\s*,\s*(\d+)")


def fetch(path: str) -> bytes:
    """A media file, tried under its fallback names too; a black-background caption is a black image (PNG)."""
    if m := _BLACK.match(path):
        return encode_png(np.zeros((int(m[2]), int(m[1]), 3), np.uint8))
    for a, b in FIXES:
        path = path.replace(a, b)
    names = [path, *(path.replace(a, b) for a, b in FALLBACKS if a in path)]
    for name in names:
        try:
            with open_url(name) as f:
                return f.read()
        except FileNotFoundError:
            continue
    raise FileNotFoundError(" and ".join(names))


def load_media(df: DataFrame, paths: Column, names: Column, on_error: str = "fail", name: str = "media") -> DataFrame:
    """``df`` with ``name``: MAP of ``names`` to the bytes of ``paths`` (parallel arrays).

    A file that cannot be read raises ('fail') or drops its row ('skip').  Null arrays give an empty map.
    """
    columns = [c for c in df.columns if c != name]
    ready = df.select(*columns, F.coalesce(paths, F.array().cast("array<string>")).alias("__paths__"), F.coalesce(names, F.array().cast("array<string>")).alias("__names__"))
    schema = df.select(*columns).withColumn(name, F.lit(None).cast("map<string,binary>")).schema

    def load(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.map_(pa.string(), pa.binary())
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                kept, media = [], []
                for i, (ps, ns) in enumerate(zip(part.column(len(columns)).to_pylist(), part.column(len(columns) + 1).to_pylist(), strict=True)):
                    try:
                        media.append([(n, fetch(p)) for n, p in zip(ns, ps, strict=True)])
                        kept.append(i)
                    except Exception:
                        if on_error == "fail":
                            raise
                rows = part.take(pa.array(kept, pa.int64()))
                yield pa.RecordBatch.from_arrays([*rows.columns[: len(columns)], pa.array(media, kind)], names=[*columns, name])

    return ready.mapInArrow(load, schema)


class VideoReader(Protocol):
    """What a video plug-in gives: its number of frames, their rate, and frames by number (height x width x 3)."""

    frames: int
    fps: float

    def read(self, i: int) -> np.ndarray: ...


_readers: dict[str, Callable[[bytes], VideoReader]] = {"y4m": Y4M}


def register_video(extension: str, reader: Callable[[bytes], VideoReader]) -> None:
    """A reader for files of an extension; the sessions' Python workers must import the module that registers it."""
    _readers[extension.lower()] = reader


def open_video(path: str) -> VideoReader:
    ext = path.rsplit(".", 1)[-1].lower()
    if ext not in _readers:
        raise ImportError(f"no video reader for .{ext}; register one (built in: {', '.join(sorted(_readers))})")
    return _readers[ext](fetch(path))


VIDEO_INFO = "struct<frames:int,fps:double,duration:double,last_frame:int>"


def video_info(path: Column) -> Column:
    """STRUCT<frames, fps, duration, last_frame> of a video file; the last frame that is sure to be whole is the last but one."""

    @F.arrow_udf(VIDEO_INFO)
    def look(paths: pa.Array) -> pa.Array:
        rows = []
        for p in paths.to_pylist():
            v = None if p is None else open_video(p)
            rows.append(None if v is None else {"frames": v.frames, "fps": v.fps, "duration": v.frames / v.fps if v.fps else None, "last_frame": max(v.frames - 2, 0)})
        return pa.array(rows, pa.struct([("frames", pa.int32()), ("fps", pa.float64()), ("duration", pa.float64()), ("last_frame", pa.int32())]))

    return look(path)


def clip_frames(df: DataFrame, path: str, indices: str, name: str = "clip") -> DataFrame:
    """``df`` with ``name``: MAP of ``0.png``, ``1.png`` ... to the frames of the video at ``path`` numbered by ``indices`` (beyond the end: the last)."""
    columns = [c for c in df.columns if c != name]
    schema = df.select(*columns).withColumn(name, F.lit(None).cast("map<string,binary>")).schema
    at = columns.index(path), columns.index(indices)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, 16):
                part, clips = b.slice(start, 16), []
                for p, numbers in zip(part.column(at[0]).to_pylist(), part.column(at[1]).to_pylist(), strict=True):
                    v = open_video(p) if p is not None and numbers else None
                    clips.append([(f"{k}.png", encode_png(v.read(min(i, v.frames - 1)))) for k, i in enumerate(numbers)] if v else [])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(clips, pa.map_(pa.string(), pa.binary()))], names=[*columns, name])

    return df.select(*columns).mapInArrow(cut, schema)
