"""Data source ``tarshards``: tar shards as rows, one partition per shard; also a sink and a stream.

Rows are members (url, seq, fname, data) or, with ``grouped=true``, whole samples (url, run, key, seq, fields),
folded where the shard is read: no shuffle.  Reading options: ``payload=false`` leaves data null (names only),
``match`` is a regular expression over member names, ``rename`` a ``pattern=replacement`` applied before it,
``on_error`` is fail or skip (the rest of a broken shard; a row ``__error__`` says why), ``pushdown=true`` opens only
the shards that a condition on url leaves; for groups ``suffixes``, ``lower``, ``interleave`` and ``duplicates`` (fail
or skip).  Writing: rows (shard, key, fields) or members (shard, fname, data), sorted by shard within each task.
"""

from __future__ import annotations

import glob
import io
import json
import os
import re
import tarfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualTo, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions.urls import MEMBER, expand_urls
from .openers import arrow_file_system, cached, open_url

SCHEMA = "url string, seq int, fname string, data binary"
SAMPLES = "url string, run bigint, key string, seq int, fields map<string,binary>"
_MEMBERS = pa.schema([("url", pa.string()), ("seq", pa.int32()), ("fname", pa.string()), ("data", pa.binary())])
_SAMPLES = pa.schema([("url", pa.string()), ("run", pa.int64()), ("key", pa.string()), ("seq", pa.int32()), ("fields", pa.map_(pa.string(), pa.binary()))])
#: Bytes and rows of one batch handed to the JVM.
BATCH_BYTES, BATCH_ROWS = 16 << 20, 4096
#: Name of the row that tells of a broken shard; like all ``__x__`` names it is no data.
ERROR = "__error__"
_META = re.compile(r"__[^/]*__($|/)")
_MEMBER, _PART = re.compile(MEMBER), re.compile(r"\d+\.")


@dataclass
class Shard(InputPartition):
    url: str

    def __init__(self, url: str):
        self.url = url


def list_shards(path: str) -> list[str]:
    """Sorted shards of a folder, glob, or URL list with ``::`` and braces.

    A URL that ends with ``/`` is a folder of a file system that Arrow knows; hidden files and folders are left out.
    """
    out = []
    for u in expand_urls(path):
        local = re.sub("^file:(//)?", "", u)
        if os.path.isdir(local):
            out += sorted(f for ext in ("tar", "tgz", "tar.gz") for f in glob.glob(f"{local}/**/*.{ext}", recursive=True))
        elif any(c in local for c in "*?[") and "://" not in local:
            out += sorted(glob.glob(local))
        elif u.endswith("/") and "://" in u:
            out += list_folder(u)
        else:
            out.append(u)
    return out


def list_folder(url: str) -> list[str]:
    """Sorted shards below a folder, by Arrow's file systems."""
    from pyarrow import fs

    where, folder = arrow_file_system(url.rstrip("/"))
    files = where.get_file_info(fs.FileSelector(folder, recursive=True))
    names = (f.path[len(folder) :].lstrip("/") for f in files if f.type == fs.FileType.File)
    return sorted(f"{url.rstrip('/')}/{n}" for n in names if n.endswith((".tar", ".tgz", ".tar.gz")) and not re.search(r"(^|/)[._]", n))


def members(stream: io.IOBase, payload: bool = True, match: str | None = None, rename: str | None = None) -> Iterator[tuple[int, str, bytes | None]]:
    """Regular members of a tar stream, compressed or not; hidden ``__x__`` names are passed over."""
    pick = re.compile(match).search if match else None
    swap = rename.split("=", 1) if rename else None
    with tarfile.open(fileobj=stream, mode="r|*") as tar:
        for seq, m in enumerate(tar):
            if m.isreg() and m.name and not _META.match(m.name):
                name = re.sub(swap[0], swap[1], m.name) if swap else m.name
                if pick is None or pick(name):
                    yield seq, name, tar.extractfile(m).read() if payload else None
            tar.members = []


def fold_members(found: Iterable[tuple[int, str, bytes | None]], suffixes: list[str] | None = None, lower: bool = True, interleave: bool = True, duplicates: str = "fail") -> Iterator[tuple[int, str, int, dict]]:
    """(run, key, seq, fields) of members in the order of their shard; one sample is held at a time.

    The same rule as :func:`shardweave.operators.samples.group_members`, for members that come in order.
    """
    run, key, opened, first, fields = -1, None, None, 0, {}
    for seq, name, data in found:
        m = _MEMBER.match(name)
        if not m:
            continue
        base, ext = m[1], m[2].lower() if lower else m[2]
        if interleave:
            if ext == "json":
                opened = base
            if opened is not None and base.startswith(f"{opened}-"):
                base, ext = opened, f"{base[len(opened) + 1 :]}.{ext}"
        if base != key:
            if fields:
                yield run, key, first, fields
            run, key, fields = run + 1, base, {}
        if suffixes is not None and ext not in suffixes:
            continue
        if ext in fields:
            if duplicates == "fail":
                raise ValueError(f"{name}: field {ext} comes twice in sample {base}")
            continue
        first = seq if not fields else first
        fields[ext] = data
    if fields:
        yield run, key, first, fields


def _members_of(url: str, options: dict[str, str]) -> Iterator[tuple[int, str, bytes | None]]:
    where = cached(url, options.get("cache_dir"), int(options.get("cache_size", -1))) if options.get("cache", "false") == "true" else url
    with open_url(where, "rb", options.get("allow_pipes", "false") == "true") as stream:
        yield from members(stream, options.get("payload", "true") != "false", options.get("match"), options.get("rename"))


def _rows(url: str, options: dict[str, str]) -> Iterator[tuple[tuple, int]]:
    """(row, its bytes) of a shard; with ``on_error=skip`` an error becomes the shard's last row."""
    grouped = options.get("grouped", "false") == "true"
    try:
        if grouped:
            names = options.get("suffixes")
            flags = {k: options.get(k, "true") != "false" for k in ("lower", "interleave")}
            for run, key, seq, fields in fold_members(_members_of(url, options), names.split(";") if names else None, duplicates=options.get("duplicates", "fail"), **flags):
                yield (url, run, key, seq, list(fields.items())), sum(len(x or b"") for x in fields.values())
        else:
            for seq, name, data in _members_of(url, options):
                yield (url, seq, name, data), len(data or b"")
    except Exception as e:
        if options.get("on_error", "fail") == "fail":
            raise RuntimeError(f"{url}: {e}") from e
        told = str(e).encode()
        yield (url, None, ERROR, -1, [("__bad__", told)]) if grouped else (url, -1, ERROR, told), len(told)


def _read(url: str, options: dict[str, str]) -> Iterator[pa.RecordBatch]:
    schema = _SAMPLES if options.get("grouped", "false") == "true" else _MEMBERS
    rows, held = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    for row, size in _rows(url, options):
        rows.append(row)
        held += size
        if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()


class TarReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def partitions(self) -> list[Shard]:
        return [Shard(u) for u in list_shards(self.options["path"])]

    def read(self, partition: Shard) -> Iterator[pa.RecordBatch]:
        return _read(partition.url, self.options)


class PushingTarReader(TarReader):
    """Opens only the shards that a condition on ``url`` leaves; the condition itself is checked again by Spark."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.urls: set[str] | None = None

    def pushFilters(self, filters: list) -> Iterator:  # noqa: N802 - Spark's name
        for f in filters:
            if getattr(f, "attribute", None) == ("url",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
                if wanted is not None:
                    self.urls = wanted if self.urls is None else self.urls & wanted
            yield f

    def partitions(self) -> list[Shard]:
        return [s for s in super().partitions() if self.urls is None or s.url in self.urls] or [Shard("")]

    def read(self, partition: Shard) -> Iterator[pa.RecordBatch]:
        return _read(partition.url, self.options) if partition.url else iter(())


class TarStreamReader(DataSourceStreamReader):
    """New shards of a folder as they appear, whatever their names.

    The offset is the time of the newest shard seen and the names of the shards that carry that very time, so it
    stays small.  A shard must be complete when it gets its name, as those of the sink are.
    """

    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def _listed(self) -> list[tuple[int, str]]:
        return sorted((os.stat(re.sub("^file:(//)?", "", u)).st_mtime_ns, u) for u in list_shards(self.options["path"]))

    def initialOffset(self) -> dict:  # noqa: N802 - Spark's name
        return {"at": 0, "names": []}

    def latestOffset(self) -> dict:  # noqa: N802
        found = self._listed()
        return {"at": found[-1][0], "names": [u for t, u in found if t == found[-1][0]]} if found else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Shard]:
        def after(t: int, u: str, mark: dict) -> bool:
            return t > mark["at"] or (t == mark["at"] and u not in mark["names"])

        return [Shard(u) for t, u in self._listed() if after(t, u, start) and not after(t, u, end)]

    def read(self, partition: Shard) -> Iterator[pa.RecordBatch]:
        return _read(partition.url, self.options)

    def commit(self, end: dict) -> None:
        pass


def named_fields(key: str, fields: list[tuple[str, bytes]], meta: bool = False) -> list[tuple[str, bytes]]:
    """Members of a sample in the order of their names; fields ``0.jpg``, ``1.jpg`` ... become ``KEY-0.jpg`` and come after the json that opens the sample."""
    shown = [(k, v) for k, v in sorted(fields, key=lambda x: x[0]) if meta or not k.startswith("_")]
    parts = [(k, v) for k, v in shown if _PART.match(k)]
    return [(f"{key}.{k}", v) for k, v in shown if not _PART.match(k)] + [(f"{key}-{k}", v) for k, v in sorted(parts, key=lambda x: (int(x[0].split(".")[0]), x[0]))]


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class TarWriter(DataSourceArrowWriter):
    """One tar per value of ``shard``; files appear under their names only when the whole job commits.

    The driver makes a staging folder at the target and every task must find it there: a folder that the executors
    do not share is refused instead of leaving each part on the disk of its machine.
    """

    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.options, self.names = options["path"].rstrip("/"), dict(options), schema.names
        need = {"shard", "key", "fields"} if "fields" in self.names else {"shard", "fname", "data"}
        if lost := need - set(self.names):
            raise ValueError(f"columns {sorted(lost)} are missing")
        self.staging = f"{self.path}/.staging-{uuid.uuid4().hex}"
        where, folder = arrow_file_system(self.staging)
        where.create_dir(folder)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyarrow import fs

        where, folder = arrow_file_system(self.staging)
        if where.get_file_info(folder).type != fs.FileType.Directory:
            raise RuntimeError(f"{self.path} is not shared: the folder made by the driver is not there on this machine")
        mtime, mode = float(self.options.get("mtime", 0)), int(self.options.get("mode", "0444"), 8)
        meta = self.options.get("keep_meta", "false") == "true"
        files, tar, out, now = [], None, None, object()

        def close() -> None:
            if tar:
                tar.close()
                out.close()

        for b in batches:
            columns = {n: b.column(b.schema.get_field_index(n)) for n in self.names}
            second = columns["key" if "fields" in columns else "fname"].to_pylist()
            third = columns["fields" if "fields" in columns else "data"].to_pylist()
            for shard, key, value in zip(columns["shard"].to_pylist(), second, third, strict=True):
                if shard != now:  # a task may get several shards, one after the other
                    close()
                    now = shard
                    name = now if isinstance(now, str) else self.options.get("pattern", "shard-%06d.tar") % now
                    part = f"{folder}/{uuid.uuid4().hex}-{os.path.basename(name)}"
                    files.append((part, name))
                    out = where.open_output_stream(part, compression=None)
                    tar = tarfile.open(fileobj=out, mode="w|gz" if name.endswith("gz") else "w|", format=tarfile.PAX_FORMAT)
                pairs = named_fields(key, value or [], meta) if "fields" in columns else [(key, value)]
                for name, data in pairs:
                    if data is None:
                        continue
                    m = tarfile.TarInfo(name)
                    m.size, m.mtime, m.mode = len(data), mtime, mode
                    m.uname, m.gname = self.options.get("user", "bigdata"), self.options.get("group", "bigdata")
                    tar.addfile(m, io.BytesIO(data))
        close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        where, folder = arrow_file_system(self.path)
        done = []
        for m in messages:
            for part, name in m.files if m else ():
                if "/" in name:
                    where.create_dir(f"{folder}/{os.path.dirname(name)}")
                where.move(part, f"{folder}/{name}")
                done.append(f"{self.path}/{name}")
        if self.options.get("manifest"):
            with where.open_output_stream(f"{folder}/{self.options['manifest']}") as out:
                out.write(json.dumps(sorted(done)).encode())
        where.delete_dir(arrow_file_system(self.staging)[1])

    def abort(self, messages: list[Written | None]) -> None:
        where, folder = arrow_file_system(self.staging)
        where.delete_dir(folder)


class TarShards(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tarshards"

    def schema(self) -> str:
        return SAMPLES if self.options.get("grouped", "false") == "true" else SCHEMA

    def reader(self, schema: StructType) -> TarReader:
        return PushingTarReader(self.options) if self.options.get("pushdown", "false") == "true" else TarReader(self.options)

    def streamReader(self, schema: StructType) -> TarStreamReader:  # noqa: N802
        return TarStreamReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> TarWriter:
        return TarWriter(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TarShards)


def _options(options: dict[str, object]) -> dict[str, str]:
    return {k: str(v).lower() if isinstance(v, bool) else ";".join(v) if isinstance(v, list) else str(v) for k, v in options.items() if v is not None}


def read_shards(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """(url, seq, fname, data), or with ``grouped=True`` the rows of :func:`read_samples`."""
    register(spark)
    if options.get("pushdown"):  # Spark refuses a reader that takes filters unless this is on
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("tarshards").options(**_options(options)).load(path)


def read_samples(spark: SparkSession, path: str, suffixes: list[str] | None = None, lower: bool = True, on_error: str = "fail", interleave: bool = True, **options: object) -> DataFrame:
    """(url, run, key, seq, fields): samples as they lie in their shards, folded while reading, without a shuffle.

    A shard that breaks raises ('fail') or ends with a sample ``__error__`` that holds the message under ``__bad__``
    ('skip'); a field that comes twice in a sample raises or its later copy is dropped.
    """
    return read_shards(spark, path, grouped=True, suffixes=suffixes, lower=lower, on_error=on_error, duplicates=on_error, interleave=interleave, **options)


def write_shards(df: DataFrame, path: str, order: str = "key", post: Callable[[str], None] | None = None, **options: object) -> list[str]:
    """Write (shard, key, fields) or (shard, fname, data): one shuffle by shard, sorted inside.

    Returns the shards written; ``post`` is called with each of them after the job has committed.
    """
    register(df.sparkSession)
    note = f".written-{uuid.uuid4().hex}.json"
    ready = df.repartition("shard").sortWithinPartitions("shard", order)
    ready.write.format("tarshards").options(**_options(options), manifest=note).mode("append").save(path)
    where, folder = arrow_file_system(f"{path.rstrip('/')}/{note}")
    with where.open_input_stream(folder) as src:
        done = json.loads(src.read())
    where.delete_file(folder)
    for shard in done if post else ():
        post(shard)
    return done
