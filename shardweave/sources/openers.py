"""Opening shards by URL inside tasks: local files, registered schemes, opt-in pipes, and a local cache.

Object stores are best read through Spark's own file systems; these openers serve what those do not know.
"""

from __future__ import annotations

import os
import re
import shlex
import subprocess
import sys
import uuid
from collections.abc import Callable
from typing import BinaryIO
from urllib.parse import urlparse
from urllib.request import urlopen

from ..functions.urls import CACHE_CHARS, rewrite_url

Opener = Callable[[str, str], BinaryIO]
#: Exit codes of a helper that stopped because its reader or writer did.
TOLERATED = (0, 141, 23, 26)
_openers: dict[str, Opener] = {}


class Pipe:
    """A subprocess as a binary stream; closing it checks the exit code."""

    def __init__(self, command: str, mode: str = "rb", tolerated: tuple[int, ...] = TOLERATED, timeout: float = 7200.0):
        side = {"rb": "stdout", "wb": "stdin"}.get(mode)
        if side is None:
            raise ValueError("a pipe is opened with rb or wb")
        self.tolerated, self.timeout = tolerated, timeout
        self.process = subprocess.Popen(command, shell=True, **{side: subprocess.PIPE})  # noqa: S602 - opt-in, see allow_pipes
        self.stream = getattr(self.process, side)

    def read(self, *n: int) -> bytes:
        return self.stream.read(*n)

    def write(self, data: bytes) -> int:
        return self.stream.write(data)

    def readline(self) -> bytes:
        return self.stream.readline()

    def close(self) -> None:
        self.stream.close()
        code = self.process.wait(self.timeout)
        if code not in self.tolerated:
            raise OSError(f"the command ended with {code}")

    def __enter__(self) -> Pipe:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def register_scheme(scheme: str, opener: Opener) -> None:
    _openers[scheme] = opener


def command_opener(read: str | None = None, write: str | None = None) -> Opener:
    """An opener that runs a command, ``{url}`` in it standing for the quoted URL; register it for schemes of your store."""

    def opener(url: str, mode: str) -> BinaryIO:
        template = read if mode == "rb" else write
        if template is None:
            raise ValueError(f"{urlparse(url).scheme}: cannot be opened with {mode}")
        return Pipe(template.format(url=shlex.quote(url)), mode)

    return opener


def _http(url: str, mode: str) -> BinaryIO:
    if mode != "rb":
        raise ValueError("http is read only")
    return urlopen(url)  # noqa: S310 - the scheme is http or https


for _scheme in ("http", "https"):
    register_scheme(_scheme, _http)


def arrow_file_system(path: str):
    """(file system, path in it): the local one, or by URI what Arrow knows (hdfs, viewfs, s3, gs, abfs)."""
    from pyarrow import fs

    if re.match("[A-Za-z][A-Za-z0-9+.-]*://", path) and not path.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    return fs.LocalFileSystem(), re.sub("^file:(//)?", "", path)


def arrow_opener(url: str, mode: str) -> BinaryIO:
    """A file of a file system that Arrow knows."""
    where, path = arrow_file_system(url)
    return where.open_input_stream(path, compression=None) if mode == "rb" else where.open_output_stream(path, compression=None)


for _scheme in ("hdfs", "viewfs", "s3a", "s3n", "abfs", "abfss"):
    register_scheme(_scheme, arrow_opener)


# Commands that write an object to their output or take it from their input, by scheme.
COMMANDS = {
    "s3": ("aws s3 cp {url} -", "aws s3 cp - {url}"),
    "gs": ("gsutil cat {url}", "gsutil cp - {url}"),
    "ais": ("ais get {url} -", "ais put - {url}"),
    "htgs": ("curl -s -L {url}", None),
    "sftp": ("curl -s {url}", "curl -s -T - {url}"),
    "ftps": ("curl -s {url}", "curl -s -T - {url}"),
    "scp": ("curl -s {url}", "curl -s -T - {url}"),
}
for _scheme, (_reads, _writes) in COMMANDS.items():
    register_scheme(_scheme, command_opener(_reads, _writes))


def routed(url: str) -> str:
    """The URL through the cache named in USE_AIS_FOR (schemes, colon-separated): ``s3://x`` becomes ``ais://s3/x``."""
    scheme, sep, rest = url.partition("://")
    return f"ais://{scheme}/{rest}" if sep and scheme in os.environ.get("USE_AIS_FOR", "").split(":") else url


def open_url(url: str, mode: str = "rb", allow_pipes: bool = False) -> BinaryIO:
    """Open a local path, ``file:`` URL, ``pipe:`` command (only if allowed) or a registered scheme."""
    if mode not in ("rb", "wb"):
        raise ValueError("shards are opened with rb or wb")
    if url == "-":
        return (sys.stdin if mode == "rb" else sys.stdout).buffer
    url = routed(rewrite_url(url))
    if url.startswith("pipe:"):
        if not allow_pipes:
            raise PermissionError("pipes are off; allow them where commands can be trusted")
        return Pipe(url[5:], mode)
    scheme = urlparse(url).scheme
    if scheme in ("", "file"):
        return open(re.sub("^file:(//)?", "", url), mode)  # noqa: SIM115 - the caller closes it
    if scheme not in _openers:
        raise ValueError(f"no opener for {scheme}:; register one")
    return _openers[scheme](url, mode)


def download(url: str, to: str, chunk: int = 1 << 20) -> None:
    """Copy in chunks under a temporary name, then rename."""
    part = f"{to}.{os.getpid()}-{uuid.uuid4().hex}"
    try:
        with open_url(url) as src, open(part, "wb") as dst:
            while data := src.read(chunk):
                dst.write(data)
        os.rename(part, to)
    finally:
        if os.path.exists(part):
            os.unlink(part)


def lru_cleanup(folder: str, limit: int) -> list[str]:
    """Delete the oldest files until the rest holds at most ``limit`` bytes; returns what went."""
    files = [os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs]
    order = sorted(files, key=lambda f: (os.stat(f).st_ctime_ns, f))
    total, gone = sum(os.path.getsize(f) for f in order), []
    for f in order:
        if total <= limit:
            break
        total -= os.path.getsize(f)
        os.unlink(f)
        gone.append(f)
    return gone


def is_archive(path: str) -> bool:
    """Whether a file is a tar or gzip file, by its magic bytes."""
    with open(path, "rb") as f:
        head = f.read(262)
    return head[:2] == b"\x1f\x8b" or head[257:262] == b"ustar"


def cached(url: str, folder: str | None = None, limit: int = -1) -> str:
    """Local path of a shard: itself if local, else its copy in the cache; what is no archive is deleted again.

    The cache folder is named by the caller or by WDS_CACHE (its size by WDS_CACHE_SIZE); there is no default.
    """
    parsed = urlparse(url)
    if parsed.scheme in ("", "file"):
        return re.sub("^file:(//)?", "", url)
    folder = folder or os.environ.get("WDS_CACHE")
    if not folder:
        raise ValueError(f"{url}: name a cache folder (cache_dir or WDS_CACHE)")
    limit = limit if limit >= 0 else int(os.environ.get("WDS_CACHE_SIZE", -1))
    where, name = os.path.split(parsed.path)
    to = os.path.join(folder, re.sub(CACHE_CHARS, "_", where.lstrip("/")), name)
    if not os.path.exists(to):
        os.makedirs(os.path.dirname(to), exist_ok=True)
        if limit > 0:
            lru_cleanup(folder, limit)
        download(url, to)
        if not is_archive(to):
            os.unlink(to)
            raise ValueError(f"{url} is no tar archive")
    return to
