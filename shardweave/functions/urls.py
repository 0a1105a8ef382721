"""Shard lists, URLs and paths: driver-side expansion and Column forms."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: schemes that name a remote object in a ``pipe:`` command.
REMOTE = r"^(https?|gs|ais|s3):"
# Fixed value: a member's path and name up to the first dot of the file name, and all that follows it.
MEMBER = r"^((?:.*/|)[^.]+)[.]([^/]*)$"
# Fixed value: characters of a cached shard's folder that become ``_``.
CACHE_CHARS = "[:/|;]"
# Fixed value: environment prefix of ``${NAME}`` in shard lists.
ENV_PREFIX = "WDS_"
_RANGE = re.compile(r"(-?\d+)\.\.(-?\d+)(?:\.\.(-?\d+))?|([A-Za-z])\.\.([A-Za-z])")


def _split_top(body: str) -> list[str]:
    parts, depth, start = [], 0, 0
    for i, c in enumerate(body):
        depth += (c == "{") - (c == "}")
        if c == "," and depth == 0:
            parts.append(body[start:i])
            start = i + 1
    return [*parts, body[start:]]


def _close(text: str, at: int) -> int:
    depth = 0
    for i in range(at, len(text)):
        depth += (text[i] == "{") - (text[i] == "}")
        if depth == 0:
            return i
    return -1


def brace_expand(text: str) -> list[str]:
    """Shell-like braces: ``{000..099}`` (zero-padded, optional step), ``{a..e}``, ``{x,y}``, nested.

    A brace that is neither range nor list, or is not closed, stays as it is.
    """
    at = text.find("{")
    while at >= 0:
        end = _close(text, at)
        if end < 0:
            return [text]
        body = text[at + 1 : end]
        values: list[str] | None = None
        if m := _RANGE.fullmatch(body):
            if m[1]:
                a, b, step = int(m[1]), int(m[2]), abs(int(m[3] or 1)) or 1
                padded = any(len(x.lstrip("-")) > 1 and x.lstrip("-").startswith("0") for x in (m[1], m[2]))
                width = max(len(m[1]), len(m[2])) if padded else 0
                run = range(a, b + 1, step) if a <= b else range(a, b - 1, -step)
                values = [f"{x:0{width}d}" for x in run]
            else:
                a, b = ord(m[4]), ord(m[5])
                values = [chr(x) for x in (range(a, b + 1) if a <= b else range(a, b - 1, -1))]
        elif len(parts := _split_top(body)) > 1:
            values = [x for p in parts for x in brace_expand(p)]
        if values is not None:
            tails = brace_expand(text[end + 1 :])
            return [text[:at] + v + t for v in values for t in tails]
        at = text.find("{", at + 1)
    return [text]


def envsubst(text: str, env: dict[str, str] | None = None) -> str:
    """Replace ``${NAME}`` by the value of WDS_NAME, repeatedly (10 rounds); a missing one is an error."""
    values = os.environ if env is None else env

    def one(m: re.Match) -> str:
        key = ENV_PREFIX + m[1]
        if key not in values:
            raise KeyError(f"missing environment variable {key}")
        return values[key]

    for _ in range(10):
        new = re.sub(r"\$\{(\w+)\}", one, text)
        if new == text:
            break
        text = new
    return text


def expand_urls(urls: str | list[str], env: dict[str, str] | None = None) -> list[str]:
    """A list is copied; a string is split on ``::``, its variables replaced and its braces expanded."""
    if not isinstance(urls, str):
        return list(urls)
    return [u for part in urls.split("::") for u in brace_expand(envsubst(part, env))]


def expand_path(text: str) -> str:
    """``~`` and ``$NAME`` as in a shell."""
    return os.path.expanduser(os.path.expandvars(text))


def parse_rewrites(spec: str) -> list[tuple[str, str]]:
    """``pattern=replacement;...`` as pairs; each pattern is anchored at the start."""
    pairs = [p.split("=", 1) for p in spec.split(";") if "=" in p]
    return [(f"^(?:{a})", b) for a, b in pairs]


def rewrite_url(url: str, spec: str | None = None) -> str:
    """The first rule that changes the URL wins."""
    for a, b in parse_rewrites(os.environ.get("GOPEN_REWRITE", "") if spec is None else spec):
        new = re.sub(a, b, url)
        if new != url:
            return new
    return url


def rewrite_url_col(url: Column, spec: str) -> Column:
    out = F.lit(None).cast("string")
    for a, b in reversed(parse_rewrites(spec)):
        new = F.regexp_replace(url, a, b)
        out = F.when(new != url, new).otherwise(out)
    return F.coalesce(out, url)


def pipe_cleaner(url: Column) -> Column:
    """The first remote URL in a ``pipe:`` command, else the command without ``pipe:``; other URLs unchanged."""
    words = F.split(F.regexp_replace(url, "^pipe:", ""), " ")
    first = F.try_element_at(F.filter(words, lambda w: w.rlike(REMOTE)), F.lit(1))
    return F.when(url.startswith("pipe:"), F.coalesce(first, F.regexp_replace(url, "^pipe:", ""))).otherwise(url)


def cache_path(url: Column, cache_dir: str) -> Column:
    """Where a cached copy lies: the URL's directory with ``: / | ;`` as ``_``, then its file name."""
    path = F.regexp_replace(F.regexp_replace(pipe_cleaner(url), r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), r"[?#;].*$", "")
    folder = F.regexp_replace(F.regexp_replace(F.regexp_extract(path, r"^(.*)/[^/]*$", 1), "^/+", ""), CACHE_CHARS, "_")
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.concat(F.lit(f"{cache_dir.rstrip('/')}/"), F.when(F.length(folder) > 0, F.concat(folder, F.lit("/"))).otherwise(""), name)


def last_components(path: Column, n: int = 3, suffix: str = "") -> Column:
    """The last ``n`` components of a path (all of them if there are fewer)."""
    parts = F.split(path, "/")
    return F.concat(F.array_join(F.slice(parts, F.greatest(F.size(parts) - n + 1, F.lit(1)), F.lit(n)), "/"), F.lit(suffix))


def join_path(a: Column, b: Column) -> Column:
    """Like os.path.join: an absolute right side wins, an empty left side adds nothing."""
    return F.when(b.startswith("/") | (F.length(a) == 0), b).otherwise(F.concat(F.regexp_replace(a, "/$", ""), F.lit("/"), b))


def fix_path(path: Column) -> Column:
    """Known misspellings: a doubled slash after data, the processed copy of a video folder."""
    return F.replace(F.replace(path, F.lit("data//"), F.lit("data/")), F.lit("process_videos"), F.lit("videos"))


def file_type(head: Column) -> Column:
    """'gzip', 'tar' or 'other' by magic bytes (the first 262 bytes suffice)."""
    return F.when(F.hex(F.substring(head, 1, 2)) == "1F8B", "gzip").when(F.hex(F.substring(head, 258, 5)) == "7573746172", "tar").otherwise("other")


def member_base(name: Column) -> Column:
    """Path and name up to the first dot of the file name; null if there is no extension."""
    got = F.regexp_extract(name, MEMBER, 1)
    return F.when(F.length(got) > 0, got)


def member_ext(name: Column, lower: bool = True) -> Column:
    """Everything after the first dot of the file name, lower-cased; null where :func:`member_base` is null."""
    got = F.regexp_extract(name, MEMBER, 2)
    return F.when(member_base(name).isNotNull(), F.lower(got) if lower else got)


def shard_name(machine: Column, start: Column, end: Column, tar: Column) -> Column:
    return F.format_string("shard-%d-%d-%d-%d.tar", machine.cast("bigint"), start.cast("bigint"), end.cast("bigint"), tar.cast("bigint"))


def sample_key(index: Column, part: Column | None = None) -> Column:
    """Nine-digit index inside the shard, with the part's number for samples of several files."""
    return F.format_string("%09d", index.cast("bigint")) if part is None else F.format_string("%09d-%d", index.cast("bigint"), part.cast("bigint"))
