"""Duplicates hidden by formatting differences (problem 3).

Progressive partition refinement.  Every row first gets a cheap invariant of its class, computed by the
JVM: the folded path, the length and the letter histogram of the decoded value with white space, case
and signs stripped.  Rows alone in their class are done.  Only rows of classes with several members get
the costly key, a hash of the canonical record (JSON parsed, named fields sorted).
"""

from __future__ import annotations

import hashlib
import json
import re

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import attach_stats
from ..runtime import materialize

#: What stays of a text when white space, punctuation and other signs are ignored.
STRIP = r"[^\p{L}\p{N}\p{M}]+"
#: Letter groups of the histogram.  One count per group and row; together with length and path they isolate nearly all rows.
LETTER_GROUPS = ("AE", "IO", "NT", "RS", "0123456789", "ОАИ的在一")
_KEPT = regex.compile(STRIP)
_NAMED = re.compile(r"\s*([^\W\d]\w*)\s*[:=]\s*(.*?)\s*", re.S)
_FIELD_END = re.compile(r"[;|\n\r]+")


def folded(c: Column) -> Column:
    """In upper case (so that ß is SS) and stripped of everything but letters, marks and digits."""
    return F.regexp_replace(F.upper(c), STRIP, "")


def _decoded(v: Column) -> Column:
    """JSON objects and strings with their escapes resolved, anything else as it is."""
    head = F.substring(F.ltrim(v), 1, 1)
    fields = F.from_json(v, "map<string,string>")
    record = F.concat_ws(" ", F.map_keys(fields), F.map_values(fields))
    listed = lambda c: F.concat_ws(" ", F.from_json(c, "array<string>"))
    text = F.when(head == "{", record).when(head == '"', listed(F.concat(F.lit("["), v, F.lit("]")))).when(head == "[", listed(v))
    return F.coalesce(F.when(F.length(text) > 0, text), v)


def cheap_key(path: Column, s: Column) -> Column:
    """64-bit invariant: equal for all copies of a record, mostly different for others; ``s`` is the folded value."""
    counts = [F.length(F.translate(s, g, "")) for g in LETTER_GROUPS]
    return F.xxhash64(F.coalesce(folded(path), F.lit("\x00")), F.length(s), *counts)


def _letters(s: str) -> str:
    return _KEPT.sub("", s.upper())


def _canonical(x: object) -> object:
    if isinstance(x, dict):
        return sorted([_letters(str(k)), _canonical(v)] for k, v in x.items())
    if isinstance(x, list):
        return [_canonical(v) for v in x]
    return "" if x is None else _letters(str(x))


def canonical_value(value: str) -> str:
    """One string for all formattings of a value: a text folded, a record of named fields sorted by name.

    JSON counts by its content: its escapes are resolved, and a list of texts is the text that they make up.
    """
    try:
        parsed = json.loads(value, parse_float=str, parse_int=str, parse_constant=str)
    except (ValueError, RecursionError):
        parsed = value
    if isinstance(parsed, str):
        parts = [p for p in _FIELD_END.split(parsed) if p.strip()]
        named = [_NAMED.fullmatch(p) for p in parts]
        if len(parts) > 1 and all(named):
            return json.dumps(sorted([_letters(m[1]), _letters(m[2])] for m in named))
        return _letters(parsed)
    if isinstance(parsed, list) and all(isinstance(x, str) for x in parsed):
        return "".join(map(_letters, parsed))
    return json.dumps(_canonical(parsed))


@F.pandas_udf(T.StringType())
def _costly_key(path: pd.Series, value: pd.Series) -> pd.Series:
    def one(p: str | None, v: str) -> str:
        what = json.dumps([None if p is None else _letters(p), canonical_value(v)])
        return hashlib.blake2b(what.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()

    return pd.Series([one(p, v) for p, v in zip(path, value, strict=True)], dtype=object)


def copy_classes(df: DataFrame, id_col: str = "rec_id", path: str = "video_path", value: str = "value") -> DataFrame:
    """(rec_id, first_id, n_copies) of every row that has copies: same path and value but for formatting.

    Rows with null or blank value belong to no class.  A null path equals only a null path.  ``first_id`` is
    the smallest id of the class.  Ids that stand twice count as two copies.  A class of the cheap key may hold
    any share of all rows: its rows stay where they are and its size comes to them (``attach_stats``).
    """
    base = df.select(F.col(id_col).alias("rec_id"), F.col(path).alias("path"), F.col(value).alias("value"))
    base = base.filter(F.col("value").rlike(r"[^\s\p{Z}\p{C}]")).withColumn("letters", folded(_decoded(F.col("value"))))
    base = materialize(base.withColumn("cheap", cheap_key(F.col("path"), F.col("letters"))).drop("letters"), "invariants")
    sizes = base.groupBy("cheap").agg(F.count(F.lit(1)).alias("n"))
    several = attach_stats(base, materialize(sizes.filter("n > 1"), "sizes"), "cheap", "n", base.count())
    keyed = materialize(several.select("rec_id", _costly_key("path", "value").alias("record")), "records")
    stats = materialize(keyed.groupBy("record").agg(F.min("rec_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies")).filter("n_copies > 1"), "classes")
    return attach_stats(keyed, stats, "record", "n_copies", keyed.count()).select("rec_id", "first_id", "n_copies")


def collapse_copies(df: DataFrame, id_col: str = "rec_id", path: str = "video_path", value: str = "value") -> DataFrame:
    """(rec_id, n_copies): one row per different record, its smallest id and how many rows carry it.

    Rows with null or blank value cannot be compared and stay, each with one copy.
    """
    classes = materialize(copy_classes(df, id_col, path, value), "copies")
    firsts = classes.filter("rec_id = first_id").select("rec_id", "n_copies").distinct()
    alone = df.select(F.col(id_col).alias("rec_id")).join(classes.select("rec_id"), "rec_id", "left_anti")
    return firsts.unionByName(alone.withColumn("n_copies", F.lit(1).cast("bigint")))
