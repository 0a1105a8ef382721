"""Projections and lookups over samples whose fields are a MAP<STRING, BINARY> (or any value type)."""

from __future__ import annotations

import fnmatch
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import broadcast_checked


def glob_rlike(pattern: str) -> str:
    """A file-name glob as a Java regular expression."""
    return "^" + fnmatch.translate(pattern).removeprefix("(?s:").replace(r")\z", "").replace(r")\Z", "") + "$"


def _matches(key: Column, pattern: str | list[str]) -> Column:
    out = F.lit(False)
    for p in pattern.split(";") if isinstance(pattern, str) else pattern:
        out = out | key.rlike(glob_rlike(p))
    return out


def first_of(spec: str, columns: list[str]) -> Column | None:
    """The first of the alternatives ``a;b;c`` that is not null; None if no such column exists."""
    there = [F.col(c) for c in spec.split(";") if c in columns]
    return F.coalesce(*there) if there else None


def rename(df: DataFrame, keep: bool = True, **new: str) -> DataFrame:
    """``new=alternatives``: each new column is the first present alternative; the others go, the rest stays.

    A row without any alternative raises when it is read; a spec without any such column raises at once.
    """
    gone = {c for spec in new.values() for c in spec.split(";")}
    out = [F.col(c) for c in df.columns if keep and c not in gone and c not in new]
    for name, spec in new.items():
        got = first_of(spec, df.columns)
        if got is None:
            raise ValueError(f"none of {spec} is a column")
        out.append(F.coalesce(got, F.raise_error(F.lit(f"none of {spec} is there")).cast(dict(df.select(got.alias('x')).dtypes)["x"])).alias(name))
    return df.select(*out)


def to_tuple(df: DataFrame, *specs: str, missing_is_error: bool = True, none_is_error: bool | None = None, on_error: str = "skip") -> DataFrame:
    """Columns ``_0, _1, ...`` by specs ``a;b``; one string with blanks is several specs.

    With ``none_is_error`` (default: as missing_is_error) rows with a null are dropped ('skip') or raise ('fail').
    """
    names = specs[0].split() if len(specs) == 1 and " " in specs[0] else specs
    none_is_error = missing_is_error if none_is_error is None else none_is_error
    cols = []
    for i, s in enumerate(names):
        got = first_of(s, df.columns)
        if got is None and missing_is_error:
            raise ValueError(f"none of {s} is a column")
        cols.append((F.lit(None) if got is None else got).alias(f"_{i}"))
    out = df.select(*cols)
    if not none_is_error:
        return out
    whole = F.lit(True)
    for c in out.columns:
        whole = whole & F.col(c).isNotNull()
    return out.filter(whole if on_error == "skip" else F.when(whole, True).otherwise(F.raise_error(F.lit("a field is null")).cast("boolean")))


def map_dict(df: DataFrame, **functions: Callable[[Column], Column]) -> DataFrame:
    """Each named column replaced by a function of itself; a missing column is an error."""
    if lost := [c for c in functions if c not in df.columns]:
        raise ValueError(f"no such columns: {lost}")
    return df.withColumns({c: f(F.col(c)) for c, f in functions.items()})


def map_tuple(df: DataFrame, *functions: Callable[[Column], Column] | None) -> DataFrame:
    """Functions by position; None leaves a column alone, superfluous functions are ignored."""
    fs = [*functions, *[None] * len(df.columns)][: len(df.columns)]
    return df.select(*[F.col(c) if f is None else f(F.col(c)).alias(c) for c, f in zip(df.columns, fs, strict=True)])


def map_rows(df: DataFrame, f: Callable[[Column], Column], name: str = "value") -> DataFrame:
    """An expression over the whole row (a struct); rows that become null are dropped."""
    return df.withColumn(name, f(F.struct(*df.columns))).filter(F.col(name).isNotNull())


def select_fields(fields: Column, spec: str) -> Column:
    """The map cut to fields whose names end with an alternative of any spec (blank-separated); ``__`` fields go."""
    ends = [e for s in spec.split() for e in s.split(";")]

    def keep(k: Column, _: Column) -> Column:
        out = F.lit(False)
        for e in ends:
            out = out | k.endswith(e)
        return out & ~k.startswith("__")

    return F.map_filter(fields, keep)


def to_dict(df: DataFrame, spec: str, fields: str = "fields", strict: bool = True) -> DataFrame:
    """:func:`select_fields`; with ``strict`` rows that also hold other fields are dropped, else those become null."""
    wanted = select_fields(F.col(fields), spec)
    public = F.map_filter(F.col(fields), lambda k, _: ~k.startswith("__"))
    if strict:
        return df.filter(F.size(wanted) == F.size(public)).withColumn(fields, wanted)
    value = F.map_from_entries(F.transform(F.map_entries(public), lambda e: F.struct(e["key"].alias("key"), F.try_element_at(wanted, e["key"]).alias("value"))))
    return df.withColumn(fields, value)


def _dotted(fields: Column, pattern: str) -> Column:
    return F.map_values(F.map_filter(fields, lambda k, _: _matches(F.concat(F.lit("."), k), pattern)))


def _any_base(fields: str, pattern: str) -> Column:
    return F.exists(F.map_keys(fields), lambda k: F.lower(F.regexp_replace(k, ".*/", "")).rlike(glob_rlike(pattern)))


def extract_keys(df: DataFrame, *patterns: str, fields: str = "fields", duplicate_is_error: bool = True, ignore_missing: bool = False) -> DataFrame:
    """Columns ``_0, ...``: the one field whose dotted name matches the glob; a missing one is null if ignored."""
    cols = []
    for i, p in enumerate(patterns):
        found = _dotted(F.col(fields), p)
        value = F.try_element_at(found, F.lit(1))
        if not ignore_missing:
            value = F.when(F.size(found) == 0, F.raise_error(F.lit(f"no field matches {p}")).cast("binary")).otherwise(value)
        if duplicate_is_error:
            value = F.when(F.size(found) > 1, F.raise_error(F.lit(f"several fields match {p}")).cast("binary")).otherwise(value)
        cols.append(value.alias(f"_{i}"))
    return df.select(*[c for c in df.columns if c != fields], *cols)


def rename_keys(df: DataFrame, fields: str = "fields", keep_unselected: bool = False, must_match: bool = True, duplicate_is_error: bool = True, **new: str) -> DataFrame:
    """Fields renamed by globs over the lower-case base name; the last matching pattern wins.

    Of several fields with one new name the first stays unless that is an error.
    """
    rules = list(new.items())

    def name(k: Column) -> Column:
        base, out = F.lower(F.regexp_replace(k, ".*/", "")), (k if keep_unselected else F.lit(None).cast("string"))
        for to, pattern in rules:
            out = F.when(base.rlike(glob_rlike(pattern)), F.lit(to)).otherwise(out)
        return out

    entries = F.filter(F.transform(F.map_entries(fields), lambda e: F.struct(name(e["key"]).alias("key"), e["value"].alias("value"))), lambda e: e["key"].isNotNull())
    names = F.transform(entries, lambda e: e["key"])
    first = F.filter(entries, lambda e, i: F.array_position(names, e["key"]) == i + 1)
    kind = dict(df.dtypes)[fields]
    value = F.map_from_entries(first)
    if duplicate_is_error:
        value = F.when(F.size(first) < F.size(entries), F.raise_error(F.lit("two fields get the same name")).cast(kind)).otherwise(value)
    if must_match:
        for to, pattern in rules:
            value = F.when(~_any_base(fields, pattern), F.raise_error(F.lit(f"nothing matches {pattern} for {to}")).cast(kind)).otherwise(value)
    return df.withColumn(fields, value)


def associate(df: DataFrame, extra: DataFrame, key: str = "key") -> DataFrame:
    """Left lookup of ``extra`` by ``key``; its columns overwrite those of the same name.  Broadcast if small.

    ``extra`` must have one row per key; rows without a match keep nulls in the new columns and their own in others.
    """
    clash = [c for c in extra.columns if c in df.columns and c != key]
    side = extra.select(key, F.lit(True).alias("__hit__"), *[F.col(c).alias(f"__new_{c}") for c in extra.columns if c != key])
    out = df.join(broadcast_checked(side), key, "left")
    new = {c: F.when(F.col("__hit__"), F.col(f"__new_{c}")).otherwise(F.col(c)) if c in clash else F.col(f"__new_{c}") for c in extra.columns if c != key}
    return out.withColumns(new).drop("__hit__", *[f"__new_{c}" for c in extra.columns if c != key])


def log_keys(df: DataFrame, key: str = "key", pos: str = "__pos__") -> DataFrame:
    """One text line per sample: position, partition, key; write it with ``df.write.text``."""
    return df.select(F.format_string("%d\t%d\t%s", F.col(pos).cast("bigint"), F.spark_partition_id(), F.col(key)).alias("value"))


def info(df: DataFrame, n: int = 5, width: int = 60) -> DataFrame:
    """Print the first rows and pass the frame on."""
    df.show(n, truncate=width)
    return df
