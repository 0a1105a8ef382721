"""Reproducible sampling and shuffling by a portable hash (the same in any SQL engine): no random state anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .order import POS

SPAN = 1 << 32


def portable_hash(*parts: Column | str | int) -> Column:
    """First 32 bits of the MD5 of the parts joined by '|', as a number."""
    text = F.concat_ws("|", *[(p if isinstance(p, Column) else F.lit(str(p))).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def rsample(df: DataFrame, p: float, key: Column, seed: int = 0) -> DataFrame:
    """Each row with probability ``p``, decided by its key."""
    if not 0 <= p <= 1:
        raise ValueError("p must lie between 0 and 1")
    return df.filter(portable_hash(seed, key) < int(p * SPAN))


def shuffle_order(key: Column, seed: int = 0, epoch: int = 0) -> Column:
    """Sort by this for a shuffle that depends on seed and epoch only."""
    return portable_hash(seed + epoch, key)


def det_shuffle(df: DataFrame, key: str, seed: int = 0, epoch: int = 0) -> DataFrame:
    """The whole table in hash order (one range shuffle); ties by key."""
    return df.orderBy(shuffle_order(F.col(key), seed, epoch), key)


def buffer_shuffle(df: DataFrame, pos: str = POS, size: int = 1000, seed: int = 0) -> DataFrame:
    """Local shuffle: rows change places only within runs of ``size`` positions; adds ``shuffled``, the new order."""
    run = F.floor(F.col(pos) / size).cast("bigint")
    place = F.row_number().over(W.partitionBy(run).orderBy(portable_hash(seed, F.col(pos)), pos)) - 1
    return df.withColumn("shuffled", run * size + place)


def resampled(df: DataFrame, n: int, total: int | None = None, seed: int = 0, epoch: int = 0, pos: str = POS) -> DataFrame:
    """``n`` draws with replacement (column ``draw``) from rows numbered densely by ``pos``."""
    total = df.count() if total is None else total
    if total == 0:
        return df.withColumn("draw", F.lit(0).cast("bigint")).limit(0)
    draws = df.sparkSession.range(n).select(F.col("id").alias("draw"), (portable_hash(seed, epoch, F.col("id")) % total).alias(pos))
    return draws.join(df, pos)


def choose(df: DataFrame, k: int, key: str, by: list[str] | None = None, seed: int = 0, epoch: int = 0) -> DataFrame:
    """``k`` rows without replacement (of each group): those with the smallest hashes."""
    order = [portable_hash(seed, epoch, F.col(key)), F.col(key)]
    if not by:
        return df.orderBy(*order).limit(k)
    return df.withColumn("__rank__", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("__rank__") <= k).drop("__rank__")


def multi_source(spec: dict, epoch: int = 0, seed: int = 0) -> list[str]:
    """Shards of one epoch of a multi-source spec: ``prefix``, ``buckets`` and per dataset ``name``, ``shards``,
    ``buckets``, and ``resample`` (draws with replacement) or ``choose`` (without), else all.  Driver-side: lists
    of shards are small."""
    import hashlib
    import posixpath

    from ..functions.urls import brace_expand, expand_path

    def h(*x: object) -> int:
        return int(hashlib.md5("|".join(map(str, x)).encode()).hexdigest()[:8], 16)  # noqa: S324

    if extra := set(spec) - {"prefix", "datasets", "buckets"}:
        raise ValueError(f"unknown entries {sorted(extra)}")
    out = []
    for k, d in enumerate(spec["datasets"]):
        if extra := set(d) - {"buckets", "name", "shards", "resample", "choose"}:
            raise ValueError(f"unknown entries {sorted(extra)}")
        buckets = d.get("buckets", spec.get("buckets", [])) or [""]
        buckets = [buckets] if isinstance(buckets, str) else buckets
        if len(buckets) != 1:
            raise ValueError("one bucket at most")
        shards = [d["shards"]] if isinstance(d["shards"], str) else d["shards"]
        urls = [expand_path(spec.get("prefix", "")) + posixpath.join(expand_path(buckets[0]), u) for s in shards for u in brace_expand(expand_path(s))]
        resample, chosen = d.get("resample", -1), d.get("choose", -1)
        if chosen > len(urls):
            raise ValueError(f"choose {chosen} of only {len(urls)} shards")
        if resample > 0 and chosen > 0:
            raise ValueError("only one of resample and choose")
        if resample > 0:
            urls = [urls[h(seed, epoch, k, i) % len(urls)] for i in range(resample)]
        elif chosen > 0:
            urls = sorted(urls, key=lambda u, k=k: (h(seed, epoch, k, u), u))[:chosen]
        out += urls
    return [u for _, u in sorted(enumerate(out), key=lambda x: (h(seed, epoch, "order", *x), x))]


def random_mix(parts: DataFrame, source: str, weights: dict[str, float], pos: str = POS, seed: int = 0) -> DataFrame:
    """Weighted interleaving: adds ``turn``, sort by it.

    The j-th row of a source of weight w comes at time (j + u) / w, u in [0, 1) by hash; so over any stretch the
    sources appear in proportion to their weights until one runs dry, and no state passes between rows.
    """
    w = F.try_element_at(F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]), F.col(source))
    jitter = portable_hash(seed, F.col(source), F.col(pos)) / float(SPAN)
    return parts.filter(w > 0).withColumn("turn", (F.col(pos) + jitter) / w)
