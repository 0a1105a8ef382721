"""Shard lists as frames: in order or shuffled, from multi-source specs, or resampled without end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import expand_urls
from ..operators.order import POS
from ..operators.sampling import multi_source, portable_hash


def make_seed(*parts: int | str) -> int:
    """A seed from several numbers and names: seed * 31 + part, kept to 31 bits; the same everywhere."""
    import zlib

    seed = 0
    for p in parts:
        seed = (seed * 31 + (p if isinstance(p, int) else zlib.crc32(p.encode()))) & 0x7FFFFFFF
    return seed


def worker_seed(rank: int, worker: int) -> int:
    return rank * 1000 + worker


def simple_shards(spark: SparkSession, urls: str | list[str], seed: int | None = None) -> DataFrame:
    """(url, __pos__), in the given order or, with a seed, in hash order.  Lists of shards are made on the driver."""
    listed = expand_urls(urls)
    if seed is not None:
        import hashlib

        listed = sorted(listed, key=lambda u: (hashlib.md5(f"{seed}|{u}".encode()).hexdigest(), u))  # noqa: S324 - no secret
    return spark.createDataFrame([(u, i) for i, u in enumerate(listed)], f"url string, {POS} bigint")


@dataclass(frozen=True)
class SourceSpec:
    """One source of a multi-source spec: how many shards an epoch takes, with replacement (``resample``) or without (``perepoch``)."""

    name: str
    urls: list[str]
    perepoch: int = -1
    resample: int = -1


def source_specs(spec: dict) -> list[SourceSpec]:
    """The sources of a spec as typed values, their braces expanded."""
    out = []
    for d in spec["datasets"]:
        listed = [d["shards"]] if isinstance(d["shards"], str) else d["shards"]
        out.append(SourceSpec(d.get("name", ""), [u for s in listed for u in expand_urls(s)], d.get("choose", -1), d.get("resample", -1)))
    return out


def load_spec(path: str) -> dict:
    import yaml

    with open(path) as f:
        return yaml.safe_load(f)


def shard_spec(spark: SparkSession, spec: str | dict | list[str], epoch: int = 0, seed: int = 0) -> DataFrame:
    """Shards of an epoch: a ``.yaml`` path or dict is a multi-source spec, anything else a plain list."""
    if isinstance(spec, str) and spec.endswith((".yaml", ".yml")):
        spec = load_spec(spec)
    return simple_shards(spark, multi_source(spec, epoch, seed) if isinstance(spec, dict) else spec)


def resampled_stream(spark: SparkSession, urls: str | list[str], rows_per_second: int = 10, seed: int = 0, epoch: int = 0) -> DataFrame:
    """Endless draws with replacement: (draw, url) from a rate source; the same draws in every run."""
    listed = expand_urls(urls)
    if not listed:
        raise ValueError("there are no shards to draw from")
    n = F.array(*map(F.lit, listed))
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return ticks.select(F.col("value").alias("draw"), F.get(n, (portable_hash(seed, epoch, F.col("value")) % len(listed)).cast("int")).alias("url"))


def find_files(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(path) of all files of that very name below ``root``, sorted; listed by Spark, contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", name).load(root)
    return found.select("path").orderBy("path")
