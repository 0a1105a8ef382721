"""A fluent wrapper around a frame of samples: lazy, immutable, every operator available."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from ..functions.codecs import Codecs, encoded
from ..operators import errors, fields, order, sampling
from ..operators.samples import valid_samples
from ..operators.sharding import shards_by_size
from ..runtime import materialize
from ..sources.tarshards import list_shards, read_samples, write_shards

Step = Callable[[DataFrame], DataFrame]


def pipeline(df: DataFrame, *steps: Step | list | None) -> DataFrame:
    """Apply steps in turn; None is skipped, lists are flattened."""
    for s in steps:
        if isinstance(s, list | tuple):
            df = pipeline(df, *s)
        elif s is not None:
            df = df.transform(s)
    return df


class Pipeline:
    """Steps from frame to frame, to be named and reused; immutable, so parts can be shared."""

    def __init__(self, *steps: Step | list | Pipeline | None):
        flat = [x for s in steps for x in (s.steps if isinstance(s, Pipeline) else s if isinstance(s, list | tuple) else [s])]
        self.steps: tuple[Step, ...] = tuple(s for s in flat if s is not None)

    def append(self, *steps: Step | list | Pipeline | None) -> Pipeline:
        return Pipeline(self, *steps)

    compose = append

    def stage(self, i: int) -> Step:
        return self.steps[i]

    def __len__(self) -> int:
        return len(self.steps)

    def __call__(self, df: DataFrame) -> DataFrame:
        return pipeline(df, *self.steps)


class Samples:
    """(url, run, key, seq, fields) or any frame derived from it; each method returns a new object."""

    def __init__(self, df: DataFrame, length: int | None = None):
        self.df, self.length = df, length

    @classmethod
    def from_shards(
        cls, spark: SparkSession, path: str, on_error: str = "fail", shuffle_shards: int | None = None, suffixes: list[str] | None = None,
        node: tuple[int, int] | None = None, resampled: int | None = None, repeat: int = 1, epoch: int = 0, **options: object,
    ) -> Samples:
        """Samples of tar shards; ``shuffle_shards`` is a seed for the order of shards, else they are in name order.

        ``node``: (rank, world) takes every world-th shard; ``resampled``: so many shards drawn with replacement, for
        ``epoch``; ``repeat``: passes over all.  Other options go to the reader (match, rename, cache, pushdown ...).
        """
        listed = list_shards(path)
        if node is not None:
            listed = listed[node[0] :: node[1]]
            path = "::".join(listed)
        if resampled is not None:
            drawn = [(i, listed[int(hashlib.md5(f"{epoch}|{i}".encode()).hexdigest()[:8], 16) % len(listed)]) for i in range(resampled)] if listed else []  # noqa: S324 - no secret
            got = valid_samples(read_samples(spark, "::".join(sorted({u for _, u in drawn})), suffixes, on_error="fail" if on_error == "fail" else "skip", **options))
            got = got.join(spark.createDataFrame(drawn, "draw bigint, url string"), "url")
            return cls(order.pos_overall(got, "draw", "seq")).repeat(repeat)
        got = read_samples(spark, path, suffixes, on_error="fail" if on_error == "fail" else "skip", **options)
        shard = F.col("url") if shuffle_shards is None else sampling.shuffle_order(F.col("url"), shuffle_shards)
        out = cls(order.pos_overall(valid_samples(got).withColumn("__shard__", shard), "__shard__", "url", "seq").drop("__shard__"))
        return out if repeat == 1 else out.repeat(repeat)

    def then(self, *steps: Step | list | None) -> Samples:
        return Samples(pipeline(self.df, *steps))

    def select(self, predicate: Column) -> Samples:
        return self.then(lambda d: d.filter(predicate))

    def map(self, f: Callable[[Column], Column], name: str = "value") -> Samples:
        return self.then(lambda d: fields.map_rows(d, f, name))

    def map_dict(self, **f: Callable[[Column], Column]) -> Samples:
        return self.then(lambda d: fields.map_dict(d, **f))

    def map_tuple(self, *f: Callable[[Column], Column] | None) -> Samples:
        return self.then(lambda d: fields.map_tuple(d, *f))

    def rename(self, keep: bool = True, **new: str) -> Samples:
        return self.then(lambda d: fields.rename(d, keep, **new))

    def rename_keys(self, **new: object) -> Samples:
        return self.then(lambda d: fields.rename_keys(d, **new))

    def extract_keys(self, *patterns: str, **options: bool) -> Samples:
        return self.then(lambda d: fields.extract_keys(d, *patterns, **options))

    def to_tuple(self, *specs: str, **options: object) -> Samples:
        return self.then(lambda d: fields.to_tuple(d, *specs, **options))

    def to_dict(self, spec: str, strict: bool = True) -> Samples:
        return self.then(lambda d: fields.to_dict(d, spec, strict=strict))

    def associate(self, extra: DataFrame, key: str = "key") -> Samples:
        return self.then(lambda d: fields.associate(d, extra, key))

    def field(self, name: str, value: Callable[[Column], Column], source: str = "fields") -> Samples:
        """A typed column from a field by a JVM-side codec, e.g. ``codecs.text_field``."""
        return self.then(lambda d: d.withColumn(name, value(F.try_element_at(F.col(source), F.lit(name)))))

    def decode(self, name: str, kind: str, codecs: Codecs | None = None, source: str = "fields", partial: bool = True) -> Samples:
        """A column decoded by the registry in Python, as the Spark type ``kind`` (for what the JVM can't decode).

        Values come in Arrow batches; arrays of numbers (images, tensors) may be given as nested lists.
        """
        own, arrow = codecs or Codecs(), to_arrow_type(_parse_datatype_string(kind))

        @F.arrow_udf(kind)
        def run(data: pa.Array) -> pa.Array:
            got = [None if b is None else own.decode(name, b, must_decode=not partial) for b in data.to_pylist()]
            return pa.array([x.tolist() if hasattr(x, "tolist") else x for x in got], arrow)

        return self.then(lambda d: d.withColumn(name, run(F.try_element_at(F.col(source), F.lit(name)))))

    def encode(self, *columns: str, source: str = "fields") -> Samples:
        """Typed columns as fields of the same names, ready to be written: text as UTF-8, numbers as digits, structures as JSON."""

        def step(d: DataFrame) -> DataFrame:
            kinds = dict(d.dtypes)
            pairs = [x for c in columns for x in (F.lit(c), encoded(F.col(c), kinds[c]))]
            kept = F.map_filter(F.col(source), lambda k, _: ~k.isin(*columns)) if source in d.columns else F.create_map().cast("map<string,binary>")
            return d.withColumn(source, F.map_concat(kept, F.create_map(*pairs)))

        return self.then(step)

    def slice(self, start: int, stop: int | None = None, step: int = 1) -> Samples:
        return self.then(lambda d: order.slice_rows(d, start, stop, step))

    def shuffle(self, size: int = 1000, seed: int = 0) -> Samples:
        def step(d: DataFrame) -> DataFrame:
            return sampling.buffer_shuffle(d, size=size, seed=seed).drop(order.POS).withColumnRenamed("shuffled", order.POS)

        return self.then(step)

    def detshuffle(self, key: str = "key", seed: int = 0, epoch: int = 0) -> Samples:
        return self.then(lambda d: order.pos_overall(d.drop(order.POS), sampling.shuffle_order(F.col(key), seed, epoch), key))

    def rsample(self, p: float = 0.5, key: str = "key", seed: int = 0) -> Samples:
        return self.then(lambda d: sampling.rsample(d, p, F.col(key), seed))

    def resampled(self, n: int, seed: int = 0, epoch: int = 0) -> Samples:
        return self.then(lambda d: sampling.resampled(d, n, None, seed, epoch))

    def batched(self, size: int = 20, partial: bool = True) -> Samples:
        return self.then(lambda d: order.batched(d, size, partial))

    def collated(self, size: int, collate: Callable[[dict], dict], schema: str) -> Samples:
        return self.then(lambda d: order.collated(d, size, collate, schema))

    def unbatched(self, *columns: str) -> Samples:
        return self.then(lambda d: order.unbatched(d, list(columns)))

    def listed(self, size: int = 20) -> Samples:
        return self.then(lambda d: order.listed(d, size))

    def unlisted(self) -> Samples:
        return self.then(order.unlisted)

    def repeat(self, epochs: int, most: int | None = None) -> Samples:
        return self.then(lambda d: order.repeat(d, epochs, most))

    def with_epoch(self, n: int) -> Samples:
        return self.then(lambda d: order.with_epoch(d, n))

    def with_length(self, n: int) -> Samples:
        return Samples(self.df, n)

    def __len__(self) -> int:
        if self.length is None:
            raise TypeError("no length was declared")
        return self.length

    def split(self, index: int, of: int) -> Samples:
        return self.then(lambda d: order.stride(d, index, of))

    def non_empty(self) -> Samples:
        return self.then(order.non_empty)

    def info(self, n: int = 5, width: int = 60) -> Samples:
        return self.then(lambda d: fields.info(d, n, width))

    def log_keys(self, path: str) -> Samples:
        fields.log_keys(self.df).write.mode("append").text(path)
        return self

    def on_error(self, policy: str) -> Samples:
        return self.then(lambda d: errors.apply_policy(d, policy))

    def cached(self) -> Samples:
        """In memory, spilling to disk; lost blocks are computed again."""
        return Samples(self.df.persist(StorageLevel.MEMORY_AND_DISK), self.length)

    def stored(self) -> Samples:
        """Written to the shared folder: survives lost executors and cuts the lineage."""
        return Samples(materialize(self.df, "samples"), self.length)

    def loader(self, size: int, partial: bool = True):
        """Batches in order, each a dict of lists: for a training loop on the driver, one partition fetched ahead."""
        for r in self.batched(size, partial).df.orderBy("batch").toLocalIterator(prefetchPartitions=True):
            yield {k: v for k, v in r.asDict().items() if k != "batch"}

    def __iter__(self):
        """Rows in order, fetched partition by partition (for a training loop on the driver)."""
        return self.df.orderBy(order.POS).toLocalIterator(prefetchPartitions=True)

    def write(self, path: str, per_shard: int = 1000, max_bytes: int | None = None, first: int = 0, post: Callable[[str], None] | None = None, **options: object) -> list[str]:
        """Tar shards of ``per_shard`` samples, in order, from number ``first`` on; ``post`` is called with each shard once all are there.

        With ``max_bytes`` a shard also ends before the sample at which it holds so many bytes.  That rule is
        sequential, so it runs in groups of 100 shards' samples, and the names carry the group's number too.
        """
        df = self.df
        if max_bytes is None:
            shard = F.format_string("shard-%06d.tar", (F.floor(F.col(order.POS) / per_shard) + first).cast("bigint"))
        else:
            size = F.aggregate(F.map_values("fields"), F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(F.length(x), F.lit(0)))
            df = df.withColumns({"__size__": size, "__group__": F.floor(F.col(order.POS) / (100 * per_shard)).cast("bigint")})
            df = shards_by_size(df.select(order.POS, "key", "fields", "__size__", "__group__"), "__size__", order.POS, max_bytes, "__group__", per_shard)
            shard = F.format_string("shard-%06d-%06d.tar", F.col("__group__") + first, F.col("shard"))
        return write_shards(df.withColumn("shard", shard).select("shard", order.POS, "key", "fields"), path, order.POS, post, **options)
