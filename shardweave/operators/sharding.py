"""Which shard a sample goes to: by count in closed form, by size in a fold."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .order import POS


def shards_by_count(df: DataFrame, most: int, pos: str = POS, first: int = 0) -> DataFrame:
    return df.withColumn("shard", (F.floor(F.col(pos) / most) + first).cast("bigint"))


def shards_by_size(df: DataFrame, size: str, order: str, most_bytes: int, by: str, most: int = 100_000) -> DataFrame:
    """``shard``: a new one begins before a row once the shard holds ``most`` rows or ``most_bytes`` bytes.

    The rule is sequential, so it runs per group of ``by``, as each of several writers follows it for its own part.
    """
    columns = [c for c in df.columns if c != "shard"]
    ready = df.select(*columns).repartition(by).sortWithinPartitions(by, order)
    schema = ready.withColumn("shard", F.lit(0).cast("bigint")).schema
    n, g = columns.index(size), columns.index(by)

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = object()
        shard = count = used = 0
        for b in batches:
            out = []
            for key, x in zip(b.column(g).to_pylist(), b.column(n).to_pylist(), strict=True):
                if key != now:
                    now, shard, count, used = key, 0, 0, 0
                if count >= most or used >= most_bytes:
                    shard, count, used = shard + 1, 0, 0
                out.append(shard)
                count, used = count + 1, used + (x or 0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], names=[*columns, "shard"])

    return ready.mapInArrow(fold, schema)
