"""The ordering contract: every frame that an order-sensitive operator sees carries ``__pos__``.

``__pos__`` is dense and 0-based.  Inside a partition key it comes from a window; over a whole table from a
range shuffle plus per-partition offsets, so no task ever sorts more than one range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from ..runtime import materialize

POS = "__pos__"


def pos_within(df: DataFrame, by: list[str], order: list[str | Column], name: str = POS) -> DataFrame:
    """Position inside each group of ``by``; ties in ``order`` keep some order, so order by something unique."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)).cast("bigint") - 1)


def pos_overall(df: DataFrame, *order: str | Column, name: str = POS) -> DataFrame:
    """Position in the whole table, without a single-task window.

    The rows are range-shuffled and sorted once and written; then the row counts of the partitions (one number
    each) become offsets.
    """
    mark = "__row__"
    parted = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(mark, F.monotonically_increasing_id())
    kept = materialize(parted, "ordered")
    part = F.shiftright(mark, 33)
    counts = kept.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, at = {}, 0
    for r in sorted(counts, key=lambda r: r["p"]):
        before[r["p"]], at = at, at + r["n"]
    if not before:
        return kept.drop(mark).withColumn(name, F.lit(0).cast("bigint"))
    offsets = kept.sparkSession.createDataFrame(list(before.items()), "__p__ bigint, __offset__ bigint")
    within = F.col(mark).bitwiseAND(F.lit((1 << 33) - 1))
    out = kept.withColumn("__p__", part).join(F.broadcast(offsets), "__p__").withColumn(name, F.col("__offset__") + within)
    return out.drop("__p__", "__offset__", mark)


def slice_rows(df: DataFrame, start: int = 0, stop: int | None = None, step: int = 1, pos: str = POS) -> DataFrame:
    """Rows start, start + step, ... below stop, as of an iterator."""
    if start < 0 or step < 1 or (stop is not None and stop < 0):
        raise ValueError("start and stop must not be negative, step must be positive")
    p = F.col(pos)
    keep = (p >= start) & ((p - start) % step == 0)
    return df.filter(keep if stop is None else keep & (p < stop))


def stride(df: DataFrame, index: int, of: int, pos: str = POS) -> DataFrame:
    """Every ``of``-th row from ``index`` on (one machine's, node's or worker's share)."""
    if not 0 <= index < of:
        raise ValueError("index must lie below the number of parts")
    return df.filter(F.col(pos) % of == index)


def single_node_only(df: DataFrame, world: int = 1) -> DataFrame:
    if world > 1:
        raise ValueError("this input is not split by node; give it a splitter")
    return df


def non_empty(df: DataFrame) -> DataFrame:
    """``df`` itself; an error if it has no row (reads one row at most)."""
    if df.isEmpty():
        raise ValueError("the input has no rows")
    return df


def chunks(df: DataFrame, total: int, jobs: int, per_tar: int = 500, pos: str = POS) -> DataFrame:
    """Columns ``job``, ``tar`` and ``file``: contiguous chunks of ceil(total / jobs) rows, each cut into shards."""
    per_job = max(1, -(-total // jobs))
    p = F.col(pos)
    inside = p % per_job
    return df.withColumns({"job": F.floor(p / per_job).cast("bigint"), "tar": F.floor(inside / per_tar).cast("bigint"), "file": inside % per_tar})


def waves(df: DataFrame, shard_size: int, start: int = 0, end: int | None = None, pos: str = POS) -> DataFrame:
    """Rows [start, end) with ``group_id``: runs of ``shard_size`` consecutive rows."""
    return slice_rows(df, start, end, 1, pos).withColumn("group_id", F.floor((F.col(pos) - start) / shard_size).cast("bigint"))


def _in_order(rows: Column, pos: str) -> Column:
    """Structs sorted by one field; the others may be maps, which have no order."""
    return F.array_sort(rows, lambda a, b: F.when(a[pos] < b[pos], -1).when(a[pos] > b[pos], 1).otherwise(0))


def _column(rows: str, name: str) -> Column:
    return F.transform(rows, lambda r: r[name])


def batched(df: DataFrame, size: int, partial: bool = True, by: list[str] | None = None, pos: str = POS) -> DataFrame:
    """One row per ``size`` consecutive rows (of each group of ``by``): every column an array in order.

    A shorter last batch is kept only with ``partial``.  A batch never holds more than ``size`` rows.
    """
    keys, cols = by or [], [c for c in df.columns if c not in (by or []) and c != pos]
    batch = F.floor(F.col(pos) / size).cast("bigint")
    rows = _in_order(F.collect_list(F.struct(pos, *cols)), pos)
    out = df.groupBy(*keys, batch.alias("batch")).agg(rows.alias("__rows__"))
    out = out if partial else out.filter(F.size("__rows__") == size)
    return out.select(*keys, "batch", *[_column("__rows__", c).alias(c) for c in cols])


def collated(df: DataFrame, size: int, collate: Callable[[dict[str, list]], dict], schema: str, pos: str = POS) -> DataFrame:
    """(batch, ...) one row per ``size`` consecutive rows, made by ``collate`` from the batch's columns (name -> list in order).

    ``schema``: the columns that ``collate`` returns, as a Spark schema string.  A batch holds at most ``size`` rows.
    """
    rows = batched(df, size, pos=pos)
    names = [c for c in rows.columns if c != "batch"]
    out = pa.schema([("batch", pa.int64()), *((f.name, to_arrow_type(f.dataType)) for f in _parse_datatype_string(schema).fields)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [{"batch": r["batch"], **collate({n: r[n] for n in names})} for r in b.to_pylist()]
            if made:
                yield pa.RecordBatch.from_pylist(made, out)

    return rows.mapInArrow(run, f"batch bigint, {schema}")


def guess_batchsize(df: DataFrame, column: str | None = None) -> Column:
    """Rows that a batch stands for: the length of its first array column."""
    first = column or next(c for c, t in df.dtypes if t.startswith("array"))
    return F.greatest(F.size(first), F.lit(0))


def listed(df: DataFrame, size: int, by: list[str] | None = None, pos: str = POS) -> DataFrame:
    """Like :func:`batched`, but the rows stay together as an array of structs (``items``)."""
    keys, cols = by or [], [c for c in df.columns if c not in (by or []) and c != pos]
    rows = _in_order(F.collect_list(F.struct(pos, F.struct(*cols).alias("item"))), pos)
    return df.groupBy(*keys, F.floor(F.col(pos) / size).cast("bigint").alias("batch")).agg(F.transform(rows, lambda r: r["item"]).alias("items"))


def unlisted(df: DataFrame, items: str = "items") -> DataFrame:
    rest = [c for c in df.columns if c != items]
    return df.select(*rest, F.posexplode(items).alias("item_pos", "item")).select(*rest, "item_pos", "item.*")


def unbatched(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of parallel arrays, as many as the first column has elements; shorter ones give null."""
    rest = [c for c in df.columns if c not in columns]
    n = F.size(columns[0])
    rows = F.posexplode(F.slice(F.arrays_zip(*columns), 1, F.greatest(n, F.lit(0)))).alias("item_pos", "__row__")
    return df.select(*rest, rows).select(*rest, "item_pos", *[F.col(f"__row__.{c}").alias(c) for c in columns])


def repeat(df: DataFrame, epochs: int, most: int | None = None, total: int | None = None, pos: str = POS) -> DataFrame:
    """``epochs`` passes (column ``epoch``), at most ``most`` rows; ``total`` is the number of rows if known."""
    n = df.count() if total is None else total
    if most is not None:
        epochs = min(epochs, -(-most // n) if n else 0)
    out = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))) if epochs > 0 else df.withColumn("epoch", F.lit(0)).limit(0)
    out = out.withColumn(pos, F.col("epoch").cast("bigint") * n + F.col(pos))
    return out if most is None else out.filter(F.col(pos) < most)


def with_epoch(df: DataFrame, n: int, pos: str = POS) -> DataFrame:
    """Endless repetition cut after ``n`` rows."""
    total = df.count()
    return repeat(df, -(-n // total) if total else 0, n, total, pos)


#: Blocks of a two-level running sum: one task sums the blocks, each block is summed on its own.
BLOCKS = 4096


def running_sum(df: DataFrame, size: str, total: int, name: str = "before", pos: str = POS) -> DataFrame:
    """``name``: sum of ``size`` over all rows before, by ``pos``, of ``total`` rows.  No task holds more than a block."""
    width = max(1, -(-total // BLOCKS))
    rows = df.withColumn("__b__", F.floor(F.col(pos) / width))
    sums = rows.groupBy("__b__").agg(F.sum(size).alias("s"))
    bases = sums.select("__b__", F.coalesce(F.sum("s").over(W.orderBy("__b__").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__base__"))
    inside = F.coalesce(F.sum(size).over(W.partitionBy("__b__").orderBy(pos).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("__in__", inside).join(F.broadcast(bases), "__b__").withColumn(name, F.col("__base__") + F.col("__in__")).drop("__b__", "__base__", "__in__")


def repeat_samples(df: DataFrame, size: str, n: int, epochs: int, total: int | None = None, pos: str = POS) -> DataFrame:
    """Repeat batches until their sizes sum to ``n``: a batch is kept while the sum before it is below ``n``."""
    total = df.count() if total is None else total
    return running_sum(repeat(df, epochs, None, total, pos), size, total * epochs, "__before__", pos).filter(F.col("__before__") < n).drop("__before__")


def running_keep(df: DataFrame, size: str, limit: int, total: int | None = None, pos: str = POS) -> DataFrame:
    """Rows whose size, summed with all before them in order of ``pos``, stays within ``limit`` (least-recently-used caches)."""
    total = df.count() if total is None else total
    return running_sum(df, size, total, "__before__", pos).filter(F.col("__before__") + F.col(size) <= limit).drop("__before__")


def round_robin(parts: DataFrame, source: str, pos: str = POS, longest: bool = False) -> DataFrame:
    """Turns over the sources (in order of ``source``), each in order of ``pos``: adds ``turn``, the new order.

    Shortest: ends when the source whose turn it is has no row left.  Longest: exhausted sources drop out.
    """
    out = parts.withColumn("turn", F.struct(F.col(pos).alias("round"), F.col(source).alias("source")))
    if longest:
        return out
    sizes = parts.groupBy(source).agg(F.count(F.lit(1)).alias("n"))
    stop = sizes.agg(F.min(F.struct("n", F.col(source).alias("source"))).alias("stop")).first().stop
    if stop is None:
        return out
    return out.filter((F.col(pos) < stop.n) | ((F.col(pos) == stop.n) & (F.col(source) < F.lit(stop.source))))
