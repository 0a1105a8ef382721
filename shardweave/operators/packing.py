"""Greedy next-fit packing of token sequences, the stateful heart of the tokenize step.

Per group, in order: a sample that does not fit closes the open bin; a sample of ``capacity`` or more closes it
too and is dropped; the last open bin is dropped unless ``keep_tail``.  No window function can express this
(each reset depends on the one before), so groups are folded, in two forms with equal results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITY = 8000


def next_fit(lengths: Iterable[int], capacity: int = CAPACITY, keep_tail: bool = False) -> list[int | None]:
    """Bin of each length, None where it is dropped."""
    out: list[int | None] = []
    bin_, used, n = 0, 0, 0
    for length in lengths:
        if used + length > capacity and n > 0:
            bin_, used, n = bin_ + 1, 0, 0
        fits = length < capacity
        out.append(bin_ if fits else None)
        if fits:
            used, n = used + length, n + 1
    return out if keep_tail else [None if b == bin_ else b for b in out]


def pack_groups(df: DataFrame, group: str, order: str, length: str, capacity: int = CAPACITY, keep_tail: bool = False) -> DataFrame:
    """``df`` with ``bin`` for the rows that are packed: one task folds one group, rows streamed in Arrow batches.

    The rows are shuffled and sorted by group and order once.  A group may be of any length: a row leaves the fold
    when its bin is closed, so no more than one open bin is held, and the last one is dropped where it stands.
    Null lengths count as 0.
    """
    columns = [c for c in df.columns if c != "bin"]
    ready = df.select(*columns).repartition(group).sortWithinPartitions(group, order)
    schema = ready.withColumn("bin", F.lit(0).cast("int")).schema
    g, n, names = columns.index(group), columns.index(length), [*columns, "bin"]

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = object()
        bin_ = used = count = 0
        held: list[pa.RecordBatch] = []  # rows of the open bin from batches before

        def cut(b: pa.RecordBatch, rows: list[int], bins: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*b.take(pa.array(rows, pa.int64())).columns, pa.array(bins, pa.int32())], names=names)

        for b in batches:
            done, bins, fresh = [], [], []  # closed rows and their bins; rows of the open bin
            for i, (key, size) in enumerate(zip(b.column(g).to_pylist(), b.column(n).to_pylist(), strict=True)):
                size = size or 0
                full = key == now and used + size > capacity and count > 0
                if full or key != now:
                    if full or keep_tail:
                        yield from held
                        done += fresh
                        bins += [bin_] * len(fresh)
                    held, fresh = [], []
                    bin_, used, count = (bin_ + 1 if full else 0), 0, 0
                    now = key
                if size < capacity:
                    fresh.append(i)
                    used, count = used + size, count + 1
            if done:
                yield cut(b, done, bins)
            if fresh:
                held.append(cut(b, fresh, [bin_] * len(fresh)))
        if keep_tail:
            yield from held

    return ready.mapInArrow(fold, schema)


MERGED = "bin int, n_samples int, input_ids array<int>, loss_mask array<int>, text array<string>, closed_by string, images array<binary>"


def merge_groups(df: DataFrame, group: str, order: list[str], key: str = "key", capacity: int = CAPACITY, keep_tail: bool = False) -> DataFrame:
    """One row per bin of each group, in the rule of :func:`pack_groups`: (group, bin, n_samples, input_ids, loss_mask, text, closed_by, images).

    ``df``: (group, order, key, input_ids, loss_mask, text, images).  The sequences of a bin are joined in the fold,
    the opening id of all but the first left out, so the samples are shuffled once and a task holds one open bin.
    ``closed_by`` is the key of the sample that did not fit any more, null for a tail.
    """
    take = [group, key, "input_ids", "loss_mask", "text", "images"]
    ready = df.repartition(group).sortWithinPartitions(group, *order).select(*take)
    kind = dict(df.dtypes)[group]

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = object()
        bin_ = used = 0
        held: list[tuple] = []

        def out(closed_by: str | None) -> pa.RecordBatch:
            ids, mask = ([x for i, s in enumerate(held) for x in (s[c] if i == 0 else s[c][1:])] for c in (0, 1))
            row = {group: now, "bin": bin_, "n_samples": len(held), "input_ids": ids, "loss_mask": mask, "text": [s[2] for s in held], "closed_by": closed_by, "images": [x for s in held for x in s[3] or ()]}
            return pa.RecordBatch.from_pylist([row], schema)

        schema = None
        for b in batches:
            if schema is None:
                rest = [("bin", pa.int32()), ("n_samples", pa.int32()), ("input_ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.int32())), ("text", pa.list_(pa.string())), ("closed_by", pa.string()), ("images", pa.list_(pa.binary()))]
                schema = pa.schema([(group, b.column(0).type), *rest])
            for g, name, *sample in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if g != now:
                    if held and keep_tail:
                        yield out(None)
                    now, bin_, used, held = g, 0, 0, []
                size = len(sample[0] or ())
                if used + size > capacity and held:
                    yield out(name)
                    bin_, used, held = bin_ + 1, 0, []
                if size < capacity:
                    held.append(tuple(sample))
                    used += size
        if held and keep_tail:
            yield out(None)

    return ready.mapInArrow(fold, f"`{group}` {kind}, {MERGED}")


def fold_bins(lengths: Column, capacity: int = CAPACITY) -> Column:
    """The same as one expression over an ordered ARRAY<INT>: bins, -1 - bin where dropped (for groups that fit a row)."""
    start = F.struct(F.lit(0).alias("bin"), F.lit(0).alias("used"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, size: Column) -> Column:
        close = (s["used"] + size > capacity) & (s["n"] > 0)
        bin_ = s["bin"] + close.cast("int")
        used, n = F.when(close, 0).otherwise(s["used"]), F.when(close, 0).otherwise(s["n"])
        fits = size < capacity
        return F.struct(
            bin_.alias("bin"),
            F.when(fits, used + size).otherwise(used).alias("used"),
            F.when(fits, n + 1).otherwise(n).alias("n"),
            F.concat(s["out"], F.array(F.when(fits, bin_).otherwise(-1 - bin_))).alias("out"),
        )

    return F.aggregate(lengths, start, step, lambda s: s["out"])


#: Rows of a group that the fold as one expression takes: it copies its output at every step.
FOLD_ROWS = 20_000


def pack_folded(df: DataFrame, group: str, order: str, length: str, capacity: int = CAPACITY, most_rows: int = FOLD_ROWS) -> DataFrame:
    """(group, order, length, bin) of the packed rows, without Python; the same rows as :func:`pack_groups`.

    The largest group is counted first; beyond ``most_rows`` rows the groups are streamed instead.
    """
    slim = df.select(group, order, F.coalesce(F.col(length), F.lit(0)).cast("int").alias(length))
    top = slim.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    if top > most_rows:
        return pack_groups(slim, group, order, length, capacity)
    rows = F.array_sort(F.collect_list(F.struct(order, length)))
    g = slim.groupBy(group).agg(rows.alias("__r__"))
    bins = fold_bins(F.transform("__r__", lambda x: x[length]), capacity)
    last = F.aggregate("__b__", F.lit(0), lambda a, b: F.greatest(a, F.when(b < 0, -1 - b).otherwise(b)))
    out = g.withColumn("__b__", bins).withColumn("__last__", last).select(group, "__last__", F.explode(F.arrays_zip("__r__", "__b__")).alias("z"))
    return out.filter("z.__b__ >= 0 and z.__b__ < __last__").select(group, F.col(f"z.__r__.{order}").alias(order), F.col(f"z.__r__.{length}").alias(length), F.col("z.__b__").alias("bin"))


def merge_bin(ids: Column) -> Column:
    """ARRAY<ARRAY<INT>> of a bin as one sequence: the opening id of all but the first is left out."""
    return F.flatten(F.transform(ids, lambda x, i: F.when(i == 0, x).otherwise(F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0))))))


def merged_length(total: Column, n: Column) -> Column:
    return total - F.greatest(n - 1, F.lit(0))
