"""Filling fixed-capacity sequences with whole samples along a space-filling curve (problem 1).

Every sample's token ids are hashed into a short vector, projected to three dimensions and placed on a
Hilbert curve.  The curve is cut into segments of about equal token counts, the samples are shuffled by
segment and sorted by curve position (one shuffle of the tokens), and each segment packs neighbours
best-fit into a bounded number of open sequences.  The segments follow from the data alone, so neither
the number of partitions nor what adaptive execution makes of them changes a sequence.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CAPACITY = 8000
#: Ids from here on stand for media patches; they say nothing about a sample's content and are not hashed.
MEDIA_IDS = 32000
DIMENSIONS, BITS, HASHED = 3, 16, 64
#: The curve's cells that tokens are counted in (one number each for the driver), tokens of a segment, and segments at most.
CELLS, SEGMENT, SEGMENTS = 1 << 16, 4_000_000, 1 << 16
#: Sequences that a task holds open; the fullest is closed when one more is needed.
OPEN = 128
#: Most bytes of one Arrow batch: token lists are long, and several batches per task are in memory at once.
ARROW_BYTES = 8 << 20
#: Tokens hashed at a time.
PASS = 500_000
#: Sequences per Arrow batch handed back to the JVM.
BATCH = 64
SCHEMA = "seq_id bigint, n_tokens int, sample_ids array<bigint>, starts array<int>, lengths array<int>, sample_from array<int>, input_ids array<int>, loss_mask array<int>"


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer cells (n x d, each below 2**bits), after Skilling (2004)."""
    x = cells.astype(np.uint64).T.copy()
    d = len(x)
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        low = q - np.uint64(1)
        for i in range(d):
            inside = (x[i] & q) != 0
            swap = np.where(inside, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inside, low, swap)
            x[i] ^= swap
        q >>= np.uint64(1)
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        t ^= np.where((x[d - 1] & q) != 0, q - np.uint64(1), np.uint64(0))
        q >>= np.uint64(1)
    x ^= t
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return key.astype(np.int64)


def _projection() -> np.ndarray:
    basis, _ = np.linalg.qr(np.random.default_rng(20240229).standard_normal((HASHED, DIMENSIONS)))
    return basis * np.sqrt(HASHED)


def curve_positions(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Curve position of each list of a flattened list array; lists without content tokens share one cell.

    The tokens are hashed PASS at a time, so working memory does not follow the batch or the longest list.
    """
    n = len(offsets) - 1
    vectors = np.zeros(n * HASHED)
    for start in range(offsets[0], offsets[-1], PASS):
        end = min(start + PASS, offsets[-1])
        first = np.searchsorted(offsets, start, side="right") - 1
        last = np.searchsorted(offsets, end, side="left")
        sizes = np.diff(np.clip(offsets[first : last + 1], start, end))
        words = values[start:end]
        content = words < MEDIA_IDS
        owner = np.repeat(np.arange(last - first, dtype=np.int64), sizes)[content]
        mixed = words[content].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        slot = owner * HASHED + (mixed >> np.uint64(58)).astype(np.int64)
        sign = np.where((mixed >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
        vectors[first * HASHED : last * HASHED] += np.bincount(slot, weights=sign, minlength=(last - first) * HASHED)
    vectors = vectors.reshape(n, HASHED)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    at = (vectors / np.where(norm == 0, 1, norm)) @ _projection()
    unit = 1 / (1 + np.exp(-1.702 * at))  # logistic stand-in for the normal distribution function: cells about equally full
    return hilbert_key(np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values (nulls as 0) and offsets of a list array, without a copy if there are no nulls."""
    values = lists.values
    return (values if values.null_count == 0 else values.fill_null(0)).to_numpy(zero_copy_only=False), lists.offsets.to_numpy()


@F.arrow_udf(T.LongType())
def _curve(ids: pa.Array) -> pa.Array:
    return pa.array(curve_positions(*_flat(ids)))


def _bytes(text: str) -> int:
    """A Spark size setting in bytes."""
    m = re.fullmatch(r"\s*(\d+)\s*([bkmg]?)b?\s*", text.lower())
    return int(m[1]) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30}[m[2]] if m else ARROW_BYTES + 1


class Packer:
    """Best-fit packing in arrival order with a bounded number of open sequences.

    An item is (sample id, offset in the sample, ids, mask).  Samples longer than the capacity are cut into
    full pieces and a rest; nothing else is ever cut.
    """

    def __init__(self, capacity: int, opened: int = OPEN):
        self.capacity, self.opened = capacity, opened
        self.bins: list[list] = []
        self.room: list[int] = []

    def _place(self, item: tuple) -> list | None:
        """Put the item into the open sequence it fills best; returns a sequence that had to be closed."""
        n, closed = len(item[2]), None
        best, at = self.capacity + 1, -1
        for i, r in enumerate(self.room):
            if n <= r < best:
                best, at = r, i
        if at < 0:
            if len(self.bins) == self.opened:
                full = min(range(len(self.room)), key=self.room.__getitem__)
                closed = self._close(full)
            at = len(self.bins)
            self.bins.append([])
            self.room.append(self.capacity)
        self.bins[at].append(item)
        self.room[at] -= n
        return self._close(at) if self.room[at] == 0 and closed is None else closed

    def _close(self, i: int) -> list:
        done = self.bins[i]
        self.bins[i], self.room[i] = self.bins[-1], self.room[-1]
        self.bins.pop(), self.room.pop()
        return done

    def add(self, sample: int, ids: np.ndarray, mask: np.ndarray) -> Iterator[list]:
        start = 0
        while len(ids) - start > self.capacity:
            end = start + self.capacity
            yield [(sample, start, ids[start:end], mask[start:end])]
            start = end
        if closed := self._place((sample, start, ids[start:], mask[start:])):
            yield closed

    def finish(self) -> Iterator[list]:
        """Close what is open; its items are first packed anew, longest first."""
        items = sorted((x for b in self.bins for x in b), key=lambda x: -len(x[2]))
        self.bins, self.room, self.opened = [], [], len(items) + 1
        for x in items:
            if closed := self._place(x):
                yield closed
        yield from self.bins
        self.bins, self.room = [], []


def _lists(rows: list[list], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate([np.asarray(r) for r in rows]) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat).cast(kind))


def _batch(first: int, seqs: list[list]) -> pa.RecordBatch:
    i32, lengths = pa.int32(), [[len(x[2]) for x in s] for s in seqs]
    columns = [
        pa.array(np.arange(first, first + len(seqs)), pa.int64()),
        pa.array([sum(n) for n in lengths], i32),
        _lists([[x[0] for x in s] for s in seqs], pa.int64()),
        _lists([np.cumsum([0, *n[:-1]]) for n in lengths], i32),
        _lists(lengths, i32),
        _lists([[x[1] for x in s] for s in seqs], i32),
        _lists([np.concatenate([x[2] for x in s]) for s in seqs], i32),
        _lists([np.concatenate([x[3] for x in s]) for s in seqs], i32),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])


def _samples(b: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(curve, sample, ids, mask) of each row of (segment, curve, sample, ids, mask); a mask that is missing or short is filled up with 0, a long one cut."""
    _, curve, sample, ids, mask = b.columns
    curve, sample = curve.to_numpy(), sample.to_pylist()
    (flat, ends), (mflat, mends) = _flat(ids), _flat(mask)
    for i in range(b.num_rows):
        x = flat[ends[i] : ends[i + 1]].copy()  # a view would keep the whole batch alive in an open sequence
        m = mflat[mends[i] : mends[i + 1]][: len(x)]
        yield curve[i], sample[i], x, np.concatenate([m, np.zeros(len(x) - len(m), m.dtype)])


def pack_sequences(df: DataFrame, id_col: str = "sample_id", ids: str = "input_ids", mask: str = "loss_mask", capacity: int = CAPACITY) -> DataFrame:
    """Sequences of at most ``capacity`` ids, each usable sample in exactly one of them.

    A sample is usable if it has ids.  Only samples longer than ``capacity`` are cut: into full pieces, each a
    sequence of its own, and a rest that is packed like a sample.  Rows that repeat a sample (same id, same
    ids) count once, the one with the longest mask; one id over different ids is different samples.  Missing
    mask entries are 0: no loss where none was asked for.  Null ids inside a list are 0.  Rows with a null
    sample id are packed, all of them.  ``starts``/``lengths`` give each piece's place in the sequence,
    ``sample_from`` its offset in the sample.  Lowers the session's Arrow batch bound to ARROW_BYTES.
    """
    spark, limit = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    if _bytes(spark.conf.get(limit, "64m")) > ARROW_BYTES:
        spark.conf.set(limit, str(ARROW_BYTES))  # read when the plan runs, so it has to stay set
    named = df.select(F.col(id_col).cast("bigint").alias("sample_id"), F.col(ids).cast("array<int>").alias("ids"), F.coalesce(F.col(mask).cast("array<int>"), F.array().cast("array<int>")).alias("mask"))
    usable = named.filter(F.size("ids") > 0)
    salt = [F.col("sample_id"), F.size("ids"), *(F.get("ids", (F.size("ids") * k / 8).cast("int")) for k in range(8))]
    order = [F.col("segment"), F.col("curve"), F.col("sample_id"), F.size("ids"), F.size("mask").desc()]
    at = locate(F.col("ids"), salt, curve_segments(usable.withColumn("curve", _curve("ids"))))
    located = usable.withColumn("at", at).select("at.segment", "at.curve", "sample_id", "ids", "mask")
    ranged = located.repartition("segment").sortWithinPartitions(*order)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, ready, now, number = Packer(capacity), [], None, 0
        seen: tuple = ()
        same: list[np.ndarray] = []

        def leave(everything: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ready, number
            while len(ready) >= BATCH or (everything and ready):
                yield _batch((now << 32) + number, ready[:BATCH])
                number += len(ready[:BATCH])
                ready = ready[BATCH:]

        for b in batches:
            for segment, (curve, sample, x, m) in zip(b.column(0).to_pylist(), _samples(b), strict=True):
                if segment != now:
                    ready += packer.finish()
                    yield from leave(True)
                    packer, now, number, seen = Packer(capacity), segment, 0, ()
                if (curve, sample) != seen:
                    seen, same = (curve, sample), []
                elif sample is not None and any(np.array_equal(x, y) for y in same):
                    continue
                same.append(x)
                ready += packer.add(sample, x, m)
                yield from leave(False)
        ready += packer.finish()
        yield from leave(True)

    return ranged.mapInArrow(pack, SCHEMA)


def curve_segments(placed: DataFrame) -> list[tuple[int, int]]:
    """(first cell, number of parts) of each segment of the curve, in order.

    A segment is a run of cells with SEGMENT tokens (more, if there would be over SEGMENTS of them).  A cell that
    alone holds twice as many is a segment in several parts, its samples spread by id.
    """
    cell = F.shiftright("curve", DIMENSIONS * BITS - (CELLS - 1).bit_length())
    rows = placed.groupBy(cell.cast("int").alias("cell")).agg(F.sum(F.size("ids").cast("bigint")).alias("n")).collect()
    counts = sorted((r["cell"], r["n"]) for r in rows)
    aim = max(SEGMENT, -(-sum(n for _, n in counts) // SEGMENTS))
    out, held = [], aim
    for at, n in counts:
        if n >= 2 * aim:
            out.append((at, n // aim))
            held = aim
        else:
            if held >= aim:
                out.append((at, 1))
                held = 0
            held += n
    return out


def locate(ids: Column, salt: list[Column], segments: list[tuple[int, int]]) -> Column:
    """STRUCT<segment, curve> of a sample; the part of a segment in several parts follows from the hash of ``salt``."""
    firsts = np.array([at for at, _ in segments] or [0], dtype=np.int64)
    parts = np.array([n for _, n in segments] or [1], dtype=np.int64)
    bases = np.cumsum(parts) - parts
    shift = DIMENSIONS * BITS - (CELLS - 1).bit_length()

    @F.arrow_udf("segment bigint, curve bigint")
    def find(lists: pa.Array, mixed: pa.Array) -> pa.Array:
        curve = curve_positions(*_flat(lists))
        i = np.searchsorted(firsts, curve >> shift, side="right") - 1
        return pa.StructArray.from_arrays([pa.array(bases[i] + mixed.to_numpy() % parts[i]), pa.array(curve)], names=["segment", "curve"])

    return find(ids, F.pmod(F.xxhash64(*salt), F.lit(1 << 20)))


def fill_report(sequences: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: sequences, tokens and the share of the capacity that they fill (0 for no sequence)."""
    n, tokens = F.count(F.lit(1)), F.coalesce(F.sum("n_tokens"), F.lit(0))
    return sequences.agg(n.alias("n_sequences"), tokens.alias("n_tokens"), F.when(n > 0, F.round(tokens / (n * capacity), 6)).otherwise(0.0).alias("fill"))
