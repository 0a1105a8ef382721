"""Frame arithmetic of clips, as JVM-side expressions.  Rounding is half-even, casts cut towards zero."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seconds that stand for an open bound.
OPEN_BOUND = 100_000.0
FRAMES = 16
#: Longest image side that is kept; beyond it both sides become this long.
MAX_SIDE = 1280


def duration(frames: Column, fps: Column) -> Column:
    return F.when(fps > 0, frames / fps)


def frame_indices(max_frame: Column, fps: Column, n: int = FRAMES, start: Column | None = None, end: Column | None = None, first: int = 0) -> Column:
    """``n`` frame numbers at the middles of equal segments between two times (open: the whole clip)."""
    if n <= 0:
        raise ValueError("the number of segments must be positive")
    s, e = (F.lit(-OPEN_BOUND) if start is None else start), (F.lit(OPEN_BOUND) if end is None else end)
    low = F.greatest(F.lit(float(first)), F.rint(s * fps))
    high = F.least(F.rint(e * fps), max_frame.cast("double"))
    seg = (high - low) / n
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (low + seg / 2 + F.rint(seg * i)).cast("int"))


def relative_timestamp(t: Column, length: Column, scale: int = 1000) -> Column:
    """Place of a time in a clip on a scale, to one decimal."""
    return F.when(length > 0, F.bround(t / length * scale, 1))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used, inside lambdas too."""
    return F.transform(F.array(value), use)[0]


def uniform_sample(items: Column, n: int) -> Column:
    """All items if there are at most ``n``; else ``n`` of them in whole steps from the first (the end may not be reached)."""
    return _let(items, lambda x: _steps(x, F.lit(n)))


def _steps(items: Column, n: Column) -> Column:
    step = F.when(n <= 1, 1).otherwise(F.greatest(F.floor((F.size(items) - 1) / F.greatest(n - 1, F.lit(1))), F.lit(1))).cast("int")
    places = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: i)
    return F.when(F.size(items) <= n, items).otherwise(_let(step, lambda k: F.transform(places, lambda i: F.get(items, i * k))))


def key_frames(frames: Column, most_i: int = 8, total: int = 24) -> Column:
    """STRUCT<i_frames, p_frames> of ARRAY<STRUCT<idx, kind>>: sampled intra frames with the last frame added,
    and as many others as fill up ``total``, their last left out."""

    def parts(order: Column) -> Column:
        n = F.size(order)
        number = lambda a: F.transform(a, lambda f: f["idx"])
        intra = F.concat(number(F.filter(order, lambda f: f["kind"] == "I")), F.when(n > 0, F.array(F.element_at(order, n)["idx"])).otherwise(F.array().cast("array<int>")))
        other = number(F.filter(order, lambda f: f["kind"] != "I"))
        return F.struct(uniform_sample(intra, most_i).alias("i"), _let(other, lambda o: F.slice(o, 1, F.greatest(F.size(o) - 1, F.lit(0)))).alias("o"))

    def chosen(p: Column) -> Column:
        return F.struct(p["i"].alias("i_frames"), _steps(p["o"], F.lit(total) - F.size(p["i"])).alias("p_frames"))

    return _let(F.array_sort(frames), lambda order: _let(parts(order), chosen))


def merge_key_frames(i_frames: Column, p_frames: Column) -> Column:
    """ARRAY<STRUCT<idx, kind>> in frame order; of two at one frame the predicted one comes first."""
    tagged = F.concat(
        F.transform(p_frames, lambda x: F.struct(x.alias("idx"), F.lit(0).alias("o"), F.lit("P").alias("kind"))),
        F.transform(i_frames, lambda x: F.struct(x.alias("idx"), F.lit(1).alias("o"), F.lit("I").alias("kind"))),
    )
    return F.transform(F.array_sort(tagged), lambda f: F.struct(f["idx"].alias("idx"), f["kind"].alias("kind")))


def time_scale_indices(i: Column, n: Column, scale: int = 1000) -> Column:
    """Frame ``i`` of ``n`` on a scale, cut to a whole number; 0 for a single frame."""
    return F.when(n > 1, (i / (n - 1) * scale).cast("int")).otherwise(0)


def capped_side(side: Column, other: Column, most: int = MAX_SIDE) -> Column:
    return F.when(F.greatest(side, other) > most, F.lit(most)).otherwise(side)


def black_background(text: Column) -> Column:
    """STRUCT<width, height> named in a black-background caption, null for any other text."""
    got = lambda i: F.regexp_extract(text, r"^Black background:[^0-9]*(\d+)\s*,\s*(\d+)", i)
    return F.when(F.length(got(1)) > 0, F.struct(got(1).cast("int").alias("width"), got(2).cast("int").alias("height")))
