"""Event-time windows with watermarks over a stream of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _timed(events: DataFrame, ts: str) -> DataFrame:
    """Event time as Spark's watermarks need it: times without zone are taken in the session's zone."""
    return events.withColumn(ts, F.col(ts).cast("timestamp"))


def _naive(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "10 minutes", ts: str = "ts", key: str = "event_type", value: str = "value") -> DataFrame:
    return sliding(events, width, width, late, ts, key, value)


def sliding(events: DataFrame, width: str = "1 hour", step: str = "15 minutes", late: str = "10 minutes", ts: str = "ts", key: str = "event_type", value: str = "value") -> DataFrame:
    """(window_start, key, n, total): rows that arrive later than ``late`` after newer ones are left out of a stream."""
    span = F.window(ts, width, step) if step != width else F.window(ts, width)
    out = _timed(events, ts).withWatermark(ts, late).groupBy(span.alias("w"), F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(_naive("w.start").alias("window_start"), "key", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes", ts: str = "ts", user: str = "user_id") -> DataFrame:
    """(session_start, session_end, user_id, n): runs of a user's events with no pause of ``gap`` or more."""
    out = _timed(events, ts).withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), F.col(user).alias("user_id")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(_naive("w.start").alias("session_start"), _naive("w.end").alias("session_end"), "user_id", "n")


def first_seen(events: DataFrame, key: str = "event_id", ts: str = "ts", late: str | None = "1 hour") -> DataFrame:
    """Each event once, however often it is delivered within the watermark.

    Without ``late`` no event of a stream is too late: each key stays in the state.
    """
    if events.isStreaming and late:
        return _timed(events, ts).withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
    return events.dropDuplicates([key])
