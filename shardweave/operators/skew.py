"""Joins of rows to per-key statistics under any skew.

A key that holds a third of all rows would put a third of the work into one task of a shuffle join.
Keys at or above ``total / HOT_KEYS`` rows number at most ``HOT_KEYS`` by the pigeonhole principle,
so their statistics have a proven size bound and are broadcast; every other key is bounded by that
same threshold and goes through the shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: At most so many keys can hold total / HOT_KEYS rows or more.
HOT_KEYS = 10_000
#: No key with fewer rows than this counts as hot, however small the table.
HOT_ROWS = 50_000


def attach_stats(rows: DataFrame, stats: DataFrame, key: str, n_col: str, total: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of ``rows`` with ``stats`` (one row per ``key``, row count in ``n_col``).

    Both should be materialized.  ``total`` is the number of rows of ``rows`` or more.  Null keys match nothing.
    """
    limit = max(hot_rows, -(-total // HOT_KEYS))
    hot = stats.filter(F.col(n_col) >= limit)
    cold = rows.join(stats.filter(F.col(n_col) < limit), key)
    return cold.unionByName(rows.join(F.broadcast(hot), key)) if hot.limit(1).count() else cold
