"""What to do with a bad row.  Errors are data: a fallible step writes ``_error`` and a policy decides.

'fail' raises when a bad row is read; 'skip' and 'warn_skip' drop bad rows; 'stop' and 'warn_stop' end the
stream before the first one.  The warn forms print how many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .order import POS

POLICIES = ("fail", "skip", "warn_skip", "stop", "warn_stop")


def flag(df: DataFrame, bad: Column, message: str, name: str = "_error") -> DataFrame:
    return df.withColumn(name, F.when(bad, F.lit(message)))


def apply_policy(df: DataFrame, policy: str = "fail", name: str = "_error", pos: str = POS) -> DataFrame:
    if policy not in POLICIES:
        raise ValueError(f"{policy!r} is none of {POLICIES}")
    bad = F.col(name).isNotNull()
    if policy == "fail":
        return df.filter(F.when(bad, F.raise_error(F.col(name)).cast("boolean")).otherwise(True)).drop(name)
    if policy.startswith("warn"):
        print(f"{df.filter(bad).count()} bad rows: {policy}")  # noqa: T201 - this is what the policy is for
    if policy.endswith("stop"):
        first = df.agg(F.min(F.when(bad, F.col(pos))).alias("p")).first().p
        return (df if first is None else df.filter(F.col(pos) < first)).drop(name)
    return df.filter(~bad).drop(name)
