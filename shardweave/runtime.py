"""Session-level helpers: shared folder, lineage cuts, size-checked broadcasts.

Lineage is cut by a written table in the shared folder that the cluster names in
``spark.checkpoint.dir``; a lost executor therefore never loses an intermediate result.  Only where
that setting is absent (tests, local use) a folder of our own is set.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows and bytes (as JSON) that a broadcast side may have; beyond either the shuffle join is used.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or in local mode, where it is unset, one of our own."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="shardweave-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def hadoop_fs(spark: SparkSession, path: str):
    """(file system, Path) of a path, through the JVM gateway."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/shardweave/{name}-{os.getpid()}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            delete_path(spark, path)
        except Exception:  # noqa: BLE001 - the JVM is already gone; the folder is the cluster's scratch space
            return


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows and ``max_bytes`` bytes, else ``df`` unchanged.

    The check reads at most ``max_rows + 1`` rows.
    """
    size = F.sum(F.length(F.to_json(F.struct("*"))).cast("bigint"))
    n, held = df.limit(max_rows + 1).agg(F.count(F.lit(1)), size).first()
    return F.broadcast(df) if n <= max_rows and (held or 0) <= max_bytes else df


@contextmanager
def conf(spark: SparkSession, **settings: object):
    """Set session settings (dots written as ``__``) for the duration of a block."""
    names = {k.replace("__", "."): str(v) for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
