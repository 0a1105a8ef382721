"""Consolidation of very many small files into few of a sensible size.

The rows are read, damaged lines counted and on request written to a table of their own, each record kept
once, and the result shuffled under the adaptive REBALANCE hint: the runtime statistics of that shuffle
merge or split output partitions near the target size.  The files are written to a staging folder and only
renamed to their final place after the multiset checksum of what is read back equals that of what should be
there, and after the lines read equal the records and the damaged lines together.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..runtime import conf, delete_path, hadoop_fs

#: Bytes per output file that REBALANCE aims at (shuffle bytes; compressed Parquet comes out near it).
TARGET_BYTES = 128 << 20
RECORD_SCHEMA = "rec_key string, video_path string, value string"
#: CR LF, lone CR and lone LF all end a line; a byte-order mark may stand before it.
LINE_END = r"\r\n|\r|\n"


def read_lines(files: DataFrame, content: str = "content", schema: str = RECORD_SCHEMA, key: str = "rec_key") -> DataFrame:
    """(line, r): every line that is not blank, with its record or null where it holds no complete one.

    A line is a complete record if it is one whole JSON object with a non-null ``key``; other fields may
    be null.  Null and empty files and blank lines give no row.  Columns of ``files`` other than
    ``content`` are not read, so clashing names cannot matter.
    """
    corrupt = "__broken__"
    line = F.explode(F.split(F.col(content), LINE_END)).alias("line")
    lines = files.select(line).select(F.regexp_replace("line", "^[\\uFEFF\\s]+|\\s+$", "").alias("line")).filter("line <> ''")
    whole = F.when(F.col("line").rlike(r"^\{[\s\S]*\}$"), F.from_json("line", f"{schema}, {corrupt} string", {"columnNameOfCorruptRecord": corrupt}))
    parsed = lines.withColumn("r", whole)
    return parsed.withColumn("r", F.when(F.col(f"r.{corrupt}").isNull() & F.col(f"r.{key}").isNotNull(), F.col("r").dropFields(corrupt)))


def parse_lines(files: DataFrame, content: str = "content", schema: str = RECORD_SCHEMA, key: str = "rec_key") -> DataFrame:
    """The complete records of :func:`read_lines`."""
    return read_lines(files, content, schema, key).filter("r is not null").select("r.*")


def damaged_lines(files: DataFrame, content: str = "content", schema: str = RECORD_SCHEMA, key: str = "rec_key") -> DataFrame:
    """(line): what :func:`parse_lines` leaves out."""
    return read_lines(files, content, schema, key).filter("r is null").select("line")


def _row_hash(columns: list[str]) -> Column:
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in columns])


def checksum_exprs(columns: list[str]) -> list[Column]:
    """Order-free checksum of a multiset of rows: count, sum and exclusive or of 64-bit row hashes."""
    h = _row_hash(columns)
    return [F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("total"), F.bit_xor(h).alias("xored")]


def multiset_checksum(df: DataFrame) -> tuple:
    return tuple(df.agg(*checksum_exprs(df.columns)).first())


@dataclass(frozen=True)
class Compacted:
    """``lines`` read, of which ``damaged`` hold no record, and different ``records`` in ``files``."""

    path: str
    records: int
    files: int
    lines: int | None = None
    damaged: int | None = None


def compact(df: DataFrame, path: str, target_bytes: int = TARGET_BYTES, overwrite: bool = False) -> Compacted:
    """Write ``df`` to ``path`` (Parquet) in files of about ``target_bytes``, all or nothing.

    The expected checksum is observed while the rows are written.  If it differs from that of the rows read
    back - an executor lost midway can make observed metrics count rows twice - it is computed afresh from
    ``df``; if it still differs nothing is committed.  An empty input commits an empty table.  A table that is
    already there is an error before anything is written, or with ``overwrite`` is moved aside and deleted once
    the new one is in its place.
    """
    spark = df.sparkSession
    fs, target = hadoop_fs(spark, path)
    if fs.exists(target) and not overwrite:
        raise FileExistsError(f"{path} is already there; nothing was written")
    staging, seen = f"{path}.staging-{uuid.uuid4().hex}", Observation()
    with conf(spark, spark__sql__adaptive__enabled="true", spark__sql__adaptive__advisoryPartitionSizeInBytes=target_bytes):
        df.observe(seen, *checksum_exprs(df.columns)).hint("rebalance").write.parquet(staging)
    back = multiset_checksum(spark.read.schema(df.schema).parquet(staging))
    if tuple(seen.get[k] for k in ("n", "total", "xored")) != back and multiset_checksum(df) != back:
        delete_path(spark, staging)
        raise RuntimeError(f"{path}: the rows written are not the rows read; nothing was committed")
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    old = f"{path}.old-{uuid.uuid4().hex}" if fs.exists(target) else None
    if old and not (overwrite and fs.rename(target, jpath(old))):
        delete_path(spark, staging)
        raise FileExistsError(f"{path} has come to be there; nothing was committed")
    if not fs.rename(jpath(staging), target) or fs.exists(jpath(f"{path}/{staging.rsplit('/', 1)[-1]}")):
        raise RuntimeError(f"{path}: cannot be committed; the old table is {old}")
    if old:
        delete_path(spark, old)
    files = sum(1 for s in fs.listStatus(target) if s.getPath().getName().startswith("part-"))
    return Compacted(path, back[0], files)


def consolidate_files(files: DataFrame, path: str, content: str = "content", schema: str = RECORD_SCHEMA, key: str = "rec_key", target_bytes: int = TARGET_BYTES, overwrite: bool = False, damaged_path: str | None = None) -> Compacted:
    """Consolidate JSON-lines files into few Parquet files at ``path``: every complete record exactly once.

    Records are told apart by ``key``; the same key always carries the same record, so any copy serves.  Lines
    and damaged lines are counted on the way (exactly, unless an executor is lost: then a repeated task counts
    twice); with ``damaged_path`` the damaged lines are also written there, as text.
    """
    seen, bad = Observation(), F.count(F.when(F.col("r").isNull(), 1)).alias("damaged")
    told = read_lines(files, content, schema, key).observe(seen, F.count(F.lit(1)).alias("lines"), bad, F.count("r").alias("records"))
    records = told.filter("r is not null").select("r.*")
    rest = [c for c in records.columns if c != key]
    once = records.groupBy(key).agg(F.min(F.struct(*rest)).alias("r")).select(key, "r.*") if rest else records.distinct()
    done = compact(once, path, target_bytes, overwrite)
    n = seen.get
    if n["lines"] != n["damaged"] + n["records"]:
        raise RuntimeError(f"{path}: {n} lines do not add up")
    if damaged_path:
        damaged_lines(files, content, schema, key).write.mode("overwrite").text(damaged_path)
    return replace(done, lines=n["lines"], damaged=n["damaged"])


def read_compacted(spark: SparkSession, done: Compacted, schema: str = RECORD_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(done.path)
