"""Drive a bounded source through a streaming plan to completion."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.order import POS, pos_overall
from ..runtime import hadoop_fs, scratch_path

#: Rows of one file of an ordered source.
FILE_ROWS = 500_000


def ordered_source(rows: DataFrame, order: str, file_rows: int = FILE_ROWS) -> str:
    """A folder with ``rows`` whose files, taken by time as a stream takes them, follow ``order``."""
    path = scratch_path(rows.sparkSession, "ordered")
    files = max(1, -(-rows.count() // file_rows))
    rows.repartitionByRange(files, order).sortWithinPartitions(order).write.parquet(path)
    fs, where = hadoop_fs(rows.sparkSession, path)
    parts = [f.getPath() for f in fs.listStatus(where) if f.getPath().getName().startswith("part-")]
    for n, part in enumerate(sorted(parts, key=lambda p: p.getName())):
        fs.setTimes(part, 1_000_000_000_000 + 1000 * n, -1)
    return path


def arrival_source(rows: DataFrame, order: list[str], batches: int) -> str:
    """A folder of at most ``batches`` files of equally many rows, in the order of arrival that ``order`` gives.

    Read one file at a time, the files are the micro-batches of a stream.
    """
    spark = rows.sparkSession
    path, placed = scratch_path(spark, "arrivals"), pos_overall(rows, *order)
    size = max(1, -(-placed.count() // batches))
    placed.withColumn("batch", F.floor(F.col(POS) / size).cast("int")).drop(POS).repartition("batch").write.partitionBy("batch").parquet(path)
    fs, where = hadoop_fs(spark, path)
    for folder in fs.listStatus(where):
        name = folder.getPath().getName()
        for part in fs.listStatus(folder.getPath()) if name.startswith("batch=") else ():
            fs.setTimes(part.getPath(), 1_000_000_000_000 + 60_000 * int(name[6:]), -1)
    return path


def run_to_table(spark: SparkSession, source: str, schema: StructType, plan: Callable[[DataFrame], DataFrame], mode: str = "append", files: int = 4, glob: str | None = None) -> DataFrame:
    """Read Parquet files under ``source`` as a stream, write what ``plan`` emits and return the table.

    All data that is there is processed in micro-batches of ``files`` files, then the query ends; checkpoint and
    table lie in the shared folder, so a restart goes on where it stopped.
    """
    out, mark = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    stream = (reader.option("pathGlobFilter", glob) if glob else reader).parquet(source)
    result = plan(stream)
    if mode == "append":
        query = result.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start()
    else:
        query = (
            result.writeStream.outputMode(mode)
            .foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(out))
            .option("checkpointLocation", mark)
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(out)
