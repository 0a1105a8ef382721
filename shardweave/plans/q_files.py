"""Queries over a manifest kept as very many small files (problem 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.compaction import Compacted, consolidate_files, read_compacted
from ..runtime import scratch_path


def _consolidated(spark: SparkSession, sf: str) -> tuple[DataFrame, Compacted]:
    files = spark.read.parquet(f"{sf}/manifest_files.parquet")
    done = consolidate_files(files, scratch_path(spark, "compact"))
    return read_compacted(spark, done), done


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _consolidated(spark, sf)[0].select("rec_key")


def p4_records(spark: SparkSession, sf: str) -> DataFrame:
    """Whole records, read back."""
    return _consolidated(spark, sf)[0]


def p4_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What was read and what came of it."""
    done = _consolidated(spark, sf)[1]
    return spark.createDataFrame([(done.lines, done.damaged, done.records)], "lines bigint, damaged bigint, records bigint")


QUERIES = {"p4_found": p4_found, "p4_records": p4_records, "p4_counts": p4_counts}
_LINES = r"""
WITH lines AS (
  SELECT trim(unnest(regexp_split_to_array(content, '\r\n|\r|\n')), chr(65279) || ' ' || chr(9)) AS line
  FROM manifest_files WHERE content IS NOT NULL),
whole AS (SELECT * FROM lines WHERE line LIKE '{%}' AND json_valid(line) AND json_extract_string(line, '$.rec_key') IS NOT NULL)
"""
_FIELDS = ", ".join(f"json_extract_string(line, '$.{c}') AS {c}" for c in ("rec_key", "video_path", "value"))
ORACLES = {
    "p4_found": _LINES + "SELECT DISTINCT json_extract_string(line, '$.rec_key') AS rec_key FROM whole",
    "p4_records": _LINES + f"SELECT DISTINCT {_FIELDS} FROM whole",
    "p4_counts": _LINES
    + """SELECT (SELECT count(*) FROM lines WHERE line <> '') AS lines, (SELECT count(*) FROM lines WHERE line <> '') - count(*) AS damaged,
         count(DISTINCT json_extract_string(line, '$.rec_key')) AS records FROM whole""",
}
