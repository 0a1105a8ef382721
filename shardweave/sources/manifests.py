"""Adapters from raw manifests to canonical rows.  Paths and prefixes are parameters; nothing is inferred by scanning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import join_path, last_components

TURNS = "array<struct<`from`:string,value:string>>"


def _array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def _lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def _prefixed(prefix: str, column: str):
    return join_path(F.lit(prefix), F.col(column)) if prefix else F.col(column)


def load_columns(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """One JSON object of two columns, each a record from row number to value."""
    raw = _array(spark, path, "image map<string,string>, value map<string,string>")
    image = raw.select(F.explode("image").alias("row", "image"))
    value = raw.select(F.explode("value").alias("row", "value"))
    return image.join(value, "row").select(_prefixed(prefix, "image").alias("video_path"), "value")


def load_captions(spark: SparkSession, path: str, prefix: str = "", media: str = "video", caption: str = "caption") -> DataFrame:
    """JSON array of {media, caption}."""
    return _array(spark, path, f"`{media}` string, `{caption}` string").select(_prefixed(prefix, media).alias("video_path"), F.col(caption).alias("value"))


def load_ego(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    return load_captions(spark, path, prefix, "video_path")


def load_control(spark: SparkSession, path: str, prefix: str = "", target_prefix: str | None = None) -> DataFrame:
    """JSON lines {source, prompt, control_...}: the target is the first field whose name holds ``control_``."""
    raw = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    got = raw.select(F.from_json("value", "map<string,string>").alias("m"))
    target = F.try_element_at(F.filter(F.map_entries("m"), lambda e: e["key"].contains("control_")), F.lit(1))["value"]
    rows = got.select(F.col("m")["source"].alias("source"), target.alias("target"), F.col("m")["prompt"].alias("value"))
    return rows.select(_prefixed(prefix, "source").alias("source"), _prefixed(prefix if target_prefix is None else target_prefix, "target").alias("target"), "value")


def load_clips(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """JSON array of {clips: [{clip_path, caption}]}: one row per clip, the last three parts of its path and ``.mp4``."""
    rows = _array(spark, path, "clips array<struct<clip_path:string,caption:string>>").select(F.explode("clips").alias("c"))
    rows = rows.select(last_components(F.col("c.clip_path"), 3, ".mp4").alias("p"), F.col("c.caption").alias("value"))
    return rows.select(_prefixed(prefix, "p").alias("video_path"), "value")


def load_timed(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """JSON lines {YoutubeID, Start_timestamp, End_timestamp, Caption}: the file is their ``_``-join and ``.mp4``."""
    rows = _lines(spark, path, "YoutubeID string, Start_timestamp string, End_timestamp string, Caption string")
    rows = rows.select(F.concat(F.concat_ws("_", "YoutubeID", "Start_timestamp", "End_timestamp"), F.lit(".mp4")).alias("p"), F.col("Caption").alias("value"))
    return rows.select(_prefixed(prefix, "p").alias("video_path"), "value")


def load_questions(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """JSON array of {video, QA: [{...}]}."""
    rows = _array(spark, path, "video string, QA array<map<string,string>>")
    return rows.select(_prefixed(prefix, "video").alias("video_path"), F.col("QA").alias("value"))


def load_chats(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """JSON array of {image, conversations}."""
    rows = _array(spark, path, f"image string, conversations {TURNS}")
    return rows.select(_prefixed(prefix, "image").alias("video_path"), F.col("conversations").alias("value"))


def _each_prefixed(prefix: str, column: str):
    return F.transform(column, lambda p: join_path(F.lit(prefix), p)) if prefix else F.col(column)


def load_interleaved(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """JSON array of {image_info, text_list}."""
    return _array(spark, path, "image_info array<string>, text_list string").select(_each_prefixed(prefix, "image_info").alias("video_path"), F.col("text_list").alias("value"))


def load_multi(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """JSON array of {images, conversations}."""
    return _array(spark, path, f"images array<string>, conversations {TURNS}").select(_each_prefixed(prefix, "images").alias("images"), "conversations")


def load_table(spark: SparkSession, path: str, columns: list[str] | None = None, prefix: str = "") -> DataFrame:
    """Parquet, only the columns asked for (all, if none are); the prefix is put before ``video_path``."""
    rows = spark.read.parquet(path)
    rows = rows.select(*columns) if columns else rows
    return rows.withColumn("video_path", _prefixed(prefix, "video_path")) if prefix and "video_path" in rows.columns else rows


def load_lines(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    return spark.read.text(path).select(_prefixed(prefix, "value").alias("video_path")).select(F.trim("video_path").alias("video_path"))


ADAPTERS: dict[str, Callable[..., DataFrame]] = {
    "columns": load_columns,
    "captions": load_captions,
    "ego": load_ego,
    "control": load_control,
    "clips": load_clips,
    "timed": load_timed,
    "questions": load_questions,
    "chats": load_chats,
    "interleaved": load_interleaved,
    "multi": load_multi,
    "table": load_table,
    "lines": load_lines,
}


def get_prefix(prefixes: dict[str, str], dataset: str) -> str:
    """Path prefix of a data set, empty for an unknown one."""
    return prefixes.get(dataset, "")


def load_manifest(spark: SparkSession, kind: str, path: str, **options: object) -> DataFrame:
    """By adapter name; a path of a JSON file in place of a name is read as questions, any other name is an error."""
    if kind not in ADAPTERS and not kind.endswith(".json"):
        raise ValueError(f"{kind!r} is none of {sorted(ADAPTERS)}")
    return ADAPTERS.get(kind, load_questions)(spark, path, **options)


def mock_rows(spark: SparkSession, n: int, **fields: object) -> DataFrame:
    """``n`` equal rows."""
    return spark.range(n).select(F.col("id").alias("__pos__"), *[F.lit(v).alias(k) for k, v in fields.items()])
