"""Integrity checks of packed sequences, the shard index and key statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tokenizers import IM_END, IM_PATCH, IM_START
from .packing import CAPACITY


def id_count(ids: Column, value: int) -> Column:
    return F.size(F.filter(ids, lambda x: x == value))


def pair_violations(df: DataFrame, ids: str = "input_ids", mask: str = "loss_mask", patches: int = 256, limit: int = CAPACITY) -> DataFrame:
    """Rows that break a rule, with ``violation``: 'no_ids', 'mask_length', 'too_long', 'image_ends' or 'image_patches'."""
    i, m = F.col(ids), F.col(mask)
    start = id_count(i, IM_START)
    what = (
        F.when(i.isNull() | (F.size(i) == 0), "no_ids")
        .when(m.isNull() | (F.size(i) != F.size(m)), "mask_length")
        .when(F.size(i) >= limit, "too_long")
        .when(start != id_count(i, IM_END), "image_ends")
        .when(id_count(i, IM_PATCH) != start * patches, "image_patches")
    )
    return df.withColumn("violation", what).filter("violation is not null")


def shard_index(df: DataFrame, url: str = "url") -> DataFrame:
    """(url, nsamples)."""
    return df.groupBy(F.col(url).alias("url")).agg(F.count(F.lit(1)).alias("nsamples"))


def index_totals(index: DataFrame) -> DataFrame:
    return index.agg(F.count(F.lit(1)).alias("n_shards"), F.coalesce(F.sum("nsamples"), F.lit(0)).alias("n_samples"))


def key_histogram(df: DataFrame, keys: Column) -> DataFrame:
    """How often each set of field names occurs: (keys, n), most frequent first."""
    names = F.array_join(F.array_sort(keys), " ")
    return df.groupBy(names.alias("keys")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "keys")


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def payload_totals(df: DataFrame, data: str = "data") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length(data)), F.lit(0)).alias("n_bytes"))


def review_sample(df: DataFrame, key: Column, share: float = 0.01, seed: int = 0) -> DataFrame:
    """Samples for review by a reader, chosen by hash of their key; write them with ``df.write.text`` or JSON."""
    from .sampling import rsample

    return rsample(df, share, key, seed)


def review_lines(df: DataFrame, tokenizer: object, share: float = 0.01, seed: int = 0) -> DataFrame:
    """One JSON line per reviewed sample: url, key, its text, and its ids (all, and those that are not masked) as text where the tokenizer can tell."""
    rows = review_sample(df, F.concat_ws("/", "url", "key"), share, seed)
    trained = F.transform(F.filter(F.arrays_zip("input_ids", "loss_mask"), lambda p: p["loss_mask"] == 1), lambda p: p["input_ids"])
    told = tokenizer.text if hasattr(tokenizer, "text") else lambda ids: F.array_join(ids, " ")
    rows = rows.withColumn("__trained__", trained)
    return rows.select(F.to_json(F.struct("url", "key", "text", told(F.col("input_ids")).alias("all"), told(F.col("__trained__")).alias("trained"))).alias("value"))
