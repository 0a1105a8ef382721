"""Token budget per source, language and domain (problem 6).

The tokenizer is loaded once per worker; texts are encoded in Arrow batches and only exact counts leave
Python.  Totals are summed over the cube of source, language and domain from pre-aggregated slices.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts per call of the tokenizer.
CHUNK = 512


def default_model(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def worker_model(path: str) -> sentencepiece.SentencePieceProcessor:
    """One per worker process, loaded at first use."""
    return sentencepiece.SentencePieceProcessor(model_file=path)


def token_count(text: Column, model: str | None = None) -> Column:
    """Exact number of tokens of a text, without opening and closing ones; 0 for null and empty."""
    path = model or default_model()

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        encode, n = worker_model(path).encode, []
        for i in range(0, len(texts), CHUNK):
            n += map(len, encode(texts[i : i + CHUNK].fill_null("").to_pylist(), num_threads=1))
        return pa.array(n, pa.int64())

    return count(text)


def language(c: Column) -> Column:
    """Two-letter code of an oddly written language tag; 'und' for null and blank."""
    code = F.lower(F.regexp_extract(c, r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1))
    return F.when(F.length(code) > 0, code).otherwise("und")


def label(c: Column) -> Column:
    """A source or domain name, trimmed and in lower case; 'unknown' for null and blank."""
    name = F.lower(F.trim(c))
    return F.when(F.length(name) > 0, name).otherwise("unknown")


def _slices(source: str, lang: str, domain: str) -> list[Column]:
    return [label(F.col(source)).alias("source"), language(F.col(lang)).alias("lang"), label(F.col(domain)).alias("domain")]


def encoded_counts(df: DataFrame, id_col: str = "sample_id", ids: str = "input_ids", source: str = "source", lang: str = "lang", domain: str = "domain") -> DataFrame:
    """(rec_id, source, lang, domain, n_tokens) of records that are already encoded.

    Null and empty lists count 0.  A record delivered several times counts once, in its longest form; rows with a
    null id cannot be told to be one record and all count.
    """
    rows = df.select(F.col(id_col).alias("rec_id"), *_slices(source, lang, domain), F.coalesce(F.greatest(F.size(ids), F.lit(0)), F.lit(0)).cast("bigint").alias("n_tokens"))
    best = F.max(F.struct("n_tokens", "source", "lang", "domain")).alias("r")
    apart = F.when(F.col("rec_id").isNull(), F.monotonically_increasing_id()).alias("apart")
    return rows.groupBy("rec_id", apart).agg(best).select("rec_id", "r.source", "r.lang", "r.domain", "r.n_tokens")


def text_counts(df: DataFrame, id_col: str = "rec_id", text: str = "value", source: str = "dataset", lang: str = "lang", domain: str = "domain", model: str | None = None) -> DataFrame:
    """(rec_id, source, lang, domain, n_tokens) of records still in text; one row per row of ``df``, no shuffle."""
    return df.select(F.col(id_col).alias("rec_id"), *_slices(source, lang, domain), token_count(F.col(text), model).alias("n_tokens"))


def token_cube(counts: DataFrame) -> DataFrame:
    """Totals over the cube of source, lang and domain; 'ALL' stands for a dimension summed over.

    The rows are first summed to their finest slices (map-side combined), so the cube expands slices, not records.
    """
    fine = counts.groupBy("source", "lang", "domain").agg(F.count(F.lit(1)).alias("n_records"), F.sum("n_tokens").alias("n_tokens"))
    named = [F.when(F.grouping(c) == 1, F.lit("ALL")).otherwise(F.col(c)).alias(f"{c}_") for c in ("source", "lang", "domain")]
    cube = fine.cube("source", "lang", "domain").agg(*named, F.sum("n_records").alias("n_records"), F.sum("n_tokens").alias("n_tokens"))
    return cube.select(*[F.col(f"{c}_").alias(c) for c in ("source", "lang", "domain")], "n_records", "n_tokens")
