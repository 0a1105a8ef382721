"""Archive members to samples: adjacent members with one base name form one sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.urls import member_base, member_ext


def visible(name: Column) -> Column:
    """Whether a member is data: not a top-level ``__x__`` and not inside one."""
    return ~name.rlike(r"^__[^/]*__($|/)")


def group_members(members: DataFrame, suffixes: list[str] | None = None, lower: bool = True, on_error: str = "fail", interleave: bool = True) -> DataFrame:
    """(url, run, key, seq, fields) from (url, seq, fname, data).

    Members are grouped while they follow one another with the same base; grouping never crosses a shard.  With
    ``interleave`` a ``P.json`` opens a sample into which the following ``P-i.ext`` fold as ``i.ext``.  Names
    without an extension are left out.  A field that comes twice in a sample raises ('fail') or its later copy
    is dropped ('skip').  One shuffle by url serves both windows and the grouping.
    """
    w = W.partitionBy("url").orderBy("seq")
    m = members.filter(visible(F.col("fname")))
    m = m.withColumns({"base": member_base(F.col("fname")), "ext": member_ext(F.col("fname"), lower)}).filter("base is not null")
    if interleave:
        opened = F.last(F.when(F.col("ext") == "json", F.col("base")), True).over(w)
        m = m.withColumn("opened", opened)
        part = F.when(F.col("opened").isNotNull() & F.col("base").startswith(F.concat("opened", F.lit("-"))), F.substr("base", F.length("opened") + 2))
        m = m.withColumns({"ext": F.when(part.isNotNull(), F.concat(part, F.lit("."), "ext")).otherwise(F.col("ext")), "base": F.when(part.isNotNull(), F.col("opened")).otherwise(F.col("base"))})
    m = m.withColumn("new", F.coalesce((F.col("base") != F.lag("base").over(w)).cast("int"), F.lit(0))).withColumn("run", F.sum("new").over(w))
    if suffixes is not None:
        m = m.filter(F.col("ext").isin(suffixes))
    if on_error == "skip":
        again = F.row_number().over(W.partitionBy("url", "run", "ext").orderBy("seq"))
        m = m.withColumn("again", again).filter("again = 1")
    rows = F.transform(F.array_sort(F.collect_list(F.struct("seq", "ext", "data"))), lambda r: F.struct(r["ext"].alias("key"), r["data"].alias("value")))
    return m.groupBy("url", "run", F.col("base").alias("key")).agg(F.min("seq").alias("seq"), F.map_from_entries(rows).alias("fields"))


def valid_samples(samples: DataFrame, fields: str = "fields") -> DataFrame:
    """Samples with at least one field and no ``__bad__`` one."""
    return samples.filter((F.size(fields) > 0) & ~F.coalesce(F.map_contains_key(fields, F.lit("__bad__")), F.lit(False)))


def pair_images(samples: DataFrame, names: str = "image_name_list", fields: str = "fields") -> DataFrame:
    """``images``: the image of each listed name, found under the name's last dash-separated part."""
    pick = lambda n: F.try_element_at(F.col(fields), F.concat(F.element_at(F.split(n, "-"), -1), F.lit(".jpg")))
    return samples.withColumn("images", F.transform(names, pick))
