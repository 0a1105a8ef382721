"""Streaming plans driven to completion, and relational queries over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import packing
from ..operators.sampling import portable_hash
from ..runtime import hadoop_fs
from ..streaming import events as ev
from ..streaming.packer import stream_bins
from ..streaming.run import arrival_source, ordered_source, run_to_table
from .q_tokens import PACK_SQL, read


def _stream(spark: SparkSession, sf: str, table: str, plan, mode: str = "append") -> DataFrame:
    path = f"{sf}/{table}.parquet"
    fs, where = hadoop_fs(spark, path)
    folder = fs.getFileStatus(where).isDirectory()  # a table is a file or a folder of files
    return run_to_table(spark, path if folder else sf, read(spark, sf, table).schema, plan, mode, glob=None if folder else f"{table}.parquet")


#: Micro-batches of the event stream; every twentieth event arrives a week late.
BATCHES, LATE_DAYS = 6, 7


def _late_stream(spark: SparkSession, sf: str, plan) -> DataFrame:
    """Events in the order they arrive, one file a micro-batch, in append mode: what comes after its window is closed is left out."""
    e = read(spark, sf, "events")
    late = F.when(portable_hash(F.col("event_id")) % 20 == 0, F.expr(f"INTERVAL {LATE_DAYS} DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    source = arrival_source(e.withColumn("arrival", F.col("ts") + late), ["arrival", "event_id"], BATCHES)
    return run_to_table(spark, source, spark.read.parquet(source).schema, plan, "append", 1)


def stream_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    return _late_stream(spark, sf, lambda s: ev.tumbling(s, "1 hour")).select("window_start", "key", "n", F.round("total", 4).alias("total"))


def stream_sliding(spark: SparkSession, sf: str) -> DataFrame:
    return _late_stream(spark, sf, lambda s: ev.sliding(s, "1 hour", "30 minutes")).select("window_start", "key", "n", F.round("total", 4).alias("total"))


def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return _late_stream(spark, sf, lambda s: ev.sessions(s, "30 minutes"))


def stream_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    return _stream(spark, sf, "events", lambda s: ev.first_seen(s, late=None)).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def stream_packer(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "documents").filter("source is not null").select(F.col("source").alias("grp"), F.col("doc_id").alias("pos"), F.coalesce("n_chars", F.lit(0)).alias("n"))
    return run_to_table(spark, ordered_source(rows, "pos"), rows.schema, stream_bins)


def star_revenue(spark: SparkSession, sf: str) -> DataFrame:
    line, orders, cust, nation = (read(spark, sf, t) for t in ("lineitem", "orders", "customer", "nation"))
    money = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    j = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(cust, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.round(money, 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


def semi_anti(spark: SparkSession, sf: str) -> DataFrame:
    cust, orders = read(spark, sf, "customer"), read(spark, sf, "orders")
    has = cust.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("with orders"))
    return has.unionByName(cust.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("without orders")))


def cube_counts(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").cube("lang", "kind").agg(F.grouping_id().cast("bigint").alias("level"), F.count(F.lit(1)).alias("n"))


def latest_per_user(spark: SparkSession, sf: str) -> DataFrame:
    w = W.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    e = read(spark, sf, "events").withColumn("r", F.row_number().over(w)).withColumn("before", F.lead("value").over(w))
    return e.filter("r = 1").select("user_id", "event_id", F.round("before", 6).alias("before"))


def top_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The feature is the report of ten rows."""
    line = read(spark, sf, "lineitem").groupBy("l_partkey").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"))
    return line.orderBy(F.desc("quantity"), "l_partkey").limit(10)


def set_operations(spark: SparkSession, sf: str) -> DataFrame:
    a = read(spark, sf, "documents").select("video_path")
    b = read(spark, sf, "manifest").select("video_path")
    both = a.intersect(b).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("both"))
    return both.unionByName(a.exceptAll(b).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("more here")))


def as_of_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Each order with its customer's order before: an as-of lookup as a window, one shuffle."""
    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return read(spark, sf, "orders").select("o_orderkey", F.lag("o_orderkey").over(w).alias("previous"))


def bins_per_group(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select("source", "doc_id", F.coalesce("n_chars", F.lit(0)).cast("int").alias("n"))
    return packing.pack_groups(d, "source", "doc_id", "n").groupBy("source").agg(F.countDistinct("bin").alias("n_bins"))


_ALL = (stream_tumbling, stream_sliding, stream_sessions, stream_first_seen, stream_packer, star_revenue, semi_anti, cube_counts, latest_per_user, top_parts, set_operations, as_of_orders, bins_per_group)
QUERIES = {f.__name__: f for f in _ALL}
# k: events with the watermark that decides whether they are late, which is that of the batch before (so two batches behind); z: the last watermark.
_ARRIVALS = f"""
WITH a AS (SELECT *, ts + CASE WHEN CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 20 = 0 THEN INTERVAL {LATE_DAYS} DAY ELSE INTERVAL 0 DAY END AS arrival FROM events),
b AS (SELECT *, (row_number() OVER (ORDER BY arrival, event_id) - 1) // (SELECT CAST(ceil(count(*) / {BATCHES}.0) AS BIGINT) FROM events) AS batch FROM a),
c AS (SELECT batch, max(ts) AS top FROM b GROUP BY batch),
m AS (SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 10 MINUTE AS mark FROM c),
k AS (SELECT b.*, m.mark FROM b JOIN m USING (batch)),
z AS (SELECT max(ts) - INTERVAL 10 MINUTE AS last FROM events)
"""
ORACLES = {
    "stream_tumbling": _ARRIVALS
    + """, w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, value, mark FROM k)
      SELECT window_start, event_type AS key, count(*) AS n, round(sum(value), 4) AS total FROM w, z
      WHERE (mark IS NULL OR window_start + INTERVAL 1 HOUR > mark) AND window_start + INTERVAL 1 HOUR <= last GROUP BY 1, 2""",
    "stream_sliding": _ARRIVALS
    + """, w AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) - i * INTERVAL 30 MINUTE AS window_start, event_type, value, mark FROM k, (SELECT unnest(range(0, 2)) AS i))
      SELECT window_start, event_type AS key, count(*) AS n, round(sum(value), 4) AS total FROM w, z
      WHERE (mark IS NULL OR window_start + INTERVAL 1 HOUR > mark) AND window_start + INTERVAL 1 HOUR <= last GROUP BY 1, 2""",
    "stream_sessions": _ARRIVALS
    + """, e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM k WHERE mark IS NULL OR ts + INTERVAL 30 MINUTE > mark),
      s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM e)
      SELECT min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, user_id, count(*) AS n FROM s, z GROUP BY user_id, g, last HAVING max(ts) + INTERVAL 30 MINUTE <= last""",
    "stream_first_seen": "SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY event_type",
    "stream_packer": PACK_SQL
    + """SELECT source AS grp, bin, count(*) AS n_samples, CAST(sum(n) AS BIGINT) AS n_tokens FROM f WHERE n < 8000 AND source IS NOT NULL
      AND bin < (SELECT max(g.bin) FROM f g WHERE g.source = f.source) GROUP BY source, bin""",
    "star_revenue": """
      SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "semi_anti": """
      SELECT count(*) AS n, 'with orders' AS kind FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
      UNION ALL SELECT count(*), 'without orders' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)""",
    "cube_counts": "SELECT lang, kind, CAST(grouping_id(lang, kind) AS BIGINT) AS level, count(*) AS n FROM documents GROUP BY CUBE (lang, kind)",
    "latest_per_user": """
      SELECT user_id, event_id, round(lead(value) OVER w, 6) AS before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) QUALIFY row_number() OVER w = 1""",
    "top_parts": "SELECT l_partkey, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY l_partkey ORDER BY quantity DESC, l_partkey LIMIT 10",
    "set_operations": """
      SELECT count(*) AS n, 'both' AS kind FROM (SELECT video_path FROM documents INTERSECT SELECT video_path FROM manifest)
      UNION ALL SELECT count(*), 'more here' FROM (SELECT video_path FROM documents EXCEPT ALL SELECT video_path FROM manifest)""",
    "as_of_orders": "SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous FROM orders",
    "bins_per_group": PACK_SQL + "SELECT source, count(DISTINCT bin) AS n_bins FROM f WHERE n < 8000 AND bin < (SELECT max(g.bin) FROM f g WHERE g.source IS NOT DISTINCT FROM f.source) GROUP BY source",
}
