"""Shards, samples, fields, order, sampling, paths and frame arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codecs, urls, video
from ..operators import errors, fields, order, quality, sampling, sharding
from ..operators.order import POS
from ..operators.samples import group_members
from ..runtime import scratch_path
from ..sources.tarshards import read_samples, write_shards
from .q_tokens import read


def _big(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def _docs(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    return order.pos_overall(read(spark, sf, "documents").select("doc_id", *more), "doc_id")


D = "WITH d AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents) "


def stride_partition(spark: SparkSession, sf: str) -> DataFrame:
    return order.stride(_docs(spark, sf), 3, 8).select("doc_id", F.col(POS).alias("pos"))


def slice_step(spark: SparkSession, sf: str) -> DataFrame:
    return order.slice_rows(_docs(spark, sf), 10, 900, 7).select("doc_id", F.col(POS).alias("pos"))


def chunk_shard_names(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf)
    c = order.chunks(d, d.count(), 3, 50)
    name = urls.shard_name(F.lit(0), F.col("job"), F.col("job") + 1, F.col("tar"))
    return c.select("doc_id", *_big("job", "tar", "file"), name.alias("shard"), urls.sample_key(F.col("file")).alias("key"))


def token_waves(spark: SparkSession, sf: str) -> DataFrame:
    return order.waves(_docs(spark, sf), 6, 12, 480).groupBy("group_id").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))


def batched_partial(spark: SparkSession, sf: str) -> DataFrame:
    b = order.batched(_docs(spark, sf), 32)
    return b.select("batch", F.size("doc_id").cast("bigint").alias("n"), F.col("doc_id")[0].alias("first_id"), F.element_at("doc_id", -1).alias("last_id"))


def batched_drop_last(spark: SparkSession, sf: str) -> DataFrame:
    b = order.batched(_docs(spark, sf), 33, partial=False)
    return b.select("batch", F.size("doc_id").cast("bigint").alias("n"), F.col("doc_id")[0].alias("first_id"))


def unbatched_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    b = order.batched(_docs(spark, sf, "kind"), 32)
    return order.unbatched(b, ["doc_id", "kind"]).select("batch", F.col("item_pos").cast("bigint").alias("item_pos"), "doc_id", "kind")


def listed_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return order.unlisted(order.listed(_docs(spark, sf, "kind"), 25)).select("batch", F.col("item_pos").cast("bigint").alias("item_pos"), "doc_id", "kind")


def _by_source(spark: SparkSession, sf: str) -> DataFrame:
    return order.pos_within(read(spark, sf, "documents").select("source", "doc_id").filter("source is not null"), ["source"], ["doc_id"])


def round_robin_shortest(spark: SparkSession, sf: str) -> DataFrame:
    return order.round_robin(_by_source(spark, sf), "source").select("source", "doc_id", F.col(POS).alias("round"))


def round_robin_longest(spark: SparkSession, sf: str) -> DataFrame:
    r = order.round_robin(_by_source(spark, sf), "source", longest=True)
    return order.pos_overall(r.drop(POS), "turn", name="rank").select("source", "doc_id", "rank")


def random_mix(spark: SparkSession, sf: str) -> DataFrame:
    m = sampling.random_mix(_by_source(spark, sf), "source", {"streetloop": 3.0, "kitchenlab": 2.0, "fieldcam": 1.0}, seed=5)
    return m.select("source", "doc_id", F.round("turn", 6).alias("turn"))


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return order.pos_overall(read(spark, sf, "eval_items").select("item_id", F.length("text").alias("n")), "item_id")


def repeat_epochs(spark: SparkSession, sf: str) -> DataFrame:
    return order.repeat(_items(spark, sf), 4, 700).select("item_id", F.col(POS).alias("pos"), F.col("epoch").cast("bigint").alias("epoch"))


def with_epoch(spark: SparkSession, sf: str) -> DataFrame:
    return order.with_epoch(_items(spark, sf), 1000).groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))


def repeat_nsamples(spark: SparkSession, sf: str) -> DataFrame:
    items = _items(spark, sf)
    return order.repeat_samples(items, "n", 150_000, 4, items.count()).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("n_chars"))


def rsample_hash(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.rsample(read(spark, sf, "documents"), 0.3, F.col("doc_id"), 7).select("doc_id")


def detshuffle_epoch(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select("doc_id")
    return order.pos_overall(d, sampling.shuffle_order(F.col("doc_id"), 3, 2), "doc_id", name="rank")


def buffer_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.buffer_shuffle(_docs(spark, sf), size=100, seed=4).select("doc_id", F.col("shuffled").cast("bigint").alias("shuffled"))


def resampled_shards(spark: SparkSession, sf: str) -> DataFrame:
    s = order.pos_overall(read(spark, sf, "shard_index").select("url").distinct(), "url")
    return sampling.resampled(s, 250, seed=1, epoch=2).select("draw", "url")


def choose_k(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.choose(read(spark, sf, "documents").select("source", "doc_id"), 5, "doc_id", ["source"], seed=9)


def _hash(*parts: str) -> str:
    return f"CAST('0x' || substr(md5({" || '|' || ".join(parts)}), 1, 8) AS BIGINT)"


def members(spark: SparkSession, sf: str) -> DataFrame:
    """Archive members as the packed samples lie in their shards: a json, then its images."""
    p = read(spark, sf, "packed").select("sample_id", "url", "image_name_list").distinct()
    key = F.format_string("%09d", "sample_id")
    names = F.concat(F.array(F.concat(key, F.lit(".JSON"))), F.transform(F.coalesce("image_name_list", F.array().cast("array<string>")), lambda n, i: F.concat(key, F.lit("-"), i.cast("string"), F.lit(".jpg"))))
    return p.select("url", "sample_id", F.posexplode(names).alias("i", "fname")).select("url", (F.col("sample_id") * 1000 + F.col("i")).alias("seq"), "fname", F.encode("fname", "UTF-8").alias("data"))


def group_by_keys(spark: SparkSession, sf: str) -> DataFrame:
    g = group_members(members(spark, sf))
    return g.select("url", "key", F.size("fields").cast("bigint").alias("n_fields"), F.array_join(F.array_sort(F.map_keys("fields")), ",").alias("names"))


def key_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return quality.key_histogram(group_members(members(spark, sf)), F.map_keys("fields"))


def member_name_split(spark: SparkSession, sf: str) -> DataFrame:
    m, p = read(spark, sf, "manifest"), F.col("video_path")
    return m.select("rec_id", urls.member_base(p).alias("base"), urls.member_ext(p).alias("ext"))


def dup_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(read(spark, sf, "manifest_qa"), "qa_id")


def shard_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.shard_index(read(spark, sf, "packed"))


def index_totals(spark: SparkSession, sf: str) -> DataFrame:
    return quality.index_totals(read(spark, sf, "shard_index"))


def payload_totals(spark: SparkSession, sf: str) -> DataFrame:
    return quality.payload_totals(members(spark, sf))


def select_rows(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").filter((F.col("lang") == "en") & (F.col("n_chars") > 200)).select("doc_id", "n_chars")


def rename_first_of(spark: SparkSession, sf: str) -> DataFrame:
    return fields.rename(read(spark, sf, "documents").select("doc_id", "domain", "kind"), topic="domain;kind")


def to_tuple_nonnull(spark: SparkSession, sf: str) -> DataFrame:
    return fields.to_tuple(read(spark, sf, "documents"), "doc_id domain;lang video_path")


def map_dict(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return fields.map_dict(d, lang=lambda c: F.upper(c), n_chars=lambda c: c * 2)


def _mapped(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents")
    pairs = [x for k, c in (("txt", "text"), ("lang.cls", "lang"), ("meta/Kind.TXT", "kind"), ("__url__", "video_path")) for x in (F.lit(k), F.encode(F.coalesce(F.col(c), F.lit("")), "UTF-8"))]
    return d.select("doc_id", F.create_map(*pairs).alias("fields"))


def extract_keys_glob(spark: SparkSession, sf: str) -> DataFrame:
    e = fields.extract_keys(_mapped(spark, sf), ".lang.*", "*.npy", ignore_missing=True)
    return e.select("doc_id", F.decode("_0", "UTF-8").alias("lang"), F.col("_1").isNull().alias("no_npy"))


def rename_keys_glob(spark: SparkSession, sf: str) -> DataFrame:
    r = fields.rename_keys(_mapped(spark, sf), kind="kind.*", label="*.cls")
    return r.select("doc_id", F.decode(F.col("fields")["kind"], "UTF-8").alias("kind"), F.decode(F.col("fields")["label"], "UTF-8").alias("label"), F.size("fields").cast("bigint").alias("n"))


def to_dict_suffix(spark: SparkSession, sf: str) -> DataFrame:
    r = fields.to_dict(_mapped(spark, sf), "cls;txt", strict=False)
    return r.select("doc_id", F.array_join(F.array_sort(F.map_keys("fields")), ",").alias("names"), F.size(F.filter(F.map_values("fields"), lambda v: v.isNull())).cast("bigint").alias("n_null"))


def associate_targets(spark: SparkSession, sf: str) -> DataFrame:
    s = read(spark, sf, "shard_index").select("url", F.regexp_extract("url", "pack/([^/]+)/", 1).alias("key"), F.lit(0).alias("max_repeats"))
    t = read(spark, sf, "mix_targets").withColumnRenamed("source", "key")
    return fields.associate(s, t).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("target_share").alias("share"), F.max("max_repeats").cast("bigint").alias("reps"))


def skip_errors(spark: SparkSession, sf: str) -> DataFrame:
    d = errors.flag(_docs(spark, sf, "text"), F.col("text").isNull(), "no text")
    return errors.apply_policy(d, "skip").select("doc_id")


def stop_at_error(spark: SparkSession, sf: str) -> DataFrame:
    d = errors.flag(_docs(spark, sf, "text"), F.col("text").isNull(), "no text")
    return errors.apply_policy(d, "stop").select("doc_id")


def decode_json_props(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select("event_id", codecs.json_field(F.encode("props", "UTF-8"), "k bigint")["k"].alias("k"))


def decode_cls_int(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select("doc_id", F.concat(F.lit(" "), F.regexp_extract("text", "([0-9]{1,6})", 1), F.lit("\n")).alias("c"))
    return d.select("doc_id", codecs.int_field(F.encode("c", "UTF-8")).alias("number"))


def url_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    spec = "s3a?://shardpool-a/=https://a.example/;s3://=gs://;/store/=file:/store/"
    return read(spark, sf, "shard_index").select("url", urls.rewrite_url_col(F.col("url"), spec).alias("to")).distinct()


def pipe_cleaner(spark: SparkSession, sf: str) -> DataFrame:
    u = read(spark, sf, "shard_index").select("url").distinct()
    cmd = F.concat(F.lit("pipe:fetch -q "), F.col("url"), F.lit(" -"))
    return u.select("url", urls.pipe_cleaner(cmd).alias("found"), urls.pipe_cleaner(F.col("url")).alias("same"))


def cache_path(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "shard_index").select("url", urls.cache_path(F.col("url"), "/cache").alias("path")).distinct()


def path_last3(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("video_path")
    return read(spark, sf, "manifest").select("rec_id", urls.last_components(p, 3, ".mp4").alias("tail"), urls.join_path(F.lit("/base/"), p).alias("joined"))


def lru_keep(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select("doc_id", F.coalesce("n_chars", F.lit(0)).alias("n"))
    return order.running_keep(order.pos_overall(d, F.col("doc_id").desc()), "n", 100_000).select("doc_id")


def shardwriter_count(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shards_by_count(_docs(spark, sf), 70).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))


def shardwriter_size(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select("source", "doc_id", F.coalesce("n_chars", F.lit(0)).alias("n"))
    s = sharding.shards_by_size(d, "n", "doc_id", 9000, "source", 25)
    return s.groupBy("source", "shard").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("n_chars"))


def _videos(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "part").select("p_partkey", (F.col("p_size") * 37 + 1).alias("frames"), (F.col("p_partkey") % 7 * 5 + 10).cast("double").alias("fps"))


def frame_indices(spark: SparkSession, sf: str) -> DataFrame:
    i = video.frame_indices(F.col("frames"), F.col("fps"))
    return _videos(spark, sf).select("p_partkey", F.array_join(F.transform(i, lambda x: x.cast("string")), ",").alias("indices"))


def bounded_indices(spark: SparkSession, sf: str) -> DataFrame:
    i = video.frame_indices(F.col("frames"), F.col("fps"), 8, F.lit(1.5), F.lit(12.25), 3)
    return _videos(spark, sf).select("p_partkey", F.array_join(F.transform(i, lambda x: x.cast("string")), ",").alias("indices"))


def relative_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    t = video.relative_timestamp(F.col("frames") / 4.0, video.duration(F.col("frames"), F.col("fps")))
    return _videos(spark, sf).select("p_partkey", t.alias("at"))


def uniform_sample(spark: SparkSession, sf: str) -> DataFrame:
    s = video.uniform_sample(F.sequence(F.lit(0), F.col("p_size") - 1), 5)
    return read(spark, sf, "part").select("p_partkey", F.array_join(F.transform(s, lambda x: x.cast("string")), ",").alias("sampled"))


def keyframe_merge(spark: SparkSession, sf: str) -> DataFrame:
    i = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda x: x * (F.col("p_size") % 5 + 1))
    p = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda x: x * 3)
    m = video.merge_key_frames(i, p)
    return read(spark, sf, "part").select("p_partkey", F.array_join(F.transform(m, lambda f: F.concat(f["idx"].cast("string"), f["kind"])), " ").alias("merged"))


def capped_side(spark: SparkSession, sf: str) -> DataFrame:
    w, h = (F.col("p_size") * 40).cast("bigint"), (F.col("p_size") * 25 + 300).cast("bigint")
    return read(spark, sf, "part").select("p_partkey", video.capped_side(w, h).cast("bigint").alias("w"), video.capped_side(h, w).cast("bigint").alias("h"))


def tenbin_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "embeddings").select("vec_id", codecs.tenbin_to_floats(codecs.floats_to_tenbin(F.col("embedding"))).alias("v"))
    return e.select("vec_id", F.size("v").cast("bigint").alias("n"), F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("total"))


def tar_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").filter("text is not null").select(F.format_string("docs-%02d.tar", F.col("doc_id") % 4).alias("shard"), F.format_string("%09d", "doc_id").alias("key"), F.create_map(F.lit("txt"), F.encode("text", "UTF-8")).alias("fields"))
    path = scratch_path(spark, "tars")
    write_shards(d, path)
    back = read_samples(spark, path)
    return back.select(F.col("key").cast("bigint").alias("doc_id"), codecs.text_field(F.col("fields")["txt"]).alias("text"))


_ALL = (
    stride_partition, slice_step, chunk_shard_names, token_waves, batched_partial, batched_drop_last, unbatched_roundtrip, listed_roundtrip, round_robin_shortest,
    round_robin_longest, random_mix, repeat_epochs, with_epoch, repeat_nsamples, rsample_hash, detshuffle_epoch, buffer_shuffle, resampled_shards, choose_k, group_by_keys,
    key_histogram, member_name_split, dup_keys, shard_counts, index_totals, payload_totals, select_rows, rename_first_of, to_tuple_nonnull, map_dict, extract_keys_glob,
    rename_keys_glob, to_dict_suffix, associate_targets, skip_errors, stop_at_error, decode_json_props, decode_cls_int, url_rewrite, pipe_cleaner, cache_path, path_last3,
    lru_keep, shardwriter_count, shardwriter_size, frame_indices, bounded_indices, relative_timestamp, uniform_sample, keyframe_merge, capped_side, tenbin_roundtrip, tar_roundtrip,
)
QUERIES = {f.__name__: f for f in _ALL}

_SOURCES = "WITH s AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS round, count(*) OVER (PARTITION BY source) AS n FROM documents WHERE source IS NOT NULL) "
_ITEMS = "WITH i AS (SELECT item_id, length(text) AS n, row_number() OVER (ORDER BY item_id) - 1 AS pos, count(*) OVER () AS total FROM eval_items) "
_MEMBERS = """WITH p AS (SELECT DISTINCT sample_id, url, image_name_list FROM packed),
m AS (SELECT url, lpad(CAST(sample_id AS VARCHAR), 9, '0') AS key, CAST(1 + coalesce(len(image_name_list), 0) AS BIGINT) AS n_fields,
      array_to_string(list_sort([CAST(x AS VARCHAR) || '.jpg' FOR x IN range(0, coalesce(len(image_name_list), 0))] || ['json']), ',') AS names FROM p) """
_FRAMES = "WITH v AS (SELECT p_partkey, p_size * 37 + 1 AS frames, CAST(p_partkey % 7 * 5 + 10 AS DOUBLE) AS fps FROM part) "
_SIZE = """
WITH RECURSIVE r AS (SELECT source, doc_id, coalesce(n_chars, 0) AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents),
f AS (
  SELECT source, n, k, CAST(0 AS BIGINT) AS shard, CAST(1 AS BIGINT) AS c, CAST(n AS BIGINT) AS used FROM r WHERE k = 1
  UNION ALL
  SELECT r.source, r.n, r.k, f.shard + x.roll, CASE WHEN x.roll = 1 THEN 1 ELSE f.c + 1 END, CASE WHEN x.roll = 1 THEN r.n ELSE f.used + r.n END
  FROM f JOIN r ON r.source IS NOT DISTINCT FROM f.source AND r.k = f.k + 1, LATERAL (SELECT CASE WHEN f.c >= 25 OR f.used >= 9000 THEN 1 ELSE 0 END AS roll) x)
SELECT source, shard, count(*) AS n, CAST(sum(n) AS BIGINT) AS n_chars FROM f GROUP BY source, shard
"""
ORACLES = {
    "stride_partition": D + "SELECT doc_id, pos FROM d WHERE pos % 8 = 3",
    "slice_step": D + "SELECT doc_id, pos FROM d WHERE pos >= 10 AND pos < 900 AND (pos - 10) % 7 = 0",
    "chunk_shard_names": D
    + """, c AS (SELECT doc_id, pos // p AS job, (pos % p) // 50 AS tar, (pos % p) % 50 AS file FROM d, (SELECT CAST(ceil(count(*) / 3.0) AS BIGINT) AS p FROM d))
      SELECT doc_id, job, tar, file, 'shard-0-' || job || '-' || (job + 1) || '-' || tar || '.tar' AS shard, lpad(CAST(file AS VARCHAR), 9, '0') AS key FROM c""",
    "token_waves": D + "SELECT (pos - 12) // 6 AS group_id, count(*) AS n, min(doc_id) AS first_id FROM d WHERE pos >= 12 AND pos < 480 GROUP BY 1",
    "batched_partial": D + "SELECT pos // 32 AS batch, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM d GROUP BY 1",
    "batched_drop_last": D + "SELECT pos // 33 AS batch, count(*) AS n, min(doc_id) AS first_id FROM d GROUP BY 1 HAVING count(*) = 33",
    "unbatched_roundtrip": D + "SELECT pos // 32 AS batch, pos % 32 AS item_pos, doc_id, kind FROM d",
    "listed_roundtrip": D + "SELECT pos // 25 AS batch, pos % 25 AS item_pos, doc_id, kind FROM d",
    "round_robin_shortest": _SOURCES
    + """, e AS (SELECT n AS en, source AS es FROM (SELECT DISTINCT n, source FROM s) ORDER BY n, source LIMIT 1)
      SELECT source, doc_id, round FROM s, e WHERE round < en OR (round = en AND source < es)""",
    "round_robin_longest": _SOURCES + "SELECT source, doc_id, row_number() OVER (ORDER BY round, source) - 1 AS rank FROM s",
    "random_mix": _SOURCES
    + f"""SELECT source, doc_id, round((s.round + {_hash("'5'", "source", "CAST(s.round AS VARCHAR)")} / 4294967296.0) / w, 6) AS turn
      FROM s JOIN (VALUES ('streetloop', 3.0), ('kitchenlab', 2.0), ('fieldcam', 1.0)) v(src, w) ON src = source""",
    "repeat_epochs": _ITEMS + "SELECT item_id, e.epoch * total + pos AS pos, e.epoch FROM i, (SELECT unnest(range(0, 4)) AS epoch) e WHERE e.epoch * total + pos < 700",
    "with_epoch": _ITEMS + "SELECT item_id, count(*) AS n FROM i, (SELECT unnest(range(0, 1000)) AS k) WHERE k % total = pos GROUP BY item_id",
    "repeat_nsamples": _ITEMS
    + """, r AS (SELECT n, sum(n) OVER (ORDER BY e.epoch, pos) - n AS before FROM i, (SELECT unnest(range(0, 4)) AS epoch) e)
      SELECT count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS n_chars FROM r WHERE before < 150000""",
    "rsample_hash": f"SELECT doc_id FROM documents WHERE {_hash("'7'", 'CAST(doc_id AS VARCHAR)')} < CAST(floor(0.3 * 4294967296) AS BIGINT)",
    "detshuffle_epoch": f"SELECT doc_id, row_number() OVER (ORDER BY {_hash("'5'", 'CAST(doc_id AS VARCHAR)')}, doc_id) - 1 AS rank FROM documents",
    "buffer_shuffle": D + f"SELECT doc_id, pos // 100 * 100 + row_number() OVER (PARTITION BY pos // 100 ORDER BY {_hash("'4'", 'CAST(pos AS VARCHAR)')}, pos) - 1 AS shuffled FROM d",
    "resampled_shards": f"""
      WITH u AS (SELECT url, row_number() OVER (ORDER BY url) - 1 AS pos, count(*) OVER () AS total FROM (SELECT DISTINCT url FROM shard_index)),
      g AS (SELECT unnest(range(0, 250)) AS draw)
      SELECT draw, url FROM g JOIN u ON {_hash("'1'", "'2'", 'CAST(draw AS VARCHAR)')} % total = pos""",
    "choose_k": f"SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY {_hash("'9'", "'0'", 'CAST(doc_id AS VARCHAR)')}, doc_id) <= 5",
    "group_by_keys": _MEMBERS + "SELECT * FROM m",
    "key_histogram": _MEMBERS + "SELECT replace(names, ',', ' ') AS keys, count(*) AS n FROM m GROUP BY 1",
    "member_name_split": r"""SELECT rec_id, nullif(regexp_extract(video_path, '^((?:.*/|)[^.]+)[.]([^/]*)$', 1), '') AS base,
      CASE WHEN regexp_extract(video_path, '^((?:.*/|)[^.]+)[.]([^/]*)$', 1) <> '' THEN lower(regexp_extract(video_path, '^((?:.*/|)[^.]+)[.]([^/]*)$', 2)) END AS ext FROM manifest""",
    "dup_keys": "SELECT qa_id, count(*) AS n FROM manifest_qa GROUP BY qa_id HAVING count(*) > 1",
    "shard_counts": "SELECT url, count(*) AS nsamples FROM packed GROUP BY url",
    "index_totals": "SELECT count(*) AS n_shards, CAST(sum(nsamples) AS BIGINT) AS n_samples FROM shard_index",
    "payload_totals": _MEMBERS.rstrip()
    + """, b AS (SELECT unnest([14] || [9 + 1 + length(CAST(x AS VARCHAR)) + 4 FOR x IN range(0, coalesce(len(image_name_list), 0))]) AS k FROM p)
      SELECT count(*) AS n, CAST(sum(k) AS BIGINT) AS n_bytes FROM b""",
    "select_rows": "SELECT doc_id, n_chars FROM documents WHERE lang = 'en' AND n_chars > 200",
    "rename_first_of": "SELECT doc_id, coalesce(domain, kind) AS topic FROM documents",
    "to_tuple_nonnull": "SELECT doc_id AS _0, coalesce(domain, lang) AS _1, video_path AS _2 FROM documents WHERE coalesce(domain, lang) IS NOT NULL AND video_path IS NOT NULL",
    "map_dict": "SELECT doc_id, upper(lang) AS lang, n_chars * 2 AS n_chars FROM documents",
    "extract_keys_glob": "SELECT doc_id, coalesce(lang, '') AS lang, true AS no_npy FROM documents",
    "rename_keys_glob": "SELECT doc_id, coalesce(kind, '') AS kind, coalesce(lang, '') AS label, CAST(2 AS BIGINT) AS n FROM documents",
    "to_dict_suffix": "SELECT doc_id, 'lang.cls,meta/Kind.TXT,txt' AS names, CAST(1 AS BIGINT) AS n_null FROM documents",
    "associate_targets": """
      WITH s AS (SELECT regexp_extract(url, 'pack/([^/]+)/', 1) AS key FROM shard_index)
      SELECT key, count(*) AS n, max(target_share) AS share, CAST(max(coalesce(m.max_repeats, 0)) AS BIGINT) AS reps FROM s LEFT JOIN mix_targets m ON m.source = key GROUP BY key""",
    "skip_errors": "SELECT doc_id FROM documents WHERE text IS NOT NULL",
    "stop_at_error": "SELECT doc_id FROM documents WHERE doc_id < coalesce((SELECT min(doc_id) FROM documents WHERE text IS NULL), 9223372036854775807)",
    "decode_json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "decode_cls_int": "SELECT doc_id, TRY_CAST(regexp_extract(text, '([0-9]{1,6})', 1) AS BIGINT) AS number FROM documents",
    "url_rewrite": r"""SELECT DISTINCT url, CASE WHEN regexp_matches(url, '^s3a?://shardpool-a/') THEN regexp_replace(url, '^s3a?://shardpool-a/', 'https://a.example/')
      WHEN starts_with(url, 's3://') THEN 'gs://' || substr(url, 6) WHEN starts_with(url, '/store/') THEN 'file:' || url ELSE url END AS "to" FROM shard_index""",
    "pipe_cleaner": r"SELECT DISTINCT url, CASE WHEN regexp_matches(url, '^(https?|gs|ais|s3):') THEN url ELSE 'fetch -q ' || url || ' -' END AS found, url AS same FROM shard_index",
    "cache_path": r"""
      WITH p AS (SELECT DISTINCT url, regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?', ''), '[?#;].*$', '') AS path FROM shard_index)
      SELECT url, '/cache/' || regexp_replace(ltrim(regexp_extract(path, '^(.*)/[^/]*$', 1), '/'), '[:/|;]', '_', 'g') || '/' || regexp_extract(path, '([^/]*)$', 1) AS path FROM p""",
    "path_last3": """SELECT rec_id, array_to_string(string_split(video_path, '/')[-3:], '/') || '.mp4' AS tail,
      CASE WHEN starts_with(video_path, '/') THEN video_path ELSE '/base/' || video_path END AS joined FROM manifest""",
    "lru_keep": "SELECT doc_id FROM documents QUALIFY sum(coalesce(n_chars, 0)) OVER (ORDER BY doc_id DESC ROWS UNBOUNDED PRECEDING) <= 100000",
    "shardwriter_count": D + "SELECT pos // 70 AS shard, count(*) AS n, min(doc_id) AS first_id FROM d GROUP BY 1",
    "shardwriter_size": _SIZE,
    "frame_indices": _FRAMES + """SELECT p_partkey, array_to_string([CAST(trunc(frames / 16.0 / 2 + round_even(frames / 16.0 * i, 0)) AS INTEGER) FOR i IN range(0, 16)], ',') AS indices FROM v""",
    "bounded_indices": _FRAMES
    + """, b AS (SELECT p_partkey, greatest(3.0, round_even(1.5 * fps, 0)) AS lo, least(round_even(12.25 * fps, 0), CAST(frames AS DOUBLE)) AS hi FROM v)
      SELECT p_partkey, array_to_string([CAST(trunc(lo + (hi - lo) / 8 / 2 + round_even((hi - lo) / 8 * i, 0)) AS INTEGER) FOR i IN range(0, 8)], ',') AS indices FROM b""",
    "relative_timestamp": _FRAMES + "SELECT p_partkey, round_even((frames / 4.0) / (frames / fps) * 1000, 1) AS at FROM v",
    "uniform_sample": """SELECT p_partkey, array_to_string(CASE WHEN p_size <= 5 THEN range(0, p_size) ELSE [i * ((p_size - 1) // 4) FOR i IN range(0, 5)] END, ',') AS sampled FROM part""",
    "keyframe_merge": """
      WITH f AS (SELECT p_partkey, i * (p_size % 5 + 1) AS idx, 1 AS o, 'I' AS kind FROM part, (SELECT unnest(range(0, 5)) AS i) UNION ALL SELECT p_partkey, i * 3, 0, 'P' FROM part, (SELECT unnest(range(0, 6)) AS i))
      SELECT p_partkey, string_agg(idx || kind, ' ' ORDER BY idx, o) AS merged FROM f GROUP BY p_partkey""",
    "capped_side": """SELECT p_partkey, CAST(CASE WHEN greatest(p_size * 40, p_size * 25 + 300) > 1280 THEN 1280 ELSE p_size * 40 END AS BIGINT) AS w,
      CAST(CASE WHEN greatest(p_size * 40, p_size * 25 + 300) > 1280 THEN 1280 ELSE p_size * 25 + 300 END AS BIGINT) AS h FROM part""",
    "tenbin_roundtrip": "SELECT vec_id, len(embedding) AS n, round(list_sum([CAST(x AS DOUBLE) FOR x IN embedding]), 4) AS total FROM embeddings",
    "tar_roundtrip": "SELECT doc_id, text FROM documents WHERE text IS NOT NULL",
}
