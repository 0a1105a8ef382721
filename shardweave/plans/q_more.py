"""Shard lists, manifests, codecs, tokenizers, jobs and further relational forms."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cbor, codecs, msgpack, urls, video
from ..functions import conversation as conv
from ..functions.tokenizers import WordTokenizer
from ..operators import fields, order, quality, sampling
from ..operators.order import POS
from ..runtime import scratch_path
from ..sources import manifests, shardlists
from ..sources.tarshards import read_samples, read_shards, register, write_shards
from . import jobs
from .q_samples import D, _docs, _hash
from .q_tokens import TURN_SQL, _turns, read

# ---- shard lists ----------------------------------------------------------------------------------------------------

LIST = "s3://b/{train,val}/c-{000..119}.tar::/m/${ROOT}/x-{0..20..5}.tar"


def shard_expansion(spark: SparkSession, sf: str) -> DataFrame:
    listed = urls.expand_urls(LIST, {"WDS_ROOT": "r{1,2}"})
    return spark.createDataFrame([(i, u) for i, u in enumerate(listed)], "pos bigint, url string")


def shard_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    """Shards in hash order, as a seed gives it."""
    s = read(spark, sf, "shard_index").select("url").distinct()
    return order.pos_overall(s, F.md5(F.concat(F.lit("5|"), F.col("url")).cast("binary")), "url", name="pos").select("pos", "url")


SPEC = {"datasets": [{"name": "a", "shards": "a-{00..92}.tar", "resample": 10}, {"name": "b", "shards": "b-{000..167}.tar", "choose": 20}, {"name": "c", "shards": ["c-{00..33}.tar"]}]}


def multi_source_epoch(spark: SparkSession, sf: str) -> DataFrame:
    listed = shardlists.shard_spec(spark, SPEC, epoch=3, seed=11)
    return listed.select(F.col(POS).alias("pos"), "url")


def mock_rows(spark: SparkSession, sf: str) -> DataFrame:
    return order.non_empty(order.single_node_only(manifests.mock_rows(spark, 1000, txt="x", cls=3))).select(F.col(POS).alias("pos"), "txt", F.col("cls").cast("bigint").alias("cls"))


def file_types(spark: SparkSession, sf: str) -> DataFrame:
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    tar = F.concat(F.encode(F.rpad(F.lit("n"), 257, "x"), "UTF-8"), F.encode(F.lit("ustar"), "UTF-8"), text)
    kind = F.col("doc_id") % 3
    head = F.when(kind == 0, F.concat(F.unhex(F.lit("1F8B08")), text)).when(kind == 1, tar).otherwise(text)
    return read(spark, sf, "documents").select("doc_id", urls.file_type(head).alias("kind"))


def path_fixes(spark: SparkSession, sf: str) -> DataFrame:
    p = F.concat(F.lit("/data//process_videos/"), F.col("video_path"))
    return read(spark, sf, "manifest").select("rec_id", urls.fix_path(p).alias("fixed"))


# ---- containers -----------------------------------------------------------------------------------------------------


def _written(spark: SparkSession, sf: str) -> str:
    """Documents as tar shards in the shared folder: text and language, and a number."""
    d = read(spark, sf, "documents").filter("text is not null")
    pairs = F.create_map(F.lit("txt"), F.encode("text", "UTF-8"), F.lit("cls"), F.encode(F.col("n_chars").cast("string"), "UTF-8"))
    path = scratch_path(spark, "tars")
    write_shards(d.select(F.format_string("docs-%02d.tar", F.col("doc_id") % 8).alias("shard"), F.format_string("%09d", "doc_id").alias("key"), pairs.alias("fields")), path)
    return path


def tar_select_rename(spark: SparkSession, sf: str) -> DataFrame:
    """Only the numbers are read, under another name; payloads of the texts are passed over."""
    m = read_shards(spark, _written(spark, sf), match=r"\.number$", rename="[.]cls$=.number")
    return m.select(F.regexp_extract("fname", r"^0*([0-9]+)\.", 1).cast("bigint").alias("doc_id"), F.regexp_extract("fname", r"\.(.*)$", 1).alias("ext"), codecs.int_field(F.col("data")).alias("number"))


def tar_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The shards of a folder read as a stream until all are in."""
    path, out, mark = _written(spark, sf), scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    register(spark)
    s = spark.readStream.format("tarshards").option("grouped", "true").load(path)
    s.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(once=True).start().awaitTermination()
    back = spark.read.schema(s.schema).parquet(out)
    return back.select(F.col("key").cast("bigint").alias("doc_id"), F.size("fields").cast("bigint").alias("n_fields"))


def log_keys(spark: SparkSession, sf: str) -> DataFrame:
    lines = fields.log_keys(_docs(spark, sf).withColumn("key", F.format_string("%09d", "doc_id")))
    return lines.select(F.regexp_replace("value", r"\t[0-9]+\t", "\t").alias("line"))


# ---- codecs ---------------------------------------------------------------------------------------------------------


def gz_decode(spark: SparkSession, sf: str) -> DataFrame:
    import gzip

    @F.arrow_udf(T.BinaryType())
    def zipped(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else gzip.compress(t.encode()) for t in texts.to_pylist()], pa.binary())

    d = read(spark, sf, "documents").select("doc_id", zipped("text").alias("data"))
    return d.select("doc_id", codecs.text_field(codecs.gunzip(F.col("data"))).alias("text"))


def codec_roundtrips(spark: SparkSession, sf: str) -> DataFrame:
    """Each event's properties through JSON, CBOR and MessagePack, and its number through npy, by the registry."""
    own = codecs.Codecs()

    @F.arrow_udf("k_cbor bigint, k_mp bigint, k_json bigint, k_npy bigint, k_cls bigint")
    def through(props: pa.Array) -> pa.Array:
        out = []
        for p in props.to_pylist():
            x = json.loads(p)
            back = {e: own.decode(f"x.{e}", own.encode(e, x)) for e in ("cbor", "mp", "json")}
            numbers = {e: int(own.decode(e, own.encode(e, x["k"]))) for e in ("npy", "cls")}
            out.append({f"k_{e}": v["k"] for e, v in back.items()} | {f"k_{e}": v for e, v in numbers.items()})
        return pa.array(out, pa.struct([(f"k_{e}", pa.int64()) for e in ("cbor", "mp", "json", "npy", "cls")]))

    return read(spark, sf, "events").select("event_id", through("props").alias("r")).select("event_id", "r.*")


def png_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Each vector's signs as a picture of one row, through PNG and PPM."""

    @F.arrow_udf("bigint")
    def lit(vectors: pa.Array) -> pa.Array:
        import numpy as np

        out = []
        for v in vectors.to_pylist():
            a = np.repeat((np.array(v) > 0).astype(np.uint8)[None, :, None], 3, axis=2)
            b = codecs.decode_png(codecs.encode_png(a)) + codecs.decode_pnm(codecs.encode_pnm(a))
            out.append(int(b.sum()))
        return pa.array(out, pa.int64())

    return read(spark, sf, "embeddings").select("vec_id", lit("embedding").alias("total"))


# ---- manifests ------------------------------------------------------------------------------------------------------


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "eval_items").select(F.col("item_id").alias("i"), F.concat(F.lit("v/"), F.col("bench"), F.lit("/"), F.col("item_id").cast("string")).alias("v"), F.col("text").alias("t"))


def _one_document(df: DataFrame, body) -> str:
    """A manifest is one JSON document; eval_items has a fixed number of rows."""
    path = scratch_path(df.sparkSession, "manifest")
    df.agg(body.alias("value")).coalesce(1).write.text(path)
    return path


def _rows_of(df: DataFrame, name: str, path: str = "video_path", value: str = "value") -> DataFrame:
    return df.select(F.lit(name).alias("adapter"), F.col(path).cast("string").alias("path"), F.col(value).cast("string").alias("value"))


def manifest_adapters(spark: SparkSession, sf: str) -> DataFrame:
    """The items written as each kind of manifest and read back by its adapter."""
    d = _items(spark, sf)
    array = lambda *c: F.to_json(F.collect_list(F.struct(*c)))
    turns = F.array(F.struct(F.lit("human").alias("from"), F.col("t").alias("value")))
    columns = F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct(F.col("i").cast("string"), F.col("v")))).alias("image"), F.map_from_entries(F.collect_list(F.struct(F.col("i").cast("string"), F.col("t")))).alias("value")))
    got = [
        _rows_of(manifests.load_columns(spark, _one_document(d, columns), "/p"), "columns"),
        _rows_of(manifests.load_captions(spark, _one_document(d, array(F.col("v").alias("video"), F.col("t").alias("caption"))), "/p"), "captions"),
        _rows_of(manifests.load_ego(spark, _one_document(d, array(F.col("v").alias("video_path"), F.col("t").alias("caption")))), "ego"),
        _rows_of(manifests.load_clips(spark, _one_document(d, F.to_json(F.array(F.struct(F.collect_list(F.struct(F.concat(F.lit("far/"), "v").alias("clip_path"), F.col("t").alias("caption"))).alias("clips"))))), "/p"), "clips"),
        _rows_of(manifests.load_questions(spark, _one_document(d, array(F.col("v").alias("video"), F.array(F.create_map(F.lit("q"), "t", F.lit("a"), "v")).alias("QA")))).withColumn("value", F.col("value")[0]["q"]), "questions"),
        _rows_of(manifests.load_chats(spark, _one_document(d, array(F.col("v").alias("image"), turns.alias("conversations")))).withColumn("value", F.col("value")[0]["value"]), "chats"),
        _rows_of(manifests.load_interleaved(spark, _one_document(d, array(F.array("v").alias("image_info"), F.col("t").alias("text_list"))), "/p").withColumn("video_path", F.col("video_path")[0]), "interleaved"),
        _rows_of(manifests.load_multi(spark, _one_document(d, array(F.array("v").alias("images"), turns.alias("conversations")))).select(F.col("images")[0].alias("video_path"), F.col("conversations")[0]["value"].alias("value")), "multi"),
    ]
    out = got[0]
    for g in got[1:]:
        out = out.unionByName(g)
    return out


def manifest_lines(spark: SparkSession, sf: str) -> DataFrame:
    """All manifest records as JSON lines, text lines and Parquet, read back by the adapters of those forms."""
    m = read(spark, sf, "manifest").select("rec_id", "video_path", "value")
    path = lambda n: scratch_path(spark, n)
    control, timed, lines, table = path("control"), path("timed"), path("lines"), path("table")
    m.select(F.to_json(F.struct(F.col("rec_id").cast("string").alias("source"), F.lit("p").alias("prompt"), F.coalesce("video_path", F.lit("")).alias("control_edge"))).alias("value")).write.text(control)
    m.select(F.to_json(F.struct(F.col("rec_id").cast("string").alias("YoutubeID"), F.lit("0").alias("Start_timestamp"), F.lit("9").alias("End_timestamp"), F.lit("c").alias("Caption"))).alias("value")).write.text(timed)
    m.select(F.concat(F.lit(" "), F.col("rec_id").cast("string"), F.lit(" "))).toDF("value").write.text(lines)
    m.write.parquet(table)
    got = [
        _rows_of(manifests.load_control(spark, control, "/s", "/t"), "control", "source", "target"),
        _rows_of(manifests.load_timed(spark, timed), "timed"),
        _rows_of(manifests.load_lines(spark, lines).withColumn("value", F.lit(None)), "lines"),
        _rows_of(manifests.load_table(spark, table, ["rec_id", "video_path"]), "table", "rec_id", "video_path"),
    ]
    out = got[0]
    for g in got[1:]:
        out = out.unionByName(g)
    return out.groupBy("adapter").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values"), F.min("path").alias("first"), F.max("path").alias("last"))


# ---- conversations and tokens ---------------------------------------------------------------------------------------


def merlin_qa(spark: SparkSession, sf: str) -> DataFrame:
    """Questions and answers cut from frame-tagged texts: two tagged captions and a summary made of each document."""
    d = read(spark, sf, "documents").filter("text is not null and text not like '%#%' and text not like '%<image>%' and text not like '%Summary:%'")
    text = F.concat(F.lit("<image><image>#1.5#"), F.col("text"), F.lit("<image>#2.0-3.25#"), F.col("kind"), F.lit("Summary:"), F.col("doc_id").cast("string"))
    q = d.select("doc_id", conv.frame_questions(text).alias("r"))
    return q.select("doc_id", F.size("r.questions").cast("bigint").alias("n"), F.array_join("r.questions", "|").alias("questions"), F.col("r.answers")[0].alias("first_answer"), F.element_at("r.answers", -1).alias("summary"))


def prompt_forms(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part")
    images, steps = F.array_repeat(F.lit("i"), F.col("p_size") % 4), F.sequence(F.lit(0), F.col("p_size") % 3)
    kinds = F.transform(steps, lambda s: F.when(s % 2 == 0, "I").otherwise("P"))
    two = conv.default_conversation(F.col("p_name"), F.col("p_brand"))
    zipped = conv.zip_turns(F.array("p_name", "p_type"), F.array("p_brand"))
    return p.select(
        "p_partkey", conv.image_prompt(images).alias("un"), conv.keyframe_prompt(steps, kinds).alias("kf"), F.array_join(F.transform(two, lambda t: F.concat(t["from"], F.lit("="), t["value"])), ";").alias("pair"),
        F.array_join(F.transform(zipped, lambda t: F.concat(t["from"], F.lit("="), t["value"])), ";").alias("zipped"),
    )


def kf_expand_length(spark: SparkSession, sf: str) -> DataFrame:
    """Key-frame tags in token space, and the count of images that they stand for."""
    steps = F.sequence(F.lit(0), F.col("p_size") % 5)
    prompt = conv.keyframe_prompt(steps, F.transform(steps, lambda s: F.when(s % 2 == 0, "I").otherwise("P")))
    turns = F.array(conv.turn("human", prompt), conv.turn("gpt", F.col("p_name")))
    wide = conv.expand_turns(turns, "kf")
    return read(spark, sf, "part").select("p_partkey", conv.human_image_tags(turns, "kf").cast("bigint").alias("n_images"), F.length(wide[0]["value"]).cast("bigint").alias("n_chars"), conv.human_image_tags(wide, "kf").cast("bigint").alias("n_blocks"))


def key_frame_choice(spark: SparkSession, sf: str) -> DataFrame:
    """Chosen intra and predicted frames of made-up clips: every seventh frame is an intra frame."""
    frames = F.transform(F.sequence(F.lit(0), F.col("p_size") * 3), lambda i: F.struct(i.alias("idx"), F.when(i % 7 == 0, "I").otherwise("P").alias("kind")))
    c = video.key_frames(frames)
    text = lambda a: F.array_join(F.transform(a, lambda x: x.cast("string")), ",")
    return read(spark, sf, "part").select("p_partkey", text(c["i_frames"]).alias("i"), text(c["p_frames"]).alias("p"))


def black_background(spark: SparkSession, sf: str) -> DataFrame:
    t = F.concat(F.when(F.col("p_partkey") % 2 == 0, "Black background: ").otherwise("White background: "), F.col("p_size").cast("string"), F.lit(", "), (F.col("p_size") + 7).cast("string"))
    b = video.black_background(t)
    return read(spark, sf, "part").select("p_partkey", b["width"].cast("bigint").alias("w"), b["height"].cast("bigint").alias("h"))


def time_scale(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "part").select("p_partkey", video.time_scale_indices(F.col("p_size") % 9, F.col("p_size")).cast("bigint").alias("at"))


def piece_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of a sentence-piece model with its special tokens, and back (no SQL can tell)."""
    import public_tokenizers

    from ..functions.tokenizers import PieceTokenizer

    t = PieceTokenizer(public_tokenizers.path("piece_bpe_32k.model"))
    d = read(spark, sf, "documents").select("doc_id", "text", t.ids(F.concat(F.lit("<im_start>"), F.coalesce("text", F.lit("")))).alias("ids"))
    return d.select("doc_id", F.size("ids").cast("bigint").alias("n"), F.col("ids")[0].cast("bigint").alias("first_id"), F.length(t.text(F.col("ids"))).cast("bigint").alias("n_back"))


def review_sample(spark: SparkSession, sf: str) -> DataFrame:
    t = read(spark, sf, "tokenized").select("sample_id").distinct()
    return quality.review_sample(t, F.col("sample_id"), 0.1, 3)


# ---- jobs -----------------------------------------------------------------------------------------------------------


def job_pack_sft(spark: SparkSession, sf: str) -> DataFrame:
    """The pack job over question-answer records: shard, key and JSON of every sample."""
    q = read(spark, sf, "manifest_qa").filter("video_path is not null and size(value) > 0").dropDuplicates(["qa_id"]).select("qa_id", "video_path", "value")
    p = jobs.pack(order.pos_overall(q, "qa_id"), jobs.PackJob("video_sft", jobs=3, per_tar=50))
    data = F.from_json(F.decode(F.col("fields")["json"], "UTF-8"), "conversations array<struct<`from`:string,value:string>>, videos array<string>")
    return p.select("shard", "key", "pos", data.alias("j")).select("shard", "key", "pos", F.size("j.conversations").cast("bigint").alias("n_turns"), F.col("j.conversations")[0]["value"].alias("asked"), F.col("j.videos")[0].alias("video"))


#: Capacity and group of the chained job: small, so that every table gives bins.
CHAIN = jobs.TokenizeJob("un", shard_size=2, capacity=3000, keep_tail=True)


def _chain(spark: SparkSession, sf: str) -> DataFrame:
    """Packed samples as shards with images, tokenized, packed, written and read back."""
    p = _turns(spark, sf).filter("turns is not null").select("sample_id", F.coalesce("image_name_list", F.array().cast("array<string>")).alias("images"), F.col("turns").alias("conversations"))
    rows = order.pos_overall(p, "sample_id")
    media = F.map_from_entries(F.transform("images", lambda x, i: F.struct(F.concat(i.cast("string"), F.lit(".jpg")), F.encode(x, "UTF-8"))))
    first, second = scratch_path(spark, "packed"), scratch_path(spark, "tokens")
    write_shards(jobs.pack(rows, jobs.PackJob("merlin-un", per_tar=100), media=media), first, "pos")
    tokens = jobs.tokenize_samples(jobs.samples_of(spark, first), CHAIN, WordTokenizer())
    write_shards(jobs.token_shards(jobs.pack_tokens(tokens, CHAIN)), second, "pos")
    return read_samples(spark, second)


def job_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of the chained jobs: sequences, samples in them, ids, trained ids and images, by the shard's name."""
    got = _chain(spark, sf)
    rows = jobs.packed_rows(got).join(got.select("url", "key", (F.size("fields") - 1).alias("n_images")), ["url", "key"])
    shard = F.regexp_extract("url", r"([^/]*)$", 1).alias("shard")
    big = lambda c, n: F.sum(c).cast("bigint").alias(n)
    return rows.groupBy(shard).agg(
        F.count(F.lit(1)).alias("n_sequences"), big(F.size("text"), "n_samples"), big(F.size("input_ids"), "n_ids"), big(F.aggregate("loss_mask", F.lit(0), lambda a, x: a + x), "n_loss"),
        big("n_images", "n_images"), big(quality.id_count(F.col("input_ids"), 32000), "n_patches"),
    )


def job_chain_violations(spark: SparkSession, sf: str) -> DataFrame:
    """What the check finds in the sequences of the chained jobs: nothing."""
    bad, _ = jobs.check(_chain(spark, sf))
    return bad.select("key", "violation")


# ---- functions of users and relational forms ------------------------------------------------------------------------


def collated_batches(spark: SparkSession, sf: str) -> DataFrame:
    got = order.collated(_docs(spark, sf, "n_chars"), 40, lambda c: {"n": len(c["doc_id"]), "most": max(x or 0 for x in c["n_chars"])}, "n bigint, most bigint")
    return got


def map_tuple(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return fields.map_tuple(d, None, lambda c: F.upper(c), lambda c: c + 1)


def map_rows(spark: SparkSession, sf: str) -> DataFrame:
    """An expression over the whole row; rows that become null go."""
    d = read(spark, sf, "documents").select("doc_id", "lang", "kind")
    return fields.map_rows(d, lambda r: F.when(r["lang"].isNotNull(), F.concat(r["lang"], F.lit("/"), r["kind"])), "tag").select("doc_id", "tag")


def table_function(spark: SparkSession, sf: str) -> DataFrame:
    """A table function of Python joined laterally: one row per run of equal letters in a code."""

    @F.udtf(returnType="letter string, n bigint")
    class Runs:
        def eval(self, text: str):
            import itertools

            for c, g in itertools.groupby(text or ""):
                yield c, sum(1 for _ in g)

    p = read(spark, sf, "part").select("p_partkey", "p_brand")
    return p.lateralJoin(Runs(F.col("p_brand").outer())).groupBy("p_partkey").agg(F.count(F.lit(1)).alias("n_runs"), F.max("n").alias("longest"))


def interval_join(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of a user's events at most ten minutes apart, by buckets of that width instead of all pairs."""
    e = read(spark, sf, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    width = 600_000_000
    a = e.select("user_id", F.col("event_id").alias("a"), F.col("t").alias("ta"), F.floor(F.col("t") / width).alias("bucket"))
    b = e.select("user_id", F.col("event_id").alias("b"), F.col("t").alias("tb"), F.explode(F.array(F.floor(F.col("t") / width), F.floor(F.col("t") / width) - 1)).alias("bucket"))
    near = a.join(b, ["user_id", "bucket"]).filter("ta < tb and tb - ta <= 600000000")
    return near.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_pairs"))


def rollup_counts(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").rollup("source", "kind").agg(F.grouping_id().cast("bigint").alias("level"), F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars"))


def approx_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Approximate counts of distinct values: whether each lies within five in a hundred of the exact one.

    Each exact count has its own aggregate: in one with them, Spark would keep a sketch of every column for each distinct value.
    """
    d, names = read(spark, sf, "lineitem"), ("l_orderkey", "l_partkey", "l_suppkey")
    got = d.agg(*[F.approx_count_distinct(c, 0.01).alias(f"a_{c}") for c in names])
    for c in names:
        got = got.crossJoin(d.agg(F.count_distinct(c).alias(f"e_{c}")))  # one row each
    return got.select(*[(F.abs(F.col(f"a_{c}") - F.col(f"e_{c}")) <= F.col(f"e_{c}") * 0.05).alias(c) for c in names])


_ALL = (
    shard_expansion, shard_shuffle, multi_source_epoch, mock_rows, file_types, path_fixes, tar_select_rename, tar_stream, log_keys, gz_decode, codec_roundtrips, png_roundtrip, manifest_adapters, manifest_lines,
    merlin_qa, prompt_forms, kf_expand_length, key_frame_choice, black_background, time_scale, piece_ids, review_sample, job_pack_sft, job_chain, job_chain_violations, collated_batches, map_tuple, map_rows,
    table_function, interval_join, rollup_counts, approx_distinct,
)
QUERIES = {f.__name__: f for f in _ALL}

_MULTI = f"""
WITH a AS (SELECT i, 'a-' || lpad(CAST({_hash("'11'", "'3'", "'0'", 'CAST(i AS VARCHAR)')} % 93 AS VARCHAR), 2, '0') || '.tar' AS url FROM (SELECT unnest(range(0, 10)) AS i)),
b AS (SELECT url, row_number() OVER (ORDER BY {_hash("'11'", "'3'", "'1'", 'url')}, url) - 1 AS r FROM (SELECT 'b-' || lpad(CAST(i AS VARCHAR), 3, '0') || '.tar' AS url FROM (SELECT unnest(range(0, 168)) AS i))),
c AS (SELECT i, 'c-' || lpad(CAST(i AS VARCHAR), 2, '0') || '.tar' AS url FROM (SELECT unnest(range(0, 34)) AS i)),
u AS (SELECT i AS n, url FROM a UNION ALL SELECT 10 + r, url FROM b WHERE r < 20 UNION ALL SELECT 30 + i, url FROM c)
SELECT row_number() OVER (ORDER BY {_hash("'11'", "'3'", "'order'", 'CAST(n AS VARCHAR)', 'url')}, n, url) - 1 AS pos, url FROM u
"""
_ITEM = "SELECT item_id AS i, 'v/' || bench || '/' || item_id AS v, text AS t FROM eval_items"
_CLIP = "[x FOR x IN range(0, p_size * 3 + 1) IF x % 7 = 0] || [p_size * 3]"
_STEPS = "range(0, p_size % {n} + 1)"
_KF = "array_to_string(['<' || CASE WHEN s % 2 = 0 THEN 'I' ELSE 'P' END || 'image>#' || s FOR s IN range(0, p_size % {n} + 1)], '')"
_WORDS = r"(<unk>|<s>|</s>|<im_patch>|<im_start>|<im_end>|[\p{L}\p{N}]+|[^\s\p{L}\p{N}])"
_CHAIN = (
    "WITH RECURSIVE"
    + TURN_SQL.strip()[4:]
    + f""",
o AS (SELECT sample_id, row_number() OVER (ORDER BY sample_id) - 1 AS pos, coalesce(len(names), 0) AS n_images,
        [turns[i].value FOR i IN range(1, len(turns) + 1) IF i % 2 = 1 AND turns[i].role = 'human'] AS p, [turns[i].value FOR i IN range(1, len(turns) + 1) IF i % 2 = 0 AND turns[i].role = 'gpt'] AS r
      FROM t WHERE turns IS NOT NULL),
z AS (SELECT *, least(len(p), len(r)) AS k, lpad(CAST(pos // 100 AS VARCHAR), 9, '0') AS tar FROM o),
g AS (SELECT sample_id, pos, n_images, tar, [coalesce(x, '') FOR x IN p[1:k]] AS p, [coalesce(x, '') FOR x IN r[1:k]] AS r FROM z WHERE k > 0),
y AS (SELECT *, list_sum([(length(x) - length(replace(x, '<image>', ''))) // 7 FOR x IN p]) AS tags FROM g),
m AS (SELECT sample_id, pos, n_images, tar,
        CAST(1 + list_sum([len(regexp_extract_all(replace(x, '<image>', '<im_start>' || repeat('<im_patch>', 256) || '<im_end>'), '{_WORDS}')) FOR x IN p]) + list_sum([len(regexp_extract_all(x || '</s>', '{_WORDS}')) FOR x IN r]) AS BIGINT) AS n,
        CAST(list_sum([len(regexp_extract_all(x || '</s>', '{_WORDS}')) FOR x IN r]) AS BIGINT) AS n_loss
      FROM y WHERE tags = n_images),
h AS (SELECT DISTINCT pos // 100 AS tar_no FROM o),
w AS (SELECT 'shard-0-0-' || (SELECT count(*) FROM o) || '-' || tar_no || '.tar' AS url, tar_no FROM h),
q AS (SELECT tar_no, row_number() OVER (ORDER BY url) - 1 AS tar_pos FROM w),
s AS (SELECT m.*, q.tar_pos, q.tar_pos // 2 AS grp, row_number() OVER (PARTITION BY q.tar_pos // 2 ORDER BY q.tar_pos, m.pos) AS k FROM m JOIN q ON q.tar_no = m.pos // 100),
f AS (
  SELECT grp, n, n_loss, n_images, k, CAST(0 AS BIGINT) AS bin, CASE WHEN n < 3000 THEN n ELSE 0 END AS used, CASE WHEN n < 3000 THEN 1 ELSE 0 END AS c FROM s WHERE k = 1
  UNION ALL
  SELECT s.grp, s.n, s.n_loss, s.n_images, s.k, f.bin + x.cl, CASE WHEN x.cl = 1 THEN 0 ELSE f.used END + CASE WHEN s.n < 3000 THEN s.n ELSE 0 END, CASE WHEN x.cl = 1 THEN 0 ELSE f.c END + CASE WHEN s.n < 3000 THEN 1 ELSE 0 END
  FROM f JOIN s ON s.grp = f.grp AND s.k = f.k + 1, LATERAL (SELECT CASE WHEN f.used + s.n > 3000 AND f.c > 0 THEN 1 ELSE 0 END AS cl) x),
b AS (SELECT grp, bin, count(*) AS n_samples, sum(n) - (count(*) - 1) AS n_ids, sum(n_loss) AS n_loss, sum(n_images) AS n_images FROM f WHERE n < 3000 GROUP BY grp, bin)
SELECT 'shard-' || lpad(CAST(grp AS VARCHAR), 6, '0') || '.tar' AS shard, count(*) AS n_sequences, CAST(sum(n_samples) AS BIGINT) AS n_samples, CAST(sum(n_ids) AS BIGINT) AS n_ids, CAST(sum(n_loss) AS BIGINT) AS n_loss,
       CAST(sum(n_images) AS BIGINT) AS n_images, CAST(sum(n_images) * 256 AS BIGINT) AS n_patches FROM b GROUP BY grp
"""
)
ORACLES = {
    "shard_expansion": """
      WITH a AS (SELECT s * 120 + i AS pos, 's3://b/' || ['train', 'val'][s + 1] || '/c-' || lpad(CAST(i AS VARCHAR), 3, '0') || '.tar' AS url FROM (SELECT unnest(range(0, 2)) AS s), (SELECT unnest(range(0, 120)) AS i)),
      b AS (SELECT 240 + r * 5 + i AS pos, '/m/r' || (r + 1) || '/x-' || (i * 5) || '.tar' AS url FROM (SELECT unnest(range(0, 2)) AS r), (SELECT unnest(range(0, 5)) AS i))
      SELECT * FROM a UNION ALL SELECT * FROM b""",
    "shard_shuffle": "SELECT row_number() OVER (ORDER BY md5('5|' || url), url) - 1 AS pos, url FROM (SELECT DISTINCT url FROM shard_index)",
    "multi_source_epoch": _MULTI,
    "mock_rows": "SELECT i AS pos, 'x' AS txt, CAST(3 AS BIGINT) AS cls FROM (SELECT unnest(range(0, 1000)) AS i)",
    "file_types": "SELECT doc_id, ['gzip', 'tar', 'other'][doc_id % 3 + 1] AS kind FROM documents",
    "path_fixes": "SELECT rec_id, '/data/videos/' || video_path AS fixed FROM manifest",
    "tar_select_rename": "SELECT doc_id, 'number' AS ext, n_chars AS number FROM documents WHERE text IS NOT NULL",
    "tar_stream": "SELECT doc_id, CAST(2 AS BIGINT) AS n_fields FROM documents WHERE text IS NOT NULL",
    "log_keys": D + "SELECT pos || chr(9) || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS line FROM d",
    "gz_decode": "SELECT doc_id, text FROM documents",
    "codec_roundtrips": "SELECT event_id, " + ", ".join(f"CAST(json_extract(props, '$.k') AS BIGINT) AS k_{e}" for e in ("cbor", "mp", "json", "npy", "cls")) + " FROM events",
    "png_roundtrip": "SELECT vec_id, CAST(len([x FOR x IN embedding IF x > 0]) * 6 AS BIGINT) AS total FROM embeddings",
    "manifest_adapters": f"""
      WITH d AS ({_ITEM}), k AS (SELECT unnest(['columns', 'captions', 'ego', 'clips', 'questions', 'chats', 'interleaved', 'multi']) AS adapter)
      SELECT adapter, CASE WHEN adapter IN ('columns', 'captions', 'interleaved') THEN '/p/' || v WHEN adapter = 'clips' THEN '/p/' || v || '.mp4' ELSE v END AS path, t AS value FROM d, k""",
    "manifest_lines": """
      WITH m AS (SELECT CAST(rec_id AS VARCHAR) AS r, video_path AS v FROM manifest)
      SELECT 'control' AS adapter, count(*) AS n, count(*) AS n_values, min('/s/' || r) AS first, max('/s/' || r) AS last FROM m UNION ALL
      SELECT 'timed', count(*), count(*), min(r || '_0_9.mp4'), max(r || '_0_9.mp4') FROM m UNION ALL
      SELECT 'lines', count(*), CAST(0 AS BIGINT), min(r), max(r) FROM m UNION ALL SELECT 'table', count(*), count(v), min(r), max(r) FROM m""",
    "merlin_qa": """SELECT doc_id, CAST(3 AS BIGINT) AS n, '<image><image>#1.5#|<image>#2.0-3.25#|Summary this video.' AS questions, text AS first_answer, CAST(doc_id AS VARCHAR) AS summary
      FROM documents WHERE text NOT LIKE '%#%' AND text NOT LIKE '%<image>%' AND text NOT LIKE '%Summary:%'""",
    "prompt_forms": f"""SELECT p_partkey, repeat('<image>', p_size % 4) AS un, {_KF.format(n=3)} AS kf, 'human=' || p_name || ';gpt=' || p_brand AS pair, 'human=' || p_name || ';gpt=' || p_brand AS zipped FROM part""",
    "kf_expand_length": """
      WITH k AS (SELECT p_partkey, p_size % 5 + 1 AS n FROM part)
      SELECT p_partkey, CAST(n AS BIGINT) AS n_images, CAST(n * (10 + 256 * 10 + 8 + 1 + 1) AS BIGINT) AS n_chars, CAST(n AS BIGINT) AS n_blocks FROM k""",
    "key_frame_choice": f"""
      WITH c AS (SELECT p_partkey, {_CLIP} AS a, [x FOR x IN range(0, p_size * 3 + 1) IF x % 7 <> 0] AS o FROM part),
      d AS (SELECT p_partkey, CASE WHEN len(a) <= 8 THEN a ELSE [a[i * greatest((len(a) - 1) // 7, 1) + 1] FOR i IN range(0, 8)] END AS i, o[1:greatest(len(o) - 1, 0)] AS o FROM c),
      e AS (SELECT p_partkey, i, o, 24 - len(i) AS room FROM d)
      SELECT p_partkey, array_to_string(i, ',') AS i, array_to_string(CASE WHEN len(o) <= room THEN o ELSE [o[x * greatest((len(o) - 1) // greatest(room - 1, 1), 1) + 1] FOR x IN range(0, room)] END, ',') AS p FROM e""",
    "black_background": "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS BIGINT) END AS w, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size + 7 AS BIGINT) END AS h FROM part",
    "time_scale": "SELECT p_partkey, CASE WHEN p_size > 1 THEN CAST(trunc(CAST(p_size % 9 AS DOUBLE) / (p_size - 1) * 1000) AS BIGINT) ELSE 0 END AS at FROM part",
    "review_sample": f"SELECT DISTINCT sample_id FROM tokenized WHERE {_hash("'3'", 'CAST(sample_id AS VARCHAR)')} < CAST(floor(0.1 * 4294967296) AS BIGINT)",
    "job_pack_sft": """
      WITH q AS (SELECT qa_id, any_value(video_path) AS v, any_value(value) AS value FROM manifest_qa WHERE video_path IS NOT NULL AND len(value) > 0 GROUP BY qa_id),
      o AS (SELECT *, row_number() OVER (ORDER BY qa_id) - 1 AS pos, count(*) OVER () AS n FROM q), c AS (SELECT *, CAST(ceil(n / 3.0) AS BIGINT) AS per FROM o)
      SELECT 'shard-0-' || (pos // per * per) || '-' || least(pos // per * per + per, n) || '-' || (pos % per // 50) || '.tar' AS shard, lpad(CAST(pos % per % 50 AS VARCHAR), 9, '0') AS key, pos,
             CAST(2 * len(value) AS BIGINT) AS n_turns, array_to_string([value[1][k] FOR k IN map_keys(value[1]) IF k <> 'a'], '') || '<video>' AS asked, v AS video FROM c""",
    "job_chain": _CHAIN,
    "job_chain_violations": "SELECT 'key' AS key, 'violation' AS violation WHERE false",
    "collated_batches": D + "SELECT pos // 40 AS batch, count(*) AS n, max(coalesce(n_chars, 0)) AS most FROM d GROUP BY 1",
    "map_tuple": "SELECT doc_id, upper(lang) AS lang, n_chars + 1 AS n_chars FROM documents",
    "map_rows": "SELECT doc_id, lang || '/' || kind AS tag FROM documents WHERE lang || '/' || kind IS NOT NULL",
    "table_function": """
      WITH c AS (SELECT p_partkey, i, p_brand[i] AS x, p_brand[i - 1] AS y FROM part, LATERAL (SELECT unnest(range(1, length(p_brand) + 1)) AS i)),
      r AS (SELECT p_partkey, i, sum(CASE WHEN i = 1 OR x <> y THEN 1 ELSE 0 END) OVER (PARTITION BY p_partkey ORDER BY i) AS run FROM c), n AS (SELECT p_partkey, run, count(*) AS n FROM r GROUP BY ALL)
      SELECT p_partkey, count(*) AS n_runs, max(n) AS longest FROM n GROUP BY p_partkey""",
    "interval_join": "SELECT a.user_id, count(*) AS n_pairs FROM events a JOIN events b ON a.user_id = b.user_id AND a.ts < b.ts AND b.ts - a.ts <= INTERVAL 10 MINUTE GROUP BY a.user_id",
    "rollup_counts": "SELECT source, kind, CAST(grouping_id(source, kind) AS BIGINT) AS level, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY ROLLUP (source, kind)",
    "approx_distinct": "SELECT true AS l_orderkey, true AS l_partkey, true AS l_suppkey",
}
