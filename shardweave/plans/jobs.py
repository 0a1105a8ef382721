"""The three jobs end to end: pack (manifest to shards), tokenize (shards to packed sequences), check (index).

``python -m shardweave.plans.jobs pack|tokenize|check|run --help``
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import conversation as conv
from ..functions import video
from ..functions.tokenizers import Tokenizer, conversation_ids, input_ids, loss_mask, make_tokenizer
from ..functions.urls import sample_key, shard_name
from ..operators import order, packing, quality
from ..operators.samples import valid_samples
from ..runtime import hadoop_fs
from ..sources.manifests import load_manifest
from ..sources.media import load_media
from ..sources.tarshards import read_samples, write_shards

PER_TAR = 500
KINDS = ("video_text_pair", "video_interleave", "video_sft", "video-only", "image", "unicontrol", "merlin-un", "merlin-s", "un", "kf")
#: Kind of token expansion of each kind of sample.
EXPANSION = {"kf": "kf", "merlin-s": "merlin-s"}


@dataclass(frozen=True)
class PackJob:
    """``kind``: what a sample is made of; ``jobs``: contiguous parts, each cut into shards of 500.

    ``media``: whether the files are read into the shards; ``on_error``: a file that cannot be read raises or drops its sample.
    """

    kind: str = "video-only"
    machine: int = 0
    machines: int = 1
    jobs: int = 1
    per_tar: int = PER_TAR
    media: bool = False
    on_error: str = "skip"


@dataclass(frozen=True)
class Kind:
    """How a kind of sample is made: its files, and its JSON from (names of its images, columns of the manifest)."""

    files: Callable[[], Column]
    body: Callable[[Column], Column]
    extension: str = "jpg"


def _list(c: str) -> Column:
    return F.coalesce(F.col(c), F.array().cast("array<string>"))


def _one(c: str) -> Column:
    return F.filter(F.array(c), lambda x: x.isNotNull())


_TURNS = lambda: conv.normal_turns(F.col("conversations"))
_VIDEOS = lambda: _list("paths").alias("videos")
SAMPLES: dict[str, Kind] = {
    "video-only": Kind(lambda: _list("paths"), lambda names: F.struct(F.col("value").alias("caption"), F.get("paths", 0).alias("video_id")), "mp4"),
    "video_text_pair": Kind(lambda: _list("paths"), lambda names: F.struct(conv.default_conversation(F.lit(conv.VIDEO), F.col("value")).alias("conversations"), _VIDEOS()), "mp4"),
    "video_interleave": Kind(lambda: _list("paths"), lambda names: F.struct(_TURNS().alias("conversations"), _VIDEOS()), "mp4"),
    "video_sft": Kind(lambda: _list("paths"), lambda names: F.struct(conv.chat_turns(F.col("pairs"), conv.VIDEO, F.size("paths")).alias("conversations"), _VIDEOS()), "mp4"),
    "image": Kind(lambda: _list("paths"), lambda names: F.struct(_TURNS().alias("conversations"), _list("paths").alias("image"))),
    "unicontrol": Kind(lambda: F.filter(F.array("source", "target"), lambda x: x.isNotNull()), lambda names: F.struct("source", "target", F.col("value").alias("prompt"))),
    "merlin-un": Kind(
        lambda: _list("images"),
        lambda names: F.struct(conv.prompts(_TURNS()).alias("prompt"), conv.replies(_TURNS()).alias("txt"), F.struct("images", _TURNS().alias("conversations")).alias("info"), names.alias("image_name_list")),
    ),
    "merlin-s": Kind(lambda: _list("images"), lambda names: F.struct(conv.zip_turns(F.col("asked.questions"), F.col("asked.answers")).alias("conversations"), names.alias("image_name_list"))),
    "un": Kind(lambda: _list("images"), lambda names: F.struct(F.array(conv.image_prompt(F.col("images"))).alias("prompt"), F.array("value").alias("txt"), names.alias("image_name_list"))),
    "kf": Kind(lambda: _list("images"), lambda names: F.struct(F.array(conv.keyframe_prompt(F.col("steps"), F.col("kinds"))).alias("prompt"), F.array("value").alias("txt"), names.alias("image_name_list"))),
}


def register_kind(name: str, kind: Kind, expansion: str = "un") -> None:
    """A kind of sample of your own for the pack job, made from the manifest's columns, ``paths`` and ``images``."""
    SAMPLES[name] = kind
    EXPANSION[name] = expansion


def prepared(manifest: DataFrame, kind: str) -> DataFrame:
    """A manifest of any adapter with the columns that samples of ``kind`` are made of; rows that lack them are an error at once.

    ``video_path`` and ``value`` may be text or lists, as the adapters give them.  Samples of merlin-s whose text
    cannot be cut into questions are dropped; key frames come as ``frames``, ARRAY<STRUCT<idx, kind>>, or as
    ``steps`` and ``kinds`` beside ``images``.
    """
    if kind not in SAMPLES:
        raise ValueError(f"{kind!r} is none of {tuple(SAMPLES)}")
    types = dict(manifest.dtypes)
    out = manifest

    def need(*names: str) -> None:
        if lost := [n for n in names if n not in out.columns]:
            raise ValueError(f"samples of kind {kind} need the columns {lost}; the manifest has {manifest.columns}")

    path, value = types.get("video_path"), types.get("value", "")
    if path:
        out = out.withColumn("paths", _one("video_path") if path == "string" else _list("video_path"))
    if kind not in KINDS:
        return out
    if kind in ("unicontrol",):
        need("source", "target", "value")
        return out
    if kind in ("merlin-un", "merlin-s", "un", "kf"):
        if "images" not in out.columns and "paths" in out.columns:
            out = out.withColumn("images", F.col("paths"))
        need("images")
    else:
        need("paths")
    if kind in ("video_interleave", "image", "merlin-un") and "conversations" not in out.columns:
        if value.startswith("array<struct"):
            out = out.withColumn("conversations", F.col("value"))
        elif value == "string":
            out = out.withColumn("conversations", conv.default_conversation(F.lit(conv.IMAGE if kind != "video_interleave" else conv.VIDEO), F.col("value")))
        need("conversations")
    if kind == "video_sft":
        if not value.startswith("array<map"):
            raise ValueError(f"samples of kind {kind} need question-answer maps in value, not {value or 'nothing'}")
        out = out.withColumn("pairs", F.col("value"))
    if kind in ("video-only", "video_text_pair", "un", "kf", "merlin-s") and value != "string":
        raise ValueError(f"samples of kind {kind} need a text in value, not {value or 'nothing'}")
    if kind == "merlin-s":
        out = out.withColumn("asked", conv.frame_questions(F.col("value"))).filter("asked is not null")
    if kind == "kf" and "frames" in out.columns:
        merged = video.key_frames(F.col("frames"))
        out = out.withColumn("__kf__", video.merge_key_frames(merged["i_frames"], merged["p_frames"]))
        steps = F.transform("__kf__", lambda f: video.time_scale_indices(f["idx"], F.size("frames")))
        out = out.withColumns({"steps": steps, "kinds": F.transform("__kf__", lambda f: f["kind"])}).drop("__kf__")
    if kind == "kf":
        need("steps", "kinds")
    return out


def pack(manifest: DataFrame, job: PackJob, total: int | None = None, media: Column | None = None) -> DataFrame:
    """(shard, pos, key, fields) of one machine's share; ``manifest`` carries ``__pos__``; ``media`` is a map of further fields.

    Files of a sample are read in the task that writes it (``job.media``); one file is the field EXT, several are
    ``0.EXT``, ``1.EXT`` ..., and images are always numbered.
    """
    rows = prepared(manifest, job.kind)
    kind = SAMPLES[job.kind]
    total = manifest.count() if total is None else total
    mine = order.stride(rows, job.machine, job.machines).withColumn(order.POS, F.floor(F.col(order.POS) / job.machines).cast("bigint"))
    n = len(range(job.machine, total, job.machines))
    placed = order.chunks(mine, n, job.jobs, job.per_tar)
    per_job = max(1, -(-n // job.jobs))
    start = F.col("job") * per_job
    name = shard_name(F.lit(job.machine), start, F.least(start + per_job, F.lit(n)), F.col("tar"))
    key = sample_key(F.col("file"))
    files = kind.files()
    names = F.transform(files, lambda _, i: F.concat(key, F.lit("-"), i.cast("string")))
    body = F.encode(F.to_json(kind.body(names)), "UTF-8")
    numbered = F.lit(True) if job.kind in ("unicontrol", "merlin-un", "merlin-s", "un", "kf") else F.size("__files__") > 1
    out = placed.select(name.alias("shard"), F.col(order.POS).alias("pos"), key.alias("key"), F.create_map(F.lit("json"), body).alias("fields"), files.alias("__files__"), *([] if media is None else [media.alias("__more__")]))
    if media is not None:
        out = out.withColumn("fields", F.map_concat("fields", "__more__")).drop("__more__")
    if job.media:
        field_names = F.transform("__files__", lambda _, i: F.when(numbered, F.concat(i.cast("string"), F.lit(f".{kind.extension}"))).otherwise(kind.extension))
        out = load_media(out, F.col("__files__"), field_names, job.on_error).withColumn("fields", F.map_concat("fields", "media")).drop("media")
    return out.drop("__files__")


@dataclass(frozen=True)
class TokenizeJob:
    """``kind``: whose media tags count (un, kf, merlin-s); shards [start, end) of the listing, ``shard_size`` to a group."""

    kind: str = "un"
    shard_size: int = 5
    start: int = 0
    end: int | None = None
    capacity: int = packing.CAPACITY
    keep_tail: bool = False


TOKEN_JSON = "prompt array<string>, txt array<string>, conversations array<struct<`from`:string,value:string>>, image_name_list array<string>"


def _sample_images(fields: Column) -> Column:
    """Images of a sample in the order of their numbers."""
    numbered = F.filter(F.map_entries(fields), lambda e: e["key"].rlike(r"^\d+\.(jpe?g|png)$"))
    rows = F.array_sort(F.transform(numbered, lambda e: F.struct(F.split(e["key"], r"\.")[0].cast("int").alias("i"), e["value"].alias("data"))))
    return F.transform(rows, lambda r: r["data"])


def tokenize_samples(samples: DataFrame, job: TokenizeJob, tokenizer: Tokenizer) -> DataFrame:
    """(group_id, tar_pos, key, seq, n, input_ids, loss_mask, text, images): samples whose image tags match their images.

    ``samples``: (url, key, seq, fields).  Shards are taken in name order, ``shard_size`` to a group.  A sample
    whose tags are more or fewer than its images, or without turns, is left out and changes no bin.
    """
    shards = order.waves(order.pos_overall(samples.select("url").distinct(), "url"), job.shard_size, job.start, job.end)
    got = samples.join(shards.select("url", F.col(order.POS).alias("tar_pos"), "group_id"), "url")
    data = F.from_json(F.decode(F.try_element_at("fields", F.lit("json")), "UTF-8"), TOKEN_JSON)
    rows = got.select("group_id", "tar_pos", "key", "seq", data.alias("j"), _sample_images(F.col("fields")).alias("images"))
    turns = F.coalesce(F.col("j.conversations"), conv.zip_turns(F.col("j.prompt"), F.col("j.txt")))
    rows = rows.select("group_id", "tar_pos", "key", "seq", "images", conv.normal_turns(turns).alias("turns"), "j.image_name_list").filter(F.size("turns") > 0)
    rows = rows.filter(conv.human_image_tags(F.col("turns"), job.kind) == F.greatest(F.size("image_name_list"), F.lit(0)))
    rows = rows.withColumn("turns", conv.expand_turns(F.col("turns"), job.kind))
    rows = rows.withColumn("parts", conversation_ids(F.col("turns"), tokenizer))
    rows = rows.withColumns({"input_ids": input_ids(F.col("parts")), "loss_mask": loss_mask(F.col("parts")), "text": conv.render(F.col("turns"))})
    return rows.select("group_id", "tar_pos", "key", "seq", F.size("input_ids").alias("n"), "input_ids", "loss_mask", "text", "images")


def pack_tokens(tokenized: DataFrame, job: TokenizeJob) -> DataFrame:
    """(group_id, bin, n_samples, input_ids, loss_mask, text, closed_by, images): next-fit per group, later opening ids left out.

    One shuffle by group; each bin is joined where it is folded.
    """
    named = tokenized.withColumn("key", F.format_string("%d-%s", "tar_pos", F.regexp_replace("key", "^0+(?=.)", "")))
    return packing.merge_groups(named, "group_id", ["tar_pos", "seq"], "key", job.capacity, job.keep_tail)


def token_shards(packed: DataFrame) -> DataFrame:
    """(shard, pos, key, fields) of packed sequences, one shard per group; a sequence is named after the sample that closed it."""
    key = F.coalesce("closed_by", F.format_string("%d-tail", "group_id"))
    names = F.transform("images", lambda _, i: F.concat(key, F.lit("-"), i.cast("string")))
    body = F.to_json(F.struct("input_ids", "loss_mask", "text", names.alias("image")))
    images = F.map_from_entries(F.transform("images", lambda x, i: F.struct(F.concat(i.cast("string"), F.lit(".jpg")).alias("key"), x.alias("value"))))
    fields = F.map_concat(F.create_map(F.lit("json"), F.encode(body, "UTF-8")), images)
    return packed.select(F.format_string("shard-%06d.tar", "group_id").alias("shard"), F.col("bin").alias("pos"), key.alias("key"), fields.alias("fields"))


def check(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(violations, index) of packed shards."""
    rows = packed_rows(samples)
    return quality.pair_violations(rows), quality.shard_index(rows)


def packed_rows(samples: DataFrame) -> DataFrame:
    data = F.from_json(F.decode(F.try_element_at("fields", F.lit("json")), "UTF-8"), "input_ids array<int>, loss_mask array<int>, text array<string>")
    return samples.select("url", "key", data.alias("j")).select("url", "key", "j.*")


def samples_of(spark: SparkSession, path: str) -> DataFrame:
    return valid_samples(read_samples(spark, path))


def processed_count(spark: SparkSession, log: str) -> int:
    """Lines of a log of processed records, 0 if there is none: where a stopped job goes on."""
    fs, path = hadoop_fs(spark, log)
    return spark.read.text(log).count() if fs.exists(path) else 0


@dataclass(frozen=True)
class Launch:
    """One job of a list, e.g. of a YAML file: ``job`` and its command-line options."""

    job: str
    options: dict[str, object] = field(default_factory=dict)

    def arguments(self) -> list[str]:
        """Positional options (manifest, shards, out, index) first, then flags; true is a flag without value, false and None none."""
        places = {"pack": ("manifest", "out"), "tokenize": ("shards", "out"), "check": ("shards", "index")}[self.job]
        flags = [x for k, v in self.options.items() if k not in places and v not in (None, False) for x in ([f"--{k.replace('_', '-')}"] if v is True else [f"--{k.replace('_', '-')}", str(v)])]
        return [self.job, *(str(self.options[p]) for p in places), *flags]


def launch(path: str) -> None:
    """All jobs of a YAML or JSON list, one after the other in one session."""
    import yaml

    with open(path) as f:
        listed = yaml.safe_load(f)
    for entry in listed:
        main(Launch(entry.pop("job"), entry).arguments())


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="prepare a multimodal corpus")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("pack")
    a.add_argument("manifest")
    a.add_argument("out")
    a.add_argument("--dataset", default="captions", help="manifest adapter")
    a.add_argument("--type", default="video-only", choices=KINDS)
    a.add_argument("--prefix", default="", help="put before every path")
    a.add_argument("--machine-id", type=int, default=0)
    a.add_argument("--total-machines", type=int, default=1)
    a.add_argument("--jobs", type=int, default=1)
    a.add_argument("--per-tar", type=int, default=PER_TAR)
    a.add_argument("--media", action="store_true", help="read the files into the shards")
    a.add_argument("--on-error", default="skip", choices=("fail", "skip"))
    a.add_argument("--log", help="records already processed, one a line: as many are left out")
    b = sub.add_parser("tokenize")
    b.add_argument("shards")
    b.add_argument("out")
    b.add_argument("--type", default="un", choices=(*conv.MEDIA_TAGS, "merlin-un"))
    b.add_argument("--tokenizer", default="word", help="word, or appended|control|chat:PATH of a sentence-piece model")
    b.add_argument("--shard-size", type=int, default=5)
    b.add_argument("--start", type=int, default=0)
    b.add_argument("--end", type=int)
    b.add_argument("--capacity", type=int, default=packing.CAPACITY)
    b.add_argument("--keep-tail", action="store_true")
    c = sub.add_parser("check")
    c.add_argument("shards")
    c.add_argument("index")
    c.add_argument("--review", help="folder for about one sample in a hundred, as text")
    c.add_argument("--tokenizer", default="word")
    d = sub.add_parser("run")
    d.add_argument("jobs_file", help="YAML list of jobs")
    return p


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    if args.job == "run":
        return launch(args.jobs_file)
    spark = SparkSession.builder.getOrCreate()
    if args.job == "pack":
        rows = load_manifest(spark, args.dataset, args.manifest, prefix=args.prefix)
        rows = order.pos_overall(rows, *[F.to_json(F.struct(c)) for c in rows.columns])
        if args.log and (skip := processed_count(spark, args.log)):
            rows = rows.filter(F.col(order.POS) >= skip).withColumn(order.POS, F.col(order.POS) - skip)
        job = PackJob(args.type, args.machine_id, args.total_machines, args.jobs, args.per_tar, args.media, args.on_error)
        write_shards(pack(rows, job), args.out, "pos")
    elif args.job == "tokenize":
        job = TokenizeJob("un" if args.type == "merlin-un" else args.type, args.shard_size, args.start, args.end, args.capacity, args.keep_tail)
        tokens = tokenize_samples(samples_of(spark, args.shards), job, make_tokenizer(args.tokenizer))
        write_shards(token_shards(pack_tokens(tokens, job)), args.out, "pos")
    else:
        samples = samples_of(spark, args.shards)
        bad, index = check(samples)
        if args.review:
            quality.review_lines(packed_rows(samples), make_tokenizer(args.tokenizer)).write.mode("overwrite").text(args.review)
        if n := bad.count():
            raise SystemExit(f"{n} samples break a rule")
        index.write.mode("overwrite").parquet(args.index)


if __name__ == "__main__":
    main()
