"""The jobs end to end, from manifests of every adapter to checked shards."""

import io
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardweave.functions import codecs, tokenizers, y4m
from shardweave.operators import order, quality
from shardweave.plans import jobs
from shardweave.plans.samples import Samples
from shardweave.sources import media, openers, shardlists, tarshards
from shardweave.sources.tarshards import read_samples, write_shards

TURNS = [{"from": "user", "value": "<image>what is it"}, {"from": "assistant", "value": "a cat"}]
RECORDS = {
    "video-only": ("captions", [{"video": f"m{i}.bin", "caption": f"c{i}"} for i in range(6)]),
    "video_text_pair": ("captions", [{"video": f"m{i}.bin", "caption": f"c{i}"} for i in range(6)]),
    "video_interleave": ("chats", [{"image": f"m{i}.bin", "conversations": TURNS} for i in range(6)]),
    "video_sft": ("questions", [{"video": f"m{i}.bin", "QA": [{"q": "who?", "a": "me"}, {"q": "why?"}]} for i in range(6)]),
    "image": ("chats", [{"image": f"m{i}.bin", "conversations": TURNS} for i in range(6)]),
    "unicontrol": ("control", [{"source": f"m{i}.bin", "prompt": "p", "control_edge": f"m{i + 1}.bin"} for i in range(6)]),
    "merlin-un": ("multi", [{"images": [f"m{i}.bin"], "conversations": TURNS} for i in range(6)]),
    "merlin-s": ("interleaved", [{"image_info": [f"m{i}.bin", f"m{i + 1}.bin"], "text_list": "<image>#1.5#a dog<image>#2.0-3.0#a cat Summary: both"} for i in range(6)]),
    "un": ("interleaved", [{"image_info": [f"m{i}.bin", f"m{i + 1}.bin"], "text_list": f"c{i}"} for i in range(6)]),
}
LINES = {"control"}
#: Field names of a sample with media.
FIELDS = {"unicontrol": {"json", "0.jpg", "1.jpg"}, "merlin-s": {"json", "0.jpg", "1.jpg"}, "un": {"json", "0.jpg", "1.jpg"}, "merlin-un": {"json", "0.jpg"}, "image": {"json", "jpg"}}


@pytest.fixture
def files(tmp_path):
    folder = tmp_path / "media"
    folder.mkdir()
    for i in range(7):
        (folder / f"m{i}.bin").write_bytes(f"bytes {i}".encode())
    return folder


def manifest(tmp_path, kind):
    adapter, rows = RECORDS[kind]
    path = tmp_path / f"{kind}.json"
    path.write_text("\n".join(map(json.dumps, rows)) if adapter in LINES else json.dumps(rows))
    return adapter, str(path)


@pytest.mark.parametrize("kind", sorted(RECORDS))
def test_pack_every_kind(spark, tmp_path, files, kind):
    adapter, path = manifest(tmp_path, kind)
    jobs.main(["pack", path, f"{tmp_path}/out", "--dataset", adapter, "--type", kind, "--prefix", str(files), "--per-tar", "4", "--media", "--on-error", "fail"])
    assert sorted(os.listdir(tmp_path / "out")) == ["shard-0-0-6-0.tar", "shard-0-0-6-1.tar"]
    got = jobs.samples_of(spark, f"{tmp_path}/out").collect()
    assert len(got) == 6 and {frozenset(r.fields) for r in got} == {frozenset(FIELDS.get(kind, {"json", "mp4"}))}
    assert all(bytes(v).startswith(b"bytes ") for r in got for k, v in r.fields.items() if k != "json")
    data = [json.loads(bytes(r.fields["json"])) for r in got]
    keys = {"video-only": {"caption", "video_id"}, "image": {"conversations", "image"}, "unicontrol": {"source", "target", "prompt"}, "merlin-un": {"prompt", "txt", "info", "image_name_list"}}
    keys |= dict.fromkeys(("merlin-s",), {"conversations", "image_name_list"}) | dict.fromkeys(("un",), {"prompt", "txt", "image_name_list"})
    assert all(set(d) == keys.get(kind, {"conversations", "videos"}) for d in data)
    if "image_name_list" in data[0]:
        assert all(d["image_name_list"] == [f"{r.key}-{i}" for i in range(len(r.fields) - 1)] for d, r in zip(data, got, strict=True))


def test_pack_key_frames(spark, tmp_path, files):
    frames = [(i, "I" if i % 10 == 0 else "P") for i in range(40)]
    df = spark.createDataFrame([(i, [f"{files}/m{i}.bin"] * 24, "c", frames) for i in range(3)], "i int, images array<string>, value string, frames array<struct<idx:int,kind:string>>")
    write_shards(jobs.pack(order.pos_overall(df, "i"), jobs.PackJob("kf", media=True)), f"{tmp_path}/out", "pos")
    got = jobs.samples_of(spark, f"{tmp_path}/out").first()
    told = json.loads(bytes(got.fields["json"]))
    assert len(got.fields) == 25 and told["prompt"][0].startswith("<Iimage>#0<Pimage>#") and told["prompt"][0].count("image>") == 24
    job = jobs.TokenizeJob("kf", capacity=7000, keep_tail=True)
    tokens = jobs.tokenize_samples(jobs.samples_of(spark, f"{tmp_path}/out"), job, tokenizers.WordTokenizer())
    assert tokens.count() == 3 and tokens.select(F.size(F.filter("input_ids", lambda x: x == tokenizers.IM_PATCH))).first()[0] == 24 * 256
    assert jobs.tokenize_samples(jobs.samples_of(spark, f"{tmp_path}/out"), jobs.TokenizeJob("un"), tokenizers.WordTokenizer()).count() == 0  # other tags count there


def test_pack_tells_what_is_missing(spark, files):
    df = spark.createDataFrame([(0, "v", "c")], "__pos__ bigint, video_path string, value string")
    for kind in ("unicontrol", "video_sft", "kf"):
        with pytest.raises(ValueError, match=kind):
            jobs.pack(df, jobs.PackJob(kind), 1)
    with pytest.raises(ValueError, match="none of"):
        jobs.pack(df, jobs.PackJob("other"), 1)
    gone = jobs.pack(df, jobs.PackJob("video-only", media=True, on_error="skip"), 1)
    assert gone.count() == 0
    with pytest.raises(Exception, match="FileNotFound"):
        jobs.pack(df, jobs.PackJob("video-only", media=True, on_error="fail"), 1).collect()
    assert jobs.pack(df.limit(0), jobs.PackJob("video-only"), 0).count() == 0


def test_several_videos_get_numbered_members(spark, tmp_path, files):
    df = spark.createDataFrame([(0, [f"{files}/m1.bin", f"{files}/m2.bin"], "c")], "__pos__ bigint, video_path array<string>, value string")
    write_shards(jobs.pack(df, jobs.PackJob("video_text_pair", media=True), 1), f"{tmp_path}/out", "pos")
    assert set(read_samples(spark, f"{tmp_path}/out").first().fields) == {"json", "0.mp4", "1.mp4"}


@pytest.mark.parametrize("tokenizer", ["word", "control"])
def test_chain_of_jobs(spark, tmp_path, files, tokenizer):
    if tokenizer != "word":
        tokenizer = "control:" + pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    adapter, path = manifest(tmp_path, "merlin-un")
    (tmp_path / "jobs.yaml").write_text(json.dumps([
        {"job": "pack", "manifest": path, "out": f"{tmp_path}/a", "dataset": adapter, "type": "merlin-un", "prefix": str(files), "per_tar": 2, "media": True},
        {"job": "tokenize", "shards": f"{tmp_path}/a", "out": f"{tmp_path}/b", "tokenizer": tokenizer, "shard_size": 2, "capacity": 600, "keep_tail": True},
        {"job": "check", "shards": f"{tmp_path}/b", "index": f"{tmp_path}/index", "review": f"{tmp_path}/review", "tokenizer": tokenizer},
    ]))
    jobs.main(["run", f"{tmp_path}/jobs.yaml"])
    packed = jobs.samples_of(spark, f"{tmp_path}/b").collect()
    assert quality.index_totals(spark.read.parquet(f"{tmp_path}/index")).first().asDict() == {"n_shards": 2, "n_samples": len(packed)}
    seen = []
    for r in packed:
        told = json.loads(bytes(r.fields["json"]))
        n = len(told["text"])
        assert sum(x == tokenizers.IM_PATCH for x in told["input_ids"]) == 256 * n == 256 * sum(k.endswith("jpg") for k in r.fields)
        assert told["image"] == [f"{r.key}-{i}" for i in range(n)] and told["input_ids"].count(1) == 1 and len(told["input_ids"]) == len(told["loss_mask"]) < 600
        seen += [bytes(r.fields[f"{i}.jpg"]) for i in range(n)]
    assert sorted(seen) == [f"bytes {i}".encode() for i in range(6)]
    dropped = jobs.pack_tokens(jobs.tokenize_samples(jobs.samples_of(spark, f"{tmp_path}/a"), jobs.TokenizeJob(shard_size=3, capacity=600), tokenizers.make_tokenizer(tokenizer)), jobs.TokenizeJob(shard_size=3, capacity=600))
    assert sorted((r.bin, r.n_samples, r.closed_by) for r in dropped.collect()) == [(0, 2, "1-0"), (1, 2, "2-0")]  # the last open bin is dropped


def test_resume_and_lists(spark, tmp_path, files):
    adapter, path = manifest(tmp_path, "video-only")
    assert jobs.processed_count(spark, f"{tmp_path}/none.txt") == 0
    (tmp_path / "log.txt").write_text("a\nb\n")
    jobs.main(["pack", path, f"{tmp_path}/out", "--dataset", adapter, "--log", f"{tmp_path}/log.txt"])
    assert sorted(json.loads(bytes(r.fields["json"]))["caption"] for r in jobs.samples_of(spark, f"{tmp_path}/out").collect()) == ["c2", "c3", "c4", "c5"]
    found = [r.path for r in shardlists.find_files(spark, str(tmp_path), "m3.bin").collect()]
    assert len(found) == 1 and found[0].endswith("/media/m3.bin")
    spec = shardlists.source_specs({"datasets": [{"name": "a", "shards": "x-{0..3}.tar", "choose": 2}, {"shards": ["y.tar"], "resample": 5}]})
    assert spec[0] == shardlists.SourceSpec("a", [f"x-{i}.tar" for i in range(4)], 2, -1) and spec[1].resample == 5
    assert jobs.Launch("check", {"shards": "s", "index": "i", "review": None}).arguments() == ["check", "s", "i"]


def test_media_fallbacks(tmp_path, monkeypatch):
    (tmp_path / "videos").mkdir()
    (tmp_path / "videos" / "x.mp4").write_bytes(b"v")
    assert media.fetch(f"{tmp_path}/process_videos/x.mp4") == b"v"
    with pytest.raises(FileNotFoundError):
        media.fetch(f"{tmp_path}/process_videos/y.mp4")
    black = codecs.decode_png(media.fetch("Black background: 4, 3"))
    assert black.shape == (3, 4, 3) and not black.any()
    monkeypatch.setenv("USE_AIS_FOR", "gs:s3")
    assert openers.routed("s3://b/k") == "ais://s3/b/k" and openers.routed("http://h/k") == "http://h/k" and openers.routed("/p") == "/p"
    assert set(openers.COMMANDS) <= set(openers._openers)


def test_tokenizer_protocol():
    assert isinstance(tokenizers.WordTokenizer(), tokenizers.Tokenizer) and isinstance(tokenizers.PieceTokenizer("x"), tokenizers.Tokenizer)
    with pytest.raises(ValueError, match="POLICY"):
        tokenizers.make_tokenizer("other")


def test_named_ids():
    model = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    control, appended, chat = (tokenizers.PieceTokenizer(model, p) for p in ("control", "appended", "chat"))
    assert (control.im_patch_token_id, control.im_start_token_id, control.im_end_token_id, control.dream_token_id) == (32000, 32001, 32002, None)
    assert appended.dream_end_token_id == appended.dream_token_id + 2 and chat.img_end_token_id == chat.bot_token_id + 7 and chat.im_patch_token_id is None


@pytest.mark.parametrize("shape", [(7, 5), (7, 5, 3), (7, 5, 4)])
def test_png(shape):
    a = np.random.default_rng(1).integers(0, 256, shape, dtype=np.uint8)
    assert (codecs.Codecs().decode("x.png", codecs.Codecs().encode("png", a)) == a).all()
    with pytest.raises(ValueError):
        codecs.decode_png(b"no")


def test_bmp():
    a = np.random.default_rng(2).integers(0, 256, (3, 5, 3), dtype=np.uint8)
    rows = b"".join(a[y, :, ::-1].tobytes() + b"\0" for y in (2, 1, 0))
    head = b"BM" + (54 + len(rows)).to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little") + (40).to_bytes(4, "little")
    head += (5).to_bytes(4, "little") + (3).to_bytes(4, "little") + (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + bytes(24)
    assert (codecs.decode_bmp(head + rows) == a).all()


@pytest.mark.parametrize("x", [None, True, 0, -33, 255, -129, 70000, 2**40, -(2**63), 1.5, "a" * 40, "\u00e9" * 300, b"xy", [1, [2]], {"a": {"b": [None]}}, list(range(70000))])
def test_msgpack(x):
    assert codecs.Codecs().decode("mp", codecs.Codecs().encode("mp", x) if not isinstance(x, str | bytes) else codecs.msgpack.dumps(x)) == x


def test_decode_hooks():
    c = codecs.Codecs(pre=[lambda n, b: b.upper() if n == "a.txt" else None], post=[lambda n, b: len(b)], only=["a.txt", "b.txt", "c.what"])
    assert [c.decode(n, b"xy") for n in ("a.txt", "b.txt", "c.what", "d.txt")] == [b"XY", "xy", 2, b"xy"]
    assert io.BytesIO(codecs.Codecs().encode("x.npy", np.arange(3))).read(6) == b"\x93NUMPY"


def test_video_frames(spark, tmp_path):
    clip = [np.full((4, 6), 10 * i, np.uint8) for i in range(9)]
    (tmp_path / "a.y4m").write_bytes(y4m.encode(clip, 3) + b"FRAME\ncut off")
    df = spark.createDataFrame([(1, f"{tmp_path}/a.y4m", [0, 4, 99]), (2, None, None)], "i int, p string, at array<int>")
    assert [tuple(r.v) if r.v else None for r in df.select(media.video_info(F.col("p")).alias("v")).collect()] == [(9, 3.0, 3.0, 7), None]
    got = {r.i: r.clip for r in media.clip_frames(df, "p", "at").collect()}
    assert [int(codecs.decode_png(bytes(got[1][f"{k}.png"]))[0, 0, 0]) for k in range(3)] == [0, 40, 80] and got[2] == {}
    with pytest.raises(ImportError, match="mp4"):
        media.open_video("x.mp4")
    with pytest.raises(ValueError):
        y4m.Y4M(b"no")
    colour = y4m.Y4M(b"YUV4MPEG2 W2 H2 F1:1 C420\nFRAME\n" + bytes([100] * 4 + [128, 128]))
    assert (colour.read(0) == 100).all() and colour.frames == 1


def test_own_kind(spark, monkeypatch):
    monkeypatch.setattr(jobs, "SAMPLES", dict(jobs.SAMPLES))
    jobs.register_kind("pages", jobs.Kind(lambda: F.col("paths"), lambda names: F.struct(F.col("value").alias("page")), "html"))
    df = spark.createDataFrame([(0, "v", "c")], "__pos__ bigint, video_path string, value string")
    assert json.loads(bytes(jobs.pack(df, jobs.PackJob("pages"), 1).first().fields["json"])) == {"page": "c"}


def test_constructor_options(spark, tmp_path, files):
    df = spark.range(12).select(F.format_string("s-%d.tar", F.col("id") % 4).alias("shard"), F.format_string("%03d", "id").alias("key"), F.create_map(F.lit("txt"), F.encode(F.col("id").cast("string"), "UTF-8")).alias("fields"))
    write_shards(df, f"{tmp_path}/s")
    keys = lambda s: [r.key for r in s.df.orderBy(order.POS).collect()]
    one, two = (Samples.from_shards(spark, f"{tmp_path}/s", node=(i, 2)) for i in range(2))
    assert sorted(keys(one) + keys(two)) == [f"{i:03d}" for i in range(12)] and keys(one) == ["000", "004", "008", "002", "006", "010"]
    drawn = Samples.from_shards(spark, f"{tmp_path}/s", resampled=6, epoch=1)
    assert len(keys(drawn)) == 18 and keys(drawn) == keys(Samples.from_shards(spark, f"{tmp_path}/s", resampled=6, epoch=1))
    assert len(keys(Samples.from_shards(spark, f"{tmp_path}/s", repeat=2))) == 24
    assert [len(b["key"]) for b in one.loader(4)] == [4, 2]


def test_folders_of_other_file_systems(tmp_path):
    for name in ("b.tar", "a.tgz", "x/c.tar.gz", ".staging-1/d.tar", "e.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"data")
    base = f"file://{tmp_path}"
    assert tarshards.list_folder(f"{base}/") == [f"{base}/a.tgz", f"{base}/b.tar", f"{base}/x/c.tar.gz"]
    assert openers.arrow_opener(f"{base}/e.txt", "rb").read() == b"data"
    assert {"hdfs", "s3a", "abfs"} <= set(openers._openers)
