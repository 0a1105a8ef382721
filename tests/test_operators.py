"""Order-sensitive operators, fields, samples, shards, jobs and streams against plain Python models."""

import io
import itertools
import os
import tarfile
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardweave.functions import cbor, codecs
from shardweave.operators import compaction, errors, fields, order, packing, quality, samples, sampling, sharding, skew
from shardweave.plans import jobs
from shardweave.plans.samples import Pipeline, Samples, pipeline
from shardweave.runtime import broadcast_checked, conf, scratch_path, shared_dir
from shardweave.sources import manifests, openers, shardlists
from shardweave.sources.cborseq import read_cbor
from shardweave.sources.tarshards import ERROR, fold_members, list_shards, read_samples, read_shards, write_shards


def numbered(spark, n=20, **more):
    return spark.range(n).select(F.col("id").alias("__pos__"), F.col("id").alias("v"), *[F.lit(x).alias(k) for k, x in more.items()])


def values(df, column="v"):
    return [r[column] for r in df.orderBy("__pos__").collect()]


def test_positions_are_dense_and_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = order.pos_overall(df, F.col("k").desc()).collect()
    assert {r.k: r["__pos__"] for r in got} == {k: 999 - k for k in range(1000)}
    assert order.pos_overall(df.limit(0), "k").count() == 0


@pytest.mark.parametrize("args", [(0, 5, 1), (3, None, 4), (2, 17, 5), (30, 40, 1)])
def test_slice(spark, args):
    assert values(order.slice_rows(numbered(spark), *args)) == list(itertools.islice(range(20), *args))


def test_batches(spark):
    b = order.batched(numbered(spark, 23), 5)
    assert [r.v for r in b.orderBy("batch").collect()] == [list(range(i, min(i + 5, 23))) for i in range(0, 23, 5)]
    assert order.batched(numbered(spark, 23), 5, partial=False).count() == 4
    assert sorted(r.v for r in order.unbatched(b, ["v"]).collect()) == list(range(23))
    assert sorted(r.v for r in order.unlisted(order.listed(numbered(spark, 7), 3)).collect()) == list(range(7))
    assert order.batched(numbered(spark, 0), 5).count() == 0


def test_repetition(spark):
    assert values(order.repeat(numbered(spark, 3), 7)) == [0, 1, 2] * 7
    assert values(order.repeat(numbered(spark, 3), 9, 10)) == ([0, 1, 2] * 4)[:10]
    assert values(order.with_epoch(numbered(spark, 3), 8)) == ([0, 1, 2] * 3)[:8]
    assert order.with_epoch(numbered(spark, 0), 8).count() == 0
    batches = numbered(spark, 3).withColumn("size", F.lit(2))
    assert order.repeat_samples(batches, "size", 10, 9).count() == 5


def test_round_robin(spark):
    rows = [(0, 0, 2), (0, 1, 2), (1, 0, 1), (2, 0, 3), (2, 1, 3), (2, 2, 3)]
    df = spark.createDataFrame(rows, "source int, __pos__ bigint, v int")
    assert [r.v for r in order.round_robin(df, "source", longest=True).orderBy("turn").collect()] == [2, 1, 3, 2, 3, 3]
    assert [r.v for r in order.round_robin(df, "source").orderBy("turn").collect()] == [2, 1, 3, 2]


def test_chunks_and_strides(spark):
    c = order.chunks(numbered(spark, 10), 10, 3, 2).orderBy("v").collect()
    assert [(r.job, r.tar, r.file) for r in c] == [(i // 4, i % 4 // 2, i % 2) for i in range(10)]
    assert values(order.stride(numbered(spark, 10), 1, 3)) == [1, 4, 7]
    with pytest.raises(ValueError):
        order.stride(numbered(spark, 1), 3, 3)
    with pytest.raises(ValueError):
        order.non_empty(numbered(spark, 0))


def test_least_recently_used(spark):
    df = order.pos_overall(numbered(spark, 20).drop("__pos__").withColumn("size", F.lit(4096)), F.col("v").desc())
    kept = order.running_keep(df, "size", 10 * 4096)
    assert sorted(r.v for r in kept.collect()) == list(range(10, 20))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=40), st.booleans())
def test_next_fit_model(sizes, tail):
    bins = packing.next_fit(sizes, 50, tail)
    for b in {x for x in bins if x is not None}:
        assert sum(s for s, x in zip(sizes, bins, strict=True) if x == b) <= 50
    assert all(x is None for s, x in zip(sizes, bins, strict=True) if s >= 50)


def test_pack_groups_equals_the_model(spark):
    rows = [(g, i, (i * 37 + len(g) * 11) % 60) for g in ("a", "bb", "ccc") for i in range(30)] + [("solo", 0, 49), ("big", 0, 60)]
    rows += [(None, i, 20) for i in range(6)]
    df = spark.createDataFrame(rows, "g string, i int, n int")
    for tail in (False, True):
        got = {(r.g, r.i): r.bin for r in packing.pack_groups(df, "g", "i", "n", 50, tail).collect()}
        want = {}
        for g in ("a", "bb", "ccc", "solo", "big", None):
            mine = [r for r in rows if r[0] == g]
            want |= {(g, r[1]): b for r, b in zip(mine, packing.next_fit([r[2] for r in mine], 50, tail), strict=True) if b is not None}
        assert got == want
    with conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch=4):  # bins that reach over batches
        many = {(r.g, r.i): r.bin for r in packing.pack_groups(df, "g", "i", "n", 50, True).collect()}
    assert many == got
    one = spark.createDataFrame([([10, 45, 60, 5, 50],)], "n array<int>").select(packing.fold_bins(F.col("n"), 50).alias("b")).first().b
    assert [None if b < 0 else b for b in one] == packing.next_fit([10, 45, 60, 5, 50], 50, True)
    assert packing.pack_groups(df.limit(0), "g", "i", "n").count() == 0


def test_merged_bin(spark):
    df = spark.createDataFrame([([[1, 5, 6], [1, 7], [1]],)], "ids array<array<int>>")
    assert df.select(packing.merge_bin(F.col("ids")).alias("x")).first().x == [1, 5, 6, 7]


def test_fields(spark):
    df = spark.createDataFrame([(1, "x", None, "k"), (2, None, "y", "k"), (3, None, None, "k")], "a int, b string, c string, d string")
    assert [r.n for r in fields.rename(df.filter("a < 3"), n="b;c;zz").orderBy("a").collect()] == ["x", "y"]
    with pytest.raises(Exception, match="none of"):
        fields.rename(df, n="b;c").collect()
    with pytest.raises(ValueError):
        fields.rename(df, n="zz")
    assert [tuple(r) for r in fields.to_tuple(df, "a b;c").orderBy("_0").collect()] == [(1, "x"), (2, "y")]
    assert fields.to_tuple(df, "a", "zz", missing_is_error=False).count() == 3
    with pytest.raises(ValueError):
        fields.map_dict(df, zz=F.upper)
    assert fields.map_tuple(df, None, F.upper, None).columns == df.columns
    extra = spark.createDataFrame([(1, "new"), (9, "never")], "a int, d string")
    assert {r.a: r.d for r in fields.associate(df, extra, "a").collect()} == {1: "new", 2: "k", 3: "k"}
    assert fields.map_rows(df, lambda r: r["b"]).count() == 1


def test_field_maps(spark):
    df = spark.createDataFrame([(1, {"txt": b"t", "a.cls": b"c", "__k__": b"m"})], "id int, fields map<string,binary>")
    assert bytes(fields.extract_keys(df, "*.cls").first()["_0"]) == b"c"
    with pytest.raises(Exception, match="no field matches"):
        fields.extract_keys(df, "*.png").collect()
    with pytest.raises(Exception, match="several fields"):
        fields.extract_keys(df, "*").collect()
    assert set(fields.rename_keys(df, text="*.tx?;txt", keep_unselected=True, must_match=False).first().fields) == {"txt", "a.cls", "__k__"}
    assert fields.to_dict(df, "txt").count() == 0
    assert fields.to_dict(df, "txt cls").count() == 1
    with pytest.raises(Exception, match="matches"):
        fields.rename_keys(df, x="*.png").collect()


def test_policies(spark):
    df = errors.flag(numbered(spark, 6), F.col("v") == 3, "bad")
    assert values(errors.apply_policy(df, "skip")) == [0, 1, 2, 4, 5]
    assert values(errors.apply_policy(df, "warn_stop")) == [0, 1, 2]
    assert values(errors.apply_policy(errors.flag(numbered(spark, 3), F.lit(False), "x"), "stop")) == [0, 1, 2]
    with pytest.raises(Exception, match="bad"):
        errors.apply_policy(df, "fail").collect()
    with pytest.raises(ValueError):
        errors.apply_policy(df, "other")


def test_sampling(spark):
    df = numbered(spark, 2000)
    n = sampling.rsample(df, 0.5, F.col("v"), 1).count()
    assert 900 < n < 1100 and n == sampling.rsample(df, 0.5, F.col("v"), 1).count()
    assert sampling.rsample(df, 0, F.col("v")).count() == 0 and sampling.rsample(df, 1, F.col("v")).count() == 2000
    a, b = ([r.v for r in sampling.det_shuffle(numbered(spark, 50), "v", 1, e).collect()] for e in (0, 1))
    assert sorted(a) == sorted(b) == list(range(50)) and a != b
    s = sampling.buffer_shuffle(numbered(spark, 100), size=10).collect()
    assert sorted(r.shuffled for r in s) == list(range(100)) and all(r.shuffled // 10 == r.v // 10 for r in s)
    assert sampling.resampled(numbered(spark, 5), 40).count() == 40 and sampling.resampled(numbered(spark, 0), 40).count() == 0
    assert sampling.choose(numbered(spark, 30), 7, "v").count() == 7
    with pytest.raises(ValueError):
        sampling.rsample(df, 2, F.col("v"))


def test_multi_source():
    spec = {"prefix": "p/", "datasets": [{"name": "a", "shards": "a-{000..092}.tar", "resample": 10}, {"shards": ["b-{000..167}.tar"], "choose": 20}, {"shards": "c-{00..33}.tar", "resample": 30}]}
    got = sampling.multi_source(spec)
    assert len(got) == 60 and got == sampling.multi_source(spec) != sampling.multi_source(spec, epoch=1)
    assert len({u for u in got if "b-" in u}) == 20 and all(u.startswith("p/") for u in got)
    for bad in ({"datasets": [], "x": 1}, {"datasets": [{"shards": "a", "choose": 2}]}, {"datasets": [{"shards": "a{1..9}", "choose": 2, "resample": 2}]}, {"datasets": [{"shards": "a", "perepoch": 1}]}):
        with pytest.raises(ValueError):
            sampling.multi_source(bad)


MEMBERS = ["0-1.json", "0-1-0.jpg", "0-1-1.jpg", "0-12.json", "0-12-0.jpg", "__meta__/x.txt", "noext", "x.TXT", "x.cls", "d/y.tar.gz", "x.txt"]


def frame(spark, names, url="u"):
    return spark.createDataFrame([(url, i, n, n.encode()) for i, n in enumerate(names)], "url string, seq int, fname string, data binary")


def test_grouping(spark):
    got = {(r.key, r.seq): set(r.fields) for r in samples.group_members(frame(spark, MEMBERS)).collect()}
    assert got == {("0-1", 0): {"json", "0.jpg", "1.jpg"}, ("0-12", 3): {"json", "0.jpg"}, ("x", 7): {"txt", "cls"}, ("d/y", 9): {"tar.gz"}, ("x", 10): {"txt"}}
    twice = frame(spark, ["a.txt", "a.txt", "a.cls"])
    with pytest.raises(Exception, match=r"(?i)duplicate"):
        samples.group_members(twice).collect()
    assert samples.group_members(twice, on_error="skip").first().fields.keys() == {"txt", "cls"}
    assert samples.group_members(frame(spark, ["a.txt", "a.cls"]), ["cls"]).first().fields.keys() == {"cls"}
    two = frame(spark, ["a.txt"], "u").union(frame(spark, ["a.txt"], "v"))
    assert samples.group_members(two).count() == 2
    assert samples.group_members(two.limit(0)).count() == 0
    assert samples.valid_samples(spark.createDataFrame([({},), ({"__bad__": b"1", "a": b""},), ({"a": b""},)], "fields map<string,binary>")).count() == 1


def tar(path, names, compress=False):
    with tarfile.open(path, "w:gz" if compress else "w") as t:
        for n in names:
            m = tarfile.TarInfo(n)
            m.size = len(n)
            t.addfile(m, io.BytesIO(n.encode()))


def test_tar_source(spark, tmp_path):
    tar(tmp_path / "a.tar", MEMBERS)
    tar(tmp_path / "b.tgz", ["k.txt", "k.cls"], compress=True)
    (tmp_path / "c.tar").write_bytes(b"broken")
    whole = read_shards(spark, str(tmp_path), on_error="skip")
    assert whole.rdd.getNumPartitions() == 3
    assert {r.fname for r in whole.collect()} == {*MEMBERS, "k.txt", "k.cls", ERROR} - {"__meta__/x.txt"}
    assert [(r.url, r.seq) for r in whole.filter(F.col("fname") == ERROR).collect()] == [(f"{tmp_path}/c.tar", -1)]
    assert samples.group_members(whole).filter("key like '%error%'").count() == 0
    assert read_shards(spark, f"{tmp_path}/b.tgz", payload=False, match=r"\.txt$").collect()[0].data is None
    assert read_shards(spark, f"{tmp_path}/a.tar", rename="^0-=zero-").filter("fname like 'zero-%'").count() == 5
    with pytest.raises(Exception, match="c.tar"):
        read_shards(spark, str(tmp_path)).count()
    assert list_shards(f"{tmp_path}/{{a,b}}.x::{tmp_path}/*.tgz") == [f"{tmp_path}/a.x", f"{tmp_path}/b.x", f"{tmp_path}/b.tgz"]


def test_pushdown_opens_only_what_is_asked_for(spark, tmp_path):
    tar(tmp_path / "a.tar", ["x.txt"])
    (tmp_path / "broken.tar").write_bytes(b"not a tar")
    df = read_shards(spark, str(tmp_path), pushdown=True)
    assert [r.fname for r in df.filter(F.col("url") == f"{tmp_path}/a.tar").collect()] == ["x.txt"]
    assert df.filter("url = 'nowhere'").count() == 0


def test_shard_lists(spark, tmp_path):
    urls = "t-{00..19}.tar"
    assert [r.url for r in shardlists.simple_shards(spark, urls).orderBy("__pos__").collect()] == [f"t-{i:02d}.tar" for i in range(20)]
    mixed = [r.url for r in shardlists.simple_shards(spark, urls, 3).orderBy("__pos__").collect()]
    assert sorted(mixed) == [f"t-{i:02d}.tar" for i in range(20)] != mixed
    (tmp_path / "s.yaml").write_text("datasets:\n- shards: t-{00..19}.tar\n  choose: 4\n")
    assert shardlists.shard_spec(spark, f"{tmp_path}/s.yaml").count() == 4
    assert shardlists.make_seed(1, "a") == shardlists.make_seed(1, "a") != shardlists.make_seed(2, "a")
    q = shardlists.resampled_stream(spark, urls, 50).writeStream.format("memory").queryName("draws").start()
    for _ in range(100):
        if spark.table("draws").count() > 20:
            break
        time.sleep(0.2)
    q.stop()
    assert {r.url for r in spark.table("draws").collect()} <= set(mixed)


def test_tar_sink_round_trip(spark, tmp_path):
    rows = [(f"s-{i % 3}.tar{'.gz' if i % 3 == 2 else ''}", f"{i:04d}", {"txt": f"t{i}".encode(), "cls": b"1", "_hidden": b"x"}) for i in range(30)]
    df = spark.createDataFrame(rows, "shard string, key string, fields map<string,binary>").coalesce(1)
    told = []
    done = write_shards(df, str(tmp_path), post=told.append)
    assert sorted(os.listdir(tmp_path)) == ["s-0.tar", "s-1.tar", "s-2.tar.gz"] and done == told == [f"{tmp_path}/{n}" for n in sorted(os.listdir(tmp_path))]
    back = read_samples(spark, str(tmp_path))
    assert "Exchange" not in back._jdf.queryExecution().toString()
    back = back.collect()
    assert {r.key: bytes(r.fields["txt"]) for r in back} == {r[1]: r[2]["txt"] for r in rows} and all(set(r.fields) == {"txt", "cls"} for r in back)


@pytest.mark.parametrize("options", [{}, {"interleave": False}, {"suffixes": ["json", "0.jpg", "txt"]}, {"lower": False}])
def test_reader_folds_like_the_operator(spark, tmp_path, options):
    tar(tmp_path / "a.tar", MEMBERS)
    tar(tmp_path / "b.tar", ["x.JSON", "x-0.Jpg", "noext", "x-1.b/c.jpg", "d/x.json", "d/x-0.jpg", "d/x-1.jpg", "y.txt", "x.txt"])
    plain = lambda df: sorted((r.url, r.run, r.key, r.seq, sorted(r.fields)) for r in df.collect())
    assert plain(read_samples(spark, str(tmp_path), **options)) == plain(samples.group_members(read_shards(spark, str(tmp_path)), **options))


def test_fields_that_come_twice(spark, tmp_path):
    tar(tmp_path / "a.tar", ["a.txt", "a.txt", "a.cls", "b.txt"])
    with pytest.raises(Exception, match="comes twice"):
        read_samples(spark, str(tmp_path)).collect()
    assert [(r.key, sorted(r.fields)) for r in read_samples(spark, str(tmp_path), on_error="skip").collect()] == [("a", ["cls", "txt"]), ("b", ["txt"])]
    (tmp_path / "c.tar").write_bytes(b"broken")
    got = read_samples(spark, str(tmp_path), on_error="skip")
    assert got.filter(F.col("key") == ERROR).count() == 1 and samples.valid_samples(got).count() == 2
    assert list(fold_members([])) == []


def test_sink_refuses_folders_that_are_not_shared(tmp_path):
    from pyspark.sql.types import BinaryType, StringType, StructType

    from shardweave.sources.tarshards import TarWriter

    kind = StructType().add("shard", StringType()).add("fname", StringType()).add("data", BinaryType())
    writer = TarWriter({"path": str(tmp_path)}, kind)
    os.rmdir(writer.staging)  # as on a machine that does not see the driver's folder
    with pytest.raises(RuntimeError, match="not shared"):
        writer.write(iter(()))
    with pytest.raises(ValueError, match="missing"):
        TarWriter({"path": str(tmp_path)}, StructType().add("shard", StringType()))


def test_tar_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    tar(tmp_path / "in" / "a.tar", ["x.txt"])
    read_shards(spark, f"{tmp_path}/in").count()
    q = spark.readStream.format("tarshards").load(f"{tmp_path}/in").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/mark").start()
    q.processAllAvailable()
    tar(tmp_path / "in" / "b.tar", ["y.txt"])
    q.processAllAvailable()
    time.sleep(0.02)
    tar(tmp_path / "in" / "0.tar", ["z.txt"])  # a smaller name than those seen
    q.processAllAvailable()
    q.stop()
    assert sorted(r.fname for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["x.txt", "y.txt", "z.txt"]


def test_cbor_source(spark, tmp_path):
    (tmp_path / "x.cbors").write_bytes(b"".join(map(cbor.dumps, [{"a": 1}, [2, b"\x00"]])))
    assert [(r.seq, r.json) for r in read_cbor(spark, f"{tmp_path}/x.cbors").collect()] == [(0, '{"a": 1}'), (1, '[2, "AA=="]')]


def test_openers(tmp_path):
    path = str(tmp_path / "f.bin")
    with openers.open_url(f"file:{path}", "wb") as f:
        f.write(b"data")
    assert openers.open_url(path).read() == b"data"
    with openers.open_url(f"pipe:cat {path}", allow_pipes=True) as p:
        assert p.read() == b"data"
    with pytest.raises(PermissionError):
        openers.open_url("pipe:true")
    with pytest.raises(OSError), openers.open_url("pipe:exit 3", allow_pipes=True) as p:
        p.read()
    with pytest.raises(ValueError):
        openers.open_url("nope://x")
    with pytest.raises(FileNotFoundError):
        openers.open_url(str(tmp_path / "gone"))
    openers.register_scheme("mem", lambda u, m: open(path, "rb"))
    with pytest.raises(ValueError, match="archive"):
        openers.cached("mem://h/d/x.tar", str(tmp_path / "cache"))
    openers.register_scheme("own", openers.command_opener(read=f"cat {path} # {{url}}"))
    with openers.open_url("own://it's here") as p:
        assert p.read() == b"data"
    with pytest.raises(ValueError, match="own"):
        openers.open_url("own://x", "wb")
    folder = tmp_path / "lru"
    folder.mkdir()
    for i in range(6):
        (folder / f"{i}").write_bytes(b"x" * 100)
    assert len(openers.lru_cleanup(str(folder), 300)) == 3


def test_manifests(spark, tmp_path):
    def write(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    rows = lambda df: [tuple(r) for r in df.collect()]
    assert sorted(rows(manifests.load_columns(spark, write("a.json", '{"image": {"0": "x", "1": "/y"}, "value": {"0": "p", "1": "q"}}'), "/pre"))) == [("/pre/x", "p"), ("/y", "q")]
    assert rows(manifests.load_captions(spark, write("b.json", '[{"video": "v", "caption": "c"}]'), "/pre/")) == [("/pre/v", "c")]
    assert rows(manifests.load_control(spark, write("c.json", '{"source": "s", "prompt": "p", "control_x": "t"}\n'), "/s", "/t")) == [("/s/s", "/t/t", "p")]
    assert rows(manifests.load_clips(spark, write("d.json", '[{"clips": [{"clip_path": "a/b/c/d", "caption": "x"}, {"clip_path": "e", "caption": "y"}]}]'))) == [("b/c/d.mp4", "x"), ("e.mp4", "y")]
    assert rows(manifests.load_timed(spark, write("e.json", '{"YoutubeID": "i", "Start_timestamp": "1", "End_timestamp": "2", "Caption": "c"}'))) == [("i_1_2.mp4", "c")]
    with pytest.raises(ValueError, match="none of"):
        manifests.load_manifest(spark, "unknown", "x")
    assert manifests.get_prefix({"a": "/p"}, "a") == "/p" and manifests.get_prefix({}, "b") == ""
    assert manifests.load_manifest(spark, "questions", write("f.json", '[{"video": "v", "QA": [{"q": "a", "a": "b"}]}]')).first().value == [{"q": "a", "a": "b"}]
    assert manifests.load_chats(spark, write("g.json", '[{"image": "v", "conversations": [{"from": "human", "value": "b"}]}]')).first().value[0]["from"] == "human"
    assert manifests.load_interleaved(spark, write("h.json", '[{"image_info": ["v"], "text_list": "t"}]')).first().video_path == ["v"]
    assert manifests.load_multi(spark, write("i.json", '[{"images": ["v"], "conversations": []}]')).first().images == ["v"]
    assert rows(manifests.load_lines(spark, write("j.txt", " a \nb\n"))) == [("a",), ("b",)]
    assert manifests.mock_rows(spark, 4, txt="x").count() == 4


def test_fluent(spark, tmp_path):
    tar(tmp_path / "a.tar", [f"{i:03d}.{e}" for i in range(12) for e in ("txt", "cls")])
    s = Samples.from_shards(spark, f"{tmp_path}/a.tar")
    assert values(s.slice(0, 12, 4).df, "key") == ["000", "004", "008"]
    assert sorted(values(s.detshuffle(seed=3).df, "key")) == values(s.df, "key") != values(s.detshuffle(seed=3).df, "key")
    assert s.batched(5).df.count() == 3 and len(s.with_length(9)) == 9 and s.repeat(2).df.count() == 24
    assert s.decode("txt", "string").df.filter("txt is null").count() == 0
    assert s.stored().cached().select(F.col("key") < "003").df.count() == 3
    assert len(s.write(f"{tmp_path}/out", 5, first=3)) == 3
    assert sorted(os.listdir(f"{tmp_path}/out")) == ["shard-000003.tar", "shard-000004.tar", "shard-000005.tar"]
    sized = s.write(f"{tmp_path}/sized", 5, max_bytes=30)
    assert len(sized) == 4 and sum(Samples.from_shards(spark, x).df.count() for x in sized) == 12
    typed = s.then(lambda d: d.select("__pos__", "key", F.length("key").alias("n.cls"), F.array(F.lit(1)).alias("a.json"), F.col("key").alias("t.txt"), F.encode("key", "UTF-8").alias("b")).withColumnRenamed("n.cls", "cls").withColumnRenamed("a.json", "json").withColumnRenamed("t.txt", "txt"))
    assert {k: bytes(v) for k, v in typed.encode("cls", "json", "txt", "b").df.filter("key = '004'").first().fields.items()} == {"cls": b"3", "json": b"[1]", "txt": b"004", "b": b"004"}
    total = s.collated(5, lambda c: {"n": len(c["key"]), "keys": c["key"]}, "n int, keys array<string>").df
    assert sorted((r.batch, r.n) for r in total.collect()) == [(0, 5), (1, 5), (2, 2)] and total.orderBy("batch").select(order.guess_batchsize(total)).first()[0] == 5
    two = Pipeline(None, lambda d: d.limit(5)).append([lambda d: d.limit(3)], None).compose(lambda d: d.limit(2))
    assert len(two) == 3 and two(s.df).count() == 2 and two.stage(0)(s.df).count() == 5
    assert s.decode("txt", "string", codecs.Codecs(pre=[lambda n, b: "pre" if n == "txt" else None])).df.first().txt == "pre"
    assert pipeline(numbered(spark), None, [lambda d: d.limit(3), None]).count() == 3
    assert [r.key for r in s] == [f"{i:03d}" for i in range(12)]
    with pytest.raises(TypeError):
        len(s)


def test_fold_and_stream_pack_alike(spark):
    df = spark.createDataFrame([(g, i, None if i % 17 == 3 else (i * 37) % 90 + (60 if i % 29 == 0 else 0)) for g in ("a", "b", None) for i in range(80)], "g string, i int, n int")
    plain = lambda d: sorted(((r.g or "", r.i, r.n, r.bin) for r in d.collect()))
    assert plain(packing.pack_folded(df, "g", "i", "n", 120)) == plain(packing.pack_folded(df, "g", "i", "n", 120, most_rows=10))
    assert packing.pack_folded(df.limit(0), "g", "i", "n").count() == 0


def test_shards_by_size(spark):
    df = spark.createDataFrame([("g", i, 40) for i in range(10)], "g string, i int, n int")
    assert [r.shard for r in sharding.shards_by_size(df, "n", "i", 100, "g").orderBy("i").collect()] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]
    assert sharding.shards_by_size(df, "n", "i", 10**9, "g", 4).agg(F.max("shard")).first()[0] == 2


FILES = [
    '{"rec_key": "a", "video_path": "v", "value": "x"}\r\n{"value": null, "rec_key": "b", "video_path": "v"}\r\r\n\n', '{"rec_key": "c", "video_path": "v", "val', None, "", chr(0xFEFF) + '{"rec_key": "d", "video_path": "v", "value": "1"}',
    '{"rec_key": "a", "video_path": "v", "value": "x"}\n{"rec_key": null, "video_path": "v", "value": "x"}\nnot json\n[1]\n{"rec_key": "e", "video_path": "v", "value": "' + "y" * 5000 + '"}',
]


def test_consolidation(spark):
    df = spark.createDataFrame([(i, c, "clash") for i, c in enumerate(FILES)], "file_id int, content string, rec_key string")
    done = compaction.consolidate_files(df, scratch_path(spark, "t"))
    got = compaction.read_compacted(spark, done)
    assert sorted(r.rec_key for r in got.collect()) == ["a", "b", "d", "e"] and done.records == 4 and done.files == 1
    none = compaction.consolidate_files(df.limit(0), scratch_path(spark, "t"))
    assert none.records == 0 and compaction.read_compacted(spark, none).count() == 0


def test_an_existing_table_is_kept_or_replaced(spark, tmp_path):
    df = spark.createDataFrame([(1, FILES[0], "x"), (2, FILES[1], "x"), (3, FILES[5], "x")], "file_id int, content string, rec_key string")
    path = f"{tmp_path}/table"
    done = compaction.consolidate_files(df.filter("file_id = 1"), path)
    assert (done.records, done.lines, done.damaged) == (2, 2, 0)
    with pytest.raises(FileExistsError):
        compaction.consolidate_files(df, path)
    assert compaction.read_compacted(spark, done).count() == 2
    done = compaction.consolidate_files(df, path, overwrite=True, damaged_path=f"{tmp_path}/damaged")
    assert (done.records, done.lines, done.damaged) == (3, 8, 4) and sorted(os.listdir(tmp_path)) == ["damaged", "table"]
    assert sorted(r.rec_key for r in compaction.read_compacted(spark, done).collect()) == ["a", "b", "e"]
    assert spark.read.text(f"{tmp_path}/damaged").count() == 4 == compaction.damaged_lines(df).count()


def test_nothing_is_committed_if_rows_differ(spark, monkeypatch):
    df = spark.range(5).select(F.col("id").cast("string").alias("rec_key"), F.lit("v").alias("video_path"), F.lit(None).cast("string").alias("value"))
    answers = iter([(4, None, None), (5, 1, 1)])
    monkeypatch.setattr(compaction, "multiset_checksum", lambda _: next(answers))
    path = scratch_path(spark, "t")
    with pytest.raises(RuntimeError, match="committed"):
        compaction.compact(df, path)
    assert not os.path.exists(path.removeprefix("file://"))


def test_compaction_splits_near_the_target(spark):
    df = spark.range(60000).select(F.md5(F.col("id").cast("string")).alias("rec_key"))
    done = compaction.compact(df.repartition(50), scratch_path(spark, "t"), 600_000)
    assert 2 <= done.files <= 8 and done.records == 60000


def test_hot_keys(spark):
    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    stats = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = skew.attach_stats(rows, stats, "k", "n", 900, hot_rows=100)
    assert got.count() == 900 and got.filter("k = 'hot' and n = 300").count() == 300


def test_runtime(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    with conf(spark, spark__sql__shuffle__partitions=3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    small, large = spark.range(5), spark.range(50)
    assert "broadcast" in broadcast_checked(small, 10)._jdf.queryExecution().toString().lower()
    assert "broadcast" not in broadcast_checked(small, 10, 20)._jdf.queryExecution().toString().lower()
    assert "broadcast" not in broadcast_checked(large, 10)._jdf.queryExecution().toString().lower()


def test_streams_do_not_depend_on_the_files(spark, tmp_path):
    from datetime import datetime, timedelta

    from shardweave.plans import q_stream
    from shardweave.streaming import packer, run

    day = datetime(2024, 1, 1)
    sizes = [500 + 37 * (n * n % 90) for n in range(60)]
    for k in range(6):  # the later a file arrives, the older are its rows
        ids = range(50 - 10 * k, 60 - 10 * k)
        spark.createDataFrame([(i, day + timedelta(days=i), "a") for i in ids], "event_id bigint, ts timestamp, event_type string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
        spark.createDataFrame([(i, "s", sizes[i]) for i in ids], "doc_id bigint, source string, n_chars bigint").coalesce(1).write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    assert [tuple(r) for r in q_stream.stream_first_seen(spark, str(tmp_path)).collect()] == [("a", 60)]
    want, used, n = [], 0, 0
    for size in sizes:
        if used + size > packer.CAPACITY and n:
            want.append(("s", len(want), n, used))
            used, n = 0, 0
        used, n = used + size, n + 1
    assert sorted(map(tuple, q_stream.stream_packer(spark, str(tmp_path)).collect())) == want
    rows = spark.createDataFrame([("s", i, x) for i, x in reversed(list(enumerate(sizes)))], "grp string, pos bigint, n bigint")
    source = run.ordered_source(rows, "pos", 7)
    assert sorted(map(tuple, run.run_to_table(spark, source, rows.schema, packer.stream_bins, files=1).collect())) == want
