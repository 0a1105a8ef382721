"""Scalar functions, URLs, codecs and tokenizers."""

import gzip
import io
import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hnp
from pyspark.sql import functions as F

from shardweave.functions import cbor, codecs, conversation, tenbin, tokenizers, urls, video


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a-{000..002}.tar", ["a-000.tar", "a-001.tar", "a-002.tar"]), ("{9..11}", ["9", "10", "11"]), ("{a,b{1..2}}x", ["ax", "b1x", "b2x"]), ("{c..a}", ["c", "b", "a"]),
        ("{0..10..5}", ["0", "5", "10"]), ("no{brace}here", ["no{brace}here"]), ("open{1..2", ["open{1..2"]), ("{}", ["{}"]), ("", [""]),
    ],
)
def test_braces(text, want):
    assert urls.brace_expand(text) == want


def test_url_lists():
    assert len(urls.expand_urls("test-{000000..000099}.tar")) == 100
    assert urls.expand_urls("${A}x::y", {"WDS_A": "p/${B}/", "WDS_B": "q"}) == ["p/q/x", "y"]
    assert urls.expand_urls(["a{1..2}"]) == ["a{1..2}"]
    with pytest.raises(KeyError):
        urls.envsubst("${NOPE}", {})


PIPES = [
    ("pipe:curl -s http://h/x.tar", "http://h/x.tar"), ("pipe:gsutil cat gs://b/y.tar", "gs://b/y.tar"), ("pipe:cat local.tar", "cat local.tar"), ("s3://b/k", "s3://b/k"),
    ("pipe:a https://h/1 gs://2", "https://h/1"), ("file:/x", "file:/x"), ("pipe:", ""), ("pipe:ais get ais://b/z -", "ais://b/z"),
]


def test_pipe_cleaner(spark):
    df = spark.createDataFrame(PIPES, "u string, want string")
    assert all(r.got == r.want for r in df.select("want", urls.pipe_cleaner(F.col("u")).alias("got")).collect())


def test_paths(spark):
    df = spark.createDataFrame([("a/b/c/d.e.txt",), ("x",), ("p.q/r.gz",), (None,), ("",)], "p string")
    got = [tuple(r) for r in df.select(urls.member_base(F.col("p")), urls.member_ext(F.col("p")), urls.last_components(F.col("p"), 2)).collect()]
    assert got == [("a/b/c/d", "e.txt", "c/d.e.txt"), (None, None, "x"), ("p.q/r", "gz", "p.q/r.gz"), (None, None, None), (None, None, "")]
    assert one(spark, urls.cache_path(F.lit("s3://host/a:b/c.tar?x=1"), "/c/")) == "/c/a_b/c.tar"
    assert urls.rewrite_url("s3://b/k", "gs://=x;s3://=/mnt/") == "/mnt/b/k"
    assert one(spark, urls.join_path(F.lit("/a/"), F.lit("/b"))) == "/b"
    assert one(spark, urls.file_type(F.lit(bytearray(gzip.compress(b""))))) == "gzip"


def test_turns(spark):
    turns = F.from_json(F.lit(json.dumps([{"from": "User", "value": "<image>hi"}, {"from": "assistant", "value": "yo"}, {"from": "human", "value": None}])), conversation.TURNS)
    t = conversation.normal_turns(turns)
    assert one(spark, conversation.render(t)) == "<s><image>hi\nyo</s>\n"
    assert one(spark, conversation.prompts(t)) == ["<image>hi", None] and one(spark, conversation.replies(t)) == ["yo"]
    assert one(spark, conversation.human_image_tags(t)) == 1
    assert one(spark, F.length(conversation.expand_turns(t)[0]["value"])) == len(conversation.IMAGE_BLOCK) + 2
    with pytest.raises(ValueError, match="unknown"):
        conversation.expand_image_tokens(F.lit(""), "other")


def test_frame_questions(spark):
    text = "<image><image>#12.5#first <image>#3#second Summary: all of it"
    got = one(spark, conversation.frame_questions(F.lit(text)))
    assert got.questions == ["<image><image>#12.5#", "<image>#3#", "Summary this video."]
    assert got.answers == ["first ", "second ", " all of it"]
    for bad in ("no tags", "<image>#1#no end", "<image>#1#a Summary: b Summary: c", "", None):
        assert one(spark, conversation.frame_questions(F.lit(bad).cast("string"))) is None


def test_word_tokenizer(spark):
    w = tokenizers.WordTokenizer()
    assert one(spark, w.words(F.lit("Hi, <im_patch>caf" + chr(0xE9) + "!"))) == ["Hi", ",", "<im_patch>", "caf" + chr(0xE9), "!"]
    assert one(spark, w.ids(F.lit("<s><im_start></s>"))) == [1, 32001, 2]
    assert one(spark, w.ids(F.lit(None).cast("string"))) == []


def test_special_split(spark):
    for text in ("a<x>b<y><x>", "<x>", "", "line\n<y>end"):
        assert one(spark, tokenizers.split_special_col(F.lit(text), ["<x>", "<y>"])) == tokenizers.split_special(text, ["<x>", "<y>"])


def test_piece_tokenizer(spark):
    public = pytest.importorskip("public_tokenizers")
    t = tokenizers.PieceTokenizer(public.path("piece_bpe_32k.model"))
    assert (t.bos_token_id, t.eos_token_id, t.unk, t.token_id("<im_patch>"), t.vocab_size) == (1, 2, 0, 32000, 32003)
    assert t.special_text(32001) == "<im_start>" and t.special_text(7) == "" and t.is_special(0) and not t.is_special(500)
    ids = t.tokenize("hello <im_start>world</s>")
    assert 32001 in ids and ids[-1] == 2
    assert t.detokenize(ids).split() == ["hello", "<im_start>", "world", "</s>"]
    assert tokenizers.PieceTokenizer(t.model, "chat").token_id("<|BOT|>") == 32000
    df = spark.createDataFrame([("hello",), ("",), (None,)], "t string")
    assert [r.x for r in df.select(t.ids(F.col("t")).alias("x")).collect()] == [t.tokenize("hello"), [], []]
    assert tokenizers.padded_vocab_size(32003, 128, 2) == 32256


@settings(max_examples=40, deadline=None)
@given(st.lists(hnp.arrays(st.sampled_from([np.float32, np.int64, np.uint8, np.uint32, np.float16]), hnp.array_shapes(max_dims=4, max_side=4)), max_size=3))
def test_tenbin_round_trip(arrays):
    back = tenbin.decode(tenbin.encode(arrays, [f"a{i}" for i in range(len(arrays))]), with_infos=True)
    assert len(back) == len(arrays)
    for i, (a, (b, info)) in enumerate(zip(arrays, back, strict=True)):
        assert a.dtype == b.dtype and np.array_equal(a, b, equal_nan=a.dtype.kind == "f") and info == f"a{i}"
    assert len(tenbin.encode(arrays)) == sum(16 + 64 + 16 + tenbin.padded(a.nbytes) for a in arrays) or any(a.ndim > 5 for a in arrays)


def test_tenbin_damage():
    data = tenbin.encode([np.arange(20)])
    with pytest.raises(ValueError):
        tenbin.decode(data[:-70])
    with pytest.raises(ValueError):
        tenbin.decode(b"x" * 64)
    with pytest.raises(ValueError):
        tenbin.encode([np.array(["a"])])


VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**63), 2**63 - 1) | st.floats(allow_nan=False) | st.text(max_size=8) | st.binary(max_size=8),
    lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(max_size=4), x, max_size=4),
    max_leaves=8,
)


@settings(max_examples=100, deadline=None)
@given(st.lists(VALUES, max_size=4))
def test_cbor_round_trip(values):
    stream = io.BytesIO(b"".join(map(cbor.dumps, values)))
    assert list(cbor.load_all(stream)) == values


def test_cbor_open_lengths():
    assert cbor.loads(bytes.fromhex("9f018202039f0405ffff")) == [1, [2, 3], [4, 5]]
    assert cbor.loads(bytes.fromhex("7f657374726561646d696e67ff")) == "streaming"
    with pytest.raises(ValueError):
        cbor.loads(b"\x19\x01")


def test_codecs():
    c = codecs.Codecs()
    for name, value in (("txt", "hello\n"), ("cls", 3), ("json", {"a": [1]}), ("npy", np.eye(2)), ("ten", [np.arange(4)]), ("cbor", {"k": 1}), ("txt.gz", "zipped")):
        got = c.decode(name, c.encode(name, value) if name != "txt.gz" else gzip.compress(b"zipped"))
        assert np.array_equal(got, value) if name in ("npy", "ten") else got == value
    assert c.decode("bin", b"x") == b"x" and c.decode("__key__", b"k") == "k" and c.decode("txt", None) is None
    assert list(c.decode("npz", c.encode("npz", {"a": np.arange(2)}))) == ["a"]
    for name in ("mp4", "pth", "pyd", "flac"):
        with pytest.raises(ImportError):
            c.decode(name, b"x")
    with pytest.raises(ValueError, match="no decoder"):
        c.decode("strange", b"x", must_decode=True)
    with pytest.raises(ValueError, match="no handler"):
        c.encode("strange", 3)
    assert codecs.Codecs(unsafe=True).decode("pyd", c.encode("pyd", {1: 2})) == {1: 2}
    assert c.register("mp4", len).decode("a.mp4", b"xyz") == 3


def test_images():
    a = (np.arange(24) * 10).astype(np.uint8).reshape(2, 4, 3)
    data = codecs.encode_pnm(a)
    assert np.array_equal(codecs.decode_pnm(data), a) and codecs.image_size(data) == (4, 2)
    assert np.array_equal(codecs.decode_pnm(codecs.encode_pnm(a / 255.0)), a)
    for spec in codecs.IMAGE_SPECS:
        out = codecs.image_array(a, spec)
        assert out.dtype == (np.uint8 if spec.endswith("8") or spec.startswith("pil") else np.float32)
        assert (out.shape[0] in (3, 4)) == (spec.startswith("torch") and "rgb" in spec)
    with pytest.raises(ValueError):
        codecs.encode_pnm(np.full((2, 2), 2.0))


def test_field_expressions(spark):
    df = spark.createDataFrame([(bytearray(b" 12\n"), bytearray(b'{"k": 5}')), (bytearray(b"x"), bytearray(b"{")), (None, None)], "a binary, b binary")
    rows = df.select(codecs.int_field(F.col("a")).alias("n"), codecs.json_field(F.col("b"), "k int")["k"].alias("k"), codecs.variant_field(F.col("b")).isNull().alias("bad")).collect()
    assert [(r.n, r.k, r.bad) for r in rows] == [(12, 5, False), (None, None, True), (None, None, True)]


def test_frames(spark):
    for frames in range(1, 400, 7):
        want = [int(frames / 16 / 2 + np.round(frames / 16 * i)) for i in range(16)]
        assert one(spark, video.frame_indices(F.lit(frames), F.lit(25.0))) == want
    with pytest.raises(ValueError):
        video.frame_indices(F.lit(1), F.lit(1.0), 0)
    assert one(spark, video.uniform_sample(F.lit(list(range(10))), 4)) == [0, 3, 6, 9]
    assert one(spark, video.uniform_sample(F.lit(list(range(3))), 4)) == [0, 1, 2]
    assert one(spark, video.uniform_sample(F.lit(list(range(5))), 1)) == [0]
    assert [(f.idx, f.kind) for f in one(spark, video.merge_key_frames(F.lit([0, 4]), F.lit([0, 2, 9])))] == [(0, "P"), (0, "I"), (2, "P"), (4, "I"), (9, "P")]
    assert one(spark, video.relative_timestamp(F.lit(2.25), F.lit(1000.0))) == 2.2
    assert tuple(one(spark, video.black_background(F.lit("Black background: 640, 480")))) == (640, 480)
    assert one(spark, video.black_background(F.lit("a.jpg"))) is None
    frames = F.array(*[F.struct(F.lit(i).alias("idx"), F.lit("I" if i % 5 == 0 else "P").alias("kind")) for i in range(20)])
    got = one(spark, video.key_frames(frames))
    assert got.i_frames == [0, 5, 10, 15, 19] and got.p_frames == [i for i in range(20) if i % 5][:-1]
