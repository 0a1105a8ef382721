"""The operators for training data against brute force, on small made-up inputs with every kind of dirt."""

import functools
import itertools
import json
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardweave.llm import bpe, budget, copies, curve_packing, leaks, lookalikes, mixture, pair_defects
from shardweave.operators.skew import attach_stats
from shardweave.runtime import conf

ZWJ, SHY, NBSP = chr(0x200D), chr(0xAD), chr(0xA0)


# ---- 1: packing -------------------------------------------------------------------------------------------------


def test_hilbert_is_a_walk_over_all_cells():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = curve_packing.hilbert_key(cells, 3)
    assert sorted(key) == list(range(512))
    assert np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1).max() == 1


def test_curve_positions_do_not_depend_on_the_pass(monkeypatch):
    rng = np.random.default_rng(2)
    sizes = [0, 5, 0, 90, 1, 300, 7, 0]
    values, offsets = rng.integers(0, 33000, sum(sizes) + 4).astype(np.int32), np.cumsum([4, *sizes]).astype(np.int32)
    whole = curve_packing.curve_positions(values, offsets)
    alone = [curve_packing.curve_positions(values[a:b], np.array([0, b - a]))[0] for a, b in itertools.pairwise(offsets)]
    for n in (1, 7, 64, 301):
        monkeypatch.setattr(curve_packing, "PASS", n)
        assert whole.tolist() == curve_packing.curve_positions(values, offsets).tolist() == alone


def _tokenized(spark, rows):
    return spark.createDataFrame(rows, "sample_id bigint, input_ids array<int>, loss_mask array<int>, seq_id string, n_tokens string")


def test_packing_keeps_every_sample_whole(spark):
    rng = np.random.default_rng(5)
    sizes = [int(x) for x in rng.integers(1, 40, 300)] + [50, 50, 51, 149, 200]
    rows = [(i, rng.integers(3, 30000, n).tolist(), [1] * n, "clash", None) for i, n in enumerate(sizes)]
    rows += [(1000, [], [], None, None), (1001, None, None, None, None), (1002, [5, None, 7], [1], None, None), (1003, [9, 9], None, None, None)]
    rows += [rows[0], rows[7], (7, rows[7][1], rows[7][2][:1], None, None), (None, [4, 4, 4], [1, 1, 1], None, None)]
    got = curve_packing.pack_sequences(_tokenized(spark, rows), capacity=50).collect()
    pieces = {}
    for r in got:
        assert r.n_tokens == len(r.input_ids) == len(r.loss_mask) == sum(r.lengths) <= 50
        for s, at, n, off in zip(r.sample_ids, r.starts, r.lengths, r.sample_from, strict=True):
            pieces.setdefault(s, []).append((off, r.input_ids[at : at + n], r.loss_mask[at : at + n]))
    usable = {r[0]: r for r in reversed(rows) if r[1]}
    assert set(pieces) == set(usable)
    for s, parts in pieces.items():
        ids = [x or 0 for x in usable[s][1]]
        parts.sort()
        assert sum((p[1] for p in parts), []) == ids
        assert len(parts) == -(-len(ids) // 50)
        mask = sum((p[2] for p in parts), [])
        assert mask == ([1, 0, 0] if s == 1002 else [0, 0] if s == 1003 else [1] * len(ids))
    fill = curve_packing.fill_report(curve_packing.pack_sequences(_tokenized(spark, rows), capacity=50), 50).first()
    assert fill.fill > 0.93
    assert len({r.seq_id for r in got}) == len(got)


def test_sequences_do_not_depend_on_partitions(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, rng.integers(3, 30000, int(n)).tolist(), [1], None, None) for i, n in enumerate(rng.integers(1, 40, 400))]
    rows += [(1000 + i, [7] * 30, [1], None, None) for i in range(200)]  # a third of all tokens at one place of the curve
    monkeypatch.setattr(curve_packing, "SEGMENT", 1000)
    df = _tokenized(spark, rows)
    segments = curve_packing.curve_segments(df.select(F.col("input_ids").alias("ids")).withColumn("curve", curve_packing._curve("ids")))
    assert len(segments) > 3 and max(n for _, n in segments) > 1
    want = None
    for n in (1, 3, 11):
        with conf(spark, spark__sql__shuffle__partitions=n):
            got = sorted((r.seq_id, r.sample_ids) for r in curve_packing.pack_sequences(df.repartition(n), capacity=50).collect())
        want = want or got
        assert got == want
    assert sorted(x for _, ids in want for x in ids) == sorted(r[0] for r in rows)


def test_packing_nothing(spark):
    empty = _tokenized(spark, [])
    assert curve_packing.pack_sequences(empty).count() == 0
    assert curve_packing.fill_report(curve_packing.pack_sequences(empty)).first().asDict() == {"n_sequences": 0, "n_tokens": 0, "fill": 0.0}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 130), max_size=80), st.integers(1, 5))
def test_packer_loses_nothing(sizes, opened):
    p, out = curve_packing.Packer(50, opened), []
    for i, n in enumerate(sizes):
        out += p.add(i, np.arange(n), np.ones(n))
    out += p.finish()
    assert all(sum(len(x[2]) for x in s) <= 50 for s in out)
    got = sorted((x[0], x[1], len(x[2])) for s in out for x in s)
    assert sum(x[2] for x in got) == sum(sizes)
    assert [x[0] for x in got] == [i for i, n in enumerate(sizes) for _ in range(-(-n // 50))]


# ---- 2: mixing --------------------------------------------------------------------------------------------------


def test_flow_uses_overlap_to_meet_quotas():
    sizes = {("a",): 100, ("b",): 10, ("a", "b"): 60}
    flow, quotas = mixture.plan_mix(sizes, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 1})
    assert quotas == {"a": 70, "b": 70}
    assert flow[("a", "b"), "b"] == 60 and flow[("b",), "b"] == 10 and flow[("a",), "a"] == 70


def test_patterns_that_become_equal_count_together(spark):
    flow, quotas = mixture.plan_mix({("a", "b"): 100, ("b",): 50}, {"a": 0, "b": 1}, {"a": 1, "b": 1})
    assert flow == {(("b",), "b"): 150} and quotas == {"b": 150}
    members = spark.createDataFrame([(f"i{k}", s, 10) for k in range(20) for s in (("a", "b") if k % 2 else ("b",))], "item string, source string, size bigint")
    targets = spark.createDataFrame([("a", 0.0, 3), ("b", 1.0, 2)], "source string, target_share double, max_repeats int")
    mix = mixture.draw_mix(members, targets)
    assert {r.source: (r.n_available, r.n_drawn) for r in mix.report.collect()} == {"a": (100, 0), "b": (200, 400)}
    assert sorted((r.item, r.n_drawn) for r in mix.drawn.collect()) == sorted((f"i{k}", 20) for k in range(20))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sets(st.sampled_from("abc"), min_size=1).map(lambda s: tuple(sorted(s))), st.integers(1, 15), min_size=1), st.lists(st.integers(1, 9), min_size=3, max_size=3), st.lists(st.integers(1, 3), min_size=3, max_size=3))
def test_mix_is_the_largest(sizes, weights, reps):
    shares, repeats = dict(zip("abc", weights, strict=True)), dict(zip("abc", reps, strict=True))
    there = {s for p in sizes for s in p}
    share = {s: shares[s] / sum(shares[x] for x in there) for s in there}
    flow, quotas = mixture.plan_mix(sizes, shares, repeats)
    fits = lambda q: all(sum(q[s] for s in c) <= sum(n * min(max(repeats[s] for s in p), sum(repeats[s] for s in p if s in c)) for p, n in sizes.items()) for k in range(1, 4) for c in map(set, itertools.combinations(there, k)))
    best = max(t for t in range(200) if fits({s: mixture._quota(t, x) for s, x in share.items()}))
    assert quotas == {s: mixture._quota(best, share[s]) for s in there}
    assert {s: sum(v for (_, x), v in flow.items() if x == s) for s in there} == quotas
    for p, n in sizes.items():
        assert sum(v for (x, _), v in flow.items() if x == p) <= n * max(repeats[s] for s in p)


def test_too_many_patterns_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixture, "PATTERNS", 2)
    members = spark.createDataFrame([("x", "a", 1), ("y", "b", 1), ("z", "a", 1), ("z", "b", 1)], "item string, source string, size bigint")
    with pytest.raises(ValueError, match="overlap in more than 2 ways"):
        mixture.draw_mix(members, spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int"))


def test_mix_meets_shares_and_caps(spark):
    items = [(f"s3://x/pack/{s}/{i}", s, 10 + i % 7) for s, n in (("big", 400), ("mid", 60), ("tiny", 5)) for i in range(n)]
    members = spark.createDataFrame(items, "item string, source string, size bigint")
    targets = spark.createDataFrame([("big", 0.5, 1), ("Mid ", 0.3, 3), ("tiny", 0.1, 4), ("gone", 0.1, 9)], "source string, target_share double, max_repeats int")
    mix = mixture.draw_mix(members, targets)
    report = {r.source: r for r in mix.report.collect()}
    drawn = mix.drawn.collect()
    assert report["gone"].n_drawn == 0 and set(report) == {"big", "mid", "tiny", "gone"}
    for s in ("big", "mid", "tiny"):
        got = sum(r.n_drawn for r in drawn if r.source == s)
        assert got == report[s].n_drawn
        assert abs(report[s].actual_share - report[s].target_share / 0.9) < 1e-3
        assert got <= report[s].max_repeats * report[s].n_available
        assert max(r.passes for r in drawn if r.source == s) <= report[s].max_repeats
        assert len({r.item for r in drawn if r.source == s}) == sum(r.source == s for r in drawn)
    assert report["tiny"].repeats == pytest.approx(4, abs=0.05)  # the scarce source decides how large the mix can be
    again = mixture.draw_mix(members, targets)
    assert sorted(map(tuple, again.drawn.collect())) == sorted(map(tuple, drawn))
    few = mixture.draw_mix(members, targets, total=100)
    assert 97 <= sum(r.n_drawn for r in few.report.collect()) <= 100


def test_shard_spellings_and_counts(spark):
    rows = [
        ("s3://a/pack/Cat/x.tar", 5, "2025-01-01"), ("s3a://a//pack/cat/x.tar", 7, "2025-01-02"), (" s3://a/pack/cat/x.tar", None, "2025-01-03"),
        ("s3://a/pack/cat/zero.tar", 0, "2025-01-01"), ("/m/pack/dog/y.tar", 3, None), (None, 4, "2025-01-01"),
    ]
    df = spark.createDataFrame(rows, "url string, nsamples bigint, indexed_at string")
    assert sorted(map(tuple, mixture.shard_items(df).collect())) == [("/m/pack/dog/y.tar", "dog", 3), ("s3://a/pack/cat/x.tar", "cat", 7)]


def test_mix_of_nothing(spark):
    members = spark.createDataFrame([], "item string, source string, size bigint")
    targets = spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int")
    mix = mixture.draw_mix(members, targets)
    assert mix.drawn.count() == 0 and mix.report.first().actual_share == 0


# ---- 3: copies --------------------------------------------------------------------------------------------------

MANIFEST = [
    (1, "s3://b/x_1.mp4", "The Cat sits."), (2, "s3://b/X-1.MP4", "the  cat\nSITS"), (3, " s3://b/x_1.mp4/", '"The cat sits"'), (4, "s3://b/x_2.mp4", "The cat sits."),
    (5, "p", '{"left": "caf\\u00e9", "right": "b"}'), (6, "p", '{ "Right" : "B." , "LEFT" : "caf' + chr(0xE9) + '" }'), (7, "p", '{"left": "b", "right": "caf' + chr(0xE9) + '"}'),
    (8, "p", "left: a b; right: c"), (9, "p", "Right = C | Left = A, b"), (10, "p", "left: c; right: a b"), (11, "p", "gro" + chr(0xDF) + "er Hund"), (12, "p", "GROSSER HUND!"),
    (13, None, "same"), (14, None, "same"), (15, "p", None), (16, "p", None), (17, "p", "  \t"), (18, "p", ""), (19, "p", "same"), (20, "p", '{"broken": '), (21, "p", '{"BROKEN":'),
    (22, "p", "cat the sits"), (23, "p", "the cat sits"), (24, "q", '["a", "b"]'), (25, "q", "[A, b]"), (26, "r", "Nach 3 Sekunden: ein Hund"), (27, "r", "nach 3 sekunden - ein hund"),
    (28, "s", '["caf\\u00e9 x"]'), (29, "s", '["Caf' + chr(0xE9) + ' x"]'), (30, "s", '["a\\nb"]'), (31, "s", "a b"), (32, "s", '["anb"]'),
]


def _brute(rows):
    groups = {}
    for i, p, v in rows:
        if v and v.strip():
            key = (None if p is None else copies._letters(p), copies.canonical_value(v))
            groups.setdefault(key, []).append(i)
    return groups


def test_copies_by_brute_force(spark):
    df = spark.createDataFrame([(*r, "x") for r in MANIFEST], "rec_id bigint, video_path string, value string, record string")
    got = {(r.first_id, r.rec_id) for r in copies.copy_classes(df).filter("rec_id <> first_id").collect()}
    assert got == {(min(g), i) for g in _brute(MANIFEST).values() for i in g if i != min(g)}
    assert got == {(1, 2), (1, 3), (5, 6), (8, 9), (11, 12), (13, 14), (20, 21), (24, 25), (26, 27), (28, 29), (30, 31)}
    collapsed = {r.rec_id: r.n_copies for r in copies.collapse_copies(df).collect()}
    assert sum(collapsed.values()) == len(MANIFEST) and collapsed[1] == 3 and collapsed[15] == 1
    none = df.limit(0)
    assert copies.copy_classes(none).count() == 0 and copies.collapse_copies(none).count() == 0


@pytest.mark.parametrize("hot", [50_000, 100])
def test_one_class_with_a_third_of_all_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(copies, "attach_stats", functools.partial(attach_stats, hot_rows=hot))
    df = spark.range(900).select(F.col("id").alias("rec_id"), F.lit("p").alias("video_path"), F.when(F.col("id") % 3 == 0, "Hot  row").otherwise(F.concat(F.lit("row"), F.col("id").cast("string"))).alias("value"))
    got = copies.copy_classes(df)
    assert got.count() == 300 and got.filter("first_id = 0 and n_copies = 300").count() == 300


# ---- 5: pairs ---------------------------------------------------------------------------------------------------


def _sample():
    subjects = ["the cook", "a brown dog", "the old baker", "a tall waiter"]
    verbs = ["opens the green door", "paints the garden fence", "folds a paper kite", "lifts a heavy basket"]
    places = ["near the fountain", "in the school gym", "on the upper deck", "beside the canal"]
    told = [f"{s.capitalize()} {v} {p}." for s, v, p in itertools.product(subjects, verbs, places)]
    asked = [f"What does {s} do {p} in this clip?" for s, p in itertools.product(subjects, places)]
    french = ["Le cuisinier ouvre la porte verte dans la cuisine.", "Un chien brun porte une caisse sous le pont.", "Le boulanger est dans le jardin avec une fillette."]
    out = [(q, "", a) for q, a in zip(itertools.cycle(asked), told * 3, strict=False)]
    out += [("Que fait le cuisinier dans la cuisine ?", "", f) for f in french * 12]
    out += [(q, "", a) for q in asked for a in ("I'm sorry, but I can't help with this request.", q, french[0], "About seven seconds")]
    return out


@pytest.fixture(scope="module")
def tagger():
    return pair_defects.Tagger().fit(_sample())


@pytest.mark.parametrize(
    ("answer", "defect"),
    [
        (None, "empty"), ("", "empty"), (" \t", "empty"), ("N/A", "empty"), ("[no answer]", "empty"), ("...", "empty"), ("<image>", "empty"), (chr(0x200B), "empty"), ("-", "empty"),
        ("The cook opens the green door near the fountain.", None), ("The cook opens the green door near the fountain", None), ("red", None), ("Yes", None), ("12", None),
        ("The cook opens the", "truncated"), ("The cook opens the green do-", "truncated"), ("A brown dog paints the garden fence,", "truncated"), ("1. The cook folds a paper kite.\n2.", "truncated"),
        ("I'm sorry, but I can't help with this request.", "refusal"), ("As a language model I have no way to watch videos. Please try another question.", "refusal"),
        ("A sign reads 'we are unable to accept cards', and the cook folds a paper kite.", None), ("The girl says she is sorry, but she cannot come along.", None),
        ("What does the cook do near the fountain in this clip?", "copy"), ("Question: what does the cook do near the fountain in this clip", "copy"),
        ("What does the cook do near the fountain in this clip? The cook folds a paper kite.", None),
        ("Le cuisinier ouvre la porte verte dans la cuisine.", "language"), (chr(0x53A8) + chr(0x5E08) + chr(0x6253) + chr(0x5F00) + chr(0x95E8) + chr(0x3002), "language"),
    ],
)
def test_defects(tagger, answer, defect):
    assert tagger.defect("<image>What does the cook do near the fountain in this clip?", "", answer) == defect


def test_asked_for_language(tagger):
    assert tagger.defect("What does the cook do near the fountain? Please answer in French.", "", "Le cuisinier ouvre la porte verte dans la cuisine.") is None


def test_pairs_of_both_tables(spark):
    turns = "array<struct<`from`:string,value:string>>"
    qa = spark.createDataFrame(
        [(1, [{"q": "What is it?", "a": ""}, {"q": "And now?"}], "x"), (1, [{"q": "What is it?", "a": ""}, {"q": "And now?"}], "x"), (2, None, "x"), (3, [], "x")],
        "qa_id bigint, value array<map<string,string>>, defect string",
    )
    talk = [("system", "be kind"), ("user", "Who is there?"), ("human", "Hello?"), ("Assistant", "The cook.")]
    packed = spark.createDataFrame([(5, (None, [{"from": a, "value": b} for a, b in talk])), (6, None), (7, (None, None))], f"sample_id bigint, info struct<images:array<string>,conversations:{turns}>")
    pairs = pair_defects.question_pairs(qa, packed)
    assert {(r.tab, r.rec_id, r.pair_no, r.a) for r in pairs.collect()} == {("manifest_qa", 1, 0, ""), ("manifest_qa", 1, 1, None), ("packed", 5, 0, None), ("packed", 5, 1, "The cook.")}
    got = sorted((r.tab, r.rec_id, r.pair_no, r.defect) for r in pair_defects.find_defects(pairs).collect())
    assert got == [("manifest_qa", 1, 0, "empty"), ("manifest_qa", 1, 1, "empty"), ("packed", 5, 0, "empty")]
    assert pair_defects.find_defects(pairs.limit(0)).count() == 0


@pytest.mark.parametrize(
    "answer", ["As requested I must pass on this one.", "That is something I would rather leave alone.", "Nope, ask someone else please.", "Ich möchte dazu lieber nichts sagen.", "Je ne vais pas répondre.", "我不想回答。"]
)
def test_refusals_in_words_that_no_rule_knows(tagger, answer):
    question = {"I": "Was macht der Koch?", "J": "Que fait le cuisinier ?", "我": "厨师在做什么？"}.get(answer[0], "What does the cook do near the fountain?") if answer[:2] != "In" else ""
    assert tagger.defect("What does the cook do?" if answer.isascii() else question, "", answer) == "refusal"


@pytest.mark.parametrize("answer", ["the picture shows a woman reading on the veranda", "He refuses to answer.", "She says 'I cannot help you'.", "A quokka hops onto the pergola", "Veranda", "on the veranda"])
def test_unknown_words_are_no_defect(tagger, answer):
    assert tagger.defect("What does the cook do near the fountain in this clip?", "", answer) is None


def test_held_out_pairs(tagger):
    """Defects made on purpose in pairs that were not fitted on: nine in ten and more are found, and hardly any other."""
    subjects, verbs = ["the young baker", "a tall cook", "the old waiter", "a brown kite"], ["opens a heavy basket", "paints the green door", "folds the garden fence", "lifts a paper kite"]
    places = ["in the school gym", "near the fountain", "beside the canal", "on the upper deck"]
    told = [f"{s.capitalize()} {v} {p}." for s, v, p in itertools.product(subjects, verbs, places)]
    asked = [f"What does {s} do {p} in this clip?" for s, p in itertools.product(subjects, places)]
    cases = [(q, a, None) for q, a in zip(itertools.cycle(asked), told, strict=False)]
    cases += [(q, a[:-1], None) for q, a in zip(itertools.cycle(asked), told, strict=False)]
    cases += [(q, f"{q.upper()} ", "copy") for q in asked]
    cases += [(q, " ".join(a.split()[:n]), "truncated") for q, a in zip(itertools.cycle(asked), told, strict=False) for n in (3, len(a.split()) - 1) if a.split()[n - 1] in ("the", "a", "in", "on", "near", "opens", "upper", "school")]
    cases += [(q, a[:-4], "truncated") for q, a in zip(asked, told[3::4], strict=False)]
    cases += [(q, r, "refusal") for q, r in zip(itertools.cycle(asked), ("I can't answer that.", "Sorry, I will not help with this.", "I must decline. Please ask another question.", "I'd rather not describe the clip."), strict=False)]
    cases += [(q, "Un chien brun ouvre la porte verte dans le jardin.", "language") for q in asked]
    got = [tagger.defect(q, "", a) for q, a, _ in cases]
    hit = sum(g == d and d is not None for g, (_, _, d) in zip(got, cases, strict=True))
    assert hit / sum(d is not None for _, _, d in cases) > 0.95 and hit / sum(g is not None for g in got) > 0.95


def test_statistics_are_those_of_all_pairs(spark, tagger, monkeypatch):
    monkeypatch.setattr(pair_defects, "HELD", 50)
    rows = [("packed", n, 0, *p) for n, p in enumerate(_sample())]
    pairs = spark.createDataFrame(rows, "tab string, rec_id bigint, pair_no bigint, q string, i string, a string").repartition(5)
    got = pair_defects.fit_tagger(pairs, sample=3)
    assert got.languages.words == tagger.languages.words and len(got.endings.shares) < len(tagger.endings.shares)
    judge = lambda t, c: sum((t.endings.share(c) or 0) < x for x in pair_defects.VERDICTS)
    cut = [pair_defects.words_of(" ".join(a.split()[:n])) for _, _, a in _sample() for n in range(1, len(a.split()) + 1)]
    assert [judge(got, c) for c in cut] == [judge(tagger, c) for c in cut]


def test_contexts_by_brute_force():
    texts = ["The cook opens the door. The cook rests", "a b c d e f g h i.", "No, only once", "x" * 3000, "one\ntwo three (aside) \U0001f642", "他开门。他走", "<image>1. ab, c; d"]
    seen, ended = {}, {}
    for t in texts:
        body = pair_defects.without_tail(pair_defects.clean(t))
        cs = pair_defects.clauses(body)
        if cs[-1][-1] not in pair_defects._STOP and sum(w[0].isalnum() for w in pair_defects.words_of(cs[-1])) > pair_defects.SHORT:
            cs.pop()
        for k in map(pair_defects.words_of, cs):
            for i in range(1, len(k) + 1):
                for n in range(1, min(pair_defects.CONTEXT, i + 1) + 1):
                    h = 0
                    for w in [*reversed(k[max(0, i - n) : i]), None][:n]:
                        h = pair_defects.longer_context(h, pair_defects._START if w is None else pair_defects.word_hash(w))
                    seen[h] = seen.get(h, 0) + 1
                    ended[h] = ended.get(h, 0) + (i == len(k))
    counts = pair_defects.Counts()
    counts.count([""] * len(texts), texts)
    rows = list(zip(*(c.to_pylist() for c in counts.batch().columns), strict=True))
    got = {k & (1 << 64) - 1: (n, e) for k, _, _, n, e, *_ in rows if k is not None}
    assert got == {h: (n, ended[h]) for h, n in seen.items()}


def test_field_gradient_raises_likelihood():
    rng = np.random.default_rng(3)
    masks = [rng.integers(0, 1 << len(pair_defects.FEATURES), n).tolist() for n in rng.integers(1, 5, 120)]
    seen = [pair_defects.Seen([""] * len(m), [["w"]] * len(m), m, [["no"] if x >> 3 & 1 else ["yes"] for x in m]) for m in masks]
    ys = [[int(x >> 3 & 1) for x in m] for m in masks]
    crf = pair_defects.Field()
    crf.fit(seen, ys, steps=60)
    assert sum(crf.tag(x) == y for x, y in zip(seen, ys, strict=True)) > 110


# ---- 6: budget --------------------------------------------------------------------------------------------------


def test_counts_equal_the_tokenizer_and_the_cube_adds_up(spark):
    texts = ["A cat.", "", None, chr(0x4F60) + chr(0x597D), "x" * 5000]
    df = spark.createDataFrame([(i, t, "S" if i % 2 else " s ", ["en", "EN_us", None, "zh-CN", " "][i], None) for i, t in enumerate(texts)], "rec_id bigint, value string, dataset string, lang string, domain string")
    model = budget.worker_model(budget.default_model())
    counts = budget.text_counts(df)
    assert {r.rec_id: r.n_tokens for r in counts.collect()} == {i: len(model.encode(t or "")) for i, t in enumerate(texts)}
    assert {r.lang for r in counts.collect()} == {"en", "zh", "und"}
    cube = {(r.source, r.lang, r.domain): (r.n_records, r.n_tokens) for r in budget.token_cube(counts).collect()}
    assert cube["ALL", "ALL", "ALL"] == (5, sum(r.n_tokens for r in counts.collect())) == cube["s", "ALL", "unknown"]
    assert budget.token_cube(counts.limit(0)).filter("source <> 'ALL'").count() == 0


def test_encoded_counts_take_a_repeated_sample_once(spark):
    df = spark.createDataFrame([(1, [1, 2], "a", "en", "d"), (1, [1, 2], "a", "en", "d"), (2, None, None, None, None), (3, [], "b", "x1", "d")], "sample_id bigint, input_ids array<int>, source string, lang string, domain string")
    assert sorted((r.rec_id, r.n_tokens, r.lang) for r in budget.encoded_counts(df).collect()) == [(1, 2, "en"), (2, 0, "und"), (3, 0, "und")]


def test_rows_without_id_all_count(spark):
    df = spark.createDataFrame([(None, [1, 2, 3], "a", "en", "d"), (None, [4, 5], "a", "en", "d"), (1, [1], "a", "en", "d")], "sample_id bigint, input_ids array<int>, source string, lang string, domain string")
    assert sorted(r.n_tokens for r in budget.encoded_counts(df).collect()) == [1, 2, 3]
    assert budget.token_cube(budget.encoded_counts(df)).filter("source = 'ALL' and lang = 'ALL' and domain = 'ALL'").first().n_tokens == 6


# ---- 7: byte pairs ----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60) | st.text(alphabet=" \n\tabcXYZ019'.,!<|>" + chr(0xE9) + chr(0x4E2D) + chr(0x0436) + ZWJ, max_size=80))
def test_ids_equal_the_tokenizer(reference, text):
    assert bpe.worker_encoder(bpe.default_vocabulary(), bpe.default_pattern())(text) == reference(text)


def test_corpus_ids(spark, reference):
    texts = ["Hello  world", None, "", "<|endoftext|> don't", "   ", "a" * 20000, chr(0x1F469) + ZWJ + chr(0x1F373)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, ids string")
    got = {r.doc_id: r.ids for r in bpe.encode_corpus(df).collect()}
    assert got == {i: reference(t or "") for i, t in enumerate(texts)}
    assert bpe.encode_corpus(df.limit(0)).count() == 0


def test_fragments_are_cut_where_no_token_reaches():
    e = bpe.worker_encoder(bpe.default_vocabulary(), bpe.default_pattern())
    word = (chr(0x4E2D) * 3 + "abc").encode()
    parts = e.fragments(word)
    assert b"".join(parts) == word and len(parts) > 1


# ---- 8: leaks ---------------------------------------------------------------------------------------------------

WORDS = "captain tavrin hides the silver kettle under folded sails while old mesker drags a violet parasol past gate nine and sews one cover for the copper lantern at bell seven".split()


def _leak_docs():
    w = list(WORDS)
    changed = w.copy()
    changed[6], changed[14] = "blue", "green"
    close = w[:15].copy()
    close[3], close[9] = "x", "y"
    text = " ".join(w)
    disguised = text.replace("a", chr(0x430)).replace("o", chr(0x3BF)).upper().replace(" ", NBSP)
    docs = {
        1: f"Before. {text} After.", 2: "noise " + " ".join(w[5:17]) + " noise", 3: " ".join(w[5:16]) + " no more", 4: " ".join(changed), 5: " ".join(close), 6: disguised,
        7: text.replace("kettle", f"ket{SHY}tle").replace("sails", f"sa{ZWJ}ils"), 8: None, 9: "", 10: "watch the clip then answer briefly all of you", 11: "unrelated words " * 50, 12: ", ".join(w).title(),
    }
    return docs


def test_leaks(spark):
    items = [(1, " ".join(WORDS)), (2, "Watch the clip, then answer briefly. Zed runs."), (3, "Watch the clip, then answer briefly. Yod sits."), (4, "Watch the clip, then answer briefly. Xan hums."), (5, None), (6, "")]
    docs = spark.createDataFrame([(k, v, "clash") for k, v in _leak_docs().items()], "doc_id bigint, text string, item_id string")
    asked = spark.createDataFrame([(*i, "b") for i in items], "item_id bigint, text string, bench string")
    got = {(r.doc_id, r.item_id): r for r in leaks.find_leaks(docs, asked).collect()}
    assert {k for k in got if k[1] == 1} == {(d, 1) for d in (1, 2, 4, 6, 7, 12)}
    assert {k for k in got if k[1] != 1} == set()
    assert got[1, 1].whole and not got[2, 1].whole and got[2, 1].n_units == 12
    blocks = {(r.doc_id, r.item_id) for r in leaks.find_leaks(docs, asked, item_block=2).collect()}
    assert blocks == set(got)
    assert leaks.find_leaks(docs.limit(0), asked).count() == 0 and leaks.find_leaks(docs, asked.limit(0)).count() == 0


def test_introductions_are_openings_of_different_items(spark):
    passage = " ".join(f"{w}{n}" for n in range(4) for w in WORDS[:15])
    stock = " ".join(f"please{n}" for n in range(45))
    items = [(n, " ".join(WORDS)) for n in (1, 2, 3)] + [(n, f"{passage} who saw {x}") for n, x in ((4, "tea"), (5, "salt"), (6, "rye"))]
    items += [(n, f"{stock} " + " ".join(f"{x}{k}" for k in range(60))) for n, x in ((7, "one"), (8, "two"), (9, "three"))]
    docs = spark.createDataFrame([(1, " ".join(WORDS)), (2, " ".join(passage.split()[:30])), (3, stock), (4, items[6][1])], "doc_id bigint, text string")
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (2, 20_000):
        got = {(r.doc_id, r.item_id) for r in leaks.find_leaks(docs, asked, item_block=block).collect()}
        assert got == {(1, 1), (1, 2), (1, 3), (2, 4), (2, 5), (2, 6), (4, 7)}


def test_ideographic_leaks(spark):
    signs = "".join(chr(0x4E00 + 37 * i) for i in range(60))
    docs = spark.createDataFrame([(1, "ab " + signs[10:34] + " cd"), (2, signs[10:33]), (3, signs[:20] + chr(0x9F00) + signs[21:40])], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, signs)], "item_id bigint, text string")
    assert {r.doc_id for r in leaks.find_leaks(docs, items).collect()} == {1, 3}


@settings(max_examples=40, deadline=None)
@given(st.data())
def test_every_allowed_change_is_found(data):
    """Any 12 running words with changed ones at least eight apart are found, wherever the changes stand."""
    start = data.draw(st.integers(0, len(WORDS) - 14))
    first = data.draw(st.integers(1, 8))
    n = data.draw(st.integers(12, len(WORDS) - start))
    words = WORDS[start : start + n]
    for k in range(first, n - 1, leaks.APART):
        words[k] = f"changed{k}"
    block = leaks.Items([(1, " ".join(WORDS))])
    assert len(list(block.search([["before", *words, "after"]]))) == 1


def test_blocks_find_all_within_the_radius(monkeypatch):
    rng = np.random.default_rng(1)
    index = leaks.Index.__new__(leaks.Index)
    index.prints = rng.integers(0, 2**63, 400, dtype=np.uint64)
    index.blocks = []
    for b in range(leaks.BLOCKS):
        key = index._key(index.prints, b)
        order = np.argsort(key, kind="stable")
        index.blocks.append((order, np.searchsorted(key[order], np.arange(65537))))
    query = index.prints[rng.integers(0, 400, 300)].copy()
    for _ in range(4):
        query ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    for bound in (7, leaks.CANDIDATES):
        monkeypatch.setattr(leaks, "CANDIDATES", bound)
        assert set(map(tuple, index.near(query).T.tolist())) == _within(index, query)
    assert index.near(query[:0]).shape == (2, 0)


def _within(index, query):
    return {(i, j) for i, q in enumerate(query) for j, p in enumerate(index.prints) if int(q ^ p).bit_count() <= leaks.RADIUS}


def test_why_windows_are_not_as_long_as_items():
    """A changed word moves a twelve-word fingerprint beyond any radius that blocks can serve, and leaves a six-word window beside it alone."""
    rng = np.random.default_rng(4)
    far, near = [], []
    for _ in range(300):
        words = rng.integers(0, 2**63, 24, dtype=np.uint64)
        changed = words.copy()
        changed[[5, 14]] = rng.integers(0, 2**63, 2, dtype=np.uint64)
        for window, out in ((12, far), (6, near)):
            apart = np.bitwise_count(leaks.simhashes(words, window) ^ leaks.simhashes(changed, window))
            out.append(int(apart[:13].min()) if window == 12 else int(apart.min()))
    assert np.median(far) > 2 * leaks.RADIUS and max(near) == 0


def test_slices_hold_bounded_words(monkeypatch):
    monkeypatch.setattr(leaks, "SLICE", 10)
    texts = [["a"] * n for n in (3, 3, 3, 3, 0, 25, 1, 9)]
    got = list(leaks.slices(texts))
    assert [i for a, b in got for i in range(a, b)] == list(range(8)) and got == [(0, 3), (3, 5), (5, 6), (6, 8)]
    assert list(leaks.slices([])) == []


# ---- 9: look-alikes ---------------------------------------------------------------------------------------------


def test_rewriting_is_stable_and_keeps_visible_differences():
    to = lookalikes.Rewriter(lookalikes.representatives())
    same = [
        ("oak tree", chr(0x3BF) + "ak" + NBSP + "tr" + ZWJ + "ee"), ("caf" + chr(0xE9), "cafe" + chr(0x301)), ("AB c", chr(0xFF21) + chr(0xFF22) + chr(0x3000) + chr(0xFF43)),
        ("well-known", "well" + chr(0x2010) + "known"), (chr(0x9762), chr(0x2FAF)), (chr(0x451), chr(0xEB)), ("a b", "a" + chr(0x2007) + "b"), ("office", "o" + chr(0xFB03) + "ce"),
    ]
    for a, b in same:
        assert to(a) == to(b), (a, b)
        assert to(to(b)) == to(b)
    for a, b in [("cafe", "caf" + chr(0xE9)), ("Oak", "oak"), ("o1", "ol"), ("a.", "a"), ("a b", "ab"), ("a\nb", "a b"), (chr(0x1F469) + ZWJ + chr(0x1F373), chr(0x1F469) + chr(0x1F373))]:
        assert to(a) != to(b), (a, b)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aeco " + "".join(map(chr, (0x430, 0x435, 0x3BF, 0x301, 0x308, 0xE9, 0x451, 0x200D, 0xA0, 0xFF21, 0x2FAF, 13, 10))), max_size=12))
def test_forms_are_stable(text):
    to = lookalikes.Rewriter(lookalikes.representatives({"e" + chr(0x301): 5, chr(0x435): 9}))
    assert to(to(text)) == to(text)
    assert unicodedata.normalize("NFC", to(text)) == to(text)


def test_pairs_by_brute_force(spark):
    a, b = "One oak", "One" + NBSP + chr(0x3BF) + "ak"
    texts = [a, b, a, "One Oak", None, "", " ", chr(0x200B), "One o" + SHY + "ak", "x" * 3000, "x" * 2999 + chr(0x445), "tie", "tie"]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, form string, look int")
    to = lookalikes.Rewriter(lookalikes.representatives())
    brute = {(i, j) for (i, x), (j, y) in itertools.combinations(enumerate(texts), 2) if x and y and x != y and to(x) == to(y) and to(x).strip()}
    got = {(r.doc_a, r.doc_b) for r in lookalikes.look_alike_pairs(df).collect()}
    assert got == brute == {(0, 1), (1, 2), (0, 8), (1, 8), (2, 8), (9, 10)}
    assert lookalikes.look_alike_pairs(df.limit(0)).count() == 0
    forms = lookalikes.consistent_text(df)
    assert forms.filter("form is null").count() == 1 and json.dumps(forms.filter("doc_id = 1").first().form) == json.dumps(forms.filter("doc_id = 0").first().form)


def test_hot_texts_and_classes_give_the_same_pairs(spark, monkeypatch):
    odd, texts = chr(0x3BF), ["oo"] * 40 + [chr(0x3BF) + "o"] * 30 + ["o" + chr(0x3BF), chr(0x3BF) * 2, "other", "other"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert odd in texts[40]
    want = {(i, j) for (i, x), (j, y) in itertools.combinations(enumerate(texts[:72]), 2) if x != y}
    members = {r.id: (r.class_id, r.n_texts, r.n_rows) for r in lookalikes.look_alike_members(df).collect()}
    assert members == {i: (0, 4, 72) for i in range(72)}
    for block in (100_000, 3, 1):
        monkeypatch.setattr(lookalikes, "JOIN_BLOCK", block)
        assert {(r.doc_a, r.doc_b) for r in lookalikes.look_alike_pairs(df).collect()} == want


def test_ascii_texts_follow_a_member_of_another_script(spark):
    big, fi = chr(0x423), chr(0xFB01)
    texts = ["Yes", big + "es", (big + " ") * 40, chr(0xDD) + "a", big + chr(0x301) + "a", "fig", fi + "g", (fi + " ") * 9, "affix a" + chr(0x430), "af" + fi + "x aa"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {(r.doc_a, r.doc_b) for r in lookalikes.look_alike_pairs(df).collect()} == {(0, 1), (3, 4), (5, 6), (8, 9)}
    forms = {r.doc_id: r.form for r in lookalikes.consistent_text(df).collect()}
    assert forms[0] == forms[1] == big + "es" and forms[5] == forms[6] == fi + "g"
    assert lookalikes.form_frequencies(df.filter("doc_id in (5, 8)"), "text")["fi"] == 2


def test_arrow_list_of_nothing():
    assert curve_packing._lists([], pa.int32()).to_pylist() == []


# ---- dirt that every operator meets ------------------------------------------------------------------------------


def test_nulls_long_texts_and_repeats_everywhere(spark):
    """Null ids and texts, a very long text, repeated rows and clashing names give defined results and no error."""
    long = "wort " * 200_000
    docs = spark.createDataFrame([(None, None, "x"), (1, long, "x"), (1, long, "x"), (2, "", None), (None, "a cat", "x")], "doc_id bigint, text string, look string")
    items = spark.createDataFrame([(None, "a cat"), (7, None), (8, " ".join(WORDS))], "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in leaks.find_leaks(docs, items).collect()} == {(None, None)}
    assert lookalikes.look_alike_members(docs).count() == 0 == lookalikes.look_alike_members(docs.limit(0)).count()
    assert lookalikes.look_alike_pairs(docs).count() == 0
    ids = bpe.encode_corpus(docs).collect()
    assert len(ids) == 5 and sorted(len(r.ids) for r in ids)[:2] == [0, 0]
    manifest = docs.select(F.col("doc_id").alias("rec_id"), F.lit(None).cast("string").alias("video_path"), F.col("text").alias("value"))
    assert {(r.rec_id, r.first_id, r.n_copies) for r in copies.copy_classes(manifest).collect()} == {(1, 1, 2)}
    assert copies.collapse_copies(manifest).agg(F.sum("n_copies")).first()[0] == 5
    counts = budget.text_counts(manifest.withColumns({"dataset": F.lit(None).cast("string"), "lang": F.lit(None).cast("string"), "domain": F.lit(None).cast("string")}))
    assert budget.token_cube(counts).filter("source = 'unknown' and lang = 'und' and domain = 'unknown'").first().n_records == 5
    pairs = spark.createDataFrame([("packed", None, None, None, None, None), ("packed", 1, 0, None, None, long), ("packed", 2, 0, long, long, "yes"), ("packed", 2, 0, long, long, "yes"), ("packed", 3, 0, "why?", None, "...")], "tab string, rec_id bigint, pair_no bigint, q string, i string, a string")
    assert {(r.rec_id, r.defect) for r in pair_defects.find_defects(pairs).collect()} == {(None, "empty"), (3, "empty")}
    members = spark.createDataFrame([(None, "a", 3), ("x", None, 3), ("y", "a", None), ("z", "a", 0), ("z2", "a", 5)], "item string, source string, size bigint")
    mix = mixture.draw_mix(members, spark.createDataFrame([("a", 1.0, 2), (None, 0.5, 1), ("b", None, None)], "source string, target_share double, max_repeats int"))
    assert {r.source: (r.n_available, r.n_drawn) for r in mix.report.collect()} == {"a": (8, 16), "b": (0, 0)}
    assert sorted((r.item or "", r.n_drawn) for r in mix.drawn.collect()) == [("", 6), ("z2", 10)]
