"""Conversations as ARRAY<STRUCT<from, value>>: building, splitting, media tokens.  All JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IMAGE, VIDEO = "<image>", "<video>"
PATCHES = 256
#: One image in token space: start, 256 patches, end.
IMAGE_BLOCK = "<im_start>" + "<im_patch>" * PATCHES + "<im_end>"
# Captions that hold one of these say nothing about the clip.
BLACK_WORDS = ("image unavailable", ".com", ".jpg", ".pdf", ".jpeg", "png", "tiff", "svg")
TURNS = "array<struct<`from`:string,value:string>>"


def turn(role: Column | str, value: Column) -> Column:
    return F.struct((F.lit(role) if isinstance(role, str) else role).alias("from"), value.alias("value"))


def normal_role(role: Column) -> Column:
    """user/human -> human, assistant/gpt -> gpt, anything else trimmed and in lower case."""
    r = F.lower(F.trim(role))
    return F.when(r.isin("user", "human"), "human").when(r.isin("assistant", "gpt"), "gpt").otherwise(r)


def normal_turns(turns: Column) -> Column:
    return F.transform(turns, lambda t: turn(normal_role(t["from"]), t["value"]))


def default_conversation(human: Column, answer: Column) -> Column:
    return F.array(turn("human", human), turn("gpt", answer))


def question_of(entries: Column) -> Column:
    """All values but that of key ``a``, in the order of the entries (ARRAY<STRUCT<key, value>>)."""
    kept = F.filter(entries, lambda e: e["key"] != "a")
    return F.array_join(F.transform(kept, lambda e: e["value"]), "")


def question_of_map(pair: Column) -> Column:
    """The same for a map, in the order of its entries, which is that of the JSON or the file it was read from."""
    return question_of(F.map_entries(pair))


def chat_turns(pairs: Column, media: str = IMAGE, count: Column | int = 1) -> Column:
    """Alternating turns of question-answer maps; media tokens stand after the first question only.

    A missing answer becomes an empty one.
    """
    n = F.lit(count) if isinstance(count, int) else count
    tokens = F.repeat(F.lit(media), n.cast("int"))
    return F.flatten(
        F.transform(
            pairs,
            lambda p, i: F.array(
                turn("human", F.concat(question_of_map(p), F.when(i == 0, tokens).otherwise(""))),
                turn("gpt", F.coalesce(F.try_element_at(p, F.lit("a")), F.lit(""))),
            ),
        )
    )


def image_prompt(images: Column) -> Column:
    return F.repeat(F.lit(IMAGE), F.greatest(F.size(images), F.lit(0)))


def keyframe_prompt(steps: Column, kinds: Column) -> Column:
    """``<Iimage>#step`` or ``<Pimage>#step`` per key frame, in order, over the shorter of both arrays."""
    pairs = F.slice(F.arrays_zip(steps.alias("s"), kinds.alias("k")), 1, F.least(F.size(steps), F.size(kinds)))
    return F.array_join(F.transform(pairs, lambda p: F.concat(F.lit("<"), p["k"], F.lit("image>#"), p["s"].cast("string"))), "")


def prompts(turns: Column) -> Column:
    """Values of the human turns at even places."""
    return F.transform(F.filter(turns, lambda t, i: (i % 2 == 0) & (t["from"] == "human")), lambda t: t["value"])


def replies(turns: Column) -> Column:
    """Values of the answering turns at odd places."""
    return F.transform(F.filter(turns, lambda t, i: (i % 2 == 1) & (t["from"] == "gpt")), lambda t: t["value"])


def zip_turns(questions: Column, answers: Column) -> Column:
    """Alternating turns; the longer array is cut to the shorter."""
    n = F.least(F.size(questions), F.size(answers))
    return F.flatten(F.zip_with(F.slice(questions, 1, n), F.slice(answers, 1, n), lambda q, a: F.array(turn("human", q), turn("gpt", a))))


def frame_questions(text: Column) -> Column:
    """STRUCT<questions, answers> of frame-tagged captions, null where they cannot be cut.

    Runs of adjacent image tags belong to the time tag that follows them; each such run with its time is a
    question and the text up to the next one its answer.  ``Summary this video.`` is asked last; the last answer
    must hold exactly one ``Summary:``, which parts the two.
    """
    tag = r"(?:<image>)+#+\d+(?:\.\d+)?(?:-\d+\.\d+)?#"
    asked = F.regexp_extract_all(text, F.lit(f"({tag})"), 1)
    parts = F.split(text, tag)
    told = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    last = F.split(F.try_element_at(told, F.lit(-1)), "Summary:")
    answers = F.concat(F.slice(told, 1, F.greatest(F.size(told) - 1, F.lit(0))), last)
    whole = (F.size(asked) > 0) & (F.size(last) == 2)
    return F.when(whole, F.struct(F.concat(asked, F.array(F.lit("Summary this video."))).alias("questions"), answers.alias("answers")))


# The media tags of each kind of sample that stand for an image.
MEDIA_TAGS = {"kf": ("<Iimage>", "<Pimage>"), "un": (IMAGE,), "merlin-s": ()}


def expand_image_tokens(text: Column, kind: str = "un") -> Column:
    """Media tags of a text in token space, by sample kind: 'kf' key frames, 'un' images, 'merlin-s' unchanged."""
    if kind not in MEDIA_TAGS:
        raise ValueError(f"unknown sample kind {kind!r}")
    for t in MEDIA_TAGS[kind]:
        text = F.replace(text, F.lit(t), F.lit(IMAGE_BLOCK))
    return text


def image_tags(text: Column, tags: tuple[str, ...] = (IMAGE,)) -> Column:
    """Number of image tags and of blocks already in token space."""
    n = F.lit(0)
    for t in (*tags, IMAGE_BLOCK):
        n = n + F.coalesce(((F.length(text) - F.length(F.replace(text, F.lit(t), F.lit("")))) / len(t)).cast("int"), F.lit(0))
    return n


def human_image_tags(turns: Column, kind: str = "un") -> Column:
    """Images that the human turns stand for, by the tags of a sample kind."""
    return F.aggregate(F.filter(turns, lambda t: t["from"] == "human"), F.lit(0), lambda n, t: n + image_tags(t["value"], MEDIA_TAGS[kind] or (IMAGE,)))


def expand_turns(turns: Column, kind: str = "un") -> Column:
    """Image tags of the human turns in token space, other turns unchanged; turns of merlin-s follow the rule of 'un'."""
    rule = kind if MEDIA_TAGS[kind] else "un"
    return F.transform(turns, lambda t: turn(t["from"], F.when(t["from"] == "human", expand_image_tokens(t["value"], rule)).otherwise(t["value"])))


def render(turns: Column) -> Column:
    """``<s>``, then the turns' values, an answering one closed by ``</s>``, joined by line ends between turns."""
    body = F.transform(turns, lambda t: F.concat(F.coalesce(t["value"], F.lit("")), F.when(t["from"] == "gpt", "</s>").otherwise("")))
    return F.concat(F.lit("<s>"), F.array_join(body, "\n"))


def has_black_word(caption: Column) -> Column:
    low = F.lower(caption)
    out = F.lit(False)
    for w in BLACK_WORDS:
        out = out | low.contains(w)
    return F.coalesce(out, F.lit(False))
