"""Tokenizers over special tokens and ordinary text.

A tokenizer is a policy: which strings are special, which ids they have, and how the text between them is
encoded.  ``WordTokenizer`` is a JVM-side expression; the sentence-piece ones load their model once per worker
and run in Arrow batches.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import cached_property, lru_cache
from typing import Protocol, runtime_checkable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOS, EOS = 1, 2
# Ids of the image tokens that follow a vocabulary of 32,000 pieces.
IM_PATCH, IM_START, IM_END = 32000, 32001, 32002
IMAGE_TOKENS = ("<im_patch>", "<im_start>", "<im_end>")
# Further tokens of the dream and chat vocabularies.
DREAM_TOKENS = ("<dream>", "<dream_start>", "<dream_end>")
CHAT_TOKENS = ("<|BOT|>", "<|EOT|>", "<|CALL_START|>", "<|CALL_END|>", "<|THINK_START|>", "<|THINK_END|>", "<|IMG_START|>", "<|IMG_END|>")


def padded_vocab_size(n: int, divisible_by: int = 128, parallel: int = 1) -> int:
    """``n`` rounded up to a multiple of ``divisible_by * parallel``."""
    m = divisible_by * parallel
    return math.ceil(n / m) * m


def padded_vocab_size_col(n: Column, divisible_by: int = 128, parallel: int = 1) -> Column:
    m = divisible_by * parallel
    return (F.ceil(n / m) * m).cast("bigint")


def split_special(text: str, special: list[str]) -> list[str]:
    """Cut at the earliest special token, again and again; of several at one place the first listed wins."""
    if not special:
        return [text] if text else []
    pattern = "|".join(re.escape(s) for s in special)
    return [p for p in re.split(f"({pattern})", text) if p]


def split_special_col(text: Column, special: list[str]) -> Column:
    """The same as an expression: special tokens and the gaps between them, in order; null and empty give no part."""
    alt = "|".join(r"\Q" + s + r"\E" for s in special)
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"(?s)({alt}|(?:(?!{alt}).)+)"), 1), F.array().cast("array<string>"))


@runtime_checkable
class Tokenizer(Protocol):
    """What the jobs need of a tokenizer: ids of a text, and of each text of a list."""

    def ids(self, text: Column) -> Column: ...

    def ids_of_list(self, texts: Column) -> Column: ...


WORD_SPECIAL = (("<unk>", 0), ("<s>", BOS), ("</s>", EOS), ("<im_patch>", IM_PATCH), ("<im_start>", IM_START), ("<im_end>", IM_END))


@dataclass(frozen=True)
class WordTokenizer:
    """Words and single marks; ids by a portable hash below those of the image tokens.  JVM-side only."""

    special: tuple[tuple[str, int], ...] = WORD_SPECIAL
    buckets: int = 30_000

    def words(self, text: Column) -> Column:
        alt = "|".join(r"\Q" + s + r"\E" for s, _ in self.special)
        return F.coalesce(F.regexp_extract_all(text, F.lit(rf"({alt}|[\p{{L}}\p{{N}}]+|[^\s\p{{L}}\p{{N}}])"), 1), F.array().cast("array<string>"))

    def id_of(self, word: Column) -> Column:
        ids = F.create_map(*[x for s, i in self.special for x in (F.lit(s), F.lit(i))])
        hashed = F.conv(F.substring(F.md5(word.cast("binary")), 1, 8), 16, 10).cast("bigint") % self.buckets + 3
        return F.coalesce(F.try_element_at(ids, word), hashed.cast("int"))

    def ids(self, text: Column) -> Column:
        return F.transform(self.words(text), self.id_of)

    def ids_of_list(self, texts: Column) -> Column:
        return F.transform(texts, self.ids)


@lru_cache(maxsize=8)
def _pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@dataclass(frozen=True)
class PieceTokenizer:
    """A sentence-piece model with special tokens cut out first.

    ``policy``: 'appended' adds begin, end, unknown and the image and dream tokens, with new ids where the model
    lacks them; 'control' takes the model's own control and unknown pieces and appends the image tokens, as the
    32,000-piece multimodal vocabulary has them; 'chat' adds the chat tokens and otherwise encodes plainly.
    """

    model: str
    policy: str = "control"

    @cached_property
    def special(self) -> dict[str, int]:
        sp = _pieces(self.model)
        known = {sp.id_to_piece(i): i for i in range(sp.get_piece_size())}
        own = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if sp.is_control(i) or sp.is_unknown(i)}
        wanted = {"appended": ("<s>", "</s>", "<unk>", *IMAGE_TOKENS, *DREAM_TOKENS), "control": (*own, *IMAGE_TOKENS), "chat": (*own, *CHAT_TOKENS)}[self.policy]
        out, free = {}, sp.get_piece_size()
        for t in dict.fromkeys(wanted):
            if t in known:
                out[t] = known[t]
            else:
                out[t], free = free, free + 1
        return out

    @property
    def vocab_size(self) -> int:
        return max(_pieces(self.model).get_piece_size(), 1 + max(self.special.values()))

    bos_token_id = property(lambda self: _pieces(self.model).bos_id())
    eos_token_id = property(lambda self: _pieces(self.model).eos_id())
    eod = property(lambda self: self.eos_token_id)
    unk = property(lambda self: _pieces(self.model).unk_id())
    pad = cls = sep = mask = unk

    # None where the policy has no such token
    im_patch_token_id = property(lambda self: self.special.get("<im_patch>"))
    im_start_token_id = property(lambda self: self.special.get("<im_start>"))
    im_end_token_id = property(lambda self: self.special.get("<im_end>"))
    dream_token_id = property(lambda self: self.special.get("<dream>"))
    dream_start_token_id = property(lambda self: self.special.get("<dream_start>"))
    dream_end_token_id = property(lambda self: self.special.get("<dream_end>"))
    bot_token_id = property(lambda self: self.special.get("<|BOT|>"))
    eot_token_id = property(lambda self: self.special.get("<|EOT|>"))
    call_start_token_id = property(lambda self: self.special.get("<|CALL_START|>"))
    call_end_token_id = property(lambda self: self.special.get("<|CALL_END|>"))
    think_start_token_id = property(lambda self: self.special.get("<|THINK_START|>"))
    think_end_token_id = property(lambda self: self.special.get("<|THINK_END|>"))
    img_start_token_id = property(lambda self: self.special.get("<|IMG_START|>"))
    img_end_token_id = property(lambda self: self.special.get("<|IMG_END|>"))

    def token_id(self, token: str) -> int:
        """Id of a special token; unknown ones are an error."""
        return self.special[token]

    def is_special(self, i: int) -> bool:
        return i in self.special.values()

    def special_text(self, i: int) -> str:
        """The special token of an id, empty for any other id."""
        return next((t for t, n in self.special.items() if n == i), "")

    def tokenize(self, text: str | None) -> list[int]:
        sp, ids = _pieces(self.model), []
        for part in split_special(text or "", list(self.special)):
            ids += [self.special[part]] if part in self.special else sp.encode(part)
        return ids

    def detokenize(self, ids: list[int]) -> str:
        """Runs of pieces decoded, special tokens set off by blanks, the whole trimmed."""
        sp, names, out, run = _pieces(self.model), {i: t for t, i in self.special.items()}, [], []
        for i in ids:
            if i in names:
                out += [sp.decode(run), f" {names[i]} "]
                run = []
            elif 0 <= i < sp.get_piece_size():
                run.append(int(i))
        return "".join([*out, sp.decode(run)]).strip()

    def ids(self, text: Column) -> Column:
        me = self

        @F.arrow_udf(T.ArrayType(T.IntegerType()))
        def encode(texts: pa.Array) -> pa.Array:
            return pa.array([me.tokenize(t) for t in texts.to_pylist()], pa.list_(pa.int32()))

        return encode(text)

    def ids_of_list(self, texts: Column) -> Column:
        """Ids of each text of ARRAY<STRING>; a null text has none."""
        me = self

        @F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
        def encode(lists: pa.Array) -> pa.Array:
            return pa.array([None if x is None else [me.tokenize(t) for t in x] for x in lists.to_pylist()], pa.list_(pa.list_(pa.int32())))

        return encode(texts)

    def text(self, ids: Column) -> Column:
        me = self

        @F.arrow_udf(T.StringType())
        def decode(lists: pa.Array) -> pa.Array:
            return pa.array([None if x is None else me.detokenize(x) for x in lists.to_pylist()], pa.string())

        return decode(ids)


def make_tokenizer(name: str) -> Tokenizer:
    """'word', or POLICY:PATH of a sentence-piece model, e.g. ``control:/models/pieces.model``."""
    if name == "word":
        return WordTokenizer()
    policy, colon, path = name.partition(":")
    if not colon or policy not in ("appended", "control", "chat"):
        raise ValueError(f"{name!r} is neither word nor POLICY:PATH with appended, control or chat")
    return PieceTokenizer(path, policy)


def conversation_ids(turns: Column, tokenizer: Tokenizer) -> Column:
    """ARRAY<STRUCT<ids, mask>> parts, one per turn; 0 masks human and system turns, an answering turn ends with ``</s>``.

    Line ends between turns are not tokenized.
    """
    value = lambda t: F.concat(F.coalesce(t["value"], F.lit("")), F.when(t["from"] == "gpt", "</s>").otherwise(""))
    silent = lambda t: F.when(t["from"].isin("human", "system"), 0).otherwise(1)
    return F.zip_with(turns, tokenizer.ids_of_list(F.transform(turns, value)), lambda t, ids: F.struct(ids.alias("ids"), F.array_repeat(silent(t), F.size(ids)).alias("mask")))


def input_ids(parts: Column) -> Column:
    return F.concat(F.array(F.lit(BOS)), F.flatten(F.transform(parts, lambda p: p["ids"])))


def loss_mask(parts: Column) -> Column:
    return F.concat(F.array(F.lit(0)), F.flatten(F.transform(parts, lambda p: p["mask"])))
