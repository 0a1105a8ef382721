"""Encoding of the whole corpus with a public byte-level BPE tokenizer (problem 7).

Forced-boundary splitting.  The text is first cut into words by the tokenizer's own pattern.  Inside a
word, a pair of neighbouring bytes that occurs inside no vocabulary token can never be bridged by a
merge, so a cut there is certain: the fragments are encoded independently and their ids concatenated.
Fragments repeat far more often than words do, so each worker keeps those it has met.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words and fragments that a worker keeps; beyond it the store is emptied (speed only, never the result).
MEMORY = 400_000


def default_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def inner_pairs(tokens: Iterable[bytes]) -> np.ndarray:
    """256 x 256 table: whether two bytes stand side by side inside some token."""
    seen = np.zeros((256, 256), dtype=bool)
    for t in tokens:
        b = np.frombuffer(t, dtype=np.uint8)
        seen[b[:-1], b[1:]] = True
    return seen


class Encoder:
    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.core = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.words = regex.compile(pattern).findall
        self.joined = inner_pairs(ranks)
        self.known: dict[str, list[int]] = {}
        self.parts: dict[bytes, list[int]] = {}

    def fragments(self, word: bytes) -> list[bytes]:
        """The word cut at every certain boundary."""
        if len(word) < 2:
            return [word]
        b = np.frombuffer(word, dtype=np.uint8)
        cuts = np.flatnonzero(~self.joined[b[:-1], b[1:]]) + 1
        return [word[i:j] for i, j in zip([0, *cuts], [*cuts, len(word)], strict=True)] if len(cuts) else [word]

    def _word(self, word: str) -> list[int]:
        ids: list[int] = []
        for f in self.fragments(word.encode("utf-8", "surrogatepass")):
            got = self.parts.get(f)
            if got is None:
                got = self.core.encode_single_piece(f)
                if len(f) <= 64:
                    self.parts[f] = got
            ids += got
        if len(self.parts) > MEMORY:
            self.parts.clear()
        return ids

    def __call__(self, text: str | None) -> list[int]:
        """Ids without special tokens (their strings are ordinary text); null and empty give no id."""
        ids: list[int] = []
        known = self.known
        for w in self.words(text or ""):
            got = known.get(w)
            if got is None:
                got = self._word(w)
                if len(w) <= 64:
                    known[w] = got
            ids += got
        if len(known) > MEMORY:
            known.clear()
        return ids


@lru_cache(maxsize=4)
def worker_encoder(path: str, pattern: str) -> Encoder:
    """One per worker process, loaded at first use."""
    return Encoder(path, pattern)


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text: str = "text", vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """(``id_col``, ids array<int>), one row for every row of ``df``; no shuffle.

    Null and empty texts give an empty list.  Other columns of ``df`` are not read.
    """
    path, pat = vocabulary or default_vocabulary(), pattern or default_pattern()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = worker_encoder(path, pat)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([to(t) for t in b.column(1).to_pylist()], pa.list_(pa.int32()))], names=[id_col, "ids"])

    named = df.select(F.col(id_col), F.col(text))
    return named.mapInArrow(encode, f"`{id_col}` {dict(named.dtypes)[id_col]}, ids array<int>")
