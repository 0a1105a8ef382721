"""Evaluation texts leaking into training text (problem 8).

Item-sized windows.  Both the held-out items and the documents are folded (case, accents, marks,
disguised characters) into words and cut into overlapping windows.  The window is as long as the longest
run that must be intact inside any stretch that counts: twelve words with changed ones at least eight
apart always hold six in a row.  Every window gets a 64-bit SimHash of its word pairs.  Four 16-bit blocks
index the item fingerprints: two fingerprints within three bits agree in at least one block, so no pair
within the radius is missed.  Each candidate is then aligned exactly and its stretch weighed: words of an
introductory phrase that several items share count nothing.

The documents are read once per block of items, without a shuffle.  The items go to the workers in blocks
of a bounded number of items; a larger item set makes more blocks, taken one after the other, never a
larger broadcast, and the driver holds one block at a time.  Candidates are looked up for a bounded number
of windows at once, however long a document is.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import unicodedata as ud
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .lookalikes import Classes, look_alike_classes

#: Words of a stretch that counts; ideographic characters of one.
MIN_WORDS, MIN_SIGNS = 12, 24
#: Changed words stand at least so many words apart.
APART = 8
#: Window length in words, and in signs for text of ideographs.
WORDS, SIGNS = 6, 7
#: Hamming radius of the fingerprints; RADIUS + 1 blocks guarantee it.
RADIUS, BLOCKS = 3, 4
#: A changed ideographic word has at most so many signs, on either side.
SIGN_GAP = 4
#: Stretch words beyond a shared introduction that a case needs (signs: twice as many).
OWN_WORDS = 6
#: Items that open with the same words share an introduction if so many of them differ after it.
SHARED = 3
#: Items of one index block, words of one slice of documents, windows of one fingerprint pass, candidates of one look-up.
ITEM_BLOCK, SLICE, PASS, CANDIDATES = 20_000, 100_000, 200_000, 4_000_000

_SIGN = "㐀-䶿一-鿿"
_UNITS = re.compile(f"[{_SIGN}]|[^\\W_{_SIGN}]+")
_IS_SIGN = re.compile(f"[{_SIGN}]")


@lru_cache(maxsize=1)
def fold_table() -> dict[int, str]:
    """Look-alike classes closed under case, as a translation of single case-folded characters."""
    sets = Classes()
    for members in look_alike_classes():
        single = [m.casefold() for m in members if len(m.casefold()) == 1]
        for m in single[1:]:
            sets.join(single[0], m)
    table: dict[int, str] = {}
    for members in sets.members():
        best = min(members, key=lambda s: (not s.isascii(), s))
        table |= {ord(m): best for m in members if m != best}
    gone = next(m for m in look_alike_classes() if "" in m)
    marks = {n: "" for n in range(0x300, 0x370)}
    return table | {ord(c): "" for c in gone if c} | marks


def units(text: str) -> list[str]:
    """Words of a folded text; every ideographic sign is a unit of its own."""
    return _UNITS.findall(ud.normalize("NFKD", text).casefold().translate(fold_table()))


@lru_cache(maxsize=1_000_000)
def unit_hash(unit: str) -> int:
    return int.from_bytes(hashlib.blake2b(unit.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _pair_hashes(h: np.ndarray) -> np.ndarray:
    x = (h[:-1] ^ (h[1:] << np.uint64(31) | h[1:] >> np.uint64(33))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def simhashes(h: np.ndarray, window: int) -> np.ndarray:
    """64-bit SimHash of each window of ``window`` units: the majority bits of its pairs (an odd number of them)."""
    pairs, n = _pair_hashes(h), len(h) - window + 1
    out = np.empty(max(n, 0), dtype=np.uint64)
    for at in range(0, n, PASS):
        part = pairs[at : at + PASS + window - 2]
        bits = np.unpackbits(part.view(np.uint8)).reshape(len(part), 64)
        m = min(PASS, n - at)
        votes = bits[:m].copy()
        for k in range(1, window - 1):
            votes += bits[k : k + m]
        out[at : at + m] = np.packbits(votes > (window - 1) // 2, axis=1).view(np.uint64).ravel()
    return out


class Index:
    """Fingerprints of the windows of some items, found again within the radius through their blocks."""

    def __init__(self, items: list[tuple[int, list[int]]], window: int):
        prints, owner, at = [np.empty(0, np.uint64)], [], []
        for k, (_, h) in enumerate(items):
            f = simhashes(np.array(h, dtype=np.uint64), window)
            prints.append(f)
            owner += [k] * len(f)
            at += range(len(f))
        self.window, self.prints = window, np.concatenate(prints)
        self.owner, self.at = np.array(owner, dtype=np.int64), np.array(at, dtype=np.int64)
        self.blocks = []
        for b in range(BLOCKS):
            key = self._key(self.prints, b)
            order = np.argsort(key, kind="stable")
            self.blocks.append((order, np.searchsorted(key[order], np.arange(65537))))

    @staticmethod
    def _key(prints: np.ndarray, b: int) -> np.ndarray:
        return (prints >> np.uint64(16 * b) & np.uint64(0xFFFF)).astype(np.int64)

    def near(self, prints: np.ndarray) -> np.ndarray:
        """(query position, index position) of all pairs within the radius, each once; CANDIDATES of them are looked at at a time."""
        found = [np.empty((2, 0), np.int64)]
        for b, (order, ends) in enumerate(self.blocks):
            key = self._key(prints, b)
            first, n = ends[key], ends[key + 1] - ends[key]
            total = np.cumsum(n)
            cuts = np.searchsorted(total, np.arange(0, total[-1] if len(total) else 0, CANDIDATES), side="right")
            for lo, hi in itertools.pairwise([*np.unique(cuts).tolist(), len(prints)]):
                m = n[lo:hi]
                query = np.repeat(np.arange(lo, hi), m)
                step = np.arange(len(query)) - np.repeat(np.cumsum(m) - m, m)
                hit = order[np.repeat(first[lo:hi], m) + step]
                close = np.bitwise_count(prints[query] ^ self.prints[hit]) <= RADIUS
                found.append(np.stack([query[close], hit[close]]))
        return np.unique(np.concatenate(found, axis=1), axis=1)


@dataclass(frozen=True)
class Stretch:
    """Where an item's units stand in a document: item units [first, last), ``own`` of them its own."""

    first: int
    last: int
    size: int
    own: int


def _run(a: list, b: list, i: int, j: int, step: int) -> int:
    n = 0
    while 0 <= i < len(a) and 0 <= j < len(b) and a[i] == b[j]:
        i, j, n = i + step, j + step, n + 1
    return n


def _grow(a: list, b: list, i: int, j: int, step: int, intact: int, signs: bool) -> tuple[int, int]:
    """From an intact run of ``intact`` units that ends before a[i], b[j] on, over changed words and further runs.

    Returns the units of b gained and the last run's length.  A change is passed only if the run before it
    leaves changed words APART (the first run is given as a whole, so its own other end is free).
    """
    gained, run, free = 0, intact, True
    gaps = [(1, 1)] if not signs else sorted(((x, y) for x in range(SIGN_GAP + 1) for y in range(SIGN_GAP + 1) if x + y), key=lambda g: (abs(g[0] - g[1]), g))
    while True:
        if not free and run < APART - 1:
            return gained, run
        best = (0, 0, 0)
        for x, y in gaps:
            n = _run(a, b, i + step * x, j + step * y, step)
            if n > best[0] and (not signs or n >= SIGN_GAP):
                best = (n, x, y)
                if x == y and n >= SIGNS:
                    break
        n, x, y = best
        if not n:
            return gained, run
        gained, run, free = gained + y + n, n, False
        i, j = i + step * (x + n), j + step * (y + n)


def align(doc: list, item: list, i: int, j: int, intro: int, signs: bool, size: list[int]) -> Stretch:
    """The stretch around the run that holds doc[i] == item[j]; ``size`` is each item unit's length as counted."""
    back, ahead = _run(doc, item, i - 1, j - 1, -1), _run(doc, item, i, j, 1)
    run = back + ahead
    before, _ = _grow(doc, item, i - back - 1, j - back - 1, -1, run, signs)
    # a change on either side of the first run is fine only if that run keeps the changes apart
    after, _ = _grow(doc, item, i + ahead, j + ahead, 1, run, signs) if not before or signs or run >= APART - 1 else (0, 0)
    first, last = j - back - before, j + ahead + after
    if before and not after and not signs and run < APART - 1:
        other, _ = _grow(doc, item, i + ahead, j + ahead, 1, run, signs)
        if other > before:
            first, last = j - back, j + ahead + other
    return Stretch(first, last, sum(size[first:last]), sum(size[max(first, intro) : last]))


class Items:
    """One block of items, ready to be searched for in documents."""

    def __init__(self, rows: list[tuple[int, str | None]], intros: list[int] | None = None):
        self.ids, self.units, self.signs, self.size, self.intro = [], [], [], [], []
        for (item, text), intro in zip(rows, intros or [0] * len(rows), strict=True):
            u = units(text or "")
            if u:
                self.intro.append(intro)
                signs = sum(1 for x in u if _IS_SIGN.match(x)) * 2 > len(u)
                self.ids.append(item)
                self.units.append(u)
                self.signs.append(signs)
                self.size.append([len(x) if signs else 1 for x in u])
        hashed = [[unit_hash(x) for x in u] for u in self.units]
        self.index = {}
        for window, want in ((WORDS, False), (SIGNS, True)):
            chosen = [k for k, s in enumerate(self.signs) if s is want and len(self.units[k]) >= window]
            if chosen:
                self.index[window] = (Index([(k, hashed[k]) for k in chosen], window), np.array(chosen))
        self.short = defaultdict(list)  # items shorter than a window: found whole, by their first unit
        for k, u in enumerate(self.units):
            if len(u) < (SIGNS if self.signs[k] else WORDS):
                self.short[u[0]].append(k)

    def _counts(self, k: int, s: Stretch) -> bool:
        least, own = (MIN_SIGNS, 2 * OWN_WORDS) if self.signs[k] else (MIN_WORDS, OWN_WORDS)
        return (s.size >= least and s.own >= own) or (s.first == 0 and s.last == len(self.units[k]) and (s.own > 0))

    def search(self, docs: list[list[str]]) -> Iterator[tuple[int, int, Stretch]]:
        """(position of the document, position of the item, its longest stretch) of every case."""
        best: dict[tuple[int, int], Stretch] = {}
        sizes = np.array([len(d) for d in docs])
        ends = np.cumsum(sizes)
        flat = np.fromiter((unit_hash(x) for d in docs for x in d), dtype=np.uint64, count=int(ends[-1]) if len(ends) else 0)
        owner = np.repeat(np.arange(len(docs)), sizes)
        for window, (index, chosen) in self.index.items():
            if len(flat) < window:
                continue
            prints = simhashes(flat, window)
            inside = np.flatnonzero(owner[: len(prints)] == owner[window - 1 :])
            query, hit = index.near(prints[inside])
            at, item = inside[query], chosen[index.owner[hit]]
            doc = owner[at]
            i, j = at - (ends - sizes)[doc], index.at[hit]
            shift = i - j
            order = np.lexsort((i, shift, item, doc))
            last, seen = None, -1
            for d, k, s, x in zip(doc[order].tolist(), item[order].tolist(), shift[order].tolist(), i[order].tolist(), strict=True):
                if (d, k, s) == last and x <= seen:
                    continue
                u, v = docs[d], self.units[k]
                start = next((t for t in range(window) if u[x + t] == v[x - s + t]), None)
                if start is None:
                    continue
                got = align(u, v, x + start, x - s + start, self.intro[k], self.signs[k], self.size[k])
                last, seen = (d, k, s), got.last + s - window
                if self._counts(k, got) and ((d, k) not in best or got.size > best[d, k].size):
                    best[d, k] = got
        if self.short:
            for d, u in enumerate(docs):
                for x, w in enumerate(u):
                    for k in self.short.get(w, ()):
                        v = self.units[k]
                        if u[x : x + len(v)] == v and (d, k) not in best:
                            whole = Stretch(0, len(v), sum(self.size[k]), sum(self.size[k][self.intro[k] :]))
                            if self._counts(k, whole):
                                best[d, k] = whole
        for (d, k), s in best.items():
            yield d, k, s


def _opening_hashes(u: list[str]) -> Iterator[int]:
    """A hash of each opening of a text, shortest first."""
    h = b""
    for x in u:
        h = hashlib.blake2b(h + x.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        yield int.from_bytes(h, "little", signed=True)


def introductions(asked: DataFrame) -> DataFrame:
    """(item, text, intro): units of each item's longest shared opening that introduces it, over all items.

    An opening is shared if SHARED or more different item texts part after it; equal texts count once.  It
    introduces an item if it is no longer than what follows it: a longer one is a passage that several items ask
    about, and counts.  Null texts have no introduction.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                opening, then, text, place, half = [], [], [], [], []
                for t in b.slice(at, 1000).column(0).to_pylist():
                    h = list(_opening_hashes(u := units(t or "")))
                    opening += h
                    then += [*u[1:], ""] if u else []
                    text += [t] * len(h)
                    place += range(1, len(h) + 1)
                    half += [len(h) // 2] * len(h)
                columns = [pa.array(opening, pa.int64()), pa.array(then, pa.string()), pa.array(text, pa.string()), pa.array(place, pa.int32()), pa.array(half, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["opening", "then", "text", "place", "half"])

    texts = asked.select(F.col("words").alias("text")).filter("text is not null").distinct()
    rows = materialize(texts.mapInArrow(cut, "opening bigint, then string, text string, place int, half int").withColumn("whole", F.xxhash64("text")).drop("text"), "openings")
    parted = rows.groupBy("opening").agg(F.count_distinct("whole").alias("texts"), F.count_distinct("then").alias("ways")).filter((F.col("texts") >= SHARED) & (F.col("ways") > 1))
    own = rows.filter("place <= half").join(parted.select("opening"), "opening", "left_semi").groupBy("whole").agg(F.max("place").alias("intro"))
    return asked.withColumn("whole", F.xxhash64("words")).join(own, "whole", "left").select("item", "words", F.coalesce("intro", F.lit(0)).alias("intro"))


OUT = "doc_id {kind}, item_id {item}, n_units int, whole boolean"


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", item_block: int = ITEM_BLOCK) -> DataFrame:
    """(doc_id, item_id, n_units, whole): every document with every item that it holds wholly or in part.

    A part is a stretch of the item of at least 12 running words (24 signs of ideographic text), single words
    in it changed if at least eight words apart, of which at least 6 (12) are not a shared introduction.
    ``n_units`` is the length of the longest stretch, ``whole`` whether it is the whole item.  Null and empty
    texts, on either side, match nothing.  Each pair comes once however often the row pair matches; a doc_id
    that stands on several rows is reported once per row.
    """
    asked = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("words"))
    blocks = max(1, -(-asked.count() // item_block))
    named = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("words")).filter(F.col("words").isNotNull())
    schema = OUT.format(kind=dict(named.dtypes)["doc"], item=dict(asked.dtypes)["item"])
    told = materialize(introductions(asked), "items")
    out = None
    for b in range(blocks):
        rows = told.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == b).collect()  # about item_block of them
        found, sent = _scan(named, [(r["item"], r["words"]) for r in rows], [r["intro"] for r in rows], schema)
        if blocks > 1:  # done with a block before the next one is fetched
            found = materialize(found, "leaks")
            sent.destroy()
        out = found if out is None else out.unionByName(found)
    return out


_blocks: dict[int, Items] = {}


def _worker_block(number: int, sent: Broadcast) -> Items:
    """The index of a block of items, built once per worker process."""
    if number not in _blocks:
        _blocks.clear()
        _blocks[number] = Items(*sent.value)
    return _blocks[number]


def slices(texts: list[list[str]]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about SLICE words together; a longer text is a run of its own."""
    start = held = 0
    for i, u in enumerate(texts):
        if held and held + len(u) > SLICE:
            yield start, i
            start, held = i, 0
        held += len(u)
    if start < len(texts):
        yield start, len(texts)


def _scan(named: DataFrame, rows: list[tuple[int, str | None]], intros: list[int], schema: str) -> tuple[DataFrame, Broadcast]:
    """One block of items against all documents; a worker builds the block's index once."""
    sent = named.sparkSession.sparkContext.broadcast((rows, intros))
    names = [c.split()[0] for c in schema.split(", ")]
    number = uuid.uuid4().int

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _worker_block(number, sent)
        for b in batches:
            texts = [units(t) for t in b.column(1).to_pylist()]
            for start, end in slices(texts):
                cases = list(block.search(texts[start:end]))
                if cases:
                    yield pa.RecordBatch.from_arrays(
                        [
                            b.column(0).take(pa.array([start + d for d, _, _ in cases])),
                            pa.array([block.ids[k] for _, k, _ in cases]),
                            pa.array([s.last - s.first for _, _, s in cases], pa.int32()),
                            pa.array([s.last - s.first == len(block.units[k]) for _, k, s in cases], pa.bool_()),
                        ],
                        names=names,
                    )

    return named.mapInArrow(scan, schema), sent
