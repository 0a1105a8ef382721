"""Visually identical text with different characters (problem 9).

Look-alike strings and code points are joined into transitive classes by union-find; each class is
represented by the member that the corpus uses most; texts are rewritten greedily (leftmost, longest)
by a multi-pattern automaton.  Two texts look the same exactly if their rewritten forms are equal.
"""

from __future__ import annotations

import re
import unicodedata as ud
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import HOT_KEYS, attach_stats
from ..runtime import materialize

# Letters of other scripts that are drawn like a Latin letter, Latin letter first.
LATIN_TWINS = (
    "aаɑα", "cсϲ", "dԁ", "eе", "gɡ", "hһ", "iіι", "jјϳ", "lӏӀ", "oоο", "pрρ", "qԛ", "sѕ", "vѵ", "wԝ", "xх", "yуγ",
    "AАΑ", "BВΒ", "CСϹ", "DԀ", "EЕΕ", "GԌ", "HНΗ", "IІΙ", "JЈͿ", "KКΚ", "MМΜ", "NΝ", "OОΟ", "PРΡ", "QԚ", "SЅ", "TТΤ", "VѴ", "WԜ", "XХΧ", "YҮΥУ", "ZΖ",
)
# Letters of two other scripts that are drawn alike, with no Latin one beside them.
OTHER_TWINS = ("ФΦ", "фφ", "ГΓ", "ПΠ", "кκ", "εє")
# Code points drawn as nothing inside running text.
INVISIBLE = "\u00ad\u034f\u061c\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufe00\ufe01\ufe02\ufe03\ufe04\ufe05\ufe06\ufe07\ufe08\ufe09\ufe0a\ufe0b\ufe0c\ufe0d\ufe0e\ufe0f\ufeff"
# Code points drawn as one blank; as one hyphen.
BLANKS = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
HYPHENS = "-\u2010\u2011"
#: Compatibility kinds whose members are drawn like what they stand for.
SAME_SHAPE = ("<wide>", "<narrow>", "<noBreak>")
#: Scripts whose composed letters get classes (canonical composition itself covers the others).
COMPOSED = ((0x00C0, 0x0250), (0x0370, 0x0400), (0x0400, 0x0530), (0x1E00, 0x2000))
EMOJI = "\U0001f000-\U0001faff\u2600-\u27bf"
_JOINED_EMOJI = re.compile(f"(?<=[{EMOJI}\ufe0f])\u200d(?=[{EMOJI}])")
_MARKED = re.compile("[^\\W\\d][\u0300-\u036f]+")
#: Rows of one text or class that one task of a join gets at most (about).
JOIN_BLOCK = 100_000
_MARKS = re.compile("[\u0300-\u036f]+")
_KEEP = "\ue000"  # stands for the joiner of an emoji sequence, which is visible, while invisible ones go


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.up: dict[str, str] = {}

    def find(self, s: str) -> str:
        root = s
        while (p := self.up.get(root, root)) != root:
            root = p
        while (p := self.up.get(s, s)) != root:
            self.up[s], s = root, p
        return root

    def join(self, a: str, b: str) -> None:
        self.up.setdefault(a, a)
        self.up.setdefault(b, b)
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[b] = a

    def members(self) -> list[list[str]]:
        by: dict[str, list[str]] = defaultdict(list)
        for s in self.up:
            by[self.find(s)].append(s)
        return list(by.values())


def _pairs() -> Iterator[tuple[str, str]]:
    for twins in (*LATIN_TWINS, *OTHER_TWINS, BLANKS, HYPHENS):
        yield from ((twins[0], x) for x in twins[1:])
    yield from (("", x) for x in INVISIBLE)
    yield from (("\n", x) for x in ("\r\n", "\r", "\u2028", "\u2029"))
    for n in (*range(0x2E80, 0x2FE0), *range(0x3000, 0x3001), *range(0x2100, 0x214F), *range(0xF900, 0xFB07), *range(0xFF01, 0xFFE7), *range(0x2F800, 0x2FA1E)):
        kind, *to = ud.decomposition(c := chr(n)).split() or [""]
        if to or kind:
            singleton = not kind.startswith("<")
            radical, ligature = 0x2E80 <= n < 0x2FE0, 0xFB00 <= n < 0xFB07
            if singleton or kind in SAME_SHAPE or radical or ligature:
                yield ud.normalize("NFKC", c), c
    bases = {x: twins[0] for twins in LATIN_TWINS for x in twins}
    for lo, hi in COMPOSED:
        for n in range(lo, hi):
            c = chr(n)
            full = ud.normalize("NFD", c)
            if len(full) > 1:
                yield c, full
                if full[0] in bases:
                    yield c, ud.normalize("NFC", bases[full[0]] + full[1:])
            elif full != c:
                yield full, c


def look_alike_classes() -> list[list[str]]:
    """Transitive classes of strings that are drawn alike; the empty string is the class of the invisible."""
    sets = Classes()
    for a, b in _pairs():
        sets.join(a, b)
    return sorted(sorted(m) for m in sets.members())


def _plain(s: str) -> tuple:
    return (not s.isascii(), ud.normalize("NFKC", s) != s, len(s), s)


def representatives(frequency: dict[str, int] | None = None) -> dict[str, str]:
    """Each class member -> the member used most (ties, and no counts: ASCII first, then shortest, then smallest)."""
    seen = frequency or {}
    out = {}
    for members in look_alike_classes():
        best = "" if "" in members else min(members, key=lambda s: (-seen.get(s, 0), *_plain(s)))
        out |= {s: best for s in members if s != best}
    return out


class Greedy:
    """Leftmost-longest replacement of the strings of a table."""

    def __init__(self, table: dict[str, str]):
        self.single = {ord(k): v for k, v in table.items() if len(k) == 1}
        #: Every longer pattern holds one of these; a text without them needs no more than single characters.
        self.signs = {next((c for c in k if ud.combining(c)), k[0]) for k in table if len(k) > 1}
        self.all = self.signs | {chr(k) for k in self.single}
        plain = "".join(sorted(c for c in self.all if c.isascii()))
        self.in_ascii = re.compile(f"[{re.escape(plain)}]").search if plain else lambda _: None
        self.long = ahocorasick.Automaton()
        for k, v in table.items():
            self.long.add_word(k, (len(k), v))
        if table:
            self.long.make_automaton()

    def __call__(self, text: str) -> str:
        if text.isascii() and not self.in_ascii(text):
            return text
        chars = set(text)
        if self.all.isdisjoint(chars):
            return text
        if self.signs.isdisjoint(chars):
            return text.translate(self.single)
        out, done = [], 0
        for end, (n, to) in self.long.iter_long(text):
            out += (text[done : end + 1 - n], to)
            done = end + 1
        return "".join(out) + text[done:] if out else text


class Rewriter:
    """Rewriting of a text by a table of look-alikes, in two steps.

    The first step is the same for every corpus and alone decides which texts are equal: ASCII before other
    members, so that marks meet the Latin letter they compose with.  The second puts the member that the table
    prefers in its place, in ASCII texts as in all others.
    """

    def __init__(self, table: dict[str, str]):
        fixed = representatives()
        self.fixed = Greedy(fixed)
        best = {s: table.get(s, s) for s in set(fixed.values()) if s}
        self.spelling = Greedy({s: m for s, m in best.items() if m != s})

    def __call__(self, text: str) -> str:
        """The consistent form; rewriting it again changes nothing."""
        if not text.isascii() or "\r" in text:
            joined = "\u200d" in text and _JOINED_EMOJI.search(text)
            text = ud.normalize("NFC", _JOINED_EMOJI.sub(_KEEP, text) if joined else text)
            for _ in range(4):
                new = ud.normalize("NFC", self.fixed(text))
                if new == text:
                    break
                text = new
            text = text.replace(_KEEP, "\u200d") if joined else text
        return ud.normalize("NFC", self.spelling(text))


@lru_cache(maxsize=1)
def _members() -> tuple[np.ndarray, set[str], list[str], list[str]]:
    """Class members: code points, marked letters, other strings of several characters without and with marks."""
    known = {s for m in look_alike_classes() for s in m if s}
    multi = {s for s in known if len(s) > 1}
    rest = sorted(s for s in multi if not _MARKED.fullmatch(s))
    return np.array(sorted(ord(s) for s in known - multi)), multi, [s for s in rest if not _MARKS.search(s)], [s for s in rest if _MARKS.search(s)]


def count_forms(texts: list[str]) -> dict[str, int]:
    """Occurrences of every class member in some texts: code points by an array, longer members around their marks."""
    single, multi, plain, marked = _members()
    whole = "\n".join(texts)
    counts = np.bincount(np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32), minlength=int(single[-1]) + 1)[single]
    seen = Counter({chr(c): n for c, n in zip(single[counts > 0].tolist(), counts[counts > 0].tolist(), strict=True)})
    seen.update({s: n for s in plain if (n := whole.count(s))})
    if _MARKS.search(whole):
        for m in _MARKS.finditer(whole):
            if m.start() and (s := whole[m.start() - 1] + m[0]) in multi and _MARKED.fullmatch(s):
                seen[s] += 1
        seen.update({s: n for s in marked if (n := whole.count(s))})
    return seen


def form_frequencies(df: DataFrame, text: str) -> dict[str, int]:
    """Occurrences in all texts of every class member.

    Counted per partition and summed; at most one row per class member (a few thousand) reaches the driver.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for b in batches:
            seen.update(count_forms(b.column(0).drop_null().to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["form", "n"])

    rows = df.select(text).mapInArrow(count, "form string, n long").groupBy("form").agg(F.sum("n").alias("n")).collect()
    return {r["form"]: r["n"] for r in rows}


def consistent_text(df: DataFrame, text: str = "text", out: str = "form", frequency: dict[str, int] | None = None) -> DataFrame:
    """``df`` with ``out``: the consistent form of ``text`` (null stays null, empty stays empty).

    ``frequency`` defaults to counts over all of ``df``.  A column already called ``out`` is replaced.
    """
    table = representatives(form_frequencies(df, text) if frequency is None else frequency)

    @F.pandas_udf("string")
    def rewrite(texts: pd.Series) -> pd.Series:
        to = _rewriter(table)
        return texts.map(to, na_action="ignore")

    return df.withColumn(out, rewrite(F.col(text)))


_cache: dict[int, Rewriter] = {}


def _rewriter(table: dict[str, str]) -> Rewriter:
    key = hash(frozenset(table.items()))
    if key not in _cache:
        _cache[key] = Rewriter(table)
    return _cache[key]


def _texts_apart(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(look, string, id) of rows whose text looks like another, different one; hashes stand for form and text.

    Null texts and texts without a visible character are left out.  Texts are told apart by a 128-bit hash pair.
    """
    named = df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    form = consistent_text(named)
    two = lambda c: F.concat_ws(":", F.hex(F.xxhash64(c)), F.hex(F.xxhash64(F.lit(7), F.reverse(c))))
    rows = materialize(
        form.filter(F.col("form").rlike(r"[^\s\p{Z}\p{C}\p{M}]")).select("id", two(F.col("form")).alias("look"), two(F.col("text")).alias("string")),
        "looks",
    )
    kinds = rows.groupBy("look", "string").agg(F.count(F.lit(1)).alias("n"))
    mixed = materialize(kinds.groupBy("look").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("rows")).filter("kinds > 1"), "mixed")
    return materialize(attach_stats(rows, mixed, "look", "rows", rows.count()).select("look", "string", "id"), "alike")


def look_alike_members(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, class_id, n_texts, n_rows): one row per row of ``df`` whose text looks like a different one.

    ``class_id`` is the smallest id of its class, ``n_texts`` how many different strings the class has, ``n_rows``
    how many rows.  The form that grows with the rows, not with their pairs.
    """
    live = _texts_apart(df, id_col, text)
    kinds = live.groupBy("look", "string").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    stats = materialize(kinds.groupBy("look").agg(F.min("first").alias("class_id"), F.count(F.lit(1)).alias("n_texts"), F.sum("n").alias("n_rows")), "members")
    return attach_stats(live, stats, "look", "n_rows", live.count()).select("id", "class_id", "n_texts", "n_rows")


def _spread_join(left: DataFrame, right: DataFrame, key: str, sizes: DataFrame, total: int) -> DataFrame:
    """Inner join by ``key`` in which no task gets more than about JOIN_BLOCK left rows of one key.

    ``sizes``: (``key``, n), the left rows of each key, of ``total`` in all.  Keys beyond the bound are cut into
    parts by the id of their left rows, and their right rows are repeated once per part.
    """
    block = max(JOIN_BLOCK, -(-total // HOT_KEYS))
    hot = sizes.filter(F.col("n") >= block).select(key, F.ceil(F.col("n") / block).cast("int").alias("parts"))
    if not hot.limit(1).count():
        return left.join(right, key)
    hot = F.broadcast(hot)  # at most HOT_KEYS keys can have so many rows
    cut = left.join(hot, key, "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"), F.lit(0))).drop("parts")
    spread = right.join(hot, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    return cut.join(spread, [key, "part"]).drop("part")


def look_alike_pairs(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: rows whose texts look the same and are not equal as strings.

    Null texts and texts without a visible character pair with nothing.  Only classes that hold two or more
    different texts go on; within them different texts are paired first and their copies after that, so equal
    copies are never compared with one another.  A class or a text with very many members is cut into blocks.
    The pairs of a class are as many as its members' product: :func:`look_alike_members` is the form that grows
    with the rows.
    """
    live = _texts_apart(df, id_col, text)
    total = live.count()
    texts = materialize(live.groupBy("look", "string").agg(F.count(F.lit(1)).alias("n")), "texts")
    a = texts.select("look", F.col("string").alias("id"))
    b = texts.select("look", F.col("string").alias("string_b"))
    kinds = _spread_join(a, b, "look", texts.groupBy("look").agg(F.count(F.lit(1)).alias("n")), total)
    kinds = kinds.filter("id < string_b").select(F.col("id").alias("string_a"), "string_b")
    sizes = lambda c: texts.select(F.col("string").alias(c), "n")
    left = _spread_join(live.select(F.col("string").alias("string_a"), "id"), kinds, "string_a", sizes("string_a"), total)
    left = left.select(F.col("id").alias("id_a"), "string_b")
    pairs = _spread_join(live.select(F.col("string").alias("string_b"), "id"), left, "string_b", sizes("string_b"), total)
    return pairs.select(F.least("id_a", "id").alias("doc_a"), F.greatest("id_a", "id").alias("doc_b")).distinct()
