"""Broken prompt and response pairs (problem 5).

A response is cut into clauses; a linear-chain conditional random field tags each clause as answer,
refusal, echo of the question, foreign or unfinished; the covered share of the response decides the
pair's defect.

What the field sees and what it learns from are kept apart.  It sees words and word pairs, places, how
much of a clause stands in the question, which language it is in and how often texts end after its last
words.  It learns from labels that are true by construction - finished texts cut anywhere, questions
given back, answers of another language put in - and, for refusals, from a fixed list of examples and
from the clauses of the sample that cue rules (``refuses``) recognise; those rules are no features.
Statistics (languages, text endings) are counted over all pairs; the weights are fitted on a bounded
sample (``SAMPLE``); every pair of the data is then tagged.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from itertools import repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize

#: Pairs that the models are fitted on, at most: those with the smallest hashes of their id.
SAMPLE = 12_000
#: Shares of the clauses with a context that end there: bounds of the classes that the field sees.
VERDICTS = (0.005, 0.02, 0.06, 0.2, 0.5)
#: Words of context for that, and how often a context must have been seen to be trusted.
CONTEXT, TRUSTED = 3, 6
#: How often a word must have been seen to tell languages apart; contexts that a worker holds before it passes them on.
KNOWN, HELD = 3, 1_000_000
#: Responses of at most so many words are short answers: never truncated unless a sign of it stands at the end.
SHORT = 4
#: Share of a response's own words that clauses of one kind must cover to make it the pair's defect.
COVER = 0.6
#: The same for a refusal, which often opens with a remark that says nothing.
REFUSAL_COVER = 0.4
#: Log-odds per language decision.
FOREIGN = 2.0
#: Questions that a worker keeps (speed only).
KEPT = 20_000
LANGS = ("en", "zh", "de", "es", "fr", "ru")

# Frequent small words that tell the languages in Latin script apart.
SMALL_WORDS = {
    "en": "the of and is in to what does do at on near with who how can you describe please there anything why",
    "de": "der die das und ist in den dem ein eine einen was wenn auf mit nach im am bitte kannst warum",
    "es": "el los las y en un una qué que por del al con se puedes describe por favor hay cuando",
    "fr": "le les des est dans et un une du au sur avec que ce qui peux pourquoi sous cette puis tandis",
}
# Names of the six languages in the six languages.
LANGUAGE_NAMES = {
    "en": "english englisch inglés anglais английск по-английски 英语 英文",
    "zh": "chinese chinesisch chino chinois китайск по-китайски 中文 汉语",
    "de": "german deutsch alemán allemand немецк по-немецки 德语 德文",
    "es": "spanish spanisch español espagnol испанск по-испански 西班牙语 西班牙文",
    "fr": "french französisch francés français французск по-французски 法语 法文",
    "ru": "russian russisch ruso russe русск по-русски 俄语 俄文",
}
# What stands in place of an answer.
PLACEHOLDER = re.compile(r"\W*(n\s*/\s*a|null|nan|nil|tbd|todo|undefined|no answer|no response|empty|placeholder|keine antwort|sin respuesta|pas de réponse|нет ответа|无回答|无答案|暂无)\W*", re.I)
# An answerer says it will not or cannot.
DECLINE = re.compile(
    r"\b(i|we)\b[^.]{0,40}\b(can ?not|can['’]t|won['’]t|unable|not able|not allowed|not permitted|decline|refuse|will not|may not)\b"
    r"|\b(outside|beyond)\b[^.]{0,20}\bi am\b|\b(in)?appropriate for me\b|\bmy (guidelines|polic|rules|instructions)|\bi have no way\b"
    r"|\bich\b[^.]{0,60}\b(nicht|keine|ablehnen|verweigern)\b|\bkann ich\b[^.]{0,40}\b(nicht|keine)\b"
    r"|\bno (puedo|me está permitido|me es posible|me permit)|\bdebo (negarme|rechazar)|\bme niego\b"
    r"|\bje\b[^.]{0,12}\b(ne (peux|suis|dois)|n['’]ai pas|refuse|dois (refuser|décliner))"
    r"|\bя\b[^.]{0,20}(не (могу|умею|вправе)|вынужден|отказыва)|\bмне (нельзя|запрещено|не разрешено)"
    r"|我[^。，]{0,4}(不能|无法|只能拒绝|没有办法|不便|拒绝|不可以)|恕(我)?(不能|无法)"
)
# An answerer speaks of itself as a program.
SELF = re.compile(r"\b(language|ai) model\b|\ban ai\b|sprachmodell|modelo de lenguaje|modèle de langue|modèle de langage|языковая модель|语言模型|人工智能")
# Regret or thanks, as it opens a refusal.
REGRET = re.compile(r"\b(sorry|apolog|unfortunately|thank you for)|tut mir leid|leider|danke für|lo siento|lamentablemente|gracias por|désolé|malheureusement|merci pour|к сожалению|извините|спасибо за|抱歉|很遗憾|对不起|感谢")
# The answerer offers to take another question.
REDIRECT = re.compile(r"\b(another|something else)\b.*\b(question|know|help)|try another|hope you understand|andere frage|otra pregunta|autre question|другой вопрос|换一个问题|其他问题")
# Refusals in varied words, and answers that share words with them; both teach the field at every size of the sample.
REFUSED = (
    "I cannot answer this question.|I can't help with that.|I won't talk about this one.|I would rather not say.|I'd prefer to leave this one out.|I will have to pass on that.|I must skip this question.|"
    "Sorry, I have to decline.|I am not able to tell you.|I'm not comfortable answering this.|No, I will not do that.|That is not something I can share.|This is something I would rather not touch.|I refuse to describe it.|"
    "Please ask someone else.|Ask somebody else, please.|You should ask another person.|Let's talk about something else instead.|I choose not to reply.|My answer is that I will not answer.|I have been told not to comment on this.|"
    "As asked, I must refuse.|I must leave this one alone.|I'd rather leave it at that.|I do not want to say anything about this.|I am afraid I can't.|Nope, not going to answer.|I am not allowed to speak about it.|It is not permitted for me to say.|My rules forbid it.|As a program I cannot see anything.|No comment from me.|I will pass.|Better ask someone else.|"
    "Das kann ich nicht beantworten.|Ich möchte dazu nichts sagen.|Dabei helfe ich nicht.|Frag bitte jemand anderen.|Ich muss diese Frage auslassen.|Darüber rede ich lieber nicht.|Ich lehne das ab.|Dazu gebe ich keine Auskunft.|Ich darf darüber nicht sprechen.|Als Programm sehe ich nichts.|"
    "No puedo responder a eso.|Prefiero no decir nada.|No voy a hablar de esto.|Pregunta a otra persona, por favor.|Tengo que dejar esta pregunta.|Me niego a describirlo.|No me está permitido hablar de ello.|Como programa no veo nada.|Lo siento, no puedo ayudarte.|"
    "Je ne peux pas répondre.|Je préfère ne rien dire.|Je ne vais pas en parler.|Demandez à quelqu'un d'autre.|Je dois passer cette question.|Je refuse de le décrire.|Je n'ai pas le droit d'en parler.|En tant que programme, je ne vois rien.|Désolé, je ne peux pas vous aider.|"
    "Я не могу ответить.|Я лучше промолчу.|Я не буду об этом говорить.|Спросите кого-нибудь другого.|Мне придётся пропустить этот вопрос.|Я отказываюсь отвечать.|Мне нельзя об этом говорить.|Мне запрещено это описывать.|Как программа я ничего не вижу.|Извините, ничем не могу помочь.|"
    "我不能回答。|我不想谈这个。|我还是不说了。|请去问别人。|这个问题我只能跳过。|我拒绝描述。|我不可以谈论这个。|作为程序，我看不到任何东西。|抱歉，我帮不了你。|恕我无可奉告。"
).split("|")
ANSWERED = (
    "The guard says he cannot let anyone in.|She refuses to board the train.|He asks someone else for the key.|They would rather walk than wait.|A man tells the driver that he must leave.|The waiter is not able to open the door.|"
    "No, only once.|No, nobody else is there.|I think it is a red car.|I see two dogs near the bench.|We see that the boy can't reach the shelf.|The woman has to pass the gate.|It is not possible to see the sky.|The child asks for another apple.|"
    "The sign tells visitors not to touch the glass.|The girl says sorry to the old man.|The boy is sorry, but he can't find the ball.|She tells him that she cannot help.|They say they are unable to pay.|He apologizes and says he has to leave.|Nobody answers the question of the teacher.|She declines the offer, and the man walks away.|The driver will not help the woman.|The dog refuses to eat.|She has to answer the phone.|He wants to go home.|They refuse to pay.|The clerk wants to answer, but nobody listens.|He would rather not swim.|One of them leaves the room alone.|Please, says the boy, and the baker gives him bread.|"
    "Der Schaffner sagt, dass er nicht helfen kann.|Sie lehnt sich an die Wand.|Nein, nur einmal.|Der Hund will nicht ins Boot.|Er fragt jemand anderen nach dem Weg.|Sie sagt, es tue ihr leid, aber sie könne nicht kommen.|Ich sehe zwei Hunde.|"
    "El camarero dice que no puede abrir.|No, solo una vez.|La niña no quiere subir al tren.|Ella dice que lo siente, pero no puede venir.|Veo dos perros.|Pregunta a otra persona por la llave, y ella se la da.|"
    "Le garçon refuse de monter.|Non, une seule fois.|Il ne peut pas ouvrir la porte.|Elle dit qu'elle est désolée, mais elle ne peut pas venir.|Je vois deux chiens.|Elle demande le chemin à quelqu'un d'autre.|"
    "Мальчик отказывается идти.|Нет, только один раз.|Она не может открыть дверь.|Она извиняется, но прийти не может.|Я вижу двух собак.|Он спрашивает дорогу у другого человека.|"
    "小狗不肯上船。|没有，只有一次。|他不能打开门。|她说很抱歉，但是她不能来。|我看到两只狗。|她去问别人怎么走。"
).split("|")
_QUOTE = re.compile("[\"“«「'‘]")
QUOTED = re.compile("\"[^\"]*\"|“[^”]*”|«[^»]*»|「[^」]*」|(?<!\\w)['‘][^'’]*['’](?!\\w)")

_MARKUP = re.compile(r"<\|?/?[a-z_]+\|?>")
_STOP = ".!?。！？"
_CLAUSE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])|\n+")
_SIGN = "㐀-鿿"
_TOKEN = re.compile(f"[{_SIGN}]|[^\\W{_SIGN}]+|[,;:，；：、]")
_IDEOGRAPH, _CYRILLIC, _NO_LETTER = re.compile(f"[{_SIGN}]"), re.compile("[Ѐ-ӿ]"), re.compile(r"[\W\d_]")
# The same tokens in many texts at once, with the marks that end a clause and signs between clauses and texts.
_FLAT = re.compile(f"[\x01\x02.!?。！？]|[{_SIGN}]|[^\\W{_SIGN}]+|[,;:，；：、]")
_AFTER = ")]}\"”’»」*_~ \t\r\n\xa0\u3000"
_ASIDE = re.compile(r"\([^()]*\)$")
_HIDDEN = re.compile("[\u00ad\u061c\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\u2066-\u2069\ufeff]")
_PICTURES = re.compile("[\U0001f000-\U0001faff\u2600-\u27bf\ufe0f\u200d]+$")
_SIGNS = re.compile(r"[\W_]+")
_NUMBERED = re.compile(r"\W*\d{1,3}\W*")
_LABEL = re.compile(r"^\W*[^\W\d_]+\s*[:：]\s*")
_BLANK = re.compile(r"[^\S \n]")  # white space other than a blank and a line end


def clean(text: str | None) -> str:
    """Without markup, media tokens and invisible characters."""
    t = _MARKUP.sub(" ", text) if text and "<" in text else text or ""
    return (t if t.isascii() else _HIDDEN.sub("", t)).strip()


def without_tail(text: str) -> str:
    """Without what may follow a finished text: closing marks, emoji, a remark in brackets."""
    while True:
        t = text.rstrip()
        t = _ASIDE.sub("", t) if t.endswith(")") and _ASIDE.search(t) else t.rstrip(_AFTER)
        if not t.isascii():
            t = _PICTURES.sub("", t)
        if t == text:
            return t
        text = t


def says_nothing(answer: str | None) -> bool:
    return _nothing(clean(answer))


def _nothing(t: str) -> bool:
    return not any(map(str.isalnum, t)) or (len(t) < 40 and bool(PLACEHOLDER.fullmatch(t)))


def clauses(text: str) -> list[str]:
    return [c for c in (x.strip() for x in _CLAUSE.split(text)) if c]


def words_of(clause: str) -> list[str]:
    return _TOKEN.findall(clause.casefold())


def _letters(t: str) -> str:
    return _SIGNS.sub("", t.casefold())


def _grams(t: str, n: int) -> set[str]:
    return {t[i : i + n] for i in range(max(1, len(t) - n + 1))} if t else set()


class Echo:
    """How much of a text stands in another one, by letter sequences; a label in front does not count."""

    def __init__(self, whole: str):
        self.whole, self.words = whole, set(words_of(whole))

    @cached_property
    def letters(self) -> str:
        return _letters(self.whole)

    @cached_property
    def n(self) -> int:
        return 2 if _IDEOGRAPH.search(self.whole) else 5

    @cached_property
    def have(self) -> set[str]:
        return _grams(self.letters, self.n)

    def near(self, words: list[str]) -> bool:
        """Whether a clause can be an echo at all: a third of its words stand there, or it has words of unusual length."""
        return 3 * sum(map(self.words.__contains__, words)) >= len(words) or max(map(len, words), default=0) > 24

    def share(self, part: str) -> float:
        best = 0.0
        for p in {part, _LABEL.sub("", part, count=1)}:
            t = _letters(p)
            if t and t in self.letters:
                return 1.0
            g = _grams(t, self.n)
            best = max(best, len(g & self.have) / len(g)) if g else best
        return best


@dataclass
class Languages:
    """Which language words belong to (naive Bayes over words and word ends, script first)."""

    words: dict[str, tuple[float, ...]] = field(default_factory=dict)
    likely: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def script(words: list[str]) -> str | None:
        firsts = "".join(map(itemgetter(0), words))
        n = len(firsts) - len(_NO_LETTER.findall(firsts))
        return "zh" if len(_IDEOGRAPH.findall(firsts)) * 3 > n else "ru" if len(_CYRILLIC.findall(firsts)) * 2 > n else None

    def learn(self, counts: Iterable[tuple[str, tuple[int, ...]]], total: tuple[int, ...]) -> None:
        """From (word or ~ending, its counts by language) and the counts of all words."""
        for k, by in counts:
            if sum(by) >= KNOWN:
                self.words[k] = x = tuple(math.log((n + 0.3) / (whole + 1 + 100)) for n, whole in zip(by, total, strict=True))
                self.likely[k] = list(SMALL_WORDS)[x.index(max(x))]

    def surely(self, lang: str | None, words: list[str]) -> bool:
        """Whether nine in ten of the known words are likeliest in one language of Latin script."""
        votes = [x for x in map(self.likely.get, words) if x]
        return bool(votes) and 10 * votes.count(lang) >= 9 * len(votes)

    def best(self, words: list[str], ascii_only: bool) -> str | None:
        """The likeliest language."""
        if not ascii_only and (one := self.script(words)):
            return one
        votes = [x for x in map(self.likely.get, words) if x]
        if votes and 10 * votes.count(votes[0]) >= 9 * len(votes):
            return votes[0]
        scores = self.scores(words, True)
        return max(scores, key=scores.get) if scores else None

    def scores(self, words: list[str], latin: bool = False) -> dict[str, float]:
        """Log score of each language; a language of another script is out of the question."""
        if not latin and (one := self.script(words)):
            return {lang: 0.0 if lang == one else -50.0 for lang in LANGS}
        get = self.words.get
        known = [x for x in (get(k) or get(f"~{k[-3:]}") for k in words) if x]
        if not known:
            return {}
        sums = dict(zip(SMALL_WORDS, map(sum, zip(*known, strict=True)), strict=True))
        return {lang: sums.get(lang, -50.0 - 12.0 * len(known)) for lang in LANGS}


_MIX, _WRAP = 0x9E3779B97F4A7C15, (1 << 64) - 1
_START = 0x51D7A3B94E6F1C27


@lru_cache(maxsize=1_000_000)
def word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def longer_context(h, word):
    """Hash of a context with one more word in front; whole numbers and arrays of them alike."""
    x = (h ^ word) * _MIX & _WRAP if isinstance(h, int) else (h ^ word) * np.uint64(_MIX)
    return x ^ (x >> 29) if isinstance(h, int) else x ^ (x >> np.uint64(29))


@dataclass
class Endings:
    """How often a text ends after the words it ends with, by contexts of up to CONTEXT words (as hashes)."""

    shares: dict[int, float] = field(default_factory=dict)
    begun: set[str] = field(default_factory=set)

    def learn(self, rows: Iterable[tuple[int, int, int, str | None]]) -> None:
        """From (context, how often seen, how often a clause ended there, the word if it is one)."""
        for key, n, ended, word in rows:
            self.shares[key & _WRAP] = ended / n
            if word:
                self.begun.update(word[:i] for i in range(1, len(word)))

    def share(self, words: list[str]) -> float | None:
        """Share of the clauses with the longest trusted context that end there; None for an unknown last word."""
        h, best = 0, None
        for n, w in enumerate([*reversed(words[-CONTEXT:]), None][:CONTEXT]):
            if w is None and n < len(words):
                break
            h = longer_context(h, _START if w is None else word_hash(w))
            got = self.shares.get(h)
            if n == 0 and got is None:
                return None
            best = best if got is None else got
        return best


SCHEMA = "key bigint, rest bigint, word string, " + ", ".join(f"n{i} bigint" for i in range(len(SMALL_WORDS)))


class Counts:
    """Contexts and language words of many texts, counted by arrays.

    Texts of a batch are joined and cut into tokens at once; contexts are hashes of up to CONTEXT tokens that
    end at a token, the start of the clause counting as one.
    """

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0
        self.names: dict[int, str] = {}
        self.langs: Counter[tuple[str, int]] = Counter()

    @staticmethod
    def flat(texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(different tokens, their numbers in the joined texts); each text is closed by a token of its own."""
        joined = "\x01".join(texts)
        if joined.count("\x01") >= len(texts) or "\x02" in joined:  # a text holds one of the signs
            joined = "\x01".join(t.replace("\x01", " ").replace("\x02", " ") for t in texts)
        joined = _MARKUP.sub(" ", joined) if "<" in joined else joined
        joined = joined if joined.isascii() else _HIDDEN.sub("", joined)
        joined = _BLANK.sub(" ", joined) if _BLANK.search(joined) else joined
        joined = joined.casefold().replace("\n", "\x02")
        for stop in _STOP:
            joined = joined.replace(f"{stop} " if stop in ".!?" else stop, f"{stop}\x02")
        found = pa.array([*_FLAT.findall(joined), "\x01"]).dictionary_encode()
        return found.dictionary.to_pylist(), found.indices.to_numpy()

    def languages(self, names: list[str], codes: np.ndarray) -> None:
        """Words of the texts that are clearly in one language."""
        close = np.flatnonzero(codes == names.index("\x01"))
        starts = np.concatenate([[0], close[:-1] + 1])
        look = lambda test: np.array([test(w) for w in names], dtype=np.int32)[codes]
        per = lambda x: np.add.reduceat(np.append(x, 0), starts)[: len(starts)]
        n = per(look(lambda w: w[0].isalpha()))
        other = (per(look(lambda w: "㐀" <= w[0] <= "鿿")) * 3 > n) | (per(look(lambda w: "Ѐ" <= w[0] <= "ӿ")) * 2 > n)
        small = [set(x.split()) for x in SMALL_WORDS.values()]
        hits = np.stack([per(look(lambda w, s=s: w in s)) for s in small])
        ranked = np.sort(hits, axis=0)
        lang = np.where(other | (n == 0) | (ranked[-1] == ranked[-2]), -1, hits.argmax(0))
        owner = np.repeat(lang, np.diff(np.append(starts, len(codes))))
        word = look(lambda w: w.replace("_", "").isalpha()).astype(bool) & (owner >= 0)
        pair, count = np.unique(owner[word].astype(np.int64) << 32 | codes[word], return_counts=True)
        for k, c in zip(pair.tolist(), count.tolist(), strict=True):
            self.langs[names[k & 0xFFFFFFFF], k >> 32] += c

    def contexts(self, names: list[str], codes: np.ndarray) -> None:
        """Contexts of the clauses that are whole: all but a last one without a stop that is no short answer."""
        kind = np.array([3 if w == "\x01" else 2 if w == "\x02" else 1 if w in _STOP else 0 for w in names], dtype=np.int8)[codes]
        stopped = np.append(False, kind[:-1] == 1)  # the token before is a stop
        keep = kind != 1
        codes, kind, stopped = codes[keep], kind[keep], stopped[keep]
        gap = kind >= 2
        ends = np.flatnonzero(gap)
        starts = np.append(0, ends[:-1] + 1)
        length = ends - starts
        spoken = np.array([w[0].isalnum() for w in names], dtype=np.int32)[codes]
        n_words = np.add.reduceat(np.append(spoken, 0), starts)[: len(starts)]
        whole = (kind[ends] == 2) | stopped[ends] | (n_words <= SHORT)
        hashes = np.array([_START if w in "\x01\x02" else word_hash(w) for w in names], dtype=np.uint64)[codes]
        hashes = np.append(np.uint64(_START), hashes)  # so that the first clause has a start before it
        place = np.arange(len(codes)) - np.repeat(starts, length + 1)
        last = np.append(gap[1:], True)
        live = ~gap & np.repeat(whole, length + 1)
        at = np.flatnonzero(live)
        place, last = place[at], last[at]
        h, rest = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
        for n in range(1, CONTEXT + 1):
            ok = place >= n - 2
            at, place, last, h, rest = at[ok], place[ok], last[ok], h[ok], h[ok]
            h = longer_context(h, hashes[at + 2 - n])
            if n == 1:
                first = np.unique(codes[at], return_index=True)[1]
                self.names.update(zip(h[first].view(np.int64).tolist(), (names[c] for c in codes[at[first]].tolist()), strict=True))
            self._add(h, rest, np.ones(len(h), np.int64), last.astype(np.int64))

    def _add(self, h: np.ndarray, rest: np.ndarray, n: np.ndarray, ended: np.ndarray) -> None:
        self.parts.append(self._sums(h, rest, n, ended))
        self.held += len(self.parts[-1][0])
        if self.held > HELD:
            self.parts = [self._sums(*(np.concatenate(c) for c in zip(*self.parts, strict=True)))]
            self.held = len(self.parts[0][0])

    @staticmethod
    def _sums(h: np.ndarray, rest: np.ndarray, n: np.ndarray, ended: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.argsort(h)
        h = h[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.empty(0, np.int64)
        return (h[first], rest[order][first], np.add.reduceat(n[order], first), np.add.reduceat(ended[order], first)) if len(h) else (h, rest, n, ended)

    def count(self, questions: list[str], answers: list[str]) -> None:
        if answers:
            self.languages(*self.flat(questions))
            told = self.flat([a if a[-1].isalnum() or a[-1] in _STOP else without_tail(clean(a)) for a in answers])
            self.languages(*told)
            self.contexts(*told)

    def full(self) -> bool:
        return self.held > HELD // 2

    def batch(self) -> pa.RecordBatch:
        """All that was counted, as rows of SCHEMA; starts anew."""
        none = tuple(np.empty(0, np.uint64) for _ in range(4))
        h, rest, n, ended = self._sums(*(np.concatenate(c) for c in zip(*self.parts, strict=True))) if self.parts else none
        known: dict[str, list[int]] = defaultdict(lambda: [0] * len(SMALL_WORDS))
        for (w, lang), c in self.langs.items():
            known[w][lang] += c
        m = len(known)
        words = np.full(len(h) + m, None, dtype=object)
        words[np.searchsorted(h, np.array([*self.names], dtype=np.int64).view(np.uint64))] = [*self.names.values()]
        words[len(h) :] = [*known]
        numbers = np.zeros((len(SMALL_WORDS), len(h) + m), dtype=np.int64)
        numbers[0, : len(h)], numbers[1, : len(h)] = n, ended
        numbers[:, len(h) :] = np.array([*known.values()], dtype=np.int64).reshape(m, len(SMALL_WORDS)).T
        gone = np.arange(len(h) + m) >= len(h)
        pad = np.zeros(m, np.int64)
        columns = [
            pa.array(np.concatenate([h.view(np.int64), pad]), mask=gone),
            pa.array(np.concatenate([rest.view(np.int64), pad]), mask=gone),
            pa.array(words, pa.string()),
            *map(pa.array, numbers),
        ]
        self.__init__()
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])


TAGS = ("answer", "refusal", "echo", "foreign", "unfinished")
_MARKS = ("stop", "comma", "hyphen", "dots", "number", "sign", "plain")
FEATURES = (
    "bias", "first", "last", "only", "short", "asks", "quotes", "echo all", "echo most", "echo some", "foreign sure", "foreign perhaps", "own language",
    "just begun", *(f"ends {m}" for m in _MARKS), *(f"share below {x}" for x in VERDICTS), "few words", "unknown word", "unknown sign", "cut word",
)
_F = {f: i for i, f in enumerate(FEATURES)}
_BIT = {f: 1 << i for i, f in enumerate(FEATURES)}


# What is known before any data is seen: the mean of the weights' prior.
PRIOR = (
    ("bias", "answer", 1.5), ("bias", "refusal", -0.5), ("quotes", "refusal", -0.5), ("echo all", "echo", 4.0), ("echo most", "echo", 1.0), ("foreign sure", "foreign", 3.5), ("ends comma", "unfinished", 3.0), ("ends hyphen", "unfinished", 3.0),
    ("ends dots", "unfinished", 2.0), ("ends number", "unfinished", 5.0), ("ends stop", "unfinished", -3.0), ("share below 0.02", "unfinished", 3.0), ("cut word", "unfinished", 3.0),
    ("just begun", "unfinished", 3.0), ("unknown word", "unfinished", -2.0),
)


def prior_weights() -> np.ndarray:
    w = np.zeros((len(FEATURES), len(TAGS)))
    for f, tag, x in PRIOR:
        w[_F[f], TAGS.index(tag)] = x
    return w


@dataclass
class Seen:
    """What the field sees of one response: a bit set of FEATURES per clause, and its words."""

    clauses: list[str]
    words: list[list[str]]
    masks: list[int]
    told: list[list[str]]  # the words outside quotations


_LAST_WORDS = sum(_BIT[f"share below {x}"] for x in VERDICTS) | _BIT["unknown word"] | _BIT["unknown sign"] | _BIT["cut word"]


def with_unknown_end(seen: Seen) -> Seen:
    """The same response as if its last word were one never seen before."""
    unknown = _BIT["unknown sign"] if _IDEOGRAPH.match(seen.words[-1][-1]) else _BIT["unknown word"]
    return Seen(seen.clauses, seen.words, [*seen.masks[:-1], seen.masks[-1] & ~_LAST_WORDS | unknown], seen.told)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    """Logarithm of the sum of exponentials."""
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Field:
    """Linear-chain conditional random field over the clauses of one response.

    Words and word pairs speak for or against the tag refusal only; the other features weigh for every tag.
    """

    def __init__(self) -> None:
        self.prior = prior_weights()
        self.w, self.t = self.prior.copy(), np.zeros((len(TAGS), len(TAGS)))
        self.lexis: dict[str, float] = {}
        self.pairs: dict[str, dict[str, float]] = {}
        self._tags: dict[tuple, list[int]] = {}

    @staticmethod
    def terms(words: list[str]) -> list[str]:
        return [*words, *map(" ".join, zip(words, words[1:], strict=False))]

    def said(self, words: list[str]) -> float:
        """How much the words speak for a refusal."""
        total, before = sum(map(self.lexis.get, words, repeat(0.0))), (none := {})
        for w in words:
            total += before.get(w, 0.0)
            before = self.pairs.get(w, none)
        return total

    def fit(self, seen: list[Seen], ys: list[list[int]], steps: int = 80, rate: float = 0.5, decay: float = 1e-3, lexical_decay: float = 2e-4, rare: float = 4.0) -> None:
        """Maximum a posteriori by AdaGrad, all sequences of one length at a time (forward-backward in log space).

        Sequences with a refusal, which are few in every language, weigh ``rare`` times as much.
        """
        counts = Counter(t for s in seen for w in s.told for t in set(self.terms(w)))
        number = {t: i for i, t in enumerate(sorted(t for t, n in counts.items() if n > 1))}
        groups: dict[int, list[int]] = defaultdict(list)
        for i, y in enumerate(ys):
            groups[len(y)].append(i)
        bits = np.arange(len(FEATURES))
        data = []
        for g in groups.values():
            x = (np.array([seen[i].masks for i in g], dtype=np.int64)[..., None] >> bits & 1).astype(float)
            rows, terms = [], []
            for r, w in enumerate(w for i in g for w in seen[i].told):
                known = {number[t] for t in self.terms(w) if t in number}
                rows += [r] * len(known)
                terms += known
            y = np.array([ys[i] for i in g])
            data.append((x, y, np.where((y == 1).any(1), rare, 1.0)[:, None, None], np.array(rows, dtype=np.int64), np.array(terms, dtype=np.int64)))
        total, gw2, gt2 = max(1, len(ys)), np.full_like(self.w, 1e-8), np.full_like(self.t, 1e-8)
        lex, gl2 = np.zeros(len(number)), np.full(len(number), 1e-8)
        eye = np.eye(len(TAGS))
        for _ in range(steps):
            gw, gt, gl = decay * (self.w - self.prior), decay * self.t, lexical_decay * lex
            for x, y, weight, rows, terms in data:
                s = x @ self.w
                n, length, _k = s.shape
                s[..., 1] += np.bincount(rows, weights=lex[terms], minlength=n * length).reshape(n, length)
                fwd, bwd = np.empty_like(s), np.zeros_like(s)
                fwd[:, 0] = s[:, 0]
                for p in range(1, length):
                    fwd[:, p] = s[:, p] + _log_sum(fwd[:, p - 1, :, None] + self.t, 1)
                for p in range(length - 2, -1, -1):
                    bwd[:, p] = _log_sum(self.t + (s[:, p + 1] + bwd[:, p + 1])[:, None, :], 2)
                z = _log_sum(fwd[:, -1], 1)[:, None]
                wrong = (np.exp(fwd + bwd - z[..., None]) - eye[y]) * weight / total
                gw += x.reshape(-1, x.shape[2]).T @ wrong.reshape(-1, wrong.shape[2])
                gl += np.bincount(terms, weights=wrong[..., 1].ravel()[rows], minlength=len(lex))
                for p in range(1, length):
                    pair = np.exp(fwd[:, p - 1, :, None] + self.t + (s[:, p] + bwd[:, p])[:, None, :] - z[:, :, None])
                    gt += ((pair * weight).sum(0) - (eye[y[:, p - 1]] * weight[:, 0]).T @ eye[y[:, p]]) / total
            gw[:, :2] = 0  # nothing but words tells a refusal from an answer
            gw2 += gw**2
            gt2 += gt**2
            gl2 += gl**2
            self.w -= rate * gw / np.sqrt(gw2)
            self.t -= rate * gt / np.sqrt(gt2)
            lex -= 2 * rate * gl / np.sqrt(gl2 + 1e-9)
        self.lexis, self.pairs = {}, {}
        for t, x in ((t, float(lex[i])) for t, i in number.items() if abs(lex[i]) >= 0.02):
            a, pair, b = t.partition(" ")
            if pair:
                self.pairs.setdefault(a, {})[b] = x
            else:
                self.lexis[a] = x
        self._tags.clear()

    def tag(self, seen: Seen) -> list[int]:
        """Most likely tags (Viterbi); equal features have equal tags, so those of the last ones are kept."""
        key = tuple((m, round(4 * self.said(w))) for m, w in zip(seen.masks, seen.told, strict=True))
        if key not in self._tags:
            if len(self._tags) >= KEPT:
                self._tags.clear()
            x = (np.array([m for m, _ in key], dtype=np.int64)[:, None] >> np.arange(len(FEATURES)) & 1).astype(float)
            s = x @ self.w
            s[:, 1] += [n / 4 for _, n in key]
            best, back = s[0], []
            for p in range(1, len(s)):
                paths = best[:, None] + self.t
                back.append(paths.argmax(0))
                best = paths.max(0) + s[p]
            out = [int(best.argmax())]
            for b in reversed(back):
                out.append(int(b[out[-1]]))
            self._tags[key] = out[::-1]
        return self._tags[key]


def requested_language(question: str) -> set[str]:
    q = question.casefold()
    return {lang for lang, names in LANGUAGE_NAMES.items() if any(n in q for n in names.split())}


def refuses(clause: str, before: bool, only: bool) -> bool:
    """Whether cue rules take a clause for a refusal; they label the sample and nothing else."""
    plain = clause.casefold().replace("’", "'")
    own = QUOTED.sub(" ", plain) if _QUOTE.search(plain) else plain
    if DECLINE.search(own) or (SELF.search(own) and REGRET.search(own)):
        return True
    return bool(REDIRECT.search(own)) and (before or only)


@dataclass
class Tagger:
    languages: Languages = field(default_factory=Languages)
    endings: Endings = field(default_factory=Endings)
    crf: Field = field(default_factory=Field)
    known: dict[tuple[str, str], tuple] = field(default_factory=dict)

    def asked(self, question: str, instruction: str) -> tuple[str | None, set[str], Echo]:
        """(language, languages asked for, letters) of a question; questions repeat, so the last ones are kept."""
        key = question, instruction
        if key not in self.known:
            if len(self.known) >= KEPT:
                self.known.clear()
            told = clean(question)
            lang = self.languages.best(words_of(told), told.isascii())
            self.known[key] = lang, requested_language(question), Echo(f"{told} {clean(instruction)}")
        return self.known[key]

    def _share(self, words: list[str]) -> int:
        """Features of the last words: the bounds that their share of endings lies below, or that it is not known."""
        share = self.endings.share(words)
        if share is not None:
            return sum(_BIT[f"share below {x}"] for x in VERDICTS if share < x)
        last = words[-1] if words else ""
        return _BIT["cut word"] if last in self.endings.begun else _BIT["unknown sign"] if _IDEOGRAPH.match(last) else _BIT["unknown word"]

    def ending(self, text: str, cs: list[str], words: list[list[str]]) -> int:
        """Features of how a response ends."""
        if text[-1] in _STOP and text[-3:] != "..." and (len(cs) == 1 or not _NUMBERED.fullmatch(cs[-1])):
            return _BIT["ends stop"]
        body = without_tail(text)
        if not body:
            return _BIT["ends sign"]
        end = body[-1]
        if end in _STOP and not body.endswith("..."):
            last = clauses(body)[-1] if body is not text else cs[-1]
            return _BIT["ends number"] if len(cs) > 1 and _NUMBERED.fullmatch(last) else _BIT["ends stop"]
        parts = clauses(body) if body != text else cs
        if len(parts) > 1 and _NUMBERED.fullmatch(parts[-1]):
            return _BIT["ends number"]
        short = sum(w[0].isalnum() for c in (words if parts is cs else map(words_of, parts)) for w in c)
        if body.endswith(("…", "...")):
            cut = clauses(body.rstrip("….")) or [""]
            return _BIT["ends dots"] | self._share(words_of(cut[-1]))
        if end in ",，、;；:：" and short > 1:
            return _BIT["ends comma"]
        if end in "-–—" and short > 1:
            return _BIT["ends hyphen"]
        if not end.isalnum():
            return _BIT["ends sign"]
        last = words[-1] if parts is cs else words_of(parts[-1])
        begun = _BIT["just begun"] if any(w in ",，、;；" for w in last[-3:]) else 0  # hardly anything follows the last comma
        few = short <= SHORT and not _IDEOGRAPH.search(parts[-1])
        if few:
            begun = _BIT["few words"]
        return begun | _BIT["ends plain"] | (_BIT["unknown word"] if few and short == 1 else self._share(last))

    def see(self, question: str, instruction: str, answer: str) -> Seen:
        """What the field sees of a pair; a cleaned answer stays as it is."""
        text = clean(answer)
        cs = clauses(text)
        words = [_TOKEN.findall(c) for c in map(str.casefold, cs)]
        (asked, wanted, echoed), told, masks = self.asked(question, instruction), words, []
        if _QUOTE.search(text):
            told = [words_of(QUOTED.sub(" ", c.replace("’", "'"))) for c in cs]
        plain = text.isascii()
        own, suspect, flat = bool(asked), False, sum(words, [])
        if asked and (one := None if plain else self.languages.script(flat)):
            suspect = one != asked
        elif asked and not self.languages.surely(asked, flat):
            whole = self.languages.scores(flat, True)
            own, suspect = bool(whole), bool(whole) and max(whole, key=whole.get) != asked
        for i, (c, w) in enumerate(zip(cs, words, strict=True)):
            m = _BIT["bias"] | (_BIT["first"] if i == 0 else 0) | (_BIT["asks"] if c.endswith(("?", "？")) else 0)
            if told is not words and len(told[i]) < len(w):
                m |= _BIT["quotes"]
            if len(w) <= SHORT:
                m |= _BIT["short"]
            if len(c) > 3 and echoed.near(w):
                echo = echoed.share(c)
                m |= _BIT["echo all"] if echo >= 0.9 else _BIT["echo most"] if echo >= 0.7 else _BIT["echo some"] if echo >= 0.4 else 0
            if not suspect:
                m |= _BIT["own language"] if own else 0
            elif scores := self.languages.scores(w, plain):
                mine = max(scores, key=scores.get)
                odds = scores[mine] - scores[asked]
                foreign = mine != asked and mine not in wanted
                m |= _BIT["foreign sure"] if foreign and odds >= FOREIGN else _BIT["foreign perhaps"] if foreign and odds > 0.5 else _BIT["own language"]
            masks.append(m)
        if masks:
            masks[-1] |= _BIT["last"] | self.ending(text, cs, words) | (_BIT["only"] if len(cs) == 1 else 0)
        return Seen(cs, words, masks, told)

    def labelled(self, told: list[tuple[str, str, str]]) -> Iterator[tuple[Seen, list[int]]]:
        """Training sequences: pairs of the sample and pairs made from them, tagged by how they came about.

        Responses that end without a stop are left out unless short: nobody knows whether they are whole.
        """
        by: dict[str | None, tuple[str, str, str]] = {}
        for n, (q, i, a) in enumerate(told):
            seen = self.see(q, i, a)
            if not seen.masks:
                continue
            ys: list[int] = []
            for k, (c, m) in enumerate(zip(seen.clauses, seen.masks, strict=True)):
                if refuses(c, k == 0 or ys[-1] == 1, len(seen.clauses) == 1):
                    ys.append(1)
                else:
                    ys.append(2 if m & _BIT["echo all"] else 3 if m & _BIT["foreign sure"] else 0)
            end, sound = seen.masks[-1], not any(ys)
            words = sum(map(len, seen.words))
            if end & (_BIT["ends stop"] | _BIT["ends sign"]) or (end & _BIT["ends plain"] and words <= SHORT) or ys[-1]:
                yield seen, ys
            if not sound:
                continue
            lang = self.asked(q, i)[0]
            body = without_tail(clean(a))
            if end & _BIT["ends stop"] and words > SHORT + 1:
                bare = body.rstrip(_STOP)
                mark = hash_place(n, 7)
                if mark < 3:
                    got = self.see(q, i, bare)
                    yield got, [0] * len(got.masks)
                    if mark == 0:
                        yield with_unknown_end(got), [0] * len(got.masks)
                elif mark < 6 or (n * 5) % 6 == 0:
                    at = max(2, 1 + hash_place(n * 31 + 5, max(1, len(bare) - 2)))
                    if n % 5 == 0 and (gaps := [m.start() for m in re.finditer(" ", bare)][1:SHORT]):
                        at = gaps[hash_place(n, len(gaps))]
                    cut = bare[:at].rstrip(" ") + ("", "", "", "...", "-", ",", "…")[hash_place(n * 17 + 3, 7)]
                    if len(words_of(cut)) > 1:
                        got = self.see(q, i, cut)
                        if got.masks and not got.masks[-1] & (_BIT["ends stop"] | _BIT["ends sign"]):
                            yield got, [0] * (len(got.masks) - 1) + [4]
                            if got.masks[-1] & _BIT["just begun"]:
                                yield with_unknown_end(got), [0] * (len(got.masks) - 1) + [4]
            if n % 12 == 0:
                got = self.see(q, i, f"{clean(a)}\n2.")
                yield got, [0] * (len(got.masks) - 1) + [4]
            if n % 12 == 4 and clean(q):
                got = self.see(q, i, clean(q))
                yield got, [2] * len(got.masks)
            elif n % 12 == 8 and by.keys() - {lang}:
                got = self.see(q, i, next(p[2] for k, p in sorted(by.items(), key=str) if k != lang))
                yield got, [3 if m & (_BIT["foreign sure"] | _BIT["foreign perhaps"]) else 0 for m in got.masks]
            by[lang] = q, i, a

    def fit(self, pairs: list[tuple[str, str, str]], counted: tuple[Languages, Endings] | None = None) -> Tagger:
        """Fit on (question, instruction, answer) triples; without any, the fixed examples and the prior decide.

        ``counted``: the statistics of all pairs; without it they are those of the triples.
        """
        told = [p for p in pairs if p[2] and not says_nothing(p[2])]
        self.languages, self.endings = counted or statistics_of(told)
        data = list(self.labelled(told))
        for tag, texts in ((1, REFUSED), (0, ANSWERED)):
            for text in texts:
                for n in range(max(1, len(data) // 2000)):
                    more = "" if n % 3 else "".join(ANSWERED[(n * 7 + len(text)) % len(ANSWERED)]) if n % 6 == 0 and tag == 0 else ""
                    seen = self.see("", "", f"{more} {text}")
                    data.append((seen, [0] * (len(seen.masks) - 1) + [tag]))
        self.crf.fit([x for x, _ in data], [y for _, y in data])
        self.known.clear()
        return self

    def defect(self, question: str | None, instruction: str | None, answer: str | None) -> str | None:
        """The pair's defect, or None: clause tags weighed by the letters they cover."""
        answer = clean(answer)
        if _nothing(answer):
            return "empty"
        seen = self.see(question or "", instruction or "", answer)
        tags = self.crf.tag(seen)
        if not any(tags):
            return None
        weight = np.array([sum(map(len, w)) for w in seen.words], dtype=float)
        covered = [weight[[t == k for t in tags]].sum() / max(weight.sum(), 1) for k in range(len(TAGS))]
        if covered[1] >= REFUSAL_COVER and covered[0] <= 1 - REFUSAL_COVER:
            return "refusal"
        if covered[2] > 0 and covered[2] + covered[4] >= 0.95 and Echo(answer).share(clean(question)) >= 0.9:
            return "copy"
        if tags[-1] == 4:
            return "truncated"
        if covered[3] >= COVER:
            return "language"
        return None


def hash_place(n: int, of: int) -> int:
    """A number below ``of``, the same in every run."""
    return int.from_bytes(hashlib.blake2b(n.to_bytes(8, "little"), digest_size=4).digest(), "little") % of


def _learned(rows: list[tuple[int | None, int | None, str | None, list[int]]]) -> tuple[Languages, Endings]:
    languages, endings, by = Languages(), Endings(), defaultdict(lambda: [0] * len(SMALL_WORDS))
    for key, _, word, n in rows:
        if key is None:
            for k in (word, f"~{word[-3:]}"):
                by[k] = [a + b for a, b in zip(by[k], n, strict=True)]
    languages.learn(by.items(), tuple(map(sum, zip(*by.values(), strict=True))) if by else (0,) * len(SMALL_WORDS))
    endings.learn((key, n[0], n[1], word) for key, _, word, n in rows if key is not None and n[0] >= TRUSTED)
    return languages, endings


def statistics_of(told: list[tuple[str, str, str]]) -> tuple[Languages, Endings]:
    """The statistics of a few pairs, without Spark."""
    counts = Counts()
    counts.count([q for q, _, _ in told], [a for _, _, a in told])
    return _learned([(k, r, w, list(n)) for k, r, w, *n in zip(*(c.to_pylist() for c in counts.batch().columns), strict=True)])


PAIR = "pair_no: bigint, q: string, i: string, a: string"


def _qa_pairs(qa: DataFrame, id_col: str = "qa_id", value: str = "value") -> DataFrame:
    """(tab, rec_id, pair_no, q, i, a) of manifest rows; the question is everything but answer and instruction."""
    m = F.col("m")
    rest = F.filter(F.array_sort(F.map_keys(m)), lambda k: ~k.isin("a", "i"))
    rows = qa.select(F.col(id_col).alias("rec_id"), F.posexplode(value).alias("pair_no", "m")).filter(m.isNotNull())
    question = F.array_join(F.transform(rest, lambda k: m[k]), " ")
    return rows.select(F.lit("manifest_qa").alias("tab"), "rec_id", F.col("pair_no").cast("bigint").alias("pair_no"), question.alias("q"), m["i"].alias("i"), m["a"].alias("a"))


def _packed_pairs(packed: DataFrame, id_col: str = "sample_id", turns: str = "info.conversations") -> DataFrame:
    """The same of packed rows: each human turn with the answering turns up to the next human one, joined."""
    role = lambda t: F.lower(F.trim(t["from"]))
    human, gpt = ("human", "user"), ("gpt", "assistant")
    said = F.filter(F.col(turns), lambda t: role(t).isin(*human, *gpt))
    rows = packed.select(F.col(id_col).alias("rec_id"), said.alias("t"))
    asked = F.filter(F.transform(F.col("t"), lambda t, n: F.when(role(t).isin(*human), n)), lambda n: n.isNotNull())
    rows = rows.select("rec_id", "t", F.posexplode(asked).alias("pair_no", "at"), F.size("t").alias("n"), asked.alias("all"))
    to = F.coalesce(F.try_element_at("all", F.col("pair_no") + 2), F.col("n"))
    replies = F.slice("t", F.col("at") + 2, F.greatest(to - F.col("at") - 1, F.lit(0)))
    answer = F.when(F.size(replies) > 0, F.array_join(F.transform(replies, lambda t: t["value"]), "\n"))
    return rows.select(F.lit("packed").alias("tab"), "rec_id", F.col("pair_no").cast("bigint").alias("pair_no"), F.col("t")[F.col("at")]["value"].alias("q"), F.lit(None).cast("string").alias("i"), answer.alias("a"))


def question_pairs(qa: DataFrame, packed: DataFrame) -> DataFrame:
    return _qa_pairs(qa).unionByName(_packed_pairs(packed))


def count_statistics(pairs: DataFrame) -> tuple[Languages, Endings, int]:
    """Language words and text endings of all pairs, counted on the workers and summed before the driver sees them, and the number of pairs.

    A context whose share is of the same class as that of the context one word shorter is left out: the shorter
    one then answers for it.  Single words all stay.
    """
    ns = [f"n{i}" for i in range(len(SMALL_WORDS))]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, pairs = Counts(), 0
        for b in batches:
            pairs += b.num_rows
            told = [(q or "", a) for q, a in zip(*(c.to_pylist() for c in b.columns), strict=True) if a and not says_nothing(a)]
            counts.count([q for q, _ in told], [a for _, a in told])
            if counts.full():
                yield counts.batch()
        yield counts.batch()
        total = [pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([None], pa.string()), *(pa.array([pairs if i == 0 else 0]) for i in range(len(ns)))]
        yield pa.RecordBatch.from_arrays(total, names=["key", "rest", "word", *ns])

    rows = pairs.select("q", "a").mapInArrow(count, SCHEMA)
    sums = rows.groupBy("key", "rest", "word").agg(*(F.sum(n).alias(n) for n in ns))
    kept = materialize(sums.filter(F.col("key").isNull() | (F.col("n0") >= TRUSTED)), "statistics")

    word = F.col("word")
    words = kept.filter("key is null and word is not null").select(F.explode(F.array(word, F.concat(F.lit("~"), F.substring(word, -3, 3)))).alias("word"), *ns)
    words = words.groupBy("word").agg(*(F.sum(n).alias(n) for n in ns))
    total = tuple(n or 0 for n in words.agg(*(F.sum(n) for n in ns)).first())
    languages, endings = Languages(), Endings()
    languages.learn(((r["word"], tuple(r[n] for n in ns)) for r in words.filter(" + ".join(ns) + f" >= {KNOWN}").toLocalIterator()), total)

    share = F.col("n1") / F.col("n0")
    verdict = sum((F.when(share < x, 1).otherwise(0) for x in VERDICTS), F.lit(0))
    pairs_in_all = kept.filter("key is null and word is null").agg(F.sum("n0")).first()[0] or 0
    ends = kept.filter("key is not null").select("key", "rest", "word", "n0", "n1", verdict.alias("verdict"))
    shorter = ends.select(F.col("key").alias("rest"), F.col("verdict").alias("so"))
    telling = ends.filter("word is null").join(shorter, "rest").filter("verdict <> so").select("key", "n0", "n1", "word")
    contexts = ends.filter("word is not null").select("key", "n0", "n1", "word").unionByName(telling)
    endings.learn((r["key"], r["n0"], r["n1"], r["word"]) for r in contexts.toLocalIterator())
    return languages, endings, pairs_in_all


def fit_tagger(pairs: DataFrame, sample: int = SAMPLE) -> Tagger:
    """Statistics of all pairs; the field is fitted on the at most ``sample`` pairs with the smallest hashes.

    Rows whose hash is clearly too large stay on the workers, so the driver sees about ``sample`` rows from any
    number of partitions.
    """
    order = F.xxhash64("tab", "rec_id", "pair_no")
    languages, endings, total = count_statistics(pairs)
    share = min(1.0, (1.2 * sample + 200) / max(1, total))
    kept = pairs.select("q", "i", "a", order.alias("h")).filter(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    rows = kept.orderBy(F.pmod("h", F.lit(1 << 30)), "h", "q", "a").limit(sample).collect()
    return Tagger().fit([(r["q"] or "", r["i"] or "", r["a"] or "") for r in rows], (languages, endings))


OUT = "tab string, rec_id bigint, pair_no bigint, defect string"


def find_defects(pairs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(tab, rec_id, pair_no, defect) of every defective pair, each once.

    ``pairs``: (tab, rec_id, pair_no, q, i, a).  A pair without answering turn, with a null, blank or merely
    formal answer is 'empty'; others are 'refusal', 'copy', 'truncated' or 'language', the first that holds.
    A null question can only have an empty answer, a refusal or a truncated one.  The fitted models are broadcast;
    they grow with the vocabulary of words and telling contexts seen at least KNOWN and TRUSTED times.
    """
    model = pairs.sparkSession.sparkContext.broadcast(fit_tagger(pairs, sample))

    def tag(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = model.value.defect
        for b in batches:
            found = [judge(q, i, a) for q, i, a in zip(*(c.to_pylist() for c in b.columns[3:]), strict=True)]
            out = pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(found, pa.string())], names=["tab", "rec_id", "pair_no", "defect"])
            yield out.filter(out.column(3).is_valid())

    named = pairs.select("tab", F.col("rec_id").cast("bigint").alias("rec_id"), F.col("pair_no").cast("bigint").alias("pair_no"), "q", "i", "a")
    return named.mapInArrow(tag, OUT).distinct()
