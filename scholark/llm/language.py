"""Language of documents and of their stretches by bit-sliced Bloom filters over character n-grams.

One filter serves all languages: slot ``i`` holds one bit per language, and the AND of an n-gram's slots is the set of
languages that contain it.  A text's popcount per language, less the count that false positives alone would give,
decides; a Viterbi pass with a cost per change divides mixed documents into stretches.

The filters are trained here, from a bounded sample of the labelled rows (``SAMPLE_DOCS`` a language, none longer than
``SAMPLE_CHARS``), in two rounds: labels first, then the units as the first model sees them, which drops wrong labels
and foreign stretches from the sample.  Everything else covers all rows and whole texts.

Defined results: null, empty and blank texts and texts without a sentence in a natural language get no stretch.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sentences import spans

SAMPLE_DOCS = 120
SAMPLE_CHARS = 2500
SLOTS = 1 << 19
HASHES = 3
CHANGE_COST = 9.0
SAME = 0.8
LEAST_KNOWN = 0.35
WORDS_KEPT = 300_000
LONGEST_WORD = 40

# Usual spellings of the languages' names: ISO 639-1, 639-2 (both) and English and own names.
NAMES = {
    "ar": "ara arabic العربية", "bg": "bul bulgarian", "cs": "ces cze czech čeština", "da": "dan danish dansk", "de": "deu ger german deutsch",
    "el": "ell gre greek", "en": "eng english", "es": "spa spanish español castellano castilian", "fa": "fas per persian farsi", "fi": "fin finnish suomi",
    "fr": "fra fre french français", "he": "heb hebrew", "hi": "hin hindi हिन्दी", "hu": "hun hungarian magyar", "id": "ind indonesian",
    "it": "ita italian italiano", "ja": "jpn japanese 日本語", "ko": "kor korean 한국어", "la": "lat latin", "nl": "nld dut dutch nederlands flemish",
    "no": "nor norwegian norsk nb nn", "pl": "pol polish polski", "pt": "por portuguese português", "ro": "ron rum romanian", "ru": "rus russian русский",
    "sv": "swe swedish svenska", "th": "tha thai ไทย", "tr": "tur turkish türkçe", "uk": "ukr ukrainian українська", "vi": "vie vietnamese",
    "zh": "zho chi chinese 中文 mandarin cmn",
}
CODES = {w: code for code, words in NAMES.items() for w in (code, *words.split())}

_TOKEN = re.compile(r"[぀-ヿ㐀-鿿]{1,2}|[฀-๿]{1,4}|[^\W\d_぀-ヿ㐀-鿿฀-๿]+(?:[’'][^\W\d_]+)*(?![\d_])")
_ASCII_TOKEN = re.compile(r"[A-Za-z]+(?:'[A-Za-z]+)*(?![\d_])")
_ASCII_UNIT = re.compile(r"[.!?]+[\")\]]*\s+|\n\s*")
_UNIT = re.compile(r"(?:[.!?…]+[\"”’»)\]]*(?:\s»)?(?=\s)|[。！？।؟]+[」』”）]*|\n)\s*|(?<=[฀-๿])\s+")
_OTHER = re.compile(r"[Ѐ-ӿ֐-ۿऀ-๿぀-ヿ㐀-鿿가-힣]")
_UNSPACED = re.compile(r"[぀-ヿ㐀-鿿฀-๿가-힣]{3}")
_WORDY = re.compile(r"(?<![\w.@/\\-])[^\W\d_]*[^\W\dA-Z_][^\W\d_]*(?![\w@/\\])")


def label_code(label: str | None) -> str | None:
    """ISO 639-1 code of a label in any usual spelling; None for missing, unknown and unreadable ones."""
    if not label:
        return None
    word = label.strip().lower()
    return CODES.get(word) or CODES.get(re.split(r"[-_ (]", word, maxsplit=1)[0])


def grams(token: str) -> Iterator[str]:
    """Character n-grams of a token: one and two signs of unspaced scripts, two to four of words with their edges."""
    if "぀" <= token[0] <= "鿿" or "฀" <= token[0] <= "๿":
        yield from token
        for k in range(len(token) - 1):
            yield token[k : k + 2]
        return
    w = " " + token.lower() + " "
    for n in (2, 3, 4):
        for k in range(len(w) - n + 1):
            yield w[k : k + n]
    if len(w) > 6:
        yield w


def sequence(token: str) -> bool:
    """Whether a long token is a sequence or a code, not a word: in capitals throughout, or of few different letters."""
    return len(token) > LONGEST_WORD and (token.isupper() or len(set(token)) < 8)


def _places(gram: str) -> list[int]:
    b = gram.encode("utf-8", "replace")
    h, g = zlib.crc32(b), zlib.adler32(b[::-1], 1) * 2654435761 | 1
    return [(h + k * g) % SLOTS for k in range(HASHES)]


class Filters:
    """The bit-sliced filters and their languages; picklable, ``SLOTS`` rows of one bit a language, in whole bytes."""

    def __init__(self, sets: dict[str, Iterable[str]]) -> None:
        self.langs = sorted(sets)
        self.slots = np.zeros((SLOTS, max(1, -(-len(self.langs) // 8))), np.uint8)
        for bit, lang in enumerate(self.langs):
            at = np.array([p for g in sets[lang] for p in _places(g)], np.int64)
            if len(at):
                self.slots[at, bit // 8] |= np.uint8(1 << bit % 8)
        fill = np.array([float(np.mean(self.slots[:, b // 8] >> np.uint8(b % 8) & np.uint8(1))) for b in range(len(self.langs))])
        self.false_positive = fill**HASHES
        self._start()

    def _start(self) -> None:
        self.index: dict[str, int] = {}
        self.table = np.zeros((4096, len(self.langs) + 1), np.float32)

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("langs", "slots", "false_positive")}

    def __setstate__(self, state) -> None:
        self.__dict__.update(state)
        self._start()

    def _row(self, token: str) -> int:
        if len(self.index) >= WORDS_KEPT:
            self._start()
        k = self.index[token] = len(self.index)
        if k >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        if not token or sequence(token):
            return k
        places = np.array([_places(g) for g in grams(token)], np.int64)
        masks = np.bitwise_and.reduce(self.slots[places], axis=1)
        hits = np.unpackbits(masks, axis=1, count=len(self.langs), bitorder="little").sum(0)
        n = len(masks)
        weight = 3.0 if token[0] >= "฀" else 1.0  # unspaced scripts: few grams a sign
        # of n grams, false positives alone set n * p bits; the rest is stretched to n again
        self.table[k, :-1] = weight * (hits - n * self.false_positive) / (1 - self.false_positive)
        self.table[k, -1] = weight * n
        return k

    def scores(self, tokens: list[str]) -> np.ndarray:
        """One row per token: corrected popcount of each language, and the number of grams."""
        if len(self.index) + len(tokens) >= WORDS_KEPT:
            self._start()
        index = self.index
        rows = [index[t] if t in index else self._row(t) for t in tokens]
        return self.table[rows]

    def units(self, parts: list[str]) -> np.ndarray:
        """Popcounts of each part of a text, and its number of grams."""
        tokens: list[str] = []
        starts = []
        for part in parts:
            starts.append(len(tokens))
            if part.isascii():
                found = _ASCII_TOKEN.findall(part)
            else:
                found = _TOKEN.findall(part)
                if len(_OTHER.findall(part)) >= 4:
                    # names in Latin letters belong to the stretch around them
                    found = [t for t in found if t[0] > "ɏ"]
            tokens += found or [""]
        return np.add.reduceat(self.scores(tokens), starts, axis=0)


def _parts(text: str) -> list[str]:
    unit = _ASCII_UNIT if text.isascii() else _UNIT
    cuts = [0] + [m.end() for m in unit.finditer(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:] + [len(text)], strict=True) if b > a]


def _profile(units: list[str]) -> dict[str, float]:
    """Share of the units that hold each gram (an upper bound from the shares of the tokens that hold it)."""
    tokens = Counter(t for u in units for t in set(_TOKEN.findall(u)))
    out: dict[str, float] = defaultdict(float)
    for t, c in tokens.items():
        if c > 1 or len(units) < 50:
            for g in set(grams(t)):
                out[g] += c / len(units)
    return {g: min(1.0, v) for g, v in out.items()}


def _cosine(a: dict[str, float], b: dict[str, float]) -> float:
    dot = sum(v * b.get(g, 0.0) for g, v in a.items())
    return dot / (sum(v * v for v in a.values()) * sum(v * v for v in b.values()) or 1.0) ** 0.5


def _sets(profiles: dict[str, dict[str, float]], least: float, rel: float) -> dict[str, set[str]]:
    top: dict[str, float] = {}
    for p in profiles.values():
        for g, v in p.items():
            if v > top.get(g, 0.0):
                top[g] = v
    return {code: {g for g, v in p.items() if v >= least and v >= rel * top[g]} for code, p in profiles.items()}


def fit(rows: Iterable[tuple[str, str]], counts: dict[str, int] | None = None) -> Filters:
    """Filters from (text, language code) rows, whose labels may be wrong in part; counts: labelled rows in all.

    A label whose texts read like those of a label with more rows (cosine of the gram profiles at least ``SAME``) is
    never right, and drops out.
    """
    docs: dict[str, list[list[str]]] = defaultdict(list)
    for text, code in rows:
        docs[code].append(_parts(text))
    docs = {c: d for c, d in docs.items() if len(d) >= 3}
    counts = counts or {c: len(d) for c, d in docs.items()}
    profiles = {c: _profile([" ".join(u) for u in d]) for c, d in docs.items()}
    order = sorted(docs, key=lambda c: (-counts[c], c))
    kept: list[str] = []
    for code in order:
        if all(_cosine(profiles[code], profiles[k]) < SAME for k in kept):
            kept.append(code)
    if not kept:
        return Filters({})
    first = Filters(_sets({c: profiles[c] for c in kept}, 0.08, 0.3))
    again: dict[str, list[str]] = defaultdict(list)
    for code in kept:
        for parts in docs[code]:
            for u, row in zip(parts, first.units(parts), strict=True):
                if row[-1] >= 12:
                    again[first.langs[int(np.argmax(row[:-1]))]].append(u)
    return Filters(_sets({c: _profile(u) for c, u in again.items() if len(u) >= 3}, 0.002, 0.12))


def _viterbi(score: np.ndarray) -> list[int]:
    best, back = score[0].copy(), []
    for row in score[1:]:
        top = int(best.argmax())
        jump = best[top] - CHANGE_COST
        stay = best >= jump
        back.append(np.where(stay, np.arange(len(best)), top))
        best = np.where(stay, best, jump) + row
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def prose(text: str) -> bool:
    """Whether the text holds at least one sentence in a natural language."""
    return _UNSPACED.search(text) is not None or sum(1 for _ in islice(_WORDY.finditer(text), 3)) == 3


def stretches(model: Filters, text: str | None) -> list[tuple[int, int, str, float]]:
    """(start, end, language, confidence) of each stretch of one language."""
    if not text or text.isspace() or not model.langs or not prose(text):
        return []
    got = model.units(_parts(text))
    whole = got.sum(0)
    winner = int(whole[:-1].argmax())
    total = float(whole[-1])
    cuts = [0]
    # leaving the winner gains at most what it lacks in all units together, and costs a change
    if float((got[:, :-1].max(1) - got[:, winner]).sum()) < CHANGE_COST:
        path = [winner]
        got = whole[None, :]
    else:
        path = _viterbi(got[:, :-1])
        if len(set(path)) == 1:
            path, got = path[:1], whole[None, :]
        else:
            at = spans(text)
            cuts = [a for a, _ in at]
            got = model.units([text[a:b] for a, b in at])
            path = _viterbi(got[:, :-1])
    if total < 6 or float(got[np.arange(len(path)), path].sum()) < LEAST_KNOWN * total:
        return []
    out: list[tuple[int, int, str, float]] = []
    lo = 0
    for k in range(1, len(path) + 1):
        if k == len(path) or path[k] != path[lo]:
            s = got[lo:k].sum(0)
            own, others = float(s[path[lo]]), np.delete(s[:-1], path[lo])
            second = float(others.max()) if len(others) else 0.0
            confidence = max(0.0, min(1.0, 0.5 * own / max(float(s[-1]), 1.0) + (own - second) / max(own, 1.0)))
            out.append((cuts[lo], cuts[k] if k < len(path) else len(text), model.langs[path[lo]], round(confidence, 4)))
            lo = k
    if len(out) == 1:
        out = [(0, len(text), out[0][2], out[0][3])]
    return out


def label_column(col):
    """JVM-side ``label_code``: null for missing and unknown labels."""
    word = F.lower(F.trim(col))
    table = F.create_map(*[F.lit(x) for kv in sorted(CODES.items()) for x in kv])
    return F.coalesce(F.try_element_at(table, word), F.try_element_at(table, F.split(word, r"[-_ (]", 2).getItem(0)))


def train(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Filters:
    """Filters from a bounded sample of the labelled rows: about ``SAMPLE_DOCS`` a language, picked by the key's hash."""
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"), label_column(F.col(lang)).alias("code"), F.length(text).alias("n"))
    rows = rows.where(F.col("code").isNotNull() & F.col("n").between(20, SAMPLE_CHARS))
    counts = {r["code"]: r["c"] for r in rows.groupBy("code").agg(F.count("*").alias("c")).collect()}
    if not counts:
        return Filters({})
    share = F.create_map(*[F.lit(x) for c, n in sorted(counts.items()) for x in (c, min(1_000_000, 1_000_000 * SAMPLE_DOCS // n))])
    picked = rows.where(F.pmod(F.xxhash64("k"), F.lit(1_000_000)) < F.element_at(share, F.col("code"))).select("k", "t", "code").collect()
    return fit(((r["t"], r["code"]) for r in sorted(picked, key=lambda r: str(r["k"]))), counts)


def detect(df: DataFrame, model: Filters, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, label_lang, start_char, end_char, true_lang, confidence, n_stretches): one row per stretch of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [], [])
            for k, t, code in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found = stretches(m, t)
                for a, b, true, conf in found:
                    for c, v in zip(cols, (k, code, a, b, true, conf, len(found)), strict=True):
                        c.append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int32())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[key, "label_lang", "start_char", "end_char", "true_lang", "confidence", "n_stretches"])

    src = df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), label_column(F.col(lang)).alias("c")).where("t is not null")
    return src.mapInArrow(run, f"`{key}` long, label_lang string, start_char long, end_char long, true_lang string, confidence double, n_stretches int")


def relabelled(detected: DataFrame) -> DataFrame:
    """The stretches of documents whose label is missing, wrong or not enough."""
    return detected.where((F.col("n_stretches") > 1) | F.col("label_lang").isNull() | (F.col("label_lang") != F.col("true_lang")))
