"""Sentence spans by semi-Markov dynamic programming.

Whole spans between candidate ends are scored jointly: the span's length, its opening word, its closing word, whether its
quotations and brackets balance and whether it begins or ends inside one.  The best chain of spans through a paragraph is
found by dynamic programming over all candidates; how far it looks back is bounded by the length score alone: it stops
where no span that begins earlier can win.

Defined results: null, empty and blank texts give no sentence; a text without any ending is one sentence; blank lines
end a paragraph and so a sentence, a single line break does not; in Thai, white space ends a sentence.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import map_batches

UNLIKELY = -8.0  # of an opening or closing word that doesn't belong to a boundary
LONG_QUOTE = 1200  # from this length on, a quotation or bracket may be a pairing by mistake

# Words after which a full stop is part of the word; a name, number or reference follows.
LEADING = frozenset(
    "dr prof mr mrs ms st mt univ fig figs eq eqs ref refs sect sec no nos app suppl tab vol pp p ch v ver vs cf e.g i.e resp ca approx "
    "aprox env syn sp subsp var cv art nr núm bzw abb s.d tabl рис г гл стр ок см им п pr sr sra d z u д т т.е т.д jan feb mar apr jun jul др nov "
    "aug sept sep oct nov dec ph.d gen ex ej lat b.v inc dept ed eds al а.е núm pág pag col hr esp incl excl max min avg temp ad lib डॉ "
    "د e i n.s"
    .split()
)
# Words that also end sentences.
TRAILING = frozenset("etc yr ff a.m p.m п и.т.д т.д т.п lib temp".split())
_END = re.compile(
    r"(?:\.{2,}|…|[.!?。！？।؟۔]+)(?:[”’\"'»\)\]」』“*_]|\s[»])*(?:\[\^?\d+(?:\s?[,–-]\s?\d+)*\])*"
)
_PARA = re.compile(r"\r?\n[ \t]*\r?\n\s*")
_THAI = re.compile(r"[฀-๿]")
_THAI_GAP = re.compile(r"(?<=[฀-๿])\s+(?=\S)")
_LAST = re.compile(r"[^\s(\[“\"«„]+$")
_LATIN_TAIL = re.compile(r"(?<=[぀-ヿ一-鿿가-힣])[A-Za-z.]+$")
_ORDINAL = re.compile(r"\b(?:[Aa]m|[Vv]om|[Zz]um|[Bb]is|[Aa]b|[Dd]e[rsn]|[Dd]em)\s\d{1,2}$")
_CJK_END = set("。！？")
_STRONG = set("。！？।؟۔")
_OPEN_Q, _CLOSE_Q = "“«„「『‹", "”»“」』›"
_PAIRS = {"(": ")", "[": "]", "「": "」", "『": "』", "«": "»", "“": "”", "„": "“", "（": "）"}
_MARKS = re.compile(r"[()\[\]「」『』«»“”„\"（）]")


def _balance(text: str) -> int:
    """Quotation marks and brackets left open or closed without an opening."""
    if not _MARKS.search(text):
        return 0
    stack: list[str] = []
    bad = 0
    for m in _MARKS.finditer(text):
        c = m.group()
        if stack and c == stack[-1]:
            stack.pop()
        elif c == '"':
            if m.start() and text[m.start() - 1].isdigit():  # inches, seconds
                continue
            stack.append('"')
        elif c in _PAIRS:
            stack.append(_PAIRS[c])
        else:
            bad += 1
    return bad + len(stack)


def _opening(text: str, at: int, stop: int) -> float:
    """Score of a sentence that begins at ``at``."""
    c = text[at]
    word = text[at : min(stop, at + 24)].split(None, 1)[0]
    if c in "¿¡" or (c in _OPEN_Q + "\"'(" and len(word) > 1):
        return 1.0
    if c in "—–-,;:、，)":
        return -4.0
    if c.isupper():
        return 1.0
    if c.islower():
        low = word.rstrip(".,").lower()
        if any(x.isupper() or x.isdigit() for x in word[1:]) and not word[1:2] == ".":
            return -0.4  # mRNA, pH
        if "α" <= c <= "ω" or low in ("n.s", "n.d"):
            return -0.2
        return -3.2
    if c.isdigit():
        return -1.0 if word[-1].isalpha() and len(word) > 2 else -1.6
    return 0.8  # scripts without case


def _closing(text: str, start: int, m: re.Match) -> float:
    """Score of a sentence that ends with the mark ``m``."""
    mark = m.group()
    t = mark[0]
    if t in _STRONG:
        return 3.0
    if t in "!?":
        return 2.2
    if t == "…" or mark.startswith(".."):
        return 0.9
    w = _LAST.search(text, max(start, m.start() - 24), m.start())
    word = w.group().strip("*_'") if w else ""
    if tail := _LATIN_TAIL.search(word):
        word = tail.group()
    low = word.lower()
    if not word:
        return -2.0
    if low in TRAILING:
        return 0.35
    if low in LEADING:
        return -3.5
    if len(word) == 1 and word.isalpha():
        return -3.5 if word.isupper() or word in "zduadtпт" else -1.0
    if word.isdigit() and len(word) < 3 and _ORDINAL.search(text, max(start, m.start() - 8), m.start()):
        return -3.5
    if "." in word and word.replace(".", "").isalpha() and len(word) <= 5:
        return -1.5
    return 1.7


def _quoted(text: str, lo: int, hi: int, ends: list[tuple[int, float, float]]) -> list[tuple[int, float, float]]:
    """Candidates inside a quotation or bracket that closes in the paragraph lose what speaks for them, the less the longer it is."""
    stack: list[tuple[str, int]] = []
    inside: list[tuple[int, int]] = []
    for m in _MARKS.finditer(text, lo, hi):
        c = m.group()
        if c == '"' and m.start() and text[m.start() - 1].isdigit():  # inches, seconds
            continue
        if stack and c == stack[-1][0]:
            at = stack.pop()[1]
            if not stack:
                inside.append((at, m.start()))
        elif c == '"':
            stack.append(('"', m.start()))
        elif c in _PAIRS:
            stack.append((_PAIRS[c], m.start()))
    out = []
    k = 0
    for at, close, start in ends:
        while k < len(inside) and inside[k][1] < at:
            k += 1
        if k < len(inside) and inside[k][0] < at - 1 and inside[k][1] >= at:
            keep = min(1.0, max(0.0, (inside[k][1] - inside[k][0] - LONG_QUOTE) / LONG_QUOTE))
            close, start = (v * keep if v > 0 else v for v in (close, start))
        out.append((at, close, start))
    return out


def _paragraph(text: str, lo: int, hi: int, out: list[tuple[int, int]]) -> None:
    thai = _THAI.search(text, lo, hi) is not None
    ends: list[tuple[int, float, float]] = []  # (offset after the end, scores of the words that close and open there)
    for m in _END.finditer(text, lo, hi):
        e = m.end()
        mark = m.group()
        t = mark[0]
        nxt = text[e] if e < hi else ""
        if not nxt:
            break
        space = nxt.isspace()
        if t == "." and not space and not mark.startswith(".."):
            # a stop inside a word, number or address; a missing space after a plain word counts
            prev = text[max(lo, m.start() - 3) : m.start()]
            plain = len(prev) == 3 and prev.isalpha() and prev.islower() and nxt.isupper() and text[e + 1 : e + 2].islower()
            if not plain or "://" in text[text.rfind(" ", lo, m.start()) + 1 : m.start()]:
                if not (len(mark) > 1 and nxt.isupper()):
                    continue
        elif t in "!?" and not space and not nxt.isupper() and len(mark) == 1 and t.isascii():
            continue
        k = e
        while k < hi and text[k].isspace():
            k += 1
        if k >= hi:
            break
        first = text[k]
        if t in _CJK_END:
            if len(mark) > 1 and not space and first not in "「『“(（" and (first in "とって，、,；" or "぀" <= first <= "ゟ"):
                continue
        close = _closing(text, lo, m)
        start = _opening(text, k, hi)
        if close < -3 and (start < 0.9 or not text[m.start() - 1 : m.start()].islower()):
            close = UNLIKELY
        if t == "." and close < 1 and start > 0:
            start *= 0.4
        if start <= -3 and t not in _STRONG:
            start = UNLIKELY
        ends.append((k, close, start))
    if thai:
        have = {k for k, _, _ in ends}
        ends += [(m.end(), 4.0, 0.0) for m in _THAI_GAP.finditer(text, lo, hi) if m.end() not in have]
        ends.sort()
    marks = _MARKS.search(text, lo, hi) is not None
    if marks and ends:
        ends = _quoted(text, lo, hi, ends)
    if not any(close + start > 0 for _, close, start in ends):
        out.append((lo, hi))
        return
    cuts = [lo] + [k for k, _, _ in ends] + [hi]
    closing = [0.0] + [c for _, c, _ in ends] + [0.0]
    opening = [0.0] + [s for _, _, s in ends] + [0.0]
    n = len(cuts)
    best = [0.0] + [-1e18] * (n - 1)  # of the chains up to a candidate, without the word that opens the next span
    most = [0.0] * n  # the best of any chain up to here, with that word
    back = [0] * n
    for j in range(1, n):
        sure = j == n - 1 or closing[j] + opening[j] > 2.4
        for i in range(j - 1, -1, -1):
            size = cuts[j] - cuts[i]
            long = (size - 600) / 300 if size > 600 else 0.0
            if most[i] + closing[j] - long <= best[j]:
                break  # neither this span nor one that begins earlier
            s = best[i] + opening[i] + closing[j] - long
            if s <= best[j]:
                continue
            uneven = _balance(text[cuts[i] : cuts[j]]) if marks else 0
            s -= 6.0 * uneven
            if size < 12 and not any(c in _STRONG for c in text[cuts[i] : cuts[j]]):
                s -= 0.5
            if s > best[j]:
                best[j], back[j] = s, i
            if i == j - 1 and not uneven and sure and (i == 0 or closing[i] + opening[i] > 2.4):
                break  # a sure span between two sure boundaries: no longer one can win
        most[j] = max(most[j - 1], best[j] + opening[j])
    spans = []
    j = n - 1
    while j > 0:
        spans.append((cuts[back[j]], cuts[j]))
        j = back[j]
    out.extend(reversed(spans))


def spans(text: str | None) -> list[tuple[int, int]]:
    """Offsets (first character, end without trailing blanks) of the sentences of ``text``, in order."""
    if not text or text.isspace():
        return []
    raw: list[tuple[int, int]] = []
    lo = 0
    for m in _PARA.finditer(text):
        if m.start() > lo and not text[lo : m.start()].isspace():
            k = lo
            while text[k].isspace():
                k += 1
            _paragraph(text, k, m.start(), raw)
        lo = m.end()
    if lo < len(text) and not text[lo:].isspace():
        while text[lo].isspace():
            lo += 1
        _paragraph(text, lo, len(text), raw)
    out = []
    for a, b in raw:
        s = text[a:b].rstrip()
        if s:
            out.append((a, a + len(s)))
    return out


def sentence_rows(df: DataFrame, key: str, text: str, field_name: str, with_text: bool = True) -> DataFrame:
    """(field_name, row_key, sent_pos, start_char, end_char[, sentence]) for every sentence of every row.

    Null and blank texts give no row; repeated rows each give their own sentences.  Other columns are not read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols: tuple[list, ...] = ([], [], [], [], [])
        for key_, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for n, (a, b) in enumerate(spans(value)):
                for c, v in zip(cols, (key_, n, a, b, value[a:b] if with_text else None), strict=True):
                    c.append(v)
        arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.string())]
        return pa.record_batch(arrays, names=["row_key", "sent_pos", "start_char", "end_char", "sentence"])

    src = df.select(F.col(key).cast("long").alias("row_key"), F.col(text).alias("value")).where("value is not null")
    got = map_batches(src, run, "row_key long, sent_pos int, start_char long, end_char long, sentence string")
    return got.withColumn("field_name", F.lit(field_name))
