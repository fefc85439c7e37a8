"""One visual form for text: a compiled longest-match transducer over grapheme clusters.

The transducer maps full-width and half-width forms, decomposed accents, odd spaces, invisible characters and look-alike
letters in one left-to-right pass: the text is read as words and what lies between them, a word's script state is settled
when it is entered, and inside it every cluster is rewritten by the longest source in the trie that ends at a cluster's
end.  Its table is built once per process from rules: sources of several characters are accents with their bases (in any
order of the marks and partly composed), look-alikes with an accent, half-width letters with a voicing mark and joined
jamo.  ``compile_table`` rejects conflicting entries and entries whose output would be rewritten again, so the result is a
fixed point: ``normalise(normalise(x)) == normalise(x)``.

Defined results: null stays null, empty stays empty, a text without entries comes back unchanged (same object).
"""

from __future__ import annotations

import unicodedata
from itertools import permutations
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import map_batches

# Characters that take no room of their own.
INVISIBLE = "­͏؜᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩️﻿"
# Spaces that look like U+0020 (the ideographic space is handled by context).
SPACES = "               "
HYPHENS = "‐‑"
# Letters of other scripts that look like Latin ones, position by position.
CYRILLIC = "авеѕіјкмнорстухһԁԛԝѵӏҮАВЕЅІЈКМНОРСТУХҺԚԜѴӀ"
CYRILLIC_AS = "abesijkmhopctyxhdqwvlYABESIJKMHOPCTYXHQWVI"
GREEK = "ονρυιΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"
GREEK_AS = "ovpuiABEZHIKMNOPTYX"
ARMENIAN = "օոսհցզյՕՏԼ"
ARMENIAN_AS = "onuhgqjOSL"
CHEROKEE = "ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ"
CHEROKEE_AS = "ABCDEGHJKLMPRSTVWZ"
LATIN_ODD = "ɡɑ"
LATIN_ODD_AS = "ga"
# Latin letters that can stand in a Cyrillic word, and the letters they look like.
BACK = "aceiopxyABCEHIKMOPTXjs"
BACK_AS = "асеіорхуАВСЕНІКМОРТХјѕ"

ALWAYS, WIDE, JOINER, TO_LATIN, TO_CYRILLIC = range(5)

_CLUSTER = regex.compile(r"\X")
_PIECE = regex.compile(r"[\p{L}\p{N}][\p{L}\p{M}\p{N}\u00ad\u200b-\u200d\u2060\ufeff]*|[^\p{L}\p{N}]+")
_LATIN, _CYR, _GRK, _ARM, _CHR = (regex.compile(rf"\p{{{n}}}") for n in ("Latin", "Cyrillic", "Greek", "Armenian", "Cherokee"))
_LETTER = regex.compile(r"[\p{L}\p{N}]")
_MARK = regex.compile(r"\p{M}")
_CJK = regex.compile(r"[　-ヿ㐀-鿿가-힣｡-ﾟ]")
_SHAPING = regex.compile(r"[\p{Arabic}\p{Devanagari}\p{Bengali}\p{Tamil}\p{Thai}\p{Emoji_Presentation}]")
_LAST_CHECKED = 0x10000  # accents have their composed forms below


class Entry(NamedTuple):
    target: str
    context: int
    visual: bool  # whether the source differs from the target in its characters only, not in its looks


def _composed_sources(c: str) -> set[str]:
    """Every spelling of the composed character ``c`` in more than one character."""
    whole = unicodedata.normalize("NFD", c)
    if len(whole) < 2 or unicodedata.normalize("NFC", whole) != c:
        return set()
    base, marks = whole[0], whole[1:]
    out = set()
    for order in set(permutations(marks)):
        for k in range(len(marks)):
            first = unicodedata.normalize("NFC", base + "".join(order[:k]))
            if len(first) == 1:
                out.add(first + "".join(order[k:]))
    return {x for x in out if x != c and unicodedata.normalize("NFC", x) == c}


def compile_table() -> dict[int, dict[str, Entry]]:
    """State -> source -> entry, for words as they are and for Cyrillic words; raises on conflicts and chains."""
    tables: dict[int, dict[str, Entry]] = {TO_LATIN: {}, TO_CYRILLIC: {}}

    def add(src: str, dst: str, ctx: int, visual: bool = True) -> None:
        entry = Entry(dst, ctx, visual)
        for state in (TO_CYRILLIC,) if ctx == TO_CYRILLIC else (TO_LATIN,) if ctx == TO_LATIN else (TO_LATIN, TO_CYRILLIC):
            if tables[state].get(src, entry)[:2] != entry[:2]:
                raise ValueError(f"conflicting mapping for U+{ord(src[0]):04X}")
            tables[state][src] = entry

    for c in INVISIBLE:
        add(c, "", JOINER if c in "\u200c\u200d" else ALWAYS)
    for c in SPACES:
        add(c, " ", ALWAYS)
    add("\u3000", " ", WIDE)
    for c in HYPHENS:
        add(c, "-", ALWAYS)
    letters: list[tuple[str, str, int]] = []  # one letter that stands for another: may bear accents
    letters += [(chr(n), chr(n - 0xFEE0), WIDE) for n in range(0xFF01, 0xFF5F)]
    for lo, hi in ((0x1D400, 0x1D7FF), (0xFB00, 0xFB06), (0x2100, 0x2149), (0x2160, 0x217F)):
        for n in range(lo, hi + 1):
            k = unicodedata.normalize("NFKC", chr(n))
            if k != chr(n) and k.isascii() and k.isalnum() and (hi != 0x2149 or len(k) == 1):
                add(chr(n), k, ALWAYS)
    for n in range(0xFF65, 0xFFA0):  # half-width kana, alone and with a voicing mark
        k = unicodedata.normalize("NFKC", chr(n))
        if not _MARK.match(k):
            add(chr(n), k, ALWAYS)
        for mark in "\uff9e\uff9f":
            both = unicodedata.normalize("NFKC", chr(n) + mark)
            if len(both) == 1:
                add(chr(n) + mark, both, ALWAYS)
    for src, dst in zip(CYRILLIC + GREEK + ARMENIAN + CHEROKEE + LATIN_ODD, CYRILLIC_AS + GREEK_AS + ARMENIAN_AS + CHEROKEE_AS + LATIN_ODD_AS, strict=True):
        letters.append((src, dst, TO_LATIN))
    letters += [(src, dst, TO_CYRILLIC) for src, dst in zip(BACK, BACK_AS, strict=True)]
    by_base: dict[str, list[tuple[str, str]]] = {}
    for n in range(0xC0, _LAST_CHECKED):
        c = chr(n)
        for src in _composed_sources(c):
            add(src, c, ALWAYS)
            if len(src) == 2:
                by_base.setdefault(src[0], []).append((src[1], c))
    for src, dst, ctx in letters:
        add(src, dst, ctx)
        for mark, composed in by_base.get(dst, ()):
            if _MARK.match(mark) and src + mark not in tables[TO_CYRILLIC if ctx == TO_CYRILLIC else TO_LATIN]:
                add(src + mark, composed, ctx)
    add("\u00b5", "\u03bc", ALWAYS, False)
    for table in tables.values():
        for dst, ctx, _ in table.values():
            if any(d in table and table[d].context in (ctx, ALWAYS) for d in (dst, *dst)):
                raise ValueError(f"chained mapping to {dst!r}")
    return tables


class Word(NamedTuple):
    """What a word's letters are taken for."""

    table: int
    latin: frozenset[str]  # letters that stand for Latin ones
    back: bool  # its Latin letters stand for Cyrillic ones


_PLAIN = Word(TO_LATIN, frozenset(), False)


class Transducer:
    """Longest-match transducer: the tries of the table's sources, walked cluster by cluster."""

    def __init__(self) -> None:
        self.tables = compile_table()
        self.tries: dict[int, dict] = {}
        for state, table in self.tables.items():
            self.tries[state] = root = {}
            for src, entry in table.items():
                node = root
                for c in src:
                    node = node.setdefault(c, {})
                node[""] = entry
        self.scripts = tuple((s, frozenset(f)) for s, f in ((_CYR, CYRILLIC), (_GRK, GREEK), (_ARM, ARMENIAN), (_CHR, CHEROKEE)))
        self.odd, self.back = frozenset(LATIN_ODD), frozenset(BACK)

    def _state(self, w: str, text: str) -> Word:
        """The state of a word, from its letters; from the whole text where it holds no other script's letters."""
        found = [s.findall(w) for s, _ in self.scripts]
        odd = [c for c in w if c in self.odd]
        if not (odd or any(found)):
            return _PLAIN
        lat = len(_LATIN.findall(w)) - len(odd)
        true = [[c for c in f if c not in fakes] for f, (_, fakes) in zip(found, self.scripts, strict=True)]
        take: set[str] = set()
        for k in (0, 2, 3):  # scripts that bear no symbols
            script, fakes = self.scripts[k]
            if found[k] and not true[k] and (lat or (_LATIN.search(text) and not self._pure(text, script, fakes))):
                take |= fakes
        script, fakes = self.scripts[1]
        if lat or take:
            take |= fakes | self.odd
        elif found[1] and not true[1] and (w.isupper() or len(w) > 1) and _LATIN.search(text) and not self._pure(text, script, fakes):
            take |= fakes
        back = bool(lat and true[0]) and all(c in self.back for c in _LATIN.findall(w))
        return Word(TO_CYRILLIC if back else TO_LATIN, frozenset(take), back)

    @staticmethod
    def _inside(text: str, k: int) -> bool:
        """A Greek small letter stands for a Latin one only inside a word, not as a symbol of its own; nu also at
        a word's edge and before a digit, where no symbol is written so."""
        before, after = text[max(0, k - 1) : k], text[k + 1 : k + 2]
        if text[k] == "ν":
            return bool(_LATIN.match(before) or _LATIN.match(after) or after in GREEK + CYRILLIC and after or after.isdigit())
        return bool(before and after) and all(_LATIN.match(c) or c in GREEK + CYRILLIC for c in before + after)

    @staticmethod
    def _pure(text: str, script, fakes: frozenset[str]) -> bool:
        return any(c not in fakes for c in script.findall(text))

    def apply(self, text: str | None) -> tuple[str | None, int]:
        """(normalised text, number of visual differences removed)."""
        if not text or text.isascii():
            return text, 0
        out: list[str] = []
        hits = 0
        for piece in _PIECE.finditer(text):
            w = piece.group()
            if w.isascii():
                out.append(w)
                continue
            state = self._state(w, text) if _LETTER.match(w) else _PLAIN
            hits += self._walk(text, piece.start(), w, state, out)
        if not hits and "\u00b5" not in text:
            return text, 0
        done = "".join(out)
        if hits and _MARK.search(text):  # a mark that an invisible character parted from its base has met it now
            done = self.apply(done)[0]
        return done, hits

    def _walk(self, text: str, start: int, w: str, state: Word, out: list[str]) -> int:
        """Rewrites one piece of the text, cluster by cluster, by the longest source that holds there."""
        root, hits = self.tries[state.table], 0
        for m in _CLUSTER.finditer(w):
            cluster, at, k = m.group(), start + m.start(), 0
            while k < len(cluster):
                node, j, best, end = root.get(cluster[k]), k + 1, None, k
                while node is not None:
                    entry = node.get("")
                    if entry is not None and self._holds(entry.context, text, at + k, state):
                        best, end = entry, j
                    node = node.get(cluster[j]) if j < len(cluster) else None
                    j += 1
                if best is None:
                    out.append(cluster[k])
                    k += 1
                else:
                    hits += best.visual
                    out.append(best.target)
                    k = end
        return hits

    @staticmethod
    def _holds(kind: int, text: str, at: int, state: Word) -> bool:
        if kind == ALWAYS:
            return True
        c = text[at]
        if kind == TO_LATIN:
            return c in state.latin and (c not in "ριυν" or Transducer._inside(text, at))
        if kind == TO_CYRILLIC:
            return state.back
        near = text[max(0, at - 1) : at] + text[at + 1 : at + 2]
        if kind == JOINER:
            return not (near and all(_SHAPING.match(x) for x in near))
        if c.isalnum():
            return True
        # full-width punctuation and the ideographic space are at home between ideographs
        return not any(_CJK.match(x) for x in near) and not (_CJK.search(text) and not any("０" <= x <= "ｚ" for x in near))


_TRANSDUCER: Transducer | None = None


def transducer() -> Transducer:
    global _TRANSDUCER
    if _TRANSDUCER is None:
        _TRANSDUCER = Transducer()
    return _TRANSDUCER


def normalise(text: str | None) -> str | None:
    """The consistent form of ``text``."""
    return transducer().apply(text)[0]


def count_differences(text: str | None) -> int:
    """How many characters or sequences only look like, or invisibly add to, what is meant."""
    return transducer().apply(text)[1]


def normalise_column(df: DataFrame, key: str, text: str, field_name: str) -> DataFrame:
    """(field_name, row_key, normalised, differences) for every row of ``df``.

    ASCII texts are their own consistent form and never leave the JVM; only the rest passes the transducer.
    Null and empty texts give themselves and 0.  Other columns of ``df`` are not read.
    """
    src = df.select(F.col(key).cast("string").alias("row_key"), F.col(text).alias("value"))
    odd = F.coalesce(F.col("value").rlike(r"[^\x00-\x7F]"), F.lit(False))

    def fold(batch: pa.RecordBatch) -> pa.RecordBatch:
        t, seen, norm, diff = transducer(), {}, [], []
        for v in batch.column(1).to_pylist():
            got = seen.get(v)
            if got is None:
                got = seen[v] = t.apply(v)
            norm.append(got[0])
            diff.append(got[1])
        return pa.record_batch([batch.column(0), pa.array(norm, pa.string()), pa.array(diff, pa.int32())], names=["row_key", "normalised", "differences"])

    plain = src.where(~odd).select("row_key", F.col("value").alias("normalised"), F.lit(0).cast("int").alias("differences"))
    folded = map_batches(src.where(odd), fold, "row_key string, normalised string, differences int")
    return plain.unionByName(folded).select(F.lit(field_name).alias("field_name"), "row_key", "normalised", "differences")
