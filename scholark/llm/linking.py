"""Free-entered names to a canonical list by a prefix-filter set-similarity join.

A name is the set of its letter pairs (numbered where they repeat).  Tokens are ordered by global rarity, only the rare
prefix of each set is joined, length and positional filters cut the candidates, Jaccard is computed exactly, and the
entry of the highest Jaccard that agrees part by part (each word within a few edits, or as its abbreviation) is kept; the
rest is reported as unmatched.  Words that add a detail are learned from the values: they stand beside whole listed names.

The reference lists are of fixed size and go to every worker; the free-entered side is reduced to its distinct values
first, so a value that holds a third of all rows is linked once.

Defined results: null and blank values are no values and give no row; ties go to the smaller reference id; a value
without a match has the reference id ``none``.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chars import normalise
from .runtime import cut

THRESHOLD = 0.45
MOST_EDITS = 2
NONE = "none"
# Words that add a detail to a listed name, or join its parts, in any such list; others are learned.
DETAIL = frozenset(
    "strain subsp var spp sp complex type isolate in remission stage i ii iii iv syndrome severe modified mild acute chronic suspected probable "
    "patients patient with kit assay version v house inhouse electronic online print open access edition issn "
    "vol volume issue the of and for on minor major protocol cases case s l nov cf aff like".split()
)
SMALL = frozenset("the of and for on in a an".split())
KEPT = 50_000
LEAST_NAMES = 3  # a word is a detail if it stands beside so many different listed names
_WORDS = re.compile(r"[^\W_]+")
_PAREN = re.compile(r"[(\[]([^()\[\]]{1,40})[)\]]")


_VOWELS = re.compile(r"[aeiouy]+")
_CODE = re.compile(r"[a-z]?\d+[a-z]?")


def words_of(value: str, gap: str = "") -> list[str]:
    """Words in one form; parts joined by a hyphen are one word, or words of their own with a blank as ``gap``."""
    return _WORDS.findall(normalise(value).casefold().replace("-", gap))


def stem(word: str, groups: int) -> str:
    """A word cut before its vowel group number ``groups``, as abbreviations of titles are; ``journal`` is always j."""
    if word == "journal":
        return "j"
    for k, m in enumerate(_VOWELS.finditer(word)):
        if k >= groups and m.start() > 2:
            return word[: m.start()]
    return word


def shortens(short: str, word: str) -> bool:
    """Whether ``short`` abbreviates ``word``: its beginning, or a contraction of three letters or more."""
    if word.startswith(short):
        return len(short) > 1 or word == "journal"
    if len(short) < 3 or len(short) >= len(word) or (short[0], short[-1]) != (word[0], word[-1]):
        return False
    rest = iter(word)
    return all(c in rest for c in short)


def pairs(text: str) -> list[str]:
    """Letter pairs of ``text`` with its edges, numbered where they repeat."""
    seen: Counter[str] = Counter()
    out = []
    for k in range(len(text) - 1):
        p = text[k : k + 2]
        seen[p] += 1
        out.append(p if seen[p] == 1 else f"{p}{seen[p]}")
    return out


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions, or ``most + 1`` beyond ``most``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    # only the band within ``most`` of the diagonal can stay below it
    n, far = len(b), most + 1
    older: list[int] = []
    before: list[int] = []
    row = [j if j <= most else far for j in range(n + 1)]
    for i, x in enumerate(a, 1):
        older, before = before, row
        row = [far] * (n + 1)
        if i <= most:
            row[0] = i
        for j in range(max(1, i - most), min(n, i + most) + 1):
            y = b[j - 1]
            v = before[j - 1] if x == y else before[j - 1] + 1
            if before[j] < v:
                v = before[j] + 1
            if row[j - 1] < v:
                v = row[j - 1] + 1
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2] and older[j - 2] < v:
                v = min(v, older[j - 2] + 1)
            row[j] = v
        if min(row) > most:
            return far
    return min(row[n], far)


class Reference:
    """The canonical list of one kind: its written forms, their token sets and the rare-prefix index."""

    def __init__(self, kind: str, entries: Iterable[tuple[str, str]], short: Iterable[tuple[str, str]] = ()) -> None:
        self.kind = kind
        self.acronyms: dict[str, str] = {}
        names = sorted(entries)
        by_name = {n: i for i, n in names}
        for form, full in short:
            if full in by_name:
                self.acronyms.setdefault("".join(words_of(form)), by_name[full])
        self.forms: list[tuple[str, list[str], str]] = []  # (reference id, words, letters)
        self.full: dict[int, list[str]] = {}  # the whole words of abbreviated forms
        for ref, name in names:
            w = [x for x in words_of(name) if x not in SMALL]
            forms = [w]
            if kind == "taxon" and len(w) == 2:
                forms += [[w[0][0], w[1]], [w[0][:3], w[1]]]
            if len(w) == 2 or kind == "method":
                forms.append(w[1:] + w[:1])
            if kind == "journal":
                for cut in ([x if len(x) <= keep else stem(x, groups) for x in w] for keep, groups in ((0, 1), (6, 2), (7, 1), (7, 2), (8, 2))):
                    self.full[len(self.forms) + len(forms)] = w
                    forms.append(cut)
            if kind == "method":
                forms += [[x if x != "sequencing" else "seq" for x in w]]
            for f in forms:
                self.forms.append((ref, f, "".join(f)))
        self.order: dict[str, int] = {}
        self.matched: dict[str, tuple[str, float] | None] = {}  # values differ in case, blanks and details more than in words
        self.vocabulary = {x for _, f, _ in self.forms for x in f}
        self.detail = DETAIL
        self.starts: dict[str, list[tuple[str, list[str]]]] = defaultdict(list)
        for ref, name in names:
            if w := words_of(name):
                self.starts[w[0]].append((ref, w))

    def beside(self, value: str) -> Iterator[tuple[str, str]]:
        """(word, reference id): what stands beside a whole listed name in ``value``."""
        words = words_of(value)
        for k, first in enumerate(words):
            for ref, w in self.starts.get(first, ()):
                if len(words) > len(w) and words[k : k + len(w)] == w:
                    for x in (*words[:k], *words[k + len(w) :]):
                        yield x, ref

    def learn(self, details: Iterable[str]) -> None:
        """Take words as details, unless they belong to a listed name."""
        self.detail = DETAIL | {w for w in details if w not in self.vocabulary}

    def rank(self, frequency: Counter[str]) -> None:
        """Order tokens by global rarity and index the rare prefix of every form."""
        self.matched = {}
        known = {t for _, _, s in self.forms for t in pairs(s)}
        self.order = {t: k for k, t in enumerate(sorted(known, key=lambda t: (frequency.get(t, 0), t)))}
        self.sets = [sorted(self.order[t] for t in set(pairs(s))) for _, _, s in self.forms]
        self.bags = [frozenset(s) for s in self.sets]
        self.index: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for n, s in enumerate(self.sets):
            for place, t in enumerate(s[: self._prefix(len(s))]):
                self.index[t].append((n, place))
        self.exact = {}
        for n, (_, _, s) in enumerate(self.forms):
            self.exact.setdefault(s, n)

    @staticmethod
    def _prefix(size: int) -> int:
        return size - -(-int(size * THRESHOLD * 1000) // 1000) + 1

    def candidates(self, letters: str) -> list[tuple[float, int]]:
        """(exact Jaccard, form) of every form at the threshold or above, best first."""
        tokens = pairs(letters)
        size = len(tokens)
        if not size:
            return []
        mine = sorted(self.order[t] for t in tokens if t in self.order)
        unknown = size - len(mine)  # rarest of all: they come first and match nothing
        got: dict[int, int] = {}
        for place, t in enumerate(mine[: max(0, self._prefix(size) - unknown)]):
            for n, other in self.index.get(t, ()):
                if n in got:
                    continue
                m = len(self.sets[n])
                if m < THRESHOLD * size or size < THRESHOLD * m:
                    continue
                # positional filter: what can still be shared from here on
                most = min(len(mine) - place, m - other)
                if most < THRESHOLD / (1 + THRESHOLD) * (size + m):
                    continue
                got[n] = 1
        own = frozenset(mine)
        out = []
        for n in got:
            both = len(own & self.bags[n])
            j = both / (size + len(self.bags[n]) - both)
            if j >= THRESHOLD:
                out.append((j, n))
        out.sort(key=lambda x: (-x[0], self.forms[x[1]][0], x[1]))
        return out

    def _agrees(self, words: list[str], letters: str, n: int) -> bool:
        """Whether the value and form ``n`` agree part by part, each word within a few edits or as an abbreviation."""
        _, form, whole = self.forms[n]
        if n in self.full:
            full = self.full[n]
            return len(words) == len(full) and all(shortens(w, f) or edits(w, f, 1) <= 1 for w, f in zip(words, full, strict=True))
        most = 1 if len(whole) < 8 else MOST_EDITS
        if edits(letters, whole, most) > most:
            return False
        if len(words) == len(form):
            for w, f in zip(words, form, strict=True):
                room = 0 if len(f) == 1 else max(1, min(MOST_EDITS, len(f) // 4))
                if edits(w, f, room) > room:
                    return False
        elif self.kind == "taxon" and len(form[0]) <= 3 and letters[: len(form[0])] != form[0]:
            return False
        return True

    def _match(self, words: list[str]) -> tuple[str, float] | None:
        """The agreeing entry of the highest exact Jaccard; the smaller reference id on ties."""
        key = " ".join(words)
        if key not in self.matched:
            if len(self.matched) >= KEPT:
                self.matched.clear()
            self.matched[key] = self._search(words, "".join(words))
        return self.matched[key]

    def _search(self, words: list[str], letters: str) -> tuple[str, float] | None:
        n = self.exact.get(letters)
        if n is not None:
            return self.forms[n][0], 1.0
        for j, n in self.candidates(letters):
            if self._agrees(words, letters, n):
                return self.forms[n][0], j
        return None

    def link(self, value: str) -> tuple[str, float]:
        """(reference id or 'none', Jaccard of the letter pairs)."""
        words = words_of(value)
        if not words:
            return NONE, 0.0
        # as entered, without what stands in brackets, and with the parts of hyphenated words apart
        bases = [words]
        text = normalise(value)
        if "(" in text or "[" in text:
            bases.append(words_of(_PAREN.sub(" ", text)))
        if "-" in text:
            bases += [words_of(text, " "), *([words_of(_PAREN.sub(" ", text), " ")] if len(bases) > 1 else [])]
        tries: dict[str, list[str]] = {}
        for base in bases:
            once = [w for w, after in zip(base, [*base[1:], ""], strict=False) if w != after]
            kept = [w for w in once if (w not in self.detail or w in self.vocabulary) and not _CODE.fullmatch(w)]
            # details go, first those that belong to no listed name
            for t in (base, [w for w in base if w not in SMALL], kept, [w for w in once if w not in self.detail and not _CODE.fullmatch(w)]):
                tries.setdefault(" ".join(t), t)
            for x in dict.fromkeys(once):
                if x in self.detail and x in self.vocabulary:
                    t = [w for w in kept if w != x]
                    tries.setdefault(" ".join(t), t)
        tries.pop("", None)
        for t in tries.values():
            letters = "".join(t)
            if letters in self.acronyms:
                return self.acronyms[letters], 1.0
            if letters in self.exact:
                return self.forms[self.exact[letters]][0], 1.0
        best: tuple[str, float] | None = None
        for t in tries.values():
            got = self._match(t)
            if got and (best is None or got[1] > best[1]):
                best = got
        if best is None and self.kind == "taxon":
            best = self._details(words)
        return best or (NONE, 0.0)

    def _details(self, words: list[str]) -> tuple[str, float] | None:
        """A listed name followed by further detail."""
        for n in (2, 1):
            if len(words) > n:
                got = self._match(words[:n])
                if got:
                    return got
        return None


def references(entities: Iterable[tuple[str, str, str]], short: Iterable[tuple[str, str]], journals: Iterable[tuple[str, str]]) -> dict[str, Reference]:
    """kind -> Reference, from (canonical_id, primary_name, entity_type), (form, full form) and (journal_id, name)."""
    short = sorted(short)
    by: dict[str, list[tuple[str, str]]] = defaultdict(list)
    for ref, name, kind in entities:
        by[kind].append((ref, name))
    out = {kind: Reference(kind, rows, short) for kind, rows in sorted(by.items())}
    out["journal"] = Reference("journal", journals)
    return out


def link_any(refs: dict[str, Reference], kind: str, value: str) -> tuple[str, float]:
    """Link within one kind, or within the best of all entity types for kind ``any``."""
    if kind != "any":
        return refs[kind].link(value)
    got = [refs[k].link(value) for k in sorted(refs) if k != "journal"]
    return max(got, key=lambda g: (g[0] != NONE, g[1])) if got else (NONE, 0.0)


def _counts(rows: list[tuple[str, str | None, str | None, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64()), strict=True)], names=["token", "kind", "ref", "n"])


def link_values(values: DataFrame, refs: dict[str, Reference]) -> DataFrame:
    """(kind, value, ref_id, similarity) for the distinct (kind, value) rows of ``values``.

    Token frequencies and detail words are counted over all distinct values.  Collected are only tokens of the reference
    lists, a number fixed by the lists' size, and words that stand beside ``LEAST_NAMES`` listed names or more.
    """
    spark = values.sparkSession
    # few bytes but much work a row: spread over all cores, where adaptive execution would join the partitions
    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    distinct = cut(values.select("kind", "value").distinct().repartition(spread))
    known = sorted({t for r in refs.values() for _, _, s in r.forms for t in pairs(s)})

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep, total = set(known), Counter()
        seen: set[tuple[str, str, str]] = set()
        for batch in batches:
            for kind, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total.update(t for t in pairs("".join(words_of(v))) if t in keep)
                for k in (kind,) if kind in refs else refs:
                    seen.update((k, w, ref) for w, ref in refs[k].beside(v))
            if len(seen) > 100_000:
                yield _counts([(w, k, ref, 1) for k, w, ref in seen])
                seen.clear()
        yield _counts([(t, None, None, n) for t, n in total.items()] + [(w, k, ref, 1) for k, w, ref in seen])

    counted = cut(distinct.mapInArrow(tokens, "token string, kind string, ref string, n long").groupBy("token", "kind", "ref").agg(F.sum("n").alias("n")))
    frequency = Counter({r["token"]: r["n"] for r in counted.where("kind is null").collect()})
    details = counted.where("kind is not null").groupBy("kind", "token").agg(F.count("*").alias("names")).where(F.col("names") >= LEAST_NAMES).collect()
    for kind, r in refs.items():
        r.learn(d["token"] for d in details if d["kind"] == kind)
        r.rank(frequency)
    shared = spark.sparkContext.broadcast(refs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = shared.value
        link = lru_cache(maxsize=50_000)(lambda kind, v: link_any(lists, kind, v))
        for batch in batches:
            got = [link(k, v) for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["kind", "value", "ref_id", "similarity"])

    return distinct.mapInArrow(run, "kind string, value string, ref_id string, similarity double")
