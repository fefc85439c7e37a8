"""Splitting oversized texts at natural boundaries by dynamic programming.

Candidate boundaries carry a penalty (paragraph < line < sentence < clause < word < edge of a mark < none); the chain of
cuts that minimises penalties plus the imbalance of the pieces' sizes, with every piece and its overlap within the limit,
is found by dynamic programming over all boundaries.  It runs over paragraphs, lines and sentences first; the finer ones
enter unless the price of a single one of them already exceeds what the chain found costs.

Overlap is a constraint: a piece starts up to ``overlap`` characters before its cut, at a sentence's start, else at a
word's, else at any character, and shares at least one character with the piece before.  Where the piece would pass the
limit the overlap is shortened.  The one exception is an unbreakable stretch of exactly ``limit`` characters, which fills
its piece.

Defined results: null and empty texts give no piece; a text within the limit is one piece; joining the pieces without
their overlaps gives the text back exactly.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import map_batches

LIMIT, OVERLAP = 2500, 200
KINDS = ("end", "paragraph", "line", "sentence", "clause", "word", "edge", "hard")
# Penalty by kind of boundary; a hard cut costs more than any number of others in a text.
PENALTY = (0.0, 0.0, 0.4, 0.8, 2.0, 3.0, 4.0, 1000.0)
SHORTENED, LOST = 0.5, 50.0  # a shorter overlap than wanted; none at all after a natural cut
LOST_HARD = 1500.0  # none at all after a hard cut: one more hard cut is better
GRID = 25
_BREAK = re.compile(
    r"(?P<p>\s*\n[ \t\r]*\n\s*)|(?P<l>[ \t\r]*\n\s*)|(?P<s>[.!?。！？।؟]+[”’\"'»)\]」』]*\s+|[。！？।؟]+[”’\"'»)\]」』]*)|(?P<c>[,;:，；、、][ \t]+|[，；、])|(?P<w>\s+)"
)
_NATURAL = re.compile(r"[\s.!?。！？।؟]")
_GROUP_KIND = {"p": 1, "l": 2, "s": 3, "c": 4, "w": 5}


def _boundaries(text: str, limit: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Sorted (position, kind): paragraphs, lines and sentences, and all boundaries."""
    coarse: list[tuple[int, int]] = []
    best: dict[int, int] = {}
    n = len(text)
    for m in _BREAK.finditer(text):
        kind, at = _GROUP_KIND[m.lastgroup], m.end()
        if 0 < at < n:
            best[at] = kind
            if kind <= 3:
                coarse.append((at, kind))
    # both sides of any mark that splits a long run; in a run longer than the limit, where no place is better than
    # another, every GRID-th one and those that leave full pieces from either end, so that no cut more than needed is made
    points = [0, *best, n]
    for a, b in zip(points, points[1:], strict=False):
        if b - a >= limit // 2:
            for m in _NATURAL.finditer(text, a, b):
                for q in (m.start(), m.end()):
                    if 0 < q < n:
                        best.setdefault(q, 6)
    points = [0, *sorted(best), n]
    for a, b in zip(points, points[1:], strict=False):
        if b - a > limit:
            full = max(1, limit - 1)
            for q in (*range(a + GRID, b, GRID), *range(a + full, b, full), *range(b - full, a, -full)):
                best[q] = 7
    return coarse, sorted(best.items())


def _starts(cuts: list[int], coarse: list[int], every: list[int], overlap: int) -> list[int]:
    """Where the piece after each cut starts: the first sentence, else word, that begins within the overlap, else its end."""
    out = []
    for cut in cuts:
        lo = max(0, cut - overlap)
        k = bisect_left(coarse, lo)
        if k < len(coarse) and coarse[k] < cut:
            out.append(coarse[k])
            continue
        k = bisect_left(every, lo)
        out.append(every[k] if k < len(every) and every[k] < cut else lo)
    return out


def _chain(marks: list[tuple[int, int]], starts: list[int], limit: int, target: float) -> tuple[float, list[int]]:
    """(cost, places in ``marks``) of the cheapest chain from the first mark to the last; infinite if there is none."""
    pos, begin = np.array([p for p, _ in marks]), np.array(starts)
    own = np.array([PENALTY[k] for _, k in marks])
    first = np.searchsorted(pos, pos - limit)
    cost = np.full(len(marks), np.inf)
    cost[0] = 0.0
    back = [0] * len(marks)
    for j in range(1, len(marks)):
        lo, at = first[j], pos[j]
        if lo == j:
            continue
        size = at - pos[lo:j]
        c = cost[lo:j] + 4.0 * ((size - target) / target) ** 2
        c[(at - begin[lo:j] > limit)] += SHORTENED
        if lo and size[0] == limit:  # no room for any overlap
            c[0] += LOST_HARD if marks[lo][1] == 7 else LOST
        k = int(c.argmin())
        cost[j] = c[k] + own[j]
        back[j] = lo + k
    path = [len(marks) - 1]
    while path[-1] > 0 and np.isfinite(cost[-1]):
        path.append(int(back[path[-1]]))
    return float(cost[-1]), path[::-1]


def split(text: str | None, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int, str]]:
    """(start, cut, end, kind of the cut at the end): a piece is ``text[start:end]``, new from ``cut`` on."""
    if not text:
        return []
    n = len(text)
    if n <= limit:
        return [(0, 0, n, "end")]
    coarse, every = _boundaries(text, limit)
    at_coarse, at_every = [p for p, _ in coarse], [p for p, _ in every]
    target = n / -(-n // max(1, limit - overlap))

    def best(inner: list[tuple[int, int]]) -> tuple[float, list[tuple[int, int]], list[int], list[int]]:
        starts = [0, *_starts([p for p, _ in inner], at_coarse, at_every, overlap), n]
        marks = [(0, 0), *inner, (n, 0)]
        cost, path = _chain(marks, starts, limit, target)
        return cost, marks, starts, path

    cost, marks, starts, path = best(coarse)
    # a chain with a finer cut costs at least that one, and the least penalty for the others that the limit demands
    least = PENALTY[4] + max(0, -(-n // limit) - 2) * min((PENALTY[k] for _, k in coarse), default=0.0)
    if cost > least:
        cost, marks, starts, path = best(every)
    out = []
    for i, j in zip(path, path[1:], strict=False):
        cut, end, begin = marks[i][0], marks[j][0], starts[i]
        if end - begin > limit:
            begin = end - limit
            k = bisect_left(at_every, begin)
            if k < len(at_every) and at_every[k] < cut:
                begin = at_every[k]
        out.append((begin, cut, end, KINDS[marks[j][1]]))
    return out


def split_column(df: DataFrame, key: str, text: str, carry: tuple[str, ...] = (), limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """Numbered pieces of every row: key, ``carry`` columns, piece_no, start_char, new_from, end_char, cut_kind, piece."""
    src = df.select(F.col(key).alias("k_"), F.col(text).alias("t_"), *[F.col(c).cast("string").alias(f"c{n}_") for n, c in enumerate(carry)]).where("t_ is not null and t_ <> ''")
    names = ["k_", *[f"c{n}_" for n in range(len(carry))], "piece_no", "start_char", "new_from", "end_char", "cut_kind", "piece"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, parts = [], ([], [], [], [], [], [])
        for r, t in enumerate(batch.column(1).to_pylist()):
            for n, (a, c, b, kind) in enumerate(split(t, limit, overlap)):
                rows.append(r)
                for col, v in zip(parts, (n, a, c, b, kind, t[a:b] if with_text else None), strict=True):
                    col.append(v)
        at = pa.array(rows, pa.int32())
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        kept = [batch.column(0).take(at), *[batch.column(2 + n).take(at) for n in range(len(carry))]]
        return pa.record_batch([*kept, *[pa.array(c, t) for c, t in zip(parts, kinds, strict=True)]], names=names)

    kind = dict(src.dtypes)["k_"]
    schema = f"k_ {kind}, " + "".join(f"c{n}_ string, " for n in range(len(carry))) + "piece_no int, start_char long, new_from long, end_char long, cut_kind string, piece string"
    out = map_batches(src, run, schema)
    return out.select(F.col("k_").alias(key), *[F.col(f"c{n}_").alias(c) for n, c in enumerate(carry)], *names[1 + len(carry) :])
