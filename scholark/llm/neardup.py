"""Near-duplicate texts by a Gray-order hierarchical index over fingerprints of the whole text.

A text is the set of its word runs.  Its hashed runs are cut into ``ROWS`` * ``PRINTS`` ranges of hash values; the least
run of each range gives a row of ``ROW_BITS`` bits, and ``ROWS`` rows, taken from ranges far apart, make a fingerprint.
Short texts take the first run in as many random orders instead.
Two texts of similarity s agree in a row with probability s, wherever edits, insertions or reordering took place, so
the fingerprints of near-duplicates have small Hamming distances also where every sentence was edited.

Index.  Upper nodes are shared masked bit patterns: one half of a fingerprint (three rows) with its value.  Inside a
node the other halves are sorted by Gray rank, one byte a level: neighbours in Gray order share masked patterns, which
are factored into one group per byte value; pairs of groups are descended together and pruned as soon as their
accumulated differences exceed ``RADIUS``.  A pair is a candidate if any of its fingerprints meets so.

Recall.  A pair of similarity s shares a given half with probability s^3 and passes the radius with a probability that
is over 0.6 at 1/2; over 2 * ``PRINTS`` halves that leaves 0.98 or more of the pairs at 1/2 and practically all from 0.6
on.  It is measured in the tests, with edits in every sentence.

Verification.  Every candidate is verified by the exact Jaccard of its 32-bit run hashes; nothing is cut in between.

Exact copies are one class from the start and never paired with each other inside the index.  A node with more than
``HOT`` texts is cut into slices, and every two slices meet in a task of their own: no node is collected into one task
and no pair of it is lost.

Defined results: texts without a word run (null, empty, one or two words) are no candidates and each a group of its
own; ties and repeated rows fall into one class; an empty table gives no pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chars import normalise
from .markup import clean
from .runtime import cut

PRINTS = 24  # fingerprints of a text
ROWS, ROW_BITS = 6, 10
HALF_BITS = ROWS // 2 * ROW_BITS
NODE_BITS = 63 - HALF_BITS
RADIUS = 8
SHORT = 32  # runs of a text
PROBES = 8
HOT = 4096  # texts of a node that one task compares
SLICE = 256  # at most 256, as a text's number is one byte
CLASSES_KEPT = 200_000

_WORD = re.compile(r"\w+")
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_HALF = np.uint64((1 << HALF_BITS) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def plain(text: str | None) -> str:
    """The text that counts: case, markup and look-alikes aside."""
    return normalise(clean(text or "")[0] or "").casefold().replace("_", " ")


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _runs(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the run of n words that begins at each place (the last n - 1 places are short)."""
    out = h.copy()
    with np.errstate(over="ignore"):
        for k in range(1, n):
            out = _mix(out * _GOLD + np.r_[h[k:], np.zeros(min(k, len(h)), np.uint64)])
    return out


class RunSets:
    """Run sets of a slice of texts in whole-array steps; hashes of words are kept."""

    def __init__(self, run: int) -> None:
        self.run = run
        self.words = _WordHashes()

    def texts(self, rows: list[tuple[str | None, str | None]]) -> Iterator[tuple[np.ndarray, int] | None]:
        """(sorted distinct run hashes (56 bits, at the top), key of the set) of each text, None without a run."""
        words: list[str] = []
        field_at: list[int] = []  # where each title and body begins
        field_text: list[int] = []
        for n, row in enumerate(rows):
            for value in row:
                field_at.append(len(words))
                field_text.append(n)
                words += _WORD.findall(plain(value))
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        runs = _runs(h, self.run)
        # runs of words inside a title or body
        ends = np.r_[np.array(field_at[1:], np.int64), len(h)]
        size = np.maximum(0, ends - np.array(field_at, np.int64) - self.run + 1)
        at = np.repeat(np.array(field_at, np.int64), size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        owner = np.repeat(np.array(field_text, np.int64), size)
        # one sort for all texts of the slice: the text's number in the top byte, 56 bits of the hash below
        keys = np.sort(owner.astype(np.uint64) << np.uint64(56) | runs[at] >> np.uint64(8))
        keys = keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys
        owner, keys = (keys >> np.uint64(56)).astype(np.int64), keys << np.uint64(8)
        bounds = np.searchsorted(owner, np.arange(len(rows) + 1))
        whole = np.bitwise_xor.reduceat(np.r_[_mix(keys), np.zeros(1, np.uint64)], bounds[:-1])
        with np.errstate(over="ignore"):
            whole = _mix(whole + np.diff(bounds).astype(np.uint64)).view(np.int64).tolist()
        for n in range(len(rows)):
            yield (keys[bounds[n] : bounds[n + 1]], whole[n]) if bounds[n] < bounds[n + 1] else None


def _short(x: np.ndarray) -> np.ndarray:
    """Sorted distinct 32-bit values of hashes."""
    v = (x >> np.uint64(32)).astype(np.uint32)
    if (v[1:] < v[:-1]).any():
        v = np.sort(v)
    new = v[1:] != v[:-1]
    return v if new.all() else v[np.r_[True, new]]


def _pack(x: np.ndarray) -> bytes:
    """Sorted distinct 32-bit values in Elias-Fano form: low 24 bits each, then the high bytes as a unary bitmap."""
    v = _short(x)
    high = np.zeros(len(v) + 256, np.uint8)
    high[(v >> np.uint32(24)).astype(np.int64) + np.arange(len(v))] = 1
    return v.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes() + np.packbits(high).tobytes()


def _unpack(b: bytes) -> np.ndarray:
    n = (len(b) - 32) * 8 // 25  # 3 bytes and 1 bit each, and 256 bits; exact up to the last byte's filling
    while 3 * n + (n + 256 + 7) // 8 < len(b):
        n += 1
    out = np.zeros((n, 4), np.uint8)
    out[:, :3] = np.frombuffer(b, np.uint8, 3 * n).reshape(-1, 3)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(b, np.uint8, offset=3 * n), count=n + 256)) - np.arange(n)
    return out.view("<u4")[:, 0] | high.astype(np.uint32) << np.uint32(24)


def run_sets(df: DataFrame, key: str, title: str, body: str, run: int) -> DataFrame:
    """(id, class_key, runs binary) of every text; both null without a word run.

    Within a task, copies of a text that has been seen carry no runs (their class has them already), so that copies
    don't crowd into one task later.
    """

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = RunSets(run)
        seen: set[int] = set()
        for batch in batches:
            given, titles, bodies = (batch.column(k).to_pylist() for k in range(3))
            ids, keys, runs = [], [], []
            for lo in range(0, len(given), SLICE):
                part = list(zip(titles[lo : lo + SLICE], bodies[lo : lo + SLICE], strict=True))
                for i, got in zip(given[lo : lo + SLICE], f.texts(part), strict=True):
                    ids.append(i)
                    if got is None:
                        keys.append(None)
                        runs.append(None)
                        continue
                    got, whole = got
                    keys.append(whole)
                    if whole in seen:
                        runs.append(None)
                        continue
                    if len(seen) >= CLASSES_KEPT:
                        seen.clear()
                    seen.add(whole)
                    runs.append(_pack(got))
            if ids:
                yield pa.record_batch([pa.array(ids, pa.string()), pa.array(keys, pa.int64()), pa.array(runs, pa.binary())], names=["id", "class_key", "runs"])

    src = df.select(F.col(key).cast("string").alias("id"), F.col(title).alias("t"), F.col(body).alias("b"))
    return src.mapInArrow(go, "id string, class_key long, runs binary")


def _probes() -> np.ndarray:
    """For each attempt, the range that an empty range looks into: a fixed random order."""
    return np.stack([np.random.default_rng(k).permutation(ROWS * PRINTS) for k in range(PROBES)])


_PROBE = _probes()
_SEEDS = _mix(np.arange(1, ROWS * PRINTS + 1, dtype=np.uint64) * _GOLD)


def least_by_range(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, ROWS * PRINTS): the least value of each range of values; ``sets`` are sorted 32-bit values, none empty.

    An empty range takes that of the first range of its fixed random order that holds a value, or else of the next one.
    """
    size = np.array([len(s) for s in sets], np.int64)
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(sets), dtype=np.uint64), size)
    keys = owner << np.uint64(32) | np.concatenate(sets).astype(np.uint64)
    ranges = ROWS * PRINTS
    edges = np.arange(ranges + 1, dtype=np.uint64) * np.uint64(1 << 32) // np.uint64(ranges)
    cuts = np.searchsorted(keys, (np.arange(len(sets), dtype=np.uint64)[:, None] << np.uint64(32)) + edges[None, :])
    at, filled = cuts[:, :-1], cuts[:, :-1] < cuts[:, 1:]
    out, open_ = at, ~filled
    for order in _PROBE:
        take = open_ & filled[:, order]
        out = np.where(take, at[:, order], out)
        open_ &= ~take
    out = np.where(out >= (start + size)[:, None], start[:, None], out)
    return keys[out] & np.uint64(0xFFFFFFFF)


def least_by_order(values: np.ndarray) -> np.ndarray:
    """(ROWS * PRINTS): of a short text, the value that comes first in each of as many random orders."""
    with np.errstate(over="ignore"):
        rank = _mix((values.astype(np.uint64)[:, None] + np.uint64(1)) * _SEEDS[None, :])
    return values[rank.argmin(0)].astype(np.uint64)


def fingerprints(least: np.ndarray) -> np.ndarray:
    """(texts, 2, PRINTS): both halves of each fingerprint, from the least values of each text."""
    with np.errstate(over="ignore"):
        row = _mix(least * _GOLD) >> np.uint64(64 - ROW_BITS)
    row = row.reshape(len(least), 2, ROWS // 2, PRINTS)  # a fingerprint's rows come from ranges PRINTS apart
    out = np.zeros((len(least), 2, PRINTS), np.uint64)
    for k in range(ROWS // 2):
        out |= row[:, :, k, :] << np.uint64(ROW_BITS * k)
    return out


def postings(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, owners): numbers of 63 bits, the node (a half's pattern, hashed) above the other half, and the text of each.

    Ranges need some values each, so texts of fewer than 2 * ``SHORT`` runs take random orders, and those of ``SHORT`` or
    more take ranges: any two texts of which one has at least half the runs of the other have one kind in common.
    """
    size = np.array([len(s) for s in sets], np.int64)
    keys, owners = [], []
    for kind, at in enumerate((np.flatnonzero(size >= SHORT), np.flatnonzero(size < 2 * SHORT))):
        if len(at):
            own = [sets[k] for k in at]
            halves = fingerprints(np.stack([least_by_order(s) for s in own]) if kind else least_by_range(own))
            tag = np.arange(2 * PRINTS, dtype=np.uint64).reshape(2, PRINTS) + np.uint64(kind * 2 * PRINTS) << np.uint64(HALF_BITS)
            node = _mix(_mix(halves + tag[None])) >> np.uint64(64 - NODE_BITS)
            keys.append((node << np.uint64(HALF_BITS) | halves[:, ::-1, :]).ravel())
            owners.append(np.repeat(at, 2 * PRINTS))
    return np.concatenate(keys), np.concatenate(owners)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each pattern in Gray order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def _cross(sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each k: all (i, j) with i < sizes_a[k], j < sizes_b[k], as (k, i, j)."""
    n = sizes_a * sizes_b
    k = np.repeat(np.arange(len(n)), n)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return k, at // sizes_b[k], at % sizes_b[k]


def near_pairs(codes: np.ndarray, node: np.ndarray, radius: int = RADIUS, levels: int = 4, budget: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j, of rows of the same node whose codes (``levels`` bytes) are within ``radius`` bits.

    Rows are sorted by (node, Gray rank).  Level by level (a byte at a time) the groups of equal bytes are paired and
    pruned by accumulated differences; all nodes are walked together, in slices of bounded size.
    """
    n = len(codes)
    if n < 2:
        return
    rank = gray_rank(codes)
    starts = [np.flatnonzero(np.r_[True, node[1:] != node[:-1]])]  # of the groups of each level
    for b in range(levels):
        shift = np.uint64(8 * (levels - 1 - b))
        new = np.r_[True, (node[1:] != node[:-1]) | ((rank[1:] ^ rank[:-1]) >> shift != 0)]
        starts.append(np.flatnonzero(new))
    ends = [np.r_[s[1:], n] for s in starts]
    starts.append(np.arange(n))  # the rows themselves, below the groups of equal codes
    # children of group g of level l are groups first[l][g]..first[l][g]+count[l][g]-1 of level l+1
    first = [np.searchsorted(starts[k + 1], starts[k]) for k in range(levels + 1)]
    count = [np.searchsorted(starts[k + 1], ends[k]) - first[k] for k in range(levels + 1)]
    several = np.flatnonzero(ends[0] - starts[0] > 1)
    stack = [(0, several, several, np.zeros(len(several), np.int64))]
    while stack:
        level, a, b, diff = stack.pop()
        if not len(a):
            continue
        work = count[level][a] * count[level][b]
        if work.sum() > budget and len(a) > 1:
            half = max(1, min(len(a) - 1, int(np.searchsorted(np.cumsum(work), work.sum() / 2))))
            stack.append((level, a[half:], b[half:], diff[half:]))
            stack.append((level, a[:half], b[:half], diff[:half]))
            continue
        k, i, j = _cross(count[level][a], count[level][b])
        ca, cb = first[level][a][k] + i, first[level][b][k] + j
        if level == levels:  # of one group with itself: each pair once
            own = (ca < cb) | (a[k] != b[k])
            x, y = ca[own], cb[own]
            yield np.minimum(x, y), np.maximum(x, y)
            continue
        own = ca <= cb
        k, ca, cb = k[own], ca[own], cb[own]
        shift = np.uint64(8 * (levels - 1 - level))
        x = (codes[starts[level + 1][ca]] ^ codes[starts[level + 1][cb]]) >> shift & np.uint64(0xFF)
        d = diff[k] + np.bitwise_count(x).astype(np.int64)
        ok = d <= radius
        stack.append((level + 1, ca[ok], cb[ok], d[ok]))


def node_pairs(keys: np.ndarray, cls: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(a, b), a < b: classes that meet in a node within the radius."""
    node, rest = keys >> np.uint64(HALF_BITS), keys & _HALF
    order = np.lexsort((gray_rank(rest), node))
    node, rest, cls = node[order], rest[order], cls[order]
    for i, j in near_pairs(rest, node):
        a, b = cls[i], cls[j]
        ok = a != b
        yield np.minimum(a, b)[ok], np.maximum(a, b)[ok]


def _meetings(posts: DataFrame, hot: int | None) -> DataFrame:
    """(x, y, part): candidate pairs of classes (part -1), and the rows (key, class, slice) of nodes beyond ``hot`` rows.

    Nodes come one after the other (a sorted partition), so a task holds one batch and at most ``hot`` rows of a node.
    """

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, cls = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        full: int | None = None  # the hot node that is being cut
        slices = 0
        held: list[np.ndarray] = []
        for batch in batches:
            keys = np.r_[keys, batch.column(0).to_numpy().view(np.uint64)]
            cls = np.r_[cls, batch.column(1).to_numpy()]
            node = keys >> np.uint64(HALF_BITS)
            if hot is not None and full is not None:
                n = int(np.searchsorted(node, np.uint64(full), "right"))
                if n:
                    yield _rows(keys[:n].view(np.int64), cls[:n], slices)
                    slices += 1
                    keys, cls, node = keys[n:], cls[n:], node[n:]
                if len(node):
                    full = None
            if not len(node):
                continue
            last = int(np.searchsorted(node, node[-1]))
            if last:
                held += [np.stack(p) for p in node_pairs(keys[:last], cls[:last])]
                keys, cls, node = keys[last:], cls[last:], node[last:]
            if hot is not None and len(node) > hot:
                full, slices = int(node[0]), 1
                yield _rows(keys.view(np.int64), cls, 0)
                keys, cls = keys[:0], cls[:0]
            if sum(p.shape[1] for p in held) > 300_000:
                yield _unique(held)
                held = []
        held += [np.stack(p) for p in node_pairs(keys, cls)]
        if held:
            yield _unique(held)

    by = F.shiftright("key", HALF_BITS)
    return posts.repartition(by).sortWithinPartitions("key").select("key", "cls").mapInArrow(go, "x long, y long, part int")


def _rows(key: np.ndarray, cls: np.ndarray, part: int) -> pa.RecordBatch:
    return pa.record_batch([pa.array(key), pa.array(cls), pa.array(np.full(len(key), part, np.int32))], names=["x", "y", "part"])


def _unique(held: list[np.ndarray]) -> pa.RecordBatch:
    both = np.concatenate(held, 1)
    both = both[:, np.lexsort((both[1], both[0]))]
    both = both[:, np.r_[True, (both[:, 1:] != both[:, :-1]).any(0)]] if both.shape[1] else both
    return _rows(both[0], both[1], -1)


def candidate_pairs(classes: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b), a < b: classes (cls long, runs binary; repeated rows are alike) whose fingerprints meet in the index."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls = batch.column(0).to_numpy()
            sets = [_unpack(b) for b in batch.column(1).to_pylist()]
            for lo in range(0, len(sets), SLICE):
                keys, owner = postings(sets[lo : lo + SLICE])
                yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(cls[lo + owner])], names=["key", "cls"])

    posts = classes.select("cls", "runs").mapInArrow(post, "key long, cls long")
    met = cut(_meetings(posts, hot).distinct())
    pairs = met.where("part < 0").select(F.col("x").alias("a"), F.col("y").alias("b"))
    if met.where("part >= 0").isEmpty():
        return pairs
    # every two slices of a hot node meet in a node of their own
    rows = met.where("part >= 0").withColumn("node", F.shiftright("x", HALF_BITS))
    rows = rows.join(rows.groupBy("node").agg(F.max("part").alias("last")), "node")
    ends = F.struct(F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.greatest("last", F.lit(1))))).where("other <> part").withColumn("ends", ends)
    own = F.shiftrightunsigned(F.xxhash64("node", "ends.p", "ends.q"), 64 - NODE_BITS)
    key = F.shiftleft(own, HALF_BITS).bitwiseOR(F.col("x").bitwiseAND(F.lit(int(_HALF)).cast("long")))
    split = _meetings(rows.select(key.alias("key"), F.col("y").alias("cls")), None)
    return pairs.unionByName(split.select(F.col("x").alias("a"), F.col("y").alias("b"))).distinct()


def similar_classes(prepared: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(members: id, cls; links: a, b, similarity between different texts) of rows with their run sets.

    ``prepared`` is the checkpointed result of ``run_sets``; the class number is the key of the exact run set.
    """
    members = prepared.where("class_key is not null").select("id", F.col("class_key").alias("cls"))
    bearers = prepared.where("runs is not null").select(F.col("class_key").alias("cls"), "runs")
    pairs = candidate_pairs(bearers)
    runs = bearers.groupBy("cls").agg(F.max("runs").alias("runs"))
    joined = pairs.join(runs.select(F.col("cls").alias("a"), F.col("runs").alias("ra")), "a").join(runs.select(F.col("cls").alias("b"), F.col("runs").alias("rb")), "b")

    def jaccard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacked = lru_cache(maxsize=5000)(lambda b: frozenset(_unpack(b).tolist()))
        for batch in batches:
            keep, sims = [], []
            for k, (ra, rb) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                # rows of one class follow each other, so its set is kept
                x, y = unpacked(ra), unpacked(rb)
                both = len(x & y)
                s = both / (len(x) + len(y) - both)
                if s >= least:
                    keep.append(k)
                    sims.append(s)
            at = pa.array(keep, pa.int32())
            yield pa.record_batch([batch.column(0).take(at), batch.column(1).take(at), pa.array(sims, pa.float64())], names=["a", "b", "similarity"])

    links = joined.select("a", "b", "ra", "rb").mapInArrow(jaccard, "a long, b long, similarity double")
    return members, links


def near_duplicate_pairs(df: DataFrame, key: str, title: str, body: str, run: int = 3, least: float = 0.5) -> DataFrame:
    """(id_a, id_b), id_a < id_b: every two records with at least ``least`` of their runs of ``run`` words in common.

    Copies of one text are pairs too; the pairs of a class arise in a join on the class, after the index has worked on
    one record a class.
    """
    prepared = cut(run_sets(df, key, title, body, run))
    members, links = similar_classes(prepared, least)
    m_a, m_b = members.select(F.col("id").alias("x"), F.col("cls").alias("a")), members.select(F.col("id").alias("y"), F.col("cls").alias("b"))
    across = links.join(m_a, "a").join(m_b, "b").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    same = m_a.join(m_b, F.col("a") == F.col("b")).where("x < y").select(F.col("x").alias("id_a"), F.col("y").alias("id_b"))
    return across.unionByName(same)


def near_duplicate_groups(df: DataFrame, key: str, title: str, body: str, run: int = 5, least: float = 0.8) -> DataFrame:
    """(id, group_id, n_links, copies): one row per record; group_id is the smallest record id of its component.

    The form for large tables: n copies of a text give n rows here, and n * (n - 1) / 2 pairs in ``near_duplicate_pairs``.
    """
    from .components import connected_components

    prepared = cut(run_sets(df, key, title, body, run))
    members, links = similar_classes(prepared, least)
    links = cut(links.select("a", "b"))
    roots = connected_components(links)
    ends = links.select(F.col("a").alias("cls")).unionByName(links.select(F.col("b").alias("cls")))
    degree = ends.groupBy("cls").agg(F.count("*").alias("n_links"))
    size = members.groupBy("cls").agg(F.count("*").alias("copies"), F.min("id").alias("first_id"))
    per_class = size.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").join(degree, "cls", "left")
    per_class = per_class.select("cls", "copies", "first_id", F.coalesce("root", "cls").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    names = per_class.groupBy("root").agg(F.min("first_id").alias("group_id"))
    per_class = per_class.join(names, "root")
    grouped = members.join(per_class, "cls").select("id", "group_id", F.col("n_links").cast("long").alias("n_links"), "copies")
    alone = prepared.where("class_key is null").select("id", F.col("id").alias("group_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("copies"))
    return grouped.unionByName(alone)
