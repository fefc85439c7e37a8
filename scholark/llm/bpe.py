"""Byte-level BPE over a contiguous rank array.

Every short word keeps two parallel arrays: part boundaries and the rank of joining each part with its neighbour.  The
smallest rank is found by a scan, its boundary is deleted and the two neighbouring ranks are refreshed, until no pair
of neighbours is in the vocabulary.  Words repeat, so finished words are kept in a bounded table.

Defined results: null and empty texts give an empty list; any other text gives ids whose bytes join to the text.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
# Fixed value: the split pattern of the byte_bpe_50k vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same pattern over ASCII, where the standard library's engine is faster.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
CONTROLS = re.compile("[\x1c-\x1f]")
WORDS_KEPT = 400_000
NONE = 1 << 30


class _Words(dict):
    """Finished words; a new one is encoded on first use, and a full table starts anew."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= WORDS_KEPT:
            self.clear()
        ids = self[word] = self.make(word.encode("utf-8", "surrogatepass"))
        return ids


class Encoder:
    """The vocabulary file's ranks and the table of finished words."""

    def __init__(self, path: str, pattern: str = PATTERN) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.words = regex.compile(pattern).findall
        self.plain = re.compile(ASCII_PATTERN, re.ASCII).findall if pattern == PATTERN else self.words
        self.kept = _Words(self._word)

    def _word(self, word: bytes) -> tuple[int, ...]:
        ranks = self.ranks
        whole = ranks.get(word)
        if whole is not None:
            return (whole,)
        n = len(word)
        if n > 500:
            return self._long(word)
        cut = list(range(n + 1))
        rank = [ranks.get(word[i : i + 2], NONE) for i in range(n - 1)]
        while rank:
            least = min(rank)
            if least == NONE:
                break
            k = rank.index(least)
            del cut[k + 1], rank[k]
            if k < len(rank):
                rank[k] = ranks.get(word[cut[k] : cut[k + 2]], NONE)
            if k:
                rank[k - 1] = ranks.get(word[cut[k - 1] : cut[k + 1]], NONE)
        return tuple(ranks[word[a:b]] for a, b in zip(cut, cut[1:], strict=False))

    def _long(self, word: bytes) -> tuple[int, ...]:
        """The same merges in the same order for words whose scan would be quadratic: a heap finds the minimum."""
        import heapq

        ranks, n = self.ranks, len(word)
        nxt, prv, alive = list(range(1, n + 2)), list(range(-1, n)), [True] * n
        end = list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or (j := nxt[i]) >= n or end[j] != stop or end[i] != j:
                continue
            alive[j], end[i], nxt[i] = False, end[j], nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for a in (prv[i], i):
                if a >= 0 and (b := nxt[a]) < n and (r := ranks.get(word[a : end[b]])) is not None:
                    heapq.heappush(heap, (r, a, end[b]))
        return tuple(ranks[word[i : end[i]]] for i in range(n) if alive[i])

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        self.extend(out, text)
        return out

    def extend(self, out, text: str | None) -> None:
        if not text:
            return
        words = self.plain(text) if text.isascii() and not CONTROLS.search(text) else self.words(text)
        out.extend(chain.from_iterable(map(self.kept.__getitem__, words)))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        out: list[int] = []
        self.extend(out, text)
        return len(out)


@lru_cache(maxsize=2)
def encoder(name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(os.path.join(folder, name + ".tiktoken"))


def encode_documents(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """(key, ids) of every row; other columns are not read.  No shuffle: a narrow map over the scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name, folder)
        for batch in batches:
            flat, offsets = array("i"), [0]
            for t in batch.column(1).to_pylist():
                enc.extend(flat, t)
                offsets.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.Array.from_buffers(pa.int32(), len(flat), [None, pa.py_buffer(flat)]))
            yield pa.record_batch([batch.column(0), ids], names=[key, "ids"])

    src = df.select(F.col(key).cast("long").alias(key), F.col(text).alias("value"))
    return src.mapInArrow(run, f"`{key}` long, ids array<int>")


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """(key, n_tokens) of every row; null and empty texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name, folder)
        for batch in batches:
            counts = [enc.count(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64())], names=[key, "n_tokens"])

    src = df.select(F.col(key).cast("long").alias(key), F.col(text).alias("value"))
    return src.mapInArrow(run, f"`{key}` long, n_tokens long")
