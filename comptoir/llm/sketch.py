"""Two Bloom filters over 64-bit hashes: "seen once" and "seen twice", built by all tasks together.

Both filters have ``2 ** log2_words`` words of 64 bits. A hash chooses one word
and up to four bits in it. A bit of the second filter is set when the bit was
set at least twice, so a hash that was added twice always has all its bits
there (no false negatives), and a hash added once has them only by chance.

Tasks keep only the words they touch. The partial filters are merged by
segment of words, and only the second filter, without its empty words, is
collected and broadcast. Its size has a fixed bound: 12 bytes a word, 100 MB
with the default ``log2_words`` of 23, whatever the size of the data. A filter
that fills up lets more hashes pass; its users confirm every hit exactly, so
results don't depend on it. On tables of many billions of keys pass a larger
``log2_words``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from comptoir.llm.common import batch_of

LOG2_WORDS = 23
SEGMENTS = 256
COMPACT_AT = 400_000  # entries a task gathers before it merges them


def _masks(h: np.ndarray) -> np.ndarray:
    one, out = np.uint64(1), np.zeros(h.size, np.uint64)
    for i in range(4):
        out |= one << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return out


def merge(word: np.ndarray, once: np.ndarray, twice: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry per word, with saturating addition of the bits."""
    order = np.argsort(word, kind="stable")
    word, once, twice = word[order], once[order], twice[order]
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if word.size else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[first, word.size])
    o, t = once[first], twice[first]
    live, j = np.flatnonzero(sizes > 1), 1
    while live.size:
        k = first[live] + j
        t[live] |= twice[k] | (o[live] & once[k])
        o[live] |= once[k]
        j += 1
        live = live[sizes[live] > j]
    return word[first], o, t


class Partial:
    """What one task has added so far."""

    def __init__(self, log2_words: int):
        self.shift = np.uint64(64 - log2_words)
        self.parts: list[tuple] = []
        self.n = 0

    def add(self, h: np.ndarray) -> None:
        if h.size:
            h, n = np.unique(h, return_counts=True)
            mask = _masks(h)
            self.extend((h >> self.shift).astype(np.uint32), mask, np.where(n > 1, mask, np.uint64(0)))

    def extend(self, word: np.ndarray, once: np.ndarray, twice: np.ndarray) -> None:
        self.parts.append((word, once, twice))
        self.n += word.size
        if self.n > COMPACT_AT:
            self.compact()
            self.n = 0  # counts what came since the last merge

    def compact(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint32), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.parts = [merge(*(np.concatenate(x) for x in zip(*self.parts)))]
        return self.parts[0]


def _rows(word, once, twice, log2_words: int) -> pa.RecordBatch:
    seg = (word >> np.uint32(max(0, log2_words - 8))).astype(np.int64)
    cut = np.searchsorted(seg, np.arange(SEGMENTS + 1))
    segs = [i for i in range(SEGMENTS) if cut[i] < cut[i + 1]]
    part = lambda a, kind: [a[cut[i]:cut[i + 1]].astype(kind).tobytes() for i in segs]
    return batch_of({"seg": (segs, pa.int32()), "word": (part(word, "<u4"), pa.binary()),
                     "once": (part(once, "<u8"), pa.binary()), "twice": (part(twice, "<u8"), pa.binary())})


def _arrays(b: pa.RecordBatch):
    for w, o, t in zip(*(b.column(c).to_pylist() for c in ("word", "once", "twice"))):
        yield np.frombuffer(w, "<u4"), np.frombuffer(o, "<u8"), np.frombuffer(t, "<u8")


def holds(word: np.ndarray, bits: np.ndarray, log2_words: int, h: np.ndarray) -> np.ndarray:
    """Whether each hash may have been added twice, by the sorted words of the second filter and their bits."""
    if not word.size or not h.size:
        return np.zeros(h.size, bool)
    w = (h >> np.uint64(64 - log2_words)).astype(np.uint32)
    i = np.minimum(np.searchsorted(word, w), word.size - 1)
    mask = _masks(h)
    return (word[i] == w) & ((bits[i] & mask) == mask)


def twice_filter(docs: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
                 log2_words: int = LOG2_WORDS):
    """Broadcast (word, bits, log2_words), for :func:`holds`, of the hashes that ``hashes`` gives for ``docs``.

    ``hashes`` yields one array per document, each hash once per document.
    """
    schema = "seg int, word binary, once binary, twice binary"

    def build(batches):
        mine = Partial(log2_words)
        for b in batches:
            found = list(hashes(b))
            if found:
                mine.add(np.concatenate(found))
        word, once, twice = mine.compact()
        if word.size:
            yield _rows(word, once, twice, log2_words)

    def gather(batches):
        mine = Partial(log2_words)
        for b in batches:
            for entry in _arrays(b):
                mine.extend(*entry)
        word, once, twice = mine.compact()
        full = twice != 0
        if full.any():
            yield _rows(word[full], twice[full], twice[full], log2_words)

    rows = (docs.mapInArrow(build, schema).repartition(SEGMENTS // 8, "seg")
            .mapInArrow(gather, schema).select("seg", "word", "twice").collect())
    rows.sort(key=lambda r: r["seg"])
    word = np.concatenate([np.frombuffer(r["word"], "<u4") for r in rows] or [np.zeros(0, np.uint32)])
    bits = np.concatenate([np.frombuffer(r["twice"], "<u8") for r in rows] or [np.zeros(0, np.uint64)])
    return docs.sparkSession.sparkContext.broadcast((word, bits, log2_words))
