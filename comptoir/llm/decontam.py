"""Benchmark decontamination with an FM-index per training shard (operator 6).

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A test
phrase is a window of ``window_words`` consecutive words of a benchmark item, or
the whole item if it has fewer. Every document word inside an occurrence of a
phrase is hit.

1. The distinct phrases are found by Spark and sent to the tasks in blocks of
   at most ``block_phrases``, each with one number: that of the set of items it is
   in. That bounds the broadcast, however many items share a phrase. More blocks
   mean more passes, staged one after another. Sets are told apart by their size and 128
   bits of hashes that combine before the shuffle; (set, item) stays a table of Spark's.
2. Each task cuts its documents into training shards of at most ``shard_words``
   indexed words and builds an FM-index of each: suffix array by prefix
   doubling, Burrows-Wheeler transform, wavelet matrix with ranks, every
   ``SAMPLE``-th suffix position. Words of no phrase can't be part of an
   occurrence; they end a stretch, as a document's end does. Stretches shorter than
   the shortest phrase are not indexed. A stretch longer than a shard is
   cut with an overlap, so no occurrence is lost.
3. All phrases of one length are searched backward together; occurrences are
   located by walking to the next sampled suffix, and their spans are merged.

4. Documents carry the numbers of the sets they hit. Only documents with hits are joined with
   (set, item), to list their items; an inner join on the set, which Spark can split where a set is hot.

The search needs no shuffle, and a document without a hit never leaves its task, so hot sources or
copies don't matter.

Defined results: a null text has no words. Items without words have no phrase;
items that repeat an ``item_id`` count as one; an item whose id is null hits but is not
listed. Without items nothing is hit; without documents the result is empty. Documents that repeat an id or
a text are rows of their own. Columns beside ``text`` are kept, but for those named as an output.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.llm.common import alnum_words, batch_of, carried, small_batches, stage

WINDOW_WORDS = 10
BLOCK_PHRASES = 200_000
SHARD_WORDS = 1 << 20
SAMPLE = 8


class FMIndex:
    """Over an array of symbols; 0 ends a stretch, and each 0 counts as a symbol of its own."""

    def __init__(self, text: np.ndarray):
        text = np.r_[text, 0].astype(np.int64) if not text.size or text[-1] else text.astype(np.int64)
        n, ends = text.size, np.flatnonzero(text == 0)
        sa = self._suffix_array(text, ends)
        before = text[sa - 1]  # the symbol before each suffix; for the first one the last 0
        self.size, self.n_symbols = n, int(text.max()) + 1
        self.starts = np.r_[0, np.cumsum(np.bincount(text, minlength=self.n_symbols))]
        # Sampled: every SAMPLE-th position, and suffixes that begin a stretch (there is no step back from them). Only
        # these positions stay; a row's place among them is a count of the sampled rows before it.
        self.sampled = (sa % SAMPLE == 0) | (before == 0)
        self.sampled_before = np.r_[0, np.cumsum(self.sampled)[:-1]].astype(np.int32)
        self.positions = sa[self.sampled]
        # A wavelet matrix: a bit of every symbol a level, each level sorted by the bit of the one above.
        self.levels, self.origin = [], np.zeros(self.n_symbols, np.int64)
        seq, symbols = before, np.arange(self.n_symbols)
        for shift in range(max(1, (self.n_symbols - 1).bit_length()) - 1, -1, -1):
            bit = (seq >> shift) & 1
            ones = np.r_[0, np.cumsum(bit)].astype(np.int32)
            zeros = int(n - ones[-1])
            self.levels.append((shift, ones, zeros))
            self.origin = np.where((symbols >> shift) & 1, zeros + ones[self.origin],
                                   self.origin - ones[self.origin])
            seq = np.r_[seq[bit == 0], seq[bit == 1]]

    @staticmethod
    def _suffix_array(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Prefix doubling: the ranks of twice as many symbols a round, until all suffixes differ."""
        n = text.size
        key = text + ends.size
        key[ends] = np.arange(ends.size)
        width = 1
        while True:
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            new = np.r_[False, sorted_key[1:] != sorted_key[:-1]]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new)
            if rank[order[-1]] == n - 1:
                return order
            after = np.zeros(n, np.int64)
            after[:n - width] = rank[width:] + 1
            key = rank * (n + 1) + after
            width *= 2

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before row ``at`` of the transform."""
        i = at
        for shift, ones, zeros in self.levels:
            i = np.where((symbol >> shift) & 1, zeros + ones[i], i - ones[i])
        return i - self.origin[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and row after the last, for each row of ``phrases`` (all of one length)."""
        first = np.zeros(len(phrases), np.int64)
        last = np.full(len(phrases), self.size, np.int64)
        known = phrases.max(axis=1, initial=0) < self.n_symbols
        last[~known] = 0
        live = np.flatnonzero(known)
        for col in range(phrases.shape[1] - 1, -1, -1):
            s = phrases[live, col]
            first[live] = self.starts[s] + self.rank(s, first[live])
            last[live] = self.starts[s] + self.rank(s, last[live])
            live = live[first[live] < last[live]]
        return first, np.maximum(last, first)

    def step_back(self, rows: np.ndarray) -> np.ndarray:
        """The row of the suffix one symbol longer, the symbol read from the wavelet matrix on the way down."""
        i, symbol = rows, np.zeros(rows.size, np.int64)
        for shift, ones, zeros in self.levels:
            below = ones[i]
            bit = ones[i + 1] - below
            symbol |= bit.astype(np.int64) << shift
            i = np.where(bit, zeros + below, i - below)
        return self.starts[symbol] + i - self.origin[symbol]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes in these rows."""
        rows, back = rows.copy(), np.zeros(rows.size, np.int64)
        walk = np.flatnonzero(~self.sampled[rows])
        while walk.size:
            rows[walk] = self.step_back(rows[walk])
            back[walk] += 1
            walk = walk[~self.sampled[rows[walk]]]
        return self.positions[self.sampled_before[rows]] + back


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[int]]:
    """Overlapping or touching spans as one, in order."""
    if not starts.size:
        return [], []
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    cut = np.flatnonzero(np.r_[True, starts[1:] > reach[:-1]])
    return starts[cut].tolist(), reach[np.r_[cut[1:] - 1, starts.size - 1]].tolist()


class Phrases:
    """A block of phrases: ids by word, and by length a matrix of word ids with the item set of each row."""

    def __init__(self, rows: list[tuple[list[bytes], int]]):
        self.word_id: dict[bytes, int] = {}
        by_length = defaultdict(list)
        for words, items in rows:
            by_length[len(words)].append(([self.word_id.setdefault(w, len(self.word_id) + 1) for w in words], items))
        self.by_length = [(n, np.array([p for p, _ in found], np.int64), np.array([i for _, i in found], np.int64))
                          for n, found in sorted(by_length.items())]
        self.shortest = min(by_length, default=0)
        self.longest = max(by_length, default=0)


def search_shard(symbols: list[np.ndarray], doc: list[int], start: list[int], phrases, hits: dict, sets: dict) -> None:
    """Index the stretches as one shard, and note spans and item sets by document."""
    sizes = np.array([s.size + 1 for s in symbols])
    offset = np.r_[0, np.cumsum(sizes)[:-1]]
    index = FMIndex(np.concatenate([x for s in symbols for x in (s, np.zeros(1, np.int64))]))
    for n, matrix, of in phrases[1]:
        first, last = index.search(matrix)
        count = last - first
        found = np.flatnonzero(count)
        if not found.size:
            continue
        count = count[found]
        which = np.repeat(found, count)
        rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[found], count)
        at = index.locate(rows)
        stretch = np.searchsorted(offset, at, side="right") - 1
        place = at - offset[stretch]
        for s, p, w in zip(stretch.tolist(), place.tolist(), of[which].tolist()):
            d = doc[s]
            hits[d].append((start[s] + p, start[s] + p + n))
            sets[d].add(w)


def cut_spans(text: str, starts: list[int], ends: list[int]) -> str:
    """The text without the characters from the first to the last word of each span of words."""
    data = text.encode()
    at = [m.span() for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", data)]
    out, done = [], 0
    for a, b in zip(starts, ends):
        out.append(data[done:at[a][0]])
        done = at[b - 1][1]
    return b"".join([*out, data[done:]]).decode()


def _searcher(block, shard_words: int):
    """A function over batches that adds the block's hits to the columns __starts, __ends, __sets."""
    def run(batches):
        word_id, by_length, shortest, longest = block.value
        phrases = (word_id, by_length)
        get = word_id.get
        for b in batches:
            hits, sets = defaultdict(list), defaultdict(set)
            n_words, stretches, doc, start, held = [], [], [], [], 0

            def flush():
                nonlocal held
                if stretches:
                    search_shard(stretches, doc, start, phrases, hits, sets)
                stretches.clear(), doc.clear(), start.clear()
                held = 0

            for d, text in enumerate(b.column("text").to_pylist()):
                words = alnum_words(text)
                n_words.append(len(words))
                if not longest or len(words) < shortest:
                    continue
                ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
                edge = np.flatnonzero(np.diff(np.r_[False, ids > 0, False]))
                first, last = edge[::2], edge[1::2]
                long = last - first >= shortest
                for a, e in zip(first[long].tolist(), last[long].tolist()):
                    while a < e:
                        part = ids[a:min(e, a + shard_words)]
                        if held + part.size > shard_words:
                            flush()
                        stretches.append(part)
                        doc.append(d)
                        start.append(a)
                        held += part.size + 1
                        if a + part.size >= e:
                            break
                        a += max(1, part.size - longest + 1)
            flush()
            starts, ends, names = [], [], []
            for d, (s, e, i) in enumerate(zip(*(b.column(c).to_pylist() for c in ("__starts", "__ends", "__sets")))):
                if d in hits:
                    pairs = np.array(sorted({*hits[d], *zip(s, e)}), np.int64)
                    s, e = merge_spans(pairs[:, 0], pairs[:, 1])
                    i = sorted({*i, *sets[d]})
                starts.append(s)
                ends.append(e)
                names.append(i)
            ints = pa.list_(pa.int32())
            new = {"n_words": (n_words, pa.int64()), "__starts": (starts, ints), "__ends": (ends, ints),
                   "__sets": (names, pa.list_(pa.int64()))}
            yield batch_of({c: new.get(c, (b.column(c), None)) for c in b.schema.names})
    return run


def phrases_of(items: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """(item, phrase): the phrases, words joined by a blank, of each item."""
    def run(batches):
        for b in batches:
            ids, found = [], []
            for item, text in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist()):
                words = alnum_words(text)
                size = min(len(words), window_words)
                for p in {b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)} if words else ():
                    ids.append(item)
                    found.append(p)
            yield batch_of({"item": (ids, pa.string()), "phrase": (found, pa.binary())})

    return (items.select(F.col("item_id").cast("string").alias("item_id"), "text")
            .mapInArrow(run, "item string, phrase binary").distinct())


def item_sets(phrases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (item, phrase): (phrase, set) with the number of each phrase's set of items, and (set, item). No set is ever one row."""
    sign = ["s1", "s2", "n"]
    by = phrases.groupBy("phrase").agg(
        *(F.bit_xor(F.when(F.col("item").isNotNull(), F.xxhash64("item", F.lit(seed)))).alias(c) for seed, c in ((1, "s1"), (2, "s2"))),
        F.count("item").alias("n")).fillna(0, ["s1", "s2"])
    by = stage(by, "phrase-sets")
    sets = stage(by.groupBy(*sign).agg(F.min("phrase").alias("phrase")).withColumn("set", F.monotonically_increasing_id()), "item-sets")
    numbered = by.join(sets.select(*sign, "set"), sign).select("phrase", "set")
    return numbered, phrases.where("item is not null").join(sets.select("phrase", "set"), "phrase").select("set", "item")


def find_hits(docs: DataFrame, items: DataFrame, window_words: int = WINDOW_WORDS,
              block_phrases: int = BLOCK_PHRASES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_starts``, ``hit_ends`` (word spans, merged, in order) and ``hit_items``."""
    spark = docs.sparkSession
    small_batches(spark)
    found = stage(phrases_of(items, window_words), "item-phrases")
    phrases, members = (stage(df, name) for df, name in zip(item_sets(found), ("phrases", "set-items")))
    blocks = max(1, -(-phrases.count() // block_phrases))
    none = F.array().cast("array<int>")
    outputs = ["n_words", "hit_starts", "hit_ends", "hit_items"]
    names = docs.select(*carried(docs, outputs)).columns
    # Columns beside the text travel under numbers, so their names clash with nothing.
    rows = docs.select(*(docs[f"`{c}`"].alias(c if c == "text" else f"k{i}") for i, c in enumerate(names)), F.lit(0).cast("long").alias("n_words"), none.alias("__starts"),
                       none.alias("__ends"), F.array().cast("array<bigint>").alias("__sets"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    for k in range(blocks):
        part = phrases.where(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == k).collect() if blocks > 1 \
            else phrases.collect()
        p = Phrases(sorted((bytes(r["phrase"]).split(), r["set"]) for r in part))
        block = spark.sparkContext.broadcast((p.word_id, p.by_length, p.shortest, p.longest))
        rows = rows.mapInArrow(_searcher(block, shard_words), schema)
        if k < blocks - 1:
            rows = stage(rows, "hits")
    return _with_items(stage(rows.withColumn("__row", F.monotonically_increasing_id()), "hits"), members).toDF(*names, *outputs)


def _with_items(rows: DataFrame, members: DataFrame) -> DataFrame:
    """``rows`` with the items of their sets; rows without a set stay where they are."""
    hit = F.size("__sets") > 0
    lists = (rows.where(hit).select("__row", F.explode("__sets").alias("set")).join(members, "set")
             .groupBy("__row").agg(F.array_sort(F.collect_set("item")).alias("__items")))
    no_items = F.array().cast("array<string>")
    listed = rows.where(hit).join(lists, "__row", "left").withColumn("__items", F.coalesce("__items", no_items))
    every = rows.where(~hit).withColumn("__items", no_items).unionByName(listed)
    return every.drop("__row", "__sets")


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` with the hit words cut out of ``text``, and the columns of :func:`find_hits` (on the text as it was)."""
    hits = find_hits(docs, items, **options)
    names = hits.columns
    known = {"text", "hit_starts", "hit_ends"}
    numbered = hits.toDF(*(c if c in known else f"k{i}" for i, c in enumerate(names)))

    def run(batches):
        for b in batches:
            texts = [cut_spans(t, s, e) if s else t for t, s, e in
                     zip(*(b.column(c).to_pylist() for c in ("text", "hit_starts", "hit_ends")))]
            yield batch_of({c: (texts, pa.string()) if c == "text" else (b.column(c), None) for c in b.schema.names})

    return numbered.mapInArrow(run, numbered.schema).toDF(*names)
