"""Hard-negative mining by slots (operator 13).

Each entry x of a vector becomes floor(256 * x); a row's score is its integer inner product with an anchor. Every
(anchor, positive) has a window of scores, from ``low`` to ``high`` per cent of the positive's score, and wants the
first ``negatives`` rows of another label in it, by falling score, then by id.

An anchor's windows overlap. Their upper limits, from the highest down, split the scores into disjoint *slots*:
slot j lies above the next lower limit and at or below limit j. A window then is a run of slots that begins with its
own, cut at its lower limit.

1. *Positives*: every task scores its rows against a block of anchors and keeps the best ``positives`` a anchor
   (:class:`Best`); a per-anchor top-n in Spark merges the tasks.
2. *Slots*: in a second pass each score below an anchor's highest limit belongs to one slot and is kept while it is
   among the best ``negatives`` of that slot: a combiner of fixed size, whatever the label or the vector that a third of all rows may
   share. The same top-n merges the tasks, by (anchor, slot).
3. *Suffix merges*: from the lowest slot up, the best of slot j and of all slots below are the first of slot j's own, then
   of the merge so far. Cut at its lower limit, that merge is window j's answer, so one pass over at most
   ``positives * negatives`` entries answers all windows of an anchor.

Anchors are the queries: they are dealt by hash into blocks of about ``anchors_a_block``, one block is sent to
all tasks at a time, and all rows are read against it. So the broadcast has a fixed size; more anchors mean more passes.

Defined results: rows with a null label, a null vector or a null or non-finite entry take no part, nor do rows with an entry
of 2^26 or more in size after scaling, whose scores could overflow 64 bits. Entries that one of two vectors lacks count as
zero. A row with a null id is no anchor, keeps its label, and comes last among equal scores. An anchor's positives are rows of
another id than its own. Rows that repeat an id are rows of their own; an anchor that stands there m times comes out m
times. Positives with a negative score have no window. Empty tables, and anchors without positives or negatives, give no
rows. Other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.functions.topn import RANK, top_n
from comptoir.llm.common import batch_of, stage
from comptoir.llm.vectors import Vectors

SCALE = 256
LARGEST = 2.0 ** 26  # of a scaled entry
ANCHORS_A_BLOCK = 16_384
TILE = 512, 2048  # anchors and rows that are multiplied at a time
LOWEST = np.iinfo(np.int64).min


class Best:
    """The best ``k`` (score, id) of each group, by falling score, then by id, nulls last. Takes them batch by batch."""

    def __init__(self, groups: int, k: int):
        self.k, self.waiting, self.n_waiting = k, [], 0
        self.kept = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))
        self.least = np.full(groups, LOWEST)  # a score below can't be among the best

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        on = score >= self.least[group]
        self.waiting.append((group[on], score[on], ids[on], no_id[on]))
        self.n_waiting += int(on.sum())
        if self.n_waiting > 200_000:
            self.merge()

    def merge(self) -> None:
        group, score, ids, no_id = (np.concatenate(x) for x in zip(self.kept, *self.waiting))
        order = np.lexsort((ids, no_id, -score, group))
        group = group[order]
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if group.size else np.zeros(0, int)
        nth = np.arange(group.size) - np.repeat(first, np.diff(np.r_[first, group.size]))
        self.kept = tuple(x[order][nth < self.k] for x in (score, ids, no_id))
        self.kept = (group[nth < self.k], *self.kept)
        full = nth == self.k - 1
        self.least[group[full]] = score[order][full]
        self.waiting, self.n_waiting = [], 0


@dataclass
class Block:
    """Some anchors: ids, labels, how often they stand in the table, and scaled vectors."""

    ids: np.ndarray
    labels: np.ndarray
    times: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Block:
        found = Vectors(table.column("vector").combine_chunks())
        vectors = np.floor(SCALE * found.padded(int(found.sizes.max(initial=0))))
        return cls(*(table.column(c).to_numpy() for c in ("vec_id", "label", "times")), vectors)

    @property
    def dims(self) -> int:
        return self.vectors.shape[1]

    def scores(self, m: np.ndarray):
        """(first anchor, first row, scores) by tile: exact, as whole floating point numbers below 2^53, else as integers."""
        exact = self.dims * np.abs(self.vectors).max(initial=0.0) * np.abs(m).max(initial=0.0) < 2.0 ** 53
        kind = np.float64 if exact else np.int64
        ours, theirs = self.vectors.astype(kind, copy=False), m.astype(kind, copy=False)
        for a in range(0, len(ours), TILE[0]):
            for r in range(0, len(theirs), TILE[1]):
                yield a, r, ours[a:a + TILE[0]] @ theirs[r:r + TILE[1]].T


def _fields(data) -> tuple:
    """What a Block or Limits is made of, as sent to the workers."""
    return tuple(getattr(data, f.name) for f in fields(data))


def rows_of(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector): ids and labels as long, the label shifted where the id is divisible by 7."""
    label = F.col("label").cast("long")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
                          F.col("embedding").alias("vector")).where("label is not null and vector is not null")


def _parts(b: pa.RecordBatch, dims: int):
    """(ids, no_id, labels, scaled vectors) of the rows that take part."""
    found = Vectors(b.column("vector"))
    with np.errstate(over="ignore"):
        whole = np.floor(SCALE * found.padded(dims))
        fits = np.ones(found.rows.size, bool)
        for size in np.unique(found.sizes[found.sizes > dims]):  # entries beyond the anchors' count as well
            rows, m = found.of_size(int(size))
            fits[np.isin(found.rows, rows[(np.abs(np.floor(SCALE * m)) >= LARGEST).any(axis=1)])] = False
    fits &= (np.abs(whole) < LARGEST).all(axis=1)
    at = pa.array(found.rows[fits])
    ids = b.column("vec_id").take(at)
    return (ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), b.column("label").take(at).to_numpy(),
            whole[fits])


def anchors_of(rows: DataFrame, every: int = 50) -> DataFrame:
    """The distinct rows whose id is divisible by ``every``, with how often they stand there, staged."""
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(F.floor(x.cast("double") * SCALE)) < LARGEST))
    return stage(rows.where((F.col("vec_id") % every == 0) & usable)
                 .groupBy("vec_id", "label", "vector").agg(F.count("*").alias("times")), "anchors")


_SCHEMA = "anchor int, slot int, score bigint, vec_id bigint"


def _batch(group: np.ndarray, score, ids, no_id, slots: int) -> pa.RecordBatch:
    return batch_of({"anchor": (pa.array(group // slots, pa.int32()), None), "slot": (pa.array(group % slots, pa.int32()), None),
                     "score": (pa.array(score), None), "vec_id": (pa.array(ids, mask=no_id), None)})


def _order() -> list:
    return [F.col("score").desc(), F.col("vec_id").asc_nulls_last()]


def positives_of(rows: DataFrame, sent, positives: int) -> DataFrame:
    """(anchor, slot, score, vec_id, rn): the best rows of the anchor's own label."""
    def run(batches):
        block = Block(*sent.value)
        best = Best(block.ids.size, positives)
        for b in batches:
            ids, no_id, labels, m = _parts(b, block.dims)
            for a, r, s in block.scores(m):
                some = slice(a, a + s.shape[0])
                those = slice(r, r + s.shape[1])
                same = ((block.labels[some, None] == labels[None, those]) & (s >= best.least[some, None])
                        & ((block.ids[some, None] != ids[None, those]) | no_id[None, those]))
                i, j = np.nonzero(same)
                best.add(a + i, s[i, j].astype(np.int64), ids[r + j], no_id[r + j])
        best.merge()
        yield _batch(*best.kept, 1)

    return top_n(rows.mapInArrow(run, _SCHEMA), _order(), positives, ("anchor", "slot"))


@dataclass
class Limits:
    """By anchor and positive, the best first: scores, ids and the limits of the windows. Missing positives have no window."""

    there: np.ndarray
    score: np.ndarray
    ids: np.ndarray
    no_id: np.ndarray
    upper: np.ndarray
    lower: np.ndarray

    @classmethod
    def of(cls, found: pa.Table, anchors: int, positives: int, low: int, high: int) -> Limits:
        at = found.column("anchor").to_numpy(), found.column(RANK).to_numpy() - 1
        (there, no_id), (s, ids) = np.zeros((2, anchors, positives), bool), np.zeros((2, anchors, positives), np.int64)
        column = found.column("vec_id")
        there[at], s[at] = True, found.column("score").to_numpy()
        ids[at], no_id[at] = column.fill_null(0).to_numpy(), column.is_null().to_numpy()
        # In whole numbers: the largest n with 100 n <= high s, and the smallest with 100 n >= low s.
        upper = np.where(there, s // 100 * high + s % 100 * high // 100, LOWEST)
        return cls(there, s, ids, no_id, upper, -(-s // 100 * low + -s % 100 * low // 100))


def slots_of(rows: DataFrame, sent, limits, positives: int, negatives: int) -> DataFrame:
    """(anchor, slot, score, vec_id, rn): the best rows of other labels in every slot."""
    def run(batches):
        block, lim = Block(*sent.value), Limits(*limits.value)
        best = Best(block.ids.size * positives, negatives)
        widest = np.where(lim.there & (lim.lower <= lim.upper), lim.lower, np.iinfo(np.int64).max).min(axis=1)
        for b in batches:
            ids, no_id, labels, m = _parts(b, block.dims)
            for a, r, s in block.scores(m):
                some = slice(a, a + s.shape[0])
                those = slice(r, r + s.shape[1])
                i, j = np.nonzero((s <= lim.upper[some, :1]) & (s >= widest[some, None])
                                  & (block.labels[some, None] != labels[None, those]))
                score = s[i, j].astype(np.int64)
                slot = (lim.upper[a + i] >= score[:, None]).sum(axis=1) - 1
                # No window that reaches down into a slot goes below the slot's own window.
                on = score >= lim.lower[a + i, slot]
                best.add((a + i[on]) * positives + slot[on], score[on], ids[r + j[on]], no_id[r + j[on]])
        best.merge()
        yield _batch(*best.kept, positives)

    return top_n(rows.mapInArrow(run, _SCHEMA), _order(), negatives, ("anchor", "slot"))


def suffix_merges(slots: DataFrame, sent, limits, negatives: int) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): all windows' answers, from the slots.

    A group is one anchor's slots: at most ``positives * negatives`` entries.
    """
    entry = F.struct("slot", RANK, "score", "vec_id")
    by_anchor = slots.groupBy("anchor").agg(F.array_sort(F.collect_list(entry)).alias("best"))

    def run(batches):
        block, lim = Block(*sent.value), Limits(*limits.value)
        for b in batches:
            out = []
            for anchor, best in zip(b.column("anchor").to_pylist(), b.column("best").to_pylist()):
                merged: list[tuple] = []
                for j in reversed(range(lim.there.shape[1])):
                    own = [(e["score"], e["vec_id"]) for e in best if e["slot"] == j]
                    merged = (own + merged)[:negatives]
                    if not lim.there[anchor, j]:
                        continue
                    positive = None if lim.no_id[anchor, j] else int(lim.ids[anchor, j])
                    rows = [(int(block.ids[anchor]), positive, i + 1, n, int(lim.score[anchor, j]), s)
                            for i, (s, n) in enumerate(x for x in merged if x[0] >= lim.lower[anchor, j])]
                    out += rows * int(block.times[anchor])
            names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
            yield batch_of({c: ([x[k] for x in out], pa.int32() if c == "rank" else pa.int64()) for k, c in enumerate(names)})

    return by_anchor.mapInArrow(run, "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                     "positive_score bigint, negative_score bigint")


def mine(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         anchors_a_block: int = ANCHORS_A_BLOCK) -> DataFrame:
    """The hard negatives of every anchor and positive, staged; ``low`` and ``high`` are per cent of the positive's score."""
    spark = vectors.sparkSession
    rows = rows_of(vectors)
    anchors = anchors_of(rows, every)
    blocks = max(1, -(-anchors.count() // anchors_a_block))
    out = None
    for block in range(blocks):
        dealt = anchors.where(F.pmod(F.xxhash64("vec_id", "vector", "label"), F.lit(blocks)) == block)
        ours = Block.of(dealt.toArrow())  # about ``anchors_a_block`` rows
        sent = spark.sparkContext.broadcast(_fields(ours))
        found = stage(positives_of(rows, sent, positives), "positives")
        limits = spark.sparkContext.broadcast(_fields(Limits.of(found.toArrow(), ours.ids.size, positives, low, high)))
        done = stage(suffix_merges(slots_of(rows, sent, limits, positives, negatives), sent, limits, negatives), "negatives")
        out = done if out is None else out.unionByName(done)
        sent.unpersist()
        limits.unpersist()
    return out
