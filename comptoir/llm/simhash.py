"""SimHash near-dedup with pigeonhole blocks (operator 9).

A document's fingerprint has 64 bits: bit i is set if it is set in over half
of the XXH64 hashes (seed 42) of its word shingles. Documents link when their
fingerprints differ in at most ``max_bits`` bits; groups are the connected
components of the links.

1. One pass computes the fingerprints; equal ones collapse to one class each,
   so a document copied a million times is one row from here on.
2. Pigeonhole: the 64 bits are split into ``2 * max_bits`` blocks (at least one).
   Two fingerprints within ``max_bits`` bits agree on at least half of the
   blocks, so each class is keyed by every choice of half of its blocks, and
   only classes with an equal key are compared.
3. A key with more than ``tile`` classes is dealt into chunks by hash, and each
   pair of chunks becomes a group of its own: no task holds more than two
   chunks, and every pair still meets.
4. Within a group the Hamming distance decides. Linked classes are reported as
   a star around one of them (at most one row a class), not as all pairs.
5. Components are computed over the stars (:mod:`~comptoir.llm.components`).

Defined results: a null or empty text has no words and the fingerprint zero,
which links like any other; a text with fewer words than a shingle is one
shingle. ``component_id`` is the smallest ``doc_id`` of the group (nulls are
passed over; a group of nulls alone has null). An empty table gives an empty
result. Other columns play no part.

:func:`one_per_component` keeps one row of each group, whatever ids are null or
repeated: rows are told apart by a staged number, and the smallest by
(``doc_id`` nulls last, hash of the text, number) stays.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm.common import batch_of, small_batches, stage, text_hash
from comptoir.llm.components import connected_components

_hash = partial(xxhash.xxh64_intdigest, seed=42)
_CHUNK = 1 << 16  # hashes unpacked into bits at a time


def fingerprint(text: str | None, shingle_words: int) -> int:
    """The SimHash of one text, unsigned."""
    words = [] if text is None else text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        return _hash(b" ".join(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    n = len(words) - shingle_words + 1
    h = np.fromiter(map(_hash, shingles), "<u8", n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        ones += np.unpackbits(h[i:i + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ``carry``, fp): one row per row of ``docs``; fp is the fingerprint as a signed long."""
    small_batches(docs.sparkSession)
    ids = ["doc_id", *carry]
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in ids)

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle_words) for t in b.column("text").to_pylist()], "<u8")
            yield batch_of({c: (b.column(c), None) for c in ids} | {"fp": (pa.array(fps.view("<i8")), None)})

    return docs.select(*ids, "text").mapInArrow(run, f"{kinds}, fp bigint")


def block_masks(max_bits: int) -> list[int]:
    """A mask (signed) for each choice of half of the blocks."""
    n = max(2 * max_bits, 1)
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(blocks, n - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _stars(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(members, centre) arrays that connect what is linked among the distinct ``fps``."""
    out, todo = [], fps
    while todo.size > 1:
        centre, rest, frontier = todo[0], todo[1:], [todo[0]]
        while frontier and rest.size:
            near = np.bitwise_count(rest ^ frontier.pop()) <= max_bits
            if near.any():
                found, rest = rest[near], rest[~near]
                out.append((found, np.full(found.size, centre)))
                frontier += list(found)
        todo = rest
    return out


def _link(max_bits: int):
    """Batches sorted by gid, fp -> edges between the classes of each gid."""
    def groups(gid: np.ndarray, fp: np.ndarray):
        first = np.flatnonzero(np.r_[True, gid[1:] != gid[:-1]])
        size = np.diff(np.r_[first, gid.size])
        two = first[size == 2]
        near = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_bits]
        found = [(fp[near], fp[near + 1])]
        for i, n in zip(first[size > 2], size[size > 2]):
            found += _stars(np.unique(fp[i:i + n]), max_bits)
        u, v = (np.concatenate(x) for x in zip(*found))
        return batch_of({"u": (pa.array(u.view(np.int64)), None), "v": (pa.array(v.view(np.int64)), None)})

    def run(batches):
        gid, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for b in batches:
            gid = np.r_[gid, b.column("gid").to_numpy(zero_copy_only=False)]
            fp = np.r_[fp, b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)]
            cut = np.searchsorted(gid, gid[-1]) if gid.size else 0  # the last group may go on in the next batch
            if cut:
                yield groups(gid[:cut], fp[:cut])
                gid, fp = gid[cut:], fp[cut:]
        if gid.size:
            yield groups(gid, fp)
    return run


def links(classes: DataFrame, max_bits: int = 3, tile: int = 2000) -> DataFrame:
    """Edges (u, v) that connect the classes (column fp, distinct) within ``max_bits`` bits of each other."""
    masks = F.array(*[F.lit(m) for m in block_masks(max_bits)])
    keys = (classes.select("fp", F.posexplode(masks).alias("choice", "mask"))
            .select("fp", "choice", F.col("fp").bitwiseAND(F.col("mask")).alias("key")))
    sizes = keys.groupBy("choice", "key").agg(F.count("fp").alias("n")).where("n > 1")
    # One chunk for most keys. A key with c chunks has a group for each pair of chunks.
    c = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("c")).cast("int")
    dealt = (keys.join(sizes, ["choice", "key"]).withColumn("c", c).withColumn("i", mine)
             .select("fp", "choice", "key", "i", F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("j"))
             .select("fp", F.xxhash64("choice", "key", F.least("i", "j"), F.greatest("i", "j")).alias("gid")))
    return (dealt.repartition("gid").sortWithinPartitions("gid", "fp")
            .mapInArrow(_link(max_bits), "u bigint, v bigint"))


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3, tile: int = 2000) -> DataFrame:
    """(doc_id, fp, component_id): one row per row of ``docs``."""
    fps = stage(fingerprints(docs, shingle_words), "fingerprints")
    classes = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    comps = connected_components(links(classes, max_bits, tile))
    member = classes.join(comps, F.col("fp") == F.col("node")).select("fp", "first_id", "root")
    best = member.groupBy("root").agg(F.min("first_id").alias("group_id"))
    linked = member.join(best, "root").select("fp", "group_id")
    # Staged, so that the last join shuffles both sides and Spark can split a hot fingerprint.
    ids = stage(classes.join(linked, "fp", "left")
                .select("fp", F.coalesce("group_id", "first_id").alias("component_id")), "component_ids")
    return fps.join(ids, "fp", "left").select("doc_id", "fp", "component_id")


def one_per_component(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3, tile: int = 2000) -> DataFrame:
    """The row of each component that is smallest by (doc_id nulls last, hash of the text, number of the row)."""
    rows = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    fps = fingerprints(rows.select("doc_id", "text", "__row", text_hash().alias("__th")), shingle_words, ("__row", "__th"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__th", "__row")
    classes = stage(fps.groupBy("fp").agg(F.min(order).alias("first")), "classes")
    comps = connected_components(links(classes, max_bits, tile))
    # A class without a link is a component of its own; its fp is no other component's root.
    stay = (classes.join(comps, F.col("fp") == F.col("node"), "left")
            .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first")).select("first.__row"))
    return rows.join(stay, "__row", "left_semi").select(*(f"`{c}`" for c in docs.columns))
