"""License scans as an exact set-similarity join (operator 1).

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Every text is
cut into blocks of ``BLOCK_WORDS`` words, each starting ``STEP_WORDS`` after the one
before, so every passage of up to ``STEP_WORDS + 1`` words lies in a block. A block
matches a template if it has at least the template's threshold of the template's
distinct words (containment).

1. One pass reduces each block to its set of template words; other words can't
   count for any template. Blocks without a chance (fewer words than any template needs) are left out.
2. Template words are ordered by the number of blocks that have them, over all
   documents, rarest first. Both sides are sorted in that order.
3. Prefix filter: of a set of size s that must share o words, one of the first
   s - o + 1 is shared. The prefixes are joined on the word; templates are parameters
   of fixed size and are broadcast. A pair is kept only at its first shared word,
   so it comes once. Length filter: the block has at least o words.
   Positional filter: the shared word and what is left after it on either side can still make o.
4. What is left is verified exactly by the size of the intersection.

Phrases are templates with threshold 1; in a block that contains a phrase's words
the places are found where they stand consecutively. A place counts in the block
in whose first ``STEP_WORDS`` words it begins.

Defined results: a null text has no words. Repeated rows are judged each on its own.
An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm.common import alnum_words, batch_of, small_batches, stage, task_ids

BLOCK_WORDS = 128
STEP_WORDS = 64


@dataclass(frozen=True)
class Template:
    label: str
    words: str  # lower case, blank-separated
    threshold: float = 0.8
    phrase: bool = False  # the words must stand consecutively

    @property
    def parts(self) -> list[str]:
        return self.words.split()


PHRASES = [Template("mit", "mit license", 1.0, True), Template("apache", "apache license", 1.0, True),
           Template("gpl", "general public license", 1.0, True)]

#: Opening sentences of widely used licence notices. Fixed values.
TEMPLATES = [
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                    "associated documentation files to deal in the software without restriction"),
    Template("apache", "licensed under the apache license version 2 0 you may not use this file except in compliance "
                       "with the license you may obtain a copy of the license at"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                    "general public license as published by the free software foundation"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
                    "is hereby granted"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("apache-2.0", "licensed under the apache license version 2 0", 1.0),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", 1.0),
]


def needed(t: Template) -> int:
    """How many of a template's distinct words a block must have."""
    n = len(set(t.parts))
    return max(1, int(np.ceil(n * t.threshold - 1e-9)))


def blocks_of(docs: DataFrame, templates: list[Template], block_words: int, step_words: int) -> DataFrame:
    """(uid, doc_id, n_words, block, ids, at, id_at): a row per row of ``docs`` with block -1, and one per block.

    ids: the block's distinct template words. at, id_at: places and ids of phrase words, from the text's start.
    """
    vocabulary = sorted({w for t in templates for w in t.parts})
    number = {w.encode(): i for i, w in enumerate(vocabulary)}
    in_phrase = np.zeros(len(vocabulary) + 1, bool)
    in_phrase[[number[w.encode()] for t in templates if t.phrase for w in t.parts]] = True
    least = min(needed(t) for t in templates)

    def run(batches):
        uids = task_ids()
        for b in batches:
            of, cols = [], {c: [] for c in ("uid", "n_words", "block", "ids", "at", "id_at")}

            def put(row, *values):
                of.append(row)
                for c, v in zip(cols, values):
                    cols[c].append(v)

            for row, text in enumerate(b.column("text").to_pylist()):
                words, uid = alnum_words(text), next(uids)
                n = len(words)
                put(row, uid, n, -1, [], [], [])
                ids = np.fromiter((number.get(w, -1) for w in words), np.int32, n)
                at = np.flatnonzero(ids >= 0)
                ids = ids[at]
                starts = np.arange(0, n, step_words)
                first, last = np.searchsorted(at, starts), np.searchsorted(at, starts + block_words)
                for k in np.flatnonzero(last - first >= least).tolist():
                    mine, place = ids[first[k]:last[k]], at[first[k]:last[k]]
                    distinct = np.unique(mine)
                    if distinct.size >= least:
                        said = in_phrase[mine]
                        put(row, uid, n, k, distinct.tolist(), place[said].tolist(), mine[said].tolist())
            ints = pa.list_(pa.int32())
            yield batch_of({
                "uid": (cols["uid"], pa.int64()), "doc_id": (b.column("doc_id").take(pa.array(of, pa.int64())), None),
                "n_words": (cols["n_words"], pa.int64()), "block": (cols["block"], pa.int32()),
                "ids": (cols["ids"], ints), "at": (cols["at"], ints), "id_at": (cols["id_at"], ints)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"uid long, doc_id {kind}, n_words long, block int, ids array<int>, at array<int>, id_at array<int>")


def matches(blocks: DataFrame, templates: list[Template], step_words: int) -> DataFrame:
    """(uid, template, score, places): the pairs of blocks and templates that match; places only for phrases."""
    spark = blocks.sparkSession
    vocabulary = sorted({w for t in templates for w in t.parts})
    number = {w: i for i, w in enumerate(vocabulary)}
    real = blocks.where("block >= 0")
    # The global order: a row for each template word.
    common = {r["id"]: r["n"] for r in
              real.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("id").alias("n")).collect()}
    by_rarity = sorted(range(len(vocabulary)), key=lambda i: (common.get(i, 0), vocabulary[i]))
    place_of = [0] * len(vocabulary)
    for place, i in enumerate(by_rarity):
        place_of[i] = place

    rows = []
    for k, t in enumerate(templates):
        ordered = sorted({place_of[number[w]] for w in t.parts})
        o = needed(t)
        said = [number[w] for w in t.parts] if t.phrase else []
        rows += [(k, p, j, ordered, o, said) for j, p in enumerate(ordered[:len(ordered) - o + 1])]
    prefixes = F.broadcast(spark.createDataFrame(
        rows, "template int, word int, j int, t_words array<int>, o int, said array<int>"))

    order = F.lit(place_of).cast("array<int>")
    sorted_blocks = real.select("uid", "block", "at", "id_at", F.array_sort(
        F.transform("ids", lambda i: F.element_at(order, i + 1))).alias("b_words"))
    # No template needs fewer words than this, so no prefix of the block is longer.
    least = min(needed(t) for t in templates)
    longest = F.size("b_words") - (least - 1)
    probes = sorted_blocks.select("*", F.posexplode(F.slice("b_words", F.lit(1), longest)).alias("i", "word"))

    b_size, t_size = F.size("b_words"), F.size("t_words")
    rest = F.least(b_size - F.col("i"), t_size - F.col("j"))
    pairs = (probes.join(prefixes, "word")
             .where(b_size >= F.col("o"))  # length
             .where(F.col("i") <= b_size - F.col("o"))  # prefix, for this template
             .where(rest >= F.col("o"))  # position
             .where(~F.arrays_overlap(F.slice("b_words", F.lit(1), F.col("i")), F.col("t_words"))))  # first shared word
    shared = F.size(F.array_intersect("b_words", "t_words"))
    sure = pairs.withColumn("shared", shared).where(F.col("shared") >= F.col("o"))
    first = F.col("said")[0]
    spoken = F.arrays_zip(F.col("at"), F.col("id_at"))

    def stands(x):  # the phrase's words follow one another from here
        return F.forall(F.sequence(F.lit(0), F.size("said") - 1),
                        lambda q: F.array_contains(F.transform(spoken, lambda s: F.struct(
                            s["at"].alias("a"), s["id_at"].alias("w"))),
                            F.struct((x["at"] + q).alias("a"), F.get(F.col("said"), q).alias("w"))))

    owned = F.col("block") * step_words
    places = F.transform(F.filter(spoken, lambda x: (x["id_at"] == first) & (x["at"] >= owned)
                                  & (x["at"] < owned + step_words) & stands(x)), lambda x: x["at"])
    is_phrase = F.size("said") > 0
    return (sure.select("uid", "template", (F.col("shared") / t_size).alias("score"), is_phrase.alias("phrase"),
                        F.when(is_phrase, places).otherwise(F.array().cast("array<int>")).alias("places"))
            .where(~F.col("phrase") | (F.size("places") > 0)))


def scan_licenses(docs: DataFrame, templates: list[Template] | None = None, block_words: int = BLOCK_WORDS,
                  step_words: int = STEP_WORDS) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), a row per row of ``docs``.

    n_base, first_word, last_word, base_labels: of the phrases' places. labels: of all templates
    that match. score: the largest containment reached, 0 without a match.
    """
    templates = PHRASES + TEMPLATES if templates is None else templates
    longest = max(len(t.parts) for t in templates)
    if longest > step_words + 1 or block_words < 2 * step_words:
        raise ValueError("a template must fit the overlap of two blocks")
    small_batches(docs.sparkSession)
    blocks = stage(blocks_of(docs, templates, block_words, step_words), "blocks")
    labels = F.lit([t.label for t in templates]).cast("array<string>")
    found = matches(blocks, templates, step_words).withColumn("label", F.element_at(labels, F.col("template") + 1))
    some = found.groupBy("uid").agg(
        F.sum(F.size("places")).alias("n_base"), F.min(F.array_min("places")).alias("first_word"),
        F.max(F.array_max("places")).alias("last_word"),
        F.collect_set(F.when(F.col("phrase"), F.col("label"))).alias("base"), F.collect_set("label").alias("all"),
        F.max("score").alias("score"))
    text = lambda c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit(""))
    return (blocks.where("block = -1").select("uid", "doc_id", "n_words").join(some, "uid", "left")
            .select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
                    F.col("first_word").cast("long"), F.col("last_word").cast("long"),
                    text("base").alias("base_labels"), text("all").alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score")))
