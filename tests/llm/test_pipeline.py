"""The pipeline against a plain Python version of its stages, with hard rows and with columns of every name it uses."""

import base64
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
import xxhash
from llm_rows import PASSAGE, ROWS, text

import corpus_pipeline as P
from comptoir.llm import quality
from comptoir.llm.queries import tokenizer

BLANKS = " \t\n\x0b\x0c\r"
NAMES = ["keep", "n_words", "n_lines", "n_dropped", "kept_text", "expected_grade", "hit_items", "hit_starts", "a.b", "__text",
         "__starts", "__row", "__id", "__th", "fp", "c3", "k0", "x0", "th", "root", "Lang"]
ITEMS = [(1, PASSAGE.upper()), (2, text(5, 12)), (3, "漢字3"), (4, None), (5, ""), (None, text(8, 11))]


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")


def lines_by_hand(rows):
    hold, key = defaultdict(set), lambda line: low(line.strip(BLANKS))
    rank = lambda i: (i is not None, i or 0)
    for i, t in rows:
        for line in (t or "").split("\n"):
            hold[key(line)].add(rank(i))
    stays = lambda i, x: len(key(x)) < 20 or len(hold[key(x)]) < 3 or max(hold[key(x)]) == rank(i)
    return [(i, t and "\n".join(x for x in t.split("\n") if stays(i, x))) for i, t in rows]


def simhash(t):
    w = (t or "").encode().lower().split()
    s = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_by_hand(rows):
    fps, group = [simhash(t) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3 and group[a] != group[b]:
                old = group[a]
                group = [group[b] if g == old else g for g in group]
    signed = lambda t: 42 if t is None else int(np.uint64(xxhash.xxh64_intdigest(t.encode(), seed=42)).view(np.int64))
    first = {}
    for k, (i, t) in enumerate(rows):
        order = (i is None, i or 0, signed(t))
        if group[k] not in first or order < first[group[k]][0]:
            first[group[k]] = order, (i, t)
    return [r for _, r in first.values()]


def clean_by_hand(rows, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for _, t in items:
        w = word.findall(low(t))
        for a in range(max(len(w) - 9, 1) if w else 0):
            windows.add(tuple(w[a:a + 10]))
    out = []
    for i, t in rows:
        at = [m.span() for m in word.finditer(low(t))]
        w, hit = word.findall(low(t)), set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in windows:
                    hit.update(range(a, a + n))
        for a in sorted(hit, reverse=True):
            if a + 1 in hit:  # between neighbours nothing stays: the next one's rest begins where it began
                t = t[:at[a][0]] + t[at[a + 1][0]:]
            else:
                t = t[:at[a][0]] + t[at[a][1]:]
        out.append((i, t))
    return out


def tokens_by_hand(rows):
    path, pattern = tokenizer()
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        out.append((i, len(ids), sha(",".join(map(str, ids))), sha(t or ""), tuple(ids)))
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(i, i % 2, 0) for i in range(12)] + [(30, 1, 1), (40, None, None), (None, 1, 0), (41, 1, 0), (41, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def frame(spark, rows):
    """With a column of every name that the operators use, and n_chars last."""
    schema = ", ".join(f"`{c}` int" for c in NAMES)
    return spark.createDataFrame([(i, t, *range(len(NAMES)), None if t is None else len(t)) for i, t in rows],
                                 f"doc_id long, text string, {schema}, n_chars int").repartition(3)


BY_HAND = [lines_by_hand, near_by_hand, lambda rows: clean_by_hand(rows, ITEMS)]


def test_every_stage_keeps_columns_and_equals_plain_python(spark, folder):
    rows, docs = list(ROWS), frame(spark, ROWS)
    columns = docs.columns
    for (name, step), by_hand in zip(P.STAGES[1:4], BY_HAND):
        docs, rows = P.stage(step(spark, docs, folder), "test"), by_hand(rows)
        assert docs.columns == columns, name
        got = docs.collect()
        assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows), name
        assert all(r[c] == k for r in got for k, c in enumerate(NAMES)), name
        assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got), name
    out = P.stage(P.STAGES[4][1](spark, docs, folder), "test")
    assert Counter(tuple(r["token_ids"]) if c == "token_ids" else r[c] for r in out.collect() for c in out.columns) == Counter(
        v for r in tokens_by_hand(rows) for v in r)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], tuple(r["token_ids"]))
                   for r in out.collect()) == Counter(tokens_by_hand(rows))


def test_the_classifier_stage_keeps_what_the_model_says(spark, folder):
    docs = frame(spark, ROWS)
    out = P.quality_stage(spark, docs, folder)
    assert out.columns == docs.columns
    model = quality.train(docs.select("doc_id", "text"), quality.grades(spark.read.parquet(f"{folder}/labels.parquet")))
    exp = Counter()
    for i, t in ROWS:
        places, values = quality.Features(quality.DIMS).of(t)
        p = 1 / (1 + np.exp(model.thresholds[1] - values @ model.weights[places]))
        exp[i, t] += int(p >= 0.5)
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == +exp and 0 < len(got) < len(ROWS)
    assert all(r[c] == k for r in got for k, c in enumerate(NAMES))


@pytest.mark.parametrize("labels, items", [(True, True), (False, False)])
def test_run_on_empty_tables(spark, folder, tmp_path, labels, items):
    path = str(tmp_path)
    frame(spark, []).write.parquet(f"{path}/documents.parquet")
    for name, full in (("labels", labels), ("benchmark", items)):
        df = spark.read.parquet(f"{folder}/{name}.parquet")
        (df if full else df.limit(0)).write.parquet(f"{path}/{name}.parquet")
    out = P.run(spark, path)
    assert out.count() == 0 and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids"]


def test_without_ratings_and_items_only_copies_go(spark, folder, tmp_path):
    path = str(tmp_path)
    frame(spark, ROWS).write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    exp = tokens_by_hand(near_by_hand(lines_by_hand(ROWS)))
    assert Counter((r["doc_id"], r["ids_sha256"]) for r in P.run(spark, path).collect()) == Counter((x[0], x[2]) for x in exp)


def lossy(n):
    """A document of n lines that loses every second one."""
    return "\n".join(f"line number {i} stands in many documents" if i % 2 else f"{i} alone" for i in range(n))


def test_line_dedup_takes_time_in_proportion_to_the_lines(spark):
    import time

    from comptoir.llm import line_dedup

    took = []
    for n in (4000, 16000, 64000):
        docs = spark.createDataFrame([(i, lossy(n)) for i in range(3)], "doc_id long, text string").repartition(3)
        best = []
        for _ in range(2):
            t = time.time()
            assert [r["n_dropped"] for r in line_dedup.dedup_lines(docs).orderBy("doc_id").collect()] == [n // 2, n // 2, 0]
            best.append(time.time() - t)
        took.append(min(best))
    assert took[2] < 8 * took[1] + 2, took  # four times the lines
