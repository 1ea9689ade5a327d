"""Quality classifier: ordinal cumulative-link regression on hashed text (operator 5).

Ratings are grades 0 to 2 (:func:`grades`: 0 toxic, 1 of low quality, 2 clean). The
model has one weight for each of ``DIMS`` hashed features, shared by all grades, and
ordered thresholds: P(grade > j) = 1 / (1 + exp(t_j - w.x)). The thresholds stay
ordered because the gaps between them are exponentials of free parameters.

Features are the distinct tokens of the whole text (runs of letters and digits,
lower-cased, and runs of marks), with a value that grows with the logarithm of their count,
and three shares of noise: words in capitals, tokens that repeat the one before, marks that aren't
punctuation.

Training maximises the cumulative-link likelihood less a ridge by limited-memory quasi-Newton
steps. Every evaluation is a Spark job over the staged features of a bounded sample of rated documents
(``most_rated``, by hash of id, grade and text), which adds up likelihood and gradient by task; the driver sees a vector of
fixed size for each task. The weights have a fixed size and are broadcast. Scoring is one pass without a
shuffle.

A document is kept if its tail probability P(grade >= ``keep_grade``) is at least
``keep_probability``.

Defined results: a null text is empty; a text without tokens has the thresholds' own probabilities.
Ratings without a document are left out before the sample is bounded, and so are ratings whose grade is unknown (a
toxic text has grade 0 whatever its quality). A document rated with several grades, or a ``doc_id`` with several texts,
gives a sample for each; rows that repeat id, text and grade are one sample, so no id can fill the sample by repetition.
Without ratings every document gets the same probabilities, and all are kept. Columns beside ``doc_id`` and ``text``
are kept, but for those named as an output.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm.common import batch_of, extended, small_batches, stage, text_hash

DIMS = 1 << 18
GRADES = 3
MOST_RATED = 20_000
STEPS = 25
RIDGE = 1.0
SHARE_SCALE = 10.0
MEMORY = 8  # pairs of steps that a quasi-Newton step looks back on
PUNCTUATION = set(".,;:!?'\"()-")
KEEP_GRADE, KEEP_PROBABILITY = 2, 0.5


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray


def grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from the ratings quality 0/1 and toxic 0/1; a toxic one needs no quality."""
    return labels.where("doc_id is not null and (toxic = 1 or quality is not null and toxic is not null)").select(
        "doc_id", F.when(F.col("toxic") == 1, 0).otherwise(F.col("quality") + 1).cast("int").alias("grade"))


class Features:
    """Hashed features of a text; remembers the places of frequent tokens."""

    def __init__(self, dims: int):
        self.dims, self.places = dims, {}
        self.find = re.compile(r"\w+|[^\w\s]+").findall

    def place(self, token: str) -> int:
        p = self.places.get(token)
        if p is None:
            p = zlib.crc32(token.encode()) % self.dims
            if len(self.places) < 300_000:
                self.places[token] = p
        return p

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(places, values)."""
        tokens = self.find(text or "")
        if not tokens:
            return np.zeros(0, np.int32), np.zeros(0)
        counts = Counter(map(str.lower, tokens))
        places = [self.place(t) for t in counts]
        values = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
        shares = {"\0capitals": sum(1 for t in tokens if len(t) > 1 and t.isupper()),
                  "\0again": sum(map(str.__eq__, tokens, tokens[1:])),
                  "\0marks": sum(n for t, n in counts.items() if not (t[0].isalnum() or t[0] == "_" or t in PUNCTUATION))}
        places += [self.place(t) for t in shares]
        return (np.array(places, np.int32),
                np.r_[values, [SHARE_SCALE * n / len(tokens) for n in shares.values()]])


def probabilities(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade > j) by row and j."""
    return 1.0 / (1.0 + np.exp(np.clip(thresholds[None, :] - score[:, None], -60, 60)))


def gradient(places, values, rows, grade, model: Model) -> tuple[float, np.ndarray, np.ndarray]:
    """(log likelihood, its gradient by weight, by threshold) of documents in sparse form."""
    n, k = grade.size, model.thresholds.size
    score = np.bincount(rows, weights=values * model.weights[places], minlength=n)
    tail = probabilities(score, model.thresholds)
    upper = np.c_[np.ones(n), tail][np.arange(n), grade]  # P(y >= grade)
    lower = np.c_[tail, np.zeros(n)][np.arange(n), grade]  # P(y > grade)
    p = np.maximum(upper - lower, 1e-12)
    d_upper, d_lower = upper * (1 - upper) / p, lower * (1 - lower) / p
    by_score = d_upper - d_lower
    by_weight = np.bincount(places, weights=values * by_score[rows], minlength=model.weights.size)
    by_threshold = np.array([np.sum(d_lower[grade == j]) - np.sum(d_upper[grade == j + 1]) for j in range(k)])
    return float(np.log(p).sum()), by_weight, by_threshold


def _direction(grad: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The quasi-Newton ascent direction from the last steps and changes of the gradient."""
    q, back = grad.copy(), []
    for s, y in reversed(pairs):
        a = (s @ q) / (s @ y)
        q -= a * y
        back.append(a)
    if pairs:
        s, y = pairs[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(pairs, reversed(back)):
        q += s * (a - (y @ q) / (s @ y))
    return q


def sampled(docs: DataFrame, rated: DataFrame, most_rated: int) -> DataFrame:
    """(text, grade): at most ``most_rated`` of the distinct (doc_id, text, grade), the first by their hash."""
    key = ["doc_id", "grade", "__th"]
    texts = docs.select("doc_id", "text", text_hash().alias("__th"))
    found = stage(texts.select("doc_id", "__th").join(rated.select("doc_id", "grade").distinct(), "doc_id").select(*key)
                  .distinct().withColumn("__h", F.xxhash64(*key)), "rated_ids")
    # Only hashes under a bound that leaves somewhat more than enough are ordered, so that one task never gets them all.
    n, near, share = found.count(), found, 1.25 * most_rated + 1000
    while share < n:
        near = found.where(F.col("__h") < F.lit(int(share / n * 2.0 ** 64) - (1 << 63)))
        if near.count() >= most_rated:
            break
        near, share = found, 2 * share
    chosen = near.orderBy("__h", *key).limit(most_rated).select(*key)
    # ``most_rated`` rows are broadcast; no text is shuffled but theirs.
    return texts.join(F.broadcast(chosen), ["doc_id", "__th"]).dropDuplicates(key).select("text", "grade")


def train(docs: DataFrame, rated: DataFrame, most_rated: int = MOST_RATED, steps: int = STEPS, dims: int = DIMS,
          ridge: float = RIDGE, tasks: int = 8) -> Model:
    """Fit to the documents with a grade (``rated``: doc_id, grade)."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = sampled(docs, rated, most_rated)

    def vectors(batches):
        made = Features(dims)
        for b in batches:
            found = [made.of(t) for t in b.column("text").to_pylist()]
            yield batch_of({"grade": (b.column("grade"), None),
                            "places": ([p.astype("<i4").tobytes() for p, _ in found], pa.binary()),
                            "vals": ([v.astype("<f4").tobytes() for _, v in found], pa.binary())})

    # Dealt by content, so that a rerun on the same data adds up the same numbers in the same tasks.
    data = stage(texts.mapInArrow(vectors, "grade int, places binary, vals binary")
                 .repartition(tasks, F.xxhash64("places")), "rated")
    shares = {r["grade"]: r["n"] for r in data.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    total = sum(shares.values())

    def thresholds(x: np.ndarray) -> np.ndarray:
        """From the last parameters: the first threshold and the logarithms of the gaps."""
        first, gaps = x[dims], np.exp(x[dims + 1:])
        return np.r_[first, first + np.cumsum(gaps)]

    def evaluate(x: np.ndarray) -> tuple[float, np.ndarray]:
        now = spark.sparkContext.broadcast((x[:dims], thresholds(x)))

        def add_up(batches):
            model, likelihood, by_w, by_t = Model(*now.value), 0.0, np.zeros(dims), np.zeros(GRADES - 1)
            for b in batches:
                places = [np.frombuffer(v, "<i4") for v in b.column("places").to_pylist()]
                rows = np.repeat(np.arange(len(places)), [p.size for p in places])
                vals = np.concatenate([np.frombuffer(v, "<f4") for v in b.column("vals").to_pylist()]).astype(float)
                one, w, t = gradient(np.concatenate(places), vals, rows, b.column("grade").to_numpy(), model)
                likelihood, by_w, by_t = likelihood + one, by_w + w, by_t + t
            at = np.flatnonzero(by_w)
            yield batch_of({"sum": ([likelihood], pa.float64()), "at": ([at.astype("<i4").tobytes()], pa.binary()),
                            "by_w": ([by_w[at].tobytes()], pa.binary()), "by_t": ([by_t.tobytes()], pa.binary())})

        value, by_t, grad = -ridge / 2 * float(x[:dims] @ x[:dims]), np.zeros(GRADES - 1), np.zeros(x.size)
        grad[:dims] = -ridge * x[:dims]
        for r in data.mapInArrow(add_up, "sum double, at binary, by_w binary, by_t binary").collect():  # a row a task
            value += r["sum"]
            grad[np.frombuffer(r["at"], "<i4")] += np.frombuffer(r["by_w"])
            by_t += np.frombuffer(r["by_t"])
        grad[dims] = by_t.sum()
        for j in range(1, GRADES - 1):
            grad[dims + j] = by_t[j:].sum() * math.exp(x[dims + j])
        now.unpersist()
        return value, grad

    # Start at the thresholds that give the grades' shares without any feature.
    above = [(sum(n for g, n in shares.items() if g > j) + 1) / (total + 2) for j in range(GRADES - 1)]
    first = [math.log((1 - a) / a) for a in above]
    x = np.zeros(dims + GRADES - 1)
    x[dims:] = [first[0], *(math.log(max(b - a, 1e-3)) for a, b in zip(first, first[1:]))]
    if not total:  # nothing to learn from: every tail is likely, so nothing is rejected
        return Model(x[:dims], np.linspace(-1.0, -0.5, GRADES - 1))
    value, grad = evaluate(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d = _direction(grad, pairs)
        if d @ grad <= 0:
            d, pairs = grad.copy(), []
        size = 1.0 if pairs else 1.0 / max(1.0, float(np.linalg.norm(grad)))
        for _ in range(8):  # halve until the step is an ascent
            there = x + size * d
            new, new_grad = evaluate(there)
            if new >= value + 1e-4 * size * float(d @ grad):
                break
            size /= 2
        else:
            break
        s, y = there - x, grad - new_grad
        if s @ y > 1e-10:
            pairs = [*pairs, (s, y)][-MEMORY:]
        done = new - value < 1e-5 * abs(value)
        x, value, grad = there, new, new_grad
        if done:
            break
    return Model(x[:dims].copy(), thresholds(x))


def score(docs: DataFrame, model: Model, keep_grade: int = KEEP_GRADE,
          keep_probability: float = KEEP_PROBABILITY) -> DataFrame:
    """``docs`` with ``expected_grade``, ``p_above_0``, ``p_above_1`` (tail probabilities) and ``keep``."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def work(batches):
        weights, thresholds = sent.value
        made = Features(weights.size)
        for texts, in batches:
            scores = []
            for text in texts.to_pylist():
                places, values = made.of(text)
                scores.append(float(values @ weights[places]))
            tail = probabilities(np.array(scores), thresholds)
            yield None, [pa.array(tail.sum(axis=1)), pa.array(tail[:, 0]), pa.array(tail[:, 1]),
                         pa.array(tail[:, keep_grade - 1] >= keep_probability)]

    return extended(docs, [docs["text"]], "expected_grade double, p_above_0 double, p_above_1 double, keep boolean", work)


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Train on the rated documents and score all of them."""
    return score(docs, train(docs, grades(labels), **options))
