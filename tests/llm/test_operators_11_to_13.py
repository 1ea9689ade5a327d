"""Operators 11 to 13 against brute force, on rows with the hard cases and on empty tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from llm_rows import ROWS

from comptoir.llm import hard_negatives, mixing, whitening

VECTORS = ("vec_id long, embedding array<float>, label int, n long, whitened string, anchor int, score string, `a.b` int, "
           "__vector int")


def vectors(rng, n, dims, spread=1.0):
    return (rng.normal(size=(n, dims)) * spread).astype(np.float32)


def hard_vectors():
    """Vectors with nulls, non-finite entries, other lengths, repeats, one very common vector."""
    rng = np.random.default_rng(5)
    good = [(i, [float(x) for x in v], int(i % 10)) for i, v in enumerate(vectors(rng, 230, 6))]
    common = [float(x) for x in vectors(rng, 1, 6)[0]]
    nan, inf = float("nan"), float("inf")
    rows = good + [(300 + i, common, i % 3) for i in range(60)]
    rows += [(50, good[50][1], 0), (50, good[50][1], 0), (100, good[7][1], 4), (7, good[7][1], 1)]  # repeated ids and rows
    rows += [(400, None, 1), (401, [1.0] * 5 + [None], 1), (402, [1.0] * 5 + [nan], 1), (450, [inf] + [0.0] * 5, 1),
             (404, [], 2), (405, [1.0, 2.0], 3), (500, [0.5] * 9, 3), (None, good[3][1], 3), (None, None, None),
             (550, good[9][1], None), (600, [1e30] * 6, 2), (650, [-0.0] * 6, 5)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y", 3, 4) for r in rows], VECTORS).repartition(4)


def usable(rows, most):
    return [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) and abs(x) < most for x in r[1])]


def exact_whitening(rows):
    """(rows that count, S, exact covariance) in whole numbers and fractions."""
    rows = usable(rows, 2.0 ** 34)
    most = Counter(len(r[1]) for r in rows if r[1])
    dims = max(most, key=lambda d: (most[d], d))
    rows = [(r[0], [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in r[1]]) for r in rows if len(r[1]) == dims]
    n, s = len(rows), [sum(x[i] for _, x in rows) for i in range(dims)]
    z = [[n * x[i] - s[i] for i in range(dims)] for _, x in rows]
    v = [[Fraction(sum(a[i] * a[j] for a in z), n ** 3) for j in range(dims)] for i in range(dims)]
    return rows, s, v


def test_whitening(spark):
    rows = hard_vectors()
    kept, s, v = exact_whitening(rows)
    df = frame(spark, rows)
    model = whitening.fit(df, components=4)
    n = len(kept)
    cov = np.array([[float(x) for x in r] for r in v])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    assert model.n == n and np.allclose(model.eigenvalues, e[:4], rtol=1e-12)
    assert np.allclose(model.explained, e[:4] / sum(e), rtol=1e-12)
    u = u * np.sign((u[:, :4] * model.components).sum(axis=0).tolist() + [1.0, 1.0])
    assert np.allclose(model.components, u[:, :4], atol=1e-11)
    out = whitening.transform(df, model)
    assert out.columns == ["vec_id", "embedding", "label", "anchor", "score", "a.b", "__vector", "n", "deviation", "whitened"]
    got = defaultdict(list)
    for r in out.collect():
        got[r["vec_id"]].append((r["n"], int(r["deviation"]), r["whitened"]))
    exp = defaultdict(list)
    for i, x in kept:
        z = [n * a - b for a, b in zip(x, s)]
        exp[i].append((n, sum(a * a for a in z), list(np.array([float(Fraction(a, n)) for a in z]) @ u[:, :4] / np.sqrt(e[:4]))))
    assert got.keys() == exp.keys()
    for i in exp:
        for a, b in zip(sorted(got[i]), sorted(exp[i]), strict=True):
            assert a[:2] == b[:2] and np.allclose(a[2], b[2], atol=1e-9)
    assert whitening.identity_error(df, model) < 1e-9


@pytest.mark.parametrize("rows", [
    [], [(1, None, 1), (2, [float("nan")], 1), (3, [], 1)]])
def test_whitening_without_usable_rows(spark, rows):
    assert whitening.fit(spark.createDataFrame([r[:2] for r in rows], "vec_id long, embedding array<float>")) is None


def test_whitening_of_flat_vectors(spark):
    """Dimensions that depend on each other, and equal vectors: null where the eigenvalue is zero."""
    rng = np.random.default_rng(1)
    m = rng.integers(-40, 40, (50, 3))
    rows = [(i, [float(a), float(b), float(a + b), 7.0, float(c)]) for i, (a, b, c) in enumerate(m)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    model = whitening.fit(df)
    assert list(model.flat) == [False] * 3 + [True] * 2 and whitening.identity_error(df, model) < 1e-9
    assert all([x is None for x in r["whitened"]] == list(model.flat) for r in whitening.transform(df, model).collect())
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], "vec_id long, embedding array<double>")
    model = whitening.fit(same)
    assert all(model.flat) and list(model.explained) == [0.0, 0.0] and whitening.identity_error(same, model) == 0
    assert {(r["whitened"][0], r["deviation"]) for r in whitening.transform(same, model).collect()} == {(None, 0)}


def test_whitening_of_wide_ranges_is_exact(spark):
    """Entries whose products need more than 64 bits."""
    rows = [(i, [2.0 ** (30 - i % 3), float(i % 5) * 1e8, float(i)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    x = np.array([[math.floor(64 * c) for c in r[1]] for r in rows], object)
    z = len(rows) * x - x.sum(axis=0)
    model = whitening.fit(df)
    assert {r["vec_id"]: r["deviation"] for r in whitening.transform(df, model).collect()} == {
        i: d for i, d in enumerate((z * z).sum(axis=1))}
    v = np.array([[Fraction(int(a), len(rows) ** 3) for a in r] for r in z.T @ z])
    assert abs(model.eigenvalues.sum() / float(v.trace()) - 1) < 1e-14


def test_jacobi_keeps_small_eigenvalues():
    """A graded matrix: eigenvalues over 12 orders of magnitude, each to a relative error."""
    rng = np.random.default_rng(3)
    for d in (1, 2, 7, 12):
        q, _ = np.linalg.qr(rng.normal(size=(d, d)))
        scale = 10.0 ** -np.arange(d)
        v = scale[:, None] * (q @ np.diag(1 + np.arange(d)) @ q.T) * scale
        v = (v + v.T) / 2
        units, e = whitening.components_of(v)
        rank = np.count_nonzero(e)
        assert np.allclose((units.T @ units)[:rank, :rank], np.eye(rank), atol=1e-12) and (np.diff(e) <= 0).all()
        assert np.allclose(units @ np.diag(e) @ units.T, v, rtol=1e-10, atol=1e-13 * v.max())
        factor, order = whitening.pivoted_cholesky(v)
        turned = whitening.one_sided_jacobi(factor)
        gram = turned.T @ turned
        norms = np.sqrt(gram.diagonal())
        assert (np.abs(gram / np.outer(norms, norms) - np.eye(len(gram))) < 1e-13).all()
        assert np.allclose(turned @ turned.T, v[order][:, order], rtol=1e-12, atol=1e-15 * v.max())


def size_of(t):
    return len(re.findall("[^\x20\x09-\x0d]+", t or ""))


def mix_by_hand(rows, weights=(5, 2, 1), most=3):
    """Targets by sharing the excess again and again, taken words by trying the draws."""
    total, sizes = sum(size_of(t) for _, t, _ in rows), defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size_of(t)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, spare, open_ = dict.fromkeys(order, 0.0), float(total), list(order)
    while spare > 1e-9 * max(total, 1) and open_:
        unit = spare / sum(w[s] for s in open_)
        spare = 0.0
        for s in open_:
            target[s] += w[s] * unit
            if target[s] > most * sizes[s]:
                spare += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
        open_ = [s for s in open_ if target[s] < most * sizes[s]]
    copies = {}
    for s in order:
        rate = target[s] / sizes[s] if sizes[s] else 0.0
        tries = []
        for k in range(8):
            c = []
            for i, t, src in rows:
                if src == s:
                    h = hashlib.sha256(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest()
                    c.append((i, t, math.floor(rate) + (int(h[8 * k:8 * k + 8], 16) / 2 ** 32 < rate - math.floor(rate))))
            tries.append((abs(sum(size_of(t) * n for _, t, n in c) - target[s]), k, c))
        copies[s] = min(tries, key=lambda x: x[:2])[2]
    return sizes, target, copies


def mix_rows():
    sources = ["b", "a", None, "é", "", "zzz"]
    rows = [(i, t, sources[(k * k) % 5]) for k, (i, t) in enumerate(ROWS)]
    return rows + [(900, "rare few words", "tiny"), (901, None, "empty"), (902, " \t\x0b\x0c\r\n", "empty")]


def test_mixing(spark):
    rows = mix_rows()
    sizes, target, copies = mix_by_hand(rows)
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows],
                               "doc_id long, text string, source string, size string, `t.u` string, copy int").repartition(3)
    sized, sources = mixing.mixture(df)
    found = {r["source"]: r for r in sources.collect()}
    assert {s: r["source_size"] for s, r in found.items()} == dict(sizes)
    assert all(abs(found[s]["target"] - target[s]) < 1e-6 for s in target)
    assert abs(sum(target.values()) - sum(sizes.values())) < 1e-6
    out = mixing.taken(sized, sources)
    exp = Counter((i, size_of(t), s, n) for s, c in copies.items() for i, t, n in c)
    assert Counter((r["doc_id"], r["size"], r["source"], r["copies"]) for r in out.collect()) == exp
    assert max(n for *_, n in exp) <= 3
    emitted = mixing.emit(df, sources)
    assert emitted.columns == ["doc_id", "text", "source", "size", "t.u", "copy"]
    assert Counter((r["doc_id"], r["text"], r["source"], r["copy"]) for r in emitted.collect()) == Counter(
        (i, t, s, k + 1) for s, c in copies.items() for i, t, n in c for k in range(n))


def test_mixing_many_sources_comes_near(spark):
    """More sources than one weight round, one with a third of all rows; the mix comes near and reruns agree."""
    rows = [(i, "w " * (1 + i * 7919 % 90), "hot" if i % 3 == 0 else f"s{i % 40:02d}") for i in range(6000)]
    sizes, target, _ = mix_by_hand(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = [Counter(), Counter()]
    for n, t in zip((2, 7), taken):
        for r in mixing.taken(*mixing.mixture(df.repartition(n))).collect():
            t[r["source"]] += r["copies"] * r["size"]
    assert taken[0] == taken[1]
    for s in target:  # within the spread that a single draw a document would have
        part = target[s] / sizes[s] % 1
        spread = math.sqrt(part * (1 - part) * sum(size_of(x) ** 2 for _, x, src in rows if src == s))
        assert abs(taken[0][s] - target[s]) <= max(spread, 1), s


def test_mixing_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    sized, sources = mixing.mixture(df)
    assert mixing.taken(sized, sources).count() == 0 and mixing.emit(df, sources).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r["copies"] for r in mixing.taken(*mixing.mixture(blank)).collect()] == [0, 0]


def negatives_by_hand(rows, every=50, positives=5, negatives=3):
    ok = [(i, v, lab) for i, v, lab in usable(rows, 2.0 ** 18) if lab is not None]
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v], (lab + 1) % 10 if i is not None and i % 7 == 0 else lab)
          for i, v, lab in ok]

    def order(x):
        return -x[0], x[1] is None, x[1] or 0

    out = Counter()
    for a, va, la in ok:
        if a is None or a % every:
            continue
        scored = [(sum(p * q for p, q in zip(va, v)), i, lab) for i, v, lab in ok]
        pos = sorted((x for x in scored if x[2] == la and x[1] != a), key=order)[:positives]
        neg = sorted((x for x in scored if x[2] != la), key=order)
        for s, p, _ in pos:
            for k, (t, n, _) in enumerate([x for x in neg if 50 * s <= 100 * x[0] <= 95 * s][:negatives]):
                out[a, p, k + 1, n, s, t] += 1
    return out


@pytest.mark.parametrize("block", [16_384, 3])
def test_hard_negatives(spark, block):
    rows = hard_vectors()
    out = hard_negatives.mine(frame(spark, rows), anchors_a_block=block)
    got = Counter(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
                  for r in out.collect())
    assert got == negatives_by_hand(rows) and len(got) > 20


def test_hard_negatives_ties_and_wide_scores(spark):
    """Equal scores everywhere (ids decide), overlapping windows, scores beyond 2^53."""
    rows = [(i, [1.0, 0.0], 3) for i in range(0, 60)] + [(i, [0.75, 0.5], 4) for i in range(100, 140)]
    rows += [(i, [0.5 + (i % 9) / 20, 0.0], i % 3) for i in range(200, 260)]
    rows += [(1000 + i, [200_000.0 - 900 * i, float(i), 1.0], i % 2) for i in range(120)]
    out = hard_negatives.mine(frame(spark, rows))
    got = Counter(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
                  for r in out.collect())
    assert got == negatives_by_hand(rows) and any(k[4] > 2 ** 50 for k in got)


def test_hard_negatives_without_anchors(spark):
    assert hard_negatives.mine(frame(spark, [])).count() == 0
    assert hard_negatives.mine(frame(spark, [(1, [1.0], 1), (50, [1.0], 1)])).count() == 0  # no negative
    assert hard_negatives.mine(frame(spark, [(1, [1.0], 1), (50, [1.0], 2)])).count() == 0  # no positive
    assert hard_negatives.mine(frame(spark, [(1, [], 1), (2, [], 2), (50, [], 2), (100, [], 2)])).count() == 4
