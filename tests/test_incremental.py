"""Maintained sums equal a full recompute after any waves of changes; work that was cut off is not seen."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest

from comptoir.plans import incremental as I
from comptoir.plans.base import Base
from comptoir.plans.incremental import MaintainedSums
from comptoir.plans.inspect import scans
from comptoir.schemas import REPLICA_SCHEMAS
from handmade import ROWS, replica

DOC = "tenant_id string, DO_Piece string, DO_Type int"


def rows(df):
    return sorted(tuple("\0" if v is None else f"{v:f}" if isinstance(v, D) else str(v) for v in r) for r in df.collect())


def tables(spark, heads, lines):
    made = {n: spark.createDataFrame(r, REPLICA_SCHEMAS[n]) for n, r in (("F_DOCENTETE", heads), ("F_DOCLIGNE", lines))}
    return replica(spark) | made


def equal(sums, rep):
    base = Base(rep)
    assert rows(sums.doc_sums()) == rows(base.doc_sums())
    mine, exp = sums.item_sales(), base.item_sales()
    cols = sorted(exp.columns)
    assert rows(mine.select(*cols)) == rows(exp.select(*cols))


def random_state(r, n):
    docs = r.sample([(t, f"P{k}", ty) for t in "AB" for k in range(8) for ty in (6, 7, 17)], n)
    heads = [(*d, r.choice([None, dt.datetime(2024, 1, r.randint(1, 9))]), r.choice([None, "C1", "C2"])) for d in docs]
    maybe = lambda v: r.choice([None, v, v])
    lines = [(*d, r.choice([None, "I1", "I2", "I3"]), r.choice([None, "x", "y", "z"]), maybe(D(r.randint(-3, 9))),
              maybe(D(r.randint(-90, 900)) / 100), maybe(D(r.randint(0, 50)))) for d in docs for _ in range(r.randint(0, 4))]
    return heads, lines


def changed_documents(spark, old, new):
    """Keys of documents whose header or lines differ, some named twice, one that never was."""
    def by_doc(state):
        out = {}
        for part in state:
            for x in part:
                out.setdefault(tuple(x[:3]), []).append(str(x))
        return {k: sorted(v) for k, v in out.items()}
    a, b = by_doc(old), by_doc(new)
    keys = [k for k in a.keys() | b.keys() if a.get(k) != b.get(k)]
    return spark.createDataFrame([*keys, *keys[:3], ("Z", "none", 7)], DOC)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_waves_equal_a_recompute(spark, scratch, seed):
    r = random.Random(seed)
    sums, state = MaintainedSums(spark, f"{scratch}/s", slots=4), random_state(r, 20)
    assert sums.apply(tables(spark, *state), None, 0)
    equal(sums, tables(spark, *state))
    for wave in (1, 2, 3):
        heads, lines = random_state(r, 12)
        keep = {tuple(x[:3]) for x in state[0][:8]} - {tuple(x[:3]) for x in heads}  # some stay as they are
        new = (heads + [x for x in state[0] if tuple(x[:3]) in keep], lines + [x for x in state[1] if tuple(x[:3]) in keep])
        assert sums.apply(tables(spark, *new), changed_documents(spark, state, new), wave)
        state = new
        if wave == 2:
            sums.compact()
    equal(sums, tables(spark, *state))
    assert sums.last_wave() == 3 and sums.commits().count() == 2  # since the compaction


def test_a_wave_counts_once_and_one_that_was_cut_off_not_at_all(spark, scratch, monkeypatch):
    sums, rep = MaintainedSums(spark, f"{scratch}/s", slots=2), replica(spark)
    heads, lines = ROWS["F_DOCENTETE"], ROWS["F_DOCLIGNE"]
    assert sums.doc_sums().count() == sums.item_sales().count() == 0  # nothing stored yet
    sums.apply(rep, None, 5)
    assert not sums.apply(rep, None, 5) and not sums.apply(tables(spark, heads[:1], lines[:1]), None, 4)
    equal(sums, rep)
    new = tables(spark, heads[2:], lines[1:])
    keys = spark.createDataFrame([h[:3] for h in heads], DOC)
    with monkeypatch.context() as m:
        m.setattr(MaintainedSums, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sums.apply(new, keys, 6)
    equal(sums, rep)  # its rows lie there, but no commit names them
    assert sums.apply(new, keys, 6)
    equal(sums, new)
    sums.apply(tables(spark, [], []), keys, 7)  # everything deleted
    assert sums.doc_sums().count() == sums.item_sales().count() == 0


def test_old_contributions_are_found_in_their_slots(spark, scratch):
    sums = MaintainedSums(spark, f"{scratch}/s", slots=8)
    sums.apply(replica(spark), None, 0)
    commits = sums.commits()
    few = spark.createDataFrame([("A", "P1", 7)], DOC).withColumn("slot", I._slot(8))
    found = sums._in_slots(sums._current("docs", commits), few)
    docs = next(d for d in scans(found) if "docs" in d["Location"])
    assert "slot" in docs["PartitionFilters"] and found.join(few, I.DOC_KEY, "left_semi").count() == 1
