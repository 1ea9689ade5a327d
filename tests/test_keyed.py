"""Tables kept from change rows: any cut of a random stream equals the latest rows, slots, lost waves, rows without key."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.schemas import REPLICA_SCHEMAS
from comptoir.sources.keyed import CHANGE, KEYS, KeyedTable, split_keyed

TABLE = "F_CAISSE"  # tenant_id, CA_No, CA_Intitule
SCHEMA = T.StructType([T.StructField(f.name, f.dataType) for f in [*REPLICA_SCHEMAS[TABLE], *CHANGE]])


def rows_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def expected(rows):
    """The latest row of each key; sequence numbers differ within a key but for exact repeats and deletions."""
    best = {}
    for tenant, no, text, seq, deleted in rows:
        if (tenant, no) not in best or (seq, deleted) > best[tenant, no][:2]:
            best[tenant, no] = (seq, deleted, text)
    return sorted((t, n, x[2]) for (t, n), x in best.items() if not x[1])


def stored(table):
    return sorted((r.tenant_id, r.CA_No, r.CA_Intitule) for r in table.rows().collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_any_cut_of_a_random_stream_equals_the_latest_rows(spark, scratch, seed):
    rng = random.Random(seed)
    stream = [(rng.choice(["A", "A", "A", "B", "C/d e"]), rng.randrange(30), rng.choice([None, "", "x", "y"]), seq, rng.random() < .3)
              for seq in range(150)]
    stream += rng.sample(stream, 20)
    rng.shuffle(stream)
    table, done = KeyedTable.of_replica(spark, scratch, TABLE, slot_rows=4), []
    for n in (90, 50, 30):
        wave, stream = stream[:n], stream[n:]
        table.apply(rows_of(spark, wave))
        done += wave
        assert stored(table) == expected(done)
    assert not stream
    slots = {r.tenant_id: r for r in table.slots().groupBy("tenant_id").agg(F.max("slots").alias("n"), F.max("n_rows").alias("most")).collect()}
    assert slots["A"].n > slots["B"].n >= 1
    # A repeated wave changes nothing, and what is only late neither.
    table.apply(rows_of(spark, done))
    assert stored(table) == expected(done)


def test_a_wave_writes_only_the_slots_of_its_keys(spark, scratch):
    table = KeyedTable.of_replica(spark, scratch, TABLE, slot_rows=8)
    first = table.apply(rows_of(spark, [(t, i, "a", 1, False) for t in "AB" for i in range(64)]))
    second = table.apply(rows_of(spark, [("A", 5, "b", 2, False), ("A", 6, "late", 0, False)]))
    slots = table.slots().collect()
    assert len(slots) == 16 and sum(r.version == second for r in slots) <= 2 and {r.version for r in slots} == {first, second}
    assert all(r.version == first for r in slots if r.tenant_id == "B")
    assert dict((n, x) for t, n, x in stored(table) if t == "A") == {i: "b" if i == 5 else "a" for i in range(64)}
    # The scan of a wave's slots is a filter on folders.
    plan = table._rows_of(table.slots().where("slot = 0"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_a_tenant_that_outgrows_its_slots_gets_more(spark, scratch):
    table = KeyedTable.of_replica(spark, scratch, TABLE, slot_rows=10)
    table.apply(rows_of(spark, [("A", i, "a", 1, False) for i in range(10)] + [("B", 1, "b", 1, False)]))
    assert {r.tenant_id: r.slots for r in table.slots().collect()} == {"A": 1, "B": 1}
    table.apply(rows_of(spark, [("A", i, "c", 2, i == 3) for i in range(3, 100)]))
    now = table.slots().collect()
    assert sorted(r.slot for r in now if r.tenant_id == "A") == list(range(16)) and sum(r.n_rows for r in now) == 101
    assert stored(table) == sorted([("A", i, "a" if i < 3 else "c") for i in range(100) if i != 3] + [("B", 1, "b")])


def test_a_wave_cut_off_before_its_commit_is_not_seen(spark, scratch, monkeypatch):
    table = KeyedTable.of_replica(spark, scratch, TABLE)
    table.apply(rows_of(spark, [("A", 1, "a", 1, False), ("A", 2, "a", 1, False)]))
    wave = rows_of(spark, [("A", 1, "b", 2, False), ("A", 2, None, 2, True), ("A", 3, "c", 2, False)])
    with monkeypatch.context() as m:
        m.setattr(table, "_read", lambda folder, schema, read=table._read, seen=[]: seen.append(folder) or (
            (_ for _ in ()).throw(RuntimeError("lost")) if seen.count("commits") > 1 else read(folder, schema)))
        with pytest.raises(RuntimeError, match="lost"):
            table.apply(wave)
    assert stored(table) == [("A", 1, "a"), ("A", 2, "a")]
    table.apply(wave)
    assert stored(table) == [("A", 1, "b"), ("A", 3, "c")]


def test_forgotten_tombstones(spark, scratch):
    table = KeyedTable.of_replica(spark, scratch, TABLE, slot_rows=2)
    table.apply(rows_of(spark, [("A", i, "a", i, i % 2 == 1) for i in range(8)] + [("B", 9, None, 9, True)]))
    assert table.slots().agg(F.sum("n_rows")).first()[0] == 9
    table.forget(6)
    assert table.slots().agg(F.sum("n_rows")).first()[0] == 6
    assert stored(table) == [("A", i, "a") for i in (0, 2, 4, 6)]
    assert table.forget(6) is None
    # With the tombstone the late row loses, without it nothing is known of the key.
    table.apply(rows_of(spark, [("A", 7, "late", 2, False), ("A", 1, "again", 0, False)]))
    assert stored(table) == [("A", 0, "a"), ("A", 1, "again"), *(("A", i, "a") for i in (2, 4, 6))]


def test_empty_waves_and_rows_without_key(spark, scratch):
    table = KeyedTable.of_replica(spark, scratch, TABLE)
    assert stored(table) == [] and table.apply(rows_of(spark, [])) is None and stored(table) == []
    rows = rows_of(spark, [("A", 1, None, 1, None), (None, 2, "x", 1, False), ("", 2, "x", 1, False), ("A", None, "x", 1, False),
                           ("A", 4, "x", None, True)])
    keyed, unkeyed = split_keyed(rows, KEYS[TABLE])
    assert sorted(r.rejected_columns for r in unkeyed.collect()) == ["CA_No", "change_seq", "tenant_id", "tenant_id"]
    with pytest.raises(ValueError, match="without tenant"):
        table.apply(rows)
    table.apply(keyed)
    assert stored(table) == [("A", 1, None)]
