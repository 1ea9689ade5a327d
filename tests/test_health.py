"""Health, backoff schedule, heartbeat merge, registry upsert and module gate on hand-made rows."""

import datetime as dt
import random

import pytest

from comptoir.operators.gate import gated, module_gate
from comptoir.operators.health import merge_heartbeat, retry_schedule, sync_health
from comptoir.operators.registry import upsert_registry
from comptoir.schemas import CYCLES_SCHEMA, REGISTRY_SCHEMA, RUN_LOG_SCHEMA

T = dt.datetime(2024, 1, 1)


def at(m):
    return T + dt.timedelta(minutes=m)


def test_sync_health_statuses(spark):
    log = [("A", 1, m, None, 10, at(1)) for m in range(3)]
    log += [("A", 2, m, ("e" * 150) if m < 7 else None, 5, at(2)) for m in range(15)]
    log += [("A", 3, 0, "ignored", 1, at(3))]
    cycles = [("A", 1, None), ("A", 2, None), ("A", 3, "boom " + "z" * 600)]
    h = {r.cycle_no: r for r in sync_health(spark.createDataFrame(log, RUN_LOG_SCHEMA),
                                            spark.createDataFrame(cycles, CYCLES_SCHEMA)).collect()}
    assert (h[1].status, h[1].last_sync_error, h[1].duration_ms) == ("active", None, 30)
    assert h[2].status == "degraded" and h[2].duration_ms == 75
    expected = "; ".join(f"{k}: {'e' * 150}" for k in ["sales", "achats", "caisse", "stock", "top_articles"])[:500]
    assert h[2].last_sync_error == expected and len(expected) == 500
    assert h[3].status == "error" and h[3].duration_ms is None and len(h[3].last_sync_error) == 500


def reference_waits(statuses, interval=60, after=5, cap=900):
    """The source system's loop, replayed: streak and wait after each cycle."""
    out, n = [], 0
    for s in statuses:
        if s != "error":
            n, wait = 0, interval
        else:
            n += 1
            wait = min(interval * 2 ** (n - after + 1), cap) if n >= after else interval
        out.append((n, wait))
    return out


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_retry_schedule_matches_loop(spark, block):
    rnd = random.Random(block)
    rows, expected = [], {}
    for tenant in ["A", "B", "C"]:
        cycles = sorted(rnd.sample(range(200), 120))  # gaps in cycle numbers
        statuses = [rnd.choice(["error"] * 4 + ["active", "degraded"]) for _ in cycles]
        if tenant == "C":
            statuses = ["error"] * len(cycles)  # never succeeds: streak spans every block
        for c, s, w in zip(cycles, statuses, reference_waits(statuses)):
            rows.append((tenant, c, s))
            expected[(tenant, c)] = w
    h = spark.createDataFrame(rows, "tenant_id string, cycle_no bigint, status string")
    got = {(r.tenant_id, r.cycle_no): (r.streak, r.wait_s) for r in retry_schedule(h, block=block).collect()}
    assert got == expected


def test_backoff_values():
    assert [w for _, w in reference_waits(["error"] * 9)] == [60, 60, 60, 60, 120, 240, 480, 900, 900]


def test_merge_heartbeat_update_only(spark):
    reg = spark.createDataFrame([("A", "hw1", "active", T, 100, "old"), ("B", "hw2", "active", T, 200, None)],
                                REGISTRY_SCHEMA)
    health = spark.createDataFrame(
        [("A", 1, "active", None, 300, at(1)), ("A", 2, "error", "down", None, at(2)),
         ("Z", 1, "active", None, 5, at(1))],
        "tenant_id string, cycle_no bigint, status string, last_sync_error string, duration_ms int, "
        "reported_at timestamp_ntz")
    got = {r.tenant_id: r for r in merge_heartbeat(reg, health).collect()}
    assert set(got) == {"A", "B"}  # unknown tenant Z stays absent
    assert (got["A"].status, got["A"].last_sync_error, got["A"].last_sync_duration_ms) == ("error", "down", 100)
    assert got["A"].updated_at == at(2)
    assert got["B"].asDict() == reg.where("tenant_id = 'B'").collect()[0].asDict()


def test_registry_upsert(spark):
    reg = spark.createDataFrame([("A", "hw1", "active", T, 100, "err")], REGISTRY_SCHEMA)
    upd = spark.createDataFrame([("A", "hw9", "active", at(5)), ("A", "hw8", "active", at(1)),
                                 ("D", None, "active", at(2))],
                                "tenant_id string, hw_id string, status string, updated_at timestamp_ntz")
    got = {r.tenant_id: r for r in upsert_registry(reg, upd).collect()}
    assert (got["A"].hw_id, got["A"].updated_at, got["A"].last_sync_duration_ms, got["A"].last_sync_error) == \
        ("hw9", at(5), 100, "err")
    assert got["D"].hw_id is None and got["D"].last_sync_duration_ms is None and got["D"].status == "active"


def test_module_gate(spark):
    tenants = spark.createDataFrame([("A",), ("B",), ("C",)], "tenant_id string")
    settings = spark.createDataFrame(
        [("A", "sales", True), ("B", "sales", False), ("C", "caisse", None),
         ("A", "stock", True), ("A", "stock", False)],
        "tenant_id string, module_key string, is_enabled boolean")
    g = {(r.tenant_id, r.module_key): r.enabled for r in module_gate(tenants, settings).collect()}
    assert len(g) == 45
    assert g[("A", "sales")] and not g[("B", "sales")] and not g[("C", "caisse")]
    assert not g[("A", "stock")] and g[("B", "stock")] and g[("C", "sales")]
    rows = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "tenant_id string, x int")
    assert sorted(r.tenant_id for r in gated(rows, module_gate(tenants, settings), "sales").collect()) == ["A", "C"]


def test_registry_storage_replaces_only_written_tenants(spark, scratch):
    from comptoir.operators.registry import read_registry, write_registry

    reg = spark.createDataFrame([("A", "hw1", "active", T, 100, None), ("B", "hw2", "active", T, 200, "e")],
                                REGISTRY_SCHEMA)
    write_registry(reg, scratch)
    upd = spark.createDataFrame([("C", "hw3", "active", at(1))],
                                "tenant_id string, hw_id string, status string, updated_at timestamp_ntz")
    new_rows = upsert_registry(read_registry(spark, scratch), upd).where("tenant_id = 'C'").checkpoint()
    write_registry(new_rows, scratch)
    got = {r.tenant_id: r for r in read_registry(spark, scratch).collect()}
    assert set(got) == {"A", "B", "C"}
    assert got["B"].last_sync_error == "e" and got["C"].hw_id == "hw3" and got["C"].last_sync_duration_ms is None
