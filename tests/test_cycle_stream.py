"""A refresh cycle end to end, and the streaming refresh compared with the batch reports."""

import datetime as dt

from comptoir.functions.labels import MODULE_KEYS, TARGET_TABLE
from comptoir.operators.reports import REPORTS, report
from comptoir.plans.base import Base
from comptoir.operators.registry import read_registry, write_registry
from comptoir.plans.cycle import read_run_log, refresh_cycle
from comptoir.schemas import REGISTRY_SCHEMA
from comptoir.sources.fixtures import replica_from_testdata, settings_fixture
from comptoir.sources.replica import check_keys, load_replica, write_replica
from comptoir.streaming.refresh import CHANGES_SCHEMA, refresh_stream
from helpers import SF_SMALL
from handmade import replica


def test_refresh_cycle(spark, scratch):
    rep_path, out, reg_path = f"{scratch}/replica", f"{scratch}/out", f"{scratch}/registry"
    write_replica(replica(spark), rep_path)
    write_registry(spark.createDataFrame([("A", "hw", "active", dt.datetime(2024, 1, 1), 5, "old"),
                                          ("Z", "hz", "active", dt.datetime(2024, 1, 1), 7, "keep")],
                                         REGISTRY_SCHEMA), reg_path)
    settings = spark.createDataFrame([("B", "sales", False)], "tenant_id string, module_key string, is_enabled boolean")
    res = refresh_cycle(spark, load_replica(spark, rep_path), out, 7, settings, registry_path=reg_path)
    assert res.cycle_error is None and [o[0] for o in res.outcomes] == MODULE_KEYS
    assert all(o[2] is None for o in res.outcomes)
    sales = spark.read.parquet(f"{out}/{TARGET_TABLE['sales']}/payload")
    assert [r.tenant_id for r in sales.collect()] == ["A"]  # sales is off for B
    log, cycles = read_run_log(spark, out)
    assert log.count() == 15 + 14 and cycles.count() == 2
    reg = {r.tenant_id: r for r in read_registry(spark, reg_path).collect()}
    assert set(reg) == {"A", "Z"}  # B has no registry row: a heartbeat is an update, not an insert
    assert reg["A"].status == "active" and reg["A"].last_sync_error is None
    assert reg["Z"].last_sync_error == "keep"  # a tenant outside the cycle is not rewritten


def test_stream_equals_batch(spark, scratch):
    rep_path, out, changes = f"{scratch}/replica", f"{scratch}/out", f"{scratch}/changes"
    fixture = replica_from_testdata(spark, SF_SMALL)
    assert check_keys(fixture).count() == 0
    write_replica(fixture, rep_path)
    settings = settings_fixture(spark)
    now = dt.datetime(2024, 1, 1)

    def land(tenants, n):
        spark.createDataFrame([(t, "F_DOCLIGNE", now) for t in tenants], CHANGES_SCHEMA) \
            .write.mode("append").parquet(changes)

    ckpt = f"{scratch}/ckpt"
    land(["T0", "T1"], 1)
    q = refresh_stream(spark, changes, rep_path, out, settings, available_now=True, checkpoint=ckpt)
    q.awaitTermination()
    assert spark.read.parquet(f"{out}/{TARGET_TABLE['stock']}/rows").select("tenant_id").distinct().count() == 2
    land(["T2"], 2)
    q = refresh_stream(spark, changes, rep_path, out, settings, available_now=True, checkpoint=ckpt)
    q.awaitTermination()

    base = Base(load_replica(spark, rep_path))
    for key in REPORTS:
        got = spark.read.parquet(f"{out}/{TARGET_TABLE[key]}/rows")
        exp = report(key, base)
        if key == "sales":  # off for T1; T2's stored NULL switch only affects 'caisse'
            exp = exp.where("tenant_id <> 'T1'")
        if key == "caisse":
            exp = exp.where("tenant_id <> 'T2'")
        cols = exp.columns
        assert got.select(*cols).exceptAll(exp).count() == 0, key
        assert exp.exceptAll(got.select(*cols)).count() == 0, key
    log, cycles = read_run_log(spark, out)
    assert sorted(r.cycle_no for r in cycles.select("cycle_no").distinct().collect()) == [0, 1]


def test_cycle_refuses_a_replica_that_breaks_the_key_contract(spark, scratch):
    from handmade import ROWS
    rows = dict(ROWS)
    rows["F_COMPTET"] = ROWS["F_COMPTET"] + [("A", "C1", "Alpha bis")]
    settings = spark.createDataFrame([], "tenant_id string, module_key string, is_enabled boolean")
    res = refresh_cycle(spark, replica(spark, rows), f"{scratch}/out", 3, settings, check_contract=True)
    assert res.outcomes == [] and "F_COMPTET" in res.cycle_error
    log, cycles = read_run_log(spark, f"{scratch}/out")
    assert {r.cycle_error for r in cycles.collect()} == {res.cycle_error}


def test_cycles_reuse_two_base_slots(spark, scratch):
    import glob
    from comptoir.plans.cycle import base_slot

    settings = spark.createDataFrame([], "tenant_id string, module_key string, is_enabled boolean")
    rep = replica(spark)
    for cycle_no in range(3):
        res = refresh_cycle(spark, rep, f"{scratch}/out", cycle_no, settings, parallel_reports=8)
        assert res.cycle_error is None and all(o[2] is None for o in res.outcomes)
    slots = glob.glob(base_slot(spark, f"{scratch}/out", 0).rsplit("/", 1)[0] + "/*")
    assert sorted(p.rsplit("/", 1)[1] for p in slots) == ["slot-0", "slot-1"]


def test_run_log_reads_prune_to_one_day(spark, scratch):
    from comptoir.plans.inspect import scans

    settings = spark.createDataFrame([], "tenant_id string, module_key string, is_enabled boolean")
    refresh_cycle(spark, replica(spark), f"{scratch}/out", 0, settings, modules=["stock"])
    log, cycles = read_run_log(spark, f"{scratch}/out", day=dt.date.today())
    assert log.count() == 2 and cycles.count() == 2
    assert {r.module_no for r in log.collect()} == {MODULE_KEYS.index("stock")}
    for df in (log, cycles):
        assert all("day" in d.get("PartitionFilters", "") for d in scans(df))


def test_compact_run_log_keeps_rows_and_cuts_files(spark, scratch):
    import glob
    from comptoir.plans.cycle import compact_run_log

    settings = spark.createDataFrame([], "tenant_id string, module_key string, is_enabled boolean")
    for cycle_no in range(3):
        refresh_cycle(spark, replica(spark), f"{scratch}/out", cycle_no, settings, modules=["stock", "caisse"])
    today = dt.date.today()
    before = sorted(tuple(r) for r in read_run_log(spark, f"{scratch}/out", day=today)[0].collect())
    compact_run_log(spark, f"{scratch}/out", today, files_per_day=1)
    after = sorted(tuple(r) for r in read_run_log(spark, f"{scratch}/out", day=today)[0].collect())
    assert after == before and len(before) == 3 * 2 * 2
    files = glob.glob(f"{scratch}/out/_refresh/run_log/day={today}/*.parquet")
    assert len(files) == 1


def test_stream_one_file_per_batch(spark, scratch):
    rep_path, out, changes = f"{scratch}/replica", f"{scratch}/out", f"{scratch}/changes"
    write_replica(replica(spark), rep_path)
    settings = spark.createDataFrame([], "tenant_id string, module_key string, is_enabled boolean")
    for tenant in ("A", "B"):
        spark.createDataFrame([(tenant, "F_DOCLIGNE", dt.datetime(2024, 1, 1))], CHANGES_SCHEMA) \
            .coalesce(1).write.mode("append").parquet(changes)
    q = refresh_stream(spark, changes, rep_path, out, settings, available_now=True,
                       checkpoint=f"{scratch}/ckpt", modules=["stock"], max_files_per_trigger=1)
    q.awaitTermination()
    log, cycles = read_run_log(spark, out)
    assert sorted((r.cycle_no, r.tenant_id) for r in cycles.collect()) == [(0, "A"), (1, "B")]


def test_runs_are_told_apart_by_their_id_not_their_number(spark, scratch):
    """Two runs in one second, a number used twice, and a stream whose new checkpoint numbers its batches from 0 again."""
    from comptoir.operators.health import merge_heartbeat, retry_schedule, sync_health
    from comptoir.operators.registry import read_registry, write_registry

    settings = spark.createDataFrame([], "tenant_id string, module_key string, is_enabled boolean")
    out, rep_path, changes = f"{scratch}/out", f"{scratch}/replica", f"{scratch}/changes"
    rep = replica(spark)
    write_replica(rep, rep_path)

    def fails():
        raise OSError("not reachable")

    only = spark.createDataFrame([("A",)], "tenant_id string")
    one = dict(modules=["caisse"], tenants=only)
    refresh_cycle(spark, fails, out, 12, settings, **one)  # an error ...
    refresh_cycle(spark, fails, out, 12, settings, **one)  # ... that is run again under its number
    for _ in range(2):  # two runs that both would be number 9
        refresh_cycle(spark, fails, out, 9, settings, run_id=f"r{_}", **one)
    spark.createDataFrame([("A", "F_CREGLEMENT", dt.datetime(2024, 1, 1))], CHANGES_SCHEMA).write.parquet(changes)
    for ckpt in ("c1", "c2"):
        refresh_stream(spark, changes, rep_path, out, settings, available_now=True, checkpoint=f"{scratch}/{ckpt}",
                       modules=["caisse"]).awaitTermination()
    log, cycles = read_run_log(spark, out)
    assert sorted(r.cycle_no for r in cycles.collect()) == [0, 0, 9, 9, 12]
    assert cycles.select("run_id").distinct().count() == 5 and log.count() == 2
    health = sync_health(log, cycles)
    got = [(r.cycle_no, r.status, r.streak) for r in retry_schedule(health).join(
        cycles.select("run_id", "started_at"), "run_id").orderBy("started_at").collect()]
    assert got == [(12, "error", 1), (9, "error", 2), (9, "error", 3), (0, "active", 0), (0, "active", 0)]
    write_registry(spark.createDataFrame([("A", "hw", "error", dt.datetime(2024, 1, 1), 5, "old")], REGISTRY_SCHEMA), f"{scratch}/reg")
    assert merge_heartbeat(read_registry(spark, f"{scratch}/reg"), health).first().status == "active"
