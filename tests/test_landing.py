"""Landing: complete deliveries, change rows, rejected rows, repeats, lines; splits of skewed keys."""

import pytest
from pyspark.sql import functions as F

from comptoir.operators.reports import REPORTS, report
from comptoir.plans.base import Base
from comptoir.sources.landing import key_splits, land, open_landed, rejected, split_predicates
from helpers import spark_rows
from handmade import replica

TABLE, COLUMNS = "F_CAISSE", "tenant_id string, CA_No string, CA_Intitule string"


def tills(spark, root):
    return sorted((r.tenant_id, r.CA_No, r.CA_Intitule) for r in open_landed_table(spark, root).collect())


def open_landed_table(spark, root):
    from comptoir.sources.keyed import KeyedTable

    return KeyedTable.of_replica(spark, root, TABLE).rows()


def test_complete_deliveries(spark, scratch):
    first = [("A", "1", "one"), ("A", "2", "two"), ("A", "x", "no number"), ("A", None, "none"), ("B", "1", "b")]
    land(spark, spark.createDataFrame(first, COLUMNS), TABLE, scratch, 1, complete=True)
    assert tills(spark, scratch) == [("A", 1, "one"), ("A", 2, "two"), ("B", 1, "b")]
    # A lost 2; B is not delivered and keeps its rows.
    second = spark.createDataFrame([("A", "1", "ONE"), ("A", "3", "three")], COLUMNS)
    for _ in range(2):  # a repeated landing changes nothing
        land(spark, second, TABLE, scratch, 2, complete=True)
        assert tills(spark, scratch) == [("A", 1, "ONE"), ("A", 3, "three"), ("B", 1, "b")]
    # An older landing that comes late changes nothing either, and 2 is not back.
    land(spark, spark.createDataFrame(first, COLUMNS), TABLE, scratch, 1)
    assert tills(spark, scratch) == [("A", 1, "ONE"), ("A", 3, "three"), ("B", 1, "b")]
    bad = rejected(spark, scratch, TABLE).collect()
    assert sorted((r.landing, r.CA_No, r.rejected_columns) for r in bad if r.CA_No) == [(1, "x", "CA_No")]
    assert [(r.CA_Intitule, r.rejected_columns) for r in bad if not r.CA_No] == [("none", "CA_No")]
    land(spark, spark.createDataFrame([], COLUMNS), TABLE, scratch, 3, complete=True)
    assert tills(spark, scratch) == [("A", 1, "ONE"), ("A", 3, "three"), ("B", 1, "b")]


def test_a_rejected_row_does_not_delete_its_predecessor(spark, scratch):
    columns = "tenant_id string, RG_No string, RG_Date string, CT_NumPayeur string, RG_Libelle string, RG_Type string, " \
              "RG_Montant string, N_Reglement string, CA_No string"
    row = ("A", "7", "2024-01-02 10:00:00", None, "pay", "1", "12.35", None, None)
    land(spark, spark.createDataFrame([row], columns), "F_CREGLEMENT", scratch, 1, complete=True)
    broken = (*row[:6], "12.345", *row[7:])
    land(spark, spark.createDataFrame([broken], columns), "F_CREGLEMENT", scratch, 2, complete=True)
    assert [str(r.RG_Montant) for r in open_landed_rows(spark, scratch, "F_CREGLEMENT")] == ["12.35"]
    assert [r.RG_Montant for r in rejected(spark, scratch, "F_CREGLEMENT").collect()] == ["12.345"]


def open_landed_rows(spark, root, table):
    from comptoir.sources.keyed import KeyedTable

    return KeyedTable.of_replica(spark, root, table).rows().collect()


def test_change_rows_with_their_own_numbers(spark, scratch):
    columns = COLUMNS + ", change_seq string, deleted boolean, note string"
    rows = [("A", "1", "one", "5", False, "n"), ("A", "1", "late", "4", None, "n"), ("A", "2", "two", None, False, "n"), ("A", "3", "x", "1", False, "n"),
            ("A", "3", None, "2", True, "n")]
    land(spark, spark.createDataFrame(rows, columns), TABLE, scratch, 1)
    assert tills(spark, scratch) == [("A", 1, "one"), ("A", 2, "two")]


def test_reports_over_a_landed_replica(spark, scratch):
    rep = replica(spark)
    for table, rows in rep.items():
        land(spark, rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns)), table, scratch, 1, complete=True)
    landed = open_landed(spark, scratch)
    for table, rows in rep.items():
        assert [(f.name, f.dataType) for f in landed[table].schema] == [(f.name, f.dataType) for f in rows.schema]
        assert landed[table].exceptAll(rows).isEmpty() and rows.exceptAll(landed[table]).isEmpty(), table
    for key in ("top_articles", "impayees", "stock"):
        assert key in REPORTS and spark_rows(report(key, Base(landed))) == spark_rows(report(key, Base(rep)))
    only = open_landed(spark, scratch, spark.createDataFrame([("B",)], "tenant_id string"))
    assert {r.tenant_id for df in only.values() for r in df.select("tenant_id").distinct().collect()} <= {"B"}


@pytest.mark.parametrize("n", [1, 7, 16])
def test_splits_of_skewed_keys_hold_about_as_many_rows(spark, n):
    # Keys crowd near zero: an even cut of their range would put nearly all into the first split.
    rows = spark.range(40_000).selectExpr("IF(id % 4 = 0, 'B', 'A') AS tenant_id", "CAST(POW(id / 40000, 6) * 1e12 AS BIGINT) * 40000 + id AS k")
    rows = rows.unionByName(spark.createDataFrame([("A", None)], "tenant_id string, k bigint"))
    found = {r.tenant_id: r.bounds for r in key_splits(rows, "k", n).collect()}
    for tenant, total in (("A", 30_001), ("B", 10_000)):
        mine = rows.where(F.col("tenant_id") == tenant)
        sizes = [mine.where(p).count() for p in split_predicates("k", found[tenant])]
        assert len(sizes) == n and sum(sizes) == total and max(sizes) <= 1.5 * total / n


def test_a_table_without_key_is_landed_complete(spark, scratch):
    with pytest.raises(ValueError, match="no key"):
        land(spark, replica(spark)["F_DOCLIGNE"], "F_DOCLIGNE", scratch, 1)
