"""Shared intermediates of the reports.

Eleven of the fifteen reports start from the same header-line join, and four
of them from the same per-item sales aggregate. ``Base`` builds these once,
lazily, from the replica; a refresh cycle (``plans.cycle``) materializes the
two aggregates under the shared checkpoint folder, so the join runs once
instead of once per report.

Data contract (see ``schemas``): the header key (tenant_id, DO_Piece, DO_Type)
is unique, as are parties by (tenant_id, CT_Num), items by (tenant_id, AR_Ref)
and tills by (tenant_id, CA_No). The reports use it to join names *after* the
top-N cut, on at most N rows per tenant.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.functions.labels import DEFAULT_ITEM_TEXT, SALES_CREDIT_NOTE, SALES_INVOICE

DOC_KEY = ["tenant_id", "DO_Piece", "DO_Type"]
DOC_COLS = DOC_KEY + ["DO_Date", "DO_Tiers"]
LINE_COLS = ["AR_Ref", "DL_Design", "DL_Qte", "DL_MontantTTC", "DL_PrixUnitaire"]
SALES_TYPES = (SALES_CREDIT_NOTE, SALES_INVOICE)


@dataclass
class Base:
    replica: dict[str, DataFrame]
    materialized: dict[str, DataFrame] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        return self.replica[name]

    # -- documents and lines ------------------------------------------------
    def headers(self) -> DataFrame:
        return self.replica["F_DOCENTETE"].select(*DOC_COLS)

    @property
    def co_partitioned(self) -> bool:
        """Whether headers and lines come from a ledger, where their join moves no rows."""
        return "period" in self.replica["F_DOCLIGNE"].columns

    def line_tables(self) -> list[DataFrame]:
        """The lines, in one table or, with a ledger's hot documents stored apart, in two that share no document."""
        return [self.replica[t] for t in ("F_DOCLIGNE", "HOT_LINES") if t in self.replica]

    def line_facts(self) -> DataFrame:
        """Lines with their header's date and party: the inner header-line join.

        Inner, so AQE may split a skewed document key on either side. Over a ledger's buckets neither side is shuffled.
        """
        if "line_facts" in self.materialized:
            return self.materialized["line_facts"]
        return reduce(DataFrame.unionByName, self._line_facts())

    def _line_facts(self) -> list[DataFrame]:
        if "line_facts" in self.materialized:
            return [self.materialized["line_facts"]]
        return [t.select(*DOC_KEY, *LINE_COLS).join(self.headers(), DOC_KEY, "inner") for t in self.line_tables()]

    def doc_sums(self) -> DataFrame:
        """One row per document that has lines: amount total and line count.

        Grouped by the join key plus header columns, so it reuses the join's
        partitioning and adds no shuffle.
        """
        if "doc_sums" in self.materialized:
            return self.materialized["doc_sums"]
        return reduce(DataFrame.unionByName, (
            facts.groupBy(*DOC_COLS).agg(F.sum("DL_MontantTTC").alias("amount"), F.count(F.lit(1)).alias("n_lines"))
            for facts in self._line_facts()))

    def docs(self, types) -> DataFrame:
        """Documents of ``types`` with lines (the header-line inner join, per document)."""
        return self.doc_sums().where(F.col("DO_Type").isin(list(types)))

    def docs_with_empty(self, types) -> DataFrame:
        """Documents of ``types`` including those without lines (``n_lines`` = 0, amount null)."""
        sums = self.docs(types).select(*DOC_KEY, "amount", "n_lines")
        return (self.headers().where(F.col("DO_Type").isin(list(types)))
                .join(sums, DOC_KEY, "left")
                .withColumn("n_lines", F.coalesce(F.col("n_lines"), F.lit(0))))

    def lines(self, types) -> DataFrame:
        return self.line_facts().where(F.col("DO_Type").isin(list(types)))

    def item_sales(self) -> DataFrame:
        """Sales and credit-note lines per (tenant, item), the null item included.

        Lines are summed per (item, text) first, by hash aggregation map-side, so a hot item ships one row per
        text and task; the largest text is taken over an item's few texts, where sorting costs little.
        """
        if "item_sales" in self.materialized:
            return self.materialized["item_sales"]
        per_text = self.lines(SALES_TYPES).groupBy("tenant_id", "AR_Ref", "DL_Design").agg(
            F.sum("DL_Qte").alias("qty"),
            F.sum("DL_MontantTTC").alias("amount"),
            F.sum("DL_PrixUnitaire").alias("price_sum"),
            F.count("DL_PrixUnitaire").alias("price_n"),
            F.count(F.lit(1)).alias("n_lines"))
        return per_text.groupBy("tenant_id", "AR_Ref").agg(
            F.sum("qty").alias("qty"),
            F.sum("amount").alias("amount"),
            F.max(F.coalesce(F.col("DL_Design"), F.lit(DEFAULT_ITEM_TEXT))).alias("text_or_default"),
            F.max("DL_Design").alias("max_design"),
            F.sum("price_sum").alias("price_sum"),
            F.sum("price_n").alias("price_n"),
            F.sum("n_lines").alias("n_lines"))

    def party_sales(self) -> DataFrame:
        """Per (tenant, customer): sales amount and number of distinct document numbers.

        Two explicit levels (per number, then per customer) keep the distinct count skew-safe: the second one combines map-side.
        """
        if "party_sales" in self.materialized:
            return self.materialized["party_sales"]
        per_piece = self.docs(SALES_TYPES).groupBy("tenant_id", "DO_Tiers", "DO_Piece").agg(F.sum("amount").alias("amount"))
        return per_piece.groupBy("tenant_id", "DO_Tiers").agg(F.sum("amount").alias("amount"), F.count("DO_Piece").alias("n_pieces"))

    # -- payments -------------------------------------------------------------
    def payments(self) -> DataFrame:
        return self.replica["F_CREGLEMENT"]

    def payer_totals(self) -> DataFrame:
        """Per (tenant, payer): payment total and number of payment rows."""
        if "payer_totals" in self.materialized:
            return self.materialized["payer_totals"]
        return (self.payments().groupBy("tenant_id", "CT_NumPayeur")
                .agg(F.sum("RG_Montant").alias("paid"), F.count(F.lit(1)).alias("n_payments")))

    def day_receipts(self) -> DataFrame:
        """Per (tenant, calendar day): payment total (all payment types)."""
        return (self.payments().groupBy("tenant_id", F.to_date("RG_Date").alias("day"))
                .agg(F.sum("RG_Montant").alias("received")))

    # -- dimensions -------------------------------------------------------------
    def party_names(self, key: str = "CT_Num") -> DataFrame:
        return self.replica["F_COMPTET"].select("tenant_id", F.col("CT_Num").alias(key), "CT_Intitule")

    def items(self) -> DataFrame:
        return self.replica["F_ARTICLE"].select("tenant_id", "AR_Ref", "AR_Design", "AR_PrixAch", "FA_CodeFamille")
