"""DuckDB oracle: each query is plain SQL over the test parquet views.

``shared.sql`` holds the relations that several reports are written over
(document lines, document totals, payments by payer...), ``views.sql`` the
fixture views; both are CTEs put before every query. Items are joined line
by line and the line x payment product is built in full, so that the SQL
checks the Spark operators' rewrites rather than repeats them.
"""

from __future__ import annotations

from pathlib import Path

HERE = Path(__file__).parent


# Queries that give a report's rows in another way.
SAME_ROWS = {"latest_sales": "sales", "latest_mouvements": "mouvements", "latest_impayees": "impayees",
             "maintained_top_clients": "maintained_clients"}
REPORT_KEYS = ["sales", "achats", "caisse", "stock", "top_articles", "top_clients", "evolution_ca", "rotation", "mode_reglement",
               "marge_brute", "mouvements", "dernieres_transac", "ca_famille", "impayees", "solde_client"]


def names() -> list[str]:
    return sorted([*(p.stem for p in HERE.glob("*.sql") if p.stem not in ("views", "shared")), *SAME_ROWS, "refresh_cycle", "published_cycle"])


# Decimal output columns, published as exact text (as in the snapshot JSON).
DECIMAL_COLUMNS: dict[str, list[str]] = {
    "sales": ["MONTANT_TTC"],
    "achats": ["MONTANT_TTC"],
    "caisse": ["ENTREE_CAISSE", "SORTIE_CAISSE"],
    "stock": ["QuantiteStock", "MontantStock"],
    "top_articles": ["QuantiteVendue", "MontantVendu"],
    "top_clients": ["CA_Total"],
    "evolution_ca": ["CA_Jour", "Encaisse_Jour"],
    "rotation": ["QuantiteVendue", "PrixMoyen"],
    "marge_brute": ["PrixVenteMoyen", "PrixAchatMoyen", "MargeUnitaire"],
    "mode_reglement": ["TotalRegle"],
    "mouvements": ["Quantite", "Montant"],
    "dernieres_transac": ["Montant"],
    "ca_famille": ["CA_Famille"],
    "impayees": ["MontantFacture", "MontantRegle", "Solde"],
    "solde_client": ["TotalFacture", "TotalRegle", "Solde"],
    "ledger_sums": ["amount"],
    "row_changes": ["RG_Montant"],
    "maintained_items": ["qty", "amount", "price_sum"],
    "maintained_clients": ["CA_Total"],
}


def shared_sql() -> str:
    return (HERE / "shared.sql").read_text().strip()


def report_sql(name: str) -> str:
    """The query with typed decimals, without the shared relations before it."""
    if name == "refresh_cycle":
        return _cycle_sql()
    if name == "published_cycle":
        return f"SELECT tenant_id, module_key, n_rows FROM ({_cycle_sql()}) AS cycle"
    return (HERE / f"{SAME_ROWS.get(name, name)}.sql").read_text().strip().rstrip(";")


def _cycle_sql() -> str:
    """Rows of each report and tenant whose switch is on, after two cycles of which the first knew T0 and T1 only."""
    counts = " UNION ALL ".join(f"SELECT tenant_id, '{key}' AS module_key, COUNT(*) AS n_rows FROM (\n{report_sql(key)}\n) AS r "
                                "GROUP BY tenant_id" for key in REPORT_KEYS)
    return (f"SELECT tenant_id, module_key, n_rows, CASE WHEN tenant_id = 'T2' THEN 1 ELSE 2 END AS n_cycles FROM ({counts}) AS c "
            "WHERE NOT EXISTS (SELECT 1 FROM SETTINGS s WHERE s.tenant_id = c.tenant_id AND s.module_key = c.module_key "
            "AND NOT coalesce(s.is_enabled, FALSE))")


def published_sql(name: str) -> str:
    """The query in published form: decimals as exact text."""
    body = report_sql(name)
    dec = DECIMAL_COLUMNS.get(SAME_ROWS.get(name, name))
    if dec:
        casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in dec)
        body = f"SELECT * REPLACE ({casts}) FROM (\n{body}\n)"
    return body


def body_sql(name: str) -> str:
    """The published query over tables named like the replica (no fixture views)."""
    return f"WITH {shared_sql()}\n{published_sql(name)}"


def sql(name: str) -> str:
    views = (HERE / "views.sql").read_text().strip()
    return f"WITH {views},\n{shared_sql()}\n{published_sql(name)}"


def all_sql() -> dict[str, str]:
    return {n: sql(n) for n in names()}
