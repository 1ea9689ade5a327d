"""Labels, fallback names and date formats of the reports.

Built from ``F.when`` chains and ``date_format`` so that every expression
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the source system's report definitions.
# ---------------------------------------------------------------------------

# Report modules, in the order a refresh cycle runs them, with their target tables.
MODULES: list[tuple[str, str]] = [
    ("sales", "tenant_ventes_matrix"),
    ("achats", "tenant_achats_matrix"),
    ("caisse", "tenant_caisse_matrix"),
    ("stock", "tenant_stock_matrix"),
    ("top_articles", "tenant_top_articles_matrix"),
    ("top_clients", "tenant_top_clients_matrix"),
    ("evolution_ca", "tenant_evolution_journaliere_matrix"),
    ("rotation", "tenant_rotation_matrix"),
    ("mode_reglement", "tenant_mode_reglement_matrix"),
    ("marge_brute", "tenant_marge_brute_matrix"),
    ("mouvements", "tenant_mouvements_matrix"),
    ("dernieres_transac", "tenant_dernieres_transac_matrix"),
    ("ca_famille", "tenant_ca_famille_matrix"),
    ("impayees", "tenant_impayees_matrix"),
    ("solde_client", "tenant_solde_client_matrix"),
]

# Document types.
SALES_CREDIT_NOTE = 6
SALES_INVOICE = 7
PURCHASE_INVOICE = 17
STOCK_IN = 20
STOCK_OUT = 21

# Document type labels of the sales report.
SALES_TYPE_LABELS = {7: "FACTURE", 6: "AVOIR"}
# Document type labels of the latest-transactions report.
TRANSACTION_TYPE_LABELS = {7: "Facture", 17: "Achat", 20: "Entrée Stock", 21: "Sortie Stock"}
# Purchase document label.
PURCHASE_LABEL = "FACTURE FOURNISSEUR"
# Stock movement direction: type 20 is in, anything else out.
STOCK_IN_LABEL = "ENTRÉE"
STOCK_OUT_LABEL = "SORTIE"
# Payment modes (N_Reglement); any other code reads "Autre".
PAYMENT_MODE_LABELS = {0: "Espèces", 1: "Chèque", 2: "Carte", 3: "Virement"}
PAYMENT_MODE_OTHER = "Autre"

# Fallback names when a joined row is missing.
UNKNOWN_CUSTOMER = "CLIENT INCONNU"
UNKNOWN_SUPPLIER = "FOURNISSEUR INCONNU"
UNKNOWN_PAYER = "DIVERS"
MAIN_TILL = "CAISSE PRINCIPALE"
DEFAULT_ITEM_TEXT = "Article"
DEFAULT_CUSTOMER = "CLIENT"
DEFAULT_FAMILY_CODE = "AUTRE"
DEFAULT_FAMILY_NAME = "Général"

# Date text formats: day/month/year, and ISO year-month-day.
DMY = "dd/MM/yyyy"
ISO_DAY = "yyyy-MM-dd"

# ---------------------------------------------------------------------------

MODULE_KEYS: list[str] = [m for m, _ in MODULES]
TARGET_TABLE: dict[str, str] = dict(MODULES)


def code_label(code: Column, labels: dict[int, str], otherwise: Column) -> Column:
    """Simple CASE on an integer code; codes not listed map to ``otherwise``."""
    out = None
    for k, v in labels.items():
        out = F.when(code == k, F.lit(v)) if out is None else out.when(code == k, F.lit(v))
    return out.otherwise(otherwise)


def type_as_text(code: Column) -> Column:
    return code.cast("string")


def payment_mode_label(code: Column) -> Column:
    return code_label(code, PAYMENT_MODE_LABELS, F.lit(PAYMENT_MODE_OTHER))


def dmy(ts: Column) -> Column:
    return F.date_format(ts, DMY)


def iso_day(ts: Column) -> Column:
    return F.date_format(ts, ISO_DAY)
