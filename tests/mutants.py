"""Wrong variants of the reports, one per semantic trap; each must give a different result.

Each mutant is a text edit of the oracle SQL (old -> new); the edit must apply.
"""

_GROUPED_PAYMENTS = ("CT_NumPayeur AS DO_Tiers, RG_Montant FROM F_CREGLEMENT",
                     "CT_NumPayeur AS DO_Tiers, SUM(RG_Montant) AS RG_Montant FROM F_CREGLEMENT GROUP BY ALL")

MUTANTS = {
    "piece_only_join": ("sales", "F_DOCENTETE JOIN F_DOCLIGNE USING (tenant_id, DO_Piece, DO_Type)",
                        "F_DOCENTETE JOIN (SELECT * EXCLUDE (DO_Type) FROM F_DOCLIGNE) AS l USING (tenant_id, DO_Piece)"),
    "inner_for_left": ("sales", "LEFT JOIN party USING", "JOIN party USING"),
    "count_without_distinct": ("top_clients", "COUNT(DISTINCT DO_Piece)", "COUNT(DO_Piece)"),
    "null_item_dropped": ("top_articles", "FROM sold_lines\n    GROUP BY", "FROM sold_lines WHERE AR_Ref IS NOT NULL\n    GROUP BY"),
    "label_grouping": ("mode_reglement", "SELECT tenant_id, N_Reglement, SUM(RG_Montant) AS total\n  FROM F_CREGLEMENT\n"
                       "  GROUP BY tenant_id, N_Reglement",
                       "SELECT tenant_id, least(N_Reglement, 4) AS N_Reglement, SUM(RG_Montant) AS total\n  FROM F_CREGLEMENT\n"
                       "  GROUP BY ALL"),
    "day_grouping": ("evolution_ca", "SELECT tenant_id, DO_Date, CAST(DO_Date AS DATE) AS calendar_day, SUM(total) AS amount\n"
                     "  FROM doc_totals\n  WHERE DO_Type IN (6, 7)\n  GROUP BY tenant_id, DO_Date",
                     "SELECT tenant_id, CAST(DO_Date AS DATE) AS DO_Date, CAST(DO_Date AS DATE) AS calendar_day, SUM(total) AS amount\n"
                     "  FROM doc_totals\n  WHERE DO_Type IN (6, 7)\n  GROUP BY ALL"),
    "payments_preaggregated_r14": ("impayees", *_GROUPED_PAYMENTS),
    "payments_preaggregated_r15": ("solde_client", *_GROUPED_PAYMENTS),
    "on_to_where": ("solde_client", "FROM party\n  LEFT JOIN invoice_rows", "FROM party\n  JOIN invoice_rows"),
    "null_cost_skipped": ("marge_brute", "SUM(coalesce(AR_PrixAch, 0)) AS cost_sum, COUNT(*) AS line_n",
                          "SUM(AR_PrixAch) AS cost_sum, COUNT(AR_PrixAch) AS line_n"),
    "item_code_grouping": ("ca_famille", "GROUP BY tenant_id, known_code, FA_Intitule",
                           "GROUP BY tenant_id, AR_Ref, known_code, FA_Intitule"),
    "having_removed": ("solde_client", "WHERE billed - paid <> 0", ""),
}
