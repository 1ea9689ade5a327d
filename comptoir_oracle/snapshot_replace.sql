SELECT tenant_id, NumFacture, DateFacture, CAST(MONTANT_TTC AS VARCHAR) AS MONTANT_TTC, TypeDoc
FROM latest_sales WHERE tenant_id = 'T1'
UNION ALL
SELECT tenant_id, DO_Piece, strftime(DO_Date, '%d/%m/%Y'), CAST(CAST(total AS DECIMAL(18,2)) AS VARCHAR), 'FACTURE FOURNISSEUR'
FROM doc_totals WHERE DO_Type = 17 AND tenant_id <> 'T1'
QUALIFY ROW_NUMBER() OVER (PARTITION BY tenant_id ORDER BY DO_Date DESC NULLS LAST, DO_Piece DESC NULLS LAST) <= 100
