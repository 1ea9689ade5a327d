SELECT tenant_id, DO_Piece AS NumFacture, strftime(DO_Date, '%d/%m/%Y') AS DateFacture, DO_Tiers AS CodeFournisseur,
  coalesce(party_name, 'FOURNISSEUR INCONNU') AS NomFournisseur, CAST(total AS DECIMAL(18,2)) AS MONTANT_TTC,
  'FACTURE FOURNISSEUR' AS TypeDoc
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY tenant_id ORDER BY DO_Date DESC NULLS LAST, DO_Piece DESC NULLS LAST) AS rn
  FROM doc_totals WHERE DO_Type = 17
) AS ranked
LEFT JOIN party USING (tenant_id, DO_Tiers)
WHERE rn <= 100
