SELECT tenant_id, strftime(DO_Date, '%d/%m/%Y') AS Date, DO_Piece AS Piece, DO_Tiers AS Tiers,
  CAST(total AS DECIMAL(28,6)) AS Montant, coalesce(type_name, CAST(DO_Type AS VARCHAR)) AS Type
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY tenant_id
    ORDER BY DO_Date DESC NULLS LAST, DO_Piece NULLS FIRST, DO_Type NULLS FIRST) AS rn
  FROM doc_totals
) AS ranked
LEFT JOIN (
  VALUES (7, 'Facture'), (17, 'Achat'), (20, 'Entrée Stock'), (21, 'Sortie Stock')
) AS type_names(DO_Type, type_name) USING (DO_Type)
WHERE rn <= 50
