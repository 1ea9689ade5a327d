-- Each line of an invoice meets each payment of its customer; both sums run over those pairs.
SELECT tenant_id, DO_Piece AS NumFacture, strftime(DO_Date, '%d/%m/%Y') AS DateFacture, DO_Tiers AS CodeClient,
  coalesce(party_name, 'CLIENT') AS NomClient, CAST(billed AS DECIMAL(18,2)) AS MontantFacture,
  CAST(paid AS DECIMAL(24,2)) AS MontantRegle, balance AS Solde
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY tenant_id ORDER BY DO_Date DESC NULLS LAST, DO_Piece NULLS FIRST) AS rn
  FROM (
    SELECT *, CAST(billed - paid AS DECIMAL(18,2)) AS balance
    FROM (
      SELECT tenant_id, DO_Piece, DO_Date, DO_Tiers, SUM(DL_MontantTTC) AS billed, coalesce(SUM(RG_Montant), 0) AS paid
      FROM doc_lines LEFT JOIN payer_rows USING (tenant_id, DO_Tiers)
      WHERE DO_Type = 7
      GROUP BY tenant_id, DO_Piece, DO_Date, DO_Tiers
    ) AS invoices
  ) AS balances
  WHERE balance > 0
) AS ranked
LEFT JOIN party USING (tenant_id, DO_Tiers)
WHERE rn <= 50
