-- As in the unpaid invoices, invoice rows meet payments in pairs; a party without either counts 0.
SELECT tenant_id, DO_Tiers AS CodeClient, party_name AS Nom, CAST(billed AS DECIMAL(28,6)) AS TotalFacture,
  CAST(paid AS DECIMAL(24,2)) AS TotalRegle, CAST(billed - paid AS DECIMAL(29,6)) AS Solde
FROM (
  SELECT tenant_id, DO_Tiers, party_name, coalesce(SUM(DL_MontantTTC), 0) AS billed, coalesce(SUM(RG_Montant), 0) AS paid
  FROM party
  LEFT JOIN invoice_rows USING (tenant_id, DO_Tiers)
  LEFT JOIN payer_rows USING (tenant_id, DO_Tiers)
  GROUP BY tenant_id, DO_Tiers, party_name
) AS accounts
WHERE billed - paid <> 0
