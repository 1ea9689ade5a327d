SELECT tenant_id, DO_Tiers AS CodeClient, coalesce(party_name, 'CLIENT') AS NomClient,
  CAST(amount AS DECIMAL(28,6)) AS CA_Total, n_pieces AS NbFactures
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY tenant_id ORDER BY amount DESC NULLS LAST, DO_Tiers NULLS FIRST) AS rn
  FROM (
    SELECT tenant_id, DO_Tiers, SUM(DL_MontantTTC) AS amount, COUNT(DISTINCT DO_Piece) AS n_pieces
    FROM sold_lines
    GROUP BY tenant_id, DO_Tiers
  ) AS per_party
) AS ranked
LEFT JOIN party USING (tenant_id, DO_Tiers)
WHERE rn <= 20
