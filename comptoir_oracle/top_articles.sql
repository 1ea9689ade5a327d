SELECT tenant_id, AR_Ref AS CodeArticle, LibelleArticle, CAST(qty AS DECIMAL(22,2)) AS QuantiteVendue,
  CAST(amount AS DECIMAL(28,6)) AS MontantVendu
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY tenant_id ORDER BY amount DESC NULLS LAST, AR_Ref NULLS FIRST) AS rn
  FROM (
    SELECT tenant_id, AR_Ref, MAX(coalesce(DL_Design, 'Article')) AS LibelleArticle, SUM(DL_Qte) AS qty,
      SUM(DL_MontantTTC) AS amount
    FROM sold_lines
    GROUP BY tenant_id, AR_Ref
  ) AS per_item
) AS ranked
WHERE rn <= 20
