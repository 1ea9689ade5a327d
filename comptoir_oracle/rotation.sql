-- The mean price in whole millionths, half up: no digit depends on a double.
SELECT tenant_id, AR_Ref AS CodeArticle, Libelle, CAST(qty AS DECIMAL(22,2)) AS QuantiteVendue,
  CAST(CAST(CASE WHEN (amount < 0) <> (qty < 0) THEN -millionths ELSE millionths END AS DECIMAL(31,0)) * CAST('0.000001' AS DECIMAL(7,6))
       AS DECIMAL(38,6)) AS PrixMoyen
FROM (
  SELECT *, (200 * a + q) // (2 * q) AS millionths
  FROM (
    SELECT *, CAST(replace(CAST(abs(amount) AS VARCHAR), '.', '') AS HUGEINT) AS a,
      nullif(CAST(replace(CAST(abs(qty) AS VARCHAR), '.', '') AS HUGEINT), 0) AS q,
      ROW_NUMBER() OVER (PARTITION BY tenant_id ORDER BY qty DESC NULLS LAST, AR_Ref NULLS FIRST) AS rn
    FROM (
      SELECT tenant_id, AR_Ref, MAX(coalesce(AR_Design, DL_Design)) AS Libelle, SUM(DL_Qte) AS qty,
        SUM(DL_MontantTTC) AS amount
      FROM sold_items
      WHERE AR_Ref IS NOT NULL
      GROUP BY tenant_id, AR_Ref
    ) AS per_item
  ) AS ranked
) AS priced
WHERE rn <= 20
