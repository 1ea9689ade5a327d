-- Both means in whole millionths, half up: no digit depends on a double.
SELECT tenant_id, AR_Ref AS CodeArticle, Libelle,
  CAST(CAST(price AS DECIMAL(31,0)) * CAST('0.000001' AS DECIMAL(7,6)) AS DECIMAL(38,6)) AS PrixVenteMoyen,
  CAST(CAST(cost AS DECIMAL(31,0)) * CAST('0.000001' AS DECIMAL(7,6)) AS DECIMAL(38,6)) AS PrixAchatMoyen,
  CAST(CAST(price - cost AS DECIMAL(31,0)) * CAST('0.000001' AS DECIMAL(7,6)) AS DECIMAL(38,6)) AS MargeUnitaire
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY tenant_id ORDER BY price - cost DESC NULLS LAST, AR_Ref NULLS FIRST) AS rn
  FROM (
    SELECT *, (20000 * CAST(replace(CAST(price_sum AS VARCHAR), '.', '') AS HUGEINT) + price_n) // (2 * price_n) AS price,
      (20000 * CAST(replace(CAST(cost_sum AS VARCHAR), '.', '') AS HUGEINT) + line_n) // (2 * line_n) AS cost
    FROM (
      SELECT tenant_id, AR_Ref, MAX(coalesce(AR_Design, DL_Design)) AS Libelle, SUM(DL_PrixUnitaire) AS price_sum,
        COUNT(DL_PrixUnitaire) AS price_n, SUM(coalesce(AR_PrixAch, 0)) AS cost_sum, COUNT(*) AS line_n
      FROM sold_items
      WHERE AR_Ref IS NOT NULL
      GROUP BY tenant_id, AR_Ref
    ) AS per_item
    WHERE price_sum > 0
  ) AS margins
) AS ranked
WHERE rn <= 20
