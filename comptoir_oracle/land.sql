-- The payments after two complete deliveries, and what each of them rejected.
SELECT * FROM (
  WITH bad AS (
    SELECT *, RG_No % 11 = 0 AS bad_date, RG_Montant IS NOT NULL AND RG_No % 7 = 0 AS bad_amount FROM F_CREGLEMENT
  ),
  lost AS (
    SELECT *, 1 AS landing, bad_date AS no_date FROM bad
    UNION ALL
    SELECT * REPLACE ('again' AS RG_Libelle), 2, bad_date OR RG_No % 13 = 0 FROM bad WHERE RG_No % 10 <> 3
  )
  SELECT tenant_id, RG_No, CASE WHEN RG_No % 13 = 0 THEN RG_Libelle ELSE 'again' END AS RG_Libelle,
    CAST(RG_Montant AS VARCHAR) AS RG_Montant, CAST(NULL AS VARCHAR) AS rejected_columns, CAST(NULL AS INT) AS landing
  FROM bad WHERE NOT bad_date AND NOT bad_amount AND RG_No % 10 <> 3
  UNION ALL
  SELECT tenant_id, RG_No, RG_Libelle, CAST(RG_Montant AS VARCHAR) || CASE WHEN RG_No % 7 = 0 THEN '5' ELSE '' END,
    concat_ws(',', CASE WHEN no_date THEN 'RG_Date' END, CASE WHEN bad_amount THEN 'RG_Montant' END), landing
  FROM lost WHERE no_date OR bad_amount
)
