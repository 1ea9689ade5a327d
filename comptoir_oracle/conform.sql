SELECT tenant_id, RG_No,
  CASE WHEN bad = '' THEN CAST(RG_Montant AS VARCHAR) END AS RG_Montant, nullif(bad, '') AS rejected_columns
FROM (
  SELECT *, concat_ws(',', CASE WHEN RG_No % 11 = 0 THEN 'RG_Date' END,
                      CASE WHEN RG_Montant IS NOT NULL AND RG_No % 7 = 0 THEN 'RG_Montant' END) AS bad
  FROM F_CREGLEMENT
) AS landed
