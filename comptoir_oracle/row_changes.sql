-- The payments as the third wave of change rows leaves them.
SELECT * REPLACE (
  CAST(CASE WHEN RG_No % 10 = 5 THEN RG_Montant + 1 ELSE RG_Montant END AS DECIMAL(14,2)) AS RG_Montant,
  CASE WHEN RG_No % 10 = 6 THEN 'back' ELSE RG_Libelle END AS RG_Libelle)
FROM F_CREGLEMENT WHERE RG_No % 10 NOT IN (4, 7)
