SELECT tenant_id, coalesce(known_code, 'AUTRE') AS CodeFamille, coalesce(FA_Intitule, 'Général') AS LibelleFamille,
  CAST(SUM(DL_MontantTTC) AS DECIMAL(28,6)) AS CA_Famille
FROM sold_items
LEFT JOIN (SELECT *, FA_CodeFamille AS known_code FROM F_FAMILLE) AS families USING (tenant_id, FA_CodeFamille)
GROUP BY tenant_id, known_code, FA_Intitule
