SELECT tenant_id, coalesce(mode_name, 'Autre') AS ModeReglement, CAST(total AS DECIMAL(24,2)) AS TotalRegle
FROM (
  SELECT tenant_id, N_Reglement, SUM(RG_Montant) AS total
  FROM F_CREGLEMENT
  GROUP BY tenant_id, N_Reglement
) AS per_mode
LEFT JOIN mode_names USING (N_Reglement)
