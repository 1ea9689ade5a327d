SELECT tenant_id, RG_No AS NUM_REGLEMENT, strftime(RG_Date, '%d/%m/%Y') AS DATE_MVT,
  coalesce(party_name, 'DIVERS') AS NOM_TIERS, RG_Libelle AS LIBELLE_MVT,
  coalesce(CA_Intitule, 'CAISSE PRINCIPALE') AS NOM_CAISSE,
  CAST(CASE WHEN RG_Type = 0 THEN RG_Montant ELSE 0 END AS DECIMAL(14,2)) AS ENTREE_CAISSE,
  CAST(CASE WHEN RG_Type = 1 THEN RG_Montant ELSE 0 END AS DECIMAL(14,2)) AS SORTIE_CAISSE,
  coalesce(mode_name, 'Autre') AS MODE_REGLEMENT
FROM (
  SELECT * FROM (
    SELECT *, CT_NumPayeur AS DO_Tiers, ROW_NUMBER() OVER (PARTITION BY tenant_id ORDER BY RG_No DESC NULLS LAST) AS rn
    FROM F_CREGLEMENT
  ) AS ranked
  WHERE rn <= 200
) AS latest
LEFT JOIN party USING (tenant_id, DO_Tiers)
LEFT JOIN F_CAISSE USING (tenant_id, CA_No)
LEFT JOIN mode_names USING (N_Reglement)
