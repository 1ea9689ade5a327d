SELECT P.tenant_id, P.module_key, CASE WHEN S.all_true IS NULL THEN TRUE ELSE S.all_true END AS enabled
FROM (
  SELECT tenant_id, unnest(['sales', 'achats', 'caisse', 'stock', 'top_articles', 'top_clients', 'evolution_ca', 'rotation',
                            'mode_reglement', 'marge_brute', 'mouvements', 'dernieres_transac', 'ca_famille', 'impayees',
                            'solde_client']) AS module_key
  FROM (SELECT DISTINCT tenant_id FROM F_DOCENTETE)
) P
LEFT JOIN (
  SELECT tenant_id, module_key, bool_and(coalesce(is_enabled, FALSE)) AS all_true FROM SETTINGS GROUP BY tenant_id, module_key
) S ON P.tenant_id = S.tenant_id AND P.module_key = S.module_key
