SELECT tenant_id, 0 AS part,
  to_json(list(struct_pack(NumFacture := NumFacture, DateFacture := DateFacture, CodeClient := CodeClient,
                           NomClient := NomClient, MONTANT_TTC := CAST(MONTANT_TTC AS VARCHAR), TypeDoc := TypeDoc)
               ORDER BY rn)) AS data
FROM latest_sales
GROUP BY tenant_id
