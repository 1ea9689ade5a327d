SELECT tenant_id, NumFacture, DateFacture, CodeClient, NomClient, MONTANT_TTC, TypeDoc FROM latest_sales
