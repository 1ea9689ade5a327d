SELECT 'F_DOCENTETE' AS "table", tenant_id, concat(DO_Piece, '|', DO_Type) AS "key", 2 * COUNT(*) AS n
FROM F_DOCENTETE WHERE DO_Type = 17 GROUP BY tenant_id, DO_Piece, DO_Type
UNION ALL
SELECT 'F_COMPTET', tenant_id, CT_Num, 2 * COUNT(*) FROM F_COMPTET WHERE CT_Num LIKE '%5' GROUP BY tenant_id, CT_Num
UNION ALL
SELECT 'F_CREGLEMENT', tenant_id, CAST(RG_No AS VARCHAR), 2 * COUNT(*)
FROM F_CREGLEMENT WHERE CA_No = 6 GROUP BY tenant_id, RG_No
