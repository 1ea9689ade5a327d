SELECT tenant_id, DO_Type, CAST(DO_Date AS DATE) AS day,
  COUNT(DISTINCT DO_Piece) AS n_documents, COUNT(*) AS n_lines, SUM(DL_MontantTTC) AS amount
FROM doc_lines
GROUP BY tenant_id, DO_Type, CAST(DO_Date AS DATE)
