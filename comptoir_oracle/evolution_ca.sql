SELECT tenant_id, strftime(DO_Date, '%Y-%m-%d') AS DateJour, CAST(amount AS DECIMAL(18,2)) AS CA_Jour,
  CAST(coalesce(received, 0) AS DECIMAL(24,2)) AS Encaisse_Jour
FROM (
  SELECT tenant_id, DO_Date, CAST(DO_Date AS DATE) AS calendar_day, SUM(total) AS amount
  FROM doc_totals
  WHERE DO_Type IN (6, 7)
  GROUP BY tenant_id, DO_Date
) AS moments
LEFT JOIN day_receipts USING (tenant_id, calendar_day)
