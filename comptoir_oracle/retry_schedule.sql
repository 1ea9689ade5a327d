SELECT tenant_id, cycle_no, status, streak,
  CAST(CASE WHEN streak >= 5 THEN least(60 * pow(2, least(streak - 4, 30)), 900) ELSE 60 END AS INT) AS wait_s
FROM (
  SELECT tenant_id, cycle_no, status,
    CAST(SUM(fail) OVER (PARTITION BY tenant_id, grp ORDER BY cycle_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INT) AS streak
  FROM (
    SELECT *, SUM(1 - fail) OVER (PARTITION BY tenant_id ORDER BY cycle_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp
    FROM (SELECT tenant_id, cycle_no, status, CASE WHEN status = 'error' THEN 1 ELSE 0 END AS fail FROM HEALTH)
  )
)
