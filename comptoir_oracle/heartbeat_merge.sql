SELECT R.tenant_id, R.hw_id,
  CASE WHEN H.tenant_id IS NOT NULL THEN H.status ELSE R.status END AS status,
  CASE WHEN H.tenant_id IS NOT NULL THEN H.reported_at ELSE R.updated_at END AS updated_at,
  CASE WHEN H.tenant_id IS NOT NULL THEN coalesce(H.duration_ms, R.last_sync_duration_ms) ELSE R.last_sync_duration_ms END AS last_sync_duration_ms,
  CASE WHEN H.tenant_id IS NOT NULL THEN H.last_sync_error ELSE R.last_sync_error END AS last_sync_error
FROM REGISTRY R
LEFT JOIN (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY tenant_id ORDER BY cycle_no DESC) AS rn FROM HEALTH) WHERE rn = 1
) H ON R.tenant_id = H.tenant_id
