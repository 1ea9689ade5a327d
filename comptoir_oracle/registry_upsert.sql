SELECT coalesce(R.tenant_id, U.tenant_id) AS tenant_id,
  CASE WHEN U.tenant_id IS NOT NULL THEN U.hw_id ELSE R.hw_id END AS hw_id,
  CASE WHEN U.tenant_id IS NOT NULL THEN U.status ELSE R.status END AS status,
  CASE WHEN U.tenant_id IS NOT NULL THEN U.updated_at ELSE R.updated_at END AS updated_at,
  R.last_sync_duration_ms, R.last_sync_error
FROM REGISTRY R
FULL JOIN (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY tenant_id ORDER BY updated_at DESC, hw_id DESC, status DESC) AS rn
                 FROM ACTIVATIONS) WHERE rn = 1
) U ON R.tenant_id = U.tenant_id
