SELECT tenant_id, cycle_no, status, last_sync_error, duration_ms, reported_at FROM HEALTH
