F_DOCENTETE AS (
  SELECT concat('T', CAST(o_orderkey % 3 AS VARCHAR)) AS tenant_id,
    concat('P', lpad(CAST(CAST(FLOOR(o_orderkey / 15) AS BIGINT) AS VARCHAR), 6, '0')) AS DO_Piece,
    CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN 7 WHEN 1 THEN 6 WHEN 2 THEN 17 WHEN 3 THEN 20 ELSE 21 END AS DO_Type,
    CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate ELSE o_orderdate + INTERVAL 9 HOUR END AS DO_Date,
    concat('C', lpad(CAST(o_custkey AS VARCHAR), 6, '0')) AS DO_Tiers
  FROM orders
),
F_DOCLIGNE AS (
  SELECT concat('T', CAST(l_orderkey % 3 AS VARCHAR)) AS tenant_id,
    concat('P', lpad(CAST(CAST(FLOOR(l_orderkey / 15) AS BIGINT) AS VARCHAR), 6, '0')) AS DO_Piece,
    CASE CAST(l_orderkey % 5 AS INT) WHEN 0 THEN 7 WHEN 1 THEN 6 WHEN 2 THEN 17 WHEN 3 THEN 20 ELSE 21 END AS DO_Type,
    CASE WHEN l_partkey % 50 = 49 THEN NULL ELSE concat('A', lpad(CAST(l_partkey AS VARCHAR), 6, '0')) END AS AR_Ref,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE concat('line ', l_returnflag, l_linestatus) END AS DL_Design,
    CAST(l_quantity AS DECIMAL(12,2)) AS DL_Qte,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(1 - CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(5,2))
         * CAST(1 + CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(5,2)) AS DECIMAL(18,6)) AS DL_MontantTTC,
    CASE WHEN l_partkey % 23 = 0 THEN CAST(0 AS DECIMAL(12,2)) ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS DL_PrixUnitaire
  FROM lineitem
),
F_COMPTET AS (
  SELECT unnest(['T0', 'T1', 'T2']) AS tenant_id,
    concat('C', lpad(CAST(c_custkey AS VARCHAR), 6, '0')) AS CT_Num, c_name AS CT_Intitule
  FROM customer WHERE c_custkey % 10 <> 9
),
F_ARTICLE AS (
  SELECT unnest(['T0', 'T1', 'T2']) AS tenant_id,
    concat('A', lpad(CAST(p_partkey AS VARCHAR), 6, '0')) AS AR_Ref, p_name AS AR_Design,
    CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(12,2)) END AS AR_PrixAch,
    p_type AS FA_CodeFamille
  FROM part WHERE p_partkey % 20 <> 19
),
F_FAMILLE AS (
  SELECT unnest(['T0', 'T1', 'T2']) AS tenant_id, FA_CodeFamille, concat('Famille ', lower(FA_CodeFamille)) AS FA_Intitule
  FROM (SELECT DISTINCT p_type AS FA_CodeFamille FROM part WHERE p_type <> 'PROMO')
),
F_ARTSTOCK AS (
  SELECT unnest(['T0', 'T1', 'T2']) AS tenant_id,
    concat('A', lpad(CAST(p_partkey AS VARCHAR), 6, '0')) AS AR_Ref,
    CAST(CASE WHEN p_partkey % 7 = 0 THEN 0 WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size - 5 END AS DECIMAL(12,2)) AS AS_QteSto,
    CAST(p_size * CAST(p_retailprice AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS AS_MontSto
  FROM part
),
F_CREGLEMENT AS (
  SELECT concat('T', CAST(event_id % 3 AS VARCHAR)) AS tenant_id, event_id AS RG_No, ts - INTERVAL 8766 DAY AS RG_Date,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE concat('C', lpad(CAST(user_id AS VARCHAR), 6, '0')) END AS CT_NumPayeur,
    event_type AS RG_Libelle,
    CAST(event_id % 2 AS INT) AS RG_Type,
    CAST(CAST(value AS DECIMAL(12,2)) * CASE WHEN user_id % 5 = 0 THEN 2000 ELSE 1 END AS DECIMAL(14,2)) AS RG_Montant,
    CAST(CAST(FLOOR(event_id / 3) AS BIGINT) % 6 AS INT) AS N_Reglement,
    CAST(CAST(FLOOR(event_id / 3) AS BIGINT) % 7 AS INT) AS CA_No
  FROM events
),
F_CAISSE AS (
  SELECT unnest(['T0', 'T1', 'T2']) AS tenant_id, CAST(r_regionkey AS INT) AS CA_No, r_name AS CA_Intitule
  FROM region
),
SETTINGS AS (
  SELECT * FROM (VALUES ('T0', 'sales', TRUE), ('T1', 'sales', FALSE), ('T2', 'caisse', NULL)) AS s(tenant_id, module_key, is_enabled)
),
MODULES AS (
  SELECT unnest(['sales', 'achats', 'caisse', 'stock', 'top_articles', 'top_clients', 'evolution_ca', 'rotation',
                 'mode_reglement', 'marge_brute', 'mouvements', 'dernieres_transac', 'ca_famille', 'impayees',
                 'solde_client']) AS module_key,
         unnest(range(15)) AS module_no
),
RUN_LOG AS (
  SELECT concat('T', CAST(event_id % 3 AS VARCHAR)) AS tenant_id,
    CAST(FLOOR(event_id / 45) AS BIGINT) AS cycle_no,
    CAST(CAST(FLOOR(event_id / 3) AS BIGINT) % 15 AS INT) AS module_no,
    CASE WHEN event_type = 'error'
      THEN concat('m', CAST(CAST(CAST(FLOOR(event_id / 3) AS BIGINT) % 15 AS INT) AS VARCHAR), ': ', repeat('x', CAST(event_id % 200 AS INT)))
    END AS error,
    CAST(FLOOR(value * 10) AS INT) AS elapsed_ms,
    ts AS logged_at
  FROM events
),
CYCLES AS (
  SELECT tenant_id, cycle_no,
    CASE WHEN cycle_no % 20 < 9 THEN 'SQL connect failed: login timeout expired' END AS cycle_error
  FROM (SELECT DISTINCT tenant_id, cycle_no FROM RUN_LOG)
),
REGISTRY AS (
  SELECT tenant_id, concat('HW-', tenant_id) AS hw_id, 'active' AS status,
    TIMESTAMP '2024-01-01 00:00:00' AS updated_at, CAST(1000 AS INT) AS last_sync_duration_ms,
    CAST(NULL AS VARCHAR) AS last_sync_error
  FROM (SELECT DISTINCT tenant_id FROM F_DOCENTETE)
),
ACTIVATIONS AS (
  SELECT tenant_id, concat('HW2-', tenant_id) AS hw_id, 'active' AS status, MAX(RG_Date) AS updated_at
  FROM F_CREGLEMENT GROUP BY tenant_id
),
HEALTH AS (
  SELECT C.tenant_id, C.cycle_no,
    CASE WHEN C.cycle_error IS NOT NULL THEN 'error' WHEN coalesce(G.n_errors, 0) > 0 THEN 'degraded' ELSE 'active' END AS status,
    left(CASE WHEN C.cycle_error IS NOT NULL THEN C.cycle_error WHEN coalesce(G.n_errors, 0) > 0 THEN G.error_text END, 500) AS last_sync_error,
    CAST(CASE WHEN C.cycle_error IS NULL THEN coalesce(G.elapsed, 0) END AS INT) AS duration_ms,
    G.reported_at
  FROM CYCLES C
  LEFT JOIN (
    SELECT tenant_id, cycle_no, COUNT(error) AS n_errors, SUM(elapsed_ms) AS elapsed, MAX(logged_at) AS reported_at,
      STRING_AGG(CASE WHEN err_rank <= 5 THEN msg END, '; ' ORDER BY module_no) AS error_text
    FROM (
      SELECT R.*, concat(M.module_key, ': ', R.error) AS msg,
        CASE WHEN R.error IS NOT NULL THEN ROW_NUMBER() OVER (PARTITION BY R.tenant_id, R.cycle_no, R.error IS NULL ORDER BY R.module_no) END AS err_rank
      FROM RUN_LOG R LEFT JOIN MODULES M ON R.module_no = M.module_no
    ) GROUP BY tenant_id, cycle_no
  ) G ON C.tenant_id = G.tenant_id AND C.cycle_no = G.cycle_no
)
