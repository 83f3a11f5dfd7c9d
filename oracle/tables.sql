-- The derived fleet tables, as named subqueries over the given tables.
jobs_plain AS (
  SELECT o_custkey % 25 AS server_id, o_orderkey AS job_id,
    concat('Job ', CAST(o_orderkey AS VARCHAR(20))) AS job_name,
    CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS start_step_id
  FROM orders
),
steps_plain AS (
  SELECT o.o_custkey % 25 AS server_id, l_orderkey AS job_id, rn AS step_id,
    concat('Load part ', CAST(l_partkey AS VARCHAR(20))) AS step_name,
    CASE l_returnflag WHEN 'A' THEN 'TSQL' WHEN 'R' THEN 'CmdExec' ELSE 'SSIS' END AS subsystem,
    concat('EXEC dbo.LoadPart @id = ', CAST(l_partkey AS VARCHAR(20))) AS command,
    CASE WHEN rn < n THEN 4 ELSE 1 END AS on_success_action,
    CASE WHEN rn < n THEN rn + 1 ELSE 0 END AS on_success_step_id,
    CASE WHEN l_linestatus = 'F' THEN 2 ELSE 4 END AS on_fail_action,
    CASE WHEN l_linestatus = 'F' THEN 0 ELSE n END AS on_fail_step_id,
    concat('DB_', CAST(l_suppkey % 5 AS VARCHAR(20))) AS database_name
  FROM (SELECT *,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS INT) AS rn,
    CAST(count(*) OVER (PARTITION BY l_orderkey) AS INT) AS n
  FROM lineitem) l
  JOIN orders o ON o.o_orderkey = l_orderkey
),
run_config AS (
  SELECT CAST(n_nationkey AS BIGINT) AS server_id, r_name AS config_name,
    concat('DB_', CAST(r_regionkey AS VARCHAR(20))) AS driver_database, (n_nationkey + r_regionkey) % 2 = 0 AS run_if_ungrouped
  FROM nation
  CROSS JOIN region
  WHERE (n_nationkey + r_regionkey) % 7 <> 0
),
databases AS (
  SELECT CAST(n_nationkey AS BIGINT) AS server_id, r_regionkey + 5 AS database_id,
    concat('DB_', CAST(r_regionkey AS VARCHAR(20))) AS database_name
  FROM nation
  CROSS JOIN region
  WHERE (n_nationkey * 3 + r_regionkey) % 11 <> 0
),
replica_states AS (
  SELECT CAST(n_nationkey AS BIGINT) AS server_id, n_nationkey AS replica_id, r_regionkey AS group_id,
    CASE WHEN n_nationkey % 5 = r_regionkey THEN 'PRIMARY' ELSE 'SECONDARY' END AS role_desc
  FROM nation
  CROSS JOIN region
  WHERE r_regionkey < 3
),
db_replica_states AS (
  SELECT CAST(n_nationkey AS BIGINT) AS server_id, n_nationkey AS replica_id, r_regionkey AS group_id, r_regionkey + 5 AS database_id, TRUE AS is_local
  FROM nation
  CROSS JOIN region
  WHERE r_regionkey < 3
  UNION ALL SELECT CAST(n_nationkey AS BIGINT), (n_nationkey + 1) % 25, r_regionkey, r_regionkey + 5, FALSE
  FROM nation
  CROSS JOIN region
  WHERE r_regionkey < 3
),
requests AS (
  SELECT o_custkey % 25 AS server_id,
    concat('JOB ', CAST(o_orderkey AS VARCHAR(20))) AS job_name,
    CASE WHEN o_orderkey % 29 = 0 THEN 'NOWHERE' ELSE r_name END AS config_name
  FROM orders
  JOIN region ON r_regionkey = o_orderkey % 5
  WHERE o_orderkey % 4 <> 0
  UNION ALL SELECT 3, 'No such job', 'ASIA'
),
jobs_installed AS (
  SELECT o_custkey % 25 AS server_id, o_orderkey AS job_id,
    concat('Job ', CAST(o_orderkey AS VARCHAR(20))) AS job_name,
    CASE WHEN o_orderkey % 6 = 0 OR o_orderkey % 11 = 0 THEN 2 ELSE 1 END AS start_step_id
  FROM orders
),
steps_installed AS (
  SELECT p.server_id, p.job_id,
    CASE WHEN p.job_id % 6 = 0 THEN p.step_id ELSE p.step_id + 2 END AS step_id, p.step_name, p.subsystem, p.command, p.on_success_action,
    CASE WHEN p.job_id % 6 = 0 OR p.on_success_step_id = 0 THEN p.on_success_step_id ELSE p.on_success_step_id + 2 END AS on_success_step_id, p.on_fail_action,
    CASE WHEN p.job_id % 6 = 0 OR p.on_fail_step_id = 0 THEN p.on_fail_step_id ELSE p.on_fail_step_id + 2 END AS on_fail_step_id, p.database_name
  FROM steps_plain p
  UNION ALL SELECT o_custkey % 25, o_orderkey, 1, $GUARD_STEP_1_NAME, 'TSQL',
    concat('EXECUTE chk @JobStepID = 1 , ', $CONFIG_MARKER, r_name, ''''), 4, 3 + CAST(o_orderkey % 2 AS INT), 4, 2, 'DBA'
  FROM orders
  JOIN region ON r_regionkey = o_orderkey % 5
  WHERE o_orderkey % 6 <> 0
  UNION ALL SELECT o_custkey % 25, o_orderkey, 2,
    CASE WHEN o_orderkey % 19 = 0 THEN 'Renamed' ELSE $GUARD_STEP_2_NAME END, 'TSQL',
    concat('EXECUTE chk @JobStepID = 2 , ', $CONFIG_MARKER,
    CASE WHEN o_orderkey % 13 = 0 THEN 'OTHER' WHEN o_orderkey % 17 = 0 THEN lower(r_name) ELSE r_name END, ''''), 1, 0, 2, 0, 'DBA'
  FROM orders
  JOIN region ON r_regionkey = o_orderkey % 5
  WHERE o_orderkey % 6 <> 0
),
principals AS (
  SELECT c_nationkey % 5 AS server_id, c_name AS principal_name,
    CASE c_custkey % 4 WHEN 0 THEN 'S' WHEN 1 THEN 'U' WHEN 2 THEN 'R' ELSE 'G' END AS principal_type
  FROM customer
  WHERE c_custkey % 10 <> 9
),
grant_events AS (
  SELECT event_id, ts, CAST(user_id % 5 AS INT) AS server_id,
    concat('<EVENT_INSTANCE><EventType>',
    CASE WHEN event_type IN ('click', 'view') THEN 'REVOKE_DATABASE' ELSE 'GRANT_DATABASE' END, '</EventType><Grantees><Grantee>Customer#', lpad(CAST(user_id AS VARCHAR(20)), 9, '0'), '</Grantee>',
    CASE WHEN event_id % 2 = 0 THEN concat('<Grantee>CUSTOMER#', lpad(CAST(event_id % 150 AS VARCHAR(20)), 9, '0'), '</Grantee>') ELSE '' END,
    CASE WHEN event_id % 50 = 0 THEN '<Grantee></Grantee>' ELSE '' END, '</Grantees></EVENT_INSTANCE>') AS event_xml
  FROM events
),
expected_objects AS (
  SELECT CAST(n_nationkey AS BIGINT) AS server_id,
    CASE r_regionkey WHEN 0 THEN 'fulltext_thesaurus_metadata_table' WHEN 1 THEN 'fulltext_thesaurus_phrase_table' ELSE 'fulltext_thesaurus_state_table' END AS object_name
  FROM nation
  CROSS JOIN region
  WHERE r_regionkey < 3
),
objects AS (
  SELECT server_id,
    CASE WHEN server_id % 3 = 0 THEN upper(object_name) ELSE object_name END AS object_name,
    CASE WHEN server_id = 7 THEN 'U' ELSE 'IT' END AS object_type
  FROM expected_objects
  WHERE (server_id + length(object_name)) % 4 <> 0
  UNION ALL SELECT p_partkey % 25,
    concat('Part_', CAST(p_partkey AS VARCHAR(20))),
    CASE WHEN p_partkey % 2 = 0 THEN 'IT' ELSE 'U' END
  FROM part
),
-- The same with everything in it that is to be refused or reported.
awk_principals AS (
  SELECT server_id, principal_name, CASE WHEN right(principal_name, 1) IN ('0', '2', '4', '6', '8')
    THEN concat(lower(principal_type), ' ') ELSE principal_type END AS principal_type
  FROM principals
),
awk_objects AS (
  SELECT server_id, object_name, CASE WHEN server_id % 2 = 0
    THEN concat(lower(object_type), ' ') ELSE object_type END AS object_type
  FROM objects
),
awk_events AS (
  SELECT event_id, server_id, CASE WHEN event_id % 40 = 3 THEN left(event_xml, length(event_xml) - 20)
    WHEN event_id % 97 = 5 THEN NULL ELSE event_xml END AS event_xml
  FROM grant_events
),
awk_config AS (
  SELECT * FROM run_config
  UNION ALL SELECT server_id, 'asia ', driver_database, run_if_ungrouped FROM run_config
  WHERE server_id % 5 = 2 AND config_name = 'ASIA'
  UNION ALL SELECT DISTINCT server_id, 'O''Brien', 'DB_0', TRUE FROM replica_states
),
awk_databases AS (
  SELECT * FROM databases
  UNION ALL SELECT server_id, database_id + 50, 'db_1 ' FROM databases
  WHERE server_id % 8 = 3 AND database_name = 'DB_1'
),
awk_configs AS (
  SELECT server_id, lower(rtrim(config_name)) AS name, count(*) AS n,
    CASE count(*) WHEN 1 THEN min(driver_database) END AS driver_database,
    CASE count(*) WHEN 1 THEN bool_and(run_if_ungrouped) END AS run_if_ungrouped
  FROM awk_config GROUP BY ALL
),
awk_roles AS (
  SELECT d.server_id, d.database_id, d.database_name,
    CASE WHEN d.server_id % 6 = 1 THEN NULL ELSE s.role_desc END AS role_desc,
    CASE WHEN d.server_id % 6 = 1 THEN 2 ELSE 1 END AS role_rows, d.server_id % 6 = 1 AS ambiguous
  FROM awk_databases d
  JOIN db_replica_states r ON r.server_id = d.server_id AND r.database_id = d.database_id AND r.is_local
  JOIN replica_states s ON s.server_id = r.server_id AND s.replica_id = r.replica_id AND s.group_id = r.group_id
),
awk_states AS (
  SELECT c.*, d.database_id, d.n AS databases, o.role_desc, coalesce(o.ambiguous, FALSE) AS ambiguous
  FROM awk_configs c
  LEFT JOIN (
    SELECT server_id, lower(rtrim(database_name)) AS name, min(database_id) AS database_id, count(*) AS n
    FROM awk_databases GROUP BY ALL
  ) d ON d.server_id = c.server_id AND d.name = lower(c.driver_database)
  LEFT JOIN awk_roles o ON o.server_id = d.server_id AND o.database_id = d.database_id
),
awk_requests AS (
  SELECT * FROM requests
  UNION ALL SELECT server_id, concat(job_name, ' '), 'OTHER' FROM jobs_plain WHERE job_id % 37 = 0
  UNION ALL SELECT server_id, job_name, 'O''Brien' FROM jobs_plain WHERE job_id % 44 = 0 AND job_id % 37 <> 0
),
awk_plain_facts AS (
  SELECT server_id, job_id, count(*) AS n, count(DISTINCT step_id) AS ids, min(step_id) AS first, max(step_id) AS last
  FROM (
    SELECT server_id, job_id, CASE WHEN job_id % 43 = 7 AND step_id = 2 THEN 1 ELSE step_id END AS step_id
    FROM steps_plain WHERE NOT (job_id % 41 = 5 AND step_id = 1)
  ) GROUP BY ALL
),
awk_checked AS (
  SELECT r.server_id, r.job_name, r.config_name, j.job_id,
    CASE
      WHEN count(*) OVER (PARTITION BY r.server_id, lower(rtrim(r.job_name))) > 1 THEN 'duplicate_request'
      WHEN j.job_id IS NULL THEN 'missing_job'
      WHEN f.n IS NULL THEN 'no_steps'
      WHEN c.n IS NULL THEN 'missing_config'
      WHEN c.n > 1 THEN 'ambiguous_config'
      WHEN contains(r.config_name, '''') THEN 'quote_in_config'
      WHEN f.ids < f.n THEN 'repeated_steps'
      WHEN f.first <> 1 OR f.last <> f.n THEN 'step_gaps'
      ELSE 'ok'
    END AS reason
  FROM awk_requests r
  LEFT JOIN jobs_plain j ON j.server_id = r.server_id AND lower(j.job_name) = lower(rtrim(r.job_name))
  LEFT JOIN awk_plain_facts f ON f.server_id = j.server_id AND f.job_id = j.job_id
  LEFT JOIN awk_configs c ON c.server_id = r.server_id AND c.name = lower(r.config_name)
),
awk_installed_facts AS (
  SELECT server_id, job_id, count(*) AS n, count(DISTINCT step_id) AS ids, min(step_id) AS first, max(step_id) AS last,
    max(CASE WHEN step_id = 1 AND lower(step_name) = lower($GUARD_STEP_1_NAME) THEN 1 END) AS guard_1,
    max(CASE WHEN step_id = 2 AND lower(step_name) = lower($GUARD_STEP_2_NAME) THEN 1 END) AS guard_2,
    max(CASE WHEN step_id > 2 AND (target IN (1, 2) OR on_fail_step_id IN (1, 2)) THEN 1
      WHEN step_id = 1 AND target < 3 THEN 1 END) AS dangling
  FROM (
    SELECT server_id, job_id, CASE WHEN job_id % 43 = 7 AND step_id = 4 THEN 3 ELSE step_id END AS step_id, step_name,
      CASE WHEN job_id % 23 = 9 AND step_id = 3 THEN 1 ELSE on_success_step_id END AS target, on_fail_step_id
    FROM steps_installed WHERE NOT (job_id % 41 = 5 AND step_id = 3)
  ) GROUP BY ALL
)
