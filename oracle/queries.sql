-- query: guard_config_name
SELECT server_id, job_id, step_id, config_name FROM guard_rows

-- query: guard_steps_found
SELECT j.server_id, j.job_id, j.job_name, j.start_step_id,
  g1.step_name AS guard_1_name, g2.step_name AS guard_2_name,
  g1.config_name AS config_name, g2.config_name AS config_name_step_2,
  FALSE AS guard_1_unreadable, FALSE AS guard_2_unreadable,
  CASE WHEN g1.job_id IS NULL THEN j.start_step_id ELSE g1.on_success_step_id END AS real_start_step_id
FROM jobs_installed j
LEFT JOIN (FROM guard_rows WHERE step_id = 1) g1 USING (server_id, job_id)
LEFT JOIN (FROM guard_rows WHERE step_id = 2) g2 USING (server_id, job_id)

-- query: guard_audit
SELECT v.server_id, v.job_id, v.job_name,
  CASE
    WHEN v.c1 IS NULL THEN $STATUS_NOT_SET_UP
    WHEN v.start_step_id <> 1 THEN $STATUS_BYPASSED
    WHEN c.config_name IS NULL THEN $STATUS_CONFIG_MISSING
    WHEN lower(v.c1) IS DISTINCT FROM lower(v.c2) THEN $STATUS_NOT_SAME_CONFIG
    ELSE $STATUS_CONFIGURED
  END AS status,
  v.c1 AS config_name, c.driver_database, c.run_if_ungrouped, v.real_start_step_id,
  s.step_name AS real_start_step_name, s.subsystem AS real_start_subsystem,
  s.database_name AS real_start_database_name, s.command AS real_start_command
FROM (
  SELECT j.*, g.c1, g.c2, coalesce(g.t1, j.start_step_id) AS real_start_step_id
  FROM jobs_installed j
  LEFT JOIN (
    SELECT server_id, job_id,
      max(config_name) FILTER (WHERE step_id = 1) AS c1,
      max(config_name) FILTER (WHERE step_id = 2) AS c2,
      max(on_success_step_id) FILTER (WHERE step_id = 1) AS t1
    FROM guard_rows GROUP BY ALL
  ) g USING (server_id, job_id)
) v
LEFT JOIN run_config c ON c.server_id = v.server_id AND lower(c.config_name) = lower(v.c1)
LEFT JOIN steps_installed s ON s.server_id = v.server_id AND s.job_id = v.job_id
  AND s.step_id = v.real_start_step_id

-- query: local_replica_role
SELECT server_id, database_id, database_name, role_desc, role_rows, FALSE AS ambiguous
FROM own_roles

-- query: config_check
SELECT server_id, job_name, config_name, driver_database,
  CASE WHEN driver_database IS NULL THEN 'config_missing'
    WHEN database_id IS NULL THEN 'database_missing' ELSE 'ok' END AS reason,
  driver_database IS NOT NULL AND database_id IS NOT NULL AS passed
FROM asked

-- query: run_decision
SELECT *, reason = 'ok' AS runs FROM (
  SELECT server_id, job_name, config_name, driver_database, role_desc,
    CASE WHEN driver_database IS NULL THEN 'config_missing'
      WHEN database_id IS NULL THEN 'database_missing'
      WHEN role_desc = 'PRIMARY' THEN 'ok'
      WHEN role_desc IS NULL AND run_if_ungrouped THEN 'ok'
      ELSE 'not_here' END AS reason
  FROM asked
)

-- query: run_decision_as_written
SELECT *, reason = 'ok' AS runs FROM (
  SELECT server_id, job_name, config_name, driver_database, role_desc,
    CASE WHEN driver_database IS NULL THEN 'config_missing'
      WHEN database_id IS NULL THEN 'database_missing'
      WHEN NOT (role_desc = 'PRIMARY' OR (role_desc IS NULL AND run_if_ungrouped)) THEN 'not_here'
      ELSE 'ok' END AS reason
  FROM asked
)

-- query: run_outcome
SELECT server_id, job_name, config_name,
  CASE WHEN driver_database IS NULL OR database_id IS NULL THEN 'failed'
    WHEN role_desc = 'PRIMARY' OR (role_desc IS NULL AND run_if_ungrouped) THEN 'run'
    ELSE 'skipped' END AS outcome
FROM asked

-- query: run_outcome_where_guarded
SELECT a.server_id, job_name, config_name,
  CASE WHEN NOT EXISTS (SELECT 1 FROM databases h
      WHERE h.server_id = a.server_id AND h.database_name = 'DB_0') THEN 'failed'
    WHEN driver_database IS NULL OR database_id IS NULL THEN 'failed'
    WHEN role_desc = 'PRIMARY' OR (role_desc IS NULL AND run_if_ungrouped) THEN 'run'
    ELSE 'skipped' END AS outcome
FROM asked a

-- query: status_check
SELECT *, reason = 'ok' AS passed FROM (
  SELECT g.server_id, g.job_id, g.step_id, g.config_name,
    CASE WHEN c.config_name IS NULL THEN 'config_missing'
      WHEN d.database_id IS NULL THEN 'database_missing'
      WHEN g.step_id = 1 AND (o.role_desc = 'PRIMARY'
        OR (o.role_desc IS NULL AND c.run_if_ungrouped)) IS NOT TRUE THEN 'not_here'
      ELSE 'ok' END AS reason
  FROM guard_rows g
  LEFT JOIN run_config c ON c.server_id = g.server_id
    AND lower(c.config_name) = lower(g.config_name)
  LEFT JOIN databases d ON d.server_id = c.server_id
    AND lower(d.database_name) = lower(c.driver_database)
  LEFT JOIN own_roles o ON o.server_id = d.server_id AND o.database_id = d.database_id
)

-- query: requests_empty
SELECT count(*) = 0 AS is_empty FROM requests

-- query: requests_duplicate_jobs
SELECT server_id, lower(job_name) AS job_name_key, count(*) AS n_requests
FROM (
  SELECT server_id, job_name FROM requests
  UNION ALL SELECT server_id, job_name FROM jobs_plain WHERE start_step_id = 2
)
GROUP BY ALL HAVING count(*) > 1

-- query: requests_missing_jobs
SELECT server_id, job_name FROM requests r
WHERE NOT EXISTS (SELECT 1 FROM jobs_plain j
  WHERE j.server_id = r.server_id AND lower(j.job_name) = lower(r.job_name))

-- query: requests_jobs_without_steps
SELECT r.server_id, r.job_name FROM requests r
JOIN jobs_plain j ON j.server_id = r.server_id AND lower(j.job_name) = lower(r.job_name)
WHERE NOT EXISTS (SELECT 1 FROM steps_plain s
  WHERE s.server_id = j.server_id AND s.job_id = j.job_id)

-- query: requests_missing_configs
SELECT server_id, job_name, config_name FROM requests r
WHERE NOT EXISTS (SELECT 1 FROM run_config c
  WHERE c.server_id = r.server_id AND lower(c.config_name) = lower(r.config_name))

-- query: install_check
SELECT server_id, job_name, config_name, job_id, reason FROM plain_checked

-- query: reinstall_check
SELECT server_id, job_name, config_name, job_id, reason FROM guarded_checked

-- query: install_worklist
SELECT j.server_id, j.job_id, r.job_name, r.config_name,
  lower(s.step_name) = lower($GUARD_STEP_1_NAME) AS requires_drop
FROM requests r
JOIN jobs_installed j ON j.server_id = r.server_id AND lower(j.job_name) = lower(r.job_name)
JOIN steps_installed s ON s.server_id = j.server_id AND s.job_id = j.job_id AND s.step_id = 1

-- query: shift_flow
SELECT server_id, job_id, step_id + 2 AS step_id, step_name, subsystem, command,
  on_success_action,
  CASE on_success_step_id WHEN 0 THEN 0 ELSE on_success_step_id + 2 END AS on_success_step_id,
  on_fail_action,
  CASE on_fail_step_id WHEN 0 THEN 0 ELSE on_fail_step_id + 2 END AS on_fail_step_id,
  database_name
FROM steps_plain

-- query: install_guard_steps
SELECT s.server_id, s.job_id, CASE WHEN p.job_id IS NULL THEN step_id ELSE step_id + 2 END AS step_id,
  step_name, subsystem, command, on_success_action,
  CASE WHEN p.job_id IS NULL OR on_success_step_id = 0 THEN on_success_step_id
    ELSE on_success_step_id + 2 END AS on_success_step_id,
  on_fail_action,
  CASE WHEN p.job_id IS NULL OR on_fail_step_id = 0 THEN on_fail_step_id
    ELSE on_fail_step_id + 2 END AS on_fail_step_id,
  database_name
FROM steps_plain s
LEFT JOIN (FROM plain_checked WHERE reason = 'ok') p USING (server_id, job_id)
UNION ALL
SELECT p.server_id, p.job_id, 1, $GUARD_STEP_1_NAME, 'TSQL',
  concat($GUARD_COMMAND_HEAD, '1 , ', $CONFIG_MARKER, p.config_name, $GUARD_COMMAND_TAIL),
  4, j.start_step_id + 2, 4, 2, 'DBA'
FROM plain_checked p JOIN jobs_plain j USING (server_id, job_id) WHERE p.reason = 'ok'
UNION ALL
SELECT p.server_id, p.job_id, 2, $GUARD_STEP_2_NAME, 'TSQL',
  concat($GUARD_COMMAND_HEAD, '2 , ', $CONFIG_MARKER, p.config_name, $GUARD_COMMAND_TAIL),
  1, 0, 2, 0, 'DBA'
FROM plain_checked p WHERE p.reason = 'ok'

-- query: install_job_starts
SELECT server_id, job_id, j.job_name,
  CASE WHEN (j.server_id, j.job_id) IN (
    SELECT (server_id, job_id) FROM plain_checked WHERE reason = 'ok'
  ) THEN 1 ELSE j.start_step_id END AS start_step_id
FROM jobs_plain j

-- query: install_preview
SELECT j.server_id, j.job_id, r.job_name, j.start_step_id, s.step_id, s.step_name, s.subsystem,
  s.command, s.on_success_action, s.on_success_step_id, s.on_fail_action, s.on_fail_step_id,
  s.database_name, 'before' AS phase
FROM requests r
JOIN jobs_plain j ON j.server_id = r.server_id AND lower(j.job_name) = lower(r.job_name)
LEFT JOIN steps_plain s ON s.server_id = j.server_id AND s.job_id = j.job_id
UNION ALL
SELECT p.server_id, p.job_id, p.job_name, CASE p.reason WHEN 'ok' THEN 1 ELSE j.start_step_id END,
  CASE p.reason WHEN 'ok' THEN step_id + 2 ELSE step_id END, step_name, subsystem, command,
  on_success_action,
  CASE WHEN p.reason = 'ok' AND on_success_step_id > 0 THEN on_success_step_id + 2
    ELSE on_success_step_id END,
  on_fail_action,
  CASE WHEN p.reason = 'ok' AND on_fail_step_id > 0 THEN on_fail_step_id + 2
    ELSE on_fail_step_id END,
  database_name, 'after'
FROM plain_checked p
JOIN jobs_plain j USING (server_id, job_id)
LEFT JOIN steps_plain s USING (server_id, job_id)
UNION ALL
SELECT p.server_id, p.job_id, p.job_name, 1, n.n,
  CASE n.n WHEN 1 THEN $GUARD_STEP_1_NAME ELSE $GUARD_STEP_2_NAME END, 'TSQL',
  concat($GUARD_COMMAND_HEAD, CAST(n.n AS VARCHAR), ' , ', $CONFIG_MARKER, p.config_name,
    $GUARD_COMMAND_TAIL),
  CASE n.n WHEN 1 THEN 4 ELSE 1 END, CASE n.n WHEN 1 THEN j.start_step_id + 2 ELSE 0 END,
  CASE n.n WHEN 1 THEN 4 ELSE 2 END, CASE n.n WHEN 1 THEN 2 ELSE 0 END, 'DBA', 'after'
FROM plain_checked p
JOIN jobs_plain j USING (server_id, job_id)
CROSS JOIN (VALUES (1), (2)) n(n)
WHERE p.reason = 'ok'

-- query: remove_check
SELECT server_id, job_name, job_id, reason FROM removal

-- query: remove_guard_steps
SELECT s.server_id, s.job_id, s.step_id - coalesce(k.k, 0) AS step_id, s.step_name, s.subsystem,
  s.command, s.on_success_action,
  CASE WHEN s.on_success_step_id = 0 THEN 0
    ELSE s.on_success_step_id - coalesce(k.k, 0) END AS on_success_step_id,
  s.on_fail_action,
  CASE WHEN s.on_fail_step_id = 0 THEN 0
    ELSE s.on_fail_step_id - coalesce(k.k, 0) END AS on_fail_step_id,
  s.database_name
FROM steps_installed s
LEFT JOIN (
  SELECT j.server_id, j.job_id, 2 AS k
  FROM jobs_installed j
  JOIN (
    SELECT server_id, job_id FROM guard_rows GROUP BY server_id, job_id HAVING count(*) = 2
  ) g ON g.server_id = j.server_id AND g.job_id = j.job_id
  WHERE j.start_step_id = 1 AND j.job_id % 4 <> 0
) k ON k.server_id = s.server_id AND k.job_id = s.job_id
WHERE k.k IS NULL OR s.step_id > 2

-- query: remove_job_starts
SELECT j.server_id, j.job_id, j.job_name,
  coalesce(t.on_success_step_id - 2, j.start_step_id) AS start_step_id
FROM jobs_installed j
LEFT JOIN (
  SELECT g.server_id, g.job_id, g.on_success_step_id FROM guard_rows g
  JOIN removal d USING (server_id, job_id)
  JOIN request_base b ON b.server_id = g.server_id AND b.job_id = g.job_id
  WHERE d.reason = 'ok' AND g.step_id = 1
) t ON t.server_id = j.server_id AND t.job_id = j.job_id

-- query: reinstall_guard_steps
SELECT s.server_id, s.job_id, CASE WHEN p.job_id IS NULL THEN step_id ELSE step_id + 2 END AS step_id,
  step_name, subsystem, command, on_success_action,
  CASE WHEN p.job_id IS NULL OR on_success_step_id = 0 THEN on_success_step_id
    ELSE on_success_step_id + 2 END AS on_success_step_id,
  on_fail_action,
  CASE WHEN p.job_id IS NULL OR on_fail_step_id = 0 THEN on_fail_step_id
    ELSE on_fail_step_id + 2 END AS on_fail_step_id,
  database_name
FROM bare_steps s
LEFT JOIN (FROM guarded_checked WHERE reason = 'ok') p USING (server_id, job_id)
UNION ALL
SELECT p.server_id, p.job_id, 1, $GUARD_STEP_1_NAME, 'TSQL',
  concat($GUARD_COMMAND_HEAD, '1 , ', $CONFIG_MARKER, p.config_name, $GUARD_COMMAND_TAIL),
  4, j.start_step_id + 2, 4, 2, 'DBA'
FROM guarded_checked p JOIN bare_jobs j USING (server_id, job_id) WHERE p.reason = 'ok'
UNION ALL
SELECT p.server_id, p.job_id, 2, $GUARD_STEP_2_NAME, 'TSQL',
  concat($GUARD_COMMAND_HEAD, '2 , ', $CONFIG_MARKER, p.config_name, $GUARD_COMMAND_TAIL),
  1, 0, 2, 0, 'DBA'
FROM guarded_checked p WHERE p.reason = 'ok'

-- query: reinstall_job_starts
SELECT j.server_id, j.job_id, j.job_name,
  CASE WHEN p.reason = 'ok' THEN 1 ELSE j.start_step_id END AS start_step_id
FROM jobs_installed j
LEFT JOIN guarded_checked p USING (server_id, job_id)

-- query: grantees
SELECT event_id, server_id, grantee
FROM (
  SELECT *, unnest(regexp_extract_all(event_xml, '<Grantee>([^<]*)</Grantee>', 1)) AS grantee
  FROM grant_events
  WHERE regexp_extract(event_xml, '<EventType>([^<]*)</EventType>', 1) = 'GRANT_DATABASE'
)
WHERE grantee <> ''

-- query: direct_grants
SELECT event_id, server_id FROM grant_events e
WHERE event_xml LIKE '%<EventType>GRANT_DATABASE</EventType>%'
  AND EXISTS (
    SELECT 1 FROM principals p
    WHERE p.principal_type IN ('S', 'U') AND p.server_id = e.server_id
      AND list_contains(
        regexp_extract_all(lower(e.event_xml), '<grantee>([^<]*)</grantee>', 1),
        lower(p.principal_name))
  )

-- query: refused_grants
SELECT DISTINCT e.event_id, e.server_id, $GRANT_REFUSED AS message
FROM (
  SELECT event_id, server_id,
    unnest(regexp_extract_all(event_xml, '<Grantee>([^<]*)</Grantee>', 1)) AS grantee
  FROM grant_events
  WHERE event_xml LIKE '%<EventType>GRANT_DATABASE</EventType>%'
) e
JOIN principals p ON p.server_id = e.server_id AND lower(p.principal_name) = lower(e.grantee)
WHERE p.principal_type IN ('S', 'U')

-- query: objects_like
SELECT server_id, object_name FROM objects
WHERE object_type = 'IT' AND object_name ILIKE 'FullText%'

-- query: objects_missing
SELECT server_id, object_name FROM expected_objects x
WHERE NOT EXISTS (SELECT 1 FROM objects o WHERE o.object_type = 'IT'
  AND o.server_id = x.server_id AND lower(o.object_name) = lower(x.object_name))

-- query: guard_audit_awkward
SELECT v.server_id, v.job_id, v.job_name,
  CASE
    WHEN v.g1 IS NULL THEN $STATUS_NOT_SET_UP
    WHEN v.start_step_id <> 1 THEN $STATUS_BYPASSED
    WHEN v.job_id % 7 = 1 THEN $STATUS_UNREADABLE
    WHEN c.n IS NULL THEN $STATUS_CONFIG_MISSING
    WHEN c.n > 1 THEN $STATUS_CONFIG_AMBIGUOUS
    WHEN lower(v.c1) IS DISTINCT FROM lower(v.c2) THEN $STATUS_NOT_SAME_CONFIG
    ELSE $STATUS_CONFIGURED
  END AS status,
  v.c1 AS config_name, c.driver_database, c.run_if_ungrouped, v.real_start_step_id,
  s.step_name AS real_start_step_name, s.subsystem AS real_start_subsystem,
  s.database_name AS real_start_database_name, CASE WHEN s.step_id IN (1, 2) AND s.job_id % 7 = 1 THEN 'no config' ELSE s.command END AS real_start_command
FROM (
  SELECT j.*, g.g1, g.c1, g.c2, coalesce(g.t1, j.start_step_id) AS real_start_step_id
  FROM jobs_installed j
  LEFT JOIN (
    SELECT server_id, job_id, max(step_name) FILTER (WHERE step_id = 1) AS g1,
      max(config_name) FILTER (WHERE step_id = 1 AND job_id % 7 <> 1) AS c1,
      max(config_name) FILTER (WHERE step_id = 2 AND job_id % 7 <> 1) AS c2,
      max(on_success_step_id) FILTER (WHERE step_id = 1) AS t1
    FROM guard_rows GROUP BY ALL
  ) g USING (server_id, job_id)
) v
LEFT JOIN awk_configs c ON c.server_id = v.server_id AND c.name = lower(v.c1)
LEFT JOIN steps_installed s ON s.server_id = v.server_id AND s.job_id = v.job_id
  AND s.step_id = v.real_start_step_id

-- query: local_replica_role_awkward
SELECT server_id, database_id, database_name, role_desc, role_rows, ambiguous FROM awk_roles

-- query: run_decision_awkward
SELECT *, reason = 'ok' AS runs FROM (
  SELECT q.server_id, q.job_name, q.config_name, c.driver_database, c.role_desc,
    CASE WHEN c.n > 1 THEN 'ambiguous_config'
      WHEN c.driver_database IS NULL THEN 'config_missing'
      WHEN c.database_id IS NULL THEN 'database_missing'
      WHEN c.databases > 1 THEN 'ambiguous_database'
      WHEN c.ambiguous THEN 'ambiguous_role'
      WHEN c.role_desc = 'PRIMARY' THEN 'ok'
      WHEN c.role_desc IS NULL AND c.run_if_ungrouped THEN 'ok'
      ELSE 'not_here' END AS reason
  FROM awk_requests q
  LEFT JOIN awk_states c ON c.server_id = q.server_id AND c.name = lower(rtrim(q.config_name))
)

-- query: status_check_awkward
SELECT *, reason = 'ok' AS passed FROM (
  SELECT g.server_id, g.job_id, g.step_id, g.config_name,
    CASE WHEN g.step_id > 2 THEN 'bad_step_id'
      WHEN c.n > 1 THEN 'ambiguous_config'
      WHEN c.driver_database IS NULL THEN 'config_missing'
      WHEN c.database_id IS NULL THEN 'database_missing'
      WHEN c.databases > 1 THEN 'ambiguous_database'
      WHEN g.step_id = 1 AND c.ambiguous THEN 'ambiguous_role'
      WHEN g.step_id = 1 AND (c.role_desc = 'PRIMARY'
        OR (c.role_desc IS NULL AND c.run_if_ungrouped)) IS NOT TRUE THEN 'not_here'
      ELSE 'ok' END AS reason
  FROM (
    SELECT server_id, job_id, CASE WHEN job_id % 3 = 0 THEN step_id + 1 ELSE step_id END AS step_id,
      CASE WHEN job_id % 7 <> 1 THEN config_name END AS config_name
    FROM guard_rows
  ) g
  LEFT JOIN awk_states c ON c.server_id = g.server_id AND c.name = lower(g.config_name)
)

-- query: install_check_awkward
SELECT server_id, job_name, config_name, job_id, reason FROM awk_checked

-- query: install_job_starts_awkward
SELECT j.server_id, j.job_id, j.job_name,
  CASE WHEN c.job_id IS NULL THEN j.start_step_id ELSE 1 END AS start_step_id
FROM jobs_plain j
LEFT JOIN (FROM awk_checked WHERE reason = 'ok') c ON c.server_id = j.server_id AND c.job_id = j.job_id

-- query: remove_check_awkward
SELECT r.server_id, r.job_name, j.job_id,
  CASE
    WHEN j.job_id IS NULL THEN 'missing_job'
    WHEN f.guard_1 IS NULL THEN 'bad_step_1'
    WHEN f.guard_2 IS NULL THEN 'bad_step_2'
    WHEN j.start_step_id <> 1 THEN 'bad_start'
    WHEN f.dangling = 1 THEN 'dangling_target'
    WHEN f.ids < f.n THEN 'repeated_steps'
    WHEN f.first <> 1 OR f.last <> f.n THEN 'step_gaps'
    ELSE 'ok'
  END AS reason
FROM (
  SELECT server_id, job_name FROM jobs_installed
  UNION ALL SELECT server_id, job_name FROM requests WHERE job_name = 'No such job'
) r
LEFT JOIN jobs_installed j ON j.server_id = r.server_id AND j.job_name = r.job_name
LEFT JOIN awk_installed_facts f ON f.server_id = j.server_id AND f.job_id = j.job_id

-- query: install_full_steps
SELECT s.server_id, s.job_id, CASE WHEN p.job_id IS NULL THEN step_id ELSE step_id + 2 END AS step_id,
  step_name, subsystem, command, on_success_action,
  CASE WHEN p.job_id IS NULL OR on_success_step_id = 0 THEN on_success_step_id
    ELSE on_success_step_id + 2 END AS on_success_step_id,
  on_fail_action,
  CASE WHEN p.job_id IS NULL OR on_fail_step_id = 0 THEN on_fail_step_id
    ELSE on_fail_step_id + 2 END AS on_fail_step_id,
  database_name,
  s.step_id + 5 AS flags,
  concat('additional_parameters ', CAST(s.step_id AS VARCHAR)) AS additional_parameters,
  s.step_id + 20 AS cmdexec_success_code,
  concat('server ', CAST(s.step_id AS VARCHAR)) AS server,
  concat('database_user_name ', CAST(s.step_id AS VARCHAR)) AS database_user_name,
  s.step_id + 14 AS retry_attempts,
  s.step_id + 14 AS retry_interval,
  s.step_id + 15 AS os_run_priority,
  concat('output_file_name ', CAST(s.step_id AS VARCHAR)) AS output_file_name,
  s.step_id + 8 AS proxy_id,
  CASE WHEN p.job_id IS NULL THEN s.step_id + 16 END AS last_run_outcome,
  CASE WHEN p.job_id IS NULL THEN s.step_id + 17 END AS last_run_duration,
  CASE WHEN p.job_id IS NULL THEN s.step_id + 16 END AS last_run_retries,
  CASE WHEN p.job_id IS NULL THEN s.step_id + 13 END AS last_run_date,
  CASE WHEN p.job_id IS NULL THEN s.step_id + 13 END AS last_run_time,
  CASE WHEN p.job_id IS NULL THEN concat('step_uid ', CAST(s.step_id AS VARCHAR)) END AS step_uid
FROM steps_plain s
LEFT JOIN (FROM plain_checked WHERE reason = 'ok') p USING (server_id, job_id)
UNION ALL
SELECT p.server_id, p.job_id, 1, $GUARD_STEP_1_NAME, 'TSQL',
  concat($GUARD_COMMAND_HEAD, '1 , ', $CONFIG_MARKER, p.config_name, $GUARD_COMMAND_TAIL),
  4, j.start_step_id + 2, 4, 2, 'DBA', 0, NULL, 0, NULL, NULL, 0, 0, 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM plain_checked p JOIN jobs_plain j USING (server_id, job_id) WHERE p.reason = 'ok'
UNION ALL
SELECT p.server_id, p.job_id, 2, $GUARD_STEP_2_NAME, 'TSQL',
  concat($GUARD_COMMAND_HEAD, '2 , ', $CONFIG_MARKER, p.config_name, $GUARD_COMMAND_TAIL),
  1, 0, 2, 0, 'DBA', 0, NULL, 0, NULL, NULL, 0, 0, 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM plain_checked p WHERE p.reason = 'ok'

-- query: direct_grants_awkward
SELECT event_id, server_id FROM awk_events e
WHERE event_id % 40 <> 3 AND event_id % 97 <> 5
  AND event_xml LIKE '%<EventType>GRANT_DATABASE</EventType>%'
  AND EXISTS (
    SELECT 1 FROM awk_principals p
    WHERE upper(rtrim(p.principal_type)) IN ('S', 'U') AND p.server_id = e.server_id
      AND list_contains(
        regexp_extract_all(lower(e.event_xml), '<grantee>([^<]*)</grantee>', 1),
        lower(p.principal_name))
  )

-- query: broken_events
SELECT event_id, server_id, event_xml FROM awk_events WHERE event_id % 40 = 3 OR event_id % 97 = 5

-- query: broken_events_stream
SELECT event_id, server_id, event_xml FROM awk_events WHERE event_id % 40 = 3 OR event_id % 97 = 5

-- query: objects_like_awkward
SELECT server_id, object_name FROM awk_objects
WHERE upper(rtrim(object_type)) = 'IT' AND object_name ILIKE 'FullText%'

-- query: objects_missing_awkward
SELECT server_id, object_name FROM expected_objects x
WHERE NOT EXISTS (SELECT 1 FROM awk_objects o WHERE upper(rtrim(o.object_type)) = 'IT'
  AND o.server_id = x.server_id AND lower(o.object_name) = lower(x.object_name))
