-- Outcome of the install checks on plain and guarded jobs and of the removal check.
guard_rows AS (
  SELECT server_id, job_id, step_id, step_name, on_success_step_id,
    split_part(split_part(command, $CONFIG_MARKER, 2), '''', 1) AS config_name
  FROM steps_installed
  WHERE (step_id = 1 AND lower(step_name) = lower($GUARD_STEP_1_NAME))
     OR (step_id = 2 AND lower(step_name) = lower($GUARD_STEP_2_NAME))
),
removal AS (
  SELECT j.server_id, j.job_id, j.job_name,
    CASE
      WHEN NOT EXISTS (SELECT 1 FROM guard_rows g
        WHERE g.server_id = j.server_id AND g.job_id = j.job_id AND g.step_id = 1) THEN 'bad_step_1'
      WHEN NOT EXISTS (SELECT 1 FROM guard_rows g
        WHERE g.server_id = j.server_id AND g.job_id = j.job_id AND g.step_id = 2) THEN 'bad_step_2'
      WHEN j.start_step_id <> 1 THEN 'bad_start'
      ELSE 'ok'
    END AS reason
  FROM jobs_installed j
),
request_base AS (
  SELECT r.server_id, r.job_name, r.config_name, j.job_id,
    EXISTS (SELECT 1 FROM run_config c WHERE c.server_id = r.server_id
      AND lower(c.config_name) = lower(r.config_name)) AS has_config
  FROM requests r
  LEFT JOIN jobs_plain j ON j.server_id = r.server_id AND lower(j.job_name) = lower(r.job_name)
),
plain_checked AS (
  SELECT server_id, job_name, config_name, job_id,
    CASE
      WHEN job_id IS NULL THEN 'missing_job'
      WHEN NOT EXISTS (SELECT 1 FROM steps_plain s
        WHERE s.server_id = b.server_id AND s.job_id = b.job_id) THEN 'no_steps'
      WHEN NOT has_config THEN 'missing_config'
      ELSE 'ok'
    END AS reason
  FROM request_base b
),
guarded_checked AS (
  SELECT b.server_id, b.job_name, b.config_name, b.job_id,
    CASE
      WHEN b.job_id IS NULL THEN 'missing_job'
      WHEN NOT EXISTS (SELECT 1 FROM steps_installed s
        WHERE s.server_id = b.server_id AND s.job_id = b.job_id) THEN 'no_steps'
      WHEN NOT b.has_config THEN 'missing_config'
      WHEN d.reason <> 'bad_step_1' THEN d.reason
      ELSE 'ok'
    END AS reason,
    coalesce(d.reason <> 'bad_step_1', FALSE) AS guarded
  FROM request_base b
  LEFT JOIN removal d ON d.server_id = b.server_id AND d.job_id = b.job_id
),
-- Guarded jobs whose guard is taken off first, and their tables without it.
bared AS (
  SELECT server_id, job_id FROM guarded_checked WHERE reason = 'ok' AND guarded
),
bare_steps AS (
  SELECT s.server_id, s.job_id, s.step_id - CASE WHEN b.job_id IS NULL THEN 0 ELSE 2 END AS step_id,
    s.step_name, s.subsystem, s.command, s.on_success_action,
    CASE WHEN b.job_id IS NULL OR s.on_success_step_id = 0 THEN s.on_success_step_id
      ELSE s.on_success_step_id - 2 END AS on_success_step_id,
    s.on_fail_action,
    CASE WHEN b.job_id IS NULL OR s.on_fail_step_id = 0 THEN s.on_fail_step_id
      ELSE s.on_fail_step_id - 2 END AS on_fail_step_id,
    s.database_name
  FROM steps_installed s
  LEFT JOIN bared b USING (server_id, job_id)
  WHERE b.job_id IS NULL OR s.step_id > 2
),
bare_jobs AS (
  SELECT j.server_id, j.job_id, j.job_name,
    CASE WHEN b.job_id IS NULL THEN j.start_step_id ELSE g.on_success_step_id - 2 END AS start_step_id
  FROM jobs_installed j
  LEFT JOIN bared b USING (server_id, job_id)
  LEFT JOIN guard_rows g ON g.server_id = j.server_id AND g.job_id = j.job_id AND g.step_id = 1
),
-- Run states: role of each database on its own server, then the state of each config.
own_roles AS (
  SELECT d.server_id, d.database_id, d.database_name, max(s.role_desc) AS role_desc,
    CAST(count(*) AS INT) AS role_rows
  FROM databases d
  JOIN db_replica_states r ON r.server_id = d.server_id AND r.database_id = d.database_id
  JOIN replica_states s ON s.server_id = r.server_id AND s.replica_id = r.replica_id
    AND s.group_id = r.group_id
  WHERE r.is_local
  GROUP BY ALL
),
asked AS (
  SELECT q.server_id, q.job_name, q.config_name, c.driver_database, c.run_if_ungrouped,
    d.database_id, o.role_desc
  FROM requests q
  LEFT JOIN run_config c ON c.server_id = q.server_id
    AND lower(c.config_name) = lower(q.config_name)
  LEFT JOIN databases d ON d.server_id = c.server_id
    AND lower(d.database_name) = lower(c.driver_database)
  LEFT JOIN own_roles o ON o.server_id = d.server_id AND o.database_id = d.database_id
)
