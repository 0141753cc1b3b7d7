"""ANSI SQL, for DuckDB, that states the expected result of each registered query."""

from __future__ import annotations

ATTACKS = "('brute_force_attempt','malware_alert','suspicious_ip_activity','privilege_escalation')"

_BRONZE = f"""
base AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k
  FROM events),
typed AS (
  SELECT *,
    CASE event_type
      WHEN 'error'  THEN CASE WHEN k % 2 = 0 THEN 'failed_login'     ELSE 'brute_force_attempt' END
      WHEN 'click'  THEN CASE WHEN k % 2 = 0 THEN 'successful_login' ELSE 'vpn_login' END
      WHEN 'view'   THEN CASE WHEN k % 2 = 0 THEN 'malware_alert'    ELSE 'suspicious_ip_activity' END
      WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN 'account_lockout'  ELSE 'privilege_escalation' END
      ELSE 'successful_login' END AS etype
  FROM base),
shaped AS (
  SELECT
    concat('ev-', CAST(event_id AS VARCHAR)) AS event_id,
    CASE WHEN k = 94 THEN 'not-a-time' ELSE CAST(ts AS VARCHAR) END AS event_time,
    concat('User_', CAST(user_id AS VARCHAR)) AS username,
    CASE WHEN k = 93 THEN NULL WHEN k = 92 THEN 'bad_ip'
         WHEN k % 5 = 0 THEN concat('10.', CAST(user_id % 256 AS VARCHAR), '.', CAST(k AS VARCHAR), '.7')
         WHEN k % 5 = 1 THEN concat('172.', CAST(8 + k % 30 AS VARCHAR), '.', CAST(user_id % 256 AS VARCHAR), '.9')
         WHEN k % 5 = 2 THEN concat('192.', CASE WHEN k % 2 = 0 THEN '168' ELSE '169' END, '.', CAST(user_id % 256 AS VARCHAR), '.1')
         ELSE concat('203.', CAST(k AS VARCHAR), '.', CAST(user_id % 256 AS VARCHAR), '.5') END AS src_ip,
    CASE WHEN k % 3 = 0 THEN concat('10.0.', CAST(user_id % 256 AS VARCHAR), '.20') END AS destination_ip,
    concat('ws-', CAST(user_id % 50 AS VARCHAR)) AS hostname,
    etype AS event_type,
    CASE WHEN k <= 39 THEN 'low' WHEN k <= 69 THEN 'medium' WHEN k <= 89 THEN 'high'
         WHEN k <= 97 THEN 'critical' WHEN k = 98 THEN 'HIGH' ELSE 'unknown' END AS severity,
    CASE WHEN etype IN ('failed_login','account_lockout') THEN 'failure'
         WHEN etype IN ('successful_login','vpn_login') THEN 'success'
         WHEN k % 2 = 0 THEN 'detected' ELSE 'blocked' END AS status,
    split_part('US,GB,DE,JP,AU,CA,FR,IN,BR,SG,KP,IR', ',', CAST(user_id % 12 + 1 AS INT)) AS country,
    split_part('Windows 11,Windows 10,macOS Sonoma,Ubuntu 22.04,RHEL 9', ',', CAST(user_id % 5 + 1 AS INT)) AS operating_system,
    split_part('IT,Finance,Engineering,HR,Marketing,Sales,Legal,Operations', ',', CAST(user_id % 8 + 1 AS INT)) AS department,
    CASE WHEN etype IN {ATTACKS} OR (etype = 'failed_login' AND k % 10 = 0)
         THEN ts + INTERVAL '1' SECOND * (60 + k * 35) END AS detection_time,
    CASE WHEN etype IN {ATTACKS} AND k % 9 <> 0
         THEN ts + INTERVAL '1' SECOND * (60 + k * 35) + INTERVAL '1' SECOND * (600 + CAST(floor(value * 97) AS INT)) END AS resolution_time,
    CAST(ts AS DATE) AS day, event_id AS n, k
  FROM typed),
versions AS (
  SELECT *, 1 AS v, day AS arrived FROM shaped
  UNION ALL SELECT *, 2 AS v, day + 1 AS arrived FROM shaped WHERE n % 20 = 0),
bronze AS (
  SELECT event_id, event_time,
    CASE WHEN v = 2 THEN concat(username, '_v2') ELSE username END AS username,
    CASE WHEN v = 2 AND k = 10 THEN 'bad_ip' ELSE src_ip END AS src_ip,
    destination_ip, hostname, event_type, severity, status, country, operating_system, department,
    detection_time, resolution_time,
    CAST(arrived AS TIMESTAMP) AS _ingested_at,
    concat('events-', strftime(arrived, '%Y%m%d'), '.jsonl') AS _source_file,
    concat('batch_', strftime(arrived, '%Y%m%d'), '_00', CAST(v AS VARCHAR)) AS _batch_id
  FROM versions)"""

# The rules of Silver, stated by octets and lookup tables.
_RULES = """
ranks(level, place) AS (VALUES ('low', 1), ('medium', 2), ('high', 3), ('critical', 4)),
private_nets AS (SELECT [172, CAST(n AS INT)] AS net FROM range(16, 32) AS r(n) UNION ALL SELECT [192, 168]),
office_hours AS (SELECT list(h) AS open FROM range(9, 17) AS r(h))"""


def refined(name: str, source: str) -> str:
    """CTE ``name``: the rows of ``source`` that Silver accepts, with its derived columns."""
    return f"""
{name}_split AS (
  SELECT *, try_cast(event_time AS TIMESTAMP) AS moment, string_split(src_ip, '.') AS octets FROM {source}),
{name}_numbers AS (
  SELECT * EXCLUDE (octets), list_transform(octets, lambda o: CAST(o AS INT)) AS octet FROM {name}_split
  WHERE moment IS NOT NULL AND len(octets) = 4
    AND list_min(list_transform(octets, lambda o: CASE WHEN length(o) IN (1, 2, 3) AND translate(o, '0123456789', '') = '' THEN 1 ELSE 0 END)) = 1),
{name} AS (
  SELECT e.event_id, e.moment AS event_time, e.detection_time, e.resolution_time, lower(e.username) AS username, e.src_ip,
    e.destination_ip, upper(e.hostname) AS hostname, e.event_type, r.level AS severity, CAST(r.place AS INT) AS severity_rank,
    e.status, e.country, e.operating_system, e.department,
    CAST(date_diff('hour', date_trunc('day', e.moment), e.moment) AS INT) AS hour_of_day, CAST(isodow(e.moment) AS INT) AS day_of_week,
    list_contains(office_hours.open, date_diff('hour', date_trunc('day', e.moment), e.moment)) AS is_business_hours,
    e.octet[1] = 10 OR e.octet[1:2] IN (SELECT net FROM private_nets) AS is_internal_ip,
    e.event_type IN {ATTACKS} AS is_attack_event, e._ingested_at, e._source_file, e._batch_id
  FROM {name}_numbers e JOIN ranks r ON r.level = e.severity, office_hours)"""


def silver_cte(name: str, source: str) -> str:
    """CTEs ``{name}_dedup``, the newest version of each event, and ``{name}`` over the Bronze-shaped ``source``."""
    return f"""
{name}_dedup AS (SELECT DISTINCT ON (event_id) * FROM {source} ORDER BY event_id, _ingested_at DESC),{refined(name, name + "_dedup")}"""


BRONZE = "WITH" + _BRONZE + "," + _RULES
SILVER = BRONZE + "," + silver_cte("silver", "bronze")

# Each distinct count is the number of keys of an intermediate table of its own.
_KEYED = """
hours AS (
  SELECT date_trunc('hour', event_time) AS h, count(*) AS n, sum(CAST(event_type = 'failed_login' AS INT)) AS failed,
    sum(CAST(is_attack_event AS INT)) AS attacks, sum(severity_rank) AS ranks, sum(CAST(severity = 'critical' AS INT)) AS critical,
    sum(CAST(is_business_hours AS INT)) AS inside
  FROM silver GROUP BY ALL),
hour_ips AS (SELECT h, count(*) AS ips FROM (SELECT DISTINCT date_trunc('hour', event_time) AS h, src_ip FROM silver) GROUP BY h),
hour_users AS (SELECT h, count(*) AS users FROM (SELECT DISTINCT date_trunc('hour', event_time) AS h, username FROM silver) GROUP BY h),
hour_countries AS (SELECT h, count(*) AS countries FROM (SELECT DISTINCT date_trunc('hour', event_time) AS h, country FROM silver) GROUP BY h)"""

FEATURES = SILVER + "," + _KEYED + """,
features AS (
  SELECT h AS window_start, h + INTERVAL 60 MINUTES AS window_end, n AS total_event_count, ips AS unique_src_ips,
    users AS unique_users, CAST(failed AS BIGINT) AS failed_login_count, CAST(failed / n AS FLOAT) AS failed_login_ratio,
    CAST(attacks AS BIGINT) AS attack_event_count, ranks / n AS avg_severity_rank,
    CAST(critical AS BIGINT) AS critical_event_count, countries AS unique_countries,
    CAST((n - inside) / n AS FLOAT) AS events_outside_business_hours_ratio
  FROM hours JOIN hour_ips USING (h) JOIN hour_users USING (h) JOIN hour_countries USING (h))"""

# Minutes are microseconds apart, divided; rates come from counts by type.
GOLD = SILVER + """,
types AS (SELECT event_type, count(*) AS n FROM silver GROUP BY event_type),
detected AS (SELECT (epoch_us(detection_time) - epoch_us(event_time)) / 60000000 AS minutes FROM silver WHERE detection_time IS NOT NULL),
resolved AS (SELECT (epoch_us(resolution_time) - epoch_us(detection_time)) / 60000000 AS minutes FROM silver WHERE resolution_time IS NOT NULL),
kpi AS (SELECT
  (SELECT count(*) FROM silver WHERE is_attack_event) AS total_attacks,
  CAST((SELECT n FROM types WHERE event_type = 'failed_login')
    / (SELECT sum(n) FROM types WHERE event_type LIKE '%_login' AND event_type <> 'vpn_login') AS FLOAT) AS failed_login_rate,
  (SELECT round(sum(minutes) / count(*), 6) FROM detected) AS avg_mttd_minutes,
  (SELECT round(sum(minutes) / count(*), 6) FROM resolved) AS avg_mttr_minutes,
  CAST((SELECT count(*) FROM resolved WHERE minutes <= 4 * 60) / (SELECT count(*) FROM resolved) AS FLOAT) AS sla_compliance),
attack_days AS (SELECT CAST(event_time AS DATE) AS d, count(*) AS n FROM silver WHERE is_attack_event GROUP BY d),
by_day AS (
  SELECT now.d AS event_date, now.n AS attack_count, CAST(sum(earlier.n) AS BIGINT) AS cumulative_attack_count
  FROM attack_days now JOIN attack_days earlier ON earlier.d <= now.d GROUP BY now.d, now.n),
attack_countries AS (SELECT country, count(*) AS n FROM silver WHERE is_attack_event GROUP BY country),
by_country AS (SELECT country, n AS attack_count, CAST(n / (SELECT sum(n) FROM attack_countries) AS FLOAT) AS percentage_of_total FROM attack_countries),
of_ip AS (SELECT date_trunc('hour', event_time) AS h, event_type, src_ip, count(*) AS n FROM silver GROUP BY ALL),
of_user AS (SELECT DISTINCT date_trunc('hour', event_time) AS h, event_type, username FROM silver),
hourly AS (
  SELECT i.h AS event_hour, i.event_type, i.n AS event_count, i.ips AS unique_ips, u.users AS unique_users
  FROM (SELECT h, event_type, CAST(sum(n) AS BIGINT) AS n, count(*) AS ips FROM of_ip GROUP BY ALL) i
  JOIN (SELECT h, event_type, count(*) AS users FROM of_user GROUP BY ALL) u USING (h, event_type))"""


def core() -> dict[str, str]:
    """Bronze to Gold."""
    q: dict[str, str] = {}
    q["bridge_bronze"] = BRONZE + " SELECT * FROM bronze"
    q["staging_events"] = BRONZE + """ SELECT event_id, event_time, username, src_ip, destination_ip, hostname, event_type, severity,
      status, country, operating_system, department, detection_time, resolution_time, _ingested_at, _source_file, _batch_id FROM bronze"""
    q["silver_dedup_latest"] = SILVER + " SELECT * FROM silver_dedup"
    q["silver_events"] = SILVER + " SELECT * FROM silver"
    q["kpi_summary"] = GOLD + " SELECT * FROM kpi"
    q["kpi_cards"] = GOLD + """ SELECT MAX(total_attacks) AS total_attacks, MAX(failed_login_rate) AS failed_login_rate,
      MAX(avg_mttd_minutes) AS avg_mttd_minutes, MAX(avg_mttr_minutes) AS avg_mttr_minutes, MAX(sla_compliance) AS sla_compliance FROM kpi"""
    q["attack_volume_by_day"] = GOLD + " SELECT * FROM by_day"
    q["attack_timeline"] = GOLD + " SELECT CAST(event_date AS TIMESTAMP) AS bucket, CAST(SUM(attack_count) AS BIGINT) AS attack_count FROM by_day GROUP BY 1"
    q["attack_volume_by_country"] = GOLD + " SELECT * FROM by_country"
    q["hourly_event_summary"] = GOLD + " SELECT * FROM hourly"
    q["hourly_features"] = FEATURES + " SELECT * REPLACE (ROUND(avg_severity_rank, 6) AS avg_severity_rank) FROM features"
    q["events_by_type"] = SILVER + " SELECT event_type, COUNT(*) AS event_count FROM silver GROUP BY 1"
    q["severity_distribution"] = SILVER + """ SELECT severity, COUNT(*) AS event_count,
      CAST(CAST(COUNT(*) AS DOUBLE) / NULLIF(SUM(COUNT(*)) OVER (), 0) AS FLOAT) AS share FROM silver GROUP BY 1"""
    q["hourly_activity"] = SILVER + " SELECT hour_of_day, COUNT(*) AS event_count FROM silver GROUP BY 1"
    q["top_countries"] = GOLD + " SELECT * FROM by_country ORDER BY attack_count DESC, country LIMIT 10"
    q["top_targeted_users"] = SILVER + """ SELECT username, COUNT(*) AS attack_count FROM silver WHERE is_attack_event
      GROUP BY 1 ORDER BY attack_count DESC, username LIMIT 10"""
    q["attack_severity_distribution"] = SILVER + """ SELECT severity, COUNT(*) AS attack_count,
      CAST(CAST(COUNT(*) AS DOUBLE) / NULLIF(SUM(COUNT(*)) OVER (), 0) AS FLOAT) AS share FROM silver WHERE is_attack_event GROUP BY 1"""
    q["repeat_offender_ips"] = SILVER + """ SELECT src_ip, COUNT(*) AS attack_count, MIN(event_time) AS first_seen, MAX(event_time) AS last_seen
      FROM silver WHERE is_attack_event GROUP BY 1 HAVING COUNT(*) >= 5"""
    q["department_risk_score"] = SILVER + """ SELECT department, COUNT(*) AS attack_count, CAST(SUM(severity_rank) AS BIGINT) AS risk_score
      FROM silver WHERE is_attack_event GROUP BY 1"""
    q["login_failure_by_hour"] = SILVER + " SELECT hour_of_day, COUNT(*) AS failed_logins FROM silver WHERE event_type = 'failed_login' GROUP BY 1"
    q["geographic_anomaly_score"] = SILVER + """,
daily AS (SELECT country, CAST(event_time AS DATE) AS event_date, COUNT(*) AS attack_count FROM silver WHERE is_attack_event GROUP BY 1, 2)
SELECT country, event_date, attack_count,
  ROUND(COALESCE((attack_count - AVG(attack_count) OVER (PARTITION BY country)) / NULLIF(STDDEV_SAMP(attack_count) OVER (PARTITION BY country), 0), 0), 6) AS z_score
FROM daily"""
    q["events_by_category"] = SILVER + """,
mapping(event_type, category, is_attack) AS (VALUES
  ('failed_login','authentication',FALSE), ('successful_login','authentication',FALSE), ('malware_alert','threat',TRUE),
  ('privilege_escalation','threat',TRUE), ('suspicious_ip_activity','threat',TRUE), ('vpn_login','access',FALSE),
  ('account_lockout','authentication',FALSE), ('brute_force_attempt','threat',TRUE))
SELECT category, is_attack, COUNT(*) AS event_count FROM silver JOIN mapping USING (event_type) GROUP BY 1, 2"""
    return q


_AS_TEXT = """event_id, event_time, username, src_ip, destination_ip, hostname, event_type, severity, status, country,
  operating_system, department, CAST(detection_time AS VARCHAR) AS detection_time, CAST(resolution_time AS VARCHAR) AS resolution_time"""


def incremental() -> dict[str, str]:
    """Incremental Silver, upsert, staging of new rows."""
    old = silver_cte("silver", "(SELECT * FROM bronze WHERE _ingested_at <= TIMESTAMP '2024-01-15')")
    new = silver_cte("fresh", "(SELECT * FROM bronze WHERE _ingested_at > (SELECT MAX(_ingested_at) FROM silver))")
    names = "event_id, event_time, username, src_ip, _ingested_at"
    return {
        "silver_incremental": BRONZE + "," + old + "," + new + """
SELECT * FROM silver WHERE event_id NOT IN (SELECT event_id FROM fresh)
UNION ALL SELECT * FROM fresh""",
        "merge_older_last": SILVER + " SELECT * FROM silver_dedup",
        "merge_bucketed": SILVER + " SELECT * FROM silver_dedup",
        "incremental_ingest": BRONZE + f""", firsts AS (SELECT *, CAST(substr(event_id, 4) AS BIGINT) % 2 AS odd FROM bronze WHERE _batch_id LIKE '%\\_001' ESCAPE '\\')
SELECT {_AS_TEXT}, CASE WHEN odd = 0 THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-02-02' END AS _ingested_at FROM firsts""",
        "merge_upsert": BRONZE + f""",
first AS (SELECT {names} FROM bronze WHERE _batch_id LIKE '%\\_001' ESCAPE '\\'),
second AS (SELECT {names} FROM bronze WHERE _batch_id LIKE '%\\_002' ESCAPE '\\')
SELECT * FROM first WHERE event_id NOT IN (SELECT event_id FROM second)
UNION ALL SELECT * FROM second""",
    }


def detectors() -> dict[str, str]:
    q: dict[str, str] = {}
    q["burst_logins"] = SILVER + """,
recent AS (SELECT src_ip, event_time, COUNT(*) OVER (PARTITION BY src_ip ORDER BY event_time
    RANGE BETWEEN INTERVAL 5 DAYS PRECEDING AND CURRENT ROW) AS events_in_window
  FROM silver WHERE event_type = 'failed_login')
SELECT DISTINCT src_ip, event_time, events_in_window FROM recent WHERE events_in_window >= 2"""
    q["burst_sources"] = SILVER + """,
recent AS (SELECT src_ip, event_time, COUNT(*) OVER (PARTITION BY src_ip ORDER BY event_time
    RANGE BETWEEN INTERVAL 5 DAYS PRECEDING AND CURRENT ROW) AS events_in_window
  FROM silver WHERE event_type = 'failed_login')
SELECT src_ip, MIN(event_time) AS first_burst, MAX(event_time) AS last_burst, MAX(events_in_window) AS peak_events
FROM recent WHERE events_in_window >= 2 GROUP BY 1"""
    q["off_hours_escalation"] = SILVER + """
SELECT username, src_ip, COUNT(*) AS escalations, MAX(severity_rank) AS max_severity_rank,
  MIN(event_time) AS first_seen, MAX(event_time) AS last_seen
FROM silver WHERE event_type = 'privilege_escalation' AND NOT is_business_hours GROUP BY 1, 2"""
    q["watchlist_countries"] = SILVER + """
SELECT country, event_type, severity, COUNT(*) AS attack_count, COUNT(DISTINCT src_ip) AS unique_ips, MAX(event_time) AS last_seen
FROM silver WHERE is_attack_event AND country IN ('KP','IR','SY') AND severity IN ('high','critical') GROUP BY 1, 2, 3"""
    q["watchlist_events"] = SILVER + """
SELECT * FROM silver WHERE is_attack_event AND country IN ('KP','IR','SY') AND severity IN ('high','critical')"""
    # The table's users have no second-scale chains: 60 seconds to one day, by country, department and system.
    q["lockout_correlation"] = SILVER + """,
c AS (SELECT event_id, event_type, event_time, country AS username, department AS src_ip, operating_system AS hostname FROM silver)
SELECT l.event_id AS lockout_id, l.username, l.src_ip, l.hostname, l.event_time AS lockout_time,
  MAX(b.event_time) AS last_attempt_time,
  CAST(epoch_us(l.event_time) - epoch_us(MAX(b.event_time)) AS DOUBLE) / 1000000 AS delay_seconds,
  COUNT(*) AS attempt_count
FROM c l JOIN c b ON l.username = b.username AND l.src_ip = b.src_ip AND l.hostname = b.hostname
  AND b.event_time BETWEEN l.event_time - INTERVAL 86400 SECONDS AND l.event_time - INTERVAL 60 SECONDS
WHERE l.event_type = 'account_lockout' AND b.event_type = 'brute_force_attempt'
GROUP BY 1, 2, 3, 4, 5"""
    q["failure_sessions"] = SILVER + """,
f AS (SELECT src_ip, event_time, LAG(event_time) OVER (PARTITION BY src_ip ORDER BY event_time) AS prev FROM silver WHERE event_type = 'failed_login'),
g AS (SELECT src_ip, event_time, SUM(CASE WHEN prev IS NULL OR event_time - prev > INTERVAL 2 DAYS THEN 1 ELSE 0 END)
        OVER (PARTITION BY src_ip ORDER BY event_time) AS session FROM f)
SELECT src_ip, MIN(event_time) AS session_start, MAX(event_time) + INTERVAL 2 DAYS AS session_end, COUNT(*) AS failed_logins
FROM g GROUP BY src_ip, session"""
    return q


_ALLOWED = (
    "['account_lockout', 'brute_force_attempt', 'failed_login', 'malware_alert', "
    "'privilege_escalation', 'successful_login', 'suspicious_ip_activity', 'vpn_login']"
).replace("'", "''")

# The raw lines spelled out from their parts; a line's fields follow from k alone.
RAW = "WITH" + _BRONZE[: _BRONZE.index("shaped AS")].rstrip().rstrip(",") + f""",
parts AS (
  SELECT k,
    CASE WHEN k = 1 THEN NULL WHEN k = 2 THEN '   ' ELSE concat('ev-', CAST(event_id AS VARCHAR)) END AS event_id,
    CASE WHEN k IN (1, 5) THEN NULL ELSE CAST(ts AS VARCHAR) END AS event_time,
    CASE WHEN k = 3 THEN NULL WHEN k = 4 THEN 'Failed_Login' WHEN k = 6 THEN '' ELSE etype END AS event_type,
    concat('user_', CAST(user_id AS VARCHAR)) AS username
  FROM typed WHERE k <> 8),
lines AS (
  SELECT CASE WHEN k = 7 THEN 'this is not json' ELSE concat(
      '{{"event_id":', CASE WHEN event_id IS NULL THEN 'null' ELSE concat('"', event_id, '"') END,
      ',"event_time":', CASE WHEN event_time IS NULL THEN 'null' ELSE concat('"', event_time, '"') END,
      ',"event_type":', CASE WHEN event_type IS NULL THEN 'null' ELSE concat('"', event_type, '"') END,
      ',"username":"', username, '"}}') END AS raw_record,
    CASE WHEN k = 7 THEN NULL ELSE event_id END AS event_id,
    CASE WHEN k = 7 THEN NULL ELSE event_time END AS event_time,
    CASE WHEN k = 7 THEN NULL ELSE event_type END AS event_type,
    username, k
  FROM parts),
judged AS (
  SELECT *, CASE WHEN k = 7 THEN 'JSON parse error: the line is not valid JSON' ELSE concat_ws('; ',
    CASE WHEN event_id IS NULL THEN 'Missing required field: event_id' WHEN trim(event_id) = '' THEN 'Required field is empty: event_id' END,
    CASE WHEN event_time IS NULL THEN 'Missing required field: event_time' WHEN trim(event_time) = '' THEN 'Required field is empty: event_time' END,
    CASE WHEN event_type IS NULL THEN 'Missing required field: event_type' WHEN trim(event_type) = '' THEN 'Required field is empty: event_type'
         WHEN event_type NOT IN ('failed_login','successful_login','malware_alert','privilege_escalation','suspicious_ip_activity',
                                 'vpn_login','account_lockout','brute_force_attempt')
         THEN concat('Invalid event_type: ''', event_type, '''. Must be one of: {_ALLOWED}') END) END AS error_reason
  FROM lines)"""


def ingesting() -> dict[str, str]:
    return {
        "validate_events": RAW + " SELECT raw_record, event_id, error_reason FROM judged",
        "route_valid": RAW + " SELECT event_id, event_time, event_type, username FROM judged WHERE error_reason = ''",
        "route_dead_letter": RAW + """ SELECT CASE WHEN k = 7 THEN 'unknown' ELSE event_id END AS event_id, raw_record, error_reason
          FROM judged WHERE error_reason <> ''""",
        "ingest_jsonl": RAW + """ SELECT event_id, event_time, event_type, username, TIMESTAMP '2024-02-01' AS _ingested_at,
          TRUE AS file_is_named, TRUE AS batch_is_named FROM judged WHERE error_reason = ''""",
        "address_checks": BRONZE + r""" SELECT event_id, _batch_id, src_ip,
          src_ip IS NOT NULL AND regexp_matches(src_ip, '^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$') AS ipv4_shape,
          src_ip IS NOT NULL AND regexp_matches(src_ip, '^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$') AS strict_ipv4,
          regexp_matches(lower(event_id), '^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$') AS uuid_v4
          FROM bronze""",
        "strict_schema": BRONZE + r""" SELECT concat_ws(',',
            CASE WHEN NOT regexp_matches(lower(event_id), '^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$') THEN 'event_id' END,
            CASE WHEN TRY_CAST(event_time AS TIMESTAMP) IS NULL THEN 'event_time' END,
            CASE WHEN src_ip IS NULL OR NOT regexp_matches(src_ip, '^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$') THEN 'src_ip' END,
            CASE WHEN severity NOT IN ('low','medium','high','critical') THEN 'severity' END) AS failing_fields, COUNT(*) AS n
          FROM bronze GROUP BY 1""",
        "internal_ip_split": SILVER + " SELECT is_internal_ip, COUNT(*) AS event_count FROM silver GROUP BY 1",
    }


_FLAGS = FEATURES + """,
results AS (SELECT window_start, attack_event_count >= 4 AS is_anomaly, window_end FROM features),
known AS (SELECT DISTINCT DATE_TRUNC('hour', event_time) AS window_start FROM silver
          WHERE event_type = 'privilege_escalation' AND NOT is_business_hours),
flagged AS (SELECT DISTINCT window_start FROM results WHERE is_anomaly),
counts AS (SELECT
  (SELECT COUNT(*) FROM (SELECT * FROM flagged INTERSECT SELECT * FROM known)) AS tp,
  (SELECT COUNT(*) FROM (SELECT * FROM flagged EXCEPT SELECT * FROM known)) AS fp,
  (SELECT COUNT(*) FROM (SELECT window_start FROM results EXCEPT SELECT * FROM flagged EXCEPT SELECT * FROM known)) AS tn,
  (SELECT COUNT(*) FROM (SELECT * FROM known EXCEPT SELECT * FROM flagged)) AS fn)"""


def models() -> dict[str, str]:
    return {
        "minmax_scores": """SELECT event_id, ROUND((value - MIN(value) OVER ()) * 2.0 / (MAX(value) OVER () - MIN(value) OVER ()) - 1.0, 6) AS score
          , value FROM events""",
        "confusion_matrix": _FLAGS + " SELECT tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives FROM counts",
        "evaluate_anomalies": _FLAGS + """ SELECT
          ROUND(CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 4) AS precision,
          ROUND(CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 4) AS recall,
          CASE WHEN tp + fp = 0 THEN FALSE ELSE CAST(tp AS DOUBLE) / (tp + fp) >= 0.7 END AS precision_meets_target,
          CASE WHEN tp + fn = 0 THEN FALSE ELSE CAST(tp AS DOUBLE) / (tp + fn) >= 0.6 END AS recall_meets_target,
          tp + fp AS n_flagged_windows, tp + fn AS n_true_anomaly_windows, tp AS n_true_positives FROM counts""",
        "anomaly_summary": _FLAGS + """ SELECT COUNT(*) FILTER (WHERE is_anomaly) AS n_anomalies, COUNT(*) AS n_windows,
          ROUND(CAST(COUNT(*) FILTER (WHERE is_anomaly) AS DOUBLE) / COUNT(*) * 100, 2) AS anomaly_percentage,
          MIN(window_start) AS first_window, MAX(window_end) AS last_window FROM results""",
        "iforest_scores": FEATURES + " SELECT window_start, total_event_count, TRUE AS score_agrees, TRUE AS flag_agrees FROM features",
        "response_percentiles": SILVER + """, r AS (SELECT (epoch_us(resolution_time) - epoch_us(detection_time)) / 6e7 AS m FROM silver),
          q AS (SELECT UNNEST([0.0, 0.05, 0.5, 0.95, 1.0])::DOUBLE AS share), s AS (SELECT list_sort(list(m)) AS l, count(m) AS n FROM r WHERE m IS NOT NULL)
          SELECT share, ROUND(l[floor((n - 1) * share)::INT + 1] + ((n - 1) * share - floor((n - 1) * share))
            * (l[ceil((n - 1) * share)::INT + 1] - l[floor((n - 1) * share)::INT + 1]), 6) AS minutes FROM q, s""",
        "iforest_training_cut": FEATURES + " SELECT count(*) AS n_samples, TRUE AS cut_agrees, TRUE AS percentage_agrees FROM features",
        "iforest_growth": FEATURES + """ SELECT CAST(t.tree AS INT) AS tree, LEAST(256, (SELECT count(*) FROM features)) AS n_sampled,
          TRUE AS all_reached, TRUE AS ends_where_due, TRUE AS cuts_in_range, TRUE AS paths_agree FROM range(100) AS t(tree)""",
        "anomaly_gains": FEATURES + " SELECT window_start, TRUE AS gains_agree, TRUE AS largest_is_named FROM features",
        "anomaly_contributions": FEATURES + """ SELECT * REPLACE (round(avg_severity_rank, 6) AS avg_severity_rank), TRUE AS named_where_flagged
          FROM features""",
        "anomaly_top_features": "SELECT TRUE AS some, TRUE AS three_each, TRUE AS first_is_named",
        "anomaly_timeline": FEATURES + " SELECT window_start AS bucket, TRUE AS score_agrees FROM features",
        "iforest_invariants": FEATURES + """ SELECT COUNT(*) AS n_windows, COUNT(DISTINCT window_start) AS n_distinct_windows,
          CAST(-1 AS DOUBLE) AS lowest, CAST(1 AS DOUBLE) AS highest, TRUE AS flags_match, TRUE AS names_match FROM features""",
    }


def semantic() -> dict[str, str]:
    q = {
        "semantic_kpi": GOLD + " SELECT sla_compliance AS KpiSummary__slaCompliance, avg_mttr_minutes AS KpiSummary__avgMttrMinutes FROM kpi",
        "semantic_by_day": GOLD + """ SELECT CAST(event_date AS TIMESTAMP) AS AttackVolumeByDay__eventDate,
          CAST(SUM(attack_count) AS BIGINT) AS AttackVolumeByDay__attackCount FROM by_day
          WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY 1 ORDER BY 1""",
        "semantic_top_countries": GOLD + """ SELECT country AS AttackVolumeByCountry__country, attack_count AS AttackVolumeByCountry__attackCount
          FROM by_country ORDER BY attack_count, country LIMIT 4""",
        "semantic_hourly": GOLD + """ SELECT date_trunc('day', event_hour) AS HourlyEventSummary__eventHour,
          CAST(sum(event_count) AS BIGINT) AS HourlyEventSummary__eventCount, CAST(sum(unique_users) AS BIGINT) AS HourlyEventSummary__uniqueUsers
          FROM hourly WHERE event_type IN ('vpn_login', 'account_lockout')
            AND event_hour >= TIMESTAMP '2024-01-17' AND event_hour < TIMESTAMP '2024-01-31' GROUP BY 1""",
        "semantic_events": SILVER + """ SELECT operating_system AS SecurityEvents__operatingSystem, day_of_week AS SecurityEvents__dayOfWeek,
          count(*) AS SecurityEvents__count, count(*) FILTER (WHERE is_attack_event) AS SecurityEvents__attackCount
          FROM silver WHERE department IN ('IT', 'Legal', 'Sales') AND is_internal_ip
            AND event_time >= TIMESTAMP '2024-01-11' AND event_time < TIMESTAMP '2024-01-31' GROUP BY ALL""",
        "semantic_distinct": SILVER + """ SELECT department AS SecurityEvents__department, is_business_hours AS SecurityEvents__isBusinessHours,
          COUNT(DISTINCT src_ip) AS SecurityEvents__uniqueIps, COUNT(DISTINCT username) AS SecurityEvents__uniqueUsers,
          COUNT(*) FILTER (WHERE event_type = 'failed_login') AS SecurityEvents__failedLoginCount FROM silver GROUP BY 1, 2""",
        "semantic_anomalies": FEATURES + """ SELECT date_trunc('day', window_start) AS AnomalyResults__windowStart, count(*) AS AnomalyResults__count,
          count(*) FILTER (WHERE attack_event_count >= 4) AS AnomalyResults__anomalyCount FROM features GROUP BY 1""",
        "semantic_date_filter": GOLD + """ SELECT CAST(event_date AS TIMESTAMP) AS AttackVolumeByDay__eventDate,
          CAST(SUM(attack_count) AS BIGINT) AS AttackVolumeByDay__attackCount,
          MAX(cumulative_attack_count) AS AttackVolumeByDay__cumulativeAttackCount FROM by_day
          WHERE event_date > DATE '2024-01-01' AND event_date < DATE '2024-01-31' GROUP BY 1""",
    }
    q["dashboard_filters"] = SILVER + """ SELECT event_type, COUNT(*) AS event_count FROM silver
      WHERE event_type IN ('malware_alert','failed_login','vpn_login') AND severity IN ('low','high') AND country IN ('US','GB','KP')
        AND event_time >= TIMESTAMP '2024-01-01' AND event_time < TIMESTAMP '2024-01-31' GROUP BY 1"""
    q["calendar_filters"] = SILVER + """ SELECT hour_of_day, COUNT(*) AS event_count FROM silver
      WHERE department IN ('IT','Legal') AND hour_of_day IN (9, 10, 22) AND day_of_week IN (1, 7) AND EXTRACT(MONTH FROM event_time) = 1 GROUP BY 1"""
    q["rollup_daily"] = SILVER + """ SELECT CAST(CAST(event_time AS DATE) AS TIMESTAMP) AS period, event_type, COUNT(*) AS event_count,
      COUNT(*) FILTER (WHERE is_attack_event) AS attack_count, COUNT(*) FILTER (WHERE event_type = 'failed_login') AS failed_login_count,
      CAST(DATE_TRUNC('month', event_time) AS DATE) AS month FROM silver GROUP BY 1, 2, 6"""
    q["rollup_monthly"] = ROLLUP_MONTHLY
    q["approx_daily_rollup"] = ROLLUP_MONTHLY.replace("CAST(DATE_TRUNC('month', event_time) AS DATE) AS month", "CAST(CAST(event_time AS DATE) AS TIMESTAMP) AS period")
    q["preagg_security_distinct"] = SILVER + """ SELECT DISTINCT CAST(date_trunc('week', event_time) AS TIMESTAMP) AS period,
      TRUE AS ips_are_near, TRUE AS users_are_near FROM silver"""
    q["preagg_attack_volume"] = GOLD + """ SELECT CAST(DATE_TRUNC('week', event_date) AS TIMESTAMP) AS period,
      CAST(SUM(attack_count) AS BIGINT) AS attackCount, MAX(cumulative_attack_count) AS cumulativeAttackCount FROM by_day GROUP BY 1"""
    q["preagg_hourly_summary"] = GOLD + """ SELECT CAST(DATE_TRUNC('day', event_hour) AS TIMESTAMP) AS period,
      CAST(SUM(event_count) AS BIGINT) AS eventCount, CAST(SUM(unique_ips) AS BIGINT) AS uniqueIps,
      CAST(SUM(unique_users) AS BIGINT) AS uniqueUsers FROM hourly GROUP BY 1"""
    q["preagg_security_events"] = SILVER + """ SELECT CAST(DATE_TRUNC('month', event_time) AS TIMESTAMP) AS period, COUNT(*) AS "count",
      COUNT(*) FILTER (WHERE is_attack_event) AS attackCount, COUNT(*) FILTER (WHERE event_type = 'failed_login') AS failedLoginCount
      FROM silver GROUP BY 1"""
    week = "CAST(DATE_TRUNC('week', event_time) AS TIMESTAMP) AS period"
    q["rollup_exact_distinct"] = SILVER + ", v AS (" + " UNION ALL ".join(
        f"SELECT '{which}' AS which, {column} AS value, event_time FROM silver"
        for which, column in (("addresses", "src_ip"), ("users", "username"), ("countries", "country"))) + ")" + " UNION ALL ".join(
        f" SELECT '{grain}' AS grain, which, CAST(DATE_TRUNC('{grain}', event_time) AS TIMESTAMP) AS period, COUNT(DISTINCT value) AS unique_values FROM v GROUP BY 2, 3"
        for grain in ("day", "week", "month"))
    q["rollup_top_users"] = SILVER + """, c AS (SELECT CAST(DATE_TRUNC('month', event_time) AS DATE) AS period, username, COUNT(*) AS attack_count
        FROM silver WHERE is_attack_event GROUP BY 1, 2), r AS (
        SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY period ORDER BY attack_count DESC, username) AS INT) AS rank FROM c)
      SELECT period, rank, username, attack_count, TRUE AS is_complete FROM r WHERE rank <= 10"""
    q["rollup_kpis"] = SILVER + f""" SELECT {week}, COUNT(*) AS event_count, COUNT(*) FILTER (WHERE is_attack_event) AS attack_count,
      CAST(CAST(COUNT(*) FILTER (WHERE event_type = 'failed_login') AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE event_type IN ('failed_login', 'successful_login')), 0) AS FLOAT) AS failed_login_rate,
      ROUND(AVG(epoch_us(detection_time) - epoch_us(event_time)) / 6e7, 6) AS avg_mttd_minutes,
      ROUND(AVG(epoch_us(resolution_time) - epoch_us(detection_time)) / 6e7, 6) AS avg_mttr_minutes,
      CAST(CAST(COUNT(*) FILTER (WHERE epoch_us(resolution_time) - epoch_us(detection_time) <= 240 * 60000000::BIGINT) AS DOUBLE) / NULLIF(COUNT(resolution_time), 0) AS FLOAT) AS sla_compliance,
      ROUND(AVG(severity_rank), 6) AS avg_severity_rank,
      CAST(CAST(COUNT(*) FILTER (WHERE NOT is_business_hours) AS DOUBLE) / COUNT(*) AS FLOAT) AS off_hours_ratio FROM silver GROUP BY 1"""
    q["rollup_moments"] = SILVER + """, m AS (
      SELECT department, event_time, 'rank' AS measured, CAST(severity_rank AS DOUBLE) AS x FROM silver
      UNION ALL SELECT department, event_time, 'response', (epoch_us(resolution_time) - epoch_us(detection_time)) / 6e7 FROM silver)
      SELECT CAST(DATE_TRUNC('month', event_time) AS TIMESTAMP) AS period, department, measured, COUNT(x) AS n,
        ROUND(AVG(x), 6) AS mean, ROUND(STDDEV_SAMP(x), 6) AS deviation FROM m GROUP BY 1, 2, 3 HAVING COUNT(x) > 0"""
    q["rollup_country_scores"] = SILVER + f""", c AS (SELECT {week}, country, COUNT(*) AS attack_count FROM silver WHERE is_attack_event GROUP BY 1, 2)
      SELECT *, ROUND(COALESCE((attack_count - AVG(attack_count) OVER k) / NULLIF(STDDEV_SAMP(attack_count) OVER k, 0), 0), 6) AS z_score
      FROM c WINDOW k AS (PARTITION BY country)"""
    return q


ROLLUP_MONTHLY = SILVER + """ SELECT CAST(DATE_TRUNC('month', event_time) AS DATE) AS month, COUNT(*) AS event_count,
  COUNT(*) FILTER (WHERE is_attack_event) AS attack_count, COUNT(*) FILTER (WHERE event_type = 'failed_login') AS failed_login_count,
  TRUE AS ips_are_near, TRUE AS users_are_near FROM silver GROUP BY 1"""


def _check(check: str, table: str, column: str, count: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\", "
        f"CAST(n AS BIGINT) AS failing_rows, n = 0 AS passed FROM ({count})"
    )


_TYPES = "('failed_login','successful_login','malware_alert','privilege_escalation','suspicious_ip_activity','vpn_login','account_lockout','brute_force_attempt')"
_LEVELS = "('low','medium','high','critical')"


def _null_checks(source: str, table: str, columns: list[str]) -> list[str]:
    return [
        _check("not_null", table, c, f"SELECT COUNT(*) FILTER (WHERE {c} IS NULL) AS n FROM {source}") for c in columns
    ]


def _repeats(source: str, table: str, column: str) -> str:
    return _check("unique", table, column, f"SELECT COUNT(*) AS n FROM (SELECT {column} FROM {source} GROUP BY 1 HAVING COUNT(*) > 1)")


def _accepted(source: str, table: str) -> list[str]:
    return [
        _check("accepted_values", table, c, f"SELECT COUNT(*) FILTER (WHERE {c} NOT IN {v}) AS n FROM {source}")
        for c, v in (("event_type", _TYPES), ("severity", _LEVELS))
    ]


def _orphans(child: str, table: str, column: str) -> str:
    return _check("relationship", table, column,
                  f"SELECT COUNT(*) AS n FROM {child} WHERE {column} NOT IN (SELECT {column} FROM silver)")


def checking() -> dict[str, str]:
    silver_name = "silver.silver_events"
    required = ("event_id event_time username src_ip hostname event_type severity severity_rank status country operating_system "
                "department hour_of_day day_of_week is_business_hours is_internal_ip is_attack_event _ingested_at _source_file _batch_id").split()
    silver_rows = [
        _repeats("silver", silver_name, "event_id"), *_null_checks("silver", silver_name, required),
        *_accepted("silver", silver_name),
        _check("range", silver_name, "severity_rank", "SELECT COUNT(*) FILTER (WHERE severity_rank NOT BETWEEN 1 AND 4) AS n FROM silver"),
    ]
    contract = [f"SELECT 'contract' AS \"check\", '{silver_name}' AS \"table\", '*' AS \"column\", CAST(0 AS BIGINT) AS failing_rows, TRUE AS passed"]
    kpi = "gold.kpi_summary"
    day, country, hour = "gold.attack_volume_by_day", "gold.attack_volume_by_country", "gold.hourly_event_summary"
    gold_rows = [
        *_null_checks("kpi", kpi, ["total_attacks", "failed_login_rate"]),
        *[_check("range", kpi, c, f"SELECT COUNT(*) FILTER (WHERE {c} < 0 OR {c} > 1) AS n FROM kpi") for c in ("failed_login_rate", "sla_compliance")],
        _repeats("by_day", day, "event_date"), *_null_checks("by_day", day, ["event_date", "attack_count", "cumulative_attack_count"]),
        _repeats("by_country", country, "country"), *_null_checks("by_country", country, ["country", "attack_count", "percentage_of_total"]),
        *_null_checks("hourly", hour, ["event_hour", "event_type", "event_count", "unique_ips", "unique_users"]),
        _orphans("by_country", country, "country"), _orphans("hourly", hour, "event_type"),
    ]
    bronze_name = "bronze.security_events"
    bronze_rows = [
        _repeats("bronze", bronze_name, "event_id"),
        *_null_checks("bronze", bronze_name, ["event_id", "event_time", "src_ip", "destination_ip", "detection_time"]),
        *_accepted("bronze", bronze_name), _orphans("bronze", bronze_name, "event_id"),
    ]

    def age(layer: str, latest: str, limit: int) -> str:
        return (f"SELECT '{layer}' AS layer, latest, ROUND(CAST(epoch_us(TIMESTAMP '2024-01-31 00:04:00') - epoch_us(latest) AS DOUBLE) / 60000000.0, 3) AS age_minutes, "
                f"{limit} AS limit_minutes, epoch_us(TIMESTAMP '2024-01-31 00:04:00') - epoch_us(latest) <= {limit} * 60000000 AS fresh FROM ({latest})")

    return {
        "dq_bronze": SILVER + " " + " UNION ALL ".join(bronze_rows),
        "dq_silver": SILVER + " " + " UNION ALL ".join(silver_rows),
        "dq_report": GOLD + " " + " UNION ALL ".join(silver_rows + contract + gold_rows),
        "anomaly_gate": FEATURES + """, flags AS (SELECT * FROM (VALUES ('lax', 1), ('usual', 4), ('strict', 1000000)) AS v(flag, least_attacks)),
          shares AS (SELECT flag, 100.0 * COUNT(*) FILTER (WHERE attack_event_count >= least_attacks) / COUNT(*) AS share FROM features, flags GROUP BY flag)
          SELECT 'anomaly_share' AS "check", 'gold.anomaly_results' AS "table", 'is_anomaly' AS "column",
            CAST(share NOT BETWEEN 1 AND 15 AS BIGINT) AS failing_rows, share BETWEEN 1 AND 15 AS passed, flag FROM shares""",
        "freshness": GOLD + " " + " UNION ALL ".join([
            age("bronze", "SELECT MAX(_ingested_at) AS latest FROM bronze", 5),
            age("silver", "SELECT MAX(event_time) AS latest FROM silver", 10),
            age("gold", "SELECT MAX(event_hour) AS latest FROM hourly", 15)]),
    }


def storing() -> dict[str, str]:
    return {
        "export_round_trip": SILVER + " SELECT silver.*, format FROM silver, (SELECT UNNEST(['jsonl', 'parquet', 'csv']) AS format)",
        "mart_from_csv": GOLD + " SELECT * FROM by_country",
        "evolved_events": SILVER + """ SELECT event_id, date_trunc('day', event_time)::TIMESTAMP AS event_time, severity_rank::BIGINT AS severity_rank, country,
          NULL::VARCHAR AS department FROM silver""",
        "write_dispositions": SILVER + """, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE event_time < TIMESTAMP '2024-01-15') AS early FROM silver)
          SELECT 'absent' AS step, 0::BIGINT AS row_count UNION ALL SELECT 'replace', early FROM c UNION ALL SELECT 'append', early + n FROM c
          UNION ALL SELECT 'merge', n FROM c UNION ALL SELECT 'replace again', early FROM c""",
        "run_history": BRONZE + r""", firsts AS (SELECT * FROM bronze WHERE _batch_id LIKE '%\_001' ESCAPE '\'),""" + silver_cte("kept", "firsts") + """,
          of_run AS (SELECT 1 AS run, 0 AS odd UNION ALL SELECT 2, 1)
          SELECT run, 'ingest,silver,gold,anomalies' AS stages_completed, NULL::VARCHAR AS stages_failed,
            (SELECT count(*) FROM firsts WHERE CAST(substr(event_id, 4) AS BIGINT) % 2 = odd) AS records_ingested,
            (SELECT count(*) FROM kept WHERE CAST(substr(event_id, 4) AS BIGINT) % 2 <= odd) AS records_transformed, 0::BIGINT AS records_rejected,
            CASE WHEN run = 2 THEN 'ingest,silver,gold,anomalies' END AS slow_stages, run = 2 AS is_slow, TRUE AS ends_after_start FROM of_run""",
        "stored_anomalies": FEATURES + """ SELECT window_start, window_end, attack_event_count / -100.0::DOUBLE AS anomaly_score, attack_event_count >= 4 AS is_anomaly,
          CASE WHEN attack_event_count >= 4 THEN 'attack_event_count' ELSE 'none' END AS top_contributing_feature,
          features.* EXCLUDE (window_start, window_end, avg_severity_rank), round(avg_severity_rank, 6) AS avg_severity_rank, 'v2' AS model_version,
          count(*) OVER () AS rows_checked, count(*) OVER () AS rows_written FROM features""",
    }


# Streams see every version of an event: no deduplication before the rules.
STREAMED = BRONZE + "," + refined("clean", "bronze")


# Micro-batches by the day of arrival, every tenth key one late.
_IN_TIME_ORDER = """
timed AS (SELECT *, TRY_CAST(event_time AS TIMESTAMP) AS t FROM bronze),
dealt AS (SELECT *, LEAST(4, GREATEST(0, FLOOR(DATE_DIFF('day', DATE '2024-01-01', CAST(_ingested_at AS DATE)) / 6.0))
    + CASE WHEN CAST(regexp_extract(event_id, '[0-9]+') AS BIGINT) % 10 = 0 THEN 1 ELSE 0 END)::BIGINT AS batch FROM timed WHERE t IS NOT NULL)"""


def streams() -> dict[str, str]:
    return {
        "stream_ingest": BRONZE + f""" SELECT {_AS_TEXT}, TRUE AS batch_is_named FROM bronze WHERE _batch_id LIKE '%\\_001' ESCAPE '\\'""",
        "stream_dead_letters": RAW + """ SELECT CASE WHEN k = 7 THEN 'unknown' ELSE event_id END AS event_id, raw_record, error_reason
          FROM judged WHERE error_reason <> ''""",
        "stream_hourly": STREAMED + """ SELECT date_trunc('hour', event_time) AS event_hour, event_type, count(*) AS event_count,
          TRUE AS ips_are_near, TRUE AS users_are_near FROM clean GROUP BY ALL""",
        "stream_features": core()["hourly_features"],
        "stream_hourly_table": core()["hourly_event_summary"],
        "stream_corrections": SILVER + " SELECT event_id, username, src_ip, event_type, severity_rank, CAST(1 AS BIGINT) AS n FROM silver",
        "stream_keyed_table": SILVER + " SELECT * FROM silver_dedup",
        "stream_late_rows": BRONZE + "," + _IN_TIME_ORDER + """,
closed AS (SELECT b.batch, MAX(d.t) - INTERVAL '1 hour' AS watermark FROM (SELECT UNNEST(range(5)) AS batch) b LEFT JOIN dealt d ON d.batch < b.batch GROUP BY 1)
SELECT event_id, _batch_id, d.batch AS stream_batch, COALESCE(DATE_TRUNC('hour', t) + INTERVAL '1 hour' <= watermark, FALSE) AS is_late
FROM dealt d JOIN closed c ON c.batch = d.batch""",
        "stream_burst_moments": SILVER + "," + _IN_TIME_ORDER + """,
recent AS (SELECT src_ip, event_time, COUNT(*) OVER (PARTITION BY src_ip ORDER BY event_time
    RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS events_in_window
  FROM silver WHERE event_type = 'failed_login'),
w AS (SELECT epoch_us(MAX(COALESCE(t, _ingested_at))) - 864000000000 AS watermark FROM timed)
SELECT DISTINCT src_ip, event_time, events_in_window FROM recent, w
WHERE events_in_window >= 2 AND (epoch_us(event_time) // 86400000001 + 1) * 86400000001 <= watermark""",
        "stream_hourly_counts": STREAMED + """ SELECT DATE_TRUNC('hour', event_time) AS event_hour, event_type, COUNT(*) AS event_count
          FROM clean GROUP BY 1, 2""",
        "stream_features_exact": STREAMED + """ SELECT DATE_TRUNC('hour', event_time) AS window_start,
          DATE_TRUNC('hour', event_time) + INTERVAL '1 hour' AS window_end, COUNT(*) AS total_event_count,
          COUNT(*) FILTER (WHERE event_type = 'failed_login') AS failed_login_count,
          CAST(CAST(COUNT(*) FILTER (WHERE event_type = 'failed_login') AS DOUBLE) / COUNT(*) AS FLOAT) AS failed_login_ratio,
          COUNT(*) FILTER (WHERE is_attack_event) AS attack_event_count, ROUND(AVG(severity_rank), 6) AS avg_severity_rank,
          COUNT(*) FILTER (WHERE severity = 'critical') AS critical_event_count,
          CAST(CAST(COUNT(*) FILTER (WHERE NOT is_business_hours) AS DOUBLE) / COUNT(*) AS FLOAT) AS events_outside_business_hours_ratio
          FROM clean GROUP BY 1, 2""",
        "stream_sessions": STREAMED + """,
f AS (SELECT src_ip, event_time, LAG(event_time) OVER (PARTITION BY src_ip ORDER BY event_time) AS prev FROM clean WHERE event_type = 'failed_login'),
g AS (SELECT src_ip, event_time, SUM(CASE WHEN prev IS NULL OR event_time - prev > INTERVAL 2 DAYS THEN 1 ELSE 0 END)
        OVER (PARTITION BY src_ip ORDER BY event_time) AS session FROM f),
s AS (SELECT src_ip, MIN(event_time) AS session_start, MAX(event_time) + INTERVAL 2 DAYS AS session_end, COUNT(*) AS failed_logins FROM g GROUP BY src_ip, session)
SELECT * FROM s WHERE session_end <= (SELECT MAX(event_time) - INTERVAL 10 MINUTES FROM clean WHERE event_type = 'failed_login')""",
        "stream_bursts": STREAMED + """,
f AS (SELECT src_ip, event_time, UNNEST(range(4)) AS i FROM clean WHERE event_type = 'failed_login'),
w AS (SELECT src_ip, time_bucket(INTERVAL 3 HOURS, event_time, TIMESTAMP '1970-01-01') - i * INTERVAL 3 HOURS AS window_start FROM f)
SELECT src_ip, window_start, window_start + INTERVAL 12 HOURS AS window_end, COUNT(*) AS failed_logins
FROM w GROUP BY 1, 2 HAVING COUNT(*) >= 2""",
        "stream_lockouts": STREAMED + """
SELECT l.event_id AS lockout_id, l.country, l.department, l.operating_system, l.event_time AS lockout_time
FROM clean l WHERE l.event_type = 'account_lockout' AND EXISTS (
  SELECT 1 FROM clean b WHERE b.event_type = 'brute_force_attempt' AND b.country = l.country AND b.department = l.department
    AND b.operating_system = l.operating_system
    AND b.event_time BETWEEN l.event_time - INTERVAL 86400 SECONDS AND l.event_time - INTERVAL 60 SECONDS)""",
        "stream_dedup": STREAMED + """ SELECT event_id, ANY_VALUE(event_type) AS event_type FROM bronze
          WHERE TRY_CAST(event_time AS TIMESTAMP) IS NOT NULL GROUP BY 1""",
        "stream_silver": SILVER + " SELECT * FROM silver",
        "stream_late_split": BRONZE + """ SELECT event_id, 'on_time' AS outcome FROM bronze
          WHERE TRY_CAST(event_time AS TIMESTAMP) IS NOT NULL""",
    }
