"""A generic click-stream ``events`` table read as security events.

Deterministic column arithmetic only, so every Silver rule meets rows that break
it: repeated ids, an invalid newest version, unparseable times, missing and
malformed addresses, wrong-case and unknown severities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigilframe.sources.contracts import ATTACK_TYPES, SOURCE_FIELDS

COUNTRIES = ("US", "GB", "DE", "JP", "AU", "CA", "FR", "IN", "BR", "SG", "KP", "IR")
DEPARTMENTS = ("IT", "Finance", "Engineering", "HR", "Marketing", "Sales", "Legal", "Operations")
SYSTEMS = ("Windows 11", "Windows 10", "macOS Sonoma", "Ubuntu 22.04", "RHEL 9")


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/events.parquet")


def _quoted(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _pick(words: tuple[str, ...], number: str) -> str:
    return f"element_at(array({_quoted(words)}), CAST({number} % {len(words)} + 1 AS INT))"


def typed_events(events: DataFrame) -> DataFrame:
    """``events`` with the key ``k`` from its props and the security type ``etype``."""
    pairs = (
        ("error", "failed_login", "brute_force_attempt"),
        ("click", "successful_login", "vpn_login"),
        ("view", "malware_alert", "suspicious_ip_activity"),
        ("signup", "account_lockout", "privilege_escalation"),
    )
    cases = " ".join(f"WHEN '{kind}' THEN if(k % 2 = 0, '{even}', '{odd}')" for kind, even, odd in pairs)
    return events.selectExpr("*", "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k").selectExpr(
        "*", f"CASE event_type {cases} ELSE 'successful_login' END AS etype"
    )


def bronze_from_events(events: DataFrame) -> DataFrame:
    """Bronze rows, one per event plus a later second version of every 20th.

    Written as SQL expressions: this runs in front of every query, and one parsed text is
    quicker to build than a tree of calls.
    """
    incident = f"etype IN ({_quoted(ATTACK_TYPES)})"
    detected = "ts + make_dt_interval(0, 0, 0, 60 + k * 35)"
    resolved = f"{detected} + make_dt_interval(0, 0, 0, 600 + CAST(floor(value * 97) AS INT))"
    shaped = typed_events(events).selectExpr(
        "concat('ev-', event_id) AS event_id",
        "if(k = 94, 'not-a-time', CAST(ts AS STRING)) AS event_time",
        "concat('User_', user_id) AS username",
        """CASE WHEN k = 93 THEN NULL WHEN k = 92 THEN 'bad_ip'
           WHEN k % 5 = 0 THEN concat('10.', user_id % 256, '.', k, '.7')
           WHEN k % 5 = 1 THEN concat('172.', k % 30 + 8, '.', user_id % 256, '.9')
           WHEN k % 5 = 2 THEN concat('192.', if(k % 2 = 0, '168', '169'), '.', user_id % 256, '.1')
           ELSE concat('203.', k, '.', user_id % 256, '.5') END AS src_ip""",
        "if(k % 3 = 0, concat('10.0.', user_id % 256, '.20'), NULL) AS destination_ip",
        "concat('ws-', user_id % 50) AS hostname",
        "etype AS event_type",
        """CASE WHEN k <= 39 THEN 'low' WHEN k <= 69 THEN 'medium' WHEN k <= 89 THEN 'high'
           WHEN k <= 97 THEN 'critical' WHEN k = 98 THEN 'HIGH' ELSE 'unknown' END AS severity""",
        """CASE WHEN etype IN ('failed_login', 'account_lockout') THEN 'failure'
           WHEN etype IN ('successful_login', 'vpn_login') THEN 'success'
           WHEN k % 2 = 0 THEN 'detected' ELSE 'blocked' END AS status""",
        f"{_pick(COUNTRIES, 'user_id')} AS country",
        f"{_pick(SYSTEMS, 'user_id')} AS operating_system",
        f"{_pick(DEPARTMENTS, 'user_id')} AS department",
        f"if({incident} OR (etype = 'failed_login' AND k % 10 = 0), {detected}, NULL) AS detection_time",
        f"if({incident} AND k % 9 <> 0, {resolved}, NULL) AS resolution_time",
        "CAST(ts AS DATE) AS _day",
        "k AS _k",
        # One pass: every row carries an array of its versions (one or two) to explode.
        "explode(if(event_id % 20 = 0, array(1, 2), array(1))) AS _v",
    ).selectExpr("*", "date_add(_day, _v - 1) AS _arrived")
    changed = {
        "username": "if(_v = 2, concat(username, '_v2'), username)",
        "src_ip": "if(_v = 2 AND _k = 10, 'bad_ip', src_ip)",
    }
    return shaped.selectExpr(
        *[f"{changed.get(c, c)} AS {c}" for c in SOURCE_FIELDS],
        "CAST(_arrived AS TIMESTAMP_NTZ) AS _ingested_at",
        "concat('events-', replace(CAST(_arrived AS STRING), '-', ''), '.jsonl') AS _source_file",
        "concat('batch_', replace(CAST(_arrived AS STRING), '-', ''), '_00', _v) AS _batch_id",
    )


def raw_records(events: DataFrame) -> DataFrame:
    """Bronze rows as raw JSON lines, without the metadata columns: what a collector would send."""
    fields = [F.col(c).cast("string").alias(c) for c in SOURCE_FIELDS]
    record = F.struct(*fields)
    first = bronze_from_events(events).filter(F.col("_batch_id").endswith("_001"))
    return first.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))


def raw_json_lines(events: DataFrame) -> DataFrame:
    """The same events as raw JSON lines, some of them broken (see FIXTURES section 6).

    ``k`` 1: null id and time, 2: blank id, 3: null type, 4: wrong-case type,
    5: no time, 6: empty type, 7: text that is not JSON, 8: a blank line.
    """
    k = F.col("k")
    record = F.struct(
        F.when(k == 1, F.lit(None)).when(k == 2, "   ").otherwise(F.concat(F.lit("ev-"), F.col("event_id"))).alias("event_id"),
        F.when(k.isin(1, 5), F.lit(None)).otherwise(F.col("ts").cast("string")).alias("event_time"),
        F.when(k == 3, F.lit(None)).when(k == 4, "Failed_Login").when(k == 6, "").otherwise(F.col("etype")).alias("event_type"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("username"),
    )
    return typed_events(events).select(
        F.when(k == 7, "this is not json")
        .when(k == 8, "   ")
        .otherwise(F.to_json(record, {"ignoreNullFields": "false"}))
        .alias("value")
    )
