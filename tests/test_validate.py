from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from vigilframe.functions import events as ev
from vigilframe.operators.validate import failing_fields, parse_lines, rejected_rows, valid_rows
from vigilframe.sources.contracts import EVENT_TYPES

GOOD = {
    "event_id": "0f9d11c2-77aa-4c0e-9b1f-6c5d4e3f2a10", "event_time": "2023-11-02T06:05:44Z",
    "event_type": "vpn_login", "username": "mkaya", "src_ip": "10.20.30.40",
}
ALLOWED = str(sorted(EVENT_TYPES))


def without(*names, **changes):
    return {k: v for k, v in {**GOOD, **changes}.items() if k not in names}


CASES = [
    (GOOD, []),
    (without(extra="x"), []),
    (without(event_time=1698905144), []),
    (without("event_id"), ["Missing required field: event_id"]),
    (without("event_time"), ["Missing required field: event_time"]),
    (without("event_type"), ["Missing required field: event_type"]),
    ({"username": "u", "src_ip": "1.2.3.4"}, [f"Missing required field: {f}" for f in ("event_id", "event_time", "event_type")]),
    (without(event_id=None), ["Missing required field: event_id"]),
    (without(event_id=""), ["Required field is empty: event_id"]),
    (without(event_id=" \t  "), ["Required field is empty: event_id"]),
    (without(event_time=""), ["Required field is empty: event_time"]),
    (without(event_type=""), ["Required field is empty: event_type"]),
    (without("event_id", event_type="nope"), ["Missing required field: event_id", f"Invalid event_type: 'nope'. Must be one of: {ALLOWED}"]),
    ({}, [f"Missing required field: {f}" for f in ("event_id", "event_time", "event_type")]),
]
CASES += [(without(event_type=t), []) for t in EVENT_TYPES]
CASES += [
    (without(event_type=t), [f"Invalid event_type: '{t}'. Must be one of: {ALLOWED}"])
    for t in ("port_scan", "VPN_LOGIN", "vpn_login\u00a0", "vpn login", "null")
]


def lines(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string")


def test_error_texts(spark):
    got = parse_lines(lines(spark, [json.dumps(c) for c, _ in CASES])).orderBy("n").collect()
    assert [r["error_reason"] for r in got] == ["; ".join(errors) for _, errors in CASES]


BROKEN = [
    "this is not json", '{"a":1} xyz', '{"a":1}{"b":2}', "{'a':1}", '{"a":01}', '{"a":1,}', '{"a"', "{a:1}", '{"a":1}]',
    '{"a":1}}', '{"a":"\\x"}', '{"a":1}// c', '{"a":1},"after":1}', '{"a":"x\ty"}',
]
NOT_OBJECTS = ["[1]", '[{"a":1}]', '"text"', "null", "12", "true"]
ODD_BUT_VALID = ['{"a":NaN}', '{"a":1,"a":2}', '{"a":{"b":[1]}}', "{}", '{"a":-0.0}', '{"a":1e400}']


def test_what_counts_as_json(spark):
    """Agrees with Python's json module on every line."""
    texts = BROKEN + NOT_OBJECTS + ODD_BUT_VALID
    got = {r["raw_record"]: r["error_reason"] for r in parse_lines(lines(spark, texts)).collect()}
    for text in texts:
        try:
            kind = "object" if isinstance(json.loads(text), dict) else "other"
        except json.JSONDecodeError:
            kind = "broken"
        expected = {
            "broken": "JSON parse error", "other": "Record is not a JSON object", "object": "Missing required field",
        }[kind]
        assert got[text].startswith(expected), text


def test_last_duplicate_key_wins(spark):
    line = '{"event_id":"a","event_id":"b","event_time":"t","event_type":"vpn_login"}'
    assert [r["event_id"] for r in valid_rows(parse_lines(lines(spark, [line]))).collect()] == ["b"]


def test_blank_lines_are_neither(spark):
    parsed = parse_lines(lines(spark, ["", "   ", "\t ", json.dumps(GOOD)]))
    assert (valid_rows(parsed).count(), rejected_rows(parsed).count()) == (1, 0)


def test_dead_letter_id(spark):
    texts = ["x", '{"event_type":"vpn_login"}', '{"event_id":null}', '{"event_id":"k","event_type":"?"}']
    got = {r["raw_record"]: r["event_id"] for r in rejected_rows(parse_lines(lines(spark, texts))).collect()}
    assert [got[t] for t in texts] == ["unknown", "unknown", None, "k"]


def test_extra_fields(spark):
    parsed = parse_lines(lines(spark, [json.dumps({**GOOD, "score": 7, "bad": "x"})]), {"score": "int", "bad": "int"})
    row = parsed.first()
    assert (row["score"], row["bad"], row["error_reason"]) == (7, None, "")


@pytest.mark.parametrize(
    "ip, shape, strict",
    [
        ("192.168.1.1", True, True), ("999.1.1.1", True, False), ("1.2.3", False, False), ("1.2.3.4.5", False, False),
        ("1.2.3.4\n", False, False), ("255.255.255.255", True, True), ("256.0.0.1", True, False), ("01.2.3.4", True, False),
        ("a.b.c.d", False, False), ("1.2.3.", False, False), (None, False, False), ("", False, False),
    ],
)
def test_addresses(spark, ip, shape, strict):
    df = spark.createDataFrame([(ip,)], "ip string")
    assert tuple(df.select(ev.looks_like_ipv4(F.col("ip")), ev.is_strict_ipv4(F.col("ip"))).first()) == (shape, strict)


def test_declared_schema(spark):
    from tests.helpers import bronze

    uid = GOOD["event_id"]
    df = bronze(
        spark, {"event_id": uid}, {"event_id": uid, "destination_ip": "256.1.1.1", "severity": "HIGH", "country": None},
        {"event_id": "x", "event_time": "never", "src_ip": None, "event_type": "nope"},
    )
    assert [r["failing_fields"] for r in failing_fields(df).collect()] == [
        [], ["destination_ip", "severity", "country"], ["event_id", "event_time", "src_ip", "event_type"],
    ]


def test_uuid(spark):
    values = [GOOD["event_id"], GOOD["event_id"].upper(), "a1b2c3d4-e5f6-1890-abcd-ef1234567890", "x", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(ev.is_uuid_v4(F.col("v"))).collect()] == [True, True, False, False, False]


def test_parse_time(spark):
    cases = {
        "2024-01-15T14:32:07Z": "2024-01-15 14:32:07", "2024-01-15T14:32:07+02:00": "2024-01-15 12:32:07",
        "2024-01-15 14:32:07.123456": "2024-01-15 14:32:07.123456", "2024-01-15": "2024-01-15 00:00:00",
        "2024/01/05": "2024-01-05 00:00:00", "2024-1-5": "2024-01-05 00:00:00", "2024-01-15T14:32": "2024-01-15 14:32:00",
        "2024": None, "2024-01": None, "T12:30": None, "12:30": None, "not-a-time": None, "2024-13-01": None, "": None, None: None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = [r[0] for r in df.select(ev.parse_time(F.col("t")).cast("string")).collect()]
    assert got == list(cases.values())
