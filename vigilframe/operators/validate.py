"""Record validation and routing of raw JSON lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from vigilframe.functions.events import is_blank, is_strict_ipv4, is_uuid_v4, parse_time, strip
from vigilframe.sources.contracts import EVENT_TYPES, REQUIRED_FIELDS, SEVERITIES, SOURCE_FIELDS

_ALLOWED = "[" + ", ".join(f"'{name}'" for name in sorted(EVENT_TYPES)) + "]"


def error_reason(event_id: Column, event_time: Column, event_type: Column) -> Column:
    """All problems of a record joined by "; "; empty text when it is valid."""
    problems = []
    for name, value in zip(REQUIRED_FIELDS, (event_id, event_time, event_type)):
        problems.append(
            F.when(value.isNull(), f"Missing required field: {name}")
            .when(is_blank(value), f"Required field is empty: {name}")
        )
    problems.append(
        F.when(
            ~is_blank(event_type) & ~event_type.isin(*EVENT_TYPES),
            F.concat(F.lit("Invalid event_type: '"), event_type, F.lit(f"'. Must be one of: {_ALLOWED}")),
        )
    )
    return F.concat_ws("; ", *problems)


def validate_events(records: DataFrame) -> DataFrame:
    """Add ``error_reason`` to records whose fields are columns."""
    return records.withColumn("error_reason", error_reason(*[F.col(c) for c in REQUIRED_FIELDS]))


_MAY_BE_NULL = ("destination_ip", "detection_time", "resolution_time")


def failing_fields(records: DataFrame) -> DataFrame:
    """Add ``failing_fields``: names of the fields that break the declared record schema.

    Stricter than ingest: a UUID v4 id, addresses with octets up to 255, readable times,
    known type and severity, and no NULL outside the three optional fields.
    """
    rules: dict[str, Callable[[Column], Column]] = {
        "event_id": is_uuid_v4,
        "src_ip": is_strict_ipv4,
        "destination_ip": is_strict_ipv4,
        "event_type": lambda c: c.isin(*EVENT_TYPES),
        "severity": lambda c: c.isin(*SEVERITIES),
    }
    rules |= {name: lambda c: parse_time(c.cast("string")).isNotNull() for name in ("event_time", "detection_time", "resolution_time")}

    def breaks(name: str) -> Column:
        value = F.col(name)
        good = rules[name](value) if name in rules else F.lit(True)
        return F.when(value.isNull(), F.lit(name not in _MAY_BE_NULL)).otherwise(~good)

    names = F.array(*[F.when(breaks(name), F.lit(name)) for name in SOURCE_FIELDS])
    return records.withColumn("failing_fields", F.array_compact(names))


# Python's reader rejects single quotes; Spark's accepts them unless told otherwise.
_JSON_OPTIONS = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


def parse_lines(lines: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """Lines in column ``value`` to source fields plus ``raw_record`` and ``error_reason``.

    Blank lines are dropped and each line is parsed once. Text that is not JSON, or is JSON
    but not an object, gets a reason and NULL fields. ``extra`` names further fields to
    keep, with their types.

    from_json stops at the end of the first value, so the line is parsed as a member of an
    outer object whose next member is the line's hash: anything after the record makes the
    hash unreadable.
    """
    extra = extra or {}
    fields = ", ".join(f"`{name}`: string" for name in (*SOURCE_FIELDS, *extra))
    text = lines.withColumn("raw_record", strip(F.col("value"))).filter("raw_record <> ''")
    outer = F.concat(F.lit('{"r":'), "raw_record", F.lit(',"after":'), F.xxhash64("raw_record"), F.lit("}"))
    parsed = text.withColumn("_json", F.from_json(outer, f"r struct<{fields}>, after bigint", _JSON_OPTIONS))
    record = parsed.select(
        *[c for c in lines.columns if c != "value"],
        "raw_record",
        (F.col("_json.r").isNotNull() & F.col("_json.after").eqNullSafe(F.xxhash64("raw_record"))).alias("_readable"),
        F.col("_json.r").alias("_r"),
    )
    rows = record.select(
        *record.columns[:-1],
        *[F.when(F.col("_readable"), F.col(f"_r.{name}")).alias(name) for name in SOURCE_FIELDS],
        *[F.when(F.col("_readable"), F.col(f"_r.{name}").try_cast(kind)).alias(name) for name, kind in extra.items()],
    )
    # Reached by unreadable lines only.
    why = F.when(F.try_parse_json("raw_record").isNotNull() & ~F.col("raw_record").startswith("{"),
                 "Record is not a JSON object").otherwise("JSON parse error: the line is not valid JSON")
    return rows.withColumn(
        "error_reason",
        F.when(~F.col("_readable"), why).otherwise(error_reason(*[F.col(c) for c in REQUIRED_FIELDS])),
    )


def valid_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter("error_reason = ''")


def rejected_rows(parsed: DataFrame) -> DataFrame:
    """Dead letters. A missing id reads "unknown"; an id that is null stays null."""
    has_id = F.array_contains(F.json_object_keys("raw_record"), "event_id")
    metadata = [c for c in parsed.columns if c.startswith("_") and c != "_readable"]
    return parsed.filter("error_reason <> ''").select(
        F.when(F.col("event_id").isNotNull(), F.col("event_id"))
        .when(F.col("_readable") & has_id, F.lit(None))
        .otherwise("unknown")
        .alias("event_id"),
        *metadata,
        "raw_record",
        "error_reason",
    )
