"""Derived columns of a security event."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vigilframe.sources.contracts import ATTACK_TYPES, SEVERITIES

# The characters a JSON-lines reader strips, ASCII controls and Unicode spaces.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed patterns. ``\z``: ``$`` would also match before a final line break.
IPV4_SHAPE = r"^[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\z"
IPV4_STRICT = r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.|\z)){4}(?<!\.)\z"
UUID_V4 = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}\z"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def looks_like_ipv4(ip: Column) -> Column:
    """Four groups of one to three digits; 999.x passes, NULL does not."""
    return ip.isNotNull() & ip.rlike(IPV4_SHAPE)


def is_strict_ipv4(ip: Column) -> Column:
    """Every octet within 0 to 255, without leading zeros."""
    return ip.isNotNull() & ip.rlike(IPV4_STRICT)


def is_uuid_v4(text: Column) -> Column:
    return text.isNotNull() & text.rlike(UUID_V4)


def is_rfc1918(ip: Column) -> Column:
    """Private ranges 10/8, 172.16/12 and 192.168/16."""
    first = F.substring_index(ip, ".", 1).try_cast("int")
    second = F.substring_index(F.substring_index(ip, ".", 2), ".", -1).try_cast("int")
    return (
        (first == 10)
        | ((first == 172) & second.between(16, 31))
        | ((first == 192) & (second == 168))
    )


def severity_rank(severity: Column) -> Column:
    rank = F.when(F.lower(severity) == SEVERITIES[0], 1)
    for position, name in enumerate(SEVERITIES[1:], start=2):
        rank = rank.when(F.lower(severity) == name, position)
    return rank.otherwise(0)


def is_attack(event_type: Column) -> Column:
    return F.coalesce(event_type.isin(*ATTACK_TYPES), F.lit(False))


def parse_time(text: Column) -> Column:
    """ISO-like text to a UTC wall-clock timestamp, NULL when it is not one.

    The text must hold a full date (two separators): Spark alone would also read a bare
    year, a year and month, or a time of day.
    """
    dated = F.when(
        F.contains(text, F.lit("/")),
        F.regexp_replace(text, r"^(\s*[0-9]+)/([0-9]+)/([0-9]+)", "$1-$2-$3"),
    ).otherwise(text)
    return F.when(
        F.substring_index(dated, "-", 2) != dated,
        dated.try_cast("timestamp").cast("timestamp_ntz"),
    )


def iso_weekday(ts: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(ts) + 1


def in_business_hours(ts: Column) -> Column:
    """09:00 up to, not including, 17:00 UTC."""
    return F.hour(ts).between(9, 16)


def hour_start(ts: Column) -> Column:
    """Start of the hour; unlike date_trunc this keeps a zone-less timestamp zone-less."""
    return F.window(ts, "1 hour")["start"]


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a UTC wall-clock timestamp."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(60_000_000.0)


def ratio(part: Column, whole: Column) -> Column:
    """32-bit share, NULL when the whole is zero."""
    return (part / F.nullif(whole, F.lit(0))).cast("float")


def distinct_count(column: str, approximate: bool) -> Column:
    """Exact, or a HyperLogLog estimate, which needs no second shuffle."""
    return F.approx_count_distinct(column) if approximate else F.countDistinct(column)
