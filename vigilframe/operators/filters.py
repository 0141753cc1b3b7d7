"""The dashboard's filters, applied before any aggregate."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F


def date_bounds(date_range: str | list[str] | tuple[str, str], as_of: date | None = None) -> tuple[date, date]:
    """First day and the day after the last.

    ``["2024-01-01", "2024-01-31"]`` includes both days; ``"Last N days"`` are the N whole
    days before ``as_of`` (today when not given).
    """
    if isinstance(date_range, str):
        relative = re.fullmatch(r"last (\d+) days?", date_range.strip().lower())
        if relative:
            end = as_of or date.today()
            return end - timedelta(days=int(relative.group(1))), end
        date_range = [date_range, date_range]
    first, last = (date.fromisoformat(d) for d in date_range)
    return first, last + timedelta(days=1)


def within(time: Column, bounds: tuple[date, date]) -> Column:
    """Half-open comparison against literals, so that it reaches the Parquet scan."""
    first, after = (F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz") for d in bounds)
    return (time >= first) & (time < after)


def restrict(df: DataFrame, column: str, bounds: tuple[date, date]) -> DataFrame:
    """Rows whose ``column`` lies in the bounds; stored events are also pruned by date directory."""
    df = df.filter(within(F.col(column).cast("timestamp_ntz"), bounds))
    if column == "event_time" and "event_date" in df.columns:
        first, after = (F.lit(d) for d in bounds)
        df = df.filter((F.col("event_date") >= first) & (F.col("event_date") < after))
    return df


@dataclass(frozen=True)
class FilterSpec:
    """Empty means no restriction; several restrictions must all hold."""

    event_types: tuple[str, ...] = ()
    severities: tuple[str, ...] = ()
    countries: tuple[str, ...] = ()
    departments: tuple[str, ...] = ()
    hours: tuple[int, ...] = ()
    weekdays: tuple[int, ...] = ()
    months: tuple[int, ...] = ()
    is_anomaly: bool | None = None
    date_range: str | tuple[str, str] | None = None
    as_of: date | None = None
    time_column: str = field(default="event_time")


def apply_filters(df: DataFrame, spec: FilterSpec) -> DataFrame:
    lists = {
        "event_type": spec.event_types,
        "severity": spec.severities,
        "country": spec.countries,
        "department": spec.departments,
        "hour_of_day": spec.hours,
        "day_of_week": spec.weekdays,
    }
    for column, values in lists.items():
        if values:
            df = df.filter(F.col(column).isin(*values))
    if spec.months:
        df = df.filter(F.month(spec.time_column).isin(*spec.months))
    if spec.is_anomaly is not None:
        df = df.filter(F.col("is_anomaly") == spec.is_anomaly)
    if spec.date_range is not None:
        df = restrict(df, spec.time_column, date_bounds(spec.date_range, spec.as_of))
    return df
