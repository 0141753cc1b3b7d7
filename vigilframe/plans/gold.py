"""Gold: KPIs, attack volumes, hourly summary, and the chart aggregates on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilframe.functions.events import distinct_count, hour_start, minutes_between, ratio
from vigilframe.sources.contracts import EVENT_TYPE_CATEGORIES

SLA_MINUTES = 240


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def kpi_summary(silver: DataFrame) -> DataFrame:
    """All scalar KPIs in one aggregate; one row, also on empty input.

    Detection and response times are not limited to attack types: any event that
    carries them counts.
    """
    resolved = F.col("resolution_time").isNotNull()
    respond = minutes_between(F.col("detection_time"), F.col("resolution_time"))
    return silver.agg(
        F.count_if("is_attack_event").alias("total_attacks"),
        ratio(
            F.count_if(_is("failed_login")),
            F.count_if(F.col("event_type").isin("failed_login", "successful_login")),
        ).alias("failed_login_rate"),
        F.avg(
            F.when(
                F.col("detection_time").isNotNull(),
                minutes_between(F.col("event_time"), F.col("detection_time")),
            )
        ).alias("avg_mttd_minutes"),
        F.avg(F.when(resolved, respond)).alias("avg_mttr_minutes"),
        ratio(F.count_if(resolved & (respond <= SLA_MINUTES)), F.count_if(resolved)).alias("sla_compliance"),
        F.current_timestamp().cast("timestamp_ntz").alias("computed_at"),
    )


def attack_volume_by_day(silver: DataFrame) -> DataFrame:
    """Attacks per day with a running total.

    The running window has no partition, but it runs over one row per calendar day.
    """
    daily = (
        silver.filter("is_attack_event")
        .groupBy(F.to_date("event_time").alias("event_date"))
        .agg(F.count("*").alias("attack_count"))
    )
    return daily.withColumn(
        "cumulative_attack_count", F.sum("attack_count").over(Window.orderBy("event_date"))
    )


def attack_volume_by_country(silver: DataFrame) -> DataFrame:
    """Attacks per country and their share of all attacks.

    The total is a scalar subquery over the same grouped rows (its shuffle is reused),
    so no task has to hold all countries.
    """
    return _with_share(
        silver.filter("is_attack_event").groupBy("country").agg(F.count("*").alias("attack_count")),
        "attack_count", "percentage_of_total",
    )


def _with_share(grouped: DataFrame, count: str, share: str) -> DataFrame:
    total = grouped.agg(F.sum(count).alias("total")).scalar()
    return grouped.withColumn(share, ratio(F.col(count), total))


def hourly_event_summary(silver: DataFrame, approximate: bool = False) -> DataFrame:
    """Events, sources and users per hour and type."""
    return (
        silver.groupBy(hour_start(F.col("event_time")).alias("event_hour"), "event_type")
        .agg(
            F.count("*").alias("event_count"),
            distinct_count("src_ip", approximate).alias("unique_ips"),
            distinct_count("username", approximate).alias("unique_users"),
        )
    )


# Charts.

def events_by_type(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_type").agg(F.count("*").alias("event_count")).orderBy(
        F.desc("event_count"), "event_type"
    )


def severity_distribution(silver: DataFrame) -> DataFrame:
    return _with_share(
        silver.groupBy("severity").agg(F.count("*").alias("event_count")), "event_count", "share"
    ).orderBy(F.desc("event_count"), "severity")


def hourly_activity(silver: DataFrame) -> DataFrame:
    return silver.groupBy("hour_of_day").agg(F.count("*").alias("event_count")).orderBy("hour_of_day")


def top_countries(by_country: DataFrame, n: int = 10) -> DataFrame:
    return by_country.orderBy(F.desc("attack_count"), "country").limit(n)


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """The five big numbers: maximum over the one-row KPI table."""
    names = ("total_attacks", "failed_login_rate", "avg_mttd_minutes", "avg_mttr_minutes", "sla_compliance")
    return kpis.agg(*[F.max(n).alias(n) for n in names])


_GRAINS = {"hour": "1 hour", "day": "1 day"}


def series(df: DataFrame, time: str, grain: str, **aggregates: Column) -> DataFrame:
    """Aggregates per hour or day of ``time``, oldest first."""
    start = F.window(F.col(time).cast("timestamp_ntz"), _GRAINS[grain])["start"].alias("bucket")
    return df.groupBy(start).agg(*[c.alias(n) for n, c in aggregates.items()]).orderBy("bucket")


def attack_timeline(by_day: DataFrame) -> DataFrame:
    return series(by_day, "event_date", "day", attack_count=F.sum("attack_count"))


def anomaly_timeline(results: DataFrame) -> DataFrame:
    return series(results, "window_start", "hour", anomaly_score=F.avg("anomaly_score"))


def anomaly_summary(results: DataFrame) -> DataFrame:
    """Flagged and total windows, and the flagged percentage to two places."""
    flagged, total = F.count_if("is_anomaly"), F.count("*")
    return results.agg(
        flagged.alias("n_anomalies"),
        total.alias("n_windows"),
        F.bround(flagged / F.nullif(total, F.lit(0)) * 100, 2).alias("anomaly_percentage"),
        F.min("window_start").alias("first_window"),
        F.max("window_end").alias("last_window"),
    )


# Further KPIs the requirements describe.

def top_targeted_users(silver: DataFrame, n: int = 10) -> DataFrame:
    return (
        silver.filter("is_attack_event").groupBy("username").agg(F.count("*").alias("attack_count"))
        .orderBy(F.desc("attack_count"), "username").limit(n)
    )


def attack_severity_distribution(silver: DataFrame) -> DataFrame:
    return _with_share(
        silver.filter("is_attack_event").groupBy("severity").agg(F.count("*").alias("attack_count")),
        "attack_count", "share",
    )


def repeat_offender_ips(silver: DataFrame, at_least: int = 5) -> DataFrame:
    return (
        silver.filter("is_attack_event").groupBy("src_ip")
        .agg(
            F.count("*").alias("attack_count"),
            F.min("event_time").alias("first_seen"),
            F.max("event_time").alias("last_seen"),
        )
        .filter(F.col("attack_count") >= at_least)
    )


def department_risk_score(silver: DataFrame) -> DataFrame:
    """Attacks weighted by severity rank, per department."""
    return (
        silver.filter("is_attack_event").groupBy("department")
        .agg(F.count("*").alias("attack_count"), F.sum("severity_rank").alias("risk_score"))
    )


def login_failure_by_hour(silver: DataFrame) -> DataFrame:
    return (
        silver.filter(_is("failed_login")).groupBy("hour_of_day")
        .agg(F.count("*").alias("failed_logins")).orderBy("hour_of_day")
    )


def geographic_anomaly_score(silver: DataFrame) -> DataFrame:
    """How far each country's daily attack count lies from that country's mean, in deviations.

    The window sees one row per day of a country.
    """
    daily = (
        silver.filter("is_attack_event")
        .groupBy("country", F.to_date("event_time").alias("event_date"))
        .agg(F.count("*").alias("attack_count"))
    )
    country = Window.partitionBy("country")
    mean, spread = F.avg("attack_count").over(country), F.stddev_samp("attack_count").over(country)
    return daily.withColumn(
        "z_score", F.round(F.coalesce((F.col("attack_count") - mean) / F.nullif(spread, F.lit(0.0)), F.lit(0.0)), 6)
    )


def event_type_categories(spark) -> DataFrame:
    """The eight-row lookup of category and attack flag."""
    rows = ", ".join(f"('{t}', '{c}', {str(a).lower()})" for t, c, a in EVENT_TYPE_CATEGORIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS m(event_type, category, is_attack)")


def events_by_category(silver: DataFrame) -> DataFrame:
    """Counts per category; the lookup has eight rows, so it is broadcast.

    Counting by type first leaves at most eight rows to join.
    """
    by_type = silver.groupBy("event_type").agg(F.count("*").alias("n"))
    lookup = F.broadcast(event_type_categories(silver.sparkSession))
    return by_type.join(lookup, "event_type").groupBy("category", "is_attack").agg(
        F.sum("n").alias("event_count")
    )
