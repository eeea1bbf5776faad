"""The three inputs and the date slices taken from them."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..names import CONV_TS
from ..schemas import APP_EVENT_BASE, APP_EVENTS, USER_LTV, VISIT_BASE, VISITS, conform

APP_EVENTS_SINCE = date(2023, 1, 1)
RUN_DAYS = 15


def read_visits(spark: SparkSession, path: str) -> DataFrame:
    return conform(spark.read.parquet(path), VISITS)


def read_app_events(spark: SparkSession, path: str, since: date = APP_EVENTS_SINCE) -> DataFrame:
    return stage_app_events(conform(spark.read.parquet(path), APP_EVENTS), since)


def read_user_ltv(spark: SparkSession, path: str) -> DataFrame:
    return conform(spark.read.parquet(path), USER_LTV)


def stage_visits(visits: DataFrame) -> DataFrame:
    return visits.select(*VISIT_BASE.names)


def stage_app_events(events: DataFrame, since: date = APP_EVENTS_SINCE) -> DataFrame:
    """`partition_date` is the table's partition column, so the bound prunes folders."""
    return events.filter(F.col("partition_date") >= F.lit(since)).select(*APP_EVENT_BASE.names)


def recent_ltv(ltv: DataFrame, as_of: date, days: int = RUN_DAYS) -> DataFrame:
    return ltv.filter(
        (F.col("product_order_timestamp") >= _midnight(as_of - timedelta(days)))
        & F.col("ltv_acquisition_capped_12m").isNotNull()
        & F.col("product_arrangement_id").isNotNull()
    ).select(*USER_LTV.names)


def _midnight(day: date) -> Column:
    return F.lit(datetime(day.year, day.month, day.day).isoformat(sep=" ")).cast("timestamp")


def date_between(column: str, first: date, last: date) -> Column:
    """`DATE(column) BETWEEN first AND last`, on the raw timestamp so that it is pushed down."""
    return (F.col(column) >= _midnight(first)) & (F.col(column) < _midnight(last + timedelta(1)))


def with_run_date(visits: DataFrame) -> DataFrame:
    return visits.withColumn("run_date", F.to_date(CONV_TS))


def run_dates(visits: DataFrame, as_of: date, days: int = RUN_DAYS) -> DataFrame:
    """Conversions of the last `days` days, ending yesterday."""
    return with_run_date(scan_dates(visits, as_of - timedelta(days), as_of - timedelta(1)))


def conversion_day(visits: DataFrame, day: date) -> DataFrame:
    return with_run_date(scan_dates(visits, day, day))


def scan_dates(visits: DataFrame, first: date, last: date, column: str = CONV_TS) -> DataFrame:
    return visits.filter(date_between(column, first, last))


def date_range(visits: DataFrame) -> DataFrame:
    return visits.agg(
        F.to_date(F.min(CONV_TS)).alias("min_date"), F.to_date(F.max(CONV_TS)).alias("max_date")
    )


def conversion_dates(visits: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    if first and last:
        visits = scan_dates(visits, first, last)
    days = visits.select(F.to_date(CONV_TS).alias("conversion_date")).distinct()
    return days.orderBy("conversion_date")


def of_type(visits: DataFrame, conversion_type: str) -> DataFrame:
    return visits.filter(F.col("conversion_type") == conversion_type)
