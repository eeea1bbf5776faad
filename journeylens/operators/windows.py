"""Visits in the look-back window before a conversion."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import touchpoint_label
from ..names import CONV_TS, USER, VISIT_TS, WINDOWS
from ..sources.tables import RUN_DAYS, _midnight

KEPT = [
    USER, VISIT_TS, CONV_TS, "visit_traffic_source_type", "visit_traffic_source_name", "visit_device_type",
    "converting_visit", "conversion_type", "product_arrangement_id", "geo_country_name", "product_name",
    "user_cohort_primary", "media_type", "channel", "platform", "b2c_product_type", "b2c_product_name_and_term",
]


def converters(visits: DataFrame, as_of: date, days: int = RUN_DAYS) -> DataFrame:
    """Distinct (user, conversion time) of recent B2C conversions."""
    recent = F.col(CONV_TS) >= _midnight(as_of - timedelta(days))
    converting = visits.filter((F.col("b2b_b2c") == "B2C") & (F.col("converting_visit") == 1) & recent)
    return converting.select(USER, CONV_TS).distinct()


def conversion_windows(
    visits: DataFrame, as_of: date, windows: dict[int, int] = WINDOWS, days: int = RUN_DAYS, laid_out: bool = False
) -> DataFrame:
    """Visits of converters of the last `days` days, with the list of windows each visit falls into.

    One pass serves all windows: the widest one filters, the list says which narrower ones
    hold the row too. The list is exploded only after the shuffle by user. With `laid_out`, visits that are laid out by
    user stay so, unsorted: the converters are hashed beside them.
    """
    widest = max(windows.values())
    # Both bounds are on raw columns, so they reach the scan; the one on visits follows from the other.
    recent = visits.filter(
        (F.col(CONV_TS) >= _midnight(as_of - timedelta(days)))
        & (F.col(VISIT_TS) >= _midnight(as_of - timedelta(days + widest)))
    )
    wanted = converters(visits, as_of, days)
    if laid_out:
        wanted = wanted.hint("shuffle_hash")
    visited, converted = F.to_date(VISIT_TS), F.to_date(CONV_TS)
    inside = recent.filter(
        (visited <= converted) & (visited >= F.date_sub(converted, widest))
    )
    held = F.array_compact(
        F.array(*[F.when(visited >= F.date_sub(converted, back), name) for name, back in windows.items()])
    )
    return (
        inside.join(wanted, [USER, CONV_TS], "left_semi")
        .select(
            *KEPT,
            *[c for c in ("is_app_conversion", "product_type") if c in visits.columns],
            touchpoint_label().alias("touchpoint"),
            held.alias("conversion_windows"),
        )
    )


def conversion_window(visits: DataFrame, as_of: date, name: int) -> DataFrame:
    """One window; `name` is 30, 60 or 90."""
    return conversion_windows(visits, as_of, {name: WINDOWS[name]}).drop("conversion_windows")


def explode_windows(windowed: DataFrame) -> DataFrame:
    return windowed.withColumn("conversion_window", F.explode("conversion_windows")).drop("conversion_windows")


def rolling_cohorts(
    visits: DataFrame, conversion_type: str = "Subscription", days: int = 90, every: DataFrame | None = None
) -> DataFrame:
    """Cohorts of every conversion date D: conversions and visits of [D - days, D].

    Each row is kept once, with the list `run_dates` of the at most `days` + 1 dates that it counts for and that occur;
    the list is exploded after the shuffle by user (see `touches_once`). The dates are collected: one per day of data.
    They are those of `every`, where `visits` hold one type only: a day with conversions of another type is a date too.
    """
    visited, converted = F.to_date(VISIT_TS), F.to_date(CONV_TS)
    dates = sorted(row.day for row in (every or visits).select(converted.alias("day")).distinct().collect() if row.day)
    if not dates:
        return visits.limit(0).withColumns({"run_dates": F.array(F.lit(None).cast("date")), "conversion_window": F.lit(days)})
    span = (dates[-1] - dates[0]).days + 1
    missing = sorted({dates[0] + timedelta(i) for i in range(span)} - set(dates))
    from_ = F.greatest(visited, converted, F.lit(dates[0]))
    to = F.least(F.date_add(F.least(visited, converted), days), F.lit(dates[-1]))
    listed = F.sequence(from_, to)
    if missing:
        listed = F.array_except(listed, F.array(*map(F.lit, missing)))
    rows = visits.filter((F.col("conversion_type") == conversion_type) & (from_ <= to))
    rows = rows.withColumns({"run_dates": listed, "conversion_window": F.lit(days)})
    return rows.filter(F.size("run_dates") > 0)
