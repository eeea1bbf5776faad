"""The whole run, from visits to result tables, all cohorts at once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import checks
from ..functions.labels import touchpoint_label
from ..names import COHORT, CONV_TS, TOUCHPOINT, WINDOWS
from ..operators import ltv as value
from ..operators import appevents, markov, marts, models, timing
from ..operators.classify import classify, frequent_sources, refresh_sources
from ..operators.journeys import LAYOUT, SPLIT_KEYS, per_window, touches, touches_once
from ..operators.windows import conversion_windows, rolling_cohorts
from ..runtime import layout_tasks, materialize, materialize_by
from ..sinks import tables as sinks
from ..sources.tables import RUN_DAYS, of_type, recent_ltv, run_dates


@dataclass
class Results:
    user_journeys: DataFrame
    channel_level: DataFrame
    transitions: DataFrame
    removal_effects: DataFrame
    conversion_time: DataFrame
    mart_channel: DataFrame
    mart_removal_ltv: DataFrame


# Fixed value: the name under which registrations are reported.
REPORTED_TYPES = {"registration": "Registration"}


def reported_type(df: DataFrame) -> DataFrame:
    kind = F
    for name, reported in REPORTED_TYPES.items():
        kind = kind.when(F.col("conversion_type") == name, reported)
    return df.withColumn("conversion_type", kind.otherwise(F.col("conversion_type")))


def windowed_visits(
    visits: DataFrame, as_of: date, days: int = RUN_DAYS, windows: dict[int, int] = WINDOWS, counts: DataFrame | None = None
) -> tuple[DataFrame, int | None]:
    """Classified visits in the windows of the conversions of the run dates, and the tasks they are laid out in, if more than
    the session's.

    Only these conversions: the others need no dropping of copies and no labels. The rows are shuffled once, by user:
    copies, converters, journeys, products and values are all found within that layout, which the written table keeps.
    """
    rows = run_dates(visits.filter("b2b_b2c = 'B2C'"), as_of, days).count()
    tasks = layout_tasks(rows, visits.sparkSession)
    classified = run_dates(classify(visits, counts=counts, by=LAYOUT, tasks=tasks), as_of, days)
    found = run_dates(conversion_windows(classified, as_of, windows, days, laid_out=True), as_of, days)
    return materialize_by(found, LAYOUT, tasks), tasks


def attribute(
    windowed: DataFrame, ltv: DataFrame, rule: str = "last_visit", channel: str = TOUCHPOINT, extra: tuple[str, ...] = (),
    laid_out: bool = False, tasks: int | None = None,
) -> Results:
    """All results from visits in their conversion windows; `extra` are further columns of the products.

    Touches and step counts feed several results, so both are written once, a touch and a step once for all windows.
    `laid_out` and `tasks` tell of visits from `windowed_visits`.
    """
    once = touches_once(windowed, rule, channel, laid_out=laid_out, layout=tasks)
    stored = materialize_by(once, LAYOUT if laid_out else SPLIT_KEYS, tasks)
    placed = per_window(stored)
    counts = materialize(markov.step_counts(stored) if "placed" in stored.columns else markov.edges(stored))
    steps = markov.per_window_steps(counts)
    raw = materialize(markov.removal_effects_raw(counts))
    credited = models.with_credits(markov.with_markov_credit(placed, raw))
    if not markov.sent(raw):  # else credits are made anew from the layout, three times, with nothing shuffled or written
        credited = materialize(credited)
    scores = models.journey_scores(credited)
    valued = materialize(value.journey_ltv(models.journeys(placed), windowed, ltv, extra))
    averages = value.average_ltv(credited, valued)
    totals = materialize(models.channel_totals(credited))
    effects = materialize(value.join_average_ltv(markov.removal_effects(raw), averages))
    keys = [*COHORT, "user_guid", "journey_no"]
    per_journey = valued.select(*keys, value.PRODUCT, value.LTV, *extra)
    user_rows = scores.filter("conversion_value = 1").join(per_journey, keys)
    user_rows = models.with_texts(user_rows.withColumn("removal_effect_ltv", value.effect_ltv()))
    mart = marts.channel_mart(totals)
    return Results(
        user_journeys=reported_type(user_rows),
        channel_level=reported_type(totals),
        transitions=reported_type(markov.transitions(steps)),
        removal_effects=reported_type(effects),
        conversion_time=timing.median_days(placed),
        mart_channel=reported_type(mart),
        mart_removal_ltv=reported_type(marts.removal_ltv_mart(mart, effects)),
    )


# The data tests of the marts.
MART_RULES = {
    "mart_channel": (["run_date", "conversion_window"], {"conversion_type": ["Trial", "Subscription", "Registration"]}),
    "mart_removal_ltv": (["run_date"], {"conversion_type": ["Trial", "Subscription", "Registration"]}),
}


def publish(tables: dict[str, DataFrame], output: str, writers: dict[str, Callable[[DataFrame, str], None]]) -> dict[str, str]:
    """Write all tables aside, counting the violations of their rules on the way, then replace what they stand for.

    Nothing is replaced unless every table was written and no rule is broken.
    """
    staged, watches = {}, []
    for name, table in tables.items():
        if name in MART_RULES:
            table, watch = checks.observed(table, *MART_RULES[name])
            watches.append(watch)
        staged[name] = materialize(table)
    for watch in watches:
        checks.require_observed(watch)
    paths = {name: f"{output}/{name}" for name in tables}
    for name, table in staged.items():
        writers.get(name, sinks.replace_cohorts)(table, paths[name])
    return paths


def run(
    visits: DataFrame,
    ltv: DataFrame,
    as_of: date,
    output: str,
    days: int = RUN_DAYS,
    types: tuple[str, ...] | None = None,
    rule: str = "last_visit",
    windows: dict[int, int] = WINDOWS,
    extra: tuple[str, ...] = (),
    mean_values: bool = False,
    source_counts: str | None = None,
) -> dict[str, str]:
    """Classify, window, attribute, check and write; the last `days` days are replaced on every run.

    A back-fill is a run of more days. `types` limits the types of conversion, `windows` the look-backs (name to days),
    `rule` says which visits convert, `extra` adds columns of the product join, and with `mean_values` several values of
    one order count as their mean. `source_counts` is the folder of a table made by `refresh_sources`: the run counts its
    own days anew and takes the rest from there, instead of counting the sources of all history.
    """
    counts = refresh_sources(visits, source_counts, as_of - timedelta(days), as_of) if source_counts else None
    if types:
        visits = visits.filter(F.col("conversion_type").isin(*types))
    # Conversions outside the run dates are filtered at the scan, before copies are dropped.
    windowed, tasks = windowed_visits(visits, as_of, days, windows, counts)
    values = recent_ltv(ltv, as_of, days)
    values = value.mean_ltv(values) if mean_values else values
    results = attribute(windowed, values, rule, extra=extra, laid_out=True, tasks=tasks)
    return publish(vars(results), output, {"conversion_time": sinks.replace_days})


def run_rolling(visits: DataFrame, output: str, conversion_type: str = "Subscription", days: int = 90) -> dict[str, str]:
    """Cohorts of every conversion date over the `days` before it: four tables, replaced by cohort."""
    # The other types only give dates: their copies need not be dropped.
    labelled = materialize(of_type(classify(visits).withColumn(TOUCHPOINT, touchpoint_label()), conversion_type))
    rows = rolling_cohorts(labelled, conversion_type, days, frequent_sources(visits))
    placed = materialize(touches(rows, "conversion_day"))
    steps = materialize(markov.edges(placed))
    raw = materialize(markov.removal_effects_raw(steps))
    credited = materialize(models.with_credits(markov.with_markov_credit(placed, raw)))
    tables = {
        "rolling_transitions": markov.transitions(steps),
        "rolling_removal_effects": markov.removal_effects(raw),
        "rolling_user_journeys": models.with_texts(models.journey_scores(credited)),
        "rolling_channel_level": models.channel_totals(credited),
    }
    return publish(tables, output, {})


def run_app_events(events: DataFrame, output: str) -> dict[str, str]:
    """The four daily tables of the app, their days replaced."""
    daily = {
        "daily_installs": appevents.daily_installs,
        "daily_engagement": appevents.daily_engagement,
        "daily_subscription_events": appevents.daily_subscription_events,
        "daily_purchases": appevents.daily_purchases,
    }
    paths = {name: f"{output}/{name}" for name in daily}
    for name, build in daily.items():
        sinks.write_mart(build(events), paths[name], sinks.MART_CLUSTERS[name])
    return paths


def run_median_history(visits: DataFrame, first: date, last: date, output: str) -> str:
    """Median days to convert of every conversion date of a span; the table is replaced whole."""
    path = f"{output}/median_history"
    medians = timing.median_days_by_date(visits).filter(F.col("run_date").between(F.lit(first), F.lit(last)))
    sinks.truncate(materialize(medians), path)
    return path
