"""One query per operator over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import checks
from ..functions import fields, labels
from ..names import COHORT, CONV_TS, FLAG, JOURNEY, MODELS, TOUCHPOINT, USER, VISIT_TS
from ..operators import appevents, classify, journeys, ltv, markov, marts, models, timing, windows
from ..runtime import materialize, scratch_path
from ..sinks import tables as sinks
from ..sources import tables
from .attribution import attribute, run_app_events
from .stages import AS_OF, Stages, stages

FIRST_RUN, LAST_RUN = AS_OF - timedelta(15), AS_OF - timedelta(1)
ONE_DAY = date(2024, 1, 20)
HISTORY = (date(2024, 1, 10), date(2024, 1, 25))
ROLLING_DAYS = 90
DIGITS = 6
VISIT_KEYS = [USER, VISIT_TS, CONV_TS, "conversion_type"]


def finish(df: DataFrame) -> DataFrame:
    """Doubles rounded to what summation order leaves alone, in two steps, as halves would fall either way; timestamps without zone."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(F.round(column, DIGITS + 3), DIGITS)
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# ---- sources and sinks ------------------------------------------------------------------------


def slice_counts(visits: DataFrame, *keys: str) -> DataFrame:
    return visits.groupBy(*keys).agg(F.count(F.lit(1)).alias("visits"), F.count_distinct(USER).alias("users"))


def written(s: Stages, df: DataFrame, write: Callable[[DataFrame, str], object]) -> DataFrame:
    """Write twice as a repeated run would, then read back. The rows are made once: a run writes them aside first."""
    path = scratch_path(s.spark)
    df = materialize(df)
    write(df, path)
    write(df, path)
    return s.spark.read.parquet(path).select(*df.columns)


def rewritten_day(s: Stages, write: Callable[[DataFrame, str], object]) -> DataFrame:
    """Write all days, then one day again with doubled scores: only that day changes."""
    path = scratch_path(s.spark)
    totals = materialize(s.totals.select("channels", *COHORT, MODELS["last_click"]))
    write(totals, path)
    again = totals.filter(F.col("run_date") == F.lit(ONE_DAY))
    write(again.withColumn(MODELS["last_click"], F.col(MODELS["last_click"]) * 2), path)
    return s.spark.read.parquet(path).select(*totals.columns)


def write_skip_empty(s: Stages) -> DataFrame:
    path = scratch_path(s.spark)
    totals = materialize(s.totals.select("channels", *COHORT, MODELS["last_click"]))
    nothing = totals.filter("conversion_type = 'Renewal'")
    rows = [(sinks.skip_empty(totals, path), "filled"), (sinks.skip_empty(nothing, path), "empty")]
    wrote = F.create_map(*[F.lit(x) for name_and_flag in rows for x in name_and_flag[::-1]])
    kept = s.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("kept_rows"))
    return kept.select(F.explode(wrote).alias("input", "written"), "kept_rows")


def mart_partitioned(s: Stages) -> DataFrame:
    """All rows of the four daily tables, written and read back, with the columns that any of them has."""
    parts = []
    for name, path in run_app_events(s.app_events, scratch_path(s.spark)).items():
        back = s.spark.read.parquet(path).withColumn("mart", F.lit(name))
        rows = {"installs": "total", "total_events": "total", "total_purchases": "total"}
        users = {"unique_user_installs": "users", "unique_users": "users", "unique_purchasers": "users"}
        parts.append(back.withColumnsRenamed(rows | users))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def view_vs_table(s: Stages) -> DataFrame:
    view = sinks.as_view(s.recent_ltv, "recent_ltv")
    path = scratch_path(s.spark)
    sinks.truncate(view.withColumn("run_date", F.to_date("product_order_timestamp")), path)
    table = s.spark.read.parquet(path)
    counted = [
        df.agg(F.count(F.lit(1)).alias("orders"), F.sum(ltv.LTV).alias("total_ltv")).withColumn("kind", F.lit(kind))
        for kind, df in (("view", view), ("table", table))
    ]
    return counted[0].unionByName(counted[1])


# ---- projections ------------------------------------------------------------------------------

SHOWN = [
    "visit_traffic_source_type", "visit_traffic_source_name", "segment_name", "segment_campaign_name",
    "segment_campaign_grouping", "segment_channel", "is_campaign_landing",
]


def label_counts(s: Stages, *names: str) -> DataFrame:
    return s.classified.groupBy(*SHOWN, *names).agg(F.count(F.lit(1)).alias("visits"))


def delimited_part_pick(s: Stages) -> DataFrame:
    named = s.visits.select(F.col("visit_traffic_source_name").alias("name"))
    parts = F.split(F.col("name"), "_")
    enough = F.length("name") - F.length(F.replace(F.col("name"), F.lit("_"), F.lit(""))) >= 5
    picked = named.filter(enough).select(
        "name", F.lower(F.get(parts, F.lit(1))).alias("channel"), F.lower(F.get(parts, F.lit(2))).alias("platform")
    )
    return picked.groupBy("name", "channel", "platform").agg(F.count(F.lit(1)).alias("visits"))


def flagged(s: Stages, rule: str) -> DataFrame:
    placed = journeys.touches(s.windowed, rule, laid_out=True)
    return placed.groupBy(*COHORT, USER).agg(
        F.count(F.lit(1)).alias("visits"), F.sum(FLAG).cast("long").alias("conversions"),
        F.max("journey_no").alias("last_journey"),
    )


def sanitized(s: Stages) -> DataFrame:
    """Score columns under the raw names of the models, renamed for output."""
    raw = {
        "attribution_position_based_0.3_0.3_0.4_heuristic": MODELS["position_based"],
        "attribution_time_decay0.6__heuristic": MODELS["time_decay"],
    }
    renamed = s.totals.select("channels", *COHORT, *[F.col(name).alias(odd) for odd, name in raw.items()])
    return fields.sanitize_columns(renamed)


def dotted(s: Stages) -> DataFrame:
    return fields.dots_to_underscores(
        s.totals.select("channels", *COHORT, F.col(MODELS["last_click"]).alias("attribution.last click.heuristic"))
    )


def user_from_journey_id(s: Stages) -> DataFrame:
    # Every touch of a rolling cohort may end a journey, so there are later journeys too.
    placed = rolling_touches(s)
    # A user's journeys are in one task, so they are counted by user before anything is shuffled.
    ids = placed.select(*COHORT, USER, "journey_no").distinct()
    ids = ids.withColumn("journey_id", fields.journey_id(F.col(USER), F.col("journey_no")))
    users = ids.select(
        *COHORT,
        USER,
        fields.user_of_journey(F.col("journey_id")).alias("user"),
        fields.user_of_journey(F.col("journey_id"), first_only=True).alias("first_user"),
    )
    counts = users.groupBy(*COHORT, USER).agg(
        F.count("user").alias("journeys"), F.count("first_user").alias("first_journeys"), F.max("user").alias("user")
    )
    return counts.groupBy(*COHORT).agg(
        F.sum("journeys").alias("journeys"), F.sum("first_journeys").alias("first_journeys"),
        F.count_distinct("user").alias("users"),
    )


def drop_zero_removal(s: Stages) -> DataFrame:
    return markov.drop_zero(markov.removal_effects(s.raw_effects))


# ---- joins --------------------------------------------------------------------------------------


def window_rows(s: Stages, name: int) -> DataFrame:
    rows = windows.conversion_window(s.classified, AS_OF, name)
    return rows.select(*VISIT_KEYS, FLAG, "touchpoint")


def windows_all(s: Stages) -> DataFrame:
    rows = windows.explode_windows(windows.conversion_windows(s.classified, AS_OF))
    return slice_counts(rows.withColumn("run_date", F.to_date(CONV_TS)), *COHORT)


def product_join(s: Stages, *extra: str) -> DataFrame:
    joined = ltv.join_product(models.journeys(s.touches), s.windowed, extra)
    return joined.select(*JOURNEY, "conversion_value", ltv.PRODUCT, *extra)


def index_join(s: Stages) -> DataFrame:
    return timing.join_time_to_convert(s.visits)


def latest_row(s: Stages) -> DataFrame:
    return timing.latest_per_user(
        s.visits, ["b2c_product_type", ltv.PRODUCT, "b2c_product_name_and_term"], [ltv.PRODUCT, VISIT_TS]
    )


# ---- models -------------------------------------------------------------------------------------


def model_shares(s: Stages, model: str) -> DataFrame:
    credited = models.with_credits(s.touches, [model]) if model != "markov" else s.credited
    return credited.select(*JOURNEY, "position", "channel", MODELS[model])


def journey_rows(s: Stages) -> DataFrame:
    return s.touches.select(*JOURNEY, "position", "touch_count", "channel", "conversion_value")


def score_rows(s: Stages) -> DataFrame:
    return models.text_form(s.scores)


def touch_counts(s: Stages) -> DataFrame:
    rows = models.journeys(s.credited)
    named = fields.journey_id(F.col(USER), F.col("journey_no")).alias("journey_id")
    return rows.select(named, *COHORT, F.col("num_touchpoints").cast("long").alias("num_touchpoints"))


def effect_ltv_rows(s: Stages) -> DataFrame:
    rows = s.scores.filter("conversion_value = 1").join(s.valued.select(*JOURNEY, ltv.PRODUCT, ltv.LTV), JOURNEY)
    return rows.select("journey_id", *COHORT, ltv.PRODUCT, "part", ltv.effect_ltv_text().alias("removal_effect_ltv"))


def exploded_ltv(s: Stages) -> DataFrame:
    rows = ltv.explode_channel_ltv(effect_ltv_rows(s)).select(*COHORT, "channel", "ltv")
    return rows.groupBy(*COHORT, "channel").agg(
        F.count(F.lit(1)).alias("touches"), F.sum("ltv").alias("total_ltv")
    )


def rolling_touches(s: Stages, label: Column | None = None) -> DataFrame:
    labelled = s.subscriptions.withColumn(TOUCHPOINT, labels.touchpoint_label() if label is None else label)
    rows = windows.rolling_cohorts(labelled, "Subscription", ROLLING_DAYS, classify.frequent_sources(s.visits))
    return journeys.touches(rows, "conversion_day")


def rolling_totals(s: Stages) -> DataFrame:
    placed = rolling_touches(s)
    heuristics = models.channel_totals(models.with_credits(placed))
    return heuristics


def rolling_effects(s: Stages) -> DataFrame:
    # By channel and platform: whole touchpoints of 90 days make groups that SQL takes minutes to invert.
    label = F.concat_ws(" | ", "media_type", "channel", "platform")
    steps = materialize(markov.edges(rolling_touches(s, label)))
    return markov.removal_effects(materialize(markov.removal_effects_raw(steps)))


def dense_matrix(s: Stages) -> DataFrame:
    """All pairs of platforms; of whole touchpoints there are too many for a dense matrix."""
    placed = journeys.touches_once(s.windowed, channel="platform", laid_out=True)
    return markov.dense_transitions(materialize(markov.edges(placed)))


def melted_matrix(s: Stages) -> DataFrame:
    """The transition probabilities as rows of a sparse matrix, then back to long."""
    return markov.melt(markov.sparse_rows(s.steps))


def removal_effect_only(s: Stages) -> DataFrame:
    return markov.removal_effects(s.raw_effects).drop("removal_effect_raw")


def full_run(s: Stages) -> DataFrame:
    """Row counts of all result tables of a run on full touchpoints."""
    results = attribute(s.windowed, s.recent_ltv, laid_out=True, tasks=s.tasks)
    counts = [
        table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("result"), "rows")
        for name, table in vars(results).items()
    ]
    return checks.report(counts)


# ---- window functions, sorts, unions --------------------------------------------------------------


def source_frequency(s: Stages) -> DataFrame:
    rows = classify.frequent_sources(s.visits)
    return rows.groupBy("visit_traffic_source_type", "source_frequency").agg(F.count(F.lit(1)).alias("visits"))


def source_frequency_daily(s: Stages) -> DataFrame:
    """The same from a table of daily counts, made ten days before the last visit and brought up to date with late rows."""
    path = scratch_path(s.spark)
    last = s.visits.agg(F.max(F.to_date(VISIT_TS))).first()[0]
    if last is None:
        return source_frequency(s)
    classify.refresh_sources(s.visits, path, last=last - timedelta(10))
    counts = classify.refresh_sources(s.visits, path, last - timedelta(20), last)
    rows = classify.frequent_sources(s.visits, counts=counts)
    return rows.groupBy("visit_traffic_source_type", "source_frequency").agg(F.count(F.lit(1)).alias("visits"))


def user_dates(s: Stages, *columns: str) -> DataFrame:
    exploded = windows.explode_windows(s.windowed)
    return timing.user_first_last(exploded, [*COHORT, USER]).select(*COHORT, USER, *columns)


def sort_user_time(s: Stages) -> DataFrame:
    """The channels of each journey in their order."""
    return s.touches.select(*JOURNEY, "position", VISIT_TS, "channel")


def share_of_total(s: Stages) -> DataFrame:
    column = MODELS["last_click"]
    return markov.share_of_total(s.totals.select(*COHORT, "channels", column), column)


def union_cohorts(s: Stages) -> DataFrame:
    """The types of conversion attributed apart, then put together."""
    parts = [
        models.channel_totals(models.with_credits(journeys.touches(tables.of_type(s.windowed, kind), laid_out=True)))
        for kind in ("Trial", "Subscription", "registration")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def union_literal(s: Stages) -> DataFrame:
    """The ids of the converting visits, and one row without id per conversion day."""
    converting = s.visits.filter("converting_visit = 1")
    ids = converting.select(ltv.PRODUCT)
    days = converting.select(F.to_date(CONV_TS)).distinct().select(F.lit(None).cast("long").alias(ltv.PRODUCT))
    return ids.unionByName(days).withColumnRenamed(ltv.PRODUCT, "id")


def filter_downstream(s: Stages) -> DataFrame:
    return union_literal(s).filter("id is not null")


def type_window_slices(s: Stages) -> DataFrame:
    return s.credited.groupBy("conversion_window", "conversion_type").agg(
        F.count(F.lit(1)).alias("touches"), F.count_distinct("channel").alias("channels"),
        F.sum(MODELS["markov"]).alias("credit"),
    )


def json_rows(s: Stages) -> DataFrame:
    kinds = {"AFEventParamRevenue": "int", "af_revenue": "float", "af_currency": "string", "af_order_id": "other"}
    return fields.json_fields(s.app_events, "event_value", kinds).select("event_time", "customer_user_id", *kinds)


def fill_product(s: Stages) -> DataFrame:
    """Missing products become 0."""
    joined = ltv.fill_product(ltv.join_product(models.journeys(s.touches), s.windowed))
    return joined.select(*JOURNEY, ltv.PRODUCT)


# ---- checks -----------------------------------------------------------------------------------


def not_null(s: Stages) -> DataFrame:
    app = checks.not_null(s.app_events, ["media_source", "customer_user_id"])
    visit = checks.not_null(s.visits, [USER, "visit_traffic_source_name", "segment_channel"])
    return checks.report([visit, app])


def accepted(s: Stages) -> DataFrame:
    types = checks.accepted_values(s.visits, "conversion_type", ["Trial", "Subscription"])
    devices = checks.accepted_values(s.visits, "visit_device_type", ["desktop", "mobile"])
    return checks.report([types, devices])


def unique(s: Stages) -> DataFrame:
    return checks.report([checks.unique(s.user_ltv, c) for c in (ltv.LTV, ltv.PRODUCT)])


_BUILD: dict[str, Callable[[Stages], DataFrame]] = {
    # sources and sinks
    "src_visits": lambda s: tables.stage_visits(s.visits),
    "src_app_events": lambda s: tables.stage_app_events(s.app_events),
    "src_ltv_recent": lambda s: tables.recent_ltv(s.user_ltv, AS_OF),
    "slice_conversion_day": lambda s: slice_counts(tables.with_run_date(s.visits), "run_date", "conversion_type"),
    "conversion_day": lambda s: tables.conversion_day(s.visits, ONE_DAY).select(*VISIT_KEYS, "run_date"),
    "run_date_range": lambda s: slice_counts(tables.run_dates(s.visits, AS_OF), "run_date"),
    "data_date_range": lambda s: tables.date_range(s.visits),
    "distinct_conversion_dates": lambda s: tables.conversion_dates(s.visits, FIRST_RUN, LAST_RUN),
    "scan_date_between": lambda s: slice_counts(
        tables.with_run_date(tables.scan_dates(s.visits, *HISTORY)), "run_date", "conversion_type"
    ),
    "write_replace_cohort": lambda s: written(s, s.totals, sinks.replace_cohorts),
    "write_replace_day": lambda s: rewritten_day(s, sinks.replace_days),
    "write_append": lambda s: written(s, s.totals, sinks.append),
    "write_truncate": lambda s: written(s, timing.median_days_by_date(s.visits), sinks.truncate),
    "write_skip_empty": write_skip_empty,
    "mart_partitioned": mart_partitioned,
    "view_vs_table": view_vs_table,
    # projections, filters
    "touchpoint_label": lambda s: s.classified.select(*VISIT_KEYS, labels.touchpoint_label().alias("touchpoint")),
    "product_label": lambda s: s.visits.groupBy(
        "product_name", "b2c_product_name_and_term", labels.product_label().alias("product_label")
    ).agg(F.count(F.lit(1)).alias("visits")),
    "b2c_converting_filter": lambda s: windows.converters(s.visits, AS_OF),
    "classify_media_type": lambda s: label_counts(s, "media_type"),
    "classify_processed_channel": lambda s: label_counts(s, "processed_channel"),
    "classify_processed_platform": lambda s: label_counts(s, "processed_platform"),
    "classify_static_channel": lambda s: label_counts(s, "static_channel"),
    "classify_static_platform": lambda s: label_counts(s, "static_platform"),
    "channel_fallback": lambda s: label_counts(s, "channel"),
    "platform_fallback": lambda s: label_counts(s, "platform"),
    "delimited_part_pick": delimited_part_pick,
    "parse_channels": lambda s: labels.parse_touchpoint(s.totals.select("channels", *COHORT)).drop("channel_name"),
    "channel_name_middle": lambda s: labels.parse_touchpoint(s.totals.select("channels", *COHORT)).select(
        "channels", *COHORT, "channel_name"
    ),
    "clean_media": lambda s: marts.channel_mart(s.totals).select(
        "channels", *COHORT, "cleaned_media_channel", "cleaned_media_type", "cleaned_platform"
    ),
    "trial_direct": lambda s: marts.channel_mart(s.totals).groupBy(*COHORT, "trial_direct").agg(
        F.count(F.lit(1)).alias("channels"), F.sum(MODELS["last_click"]).alias("last_click")
    ),
    "app_group": lambda s: s.app_events.groupBy(
        "app_id",
        appevents.app_group(appevents.PLAIN_EDITION).alias("plain_group"),
        appevents.app_group(appevents.BRANDED_EDITION).alias("branded_group"),
    ).agg(F.count(F.lit(1)).alias("events")),
    "app_channel_category": lambda s: s.app_events.groupBy(
        "media_source", "campaign_type", "platform", appevents.channel_category().alias("channel_category")
    ).agg(F.count(F.lit(1)).alias("events")),
    "purchase_type": lambda s: appevents.purchases(s.app_events).groupBy("product_id", "purchase_type").agg(
        F.count(F.lit(1)).alias("events")
    ),
    "app_installs": lambda s: appevents.installs(s.app_events),
    "app_purchases": lambda s: appevents.purchases(s.app_events),
    "app_engagement": lambda s: appevents.engagement(s.app_events),
    "app_subscription_events": lambda s: appevents.subscription_events(s.app_events),
    "flag_converting_visit": lambda s: flagged(s, "last_visit"),
    "flag_converting_by_conv_ts": lambda s: flagged(s, "conversion_time"),
    "flag_last_visit_only": lambda s: flagged(s, "last_visit_only"),
    "flag_by_conversion_date": lambda s: flagged(s, "conversion_day"),
    "sanitize_columns": sanitized,
    "dots_to_underscores": dotted,
    "user_from_journey_id": user_from_journey_id,
    "conversion_type_split": lambda s: slice_counts(
        tables.with_run_date(tables.of_type(s.visits, "Trial")), "run_date", "conversion_type"
    ),
    "converted_only": lambda s: ltv.converted_only(models.journeys(s.touches)),
    "drop_zero_removal": drop_zero_removal,
    "fill_product_id": fill_product,
    # joins
    "conversion_window_30": lambda s: window_rows(s, 30),
    "conversion_window_60": lambda s: window_rows(s, 60),
    "conversion_window_90": lambda s: window_rows(s, 90),
    "conversion_windows_all": windows_all,
    "join_product_arrangement": lambda s: product_join(s),
    "join_product_arrangement_ext": lambda s: product_join(s, "is_app_conversion", "product_type"),
    "join_ltv": lambda s: s.valued.select(*JOURNEY, "num_touchpoints", ltv.PRODUCT, ltv.LTV),
    "join_avg_ltv": lambda s: s.effects,
    "mart_removal_ltv": lambda s: marts.removal_ltv_mart(marts.channel_mart(s.totals), s.effects),
    "index_join_time_to_convert": index_join,
    "latest_row_per_user": latest_row,
    # aggregations
    "daily_installs": lambda s: appevents.daily_installs(s.app_events),
    "daily_engagement": lambda s: appevents.daily_engagement(s.app_events),
    "daily_subscription_events": lambda s: appevents.daily_subscription_events(s.app_events),
    "daily_purchases": lambda s: appevents.daily_purchases(s.app_events),
    "distinct_converters": lambda s: windows.converters(s.classified, AS_OF),
    "distinct_classified": lambda s: slice_counts(s.classified, "visit_traffic_source_type", "conversion_type"),
    "dedup_user_rows": lambda s: ltv.journey_ltv(
        models.journeys(s.touches), s.windowed, s.recent_ltv, ("is_app_conversion",)
    ).dropDuplicates(),
    "ltv_mean_dedup": lambda s: ltv.mean_ltv(s.user_ltv),
    "avg_ltv_per_channel": lambda s: s.averages,
    "median_days_to_convert": lambda s: timing.median_days(s.touches),
    "median_days_by_conv_date": lambda s: timing.median_days_by_date(s.visits),
    "user_first_last": lambda s: timing.user_first_last(s.visits),
    "channel_totals": lambda s: s.totals,
    # models
    "build_journeys": journey_rows,
    "attr_last_click": lambda s: model_shares(s, "last_click"),
    "attr_first_click": lambda s: model_shares(s, "first_click"),
    "attr_position_based": lambda s: model_shares(s, "position_based"),
    "attr_time_decay": lambda s: model_shares(s, "time_decay"),
    "markov_transitions": lambda s: markov.transitions(s.steps),
    "markov_matrix_dense": dense_matrix,
    "markov_removal_effect": removal_effect_only,
    "removal_effect_raw": lambda s: markov.removal_effects(s.raw_effects),
    "attr_markov": lambda s: model_shares(s, "markov"),
    "journey_scores": score_rows,
    "num_touchpoints": touch_counts,
    "rolling_cohort_90": rolling_totals,
    "rolling_cohort_90_effects": rolling_effects,
    "removal_effect_ltv": effect_ltv_rows,
    "explode_channel_ltv": exploded_ltv,
    # window functions
    "source_frequency": source_frequency,
    "source_frequency_daily": source_frequency_daily,
    "user_max_date": lambda s: user_dates(s, "last_visit"),
    "running_journey_no": lambda s: rolling_touches(s).groupBy(*COHORT).agg(
        F.count(F.lit(1)).alias("touches"), F.sum("journey_no").alias("journey_sum"),
        F.max("journey_no").alias("last_journey"),
    ),
    "touch_lead": lambda s: s.touches.select(*JOURNEY, "position", "channel", "next_channel"),
    "share_of_total": share_of_total,
    # sorts
    "sort_user_time": sort_user_time,
    "order_dates": lambda s: tables.conversion_dates(s.visits),
    "top1_per_user": lambda s: timing.latest_per_user(s.visits, [ltv.PRODUCT], [ltv.PRODUCT, VISIT_TS]),
    # set operations, reshaping
    "union_cohorts": union_cohorts,
    "union_all_literal": union_literal,
    "filter_downstream": filter_downstream,
    "melt_matrix": melted_matrix,
    "explode_rows": lambda s: s.scores.select("journey_id", *COHORT, F.explode("touches").alias("touch")).select(
        "journey_id", *COHORT, "touch.position", "touch.channel"
    ),
    "type_window_slices": type_window_slices,
    "json_fields": json_rows,
    # checks and the whole run
    "check_not_null": not_null,
    "check_accepted_values": accepted,
    "check_unique": unique,
    "full_run": full_run,
}


def _query(build: Callable[[Stages], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: finish(build(stages(spark, folder)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(build) for name, build in _BUILD.items()}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Conversions per channel, day, type and window under all five models."""
    return finish(stages(spark, folder).totals)
