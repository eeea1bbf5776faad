"""Declared input schemas; the readers check tables against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

STR, TS, LONG, DBL, BOOL, DATE = (
    T.StringType(), T.TimestampType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.DateType(),
)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


VISIT_BASE = _struct(
    user_guid=STR,
    attribution_visit_start_time=TS,
    visit_traffic_source_type=STR,
    visit_traffic_source_name=STR,
    visit_device_type=STR,
    is_campaign_landing=BOOL,
    segment_name=STR,
    segment_campaign_name=STR,
    segment_campaign_grouping=STR,
    segment_channel=STR,
    segment_audience=STR,
    b2c_abstraction_datasource=STR,
    b2b_b2c=STR,
    product_name=STR,
    b2c_product_name_and_term=STR,
    geo_country_name=STR,
    conversion_visit_timestamp=TS,
    converting_visit=LONG,
)

VISITS = T.StructType(
    VISIT_BASE.fields
    + _struct(
        conversion_type=STR,
        product_arrangement_id=LONG,
        user_cohort_primary=STR,
        b2c_product_type=STR,
        is_app_conversion=BOOL,
        product_type=STR,
    ).fields
)

APP_EVENT_BASE = _struct(
    event_name=STR,
    event_value=STR,
    media_source=STR,
    platform=STR,
    event_time=TS,
    install_time=TS,
    campaign=STR,
    campaign_type=STR,
    region=STR,
    country_code=STR,
    appsflyer_id=STR,
    customer_user_id=STR,
    app_id=STR,
    app_name=STR,
)

APP_EVENTS = T.StructType(APP_EVENT_BASE.fields + _struct(partition_date=DATE).fields)

USER_LTV = _struct(
    user_guid=STR,
    ltv_acquisition_capped_12m=DBL,
    product_order_timestamp=TS,
    product_arrangement_id=LONG,
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep the declared columns in order, cast to the declared types; fail if one is missing."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.selectExpr(*[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in schema])
