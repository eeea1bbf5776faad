"""Derives the three inputs from the benchmark tables `events` and `nation`.

Only modulo, CASE and concatenation are used, so that any SQL engine derives the same rows.
The rules are listed in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import literal
from ..schemas import APP_EVENTS, USER_LTV, VISITS, conform

# Fixed values, by event_id modulo the length of the list.
SOURCES = [
    ("Search", "Google Organic"),
    ("sem", "Paid Media_H1_Search_Google_UK_x"),
    ("Social Free", "LinkedIn"),
    ("Marketing Email", "Weekly Newsletter"),
    ("Direct", "Direct"),
    ("External Display", "Paid Media_Display_DV360_UK_a_b"),
    ("Unclassified Referrer", "example.org"),
    ("Push Notification", "App Push"),
    ("Affiliates", "Affiliate One"),
    ("Facebook", "Social"),
    ("Barrier", "Barrier page"),
    (None, None),
]
RARE_EVENT = 77
DEVICES = ["desktop", "mobile", "tablet"]
CAMPAIGNS = ["onsite sale", "ppc push", "organic social", "video", "newsletter", None, "Paid Media - SEM"]
GROUPINGS = ["organic growth", "brand", None, "retention"]
SEGMENT_CHANNELS = ["sem", "marketing email", "editorial email", "direct email", None]
USER_COHORTS = ["new", "active", "lapsed"]
PRODUCTS = [
    ("E-Paper daily", "Digital"),
    ("The Edit app", "Edit"),
    ("Newspaper - 5 weekdays", "Print"),
    ("Newspaper - 6 days a week", "Print"),
    ("FT Weekend", "Print"),
    ("Newspaper - weekend only", "Print"),
    ("Digital", "Standard Monthly"),
    ("Digital", "Premium Monthly"),
    ("Digital", "Standard Annual"),
    ("Digital", "Premium Annual"),
    ("Digital", "Student"),
]
APP_PRODUCTS = [
    "sub_M_T",
    "x713f1e28_0bc5_8261_f1e6_eebab6f7600e_M",
    "xc8ad55e6_ba74_fea0_f9da_a4546ae2ee23_M",
    "x713f1e28_0bc5_8261_f1e6_eebab6f7600e_Annual",
    "xc8ad55e6_ba74_fea0_f9da_a4546ae2ee23_Annual",
    "p1m_premium",
    "p1m_standard",
    "p1y_premium",
    "p1y_standard",
    "other",
]
MEDIA_SOURCES = [
    "QR_code", "Email", "Web-to-app", "web_to_app", "googleadwords_int", "Apple Search Ads", "Newsfeed", "Partner",
]
APPS = [
    "com.ft.news", "id1200842933", "id1574510369", "com.ft.ftepaper.android", "id6449040684", "other.app",
]


def pick(values: list[str | None], number: str = "event_id") -> str:
    """SQL for values[number % len(values)]"""
    listed = ", ".join(literal(value) for value in values)
    return f"get(array({listed}), int({number} % {len(values)}))"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def conversions(log: DataFrame) -> DataFrame:
    """The first signup, purchase and registration of each user and day; every fortieth view is a registration."""
    kind = "case event_type when 'signup' then 'Trial' when 'purchase' then 'Subscription' else 'registration' end"
    days = (
        log.filter("event_type in ('signup', 'purchase') or event_type = 'view' and event_id % 40 = 3")
        .groupBy("user_id", F.to_date("ts").alias("day"), F.expr(kind).alias("conversion_type"))
        .agg(F.expr("min(struct(ts, event_id, value))").alias("first"))
    )
    return days.selectExpr(
        "user_id", "conversion_type", "first.ts as conversion_ts", "first.event_id as conversion_id",
        "first.value as conversion_value",
    )


def visits(spark: SparkSession, folder: str) -> DataFrame:
    """One row per conversion and visit of its user up to the conversion, or to the end of its day for every third one.

    Earlier visits go back up to 90 days further, so that the windows differ. Every seventeenth visit is there twice,
    every thirteenth conversion has no product, and one source type is seen a few times only. A user has at most one conversion per day and type, so a visit meets a number of
    conversions bounded by the days of the log, never by the user's rows.
    """
    log = events(spark, folder)
    nations = _table(spark, folder, "nation").selectExpr(
        "bigint(n_nationkey) as nation_key", "n_name as geo_country_name"
    )
    # Rows multiply here, so both sides are shuffled even where one would fit a broadcast.
    pairs = log.join(conversions(log).hint("shuffle_hash"), "user_id").filter(
        "ts <= conversion_ts or conversion_id % 3 = 0 and to_date(ts) = to_date(conversion_ts)"
    )
    pairs = pairs.withColumn("ts", F.expr("if(ts < conversion_ts, ts - make_interval(0, 0, 0, int(30 * (event_id % 4))), ts)"))
    pairs = pairs.withColumn("copy", F.expr("explode(if(event_id % 17 = 0, array(1, 2), array(1)))"))
    pairs = pairs.withColumn("nation_key", F.expr("user_id % 25")).join(nations, "nation_key", "left")
    source_name = pick([name for _, name in SOURCES])
    table = pairs.selectExpr(
        "'u' || user_id as user_guid",
        "ts as attribution_visit_start_time",
        f"if(event_id = {RARE_EVENT}, 'Rare', {pick([kind for kind, _ in SOURCES])}) as visit_traffic_source_type",
        source_name + " as visit_traffic_source_name",
        pick(DEVICES) + " as visit_device_type",
        "event_id % 2 = 0 as is_campaign_landing",
        f"if(event_id % 4 < 2, {source_name}, 'seg' || event_id % 5) as segment_name",
        pick(CAMPAIGNS) + " as segment_campaign_name",
        pick(GROUPINGS, "(event_id div 3)") + " as segment_campaign_grouping",
        pick(SEGMENT_CHANNELS) + " as segment_channel",
        "'audience' || event_id % 3 as segment_audience",
        "'web' as b2c_abstraction_datasource",
        "if(user_id % 10 = 9, 'B2B', 'B2C') as b2b_b2c",
        pick([name for name, _ in PRODUCTS], "conversion_id") + " as product_name",
        pick([term for _, term in PRODUCTS], "conversion_id") + " as b2c_product_name_and_term",
        "geo_country_name",
        "conversion_ts as conversion_visit_timestamp",
        "if(event_id = conversion_id, 1, 0) as converting_visit",
        "conversion_type",
        "if(conversion_id % 13 = 5, null, conversion_id) as product_arrangement_id",
        pick(USER_COHORTS, "user_id") + " as user_cohort_primary",
        pick(["digital", "print"], "conversion_id") + " as b2c_product_type",
        "conversion_id % 2 = 1 as is_app_conversion",
        pick(["core", "bundle", "add-on"], "conversion_id") + " as product_type",
    )
    return conform(table, VISITS)


def user_ltv(spark: SparkSession, folder: str) -> DataFrame:
    """One value per conversion, missing for some; every fifth conversion has a second value."""
    copies = "explode(if(conversion_id % 5 = 0, array(12, 6), array(12)))"
    table = conversions(events(spark, folder)).withColumn("factor", F.expr(copies)).selectExpr(
        "'u' || user_id as user_guid",
        "if(conversion_id % 11 = 0 and factor = 12, null, conversion_value * factor) as ltv_acquisition_capped_12m",
        "conversion_ts as product_order_timestamp",
        "conversion_id as product_arrangement_id",
    )
    return conform(table, USER_LTV)


def app_events(spark: SparkSession, folder: str) -> DataFrame:
    name = f"""
        case event_type
            when 'signup' then 'install'
            when 'purchase' then 'af_purchase'
            when 'view' then 'af_content_view'
            when 'click' then {pick(["af_share", "af_login", "select_package"])}
            else {pick(["af_ars_subscription_renewed", "af_purchase_canceled"])}
        end"""
    cents = "string(bigint(round(value * 100)))"
    fields = {
        "AFEventParamRevenue": f"'\"' || {cents} || '\"'",
        "AFEventParamCurrency": f"'\"' || {pick(['GBP', 'USD'])} || '\"'",
        "payment_method_type": f"'\"' || {pick(['card', 'store', 'voucher'])} || '\"'",
        "AFEventParamOrderId": "'\"o' || event_id || '\"'",
        "AFEventParamContentType": f"'\"' || {pick(APP_PRODUCTS)} || '\"'",
        "af_content_type": f"'\"' || {pick(APP_PRODUCTS)} || '\"'",
        "af_order_id": "'\"a' || event_id || '\"'",
        "af_revenue": f"if(event_id % 7 = 0, '\"n/a\"', {cents})",
        "af_currency": f"'\"' || {pick(['EUR', 'USD'])} || '\"'",
    }
    body = " || ', ' || ".join(f"'\"{key}\": ' || {value}" for key, value in fields.items())
    broken = """'{"AFEventParamRevenue": "1", '"""
    table = events(spark, folder).selectExpr(
        name + " as event_name",
        f"if(event_id % 13 = 0, {broken}, '{{' || {body} || '}}') as event_value",
        pick(MEDIA_SOURCES) + " as media_source",
        "if(event_id % 4 < 2, 'ios', 'android') as platform",
        "ts as event_time",
        "date_trunc('day', ts) as install_time",
        "'campaign' || event_id % 3 as campaign",
        "if(event_id % 2 = 0, 'organic', 'paid') as campaign_type",
        pick(["EMEA", "APAC"], "user_id") + " as region",
        pick(["GB", "US", "JP"], "user_id") + " as country_code",
        "'af' || user_id as appsflyer_id",
        "'u' || user_id as customer_user_id",
        pick(APPS) + " as app_id",
        "'app' || event_id % 6 as app_name",
        "to_date(ts) as partition_date",
    )
    return conform(table, APP_EVENTS)
