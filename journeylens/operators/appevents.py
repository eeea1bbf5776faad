"""App events: flattened events and daily counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import json_fields
from ..functions.rules import first_match, literal

# ---- Fixed values -----------------------------------------------------------------------------
INSTALL, PURCHASE = "install", "af_purchase"
ENGAGEMENT = ["af_content_view", "af_first_open", "af_share", "af_login", "select_package", "af_barrier_view"]
SUBSCRIPTION = [
    "af_ars_subscription_xgraded", "af_ars_subscription_renewed", "af_ars_subscription_canceled",
    "af_purchase_canceled", "af_purchase_refund",
]
MAIN_APP = ["com.ft.news", "id1200842933"]
EDIT_APP = ["id1574510369"]
EDITION_APP = ["com.ft.ftepaper.android", "id6449040684"]
PLAIN_EDITION, BRANDED_EDITION = "Digital Edition", "FT Digital Edition"
# The channel category is that of the first rule that holds.
CHANNEL_CATEGORIES = [
    ([[("media_source", "is", "QR_code")]], "QR_code"),
    ([[("media_source", "is", "Email")]], "Email_onboarding"),
    ([[("media_source", "is", "Web-to-app")], [("media_source", "is", "web_to_app")]], "Onsite"),
    ([[("campaign_type", "is", "organic"), ("platform", "is", "ios")]], "Apple_store_organic"),
    ([[("campaign_type", "is", "organic"), ("platform", "is", "android")]], "Google_play_organic"),
    ([[("media_source", "is", "googleadwords_int")]], "ACi/Ace_paid"),
    ([[("media_source", "is", "Apple Search Ads")]], "ASA_paid"),
]
OTHER_CATEGORY = "Other"
PURCHASE_TYPES = [
    ("_M_T", "monthly_trial"),
    ("713f1e28_0bc5_8261_f1e6_eebab6f7600e_M", "ios monthly premium"),
    ("c8ad55e6_ba74_fea0_f9da_a4546ae2ee23_M", "ios monthly standard"),
    ("713f1e28_0bc5_8261_f1e6_eebab6f7600e_Annual", "ios annual premium"),
    ("c8ad55e6_ba74_fea0_f9da_a4546ae2ee23_Annual", "ios annual standard"),
    ("p1m_premium", "monthly premium"),
    ("p1m_standard", "monthly standard"),
    ("p1y_premium", "annual premium"),
    ("p1y_standard", "annual standard"),
]
PURCHASE_FIELDS = {
    "revenue": "AFEventParamRevenue",
    "currency": "AFEventParamCurrency",
    "payment_method_type": "payment_method_type",
    "order_id": "AFEventParamOrderId",
    "product_id": "AFEventParamContentType",
}
SUBSCRIPTION_FIELDS = {
    "af_content_type": "af_content_type",
    "af_order_id": "af_order_id",
    "revenue": "af_revenue",
    "payment_method_type": "payment_method_type",
    "currency": "af_currency",
}
# -----------------------------------------------------------------------------------------------

PLACE = ["app_name", "app_group", "app_id", "platform", "region", "country_code"]
ORIGIN = ["campaign", "campaign_type", "channel_category"]
WHO = ["appsflyer_id", "user_id", "install_time"]


def app_group(edition_label: str) -> Column:
    app = F.col("app_id")
    return (
        F.when(app.isin(MAIN_APP), "Main App")
        .when(app.isin(EDIT_APP), "FT Edit")
        .when(app.isin(EDITION_APP), edition_label)
        .otherwise("Other")
    )


def channel_category() -> Column:
    return first_match(CHANNEL_CATEGORIES, literal(OTHER_CATEGORY))


def purchase_type(product: Column) -> Column:
    """First pattern found in the product id; `_` stands for any one character."""
    kind = F
    for piece, label in PURCHASE_TYPES:
        kind = kind.when(product.like(f"%{piece}%"), label)
    return kind.otherwise("not identified")


def _select(events: DataFrame, names: list[str], edition_label: str) -> DataFrame:
    return events.filter(F.col("event_name").isin(names)).withColumns(
        {
            "event_date": F.to_date("event_time"),
            "app_group": app_group(edition_label),
            "channel_category": channel_category(),
            "user_id": F.col("customer_user_id"),
        }
    )


def _flatten(events: DataFrame, fields: dict[str, str]) -> DataFrame:
    """JSON fields under their output names, revenue as a number."""
    kinds = {key: "float" if name == "revenue" else "string" for name, key in fields.items()}
    plain = events.columns
    flat = json_fields(events, "event_value", kinds)
    return flat.select(*plain, *[F.col(key).alias(name) for name, key in fields.items()])


def installs(events: DataFrame) -> DataFrame:
    return _select(events, [INSTALL], PLAIN_EDITION).select("event_date", *PLACE, *ORIGIN, *WHO)


def engagement(events: DataFrame) -> DataFrame:
    return _select(events, ENGAGEMENT, BRANDED_EDITION).select("event_date", "event_name", *PLACE, *ORIGIN, *WHO)


def subscription_events(events: DataFrame) -> DataFrame:
    flat = _flatten(_select(events, SUBSCRIPTION, PLAIN_EDITION), SUBSCRIPTION_FIELDS)
    return flat.select("event_date", "event_name", *PLACE, *ORIGIN, *WHO, *SUBSCRIPTION_FIELDS)


def purchases(events: DataFrame) -> DataFrame:
    flat = _flatten(_select(events, [PURCHASE], BRANDED_EDITION), PURCHASE_FIELDS)
    return flat.select(
        "event_date", *PLACE, *ORIGIN, *WHO, *PURCHASE_FIELDS, purchase_type(F.col("product_id")).alias("purchase_type")
    )


def _daily(events: DataFrame, keys: list[str], rows: str, users: str, *more: Column) -> DataFrame:
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(rows), F.count_distinct("user_id").alias(users), *more
    )


def daily_installs(events: DataFrame) -> DataFrame:
    return _daily(installs(events), ["event_date", *PLACE, *ORIGIN], "installs", "unique_user_installs")


def daily_engagement(events: DataFrame) -> DataFrame:
    return _daily(engagement(events), ["event_date", "event_name", *PLACE, *ORIGIN], "total_events", "unique_users")


def daily_subscription_events(events: DataFrame) -> DataFrame:
    keys = ["event_date", "event_name", *PLACE, *ORIGIN, "payment_method_type"]
    return _daily(subscription_events(events), keys, "total_events", "unique_users")


def daily_purchases(events: DataFrame) -> DataFrame:
    keys = ["event_date", *PLACE, *ORIGIN, "purchase_type", "currency", "payment_method_type"]
    return _daily(
        purchases(events), keys, "total_purchases", "unique_purchasers", F.sum("revenue").alias("total_revenue")
    )
