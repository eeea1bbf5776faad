"""Touchpoint and product labels, and taking touchpoints apart again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels by lower-cased product name, then by name and term.
PRODUCT_PATTERNS = [("%e-paper%", "Digital Edition"), ("%edit%", "FT Edit")]
PRODUCT_NAMES = {
    "newspaper - 5 weekdays": "Newspaper",
    "newspaper - 6 days a week": "Newspaper",
    "ft weekend": "FT Weekend",
    "newspaper - weekend only": "Newspaper",
}
PRODUCT_TERMS = ["Standard Monthly", "Premium Monthly", "Standard Annual", "Premium Annual"]
OTHER_PRODUCT = "Others"

SEPARATOR = " | "
NO_TOUCHPOINT = "-"


def product_label() -> Column:
    name, term = F.lower("product_name"), F.lower("b2c_product_name_and_term")
    label = F
    for pattern, result in PRODUCT_PATTERNS:
        label = label.when(name.like(pattern), result)
    for exact, result in PRODUCT_NAMES.items():
        label = label.when(name == exact, result)
    for result in PRODUCT_TERMS:
        label = label.when(term == result.lower(), result)
    return label.otherwise(OTHER_PRODUCT)


def touchpoint_label() -> Column:
    """Eight parts in one string; NULL if any part is NULL."""
    parts = [
        F.col("media_type"), F.col("channel"), F.col("platform"), F.col("visit_traffic_source_name"),
        F.col("visit_device_type"), F.col("geo_country_name"), F.col("user_cohort_primary"), product_label(),
    ]
    joined = [parts[0]]
    for part in parts[1:]:
        joined += [F.lit(SEPARATOR), part]
    return F.concat(*joined)


def parse_touchpoint(df: DataFrame, column: str = "channels") -> DataFrame:
    """The eight parts: three from the left, four from the right, the name in between.

    The name may itself hold the delimiter, so it is what remains without the outer parts.
    """
    text = F.col(column)
    parts = F.split(text, r"\|")
    middle = F.regexp_replace(F.regexp_replace(text, r"^([^|]+\|){3}", ""), r"(\|[^|]+){4}$", "")
    from_left = {"media_type": 0, "media_channel": 1, "platform": 2}
    from_right = {"channel_device_type": 4, "geo_country_name": 3, "user_cohort_primary": 2, "product_type": 1}
    columns = {name: F.get(parts, F.lit(i)) for name, i in from_left.items()}
    columns["channel_name"] = middle
    columns |= {name: F.get(parts, F.size(parts) - k) for name, k in from_right.items()}
    whole = F.trim(text) == NO_TOUCHPOINT
    return df.select(
        "*", *[F.when(whole, NO_TOUCHPOINT).otherwise(F.trim(part)).alias(name) for name, part in columns.items()]
    )


def clean_media(df: DataFrame) -> DataFrame:
    kind, channel, platform = F.col("media_type"), F.col("media_channel"), F.col("platform")
    return df.select(
        "*",
        F.when(channel.isin("social_free", "social free"), "organic social")
        .when(channel == "ppc", "paid search")
        .when((kind == "organic") & (channel == "search"), "organic search")
        .otherwise(channel)
        .alias("cleaned_media_channel"),
        F.when(kind.isin("email", "editorial email"), "organic").otherwise(kind).alias("cleaned_media_type"),
        F.when((kind == "email") & (platform == "newsletter"), "email").otherwise(platform).alias("cleaned_platform"),
        F.when(F.col("conversion_type") == "Trial", "Trial")
        .when(F.col("product_type").isin(PRODUCT_TERMS), "Directs")
        .otherwise("Other")
        .alias("trial_direct"),
    )
