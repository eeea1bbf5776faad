"""Customer lifetime value per journey and per channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..names import COHORT, CONV_TS, JOURNEY, MODELS, USER
from ..runtime import materialize
from .models import SCORE_DIGITS
from .skew import salted_left_join

LTV = "ltv_acquisition_capped_12m"
PRODUCT = "product_arrangement_id"
ORDER_TS = "product_order_timestamp"


def mean_ltv(ltv: DataFrame) -> DataFrame:
    """One value per user, order time and product: the mean. Rows with a missing part are dropped."""
    keys = [c for c in ltv.columns if c != LTV]
    return ltv.dropna(subset=[*keys, LTV]).groupBy(*keys).agg(F.avg(LTV).alias(LTV))


def join_product(journeys: DataFrame, visits: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Attach the products the user got on the run date by a conversion of the same type."""
    kept = [USER, "conversion_type", F.to_date(CONV_TS).alias("run_date"), PRODUCT, *extra]
    products = visits.select(*kept).distinct()
    return journeys.join(products, [USER, "conversion_type", "run_date"], "left")


def fill_product(df: DataFrame) -> DataFrame:
    return df.fillna({PRODUCT: 0})


def converted_only(df: DataFrame) -> DataFrame:
    return df.filter("conversion_value = 1")


def join_ltv(journeys: DataFrame, ltv: DataFrame) -> DataFrame:
    """Attach the value of the order of the same product and day; journeys should be a written table.

    Unknown products of a day all have one key, which is dealt to several tasks if it has many journeys.
    """
    orders = ltv.filter(F.col(LTV).isNotNull()).select(
        PRODUCT, F.to_date(ORDER_TS).alias("run_date"), F.col(LTV).cast("double").alias(LTV)
    )
    spread = [c for c in JOURNEY if c in journeys.columns]
    return salted_left_join(journeys, orders, [PRODUCT, "run_date"], spread)


def journey_ltv(journeys: DataFrame, visits: DataFrame, ltv: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Converted journeys with product and value; one row per matching order."""
    with_product = fill_product(join_product(converted_only(journeys), visits, extra))
    return join_ltv(materialize(with_product), ltv)


def average_ltv(credited: DataFrame, valued: DataFrame) -> DataFrame:
    """Mean of Markov share x value per channel, over the touches of converted journeys.

    Shares are summed per journey and channel before they meet the values, so a journey
    enters the join with as many rows as it has channels. Journeys without a value leave a
    channel with a NULL mean.
    """
    share = F.col(MODELS["markov"])
    per_channel = (
        credited.filter("conversion_value = 1")
        .groupBy(*JOURNEY, "channel")
        .agg(F.sum(share).alias("share_"), F.count(share).alias("touches_"))
    )
    met = per_channel.join(valued.select(*JOURNEY, LTV), JOURNEY).filter("touches_ > 0")
    counted = F.sum(F.when(F.col(LTV).isNotNull(), F.col("touches_")))
    mean = F.sum(F.col("share_") * F.col(LTV)) / counted
    return met.groupBy(*COHORT, "channel").agg(mean.alias("average_ltv"))


def join_average_ltv(effects: DataFrame, averages: DataFrame) -> DataFrame:
    return effects.join(averages, [*COHORT, "channel"], "left")


def effect_ltv(ltv: Column = None) -> Column:
    """Per touch of a `touches` list: channel and Markov share x value."""
    value = F.col(LTV) if ltv is None else ltv
    return F.transform(
        "touches", lambda t: F.struct(t["channel"].alias("channel"), (t[MODELS["markov"]] * value).alias("ltv"))
    )


def effect_ltv_text(digits: int = SCORE_DIGITS) -> Column:
    """`channel: value > channel: value`; NULL without value or share."""
    parts = F.transform(
        effect_ltv(), lambda t: F.concat(t["channel"], F.lit(": "), F.format_string(f"%.{digits}f", F.round(F.round(t["ltv"], digits + 3), digits)))
    )
    known = F.forall(effect_ltv(), lambda t: t["ltv"].isNotNull())
    return F.when(known, F.concat_ws(" > ", parts))


def zip_effect_ltv(channels: Column, shares: Column, ltv: Column) -> Column:
    """The same from texts `a > b` and `0.3 > 0.7`; NULL if they do not fit together."""
    names = F.transform(F.split(channels, ">"), lambda x: F.trim(x))
    parts = F.transform(F.split(shares, ">"), lambda x: F.trim(x).try_cast("double"))
    pairs = F.transform(
        F.arrays_zip(names.alias("channel"), parts.alias("share")),
        lambda p: F.struct(p["channel"].alias("channel"), (p["share"] * ltv).alias("ltv")),
    )
    fits = (F.size(names) == F.size(parts)) & F.forall(parts, lambda x: x.isNotNull())
    return F.when(fits, pairs)


def explode_channel_ltv(df: DataFrame, column: str = "removal_effect_ltv") -> DataFrame:
    """Text `channel: value > ...` to rows (channel, ltv); what is no number becomes NULL."""
    piece = F.col("piece_")
    at = F.instr(piece, ": ")
    channel = F.when(at > 0, F.substring(piece, F.lit(1), at - 1)).otherwise(piece)
    value = F.when(at > 0, F.substring(piece, at + 2, F.length(piece)))
    rows = df.filter(F.col(column).isNotNull()).withColumn("piece_", F.explode(F.split(column, " > ")))
    return rows.withColumns({"channel": channel, "ltv": value.try_cast("double")}).drop("piece_")
