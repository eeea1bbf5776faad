"""Credit per touch under the heuristic models, and its sums.

The formulas are the usual definitions: all credit to the last or the first touch; fixed
shares for first, middle and last; weights falling with the time before the conversion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import journey_id
from ..names import COHORT, JOURNEY, MODELS, USER, VISIT_TS

POSITION_SHARES = (0.3, 0.3, 0.4)
SCORE_DIGITS = 6


def last_click() -> Column:
    return (F.col("position") == F.col("touch_count")).cast("double")


def first_click() -> Column:
    return (F.col("position") == 1).cast("double")


def position_based(shares: tuple[float, float, float] = POSITION_SHARES) -> Column:
    """The middle share is spread over the middle touches, or over both ends if there are none."""
    first, middle, last = shares
    n = F.col("touch_count")
    spread = F.when(n == 2, F.lit(middle / 2)).otherwise(0.0)
    return (
        F.when(n == 1, F.lit(1.0))
        .when(F.col("position") == 1, F.lit(first) + spread)
        .when(F.col("position") == n, F.lit(last) + spread)
        .otherwise(F.lit(middle) / (n - 2))
    )


def time_decay() -> Column:
    return F.col("decay_weight") / F.col("decay_total")


HEURISTICS = {
    "last_click": last_click, "first_click": first_click, "position_based": position_based, "time_decay": time_decay,
}


def with_credits(touches: DataFrame, models: list[str] = list(HEURISTICS)) -> DataFrame:
    """Add one share per model; all shares are 0 in a journey without conversion."""
    converted = F.col("conversion_value") == 1
    return touches.withColumns(
        {MODELS[m]: F.when(converted, HEURISTICS[m]()).otherwise(0.0) for m in models}
    )


def credit_columns(df: DataFrame) -> list[str]:
    return [name for name in MODELS.values() if name in df.columns]


def channel_totals(credited: DataFrame) -> DataFrame:
    """Credit per channel and cohort; summed before the shuffle."""
    sums = [F.sum(name).alias(name) for name in credit_columns(credited)]
    return credited.groupBy(*COHORT, F.col("channel").alias("channels")).agg(*sums)


def journeys(touches: DataFrame) -> DataFrame:
    """One row per journey, without its touches."""
    return touches.groupBy(*JOURNEY).agg(
        F.max("conversion_value").alias("conversion_value"), F.max("touch_count").alias("num_touchpoints")
    )


def journey_scores(credited: DataFrame, list_touches: int | None = None) -> DataFrame:
    """One row per journey with its touches in order and their credits.

    `touches` is an array of structs. On request lists are cut into parts of `list_touches`
    touches: part 0, 1, ... in order make up the whole journey.
    """
    touch = F.struct("position", VISIT_TS, "channel", *credit_columns(credited))
    part = F.floor((F.col("position") - 1) / list_touches) if list_touches else F.lit(0)
    part = part.cast("int").alias("part")
    lists = credited.groupBy(*JOURNEY, part).agg(
        F.sort_array(F.collect_list(touch)).alias("touches"),
        F.max("conversion_value").alias("conversion_value"),
        F.max("touch_count").alias("num_touchpoints"),
    )
    return lists.withColumn("journey_id", journey_id(F.col(USER), F.col("journey_no")))


def score_text(column: str, digits: int = SCORE_DIGITS) -> Column:
    """The credits of a journey as `0.300000 > 0.700000`."""
    values = F.transform("touches", lambda t: F.format_string(f"%.{digits}f", F.round(F.round(t[column], digits + 3), digits)))
    return F.concat_ws(" > ", values)


def with_texts(scores: DataFrame) -> DataFrame:
    """Adds the lists as text: `channels_agg` and one text per model."""
    present = scores.schema["touches"].dataType.elementType.names
    texts = {name: score_text(name) for name in MODELS.values() if name in present}
    return scores.withColumns({"channels_agg": F.concat_ws(" > ", F.col("touches.channel")), **texts})


def text_form(scores: DataFrame) -> DataFrame:
    """`with_texts` without the lists."""
    models = [name for name in MODELS.values() if name in scores.schema["touches"].dataType.elementType.names]
    columns = ["journey_id", USER, "part", "channels_agg", "conversion_value", *models, "num_touchpoints", *COHORT]
    return with_texts(scores).select(*columns)


def touchpoint_count(channels: Column) -> Column:
    """Number of touches in a ` > `-separated text."""
    return F.size(F.split(channels, " > "))
