"""First-order Markov chain per cohort: transitions, removal effects and credits.

A journey is a walk (start) -> channels -> (conversion) or (null); steps from a channel to
itself are left out. The removal effect of a channel is the relative loss of conversion
probability when visits to it end in (null) (Anderl et al., "Mapping the customer journey",
2016). With Q the steps between channels, N = (I - Q)^-1 and v the conversion
probabilities, it equals N[start, k] v[k] / (N[k, k] v[start]): one solution instead of one
per channel. Channels that no steps connect do not see each other in N, so the connected
groups are dealt to many calls and solved by sparse elimination of their strongly connected parts (see `sparse`).
"""

from __future__ import annotations

import sys
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..names import COHORT, CONVERSION, FLAG, JOURNEY, MODELS, NULL_STATE, START, WINDOWS
from ..runtime import HOT_KEY_ROWS, materialize
from . import sparse
from .groups import connected_groups

# Executors need not have this package: the solver travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sparse)

ENDS = [CONVERSION, NULL_STATE]
SOLVED_SCHEMA = (
    "run_date date, conversion_type string, conversion_window int, channel string, reached double, value double, won double"
)
PAIR_SALTS = 16
# Steps that one call of the solver gets, but for a larger group, which is never cut: some 200 bytes each.
CALL_STEPS = 10_000
# Removal effects that are sent to every task: some 150 bytes each, 40 MB at most.
FEW_WEIGHTS = 250_000
# Bytes of more removal effects that are sent to every task, packed by channel: eight for each of the cohorts.
PACKED_BYTES = 64 << 20
# Channels of a day and type whose groups are sent to every task: two numbers each, 50 MB at most.
FEW_NODES = 1_000_000
# The windows of a day and type are solved by the same groups.
GROUP_KEYS = ["run_date", "conversion_type"]


def step_counts(placed: DataFrame, windows: tuple[int, ...] = tuple(WINDOWS)) -> DataFrame:
    """Step counts of `touches_once`, one row per step of a day and type with a column for each window.

    Narrower windows hold nearly the steps of the widest one, so that a row per window would be shuffled for nothing.
    """
    def at(w: int) -> Column:
        return F.get(F.filter("placed", lambda p: p["conversion_window"] == w), F.lit(0))["position"]

    placed = placed.select(*GROUP_KEYS, "channel", FLAG, "next_channel", *[at(w).alias(f"at_{w}") for w in windows])
    end = F.when(F.col(FLAG) == 1, CONVERSION).otherwise(NULL_STATE)
    one = lambda held: F.when(held, 1).otherwise(0)
    leave = F.struct(
        F.col("channel").alias("source"), F.coalesce("next_channel", end).alias("destination"),
        *[one(F.col(f"at_{w}").isNotNull()).alias(f"steps_{w}") for w in windows],
    )
    enter = F.struct(
        F.lit(START).alias("source"), F.col("channel").alias("destination"),
        *[one(F.col(f"at_{w}") == 1).alias(f"steps_{w}") for w in windows],
    )
    first = reduce(or_, [F.coalesce(F.col(f"at_{w}") == 1, F.lit(False)) for w in windows])
    steps = F.explode(F.when(first, F.array(enter, leave)).otherwise(F.array(leave)))
    return (
        placed.select(*GROUP_KEYS, steps.alias("step"))
        .select(*GROUP_KEYS, "step.*")
        .filter("source != destination")
        .groupBy(*GROUP_KEYS, "source", "destination")
        .agg(*[F.sum(f"steps_{w}").alias(f"steps_{w}") for w in windows])
    )


def per_window_steps(counts: DataFrame) -> DataFrame:
    """One row per step of a cohort."""
    if "steps" in counts.columns:
        return counts
    counted = {int(name.removeprefix("steps_")): name for name in counts.columns if name.startswith("steps_")}
    rows = F.array(*[F.struct(F.lit(w).alias("conversion_window"), F.col(n).alias("steps")) for w, n in counted.items()])
    rows = counts.withColumn("row_", F.explode(rows)).drop(*counted.values()).select("*", "row_.*").drop("row_")
    others = [c for c in rows.columns if c not in (*COHORT, "source", "destination", "steps")]
    return rows.select(*COHORT, "source", "destination", "steps", *others).filter("steps > 0")


def edges(touches: DataFrame) -> DataFrame:
    """Step counts: each touch emits the step that leaves it, the first one also the step into it."""
    if "placed" in touches.columns:
        return per_window_steps(step_counts(touches))
    end = F.when(F.col(FLAG) == 1, CONVERSION).otherwise(NULL_STATE)
    leave = F.struct(
        F.col("channel").alias("source"), F.coalesce("next_channel", end).alias("destination")
    )
    enter = F.struct(F.lit(START).alias("source"), F.col("channel").alias("destination"))
    steps = F.explode(F.when(F.col("position") == 1, F.array(enter, leave)).otherwise(F.array(leave)))
    return (
        touches.select(*COHORT, steps.alias("step"))
        .select(*COHORT, "step.*")
        .filter("source != destination")
        .groupBy(*COHORT, "source", "destination")
        .agg(F.count(F.lit(1)).alias("steps"))
    )


def probabilities(steps: DataFrame) -> DataFrame:
    """Steps out of a state sum to 1."""
    out = Window.partitionBy(*COHORT, "source")
    return steps.withColumn("probability", F.col("steps") / F.sum("steps").over(out))


def transitions(steps: DataFrame, digits: int = 3) -> DataFrame:
    return probabilities(steps).select(
        *COHORT, "source", "destination", F.bround("probability", digits).alias("probability")
    )


def dense_transitions(steps: DataFrame) -> DataFrame:
    """All pairs of states of a cohort, with 0 where no step occurs; end states lead to themselves.

    Quadratic in the number of channels by definition, so only on request.
    """
    given = transitions(steps)
    seen = steps.select(*COHORT, F.explode(F.array("source", "destination")).alias("state")).distinct()
    ends = seen.select(*COHORT).distinct().withColumn(
        "state", F.explode(F.array(*map(F.lit, (START, NULL_STATE, CONVERSION))))
    )
    states = seen.unionByName(ends).distinct()
    # The sources of a cohort are spread over PAIR_SALTS tasks; the destinations go to each.
    source = states.withColumn("salt_", F.pmod(F.xxhash64("state"), F.lit(PAIR_SALTS)))
    destination = states.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(PAIR_SALTS - 1)).cast("array<bigint>")))
    pairs = source.withColumnRenamed("state", "source").join(
        destination.withColumnRenamed("state", "destination"), [*COHORT, "salt_"]
    )
    stays = F.col("source").isin(NULL_STATE, CONVERSION) & (F.col("source") == F.col("destination"))
    return pairs.join(given, [*COHORT, "source", "destination"], "left").select(
        *COHORT, "source", "destination",
        F.when(stays, 1.0).otherwise(F.coalesce("probability", F.lit(0.0))).alias("probability"),
    )


def sparse_rows(steps: DataFrame) -> DataFrame:
    """The matrix by rows: per source a map of the probabilities that are not zero, and `width`, the destinations of the cohort.

    No column per destination is ever made, so there may be any number of them.
    """
    given = transitions(steps)
    width = steps.groupBy(*COHORT).agg(F.count_distinct("destination").alias("width"))
    rows = given.groupBy(*COHORT, "source").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("destination", "probability")))).alias("row")
    )
    return rows.join(width, COHORT)


def melt(rows: DataFrame) -> DataFrame:
    """`sparse_rows` in long form; `zeros` counts the entries of the source's row that are left out."""
    zeros = (F.col("width") - F.size("row")).alias("zeros")
    return rows.select(*COHORT, "source", zeros, F.explode("row").alias("destination", "probability"))


def _solve(frame: pd.DataFrame) -> pd.DataFrame:
    """Visits, returns and values of the channels of some groups of one cohort, from all steps that touch them."""
    source, destination = frame.source.to_numpy(), frame.destination.to_numpy()
    start, win = source == START, destination == CONVERSION
    end = win | (destination == NULL_STATE)
    left = np.where(start, frame.entered, frame.groupby("source").steps.transform("sum"))
    probability = frame.steps.to_numpy() / left
    channels, at = np.unique(np.concatenate([source[~start], destination[~end]]), return_inverse=True)
    from_, to = np.zeros(len(frame), int), np.zeros(len(frame), int)
    from_[~start], to[~end] = at[: (~start).sum()], at[(~start).sum() :]
    starts, wins, leave = np.zeros(len(channels)), np.zeros(len(channels)), np.zeros(len(channels))
    np.add.at(starts, to[start], probability[start])
    np.add.at(leave, from_[end], probability[end])
    np.add.at(wins, from_[win], probability[win])
    out: list[dict[int, float]] = [{} for _ in channels]
    inner = ~start & ~end
    for i, j, p in zip(from_[inner].tolist(), to[inner].tolist(), probability[inner].tolist()):
        out[i][j] = p
    visits, again, value = sparse.solve(out, wins, starts, leave)
    return pd.DataFrame(
        {
            **{key: frame[key].iloc[0] for key in COHORT},
            "channel": channels, "reached": visits / again, "value": value, "won": starts * value,
        }
    )


def _node(channel: str | Column) -> Column:
    return F.xxhash64(*GROUP_KEYS, channel)


def channel_groups(steps: DataFrame) -> DataFrame:
    """Rows (node, group): channels of one day and type that steps of any window connect, the ends left out, share a group.

    What the chain does in a group depends on the steps of the group alone. Nodes go by a hash of day, type and channel;
    of equal hashes two groups would be solved together, with the same result, and so are groups of one window that
    only another one connects.
    """
    start, end = F.col("source") == START, F.col("destination").isin(ENDS)
    links = steps.filter(~(start & end)).select(
        *GROUP_KEYS,
        _node(F.when(start, F.col("destination")).otherwise(F.col("source"))).alias("a"),
        _node(F.when(end, F.col("source")).otherwise(F.col("destination"))).alias("b"),
    )
    # Groups never cross days and types: dealt by them, one pass finds them.
    return connected_groups(links.repartition(*GROUP_KEYS).select("a", "b"))


def removal_effects_raw(steps: DataFrame, call_steps: int = CALL_STEPS) -> DataFrame:
    """Unrounded effect per cohort and channel; NULL in a cohort without conversions.

    The connected groups of a cohort's channels are dealt to calls of some `call_steps` steps; a group is never cut, so
    a call holds the steps of its largest group at least. Groups do not see each other in the inverse, so it does not
    matter which are solved together. The probability of a conversion is summed over the groups. `steps` should be a
    written table, of `edges` or of `step_counts`, whose windows are made rows only where they are solved.
    """
    start, end = F.col("source") == START, F.col("destination").isin(ENDS)
    at = F.when(start, F.col("destination")).otherwise(F.col("source"))
    counted = [c for c in steps.columns if c.startswith("steps")]
    cohorts = materialize(
        per_window_steps(steps).groupBy(*COHORT).agg(
            F.sum(F.when(start, F.col("steps"))).alias("entered"),
            F.sum(F.when(start & (F.col("destination") == CONVERSION), F.col("steps"))).alias("direct"),
        )
    )
    # In the form of `edges` the rows of each window count: a call then holds fewer.
    calls = materialize(steps.groupBy(*GROUP_KEYS).agg(F.ceil(F.count(F.lit(1)) / call_steps).alias("calls")))
    groups = materialize(channel_groups(steps))
    if groups.count() <= FEW_NODES:
        groups = F.broadcast(groups)
    dealt = steps.filter(~(start & end)).withColumn("node", _node(at)).join(groups, "node")
    call = F.pmod(F.xxhash64("group"), "calls").alias("call")
    dealt = dealt.join(F.broadcast(calls), GROUP_KEYS).select(*GROUP_KEYS, call, *COHORT[2:][: "steps" in counted], "source", "destination", *counted)
    dealt = per_window_steps(dealt.repartition(*GROUP_KEYS, "call")).join(F.broadcast(cohorts.drop("direct")), COHORT)
    solved = materialize(dealt.groupBy(*COHORT, "call").applyInPandas(_solve, SOLVED_SCHEMA))
    direct = cohorts.filter("direct is not null").select(*COHORT, (F.col("direct") / F.col("entered")).alias("won"))
    won = solved.select(*COHORT, "won").unionByName(direct).groupBy(*COHORT).agg(F.sum("won").alias("converted"))
    effect = F.when(F.col("converted") > 0, F.col("reached") * F.col("value") / F.col("converted"))
    return solved.join(won, COHORT).select(*COHORT, "channel", effect.alias("removal_effect_raw"))


def share_of_total(df: DataFrame, column: str, keys: list[str] = COHORT) -> DataFrame:
    """`column` in percent of its sum per key; sums are combined before the shuffle."""
    sums = df.groupBy(*keys).agg(F.sum(column).alias("sum_"))
    percent = F.try_divide(F.col(column), F.col("sum_")) * 100
    return df.join(sums, keys).withColumn(column, percent).drop("sum_")


def removal_effects(raw: DataFrame, digits: int = 3) -> DataFrame:
    """Rounded first, then scaled to 100 within the cohort; the rounded value is kept."""
    # The first rounding takes away the noise of the last bits before the tie-breaking one.
    rounded = F.bround(F.round("removal_effect_raw", 9), digits)
    table = raw.select(*COHORT, "channel", rounded.alias("removal_effect"), rounded.alias("removal_effect_raw"))
    return share_of_total(table, "removal_effect")


def drop_zero(effects: DataFrame) -> DataFrame:
    return effects.filter("removal_effect != 0")


def sent(raw: DataFrame) -> str:
    """How removal effects go to every task: as "rows", "packed" by channel, or "" where they are too many."""
    if raw.limit(FEW_WEIGHTS + 1).count() <= FEW_WEIGHTS:
        return "rows"
    cohorts = raw.select(*COHORT).distinct().count()
    names = raw.select("channel").distinct()
    size = names.agg(F.sum(F.octet_length("channel") + 64 + 8 * cohorts)).first()[0]
    return "packed" if size <= PACKED_BYTES else ""


def with_weights(touches: DataFrame, weights: DataFrame) -> DataFrame:
    """`touches` with `weight_` of their cohort and channel, where there is one, shuffled only if the weights are too many to send.

    Packed, a channel has one list with a place for each cohort, so that it is sent once.
    """
    how = sent(weights)
    if how != "packed":
        return touches.join(F.broadcast(weights) if how else weights, [*COHORT, "channel"], "left")
    cohorts = weights.select(*COHORT).distinct().repartition(1)
    cohorts = materialize(cohorts.withColumn("cohort_", F.monotonically_increasing_id().cast("int")))
    listed = F.map_from_entries(F.collect_list(F.struct("cohort_", "weight_")))
    packed = weights.join(F.broadcast(cohorts), COHORT).groupBy("channel").agg(listed.alias("listed_"))
    each = F.transform(F.sequence(F.lit(0), F.lit(cohorts.count() - 1)), lambda i: F.col("listed_")[i])
    packed = materialize(packed.select("channel", each.alias("packed_")))
    found = touches.join(F.broadcast(cohorts), COHORT, "left").join(F.broadcast(packed), "channel", "left")
    return found.select(*touches.columns, F.get("packed_", F.col("cohort_")).alias("weight_"))


def with_markov_credit(touches: DataFrame, raw: DataFrame, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Share of a converting journey in proportion to the removal effects of its touches.

    The weights of a journey are summed by a window, so touches laid out by user (`materialize_by`) are not shuffled;
    journeys of more than `hot_rows` touches are summed by an aggregation and joined, which adaptive execution splits.
    `raw` should be a written table: it is broadcast where its rows are few, or where they are when packed by channel.
    """
    weighed = with_weights(touches, raw.select(*COHORT, "channel", F.col("removal_effect_raw").alias("weight_")))
    share = F.try_divide(F.col("weight_"), F.col("weights_"))
    credit = F.when(F.col("conversion_value") == 1, share).otherwise(0.0)
    long = F.col("touch_count") > hot_rows
    summed = weighed.filter(~long).withColumn("weights_", F.sum("weight_").over(Window.partitionBy(*JOURNEY)))
    if not touches.filter(long).isEmpty():
        totals = weighed.filter(long).groupBy(*JOURNEY).agg(F.sum("weight_").alias("weights_"))
        summed = summed.unionByName(weighed.filter(long).join(totals, JOURNEY))
    return summed.withColumn(MODELS["markov"], credit).drop("weight_", "weights_")
