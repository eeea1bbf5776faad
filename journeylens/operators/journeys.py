"""From visit rows to touches: one row per visit with its journey and place in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import NO_TOUCHPOINT
from ..names import CONV_TS, FLAG, TOUCHPOINT, USER, VISIT_TS, WINDOWS
from ..runtime import HOT_KEY_ROWS, hot_keys
from .scan import ordered_scan
from .windows import explode_windows

SPLIT_KEYS = ["run_date", "conversion_type", USER]
# What windowed visits and touches are laid out by: all that follows by user, conversion or journey needs no shuffle, and
# rows of one visit lie together, which compresses.
LAYOUT = [USER]
CHUNK_SECONDS = 60
# Rows, with the dates of `run_dates` exploded, that a task orders: some 300 bytes each, in two sorts at a time.
TASK_ROWS = 500_000

DECAY, DECAY_HOURS = 0.6, 7
# Rules whose converting visits may differ between the windows of one cohort: each window is ordered on its own.
OWN_MAXIMUM = {"conversion_time"}


def flag_rule(rule: str) -> tuple[Column | None, Column]:
    """What is maximised per user and cohort, and the condition for a converting visit."""
    was, at, last = F.col("recorded_") == 1, F.col(VISIT_TS), F.col("last_")
    rules = {
        "last_visit": (at, (at == last) & was),
        "conversion_time": (F.col(CONV_TS), (at == last) & was),
        "last_visit_only": (at, at == last),
        "conversion_day": (None, F.to_date(CONV_TS) == F.col("run_date")),
        "as_is": (None, was),
    }
    return rules[rule]


def touches_once(
    visits: DataFrame,
    rule: str = "last_visit",
    channel: str = TOUCHPOINT,
    decay: float = DECAY,
    decay_hours: int = DECAY_HOURS,
    hot_rows: int | None = HOT_KEY_ROWS,
    keep: tuple[str, ...] = (),
    windows: tuple[int, ...] = tuple(WINDOWS),
    laid_out: bool = False,
    layout: int | None = None,
) -> DataFrame:
    """Order each user's visits once, cut journeys after conversions, place each touch in every window.

    `visits` holds the cohort key: `conversion_window`, or the list `conversion_windows` of nested windows (each
    holding the last visits of the next), and `run_date`, or the list `run_dates`. The rows are shuffled once, by date, type and user, or with
    `laid_out` not at all, `visits` being laid out by LAYOUT, in `layout` tasks if these are not the session's; with
    `run_dates` by type and user, the dates being exploded afterwards, into as many tasks as the exploded rows ask for,
    so `visits` should then be a written table; every window function reuses that partitioning.
    The narrower windows of a cohort hold the last visits of the widest one, so one order serves them all: a row
    carries its places in the list `placed`, one entry per window. Users with more than `hot_rows` rows are split by
    time instead (see `ordered_scan`).
    """
    listed = [c for c in ("conversion_window", "conversion_windows", "run_dates") if c in visits.columns]
    keys = [k for k in SPLIT_KEYS if k != "run_date" or "run_dates" not in listed]
    if "run_date" not in visits.columns and "run_dates" not in listed:
        visits = visits.withColumn("run_date", F.to_date(CONV_TS))
    if "conversion_windows" in listed and rule in OWN_MAXIMUM:
        visits = explode_windows(visits)
        listed = ["conversion_window" if c == "conversion_windows" else c for c in listed]
    rows = visits.filter(F.col(USER).isNotNull() & F.col("conversion_type").isNotNull()).select(
        *keys, *listed, VISIT_TS, CONV_TS, F.col(FLAG).cast("int").alias("recorded_"),
        F.coalesce(F.col(channel), F.lit(NO_TOUCHPOINT)).alias("channel"), *keep,
    )
    tasks = exploded_tasks(rows) if "run_dates" in listed else None
    arguments = (keys, rule, decay, decay_hours, windows if "conversion_windows" in listed else None, tasks, laid_out)
    hot = hot_keys(rows, keys, hot_rows) if hot_rows else None
    if hot is None or hot.isEmpty():
        return _place(rows, None, *arguments)
    usual = _place(rows.join(F.broadcast(hot), keys, "left_anti"), None, *arguments)
    minutes = F.floor(F.unix_micros(VISIT_TS) / (CHUNK_SECONDS * 1_000_000))
    busy = rows.join(F.broadcast(hot), keys, "left_semi").withColumn("chunk_", minutes)
    both = usual.unionByName(_place(busy, "chunk_", *arguments).drop("chunk_"))
    return both.repartition(*([layout] if layout else []), *LAYOUT) if laid_out else both


def exploded_tasks(rows: DataFrame) -> int:
    """Tasks of some TASK_ROWS rows each once `run_dates` is exploded.

    Dates are exploded after the shuffle, so the sizes that adaptive execution sees there say nothing of the sorts.
    """
    exploded = rows.agg(F.sum(F.size("run_dates").cast("long"))).first()[0] or 0
    return max(1, -(-exploded // TASK_ROWS))


def per_window(placed: DataFrame) -> DataFrame:
    """One row per touch and window."""
    if "placed" not in placed.columns:
        return placed
    return placed.withColumn("placed", F.explode("placed")).select("*", "placed.*").drop("placed")


def touches(visits: DataFrame, *arguments, **options) -> DataFrame:
    """`touches_once`, one row per touch and window."""
    return per_window(touches_once(visits, *arguments, **options))


def _place(
    rows: DataFrame, chunk: str | None, keys: list[str], rule: str, decay: float, decay_hours: int,
    nested: tuple[int, ...] | None, tasks: int | None, laid_out: bool,
) -> DataFrame:
    if chunk or tasks or not laid_out:
        rows = rows.repartition(*([tasks] if tasks else []), *keys, *([chunk] if chunk else []))
    if "run_dates" in rows.columns:
        rows = rows.withColumn("run_date", F.explode("run_dates")).drop("run_dates")
    by_user = SPLIT_KEYS + ["conversion_window"] * (nested is None)
    held = {w: F.array_contains("conversion_windows", w) if nested else F.lit(True) for w in nested or (0,)}
    maximum, converting = flag_rule(rule)
    # Of visits at the same time the converting one comes last, then the channel decides. What
    # still ties is interchangeable: the maximum rules flag by time and recorded flag alone.
    order = [VISIT_TS, FLAG if maximum is None else "recorded_", "channel"]
    if maximum is not None:
        rows = ordered_scan(rows, by_user, order, total={"last_": ("max", maximum)}, chunk=chunk)
    rows = rows.withColumn(FLAG, F.when(converting, 1).otherwise(0)).drop("last_")
    # The rank settles the order of interchangeable rows for all that follows. Conversions before a window begins are
    # those of rows outside it.
    rows = ordered_scan(
        rows,
        by_user,
        order,
        before={"journey_": F.col(FLAG), "rank_": F.lit(1)},
        following={"next_channel": F.col("channel")},
        total={f"earlier_{w}": ("sum", F.when(inside, 0).otherwise(F.col(FLAG))) for w, inside in held.items()},
        chunk=chunk,
    )
    rows = ordered_scan(
        rows,
        by_user + ["journey_"],
        ["rank_"],
        before={f"position_{w}": F.when(inside, 1).otherwise(0) for w, inside in held.items()},
        total={
            **{f"count_{w}": ("sum", F.when(inside, 1).otherwise(0)) for w, inside in held.items()},
            "conversion_value": ("max", F.col(FLAG)),
            "journey_end": ("max", F.col(VISIT_TS)),
        },
        chunk=chunk,
    )
    periods = F.floor(
        (F.unix_micros("journey_end") - F.unix_micros(VISIT_TS)) / F.lit(decay_hours * 3_600_000_000)
    )
    rows = rows.withColumns(
        {
            "next_channel": F.when(F.col(FLAG) == 0, F.col("next_channel")),
            "decay_weight": F.pow(F.lit(decay), periods),
        }
    )
    weights = {f"decay_{w}": ("sum", F.when(inside, F.col("decay_weight")).otherwise(0.0)) for w, inside in held.items()}
    rows = ordered_scan(rows, by_user + ["journey_"], ["rank_"], total=weights, chunk=chunk)

    def place(w: int) -> dict[str, Column]:
        return {
            "journey_no": F.col("journey_") - F.col(f"earlier_{w}"),
            "position": F.col(f"position_{w}") + 1,
            "touch_count": F.col(f"count_{w}"),
            "decay_total": F.col(f"decay_{w}"),
        }

    if nested:
        entry = lambda w: F.struct(F.lit(w).alias("conversion_window"), *(v.alias(k) for k, v in place(w).items()))
        rows = rows.withColumn("placed", F.array_compact(F.array(*(F.when(x, entry(w)) for w, x in held.items()))))
    else:
        rows = rows.withColumns(place(0))
    own = [f"{name}_{w}" for name in ("earlier", "position", "count", "decay") for w in held]
    return rows.drop("recorded_", "rank_", "journey_", "conversion_windows", *own)
