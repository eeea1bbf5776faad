"""Ordered computations per key that do not need the whole key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MERGE = {"sum": F.sum, "max": F.max, "min": F.min}


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    before: dict[str, Column] | None = None,
    total: dict[str, tuple[str, Column]] | None = None,
    following: dict[str, Column] | None = None,
    chunk: str | None = None,
) -> DataFrame:
    """Add columns to each row from the rows of the same keys, taken in `order`.

    before     sum over the rows before this one
    total      ("sum" | "max" | "min", value) over all rows of the keys
    following  the value on the next row

    Without `chunk` these are plain windows. With `chunk`, a column that grows with the
    order, windows run within (keys, chunk); one summary row per chunk then carries the
    state from chunk to chunk, and is joined back. No task sees more than one chunk's rows.
    """
    before, total, following = before or {}, total or {}, following or {}
    group = keys + ([chunk] if chunk else [])
    ordered = Window.partitionBy(*group).orderBy(*order)
    prior = ordered.rowsBetween(Window.unboundedPreceding, -1)
    # Ordered too, though it spans all rows: so all columns come from one sort.
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    columns = {name: F.coalesce(F.sum(v).over(prior), F.lit(0)) for name, v in before.items()}
    columns |= {name: F.lead(v).over(ordered) for name, v in following.items()}
    if not chunk:
        columns |= {name: MERGE[how](v).over(whole) for name, (how, v) in total.items()}
        return df.withColumns(columns)

    last_of_chunk = F.lead(F.lit(1)).over(ordered).isNull()
    local = df.withColumns(columns | {"last_of_chunk_": last_of_chunk}) if columns else df
    parts = [F.sum(v).alias(f"{name}_part_") for name, v in before.items()]
    parts += [MERGE[how](v).alias(f"{name}_part_") for name, (how, v) in total.items()]
    parts += [F.min_by(v, F.struct(*order)).alias(f"{name}_part_") for name, v in following.items()]
    summary = df.groupBy(*group).agg(*parts)
    steps = Window.partitionBy(*keys).orderBy(chunk)
    earlier = steps.rowsBetween(Window.unboundedPreceding, -1)
    every = steps.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = summary.select(
        *group,
        *[F.coalesce(F.sum(f"{n}_part_").over(earlier), F.lit(0)).alias(f"{n}_carry_") for n in before],
        *[MERGE[how](f"{n}_part_").over(every).alias(n) for n, (how, _) in total.items()],
        *[F.lead(f"{n}_part_").over(steps).alias(f"{n}_carry_") for n in following],
    )
    joined = local.join(carried, group)
    joined = joined.withColumns(
        {n: F.col(n) + F.col(f"{n}_carry_") for n in before}
        | {n: F.when(F.col("last_of_chunk_"), F.col(f"{n}_carry_")).otherwise(F.col(n)) for n in following}
    ) if columns else joined
    return joined.drop("last_of_chunk_", *[f"{n}_carry_" for n in [*before, *following]])
