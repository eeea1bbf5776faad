"""Joins whose left side holds keys with very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import HOT_KEY_ROWS, materialize

PART = "part_"


def key_parts(rows: DataFrame, keys: list[str], limit: int = HOT_KEY_ROWS) -> DataFrame:
    """Keys of more than `limit` rows and the number of parts, of some `limit` rows each, that they are dealt to.

    Counted with map-side combine; at most rows / limit keys.
    """
    counted = rows.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
    hot = counted.filter(F.col("key_rows") > limit)
    return materialize(hot.select(*keys, F.ceil(F.col("key_rows") / limit).cast("int").alias("parts_")))


def deal(rows: DataFrame, keys: list[str], parts: DataFrame, spread: list[str]) -> DataFrame:
    """`rows` with the part of their key each belongs to, by the hash of the columns `spread`; 0 where the key is not hot.

    The part follows from the row, so a task that runs again deals alike.
    """
    parted = rows.join(F.broadcast(parts), keys, "left")
    part = F.coalesce(F.pmod(F.xxhash64(*spread), F.col("parts_")), F.lit(0)).cast("int")
    return parted.withColumn(PART, part).drop("parts_")


def salted_left_join(
    rows: DataFrame, other: DataFrame, keys: list[str], spread: list[str], limit: int = HOT_KEY_ROWS
) -> DataFrame:
    """`rows` left-joined with `other`, hot keys of `rows` dealt to several tasks, with a copy of the other side for each.

    `rows` should be a written table: it is read once more for the counts. Copies of the other side are as many as
    the parts of its key, so some rows / limit in all for each of its rows of a hot key.
    """
    parts = key_parts(rows, keys, limit)
    if parts.isEmpty():
        return rows.join(other, keys, "left")
    copies = other.join(F.broadcast(parts), keys, "left")
    last = F.coalesce(F.col("parts_"), F.lit(1)) - 1
    copies = copies.withColumn(PART, F.explode(F.sequence(F.lit(0), last))).drop("parts_")
    return deal(rows, keys, parts, spread).join(copies, [*keys, PART], "left").drop(PART)
