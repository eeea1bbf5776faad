"""Connected components of an edge table by alternating large and small stars.

Every round is a few aggregations and joins over the edges and is written to the shared folder. A node with
very many neighbours is only ever a key of a map-side combined minimum or of a join between two written
tables, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize


def _state(edges: DataFrame) -> tuple[int, bool]:
    """The number of edges, and whether they are stars: every upper node has one edge and is nobody's lower node."""
    ends = edges.select(F.col("hi").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("low")).unionByName(
        edges.select(F.col("lo").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("low"))
    )
    nodes = ends.groupBy("u").agg(F.sum("up").alias("n"), F.max("low").alias("low"))
    count, open_nodes = nodes.agg(F.sum("n"), F.count_if(F.expr("n > 1 or (n = 1 and low = 1)"))).first()
    return count or 0, not open_nodes


#: Edges that a task of a round holds.
TASK_EDGES = 200_000


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for all nodes of edges (a, b) of longs; component is the smallest node reached.

    Nulls and loops are dropped, repeated edges count once; a node of loops only does not appear.
    """
    live = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    )
    count, stars = _state(live)
    while not stars:
        # The number of tasks of a round follows the number of edges.
        tasks = max(16, count // TASK_EDGES)
        both = live.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            live.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = materialize(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")).coalesce(tasks))
        large = materialize(
            both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).coalesce(tasks)
        )
        small = materialize(large.groupBy("hi").agg(F.min("lo").alias("m")).coalesce(tasks))
        live = materialize(
            large.join(small, "hi")
            .filter("lo <> m")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionByName(small.select("hi", F.col("m").alias("lo")))
            .distinct()
            .coalesce(tasks)
        )
        count, stars = _state(live)
    return live.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        live.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )


def relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (node, component) after further links (a, b): only the components they touch are joined anew."""
    x, y = (labels.select(F.col("node").alias(f"n{i}"), F.col("component").alias(f"c{i}")) for i in "xy")
    met = links.join(x, F.col("a") == F.col("nx"), "left").join(y, F.col("b") == F.col("ny"), "left")
    met = materialize(
        met.select("a", "b", F.coalesce("cx", "a").alias("ca"), F.coalesce("cy", "b").alias("cb"), F.col("nx"), F.col("ny"))
    )
    joined = materialize(components(met.select(F.col("ca").alias("a"), F.col("cb").alias("b"))))
    fresh = met.filter("nx is null").select(F.col("a").alias("node")).unionByName(
        met.filter("ny is null").select(F.col("b").alias("node"))
    )
    known = labels.unionByName(fresh.distinct().withColumn("component", F.col("node")))
    ends = joined.select(F.col("node").alias("end"), F.col("component").alias("least"))
    return known.join(ends, F.col("component") == F.col("end"), "left").select(
        "node", F.coalesce("least", "component").alias("component")
    )
