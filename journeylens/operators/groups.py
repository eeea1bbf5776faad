"""Connected groups of nodes: a forest per task, joined across tasks by contraction."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Nodes that a task joins before it hands them on.
FOREST_NODES = 1_000_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of the links with the root of its tree; a node may come again, with another root."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        top = node
        while parent[top] != top:
            top = parent[top]
        while parent[node] != top:
            parent[node], node = top, parent[node]
        return top

    def handed_on() -> pa.RecordBatch:
        nodes = list(parent)
        columns = [pa.array(nodes, pa.int64()), pa.array([root(node) for node in nodes], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["node", "root"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        if len(parent) > FOREST_NODES:
            yield handed_on()
            parent.clear()
    yield handed_on()


def connected_groups(links: DataFrame) -> DataFrame:
    """Rows (node, group), one per node of the links (a, b) of longs; nodes joined by a walk share a group.

    Every task joins the links it holds, so links dealt by some key that groups never cross are done in one pass. What
    groups share nodes of several tasks is then contracted (see `_contracted`).
    """
    forest = materialize(links.select("a", "b").mapInArrow(_forest, "node long, root long"))
    least = materialize(forest.groupBy("node").agg(F.min("root").alias("group")))
    crossing = forest.join(least, "node").filter(F.col("root") != F.col("group"))
    crossing = materialize(crossing.select(F.col("root").alias("a"), F.col("group").alias("b")).distinct())
    if crossing.isEmpty():
        return least
    joined = _contracted(crossing).select(F.col("node").alias("from"), F.col("group").alias("to"))
    return least.join(joined, F.col("group") == F.col("from"), "left").select(
        "node", F.coalesce("to", "group").alias("group")
    )


def _contracted(links: DataFrame) -> DataFrame:
    """The same by rounds over the whole table.

    Each round every node takes the name of the neighbour with the least hash, itself included, and the links are
    rewritten to those names. A path loses about half of its nodes a round, a star all but one; rounds end when no
    link is left. A node's links meet only in a combined minimum, so one of very many neighbours is no hot key.
    """
    live = materialize(links.select("a", "b").distinct())
    nodes = live.select(F.col("a").alias("node")).unionByName(live.select(F.col("b").alias("node"))).distinct()
    named = materialize(nodes.withColumn("group", F.col("node")))
    live = live.filter("a <> b")
    turn = 0
    while not live.isEmpty():
        turn += 1
        ends = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        key = lambda name: F.struct(F.xxhash64(name, F.lit(turn)).alias("hash"), F.col(name).alias("name"))  # noqa: E731, B023
        least = ends.groupBy("a").agg(F.least(F.min(key("b")), key("a"))["name"].alias("to"))
        moves = materialize(least.select(F.col("a").alias("from"), "to"))
        named = materialize(
            named.join(moves, F.col("group") == F.col("from"), "left").select(
                "node", F.coalesce("to", "group").alias("group")
            )
        )
        first, second = (moves.select(F.col("from").alias(f"from_{x}"), F.col("to").alias(f"to_{x}")) for x in "ab")
        live = materialize(
            live.join(first, F.col("a") == F.col("from_a"))
            .join(second, F.col("b") == F.col("from_b"))
            .filter("to_a <> to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .distinct()
        )
    return named
