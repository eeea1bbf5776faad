"""Near-duplicate embeddings by NN-descent over a neighbour graph.

1. Equal vectors are one node. Several orders of random-hyperplane codes put nodes of small angles side by side; each
   node is compared with the next ones of each order, which gives the first neighbour lists. Orders and places compared
   grow with the logarithm of the number of nodes.
2. NN-descent: the members of each list are compared with each other (neighbours of neighbours), the best NEIGHBOURS of each
   node stay, however far, so that a pair among unrelated vectors is reached over common neighbours too; until the lists
   hardly change.
3. Where all of a list is linked, more links may exist than it holds. So lists are enlarged to all nodes reached by
   links and compared again, block by block, in double precision; this gives the links and their numbers.
4. A sample of vectors is compared with all rows: of those with links, the share that has all of them. Orders are added
   with twice the window, and the lists descend further, until that share is reached; every result has passed this audit.

Cosines are first taken in single precision with some slack, and linked in double precision only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize
from .components import components

LINK = 0.9
SLACK = 1e-4
#: Least orders and places compared in each; of those below LINK, so many closest start a list.
ORDERS, CODE_BITS, WINDOW, STARTS = 12, 48, 8, 2
#: Members of a list, and the share of new ones in lists not full of links at which the descent ends.
NEIGHBOURS, SETTLED = 8, 0.01
BLOCK = 512
#: Vectors of the first draw of the audit and of a later one at most, the vectors with links that it must meet (or else
#: it draws all), and the share of them that must have all their links.
AUDITED, DRAWN, MET, RECALL = 512, 4096, 200, 0.95
#: Vectors in components of more nodes count apart, so that large groups do not hide what small ones lose.
HOT = 100


def _matrix(column: pa.Array, kind=np.float32) -> np.ndarray:
    """Rows of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind, copy=False) if len(column) else np.empty((0, 0), kind)


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys, units = [], [], []
        for vec_id, value in zip(batch.column(0), batch.column(1)):
            numbers = value.as_py()
            if vec_id.as_py() is None or not numbers or None in numbers:
                continue
            x = np.array(numbers, np.float64)
            top = np.abs(x).max()
            if not np.isfinite(top) or top == 0:
                continue
            x = x / top
            x = x / np.sqrt(x @ x)
            ids.append(vec_id.as_py())
            keys.append(xxhash.xxh3_128_hexdigest(x.tobytes()))
            units.append(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(keys, pa.string()), pa.array(units, pa.list_(pa.float64()))],
            ["vec_id", "key", "unit"],
        )


def nodes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, node) of the vectors that can link, and (node, copies, dim, unit) of the different ones.

    Of several vectors under one id the first in order counts. A node is the smallest id of its equal vectors.
    """
    units = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>")).mapInArrow(
        _unit, "vec_id long, key string, unit array<double>"
    )
    one = materialize(units.groupBy("vec_id").agg(F.min(F.struct("key", "unit")).alias("x")).select("vec_id", "x.*"))
    classes = materialize(one.groupBy("key").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")))
    owners = materialize(one.select("vec_id", "key").join(classes, "key").select("vec_id", "node", "copies"))
    first = owners.filter("vec_id = node").select("node", "copies")
    return owners, materialize(
        one.join(first, F.col("vec_id") == F.col("node")).select("node", "copies", F.size("unit").alias("dim"), "unit")
    )


def _coded(orders: range):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 1024):
                part = batch.slice(row, 1024)
                dims = np.asarray(part.column(1))
                for dim in np.unique(dims):
                    own = part.filter(pa.array(dims == dim))
                    x = _matrix(own.column(2))
                    for order in orders:
                        planes = np.random.default_rng([order, int(dim)]).standard_normal((int(dim), CODE_BITS))
                        bits = (x @ planes.astype(np.float32) > 0).astype(np.int64)
                        code = bits @ (1 << np.arange(CODE_BITS, dtype=np.int64)[::-1])
                        group = np.full(len(x), int(dim) << 16 | order, np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(group), pa.array(code), own.column(0), own.column(2).cast(pa.list_(pa.float32()))],
                            ["part", "code", "node", "unit"],
                        )

    return apply


def _neighbours(window: int):
    """Compares each row of an ordered stream with the `window` rows before it; gives all that may link, and STARTS others."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([*(rest.to_batches() if rest else []), batch]).combine_chunks()
            done = rest.num_rows if rest else 0
            part, node = rows["part"].to_numpy(), rows["node"].to_numpy()
            for group in np.unique(part):
                at = np.flatnonzero(part == group)
                wide = min(window, len(at) - 1)
                if wide < 1:
                    continue
                x = _matrix(rows["unit"].combine_chunks().take(pa.array(at)) if len(at) < len(part) else rows["unit"].combine_chunks())
                close = np.full((len(at), wide), -2, np.float32)
                for d in range(1, wide + 1):
                    close[d:, d - 1] = np.einsum("ij,ij->i", x[d:], x[:-d])
                good = close >= LINK - SLACK
                best = np.argsort(-close, axis=1)[:, :STARTS]
                good[np.arange(len(at))[:, None], best] = True
                good &= (close > -2) & (at >= done)[:, None]
                i, back = np.nonzero(good)
                if len(i):
                    yield _pairs(node[at[i]], node[at[i - back - 1]], close[i, back])
            rest = rows.slice(max(0, rows.num_rows - window))

    return apply


def _pairs(a: np.ndarray, b: np.ndarray, close: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(close.astype(np.float32))], ["a", "b", "close"]
    )


def first_pairs(points: DataFrame, orders: range, window: int) -> DataFrame:
    coded = points.select("node", "dim", "unit").mapInArrow(
        _coded(orders), "part long, code long, node long, unit array<float>"
    )
    ordered = coded.repartitionByRange("part", "code", "node").sortWithinPartitions("part", "code", "node")
    pairs = ordered.mapInArrow(_neighbours(window), "a long, b long, close float")
    return pairs.groupBy("a", "b").agg(F.max("close").alias("close"))


def best_lists(pairs: DataFrame) -> DataFrame:
    """Rows (u, v, close): the NEIGHBOURS closest of each node."""
    both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"), "close").unionByName(
        pairs.select(F.col("b").alias("u"), F.col("a").alias("v"), "close")
    )
    order = Window.partitionBy("u").orderBy(F.desc("close"), "v")
    return both.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= NEIGHBOURS).drop("place")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs within each list of a stream ordered by list that may link or are closer than the last in the list of one
    of both; a list has NEIGHBOURS + 1 members at most."""
    rest = None
    last = False
    stream = iter(batches)
    while not last:
        batch = next(stream, None)
        last = batch is None
        parts = [*(rest.to_batches() if rest else []), *([] if last else [batch])]
        if not parts:
            return
        rows = pa.Table.from_batches(parts).combine_chunks()
        owner = rows["u"].to_numpy()
        cut = len(owner) if last else int(np.searchsorted(owner, owner[-1])) if len(owner) else 0
        rest = rows.slice(cut)
        if not cut:
            continue
        rows = rows.slice(0, cut)
        owner, node = rows["u"].to_numpy(), rows["member"].to_numpy()
        units, least = rows["unit"].combine_chunks(), rows["least"].to_numpy()
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        out = []
        for start, end in zip(starts, np.r_[starts[1:], len(owner)]):
            if end - start > 2:
                x = _matrix(units.slice(start, end - start))
                close = x @ x.T
                wanted = np.minimum(least[start:end], LINK - SLACK)
                i, j = np.nonzero(np.triu((close > wanted[:, None]) | (close > wanted[None, :]), 1))
                out.append((node[start + i], node[start + j], close[i, j]))
        if out:
            yield _pairs(*(np.concatenate(c) for c in zip(*out)))


def _last(lists: DataFrame) -> DataFrame:
    """Rows (member, least): the closeness of the last in a node's list, -2 while the list has room."""
    full = F.count(F.lit(1)) >= NEIGHBOURS
    return lists.groupBy(F.col("u").alias("member")).agg(F.when(full, F.min("close")).otherwise(-2.0).cast("float").alias("least"))


def descend(points: DataFrame, pairs: DataFrame, lists: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """NN-descent from some pairs (a, b, close) and earlier lists.

    Gives all pairs it came across that may link, and the first ones; and the lists (u, v, close).
    """

    def known() -> DataFrame:
        return lists.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), "close")

    def merged(more: DataFrame) -> DataFrame:
        return materialize(best_lists(known().unionByName(more).groupBy("a", "b").agg(F.max("close").alias("close"))))

    narrow = materialize(points.select(F.col("node").alias("member"), F.col("unit").cast("array<float>").alias("unit")))
    linked = [pairs.filter(F.col("close") >= LINK - SLACK).select("a", "b")]
    before, lists = lists, materialize(best_lists(pairs)) if lists is None else merged(pairs)
    while True:
        # Lists without a new member were compared before.
        fresh = lists if before is None else materialize(lists.join(before, ["u", "v"], "left_anti"))
        last = materialize(_last(lists))
        if before is not None:
            open_lists = lists.join(last.filter(F.col("least") < LINK).select(F.col("member").alias("u")), "u", "left_semi")
            open_fresh = fresh.join(last.filter(F.col("least") < LINK).select(F.col("member").alias("u")), "u", "left_semi")
            if open_fresh.count() <= SETTLED * open_lists.count():
                break
        owners = fresh.select("u").distinct()
        members = lists.join(owners, "u", "left_semi").select("u", F.col("v").alias("member")).unionByName(
            owners.select("u", F.col("u").alias("member"))
        )
        found = materialize(
            members.join(last, "member").join(narrow, "member").repartition("u").sortWithinPartitions("u", "member")
            .mapInArrow(_joined, "a long, b long, close float").groupBy("a", "b").agg(F.max("close").alias("close"))
        )
        linked.append(found.filter(F.col("close") >= LINK - SLACK).select("a", "b"))
        before, lists = lists, merged(found)
    out = linked[0]
    for more in linked[1:]:
        out = out.unionByName(more)
    return out.distinct(), lists


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the two halves of each block pair: per node how many, and a forest that connects them."""
    rest, last, stream = None, False, iter(batches)
    while not last:
        batch = next(stream, None)
        last = batch is None
        parts = [*(rest.to_batches() if rest else []), *([] if last else [batch])]
        if not parts:
            return
        rows = pa.Table.from_batches(parts).combine_chunks()
        keys = np.stack([rows[c].to_numpy() for c in ("component", "i", "j")])
        starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(0)]) if keys.shape[1] else []
        ends = [*starts[1:], rows.num_rows]
        for start, end in zip(starts, ends):
            if end == rows.num_rows and not last:
                rest = rows.slice(start)
                break
            rest = None
            own = rows.slice(start, end - start).combine_chunks()
            node, block, copies = (own[c].to_numpy() for c in ("node", "block", "copies"))
            x = _matrix(own["unit"].combine_chunks(), np.float64)
            one = keys[1, start] == keys[2, start]
            left, right = (np.arange(len(node)),) * 2 if one else (np.flatnonzero(block == keys[i, start]) for i in (1, 2))
            close = x[left] @ x[right].T >= LINK
            if one:
                np.fill_diagonal(close, False)
            counted = [(left, close @ copies[right])] if one else [(left, close @ copies[right]), (right, copies[left] @ close)]
            at = np.concatenate([c[0] for c in counted])
            n = np.concatenate([c[1] for c in counted]).astype(np.int64)
            some = n > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[at][some]), pa.array(n[some]), pa.nulls(int(some.sum()), pa.int64())], ["node", "n", "other"]
            )
            a, b = _forest(close, left, right, len(node))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[a]), pa.array(np.zeros(len(a), np.int64)), pa.array(node[b])], ["node", "n", "other"]
            )


def _forest(close: np.ndarray, left: np.ndarray, right: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a forest that connects what the links connect, breadth first."""
    row, column = np.full(count, -1), np.full(count, -1)
    row[left], column[right] = np.arange(len(left)), np.arange(len(right))
    free, edges = np.ones(count, bool), []
    for root in range(count):
        if not free[root]:
            continue
        free[root] = False
        wave = [root]
        while wave:
            v = wave.pop()
            mask = np.zeros(count, bool)
            if row[v] >= 0:
                mask[right[close[row[v]]]] = True
            if column[v] >= 0:
                mask[left[close[:, column[v]]]] = True
            new = np.flatnonzero(mask & free)
            free[new] = False
            edges += [(v, w) for w in new]
            wave += new.tolist()
    pairs = np.array(edges, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def enlarge(points: DataFrame, reached: DataFrame) -> DataFrame:
    """Rows (node, n, other) from (node, component): numbers of linked vectors in the component, to be summed, and (where
    other is set) links that connect."""
    sizes = reached.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
    sized = materialize(sizes)
    placed = reached.join(sized, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    turn = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("turn")
    dealt = placed.select("node", "component", "block", turn).select(
        "node", "component", "block", F.least("block", "turn").alias("i"), F.greatest("block", "turn").alias("j")
    )
    filled = dealt.join(points.select("node", "copies", "unit"), "node")
    return filled.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "node").mapInArrow(
        _blocks, "node long, n long, other long"
    )


def _truth(points: DataFrame, sample: DataFrame) -> DataFrame:
    """Rows (node, true): with how many of all vectors each node of the sample (node, dim, unit) links."""
    drawn = sample.toArrow()
    asked, dims = drawn["node"].to_numpy(), drawn["dim"].to_numpy()
    units = drawn["unit"].combine_chunks()
    queries = {int(d): (asked[dims == d], _matrix(units.filter(pa.array(dims == d)), np.float64)) for d in set(dims)}
    shared = points.sparkSession.sparkContext.broadcast(queries)  # some DRAWN vectors

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_dims = np.asarray(batch.column("dim"))
            for dim, (ids, units) in shared.value.items():
                own = batch.filter(pa.array(all_dims == dim))
                if own.num_rows:
                    near = _matrix(own.column("unit"), np.float64) @ units.T >= LINK
                    near &= np.asarray(own.column("node"))[:, None] != ids[None, :]
                    n = (np.asarray(own.column("copies")) @ near).astype(np.int64)
                    some = n > 0
                    yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(n[some])], ["node", "n"])

    return points.mapInArrow(apply, "node long, n long").groupBy("node").agg(F.sum("n").alias("true"))


def audit(points: DataFrame, totals: DataFrame, reached: DataFrame) -> float:
    """Of the nodes of a sample that link with any row, the share with all their links in totals (node, n).

    Nodes in components of over HOT nodes and all others count apart, and the smaller share is given. Nodes are drawn by
    hash until MET others with links are met, or all are drawn; where there is no link at all, the share is 1.
    """
    sizes = reached.groupBy("component").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > HOT)
    hot = reached.join(sizes, "component").select("node", F.lit(True).alias("hot"))
    known = materialize(totals.join(hot, "node", "left").select("node", "n", F.coalesce("hot", F.lit(False)).alias("hot")))
    count = points.count()
    met, whole = {True: 0, False: 0}, {True: 0, False: 0}
    last, size = 0.0, AUDITED
    while last < 1 and met[False] < MET and count:
        to = min(1.0, last + size / count)
        place = (F.xxhash64(F.lit(7), "node") / 2.0**64) + 0.5
        sample = points.filter((place >= last) & (place < to) if to < 1 else place >= last).select("node", "dim", "unit")
        both = _truth(points, sample).join(known, "node", "left").select(
            F.coalesce("hot", F.lit(False)).alias("hot"), (F.coalesce("n", F.lit(0)) >= F.col("true")).alias("whole")
        )
        for row in both.groupBy("hot").agg(F.count(F.lit(1)).alias("met"), F.count_if("whole").alias("whole")).collect():
            met[row.hot] += row.met
            whole[row.hot] += row.whole
        last, size = to, min(2 * size, DRAWN)
    return min((whole[k] / met[k] for k in met if met[k]), default=1.0)


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row of vectors (vec_id, embedding).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
    different lengths with each other. Rows without an id have no component and are kept.
    """
    owners, points = nodes(vectors)
    size = points.count().bit_length()
    orders, window = max(ORDERS, size), max(WINDOW, size)
    links, lists = descend(points, materialize(first_pairs(points, range(orders), window)))
    pairs = materialize(links)
    while True:
        reached = materialize(components(pairs))
        counted = materialize(enlarge(points, reached))
        totals = materialize(counted.groupBy("node").agg(F.sum("n").alias("n")))
        if audit(points, totals, reached) >= RECALL:
            break
        window *= 2
        further, lists = descend(points, materialize(first_pairs(points, range(orders, 2 * orders), window)), lists)
        pairs = materialize(pairs.unionByName(further).distinct())
        orders *= 2
    labels = materialize(components(counted.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))))
    per_node = materialize(
        points.select("node")
        .join(totals, "node", "left")
        .join(labels, "node", "left")
        .select("node", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "node").alias("component"))
    )
    per_id = owners.join(per_node, "node").select(
        F.col("vec_id").alias("own_id"), (F.col("n") + F.col("copies") - 1).alias("n_links"), "component"
    )
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    component = F.coalesce("component", "vec_id")
    return rows.join(per_id, F.col("vec_id") == F.col("own_id"), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
