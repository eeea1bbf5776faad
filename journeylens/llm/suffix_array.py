"""Repeated passages by a distributed suffix array: every byte of a WIDTH-byte string that also starts elsewhere goes.

Sampled suffixes. A suffix is kept where its first LEAD bytes have the least hash of all LEAD-byte strings in some
window of WIDTH bytes (the leftmost of equals). Equal windows choose alike, so a repeated string shows in the suffixes
that its copies chose; each sampled suffix stands for the run of windows that chose it.

Sorting. A suffix is read as tokens (64-bit hashes of stretches of its bytes). Spark draws splitters from a sample and
range-partitions the suffixes by their leading tokens, ties going on by document and place, so that one string however
frequent spreads over many buckets. A bucket is sorted by multikey quicksort and neighbours are compared; the first
and last strings of each bucket are compared across its boundaries.

Levels. Suffixes alone with their leading token hold no repeat. Those whose whole run of windows occurs again are
covered. The others (different runs behind one leading token: the edges of repeated passages) are cut into slices of
SLICE windows, whose leading token is what all windows of the slice share, and sorted again, then into single windows.
Runs that are equal go on as one. Nothing is capped: a level only ever leaves out what cannot repeat.

A text is null: empty. Matches never cross texts; of rows that repeat, each is a text of its own, and a null id is an
id like others. Strings are compared by 128 bits of hashes. Very long texts are sampled in overlapping pieces; a text
of one repeated byte samples every place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .common import mix

WIDTH = 200
LEAD = 64
SLICE = 12
#: Bytes that are sampled at a time.
PIECE = 1 << 20
#: Ranges that quicksort leaves to a plain sort.
SMALL = 1 << 12

KEYS = ["doc_id", "text_key"]
SUFFIXES = "doc_id long, text_key long, place long, a long, x long"
SORTED = "doc_id long, text_key long, place long, flags int, bucket int, edge array<long>"
CLASS, COVERED, MIXED, FIRST, IN_FIRST, IN_LAST, IN_FIRST_RUN, IN_LAST_RUN = (1 << i for i in range(8))

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64)] * 2


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse up to the n-th."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 20)
        for i, base in enumerate((_BASE, _INVERSE)):
            factors = np.full(size, np.uint64(base))
            factors[0] = 1
            _powers[i] = np.cumprod(factors, dtype=np.uint64)
    return _powers[0], _powers[1]


class Hashed:
    """Hashes of any stretch of `data`, equal for equal stretches."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def every(self, width: int) -> np.ndarray:
        count = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:-width]) * self.down[:count])

    def of(self, start: np.ndarray, stop: np.ndarray, also: np.ndarray | int = 0) -> np.ndarray:
        plain = (self.sums[stop] - self.sums[start]) * self.down[start]
        return mix(plain + mix((stop - start).astype(np.uint64) + (np.asarray(also, np.uint64) << np.uint64(32))))


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` neighbours the place of its least value, the leftmost of equals."""
    count = len(values) - width + 1
    rows = -(-len(values) // width)
    table = np.full(rows * width, np.uint64(2**64 - 1))
    table[: len(values)] = values
    table = table.reshape(rows, width)
    places = np.arange(rows * width, dtype=np.int32).reshape(rows, width)
    # A window is the end of one row and the beginning of the next.
    tail = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1]
    at_tail = np.where(table == tail, places, np.int32(2**31 - 1))
    at_tail = np.minimum.accumulate(at_tail[:, ::-1], axis=1)[:, ::-1].ravel()[:count]
    head = np.minimum.accumulate(table, axis=1)
    fresh = np.ones(table.shape, bool)
    fresh[:, 1:] = table[:, 1:] < head[:, :-1]
    at_head = np.maximum.accumulate(np.where(fresh, places, np.int32(-1)), axis=1).ravel()[width - 1 :][:count]
    tail, head = tail.ravel()[:count], head.ravel()[width - 1 :][:count]
    return np.where(tail <= head, at_tail, at_head)


def packed(place: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """A place and the least and most bytes by which its windows begin before it, as one long."""
    return place.astype(np.int64) << 16 | least.astype(np.int64) << 8 | most.astype(np.int64)


def _pieces(texts: list[bytes | None]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (row, first byte, bytes) of about PIECE bytes; neighbouring pieces share all but one byte of a window."""
    group, size = [], 0
    for row, text in enumerate(texts):
        for first in range(0, max(len(text or b"") - WIDTH + 1, 0), PIECE):
            piece = text[first : first + PIECE + WIDTH - 1]
            group.append((row, first, piece))
            size += len(piece)
            if size >= PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


def sampled(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, ...]]:
    """For the sampled suffixes of the texts: row, packed place, leading token, token of the run of windows."""
    for group in _pieces(texts):
        data = np.frombuffer(b"".join(piece for _, _, piece in group), np.uint8).astype(np.uint64)
        sizes = np.array([len(piece) for _, _, piece in group])
        starts = np.cumsum(sizes) - sizes
        hashed = Hashed(data)
        chosen = least_in_windows(hashed.every(LEAD), WIDTH - LEAD + 1)
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts] += 1
        inside[starts + sizes - WIDTH + 1] -= 1
        chosen = np.where(np.cumsum(inside[: len(chosen)], dtype=np.int8) > 0, chosen, np.int32(-1))
        first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        last = np.r_[first[1:], len(chosen)] - 1
        real = chosen[first] >= 0
        first, last, at = first[real], last[real], chosen[first[real]].astype(np.int64)
        piece = np.searchsorted(starts, first, side="right") - 1
        least, most = at - last, at - first
        rows = np.array([row for row, _, _ in group])[piece]
        places = at - starts[piece] + np.array([base for _, base, _ in group], np.int64)[piece]
        run = hashed.of(first, last + WIDTH, least << 8 | most)
        yield rows, packed(places, least, most), hashed.of(at, at + LEAD), run


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, places, lead, run in sampled(batch.column(2).cast(pa.large_binary()).to_pylist()):
            ids, keys = (batch.column(i).take(pa.array(rows)) for i in (0, 1))
            arrays = [ids, keys, pa.array(places), _signed(lead), _signed(run)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_key", "place", "a", "x"])


def multikey_quicksort(columns: list[np.ndarray]) -> np.ndarray:
    """The order of rows by the columns: split three ways around a pivot, the middle going on to the next column."""
    order = np.arange(len(columns[0]))
    todo = [(0, len(order), 0)]
    while todo:
        start, stop, depth = todo.pop()
        if depth == len(columns) or stop - start < 2:
            continue
        part = order[start:stop]
        if stop - start <= SMALL:
            order[start:stop] = part[np.lexsort([c[part] for c in columns[depth:][::-1]])]
            continue
        tokens = columns[depth][part]
        pivot = np.sort(tokens[:: len(tokens) // 31])[15]
        less, more = tokens < pivot, tokens > pivot
        order[start:stop] = np.concatenate([part[less], part[~(less | more)], part[more]])
        middle, end = start + np.count_nonzero(less), stop - np.count_nonzero(more)
        todo += [(start, middle, depth), (middle, end, depth + 1), (end, stop, depth)]
    return order


def _runs(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's run and the size of each run, from marks on the first rows."""
    number = np.cumsum(new) - 1
    return number, np.bincount(number)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorts one bucket and marks each suffix by its neighbours; one more row tells of the bucket's ends."""
    names = [column.partition(" ")[0] for column in SORTED.split(", ")]
    held = list(batches)
    if not sum(batch.num_rows for batch in held):
        return
    rows = pa.Table.from_batches(held).combine_chunks()
    bucket = TaskContext.get().partitionId()
    a, x = (rows[name].to_numpy() for name in ("a", "x"))
    order = multikey_quicksort([a, x])
    a, x = a[order], x[order]
    new_class = np.r_[True, a[1:] != a[:-1]]
    new_run = new_class | np.r_[True, x[1:] != x[:-1]]
    of, size = _runs(new_class)
    run, run_size = _runs(new_run)
    runs_of = np.bincount(of[new_run])
    flags = (
        (size[of] > 1) * CLASS + (run_size[run] > 1) * COVERED + (runs_of[of] > 1) * MIXED + new_run * FIRST
        + (of == 0) * IN_FIRST + (of == of[-1]) * IN_LAST + (run == 0) * IN_FIRST_RUN + (run == run[-1]) * IN_LAST_RUN
    )
    kept = np.flatnonzero(flags & (CLASS | IN_FIRST | IN_LAST))
    first_end, last_start = int(size[0]) - 1, len(a) - int(size[-1])
    edge = [int(v) for v in (a[0], x[0], x[first_end], a[-1], x[last_start], x[-1], len(size))]
    taken = rows.take(pa.array(order[kept]))
    table = pa.Table.from_arrays(
        [
            *(taken[name] for name in ("doc_id", "text_key", "place")),
            pa.array(flags[kept].astype(np.int32)),
            pa.array(np.full(len(kept), bucket, np.int32)),
            pa.nulls(len(kept), pa.list_(pa.int64())),
        ],
        names,
    )
    yield from table.to_batches()
    ends = [None, None, None, 0, bucket, edge]
    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(ends, table.schema.types)], names)


def _across(edges: list[tuple[int, list[int]]]) -> list[tuple[int, bool, bool, bool, bool, bool, bool]]:
    """For each bucket: whether its first and its last class, and its first and its last run, go on in a neighbour,
    and whether those classes hold different runs. Two classes a bucket, whatever its size."""
    edges = sorted(edges)
    chain, ends = [], []  # least and most run of each class that reaches a boundary; the classes of each bucket
    for i, (_, (a, x, first_most, last_a, last_least, last_x, classes)) in enumerate(edges):
        if i and edges[i - 1][1][3] == a:
            mine = ends[-1][1]
            chain[mine] = (min(chain[mine][0], x), max(chain[mine][1], first_most))
        else:
            mine = len(chain)
            chain.append((x, first_most))
        ends.append((mine, mine if classes == 1 else len(chain)))
        if classes > 1:
            chain.append((last_least, last_x))
    told = []
    for i, (bucket, (a, x, _, last_a, _, last_x, _)) in enumerate(edges):
        before, after = (edges[j][1] if 0 <= j < len(edges) else None for j in (i - 1, i + 1))
        class_before, class_after = before is not None and before[3] == a, after is not None and after[0] == last_a
        run_before, run_after = class_before and before[5] == x, class_after and after[1] == last_x
        mixed = [chain[k][0] != chain[k][1] for k in ends[i]]
        told.append((bucket, class_before, class_after, run_before, run_after, *mixed))
    return told


def compared(suffixes: DataFrame) -> DataFrame:
    """Sorts the suffixes (SUFFIXES); rows (doc_id, text_key, place, covered, goes_on) of those with company.

    covered: the whole run occurs elsewhere. goes_on: other runs begin alike, and of equal runs this row is the first.
    """
    spark = suffixes.sparkSession
    dealt = suffixes.repartitionByRange("a", "x", "doc_id", "text_key", "place")
    rows = materialize(dealt.mapInArrow(_compare, SORTED))
    edges = rows.filter("edge is not null").select("bucket", "edge").collect()  # one row per bucket
    table = spark.createDataFrame(
        _across([(row.bucket, list(row.edge)) for row in edges]),
        "at int, class_before boolean, class_after boolean, run_before boolean, run_after boolean, "
        "first_mixed boolean, last_mixed boolean",
    )
    met = rows.filter("edge is null").join(F.broadcast(table), F.col("bucket") == F.col("at"))

    def has(flag: int) -> Column:
        return F.col("flags").bitwiseAND(flag) != 0

    def also(flag: int, first: int, before: str, last: int, after: str) -> Column:
        return has(flag) | (has(first) & F.col(before)) | (has(last) & F.col(after))

    together = also(CLASS, IN_FIRST, "class_before", IN_LAST, "class_after")
    covered = also(COVERED, IN_FIRST_RUN, "run_before", IN_LAST_RUN, "run_after")
    mixed = also(MIXED, IN_FIRST, "first_mixed", IN_LAST, "last_mixed")
    first = has(FIRST) & ~(has(IN_FIRST_RUN) & F.col("run_before"))
    return met.filter(together).select(*KEYS, "place", covered.alias("covered"), (mixed & first).alias("goes_on"))


def _texts(documents: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = [squeeze(text) for text in batch.column(2).cast(pa.large_binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], [*KEYS, "text"])


def _with_places(texts: DataFrame, places: DataFrame, how: str) -> DataFrame:
    """The texts, compressed for the way, with the list of their places: once per distinct row, as long as its text."""
    lists = places.groupBy(F.col("doc_id").alias("id_"), F.col("text_key").alias("key_")).agg(
        F.collect_set("place").alias("places")
    )
    ways = texts.mapInArrow(_squeeze, "doc_id long, text_key long, text binary")
    same = F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("text_key") == F.col("key_"))
    # The same plan at every size: a list of places may be broadcast here and too large there.
    return ways.join(lists.hint("merge"), same, how).select(*KEYS, "text", "places")


def _unpacked(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return places >> 16, places >> 8 & 255, places & 255


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the run of windows of each place."""
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for row in range(batch.num_rows):
            text = expand(batch.column(2)[row].as_py())
            # Of a repeated text the same places are cut out again; that they are alone is judged by the first level.
            places = batch.column(3)[row].values.to_numpy()
            at, least, most = _unpacked(places)
            cut = [text[i:j] for i, j in zip((at - most).tolist(), (at - least + WIDTH).tolist())]
            one = pa.array(np.full(len(places), row))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(one), batch.column(1).take(one), pa.array(places), pa.array(cut, pa.binary())],
                [*KEYS, "place", "bytes"],
            )


def _slices(width: int):
    """Cuts runs of windows into slices of `width` windows, with the tokens of what their windows share and cover."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at, least, most = _unpacked(batch.column(2).to_numpy())
            low, high = (batch.column(i).to_numpy() for i in (4, 5))
            stretches = batch.column(3).cast(pa.large_binary()).to_pylist()
            data = np.frombuffer(b"".join(stretches), np.uint8).astype(np.uint64)
            origin = np.cumsum([0, *map(len, stretches[:-1])]) + most  # the place itself, in data
            counts = high // width - low // width + 1
            row = np.repeat(np.arange(len(at)), counts)
            slice_ = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + (low // width)[row]
            near, far = slice_ * width, slice_ * width + width - 1
            own_near, own_far = np.maximum(near, low[row]), np.minimum(far, high[row])
            hashed, origin = Hashed(data), origin[row]
            lead = hashed.of(origin - near, origin - far + WIDTH)
            run = hashed.of(origin - own_far, origin - own_near + WIDTH, own_near << 8 | own_far)
            one = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(one), batch.column(1).take(one), pa.array(packed(at[row], own_near, own_far)),
                    _signed(lead), _signed(run),
                ],
                ["doc_id", "text_key", "place", "a", "x"],
            )

    return cut


def _in_slices(regions: DataFrame, width: int) -> DataFrame:
    """`regions`: doc_id, text_key, place, bytes, low, high; the windows from low to high bytes before the place."""
    return regions.mapInArrow(_slices(width), SUFFIXES)


def repeated(texts: DataFrame) -> DataFrame:
    """Rows (doc_id, text_key, place): the windows of these places occur elsewhere, and no others do."""
    whole = compared(texts.mapInArrow(_sample, SUFFIXES))
    open_runs = whole.filter("goes_on").select(*KEYS, "place")
    regions = materialize(
        _with_places(texts, open_runs, "inner").mapInArrow(_cut_out, "doc_id long, text_key long, place long, bytes binary")
    )
    places = F.col("place")
    low, high = F.shiftright(places, 8).bitwiseAND(255), places.bitwiseAND(255)
    sliced = compared(_in_slices(regions.select("*", low.cast("long").alias("low"), high.cast("long").alias("high")), SLICE))
    wanted = sliced.filter("goes_on").select(
        F.col("doc_id").alias("id_"), F.col("text_key").alias("key_"), F.shiftright(places, 16).alias("at_"),
        low.cast("long").alias("low"), high.cast("long").alias("high"),
    )
    # One place may head two regions where a long text was sampled in pieces.
    same = (
        F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("text_key") == F.col("key_"))
        & (F.shiftright("place", 16) == F.col("at_"))
        & (F.col("low") >= F.shiftright("place", 8).bitwiseAND(255)) & (F.col("high") <= F.col("place").bitwiseAND(255))
    )
    met = regions.join(wanted.hint("merge"), same).select(*KEYS, "place", "bytes", "low", "high")
    single = compared(_in_slices(met, 1))
    found = [level.filter("covered").select(*KEYS, "place") for level in (whole, sliced, single)]
    return found[0].unionByName(found[1]).unionByName(found[2])


def spans_of(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches that the windows of the places cover."""
    at, least, most = _unpacked(places)
    start, stop = at - most, at - least + WIDTH
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    first = np.flatnonzero(np.r_[True, start[1:] > stop[:-1]]) if len(start) else np.empty(0, np.int64)
    return start[first], stop[np.r_[first[1:], len(start)] - 1] if len(start) else stop


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        sizes, removed, counts, kept = [], [], [], []
        for text, places in zip(batch.column(2), batch.column(3)):
            text = expand(text.as_py())
            starts, stops = spans_of(places.values.to_numpy() if places.is_valid else np.empty(0, np.int64))
            bounds = [0, *np.stack([starts, stops], axis=1).ravel().tolist(), len(text)]
            kept.append(b"".join(text[i:j] for i, j in zip(bounds[::2], bounds[1::2])))
            sizes.append(len(text))
            removed.append(int((stops - starts).sum()))
            counts.append(len(starts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(v, pa.int64()) for v in (sizes, removed, counts)), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def without_repeats(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept), one per document; kept: the remaining UTF-8 bytes."""
    texts = _texts(documents)
    met = _with_places(texts, repeated(texts), "left")
    return met.mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
