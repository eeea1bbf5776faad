"""Quality classifier by importance resampling: how much likelier a text is under target text than under raw text.

Both models are bags of hashed n-grams (word 1- and 2-grams, an immediate repetition of a word being one n-gram of its
own, and character 2- and 3-grams) with add-one smoothing: the target from all documents labelled good, the raw one
from all documents. A document's log weight is the sum of the log ratios of its n-grams. The documents of the k
largest sums of log weight and Gumbel noise are a sample without replacement in proportion to the weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .common import mix, window_hashes, word_hashes

BUCKETS = 1 << 16
SEED = 20240131
#: Standard errors by which the share to keep lies above the share of good labels, so that good documents stay.
MARGIN = 1.0
#: Documents labelled good that the target model is counted from at most, those of the smallest hashes of their ids.
TARGET_DOCUMENTS = 20_000
CHARACTERS = 1 << 20
#: Rows that are filtered at a time.
ROWS = 256
_REPEAT = np.uint64(1)


def buckets(text: str) -> Iterator[np.ndarray]:
    words = word_hashes(text.encode("utf-8", "replace").split())
    pairs = window_hashes(words, 2)
    if len(pairs):
        pairs[words[1:] == words[:-1]] = _REPEAT
    yield (np.concatenate([mix(words), pairs]) % np.uint64(BUCKETS)).astype(np.int64)
    for start in range(0, max(len(text) - 1, 0), CHARACTERS):
        part = text[start : start + CHARACTERS + 2].encode("utf-32-le", "replace")
        codes = np.frombuffer(part, np.uint32).astype(np.uint64)
        for width in (2, 3):
            yield (window_hashes(codes, width)[:CHARACTERS] % np.uint64(BUCKETS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for good, text in zip(batch.column(0), batch.column(1)):
            for part in buckets(text.as_py() or ""):
                found = np.bincount(part, minlength=BUCKETS) if len(part) > BUCKETS // 8 else None
                for row in (0, 1) if good.as_py() else (1,):
                    if found is None:
                        np.add.at(totals[row], part, 1)
                    else:
                        totals[row] += found
    at = np.flatnonzero(totals[1])
    yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(t[at]) for t in totals)], ["bucket", "target", "raw"])


def good_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled good and never poor."""
    marked = labels.filter("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return marked.agg(F.min("quality").alias("good"))


def log_ratios(documents: DataFrame, labels: DataFrame) -> np.ndarray | None:
    """The log ratio of each bucket; None if no document is labelled good."""
    taken = good_ids(labels).filter("good = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TARGET_DOCUMENTS)
    # Bounded by TARGET_DOCUMENTS, so texts need not move.
    marked = documents.select("doc_id", "text").join(F.broadcast(taken), "doc_id", "left")
    counted = marked.select((F.coalesce("good", F.lit(0)) == 1).alias("good"), "text").mapInArrow(
        _count, "bucket long, target long, raw long"
    )
    # Bounded: one row per bucket.
    rows = counted.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toArrow()
    target, raw = np.ones(BUCKETS), np.ones(BUCKETS)
    target[rows["bucket"].to_numpy()] += rows["target"].to_numpy()
    raw[rows["bucket"].to_numpy()] += rows["raw"].to_numpy()
    if target.sum() == BUCKETS:
        return None
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def keys(ids: pa.Array, texts: pa.Array, ratio: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log weight, key and rank key of each text: the key is weight plus noise, rank_key orders keys as longs."""
    weight = np.array([0.0 if ratio is None else sum(ratio[b].sum() for b in buckets(t.as_py() or "")) for t in texts], float)
    drawn = ids.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).view(np.uint64)
    chance = ((mix(drawn + np.uint64(SEED)) >> np.uint64(11)).astype(float) + 0.5) / 2.0**53
    key = weight - np.log(-np.log(chance))
    bits = (key + 0.0).view(np.int64)
    return weight, key, np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def weigh(documents: DataFrame, ratios: np.ndarray | None) -> DataFrame:
    """Rows (doc_id, log_weight, gumbel_key, rank_key), see `keys`."""
    shared = documents.sparkSession.sparkContext.broadcast(ratios)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = keys(batch.column(0), batch.column(1), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, found)], ["doc_id", "log_weight", "gumbel_key", "rank_key"]
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        apply, "doc_id long, log_weight double, gumbel_key double, rank_key long"
    )


def kth_largest(rows: DataFrame, column: str, k: int) -> tuple[int, int]:
    """The k-th largest long of a written column, and how many are larger: four counts of 16 bits each."""
    low, above, value = -(1 << 63), 0, F.col(column)
    for shift in (48, 32, 16, 0):
        part = F.shiftright(value, shift) - (low >> shift)
        inside = rows if shift == 48 else rows.filter(value.between(low, low + (1 << (shift + 16)) - 1))
        for digit, n in sorted(inside.groupBy(part.alias("d")).count().collect(), reverse=True):
            if above + n >= k:
                low += digit << shift
                break
            above += n
    return low, above


def _cut(
    documents: DataFrame, labels: DataFrame, share: float | None, raw: DataFrame | None
) -> tuple[np.ndarray | None, DataFrame, tuple[int, int] | None, bool]:
    """The log ratios, the weighed documents, and the last kept (rank key, -1 - id); without those, whether all stay."""
    ratios = log_ratios(documents if raw is None else raw, labels)
    weighed = materialize(weigh(documents, ratios))
    total = weighed.count()
    if share is None:
        mine = good_ids(labels).join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
        good, n = mine.agg(F.coalesce(F.sum("good"), F.lit(0)), F.count(F.lit(1))).first()
        p = (good + 1) / (n + 2)
        share = min(1.0, p + MARGIN * (p * (1 - p) / (n + 2)) ** 0.5) if n else 1.0
    k = min(total, -int(-(share * total) // 1))
    if k == total or k <= 0:
        return ratios, weighed, None, k == total
    cut, above = kth_largest(weighed, "rank_key", k)
    ties = weighed.filter(F.col("rank_key") == cut).select((-1 - F.coalesce("doc_id", F.lit(-1))).alias("back"))
    last, _ = kth_largest(ties, "back", k - above)
    return ratios, weighed, (cut, last), False


def resample(documents: DataFrame, labels: DataFrame, share: float | None = None, raw: DataFrame | None = None) -> DataFrame:
    """Rows (doc_id, log_weight, gumbel_key, kept), one per document; k is the share of the documents, rounded up.

    Without a share, it is that of good ones among the labels of these documents, and MARGIN standard error more. Equal
    keys go by the smaller id; repeated rows of one key and id are kept or go together. All are kept without labels.
    The models are counted over `raw` (doc_id, text) where documents are only what an earlier filter left of it: without
    the rejected text target and raw hardly differ, and the weights would be noise.
    """
    _, weighed, least, every = _cut(documents, labels, share, raw)
    kept = F.lit(every)
    if least:
        on_edge = (F.col("rank_key") == least[0]) & ((-1 - F.coalesce("doc_id", F.lit(-1))) >= least[1])
        kept = (F.col("rank_key") > least[0]) | on_edge
    return weighed.select("doc_id", "log_weight", "gumbel_key", kept.alias("kept"))


def keep(documents: DataFrame, labels: DataFrame, share: float | None = None, raw: DataFrame | None = None) -> DataFrame:
    """The rows of documents that `resample` keeps, all columns, weighed again and filtered in place."""
    ratios, _, least, every = _cut(documents.select("doc_id", "text"), labels, share, raw)
    if least is None:
        return documents if every else documents.limit(0)
    shared = documents.sparkSession.sparkContext.broadcast(ratios)
    at, id_at = documents.columns.index("text"), documents.columns.index("doc_id")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                _, _, rank = keys(part.column(id_at), part.column(at), shared.value)
                back = -1 - part.column(id_at).cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
                yield part.filter(pa.array((rank > least[0]) | ((rank == least[0]) & (back >= least[1]))))

    return documents.mapInArrow(apply, documents.schema)
