"""Importance resampling towards a target distribution, its features read off by Aho-Corasick automata.

A dictionary holds the distinct words of a piece of text between delimiters; each word carries its CRC-32 and length
as payload. One scan of the automaton over the text emits the payloads in order. The CRC-32 of two neighbours joined
by a space follows from their payloads alone (a CRC is linear, so that of a prefix is moved on by the bytes after it),
so no pair of words is ever put together or hashed. Buckets are counted per task and summed by Spark; the table of
gains has one entry per bucket and travels with the tasks.

Null and empty texts have no words, no features and the weight 0. Rows that repeat count each time. A null id draws
as an empty one. Memory: a task holds one Arrow batch, the words of PIECE bytes of text or of one longer text, and the
payloads of one text.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Bytes of text whose distinct words make up one dictionary.
PIECE = 1 << 24

_SPACE = zlib.crc32(b" ")
_FOUR = tuple(np.uint32(8 * i) for i in range(4))
_WORD = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Lower-cases A-Z; what is no letter, digit or byte of a character beyond ASCII delimits.
_PLAIN = bytes(b if b in _WORD else (b | 0x20 if 0x41 <= b <= 0x5A else 0x20) for b in range(256))


def _tables(images: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit numbers, given by the images of the single bits, as one table per byte."""
    values = np.arange(256)
    tables = np.zeros((4, 256), np.uint32)
    for bit in range(32):
        tables[bit // 8] ^= np.where(values >> (bit % 8) & 1, images[bit], np.uint32(0)).astype(np.uint32)
    return tables


def _map(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = tables[..., 0, x & np.uint32(255)] if tables.ndim == 2 else None
    for byte in range(1, 4):
        out = out ^ tables[byte, (x >> _FOUR[byte]) & np.uint32(255)]
    return out


def _zero_byte() -> np.ndarray:
    """The images of single bits when one zero byte follows: CRCs of equally long texts differ as their registers do."""
    return np.array([zlib.crc32(b"\0", 1 << bit) ^ zlib.crc32(b"\0", 0) for bit in range(32)], np.uint32)


@lru_cache(maxsize=4096)
def moved_on(length: int) -> np.ndarray:
    """The tables that move a CRC-32 on by `length` bytes."""
    images = np.uint32(1) << np.arange(32, dtype=np.uint32)
    step = _zero_byte()
    while length:
        if length & 1:
            images = _map(_tables(step), images)
        step = _map(_tables(step), step)
        length >>= 1
    return _tables(images)


def pair_crcs(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of each word, a space and the next word, from the words' CRCs and lengths."""
    if len(crcs) < 2:
        return np.empty(0, np.uint32)
    left = _map(moved_on(1), crcs[:-1]) ^ np.uint32(_SPACE)
    kinds, kind = np.unique(lengths[1:], return_inverse=True)
    stacked = np.stack([moved_on(int(n)) for n in kinds])
    out = crcs[1:].copy()
    for byte in range(4):
        out ^= stacked[kind, byte, (left >> _FOUR[byte]) & np.uint32(255)]
    return out


def _dictionary(words: set[str]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for word in words:
        raw = word.encode("latin-1")
        automaton.add_word(f" {word} ", len(raw) << 32 | zlib.crc32(raw))
    if words:
        automaton.make_automaton()
    return automaton


def payloads(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """For each text its words' payloads in order: length << 32 | CRC-32."""
    at = 0
    while at < len(texts):
        lines, size = [], 0
        while at < len(texts) and (not lines or size + len(texts[at] or b"") <= PIECE):
            # One character per byte, so that all strings stay compact.
            lines.append(f" {(texts[at] or b'').translate(_PLAIN).decode('latin-1')} ")
            size += len(texts[at] or b"")
            at += 1
        words: set[str] = set()
        for line in lines:
            words.update(line.split(" "))
        words.discard("")
        automaton = _dictionary(words)
        for line in lines:
            found = [payload for _, payload in automaton.iter(line)] if words else []
            yield np.array(found, np.int64)


def buckets(words: np.ndarray) -> np.ndarray:
    """The bucket of each word and of each two neighbours, from the payloads of one text."""
    crcs = (words & 0xFFFFFFFF).astype(np.uint32)
    return np.concatenate([crcs, pair_crcs(crcs, words >> 32)]) % np.uint32(BUCKETS)


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes | None]:
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for words in payloads(_texts(batch, 0)):
            totals += np.bincount(buckets(words), minlength=BUCKETS)
    at = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(totals[at])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> list[int]:
    """How many features of all texts fall into each bucket; BUCKETS rows reach the driver."""
    counted = texts.select("text").mapInArrow(_count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = [0] * BUCKETS
    for bucket, n in counted.collect():
        counts[bucket] = n
    return counts


def gains(raw: list[int], target: list[int]) -> np.ndarray:
    """Thousands of the log ratio of the add-one shares of each bucket in target and raw text, rounded down."""
    all_raw, all_target = sum(raw) + BUCKETS, sum(target) + BUCKETS
    ratios = ((float(t + 1) * float(all_raw)) / (float(s + 1) * float(all_target)) for s, t in zip(raw, target))
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def weigh(documents: DataFrame, gain: np.ndarray) -> DataFrame:
    """Rows (doc_id, n_features, weight)."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, weights = [], []
            for words in payloads(_texts(batch, 1)):
                own = buckets(words)
                features.append(len(own))
                weights.append(int(gain[own].sum()) // len(own) if len(own) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(features, pa.int64()), pa.array(weights, pa.int64())],
                ["doc_id", "n_features", "weight"],
            )

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return documents.select(ids, "text").mapInArrow(apply, "doc_id long, n_features long, weight long")


def noise(seed: int = SEED) -> Column:
    """Thousands of a Gumbel draw that the id alone decides, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    chance = (drawn + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.ln(-F.ln(chance)))


def ranked(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Adds rank: 1, 2, 3 ... for the drawn share of the documents with enough words, by falling score and rising id.

    Scores are whole numbers of a bounded range (logarithms of counts in thousandths), so a count per score gives where
    each score's ranks begin; only rows of one score are ordered together, and the noise of the ids spreads them.
    `scored` should be a written table.
    """
    enough = F.col("n_features") >= 2 * least_words - 1
    counts = scored.filter(enough).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    rows = sorted(counts.collect(), reverse=True)
    drawn, before, places = percent * sum(n for _, n in rows) // 100, 0, []
    for score, n in rows:
        if before < drawn:
            places.append((score, before))
        before += n
    spark = scored.sparkSession
    # As many rows as there are scores, however many documents.
    first = F.broadcast(spark.createDataFrame(places, "place_score long, place_before long"))
    met = scored.filter(enough).join(first, F.col("score") == F.col("place_score"))
    within = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    placed = met.withColumn("rank", (F.col("place_before") + within).cast("long"))
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    low = places[-1][0] if places else None
    rest = scored.filter(~enough | (F.col("score") < low)) if places else scored
    columns = ["doc_id", "n_features", "weight", "score"]
    return placed.select(*columns, "rank").unionByName(rest.select(*columns, F.lit(None).cast("long").alias("rank")))


def draw(documents: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows (doc_id, n_features, weight, score, rank), one per document; rank is null for documents not drawn."""
    gain = gains(bucket_counts(documents), bucket_counts(target))
    scored = weigh(documents, gain).withColumn("score", F.col("weight") + noise())
    return ranked(materialize(scored), percent)
