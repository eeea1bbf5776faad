"""Toxicity by non-negative positive-unlabelled learning: confirmed toxic examples against text nobody has judged.

The score is linear in the distinct words of a text (runs of letters, lower case) and their beginnings. It minimises the
corrected risk prior * E_toxic[loss(+)] + max(0, E_unlabelled[loss(-)] - prior * E_toxic[loss(-)]) with the logistic
loss; where the second part falls below zero, its gradient is followed back up. Rare features are held closer to zero, by
a penalty that grows with the square of their rarity, instead of being left out. The prior is the share of toxic ones among the labels of
the training folds. The examples are bounded samples of whole texts; scoring covers every text whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold

#: Texts that the classifier is fitted on, at most.
POSITIVES = 3000
UNLABELLED = 6000
#: A word or beginning counts if so many of the toxic examples have it.
LEAST_EXAMPLES = 3
#: Penalty on squared weights; that of a feature in less than this share of the toxic examples is larger.
PENALTY, USUAL_SHARE = 1e-3, 0.025
BEGINNINGS = (4, 5, 6, 7)
#: Words remembered by a task.
REMEMBERED = 500_000
FOLDS = 5
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def _feature(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))


def features(word: str) -> list[int]:
    """Hashes of a word and of its beginnings."""
    return [_feature(x) for x in (word, *(f"{word[:n]}-" for n in BEGINNINGS if len(word) >= n))]


def numbers(word: str, vocabulary: dict[int, int], plain: set[str]) -> bytes:
    """The 32-bit numbers of those of `features` that are in the vocabulary of `train`.

    Texts with a word have all its beginnings, so past a beginning in too few examples, neither longer ones nor the
    word are in enough. `plain` remembers the shortest beginnings that do not count.
    """
    start, found = word[: BEGINNINGS[0]], []
    if start in plain:
        return b""
    for n in BEGINNINGS:
        if len(word) < n:
            break
        begun = vocabulary.get(_feature(f"{word[:n]}-"))
        if begun is None:
            if not found:
                plain.add(start)
            return array("i", found).tobytes()
        found.append(begun)
    whole = vocabulary.get(_feature(word))
    return array("i", found if whole is None else [*found, whole]).tobytes()


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [{f for w in words(t.as_py() or "") for f in features(w)} for t in batch.column(1)]
        hashes = [np.fromiter(f, np.uint64, len(f)).view(np.int64) for f in found]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.list_(pa.int64()))], ["positive", "found"])


def _fit(sets: list[np.ndarray], positive: np.ndarray, prior: float, width: int) -> np.ndarray:
    """Weights, the last one for the constant, by gradient steps with momentum."""
    at, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    p, u = positive / max(positive.sum(), 1), (1 - positive) / max((1 - positive).sum(), 1)
    share = np.bincount(at, p[owner], width)
    penalty = PENALTY * np.maximum(1, USUAL_SHARE / np.maximum(share, 1e-9)) ** 2
    weights, speed = np.zeros(width + 1), np.zeros(width + 1)
    weights[-1] = -1.0
    for _ in range(600):
        z = np.bincount(owner, weights[at], len(sets)) + weights[-1]
        chance = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        negative = (u - prior * p) @ np.logaddexp(0, z)
        rise = (u - prior * p) * chance
        error = prior * p * (chance - 1) + rise if negative >= 0 else -rise
        slope = np.append(np.bincount(at, error[owner], width), error.sum())
        slope[:-1] += penalty * weights[:-1]
        speed = 0.9 * speed + slope
        weights -= 0.2 * speed
    return weights


def train(documents: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Sorted feature hashes, their weights and the constant; None without a toxic example.

    Labels are read in the training folds only; ids that are null or carry both labels are left out.
    """
    own = documents.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = labels.filter("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    marked = marked.filter(crc_fold(folds=FOLDS) != 0).groupBy("doc_id").agg(
        F.min("toxic").alias("toxic"), F.max("toxic").alias("most")
    )
    marked = marked.filter("toxic = most")
    toxic, judged = marked.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    if not toxic:
        return None
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = own.select("doc_id").distinct()
    examples = marked.filter("toxic = 1").join(ids, "doc_id", "left_semi").orderBy(*by_hash).limit(POSITIVES).select("doc_id")
    others = ids.filter(crc_fold(folds=FOLDS) != 0).orderBy(*by_hash).limit(UNLABELLED)
    chosen = examples.withColumn("positive", F.lit(1)).unionByName(others.withColumn("positive", F.lit(0)))
    # Bounded: at most POSITIVES + UNLABELLED rows.
    texts = own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "positive").agg(F.max("text").alias("text"))
    rows = texts.select("positive", "text").mapInArrow(_extract, "positive int, found array<long>").toArrow()
    positive = np.asarray(rows["positive"].to_numpy(), float)
    sets = [np.asarray(w.values, np.int64).view(np.uint64) for w in rows["found"]]
    if not positive.sum():
        return None
    vocabulary, seen = np.unique(np.concatenate([s for s, y in zip(sets, positive) if y]), return_counts=True)
    vocabulary = vocabulary[seen >= LEAST_EXAMPLES]
    numbered = [_at(vocabulary, s) for s in sets]
    weights = _fit(numbered, positive, toxic / judged, len(vocabulary))
    return vocabulary, weights[:-1], float(weights[-1])


def _at(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(vocabulary):
        return np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return at[vocabulary[at] == hashes]


def score(documents: DataFrame, model: tuple[np.ndarray, np.ndarray, float] | None) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per document; null texts count as empty.

    Without a model every score is 0. Rows without an id are not held out.
    """
    # Bounded by the words of POSITIVES texts that LEAST_EXAMPLES of them share.
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known, plain = shared.value, {}, set()
        vocabulary = {feature: n for n, feature in enumerate(model[0].tolist())} if model else {}
        weights, constant = (model[1], model[2]) if model else (np.empty(0), 0.0)
        for batch in batches:
            z = []
            for text in batch.column(1):
                if len(known) + len(plain) > REMEMBERED:
                    known.clear()
                    plain.clear()
                own = words(text.as_py() or "")
                for word in own:
                    if word not in known:
                        known[word] = numbers(word, vocabulary, plain)
                # Sorted, so that a text has the same sum wherever it is.
                found = np.unique(np.frombuffer(b"".join(map(known.__getitem__, own)), np.int32))
                z.append(sum(weights[found].tolist()) + constant)
            chance = 1 / (1 + np.exp(-np.clip(z, -30, 30))) if model else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chance, pa.float64())], ["doc_id", "score"])

    scored = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(apply, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(crc_fold(folds=FOLDS) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def judge(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return score(documents, train(documents, labels))
