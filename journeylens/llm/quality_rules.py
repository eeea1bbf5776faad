"""Quality rules: plain counts of each text, and a calibrated n-gram classifier trained on labelled documents.

The classifier is a logistic regression over the relative frequencies of hashed word 1- and 2-grams and character 2-
and 3-grams. It is fitted on at most SAMPLE labelled documents of each class (those of the smallest id hashes), and
its scores are turned into probabilities on a part of them that it was not fitted on, weighted to the shares of the
classes among all labels. Every text is read whole, in Arrow batches, against fixed thresholds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, mix, window_hashes, word_hashes

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: A document goes if it is over four times likelier to be poor than good.
KEEP_FROM = 0.2
#: Rows that are filtered at a time.
ROWS = 256
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Labelled documents of each class that the classifier is fitted on, at most.
SAMPLE = 1000
#: Weights of each of the two families of n-grams.
BUCKETS = 1 << 14
#: Characters of a long text whose n-grams are held at a time.
CHARACTERS = 1 << 20
_SCALE = 100.0
_SPACE_BYTES, _SYMBOL_BYTES = SPACE.encode(), SYMBOLS.encode()


def counts(text: str, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode("utf-8", "replace")
    word_chars = len(text) - (len(raw) - len(raw.translate(None, _SPACE_BYTES)))
    symbols = len(raw) - len(raw.translate(None, _SYMBOL_BYTES))
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    repeated = 0
    windows = window_hashes(hashes, WINDOW)
    if len(windows) > 1:
        order = np.argsort(windows)
        same = windows[order][1:] == windows[order][:-1]
        if same.any():
            twice = np.zeros(len(windows), np.int8)
            twice[order[1:][same]] = 1
            twice[order[:-1][same]] = 1
            change = np.zeros(len(words) + 1, np.int64)
            change[: len(windows)] += twice
            change[WINDOW : WINDOW + len(windows)] -= twice
            repeated = int((np.cumsum(change) > 0).sum())
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated


def character_buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of all character 2- and 3-grams, a stretch of the text at a time."""
    for start in range(0, max(len(text) - 1, 0), CHARACTERS):
        part = text[start : start + CHARACTERS + 2].encode("utf-32-le", "replace")
        codes = np.frombuffer(part, np.uint32).astype(np.uint64)
        for width in (2, 3):
            grams = window_hashes(codes, width)[:CHARACTERS]
            yield (grams % np.uint64(BUCKETS)).astype(np.int64)


def word_buckets(hashes: np.ndarray) -> np.ndarray:
    pairs = window_hashes(hashes, 2)
    if len(pairs):
        pairs[hashes[1:] == hashes[:-1]] = np.uint64(1)  # a word twice in a row, whichever it is
    return (np.concatenate([mix(hashes), pairs]) % np.uint64(BUCKETS)).astype(np.int64)


def _features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scaled relative frequencies of the n-grams of a text; characters' numbers follow the words'."""
    words = np.bincount(word_buckets(word_hashes(text.encode("utf-8", "replace").split())), minlength=BUCKETS)
    characters = sum((np.bincount(b, minlength=BUCKETS) for b in character_buckets(text)), np.zeros(BUCKETS))
    both = np.concatenate([_SCALE * words / max(words.sum(), 1), _SCALE * characters / max(characters.sum(), 1)])
    at = np.flatnonzero(both)
    return at, both[at]


def labelled_sample(labels: DataFrame, label: str, documents: DataFrame, limit: int) -> DataFrame:
    """(doc_id, label, text) of at most `limit` documents of each of the labels 0 and 1, those of the smallest id hashes.

    Ids that are null or carry both labels are left out; of several texts of an id the last in order is taken.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    marked = marked.filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(
        F.min("label").alias("label"), F.max("label").alias("most")
    )
    marked = marked.filter("label = most").select("doc_id", "label")
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = documents.select("doc_id").distinct()
    marked = marked.join(ids, "doc_id", "left_semi")
    chosen = marked.filter("label = 0").orderBy(*by_hash).limit(limit).unionByName(
        marked.filter("label = 1").orderBy(*by_hash).limit(limit)
    )
    # Broadcast: at most 2 * limit rows.
    joined = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return joined.groupBy("doc_id", "label").agg(F.max("text").alias("text"))


def _fit(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray) -> np.ndarray:
    """Weights, the last one for the constant, by gradient steps with momentum on the mean log loss of both classes."""
    width = 2 * BUCKETS
    at = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    weights, speed = np.zeros(width + 1), np.zeros(width + 1)
    share = np.where(target == 1, 0.5 / max(target.sum(), 1), 0.5 / max((1 - target).sum(), 1))
    rate = 4 / (1 + np.bincount(owner, value**2, len(rows)).mean())
    for _ in range(300):
        z = np.bincount(owner, weights[at] * value, len(rows)) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * share
        slope = np.append(np.bincount(at, error[owner] * value, width), error.sum()) + 1e-4 * weights
        speed = 0.9 * speed + slope
        weights -= 0.1 * rate * speed
    return weights


def calibrate(z: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the probability of label 1 given a score (Platt), by weighted Newton steps."""
    slope, shift = 1.0, 0.0
    weight = weight / weight.sum()
    n1, n0 = max(target.sum(), 1), max((1 - target).sum(), 1)
    goal = np.where(target == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * z + shift, -30, 30)))
        error, bend = weight * (p - goal), weight * p * (1 - p) + 1e-9
        hessian = np.array([[(bend * z * z).sum() + 1e-4, (bend * z).sum()], [(bend * z).sum(), bend.sum() + 1e-4]])
        step = np.clip(np.linalg.solve(hessian, [(error * z).sum(), error.sum()]), -0.5, 0.5)
        slope, shift = slope - step[0], shift - step[1]
    return float(slope), float(shift)


def train(documents: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[np.ndarray, float, float] | None:
    """Weights and calibration of label 1; None without documents of both labels."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at, value = _features(batch.column(2)[i].as_py() or "")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, 1),
                        batch.column(1).slice(i, 1),
                        pa.array([at.astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([value.astype(np.float32)], pa.list_(pa.float32())),
                    ],
                    ["doc_id", "label", "at", "value"],
                )

    sample = labelled_sample(labels, label, documents, SAMPLE)
    # Bounded: at most 2 * SAMPLE rows.
    found = sample.mapInArrow(extract, "doc_id long, label int, at array<int>, value array<float>").toArrow()
    found = found.sort_by("doc_id")
    target = np.asarray(found.column("label").to_numpy(), float)
    rows = [(np.asarray(a.values, np.int64), np.asarray(v.values, float)) for a, v in zip(found["at"], found["value"])]
    if len(set(target)) < 2:
        return None
    # Every third document of each class is kept back for the calibration.
    back = np.zeros(len(rows), bool)
    for c in (0, 1):
        back[np.flatnonzero(target == c)[2::3]] = True
    weights = _fit([r for r, b in zip(rows, back) if not b], target[~back])
    if not back.any() or len(set(target[back])) < 2:
        back[:] = True
    z = np.array([weights[r[0]] @ r[1] + weights[-1] for r, b in zip(rows, back) if b])
    of_all = {
        r.label: r.n
        for r in labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n")).collect()
    }
    held = target[back]
    weight = np.where(held == 1, of_all[1] / (held == 1).sum(), of_all[0] / (held == 0).sum())
    return weights, *calibrate(z, held, weight / weight.mean())


def rate(texts: Iterable[str | None], fitted: tuple[np.ndarray, float, float] | None) -> list[tuple]:
    """The counts of the base rules and the probability of label 1, for each text."""
    rows = []
    for text in texts:
        text = text or ""
        words = text.encode("utf-8", "replace").split()
        hashes = word_hashes(words)
        chance = None
        if fitted:
            weights, slope, shift = fitted
            z = weights[-1]
            if len(hashes):
                z += _SCALE * weights[word_buckets(hashes)].mean()
            total = grams = 0
            for buckets in character_buckets(text):
                total += weights[BUCKETS + buckets].sum()
                grams += len(buckets)
            z += _SCALE * total / max(grams, 1)
            chance = 1 / (1 + np.exp(-np.clip(slope * z + shift, -30, 30)))
        rows.append((*counts(text, words, hashes), chance))
    return rows


def score(documents: DataFrame, model: tuple[np.ndarray, float, float] | None) -> DataFrame:
    """Rows (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, probability), one per document.

    Null texts count as empty; the probability is null without a model.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # 2 * BUCKETS + 3 numbers
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "probability"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*rate((t.as_py() for t in batch.column(1)), shared.value))) or [()] * 6
            kinds = [pa.int64()] * 5 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names
            )

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names[1:6]) + ", probability double"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(apply, schema)


def keep(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of documents that `judge` keeps, all columns, filtered in place: no text is shuffled."""
    shared = documents.sparkSession.sparkContext.broadcast(train(documents.select("doc_id", "text"), labels))
    at = documents.columns.index("text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                rated = rate((t.as_py() for t in part.column(at)), shared.value)
                kept = [
                    n >= MIN_WORDS and 100 * repeated <= MAX_REPEATED_PERCENT * n and (chance is None or chance >= KEEP_FROM)
                    for n, _, _, _, repeated, chance in rated
                ]
                yield part.filter(pa.array(kept, pa.bool_()))

    return documents.mapInArrow(apply, documents.schema)


def judge(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`score` with base_failed (too few words, or too many that repeat) and kept (neither that nor judged poor).

    Without labels of both kinds the rules alone decide.
    """
    scored = score(documents, train(documents, labels))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    good = F.coalesce(F.col("probability") >= KEEP_FROM, F.lit(True))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & good)
