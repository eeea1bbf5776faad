"""What the operators share: reading tables, plain words, seeded mixing of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that ends a word, as bytes and as characters.
SPACE = " \t\n\v\f\r"

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table; further columns are never read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def mix(hashes: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (finaliser of splitmix64)."""
    hashes = (hashes ^ (hashes >> np.uint64(30))) * _MIX_1
    hashes = (hashes ^ (hashes >> np.uint64(27))) * _MIX_2
    return hashes ^ (hashes >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One 64-bit hash per word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of `width` neighbours; none if there are fewer."""
    count = len(words) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    rolled = words[:count].copy()
    for i in range(1, width):
        rolled = rolled * _GOLDEN + words[i : i + count]
    return mix(rolled)


def crc_fold(column: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of an id's text, modulo `folds`."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds
