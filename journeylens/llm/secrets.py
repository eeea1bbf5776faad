"""Secret scans by DataFrame functions alone: exact patterns, and character Markov models of random and ordinary strings.

Base kinds are assignments, access keys and long hexadecimal runs. Further candidates are runs of LEAST or more
letters, digits and +/_=- . Two first-order Markov models over characters, one of random strings and one of ordinary
identifiers, give each candidate a log-likelihood ratio; those of enough of it that meet no base span are of kind `random`.

The models are counted from labelled samples: ordinary identifiers are the words of the documents of a bounded sample
(SAMPLE documents of the smallest id hashes) that no base kind covers, random strings are the values of its base spans,
and, so that other alphabets than theirs are known, base64 digests of the sample's ids.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

KINDS = ("assign", "access", "hex")
RANDOM = "random"
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
LEAST = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
#: Documents that the models are counted from, at most, and the shortest word that is an identifier.
SAMPLE = 4000
LEAST_WORD = 6
#: How many observations the frequency of the second character alone is worth.
LEAN = 10.0
#: Bits of evidence a character from which on a candidate is random.
PER_CHARACTER = 0.5
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as (start, end, value), in code points.

    The pieces between the matches give their places; texts without a match are read once.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    lengths = F.zip_with(pieces, whole, lambda p, m: F.struct(F.char_length(p).alias("gap"), F.char_length(m).alias("own")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("places"))

    def step(seen: Column, x: Column) -> Column:
        begin = seen["at"] + x["gap"]
        end = begin + F.coalesce(x["own"], F.lit(0))
        place = F.struct(begin.alias("start"), end.alias("end"))
        return F.struct(
            end.alias("at"),
            F.when(x["own"].isNull(), seen["places"]).otherwise(F.concat(seen["places"], F.array(place))).alias("places"),
        )

    places = F.aggregate(lengths, start, step, lambda seen: seen["places"])
    values = F.transform(whole, lambda m: F.regexp_extract(m, pattern, group)) if group else whole
    found = F.zip_with(places, values, lambda p, v: F.struct(p["start"].alias("start"), p["end"].alias("end"), v.alias("value")))
    kind = "array<struct<start:int,end:int,value:string>>"
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(kind))


def base(documents: DataFrame) -> DataFrame:
    """documents with the arrays assign, access and hex of (start, end, value)."""
    text = F.col("text")
    return documents.withColumns(
        {
            "assign": F.filter(matches(text, ASSIGN, 1), lambda x: F.char_length(x["value"]) >= 6),
            "access": F.filter(matches(text, ACCESS), lambda x: F.char_length(x["value"]) >= 20),
            "hex": matches(text, HEX),
        }
    )


def pairs_of(value: Column) -> Column:
    """Numbers of the pairs of neighbouring characters; what the alphabet lacks counts as one more character."""
    size = len(ALPHABET) + 1

    def place(i: Column) -> Column:
        return F.instr(F.lit(ALPHABET), F.substr(value, i, F.lit(1)))

    numbers = F.transform(F.sequence(F.lit(1), F.char_length(value) - 1), lambda i: place(i) * size + place(i + 1))
    return F.when(F.char_length(value) > 1, numbers).otherwise(F.array().cast("array<int>"))


def train(documents: DataFrame) -> list[float]:
    """Bits of evidence for a random string by pair of characters, from the labelled samples."""
    ids = documents.filter("doc_id is not null").select("doc_id").distinct()
    # Broadcast: at most SAMPLE rows.
    sample = F.broadcast(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))
    found = base(documents.select("doc_id", text_or_empty().alias("text")).join(sample, "doc_id"))
    values = F.transform(F.concat("assign", "access", "hex"), lambda x: x["value"])
    digest = F.rtrim(F.base64(F.unhex(F.sha2(F.col("doc_id").cast("string"), 256))), F.lit("="))
    rest = F.regexp_replace("text", f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    words = F.regexp_extract_all(rest, F.lit(rf"[A-Za-z_][A-Za-z0-9_]{{{LEAST_WORD - 1},}}"), F.lit(0))
    random = found.select(F.explode(F.array_append(values, digest)).alias("value"), F.lit(1).alias("random"))
    ordinary = found.select(F.explode(words).alias("value"), F.lit(0).alias("random"))
    labelled = random.unionByName(ordinary).distinct()
    counted = labelled.select("random", F.explode(pairs_of(F.col("value"))).alias("pair")).groupBy("random", "pair").count()
    size = len(ALPHABET) + 1
    counts = [[0] * (size * size) for _ in range(2)]
    for row in counted.collect():  # bounded by the pairs of characters
        counts[row["random"]][row["pair"]] += row["count"]
    random_model, ordinary_model = (_log_chances(own, size) for own in counts)
    return [x - y for x, y in zip(random_model, ordinary_model)]


def _log_chances(counts: list[int], size: int) -> list[float]:
    """Bits of each character after each other one; rare first characters lean on how frequent the second is at all."""
    rows = [counts[i * size : (i + 1) * size] for i in range(size)]
    total = sum(counts)
    second = [(sum(row[j] for row in rows) + 1) / (total + size) for j in range(size)]
    return [
        math.log2((row[j] + LEAN * second[j]) / (sum(row) + LEAN)) for row in rows for j in range(size)
    ]


def evidence(value: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of random against ordinary, in bits."""
    table = F.lit(model)
    return F.aggregate(pairs_of(value), F.lit(0.0), lambda total, pair: total + F.get(table, pair))


def find(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, spans array<struct<start, no, end, kind>>), one per document, by start, then kind.

    Places are in code points, end exclusive; no is the kind's place in KINDS, random comes last. Null texts count as
    empty and have none. Repeated rows each keep their own spans.
    """
    model = train(documents)
    own = base(documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")))
    span = "array<struct<start:int,no:int,end:int,kind:string>>"

    def named(column: Column, no: int, kind: str) -> Column:
        make = lambda x: F.struct(x["start"], F.lit(no).alias("no"), x["end"], F.lit(kind).alias("kind"))
        return F.transform(column, make).cast(span)

    known = F.concat(*(named(F.col(kind), no, kind) for no, kind in enumerate(KINDS)))
    with_known = own.withColumn("known", known).withColumn("long", matches(F.col("text"), CANDIDATE))
    apart = F.filter(
        "long", lambda x: ~F.exists("known", lambda k: (k["start"] < x["end"]) & (x["start"] < k["end"]))
    )
    likely = F.filter(
        apart, lambda x: evidence(x["value"], model) >= PER_CHARACTER * (F.char_length(x["value"]) - 1)
    )
    return with_known.select(
        "doc_id", F.array_sort(F.concat("known", named(likely, len(KINDS), RANDOM))).alias("spans")
    )
