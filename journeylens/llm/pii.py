"""Personal data: exact patterns, and contextual extraction bootstrapped from what they find.

Base entities are e-mail addresses, IPv4 addresses, card and phone numbers. They are the seeds of a pattern-instance
graph over all documents: an instance is an identifier-like token (four digits or more) or a base entity, a pattern is
the pair of words before it. Seeds score 1; any other instance scores, in a pattern, the best confidence it has from
other accepted patterns, so no pattern vouches for itself. A pattern's confidence is the mean score of its different
instances, its support their sum; with enough of both it is accepted, and its instances count in further patterns. Joins
and aggregations of the edge table repeat this until nothing changes. Tokens that no base kind covers and that stand in
an accepted pattern are further spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .common import SPACE, text_or_empty

KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"
#: A pattern is supported by so many different seeds, or by instances whose scores sum to it, and found confident from
#: this mean score on.
MIN_SEEDS = 3
MIN_CONFIDENCE = 0.6
#: Growth of the summed confidences below which a round has changed nothing.
SETTLED = 1e-3
#: Digits and characters of an identifier-like token, and how far back its pattern may reach.
MIN_DIGITS, MAX_LENGTH, REACH = 4, 80, 120
ROWS = 256

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A match that starts inside a run of digits would also start at the run's first one, so only those are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_SIGNS = "\"'`.,;:!?()[]{}<>#*$%&|="
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_SEED = pa.struct([("pattern", pa.string()), ("instance", pa.string())])
_OTHER = pa.struct([("pattern", pa.string()), ("instance", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ back over the local part, then on over the domain: linear, however long the runs are."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def luhn(digits: str) -> bool:
    doubled = (int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits)))
    return sum(n - 9 if n > 9 else n for n in doubled) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base entities, by kind, then start."""
    spans = [("email", start, end) for start, end in _emails(text)]
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in (x.lstrip("0") for x in m[0].split("."))):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 2 * 19:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGIT.findall(m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def pattern_before(text: str, start: int) -> str | None:
    """The two words before a position, lower case."""
    words = text[max(0, start - REACH) : start].split()
    return " ".join(words[-2:]).lower() if words else None


def other_tokens(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Identifier-like tokens that meet no base span, without signs at their ends."""
    reach = 0
    for hint in _DIGIT.finditer(text):
        if hint.start() < reach:
            continue
        start = hint.start()
        while start > reach and text[start - 1] not in SPACE:
            start -= 1
        reach = _TOKEN.match(text, hint.start()).end()
        if reach - start > 2 * MAX_LENGTH:
            continue
        body = text[start:reach].rstrip(_SIGNS)
        first, last = start + len(body) - len(body.lstrip(_SIGNS)), start + len(body)
        if last - first <= MAX_LENGTH and len(_DIGIT.findall(text, first, last)) >= MIN_DIGITS:
            if not any(first < end and begin < last for _, begin, end in spans):
                yield first, last


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            spans, seeds, others = [], [], []
            for value in part.column(2):
                text = value.as_py() or ""
                own = base_spans(text)
                found = [(pattern_before(text, s), text[s:e].lower()) for _, s, e in own]
                more = [(pattern_before(text, s), text[s:e].lower(), s, e) for s, e in other_tokens(text, own)]
                spans.append([dict(zip(("kind", "start", "end"), x)) for x in own])
                seeds.append([{"pattern": p, "instance": i} for p, i in found if p])
                others.append([dict(zip(("pattern", "instance", "start", "end"), x)) for x in more if x[0]])
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:2], *(pa.array(v, pa.list_(k)) for v, k in ((spans, _SPAN), (seeds, _SEED), (others, _OTHER)))],
                ["doc_id", "text_key", "spans", "seeds", "others"],
            )


def scan(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, text_key, spans, seeds, others), one per document: base spans, and edges of the graph."""
    return documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        _scan,
        "doc_id long, text_key long, spans array<struct<kind:string,start:long,end:long>>, "
        "seeds array<struct<pattern:string,instance:string>>, "
        "others array<struct<pattern:string,instance:string,start:long,end:long>>",
    )


def confident_patterns(scanned: DataFrame) -> DataFrame:
    """Rows (pattern, confidence) of the supported patterns that reach MIN_CONFIDENCE.

    Scores only grow from round to round, so the accepted patterns do too, and the rounds end.
    """
    seeds = scanned.select(F.inline("seeds")).withColumn("seed", F.lit(1))
    others = scanned.select(F.inline("others")).select("pattern", "instance", F.lit(0).alias("seed"))
    edges = materialize(seeds.unionByName(others).groupBy("pattern", "instance").agg(F.max("seed").alias("seed")))
    scored = edges.withColumn("score", F.col("seed").cast("double"))
    before = (0, 0.0)
    while True:
        rated = scored.groupBy("pattern").agg(F.avg("score").alias("confidence"), F.sum("score").alias("support"))
        enough = (F.col("support") >= MIN_SEEDS) & (F.col("confidence") >= MIN_CONFIDENCE)
        patterns = materialize(rated.filter(enough).select("pattern", "confidence"))
        count, total = patterns.agg(F.count(F.lit(1)), F.coalesce(F.sum("confidence"), F.lit(0.0))).first()
        if count == before[0] and total - before[1] < SETTLED:
            return patterns
        before = (count, total)
        held = materialize(edges.filter("seed = 0").join(patterns, "pattern").select("instance", "pattern", "confidence"))
        best = materialize(held.groupBy("instance").agg(F.max(F.struct("confidence", "pattern")).alias("best")))
        second = (
            held.join(best, "instance").filter(F.col("pattern") != F.col("best.pattern"))
            .groupBy("instance").agg(F.max("confidence").alias("second"))
        )
        ranked = materialize(best.join(second, "instance", "left"))
        elsewhere = F.when(F.col("best.pattern") == F.col("pattern"), F.col("second")).otherwise(F.col("best.confidence"))
        scored = materialize(
            edges.join(ranked, "instance", "left").select(
                "pattern", "instance", F.when(F.col("seed") == 1, 1.0).otherwise(F.coalesce(elsewhere, F.lit(0.0))).alias("score")
            )
        )


def further_spans(scanned: DataFrame, patterns: DataFrame) -> DataFrame:
    """Rows (doc_id, text_key, more) of documents with tokens in the patterns: their places, in order."""
    tokens = scanned.select("doc_id", "text_key", F.inline("others")).join(patterns, "pattern")
    place = F.struct(F.lit(CONTEXT).alias("kind"), "start", "end")
    return tokens.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(place)).alias("more"))


def _same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def find(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, spans), one per document (doc_id, text): base spans by kind and start, then those from contexts.

    A span is (kind, start, end) in code points, end exclusive. Null texts count as empty and have none; rows that repeat
    an id keep their own spans.
    """
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    scanned = materialize(scan(own))
    more = materialize(further_spans(scanned, confident_patterns(scanned)))
    both = scanned.join(more, _same_row(scanned, more), "left")
    return both.select(
        scanned["doc_id"], F.when(F.col("more").isNull(), F.col("spans")).otherwise(F.concat("spans", "more")).alias("spans")
    )


def covered(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each stretch of spans replaced by the kind of its first one, in brackets."""
    out, last, name = [], 0, None
    begun = ended = 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if name is None or start >= ended:
            if name:
                out += [text[last:begun], f"[{name.upper()}]"]
                last = ended
            name, begun, ended = kind, start, end
        ended = max(ended, end)
    if name:
        out += [text[last:begun], f"[{name.upper()}]"]
        last = ended
    return "".join(out) + text[last:]


def redact(documents: DataFrame) -> DataFrame:
    """documents with personal data in `text` replaced by [KIND]; all columns and rows stay, null texts too."""
    columns, names = documents.columns, [f"c{i}" for i in range(len(documents.columns))]
    # All columns travel in one, so that no name of the input meets one of this search.
    row = F.struct(*(F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)))
    own_id = F.col("doc_id").cast("long").alias("doc_id")
    keyed = documents.select(row.alias("row"), own_id, F.xxhash64(text_or_empty()).alias("text_key"))
    scanned = materialize(scan(documents.select(own_id, text_or_empty().alias("text"))))
    more = materialize(further_spans(scanned, confident_patterns(scanned)))
    joined = keyed.join(more, _same_row(keyed, more), "left").select("row", "more")
    at = columns.index("text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, texts = batch.column(0).flatten(), []
            for value, extra in zip(values[at], batch.column(1)):
                text = value.as_py()
                spans = base_spans(text or "") + [tuple(x.values()) for x in extra.as_py() or ()]
                texts.append(covered(text, spans) if spans else text)
            values[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(values, columns)

    return joined.mapInArrow(apply, documents.schema)
