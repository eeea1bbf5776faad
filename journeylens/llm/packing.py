"""Best-fit decreasing packing of tokenised documents into sequences of one length.

Equal lengths are interchangeable, so the best-fit decreasing assignment follows from how many pieces there are of
each length: at most `capacity` numbers, whatever the corpus. `plan` packs that histogram with a segment tree over the
remaining capacities; it finds the tightest open sequence of enough room in logarithmic time and fills all sequences
of that remaining room in one step. Every piece then looks up its place by its length and its number among the pieces
of that length. Numbers are counted per partition and length and shifted by the counts of earlier partitions, so no
task sees all pieces of a length.
"""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..runtime import materialize

CAPACITY = 2048
END = 0
#: Words that a task remembers the ids of (some 90 MB), and the longest that it does.
REMEMBERED = 300_000
REMEMBERED_LENGTH = 60
ROWS = 256
#: Characters of a long text that are tokenised at a time, cut at a space.
CHARACTERS = 1 << 20
_SIGNS = ".,;:!?#%&$*|"


def _byte_letters() -> dict[int, str]:
    """The byte-level characters: printable bytes stand for themselves, the others for those from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in plain)}


_BYTE_LETTERS = _byte_letters()


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTokenizer:
    """Ids of whole texts, as little-endian 32-bit numbers, through the ids of their words.

    The tokenizer drops white space and never merges across it, so the text may be cut at spaces and line ends. A word
    that ends in signs has the ids of the letters before them, then those of the signs, unless its lower-case form ends
    in a mark that the signs would join. Words that may hold a special token stay whole: they are found in them as
    in any text.
    """

    def __init__(self, model: str):
        self.tokenizer = Tokenizer.from_str(model)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}

    def _parts(self, word: str) -> tuple[str, ...]:
        base = word.rstrip(_SIGNS)
        if "<|" in word or not base or not base.lower()[-1].isalpha():
            return (word,)
        plain = base.lower() if max(base) < "\u0100" else base
        return (plain, word[len(base) :]) if len(base) < len(word) else (plain,)

    def _learn(self, words: set[str]) -> None:
        """Words of letters below 256, signs after them or not, need but a look-up or the merges; the rest goes by parts."""
        known, rest = self.known, []
        for word in words:
            base = word.rstrip(_SIGNS)
            if not base.isalpha() or not base.isascii() and max(base) >= "\u0100":
                rest.append(word)
                continue
            lower = base.lower()
            ids = known.get(lower)
            if ids is None:
                letters = lower if lower.isascii() else lower.encode().decode("latin-1").translate(_BYTE_LETTERS)
                ids = known[lower] = _packed([t.id for t in self.model.tokenize(letters)])
            if len(base) < len(word):
                signs = word[len(base) :]
                if signs not in known:
                    known[signs] = _packed(self.tokenizer.encode(signs, add_special_tokens=False).ids)
                ids += known[signs]
            known[word] = ids
        if rest:
            self._learn_parts(rest)

    def _learn_parts(self, words: list[str]) -> None:
        parts = {word: self._parts(word) for word in words}
        new = [p for p in {p for ps in parts.values() for p in ps} if p not in self.known]
        # Lower-case letters below 256 are normal as they are and one piece, so the merges alone give their ids.
        single = [p for p in new if p.isalpha() and max(p) < "\u0100" and p == p.lower()]
        found = [[t.id for t in self.model.tokenize(p.encode().decode("latin-1").translate(_BYTE_LETTERS))] for p in single]
        others = [p for p in new if not (p.isalpha() and max(p) < "\u0100" and p == p.lower())]
        found += [e.ids for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        for piece, ids in zip(single + others, found):
            self.known[piece] = _packed(ids)
        for word, pieces in parts.items():
            self.known[word] = b"".join(map(self.known.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        out, start = [], 0
        while start < len(text) or not out:
            end = start + CHARACTERS
            if end < len(text):
                end = max(text.find(" ", end), 0) or len(text)
            words = text[start:end].replace("\n", " ").split(" ")
            if len(self.known) > REMEMBERED:
                self.known.clear()
            if missing := set(words).difference(self.known):
                self._learn(missing)
            out.append(b"".join(map(self.known.__getitem__, words)))
            # Long ones are never known, so always missing.
            for word in missing:
                if len(word) > REMEMBERED_LENGTH:
                    del self.known[word]
            start = end
        return b"".join(out)


def pieces(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, part, number[, ids]) of documents (doc_id, text).

    A document is the ids of its text (none if null or empty), then id 0; longer ones are cut to the capacity.
    `number` counts the pieces of a length within a partition `part`, so the rows must be written before use.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        model = documents.sparkSession.sparkContext.broadcast(file.read())

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = WordTokenizer(model.value)
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number", *["ids"] * with_ids]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                rows = batch.slice(first, ROWS)
                out: list[list] = [[] for _ in names]
                for doc_id, text in zip(rows.column(0), rows.column(1)):
                    ids = tokenizer.encode(text.as_py() or "") + struct.pack("<I", END)
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        length = len(own) // 4
                        values = (doc_id.as_py(), piece, at // 4, length, zlib.crc32(own), part, seen[length], own)
                        for column, value in zip(out, values):
                            column.append(value)
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, number long"
    return documents.select("doc_id", "text").mapInArrow(apply, schema + ", ids binary" * with_ids)


class Capacities:
    """Segment tree over remaining capacities: which of them have open sequences, and the least of enough room."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.filled = bytearray(2 * self.leaves)

    def mark(self, room: int, is_open: bool) -> None:
        node = room + self.leaves
        self.filled[node] = is_open
        while node > 1:
            node //= 2
            self.filled[node] = self.filled[2 * node] | self.filled[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        node = least + self.leaves
        if self.filled[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.filled[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.filled[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Best-fit decreasing over pieces counted by length: rows (length, first number, first sequence, per sequence, offset).

    A row says: from the first number on, so many pieces go to each sequence from the first one on, the first of them
    at the offset. It holds until the next row of the same length.
    """
    tree, open_at = Capacities(capacity), defaultdict(list)  # room -> [first sequence, sequences]
    rows, made = [], 0
    for length in sorted(counts, reverse=True):
        left, number = counts[length], 0

        def place(first: int, sequences: int, room: int) -> int:
            """Fill sequences of one room; gives back how many of them were used."""
            nonlocal left, number
            each = room // length
            rows.append((length, number, first, each, capacity - room))
            used = min(sequences, -(-left // each))
            whole = min(used, left // each)
            rest = left - whole * each if used > whole else 0
            for start, n, held in ((first, whole, each), (first + whole, used - whole, rest)):
                after = room - held * length
                if n and after:
                    open_at[after].append([start, n])
                    tree.mark(after, True)
            placed = whole * each + rest
            left, number = left - placed, number + placed
            return used

        while left and (room := tree.tightest(length)) is not None:
            ranges = open_at[room]
            first, sequences = ranges.pop()
            used = place(first, sequences, room)
            if used < sequences:
                ranges.append([first + used, sequences - used])
            if not open_at[room]:
                tree.mark(room, False)
        if left:
            fresh = -(-left // (capacity // length))
            place(made, fresh, capacity)
            made += fresh
    return np.array(rows, np.int64).reshape(-1, 5)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Written rows of `pieces` with (sequence_id, offset) in place of (part, number)."""
    spark = cut.sparkSession
    counts = materialize(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("pieces")))
    # Bounded: one row for each length up to the capacity.
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("pieces").alias("n")).collect()}
    layout = spark.sparkContext.broadcast(plan(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = materialize(
        counts.select("length", "part", F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("before"))
    )
    numbered = cut.join(shifts, ["length", "part"])
    rest = [c for c in cut.columns if c not in ("part", "number")]
    numbered = numbered.select(*rest, (F.col("before") + F.col("number")).alias("number"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = layout.value
        keys = rows[:, 0] << 40 | rows[:, 1]
        order = np.argsort(keys)
        keys, rows = keys[order], rows[order]
        for batch in batches:
            length, number = (np.asarray(batch.column(c)) for c in ("length", "number"))
            row = rows[np.searchsorted(keys, length << 40 | number, side="right") - 1]
            within = number - row[:, 1]
            sequence, place = row[:, 2] + within // row[:, 3], row[:, 4] + within % row[:, 3] * length
            kept = [batch.column(c) for c in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(place)], [*rest, "sequence_id", "offset"])

    kinds = dict(cut.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in rest) + ", sequence_id long, offset long"
    return numbered.mapInArrow(apply, schema)


def pack_documents(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    return pack(materialize(pieces(documents, tokenizer_path, capacity, with_ids)), capacity)
