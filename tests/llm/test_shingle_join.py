"""The n-gram Jaccard join against brute force on small and awkward tables."""

from __future__ import annotations

import random

import pyarrow as pa

from journeylens.llm import shingle_join
from journeylens.llm.shingle_join import near_copies

SCHEMA = "doc_id long, text string"


def brute(rows):
    def shingles(text):
        words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in _words(text or "")]
        if not words:
            return set()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    sets = [(doc_id, shingles(text)) for doc_id, text in rows]
    label = {doc_id: doc_id for doc_id, _ in sets}
    changed = True
    while changed:
        changed = False
        for i, s in sets:
            for j, t in sets:
                if s and t and 100 * len(s & t) >= 75 * len(s | t) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return sorted((doc_id, len(s), label[doc_id]) for doc_id, s in sets)


def _words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text)


def ours(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in near_copies(frame).select("doc_id", "n_shingles", "component_id").collect())


def test_awkward_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE\x0btwo"), (6, "one two three"),
        (7, "a b c d e"), (8, "A b c\x0cd e"), (9, "a b c d e f"), (10, "é É x y z"), (11, "É É x y z"),
        (12, "w" * 50_000 + " a b c d"), (13, "x\x1cy a b c d"), (14, "same same same same same same same"),
        (14, "same same same same same same same"), (15, "word " * 30_000),
    ]
    assert ours(spark, rows) == brute(rows)


def test_random_copies_passages_and_small_sets(spark, monkeypatch):
    draw = random.Random(3)
    monkeypatch.setattr(shingle_join, "FREQUENT_FROM", 6)
    monkeypatch.setattr(shingle_join, "LIST_ROWS", 7)
    passage = " ".join(f"p{i}" for i in range(12))
    rows = []
    for i in range(160):
        if rows and draw.random() < 0.6:
            words = draw.choice(rows)[1].split()
            for _ in range(draw.randrange(3)):
                words[draw.randrange(len(words))] = f"n{draw.randrange(9)}"
        else:
            words = [f"v{draw.randrange(300)}" for _ in range(draw.choice([3, 5, 6, 7, 8, 30, 60]))]
        if draw.random() < 0.3:
            words += passage.split()
        rows.append((i, " ".join(words)))
    assert ours(spark, rows) == brute(rows)


def test_ids_null_or_shared_and_extra_columns(spark):
    text = " ".join(f"a{i}" for i in range(40))
    other = " ".join(f"b{i}" for i in range(40))
    frame = spark.createDataFrame(
        [(None, text, 1), (5, text, 1), (5, other, 1), (3, other, 1), (9, text, 1)],
        "doc_id long, text string, n long",
    )
    found = {(r.doc_id, r.component_id) for r in near_copies(frame).collect()}
    assert found == {(None, None), (5, 3), (3, 3), (9, 3)}


def test_empty_table(spark):
    assert near_copies(spark.createDataFrame([], SCHEMA)).collect() == []


def test_last_row_of_a_list_in_pieces_stays(monkeypatch):
    monkeypatch.setattr(shingle_join, "LIST_ROWS", 2)
    names = ["token", "part", "n", "gid", "at"]
    rows = [(5, -1, 9, gid, 0) for gid in range(10)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part)], names) for part in (rows[:9], rows[9:])]
    out = [r for b in shingle_join._listed(iter(batches)) for r in b.to_pylist()]
    assert sorted(r["gid"] for r in out) == list(range(10)) and all(r["many"] for r in out)


def _passages(n):
    """Texts that share a passage and no more, each with a near copy in whose place a few words differ."""
    rows = []
    for i in range(n):
        words = [f"p{j}" for j in range(8)] + [f"v{i}x{j}" for j in range(60)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:30] + ["other"] + words[31:]))]
    return rows


def test_no_round_where_step_5_has_fewer_pairs(spark, monkeypatch):
    tried = []
    monkeypatch.setattr(shingle_join, "_between", lambda *args: tried.append(args))
    rows = _passages(4)
    assert ours(spark, rows) == brute(rows) and not tried


def test_rounds_end_once_they_save_less_than_they_try(spark, monkeypatch):
    between, tried = shingle_join._between, []
    monkeypatch.setattr(shingle_join, "_between", lambda *args: tried.append(args) or between(*args))
    monkeypatch.setattr(shingle_join, "TURNS", 1)
    draw = random.Random(5)
    rows = _passages(12)
    # A chain of near copies in lists of their own, of which each round finds some.
    words = [f"c{j}" for j in range(120)]
    for i in range(100, 140):
        words = [w if draw.random() > 0.012 else f"d{i}" for w in words]
        rows.append((i, " ".join(words)))
    assert ours(spark, rows) == brute(rows)
    assert 0 < len(tried) < 4
