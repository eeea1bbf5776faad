"""Target resampling, suffix-array dedup and centroid clusters against brute force; faults mended; the pipeline's rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from journeylens.llm import (
    byte_bpe, centroids, packing, pii, quality_rules, resampling, shingle_join, suffix_array, toxicity, word_automaton,
)

DOCS = "doc_id long, text string, place string"
AWKWARD = [
    (1, None, "x"), (2, "", None), (3, " \t\r\n", "x"), (4, "Ünï 한국어 A-b\x00c", "x"), (4, "Ünï 한국어 A-b\x00c", "x"),
    (None, "no id at all", "x"), (5, "Word " * 3000, "x"), (6, "x" * 5000, "x"), (7, "one", "x"),
]
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def prose(draw, words, vocabulary=400):
    return " ".join(f"{draw.choice(['Ab', 'cé', 'Zo'])}{draw.randrange(vocabulary)}" for _ in range(words))


# ---- target resampling -----------------------------------------------------------------------------


def features(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    return len(words), [zlib.crc32(f.encode()) % 10_000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute_draw(documents, target):
    counts = [0] * 10_000, [0] * 10_000
    for side, texts in ((0, [t for _, t, _ in documents]), (1, target)):
        for text in texts:
            for b in features(text)[1]:
                counts[side][b] += 1
    raw, goal = sum(counts[0]) + 10_000, sum(counts[1]) + 10_000
    gain = [math.floor(1000 * math.log((t + 1) * raw / ((s + 1) * goal))) for s, t in zip(*counts)]
    rows = []
    for doc_id, text, _ in documents:
        n, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = order[: 25 * len(order) // 100]
    return rows, drawn


def test_draw_equals_brute_force(spark):
    draw = random.Random(1)
    rows = [(100 + i, prose(draw, draw.randrange(5, 60)), "x") for i in range(300)] + AWKWARD
    target = [prose(draw, 30, 50) for _ in range(20)] + [None]
    found = word_automaton.draw(spark.createDataFrame(rows, DOCS).repartition(5), spark.createDataFrame([(t,) for t in target], "text string"))
    got = found.collect()
    everything, drawn = brute_draw(rows, target)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=key) == sorted(
        ((r[0], *r[2:]) for r in everything), key=key
    )
    ranks = {r["rank"]: r.doc_id for r in got if r["rank"]}
    assert ranks == {i + 1: r[0] for i, r in enumerate(drawn)} and len(drawn) > 50


def test_draw_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert word_automaton.draw(empty, empty).count() == 0
    short = word_automaton.draw(spark.createDataFrame(AWKWARD[:4], DOCS), empty)
    assert [r["rank"] for r in short.collect()] == [None] * 4


def test_payloads_compose_to_the_crc_of_pairs(monkeypatch):
    monkeypatch.setattr(word_automaton, "PIECE", 50)
    texts = [b"The cat, the CAT; " + "é한".encode() * 300 + b" x", None, b"", b"--", b"a b\xc3\xa9c d"]
    for text, words in zip(texts, word_automaton.payloads(texts)):
        assert word_automaton.buckets(words).tolist() == features((text or b"").decode())[1]


# ---- suffix array ----------------------------------------------------------------------------------


def brute_repeats(texts, width=200):
    seen: dict[bytes, int] = {}
    for text in texts:
        for i in range(len(text) - width + 1):
            seen[text[i : i + width]] = seen.get(text[i : i + width], 0) + 1
    out = []
    for text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - width + 1):
            if seen[text[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(text), sum(gone), spans, bytes(b for b, g in zip(text, gone) if not g)))
    return out


def shared_passages(seed, documents=40):
    """Texts that share passages around the least length, with different surroundings, and parts of each other."""
    draw = random.Random(seed)
    passages = [prose(draw, 80)[:n] for n in (150, 199, 200, 201, 260, 400, 395)]
    rows = []
    for i in range(documents):
        parts = [prose(draw, draw.randrange(3, 60))]
        for _ in range(draw.randrange(3)):
            passage = draw.choice(passages)
            cut = draw.choice([0, 0, 7, 31])
            parts += [passage[cut : len(passage) - draw.choice([0, 0, 5, 40])], prose(draw, draw.randrange(0, 30))]
        rows.append((i, draw.choice([" ", ""]).join(parts), "x"))
    return [*rows, *AWKWARD, (90, "ab" * 400, "x"), (91, "zab" + "ab" * 150, "x"), rows[0], (0, rows[1][1][3:], "x")]


@pytest.mark.parametrize("seed, piece, partitions", [(1, 1 << 20, 1), (2, 300, 5), (3, 1000, 7)])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, seed, piece, partitions):
    monkeypatch.setattr(suffix_array, "PIECE", piece)
    monkeypatch.setattr(suffix_array, "SMALL", 64)
    rows = shared_passages(seed)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = suffix_array.without_repeats(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = brute_repeats([(t or "").encode() for _, t, _ in rows])
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=key) == sorted(
        ((row[0], *x) for row, x in zip(rows, expected)), key=key
    )
    assert sum(x[1] for x in expected) > 3000


def test_nothing_to_remove(spark):
    assert suffix_array.without_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_multikey_quicksort_orders_by_all_columns(monkeypatch):
    monkeypatch.setattr(suffix_array, "SMALL", 40)
    draw = np.random.default_rng(3)
    columns = [draw.integers(0, 5, 4000), draw.integers(-3, 300, 4000), draw.integers(0, 9, 4000)]
    order = suffix_array.multikey_quicksort(columns)
    rows = list(zip(*(c[order].tolist() for c in columns)))
    assert rows == sorted(zip(*(c.tolist() for c in columns))) and sorted(order) == list(range(4000))


def test_boundaries_are_compared():
    """One class over three buckets, all of the middle one; another that ends where its bucket does."""
    edges = [(0, [1, 1, 1, 5, 2, 7, 2]), (1, [5, 7, 7, 5, 7, 7, 1]), (2, [5, 8, 8, 9, 1, 1, 2]), (3, [10, 1, 1, 10, 1, 1, 1])]
    told = {row[0]: row[1:] for row in suffix_array._across(edges)}
    assert told[0] == (False, True, False, True, False, True)
    assert told[1] == (True, True, True, False, True, True)
    assert told[2] == (True, False, False, False, True, False)
    assert told[3] == (False, False, False, False, False, False)


# ---- centroids -------------------------------------------------------------------------------------


def brute_clusters(rows, clusters, rounds, seed=2):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    hashed = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centres = [v for _, v in hashed[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centres = [[sum(x) // len(groups[k]) for x in zip(*groups[k])] if k in groups else c for k, c in enumerate(centres)]
    return [(i, *near(v)[::-1]) for i, v in kept], centres


@pytest.mark.parametrize("clusters, rounds", [(5, 3), (40, 5)])
def test_clusters_equal_brute_force(spark, clusters, rounds):
    draw = np.random.default_rng(4)
    middles = draw.standard_normal((8, 64))
    rows = [(i, (middles[i % 8] + 0.2 * draw.standard_normal(64)).tolist()) for i in range(150)]
    rows += [(i, rows[0][1]) for i in (0, 500, 501)] + [(None, rows[3][1])]
    rows += [(600, None), (601, []), (602, [0.0] * 63), (603, [None] * 64), (604, [float("nan")] * 64), (605, [float("inf")] * 64)]
    rows += [(700, [1e7] * 64), (701, [-3.5e5] + [0.0] * 63)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, cluster string").repartition(3)
    placed, centres = centroids.cluster(df, clusters, rounds)
    expected, expected_centres = brute_clusters(rows, clusters, rounds)
    assert centres == expected_centres
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = [(r.vec_id, r.cluster, r.distance) for r in placed.collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)
    sums = {k: sum(d for _, c, d in expected if c == k) for _, k, _ in expected}
    assert {(r.cluster, r.cluster_inertia, r.inertia) for r in placed.collect()} == {(k, s, sum(sums.values())) for k, s in sums.items()}
    digests = {r.centroid_sha256 for r in centroids.with_digest(placed, centres).filter("cluster = 0").collect()}
    assert digests == {hashlib.sha256(",".join(map(str, centres[0])).encode()).hexdigest()}


def test_clusters_of_little_and_of_huge_numbers(spark):
    schema = "vec_id long, embedding array<double>"
    placed, centres = centroids.cluster(spark.createDataFrame([], schema))
    assert placed.count() == 0 and centres == []
    rows = [(1, [1e300] + [0.0] * 63), (2, [-1e300] + [0.0] * 63), (3, [1e300] + [0.0] * 63)]
    placed, centres = centroids.cluster(spark.createDataFrame(rows, schema))
    expected, expected_centres = brute_clusters(rows, 40, 5)
    assert centres == expected_centres
    assert sorted((r.vec_id, r.cluster, r.distance) for r in placed.collect()) == sorted(expected)


def test_the_filter_leaves_centroids_out():
    draw = np.random.default_rng(5)
    middles = draw.integers(-500, 500, (40, 64))
    values = middles[draw.integers(0, 40, 2000)] + draw.integers(-20, 20, (2000, 64))
    spread = np.cov(values.T)
    axes = np.linalg.eigh(spread)[1][:, ::-1]
    number, distance, compared = centroids.nearest(values, *centroids.turned(values, axes), middles, axes)
    full = ((values[:, None] - middles[None]) ** 2).sum(axis=2)
    assert (number == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert compared < 2 * len(values)


# ---- faults mended ---------------------------------------------------------------------------------


def test_an_ip_with_a_part_of_thousands_of_digits(spark):
    text = "at 1." + "0" * 5000 + ".2.3 and 1.2.3.999"
    spans = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans
    assert [(s.kind, text[s.start : s.end].count("0")) for s in spans if s.kind == "ip"] == [("ip", 5000)]


def test_columns_named_like_those_of_the_search(spark):
    rows = [(1, "mail a@b.org now", "m", "t", 5), (None, None, "m", "t", None), (2, "", None, "t", 0)]
    df = spark.createDataFrame(rows, "doc_id int, text string, more string, text_key string, row int")
    found = pii.redact(df)
    assert found.schema == df.schema
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([(1, "mail [EMAIL] now", "m", "t", 5), *rows[1:]], key=repr)


def test_word_ids_equal_the_tokenizer_in_its_default_setting():
    draw = random.Random(12)
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        words = packing.WordTokenizer(file.read())
    pieces = ["İ", "DİYARBAKIR", "ß", "ΑΣ", "é", "a", "The", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "!", ",", "|", "&", "#",
              "'s", "12", " ", "  ", "\n", "\t", "̇", "é", "한국", "😀", " ", "x" * 70]
    texts = ["İ!", "DİYARBAKIRİ, x", "a<|endoftext|>b", "", "<|startoftext|>,"]
    texts += ["".join(draw.choice(pieces) for _ in range(draw.randrange(1, 12))) for _ in range(4000)]
    for text in texts:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_bytes_in_one_pass_equal_encode_and_decode(spark):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    df = spark.createDataFrame([(i, t) for i, t, _ in AWKWARD], "doc_id int, text string")
    once = byte_bpe.round_trip(df, ranks, public_tokenizers.PATTERN)
    twice = byte_bpe.decode(byte_bpe.encode(df, ranks, public_tokenizers.PATTERN), ranks)
    assert once.schema == twice.schema and sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))


# ---- quality classifier and the pipeline -----------------------------------------------------------


def test_log_weights_recomputed_one_by_one(spark):
    draw = random.Random(6)
    rows = [(i, prose(draw, 12, 20 if i % 3 else 200), "x") for i in range(60)] + AWKWARD
    labels = [(i, int(i % 3 > 0)) for i in range(40)]
    found = resampling.resample(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int"))
    bags = {i: np.bincount(np.concatenate(list(resampling.buckets(t or ""))), minlength=resampling.BUCKETS) for i, (_, t, _) in enumerate(rows)}
    good = {i for i, q in labels if q}
    target, raw = np.ones(resampling.BUCKETS), np.ones(resampling.BUCKETS)
    for i, (doc_id, _, _) in enumerate(rows):
        raw += bags[i]
        target += bags[i] * (doc_id in good)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    expected = sorted(float(ratio @ bag) for bag in bags.values())
    np.testing.assert_allclose(sorted(r.log_weight for r in found.collect()), expected, atol=1e-9)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    draw = random.Random(9)
    rows = [(i, prose(draw, 40, 2000) + ".", "en", "s", 0, "extra", i) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " end", "en", "s", 0, None, 1) for i in range(10)]
    rows += [(200, "short", "en", "s", 0, "x", 1), (201, None, None, None, None, None, None), (None, prose(draw, 40), "en", "s", 0, "x", 1)]
    rows += [rows[0], (0, rows[0][1], "en", "t", 0, "other", 2), (300, "mail me at a.b@c.org " + prose(draw, 30), "en", "s", 0, "x", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, more string, kept_id long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in range(0, 60, 2)] + [(200, 0, 0), (201, 0, 1), (5000, 1, 0), (None, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def test_stages_on_awkward_rows(spark, tables):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    ids = lambda df: sorted((r.doc_id for r in df.collect()), key=repr)
    judged = quality_rules.judge(docs, labels.select("doc_id", "quality"))
    first = corpus_pipeline.quality_rules_stage(spark, docs, folder)
    assert first.schema == docs.schema and ids(first) == ids(judged.filter("kept")) and 200 not in ids(first)
    weighed = resampling.resample(docs, labels.select("doc_id", "quality"), share=0.5)
    second = resampling.keep(docs, labels.select("doc_id", "quality"), share=0.5)
    assert second.schema == docs.schema and ids(second) == ids(weighed.filter("kept"))
    third = corpus_pipeline.near_copies_stage(spark, docs, folder).collect()
    kept = [r.doc_id for r in third if r.doc_id is not None]
    assert len(kept) == len(set(kept)) and set(kept) == set(range(60)) | {200, 201, 300}
    # Of the rows of id 0 the one with the least other columns.
    assert [(r.source, r.more) for r in third if r.doc_id == 0] == [("s", "extra")]
    assert sum(r.doc_id is None for r in third) == 1
    fourth = {r.doc_id: r for r in corpus_pipeline.personal_data_stage(spark, docs, folder).collect()}
    assert "[EMAIL]" in fourth[300].text and fourth[300].n_chars == len(fourth[300].text) and fourth[1].more == "extra"


def test_pipeline_runs_and_runs_on_nothing(spark, tables, tmp_path):
    folder, _ = tables
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in packed} >= {2, 4, 300} and all(r.length <= 2048 for r in packed)
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rounds_leave_lists_that_lie_in_one_component(spark):
    lists = spark.createDataFrame(
        [(1, 1, 9, 0), (1, 2, 9, 0), (2, 3, 9, 0), (2, 4, 9, 0), (3, 1, 9, 1), (3, 5, 90, 1)], "token long, gid long, n long, at int"
    )
    posted = spark.createDataFrame([(g, [1, 2, 3], 9, 5) for g in range(1, 6)], "gid long, tokens array<long>, n long, last long")
    members = spark.createDataFrame([(g, g) for g in range(1, 6)], "gid long, doc_id long")
    labels = spark.createDataFrame([(3, 3), (4, 3)], "node long, component long")
    pairs, waiting = shingle_join._between(lists, posted, members, labels, 0)
    assert [tuple(r) for r in pairs.collect()] == [(1, 2)]  # the sizes of 1 and 5 allow no link
    assert {r.token for r in waiting.collect()} == {1, 3}


def test_a_word_has_no_number_past_a_beginning_that_does_not_count():
    draw = random.Random(4)
    texts = [{"".join(draw.choice("abé") for _ in range(draw.randint(1, 9))) for _ in range(30)} for _ in range(60)]
    sets = [{f for word in text for f in toxicity.features(word)} for text in texts]
    seen, counts = np.unique(np.concatenate([np.array(sorted(s), np.uint64) for s in sets]), return_counts=True)
    vocabulary = {f: n for n, f in enumerate(seen[counts >= toxicity.LEAST_EXAMPLES].tolist())}
    plain, words = set(), sorted(set().union(*texts)) + ["zzzzzzz", "abéz", ""]
    for word in words * 2:
        found = np.frombuffer(toxicity.numbers(word, vocabulary, plain), np.int32)
        assert sorted(found.tolist()) == sorted(vocabulary[f] for f in toxicity.features(word) if f in vocabulary)
    assert 0 < len(vocabulary) < len(seen) and "zzzz" in plain


def test_words_of_letters_below_256_need_the_merges_only(monkeypatch):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        model = file.read()
    own, whole = packing.WordTokenizer(model), Tokenizer.from_str(model)
    monkeypatch.setattr(own, "_parts", lambda word: pytest.fail(f"{word!r} went by parts"))
    text = "Weiß, cióníja, Éouêre etéoiéle&&& ÀÉ! ªº µm ÿ plain PLAIN plain.\nword||| ÿÿ,, " + "é" * 90 + " " + "x" * 90 + "!"
    assert own.encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
