import random
import uuid
from datetime import date

import numpy as np
import pytest
from helpers import by, visits
from pyspark.sql import functions as F

from journeylens.names import COHORT, CONVERSION, MODELS, NULL_STATE, START
from journeylens.operators import groups, journeys, markov, sparse
from journeylens.runtime import materialize, materialize_by

SCHEMA = "run_date date, conversion_type string, conversion_window int, source string, destination string, steps long"


def chain(spark, counts, window=30):
    return spark.createDataFrame(
        [(date(2024, 1, 20), "Trial", window, a, b, n) for (a, b), n in counts.items()], SCHEMA
    )


TWO_CHANNELS = {
    (START, "A"): 6, (START, "B"): 4, ("A", "B"): 5, ("A", CONVERSION): 3, ("A", NULL_STATE): 2,
    ("B", "A"): 3, ("B", CONVERSION): 3, ("B", NULL_STATE): 4,
}
BASE = 0.501176


def removed(counts, gone):
    """Conversion probability with one channel taken out, by long iteration."""
    states = sorted({s for edge in counts for s in edge})
    index = {s: i for i, s in enumerate(states)}
    matrix = np.zeros((len(states), len(states)))
    for (a, b), n in counts.items():
        matrix[index[a], index[NULL_STATE if b == gone else b]] += n
    for end in (CONVERSION, NULL_STATE):
        if end in index:
            matrix[index[end], index[end]] = 1
    sums = matrix.sum(axis=1, keepdims=True)
    matrix = matrix / np.where(sums == 0, 1, sums)
    return np.linalg.matrix_power(matrix, 5000)[index[START], index[CONVERSION]]


def test_known_chain(spark):
    effects = by(markov.removal_effects_raw(chain(spark, TWO_CHANNELS)), "channel", "removal_effect_raw")
    assert effects["A"][0] == pytest.approx(1 - 0.12 / BASE, abs=1e-5)
    assert effects["B"][0] == pytest.approx(1 - 0.18 / BASE, abs=1e-5)
    percent = by(markov.removal_effects(markov.removal_effects_raw(chain(spark, TWO_CHANNELS))), "channel", "removal_effect", "removal_effect_raw")
    assert sum(v[0] for v in percent.values()) == pytest.approx(100)
    assert percent["A"] == (pytest.approx(0.761 / (0.761 + 0.641) * 100), 0.761)


def random_chain(rng, channels):
    names = [f"c{i}" for i in range(channels)]
    counts = {}
    for _ in range(40):
        path = [START, *[rng.choice(names) for _ in range(rng.randint(1, 6))], rng.choice([CONVERSION, NULL_STATE])]
        for edge in zip(path, path[1:]):
            if edge[0] != edge[1]:
                counts[edge] = counts.get(edge, 0) + 1
    return counts


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_removal_one_at_a_time(spark, seed):
    counts = random_chain(random.Random(seed), 5)
    counts.setdefault((START, CONVERSION), 0)
    counts = {edge: n for edge, n in counts.items() if n}
    # A second, unconnected group of channels in the same cohort.
    counts |= {(START, "x"): 3, ("x", "y"): 3, ("y", "x"): 1, ("y", CONVERSION): 2, (START, CONVERSION): 2}
    steps = chain(spark, counts).unionByName(chain(spark, TWO_CHANNELS, 60))
    raw = markov.removal_effects_raw(steps)
    assert raw.count() == 9
    base = removed(counts, None)
    for channel, (effect,) in by(raw.filter("conversion_window = 30"), "channel", "removal_effect_raw").items():
        assert effect == pytest.approx(1 - removed(counts, channel) / base)


@pytest.mark.parametrize("most_fill", [0, 4, 10**9])
@pytest.mark.parametrize("n, density, leaves", [(1, 1, 0.5), (40, 0.05, 0.3), (60, 0.06, 0.3), (60, 0.1, 1e-7), (50, 0.5, 0.1)])
def test_sparse_solution_gives_the_entries_of_the_inverse(n, density, leaves, most_fill):
    rng = np.random.default_rng(7)
    matrix = np.where(rng.random((n, n)) < density, rng.random((n, n)), 0)
    np.fill_diagonal(matrix, 0)
    total = matrix.sum(axis=1) + leaves
    matrix, leave = matrix / total[:, None], leaves / total
    wins, starts = leave * rng.random(n), rng.random(n)
    inverse = np.linalg.inv(np.eye(n) - matrix)
    out = [{int(j): matrix[i, j] for j in np.flatnonzero(matrix[i])} for i in range(n)]
    visits, again, value = sparse.solve(out, wins, starts, leave, most_fill)
    digits = 1e-9 if leaves > 1e-3 else 1e-5
    np.testing.assert_allclose(visits, starts @ inverse, rtol=digits)
    np.testing.assert_allclose(again, np.diag(inverse), rtol=digits)
    np.testing.assert_allclose(value, inverse @ wins, rtol=digits)


def test_walks_that_hardly_ever_end():
    """Two states that pass walks on to each other a million million times: known in closed form."""
    e = 1e-12
    visits, again, value = sparse.solve([{1: 1 - e}, {0: 1.0}], np.array([e, 0.0]), np.array([1.0, 0.0]), np.array([e, 0.0]))
    np.testing.assert_allclose(visits, [1 / e, 1 / e * (1 - e)], rtol=1e-9)
    np.testing.assert_allclose(again, [1 / e, 1 / e], rtol=1e-9)
    np.testing.assert_allclose(value, [1, 1], rtol=1e-9)


def test_strong_parts_come_before_what_leads_to_them():
    rng = random.Random(4)
    out = [[rng.randrange(30) for _ in range(rng.randrange(3))] for _ in range(30)]
    reach = {(i, j) for i in range(30) for j in out[i]} | {(i, i) for i in range(30)}
    for k in range(30):
        reach |= {(i, j) for i in range(30) for j in range(30) if (i, k) in reach and (k, j) in reach}
    parts = sparse.strong_parts(out)
    assert sorted(x for part in parts for x in part) == list(range(30))
    number = {x: i for i, part in enumerate(parts) for x in part}
    for i in range(30):
        for j in range(30):
            assert (number[i] == number[j]) == ((i, j) in reach and (j, i) in reach)
            assert (i, j) not in reach or number[j] <= number[i]


@pytest.mark.parametrize("nodes", [3, 10**6])
def test_connected_groups(spark, monkeypatch, nodes):
    monkeypatch.setattr(groups, "FOREST_NODES", nodes)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    rng = random.Random(6)
    pairs = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1100)] + [(7, 7), (5000, 5000)]
    pairs += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(90)]
    label = {v: v for p in pairs for v in p}
    for _ in range(250):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    found = dict(groups.connected_groups(spark.createDataFrame(pairs, "a long, b long").repartition(3)).collect())
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(found) == set(label)
    assert len({(found[v], label[v]) for v in label}) == len(set(found.values())) == len(set(label.values()))


def test_many_states(spark):
    rng = np.random.default_rng(5)
    n, counts = 10_000, {}
    for i in range(n):
        counts[(START, f"c{i}")] = 1
        counts[(f"c{i}", CONVERSION if i % 3 else NULL_STATE)] = 2
        for j in rng.integers(0, n, 3):
            if i != j:
                counts[(f"c{i}", f"c{j}")] = 1
    raw = markov.removal_effects_raw(chain(spark, counts).repartition(4)).filter("removal_effect_raw between 0 and 1")
    assert raw.count() == n


def test_small_groups_share_calls(spark, monkeypatch, tmp_path):
    """300 groups take a few calls, not one each; the effects do not depend on how many."""
    rng, counts = random.Random(8), {(START, CONVERSION): 3}
    for g in range(300):
        for (a, b), n in random_chain(rng, 3).items():
            counts[tuple(s if s.startswith("(") else f"g{g}{s}" for s in (a, b))] = n
    for (a, b), n in list(counts.items()):
        if a == START:
            counts[(a, b)] = n + rng.randrange(3)
    solve = markov._solve

    def counted(frame):
        (tmp_path / uuid.uuid4().hex).touch()
        return solve(frame)

    monkeypatch.setattr(markov, "_solve", counted)
    steps = materialize(chain(spark, counts))
    effects = by(markov.removal_effects_raw(steps), "channel", "removal_effect_raw")
    assert len(list(tmp_path.iterdir())) == 1
    apart = by(markov.removal_effects_raw(steps, 20), "channel", "removal_effect_raw")
    assert len(list(tmp_path.iterdir())) > 100
    assert set(effects) == set(apart) == {s for edge in counts for s in edge if s.startswith("g")}
    assert all(effects[c] == pytest.approx(apart[c], rel=1e-12) for c in effects)
    base = removed(counts, None)
    for channel in rng.sample(sorted(effects), 3):
        assert effects[channel][0] == pytest.approx(1 - removed(counts, channel) / base)


def test_no_conversions(spark):
    steps = chain(spark, {(START, "A"): 2, ("A", NULL_STATE): 2})
    raw = markov.removal_effects_raw(steps)
    assert by(raw, "channel", "removal_effect_raw") == {"A": (None,)}
    assert by(markov.removal_effects(raw), "channel", "removal_effect") == {"A": (None,)}


def test_edges_leave_out_steps_to_the_same_channel(spark):
    rows = [("u", f"2024-01-20 0{h}:00:00", "AABA"[h], int(h == 3)) for h in range(4)]
    rows += [("w", "2024-01-20 01:00:00", "B", 0)]
    steps = markov.edges(journeys.touches(visits(spark, rows)))
    assert by(steps, ["source", "destination"], "steps") == {
        (START, "A"): (1,), ("A", "B"): (1,), ("B", "A"): (1,), ("A", CONVERSION): (1,),
        (START, "B"): (1,), ("B", NULL_STATE): (1,),
    }
    sums = markov.probabilities(steps).groupBy(*COHORT, "source").agg(F.sum("probability").alias("p"))
    assert all(row.p == pytest.approx(1) for row in sums.collect())
    dense = by(markov.dense_transitions(steps), ["source", "destination"], "probability")
    assert len(dense) == 25 and dense[("A", "B")] == (0.5,) and dense[("B", "B")] == (0.0,)
    assert dense[(CONVERSION, CONVERSION)] == (1.0,) and dense[(NULL_STATE, CONVERSION)] == (0.0,)


def test_start_value_is_the_share_of_converting_journeys(spark):
    rng = random.Random(3)
    rows = []
    for user in range(30):
        n = rng.randint(1, 5)
        rows += [(f"u{user}", f"2024-01-20 0{h}:00:00", rng.choice("ABC"), int(h == n - 1 and user % 3 > 0)) for h in range(n)]
    steps = markov.edges(journeys.touches(visits(spark, rows)))
    counts = {(r.source, r.destination): r.steps for r in steps.collect()}
    assert removed(counts, None) == pytest.approx(20 / 30)


def test_markov_credit(spark):
    rows = [("u", "2024-01-20 01:00:00", "A", 0), ("u", "2024-01-20 02:00:00", "B", 1), ("w", "2024-01-20 02:00:00", "A", 0)]
    placed = journeys.touches(visits(spark, rows))
    raw = markov.removal_effects_raw(markov.edges(placed))
    credit = by(markov.with_markov_credit(placed, raw), ["user_guid", "channel"], MODELS["markov"])
    assert credit == {("u", "A"): (0.5,), ("u", "B"): (0.5,), ("w", "A"): (0.0,)}


def test_sparse_rows_keep_any_number_of_destinations(spark):
    counts = {(START, f"c{i}"): 1 for i in range(12_000)} | {("c0", "c1"): 3, ("c0", CONVERSION): 1}
    rows = markov.sparse_rows(chain(spark, counts))
    assert by(rows, "source", "width")["c0"] == (12_001,)
    found = by(markov.melt(rows), ["source", "destination"], "probability", "zeros")
    assert len(found) == 12_002 and found[("c0", "c1")] == (0.75, 11_999) and found[(START, "c7")][1] == 1


def test_credit_does_not_shuffle_touches_laid_out_by_user(spark):
    rows = [("u", "2024-01-20 01:00:00", "A", 0), ("u", "2024-01-20 02:00:00", "B", 1), ("w", "2024-01-20 02:00:00", "A", 0)]
    stored = materialize_by(journeys.touches_once(visits(spark, rows)), journeys.SPLIT_KEYS)
    placed = journeys.per_window(stored)
    raw = materialize(markov.removal_effects_raw(materialize(markov.edges(placed))))
    credited = markov.with_markov_credit(placed, raw)
    plan = credited._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 1 and "Window" in plan
    assert by(credited, ["user_guid", "channel"], MODELS["markov"]) == {("u", "A"): (0.5,), ("u", "B"): (0.5,), ("w", "A"): (0.0,)}
    split = markov.with_markov_credit(placed, raw, hot_rows=1)
    assert by(split, ["user_guid", "channel"], MODELS["markov"]) == by(credited, ["user_guid", "channel"], MODELS["markov"])


def test_removal_effects_packed_by_channel_need_no_shuffle_of_touches(spark, monkeypatch):
    """Beyond the few that go as rows; cohorts and channels without an effect stay without one."""
    rows = [(f"u{u}", f"2024-01-20 0{h}:00:00", "ABCD"[(u + h) % 4], int(h == 3)) for u in range(6) for h in (1, 2, 3)]
    frame = visits(spark, rows).unionByName(visits(spark, rows[4:], kind="Subscription", window=60))
    stored = materialize_by(journeys.touches_once(frame), journeys.SPLIT_KEYS)
    raw = materialize(markov.removal_effects_raw(markov.edges(stored)).filter("conversion_window = 30 or channel <> 'A'"))
    keys = [*COHORT, "user_guid", "position"]
    usual = by(markov.with_markov_credit(stored, raw), keys, "channel", MODELS["markov"])
    monkeypatch.setattr(markov, "FEW_WEIGHTS", 1)
    assert markov.sent(raw) == "packed"
    packed = markov.with_markov_credit(stored, raw)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 2
    assert by(packed, keys, "channel", MODELS["markov"]) == usual and len(usual) == 32
    monkeypatch.setattr(markov, "PACKED_BYTES", 1)
    assert markov.sent(raw) == ""
    assert by(markov.with_markov_credit(stored, raw), keys, "channel", MODELS["markov"]) == usual
