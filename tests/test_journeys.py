import random
from datetime import date, datetime, timedelta
from types import SimpleNamespace

import pytest
from helpers import at, by, same_rows, visits
from pyspark.sql import functions as F

from journeylens import runtime
from journeylens.functions import labels
from journeylens.names import COHORT, JOURNEY, MODELS, USER, WINDOWS
from journeylens.operators import journeys, ltv, markov, models, windows
from journeylens.plans import queries, stages
from journeylens.plans.queries import _BUILD
from journeylens.runtime import materialize, materialize_by
from journeylens.sources.tables import run_dates

SCORES = [MODELS[m] for m in ("last_click", "first_click", "position_based", "time_decay")]


def credits(spark, rows, rule="last_visit", **options):
    placed = journeys.touches(visits(spark, rows), rule, **options)
    return models.with_credits(placed)


def test_three_touches(spark):
    rows = [("u", "2024-01-20 0%d:00:00" % h, c, int(h == 9)) for h, c in ((1, "A"), (2, "B"), (9, "A"))]
    got = by(credits(spark, rows), "position", "channel", *SCORES)
    total = 0.6 + 0.6 + 1
    assert got[1] == ("A", 0.0, 1.0, 0.3, pytest.approx(0.6 / total))
    assert got[2] == ("B", 0.0, 0.0, 0.3, pytest.approx(0.6 / total))
    assert got[3] == ("A", 1.0, 0.0, 0.4, pytest.approx(1 / total))


def test_one_and_two_touches(spark):
    one = by(credits(spark, [("u", "2024-01-20 01:00:00", "A", 1)]), "position", *SCORES)
    assert one == {1: (1.0, 1.0, 1.0, 1.0)}
    two = by(
        credits(spark, [("u", "2024-01-20 01:00:00", "A", 0), ("u", "2024-01-20 02:00:00", "B", 1)]),
        "position",
        MODELS["position_based"],
    )
    assert two[1][0] == pytest.approx(0.45) and two[2][0] == pytest.approx(0.55)


def test_two_conversions_and_a_trailing_visit(spark):
    rows = [("u", f"2024-01-20 0{h}:00:00", "ABCDE"[h], int(h in (1, 3))) for h in range(5)]
    placed = journeys.touches(visits(spark, rows), "as_is")
    got = by(placed, "channel", "journey_no", "position", "conversion_value", "next_channel")
    assert got == {
        "A": (0, 1, 1, "B"), "B": (0, 2, 1, None), "C": (1, 1, 1, "D"), "D": (1, 2, 1, None), "E": (2, 1, 0, None),
    }
    totals = by(models.channel_totals(models.with_credits(placed)), "channels", *SCORES)
    assert totals["E"] == (0, 0, 0, 0)
    text = by(models.text_form(models.journey_scores(models.with_credits(placed))), "journey_id", "channels_agg")
    assert text == {"id:u_J:0": ("A > B",), "id:u_J:1": ("C > D",), "id:u_J:2": ("E",)}


def test_only_the_last_recorded_conversion_counts(spark):
    rows = [("u", "2024-01-20 01:00:00", "A", 1), ("u", "2024-01-20 02:00:00", "B", 1)]
    assert by(credits(spark, rows), "channel", "converting_visit") == {"A": (0,), "B": (1,)}
    rows = [("u", "2024-01-20 01:00:00", "A", 1), ("u", "2024-01-20 02:00:00", "B", 0)]
    assert by(credits(spark, rows), "channel", "converting_visit") == {"A": (0,), "B": (0,)}
    assert by(credits(spark, rows, "last_visit_only"), "channel", "converting_visit") == {"A": (0,), "B": (1,)}
    at_noon = [("u", "2024-01-20 12:00:00", "A", 1), ("u", "2024-01-20 13:00:00", "B", 0)]
    assert by(credits(spark, at_noon, "conversion_time"), "channel", "converting_visit") == {"A": (1,), "B": (0,)}


def test_missing_touchpoint_is_a_dash(spark):
    assert by(credits(spark, [("u", "2024-01-20 01:00:00", None, 1)]), "channel", "position") == {"-": (1,)}


def random_visits(spark, users=6, seed=5):
    rng = random.Random(seed)
    rows = []
    for user in range(users):
        start = datetime(2024, 1, 20)
        for _ in range(rng.randint(1, 4) if user else 120):
            # Few distinct times, so that visits tie and chunks hold several rows.
            time = start + timedelta(seconds=20 * rng.randint(0, 60))
            rows.append((f"u{user}", str(time), rng.choice("ABCD"), int(rng.random() < 0.3)))
    return visits(spark, rows)


@pytest.mark.parametrize("rule", ["last_visit", "last_visit_only", "as_is", "conversion_day"])
def test_a_hot_user_split_by_time_gives_the_same_touches(spark, rule):
    rows = random_visits(spark)
    usual = journeys.touches(rows, rule, hot_rows=None)
    split = journeys.touches(rows, rule, hot_rows=10)
    columns = [*COHORT, USER, "channel", "journey_no", "position", "touch_count", "conversion_value", "next_channel",
               "journey_end", "decay_weight", "decay_total", "attribution_visit_start_time"]
    same_rows(usual.select(*columns), split.select(*columns))


def test_split_users_keep_several_windows_apart(spark):
    rows = random_visits(spark).withColumn("conversion_windows", F.expr("array(30, 60)")).drop("conversion_window")
    same_rows(journeys.touches(rows, "as_is", hot_rows=None), journeys.touches(rows, "as_is", hot_rows=10))


def nested_visits(spark):
    """Random visits over 91 days before one noon; some users are in the widest window only."""
    rng = random.Random(11)
    noon = datetime(2024, 1, 20, 12)
    rows = []
    for user in range(25):
        oldest = rng.choice([20, 50, 91])
        for _ in range(rng.randint(1, 12)):
            time = noon - timedelta(days=rng.randint(0, oldest), hours=rng.randint(0, 5))
            rows.append((f"u{user}", str(time), rng.choice("ABC"), int(rng.random() < 0.3)))
    frame = visits(spark, rows).drop("conversion_window")
    age = F.date_diff("conversion_visit_timestamp", "attribution_visit_start_time")
    held = F.array_compact(F.array(*[F.when(age <= days, name) for name, days in WINDOWS.items()]))
    return frame.withColumn("conversion_windows", held)


@pytest.mark.parametrize("hot_rows", [None, 5])
@pytest.mark.parametrize("rule", ["last_visit", "last_visit_only", "as_is", "conversion_day", "conversion_time"])
def test_one_order_serves_all_windows(spark, rule, hot_rows):
    rows = nested_visits(spark)
    apart = journeys.touches(windows.explode_windows(rows), rule, hot_rows=None)
    together = journeys.touches(rows, rule, hot_rows=hot_rows)
    same_rows(apart.select(*sorted(apart.columns)), together.select(*sorted(apart.columns)))
    counts = [together.filter(F.col("conversion_window") == w).count() for w in WINDOWS]
    assert counts[0] < counts[1] < counts[2]


def test_steps_of_all_windows_are_one_row(spark):
    rows = materialize(nested_visits(spark))
    once = materialize(journeys.touches_once(rows, "as_is", hot_rows=None))
    counts = materialize(markov.step_counts(once))
    apart = markov.edges(journeys.per_window(once))
    same_rows(markov.per_window_steps(counts), apart)
    same_rows(markov.edges(once), apart)
    assert counts.count() < apart.count()
    raw = markov.removal_effects_raw(materialize(apart))
    same_rows(markov.removal_effects_raw(counts), raw)
    same_rows(markov.removal_effects_raw(counts, 4), raw)


def test_laid_out_visits_are_not_shuffled_again(spark):
    """Hot users are, and come back into the layout."""
    rows = materialize_by(nested_visits(spark).withColumn("run_date", F.to_date("conversion_visit_timestamp")).repartition(3, USER), [USER], 3)
    usual = journeys.touches_once(rows, "as_is", hot_rows=None)
    laid_out = journeys.touches_once(rows, "as_is", hot_rows=None, laid_out=True, layout=3)
    assert "Exchange" not in laid_out._jdf.queryExecution().executedPlan().toString()
    same_rows(journeys.per_window(laid_out), journeys.per_window(usual))
    hot = journeys.touches_once(rows, "as_is", hot_rows=5, laid_out=True, layout=3)
    same_rows(journeys.per_window(hot), journeys.per_window(usual))
    assert hot.rdd.getNumPartitions() == 3


def test_touches_are_ordered_and_kept_once(spark):
    rows = materialize(nested_visits(spark))
    once = journeys.touches_once(rows, "as_is", hot_rows=None)
    assert once.count() == rows.count()
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Generate" not in plan


def test_rolling_rows_are_shuffled_unexploded(spark):
    rows = materialize(visits(spark, [("u", f"2024-01-{d:02d} 01:00:00", "A", 1) for d in range(1, 20)], kind="Subscription"))
    rolled = windows.rolling_cohorts(rows.drop("conversion_window"))
    plan = models.with_credits(journeys.touches(rolled, "conversion_day", hot_rows=None))
    plan = plan._jdf.queryExecution().executedPlan().toString()
    # From the top: the dates are made after the only shuffle.
    assert plan.count("Exchange") == 1 and plan.index("Generate explode(run_dates") < plan.index("Exchange")


def test_credits_sum_to_conversions(spark):
    placed = journeys.touches(random_visits(spark), "as_is")
    steps = markov.edges(placed)
    credited = models.with_credits(markov.with_markov_credit(placed, markov.removal_effects_raw(steps)))
    sums = credited.groupBy(*JOURNEY).agg(
        F.max("conversion_value").alias("value"), *[F.sum(m).alias(m) for m in MODELS.values()]
    )
    for row in sums.collect():
        for model in MODELS.values():
            assert row[model] == pytest.approx(row["value"])


def test_long_journeys_continue_in_further_rows(spark):
    rows = [("u", f"2024-01-20 0{h}:00:00", "ABCDE"[h], int(h == 4)) for h in range(5)]
    scores = models.text_form(models.journey_scores(credits(spark, rows), list_touches=2))
    assert by(scores, "part", "channels_agg", "num_touchpoints") == {0: ("A > B", 5), 1: ("C > D", 5), 2: ("E", 5)}


def test_a_hot_journey_is_one_row_with_all_touches(spark):
    start = datetime(2024, 1, 20)
    rows = [("u", str(start + timedelta(seconds=i)), "A", int(i == 11_999)) for i in range(12_000)]
    credited = credits(spark, rows)
    stages = SimpleNamespace(credited=credited, scores=models.journey_scores(credited))
    assert [len(r.touches) for r in stages.scores.collect()] == [12_000]
    assert [r.num_touchpoints for r in _BUILD["num_touchpoints"](stages).collect()] == [12_000]


def test_look_back_counts_both_ends(spark):
    conversion = datetime(2024, 3, 31, 12)
    ages = [0, 30, 31, 32, 61, 62, 91, 92]
    base = visits(spark, [("u", str(conversion - timedelta(days=age)), "A", int(age == 0)) for age in ages], str(conversion))
    names = [c for c in windows.KEPT if c not in base.columns]
    full = base.select("*", F.lit("B2C").alias("b2b_b2c"), *[F.lit("x").alias(c) for c in names])
    rows = windows.conversion_windows(full, date(2024, 4, 1))
    got = by(
        rows.withColumn("age", F.date_diff("conversion_visit_timestamp", "attribution_visit_start_time")),
        "age", "conversion_windows",
    )
    assert {age: windows_[0] for age, windows_ in got.items()} == {
        0: [30, 60, 90], 30: [30, 60, 90], 31: [30, 60, 90], 32: [60, 90], 61: [60, 90], 62: [90], 91: [90],
    }
    assert windows.conversion_window(full, date(2024, 4, 1), 30).count() == 3
    # The conversion is too old for a run two weeks and two days later.
    assert windows.conversion_windows(full, date(2024, 4, 16)).count() == 0


def test_rolling_cohorts(spark):
    a = visits(spark, [("u", "2024-01-10 01:00:00", "A", 1)], "2024-01-10 01:00:00", "Subscription")
    b = visits(spark, [("u", "2024-01-11 01:00:00", "B", 0)], "2024-01-12 01:00:00", "Subscription")
    c = visits(spark, [("w", "2024-01-13 01:00:00", "C", 1)], "2024-01-13 01:00:00", "Trial")
    rolled = windows.rolling_cohorts(a.unionByName(b).unionByName(c).drop("conversion_window"), days=2)
    assert rolled.count() == 2  # rows are not repeated
    pairs = {(row.touchpoint, day.day) for row in rolled.collect() for day in row.run_dates}
    # Day 13 has a trial only, but is a cohort of its own; A is too old for it.
    assert pairs == {("A", 10), ("A", 12), ("B", 12), ("B", 13)}
    flags = by(journeys.touches(rolled, "conversion_day"), ["channel", "run_date"], "converting_visit")
    assert flags == {("A", date(2024, 1, 10)): (1,), ("A", date(2024, 1, 12)): (0,),
                     ("B", date(2024, 1, 12)): (1,), ("B", date(2024, 1, 13)): (0,)}


def test_only_conversions_of_the_run_dates_are_deduplicated_for_windows(spark, tmp_path):
    """The windows are those of all classified visits, without dropping copies of the other conversions first."""
    rows = []
    for i in range(240):
        kind = ("view", "signup", "purchase", "click")[i % 4] if i % 5 else None
        rows.append((i, at(f"2024-01-{1 + i % 30:02d} {i % 24:02d}:00:00"), i // 3 % 8 if i % 19 else None, kind, float(i)))
    events = spark.createDataFrame(rows + rows[:40], "event_id long, ts timestamp, user_id long, event_type string, value double")
    events.write.parquet(str(tmp_path / "events.parquet"))
    nations = spark.createDataFrame([(i, f"n{i}") for i in range(25)], "n_nationkey int, n_name string")
    nations.write.parquet(str(tmp_path / "nation.parquet"))
    stage = stages.Stages(spark, str(tmp_path))
    kept = materialize(stage.windowed)
    assert "classified" not in vars(stage)
    same_rows(kept, run_dates(windows.conversion_windows(stage.classified, stages.AS_OF), stages.AS_OF))
    assert 0 < kept.count() < stage.classified.count()


def test_windowed_visits_are_shuffled_once(spark, tmp_path, monkeypatch):
    """By user, in as many tasks as the rows ask for; products and values then need no shuffle of journeys by user."""
    rows = [(i, at(f"2024-01-{16 + i % 15:02d} {i % 24:02d}:00:00"), i % 7, ("view", "signup", "purchase")[i % 3], float(i)) for i in range(300)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double")
    events.write.parquet(str(tmp_path / "events.parquet"))
    nations = spark.createDataFrame([(i, f"n{i}") for i in range(25)], "n_nationkey int, n_name string")
    nations.write.parquet(str(tmp_path / "nation.parquet"))
    usual = stages.Stages(spark, str(tmp_path))
    assert usual.tasks is None
    split = stages.Stages(spark, str(tmp_path))
    monkeypatch.setattr(runtime, "LAYOUT_ROWS", 200)
    assert split.tasks > 4
    same_rows(split.windowed, usual.windowed)
    same_rows(split.placed, usual.placed)
    for stage in (usual, split):
        products = ltv.join_product(models.journeys(stage.touches), stage.windowed)
        assert "Exchange" not in products._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
    same_rows(split.averages, usual.averages)


def test_rolling_rows_are_exploded_into_as_many_tasks_as_they_ask_for(spark, monkeypatch):
    rows = [(f"u{u}", f"2024-01-{d:02d} 01:00:00", "AB"[d % 2], 1) for u in range(9) for d in range(1, 20)]
    rows = visits(spark, rows, kind="Subscription").withColumn("conversion_visit_timestamp", F.col("attribution_visit_start_time"))
    rolled = materialize(windows.rolling_cohorts(rows.drop("conversion_window")))
    usual = materialize(journeys.touches(rolled, "conversion_day"))
    monkeypatch.setattr(journeys, "TASK_ROWS", 200)
    split = journeys.touches(rolled, "conversion_day")
    assert usual.count() == 9 * 190 and split.rdd.getNumPartitions() == 9  # 1,710 rows, 171 before
    same_rows(usual, split)


def test_rolling_queries_drop_copies_of_their_type_only(spark, tmp_path):
    """They have the rows of all classified visits, days with conversions of another type included."""
    rows = []
    for i in range(240):
        kind = ("view", "signup", "purchase", "click")[i % 4] if i % 5 else None
        rows.append((i, at(f"2024-01-{1 + i % 30:02d} {i % 24:02d}:00:00"), i // 3 % 8 if i % 19 else None, kind, float(i)))
    events = spark.createDataFrame(rows + rows[:40], "event_id long, ts timestamp, user_id long, event_type string, value double")
    events.write.parquet(str(tmp_path / "events.parquet"))
    nations = spark.createDataFrame([(i, f"n{i}") for i in range(25)], "n_nationkey int, n_name string")
    nations.write.parquet(str(tmp_path / "nation.parquet"))
    stage = stages.Stages(spark, str(tmp_path))
    placed = materialize(queries.rolling_touches(stage))
    assert "classified" not in vars(stage)
    labelled = stage.classified.withColumn("touchpoint", labels.touchpoint_label())
    same_rows(placed, journeys.touches(windows.rolling_cohorts(labelled), "conversion_day"))
    days = {row.run_date for row in placed.select("run_date").distinct().collect()}
    own = stage.subscriptions.select(F.to_date("conversion_visit_timestamp").alias("d")).distinct().collect()
    assert len(days) > len({row.d for row in own})


def test_journeys_of_a_user_are_counted_before_the_shuffle(spark, monkeypatch):
    rows = [(f"u{u}", f"2024-01-{d:02d} 01:00:00", "A", 1) for u in ("", 1, "2_J:0") for d in range(1, 9)]
    rows = visits(spark, rows, kind="Subscription").withColumn("conversion_visit_timestamp", F.col("attribution_visit_start_time"))
    rows = rows.withColumn("user_guid", F.expr("if(user_guid = 'u', '', user_guid)"))
    rolled = materialize(windows.rolling_cohorts(rows.drop("conversion_window")))
    monkeypatch.setattr(queries, "rolling_touches", lambda s: journeys.touches(rolled, "conversion_day", hot_rows=None))
    counted = queries.user_from_journey_id(None)
    # Each day of the eight is the one journey of a user that ends on it; the empty user has no text.
    assert by(counted, "run_date", "journeys", "first_journeys", "users")[date(2024, 1, 5)] == (2, 2, 2)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert not any("journey_no" in line for line in plan.splitlines() if "Exchange" in line)
    # Of the exchanges, that of the rows is the last: what is between it and the distinct journeys needs none.
    assert "journey_no" not in plan.split("Exchange")[1].split("\n")[0]
