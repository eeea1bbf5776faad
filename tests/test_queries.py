"""Registered queries against their SQL. Set ALL_QUERIES=1 for every one of them."""

import os

import pytest
from compare import difference, duck

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
SOME = [
    "classify_processed_channel", "classify_static_platform", "conversion_window_30", "channel_totals", "journey_scores",
    "markov_transitions", "removal_effect_raw", "rolling_cohort_90", "rolling_cohort_90_effects", "mart_removal_ltv",
    "median_days_to_convert", "daily_purchases", "daily_subscription_events", "full_run",
]
SQL = entry.oracle_sql()
NAMES = list(SQL) if os.environ.get("ALL_QUERIES") else SOME


@pytest.fixture(scope="module")
def connection():
    if not os.path.isdir(FOLDER):
        pytest.skip("no benchmark tables")
    return duck(FOLDER)


def test_every_query_has_sql():
    own = {name for name in entry.queries() if name != "pipeline" and not name.startswith("op")}
    assert own == {name for name in SQL if name in own} and set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    assert difference(spark, connection, FOLDER, entry.queries()[name], SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
