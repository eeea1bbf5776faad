"""Labels, app events, timing, values, sinks, checks and the whole run on small fixtures."""

from datetime import date
from types import SimpleNamespace

import pytest
from helpers import at, by, same_rows, visits
from pyspark.sql import functions as F

from journeylens import checks
from journeylens.functions import fields, labels
from journeylens.names import USER, VISIT_TS
from journeylens.operators import appevents, journeys, ltv, models, timing
from journeylens.operators import ltv as value_columns
from journeylens.operators import skew
from journeylens.plans import queries
from journeylens.plans.attribution import attribute, reported_type, run, run_median_history, run_rolling
from journeylens.runtime import materialize, scratch_path, scratch_root
from journeylens.sinks import tables as sinks
from journeylens.sources import tables

PARTS = ["media_type", "media_channel", "platform", "channel_name", "channel_device_type", "geo_country_name",
         "user_cohort_primary", "product_type"]


def test_parsing_inverts_the_touchpoint(spark):
    base = spark.createDataFrame(
        [(1, "organic", "search", "google", "A | B", "mobile", "GB", "new", "Digital", "Premium Annual"),
         (2, "organic", "search", "google", None, "mobile", "GB", "new", "Digital", "Premium Annual")],
        "id int, media_type string, channel string, platform string, visit_traffic_source_name string, visit_device_type string, "
        "geo_country_name string, user_cohort_primary string, product_name string, b2c_product_name_and_term string",
    )
    texts = base.select("id", labels.touchpoint_label().alias("channels"))
    assert by(texts, "id", "channels") == {
        1: ("organic | search | google | A | B | mobile | GB | new | Premium Annual",), 2: (None,),
    }
    parsed = by(labels.parse_touchpoint(texts), "id", *PARTS)
    assert parsed[1] == ("organic", "search", "google", "A | B", "mobile", "GB", "new", "Premium Annual")
    dash = labels.parse_touchpoint(spark.createDataFrame([(1, " - ")], "id int, channels string"))
    assert by(dash, "id", *PARTS) == {1: ("-",) * 8}
    short = labels.parse_touchpoint(spark.createDataFrame([(1, "a | b")], "id int, channels string"))
    assert by(short, "id", "media_channel", "platform", "product_type", "geo_country_name") == {1: ("b", None, "b", None)}


@pytest.mark.parametrize("name, term, label", [
    ("The E-Paper", None, "Digital Edition"), ("FT EDIT", None, "FT Edit"), ("Newspaper - Weekend only", None, "Newspaper"),
    ("FT Weekend", "Premium Monthly", "FT Weekend"), ("x", "premium MONTHLY", "Premium Monthly"), (None, None, "Others"),
])
def test_product_label(spark, name, term, label):
    df = spark.createDataFrame([(name, term)], "product_name string, b2c_product_name_and_term string")
    assert df.select(labels.product_label()).first()[0] == label


def test_json_fields_names_and_ids(spark):
    df = spark.createDataFrame([('{"a": "7", "b": 1.5, "c": "true"}',), ('{"a": "x"',), (None,)], "j string")
    kinds = {"a": "int", "b": "float", "c": "bool", "d": "string"}
    rows = [tuple(r)[1:] for r in fields.json_fields(df, "j", kinds).collect()]
    assert rows == [(7, 1.5, True, None), (None,) * 4, (None,) * 4]
    bad = spark.createDataFrame([('{"a": "x"}',)], "j string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        fields.json_fields(bad, "j", {"a": "int"}, strict=True).collect()
    assert fields.sanitized_name("position_based_0.3_0.3_0.4_heuristic") == "position_based_heuristic"
    ids = spark.createDataFrame([("id:a_b_J:0",), ("id:u_J:12",), ("none",)], "j string")
    users = by(ids.select("j", fields.user_of_journey(F.col("j")).alias("u"),
                          fields.user_of_journey(F.col("j"), first_only=True).alias("f")), "j", "u", "f")
    assert users == {"id:a_b_J:0": ("a_b", "a_b"), "id:u_J:12": ("u", None), "none": (None, None)}


def app_rows(spark, rows):
    data = [(name, value, source, platform, at("2024-01-02 03:00:00"), kind, app, user) for name, value, source, platform, kind, app, user in rows]
    df = spark.createDataFrame(data, "event_name string, event_value string, media_source string, platform string, "
                                     "event_time timestamp, campaign_type string, app_id string, customer_user_id string")
    return df.select("*", *[F.lit("x").alias(c) for c in ("campaign", "region", "country_code", "appsflyer_id", "app_name")],
                     F.col("event_time").alias("install_time"))


def test_app_events(spark):
    body = '{"AFEventParamRevenue": "%s", "AFEventParamContentType": "%s"}'
    events = app_rows(spark, [
        ("af_purchase", body % ("10", "aXMYTz"), "QR_code", "ios", "organic", "id6449040684", "u1"),
        ("af_purchase", body % ("5", "p1y_standard"), "Email", "ios", "paid", "com.ft.news", "u1"),
        ("af_purchase", body % ("no", "zz"), "other", "android", "organic", "x", "u2"),
        ("install", None, "web_to_app", "ios", "paid", "id6449040684", "u1"),
        ("install", None, "web_to_app", "ios", "paid", "id6449040684", "u1"),
        ("af_barrier_view", None, "Apple Search Ads", "ios", "paid", "id1574510369", "u3"),
        ("select_package", None, "googleadwords_int", "ios", "paid", "id1574510369", "u3"),
        ("af_purchase_refund", '{"af_revenue": 3, "af_currency": "GBP"}', "x", "ios", "paid", "id6449040684", "u3"),
    ])
    bought = by(appevents.purchases(events), "product_id", "revenue", "purchase_type", "app_group", "channel_category")
    assert bought == {
        "aXMYTz": (10.0, "monthly_trial", "FT Digital Edition", "QR_code"),
        "p1y_standard": (5.0, "annual standard", "Main App", "Email_onboarding"),
        "zz": (None, "not identified", "Other", "Google_play_organic"),
    }
    assert by(appevents.daily_installs(events), "app_group", "installs", "unique_user_installs", "channel_category") == {
        "Digital Edition": (2, 1, "Onsite"),
    }
    assert by(appevents.engagement(events), "event_name", "channel_category", "app_group") == {
        "af_barrier_view": ("ASA_paid", "FT Edit"), "select_package": ("ACi/Ace_paid", "FT Edit"),
    }
    assert by(appevents.subscription_events(events), "event_name", "revenue", "currency", "app_group") == {
        "af_purchase_refund": (3.0, "GBP", "Digital Edition"),
    }


def test_median_days(spark):
    rows = [("a", "2024-01-17 13:00:00", "A", 0), ("a", "2024-01-20 12:00:00", "A", 1),   # 2 whole days
            ("b", "2024-01-15 12:00:00", "A", 0), ("b", "2024-01-20 12:00:00", "A", 1),   # 5
            ("c", "2024-01-20 12:00:00", "A", 1)]                                       # no first visit
    placed = journeys.touches(visits(spark, rows))
    assert by(timing.median_days(placed), "stage", "median_days") == {"trial": (3.5,)}
    none = journeys.touches(visits(spark, rows[-1:]))
    assert by(timing.median_days(none), "stage", "median_days") == {"trial": (None,)}


def test_median_days_by_date_weighs_rows(spark):
    rows = [("a", "2024-01-18 23:00:00", "A", 0), ("a", "2024-01-20 01:00:00", "A", 1), ("a", "2024-01-20 02:00:00", "A", 1),
            ("b", "2024-01-10 00:00:00", "A", 0), ("b", "2024-01-20 01:00:00", "A", 1),
            ("c", "2024-01-20 01:00:00", "A", 1), ("d", "2024-01-21 01:00:00", "A", 1)]
    got = by(timing.median_days_by_date(visits(spark, rows)), "run_date", "median_days")
    assert got == {date(2024, 1, 20): (2.0,), date(2024, 1, 21): (None,)}


def test_latest_row(spark):
    rows = visits(spark, [("a", "2024-01-18 23:00:00", "A", 0), ("a", "2024-01-19 23:00:00", "B", 0)])
    assert by(timing.latest_per_user(rows, ["touchpoint"], [VISIT_TS]), USER, "touchpoint") == {"a": ("B",)}


def with_product(df, product=1):
    return df.withColumn(ltv.PRODUCT, F.lit(product).cast("long"))


def orders(spark, rows):
    return spark.createDataFrame([(u, v, at(t), p) for u, v, t, p in rows],
                                 "user_guid string, ltv_acquisition_capped_12m double, product_order_timestamp timestamp, product_arrangement_id long")


def test_values_per_channel(spark):
    rows = with_product(visits(spark, [("u", "2024-01-20 01:00:00", "A", 0), ("u", "2024-01-20 02:00:00", "B", 0), ("u", "2024-01-20 03:00:00", "A", 1)]))
    lone = with_product(visits(spark, [("w", "2024-01-20 03:00:00", "C", 1)]), 2)
    rows = rows.unionByName(lone)
    value = orders(spark, [("u", 10.0, "2024-01-20 09:00:00", 1), ("u", 20.0, "2024-01-20 10:00:00", 1), ("u", 9.0, "2024-01-21", 1)])
    results = attribute(rows, value)
    credit = by(models.journey_scores(models.with_credits(journeys.touches(rows))), USER, "num_touchpoints")
    assert credit == {"u": (3,), "w": (1,)}
    effects = by(results.removal_effects, "channel", "removal_effect", "average_ltv")
    # Without A only w converts; without B, half of the walks from A still do. Effects 0.5, 0.25, 0.5.
    assert effects["A"] == (pytest.approx(40), pytest.approx(6.0))
    assert effects["B"] == (pytest.approx(20), pytest.approx(3.0))
    assert effects["C"][1] is None
    journeys_ = results.user_journeys.filter("user_guid = 'u'").orderBy(ltv.LTV).collect()
    assert [r[ltv.LTV] for r in journeys_] == [10.0, 20.0]
    assert [t.ltv for t in journeys_[0].removal_effect_ltv] == [pytest.approx(x) for x in (4, 2, 4)]
    assert results.user_journeys.count() == 3


def test_mean_ltv_and_text_forms(spark):
    value = orders(spark, [("u", 10.0, "2024-01-20", 1), ("u", 20.0, "2024-01-20", 1), ("u", None, "2024-01-20", 1), (None, 5.0, "2024-01-20", 1)])
    assert by(ltv.mean_ltv(value), USER, ltv.LTV) == {"u": (15.0,)}
    texts = spark.createDataFrame([(1, "A > B", "0.25 > 0.75", 4.0), (2, "A", "0.5 > 0.5", 4.0), (3, "A", "x", 4.0), (4, "A", None, 4.0)],
                                  "id int, c string, s string, v double")
    zipped = by(texts.select("id", ltv.zip_effect_ltv(F.col("c"), F.col("s"), F.col("v")).alias("z")), "id", "z")
    assert [tuple(p) for p in zipped[1][0]] == [("A", 1.0), ("B", 3.0)]
    assert zipped[2] == zipped[3] == zipped[4] == (None,)
    exploded = ltv.explode_channel_ltv(spark.createDataFrame([("A: 1.5 > B: nan? > C: D: 2",), (None,)], "removal_effect_ltv string"))
    assert by(exploded, "channel", "ltv") == {"A": (1.5,), "B": (None,), "C": (None,)}


def test_date_filters_reach_the_scan(spark):
    rows = materialize(visits(spark, [("a", "2024-01-18", "A", 0)]))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = tables.run_dates(rows, date(2024, 1, 31))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(conversion_visit_timestamp,2024-01-16" in plan
    assert "LessThan(conversion_visit_timestamp,2024-01-31" in plan
    assert tables.run_dates(rows, date(2024, 1, 21)).count() == 1
    assert tables.run_dates(rows, date(2024, 1, 20)).count() == 0


def test_journey_plan_has_one_shuffle(spark):
    rows = materialize(visits(spark, [("a", "2024-01-18", "A", 0)]).withColumn("conversion_windows", F.expr("array(30, 60)")).drop("conversion_window"))
    plan = models.with_credits(journeys.touches(rows, hot_rows=None))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "ArrowEvalPython" not in plan


def test_sinks(spark):
    table = spark.createDataFrame([(date(2024, 1, d), k, 30, v) for d, k, v in ((1, "Trial", 1), (1, "Subscription", 2), (2, "Trial", 3))],
                                  "run_date date, conversion_type string, conversion_window int, x int")
    path = scratch_path(spark)
    sinks.replace_cohorts(table, path)
    sinks.replace_cohorts(table, path)
    same_rows(spark.read.parquet(path), table)
    sinks.replace_cohorts(table.filter("x = 1").withColumn("x", F.lit(10)), path)
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [2, 3, 10]
    days = scratch_path(spark)
    sinks.replace_days(table, days)
    sinks.replace_days(table.filter("x = 1"), days)
    assert sorted(r.x for r in spark.read.parquet(days).collect()) == [1, 3]
    sinks.append(table, days)
    assert spark.read.parquet(days).count() == 5
    sinks.truncate(table.filter("x = 3"), days)
    assert [r.x for r in spark.read.parquet(days).collect()] == [3]
    assert not sinks.skip_empty(table.filter("x > 9"), scratch_path(spark))


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("b", 2)], "k string, n int")
    report = checks.report([checks.not_null(df, ["k", "n"]), checks.accepted_values(df, "k", ["a"]), checks.unique(df, "n")])
    assert by(report, "rule", "violations") == {"not_null:k": (1,), "not_null:n": (0,), "accepted_values:k": (1,), "unique:n": (1,)}
    with pytest.raises(ValueError, match="unique:n: 1"):
        checks.require(report)


def test_registrations_are_renamed(spark):
    df = spark.createDataFrame([("registration",), ("Trial",)], "conversion_type string")
    assert sorted(r[0] for r in reported_type(df).collect()) == ["Registration", "Trial"]


def test_scratch_is_the_folder_of_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == configured.rstrip("/") if configured else scratch_root(spark)


def daily_visits(spark, kind="Trial"):
    users = []
    for u in range(12):
        users += [(f"u{u}", "2024-01-19 01:00:00", None, 0), (f"u{u}", "2024-01-20 12:00:00", None, 1)]
    base = with_product(visits(spark, users, kind=kind).drop("touchpoint", "conversion_window"))
    constant = {"b2b_b2c": "B2C", "visit_traffic_source_type": "Search", "visit_traffic_source_name": "Bing",
                "segment_name": "s", "segment_campaign_name": "c", "segment_campaign_grouping": "g", "segment_channel": "h",
                "visit_device_type": "mobile", "geo_country_name": "GB", "product_name": "FT Weekend", "user_cohort_primary": "new",
                "b2c_product_type": "x", "b2c_product_name_and_term": "y"}
    return base.select("*", F.lit(False).alias("is_campaign_landing"), *[F.lit(v).alias(k) for k, v in constant.items()])


def test_daily_run_writes_all_tables_twice_alike(spark):
    rows = daily_visits(spark)
    path = scratch_path(spark)
    value = orders(spark, [("u1", 8.0, "2024-01-20", 1)])
    paths = run(rows, value, date(2024, 1, 31), path)
    first = {name: spark.read.parquet(p).collect() for name, p in paths.items()}
    run(rows, value, date(2024, 1, 31), path)
    for name, p in paths.items():
        assert sorted(map(repr, spark.read.parquet(p).collect())) == sorted(map(repr, first[name])), name
    mart = by(spark.read.parquet(paths["mart_removal_ltv"]), "conversion_window", "channels", "cleaned_media_channel", "average_ltv")
    touchpoint = "organic | search | bing | Bing | mobile | GB | new | FT Weekend"
    assert mart == {w: (touchpoint, "organic search", 4.0) for w in (30, 60, 90)}


def test_run_arguments(spark):
    rows = daily_visits(spark).unionByName(daily_visits(spark, "Subscription")).withColumn("is_app_conversion", F.lit(True))
    value = orders(spark, [("u1", 8.0, "2024-01-20", 1), ("u1", 4.0, "2024-01-20", 1)])
    path = scratch_path(spark)
    # Forty days later only a back-fill reaches the conversions.
    nothing = run(rows, value, date(2024, 2, 29), f"{path}/a")["channel_level"]
    assert spark.read.schema("channels string").parquet(nothing).count() == 0
    options = {"days": 45, "types": ("Trial",), "windows": {30: 31}, "rule": "last_visit_only"}
    paths = run(rows, value, date(2024, 2, 29), f"{path}/b", extra=("is_app_conversion",), mean_values=True, **options)
    journeys_ = spark.read.parquet(paths["user_journeys"])
    assert {(r.conversion_type, r.conversion_window) for r in journeys_.collect()} == {("Trial", 30)}
    touchpoint = "organic | search | bing | Bing | mobile | GB | new | FT Weekend"
    row = journeys_.filter("user_guid = 'u1'").collect()
    # One row: the two values of the order count as their mean.
    assert [(r.channels_agg, r.is_app_conversion, r[value_columns.LTV]) for r in row] == [(f"{touchpoint} > {touchpoint}", True, 6.0)]
    assert row[0].attribution_last_click_heuristic == "0.000000 > 1.000000"


def test_a_broken_rule_stops_the_run_before_anything_is_replaced(spark):
    path = scratch_path(spark)
    value = orders(spark, [("u1", 8.0, "2024-01-20", 1)])
    paths = run(daily_visits(spark), value, date(2024, 1, 31), path)
    before = {name: sorted(map(repr, spark.read.parquet(p).collect())) for name, p in paths.items()}
    both = daily_visits(spark).unionByName(daily_visits(spark, "Renewal"))
    with pytest.raises(ValueError, match="accepted_values:conversion_type"):
        run(both, value, date(2024, 1, 31), path)
    assert before == {name: sorted(map(repr, spark.read.parquet(p).collect())) for name, p in paths.items()}


def test_rolling_run_writes_four_tables(spark):
    path = scratch_path(spark)
    paths = run_rolling(daily_visits(spark, "Subscription"), path)
    run_rolling(daily_visits(spark, "Subscription"), path)
    rows = {name: spark.read.parquet(p) for name, p in paths.items()}
    assert rows["rolling_channel_level"].count() == 1 and rows["rolling_user_journeys"].count() == 24
    effects = rows["rolling_removal_effects"].collect()
    assert [(str(r.run_date), r.removal_effect) for r in effects] == [("2024-01-20", 100.0)]
    assert {(r.source, r.destination) for r in rows["rolling_transitions"].collect()} == {
        ("(start)", effects[0].channel), (effects[0].channel, "(conversion)")
    }


def test_median_history_is_replaced_whole(spark):
    path = scratch_path(spark)
    found = run_median_history(daily_visits(spark), date(2024, 1, 1), date(2024, 1, 31), path)
    assert [(r.stage, str(r.run_date), r.median_days) for r in spark.read.parquet(found).collect()] == [("trial", "2024-01-20", 1.0)]
    run_median_history(daily_visits(spark), date(2024, 2, 1), date(2024, 2, 2), path)
    assert spark.read.schema("stage string").parquet(found).count() == 0


def test_nested_json_values_are_null(spark):
    df = spark.createDataFrame([('{"a": {"b": 1}, "c": "{plain", "d": [1]}',), ('{"a": "[x]", "c": 2}',), ("{broken",)], "j string")
    flat = fields.json_fields(df, "j", {"a": "string", "c": "string", "d": "string"})
    assert [tuple(r)[1:] for r in flat.collect()] == [(None, "{plain", None), ("[x]", "2", None), (None, None, None)]


def test_rule_literals_keep_backslashes_and_quotes(spark):
    from journeylens.functions.rules import literal

    text = "a\\b'c"
    assert spark.range(1).selectExpr(f"{literal(text)} as t").first().t == text


def test_hot_keys_are_dealt_evenly_and_joined_alike(spark):
    """A third of the journeys has no product and so key 0; nulls meet nothing, orders repeat."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40)
    rows = materialize(spark.range(3000).select("id", key.cast("int").alias("k"), F.lit(date(2024, 1, 20)).alias("d")))
    other = spark.createDataFrame(
        [(k, date(2024, 1, 20), float(v)) for k in (0, 1, 2, 2, 99) for v in (1, 2)] + [(None, date(2024, 1, 20), 7.0)],
        "k int, d date, value double",
    )
    parts = skew.key_parts(rows, ["k", "d"], 100)
    assert [(r.k, r.parts_) for r in parts.collect()] == [(0, 11)]
    sizes = skew.deal(rows, ["k", "d"], parts, ["id"]).filter("k = 0").groupBy(skew.PART).count().collect()
    assert len(sizes) == 11 and max(r["count"] for r in sizes) < 2 * 1000 / 11
    same_rows(skew.salted_left_join(rows, other, ["k", "d"], ["id"], 100), rows.join(other, ["k", "d"], "left"))
    same_rows(skew.salted_left_join(rows, other, ["k", "d"], ["id"], 10_000), rows.join(other, ["k", "d"], "left"))


def test_rows_written_twice_are_made_once(spark):
    rows = spark.createDataFrame([(date(2024, 1, 20), "Trial", 30, "A", 1.0)] * 3, "run_date date, conversion_type string, conversion_window int, channels string, n double")
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    counted = rows.coalesce(1).mapInArrow(count, rows.schema)
    back = queries.written(SimpleNamespace(spark=spark), counted, sinks.append)
    assert back.count() == 6 and made.value == 3
