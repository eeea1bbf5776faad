"""Labels worked out by hand, source by source."""

from datetime import date, datetime

import pytest
from helpers import by

from journeylens.operators import classify as c
from journeylens.runtime import materialize, scratch_path

COLUMNS = (
    "visit_traffic_source_type string, visit_traffic_source_name string, segment_name string, "
    "segment_campaign_name string, segment_campaign_grouping string, segment_channel string, is_campaign_landing boolean"
)
ON, OFF = True, False
SALE = "Paid Media_H2 2023 Sale_"

# (type, name, segment, campaign, grouping, segment channel, landing) ->
# (media type, processed channel, processed platform, static channel, static platform, channel, platform)
CASES = [
    (("Search", "Google Organic", None, None, None, None, None),
     ("organic", None, None, None, "google", "search", "google")),
    (("Social_Free", "x", None, None, None, None, None),
     ("organic", "social_free", None, "social free", None, "social_free", "social_free")),
    (("Direct", "Direct", "Direct", "organic push", None, None, ON),
     ("organic", None, None, None, None, "direct", "direct")),
    (("Direct", "Direct", "Direct", None, "Organic growth", None, OFF),
     ("direct", None, None, None, None, "direct", "direct")),
    (("Search", "Bing", "other", None, None, None, OFF),
     ("organic", "search", "bing", None, None, "search", "bing")),
    (("Search", "Bing", None, None, None, None, OFF),
     ("search", None, None, None, None, "search", "search")),
    (("Referral", "paid.outbrain.com", None, None, None, None, None),
     ("referral", None, None, None, "outbrain", "referral", "outbrain")),
    (("Referral", "paid.outbrain.com/x", None, None, None, None, None),
     ("paid media", None, None, None, "outbrain", "referral", "outbrain")),
    (("Referral", "X - SEM - Y", None, None, None, None, None),
     ("paid media", "ppc", "search", None, None, "ppc", "search")),
    (("Performance Max", "y", None, None, None, None, None),
     ("paid media", None, None, None, None, "performance max", "performance max")),
    (("Other", "PMAX sale", None, None, None, None, None),
     ("paid media", "pmax", None, None, None, "pmax", "pmax")),
    (("x", "Core Subs_Other_Newsletter_UK_H2 Sale 2024_9-2024_Mill Media Sheffield", None, None, None, None, None),
     ("paid media", None, None, "newsletter", "newsletter", "newsletter", "newsletter")),
    (("Meta CAPI", "y", None, None, None, None, None),
     ("capi", "meta capi", "capi", None, None, "meta capi", "capi")),
    (("Barrier", "Page", None, None, None, None, None),
     ("barrier", "barrier", "barrier", None, None, "barrier", "barrier")),
    (("FT Print", "Page", None, None, None, None, None),
     ("ft print", "ft print", "ft print", None, None, "ft print", "ft print")),
    (("x", "y", "y", None, None, "SEM", ON),
     ("paid media", "ppc", "search", None, None, "ppc", "search")),
    (("x", "y", "y", "Paid Media - SEM", None, None, ON),
     ("paid media", "ppc", "search", None, None, "ppc", "search")),
    (("x", "y", "y", "paid media - sem", None, None, ON),
     ("paid media", None, None, None, None, "x", "x")),
    (("x", "y", "y", "Paid Media - Social", None, None, ON),
     ("paid media", "paid social", None, None, None, "paid social", "paid social")),
    (("Unclassified Referrer", "a.org", "b", None, None, None, OFF),
     ("Unclassified Referrer", "unclassified referrer", "unclassified referrer", None, None,
      "unclassified referrer", "unclassified referrer")),
    (("Unclassified Referrer", "outbrain.org", "b", None, None, None, OFF),
     ("Unclassified Referrer", "unclassified referrer", None, None, "outbrain", "unclassified referrer", "outbrain")),
    (("Push Notification", "App Push", "b", None, None, None, OFF),
     ("ft app", "push notification", "push notification", None, None, "push notification", "push notification")),
    (("Facebook", "Social", None, None, None, None, None),
     ("unclassified social", None, None, "unclassified social", "facebook", "unclassified social", "facebook")),
    (("External Display", "My Search", None, None, None, None, None),
     ("external display", "ppc", None, "external display", "search", "ppc", "search")),
    (("External Display", "banner", None, None, None, None, None),
     ("external display", None, None, "external display", None, "external display", "external display")),
    (("x", "paid media FB one", None, None, None, None, None),
     ("paid media", "paid social", None, None, "facebook", "paid social", "facebook")),
    (("x", SALE + "LinkedIn_a", None, None, None, None, None),
     ("paid media", "paid social", None, None, "linkedin", "paid social", "linkedin")),
    (("x", SALE + "Display_a", None, None, None, None, None),
     ("paid media", "display", None, None, "display", "display", "display")),
    (("x", SALE + "Search_a", None, None, None, None, None),
     ("paid media", "ppc", "search", None, None, "ppc", "search")),
    (("x", SALE + "Landing Page_a PMAX", SALE + "Landing Page_a PMAX", None, None, None, ON),
     ("paid media", "pmax", "search", None, None, "pmax", "search")),
    (("x", "Paid Media_Video_YouTube_UK_a_b", None, None, None, None, None),
     ("paid media", "video", "youtube", None, None, "video", "youtube")),
    (("x", "Paid Media_Video_YouTube_UK_a", None, None, None, None, None),
     ("paid media", None, None, "video", "youtube", "video", "youtube")),
    (("x", "print_Poster_Tube_UK_a_b", None, None, None, None, None),
     ("x", "poster", None, None, None, "poster", "poster")),
    (("Marketing Email", "Weekly Newsletter", None, None, None, None, None),
     ("marketing email", "email", None, None, "newsletter", "email", "newsletter")),
    (("FT Product", "y", None, None, None, None, None),
     ("ft product", "ft product", None, None, None, "ft product", "ft product")),
    (("x", "y", "y", "promo", None, "Marketing Email", ON),
     ("x", "marketing email", None, None, None, "marketing email", "marketing email")),
    (("Affiliates", "Shop", "Shop", "promo", None, "z", ON),
     ("affiliates", "affiliates", "affiliates", None, None, "affiliates", "affiliates")),
    (("Affiliates", "Shop", "Shop", "promo", None, "z", OFF),
     ("affiliates", "affiliates", "affiliates", None, None, "affiliates", "affiliates")),
    (("Affiliates", "Shop", "other", "promo", None, "z", OFF),
     ("affiliates", "affiliates", "affiliates", None, None, "affiliates", "affiliates")),
    (("Social Media", "Twitter", "b", None, None, None, OFF),
     ("organic", "social free", "twitter", None, None, "social free", "twitter")),
    (("News Aggregator", "Flip", "b", None, None, None, OFF),
     ("news aggregator", "news aggregator", "flip", None, None, "news aggregator", "flip")),
    (("Direct", "Direct", "b", None, None, None, OFF),
     ("direct", "Direct", "direct", None, None, "Direct", "direct")),
    (("University", "MIT", "b", None, None, None, OFF),
     ("university", "university", "MIT", None, None, "university", "MIT")),
    (("External Print Ad", "y", "b", None, None, None, OFF),
     ("external print ad", "external print ad", "external print ad", None, None, "external print ad", "external print ad")),
    (("Internal Print Ad", "y", None, None, None, None, OFF),
     ("internal print ad", None, None, "internal print ad", None, "internal print ad", "internal print ad")),
    (("Sister Site", "y", "b", None, None, None, OFF),
     ("sister site", "sister site", "sister site", None, None, "sister site", "sister site")),
    (("Chat", "Microsoft Teams", "b", None, None, None, OFF),
     ("chat", None, "microsoft teams", None, None, "chat", "microsoft teams")),
    (("x", "Print Sale", None, None, None, None, None), ("x", None, None, None, None, "x", "x")),
    (("x", "Big Print Sale", None, None, None, None, None), ("x", None, None, "print", None, "print", "print")),
    (("FT App", "my app", None, None, None, None, None), ("ft app", None, None, None, "ft app", "ft app", "ft app")),
    (("FT App", "whatsapp", None, None, None, None, None), ("ft app", None, None, None, "whatsapp", "ft app", "whatsapp")),
    (("FT App", "y", "y", "the app", None, None, ON), ("ft app", None, None, "ft app", "ft app", "ft app", "ft app")),
    (("x", "y", "y", "an email", None, "Other", ON), ("x", None, None, "other email", None, "other email", "other email")),
    (("x", "y", "y", "z", None, "Other", ON), ("x", None, None, None, None, "other", "x")),
    (("x", "direct email to email", None, None, None, None, None),
     ("x", None, None, "direct email", "email", "direct email", "email")),
    (("x", "google dem gen", None, None, None, None, None),
     ("x", None, None, None, "google dem gen", "x", "google dem gen")),
    (("x", "y", "y", "google dem gen", None, None, ON), ("x", None, None, None, "google", "x", "google")),
    (("x", "siriusxm ad", None, None, None, None, None), ("x", None, None, None, "siriusxm", "x", "siriusxm")),
    (("x", "siriusxm", None, None, None, None, None), ("x", None, None, None, None, "x", "x")),
    (("x", "a sem b", None, None, None, None, None), ("x", None, "search", None, None, "x", "search")),
    (("Outbrain ads", "y", None, None, None, None, None), ("outbrain ads", None, "outbrain", None, None, "outbrain ads", "outbrain")),
    ((None, None, None, None, None, None, None), (None, None, None, None, None, None, None)),
]


def test_hand_worked_labels(spark):
    sources = spark.createDataFrame([(*case, str(i)) for i, (case, _) in enumerate(CASES)], COLUMNS + ", id string")
    got = by(c.label_sources(sources), "id", *c.LABELS)
    for i, (case, expected) in enumerate(CASES):
        assert got[str(i)] == expected, case


def test_rare_sources_and_copies_are_dropped(spark):
    schema = COLUMNS + ", b2b_b2c string, visit int"
    rows = [(kind, "n", None, None, None, None, None, "B2C", visit) for kind, n in (("ten", 10), ("nine", 9), (None, 11)) for visit in range(n)]
    rows += [("nine", "n", None, None, None, None, None, "B2B", 1), ("ten", "n", None, None, None, None, None, "B2C", 0)]
    visits = spark.createDataFrame(rows, schema)
    assert by(c.classify(visits).groupBy("visit_traffic_source_type").count(), "visit_traffic_source_type", "count") == {
        "ten": (10,), None: (11,),
    }
    frequent = c.frequent_sources(visits)
    assert {(r.visit_traffic_source_type, r.source_frequency) for r in frequent.collect()} == {("ten", 11), (None, 11)}
    assert frequent.count() == 22


def test_copies_are_dropped_within_a_layout(spark, monkeypatch):
    """One shuffle by the columns asked for, in which sources go by their number; too many sources go as they are."""
    schema = COLUMNS + ", b2b_b2c string, user string, visit int"
    rows = [(f"t{i % 3}", f"paid {i % 7}" if i % 5 else None, None, None, None, None, i % 2 == 0, "B2C", f"u{i % 4}" if i % 9 else None, i % 60) for i in range(420)]
    visits = materialize(spark.createDataFrame(rows + [(*rows[0][:7], "B2B", "u1", 1)], schema))
    usual = sorted(map(repr, c.classify(visits).collect()))
    laid_out = c.classify(visits, by=["user"], tasks=3)
    plan = laid_out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("BroadcastExchange") == 1
    assert "segment_name" not in next(line for line in plan.splitlines()[plan[: plan.index("Exchange hash")].count("\n") + 1 :])
    assert sorted(map(repr, laid_out.collect())) == usual and len(usual) == len(set(rows)) < len(rows)
    monkeypatch.setattr(c, "FEW_SOURCES", 1)
    assert sorted(map(repr, c.classify(visits, by=["user"], tasks=3).collect())) == usual
    assert sorted(map(repr, c.classify(visits).collect())) == usual


def test_lookup_is_exact_beyond_a_broadcast(spark):
    schema = COLUMNS + ", b2b_b2c string, visit int"
    rows = [(f"t{i % 3}", f"paid {i % 7}" if i % 5 else None, None, None, None, None, i % 2 == 0, "B2C", i) for i in range(200)]
    visits = spark.createDataFrame(rows, schema)
    broadcast = sorted(map(repr, c.classify(visits).collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(repr, c.classify(visits).collect())) == broadcast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(broadcast) == 200


def test_daily_source_counts_equal_the_full_pass(spark):
    """Five days refreshed one after the other, late rows of the day before and rows without a time included."""
    schema = COLUMNS + ", b2b_b2c string, attribution_visit_start_time timestamp, seen int"
    rows = []
    for i in range(300):
        day = i % 5 + 1
        time = None if i % 29 == 0 else datetime(2024, 1, day, 23, 59, 59) if i % 7 else datetime(2024, 1, day)
        seen = day + (i % 4 == 0)
        rows.append((f"t{i % 9}" if i % 11 else None, f"n{i % 3}", None, None, None, None, None, "B2C" if i % 13 else "B2B", time, seen))
    visits = spark.createDataFrame(rows, schema)
    path = scratch_path(spark)
    for day in range(1, 7):
        known = visits.filter(f"seen <= {day}").drop("seen")
        first = None if day == 1 else date(2024, 1, day - 1)
        counts = c.refresh_sources(known, path, first, date(2024, 1, day))
        for least in (1, 20):
            full, kept = c.frequent_sources(known, least), c.frequent_sources(known, least, counts)
            assert sorted(map(repr, kept.collect())) == sorted(map(repr, full.collect()))
    assert counts.agg({"rows_": "sum"}).first()[0] == visits.filter("b2b_b2c = 'B2C'").count()
    empty = c.refresh_sources(known.limit(0), scratch_path(spark))
    assert empty.count() == 0 and c.frequent_sources(known.limit(0), counts=empty).count() == 0


@pytest.mark.parametrize("chain", [c.MEDIA_TYPE, c.CHANNEL, c.PLATFORM, c.STATIC_CHANNEL, c.STATIC_PLATFORM])
def test_no_rule_repeats_an_earlier_one(chain):
    seen = []
    for alternatives, _ in chain:
        for tests in alternatives:
            key = frozenset(map(tuple, tests))
            assert not any(earlier <= key for earlier in seen), tests
        seen += [frozenset(map(tuple, tests)) for tests in alternatives]
