"""Visit classification: media type, channel and platform.

The labels are first-match chains over few prepared columns: lower-cased names and flags.
Names starting with `raw_` keep their case. Rules that an earlier rule always pre-empts are
left out: on a landing the segment name equals the source name, so tests on the segment name
repeat tests on the source name. The chains run over the distinct sources only.
"""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import contains, first_match
from ..names import VISIT_TS
from ..runtime import materialize
from ..sinks.tables import replace_partitions

MIN_SOURCE_FREQUENCY = 10
# Sources that are sent to every task, to stand for their columns by a number: some 600 bytes each, 30 MB at most.
FEW_SOURCES = 50_000

# ---- Fixed values: patterns, their order and labels -----------------------------------------

LANDING = ("landing", "holds")              # campaign landing, segment is the source
ELSEWHERE = ("elsewhere", "holds")          # no landing, segment differs from the source
SAME_SEGMENT = ("same_segment", "holds")    # no landing, segment is the source
NO_CHANNEL = ("processed_channel", "null")
NO_PLATFORM = ("processed_platform", "null")
TYPE = ("copy", "type")
NAME = ("copy", "name")

FIVE_PARTS = ("underscores_5", "holds")

PAID_SEARCH_NAMES = [
    [("name", "is", "sem")],
    [("name", "like", "%- sem -%")],
    [("name", "like", "%- sem-%")],
    [("name", "like", "%paid search%")],
    [("raw_name", "like", "Paid Media_H2 2023 Sale_Search_%")],
    [("raw_name", "like", "Paid Media_BAU_Search_%")],
    [("type", "is", "sem")],
]
UNCLASSIFIED_SOCIAL = ([[("raw_type", "is", "Facebook"), ("raw_name", "is", "Social")]], "unclassified social")
IN_APP = ("type", "like", "%ft app")
NOT_WHATSAPP = ("name", "unlike", "%whatsapp%")

MEDIA_TYPE = [
    ([[("name", "like", "%organic%")], [("type", "like", "%social_free%")]], "organic"),
    ([[LANDING, ("campaign", "like", "%organic%")], [LANDING, ("grouping", "like", "%organic%")]], "organic"),
    (
        [
            [ELSEWHERE, ("type", "like", "%search%")],
            [ELSEWHERE, ("type", "like", "%social free%")],
            [ELSEWHERE, ("type", "like", "%social media%")],
        ],
        "organic",
    ),
    (
        [
            [("name", "like", "%paid%"), ("name", "is not", "paid.outbrain.com")],
            [("name", "is", "sem")],
            [("type", "is", "sem")],
            [("name", "like", "%- sem -%")],
            [("name", "like", "%- sem-%")],
            [("name", "like", "%pmax%")],
            [("raw_name", "is", "Core Subs_Other_Newsletter_UK_H2 Sale 2024_9-2024_Mill Media Sheffield")],
            [("type", "like", "%pmax%")],
            [("type", "like", "%performance max%")],
        ],
        "paid media",
    ),
    *contains("type", ["capi"]),
    *contains("type", ["barrier", "external video", "ft_print"], TYPE),
    (
        [
            [LANDING, ("seg_channel", "is", "sem")],
            [LANDING, ("campaign", "like", "%paid campaigns%")],
            [LANDING, ("campaign", "like", "%paid media%")],
        ],
        "paid media",
    ),
    ([[ELSEWHERE, ("type", "like", "unclassified referrer%")]], ("copy", "raw_type")),
    ([[ELSEWHERE, ("type", "is", "push notification")]], "ft app"),
    UNCLASSIFIED_SOCIAL,
]

CHANNEL = [
    ([[("name", "like", "%pmax%")], [("name", "like", "%performance max%")]], "pmax"),
    (PAID_SEARCH_NAMES, "ppc"),
    ([[("name", "like", "%search%"), ("type", "like", "%external display%")]], "ppc"),
    *contains("type", ["capi"], TYPE),
    (
        [
            [("name", "is", "paid media - social")],
            [("name", "like", "%paid social%")],
            [("raw_name", "like", "Paid Media_H2 2023 Sale_LinkedIn_%")],
            [("raw_name", "like", "Paid Media_H2 2023 Sale_Facebook_%")],
            [("raw_name", "like", "Paid Media_H2 2023 Sale_Twitter_%")],
            [("name", "like", "%paid media%"), ("name", "like", "%fb%")],
        ],
        "paid social",
    ),
    ([[("raw_name", "like", "Paid Media_H2 2023 Sale_Display_%")]], "display"),
    (
        [
            [FIVE_PARTS, ("name", "like", "paid media_%")],
            [FIVE_PARTS, ("name", "like", "organic_%")],
            [FIVE_PARTS, ("name", "like", "print_%")],
        ],
        ("part", "raw_name", 1),
    ),
    *contains("type", ["email"]),
    *contains("type", ["barrier", "external video", "ft_print", "social_free"], TYPE),
    ([[("type", "is", "ft product")]], TYPE),
    ([[LANDING, ("seg_channel", "is", "sem")], [LANDING, ("raw_campaign", "is", "Paid Media - SEM")]], "ppc"),
    ([[LANDING, ("campaign", "is", "paid media - social")]], "paid social"),
    *contains("seg_channel", ["marketing email", "editorial email", "direct email"], None, LANDING),
    *contains("type", ["affiliates"], None, LANDING),
    *contains("type", ["search"], "search", ELSEWHERE),
    *contains("type", ["social media"], "social free", ELSEWHERE),
    *contains("type", ["push notification", "internal", "aggregator", "unclassified referrer"], TYPE, ELSEWHERE),
    *contains("type", ["direct"], ("copy", "raw_type"), ELSEWHERE),
    *contains(
        "type",
        ["news", "partner", "sister", "wiki", "blog", "university", "external", "affiliates"],
        TYPE,
        ELSEWHERE,
    ),
    *contains("type", ["affiliates"], TYPE, SAME_SEGMENT),
]

PLATFORM = [
    (PAID_SEARCH_NAMES, "search"),
    *contains("type", ["capi"]),
    (
        [[FIVE_PARTS, ("name", "like", "paid media_%")], [FIVE_PARTS, ("name", "like", "organic_%")]],
        ("part", "raw_name", 2),
    ),
    *contains("type", ["affiliates"], None, LANDING),
    *contains("type", ["ft print"], TYPE),
    ([[("name", "like", "% sem %")]], "search"),
    *contains("type", ["barrier", "external video"], TYPE),
    *contains("type", ["outbrain"]),
    (
        [
            [LANDING, ("seg_channel", "is", "sem")],
            [LANDING, ("raw_campaign", "is", "Paid Media - SEM")],
            [
                LANDING,
                ("raw_name", "like", "Paid Media_H2 2023 Sale_Landing Page_%"),
                ("raw_name", "like", "% PMAX"),
            ],
        ],
        "search",
    ),
    *contains("type", ["partnership", "push notification"], TYPE, ELSEWHERE),
    *contains("type", ["aggregator"], NAME, ELSEWHERE),
    *contains("type", ["internal"], TYPE, ELSEWHERE),
    *contains("type", ["search", "social media"], NAME, ELSEWHERE),
    *contains("type", ["direct"], TYPE, ELSEWHERE),
    *contains("type", ["unclassified referrer"], TYPE, ELSEWHERE, ("name", "unlike", "%outbrain%")),
    *contains("type", ["news", "partner"], NAME, ELSEWHERE),
    *contains("type", ["sister"], TYPE, ELSEWHERE),
    *contains("type", ["wiki", "blog"], NAME, ELSEWHERE),
    *contains("type", ["external print ad"], None, ELSEWHERE),
    *contains("type", ["university"], ("copy", "raw_name"), ELSEWHERE),
    *contains("type", ["external", "email", "affiliates"], TYPE, ELSEWHERE),
    *contains("name", ["microsoft teams"], NAME, ELSEWHERE),
    *contains("type", ["ft_print"], TYPE, ELSEWHERE),
    *contains("type", ["affiliates"], TYPE, SAME_SEGMENT),
]

# Words looked up in the source name, then in the campaign name of a landing.
CHANNEL_WORDS = [
    "onsite", "ppc", "pmax", "influencer", "article", "organic social", "paid social", "video", "affiliates",
]
LATE_CHANNEL_WORDS = ["newsletter", "display", "audio"]
MAIL_WORDS = ["marketing email", "editorial email", "direct email"]

STATIC_CHANNEL = [
    UNCLASSIFIED_SOCIAL,
    *contains("name", CHANNEL_WORDS, None, NO_CHANNEL),
    *contains("type", ["external print ad", "internal print ad"], None, NO_CHANNEL),
    *contains("name", LATE_CHANNEL_WORDS, None, NO_CHANNEL),
    *contains("name", ["print"], None, NO_CHANNEL, ("raw_name", "is not", "Print Sale")),
    *contains("name", MAIL_WORDS + ["podcast"], None, NO_CHANNEL),
    *contains("type", ["external display"], None, NO_PLATFORM),
    *contains("type", ["social_free"], "social free"),
    *contains("campaign", CHANNEL_WORDS + LATE_CHANNEL_WORDS, None, NO_CHANNEL, LANDING),
    *contains("campaign", ["app"], "ft app", IN_APP, NO_CHANNEL, LANDING, NOT_WHATSAPP),
    *contains("campaign", ["print"] + MAIL_WORDS, None, NO_CHANNEL, LANDING),
    *contains("campaign", ["email"], "other email", NO_CHANNEL, LANDING),
    *contains("campaign", ["podcast"], None, NO_CHANNEL, LANDING),
]


def _networks(column: str, *guards: tuple) -> list[tuple]:
    """Ad networks, in order; two of them go by two names."""
    return [
        *contains(column, ["dv360", "instagram"], None, *guards),
        *contains(column, ["facebook", "fb"], "facebook", *guards),
        *contains(column, ["linkedin", "acast", "twitter"], None, *guards),
        *contains(column, ["youtube", "- yt -"], "youtube", *guards),
    ]


STATIC_PLATFORM = [
    *contains("name", ["unidays", "search"], None, NO_PLATFORM),
    *contains("name", [" sem "], "sem", NO_PLATFORM),
    *contains("name", ["newsletter", "email"], None, NO_PLATFORM),
    *_networks("name", NO_PLATFORM),
    *contains("name", ["outbrain", "display", "affiliates"], None, NO_PLATFORM),
    *contains("name", ["app"], "ft app", IN_APP, NO_PLATFORM, NOT_WHATSAPP),
    *contains("name", ["house ads"], None, NO_PLATFORM),
    *contains("name", ["ft_print"], "ft print", NO_PLATFORM),
    *contains("name", ["google dem gen", "keywee", "reddit", "blis"], None, NO_PLATFORM),
    *contains("name", ["direct email", "meta", "google"], None, NO_CHANNEL),
    *contains("name", ["sony"], None, NO_PLATFORM),
    *contains("name", ["siriusxm_"], "siriusxm", NO_PLATFORM),
    ([[("type", "is", "facebook"), NO_PLATFORM]], "facebook"),
    *contains("name", ["whatsapp", "tiktok"], None, NO_PLATFORM),
    *contains("campaign", ["search"], None, NO_CHANNEL, LANDING),
    (
        [
            [("campaign", "is", "sem"), NO_CHANNEL, LANDING],
            [("campaign", "like", "% sem %"), NO_CHANNEL, LANDING],
        ],
        "sem",
    ),
    *contains("campaign", ["google", "newsletter"], None, NO_CHANNEL, LANDING),
    *_networks("campaign", NO_CHANNEL, LANDING),
    *contains("campaign", ["display", "affiliates"], None, NO_CHANNEL, LANDING),
    *contains("campaign", ["app"], "ft app", IN_APP, NO_CHANNEL, LANDING, NOT_WHATSAPP),
    *contains(
        "campaign",
        ["house ads", "ft print", "keywee", "reddit", "blis", "meta", "whatsapp", "tiktok"],
        None,
        NO_CHANNEL,
        LANDING,
    ),
]

# ----------------------------------------------------------------------------------------------

# Columns the rules test, as SQL over the visit columns.
PREPARED = {
    "name": "lower(visit_traffic_source_name)",
    "type": "lower(visit_traffic_source_type)",
    "raw_name": "visit_traffic_source_name",
    "raw_type": "visit_traffic_source_type",
    "campaign": "lower(segment_campaign_name)",
    "raw_campaign": "segment_campaign_name",
    "grouping": "lower(segment_campaign_grouping)",
    "seg_channel": "lower(segment_channel)",
    "landing": "is_campaign_landing and segment_name = visit_traffic_source_name",
    "elsewhere": "not is_campaign_landing and segment_name != visit_traffic_source_name",
    "same_segment": "not is_campaign_landing and segment_name = visit_traffic_source_name",
    "underscores_5": "length(visit_traffic_source_name) - length(replace(visit_traffic_source_name, '_', '')) >= 5",
}
LABELS = [
    "media_type", "processed_channel", "processed_platform", "static_channel", "static_platform", "channel", "platform",
]


# What the labels depend on.
SOURCE_KEYS = [
    "visit_traffic_source_type", "visit_traffic_source_name", "segment_name", "segment_campaign_name",
    "segment_campaign_grouping", "segment_channel", "is_campaign_landing",
]


def label_sources(sources: DataFrame) -> DataFrame:
    """Add the seven label columns, row by row."""
    plain = sources.columns
    named = sources.select("*", *[F.expr(rule).alias(name) for name, rule in PREPARED.items()])
    labelled = named.select(
        "*",
        first_match(MEDIA_TYPE, "type").alias("media_type"),
        first_match(CHANNEL).alias("processed_channel"),
        first_match(PLATFORM).alias("processed_platform"),
    ).select(
        "*",
        first_match(STATIC_CHANNEL).alias("static_channel"),
        first_match(STATIC_PLATFORM).alias("static_platform"),
    )
    channel = F.coalesce("processed_channel", "static_channel", F.when(F.col("landing"), F.col("seg_channel")), "type")
    platform = F.coalesce("processed_platform", "static_platform", "processed_channel", "static_channel", "type")
    return labelled.select(*plain, *LABELS[:5], channel.alias("channel"), platform.alias("platform"))


def daily_sources(visits: DataFrame) -> DataFrame:
    """B2C visits per day and source: rows (SOURCE_KEYS, rows_, visit_date), no date for visits without a time."""
    day = F.to_date(VISIT_TS).alias("visit_date")
    counts = visits.filter("b2b_b2c = 'B2C'").groupBy(*SOURCE_KEYS, day).agg(F.count(F.lit(1)).alias("rows_"))
    return counts.select(*SOURCE_KEYS, "rows_", "visit_date")


def refresh_sources(visits: DataFrame, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """The table of daily source counts at `path` after the days `first` to `last` were counted anew.

    Only visits of these days, and those without a time, are read; without bounds it is the whole history, as when
    the table is made. Late visits count as soon as their day is refreshed. Visits are only ever added: a day
    that has none left keeps its counts.
    """
    if first or last:
        time = F.col(VISIT_TS)
        held = time >= F.lit(first).cast("timestamp") if first else F.lit(True)
        held = held & (time < F.date_add(F.lit(last), 1).cast("timestamp") if last else F.lit(True))
        visits = visits.filter(held | time.isNull())
    counts = daily_sources(visits)
    replace_partitions(counts, path, ["visit_date"])
    return visits.sparkSession.read.schema(counts.schema).parquet(path)


def source_dictionary(
    visits: DataFrame, at_least: int = MIN_SOURCE_FREQUENCY, counts: DataFrame | None = None
) -> DataFrame:
    """Each distinct source of B2C visits with its labels and the frequency of its type.

    With `counts`, the table kept by `refresh_sources`, its days are summed and the history is not read.

    One pass over the source columns, combined before the shuffle. Some 200 patterns are
    then tested once per source, not once per visit; and frequencies come from these counts
    instead of a window over few, huge groups.
    """
    counted = F.count(F.lit(1)) if counts is None else F.sum("rows_")
    rows = visits.filter("b2b_b2c = 'B2C'") if counts is None else counts
    sources = materialize(rows.groupBy(*SOURCE_KEYS).agg(counted.alias("rows_")))
    types = sources.groupBy(F.col("visit_traffic_source_type").alias("kind_")).agg(
        F.sum("rows_").alias("source_frequency")
    )
    same = F.col("visit_traffic_source_type").eqNullSafe(F.col("kind_"))
    kept = sources.join(types.filter(F.col("source_frequency") >= at_least), same)
    return label_sources(kept.drop("rows_", "kind_"))


def frequent_sources(
    visits: DataFrame, at_least: int = MIN_SOURCE_FREQUENCY, counts: DataFrame | None = None
) -> DataFrame:
    """B2C rows whose source type occurs often enough, with that frequency."""
    return _look_up(visits.filter("b2b_b2c = 'B2C'"), source_dictionary(visits, at_least, counts), ["source_frequency"])


def classify(
    visits: DataFrame, at_least: int = MIN_SOURCE_FREQUENCY, counts: DataFrame | None = None,
    by: list[str] | None = None, tasks: int | None = None,
) -> DataFrame:
    """Frequent B2C visits without exact copies, labelled; with `by` laid out by these columns, in `tasks` tasks if given.

    Where the sources are few, each stands for its columns by its number until copies are dropped, and with `by` the
    rows are shuffled once, by these columns, which no copies differ in. Else copies go first, then the dictionary is
    looked up: being a written table, it is broadcast only if it is small.
    """
    columns = ["source_frequency", *LABELS]
    entries = materialize(source_dictionary(visits, at_least, counts).withColumn("source_", F.monotonically_increasing_id()))
    b2c = visits.filter("b2b_b2c = 'B2C'")
    layout = [*([tasks] if tasks else []), *(by or [])]
    if entries.limit(FEW_SOURCES + 1).count() > FEW_SOURCES:
        found = _look_up(b2c.dropDuplicates(), entries.drop("source_"), columns)
        return found.repartition(*layout) if by else found
    coded = _joined(b2c, F.broadcast(entries), ["source_"]).drop(*SOURCE_KEYS, "b2b_b2c")
    once = (coded.repartition(*layout) if by else coded).dropDuplicates()
    found = once.join(F.broadcast(entries), "source_").withColumn("b2b_b2c", F.lit("B2C"))
    return found.select(*visits.columns, *columns)


def _look_up(visits: DataFrame, dictionary: DataFrame, columns: list[str]) -> DataFrame:
    return _joined(visits, materialize(dictionary.select(*SOURCE_KEYS, *columns)), columns)


def _joined(visits: DataFrame, entries: DataFrame, columns: list[str]) -> DataFrame:
    entries = entries.select(*[F.col(key).alias(f"{key}_") for key in SOURCE_KEYS], *columns)
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"{key}_")) for key in SOURCE_KEYS])
    return visits.join(entries, same).drop(*[f"{key}_" for key in SOURCE_KEYS])
