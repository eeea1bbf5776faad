"""The same results in DuckDB SQL over the benchmark tables, for checking.

Written independently of the DataFrame code where it matters: journeys by plain window
functions, removal effects from dense inverses, labels by joining sources with a table of tests. Only fixed values (names, patterns, labels) are shared.
"""

from __future__ import annotations

import re

from ..functions.labels import PRODUCT_NAMES, PRODUCT_PATTERNS, PRODUCT_TERMS
from ..operators import appevents as app
from ..operators import classify as rules
from ..sources import sample

AS_OF = "DATE '2024-01-31'"
COHORT = "run_date, conversion_type, conversion_window"
JOURNEY = f"{COHORT}, user_guid, journey_no"


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def pick(values: list[str | None], number: str = "event_id") -> str:
    return f"([{', '.join(map(text, values))}])[{number} % {len(values)} + 1]"


def same(columns: str, left: str, right: str) -> str:
    return " AND ".join(f"{left}.{c.strip()} = {right}.{c.strip()}" for c in columns.split(","))


SOURCE_NAME = pick([n for _, n in sample.SOURCES])
FIELDS = {
    "AFEventParamRevenue": "'\"' || cents || '\"'",
    "AFEventParamCurrency": f"'\"' || {pick(['GBP', 'USD'])} || '\"'",
    "payment_method_type": f"'\"' || {pick(['card', 'store', 'voucher'])} || '\"'",
    "AFEventParamOrderId": "'\"o' || event_id || '\"'",
    "AFEventParamContentType": f"'\"' || {pick(sample.APP_PRODUCTS)} || '\"'",
    "af_content_type": f"'\"' || {pick(sample.APP_PRODUCTS)} || '\"'",
    "af_order_id": "'\"a' || event_id || '\"'",
    "af_revenue": "CASE WHEN event_id % 7 = 0 THEN '\"n/a\"' ELSE cents END",
    "af_currency": f"'\"' || {pick(['EUR', 'USD'])} || '\"'",
}
JSON_BODY = " || ', ' || ".join(f"'\"{key}\": ' || {value}" for key, value in FIELDS.items())


def json_text(key: str) -> str:
    return f"CASE WHEN json_valid(event_value) THEN json_extract_string(event_value, '$.{key}') END"


def product_label() -> str:
    arms = [f"WHEN lower(product_name) LIKE {text(p)} THEN {text(r)}" for p, r in PRODUCT_PATTERNS]
    arms += [f"WHEN lower(product_name) = {text(n)} THEN {text(r)}" for n, r in PRODUCT_NAMES.items()]
    arms += [f"WHEN lower(b2c_product_name_and_term) = {text(t.lower())} THEN {text(t)}" for t in PRODUCT_TERMS]
    return f"CASE {' '.join(arms)} ELSE 'Others' END"


# Named pieces; each may use the ones before it.
PIECES: dict[str, str] = {}


def six(value: str) -> str:
    """Six digits, in decimals, where halves are exact."""
    return f"CAST(round(CAST({value} AS DECIMAL(38, 9)), 6) AS DOUBLE)"

PIECES["conv"] = """
    SELECT user_id, conversion_type, ts AS conversion_ts, event_id AS conversion_id, value AS conversion_value
    FROM (
        SELECT *, CASE event_type WHEN 'signup' THEN 'Trial' WHEN 'purchase' THEN 'Subscription' ELSE 'registration' END
                AS conversion_type,
            row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
        FROM events WHERE event_type IN ('signup', 'purchase') OR (event_type = 'view' AND event_id % 40 = 3)
    ) WHERE rn = 1"""

PIECES["visits"] = f"""
    SELECT 'u' || e.user_id AS user_guid,
        CASE WHEN e.ts < c.conversion_ts THEN e.ts - to_days((30 * (event_id % 4))::INT) ELSE e.ts END
            AS attribution_visit_start_time,
        CASE WHEN event_id = {sample.RARE_EVENT} THEN 'Rare' ELSE {pick([k for k, _ in sample.SOURCES])} END
            AS visit_traffic_source_type,
        {SOURCE_NAME} AS visit_traffic_source_name,
        {pick(sample.DEVICES)} AS visit_device_type,
        event_id % 2 = 0 AS is_campaign_landing,
        CASE WHEN event_id % 4 < 2 THEN {SOURCE_NAME} ELSE 'seg' || (event_id % 5) END AS segment_name,
        {pick(sample.CAMPAIGNS)} AS segment_campaign_name,
        {pick(sample.GROUPINGS, '(event_id // 3)')} AS segment_campaign_grouping,
        {pick(sample.SEGMENT_CHANNELS)} AS segment_channel,
        'audience' || (event_id % 3) AS segment_audience,
        'web' AS b2c_abstraction_datasource,
        CASE WHEN e.user_id % 10 = 9 THEN 'B2B' ELSE 'B2C' END AS b2b_b2c,
        {pick([n for n, _ in sample.PRODUCTS], 'conversion_id')} AS product_name,
        {pick([t for _, t in sample.PRODUCTS], 'conversion_id')} AS b2c_product_name_and_term,
        n.n_name AS geo_country_name,
        conversion_ts AS conversion_visit_timestamp,
        CAST(event_id = conversion_id AS BIGINT) AS converting_visit,
        conversion_type,
        CASE WHEN conversion_id % 13 <> 5 THEN conversion_id END AS product_arrangement_id,
        {pick(sample.USER_COHORTS, 'e.user_id')} AS user_cohort_primary,
        {pick(['digital', 'print'], 'conversion_id')} AS b2c_product_type,
        conversion_id % 2 = 1 AS is_app_conversion,
        {pick(['core', 'bundle', 'add-on'], 'conversion_id')} AS product_type
    FROM events e JOIN conv c ON e.user_id = c.user_id AND (e.ts <= c.conversion_ts
        OR (conversion_id % 3 = 0 AND CAST(e.ts AS DATE) = CAST(c.conversion_ts AS DATE)))
    JOIN (VALUES (1), (2)) f(copies) ON copies = 1 OR event_id % 17 = 0
    LEFT JOIN nation n ON n.n_nationkey = e.user_id % 25"""

PIECES["user_ltv"] = """
    SELECT 'u' || user_id AS user_guid,
        CASE WHEN factor = 12 AND conversion_id % 11 = 0 THEN NULL ELSE conversion_value * factor END
            AS ltv_acquisition_capped_12m,
        conversion_ts AS product_order_timestamp, conversion_id AS product_arrangement_id
    FROM conv JOIN (VALUES (12), (6)) f(factor) ON factor = 12 OR conversion_id % 5 = 0"""

PIECES["recent_ltv"] = f"""
    SELECT * FROM user_ltv
    WHERE CAST(product_order_timestamp AS DATE) >= {AS_OF} - 15
        AND ltv_acquisition_capped_12m IS NOT NULL AND product_arrangement_id IS NOT NULL"""

PIECES["app_events"] = f"""
    SELECT
        CASE event_type WHEN 'signup' THEN 'install' WHEN 'purchase' THEN 'af_purchase'
            WHEN 'view' THEN 'af_content_view' WHEN 'click' THEN {pick(['af_share', 'af_login', 'select_package'])}
            ELSE {pick(['af_ars_subscription_renewed', 'af_purchase_canceled'])} END AS event_name,
        CASE WHEN event_id % 13 = 0 THEN '{{"AFEventParamRevenue": "1", ' ELSE '{{' || {JSON_BODY} || '}}' END AS event_value,
        {pick(sample.MEDIA_SOURCES)} AS media_source,
        CASE WHEN event_id % 4 < 2 THEN 'ios' ELSE 'android' END AS platform,
        ts AS event_time, date_trunc('day', ts) AS install_time,
        'campaign' || (event_id % 3) AS campaign,
        CASE WHEN event_id % 2 = 0 THEN 'organic' ELSE 'paid' END AS campaign_type,
        {pick(['EMEA', 'APAC'], 'user_id')} AS region,
        {pick(['GB', 'US', 'JP'], 'user_id')} AS country_code,
        'af' || user_id AS appsflyer_id, 'u' || user_id AS customer_user_id,
        {pick(sample.APPS)} AS app_id, 'app' || (event_id % 6) AS app_name, CAST(ts AS DATE) AS partition_date
    FROM (SELECT *, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS cents FROM events)"""

# ---- labels: sources x tests ------------------------------------------------------------------

CHAINS = {
    "media_type": rules.MEDIA_TYPE,
    "processed_channel": rules.CHANNEL,
    "processed_platform": rules.PLATFORM,
    "static_channel": rules.STATIC_CHANNEL,
    "static_platform": rules.STATIC_PLATFORM,
}


def _tests(names: list[str]) -> str:
    rows = []
    for name in names:
        for rank, (alternatives, result) in enumerate(CHAINS[name]):
            kind, value, part = ("text", result, 0) if isinstance(result, str) else (*result, 0)[:3]
            for number, tests in enumerate(alternatives):
                for column, comparison, *pattern in tests:
                    cells = [text(name), str(rank), str(number), text(column), text(comparison)]
                    cells += [text(pattern[0] if pattern else None), text(kind), text(value), str(part)]
                    rows.append(f"({', '.join(cells)})")
    return "VALUES " + ", ".join(rows)


TEST_COLUMNS = "target, rnk, alt, col, op, pat, kind, res, part"
PREPARED = {
    "name": "lower(visit_traffic_source_name)", "type": "lower(visit_traffic_source_type)",
    "raw_name": "visit_traffic_source_name", "raw_type": "visit_traffic_source_type",
    "campaign": "lower(segment_campaign_name)", "raw_campaign": "segment_campaign_name",
    "grouping": "lower(segment_campaign_grouping)", "seg_channel": "lower(segment_channel)",
    "landing": "CASE WHEN is_campaign_landing AND segment_name = visit_traffic_source_name THEN 'yes' END",
    "elsewhere": "CASE WHEN NOT is_campaign_landing AND segment_name <> visit_traffic_source_name THEN 'yes' END",
    "same_segment": "CASE WHEN NOT is_campaign_landing AND segment_name = visit_traffic_source_name THEN 'yes' END",
    "underscores_5": "CASE WHEN len(string_split(visit_traffic_source_name, '_')) > 5 THEN 'yes' END",
}
KEYS = ", ".join(rules.SOURCE_KEYS)

PIECES["sources"] = f"""
    SELECT *, row_number() OVER () AS sid FROM (
        SELECT {KEYS}, sum(n) OVER (PARTITION BY visit_traffic_source_type) AS source_frequency
        FROM (SELECT {KEYS}, count(*) AS n FROM visits WHERE b2b_b2c = 'B2C' GROUP BY ALL)
    ) WHERE source_frequency >= 10"""
PIECES["cells"] = " UNION ALL ".join(
    f"SELECT sid, {text(name)} AS col, {rule} AS val FROM sources" for name, rule in PREPARED.items()
)


def _labelled(names: list[str], cells: str) -> str:
    return f"""
    SELECT f.sid, f.target,
        CASE t.kind WHEN 'text' THEN t.res WHEN 'copy' THEN c.val
            ELSE lower(split_part(c.val, '_', t.part + 1)) END AS label
    FROM (
        SELECT sid, target, min(rnk) AS rnk FROM (
            SELECT sid, target, rnk, alt, bool_and(coalesce(CASE op
                WHEN 'like' THEN val LIKE pat WHEN 'unlike' THEN val NOT LIKE pat WHEN 'is' THEN val = pat
                WHEN 'is not' THEN val <> pat WHEN 'null' THEN val IS NULL ELSE val = 'yes' END, false)) AS holds
            FROM {cells} JOIN ({_tests(names)}) t({TEST_COLUMNS}) USING (col) GROUP BY ALL
        ) WHERE holds GROUP BY ALL
    ) f
    JOIN (SELECT DISTINCT target, rnk, kind, res, part FROM ({_tests(names)}) t({TEST_COLUMNS})) t USING (target, rnk)
    LEFT JOIN {cells} c ON c.sid = f.sid AND c.col = t.res"""


PIECES["first_labels"] = _labelled(["media_type", "processed_channel", "processed_platform"], "cells")
PIECES["more_cells"] = """
    SELECT * FROM cells
    UNION ALL SELECT s.sid, t.target, l.label FROM sources s
        CROSS JOIN (VALUES ('processed_channel'), ('processed_platform')) t(target)
        LEFT JOIN first_labels l ON l.sid = s.sid AND l.target = t.target"""
PIECES["second_labels"] = _labelled(["static_channel", "static_platform"], "more_cells")
PIECES["dictionary"] = f"""
    SELECT {KEYS}, source_frequency,
        coalesce(m, lower(visit_traffic_source_type)) AS media_type, pc AS processed_channel, pp AS processed_platform,
        sc AS static_channel, sp AS static_platform,
        coalesce(pc, sc, CASE WHEN is_campaign_landing AND segment_name = visit_traffic_source_name
            THEN lower(segment_channel) END, lower(visit_traffic_source_type)) AS channel,
        coalesce(pp, sp, pc, sc, lower(visit_traffic_source_type)) AS platform
    FROM sources LEFT JOIN (
        SELECT sid, max(label) FILTER (target = 'media_type') AS m,
            max(label) FILTER (target = 'processed_channel') AS pc,
            max(label) FILTER (target = 'processed_platform') AS pp,
            max(label) FILTER (target = 'static_channel') AS sc,
            max(label) FILTER (target = 'static_platform') AS sp
        FROM (SELECT * FROM first_labels UNION ALL SELECT * FROM second_labels) GROUP BY sid
    ) USING (sid)"""
PIECES["classified"] = f"""
    SELECT v.*, source_frequency, media_type, processed_channel, processed_platform, static_channel, static_platform,
        channel, platform
    FROM (SELECT DISTINCT * FROM visits WHERE b2b_b2c = 'B2C') v JOIN dictionary d
    ON {' AND '.join(f'v.{k} IS NOT DISTINCT FROM d.{k}' for k in rules.SOURCE_KEYS)}"""

# ---- windows and journeys -----------------------------------------------------------------------

PIECES["frequent"] = """
    SELECT DISTINCT v.* FROM visits v JOIN (
        SELECT visit_traffic_source_type AS k FROM visits WHERE b2b_b2c = 'B2C' GROUP BY 1 HAVING count(*) >= 10
    ) f ON v.visit_traffic_source_type IS NOT DISTINCT FROM f.k
    WHERE b2b_b2c = 'B2C'"""


def window_rows(source: str, columns: str) -> str:
    return f"""
    SELECT {columns}, CAST(conversion_visit_timestamp AS DATE) AS run_date, w.name AS conversion_window
    FROM {source} v JOIN (VALUES (30, 31), (60, 61), (90, 91)) w(name, days)
        ON CAST(attribution_visit_start_time AS DATE) >= CAST(conversion_visit_timestamp AS DATE) - w.days
    WHERE CAST(attribution_visit_start_time AS DATE) <= CAST(conversion_visit_timestamp AS DATE)
        AND EXISTS (SELECT 1 FROM {source} c WHERE c.user_guid = v.user_guid AND c.converting_visit = 1
            AND c.conversion_visit_timestamp = v.conversion_visit_timestamp
            AND CAST(c.conversion_visit_timestamp AS DATE) >= {AS_OF} - 15)"""


TOUCHPOINT = " || ' | ' || ".join(
    ["media_type", "channel", "platform", "visit_traffic_source_name", "visit_device_type", "geo_country_name",
     "user_cohort_primary", product_label()]
)
PIECES["windowed"] = f"""
    SELECT *, {TOUCHPOINT} AS label FROM ({window_rows('classified', 'v.*')})
    WHERE run_date BETWEEN {AS_OF} - 15 AND {AS_OF} - 1"""

PIECES["rolling"] = """
    SELECT v.*, d.run_date, 90 AS conversion_window, TOUCHPOINT_ AS label
    FROM classified v JOIN (SELECT DISTINCT CAST(conversion_visit_timestamp AS DATE) AS run_date FROM classified) d
        ON CAST(conversion_visit_timestamp AS DATE) BETWEEN d.run_date - 90 AND d.run_date
        AND CAST(attribution_visit_start_time AS DATE) BETWEEN d.run_date - 90 AND d.run_date
    WHERE conversion_type = 'Subscription'""".replace("TOUCHPOINT_", TOUCHPOINT)

USER_MAX = f"max({{}}) OVER (PARTITION BY {COHORT}, user_guid)"
FLAGS = {
    "last_visit": f"attribution_visit_start_time = {USER_MAX.format('attribution_visit_start_time')} AND converting_visit = 1",
    "conversion_time": f"attribution_visit_start_time = {USER_MAX.format('conversion_visit_timestamp')} AND converting_visit = 1",
    "last_visit_only": f"attribution_visit_start_time = {USER_MAX.format('attribution_visit_start_time')}",
    "conversion_day": "CAST(conversion_visit_timestamp AS DATE) = run_date",
}


def touches(source: str, flag: str, tie: str = "converting_visit") -> str:
    order = f"ORDER BY attribution_visit_start_time, {tie}, channel"
    user = f"PARTITION BY {COHORT}, user_guid"
    return f"""
    SELECT *, row_number() OVER (PARTITION BY {JOURNEY} {order}) AS position,
        count(*) OVER (PARTITION BY {JOURNEY}) AS touch_count,
        max(flag) OVER (PARTITION BY {JOURNEY}) AS conversion_value,
        epoch_us(max(attribution_visit_start_time) OVER (PARTITION BY {JOURNEY}))
            - epoch_us(attribution_visit_start_time) AS micros_left
    FROM (
        SELECT *, CAST(coalesce(sum(flag) OVER ({user} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                AS BIGINT) AS journey_no,
            CASE WHEN flag = 0 THEN lead(channel) OVER ({user} {order}) END AS next_channel
        FROM (
            SELECT {COHORT}, user_guid, attribution_visit_start_time, converting_visit, coalesce(label, '-') AS channel,
                CASE WHEN {flag} THEN 1 ELSE 0 END AS flag
            FROM {source}
        )
    )"""


PIECES["touches"] = touches("windowed", FLAGS["last_visit"])
PIECES["rolling_touches"] = touches("rolling", FLAGS["conversion_day"], "flag")

# ---- Markov chain: dense inverses of small groups of channels -------------------------------------
#
# Visits without a touchpoint meet in one channel; without it the channels fall into small groups, each inverted by
# Gauss-Jordan elimination over nested lists. That channel, the hub, then adds a product of a column and a row.

HUB = "'-'"


def markov_pieces(prefix: str, source: str) -> None:
    def weighted(name: str, columns: str, join: str, where: str) -> None:
        PIECES[f"{prefix}mk_{name}"] = f"""
            SELECT {', '.join(f'm.{c.strip()}' for c in COHORT.split(','))}, {columns} AS channel, sum(m.x * q.p) AS value
            FROM {prefix}mk_inverse m JOIN {prefix}probs q ON {same(COHORT, 'm', 'q')} AND {join} WHERE {where} GROUP BY ALL"""

    PIECES[f"{prefix}edges"] = f"""
        SELECT {COHORT}, source, destination, count(*) AS steps FROM (
            SELECT {COHORT}, '(start)' AS source, channel AS destination FROM {source} WHERE position = 1
            UNION ALL
            SELECT {COHORT}, channel, coalesce(next_channel, CASE WHEN flag = 1 THEN '(conversion)' ELSE '(null)' END)
            FROM {source}
        ) WHERE source <> destination GROUP BY ALL"""
    PIECES[f"{prefix}probs"] = f"""
        SELECT *, steps / sum(steps) OVER (PARTITION BY {COHORT}, source) AS p FROM {prefix}edges"""
    PIECES[f"{prefix}mk_channels"] = f"SELECT DISTINCT {COHORT}, channel FROM {source} WHERE channel <> {HUB}"
    PIECES[f"{prefix}mk_links"] = f"""
        SELECT {COHORT}, source AS a, destination AS b FROM {prefix}edges
        WHERE source NOT IN ({HUB}, '(start)') AND destination NOT IN ({HUB}, '(conversion)', '(null)')
        UNION SELECT {COHORT}, destination, source FROM {prefix}edges
        WHERE source NOT IN ({HUB}, '(start)') AND destination NOT IN ({HUB}, '(conversion)', '(null)')"""
    PIECES[f"{prefix}mk_numbered"] = f"""
        SELECT *, row_number() OVER (PARTITION BY {COHORT}, grp ORDER BY channel) AS k FROM (
            WITH RECURSIVE reach AS (
                SELECT {COHORT}, channel AS a, channel AS b FROM {prefix}mk_channels
                UNION
                SELECT r.run_date, r.conversion_type, r.conversion_window, r.a, l.b
                FROM reach r JOIN {prefix}mk_links l ON {same(COHORT, 'r', 'l')} AND r.b = l.a)
            SELECT {COHORT}, a AS channel, min(b) AS grp FROM reach GROUP BY ALL)"""
    PIECES[f"{prefix}mk_inverse"] = f"""
        WITH pairs AS (
            SELECT {COHORT}, grp, i.k AS i, j.k AS j, i.channel AS source, j.channel AS destination
            FROM {prefix}mk_numbered i JOIN {prefix}mk_numbered j USING ({COHORT}, grp)),
        filled AS (
            SELECT {COHORT}, grp, i, j, (i = j)::DOUBLE AS unit, (i = j)::DOUBLE - coalesce(p, 0) AS x
            FROM pairs LEFT JOIN {prefix}probs USING ({COHORT}, source, destination)),
        matrices AS (
            SELECT {COHORT}, grp, list(r ORDER BY i) AS m FROM (
                SELECT {COHORT}, grp, i, list_concat(list(x ORDER BY j), list(unit ORDER BY j)) AS r FROM filled GROUP BY ALL)
            GROUP BY ALL),
        inverted AS (
            SELECT {COHORT}, grp, len(m) AS n, list_reduce(
                list_transform(range(1, len(m) + 1), lambda k: [[k::DOUBLE]]),
                lambda a, e: list_transform(range(1, len(a) + 1), lambda i:
                    list_transform(range(1, len(a[1]) + 1), lambda c: CASE WHEN i = e[1][1]
                        THEN a[i][c] / a[i][i]
                        ELSE a[i][c] - a[i][e[1][1]::INT] * a[e[1][1]::INT][c] / a[e[1][1]::INT][e[1][1]::INT] END)),
                m) AS m
            FROM matrices)
        SELECT {COHORT}, x.channel AS i, y.channel AS j, m[x.k::INT][(n + y.k)::INT] AS x
        FROM inverted JOIN {prefix}mk_numbered x USING ({COHORT}, grp) JOIN {prefix}mk_numbered y USING ({COHORT}, grp)"""
    weighted("to_hub", "m.i", "q.source = m.j", f"q.destination = {HUB}")
    weighted("to_win", "m.i", "q.source = m.j", "q.destination = '(conversion)'")
    weighted("from_hub", "m.j", "q.destination = m.i", f"q.source = {HUB}")
    weighted("from_start", "m.j", "q.destination = m.i", "q.source = '(start)'")
    PIECES[f"{prefix}mk_parts"] = f"""
        SELECT n.run_date, n.conversion_type, n.conversion_window, n.channel, d.x AS own, coalesce(b.value, 0) AS to_hub,
            coalesce(w.value, 0) AS to_win, coalesce(h.value, 0) AS from_hub, coalesce(s.value, 0) AS from_start
        FROM {prefix}mk_numbered n
        JOIN {prefix}mk_inverse d ON {same(COHORT, 'n', 'd')} AND d.i = n.channel AND d.j = n.channel
        {' '.join(f"LEFT JOIN {prefix}mk_{name} {x} ON {same(COHORT + ', channel', 'n', x)}" for name, x in
                  (('to_hub', 'b'), ('to_win', 'w'), ('from_hub', 'h'), ('from_start', 's')))}"""
    PIECES[f"{prefix}mk_hub"] = f"""
        SELECT {COHORT}, 1 - sum(p * to_hub) FILTER (source = {HUB}) AS stays_out,
            coalesce(sum(p * to_win) FILTER (source = {HUB}), 0) AS value, coalesce(sum(p * to_hub) FILTER (source = '(start)'), 0) AS visits
        FROM (
            SELECT {COHORT}, source, p, coalesce(to_hub, (destination = {HUB})::INT) AS to_hub,
                coalesce(to_win, (destination = '(conversion)')::INT) AS to_win
            FROM {prefix}probs LEFT JOIN (SELECT {COHORT}, channel AS destination, to_hub, to_win FROM {prefix}mk_parts)
                USING ({COHORT}, destination)
            WHERE source IN ({HUB}, '(start)'))
        GROUP BY ALL HAVING count(*) FILTER (source = {HUB}) > 0"""
    PIECES[f"{prefix}mk_solved"] = f"""
        SELECT {COHORT}, channel, own + coalesce(to_hub * from_hub / stays_out, 0) AS again,
            to_win + coalesce(to_hub * value / stays_out, 0) AS value, from_start + coalesce(from_hub * visits / stays_out, 0) AS visits
        FROM {prefix}mk_parts LEFT JOIN {prefix}mk_hub USING ({COHORT})
        UNION ALL SELECT {COHORT}, {HUB}, 1 / stays_out, value / stays_out, visits / stays_out FROM {prefix}mk_hub"""
    PIECES[f"{prefix}mk_won"] = f"""
        SELECT {COHORT}, sum(p * coalesce(value, (destination = '(conversion)')::INT)) AS won
        FROM {prefix}probs LEFT JOIN (SELECT {COHORT}, channel AS destination, value FROM {prefix}mk_solved)
            USING ({COHORT}, destination)
        WHERE source = '(start)' GROUP BY ALL"""
    PIECES[f"{prefix}raw"] = f"""
        SELECT {COHORT}, channel, CASE WHEN won > 0 THEN visits * value / (again * won) END AS effect
        FROM {prefix}mk_solved JOIN {prefix}mk_won USING ({COHORT})"""
    PIECES[f"{prefix}effects"] = f"""
        SELECT {COHORT}, channel, rounded / nullif(sum(rounded) OVER (PARTITION BY {COHORT}), 0) * 100 AS removal_effect,
            rounded AS removal_effect_raw
        FROM (SELECT *, round_even(round(effect, 9), 3) AS rounded FROM {prefix}raw)"""


PIECES["platform_rows"] = "SELECT * REPLACE (platform AS label) FROM windowed"
PIECES["platform_touches"] = touches("platform_rows", FLAGS["last_visit"])
markov_pieces("platform_", "platform_touches")
markov_pieces("", "touches")
PIECES["rolling_part_rows"] = "SELECT * REPLACE (concat_ws(' | ', media_type, channel, platform) AS label) FROM rolling"
PIECES["rolling_part_touches"] = touches("rolling_part_rows", FLAGS["conversion_day"], "flag")
markov_pieces("rolling_part_", "rolling_part_touches")

LAST, FIRST, POSITION, DECAY, MARKOV = (
    "attribution_last_click_heuristic", "attribution_first_click_heuristic", "attribution_position_based_heuristic",
    "attribution_time_decay_heuristic", "attribution_markov_algorithmic",
)


def heuristics(source: str) -> str:
    return f"""
    SELECT *,
        conversion_value * CAST(position = touch_count AS DOUBLE) AS {LAST},
        conversion_value * CAST(position = 1 AS DOUBLE) AS {FIRST},
        conversion_value * CAST(CASE WHEN touch_count = 1 THEN 1
            WHEN touch_count = 2 THEN CASE position WHEN 1 THEN 0.45 ELSE 0.55 END
            WHEN position = 1 THEN 0.3 WHEN position = touch_count THEN 0.4 END AS DOUBLE) AS share_at_ends,
        w / sum(w) OVER (PARTITION BY {JOURNEY}) * conversion_value AS {DECAY}
    FROM (SELECT *, pow(CAST(0.6 AS DOUBLE), micros_left // 25200000000) AS w FROM {source})"""


MIDDLE = f"coalesce(share_at_ends, conversion_value * CAST(0.3 AS DOUBLE) / (touch_count - 2)) AS {POSITION}"
PIECES["heuristic"] = f"SELECT * EXCLUDE (share_at_ends), {MIDDLE} FROM ({heuristics('touches')})"
PIECES["rolling_heuristic"] = f"SELECT * EXCLUDE (share_at_ends), {MIDDLE} FROM ({heuristics('rolling_touches')})"
PIECES["credited"] = f"""
    SELECT h.*, CASE WHEN conversion_value = 1
        THEN effect / sum(effect) OVER (PARTITION BY {JOURNEY}) ELSE 0 END AS {MARKOV}
    FROM heuristic h LEFT JOIN raw USING ({COHORT}, channel)"""

SCORES = [LAST, FIRST, POSITION, DECAY, MARKOV]
PIECES["totals"] = f"""
    SELECT {COHORT}, channel AS channels, {', '.join(f'sum({s}) AS {s}' for s in SCORES)}
    FROM credited GROUP BY ALL"""
PIECES["journeys"] = f"""
    SELECT {JOURNEY}, max(conversion_value) AS conversion_value, count(*) AS num_touchpoints
    FROM touches GROUP BY ALL"""

# ---- lifetime value --------------------------------------------------------------------------------


def products(columns: str, where: str = "true") -> str:
    return f"SELECT DISTINCT user_guid, conversion_type, run_date, {columns} FROM windowed WHERE {where}"


PIECES["orders"] = """
    SELECT product_arrangement_id, CAST(product_order_timestamp AS DATE) AS run_date, ltv_acquisition_capped_12m
    FROM recent_ltv"""
PIECES["valued"] = f"""
    SELECT j.*, coalesce(p.product_arrangement_id, 0) AS product_arrangement_id, o.ltv_acquisition_capped_12m
    FROM journeys j LEFT JOIN ({products('product_arrangement_id')}) p USING (user_guid, conversion_type, run_date)
    LEFT JOIN orders o ON o.product_arrangement_id = coalesce(p.product_arrangement_id, 0) AND o.run_date = j.run_date
    WHERE conversion_value = 1"""
PIECES["averages"] = f"""
    SELECT {COHORT}, channel, avg(c.{MARKOV} * v.ltv_acquisition_capped_12m) AS average_ltv
    FROM credited c JOIN valued v USING ({JOURNEY}) WHERE c.conversion_value = 1 GROUP BY ALL"""
PIECES["effects_ltv"] = f"SELECT * FROM effects LEFT JOIN averages USING ({COHORT}, channel)"
PIECES["texts"] = f"""
    SELECT 'id:' || user_guid || '_J:' || journey_no AS journey_id, user_guid, 0 AS part,
        string_agg(channel, ' > ' ORDER BY position) AS channels_agg, max(conversion_value) AS conversion_value,
        {', '.join(f"string_agg(printf('%.6f', {six(s)}), ' > ' ORDER BY position) AS {s}" for s in SCORES)},
        count(*) AS num_touchpoints, {COHORT}, journey_no
    FROM credited GROUP BY {JOURNEY}"""
PIECES["effect_texts"] = f"""
    SELECT 'id:' || user_guid || '_J:' || journey_no AS journey_id, {COHORT}, product_arrangement_id, 0 AS part,
        CASE WHEN bool_and(c.{MARKOV} * ltv_acquisition_capped_12m IS NOT NULL) THEN
            string_agg(channel || ': ' || printf('%.6f', {six(f'c.{MARKOV} * ltv_acquisition_capped_12m')}), ' > '
                ORDER BY position) END AS removal_effect_ltv
    FROM credited c JOIN valued v USING ({JOURNEY}) WHERE c.conversion_value = 1
    GROUP BY {JOURNEY}, product_arrangement_id, ltv_acquisition_capped_12m"""

# ---- marts --------------------------------------------------------------------------------------------

PART_NAMES = (
    "media_type, media_channel, platform, channel_name, channel_device_type, geo_country_name, user_cohort_primary, "
    "product_type"
)
CLEANED_NAMES = "cleaned_media_channel, cleaned_media_type, cleaned_platform"
PIECES["parts"] = f"""
    SELECT *,
        CASE WHEN media_channel = 'social_free' OR media_channel = 'social free' THEN 'organic social'
            WHEN media_channel = 'ppc' THEN 'paid search'
            WHEN media_type = 'organic' AND media_channel = 'search' THEN 'organic search'
            ELSE media_channel END AS cleaned_media_channel,
        CASE WHEN media_type = 'email' OR media_type = 'editorial email' THEN 'organic' ELSE media_type END
            AS cleaned_media_type,
        CASE WHEN media_type = 'email' AND platform = 'newsletter' THEN 'email' ELSE platform END AS cleaned_platform,
        CASE WHEN product_type IN ({', '.join(map(text, PRODUCT_TERMS))}) THEN 'Directs' ELSE 'Other' END AS direct_kind
    FROM (
        SELECT channels, {', '.join(f"CASE WHEN trim(channels) = '-' THEN '-' ELSE trim({part}) END AS {name}" for name, part in (
            ('media_type', 'p[1]'), ('media_channel', 'p[2]'), ('platform', 'p[3]'),
            ('channel_name', "array_to_string(p[4:len(p) - 4], '|')"), ('channel_device_type', 'p[len(p) - 3]'),
            ('geo_country_name', 'p[len(p) - 2]'), ('user_cohort_primary', 'p[len(p) - 1]'), ('product_type', 'p[len(p)]'),
        ))}
        FROM (SELECT DISTINCT channels, string_split(channels, '|') AS p FROM totals))"""
PIECES["mart"] = f"""
    SELECT channels, {LAST}, {MARKOV}, {COHORT}, {PART_NAMES}, {CLEANED_NAMES},
        if(conversion_type = 'Trial', 'Trial', direct_kind) AS trial_direct
    FROM totals JOIN parts USING (channels)"""

# ---- app events ------------------------------------------------------------------------------------------


def names(values: list[str]) -> str:
    return "(" + ", ".join(map(text, values)) + ")"


def app_group(edition: str) -> str:
    return f"""CASE WHEN app_id IN {names(app.MAIN_APP)} THEN 'Main App' WHEN app_id IN {names(app.EDIT_APP)} THEN 'FT Edit'
        WHEN app_id IN {names(app.EDITION_APP)} THEN {text(edition)} ELSE 'Other' END"""


def category() -> str:
    def holds(tests) -> str:
        return " AND ".join(f"{column} = {text(value)}" for column, _, value in tests)

    arms = [f"WHEN {' OR '.join(map(holds, either))} THEN {text(result)}" for either, result in app.CHANNEL_CATEGORIES]
    return f"CASE {' '.join(arms)} ELSE {text(app.OTHER_CATEGORY)} END"


CATEGORY = category()
PURCHASE_TYPE = "CASE {} ELSE 'not identified' END".format(
    " ".join(f"WHEN product_id LIKE {text(f'%{piece}%')} THEN {text(label)}" for piece, label in app.PURCHASE_TYPES)
)


def app_rows(event_names: list[str], edition: str, json: dict[str, str] | None = None) -> str:
    columns = [
        "CAST(event_time AS DATE) AS event_date", "event_name", "app_name", f"{app_group(edition)} AS app_group", "app_id",
        "platform", "region", "country_code", "campaign", "campaign_type", f"{CATEGORY} AS channel_category",
        "appsflyer_id", "customer_user_id AS user_id", "install_time",
    ]
    for name, key in (json or {}).items():
        value = json_text(key)
        columns.append(f"{f'TRY_CAST({value} AS DOUBLE)' if name == 'revenue' else value} AS {name}")
    return f"SELECT {', '.join(columns)} FROM app_events WHERE event_name IN {names(event_names)}"


PIECES["installs"] = f"SELECT * EXCLUDE (event_name) FROM ({app_rows([app.INSTALL], app.PLAIN_EDITION)})"
PIECES["engagement"] = app_rows(app.ENGAGEMENT, app.BRANDED_EDITION)
PIECES["subscription_events"] = app_rows(app.SUBSCRIPTION, app.PLAIN_EDITION, app.SUBSCRIPTION_FIELDS)
PIECES["purchases"] = f"""SELECT * EXCLUDE (event_name), {PURCHASE_TYPE} AS purchase_type
    FROM ({app_rows([app.PURCHASE], app.BRANDED_EDITION, app.PURCHASE_FIELDS)})"""
DIMS = "event_date, app_name, app_group, app_id, platform, region, country_code, campaign, campaign_type, channel_category"
PURCHASE_DIMS = f"{DIMS}, purchase_type, currency, payment_method_type"
DAILY_PURCHASES = f"""SELECT {PURCHASE_DIMS}, count(*) AS total_purchases, count(DISTINCT user_id) AS unique_purchasers,
    sum(revenue) AS total_revenue FROM purchases GROUP BY {PURCHASE_DIMS}"""

# ---- timing ----------------------------------------------------------------------------------------------

STAGE = "CASE conversion_type WHEN 'Trial' THEN 'trial' WHEN 'Subscription' THEN 'subscriber' ELSE conversion_type END AS stage"
PIECES["time_to_convert"] = """
    SELECT conversion_type, user_guid, CASE WHEN converted - reference >= 1 THEN converted - reference END AS time_to_convert
    FROM (
        SELECT conversion_type, user_guid, min(CAST(attribution_visit_start_time AS DATE)) AS reference,
            min(CAST(attribution_visit_start_time AS DATE)) FILTER (converting_visit = 1) AS converted
        FROM visits GROUP BY ALL
    )"""
PIECES["stage_rows"] = """
    SELECT v.conversion_type, v.user_guid, CAST(attribution_visit_start_time AS DATE) AS run_date, time_to_convert
    FROM visits v LEFT JOIN time_to_convert t USING (conversion_type, user_guid) WHERE converting_visit = 1"""

ROUND = {
    **{s: 6 for s in SCORES}, "removal_effect": 6, "average_ltv": 6, "total_revenue": 6, "ltv_acquisition_capped_12m": 6,
}


def query(body: str) -> str:
    """Put the pieces a query needs, directly or not, before it."""
    order = list(PIECES)
    needed: set[str] = set()

    def visit(sql: str, before: int) -> None:
        words = set(re.findall(r"\w+", sql))
        for place, name in enumerate(order[:before]):
            if name in words and name not in needed:
                needed.add(name)
                visit(PIECES[name], place)

    visit(body, len(order))
    pieces = ",\n".join(f"{name} AS MATERIALIZED ({PIECES[name]})" for name in order if name in needed)
    return f"WITH {pieces}\n{body}" if needed else body


def rounded(columns: list[str]) -> str:
    return ", ".join(f"{six(c)} AS {c}" for c in columns)


KEYS_OUT = "user_guid, attribution_visit_start_time, conversion_visit_timestamp, conversion_type"
COUNTS = "count(*) AS visits, count(DISTINCT user_guid) AS users"
CONV_DATE = "CAST(conversion_visit_timestamp AS DATE)"
VISIT_18 = (
    "user_guid, attribution_visit_start_time, visit_traffic_source_type, visit_traffic_source_name, visit_device_type, "
    "is_campaign_landing, segment_name, segment_campaign_name, segment_campaign_grouping, segment_channel, "
    "segment_audience, b2c_abstraction_datasource, b2b_b2c, product_name, b2c_product_name_and_term, geo_country_name, "
    "conversion_visit_timestamp, converting_visit"
)


def window_query(name: int) -> str:
    """The converters once, and the one look-back asked for."""
    converted = "CAST(conversion_visit_timestamp AS DATE)"
    return f"""SELECT {KEYS_OUT}, converting_visit, {TOUCHPOINT} AS touchpoint FROM classified JOIN (
            SELECT DISTINCT user_guid, conversion_visit_timestamp FROM classified
            WHERE converting_visit = 1 AND {converted} >= {AS_OF} - 15) USING (user_guid, conversion_visit_timestamp)
        WHERE CAST(attribution_visit_start_time AS DATE) BETWEEN {converted} - {name + 1} AND {converted}"""


def label_query(name: str) -> str:
    return f"SELECT {KEYS}, {name}, count(*) AS visits FROM classified GROUP BY ALL"


def flag_query(rule: str) -> str:
    return f"""SELECT {COHORT}, user_guid, count(*) AS visits, CAST(sum(flag) AS BIGINT) AS conversions,
        max(journey_no) AS last_journey FROM ({touches('windowed', FLAGS[rule])}) GROUP BY ALL"""


def share_query(score: str, piece: str = "heuristic") -> str:
    return f"SELECT {JOURNEY}, position, channel, {rounded([score])} FROM {piece}"


TOTALS = f"SELECT {COHORT}, channels, {rounded(SCORES)} FROM totals"
HEURISTIC_TOTALS = f"""SELECT {COHORT}, channel AS channels,
    {', '.join(six(f'sum({s})') + f' AS {s}' for s in SCORES[:4])} FROM {{}} GROUP BY ALL"""
DEDUP_LTV = products("product_arrangement_id, is_app_conversion")

SOURCE_FREQUENCY = """SELECT visit_traffic_source_type, source_frequency, count(*) AS visits FROM (
    SELECT *, count(*) OVER (PARTITION BY visit_traffic_source_type) AS source_frequency
    FROM visits WHERE b2b_b2c = 'B2C') WHERE source_frequency >= 10 GROUP BY ALL"""
_BODY: dict[str, str] = {
    "src_visits": f"SELECT {VISIT_18} FROM visits",
    "src_app_events": "SELECT * EXCLUDE (partition_date) FROM app_events WHERE partition_date >= DATE '2023-01-01'",
    "src_ltv_recent": f"SELECT * REPLACE (round(ltv_acquisition_capped_12m, 6) AS ltv_acquisition_capped_12m) FROM recent_ltv",
    "slice_conversion_day": f"SELECT {CONV_DATE} AS run_date, conversion_type, {COUNTS} FROM visits GROUP BY ALL",
    "conversion_day": f"SELECT {KEYS_OUT}, {CONV_DATE} AS run_date FROM visits WHERE {CONV_DATE} = DATE '2024-01-20'",
    "run_date_range": f"""SELECT {CONV_DATE} AS run_date, {COUNTS} FROM visits
        WHERE {CONV_DATE} BETWEEN {AS_OF} - 15 AND {AS_OF} - 1 GROUP BY ALL""",
    "data_date_range": f"SELECT min({CONV_DATE}) AS min_date, max({CONV_DATE}) AS max_date FROM visits",
    "distinct_conversion_dates": f"""SELECT DISTINCT {CONV_DATE} AS conversion_date FROM visits
        WHERE {CONV_DATE} BETWEEN {AS_OF} - 15 AND {AS_OF} - 1 ORDER BY 1""",
    "scan_date_between": f"""SELECT {CONV_DATE} AS run_date, conversion_type, {COUNTS} FROM visits
        WHERE {CONV_DATE} BETWEEN DATE '2024-01-10' AND DATE '2024-01-25' GROUP BY ALL""",
    "write_replace_cohort": TOTALS,
    "write_replace_day": f"""SELECT channels, {COHORT},
        {six(LAST)} * CASE WHEN run_date = DATE '2024-01-20' THEN 2 ELSE 1 END AS {LAST} FROM totals""",
    "write_append": f"{TOTALS} UNION ALL {TOTALS}",
    "write_truncate": f"SELECT {STAGE}, run_date, median(time_to_convert) AS median_days FROM stage_rows GROUP BY conversion_type, run_date",
    "write_skip_empty": """SELECT * FROM (VALUES ('filled', true), ('empty', false)) t(input, written),
        (SELECT count(*) AS kept_rows FROM totals)""",
    "mart_partitioned": f"""
        SELECT 'daily_installs' AS mart, {DIMS}, count(*) AS total, count(DISTINCT user_id) AS users, NULL AS event_name,
            NULL AS payment_method_type, NULL AS purchase_type, NULL AS currency, CAST(NULL AS DOUBLE) AS total_revenue
        FROM installs GROUP BY {DIMS}
        UNION ALL BY NAME SELECT 'daily_engagement' AS mart, {DIMS}, event_name, count(*) AS total,
            count(DISTINCT user_id) AS users FROM engagement GROUP BY {DIMS}, event_name
        UNION ALL BY NAME SELECT 'daily_subscription_events' AS mart, {DIMS}, event_name, payment_method_type,
            count(*) AS total, count(DISTINCT user_id) AS users
        FROM subscription_events GROUP BY {DIMS}, event_name, payment_method_type
        UNION ALL BY NAME SELECT 'daily_purchases' AS mart, {PURCHASE_DIMS}, total_purchases AS total,
            unique_purchasers AS users, round(total_revenue, 6) AS total_revenue FROM ({DAILY_PURCHASES})""",
    "view_vs_table": """SELECT kind, count(*) AS orders, round(sum(ltv_acquisition_capped_12m), 6) AS total_ltv
        FROM recent_ltv, (VALUES ('view'), ('table')) t(kind) GROUP BY ALL""",
    "touchpoint_label": f"SELECT {KEYS_OUT}, {TOUCHPOINT} AS touchpoint FROM classified",
    "product_label": f"""SELECT product_name, b2c_product_name_and_term, {product_label()} AS product_label,
        count(*) AS visits FROM visits GROUP BY ALL""",
    "b2c_converting_filter": f"""SELECT DISTINCT user_guid, conversion_visit_timestamp FROM visits
        WHERE b2b_b2c = 'B2C' AND converting_visit = 1 AND {CONV_DATE} >= {AS_OF} - 15""",
    **{f"classify_{name}": label_query(name) for name in CHAINS},
    "channel_fallback": label_query("channel"),
    "platform_fallback": label_query("platform"),
    "delimited_part_pick": """SELECT visit_traffic_source_name AS name,
        lower(split_part(visit_traffic_source_name, '_', 2)) AS channel,
        lower(split_part(visit_traffic_source_name, '_', 3)) AS platform, count(*) AS visits FROM visits
        WHERE len(string_split(visit_traffic_source_name, '_')) > 5 GROUP BY ALL""",
    "parse_channels": f"SELECT * EXCLUDE (channel_name) FROM (SELECT channels, {COHORT}, {PART_NAMES} FROM mart)",
    "channel_name_middle": f"SELECT channels, {COHORT}, channel_name FROM mart",
    "clean_media": f"SELECT channels, {COHORT}, cleaned_media_channel, cleaned_media_type, cleaned_platform FROM mart",
    "trial_direct": f"""SELECT {COHORT}, trial_direct, count(*) AS channels, {six(f'sum({LAST})')} AS last_click
        FROM mart GROUP BY ALL""",
    "app_group": f"""SELECT app_id, {app_group(app.PLAIN_EDITION)} AS plain_group,
        {app_group(app.BRANDED_EDITION)} AS branded_group, count(*) AS events FROM app_events GROUP BY ALL""",
    "app_channel_category": f"""SELECT media_source, campaign_type, platform, {CATEGORY} AS channel_category,
        count(*) AS events FROM app_events GROUP BY ALL""",
    "purchase_type": "SELECT product_id, purchase_type, count(*) AS events FROM purchases GROUP BY ALL",
    "app_installs": "SELECT * FROM installs",
    "app_purchases": "SELECT * FROM purchases",
    "app_engagement": "SELECT * FROM engagement",
    "app_subscription_events": "SELECT * FROM subscription_events",
    "flag_converting_visit": flag_query("last_visit"),
    "flag_converting_by_conv_ts": flag_query("conversion_time"),
    "flag_last_visit_only": flag_query("last_visit_only"),
    "flag_by_conversion_date": flag_query("conversion_day"),
    "sanitize_columns": f"""SELECT channels, {COHORT}, {six(POSITION)} AS attribution_position_based_heuristic,
        {six(DECAY)} AS attribution_time_decay_heuristic FROM totals""",
    "dots_to_underscores": f"SELECT channels, {COHORT}, {six(LAST)} AS attribution_last_click_heuristic FROM totals",
    "user_from_journey_id": f"""SELECT {COHORT}, count(*) AS journeys, count(*) FILTER (journey_no = 0) AS first_journeys,
        count(DISTINCT user_guid) AS users FROM (SELECT DISTINCT {JOURNEY} FROM rolling_touches) GROUP BY ALL""",
    "conversion_type_split": f"""SELECT {CONV_DATE} AS run_date, conversion_type, {COUNTS} FROM visits
        WHERE conversion_type = 'Trial' GROUP BY ALL""",
    "converted_only": "SELECT * FROM journeys WHERE conversion_value = 1",
    "drop_zero_removal": f"""SELECT {COHORT}, channel, {rounded(['removal_effect', 'removal_effect_raw'])} FROM effects
        WHERE removal_effect <> 0""",
    "fill_product_id": f"""SELECT {JOURNEY}, coalesce(product_arrangement_id, 0) AS product_arrangement_id
        FROM journeys LEFT JOIN ({products('product_arrangement_id', "true")})
        USING (user_guid, conversion_type, run_date)""",
    "conversion_window_30": window_query(30),
    "conversion_window_60": window_query(60),
    "conversion_window_90": window_query(90),
    "conversion_windows_all": f"SELECT {COHORT}, {COUNTS} FROM ({window_rows('frequent', 'v.*')}) GROUP BY ALL",
    "join_product_arrangement": f"""SELECT {JOURNEY}, conversion_value, product_arrangement_id
        FROM journeys LEFT JOIN ({products('product_arrangement_id')}) USING (user_guid, conversion_type, run_date)""",
    "join_product_arrangement_ext": f"""SELECT {JOURNEY}, conversion_value, product_arrangement_id, is_app_conversion, product_type
        FROM journeys LEFT JOIN ({products('product_arrangement_id, is_app_conversion, product_type')})
        USING (user_guid, conversion_type, run_date)""",
    "join_ltv": f"""SELECT {JOURNEY}, num_touchpoints, product_arrangement_id, {rounded(['ltv_acquisition_capped_12m'])}
        FROM valued""",
    "join_avg_ltv": f"""SELECT {COHORT}, channel, {rounded(['removal_effect', 'removal_effect_raw', 'average_ltv'])}
        FROM effects_ltv""",
    "mart_removal_ltv": f"""SELECT m.* REPLACE ({rounded([LAST, MARKOV])}), {rounded(['removal_effect', 'average_ltv'])}
        FROM mart m LEFT JOIN (SELECT {COHORT}, channel AS channels, removal_effect, average_ltv FROM effects_ltv)
        USING ({COHORT}, channels)""",
    "index_join_time_to_convert": """SELECT conversion_type, user_guid, run_date, count(*) AS conversions, time_to_convert
        FROM stage_rows GROUP BY ALL""",
    "latest_row_per_user": """SELECT user_guid, conversion_visit_timestamp, b2c_product_type, product_arrangement_id,
        b2c_product_name_and_term FROM visits QUALIFY row_number() OVER (PARTITION BY user_guid
        ORDER BY conversion_visit_timestamp DESC, product_arrangement_id DESC, attribution_visit_start_time DESC) = 1""",
    "daily_installs": f"""SELECT {DIMS}, count(*) AS installs, count(DISTINCT user_id) AS unique_user_installs
        FROM installs GROUP BY {DIMS}""",
    "daily_engagement": f"""SELECT {DIMS}, event_name, count(*) AS total_events, count(DISTINCT user_id) AS unique_users
        FROM engagement GROUP BY {DIMS}, event_name""",
    "daily_subscription_events": f"""SELECT {DIMS}, event_name, payment_method_type, count(*) AS total_events,
        count(DISTINCT user_id) AS unique_users FROM subscription_events GROUP BY {DIMS}, event_name, payment_method_type""",
    "daily_purchases": DAILY_PURCHASES,
    "distinct_converters": f"""SELECT DISTINCT user_guid, conversion_visit_timestamp FROM frequent
        WHERE converting_visit = 1 AND {CONV_DATE} >= {AS_OF} - 15""",
    "distinct_classified": f"SELECT visit_traffic_source_type, conversion_type, {COUNTS} FROM frequent GROUP BY ALL",
    "dedup_user_rows": f"""SELECT DISTINCT {JOURNEY}, conversion_value, num_touchpoints,
        coalesce(p.product_arrangement_id, 0) AS product_arrangement_id, is_app_conversion,
        round(o.ltv_acquisition_capped_12m, 6) AS ltv_acquisition_capped_12m
        FROM journeys LEFT JOIN ({DEDUP_LTV}) p USING (user_guid, conversion_type, run_date)
        LEFT JOIN orders o ON o.product_arrangement_id = coalesce(p.product_arrangement_id, 0)
            AND o.run_date = journeys.run_date
        WHERE conversion_value = 1""".replace(
        "DISTINCT run_date", "DISTINCT journeys.run_date"
    ),
    "ltv_mean_dedup": """SELECT user_guid, product_order_timestamp, product_arrangement_id,
        round(avg(ltv_acquisition_capped_12m), 6) AS ltv_acquisition_capped_12m FROM user_ltv
        WHERE ltv_acquisition_capped_12m IS NOT NULL GROUP BY ALL""",
    "avg_ltv_per_channel": f"SELECT {COHORT}, channel, {rounded(['average_ltv'])} FROM averages",
    "median_days_to_convert": f"""SELECT {STAGE}, median(days) AS median_days, run_date, conversion_window FROM (
        SELECT {COHORT}, user_guid, (epoch_us(min(attribution_visit_start_time) FILTER (flag = 1))
            - epoch_us(min(attribution_visit_start_time) FILTER (flag = 0))) // 86400000000 AS days
        FROM touches GROUP BY ALL) GROUP BY {COHORT}""",
    "median_days_by_conv_date": f"""SELECT {STAGE}, run_date, median(time_to_convert) AS median_days FROM stage_rows
        GROUP BY conversion_type, run_date""",
    "user_first_last": """SELECT user_guid, min(attribution_visit_start_time) AS first_visit,
        max(attribution_visit_start_time) AS last_visit FROM visits GROUP BY ALL""",
    "channel_totals": TOTALS,
    "build_journeys": f"SELECT {JOURNEY}, position, touch_count, channel, conversion_value FROM touches",
    "attr_last_click": share_query(LAST),
    "attr_first_click": share_query(FIRST),
    "attr_position_based": share_query(POSITION),
    "attr_time_decay": share_query(DECAY),
    "attr_markov": share_query(MARKOV, "credited"),
    "markov_transitions": f"SELECT {COHORT}, source, destination, round_even(p, 3) AS probability FROM probs",
    "markov_removal_effect": f"SELECT {COHORT}, channel, {rounded(['removal_effect'])} FROM effects",
    "removal_effect_raw": f"SELECT {COHORT}, channel, {rounded(['removal_effect', 'removal_effect_raw'])} FROM effects",
    "journey_scores": "SELECT * EXCLUDE (journey_no) FROM texts",
    "num_touchpoints": f"SELECT journey_id, {COHORT}, num_touchpoints FROM texts",
    "rolling_cohort_90": HEURISTIC_TOTALS.format("rolling_heuristic"),
    "rolling_cohort_90_effects": f"""SELECT {COHORT}, channel, {rounded(['removal_effect', 'removal_effect_raw'])}
        FROM rolling_part_effects""",
    "removal_effect_ltv": "SELECT * FROM effect_texts",
    "explode_channel_ltv": f"""SELECT {COHORT}, channel, count(*) AS touches,
        {six('sum(' + six(f'c.{MARKOV} * ltv_acquisition_capped_12m') + ')')} AS total_ltv
        FROM credited c JOIN valued v USING ({JOURNEY})
        WHERE c.conversion_value = 1 AND ltv_acquisition_capped_12m IS NOT NULL GROUP BY ALL""",
    "source_frequency": SOURCE_FREQUENCY,
    "source_frequency_daily": SOURCE_FREQUENCY,
    "user_max_date": f"SELECT {COHORT}, user_guid, max(attribution_visit_start_time) AS last_visit FROM windowed GROUP BY ALL",
    "running_journey_no": f"""SELECT {COHORT}, count(*) AS touches, CAST(sum(journey_no) AS BIGINT) AS journey_sum,
        max(journey_no) AS last_journey FROM rolling_touches GROUP BY ALL""",
    "touch_lead": f"SELECT {JOURNEY}, position, channel, next_channel FROM touches",
    "share_of_total": f"""SELECT {COHORT}, channels,
        {six(f'{LAST} / nullif(sum({LAST}) OVER (PARTITION BY {COHORT}), 0) * 100')} AS {LAST} FROM totals""",
    "sort_user_time": f"""SELECT {JOURNEY}, position, attribution_visit_start_time, channel FROM touches""",
    "order_dates": f"SELECT DISTINCT {CONV_DATE} AS conversion_date FROM visits ORDER BY 1",
    "top1_per_user": """SELECT user_guid, conversion_visit_timestamp, product_arrangement_id FROM visits
        QUALIFY row_number() OVER (PARTITION BY user_guid
        ORDER BY conversion_visit_timestamp DESC, product_arrangement_id DESC, attribution_visit_start_time DESC) = 1""",
    "union_cohorts": HEURISTIC_TOTALS.format("heuristic"),
    "union_all_literal": f"""SELECT product_arrangement_id AS id FROM visits WHERE converting_visit = 1
        UNION ALL SELECT NULL FROM (SELECT DISTINCT {CONV_DATE} FROM visits WHERE converting_visit = 1)""",
    "filter_downstream": """SELECT product_arrangement_id AS id FROM visits
        WHERE converting_visit = 1 AND product_arrangement_id IS NOT NULL""",
    "melt_matrix": f"""SELECT {COHORT}, source, destination, round_even(p, 3) AS probability, width - count(*) OVER (
            PARTITION BY {COHORT}, source) AS zeros
        FROM probs JOIN (SELECT {COHORT}, count(DISTINCT destination) AS width FROM edges GROUP BY ALL) USING ({COHORT})""",
    "explode_rows": f"""SELECT 'id:' || user_guid || '_J:' || journey_no AS journey_id, {COHORT}, position, channel
        FROM touches""",
    "type_window_slices": f"""SELECT conversion_window, conversion_type, count(*) AS touches,
        count(DISTINCT channel) AS channels, {six(f'sum({MARKOV})')} AS credit FROM credited GROUP BY ALL""",
    "json_fields": f"""SELECT event_time, customer_user_id,
        TRY_CAST({json_text('AFEventParamRevenue')} AS BIGINT) AS AFEventParamRevenue,
        round(TRY_CAST({json_text('af_revenue')} AS DOUBLE), 6) AS af_revenue,
        {json_text('af_currency')} AS af_currency, {json_text('af_order_id')} AS af_order_id FROM app_events""",
    "check_not_null": """SELECT 'not_null:user_guid' AS rule, count(*) FILTER (user_guid IS NULL) AS violations FROM visits
        UNION ALL SELECT 'not_null:visit_traffic_source_name', count(*) FILTER (visit_traffic_source_name IS NULL) FROM visits
        UNION ALL SELECT 'not_null:segment_channel', count(*) FILTER (segment_channel IS NULL) FROM visits
        UNION ALL SELECT 'not_null:media_source', count(*) FILTER (media_source IS NULL) FROM app_events
        UNION ALL SELECT 'not_null:customer_user_id', count(*) FILTER (customer_user_id IS NULL) FROM app_events""",
    "check_accepted_values": """SELECT 'accepted_values:conversion_type' AS rule,
        count(*) FILTER (conversion_type NOT IN ('Trial', 'Subscription')) AS violations FROM visits
        UNION ALL SELECT 'accepted_values:visit_device_type',
        count(*) FILTER (visit_device_type NOT IN ('desktop', 'mobile')) FROM visits""",
    "check_unique": """SELECT 'unique:ltv_acquisition_capped_12m' AS rule, count(*) AS violations FROM (
        SELECT ltv_acquisition_capped_12m AS v FROM user_ltv WHERE v IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'unique:product_arrangement_id', count(*) FROM (
        SELECT product_arrangement_id FROM user_ltv GROUP BY 1 HAVING count(*) > 1)""",
}

# Result sizes of a run on full touchpoints.
PIECES["full_windowed"] = f"""
    SELECT *, {TOUCHPOINT} AS label FROM ({window_rows('classified', 'v.*')})
    WHERE run_date BETWEEN {AS_OF} - 15 AND {AS_OF} - 1"""
PIECES["full_touches"] = touches("full_windowed", FLAGS["last_visit"])
PIECES["full_channels"] = f"SELECT count(*) AS n FROM (SELECT DISTINCT {COHORT}, channel FROM full_touches)"
_BODY["full_run"] = f"""
    SELECT 'user_journeys' AS result, count(*) AS rows FROM valued
    UNION ALL SELECT 'channel_level', n FROM full_channels
    UNION ALL SELECT 'transitions', count(DISTINCT ({COHORT}, channel,
            coalesce(next_channel, CASE WHEN flag = 1 THEN '(conversion)' ELSE '(null)' END)))
        FILTER (channel IS DISTINCT FROM next_channel)
        + count(DISTINCT ({COHORT}, channel)) FILTER (position = 1) FROM full_touches
    UNION ALL SELECT 'removal_effects', n FROM full_channels
    UNION ALL SELECT 'conversion_time', count(DISTINCT ({COHORT})) FROM full_touches
    UNION ALL SELECT 'mart_channel', n FROM full_channels
    UNION ALL SELECT 'mart_removal_ltv', n FROM full_channels"""

_STATES = f"""SELECT {COHORT}, source AS state FROM platform_edges UNION SELECT {COHORT}, destination FROM platform_edges
    UNION SELECT {COHORT}, e FROM platform_edges, (VALUES ('(null)'), ('(conversion)')) t(e)"""
_BODY["markov_matrix_dense"] = f"""
    SELECT {COHORT}, source, destination,
        CASE WHEN source = destination AND source IN ('(null)', '(conversion)') THEN 1
            ELSE coalesce(round_even(p, 3), 0) END AS probability
    FROM (SELECT {COHORT}, state AS source FROM ({_STATES}))
    JOIN (SELECT {COHORT}, state AS destination FROM ({_STATES})) USING ({COHORT})
    LEFT JOIN platform_probs USING ({COHORT}, source, destination)"""


def oracle_sql() -> dict[str, str]:
    return {name: query(body) for name, body in _BODY.items()}
