"""Independent DuckDB formulations of the registered queries (the driver's
correctness oracle). Tables ``events`` and ``documents`` are pre-registered
views. The raw stand-in is rebuilt with plain columns (one column per event
param) instead of a key/value array - except for the param-lookup queries,
which build the array and search it with ``list_filter`` - and the
attribution uses ``row_number`` picks and a ``last_value IGNORE NULLS``
RANGE window instead of arg-min/arg-max aggregates."""

from __future__ import annotations

INIT_RANGE = ("20231231", "20240130")
UPDATE_DAY = "20240115"
UPDATE_START = "20231216"
SHARD_RANGE = ("20240105", "20240112")

RAW = """
b AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         epoch_us(ts) AS us,
         event_id % 20 AS m
  FROM events
),
mt(m, p_source, p_medium, p_campaign, p_gclid, suffix) AS (
  VALUES (0, NULL, NULL, NULL, NULL, '/p'), (1, NULL, NULL, NULL, NULL, '/p'),
         (2, NULL, NULL, NULL, NULL, '/p'), (3, NULL, NULL, NULL, NULL, '/p'),
         (4, NULL, NULL, NULL, NULL, '/p'), (5, NULL, NULL, NULL, NULL, '/p'),
         (6, NULL, NULL, NULL, NULL, '/p?fbclid=1'),
         (7, 'google', 'organic', NULL, NULL, '/p'),
         (8, 'google', 'cpc', 'brand', NULL, '/p?gclid=1'),
         (9, NULL, NULL, NULL, 'g1', '/p'),
         (10, 'facebook', 'social', NULL, NULL, '/p?fbclid=1'),
         (11, 'tiktok', 'referral', 'x', NULL, '/p?ttclid=1'),
         (12, 'bing', 'organic', NULL, NULL, '/p?msclkid=1'),
         (13, 'newsletter', 'email', 'weekly', NULL, '/p'),
         (14, 'youtube', 'video', NULL, NULL, '/p'),
         (15, 'partner', 'affiliate', NULL, NULL, '/p'),
         (16, 'amazon', 'cpc', 'eshop-sale', NULL, '/p'),
         (17, NULL, NULL, 'cross-network', NULL, '/p'),
         (18, 'blog.example', 'referral', NULL, NULL, '/p'),
         (19, '(direct)', '(none)', NULL, NULL, '/p')
),
r0 AS (
  SELECT b.*, mt.p_source, mt.p_medium, mt.p_campaign, mt.p_gclid, mt.suffix,
         CASE WHEN b.event_id % 89 = 0 THEN NULL
              ELSE ((b.us // 1000000 - 43200) // 86400) * 86400 + 43200 END AS gsid
  FROM b JOIN mt ON b.m = mt.m
),
raw AS (
  SELECT
    event_id, k, value,
    strftime(ts, '%Y%m%d') AS event_date,
    us AS event_timestamp,
    CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'session_start'
                    WHEN 'signup' THEN 'first_visit' WHEN 'error' THEN 'exception'
                    WHEN 'purchase' THEN 'purchase' END AS event_name,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'u' || CAST(user_id AS VARCHAR) END AS user_pseudo_id,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CAST(gsid AS BIGINT) AS ga_session_id,
    CAST((gsid - 1703980800) // 172800 AS BIGINT) AS ga_session_number,
    'https://shop.example' || suffix AS page_location,
    'Page ' || CAST(k % 10 AS VARCHAR) AS page_title,
    p_source AS source, p_medium AS medium, p_campaign AS campaign, p_gclid AS gclid,
    CASE WHEN event_id % 5 = 0 THEN CAST(1 AS BIGINT) END AS entrances,
    CASE WHEN k % 3 = 0 THEN '1' END AS engaged_string,
    CASE WHEN k % 3 = 1 THEN CAST(0 AS BIGINT) END AS engaged_int,
    CAST(k * 100 AS BIGINT) AS engagement_time_msec,
    value AS score,
    (['desktop', 'mobile', 'tablet'])[k % 3 + 1] AS device_category,
    (['en', 'fr', 'de', 'es', 'en-us', 'om', 'EN', NULL])[event_id % 8 + 1] AS device_language,
    'x' || CAST(k % 4 AS VARCHAR) AS x4,
    event_type = 'purchase' AS is_purchase
  FROM r0
)"""


# Two thirds of the events without a user, half of them without a session.
ANONYMOUS_RAW = """
raw AS (
  SELECT * REPLACE (
    CASE event_timestamp % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE user_pseudo_id END AS user_pseudo_id,
    CASE WHEN event_timestamp % 3 = 2 OR event_timestamp % 2 = 1 THEN ga_session_id END AS ga_session_id,
    CASE WHEN event_timestamp % 3 = 2 OR event_timestamp % 2 = 1 THEN ga_session_number END AS ga_session_number)
  FROM raw0
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def _src(where: str) -> str:
    return f"""
src AS (
  SELECT CAST(strptime(event_date, '%Y%m%d') AS DATE) AS date,
         coalesce(user_pseudo_id, '') || coalesce(CAST(ga_session_id AS VARCHAR), '') AS session_id,
         user_pseudo_id, ga_session_id AS session_start,
         source, medium, campaign, gclid, event_timestamp, page_location
  FROM raw
  WHERE ({where}) AND event_name NOT IN ('session_start', 'first_visit')
)"""


# The click-id rules: (pattern of the page, source, medium); the first also holds where gclid is present.
CLICK_IDS = (("http%gclid=%", "google", "cpc"), ("http%fbclid=%", "facebook", "paid social"),
             ("http%ttclid=%", "tiktok", "paid social"), ("http%msclkid=%", "bing", "cpc"))


def _touch_cte() -> str:
    """Touch struct fields per event, from the click-id rule table."""
    any_param = "coalesce(source, medium, campaign, gclid)"

    def override(field: int, fallback: str) -> str:
        arms = []
        for i, rule in enumerate(CLICK_IDS):
            test = f"page_location LIKE '{rule[0]}'"
            if i == 0:
                test = f"(gclid IS NOT NULL OR {test})"
            arms.append(f"WHEN {test} THEN '{rule[field]}'")
        return f"CASE WHEN {any_param} IS NULL THEN NULL " + " ".join(arms) + f" ELSE {fallback} END"

    return f"""
touch AS (
  SELECT *,
    {any_param} IS NOT NULL AS has_touch,
    {override(1, 'source')} AS t_source,
    {override(2, 'medium')} AS t_medium,
    CASE WHEN {any_param} IS NOT NULL THEN campaign END AS t_campaign,
    CASE WHEN {any_param} IS NOT NULL THEN gclid END AS t_gclid
  FROM src
)"""


TOUCH = _touch_cte()

PREP = """
ranked AS (
  SELECT *,
    row_number() OVER (PARTITION BY session_id, user_pseudo_id, session_start
                       ORDER BY event_timestamp ASC NULLS FIRST, has_touch DESC, t_source NULLS FIRST,
                         t_medium NULLS FIRST, t_campaign NULLS FIRST, t_gclid NULLS FIRST) AS rn_first,
    row_number() OVER (PARTITION BY session_id, user_pseudo_id, session_start
                       ORDER BY has_touch DESC, event_timestamp DESC) AS rn_last
  FROM touch
),
prep AS (
  SELECT min(date) AS date, session_id, user_pseudo_id, session_start,
    bool_or(rn_first = 1 AND has_touch) AS has_first,
    max(CASE WHEN rn_first = 1 THEN t_source END) AS first_source,
    max(CASE WHEN rn_first = 1 THEN t_medium END) AS first_medium,
    max(CASE WHEN rn_first = 1 THEN t_campaign END) AS first_campaign,
    max(CASE WHEN rn_first = 1 THEN t_gclid END) AS first_gclid,
    bool_or(rn_last = 1 AND has_touch) AS has_last,
    max(CASE WHEN rn_last = 1 AND has_touch THEN t_source END) AS last_source,
    max(CASE WHEN rn_last = 1 AND has_touch THEN t_medium END) AS last_medium,
    max(CASE WHEN rn_last = 1 AND has_touch THEN t_campaign END) AS last_campaign,
    max(CASE WHEN rn_last = 1 AND has_touch THEN t_gclid END) AS last_gclid
  FROM ranked
  GROUP BY session_id, user_pseudo_id, session_start
)"""


def _stg(lookback: int, keep: str = "TRUE") -> str:
    return f"""
filled AS (
  SELECT *,
    last_value(CASE WHEN has_last THEN {{'s': last_source, 'm': last_medium, 'c': last_campaign}} END IGNORE NULLS)
      OVER (PARTITION BY user_pseudo_id ORDER BY session_start ASC NULLS FIRST
            RANGE BETWEEN {lookback} PRECEDING AND CURRENT ROW) AS lb
  FROM prep
),
stg AS (
  SELECT session_id, user_pseudo_id, date, session_start,
    coalesce(CASE WHEN has_first THEN first_source ELSE lb.s END, '(direct)') AS source,
    coalesce(CASE WHEN has_first THEN first_medium ELSE lb.m END, '(none)') AS medium,
    coalesce(CASE WHEN has_first THEN first_campaign ELSE lb.c END, '(not set)') AS campaign
  FROM filled
  WHERE {keep}
)"""


def _flat(where: str) -> str:
    return f"""
flat AS (
  SELECT
    coalesce(user_pseudo_id, '') || coalesce(CAST(ga_session_id AS VARCHAR), '') AS session_id,
    CAST(strptime(event_date, '%Y%m%d') AS DATE) AS event_date,
    make_timestamp(event_timestamp) AS event_timestamp,
    event_name, ga_session_number, ga_session_id, page_location, page_title, entrances,
    coalesce(engaged_string, CAST(engaged_int AS VARCHAR)) AS session_engaged,
    user_id, user_pseudo_id, device_category, device_language,
    x4 AS device_browser, x4 AS device_browser_version, x4 AS device_operating_system,
    x4 AS device_operating_system_version, x4 AS device_brand_name, x4 AS device_mobile_model_name,
    x4 AS geo_country, x4 AS geo_city, x4 AS geo_region,
    x4 AS user_source, x4 AS user_medium, x4 AS user_campaign,
    CASE WHEN is_purchase THEN CAST(k % 3 AS BIGINT) END AS ecommerce_total_item_quantity,
    CASE WHEN is_purchase THEN value END AS ecommerce_purchase_revenue,
    CAST(NULL AS DOUBLE) AS ecommerce_refund_value,
    CASE WHEN is_purchase THEN CAST(1.5 AS DOUBLE) END AS ecommerce_shipping_value,
    CASE WHEN is_purchase THEN CAST(0.25 AS DOUBLE) END AS ecommerce_tax_value,
    CASE WHEN is_purchase THEN CAST(k % 3 AS BIGINT) END AS ecommerce_unique_items,
    CASE WHEN is_purchase THEN 't' || CAST(event_id AS VARCHAR) END AS ecommerce_transaction_id,
    coalesce(event_timestamp - lag(event_timestamp) OVER (
        PARTITION BY user_pseudo_id, ga_session_id ORDER BY event_timestamp), 0) / 1000000 AS previous_timestamp,
    CASE WHEN event_timestamp = max(event_timestamp) OVER (PARTITION BY user_pseudo_id, ga_session_number)
         THEN CAST(1 AS BIGINT) END AS exit_page,
    engagement_time_msec
  FROM raw
  WHERE {where}
)"""


EVENTS_SELECT = """
SELECT f.*, s.source AS session_source, s.medium AS session_medium, s.campaign AS session_campaign,
       s.session_start AS session_start
FROM flat f LEFT JOIN stg s ON f.session_id = s.session_id"""

SRC_SELECT = """
SELECT date, session_id, user_pseudo_id, session_start,
       source AS traffic_source, medium AS traffic_medium, campaign AS traffic_campaign, gclid AS traffic_gclid,
       event_timestamp, page_location
FROM src"""


def _items(where: str) -> str:
    return f"""{_with(RAW)}
SELECT CAST(strptime(event_date, '%Y%m%d') AS DATE) AS date,
       'item' || CAST((k + i) % 10 AS VARCHAR) AS item_name,
       CASE WHEN i = 1 THEN NULL ELSE 'v' || CAST(i AS VARCHAR) END AS item_variant,
       CAST(k % 5 + 1 AS BIGINT) AS item_quantity,
       value AS item_revenue
FROM raw CROSS JOIN range(0, 2) AS r(i)
WHERE ({where}) AND event_name = 'purchase' AND i < k % 3"""


INIT_WHERE = f"event_date BETWEEN '{INIT_RANGE[0]}' AND '{INIT_RANGE[1]}'"
UPDATE_WHERE = f"event_date = '{UPDATE_DAY}'"
UPDATE_SRC_WHERE = f"event_date BETWEEN '{UPDATE_START}' AND '{UPDATE_DAY}'"
UPDATE_KEEP = f"date = DATE '{UPDATE_DAY[:4]}-{UPDATE_DAY[4:6]}-{UPDATE_DAY[6:]}'"

PARAM_ARRAY = """
arr AS (
  SELECT event_timestamp, event_date, list_filter([
      CASE WHEN ga_session_id IS NOT NULL THEN {'key': 'ga_session_id', 'value': {'string_value': NULL::VARCHAR, 'int_value': ga_session_id, 'float_value': NULL::DOUBLE, 'double_value': NULL::DOUBLE}} END,
      CASE WHEN ga_session_number IS NOT NULL THEN {'key': 'ga_session_number', 'value': {'string_value': NULL::VARCHAR, 'int_value': ga_session_number, 'float_value': NULL::DOUBLE, 'double_value': NULL::DOUBLE}} END,
      {'key': 'page_location', 'value': {'string_value': page_location, 'int_value': NULL::BIGINT, 'float_value': NULL::DOUBLE, 'double_value': NULL::DOUBLE}},
      {'key': 'page_title', 'value': {'string_value': page_title, 'int_value': NULL::BIGINT, 'float_value': NULL::DOUBLE, 'double_value': NULL::DOUBLE}},
      CASE WHEN campaign IS NOT NULL THEN {'key': 'campaign', 'value': {'string_value': campaign, 'int_value': NULL::BIGINT, 'float_value': NULL::DOUBLE, 'double_value': NULL::DOUBLE}} END,
      CASE WHEN entrances IS NOT NULL THEN {'key': 'entrances', 'value': {'string_value': NULL::VARCHAR, 'int_value': entrances, 'float_value': NULL::DOUBLE, 'double_value': NULL::DOUBLE}} END,
      CASE WHEN engaged_string IS NOT NULL THEN {'key': 'session_engaged', 'value': {'string_value': engaged_string, 'int_value': NULL::BIGINT, 'float_value': NULL::DOUBLE, 'double_value': NULL::DOUBLE}} END,
      CASE WHEN engaged_int IS NOT NULL THEN {'key': 'session_engaged', 'value': {'string_value': NULL::VARCHAR, 'int_value': engaged_int, 'float_value': NULL::DOUBLE, 'double_value': NULL::DOUBLE}} END,
      {'key': 'engagement_time_msec', 'value': {'string_value': NULL::VARCHAR, 'int_value': engagement_time_msec, 'float_value': NULL::DOUBLE, 'double_value': NULL::DOUBLE}},
      CASE WHEN k % 2 = 0 THEN {'key': 'score', 'value': {'string_value': NULL::VARCHAR, 'int_value': NULL::BIGINT, 'float_value': score, 'double_value': NULL::DOUBLE}}
           ELSE {'key': 'score', 'value': {'string_value': NULL::VARCHAR, 'int_value': NULL::BIGINT, 'float_value': NULL::DOUBLE, 'double_value': score}} END
    ], lambda e: e IS NOT NULL) AS ep
  FROM raw
)"""


def _p(key: str, field: str) -> str:
    return f"list_filter(ep, lambda p: p.key = '{key}')[1].value.{field}"


PARAM_EXTRACT = f"""{_with(RAW, PARAM_ARRAY)}
SELECT event_timestamp,
       {_p('ga_session_id', 'int_value')} AS ga_session_id,
       {_p('ga_session_number', 'int_value')} AS ga_session_number,
       {_p('page_location', 'string_value')} AS page_location,
       {_p('page_title', 'string_value')} AS page_title,
       {_p('campaign', 'string_value')} AS campaign,
       {_p('entrances', 'int_value')} AS entrances,
       {_p('session_engaged', 'string_value')} AS engaged_string,
       {_p('session_engaged', 'int_value')} AS engaged_int,
       coalesce({_p('score', 'float_value')}, {_p('score', 'double_value')}) AS score,
       {_p('engagement_time_msec', 'int_value')} AS engagement_time_msec
FROM arr
WHERE {INIT_WHERE}"""


def _stg_query(lookback: int, src_where: str = INIT_WHERE, keep: str = "TRUE") -> str:
    return f"{_with(RAW, _src(src_where), TOUCH, PREP, _stg(lookback, keep))}\nSELECT * FROM stg"


def _events_query(flat_where: str, src_where: str, keep: str = "TRUE") -> str:
    return f"{_with(RAW, _src(src_where), TOUCH, PREP, _stg(2592000, keep), _flat(flat_where))}{EVENTS_SELECT}"


EVENTS_FLAT_COLUMNS = """session_id, event_date, event_timestamp, event_name, ga_session_number, ga_session_id,
  page_location, page_title, entrances, session_engaged, user_id, user_pseudo_id, device_category, device_language,
  device_browser, device_browser_version, device_operating_system, device_operating_system_version,
  device_brand_name, device_mobile_model_name, geo_country, geo_city, geo_region, user_source, user_medium,
  user_campaign, ecommerce_total_item_quantity, ecommerce_purchase_revenue, ecommerce_refund_value,
  ecommerce_shipping_value, ecommerce_tax_value, ecommerce_unique_items, ecommerce_transaction_id,
  engagement_time_msec"""

# The channel rules over columns s, m, c; DuckDB's regexp_matches is RE2, the rules' own dialect.
CHANNEL_CASE = """CASE
  WHEN s = '(direct)' AND m IN ('(not set)', '(none)') THEN 'Direct'
  WHEN regexp_matches(c, 'cross-network') THEN 'Cross-network'
  WHEN ({shopping}) AND {paid} THEN 'Paid Shopping'
  WHEN {search} AND {paid} THEN 'Paid Search'
  WHEN {social} AND {paid} THEN 'Paid Social'
  WHEN {video} AND {paid} THEN 'Paid Video'
  WHEN m IN ('display', 'banner', 'expandable', 'interstitial', 'cpm') THEN 'Display'
  WHEN {shopping} THEN 'Organic Shopping'
  WHEN {social} OR m IN ('social', 'social-network', 'social-media', 'sm', 'social network', 'social media')
    THEN 'Organic Social'
  WHEN {video} OR regexp_matches(m, '^(.*video.*)$') THEN 'Organic Video'
  WHEN {search} OR m = 'organic' THEN 'Organic Search'
  WHEN {email_source} OR {email_medium} THEN 'Email'
  WHEN m = 'affiliate' THEN 'Affiliates'
  WHEN m = 'referral' THEN 'Referral'
  WHEN m = 'audio' THEN 'Audio'
  WHEN m = 'sms' THEN 'SMS'
  WHEN regexp_matches(m, 'push$') OR regexp_matches(m, 'mobile|notification') THEN 'Mobile Push Notifications'
  ELSE 'Unassigned'
END""".format(
    shopping="regexp_matches(s, 'alibaba|amazon|google shopping|shopify|etsy|ebay|stripe|walmart') "
             "OR regexp_matches(c, '^(.*(([^a-df-z]|^)shop|shopping).*)$')",
    paid="regexp_matches(m, '^(.*cp.*|ppc|paid.*)$')",
    search="regexp_matches(s, 'baidu|bing|duckduckgo|ecosia|google|yahoo|yandex')",
    social="regexp_matches(s, 'badoo|facebook|fb|instagram|linkedin|pinterest|tiktok|twitter|whatsapp')",
    video="regexp_matches(s, 'dailymotion|disneyplus|netflix|youtube|vimeo|twitch|vimeo|youtube')",
    email_source="regexp_matches(s, 'email|e-mail|e_mail|e mail')",
    email_medium="regexp_matches(m, 'email|e-mail|e_mail|e mail')")



def _language_values() -> str:
    from touchline.functions.languages import LANGUAGE_NAMES

    def q(v: str) -> str:
        return "'" + v.replace("'", "''") + "'"

    return ", ".join(f"({q(a)}, {q(b)})" for a, b in LANGUAGE_NAMES)


def _struct_cols(prefix: str, has: str, cols: str) -> str:
    return ", ".join([f"{has} AS has_{prefix}"] + [f"{prefix}_{f}" for f in cols.split()])


def oracle_sql() -> dict[str, str]:
    stg_keys = "session_id, user_pseudo_id, session_start"
    langs = f"lang(code, name) AS (VALUES {_language_values()})"
    sessionized = _events_query(INIT_WHERE, INIT_WHERE)
    return {
        "param_extract": PARAM_EXTRACT,
        "param_extract_sqlfn": PARAM_EXTRACT,
        "param_extract_strict": PARAM_EXTRACT,
        "event_traffic": f"{_with(RAW, _src(INIT_WHERE))}{SRC_SELECT}",
        "click_id_touch": f"""{_with(RAW, _src(INIT_WHERE), TOUCH)}
SELECT event_timestamp, session_id, has_touch, t_source AS touch_source, t_medium AS touch_medium,
       t_campaign AS touch_campaign, t_gclid AS touch_gclid
FROM touch""",
        "session_first_touch": f"""{_with(RAW, _src(INIT_WHERE), TOUCH, PREP)}
SELECT {stg_keys}, {_struct_cols('first', 'has_first', 'source medium campaign gclid')} FROM prep""",
        "session_last_touch": f"""{_with(RAW, _src(INIT_WHERE), TOUCH, PREP)}
SELECT {stg_keys}, {_struct_cols('last', 'has_last', 'source medium campaign gclid')} FROM prep""",
        "session_rollup": f"""{_with(RAW, _src(INIT_WHERE), TOUCH, PREP)}
SELECT date, {stg_keys}, {_struct_cols('first', 'has_first', 'source medium campaign gclid')},
       {_struct_cols('last', 'has_last', 'source medium campaign gclid')} FROM prep""",
        "session_rollup_from_day_partials": f"""{_with(RAW, _src(INIT_WHERE), TOUCH, PREP)}
SELECT date, {stg_keys}, {_struct_cols('first', 'has_first', 'source medium campaign gclid')},
       {_struct_cols('last', 'has_last', 'source medium campaign gclid')} FROM prep""",
        "session_traffic_30d": _stg_query(2592000),
        "session_traffic_30d_window": _stg_query(2592000),
        "session_traffic_30d_split": _stg_query(2592000),
        "session_traffic_30d_from_day_partials": _stg_query(2592000),
        "session_traffic_2d": _stg_query(172800),
        "session_traffic_2d_window": _stg_query(172800),
        "events_flat_extra": f"{_with(RAW, _flat(INIT_WHERE))}\nSELECT {EVENTS_FLAT_COLUMNS}, score, campaign FROM (SELECT flat.*, raw.score, raw.campaign FROM flat JOIN raw ON make_timestamp(raw.event_timestamp) = flat.event_timestamp AND raw.event_name IS NOT DISTINCT FROM flat.event_name AND raw.user_pseudo_id IS NOT DISTINCT FROM flat.user_pseudo_id AND raw.ga_session_id IS NOT DISTINCT FROM flat.ga_session_id)",
        "events_flat": f"{_with(RAW, _flat(INIT_WHERE))}\nSELECT {EVENTS_FLAT_COLUMNS} FROM flat",
        "seconds_since_previous": f"""{_with(RAW, _flat(INIT_WHERE))}
SELECT event_timestamp, user_pseudo_id, ga_session_id, previous_timestamp FROM flat""",
        "seconds_since_previous_window": f"""{_with(RAW, _flat(INIT_WHERE))}
SELECT event_timestamp, user_pseudo_id, ga_session_id, previous_timestamp FROM flat""",
        "seconds_since_previous_split": f"""{_with(RAW, _flat(INIT_WHERE))}
SELECT event_timestamp, user_pseudo_id, ga_session_id, previous_timestamp FROM flat""",
        "exit_flag": f"""{_with(RAW, _flat(INIT_WHERE))}
SELECT event_timestamp, user_pseudo_id, ga_session_number, exit_page FROM flat""",
        "exit_flag_window": f"""{_with(RAW, _flat(INIT_WHERE))}
SELECT event_timestamp, user_pseudo_id, ga_session_number, exit_page FROM flat""",
        "exit_flag_bucketed": f"""{_with(RAW, _flat(INIT_WHERE))}
SELECT event_timestamp, user_pseudo_id, ga_session_number, exit_page FROM flat""",
        "events_sessionized": sessionized,
        "session_key_fanout": f"""{_with(RAW.replace("raw AS (", "raw0 AS ("), ANONYMOUS_RAW, _src(INIT_WHERE), TOUCH, PREP,
                                         _stg(2592000), _flat(INIT_WHERE))}
SELECT f.event_timestamp, f.session_id, f.user_pseudo_id, f.previous_timestamp, f.exit_page, s.source AS session_source,
       s.medium AS session_medium, s.campaign AS session_campaign, s.session_start
FROM flat f LEFT JOIN stg s ON f.session_id = s.session_id""",
        "purchase_items": _items(INIT_WHERE),
        "shard_range_scan": f"""{_with(RAW)}
SELECT event_date, event_timestamp, event_name, user_pseudo_id, ga_session_id FROM raw
WHERE event_date BETWEEN '{SHARD_RANGE[0]}' AND '{SHARD_RANGE[1]}'""",
        "shard_point_scan": f"""{_with(RAW)}
SELECT event_date, event_timestamp, event_name, user_pseudo_id, ga_session_id FROM raw
WHERE event_date = '{UPDATE_DAY}'""",
        "shard_suffix_scan": f"""{_with(RAW)}
SELECT event_date, event_timestamp, event_name, user_pseudo_id, ga_session_id, event_date AS table_suffix FROM raw
WHERE event_date BETWEEN '{SHARD_RANGE[0]}' AND '{SHARD_RANGE[1]}'""",
        "channel_grouping": f"""WITH ev AS ({sessionized})
SELECT event_timestamp, session_source, session_medium, session_campaign,
       {CHANNEL_CASE.replace(chr(10), chr(10) + '       ')} AS channel
FROM (SELECT *, session_source AS s, session_medium AS m, session_campaign AS c FROM ev)""",
        "language_name": f"""{_with(RAW, langs)}
SELECT make_timestamp(event_timestamp) AS event_timestamp, device_language,
       coalesce(lang.name, device_language) AS language_name
FROM raw LEFT JOIN lang ON raw.device_language = lang.code
WHERE {INIT_WHERE}""",
        "language_name_column": f"""{_with(RAW, langs)}
SELECT device_language, count(*) AS n_events, coalesce(any_value(lang.name), device_language) AS language_name
FROM raw LEFT JOIN lang ON raw.device_language = lang.code WHERE {INIT_WHERE} GROUP BY device_language""",
        "document_language_name": f"""WITH {langs}
SELECT doc_id, documents.lang, coalesce(l.name, documents.lang) AS language_name
FROM documents LEFT JOIN lang AS l ON documents.lang = l.code""",
        "sessions_by_channel": f"""{_with(RAW, _src(INIT_WHERE), TOUCH, PREP, _stg(2592000))}
SELECT session_id, user_pseudo_id, date, session_start, source, medium, campaign,
       {CHANNEL_CASE} AS channel
FROM (SELECT *, source AS s, medium AS m, campaign AS c FROM stg)""",
        "init_src_table": f"{_with(RAW, _src(INIT_WHERE))}{SRC_SELECT}",
        "init_stg_table": _stg_query(2592000),
        "init_events_table": sessionized,
        "init_items_table": _items(INIT_WHERE),
        "update_src_day": f"{_with(RAW, _src(UPDATE_WHERE))}{SRC_SELECT}",
        "update_stg_day": _stg_query(2592000, UPDATE_SRC_WHERE, UPDATE_KEEP),
        "update_events_day": _events_query(UPDATE_WHERE, UPDATE_SRC_WHERE, UPDATE_KEEP),
        "update_items_day": _items(UPDATE_WHERE),
    }
