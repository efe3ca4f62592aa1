"""events table: flattened events (P8), seconds since the previous event of
the session (P9), exit flag (P10) and the session's traffic source (P11)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.dates import micros_to_timestamp, shard_to_date
from touchline.functions.params import float_param, int_param, one_value_per_key, string_or_int_param, string_param
from touchline.operators.ordered import PIECE, join_keys, lag_in_pieces, large_cuts, max_by_join, max_in_groups, not_null_keys
from touchline.operators.traffic import session_key
from touchline.schema import EVENT_COLUMNS, FLAT_EVENT_COLUMNS, SESSION_SOURCE_COLUMNS
from touchline.session import materialize

MICROS = "_us"
# Names of the (user, session) group of an event: keys that are not NULL.
GROUP = ["_user", "_session", "_nulls"]
# Kinds of extra event params: the lookup and the column type.
PARAM_KINDS = {"string": string_param, "int": int_param, "float": float_param}
PARAM_TYPES = {"string": T.StringType(), "int": T.LongType(), "float": T.DoubleType()}
# Keys that ``flatten_events`` looks up.
EVENT_PARAMS = ("ga_session_id", "ga_session_number", "page_location", "page_title", "entrances", "session_engaged",
                "engagement_time_msec")
# (user, session) groups of more events than this are split for LAG and the
# session join, into pieces of about PIECE_EVENTS. Neither changes the result.
LARGE_GROUP = 100_000
PIECE_EVENTS = 50_000
# Width of the time buckets of exit_flag(method="bucketed").
BUCKET_MICROS = 60_000_000


def flatten_events(raw: DataFrame, strict: bool = False, extra_params: dict[str, str] | None = None) -> DataFrame:
    """The per-event projection (no event-name exclusion here). Keeps the
    raw epoch micros in ``_us`` for the two windows; ``event_timestamp`` is a
    UTC wall-clock TIMESTAMP_NTZ. ``extra_params`` adds further event params as
    columns of their name (kind "string", "int" or "float"); ``strict`` fails on
    an event that has one of the looked-up keys twice."""
    extra_params = extra_params or {}
    if taken := {k.lower() for k in extra_params} & {c.lower() for c in (*EVENT_COLUMNS, MICROS, *GROUP)}:
        raise ValueError(f"extra params named like columns of the events table: {sorted(taken)}")
    if strict:
        raw = one_value_per_key(raw, [*EVENT_PARAMS, *extra_params])
    extra = [PARAM_KINDS[kind](key).alias(key) for key, kind in extra_params.items()]
    gsid = int_param("ga_session_id")
    dev, web, geo, uts, ec = (F.col(c) for c in ("device", "device.web_info", "geo", "traffic_source", "ecommerce"))
    return raw.select(
        session_key(F.col("user_pseudo_id"), gsid).alias("session_id"),
        shard_to_date(F.col("event_date")).alias("event_date"),
        micros_to_timestamp(F.col("event_timestamp")).alias("event_timestamp"),
        F.col("event_name"),
        int_param("ga_session_number").alias("ga_session_number"),
        gsid.alias("ga_session_id"),
        string_param("page_location").alias("page_location"),
        string_param("page_title").alias("page_title"),
        int_param("entrances").alias("entrances"),
        string_or_int_param("session_engaged").alias("session_engaged"),
        F.col("user_id"),
        F.col("user_pseudo_id"),
        dev.getField("category").alias("device_category"),
        dev.getField("language").alias("device_language"),
        web.getField("browser").alias("device_browser"),
        web.getField("browser_version").alias("device_browser_version"),
        dev.getField("operating_system").alias("device_operating_system"),
        dev.getField("operating_system_version").alias("device_operating_system_version"),
        dev.getField("mobile_brand_name").alias("device_brand_name"),
        dev.getField("mobile_model_name").alias("device_mobile_model_name"),
        geo.getField("country").alias("geo_country"),
        geo.getField("city").alias("geo_city"),
        geo.getField("region").alias("geo_region"),
        uts.getField("source").alias("user_source"),
        uts.getField("medium").alias("user_medium"),
        uts.getField("name").alias("user_campaign"),
        ec.getField("total_item_quantity").alias("ecommerce_total_item_quantity"),
        ec.getField("purchase_revenue").alias("ecommerce_purchase_revenue"),
        ec.getField("refund_value").alias("ecommerce_refund_value"),
        ec.getField("shipping_value").alias("ecommerce_shipping_value"),
        ec.getField("tax_value").alias("ecommerce_tax_value"),
        ec.getField("unique_items").alias("ecommerce_unique_items"),
        ec.getField("transaction_id").alias("ecommerce_transaction_id"),
        int_param("engagement_time_msec").alias("engagement_time_msec"),
        *extra,
        F.col("event_timestamp").alias(MICROS),
    )


PREVIOUS_KEYS = ("user_pseudo_id", "ga_session_id")
# Events sharing a timestamp (GA4 writes session_start / first_visit /
# page_view with one timestamp) are ordered by name, so the pick of which one
# gets the gap and which gets 0 is the same on every run and task retry.
LAG_TIEBREAK = ("event_name",)
EXIT_KEYS = ["user_pseudo_id", "ga_session_number"]


def event_sessions(flat: DataFrame) -> DataFrame:
    """One row per (user, session id, session number): its latest timestamp
    ``_last`` and number of events ``_n``. A narrow scan, combined map-side."""
    keys = [*PREVIOUS_KEYS, "ga_session_number"]
    return flat.groupBy(*keys).agg(F.max(MICROS).alias("_last"), F.count(F.lit(1)).alias("_n"))


def sessions_of_days(partials: DataFrame) -> DataFrame:
    """``event_sessions`` of the events that went into these session-day
    partials (of ``all_event_traffic``): no further scan of the events."""
    return partials.groupBy("user_pseudo_id", F.col("session_start").alias("ga_session_id"), "ga_session_number").agg(
        F.max("last_us").alias("_last"), F.sum("n_events").alias("_n"))


def grouped(df: DataFrame) -> DataFrame:
    return not_null_keys(df, dict(zip(GROUP, map(F.col, PREVIOUS_KEYS))))[0]


def large_group_cuts(flat: DataFrame, sessions: DataFrame | None, large_group: int = LARGE_GROUP) -> DataFrame | None:
    """Cuts of the groups with more than ``large_group`` events, or None."""
    counts = None
    if sessions is not None:
        counts = grouped(sessions).groupBy(*GROUP).agg(F.sum("_n").alias("n"))
    return large_cuts(grouped(flat), GROUP, MICROS, large_group, max(1, min(PIECE_EVENTS, large_group)), counts,
                      GROUP[0])


def _lagged(flat: DataFrame, cuts: DataFrame | None) -> DataFrame:
    out = lag_in_pieces(grouped(flat), GROUP, MICROS, "_prev", LAG_TIEBREAK, cuts)
    return out.withColumn("previous_timestamp", _seconds_since(F.col("_prev"))).drop("_prev")


def _seconds_since(previous: Column) -> Column:
    return F.coalesce(F.col(MICROS) - previous, F.lit(0)) / F.lit(1000000)


def seconds_since_previous(flat: DataFrame, method: str = "split", large_group: int = LARGE_GROUP) -> DataFrame:
    """(ts - previous ts of the same (user_pseudo_id, ga_session_id)) in
    seconds, 0 for the first event; ties on ts ordered by ``LAG_TIEBREAK``.
    ``method="split"`` splits groups of more than ``large_group`` events at
    quantiles of their time; ``method="window"`` is the direct LAG."""
    if method == "window":
        order = [F.col(c).asc_nulls_first() for c in (MICROS, *LAG_TIEBREAK)]
        previous = F.lag(MICROS).over(Window.partitionBy(*PREVIOUS_KEYS).orderBy(*order))
        return flat.withColumn("previous_timestamp", _seconds_since(previous))
    if method != "split":
        raise ValueError(f"unknown method {method!r}")
    return _lagged(flat, large_group_cuts(flat, None, large_group)).drop(*GROUP, PIECE)


def _is_last() -> Column:
    return F.when(F.col(MICROS) == F.col("_max"), F.lit(1).cast("bigint"))


def exit_flag(flat: DataFrame, method: str = "aggregate", bucket_micros: int = BUCKET_MICROS) -> DataFrame:
    """P10: 1 on every event whose timestamp is the max of its
    (user_pseudo_id, ga_session_number) group, else NULL. ``method``:
    "bucketed" (skew-safe: groups split by time bucket, the group max carried
    in), "aggregate" (grouped max joined back; hot keys left to AQE's skew
    join) or "window" (the direct window, one task per group)."""
    keys = EXIT_KEYS
    if method == "window":
        out = flat.withColumn("_max", F.max(MICROS).over(Window.partitionBy(*keys)))
    elif method == "bucketed":
        out = max_in_groups(flat, keys, MICROS, "_max", bucket_micros)
    elif method == "aggregate":
        out = max_by_join(flat, keys, MICROS, "_max")
    else:
        raise ValueError(f"unknown method {method!r}")
    return out.withColumn("exit_page", _is_last()).drop("_max")


def event_columns(raw: DataFrame, method: str = "split", strict: bool = False,
                  extra_params: dict[str, str] | None = None, large_group: int = LARGE_GROUP) -> DataFrame:
    """P8 + P9 + P10 in the 36-column order. ``method``: "split" (the
    skew-safe forms: LAG with large groups split, exit flag as a grouped max
    joined back) or "window" (both direct windows)."""
    flat = flatten_events(raw, strict, extra_params)
    flat = seconds_since_previous(flat, method, large_group)
    flat = exit_flag(flat, "window" if method == "window" else "aggregate")
    return flat.select(*FLAT_EVENT_COLUMNS, *(extra_params or {}))


def _session_side(stg: DataFrame) -> DataFrame:
    return stg.select(
        F.col("session_id").alias("_stg_session_id"),
        F.col("source").alias("session_source"),
        F.col("medium").alias("session_medium"),
        F.col("campaign").alias("session_campaign"),
        F.col("session_start"),
    )


def sessionize(events: DataFrame, stg: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """Left join on session_id alone (several stg rows can share one id;
    the join then fans out, as in the source). The planner picks a broadcast
    when the stg side is measured small (file size or AQE runtime stats), a
    sort-merge join otherwise, with AQE splitting skewed session ids."""
    side = _session_side(stg)
    joined = events.join(side, events["session_id"] == side["_stg_session_id"], "left")
    return joined.select(*EVENT_COLUMNS, *extra)


def build_events(raw: DataFrame, stg: DataFrame, method: str = "split", strict: bool = False,
                 extra_params: dict[str, str] | None = None, large_group: int = LARGE_GROUP,
                 sessions: DataFrame | None = None) -> DataFrame:
    """The 40-column events table: P8-P10, then the session source (P11), then
    any extra params. ``sessions``: the events' ``event_sessions`` (counted here
    if not given), read several times, so better a stored table.

    The exit maximum and the session source both hang on the event's session,
    so they are put together on the sessions (with several rows where several
    stg rows share an id). Events move once: LAG deals them by (user, session)
    and piece, and the session side, with a copy for each piece of a large
    group, comes to where they are. A group that is hot among the events and
    repeated in stg thus spreads over as many tasks as it has pieces."""
    extra = list(extra_params or ())
    if method == "window":
        return sessionize(event_columns(raw, method, strict, extra_params), stg, extra)
    flat = flatten_events(raw, strict, extra_params)
    sessions = materialize(event_sessions(flat)) if sessions is None else sessions
    cuts = large_group_cuts(flat, sessions, large_group)
    timed = _lagged(flat, cuts)
    side = join_keys(sessions, sessions.groupBy(*EXIT_KEYS).agg(F.max("_last").alias("_max")), EXIT_KEYS)
    of_session = session_key(F.col("user_pseudo_id"), F.col("ga_session_id")) == F.col("_stg_session_id")
    side = grouped(side.join(_session_side(stg), of_session, "left")).select(
        *GROUP, F.col("ga_session_number").alias("_number"), "_max", *SESSION_SOURCE_COLUMNS)
    if cuts is not None:
        side = side.join(cuts.select(*GROUP, "n_pieces"), GROUP, "left")
        pieces = F.sequence(F.lit(0), F.coalesce("n_pieces", F.lit(1)) - 1)
        side = side.withColumn(PIECE, F.explode(pieces)).drop("n_pieces")
    else:
        side = side.withColumn(PIECE, F.lit(0))
    # not a join key, as the events lie by group and piece: a group has few numbers
    same_number = F.coalesce(F.col("ga_session_number") == F.col("_number"),
                             F.col("ga_session_number").isNull() & F.col("_number").isNull())
    here = reduce(and_, (timed[k] == side[k] for k in (*GROUP, PIECE))) & same_number
    return timed.join(side, here, "left").withColumn("exit_page", _is_last()).select(*EVENT_COLUMNS, *extra)
