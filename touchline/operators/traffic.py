"""Session traffic-source attribution (src_event_traffic -> stg_session_traffic).

Stages and their shuffles:

1. ``event_traffic`` - narrow: shard filter, event-name filter, param lookups.
2. ``session_rollup`` - one shuffle on the session key with map-side partial
   aggregation; first touch (arg-min, NULL kept) and last non-NULL touch
   (arg-max) carry O(1) state per group, so a hot session key is pre-combined
   before it is shuffled.
3. ``lookback_fill`` - first touch, else the latest non-NULL last touch of the
   same user within ``lookback`` seconds (RANGE frame, current row included).
   ``method="split"`` (default, ``operators.lookback``) deals a large user's
   sessions by pieces of about equal size: no task holds more than one piece,
   however many sessions the user has; ``method="window"`` is the direct RANGE
   window (one task per user), kept as the readable specification.
4. ``session_traffic`` - defaults ``(direct)`` / ``(none)`` / ``(not set)``.

``session_day_partials`` / ``merge_session_days`` split step 2 into a per
(session, day) partial and its merge, so a daily update can keep the partials
and merge a window of days instead of re-aggregating its events. From stored
partials, merge and lookback together cost one shuffle of the session rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.clickids import CLICK_ID_RULES, traffic_touch
from touchline.functions.dates import LOOKBACK_SECONDS, shard_to_date
from touchline.functions.params import int_param, one_value_per_key, string_param
from touchline.operators.lookback import DEALT, USER, carried_touches, latest_touch_within, with_piece
from touchline.operators.ordered import PIECE, large_cuts, not_null_keys
from touchline.schema import SRC_COLUMNS, STG_COLUMNS

# Fixed values (must equal the reference).
EXCLUDED_EVENTS = ("session_start", "first_visit")
DEFAULT_SOURCE = "(direct)"
DEFAULT_MEDIUM = "(none)"
DEFAULT_CAMPAIGN = "(not set)"

# Users with more rows than this are split for the lookback, into pieces of about
# PIECE_SESSIONS. Neither changes the result.
LARGE_USER = 100_000
PIECE_SESSIONS = 50_000
# Keys that ``event_traffic`` looks up.
TRAFFIC_PARAMS = ("ga_session_id", "source", "medium", "campaign", "gclid", "page_location")
SESSION_KEYS = ("session_id", "user_pseudo_id", "session_start")
FIRST = "session_first_traffic_source"
LAST = "session_last_traffic_source"
FILLED = "session_traffic_source_last_non_direct"


def session_key(user_pseudo_id: Column, ga_session_id: Column) -> Column:
    """Unseparated concatenation; both parts coalesced to '' so it is never NULL."""
    return F.concat(F.coalesce(user_pseudo_id, F.lit("")), F.coalesce(ga_session_id.cast("string"), F.lit("")))


def _excluded() -> Column:
    return F.col("event_name").isin(*EXCLUDED_EVENTS)


def all_event_traffic(raw: DataFrame, strict: bool = False, *more: Column) -> DataFrame:
    """The rows of ``event_traffic`` before its event-name filter, with the
    event name, the session number and ``more`` columns. ``strict`` fails on an
    event that has one of the looked-up keys twice."""
    raw = one_value_per_key(raw, TRAFFIC_PARAMS) if strict else raw
    session_id_param = int_param("ga_session_id")
    return raw.select(
        shard_to_date(F.col("event_date")).alias("date"),
        session_key(F.col("user_pseudo_id"), session_id_param).alias("session_id"),
        F.col("user_pseudo_id"),
        session_id_param.alias("session_start"),
        F.struct(
            string_param("source").alias("source"),
            string_param("medium").alias("medium"),
            string_param("campaign").alias("campaign"),
            string_param("gclid").alias("gclid"),
        ).alias("traffic_source"),
        F.col("event_timestamp"),
        string_param("page_location").alias("page_location"),
        F.col("event_name"),
        int_param("ga_session_number").alias("ga_session_number"),
        *more,
    )


def event_traffic(raw: DataFrame, strict: bool = False) -> DataFrame:
    """One row per event (minus session_start / first_visit) with the session
    key and the four traffic params packed in a struct. The caller restricts
    ``raw`` to the shard window (a partition filter on the scan)."""
    return all_event_traffic(raw.where(~_excluded()), strict).select(*SRC_COLUMNS)


def with_touch(src: DataFrame, rules=CLICK_ID_RULES) -> DataFrame:
    """P2 applied once per event, before any grouping."""
    ts = F.col("traffic_source")
    return src.withColumn(
        "touch",
        traffic_touch(ts.getField("source"), ts.getField("medium"), ts.getField("campaign"),
                      ts.getField("gclid"), F.col("page_location"), rules),
    )


def session_rollup(src: DataFrame, rules=CLICK_ID_RULES) -> DataFrame:
    """Group by (session_id, user_pseudo_id, session_start).

    Ordering key = (event_timestamp, touch): timestamp ascending as in the
    source (a NULL timestamp sorts first, as there). Among equal timestamps an
    event with a touch goes before one without, then the touch itself breaks
    ties, so the pick is deterministic under task retries."""
    touched = with_touch(src, rules)
    order = F.struct(F.col("event_timestamp"), F.col("touch"))
    first = F.struct(F.col("event_timestamp"), F.col("touch").isNull(), F.col("touch"))
    return (
        touched.where(F.col("session_id").isNotNull())
        .groupBy(*SESSION_KEYS)
        .agg(
            F.min("date").alias("date"),
            F.min_by(F.col("touch"), first).alias(FIRST),
            F.max_by(F.col("touch"), F.when(F.col("touch").isNotNull(), order)).alias(LAST),
        )
        .select("date", *SESSION_KEYS, FIRST, LAST)
    )


def session_day_partials(src: DataFrame, rules=CLICK_ID_RULES, **counts: Column) -> DataFrame:
    """Per (session, day) partial state of the roll-up: the day's earliest
    (event_timestamp, touch) and latest non-NULL one. Both are min / max of a
    struct, hence associative: merging the days of a window gives exactly
    ``session_rollup`` of that window's src rows (same order and tie-break).

    Over ``all_event_traffic`` there is a row per session number, too; events
    that ``event_traffic`` leaves out add no touch (``first_event`` is NULL where
    there are no others), but count in ``n_events`` and ``last_us``, the number
    of events and their latest timestamp, which the events table needs.
    ``counts`` adds numbers of events for which a condition holds."""
    touched = with_touch(src, rules)
    ts, touch = F.col("event_timestamp").alias("ts"), F.col("touch").alias("touch")
    order, first = F.struct(ts, touch), F.struct(ts, F.col("touch").isNull().alias("untouched"), touch)
    whole = "event_name" in src.columns
    taken = ~_excluded() if whole else F.lit(True)
    keys = ["date", *SESSION_KEYS, *(["ga_session_number"] if whole else [])]
    return (
        touched.where(F.col("session_id").isNotNull())
        .groupBy(*keys)
        .agg(F.min(F.when(taken, first)).alias("first_event"),
             F.max(F.when(taken & F.col("touch").isNotNull(), order)).alias("last_touch_event"),
             F.count(F.lit(1)).alias("n_events"), F.max("event_timestamp").alias("last_us"),
             *(F.count_if(c).alias(name) for name, c in counts.items()))
    )


def merge_session_days(partials: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Roll session-day partials up to sessions (same columns as
    ``session_rollup``). ``also``: columns that follow from the session keys, by
    which ``partials`` is partitioned; sessions are then merged in place."""
    return (
        partials.where(F.col("first_event").isNotNull()).groupBy(*SESSION_KEYS, *also)
        .agg(F.min("date").alias("date"),
             F.min("first_event").getField("touch").alias(FIRST),
             F.max("last_touch_event").getField("touch").alias(LAST))
        .select("date", *SESSION_KEYS, FIRST, LAST, *also)
    )


def _coalesced(rows: DataFrame, found: Column) -> DataFrame:
    return rows.select("date", *SESSION_KEYS, F.coalesce(F.col(FIRST), found).alias(FILLED))


def large_user_cuts(rows: DataFrame, large_user: int = LARGE_USER) -> DataFrame | None:
    """Cuts of the users with more than ``large_user`` of these rows (sessions,
    or the partials or events they come from), or None: a user then has no more
    sessions than that. Users are counted over their column alone."""
    return large_cuts(not_null_keys(rows, {USER[0]: F.col("user_pseudo_id")})[0], USER, "session_start", large_user,
                      max(1, min(PIECE_SESSIONS, large_user)))


def lookback_fill(prep: DataFrame, lookback_seconds: int = LOOKBACK_SECONDS, method: str = "split",
                  large_user: int = LARGE_USER) -> DataFrame:
    """First touch, else the last non-NULL touch of the user's sessions
    whose start lies in [start - lookback, start] (NULL start: only NULL-start
    sessions of the user). ``prep``: one row per session, read several times
    by ``method="split"``."""
    if method == "window":
        w = (Window.partitionBy("user_pseudo_id").orderBy("session_start")
             .rangeBetween(-lookback_seconds, Window.currentRow))
        found = F.last(F.col(LAST), ignorenulls=True).over(w)
        return prep.select("date", *SESSION_KEYS, F.coalesce(F.col(FIRST), found).alias(FILLED))
    if method != "split":
        raise ValueError(f"unknown lookback method {method!r}")
    return _lookback(prep, prep, F.col(LAST), large_user_cuts(prep, large_user), lookback_seconds)


def _lookback(prep: DataFrame, rows: DataFrame, value: Column, cuts: DataFrame | None,
              lookback_seconds: int) -> DataFrame:
    """``rows``: what the large users' carried touches come from; ``value``, an
    order of their touches, ends in the touch."""
    dealt = prep if PIECE in prep.columns else with_piece(prep, "user_pseudo_id", "session_start", cuts)
    carry = None
    if cuts is not None:
        carry = carried_touches(rows, "user_pseudo_id", "session_start", value, cuts)
        touch = carry.schema["_carry"].dataType["v"].dataType
        v = F.col("_carry.v.touch") if "touch" in touch.names else F.col("_carry.v")
        carry = carry.withColumn("_carry", F.struct(F.col("_carry.start").alias("start"), v.alias("v")))
    found = latest_touch_within(dealt, "session_start", LAST, lookback_seconds, "_found", carry)
    return found.select("date", *SESSION_KEYS, F.coalesce(F.col(FIRST), F.col("_found")).alias(FILLED))


def session_traffic(src: DataFrame | None, lookback_seconds: int = LOOKBACK_SECONDS, keep_date=None,
                    method: str = "split", large_user: int = LARGE_USER,
                    partials: DataFrame | None = None) -> DataFrame:
    """stg_session_traffic from src_event_traffic. ``keep_date`` keeps only
    sessions dated that day (the daily update); it is applied after the
    lookback, which must still see the earlier days. ``partials`` (session-day
    partials of the window, a stored table) replace ``src``, which may then be
    None: they move once, to where merge and lookback both find them."""
    if method == "window":
        prep = session_rollup(src) if partials is None else merge_session_days(partials)
        filled = lookback_fill(prep, lookback_seconds, method)
    elif method != "split":
        raise ValueError(f"unknown lookback method {method!r}")
    elif partials is None:
        cuts, touched = large_user_cuts(src, large_user), None
        if cuts is not None:
            touched = with_touch(src).withColumn("_order", F.when(F.col("touch").isNotNull(), F.struct(
                F.col("event_timestamp").alias("ts"), F.col("touch"))))
        filled = _lookback(session_rollup(src), touched, F.col("_order"), cuts, lookback_seconds)
    else:
        cuts = large_user_cuts(partials, large_user)
        dealt = with_piece(partials, "user_pseudo_id", "session_start", cuts).repartition(*(USER if cuts is None else DEALT))
        filled = _lookback(merge_session_days(dealt, tuple(DEALT)), partials, F.col("last_touch_event"), cuts,
                           lookback_seconds)
    t = F.col(FILLED)
    stg = filled.select(
        "session_id", "user_pseudo_id", "date", "session_start",
        F.coalesce(t.getField("source"), F.lit(DEFAULT_SOURCE)).alias("source"),
        F.coalesce(t.getField("medium"), F.lit(DEFAULT_MEDIUM)).alias("medium"),
        F.coalesce(t.getField("campaign"), F.lit(DEFAULT_CAMPAIGN)).alias("campaign"),
    )
    if keep_date is not None:
        stg = stg.where(F.col("date") == F.lit(keep_date).cast("date"))
    return stg.select(*STG_COLUMNS)


__all__ = ["EXCLUDED_EVENTS", "SRC_COLUMNS", "all_event_traffic", "event_traffic", "lookback_fill", "merge_session_days",
           "session_day_partials", "session_key", "session_rollup", "session_traffic", "with_touch"]
