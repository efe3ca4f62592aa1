"""Registered queries: one per operator of the inventory, each reading the
given test tables (the ``events`` table shaped as raw export rows, or
``documents``) so its work grows with them. Every callable takes
``(spark, sf_dir)`` and returns a DataFrame whose columns are aliased to the
names used by the matching oracle SQL.

Fixed run dates: the initial load runs on 2024-02-02 (shards 20231231 ..
20240130, i.e. the whole test window); the update scenario is init on
2024-01-16, then the updates of 2024-01-16 and 2024-01-17 (the latter twice, to
exercise idempotence), i.e. update day 20240115.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.channels import channel_group
from touchline.functions.dates import init_window
from touchline.functions.languages import language_name, with_language_name
from touchline.functions.params import float_param, int_param, register_param_functions, string_param
from touchline.operators.events import (
    LARGE_GROUP,
    build_events,
    exit_flag,
    flatten_events,
    seconds_since_previous,
    sessions_of_days,
)
from touchline.operators.items import purchase_items
from touchline.operators.traffic import (
    FIRST,
    LAST,
    all_event_traffic,
    event_traffic,
    merge_session_days,
    session_day_partials,
    session_rollup,
    session_traffic,
    with_touch,
)
from touchline.plans.reporting import TablePaths, init, update
from touchline.schema import FLAT_EVENT_COLUMNS
from touchline.session import app_id, materialize, scratch_path
from touchline.sources.fixture import driver_raw_events
from touchline.sources.raw import SUFFIX, scan_shard, scan_shard_range, write_shards, write_suffix_shards

INIT_RUN_DATE = dt.date(2024, 2, 2)
UPDATE_INIT_RUN_DATE = dt.date(2024, 1, 16)
UPDATE_RUN_DATES = (dt.date(2024, 1, 16), dt.date(2024, 1, 17), dt.date(2024, 1, 17))
UPDATE_DAY = dt.date(2024, 1, 15)
SHARD_RANGE = ("20240105", "20240112")
SHARD_DAY = "20240115"
SHORT_LOOKBACK = 172800

_MEMO: dict = {}


def _memo(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], str]) -> str:
    key = (app_id(spark), sf_dir.rstrip("/"), name)
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw stand-in, its rows dealt by day."""
    return driver_raw_events(spark, sf_dir, dealt=True)


def raw_shards(spark: SparkSession, sf_dir: str) -> str:
    """The raw stand-in stored as day shards in the shared folder (once per
    app), so queries read it the way they read a real export."""
    return _memo(spark, sf_dir, "shards",
                 lambda: write_shards(raw_events(spark, sf_dir), scratch_path(spark, "raw-shards"), dealt=True))


def init_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of the initial-load window (a partition filter on the scan)."""
    return scan_shard_range(spark, raw_shards(spark, sf_dir), *init_window(INIT_RUN_DATE))


def init_tables(spark: SparkSession, sf_dir: str) -> TablePaths:
    root = _memo(spark, sf_dir, "init", lambda: init(
        spark, raw_shards(spark, sf_dir), scratch_path(spark, "tables-init"), INIT_RUN_DATE).root)
    return TablePaths(root)


def updated_tables(spark: SparkSession, sf_dir: str) -> TablePaths:
    def build() -> str:
        raw = raw_shards(spark, sf_dir)
        root = scratch_path(spark, "tables-update")
        init(spark, raw, root, UPDATE_INIT_RUN_DATE)
        for run_date in UPDATE_RUN_DATES:
            update(spark, raw, root, run_date)
        return root
    return TablePaths(_memo(spark, sf_dir, "update", build))


def _struct_fields(col: str, prefix: str, fields=("source", "medium", "campaign", "gclid")) -> list:
    c = F.col(col)
    return [c.isNotNull().alias(f"has_{prefix}")] + [c.getField(f).alias(f"{prefix}_{f}") for f in fields]


def _src_flat(src: DataFrame) -> DataFrame:
    ts = F.col("traffic_source")
    return src.select(
        "date", "session_id", "user_pseudo_id", "session_start",
        *[ts.getField(f).alias(f"traffic_{f}") for f in ("source", "medium", "campaign", "gclid")],
        "event_timestamp", "page_location",
    )


# ---------------------------------------------------------------- P13, U1-U3
def q_param_extract(spark, sf_dir):
    return init_raw(spark, sf_dir).select(
        "event_timestamp",
        int_param("ga_session_id").alias("ga_session_id"),
        int_param("ga_session_number").alias("ga_session_number"),
        string_param("page_location").alias("page_location"),
        string_param("page_title").alias("page_title"),
        string_param("campaign").alias("campaign"),
        int_param("entrances").alias("entrances"),
        string_param("session_engaged").alias("engaged_string"),
        int_param("session_engaged").alias("engaged_int"),
        float_param("score").alias("score"),
        int_param("engagement_time_msec").alias("engagement_time_msec"),
    )


def q_param_extract_strict(spark, sf_dir):
    """Same lookups with the duplicate-key check on (raises on a repeated key)."""
    return init_raw(spark, sf_dir).select(
        "event_timestamp",
        int_param("ga_session_id", strict=True).alias("ga_session_id"),
        int_param("ga_session_number", strict=True).alias("ga_session_number"),
        string_param("page_location", strict=True).alias("page_location"),
        string_param("page_title", strict=True).alias("page_title"),
        string_param("campaign", strict=True).alias("campaign"),
        int_param("entrances", strict=True).alias("entrances"),
        string_param("session_engaged", strict=True).alias("engaged_string"),
        int_param("session_engaged", strict=True).alias("engaged_int"),
        float_param("score", strict=True).alias("score"),
        int_param("engagement_time_msec", strict=True).alias("engagement_time_msec"),
    )


def q_param_extract_sqlfn(spark, sf_dir):
    register_param_functions(spark)
    view = f"raw_events_{abs(hash(sf_dir)) % 10**8}"
    init_raw(spark, sf_dir).createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT event_timestamp,
               extract_int_value(event_params, 'ga_session_id') AS ga_session_id,
               extract_int_value(event_params, 'ga_session_number') AS ga_session_number,
               extract_string_value(event_params, 'page_location') AS page_location,
               extract_string_value(event_params, 'page_title') AS page_title,
               extract_string_value(event_params, 'campaign') AS campaign,
               extract_int_value(event_params, 'entrances') AS entrances,
               extract_string_value(event_params, 'session_engaged') AS engaged_string,
               extract_int_value(event_params, 'session_engaged') AS engaged_int,
               extract_float_value(event_params, 'score') AS score,
               extract_int_value(event_params, 'engagement_time_msec') AS engagement_time_msec
        FROM {view}""")


# ---------------------------------------------------------------- P1-P7
def q_event_traffic(spark, sf_dir):
    return _src_flat(event_traffic(init_raw(spark, sf_dir)))


def q_click_id_touch(spark, sf_dir):
    touched = with_touch(event_traffic(init_raw(spark, sf_dir)))
    return touched.select("event_timestamp", "session_id", *_struct_fields("touch", "touch"))


def _rollup(spark, sf_dir):
    return session_rollup(event_traffic(init_raw(spark, sf_dir)))


def q_session_first_touch(spark, sf_dir):
    return _rollup(spark, sf_dir).select("session_id", "user_pseudo_id", "session_start",
                                         *_struct_fields(FIRST, "first"))


def q_session_last_touch(spark, sf_dir):
    return _rollup(spark, sf_dir).select("session_id", "user_pseudo_id", "session_start",
                                         *_struct_fields(LAST, "last"))


def q_session_rollup(spark, sf_dir):
    return _rollup(spark, sf_dir).select("date", "session_id", "user_pseudo_id", "session_start",
                                         *_struct_fields(FIRST, "first"), *_struct_fields(LAST, "last"))


def q_session_rollup_from_day_partials(spark, sf_dir):
    """The roll-up as the update path builds it: per (session, day) partials,
    merged."""
    partials = session_day_partials(all_event_traffic(init_raw(spark, sf_dir)))
    return merge_session_days(partials).select("date", "session_id", "user_pseudo_id", "session_start",
                                               *_struct_fields(FIRST, "first"), *_struct_fields(LAST, "last"))


def _stg(lookback: int, method: str, **options):
    def run(spark, sf_dir):
        return session_traffic(event_traffic(init_raw(spark, sf_dir)), lookback, method=method, **options)
    return run


def q_session_traffic_from_day_partials(spark, sf_dir):
    """stg as the load builds it, users of more than 50 partials split."""
    partials = materialize(session_day_partials(all_event_traffic(init_raw(spark, sf_dir))))
    return session_traffic(None, large_user=50, partials=partials)


# ---------------------------------------------------------------- P8-P11
def q_events_flat(spark, sf_dir):
    cols = [c for c in FLAT_EVENT_COLUMNS if c not in ("previous_timestamp", "exit_page")]
    return flatten_events(init_raw(spark, sf_dir)).select(*cols)


def q_events_flat_extra(spark, sf_dir):
    """The flat events with two further params: a float and a string."""
    cols = [c for c in FLAT_EVENT_COLUMNS if c not in ("previous_timestamp", "exit_page")]
    flat = flatten_events(init_raw(spark, sf_dir), extra_params={"score": "float", "campaign": "string"})
    return flat.select(*cols, "score", "campaign")


def _previous(method: str, **options):
    def run(spark, sf_dir):
        out = seconds_since_previous(flatten_events(init_raw(spark, sf_dir)), method, **options)
        return out.select("event_timestamp", "user_pseudo_id", "ga_session_id", "previous_timestamp")
    return run


def _exit(method: str):
    def run(spark, sf_dir):
        out = exit_flag(flatten_events(init_raw(spark, sf_dir)), method)
        return out.select("event_timestamp", "user_pseudo_id", "ga_session_number", "exit_page")
    return run


def _sessionized(raw: DataFrame, large_group: int = LARGE_GROUP) -> DataFrame:
    """The events table as a load builds it: sessions, and their traffic, from
    the session-day partials."""
    partials = materialize(session_day_partials(all_event_traffic(raw)))
    stg = session_traffic(None, partials=partials)
    return build_events(raw, stg, large_group=large_group, sessions=sessions_of_days(partials))


def q_events_sessionized(spark, sf_dir):
    return _sessionized(init_raw(spark, sf_dir))


def q_session_key_fanout(spark, sf_dir):
    """Sessions that share an id: a third of the events have no user, another
    third an empty one, and of both every second event has no session id, so
    that the id '' is hot among the events and repeated in stg. Such groups
    are split from 500 events on."""
    raw, n = init_raw(spark, sf_dir), F.col("event_timestamp")
    user = F.when(n % 3 == 0, F.lit(None).cast("string")).when(n % 3 == 1, F.lit("")).otherwise(F.col("user_pseudo_id"))
    no_session = (n % 3 < 2) & (n % 2 == 0)
    others = F.filter("event_params", lambda p: ~p["key"].isin("ga_session_id", "ga_session_number"))
    raw = raw.withColumn("user_pseudo_id", user).withColumn(
        "event_params", F.when(no_session, others).otherwise(F.col("event_params")))
    return _sessionized(raw, large_group=500).select(
        "event_timestamp", "session_id", "user_pseudo_id", "previous_timestamp", "exit_page", "session_source",
        "session_medium", "session_campaign", "session_start")


def q_purchase_items(spark, sf_dir):
    return purchase_items(init_raw(spark, sf_dir))


# ---------------------------------------------------------------- S1, S2
def _scan_projection(raw: DataFrame, *more) -> DataFrame:
    return raw.select("event_date", "event_timestamp", "event_name", "user_pseudo_id",
                      int_param("ga_session_id").alias("ga_session_id"), *more)


def q_shard_range_scan(spark, sf_dir):
    return _scan_projection(scan_shard_range(spark, raw_shards(spark, sf_dir), *SHARD_RANGE))


def q_shard_point_scan(spark, sf_dir):
    return _scan_projection(scan_shard(spark, raw_shards(spark, sf_dir), SHARD_DAY))


def suffix_shards(spark: SparkSession, sf_dir: str) -> str:
    """The shards again, as ``events_yyyyMMdd`` tables; every eighth event is in
    the intraday table of its day, too, as it is until the day's table is done."""
    def build() -> str:
        raw = raw_events(spark, sf_dir).withColumn("_table", F.explode(F.when(
            F.col("event_timestamp") % 8 == 0,
            F.array("event_date", F.concat(F.lit("intraday_"), "event_date"))).otherwise(F.array("event_date"))))
        return write_suffix_shards(raw, scratch_path(spark, "suffix-shards"), "_table", dealt=True)
    return _memo(spark, sf_dir, "suffix-shards", build)


def q_shard_suffix_scan(spark, sf_dir):
    """S1 over the export's own table names; the intraday tables lie outside."""
    raw = scan_shard_range(spark, suffix_shards(spark, sf_dir), *SHARD_RANGE, layout="suffix")
    return _scan_projection(raw, F.col(SUFFIX).alias("table_suffix"))


# ---------------------------------------------------------------- P14, P15
def q_channel_grouping(spark, sf_dir):
    """Sessions are classified, then their label joins the flat events: the
    rules run per session, and neither window of the events table is built."""
    raw = init_raw(spark, sf_dir)
    label = channel_group(F.col("source"), F.col("medium"), F.col("campaign"))
    side = session_traffic(event_traffic(raw)).select(
        F.col("session_id").alias("_session"), F.col("source").alias("session_source"),
        F.col("medium").alias("session_medium"), F.col("campaign").alias("session_campaign"), label.alias("_channel"))
    flat = flatten_events(raw).select("session_id", "event_timestamp")
    none = F.lit(None).cast("string")
    return flat.join(side, F.col("session_id") == F.col("_session"), "left").select(
        "event_timestamp", "session_source", "session_medium", "session_campaign",
        F.coalesce("_channel", channel_group(none, none, none)).alias("channel"))


def q_language_name(spark, sf_dir):
    flat = flatten_events(init_raw(spark, sf_dir))
    return with_language_name(flat.select("event_timestamp", "device_language"), "device_language", "language_name")


def q_document_language_name(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return with_language_name(docs.select("doc_id", "lang"), "lang", "language_name")


def q_language_name_column(spark, sf_dir):
    """The lookup as a Column, on the few distinct codes of the events."""
    codes = flatten_events(init_raw(spark, sf_dir)).groupBy("device_language").agg(F.count(F.lit(1)).alias("n_events"))
    return codes.withColumn("language_name", language_name(F.col("device_language")))


def q_sessions_by_channel(spark, sf_dir):
    stg = session_traffic(event_traffic(init_raw(spark, sf_dir)))
    return stg.withColumn("channel", channel_group(F.col("source"), F.col("medium"), F.col("campaign")))


# ---------------------------------------------------------------- P16, P17
def q_init_src_table(spark, sf_dir):
    return _src_flat(init_tables(spark, sf_dir).read(spark, "src"))


def q_init_stg_table(spark, sf_dir):
    return init_tables(spark, sf_dir).read(spark, "stg")


def q_init_events_table(spark, sf_dir):
    return init_tables(spark, sf_dir).read(spark, "events")


def q_init_items_table(spark, sf_dir):
    return init_tables(spark, sf_dir).read(spark, "items")


def q_update_src_day(spark, sf_dir):
    src = updated_tables(spark, sf_dir).read(spark, "src")
    return _src_flat(src.where(F.col("date") == F.lit(UPDATE_DAY)))


def q_update_stg_day(spark, sf_dir):
    return updated_tables(spark, sf_dir).read(spark, "stg").where(F.col("date") == F.lit(UPDATE_DAY))


def q_update_events_day(spark, sf_dir):
    ev = updated_tables(spark, sf_dir).read(spark, "events")
    return ev.where(F.col("event_date") == F.lit(UPDATE_DAY))


def q_update_items_day(spark, sf_dir):
    return updated_tables(spark, sf_dir).read(spark, "items").where(F.col("date") == F.lit(UPDATE_DAY))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "param_extract": q_param_extract,
    "param_extract_sqlfn": q_param_extract_sqlfn,
    "param_extract_strict": q_param_extract_strict,
    "event_traffic": q_event_traffic,
    "click_id_touch": q_click_id_touch,
    "session_first_touch": q_session_first_touch,
    "session_last_touch": q_session_last_touch,
    "session_rollup": q_session_rollup,
    "session_rollup_from_day_partials": q_session_rollup_from_day_partials,
    "session_traffic_30d": _stg(2592000, "split"),
    "session_traffic_30d_window": _stg(2592000, "window"),
    "session_traffic_30d_split": _stg(2592000, "split", large_user=50),
    "session_traffic_30d_from_day_partials": q_session_traffic_from_day_partials,
    "session_traffic_2d": _stg(SHORT_LOOKBACK, "split"),
    "session_traffic_2d_window": _stg(SHORT_LOOKBACK, "window"),
    "events_flat": q_events_flat,
    "events_flat_extra": q_events_flat_extra,
    "seconds_since_previous": _previous("split"),
    "seconds_since_previous_split": _previous("split", large_group=20),
    "seconds_since_previous_window": _previous("window"),
    "exit_flag": _exit("aggregate"),
    "exit_flag_bucketed": _exit("bucketed"),
    "exit_flag_window": _exit("window"),
    "events_sessionized": q_events_sessionized,
    "session_key_fanout": q_session_key_fanout,
    "purchase_items": q_purchase_items,
    "shard_range_scan": q_shard_range_scan,
    "shard_point_scan": q_shard_point_scan,
    "shard_suffix_scan": q_shard_suffix_scan,
    "channel_grouping": q_channel_grouping,
    "language_name": q_language_name,
    "language_name_column": q_language_name_column,
    "document_language_name": q_document_language_name,
    "sessions_by_channel": q_sessions_by_channel,
    "init_src_table": q_init_src_table,
    "init_stg_table": q_init_stg_table,
    "init_events_table": q_init_events_table,
    "init_items_table": q_init_items_table,
    "update_src_day": q_update_src_day,
    "update_stg_day": q_update_stg_day,
    "update_events_day": q_update_events_day,
    "update_items_day": q_update_items_day,
}
