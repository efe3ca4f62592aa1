"""Initial load (P16) and daily update (P17) over day-partitioned tables.

Each stage is written as a table before the next one reads it (the source's
statement order): src -> stg -> events, and items independently. Writing the
tables is also what cuts the lineage, so a lost executor never replays the whole
chain. All tables of a load become visible together, with its commit record
(``sources.sinks``): a load that fails leaves the old tables as they were, and
its repeat goes on after the last table it finished.

The raw shards are scanned once per table that needs them (src, session days,
events, items), never while a plan is built. The staging table of per-(session,
day) partial aggregates serves the sessions of stg, and gives the events table
its groups' sizes and latest timestamps. Its scan also observes the stated
conditions of the input (``checked_session_days``).

Update semantics kept from the source: the day's src rows are (re)written, stg
is recomputed from the trailing window of src but only the day's sessions are
kept, the day's events join only that day's stg rows, and the day's windows
see that day only. Unlike an append, re-running a day replaces it. The
window's roll-up is merged from the staging table (written by both entry
points), which gives the same sessions as re-aggregating the window's src rows
while reading one row per session and day instead of one per event.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.dates import (
    LOOKBACK_SECONDS,
    UPDATE_START_OFFSET_DAYS,
    UPDATE_DAY_OFFSET_DAYS,
    init_window,
    parse_shard,
    shard,
    shards_between,
    update_window,
)
from touchline.functions.clickids import CLICK_ID_RULES
from touchline.operators.events import LARGE_GROUP, PARAM_TYPES, build_events, sessions_of_days
from touchline.operators.items import purchase_items
from touchline.operators.traffic import (
    LARGE_USER,
    all_event_traffic,
    event_traffic,
    session_day_partials,
    session_traffic,
)
from touchline.schema import EVENT_SCHEMA, ITEM_SCHEMA, SESSION_DAY_SCHEMA, SRC_SCHEMA, STG_SCHEMA
from touchline.session import materialize
from touchline.sources.raw import PARTITION_COLUMN, SUFFIX, scan_shard, scan_shard_range, shard_states
from touchline.sources.sinks import Load, Version, read_table, version

# Folders below the root, by short name, and the day column of each.
TABLES = {"src": "src_event_traffic", "session_days": "_session_days", "stg": "stg_session_traffic", "events": "events",
          "items": "items"}
SCHEMAS = {"src": SRC_SCHEMA, "stg": STG_SCHEMA, "events": EVENT_SCHEMA, "items": ITEM_SCHEMA,
           "session_days": SESSION_DAY_SCHEMA}


class BadInput(ValueError):
    """The raw shards break a stated condition of the input."""


@dataclass(frozen=True)
class TablePaths:
    """``extra_params``: event params that the events table has beside the
    contract columns, by kind ("string", "int" or "float"). ``checks``: what the
    load that returned this saw in its input (see ``checked_session_days``) and the rows per day."""

    root: str
    extra_params: dict[str, str] = field(default_factory=dict)
    checks: dict = field(default_factory=dict, compare=False)

    @property
    def src(self) -> str:
        return os.path.join(self.root, TABLES["src"])

    @property
    def stg(self) -> str:
        return os.path.join(self.root, TABLES["stg"])

    @property
    def events(self) -> str:
        return os.path.join(self.root, TABLES["events"])

    @property
    def items(self) -> str:
        return os.path.join(self.root, TABLES["items"])

    @property
    def session_days(self) -> str:
        """Staging: one partial roll-up row per (session, number, day), so the
        daily update merges 31 days of session-day rows instead of
        re-aggregating 31 days of event rows."""
        return os.path.join(self.root, TABLES["session_days"])

    def schema(self, table: str) -> T.StructType:
        extra = self.extra_params if table == "events" else {}
        return T.StructType([*SCHEMAS[table], *(T.StructField(k, PARAM_TYPES[v]) for k, v in extra.items())])

    def read(self, spark: SparkSession, table: str, of: Version | None = None):
        """A table of the newest committed version, or of the one given: tables
        that belong together are read ``of`` one ``version(spark, root)``."""
        of = version(spark, self.root.rstrip("/")) if of is None else of
        return read_table(spark, self.root.rstrip("/"), TABLES[table], self.schema(table), of)

    def register_views(self, spark: SparkSession, prefix: str = "") -> list[str]:
        """Expose the four tables, all of one version, to SQL as temp views
        src_event_traffic, stg_session_traffic, events, items (optionally
        prefixed)."""
        now = version(spark, self.root.rstrip("/"))
        names = {t: n for t, n in TABLES.items() if t != "session_days"}
        for table, view in names.items():
            self.read(spark, table, now).createOrReplaceTempView(prefix + view)
        return [prefix + v for v in names.values()]


def checked_session_days(raw: DataFrame, days: list[str], rules) -> tuple[DataFrame, Callable[[], dict]]:
    """The session-day partials of ``raw``, and a function that gives, once they
    are written, what that pass has seen of the stated conditions of the input:
    ``rows``; ``null_timestamps`` (a session's first event is then undefined);
    ``other_dates``, rows whose date is not their shard's (the shard range then
    selects other rows than the date does) or not a day of the load. They are
    counted per session day and observed in the aggregate's few rows, which a
    repeated task may count again."""
    date = F.col(PARTITION_COLUMN)
    fits = date.isin(*days) & ((date == F.col(SUFFIX)) if SUFFIX in raw.columns else F.lit(True))
    counts = {"_untimed": F.col("event_timestamp").isNull(), "_misdated": F.col("_other")}
    other = (~F.coalesce(fits, F.lit(False))).alias("_other")
    partials = session_day_partials(all_event_traffic(raw, False, other), rules, **counts)
    observed = Observation()
    watched = partials.observe(observed, F.sum("n_events").alias("rows"), F.sum("_untimed").alias("null_timestamps"),
                               F.sum("_misdated").alias("other_dates"))

    def found() -> dict:
        return {"checks": {k: v or 0 for k, v in observed.get.items()}}

    return watched.drop(*counts), found


def _rows_per_day(partials: DataFrame, days: list[str]) -> dict[str, int]:
    seen = {shard(r["date"]): r["n"] for r in partials.groupBy("date").agg(F.sum("n_events").alias("n")).collect() if r["date"]}
    return {day: seen.get(day, 0) for day in days}


def _finish(load: Load, paths: TablePaths, partials: DataFrame, days: list[str], fail_on_bad_input: bool) -> TablePaths:
    checks = load.notes["checks"]
    if fail_on_bad_input and (checks["null_timestamps"] or checks["other_dates"]):
        raise BadInput(f"nothing was published: {checks}")
    checks["rows_per_day"] = _rows_per_day(partials, days)  # a day's rows, from its sessions
    load.commit()
    return TablePaths(paths.root, paths.extra_params, checks)


def init(spark: SparkSession, raw_path: str, root: str, run_date=None, lookback_seconds: int = LOOKBACK_SECONDS,
         method: str = "split", strict: bool = False, rules=CLICK_ID_RULES,
         extra_params: dict[str, str] | None = None, large_group: int = LARGE_GROUP, large_user: int = LARGE_USER,
         layout: str = "auto", fail_on_bad_input: bool = False) -> TablePaths:
    """Replace all four tables from the shards [run_date-33, run_date-3]
    (run_date defaults to today, UTC). ``strict`` fails on an event that has a
    looked-up param key twice, ``rules`` are the click-id rules, ``extra_params``
    further event params for the events table (name: "string", "int" or "float");
    ``large_group`` and ``large_user`` say which groups and users are split (see
    ``operators.events`` and ``operators.traffic``); ``layout`` is the raw
    export's ("partition", "suffix" or "auto"). ``fail_on_bad_input`` publishes
    nothing if the input breaks a condition of ``checked_session_days``."""
    paths = TablePaths(root, extra_params or {})
    start, end = init_window(run_date)
    days = shards_between(start, end)
    raw = scan_shard_range(spark, raw_path, start, end, layout)
    load = Load(spark, root, ["init", days, lookback_seconds, method, strict, rules, paths.extra_params, raw_path,
                              shard_states(spark, raw_path, start, end)])
    read = lambda table: load.read(TABLES[table], paths.schema(table))
    load.replace(TABLES["src"], "date", lambda: event_traffic(raw, strict))
    days_made, found = checked_session_days(raw, days, rules)
    load.replace(TABLES["session_days"], "date", lambda: days_made, rebalance=True, note=found)
    partials = read("session_days")
    load.replace(TABLES["stg"], "date", lambda: session_traffic(
        None, lookback_seconds, method=method, large_user=large_user, partials=partials), rebalance=True)
    load.replace(TABLES["events"], "event_date", lambda: build_events(
        raw, read("stg"), method, strict, paths.extra_params, large_group, materialize(sessions_of_days(partials))),
        rebalance=True)
    # a few percent of the rows: without the exchange each scan task would leave its own small file
    load.replace(TABLES["items"], "date", lambda: purchase_items(raw), rebalance=True)
    return _finish(load, paths, partials, days, fail_on_bad_input)


def update_day(spark: SparkSession, raw_path: str, root: str, day: str, start: str | None = None,
               lookback_seconds: int = LOOKBACK_SECONDS, method: str = "split", strict: bool = False,
               rules=CLICK_ID_RULES, extra_params: dict[str, str] | None = None, large_group: int = LARGE_GROUP,
               large_user: int = LARGE_USER, layout: str = "auto", fail_on_bad_input: bool = False) -> TablePaths:
    """Load shard ``day`` (yyyyMMdd); stg is recomputed from src over
    [start, day] (default: the 31 days ending at ``day``). The day of each
    table is replaced as a whole. Options as for ``init``."""
    paths = TablePaths(root, extra_params or {})
    date = parse_shard(day)
    if start is None:
        start = shard(date - dt.timedelta(days=UPDATE_START_OFFSET_DAYS - UPDATE_DAY_OFFSET_DAYS))
    first = parse_shard(start)
    raw = scan_shard(spark, raw_path, day, layout)
    load = Load(spark, root, ["day", day, start, lookback_seconds, method, strict, rules, paths.extra_params, raw_path,
                              shard_states(spark, raw_path, day, day)])
    read = lambda table: load.read(TABLES[table], paths.schema(table))
    load.replace_day(TABLES["src"], "date", date, lambda: event_traffic(raw, strict))
    days_made, found = checked_session_days(raw, [day], rules)
    load.replace_day(TABLES["session_days"], "date", date, lambda: days_made, rebalance=True, note=found)
    partials = read("session_days")
    window = partials.where(F.col("date").between(F.lit(first), F.lit(date)))
    load.replace_day(TABLES["stg"], "date", date, lambda: session_traffic(
        None, lookback_seconds, date, method, large_user, window), rebalance=True)
    of_day = F.col("date") == F.lit(date)
    load.replace_day(TABLES["events"], "event_date", date, lambda: build_events(
        raw, read("stg").where(of_day), method, strict, paths.extra_params, large_group,
        materialize(sessions_of_days(partials.where(of_day)))), rebalance=True)
    load.replace_day(TABLES["items"], "date", date, lambda: purchase_items(raw), rebalance=True)
    return _finish(load, paths, partials.where(of_day), [day], fail_on_bad_input)


def update(spark: SparkSession, raw_path: str, root: str, run_date=None, lookback_seconds: int = LOOKBACK_SECONDS,
           method: str = "split", **options) -> TablePaths:
    """Daily update for ``run_date``: loads shard run_date-2, re-aggregates
    src over [run_date-32, run_date-2]. Options as for ``init``."""
    start, day = update_window(run_date)
    return update_day(spark, raw_path, root, day, start, lookback_seconds, method, **options)
