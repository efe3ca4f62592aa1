"""Run-date arithmetic of the two batch entry points and shard-date parsing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SHARD_FORMAT = "%Y%m%d"

# Fixed values (must equal the reference): day offsets from the run date.
INIT_START_OFFSET_DAYS = 33
INIT_END_OFFSET_DAYS = 3
UPDATE_START_OFFSET_DAYS = 32
UPDATE_DAY_OFFSET_DAYS = 2
LOOKBACK_SECONDS = 2592000


def today_utc() -> dt.date:
    """CURRENT_DATE of the run (UTC), the default run date of both scripts."""
    return dt.datetime.now(dt.timezone.utc).date()


def _as_date(value) -> dt.date:
    if value is None:
        return today_utc()
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def shard(day) -> str:
    return _as_date(day).strftime(SHARD_FORMAT)


def parse_shard(suffix: str) -> dt.date:
    return dt.datetime.strptime(suffix, SHARD_FORMAT).date()


def shards_between(start: str, end: str) -> list[str]:
    """All day shards of [start, end]."""
    first, last = parse_shard(start), parse_shard(end)
    return [shard(first + dt.timedelta(days=i)) for i in range((last - first).days + 1)]


def init_window(run_date=None) -> tuple[str, str]:
    """Inclusive shard range of the initial load: [run-33, run-3]; run date
    defaults to today (UTC)."""
    d = _as_date(run_date)
    return (shard(d - dt.timedelta(days=INIT_START_OFFSET_DAYS)),
            shard(d - dt.timedelta(days=INIT_END_OFFSET_DAYS)))


def update_window(run_date=None) -> tuple[str, str]:
    """(start of the re-aggregated range, the day loaded) of a daily update:
    (run-32, run-2); run date defaults to today (UTC)."""
    d = _as_date(run_date)
    return (shard(d - dt.timedelta(days=UPDATE_START_OFFSET_DAYS)),
            shard(d - dt.timedelta(days=UPDATE_DAY_OFFSET_DAYS)))


def shard_to_date(col: Column) -> Column:
    """yyyyMMdd string -> DATE (raises on malformed input under ANSI, as a cast).
    Eight digits are taken apart as a number, as a format parser is slow for a
    column that every event has; the parser is left with all other strings."""
    n = col.try_cast("int")
    year, month, day = F.call_function("div", n, F.lit(10000)), F.call_function("div", n, F.lit(100)) % 100, n % 100
    digits = (F.length(col) == 8) & (n >= 10_000_000)
    return F.when(digits, F.make_date(year.cast("int"), month.cast("int"), day)).otherwise(F.to_date(col, "yyyyMMdd"))


def micros_to_timestamp(col: Column) -> Column:
    """Epoch microseconds -> UTC wall-clock TIMESTAMP_NTZ, independent of the
    session time zone."""
    return F.timestamp_add("MICROSECOND", col, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def timestamp_to_micros(col: Column) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> epoch microseconds."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col)
