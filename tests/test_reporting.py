import datetime as dt

import pytest
from pyspark.sql import functions as F

from touchline.functions import dates
from touchline.functions.dates import init_window, update_window
from touchline.plans.reporting import TABLES, BadInput, TablePaths, init, update, update_day
from touchline.schema import EVENT_COLUMNS, ITEM_COLUMNS, SRC_COLUMNS, STG_COLUMNS
from touchline.session import scratch_path
from touchline.sources.fixture import driver_raw_events
from touchline.sources import sinks
from touchline.sources.raw import scan_shard, scan_shard_range, shard_folders, write_shards, write_suffix_shards
from touchline.sources.sinks import version

from helpers import param, raw_row


def test_run_date_windows():
    assert init_window(dt.date(2024, 2, 2)) == ("20231231", "20240130")
    assert update_window(dt.date(2024, 1, 17)) == ("20231216", "20240115")
    assert init_window("2024-01-16")[1] == "20240113"
    start, end = init_window()
    assert start < end and len(end) == 8  # defaults to the current date


@pytest.fixture(scope="module")
def shards(spark, sf_small):
    return write_shards(driver_raw_events(spark, sf_small), scratch_path(spark, "test-shards"))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_shard_scan_prunes_partitions(spark, shards):
    df = scan_shard_range(spark, shards, "20240105", "20240112")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "20240105" in plan
    days = {r.event_date for r in df.select("event_date").distinct().collect()}
    assert days and min(days) >= "20240105" and max(days) <= "20240112"
    assert isinstance(scan_shard(spark, shards, "20240115").schema["event_date"].dataType.simpleString(), str)
    assert dict(scan_shard(spark, shards, "20240115").dtypes)["event_date"] == "string"


def test_init_writes_four_tables_in_contract_order(spark, shards):
    paths = init(spark, shards, scratch_path(spark, "test-init"), dt.date(2024, 2, 2))
    for table, cols in (("src", SRC_COLUMNS), ("stg", STG_COLUMNS), ("events", EVENT_COLUMNS),
                        ("items", ITEM_COLUMNS)):
        df = paths.read(spark, table)
        assert tuple(df.columns) == tuple(cols)
        assert df.count() > 0
    raw_n = scan_shard_range(spark, shards, "20231231", "20240130").count()
    assert paths.read(spark, "events").count() == raw_n  # stg session ids are unique on this input
    # rebalanced writes: a few files per day, not one per task and day
    import glob
    import os
    days = glob.glob(os.path.join(paths.events.replace("file:", ""), "load=*", "event_date=*"))
    files = glob.glob(os.path.join(paths.events.replace("file:", ""), "load=*", "event_date=*", "*.parquet"))
    assert days and len(files) <= 2 * len(days)


def test_update_is_idempotent_and_differs_from_init_across_midnight(spark, shards):
    root = scratch_path(spark, "test-update")
    init(spark, shards, root, dt.date(2024, 1, 16))
    update(spark, shards, root, dt.date(2024, 1, 16))
    update(spark, shards, root, dt.date(2024, 1, 17))
    paths = TablePaths(root)
    day = dt.date(2024, 1, 15)

    def snapshot():
        return {t: _rows(paths.read(spark, t).where(F.col("event_date" if t == "events" else "date") == day))
                for t in ("src", "stg", "events", "items", "session_days")}

    once = snapshot()
    update(spark, shards, root, dt.date(2024, 1, 17))
    assert snapshot() == once  # re-running a day replaces it
    # earlier days are untouched by the day's overwrite
    assert paths.read(spark, "events").where(F.col("event_date") == dt.date(2024, 1, 14)).count() > 0
    assert len(once["stg"]) > 0 and all(r[2] == day for r in once["stg"])

    # The update sees one day of events and only that day's sessions,
    # so sessions begun before midnight lose their source there
    init_root = scratch_path(spark, "test-init-cmp")
    init(spark, shards, init_root, dt.date(2024, 2, 2))
    full = TablePaths(init_root).read(spark, "events").where(F.col("event_date") == day)
    upd = paths.read(spark, "events").where(F.col("event_date") == day)
    assert full.count() == upd.count()
    lost = upd.where(F.col("session_source").isNull()).count()
    assert lost > full.where(F.col("session_source").isNull()).count()


def test_views_and_sql_functions_over_written_tables(spark, shards):
    from touchline.functions.sql import register_sql_functions

    paths = init(spark, shards, scratch_path(spark, "test-views"), dt.date(2024, 2, 2))
    assert paths.register_views(spark, prefix="t_") == ["t_src_event_traffic", "t_stg_session_traffic",
                                                        "t_events", "t_items"]
    register_sql_functions(spark)
    rows = spark.sql("""
        SELECT channel_group(session_source, session_medium, session_campaign) AS channel, count(*) AS n
        FROM t_events GROUP BY 1""").collect()
    assert sum(r.n for r in rows) == paths.read(spark, "events").count()
    assert {"Unassigned", "Direct"} & {r.channel for r in rows}


def test_cli_init_and_update_day(spark, shards):
    from touchline.__main__ import main

    root = scratch_path(spark, "test-cli")
    assert main(["init", "--raw", shards, "--root", root, "--run-date", "2024-01-16"]) == 0
    assert main(["update-day", "--raw", shards, "--root", root, "--day", "20240114"]) == 0
    ev = TablePaths(root).read(spark, "events")
    assert ev.where(F.col("event_date") == dt.date(2024, 1, 14)).count() > 0
    assert ev.where(F.col("event_date") == dt.date(2024, 1, 15)).count() == 0


def test_init_window_and_skew_safe_forms_write_the_same_tables(spark, shards):
    a = init(spark, shards, scratch_path(spark, "test-init-window"), dt.date(2024, 2, 2), method="window")
    b = init(spark, shards, scratch_path(spark, "test-init-bucketed"), dt.date(2024, 2, 2), method="split")
    for table in ("stg", "events", "items", "src"):
        x, y = a.read(spark, table), b.read(spark, table)
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, table


def _raw(spark, *rows):
    from touchline.schema import RAW_EVENT_SCHEMA

    return spark.createDataFrame(list(rows), RAW_EVENT_SCHEMA)


def test_replayed_day_leaves_exactly_the_new_rows(spark, sf_small):
    raw = driver_raw_events(spark, sf_small)
    for keep in ("event_name <> 'purchase'", "event_name = 'session_start'"):
        first = write_shards(raw, scratch_path(spark, "replay-a"))
        second = write_shards(raw.where(f"event_date <> '20240114' or {keep}"), scratch_path(spark, "replay-b"))
        root, fresh = scratch_path(spark, "replay"), scratch_path(spark, "replay-fresh")
        init(spark, first, root, dt.date(2024, 1, 16))
        init(spark, first, fresh, dt.date(2024, 1, 16))
        update_day(spark, first, root, "20240114")
        update_day(spark, second, root, "20240114")
        update_day(spark, second, fresh, "20240114")
        for table in ("src", "session_days", "stg", "events", "items"):
            got, want = (_rows(TablePaths(r).read(spark, table)) for r in (root, fresh))
            assert got == want, table
        day = TablePaths(root).read(spark, "items").where(F.col("date") == dt.date(2024, 1, 14))
        assert day.count() == 0


def test_tables_without_rows_are_readable(spark, sf_small):
    raw = driver_raw_events(spark, sf_small)
    quiet = write_shards(raw.where("event_name <> 'purchase'"), scratch_path(spark, "quiet"))
    paths = init(spark, quiet, scratch_path(spark, "quiet-tables"), dt.date(2024, 1, 16))
    assert paths.read(spark, "items").count() == 0 and paths.read(spark, "events").count() > 0
    starts = write_shards(raw.where("event_name = 'session_start'"), scratch_path(spark, "starts"))
    paths = update_day(spark, starts, scratch_path(spark, "starts-tables"), "20240114")
    assert paths.read(spark, "src").count() == 0 and paths.read(spark, "events").count() > 0


def test_extra_params_own_rules_and_strict(spark, shards):
    from touchline.operators.traffic import event_traffic, session_rollup
    from tests.helpers import param, raw_row

    extra = {"score": "float"}
    paths = init(spark, shards, scratch_path(spark, "extra"), dt.date(2024, 1, 16), extra_params=extra)
    paths = update_day(spark, shards, paths.root, "20240114", extra_params=extra)
    assert paths.read(spark, "events").where("score is not null").count() > 0
    row = raw_row(1, gsid=5, params=[param("source", s="s"), param("page_location", s="http://x?own=1")])
    src = event_traffic(_raw(spark, row))
    got = session_rollup(src, rules=(("http%own=%", "mine", "paid"),)).first()
    assert (got.session_first_traffic_source.source, got.session_first_traffic_source.medium) == ("mine", "paid")
    twice = raw_row(1, gsid=5, params=[param("source", s="s"), param("source", s="t")])
    with pytest.raises(Exception):
        event_traffic(_raw(spark, twice), strict=True).collect()


def test_first_touch_tie_prefers_an_event_with_a_touch(spark):
    from touchline.operators.traffic import event_traffic, merge_session_days, session_day_partials, session_rollup
    from tests.helpers import param, raw_row

    rows = [raw_row(100, gsid=5), raw_row(100, gsid=5, params=[param("source", s="news")]),
            raw_row(200, gsid=5, params=[param("source", s="late")])]
    src = event_traffic(_raw(spark, *rows))
    for got in (session_rollup(src).first(), merge_session_days(session_day_partials(src)).first()):
        assert got.session_first_traffic_source.source == "news"


ALL_TABLES = ("src", "session_days", "stg", "events", "items")


def _tables(spark, root):
    return {t: _rows(TablePaths(root).read(spark, t)) for t in ALL_TABLES}


class Stopped(Exception):
    pass


def _stop_after(monkeypatch, table, written):
    """Let a load fail right after it has noted ``table`` as finished."""
    write = sinks.write_record

    def stopping(spark, path, record):
        write(spark, path, record)
        if f"/{sinks.LOADS}/" in path:
            written.append(path.rpartition("/")[2].removesuffix(".json"))
            if written[-1] == table:
                raise Stopped(table)

    monkeypatch.setattr(sinks, "write_record", stopping)


@pytest.mark.parametrize("table, kind", [("src", "init"), ("session_days", "update"), ("stg", "update"), ("events", "init"),
                                         ("items", "update")])
def test_stopped_load_leaves_the_old_tables_and_its_repeat_goes_on(spark, shards, monkeypatch, table, kind):
    def load(root):
        return update_day(spark, shards, root, "20240114") if kind == "update" else init(
            spark, shards, root, dt.date(2024, 1, 20))

    root, fresh = scratch_path(spark, "stopped"), scratch_path(spark, "stopped-fresh")
    for r in (root, fresh):
        init(spark, shards, r, dt.date(2024, 1, 16))
    before = _tables(spark, root)
    with monkeypatch.context() as patch:
        _stop_after(patch, TABLES[table], written := [])
        with pytest.raises(Stopped):
            load(root)
    order = list(TABLES)
    assert written == [TABLES[t] for t in order[:order.index(table) + 1]]
    assert _tables(spark, root) == before and version(spark, root).number == 1
    with monkeypatch.context() as patch:  # a repeat writes the other tables only
        _stop_after(patch, None, written := [])
        load(root)
    assert written == [TABLES[t] for t in order[order.index(table) + 1:]]
    assert version(spark, root).number == 2
    load(fresh)
    assert _tables(spark, root) == _tables(spark, fresh)
    assert _rows(TablePaths(root).read(spark, "stg", version(spark, root, 1))) == before["stg"]  # old readers go on


def test_changed_input_starts_the_load_anew(spark, sf_small, monkeypatch):
    raw = driver_raw_events(spark, sf_small)
    path, root = scratch_path(spark, "anew-shards"), scratch_path(spark, "anew")
    write_shards(raw.where("event_name <> 'purchase'"), path)
    with monkeypatch.context() as patch:
        _stop_after(patch, TABLES["src"], [])
        with pytest.raises(Stopped):
            init(spark, path, root, dt.date(2024, 1, 16))
    assert _tables(spark, root) == {t: [] for t in ALL_TABLES}
    write_shards(raw, path)
    spark.catalog.refreshByPath(path)
    init(spark, path, root, dt.date(2024, 1, 16))
    events = TablePaths(root).read(spark, "events").count()
    assert events == scan_shard_range(spark, path, *init_window(dt.date(2024, 1, 16))).count()


def test_second_writer_fails_and_vacuum_keeps_the_last_versions(spark, shards):
    root = scratch_path(spark, "two-writers")
    slow = sinks.Load(spark, root, ["slow"])
    init(spark, shards, root, dt.date(2024, 1, 16))
    with pytest.raises(RuntimeError, match="meanwhile"):
        slow.commit()
    update_day(spark, shards, root, "20240114")
    update_day(spark, shards, root, "20240114")
    now, before = _tables(spark, root), _rows(TablePaths(root).read(spark, "events", version(spark, root, 2)))
    gone = sinks.vacuum(spark, root, keep=2)
    assert not gone and sinks.versions(spark, root) == [2, 3]  # the days of version 1 are still named
    assert _rows(TablePaths(root).read(spark, "events", version(spark, root, 2))) == before
    gone = sinks.vacuum(spark, root, keep=1)
    assert len(gone) == len(ALL_TABLES) and sinks.versions(spark, root) == [3]
    assert _tables(spark, root) == now
    assert sinks.vacuum(spark, scratch_path(spark, "nothing")) == []


def test_suffix_layout_loads_the_same_tables(spark, sf_small, shards):
    raw = driver_raw_events(spark, sf_small)
    both = raw.withColumn("_table", F.explode(F.array("event_date", F.concat(F.lit("intraday_"), "event_date"))))
    path = write_suffix_shards(both, scratch_path(spark, "suffix"), "_table")
    names = [n.rpartition("/")[2] for n in shard_folders(spark, path, "20240105", "20240112")]
    assert names == [f"events_202401{d:02d}" for d in range(5, 13)]
    day = scan_shard(spark, path, "20240115", "auto")
    assert {(r.event_date, r._table_suffix) for r in day.select("event_date", "_table_suffix").distinct().collect()} == {
        ("20240115", "20240115")}
    assert scan_shard_range(spark, path, "20300101", "20300105", "suffix").count() == 0
    assert scan_shard(spark, shards, "20240115", "auto").count() == day.count()
    roots = []
    for source in (path, shards):
        roots.append(init(spark, source, scratch_path(spark, "suffix-tables"), dt.date(2024, 1, 16)).root)
        update(spark, source, roots[-1], dt.date(2024, 1, 17))
    assert _tables(spark, roots[0]) == _tables(spark, roots[1])


def test_load_reports_and_refuses_bad_input(spark, sf_small, shards):
    root = scratch_path(spark, "checks")
    checks = init(spark, shards, root, dt.date(2024, 1, 16), fail_on_bad_input=True).checks
    per_day = {r.event_date: r["count"] for r in driver_raw_events(spark, sf_small).groupBy("event_date").count().collect()}
    days = [d for d in checks["rows_per_day"] if d in per_day]
    assert checks["null_timestamps"] == checks["other_dates"] == 0 and len(checks["rows_per_day"]) == 31 and days
    assert checks["rows_per_day"] == {d: per_day.get(d, 0) for d in checks["rows_per_day"]}
    assert checks["rows"] == sum(checks["rows_per_day"].values())
    assert version(spark, root).notes["checks"] == checks
    before = _tables(spark, root)

    raw = driver_raw_events(spark, sf_small).where("event_date = '20240114'")
    some = F.col("event_timestamp") % 2 == 0
    n = raw.where(some).count()
    late = raw.withColumn("_table", F.lit("20240114")).withColumn(
        "event_date", F.when(some, F.lit("20240113")).otherwise(F.col("event_date")))
    untimed = raw.withColumn("_table", F.lit("20240114")).withColumn(
        "event_timestamp", F.when(~some, F.col("event_timestamp")))
    for bad, what in ((late, "other_dates"), (untimed, "null_timestamps")):
        path = write_suffix_shards(bad, scratch_path(spark, "bad"), "_table")
        with pytest.raises(BadInput, match="nothing was published"):
            update_day(spark, path, root, "20240114", fail_on_bad_input=True)
        assert _tables(spark, root) == before
        checks = update_day(spark, path, scratch_path(spark, "bad-tables"), "20240114").checks
        assert checks[what] == n and checks["rows"] == raw.count()


def test_load_without_shards(spark, shards):
    root = scratch_path(spark, "no-shards")
    checks = init(spark, shards, root, dt.date(2030, 1, 16)).checks
    assert _tables(spark, root) == {t: [] for t in ALL_TABLES}
    assert checks["rows"] == 0 and set(checks["rows_per_day"].values()) == {0}


@pytest.mark.parametrize("key", ["session_engaged", "source", "page_title", "ga_session_id", "campaign"])
def test_strict_load_fails_on_a_key_given_twice(spark, key):
    twice = [param(key, s="1", i=1), param(key, i=0)]
    rows = [raw_row(1, gsid=None if key == "ga_session_id" else 5, params=twice, day="20240110"),
            raw_row(2, gsid=5, params=[param("other", s="x"), param("other", s="y")], day="20240110")]
    path = write_shards(_raw(spark, *rows), scratch_path(spark, "twice"))
    root = scratch_path(spark, "twice-tables")
    with pytest.raises(Exception, match="more than once"):
        init(spark, path, root, dt.date(2024, 1, 16), strict=True)
    assert version(spark, root).number == 0
    assert init(spark, path, root, dt.date(2024, 1, 16)).read(spark, "events").count() == 2


def test_strict_ignores_other_keys(spark):
    rows = [raw_row(2, gsid=5, params=[param("other", s="x"), param("other", s="y")], day="20240110")]
    path = write_shards(_raw(spark, *rows), scratch_path(spark, "others"))
    paths = init(spark, path, scratch_path(spark, "others-tables"), dt.date(2024, 1, 16), strict=True)
    assert paths.read(spark, "events").count() == 1


def test_extra_param_named_like_a_column_is_refused(spark, shards):
    with pytest.raises(ValueError, match="page_title"):
        init(spark, shards, scratch_path(spark, "clash"), dt.date(2024, 1, 16), extra_params={"page_title": "string"})


def test_run_date_defaults_to_today_in_utc(monkeypatch):
    class Clock(dt.datetime):
        @classmethod
        def now(cls, tz=None):
            return dt.datetime(2024, 3, 1, 0, 30, tzinfo=dt.timezone(dt.timedelta(hours=2))).astimezone(tz)

    monkeypatch.setattr(dates.dt, "datetime", Clock)
    assert init_window() == init_window(dt.date(2024, 2, 29)) == ("20240127", "20240226")
    assert update_window() == update_window(dt.date(2024, 2, 29))


def test_dealt_shards_hold_all_rows_and_split_large_days(spark, tmp_path, monkeypatch):
    """A day with most rows, repeated and missing ids, and events without a time."""
    monkeypatch.setattr("touchline.sources.fixture.TASK_EVENTS", 20)
    start = dt.datetime(2024, 1, 5, 12)
    times = [start + dt.timedelta(minutes=i) for i in range(400)] + [start + dt.timedelta(days=d) for d in (1, 2, 2)] + [None] * 3
    rows = [(None if i % 50 == 7 else i // 2, t, i % 9, "purchase" if i % 4 else "view", 1.0 * i, f'{{"k": {i}}}' if i % 6 else None)
            for i, t in enumerate(times)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    plain = driver_raw_events(spark, str(tmp_path))
    shards = write_shards(driver_raw_events(spark, str(tmp_path), dealt=True), scratch_path(spark, "dealt"), dealt=True)
    stored = spark.read.parquet(shards).withColumn("event_date", F.col("event_date").cast("string")).select(*plain.columns)
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, plain.collect()))
    files = stored.select(F.input_file_name().alias("f"), "event_date").distinct().groupBy("event_date").count()
    assert {r.event_date: r["count"] for r in files.collect()}["20240105"] > 5
