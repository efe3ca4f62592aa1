import datetime as dt

from pyspark.sql import functions as F

from touchline.plans.reporting import TablePaths, init, update_day
from touchline.session import scratch_path
from touchline.sources.fixture import driver_raw_events
from touchline.streaming import start_daily_updates


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_arriving_shards_trigger_daily_updates(spark, sf_small):
    raw = driver_raw_events(spark, sf_small)
    landing = scratch_path(spark, "landing")
    # the export so far: up to 2024-01-13
    raw.where(F.col("event_date") <= "20240113").write.partitionBy("event_date").parquet(landing)
    root = scratch_path(spark, "stream-tables")
    init(spark, landing, root, dt.date(2024, 1, 16))
    ckpt = scratch_path(spark, "stream-ckpt")
    q = start_daily_updates(spark, landing, root, ckpt, from_day="20240114")
    q.awaitTermination(300)
    assert TablePaths(root).read(spark, "events").where(F.col("event_date") > dt.date(2024, 1, 13)).count() == 0
    # two new shards land
    for day in ("20240114", "20240115"):
        raw.where(F.col("event_date") == day).write.mode("append").partitionBy("event_date").parquet(landing)
    q = start_daily_updates(spark, landing, root, ckpt, from_day="20240114")
    q.awaitTermination(300)
    assert q.exception() is None
    events = TablePaths(root).read(spark, "events")
    got = _rows(events.where(F.col("event_date") == dt.date(2024, 1, 15)))
    assert got

    # same result as running the batch update for those days directly
    ref = scratch_path(spark, "batch-tables")
    init(spark, landing, ref, dt.date(2024, 1, 16))
    update_day(spark, landing, ref, "20240114")
    update_day(spark, landing, ref, "20240115")
    want = _rows(TablePaths(ref).read(spark, "events").where(F.col("event_date") == dt.date(2024, 1, 15)))
    assert got == want
