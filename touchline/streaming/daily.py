"""Run the daily update whenever new export shards arrive.

The raw root is watched as a Structured Streaming file source (partition
discovery on ``event_date=yyyyMMdd`` directories). Each micro-batch only
names the days that received files; for each such day, in date order, the
batch job ``update_day`` replaces that day in src / stg / events / items
(whole days, committed together, so a replayed batch is idempotent). The stream's
checkpoint records which files were handled, so a restarted job resumes where
it stopped; ``availableNow`` processes what is there and stops, which suits a
scheduled run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from touchline.functions.dates import LOOKBACK_SECONDS
from touchline.plans.reporting import update_day
from touchline.schema import RAW_EVENT_SCHEMA
from touchline.sources.raw import PARTITION_COLUMN


def start_daily_updates(spark: SparkSession, raw_path: str, root: str, checkpoint_location: str,
                        from_day: str, lookback_seconds: int = LOOKBACK_SECONDS,
                        method: str = "split", available_now: bool = True,
                        processing_time: str = "1 hour") -> StreamingQuery:
    """``from_day`` (yyyyMMdd): shards of earlier days are acknowledged but not
    re-run - the first day after the initial load's window, whose days must not
    be replaced by one-day updates."""
    arrivals = (
        spark.readStream.schema(RAW_EVENT_SCHEMA)
        .option("basePath", raw_path)
        .parquet(raw_path)
        .select(PARTITION_COLUMN)
    )

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # One row per day that received files - a handful of values.
        days = sorted(r[PARTITION_COLUMN] for r in batch.select(PARTITION_COLUMN).distinct().collect())
        days = [d for d in days if d >= from_day]
        for day in days:
            update_day(spark, raw_path, root, day, lookback_seconds=lookback_seconds, method=method,
                       layout="partition")

    writer = arrivals.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
