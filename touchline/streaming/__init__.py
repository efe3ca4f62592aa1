"""Incremental driver of the daily update: a file-stream over the raw export
root runs ``update_day`` for each shard that lands (Structured Streaming,
``foreachBatch``, restartable from its checkpoint)."""

from touchline.streaming.daily import start_daily_updates

__all__ = ["start_daily_updates"]
