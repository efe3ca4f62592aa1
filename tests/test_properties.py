"""Properties of the reporting outputs on the driver's test tables."""

import pytest
from pyspark.sql import functions as F

from touchline.operators.events import build_events, event_columns
from touchline.operators.traffic import FILLED, event_traffic, lookback_fill, session_rollup, session_traffic
from touchline.plans import catalog


@pytest.fixture(scope="module")
def raw(spark, sf_small):
    return catalog.init_raw(spark, sf_small)


def test_previous_timestamp_non_negative_and_first_is_zero(raw):
    ev = event_columns(raw)
    assert ev.where(F.col("previous_timestamp") < 0).count() == 0
    firsts = (ev.groupBy("user_pseudo_id", "ga_session_id")
              .agg(F.min_by("previous_timestamp", "event_timestamp").alias("p")))
    assert firsts.where(F.col("p") != 0).count() == 0


def test_one_exit_flag_at_least_per_session_number(raw):
    ev = event_columns(raw)
    per_group = ev.groupBy("user_pseudo_id", "ga_session_number").agg(F.count("exit_page").alias("n"))
    assert per_group.where(F.col("n") < 1).count() == 0


def test_widening_lookback_keeps_found_touches(raw):
    prep = session_rollup(event_traffic(raw))
    short = lookback_fill(prep, 172800).select("session_id", "user_pseudo_id", "session_start",
                                              F.col(FILLED).alias("short"))
    long = lookback_fill(prep, 2592000).select("session_id", "user_pseudo_id", "session_start",
                                             F.col(FILLED).alias("long"))
    keys = ["session_id", "user_pseudo_id", "session_start"]
    j = short.join(long, [short[k].eqNullSafe(long[k]) for k in keys]).where(F.col("short").isNotNull())
    assert j.count() > 0
    assert j.where(~F.col("short").eqNullSafe(F.col("long"))).count() == 0


def test_events_keep_every_raw_row(raw):
    stg = session_traffic(event_traffic(raw))
    assert stg.groupBy("session_id").count().where(F.col("count") > 1).count() == 0
    assert build_events(raw, stg).count() == raw.count()


def test_skew_safe_and_direct_forms_agree(raw):
    direct = event_columns(raw, "window")
    safe = event_columns(raw, "split")
    assert direct.exceptAll(safe).count() == 0 and safe.exceptAll(direct).count() == 0


@pytest.mark.parametrize("large_group", [0, 3, 40, 10**9])
def test_lag_limit_does_not_change_the_events_table(raw, large_group):
    stg = session_traffic(event_traffic(raw))
    stg = stg.unionByName(stg.limit(5).withColumn("source", F.lit("again")))  # ids that several sessions share
    direct = build_events(raw, stg, "window")
    safe = build_events(raw, stg, "split", large_group=large_group)
    assert direct.columns == safe.columns
    assert direct.exceptAll(safe).count() == 0 and safe.exceptAll(direct).count() == 0
