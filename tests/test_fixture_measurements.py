"""Counts measured independently while surveying (FIXTURES.md "Coverage
measured", SURVEY §5.4), reproduced through the library on the same tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from touchline.operators.events import build_events
from touchline.operators.items import purchase_items
from touchline.operators.traffic import FILLED, FIRST, LAST, event_traffic, lookback_fill, session_rollup, session_traffic
from touchline.plans import catalog

DAY = dt.date(2024, 1, 15)


@pytest.fixture(scope="module")
def raw(spark, sf_small):
    return catalog.init_raw(spark, sf_small)


def test_session_attribution_breakdown_sf0001(raw):
    prep = session_rollup(event_traffic(raw))
    assert prep.count() == 339
    assert prep.where(F.col(FIRST).isNotNull()).count() == 211
    assert prep.where(F.col(FIRST).isNull() & F.col(LAST).isNotNull()).count() == 49
    for lookback, filled, nothing in ((2592000, 73, 6), (172800, 59, 20)):
        keys = ["session_id", "user_pseudo_id", "session_start"]
        filled_df = lookback_fill(prep, lookback).alias("o")
        p = prep.select(*keys, FIRST, LAST).alias("p")
        out = filled_df.join(p, [F.col(f"o.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]) \
            .select(F.col(f"p.{FIRST}").alias(FIRST), F.col(f"p.{LAST}").alias(LAST), F.col(f"o.{FILLED}").alias(FILLED))
        assert out.count() == 339
        both_null = out.where(F.col(FIRST).isNull() & F.col(LAST).isNull())
        assert both_null.where(F.col(FILLED).isNotNull()).count() == filled, lookback
        assert out.where(F.col(FILLED).isNull()).count() == nothing, lookback


def test_event_and_item_counts_sf0001(raw):
    ev = build_events(raw, session_traffic(event_traffic(raw)))
    assert ev.where(F.col("session_source").isNull()).count() == 109
    assert ev.where(F.col("user_pseudo_id").isNull()).count() == 11
    assert ev.where(F.col("ga_session_id").isNull()).count() == 12
    assert ev.where(F.col("user_pseudo_id").isNull() & F.col("ga_session_id").isNull()).count() == 1
    assert purchase_items(raw).count() == 214
    assert raw.where((F.col("event_name") == "purchase") & (F.size("items") == 0)).count() == 63


def test_update_day_counts_sf0001(spark, sf_small):
    tables = catalog.updated_tables(spark, sf_small)
    ev = tables.read(spark, "events").where(F.col("event_date") == DAY)
    stg = tables.read(spark, "stg").where(F.col("date") == DAY)
    assert ev.count() == 26 and stg.count() == 7
    init_stg = catalog.init_tables(spark, sf_small).read(spark, "stg")
    earlier = ev.join(init_stg.where(F.col("date") < DAY).select("session_id"), "session_id")
    assert earlier.count() == 5


def test_init_vs_update_differences_sf001(spark):
    sf = "/root/testdata/sf0.01"
    full = catalog.init_tables(spark, sf).read(spark, "events").where(F.col("event_date") == DAY)
    upd = catalog.updated_tables(spark, sf).read(spark, "events").where(F.col("event_date") == DAY)
    key = ["event_timestamp", "event_name", "user_pseudo_id"]
    j = full.alias("f").join(upd.alias("u"), [F.col(f"f.{k}").eqNullSafe(F.col(f"u.{k}")) for k in key])
    assert full.count() == upd.count() == j.count() == 317
    f_src, u_src = F.col("f.session_source"), F.col("u.session_source")
    assert j.where(f_src.isNotNull() & u_src.isNull()).count() == 90
    assert j.where(f_src.isNotNull() & u_src.isNotNull() & (f_src != u_src)).count() == 9
    assert j.where(~F.col("f.previous_timestamp").eqNullSafe(F.col("u.previous_timestamp"))).count() == 66
    assert j.where(~F.col("f.exit_page").eqNullSafe(F.col("u.exit_page"))).count() == 91
