"""Plan-shape checks: no Python in any query of the reference's operators, pushdown
reaches the scan, and the skew-safe forms move wide rows no more often than they
say."""

import pytest

from touchline.operators.events import build_events
from touchline.sources.fixture import driver_raw_events
from touchline.sources.raw import scan_shard_range
from touchline.operators.traffic import all_event_traffic, event_traffic, session_day_partials, session_traffic
from touchline.plans import catalog
from touchline.session import materialize, scratch_path
from touchline.sources.raw import write_shards


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_evaluation(spark, sf_small, name):
    plan = _plan(catalog.QUERIES[name](spark, sf_small))
    assert "EvalPython" not in plan and "PythonUDF" not in plan and "MapInPandas" not in plan


def test_event_name_filter_and_column_pruning_reach_parquet(spark, sf_small):
    shards = write_shards(driver_raw_events(spark, sf_small), scratch_path(spark, "plan-shards"))
    src = event_traffic(scan_shard_range(spark, shards, "20240101", "20240110"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = _plan(src)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [Not(In(event_name, [first_visit,session_start]))" in plan.replace("'", "")
    assert "PartitionFilters" in plan
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "device" not in read_schema and "items" not in read_schema and "ecommerce" not in read_schema
    assert "event_params:array<struct<key:string,value:struct<string_value:string,int_value:bigint>>>" in read_schema


def _exchanges(df):
    return _plan(df).count("Exchange hashpartitioning")


def _wide_exchanges(df, wide):
    """Hash exchanges, in the initial plan, of rows that hold column ``wide``."""
    exchanges, plan = 0, df._jdf.queryExecution().executedPlan()
    stack = [plan]
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.initialPlan()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "Exchange" and "hashpartitioning" in node.toString().split("\n")[0]:
            exchanges += wide in node.output().mkString(",")
    return exchanges


@pytest.fixture
def no_broadcast(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("large_group", [0, 10**9])
def test_events_move_once(spark, sf_small, large_group, no_broadcast):
    """For LAG; their sessions come to where they are. The direct form moves
    them for each window and for the join."""
    raw = driver_raw_events(spark, sf_small)
    stg = session_traffic(event_traffic(raw))
    assert _wide_exchanges(build_events(raw, stg, large_group=large_group), "page_title") == 1
    assert _wide_exchanges(build_events(raw, stg, "window"), "page_title") == 3


@pytest.mark.parametrize("large_user", [0, 10**9])
def test_sessions_move_once_from_day_partials_to_stg(spark, sf_small, large_user, no_broadcast):
    """Merge and lookback find the dealt partials in place; a carried touch of
    a large user is a narrow row."""
    partials = materialize(session_day_partials(all_event_traffic(driver_raw_events(spark, sf_small))))
    stg = session_traffic(None, partials=partials, large_user=large_user)
    assert _wide_exchanges(stg, "session_id") == 1
    if large_user:
        assert _exchanges(stg) == 1 and "Join" not in _plan(stg)


def test_lookback_without_large_users_is_the_direct_plan(spark, sf_small):
    src = event_traffic(driver_raw_events(spark, sf_small))
    stg = session_traffic(src)
    assert _exchanges(stg) == 2 and _wide_exchanges(stg, "session_id") == 2
    assert "Join" not in _plan(stg)
    assert _exchanges(session_traffic(src, method="window")) == 2


def test_rebalance_before_partitioned_write_of_shuffled_output(spark, sf_small):
    from touchline.sources.sinks import _prepare

    ev = catalog.QUERIES["events_sessionized"](spark, sf_small)
    plan = _prepare(ev, "event_date", True)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_raw_rows_are_built_after_the_only_shuffle_and_without_lambdas(spark, sf_small):
    """The stand-in export's rows are many times as wide as the events'."""
    plan = _plan(catalog.raw_events(spark, sf_small))
    exchanges = [line for line in plan.split("\n") if "Exchange" in line]
    assert len(exchanges) == 1 and "rangepartitioning(ts" in exchanges[0]
    assert "event_params" not in plan[plan.index(exchanges[0]):]
    assert "lambdafunction" not in plan
