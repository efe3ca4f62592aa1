import random
from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from touchline.operators.events import exit_flag, flatten_events, seconds_since_previous
from touchline.operators.items import purchase_items
from touchline.operators.ordered import (
    MOST_PIECES,
    group_cuts,
    lag_in_pieces,
    max_by_join,
    max_in_groups,
    not_null_keys,
    piece_of,
)
from touchline.schema import FLAT_EVENT_COLUMNS
from touchline.operators.events import event_columns

from helpers import param, raw_df, raw_row, rows_of


def test_exit_flag_ties_and_null_session_number(spark):
    rows = [
        raw_row(10, gsid=1, gsn=0), raw_row(20, gsid=1, gsn=0), raw_row(20, gsid=2, gsn=0),
        raw_row(5, gsid=3, gsn=None), raw_row(7, gsid=3, gsn=None),
    ]
    for method in ("bucketed", "aggregate", "window"):
        out = exit_flag(flatten_events(raw_df(spark, rows)), method, bucket_micros=3)
        got = rows_of(out, "_us", "ga_session_id", "exit_page")
        assert got == sorted([(10, 1, None), (20, 1, 1), (20, 2, 1), (5, 3, None), (7, 3, 1)], key=repr), method


def test_previous_timestamp_seconds(spark):
    rows = [raw_row(1_000_000, gsid=1), raw_row(3_500_000, gsid=1), raw_row(4_000_000, gsid=2),
            raw_row(9_000_000, gsid=1)]
    for method in ("split", "window"):
        out = seconds_since_previous(flatten_events(raw_df(spark, rows)), method, large_group=2)
        got = rows_of(out, "_us", "previous_timestamp")
        assert got == [(1_000_000, 0.0), (3_500_000, 2.5), (4_000_000, 0.0), (9_000_000, 5.5)], method


def _brute_lag(rows):
    out = {}
    groups = {}
    for rid, k, ts in rows:
        groups.setdefault(k, []).append((ts, rid))
    for k, items in groups.items():
        items.sort(key=lambda x: (x[0] is not None, x[0]))
        prev = None
        for ts, rid in items:
            out[rid] = prev
            prev = ts
    return out


@pytest.mark.parametrize("seed", [7, 8])
def test_bucketed_lag_and_max_match_brute_force_under_skew(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for rid in range(600):
        k = None if rnd.random() < 0.5 else rnd.randrange(5)  # one hot (NULL) group
        ts = rnd.sample(range(10_000), 1)[0] if rnd.random() > 0.02 else None
        rows.append((rid, k, ts))
    # unique timestamps inside a group, so LAG is fully determined
    seen, uniq = set(), []
    for rid, k, ts in rows:
        if (k, ts) in seen and ts is not None:
            continue
        seen.add((k, ts))
        uniq.append((rid, k, ts))
    df = spark.createDataFrame(uniq, "rid int, k int, ts long")
    expected = _brute_lag(uniq)
    grouped, keys = not_null_keys(df, {"g": F.col("k").cast("long")})
    assert {r.rid: r.prev for r in lag_in_pieces(grouped, keys, "ts", "prev").collect()} == expected
    sizes = {}
    for _, k, _ in uniq:
        sizes[k] = sizes.get(k, 0) + 1
    for piece_rows in (1, 7, 150, 10_000):
        for some in (list(sizes), [None], [1, 3], []):  # whichever groups are split
            large = spark.createDataFrame([(k, sizes[k]) for k in some], "k int, n long")
            large = not_null_keys(large, {"g": F.col("k").cast("long")})[0].select(*keys, "n")
            cuts = group_cuts(grouped, keys, "ts", large, max([sizes[k] for k in some], default=1), piece_rows)
            rows_of_piece = {}
            for r in lag_in_pieces(grouped, keys, "ts", "prev", cuts=cuts).collect():
                assert r.prev == expected[r.rid], (piece_rows, some)
                rows_of_piece[r.k, r._piece] = rows_of_piece.get((r.k, r._piece), 0) + 1
            nulls = sum(1 for _, k, ts in uniq if ts is None)
            assert all(n <= 2 * piece_rows + nulls for (k, _), n in rows_of_piece.items() if k in some and piece_rows > 1)
    for width in (37, 1000, 100_000):
        mx = {r.rid: r.mx for r in max_in_groups(df, ["k"], "ts", "mx", width).collect()}
        assert {r.rid: r.mx for r in max_by_join(df, ["k"], "ts", "mx").collect()} == mx
        gmax = {}
        for _, k, ts in uniq:
            if ts is not None:
                gmax[k] = max(gmax.get(k, ts), ts)
        assert mx == {rid: gmax.get(k) for rid, k, _ in uniq}, width


def test_flatten_projection_and_types(spark):
    rows = [raw_row(1_704_067_207_179_575, gsid=1, gsn=2, language="en",
                    params=[param("page_location", s="https://a/p"), param("page_title", s="T"),
                            param("entrances", i=1), param("session_engaged", i=0),
                            param("engagement_time_msec", i=300)])]
    out = event_columns(raw_df(spark, rows), "split")
    assert tuple(out.columns) == FLAT_EVENT_COLUMNS
    r = out.first()
    assert r.session_id == "u11" and str(r.event_date) == "2024-01-15"
    assert r.event_timestamp.isoformat() == "2024-01-01T00:00:07.179575"
    assert (r.page_title, r.entrances, r.session_engaged, r.engagement_time_msec) == ("T", 1, "0", 300)
    assert (r.device_browser, r.geo_country, r.previous_timestamp, r.exit_page) == ("b", "c", 0.0, 1)
    types = dict(out.dtypes)
    assert types["event_timestamp"] == "timestamp_ntz" and types["previous_timestamp"] == "double"
    assert types["exit_page"] == "bigint" and types["event_date"] == "date"


def test_event_timestamp_independent_of_session_time_zone(spark):
    rows = [raw_row(0, gsid=1)]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = flatten_events(raw_df(spark, rows)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert r.event_timestamp.isoformat() == "1970-01-01T00:00:00"


def test_items_inner_explode(spark):
    item = {"item_name": "a", "item_variant": None, "quantity": 2, "item_revenue": 1.5}
    rows = [raw_row(1, name="purchase", items=[item, item]), raw_row(2, name="purchase", items=[]),
            raw_row(3, name="purchase", items=None), raw_row(4, name="page_view", items=[item])]
    out = purchase_items(raw_df(spark, rows))
    assert out.columns == ["date", "item_name", "item_variant", "item_quantity", "item_revenue"]
    assert out.count() == 2


def test_timestamp_ties_are_ordered_by_event_name(spark):
    rows = [raw_row(1_000_000, gsid=1, name="page_view"), raw_row(3_000_000, gsid=1, name="session_start"),
            raw_row(3_000_000, gsid=1, name="first_visit"), raw_row(3_000_000, gsid=1, name="page_view")]
    for method in ("split", "window"):
        out = seconds_since_previous(flatten_events(raw_df(spark, rows)), method, large_group=2)
        got = rows_of(out, "_us", "event_name", "previous_timestamp")
        assert got == [(1_000_000, "page_view", 0.0), (3_000_000, "first_visit", 2.0),
                       (3_000_000, "page_view", 0.0), (3_000_000, "session_start", 0.0)], method


def test_piece_of_is_a_binary_search_of_the_cuts(spark):
    """Not a look at each of up to 4095 cuts for every event."""
    many = [3 * i for i in range(MOST_PIECES - 1)]
    lists = [None, [], [5], [1, 4, 9], many[:64], many]
    stamps = [None, -1, 0, 1, 4, 5, 6, 192, 193, 9000, 3 * len(many), 10**15]
    rows = [(i, t, c) for i, (t, c) in enumerate((t, c) for t in stamps for c in lists)]
    found = spark.createDataFrame(rows, "i int, t long, c array<long>").select("i", piece_of(F.col("t"), F.col("c")).alias("p"))
    expected = {i: 0 if t is None or not c else bisect_left(c, t) for i, t, c in rows}
    assert {r.i: r.p for r in found.collect()} == expected
    assert "filter(" not in found._jdf.queryExecution().optimizedPlan().toString()
