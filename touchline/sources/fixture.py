"""Stand-in input: the driver's ``events`` table shaped as raw export rows.

It only produces rows in the raw schema (nested structs, a repeated
``event_params`` key/value bag, an ``items`` array); every attribution,
flattening and classification step runs afterwards through the library on
that input and would run the same on a real export. Formulas:

* us = epoch micros of ``ts``; k = ``props.k``; m = event_id % 20
* event_name: view->page_view, click->session_start, signup->first_visit,
  error->exception, purchase->purchase
* user_pseudo_id NULL when event_id % 97 = 0, else 'u' + user_id;
  user_id NULL when event_id % 3 = 0
* ga_session_id absent when event_id % 89 = 0, else the noon-to-noon day
  start of the event (seconds); ga_session_number from it
* traffic params and page_location by m (``TRAFFIC_BY_M``); a NULL param is
  absent from the array
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.dates import timestamp_to_micros
from touchline.schema import RAW_EVENT_SCHEMA

EVENT_NAMES = {
    "view": "page_view",
    "click": "session_start",
    "signup": "first_visit",
    "error": "exception",
    "purchase": "purchase",
}

PAGE_ROOT = "https://shop.example"

# m -> (source, medium, campaign, gclid, page suffix)
TRAFFIC_BY_M = {
    **{m: (None, None, None, None, "/p") for m in range(6)},
    6: (None, None, None, None, "/p?fbclid=1"),
    7: ("google", "organic", None, None, "/p"),
    8: ("google", "cpc", "brand", None, "/p?gclid=1"),
    9: (None, None, None, "g1", "/p"),
    10: ("facebook", "social", None, None, "/p?fbclid=1"),
    11: ("tiktok", "referral", "x", None, "/p?ttclid=1"),
    12: ("bing", "organic", None, None, "/p?msclkid=1"),
    13: ("newsletter", "email", "weekly", None, "/p"),
    14: ("youtube", "video", None, None, "/p"),
    15: ("partner", "affiliate", None, None, "/p"),
    16: ("amazon", "cpc", "eshop-sale", None, "/p"),
    17: (None, None, "cross-network", None, "/p"),
    18: ("blog.example", "referral", None, None, "/p"),
    19: ("(direct)", "(none)", None, None, "/p"),
}

TRAFFIC_KEYS = ("source", "medium", "campaign", "gclid")

# Events for which one task builds and writes raw rows: a few seconds of work, and a day still has several files.
TASK_EVENTS = 100_000

DEVICE_CATEGORIES = ("desktop", "mobile", "tablet")
DEVICE_LANGUAGES = ("en", "fr", "de", "es", "en-us", "om", "EN", None)


def _lookup(mapping: dict, key: Column, field: int) -> Column:
    pairs = chain.from_iterable((F.lit(k), F.lit(v[field]).cast("string")) for k, v in mapping.items())
    return F.try_element_at(F.create_map(*pairs), key)


def _pick(values, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), index.cast("int"))


def _value(s=None, i=None, f=None, d=None) -> Column:
    none = F.lit(None)
    return F.struct(
        (s if s is not None else none).cast("string").alias("string_value"),
        (i if i is not None else none).cast("long").alias("int_value"),
        (f if f is not None else none).cast("double").alias("float_value"),
        (d if d is not None else none).cast("double").alias("double_value"),
    )


def _param(key: str, value: Column) -> Column:
    return F.struct(F.lit(key).alias("key"), value.alias("value"))


def _text(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"))


def _traffic_params(m: int, none: Column) -> Column:
    """The traffic params of the events with this ``m`` (a constant)."""
    found = [_param(key, _value(s=F.lit(v))) for key, v in zip(TRAFFIC_KEYS, TRAFFIC_BY_M[m]) if v is not None]
    return F.array(*found) if found else none


def raw_events_from_driver(events: DataFrame) -> DataFrame:
    if isinstance(events.schema["ts"].dataType, T.TimestampNTZType):
        us = timestamp_to_micros(F.col("ts"))
    else:
        us = F.unix_micros(F.col("ts"))
    b = events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object(F.col("props"), "$.k").cast("long").alias("k"),
        us.alias("us"),
        (F.col("event_id") % 20).alias("m"),
    ).withColumn(
        "gsid",
        F.when(F.col("event_id") % 89 != 0, F.expr("((us div 1000000 - 43200) div 86400) * 86400 + 43200")),
    ).withColumn("gsn", F.expr("(gsid - 1703980800) div 172800"))

    k, m, value, eid, gsid, gsn = (F.col(c) for c in ("k", "m", "value", "event_id", "gsid", "gsn"))
    none = F.array().cast(RAW_EVENT_SCHEMA["event_params"].dataType)
    traffic = F.array(*[_traffic_params(m, none) for m in sorted(TRAFFIC_BY_M)])
    # short arrays put together, not one array whose NULL elements a lambda drops: lambdas, and all below them, are
    # interpreted row by row
    params = F.flatten(F.array(
        F.when(gsid.isNotNull(), F.array(_param("ga_session_id", _value(i=gsid)), _param("ga_session_number", _value(i=gsn))))
        .otherwise(none),
        F.array(_param("page_location", _value(s=F.concat(F.lit(PAGE_ROOT), _lookup(TRAFFIC_BY_M, m, 4)))),
                _param("page_title", _value(s=_text("Page ", k % 10)))),
        F.coalesce(F.get(traffic, m.cast("int")), none),
        F.when(eid % 5 == 0, F.array(_param("entrances", _value(i=F.lit(1))))).otherwise(none),
        F.when(k % 3 == 0, F.array(_param("session_engaged", _value(s=F.lit("1")))))
        .when(k % 3 == 1, F.array(_param("session_engaged", _value(i=F.lit(0))))).otherwise(none),
        F.array(_param("engagement_time_msec", _value(i=k * 100))),
        F.when(k % 2 == 0, F.array(_param("score", _value(f=value))))
        .when(k % 2 == 1, F.array(_param("score", _value(d=value)))).otherwise(none),
    ))
    x4 = _text("x", k % 4)
    purchase = F.col("event_type") == F.lit("purchase")

    def item(i: int) -> Column:
        return F.struct(
            _text("item", (k + i) % 10).alias("item_name"),
            (F.lit(None).cast("string") if i == 1 else F.lit(f"v{i}")).alias("item_variant"),
            (k % 5 + 1).cast("long").alias("quantity"),
            value.alias("item_revenue"),
        )

    names = list(chain.from_iterable((F.lit(a), F.lit(b)) for a, b in EVENT_NAMES.items()))
    raw = b.select(
        F.date_format(F.col("ts"), "yyyyMMdd").alias("event_date"),
        F.col("us").alias("event_timestamp"),
        F.try_element_at(F.create_map(*names), F.col("event_type")).alias("event_name"),
        params.alias("event_params"),
        F.when(eid % 3 != 0, F.col("user_id").cast("string")).alias("user_id"),
        F.when(eid % 97 != 0, _text("u", F.col("user_id"))).alias("user_pseudo_id"),
        F.struct(
            _pick(DEVICE_CATEGORIES, k % 3).alias("category"),
            _pick(DEVICE_LANGUAGES, eid % 8).alias("language"),
            x4.alias("operating_system"),
            x4.alias("operating_system_version"),
            x4.alias("mobile_brand_name"),
            x4.alias("mobile_model_name"),
            F.struct(x4.alias("browser"), x4.alias("browser_version")).alias("web_info"),
        ).alias("device"),
        F.struct(x4.alias("country"), x4.alias("city"), x4.alias("region")).alias("geo"),
        F.struct(x4.alias("source"), x4.alias("medium"), x4.alias("name")).alias("traffic_source"),
        F.when(purchase, F.struct(
            (k % 3).cast("long").alias("total_item_quantity"),
            value.alias("purchase_revenue"),
            F.lit(None).cast("double").alias("refund_value"),
            F.lit(1.5).alias("shipping_value"),
            F.lit(0.25).alias("tax_value"),
            (k % 3).cast("long").alias("unique_items"),
            _text("t", eid).alias("transaction_id"),
        )).alias("ecommerce"),
        F.slice(F.array(item(0), item(1)), 1, F.when(purchase, (k % 3).cast("int")).otherwise(F.lit(0))).alias("items"),
    )
    return raw.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_EVENT_SCHEMA.fields])


def dealt_by_time(events: DataFrame) -> DataFrame:
    """``events`` dealt over ranges of their time, of about TASK_EVENTS rows at
    most. Raw rows built from them lie by day, however many row groups the table
    has and rows a day has, and only the narrow rows have moved."""
    least = events.sparkSession.sparkContext.defaultParallelism
    return events.repartitionByRange(max(least, -(-events.count() // TASK_EVENTS)), "ts", "event_id")


def driver_raw_events(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """``dealt``: by ranges of time, for ``write_shards(..., dealt=True)``."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return raw_events_from_driver(dealt_by_time(events) if dealt else events)
