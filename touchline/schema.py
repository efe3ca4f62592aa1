"""Raw event schema (GA4 export shape) and the column contracts of the four
derived tables. Column order is part of the contract: Spark's ``partitionBy``
moves the partition column to the end on read-back, so readers re-select it."""

from pyspark.sql import types as T

PARAM_VALUE = T.StructType(
    [
        T.StructField("string_value", T.StringType()),
        T.StructField("int_value", T.LongType()),
        T.StructField("float_value", T.DoubleType()),
        T.StructField("double_value", T.DoubleType()),
    ]
)

EVENT_PARAMS = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", PARAM_VALUE)])
)

DEVICE = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("operating_system", T.StringType()),
        T.StructField("operating_system_version", T.StringType()),
        T.StructField("mobile_brand_name", T.StringType()),
        T.StructField("mobile_model_name", T.StringType()),
        T.StructField(
            "web_info",
            T.StructType(
                [T.StructField("browser", T.StringType()), T.StructField("browser_version", T.StringType())]
            ),
        ),
    ]
)

GEO = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("country", "city", "region")]
)

USER_TRAFFIC_SOURCE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("source", "medium", "name")]
)

ECOMMERCE = T.StructType(
    [
        T.StructField("total_item_quantity", T.LongType()),
        T.StructField("purchase_revenue", T.DoubleType()),
        T.StructField("refund_value", T.DoubleType()),
        T.StructField("shipping_value", T.DoubleType()),
        T.StructField("tax_value", T.DoubleType()),
        T.StructField("unique_items", T.LongType()),
        T.StructField("transaction_id", T.StringType()),
    ]
)

ITEM = T.StructType(
    [
        T.StructField("item_name", T.StringType()),
        T.StructField("item_variant", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("item_revenue", T.DoubleType()),
    ]
)

# The raw table is stored partitioned by ``event_date`` (string yyyyMMdd, one
# directory per export shard). Declaring the schema keeps the partition column a
# string; inference would turn ``event_date=20240105`` into an integer.
RAW_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_date", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("event_params", EVENT_PARAMS),
        T.StructField("user_id", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("device", DEVICE),
        T.StructField("geo", GEO),
        T.StructField("traffic_source", USER_TRAFFIC_SOURCE),
        T.StructField("ecommerce", ECOMMERCE),
        T.StructField("items", T.ArrayType(ITEM)),
    ]
)

TRAFFIC_STRUCT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("source", "medium", "campaign", "gclid")]
)

SRC_COLUMNS = (
    "date",
    "session_id",
    "user_pseudo_id",
    "session_start",
    "traffic_source",
    "event_timestamp",
    "page_location",
)

STG_COLUMNS = ("session_id", "user_pseudo_id", "date", "session_start", "source", "medium", "campaign")

FLAT_EVENT_COLUMNS = (
    "session_id",
    "event_date",
    "event_timestamp",
    "event_name",
    "ga_session_number",
    "ga_session_id",
    "page_location",
    "page_title",
    "entrances",
    "session_engaged",
    "user_id",
    "user_pseudo_id",
    "device_category",
    "device_language",
    "device_browser",
    "device_browser_version",
    "device_operating_system",
    "device_operating_system_version",
    "device_brand_name",
    "device_mobile_model_name",
    "geo_country",
    "geo_city",
    "geo_region",
    "user_source",
    "user_medium",
    "user_campaign",
    "ecommerce_total_item_quantity",
    "ecommerce_purchase_revenue",
    "ecommerce_refund_value",
    "ecommerce_shipping_value",
    "ecommerce_tax_value",
    "ecommerce_unique_items",
    "ecommerce_transaction_id",
    "previous_timestamp",
    "exit_page",
    "engagement_time_msec",
)

SESSION_SOURCE_COLUMNS = ("session_source", "session_medium", "session_campaign", "session_start")

EVENT_COLUMNS = FLAT_EVENT_COLUMNS + SESSION_SOURCE_COLUMNS

ITEM_COLUMNS = ("date", "item_name", "item_variant", "item_quantity", "item_revenue")

SESSION_DAY_COLUMNS = ("date", "session_id", "user_pseudo_id", "session_start", "ga_session_number", "first_event",
                       "last_touch_event", "n_events", "last_us")

# Types of the derived tables. Readers pass them on, so a table or day without
# rows (and so without files) is empty instead of unreadable.
_BIGINTS = {"session_start", "ga_session_number", "ga_session_id", "entrances", "ecommerce_total_item_quantity",
            "ecommerce_unique_items", "exit_page", "engagement_time_msec", "item_quantity",
            "n_events", "last_us"}
_DOUBLES = {"ecommerce_purchase_revenue", "ecommerce_refund_value", "ecommerce_shipping_value", "ecommerce_tax_value",
            "previous_timestamp", "item_revenue"}


def _touch_event(*extra: T.StructField) -> T.StructType:
    return T.StructType([T.StructField("ts", T.LongType()), *extra, T.StructField("touch", TRAFFIC_STRUCT)])


def _table(columns, **types: T.DataType) -> T.StructType:
    def kind(name: str) -> T.DataType:
        if name in types:
            return types[name]
        if name in ("date", "event_date"):
            return T.DateType()
        return T.LongType() if name in _BIGINTS else T.DoubleType() if name in _DOUBLES else T.StringType()

    return T.StructType([T.StructField(c, kind(c)) for c in columns])


SRC_SCHEMA = _table(SRC_COLUMNS, traffic_source=TRAFFIC_STRUCT, event_timestamp=T.LongType())
STG_SCHEMA = _table(STG_COLUMNS)
EVENT_SCHEMA = _table(EVENT_COLUMNS, event_timestamp=T.TimestampNTZType())
ITEM_SCHEMA = _table(ITEM_COLUMNS)
SESSION_DAY_SCHEMA = _table(SESSION_DAY_COLUMNS, last_touch_event=_touch_event(),
                            first_event=_touch_event(T.StructField("untouched", T.BooleanType())))
