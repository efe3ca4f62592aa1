"""Builders of crafted raw-export rows for unit tests."""

from pyspark.sql import functions as F

from touchline.schema import RAW_EVENT_SCHEMA


def param(key, s=None, i=None, f=None, d=None):
    return {"key": key, "value": {"string_value": s, "int_value": i, "float_value": f, "double_value": d}}


def raw_row(ts, name="page_view", user="u1", gsid=None, gsn=None, params=None, day="20240115",
            items=None, language=None):
    ps = list(params or [])
    if gsid is not None:
        ps.insert(0, param("ga_session_id", i=gsid))
    if gsn is not None:
        ps.insert(1, param("ga_session_number", i=gsn))
    return {
        "event_date": day,
        "event_timestamp": ts,
        "event_name": name,
        "event_params": ps,
        "user_id": None,
        "user_pseudo_id": user,
        "device": {"category": "desktop", "language": language, "operating_system": None,
                   "operating_system_version": None, "mobile_brand_name": None, "mobile_model_name": None,
                   "web_info": {"browser": "b", "browser_version": "1"}},
        "geo": {"country": "c", "city": None, "region": None},
        "traffic_source": {"source": None, "medium": None, "name": None},
        "ecommerce": None,
        "items": items if items is not None else [],
    }


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW_EVENT_SCHEMA)


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


__all__ = ["F", "param", "raw_df", "raw_row", "rows_of"]
