"""Typed lookups in the repeated ``event_params`` key/value column.

A lookup is a scalar subquery over the array in the source dialect: no match
gives NULL, a NULL or empty array gives NULL, and the first match wins. It is
built from codegen'd array built-ins - the position of the key in
``event_params.key`` selects the element of ``event_params.value.<field>`` - so
no lambda runs per key and no join or shuffle is involved. ``strict=True``
raises when a key occurs more than once, as the source dialect does;
``one_value_per_key`` is the same check for all lookups of a row together.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VALUE_FIELDS = ("string_value", "int_value", "float_value", "double_value")


def _as_col(params) -> Column:
    return F.col(params) if isinstance(params, str) else params


def param_position(key: str, params="event_params") -> Column:
    """1-based position of the first element whose key equals ``key``; 0 when
    absent, NULL when the array is NULL."""
    return F.array_position(_as_col(params).getField("key"), F.lit(key))


def param_value(key: str, field: str, params="event_params", strict: bool = False) -> Column:
    if field not in VALUE_FIELDS:
        raise ValueError(f"unknown param value field {field!r}")
    arr = _as_col(params)
    position = param_position(key, arr)
    value = F.get(arr.getField("value").getField(field), (position - 1).cast("int"))
    if strict:
        # a second match exists iff the key occurs again after its first position
        keys = arr.getField("key")
        rest = F.slice(keys, (position + 1).cast("int"), F.greatest(F.size(keys), F.lit(1)))
        repeated = F.array_position(rest, F.lit(key)) > 0
        value = F.when(
            repeated, F.raise_error(F.lit(f"event param {key!r} occurs more than once"))
        ).otherwise(value)
    return value


def string_param(key: str, params="event_params", strict: bool = False) -> Column:
    return param_value(key, "string_value", params, strict)


def int_param(key: str, params="event_params", strict: bool = False) -> Column:
    return param_value(key, "int_value", params, strict)


def float_param(key: str, params="event_params", strict: bool = False) -> Column:
    """float_value of the matched element, else its double_value."""
    return F.coalesce(
        param_value(key, "float_value", params, strict), param_value(key, "double_value", params, strict)
    )


def string_or_int_param(key: str, params="event_params", strict: bool = False) -> Column:
    """string_value, else int_value rendered as a string (e.g. session_engaged)."""
    return F.coalesce(string_param(key, params, strict), int_param(key, params, strict).cast("string"))


def one_value_per_key(df: DataFrame, keys: Iterable[str], params: str = "event_params") -> DataFrame:
    """``df``, failing on a row whose ``params`` hold one of ``keys`` twice: the
    check of ``strict`` for many lookups at once, in one pass per row. It hangs
    on the column itself, so that it runs whichever lookups are read later."""
    named = F.filter(F.col(params).getField("key"), lambda k: k.isin(*keys))
    repeated = F.size(F.array_distinct(named)) < F.size(named)
    message = F.concat(F.lit("event param occurs more than once, of "), F.array_join(named, ", "))
    return df.withColumn(params, F.when(repeated, F.raise_error(message)).otherwise(F.col(params)))


_PARAMS_SQL_TYPE = (
    "ARRAY<STRUCT<key: STRING, value: STRUCT<string_value: STRING, int_value: BIGINT, "
    "float_value: DOUBLE, double_value: DOUBLE>>>"
)

_SQL_FUNCTIONS = {
    "extract_string_value": ("STRING", "get(event_params.value.string_value, {idx})"),
    "extract_int_value": ("BIGINT", "get(event_params.value.int_value, {idx})"),
    "extract_float_value": (
        "DOUBLE",
        "coalesce(get(event_params.value.float_value, {idx}), get(event_params.value.double_value, {idx}))",
    ),
}


def register_param_functions(spark: SparkSession) -> list[str]:
    """Register the three lookups as SQL functions (temporary, session-scoped).

    They are SQL-bodied functions, so Catalyst inlines them into the plan: no
    Python runs per row."""
    idx = "CAST(array_position(event_params.key, param_key) AS INT) - 1"
    names = []
    for name, (ret, body) in _SQL_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(event_params {_PARAMS_SQL_TYPE}, param_key STRING) "
            f"RETURNS {ret} RETURN {body.format(idx=idx)}"
        )
        names.append(name)
    return names
