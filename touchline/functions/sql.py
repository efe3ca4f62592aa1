"""SQL surface: register the classifiers and param lookups as session SQL
functions, so dashboards and ad-hoc SQL can call them by name. All bodies are
SQL expressions (Catalyst inlines them; no Python per row)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from touchline.functions.channels import channel_group_sql
from touchline.functions.languages import LANGUAGE_NAMES
from touchline.functions.params import register_param_functions


def _quote(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def language_name_sql(code: str = "language_code") -> str:
    pairs = ", ".join(f"{_quote(k)}, {_quote(v)}" for k, v in LANGUAGE_NAMES)
    return f"coalesce(try_element_at(map({pairs}), {code}), {code})"


def register_sql_functions(spark: SparkSession) -> list[str]:
    """extract_string_value / extract_int_value / extract_float_value,
    channel_group(source, medium, campaign), language_name(language_code)."""
    names = register_param_functions(spark)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION channel_group(source STRING, medium STRING, campaign STRING) "
        f"RETURNS STRING RETURN {channel_group_sql()}"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION language_name(language_code STRING) "
        f"RETURNS STRING RETURN {language_name_sql()}"
    )
    return names + ["channel_group", "language_name"]
