"""touchline: GA4-style web-event attribution and reporting on Spark.

Everything is expressed with DataFrame / SQL built-ins so Catalyst plans it:
param lookups, session traffic-source attribution (first touch, else the last
touch of the same user within a lookback window), event flattening with
per-session windows, a left join to the session source, item explode, channel
and language classifiers, and an init / daily-update pair over day-partitioned
tables.
"""

from touchline.functions.params import (
    float_param,
    int_param,
    param_value,
    register_param_functions,
    string_param,
)
from touchline.functions.clickids import traffic_touch
from touchline.functions.channels import channel_group
from touchline.functions.languages import language_name
from touchline.functions.sql import register_sql_functions
from touchline.operators.traffic import (
    event_traffic,
    lookback_fill,
    session_rollup,
    session_traffic,
)
from touchline.operators.events import (
    build_events,
    exit_flag,
    flatten_events,
    seconds_since_previous,
    sessionize,
)
from touchline.operators.items import purchase_items
from touchline.plans.reporting import TablePaths, init, update, update_day

__all__ = [
    "TablePaths",
    "build_events",
    "channel_group",
    "event_traffic",
    "exit_flag",
    "flatten_events",
    "float_param",
    "init",
    "int_param",
    "language_name",
    "lookback_fill",
    "param_value",
    "purchase_items",
    "register_param_functions",
    "register_sql_functions",
    "seconds_since_previous",
    "session_rollup",
    "session_traffic",
    "sessionize",
    "string_param",
    "traffic_touch",
    "update",
    "update_day",
]
