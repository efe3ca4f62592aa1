"""Traffic touch of one event with the ad click-id override.

The touch is the struct (source, medium, campaign, gclid) of the event's
traffic params, or NULL when all four are NULL. The NULL test runs on the raw
params, outside the override: a URL with a click id but no traffic param stays
NULL. Inside, ordered rules replace source and medium; campaign and gclid are
never replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference): click-id rules in evaluation order as
# (page_location LIKE pattern, source, medium). The first rule also fires when
# the gclid param is present.
CLICK_ID_RULES = (
    ("http%gclid=%", "google", "cpc"),
    ("http%fbclid=%", "facebook", "paid social"),
    ("http%ttclid=%", "tiktok", "paid social"),
    ("http%msclkid=%", "bing", "cpc"),
)


def _like(text: Column, pattern: str) -> Column:
    """``text LIKE pattern``, whose regular expression runs only on texts that
    hold the pattern's longest part without a wildcard."""
    part = "" if "\\" in pattern else max(re.split("[%_]", pattern), key=len)
    return text.contains(part) & text.like(pattern) if part else text.like(pattern)


def _override(fallback: Column, conditions: list[Column], field: int, rules) -> Column:
    out = None
    for cond, rule in zip(conditions, rules):
        out = F.when(cond, F.lit(rule[field])) if out is None else out.when(cond, F.lit(rule[field]))
    return fallback if out is None else out.otherwise(fallback)


def traffic_touch(source: Column, medium: Column, campaign: Column, gclid: Column,
                  page_location: Column, rules=CLICK_ID_RULES) -> Column:
    """``rules``: own (page_location pattern, source, medium) rules, in order."""
    conditions = [_like(page_location, pattern) for pattern, _, _ in rules]
    if conditions:
        conditions[0] = gclid.isNotNull() | conditions[0]
    touched = F.coalesce(source, medium, campaign, gclid).isNotNull()
    # No otherwise(): a missing touch must be a NULL struct, not a struct of NULLs.
    return F.when(
        touched,
        F.struct(
            _override(source, conditions, 1, rules).alias("source"),
            _override(medium, conditions, 2, rules).alias("medium"),
            campaign.alias("campaign"),
            gclid.alias("gclid"),
        ),
    )
