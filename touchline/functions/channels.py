"""Marketing channel grouping of a (source, medium, campaign) triple.

First true rule wins; NULL inputs make a rule's test NULL, which counts as not
true. The patterns are written in the dashboard's regex dialect (RE2:
unanchored search, ``.`` stops only at ``\\n``, ``$`` is end of text); ``re2``
maps them onto Java regex semantics for ``rlike``. The Column and the SQL form are
both rendered from the one list ``RULES``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference): patterns, lists and labels of the
# channel rules.
SHOPPING_SOURCES = "alibaba|amazon|google shopping|shopify|etsy|ebay|stripe|walmart"
SHOPPING_CAMPAIGN = "^(.*(([^a-df-z]|^)shop|shopping).*)$"
PAID_MEDIUM = "^(.*cp.*|ppc|paid.*)$"
SEARCH_SOURCES = "baidu|bing|duckduckgo|ecosia|google|yahoo|yandex"
SOCIAL_SOURCES = "badoo|facebook|fb|instagram|linkedin|pinterest|tiktok|twitter|whatsapp"
VIDEO_SOURCES = "dailymotion|disneyplus|netflix|youtube|vimeo|twitch|vimeo|youtube"
VIDEO_MEDIUM = "^(.*video.*)$"
EMAIL_PATTERN = "email|e-mail|e_mail|e mail"
CROSS_NETWORK_CAMPAIGN = "cross-network"
PUSH_MEDIUM_SUFFIX = "push$"
PUSH_MEDIUM = "mobile|notification"
DIRECT_SOURCE = "(direct)"
DIRECT_MEDIUMS = ("(not set)", "(none)")
DISPLAY_MEDIUMS = ("display", "banner", "expandable", "interstitial", "cpm")
SOCIAL_MEDIUMS = ("social", "social-network", "social-media", "sm", "social network", "social media")
DEFAULT_CHANNEL = "Unassigned"


@dataclass(frozen=True)
class Match:
    """A field matches a pattern (``like``) or is one of some values."""

    field: str
    like: str | None = None
    among: tuple[str, ...] = ()


def _any(*tests: Match) -> tuple[Match, ...]:
    return tests


PAID = _any(Match("medium", PAID_MEDIUM))
SHOPPING = _any(Match("source", SHOPPING_SOURCES), Match("campaign", SHOPPING_CAMPAIGN))
SEARCH = _any(Match("source", SEARCH_SOURCES))
SOCIAL = _any(Match("source", SOCIAL_SOURCES))
VIDEO = _any(Match("source", VIDEO_SOURCES))

# Fixed values (must equal the reference): the rules in order. A rule holds if,
# of each of its groups, any test does; the first rule that holds gives the label.
RULES = (
    ("Direct", (_any(Match("source", among=(DIRECT_SOURCE,))), _any(Match("medium", among=DIRECT_MEDIUMS)))),
    ("Cross-network", (_any(Match("campaign", CROSS_NETWORK_CAMPAIGN)),)),
    ("Paid Shopping", (SHOPPING, PAID)),
    ("Paid Search", (SEARCH, PAID)),
    ("Paid Social", (SOCIAL, PAID)),
    ("Paid Video", (VIDEO, PAID)),
    ("Display", (_any(Match("medium", among=DISPLAY_MEDIUMS)),)),
    ("Organic Shopping", (SHOPPING,)),
    ("Organic Social", (SOCIAL + _any(Match("medium", among=SOCIAL_MEDIUMS)),)),
    ("Organic Video", (VIDEO + _any(Match("medium", VIDEO_MEDIUM)),)),
    ("Organic Search", (SEARCH + _any(Match("medium", among=("organic",))),)),
    ("Email", (_any(Match("source", EMAIL_PATTERN), Match("medium", EMAIL_PATTERN)),)),
    ("Affiliates", (_any(Match("medium", among=("affiliate",))),)),
    ("Referral", (_any(Match("medium", among=("referral",))),)),
    ("Audio", (_any(Match("medium", among=("audio",))),)),
    ("SMS", (_any(Match("medium", among=("sms",))),)),
    ("Mobile Push Notifications", (_any(Match("medium", PUSH_MEDIUM_SUFFIX), Match("medium", PUSH_MEDIUM)),)),
)
CHANNELS = (*(label for label, _ in RULES), DEFAULT_CHANNEL)


def re2(pattern: str) -> str:
    """Java regex with RE2 semantics for these patterns: UNIX_LINES so ``.``
    only stops at ``\\n``, and a final ``$`` as end of input (``\\z``)."""
    if pattern.endswith("$") and not pattern.endswith("\\$"):
        pattern = pattern[:-1] + "\\z"
    return "(?d)" + pattern


def channel_group(source: Column, medium: Column, campaign: Column) -> Column:
    """The rule list as a Column."""
    fields = {"source": source, "medium": medium, "campaign": campaign}

    def holds(test: Match) -> Column:
        field = fields[test.field]
        return field.isin(*test.among) if test.like is None else field.rlike(re2(test.like))

    out = F
    for label, groups in RULES:
        out = out.when(reduce(and_, (reduce(or_, map(holds, group)) for group in groups)), F.lit(label))
    return out.otherwise(F.lit(DEFAULT_CHANNEL))


def channel_group_sql(source: str = "source", medium: str = "medium", campaign: str = "campaign") -> str:
    """The rule list as a Spark SQL CASE."""
    fields = {"source": source, "medium": medium, "campaign": campaign}

    def quoted(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def holds(test: Match) -> str:
        if test.like is None:
            return f"{fields[test.field]} IN ({', '.join(map(quoted, test.among))})"
        return f"{fields[test.field]} RLIKE {quoted(re2(test.like))}"

    arms = (f"WHEN {' AND '.join('(' + ' OR '.join(map(holds, group)) + ')' for group in groups)} THEN {quoted(label)}"
            for label, groups in RULES)
    return f"CASE {' '.join(arms)} ELSE {quoted(DEFAULT_CHANNEL)} END"
