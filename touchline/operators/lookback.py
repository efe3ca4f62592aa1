"""Skew-safe "latest non-NULL value within a lookback" per user.

The direct form is ``last(v, ignorenulls) OVER (PARTITION BY user ORDER BY
start RANGE BETWEEN L PRECEDING AND CURRENT ROW)``: one task receives every
session of a user, and an anonymous (NULL) user can own a third of all
sessions. Here the rows are dealt once by (user, piece), and what follows finds
them in place. Only the users listed as large have more than one piece; theirs
end at quantiles of their own starts (``ordered.group_cuts``), so that a piece has
about equally many rows wherever the user's traffic is dense.

1. A running max of the candidate struct(start, value) gives the latest one up to
   each start and its peers, inside the piece.
2. ``carried_touches``: the latest candidate of a large user's earlier pieces, one
   narrow row per piece, from an aggregate over the large users' rows alone
   (pre-combined map-side) and a window over their pieces. It counts where the own
   piece has no candidate yet. Without large users this step is left out, and the
   plan is the direct one.
3. The candidate counts only when it started within the lookback (RANGE frame
   semantics, inclusive); a NULL start sees only its NULL peers.

Ties among sessions sharing the latest start are broken by the larger value,
which is one of the orders the source leaves open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.ordered import PIECE, not_null_keys, piece_of

# Where a row is dealt: the user, in keys that are not NULL, and the piece.
USER = ["_user", "_nulls"]
DEALT = [*USER, PIECE]


def with_piece(df: DataFrame, user: str, start: str, cuts: DataFrame | None) -> DataFrame:
    """``df`` with the columns ``DEALT``. ``cuts``: (USER, cuts) of the large
    users, or None."""
    df = not_null_keys(df, {USER[0]: F.col(user)})[0]
    if cuts is None:
        return df.withColumn(PIECE, F.lit(0))
    joined = df.join(cuts.select(*USER, "cuts"), USER, "left")
    return joined.withColumn(PIECE, piece_of(F.col(start), F.col("cuts"))).drop("cuts")


def carried_touches(df: DataFrame, user: str, start: str, value: Column, cuts: DataFrame) -> DataFrame:
    """(USER, PIECE, ``_carry``): the latest struct(start, v) of the earlier
    pieces. ``value`` may be an order struct of several rows per start, of which
    the greatest counts."""
    large = with_piece(df.select(F.col(user), F.col(start), value.alias("v")), user, start, cuts)
    # NULL starts never carry; users that are not large have no later piece
    latest = (large.where(F.col("v").isNotNull() & F.col(start).isNotNull()).join(cuts.select(*USER), USER, "left_semi")
              .groupBy(*DEALT).agg(F.max(F.struct(F.col(start).alias("start"), "v")).alias("latest")))
    pieces = cuts.select(*USER, F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)).alias(PIECE))
    earlier = Window.partitionBy(*USER).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carry = pieces.join(latest, DEALT, "left").select(*DEALT, F.max("latest").over(earlier).alias("_carry"))
    return carry.where(F.col("_carry").isNotNull())


def latest_touch_within(rows: DataFrame, start: str, value: str, lookback: int, out: str,
                        carry: DataFrame | None = None) -> DataFrame:
    """``rows`` (with ``DEALT``, and partitioned by them if the window is to
    find them in place) with ``out``: the latest non-NULL ``value`` among rows
    of the same user whose start lies in [start - lookback, start]."""
    running = (Window.partitionBy(*(DEALT if carry is not None else USER)).orderBy(F.col(start).asc_nulls_first())
               .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    candidate = F.when(F.col(value).isNotNull(), F.struct(F.col(start).alias("start"), F.col(value).alias("v")))
    best = rows.withColumn("_best", F.max(candidate).over(running))
    if carry is not None:
        best = best.join(carry, DEALT, "left").withColumn("_best", F.coalesce("_best", "_carry")).drop("_carry")
    found = F.col("_best")
    within = F.col(start).isNull() | (found.getField("start") >= F.col(start) - F.lit(lookback))
    return best.withColumn(out, F.when(within, found.getField("v"))).drop("_best")
