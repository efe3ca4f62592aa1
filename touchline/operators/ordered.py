"""Skew-safe per-group windows over events (W2 lag, W3 group max).

``PARTITION BY key ORDER BY ts`` sends a whole group to one task; a hot
(user, session) group - e.g. every anonymous event - would stall the stage.

``lag_in_pieces`` cuts large groups into pieces of about equal numbers of rows,
at quantiles of the group's own timestamps (``group_cuts``: a mergeable sketch
per large group, over narrow rows). A cut is a timestamp of the group, so it is
at once the last one of its piece, and thus what the first row of the next piece
lags onto: no carried rows and no second pass are needed. A dense minute gets as
many pieces as its rows ask for. Rows that share a timestamp stay together.

``max_in_groups`` splits each group by the value's bucket and carries the max of
the whole group into each as a pseudo-row; ``max_by_join`` is the unbucketed
alternative for the group max: a grouped max joined back NULL-safe, whose hot
keys are left to AQE's skew-join split. Both cost one shuffle of the event rows,
as the direct window does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import materialize

BUCKET = "_bucket"
BUCKET_MAX = "_bucket_max"
PSEUDO = "_pseudo"
PIECE = "_piece"
# A group has at most MOST_PIECES pieces.
MOST_PIECES = 4096
# The cuts of large groups are broadcast up to this many bytes.
BROADCAST_CUTS = 16 << 20


def bucket_of(ts: str, width: int):
    return F.floor(F.col(ts) / F.lit(width))


def bucket_summary(df: DataFrame, keys: list[str], ts: str, width: int) -> DataFrame:
    """max(ts) per (keys, bucket of ts) - pre-combined map-side."""
    return df.groupBy(*keys, bucket_of(ts, width).alias(BUCKET)).agg(F.max(ts).alias(BUCKET_MAX))


def not_null_keys(df: DataFrame, columns: dict[str, Column]) -> tuple[DataFrame, list[str]]:
    """``df`` with columns that are never NULL and equal where these are equal
    or both NULL: names of such keys, for equi-joins and windows that are to
    share one partitioning. ``columns``: strings and longs by key name."""
    nulls = F.lit(0)
    for i, c in enumerate(columns.values()):
        nulls = nulls + F.when(c.isNull(), 1 << i).otherwise(0)
    blank = {"string": "", "bigint": -1}
    named = df.withColumns(columns)
    kinds = dict(named.dtypes)
    return named.withColumns({**{k: F.coalesce(c, F.lit(blank[kinds[k]]).cast(kinds[k])) for k, c in columns.items()},
                              "_nulls": nulls}), [*columns, "_nulls"]


def large_cuts(rows: DataFrame, keys: list[str], ts: str, large: int, piece_rows: int,
               counts: DataFrame | None = None, first: str | None = None) -> DataFrame | None:
    """Cuts of the groups of more than ``large`` rows: ``keys`` (not NULL),
    ``cuts`` and ``n_pieces``, written once, or None if there are none.

    No group is larger than the input, so a small input needs no count by group
    (its rows are counted from file footers). ``counts`` (``keys``, ``n``): the
    groups' sizes, if known. ``first``: the one of ``keys`` that is cheap to
    read; only groups of those of its values with more than ``large`` rows are
    counted."""
    if rows.count() <= large:
        return None
    if counts is None:
        counted = rows
        if first is not None:
            many = rows.groupBy(first).count().where(F.col("count") > large).select(first)
            many = materialize(many)
            if (n := many.count()) == 0:
                return None
            counted = rows.join(_checked(many, 100 * n), first, "left_semi")
        counts = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    found = materialize(counts.where(F.col("n") > large))
    groups, most = found.agg(F.count("*"), F.max("n")).first()
    if groups == 0:
        return None
    cuts = materialize(group_cuts(rows, keys, ts, _checked(found, 100 * groups), most, piece_rows))
    return _checked(cuts, cuts.agg(F.sum(F.lit(100) + 8 * F.col("n_pieces"))).first()[0])


def _checked(df: DataFrame, size: int) -> DataFrame:
    """``df``, to be broadcast if its ``size`` in bytes allows."""
    return F.broadcast(df) if size <= BROADCAST_CUTS else df


def group_cuts(rows: DataFrame, keys: list[str], ts: str, large: DataFrame, most: int, piece_rows: int) -> DataFrame:
    """``keys``, ``cuts`` and ``n_pieces`` of the groups listed in ``large``
    (``keys``, ``n``: its rows; ``most``: the largest of them): ascending
    values of ``ts`` that divide the group into pieces of about ``piece_rows``
    rows. A piece ends with its cut, and the last one has none."""
    pieces = max(2, min(MOST_PIECES, -(-most // piece_rows)))
    grid = [i / pieces for i in range(1, pieces)]
    own = F.least(F.lit(pieces), F.ceil(F.col("n") / F.lit(piece_rows)))
    step = F.greatest(F.lit(1), F.floor(F.lit(pieces) / own))  # a smaller group takes every step-th cut
    found = rows.select(*keys, ts).join(large, keys).groupBy(*keys).agg(
        F.percentile_approx(ts, grid, 20 * max(pieces, 500)).alias("cuts"), F.first("n").alias("n"))
    some = F.filter(F.coalesce("cuts", F.array().cast("array<long>")), lambda c, i: (i + 1) % step == 0)
    return found.select(*keys, F.array_distinct(some).alias("cuts")).withColumn("n_pieces", F.size("cuts") + 1)


def piece_of(ts: Column, cuts: Column) -> Column:
    """How many of the ascending ``cuts`` are below ``ts`` (0: NULL, or no cuts):
    a binary search, as a large input's groups have thousands of cuts."""
    halves = F.array(*[F.lit(1 << i) for i in reversed(range((MOST_PIECES - 1).bit_length()))])
    step = lambda below, half: below + F.when(F.get(cuts, below + half - 1) < ts, half).otherwise(0)
    return F.when(cuts.isNull(), 0).otherwise(F.aggregate(halves, F.lit(0), step))


def lag_in_pieces(df: DataFrame, keys: list[str], ts: str, out: str, tiebreak: tuple[str, ...] = (),
                  cuts: DataFrame | None = None) -> DataFrame:
    """``df`` with ``out`` = LAG(ts) OVER (PARTITION BY keys ORDER BY ts,
    *tiebreak), NULL on the group's first row, and the row's piece, ``PIECE``.
    NULL ts rows sort first; ``keys`` are not NULL (see ``not_null_keys``).
    ``cuts``: from ``group_cuts`` of the same rows; the groups there are split,
    which doesn't change the result. Rows end up dealt by keys and piece."""
    order = [F.col(ts).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in tiebreak]]
    if cuts is None:
        return df.withColumn(PIECE, F.lit(0)).withColumn(out, F.lag(ts).over(Window.partitionBy(*keys).orderBy(*order)))
    rows = df.join(cuts.select(*keys, "cuts"), keys, "left")
    rows = rows.withColumn(PIECE, piece_of(F.col(ts), F.col("cuts")))
    rows = rows.withColumn("_before", F.get("cuts", F.col(PIECE) - 1)).drop("cuts")
    lag = F.lag(ts).over(Window.partitionBy(*keys, PIECE).orderBy(*order))
    return rows.withColumn(out, F.coalesce(lag, "_before")).drop("_before")


def join_keys(df: DataFrame, side: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on ``keys``, NULL-safe, keeping the keys of ``df``."""
    renamed = [f"_key{i}" for i in range(len(keys))]
    side = side.withColumnsRenamed(dict(zip(keys, renamed)))
    same = [F.col(k).eqNullSafe(F.col(r)) for k, r in zip(keys, renamed)]
    return df.join(side, same, how).drop(*renamed)


def max_in_groups(df: DataFrame, keys: list[str], value: str, out: str, width: int) -> DataFrame:
    """``out`` = MAX(value) OVER (PARTITION BY keys); rows are bucketed by
    ``value`` itself, the pseudo-row of each (keys, bucket) carries the max of
    the whole group (a window over the group's bucket summaries)."""
    summary = bucket_summary(df, keys, value, width)
    carry = (
        summary.select(*keys, BUCKET, F.max(BUCKET_MAX).over(Window.partitionBy(*keys)).alias(value))
        .where(F.col(value).isNotNull())
        .withColumn(PSEUDO, F.lit(True))
    )
    rows = df.withColumn(BUCKET, bucket_of(value, width)).withColumn(PSEUDO, F.lit(False))
    return (
        rows.unionByName(carry, allowMissingColumns=True)
        .withColumn(out, F.max(value).over(Window.partitionBy(*keys, BUCKET)))
        .where(~F.col(PSEUDO))
        .drop(BUCKET, PSEUDO)
    )


def max_by_join(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """``out`` = MAX(value) OVER (PARTITION BY keys), as a grouped aggregate
    (pre-combined map-side) joined back on the keys, NULL-safe. No ordering is
    needed, so nothing is bucketed: a hot group costs one partial row per map
    task in the aggregate, and in the join AQE's skew handling splits the
    event side of a hot key while the aggregate side has one row per key."""
    return join_keys(df, df.groupBy(*keys).agg(F.max(value).alias(out)), keys)
