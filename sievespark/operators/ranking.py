"""Winners, ranks, cuts and base-id dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievespark.operators.names import unused
from sievespark.operators.quantiles import at_positions
from sievespark.session import cut_lineage


def best_pose(poses: DataFrame, key: Sequence[str], score: str, distance: str, tie: Sequence[str], payload: Sequence[str] = ()) -> DataFrame:
    """One winner a key: the lowest score; without any score the smallest distance. Ties go to the least ``tie``.

    A single aggregation with map-side combine; no sort, no window.
    """
    wanted = F.struct(*[F.col(c) for c in dict.fromkeys((*tie, distance, score, *payload))])
    order = F.struct(F.col(score).isNull(), F.coalesce(score, distance), *[F.col(c) for c in tie])
    (won,) = unused(poses.columns, "won")
    return poses.groupBy(*key).agg(F.min_by(wanted, order).alias(won)).select(*key, f"{won}.*")


def _dealt(df: DataFrame, keys: Sequence[Column]) -> tuple[DataFrame, str, str]:
    """``df`` in ranges of the whole order, each sorted in one task, with the names of two more columns: range, and place in it. Written.

    A group or a tied score of any size is cut at the next column of the order.
    """
    slot, at = unused(df.columns, "slot", "at")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return cut_lineage(rows.withColumns({slot: F.spark_partition_id(), at: F.monotonically_increasing_id()})), slot, at


def ranked(df: DataFrame, order: Sequence[str], within: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Dense positions from 1 over ``order`` within each ``within``; nulls come last.

    The rows are dealt into ranges of (``within``, ``order``), numbered inside each range and shifted
    by the rows of their group in the ranges before. They are written on the way, so ranks and values
    are of one computation; the input is read once more to find the ranges.
    """
    rows, slot, at = _dealt(df, [F.col(c).asc_nulls_last() for c in (*within, *order)])
    n, first, shift = unused(rows.columns, "n", "first", "shift")
    sizes = rows.groupBy(*within, slot).agg(F.count(F.lit(1)).alias(n), F.min(at).alias(first))
    before = F.sum(n).over(Window.partitionBy(*within).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1))
    moved = sizes.select(*within, slot, (F.coalesce(before, F.lit(0)) - F.col(first) + 1).alias(shift))  # a row a group and range
    joined = _null_safe(rows, moved, [*within, slot])
    return joined.select(*df.columns, (F.col(at) + F.col(shift)).cast("long").alias(name))


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join; nulls of ``keys`` equal each other."""
    names = unused([*left.columns, *right.columns], *[f"right_{i}" for i in range(len(keys))])
    other = right.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for k, n in zip(keys, names):
        cond &= left[k].eqNullSafe(F.col(n))
    return left.join(other if keys else F.broadcast(other), cond).drop(*names)  # without keys: one row


def best_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order`` (the first wins a tie); a group limit runs before the shuffle."""
    (place,) = unused(df.columns, "place")
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn(place, F.row_number().over(w)).where(F.col(place) == 1).drop(place)


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def cut_prefix(df: DataFrame, score: str, cutoff: float) -> DataFrame:
    """Rows at or below the cutoff; as a filter it reaches the scan, and sorted files are skipped by statistics."""
    return df.where(F.col(score) <= cutoff)


def inversions(df: DataFrame, order: str, value: str, within: Sequence[str]) -> DataFrame:
    """Rows a group whose value falls below the one before; none means sorted.

    Counted inside ranges of (``within``, ``order``), and once more over the ranges' borders.
    """
    rows, slot, at = _dealt(df.select(*within, order, value), [F.col(c).asc_nulls_last() for c in (*within, order)])
    bad, n, first, last, border = unused(rows.columns, "bad", "n", "first", "last", "border")
    falls = F.lag(value).over(Window.partitionBy(*within, slot).orderBy(at)) > F.col(value)
    ends = [f(F.col(value), F.col(at)).alias(x) for f, x in ((F.min_by, first), (F.max_by, last))]
    per = rows.withColumn(bad, falls).groupBy(*within, slot).agg(F.count_if(bad).alias(n), *ends)
    crossed = F.lag(last).over(Window.partitionBy(*within).orderBy(slot)) > F.col(first)
    return per.withColumn(border, crossed.cast("int")).groupBy(*within).agg((F.sum(n) + F.coalesce(F.sum(border), F.lit(0))).cast("long").alias("inversions"))


def require_sorted(df: DataFrame, order: str, value: str, within: Sequence[str] = ()) -> DataFrame:
    """``df``; an error if a value falls below the one before it."""
    if not inversions(df, order, value, within).where("inversions > 0").isEmpty():
        raise ValueError(f"{value} is not sorted by {order}")
    return df


def require_some(df: DataFrame, what: str) -> DataFrame:
    """``df``; an error if it has no rows."""
    if df.isEmpty():
        raise ValueError(f"no row is left: {what}")
    return df


def last_wins(df: DataFrame, key: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """A lookup table with one row a key: the last in ``seq``."""
    rest = [c for c in df.columns if c not in key]
    (row,) = unused(df.columns, "row")
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*seq)).alias(row)).select(*key, f"{row}.*")


def share_cut(df: DataFrame, share: float, order: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """The first ``ceil(share * n)`` rows of each group in ``order``; nulls come last.

    Where the first of ``order`` is a number, its value at the cut is found by selection (see
    :func:`at_positions`): rows below it stay, and only rows that tie with it are ranked. Reading
    ``df`` again must give the same rows, since it is read once a pass.
    """
    first = order[0]
    if not isinstance(df.schema[first].dataType, T.NumericType):
        rank, most = unused(df.columns, "rank", "most")
        sizes = df.groupBy(*within).agg(F.ceil(F.count(F.lit(1)) * share).alias(most))
        return _null_safe(ranked(df, order, within, rank), sizes, list(within)).where(F.col(rank) <= F.col(most)).select(*df.columns)
    found = at_positions(df, [first], [lambda n: F.ceil(n * share) - 1], within, nulls_last=True)
    at, edge, below, rank = unused(df.columns, "at", "edge", "below", "rank")
    cut = found.select(*within, F.col("at").alias(at), F.col("value").alias(edge), F.col("below").alias(below))
    value = F.col(first).cast("double")
    placed = F.when(F.isnan(value), F.lit(None)).otherwise(value)  # NaN and null come after all numbers
    both = _null_safe(df, cut, list(within))
    lower = both.where(placed.isNotNull() & (F.col(edge).isNull() | (placed < F.col(edge)))).where(F.col(at) >= 0)
    ties = both.where(placed.eqNullSafe(F.col(edge))).where(F.col(at) >= 0)
    kept = ranked(ties, order, within, rank).where(F.col(rank) <= F.col(at) - F.col(below) + 1)
    return lower.select(*df.columns).unionByName(kept.select(*df.columns))
