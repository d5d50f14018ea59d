"""Exact order statistics and quantiles by distributed selection.

A sketch gives each group a grid of approximate quantiles; for each position asked for, the two
grid values around it are a bracket. A pass counts the rows below and inside the bracket exactly and
sketches its inside again, until it is small. Only the distinct values inside the last bracket are
put in order. A sketch that misses costs a pass, never a wrong value: brackets count before they hold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievespark.session import cut_lineage, drop

#: Grid steps of a sketch, and its accuracy.
GRID, ACCURACY = 500, 10_000
#: Rows of a bracket that are put in order.
BRACKET = 1_000_000


def _same(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])


def _grid(v: Column) -> Column:
    return F.percentile_approx(v, [i / GRID for i in range(GRID + 1)], ACCURACY)


def _around(grid: Column, place: Column) -> tuple[Column, Column]:
    """The grid's values two steps before and after ``place`` (0 to 1); null beyond its ends."""
    low, high = (F.floor(place * GRID) - 2).cast("int"), (F.ceil(place * GRID) + 2).cast("int")
    at = lambda i: F.when((i > 0) & (i < GRID), F.try_element_at(grid, i + 1))
    return at(low), at(high)


def at_positions(df: DataFrame, values: Sequence[str], positions: Sequence[Callable[[Column], Column]], within: Sequence[str] = (), nulls_last: bool = False, bracket: int = BRACKET) -> DataFrame:
    """``within``, of (number of the column), target (number of the position), at, n, value, below.

    ``positions`` make a place from 0 out of n, the group's rows. value is the one at that place in
    ascending order, as double; below counts the smaller ones. Nulls and NaN are left out of n; with
    ``nulls_last`` n counts them, and a place among them has a null value. Places outside have none
    either. ``df`` is read once a pass, three or four times, and must give the same rows each time.
    """
    keys = [*[f"g{i}" for i in range(len(within))], "of"]
    listed = F.posexplode(F.array(*[F.col(c).cast("double") for c in values])).alias("of", "v")
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(within, keys)], listed)
    real = F.col("v").isNotNull() & ~F.isnan("v")
    start = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("every"), F.count_if(real).alias("inside"), _grid(F.when(real, F.col("v"))).alias("grid"))
    n = F.col("every") if nulls_last else F.col("inside")
    asked = F.posexplode(F.array(*[p(n).cast("long") for p in positions])).alias("target", "at")
    full = [F.lit(0).cast("long").alias("before"), *[F.lit(None).cast("double").alias(c) for c in ("lo", "hi")], F.col("inside").alias("known")]
    state = start.select(*keys, n.alias("n"), "inside", "grid", *full, asked)
    state = cut_lineage(state.withColumn("done", (F.col("at") < 0) | (F.col("at") >= F.col("known")) | (F.col("inside") <= bracket)))
    numbers = rows.where(real)
    inside = lambda a, b: (F.col(a).isNull() | (F.col("v") >= F.col(a))) & (F.col(b).isNull() | (F.col("v") <= F.col(b)))
    while not state.where(~F.col("done")).isEmpty():
        low, high = _around(F.col("grid"), (F.col("at") - F.col("before") + 0.5) / F.col("inside"))
        going = state.where(~F.col("done")).withColumns({"lo2": F.coalesce(low, "lo"), "hi2": F.coalesce(high, "hi")})
        met = numbers.alias("r").join(going.alias("s"), _same(keys) & inside("s.lo", "s.hi")).select(*[F.col(f"s.{c}").alias(c) for c in (*keys, "target", "lo2", "hi2")], "v")
        here = inside("lo2", "hi2")
        seen = met.groupBy(*keys, "target", "lo2", "hi2").agg(F.count_if(F.col("v") < F.col("lo2")).alias("less"), F.count_if(here).alias("inside2"), _grid(F.when(here, F.col("v"))).alias("grid2"))
        both = state.alias("s").join(seen.alias("r"), _same([*keys, "target"]), "left").select("s.*", "r.lo2", "r.hi2", "r.less", "r.inside2", "r.grid2")
        first = F.col("before") + F.col("less")
        holds = F.coalesce((F.col("at") >= first) & (F.col("at") < first + F.col("inside2")), F.lit(False))
        # A bracket that does not get much smaller holds few values, or the sketch missed: what it holds is put in order.
        done = F.col("done") | ~holds | (F.col("inside2") <= bracket) | (F.col("inside2") * 2 > F.col("inside")) | F.coalesce(F.col("lo2") == F.col("hi2"), F.lit(False))
        new = {c: F.when(holds, v).otherwise(F.col(c)) for c, v in (("lo", F.col("lo2")), ("hi", F.col("hi2")), ("before", first), ("inside", F.col("inside2")), ("grid", F.col("grid2")))}
        old, state = state, cut_lineage(both.select(*keys, "n", "known", "target", "at", done.alias("done"), *[v.alias(c) for c, v in new.items()]))
        drop(old)
    asked = state.where((F.col("at") >= 0) & (F.col("at") < F.col("known")))
    met = numbers.alias("r").join(asked.alias("s"), _same(keys) & inside("s.lo", "s.hi")).groupBy(*[F.col(f"s.{c}").alias(c) for c in (*keys, "target", "at", "before")], F.col("r.v").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*keys, "target").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    places = met.withColumn("upto", F.col("before") + upto).where((F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("c")))
    hit = places.select(*keys, "target", F.col("v").alias("value"), (F.col("upto") - F.col("c")).alias("below"))
    out = state.alias("s").join(hit.alias("r"), _same([*keys, "target"]), "left").select(*[F.col(f"s.{k}").alias(c) for k, c in zip(keys, within)], "s.of", "s.target", "s.at", "s.n", "r.value", F.coalesce("r.below", "s.known").alias("below"))
    return cut_lineage(out)


def quantiles(df: DataFrame, values: Sequence[str], shares: Sequence[float], within: Sequence[str] = (), bracket: int = BRACKET) -> DataFrame:
    """``within``, of (the column's name), share, value: exact quantiles, interpolated as percentile() does.

    Nulls and NaN are left out; a column of none has no value. See :func:`at_positions`.
    """
    ends = [f for q in shares for f in (lambda n, q=q: F.floor((n - 1) * q), lambda n, q=q: F.ceil((n - 1) * q))]
    found = at_positions(df, values, ends, within, bracket=bracket)
    per = found.withColumn("number", F.floor(F.col("target") / 2)).groupBy(*within, "of", "number", "n").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    q = F.element_at(F.array(*[F.lit(float(x)) for x in shares]), (F.col("number") + 1).cast("int"))
    rest = (F.col("n") - 1) * q - F.floor((F.col("n") - 1) * q)
    name = F.element_at(F.array(*[F.lit(c) for c in values]), F.col("of") + 1)
    return per.select(*within, name.alias("of"), q.alias("share"), F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("lo") + rest * (F.col("hi") - F.col("lo"))).alias("value"))
