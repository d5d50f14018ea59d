"""Shape of a curve sampled on a threshold grid: slopes, half-maximum, local minimum, snapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def slopes(df: DataFrame, x: str, y: str, within: Sequence[str] = ()) -> DataFrame:
    """(within, low, high, mid, slope) between neighbours of the grid (a few rows a curve)."""
    w = Window.partitionBy(*within).orderBy(x)
    pairs = df.select(*within, F.col(x).alias("low"), F.lead(x).over(w).alias("high"), F.col(y).alias("y0"), F.lead(y).over(w).alias("y1")).where("high is not null")
    return pairs.select(*within, "low", "high", ((F.col("low") + F.col("high")) / 2).alias("mid"), ((F.col("y1") - F.col("y0")) / (F.col("high") - F.col("low"))).alias("slope"))


def half_maximum(curve: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The highest midpoint whose slope is half the peak or more; the last midpoint if there is none."""
    w = Window.partitionBy(*within)
    marked = curve.withColumn("peak", F.max("slope").over(w))
    hit = F.max(F.when(F.col("slope") >= 0.5 * F.col("peak"), F.col("mid")))
    return marked.groupBy(*within).agg(F.coalesce(hit, F.max("mid")).alias("upper"))


def local_minimum(curve: DataFrame, within: Sequence[str] = (), climb: Column | None = None) -> DataFrame:
    """The first interior midpoint, from the loose end, whose climb rate is strictly below both neighbours."""
    rate = -F.col("slope") if climb is None else climb
    w = Window.partitionBy(*within).orderBy("mid")
    rated = curve.withColumn("rate", rate).withColumn("before", F.lag("rate").over(w)).withColumn("after", F.lead("rate").over(w))
    hit = F.min(F.when((F.col("rate") < F.col("before")) & (F.col("rate") < F.col("after")), F.col("mid")))
    return rated.groupBy(*within).agg(F.coalesce(hit, F.min("mid")).alias("lower"))


def snap(value: Column, grid: Sequence[float]) -> Column:
    """Nearest grid value in double arithmetic; of two as near, the higher one."""
    points = F.array(*[F.lit(float(g)) for g in sorted(grid)])
    best = F.aggregate(points, F.struct(F.lit(None).cast("double").alias("g"), F.lit(float("inf")).alias("d")), lambda a, g: F.when(F.abs(g - value) <= a["d"], F.struct(g.alias("g"), F.abs(g - value).alias("d"))).otherwise(a))
    return best["g"]


def intersection(df: DataFrame, grid: Sequence[float]) -> DataFrame:
    """Common range of all curves: highest lower, lowest upper, snapped; swapped if inverted."""
    ends = df.agg(F.max("lower").alias("lo"), F.min("upper").alias("hi"))
    snapped = ends.select("lo", "hi", snap(F.col("lo"), grid).alias("a"), snap(F.col("hi"), grid).alias("b"))
    return snapped.select("lo", "hi", F.least("a", "b").alias("lower"), F.greatest("a", "b").alias("upper"))
