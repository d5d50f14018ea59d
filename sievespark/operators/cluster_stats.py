"""z-scores over a pool, and statistics of clusters against it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievespark.functions.scalar import GOOD_T, normal_cdf, rounded
from sievespark.operators.names import unused


def pool_zscore(df: DataFrame, value: str, within: Sequence[str] = (), name: str = "z") -> DataFrame:
    """(x - mean) / population deviation of the row's pool.

    Pools are conformations, a handful: a row each is broadcast, since dealing rows by pool would give
    each task a whole one, and all that is grouped within pools after it.
    """
    mean, std = unused(df.columns, "mean", "std")
    pools = df.groupBy(*within).agg(F.avg(value).alias(mean), F.stddev_pop(value).alias(std))
    both = df.join(F.broadcast(pools), list(within)) if within else df.crossJoin(F.broadcast(pools))
    return both.withColumn(name, (F.col(value) - F.col(mean)) / F.col(std)).drop(mean, std)


def describe_clusters(df: DataFrame, cluster: Sequence[str], z: str = "z", loose: float = 1.0) -> DataFrame:
    """count, mean_z, min_z, std_z (sample; 0 below two members) and whether the cluster is trustworthy."""
    out = df.groupBy(*cluster).agg(F.count(F.lit(1)).alias("count"), F.avg(z).alias("mean_z"), F.min(z).alias("min_z"), F.coalesce(F.stddev_samp(z), F.lit(0.0)).alias("std_z"))
    return out.withColumn("trustworthy", (F.col("count") >= 2) & (F.col("std_z") < loose))


def judge_clusters(clusters: DataFrame, mean_digits: int | None = 4) -> DataFrame:
    """Trustworthy clusters with t_stat = mean_z * sqrt(n), and whether they are significantly good (p <= 0.05).

    ``mean_digits`` rounds the mean first, as a stage that rereads a text table does.
    """
    return t_statistics(clusters.where("trustworthy"), mean_digits)


def t_statistics(clusters: DataFrame, mean_digits: int | None = 4) -> DataFrame:
    """t_stat and good for all clusters, trustworthy or not; see :func:`judge_clusters`."""
    mean = F.col("mean_z") if mean_digits is None else rounded(F.col("mean_z"), mean_digits)
    return clusters.withColumn("t_stat", mean * F.sqrt(F.col("count"))).withColumn("good", F.col("t_stat") <= GOOD_T)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 of nothing."""
    return 100.0 * part / F.greatest(F.lit(1), whole)


def p_values(df: DataFrame, t: str = "t_stat", name: str = "p_value") -> DataFrame:
    """Normal CDF of a column."""
    return df.withColumn(name, normal_cdf(F.col(t)))
