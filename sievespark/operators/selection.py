"""The pick list: good clusters' representatives with merged roles, and lone outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievespark.operators.cluster_stats import p_values


def pick_list(members: DataFrame, good: DataFrame, outliers: DataFrame, cluster: Sequence[str], medoids: DataFrame | None = None) -> DataFrame:
    """(cluster, source, compound_id, ad4_score, cluster_size, roles).

    Each good cluster gives its best scorer and its medoid; one that is both is one row with both
    roles. ``medoids`` has (cluster, compound_id); without it the member nearest the cluster's mean
    z stands in. Every outlier is a row of its own.
    """
    inside = members.join(good.select(*cluster, "count", F.col("mean_z").alias("centre")), list(cluster))
    best = inside.groupBy(*cluster).agg(F.min_by("compound_id", F.struct("ad4_score", "compound_id")).alias("compound_id")).withColumn("role", F.lit("best_scorer"))
    if medoids is None:
        near = F.struct(F.round(F.abs(F.col("z") - F.col("centre")), 9).alias("d"), F.col("compound_id"))
        medoids = inside.groupBy(*cluster).agg(F.min_by("compound_id", near).alias("compound_id"))
    middle = medoids.select(*cluster, "compound_id").withColumn("role", F.lit("medoid"))
    roles = best.unionByName(middle).groupBy(*cluster, "compound_id").agg(F.array_join(F.array_sort(F.collect_set("role")), "+").alias("roles"))
    chosen = roles.join(inside.select(*cluster, "compound_id", "ad4_score", F.col("count").alias("cluster_size")), [*cluster, "compound_id"])
    out = chosen.withColumn("source", F.lit("cluster"))
    alone = outliers.select(*cluster, "compound_id", "ad4_score", F.lit(1).cast("long").alias("cluster_size"), F.lit("singleton_outlier").alias("roles"), F.lit("singleton").alias("source"))
    return out.unionByName(alone).select(*cluster, "source", "compound_id", "ad4_score", "cluster_size", "roles")


def kept_clusters(picks: DataFrame, judged: DataFrame, cluster: Sequence[str]) -> DataFrame:
    """Statistics of the clusters that gave picks: count, mean_z, min_z, std_z, t_stat, p_value."""
    kept = picks.where("source = 'cluster'").select(*cluster).distinct()
    return p_values(judged).join(kept, list(cluster), "left_semi").select(*cluster, "count", "mean_z", "min_z", "std_z", "t_stat", "p_value")


def consensus(df: DataFrame, ranks: Sequence[str], sigma: float) -> DataFrame:
    """Exponential consensus sum(exp(-r / sigma) / sigma) and the mean rank."""
    total = sum((F.exp(-F.col(r) / sigma) / sigma for r in ranks), F.lit(0.0))
    mean = sum((F.col(r) for r in ranks), F.lit(0)) / float(len(ranks))
    return df.withColumn("consensus", total).withColumn("mean_rank", mean)


def within_ranges(df: DataFrame, ranges: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Rows inside every range, ends included; None leaves an end open. All of it reaches the scan."""
    for name, (low, high) in ranges.items():
        if low is not None:
            df = df.where(F.col(name) >= low)
        if high is not None:
            df = df.where(F.col(name) <= high)
    return df
