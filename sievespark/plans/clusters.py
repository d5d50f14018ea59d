"""From ranked hits to the pick list: scaffold groups, nested clusters, informative range, statistics, picks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievespark.chem.molblock import Backend, featurise
from sievespark.functions.scalar import add_properties
from sievespark.operators.cluster_stats import describe_clusters, judge_clusters, pool_zscore
from sievespark.operators.clustering import nested_of_fingerprints, numbered, size_summary
from sievespark.operators.curves import half_maximum, intersection, local_minimum, slopes
from sievespark.operators.ranking import ranked
from sievespark.operators.selection import kept_clusters, pick_list
from sievespark.operators.similarity import cluster_medoids
from sievespark.session import cut_lineage

#: Thresholds in twentieths (0.35 to 0.90), and the one at which picks are made.
GRID, PICKED = tuple(range(7, 19)), 12
CLUSTER = ["conformation", "k", "cluster_id"]


@dataclass
class Clusters:
    """Everything the clustering stages give; each is a DataFrame."""

    groups: DataFrame  # conformation, bm_group_id, size, scaffold
    members: DataFrame  # conformation, k, cluster_id, compound_id, rank, ad4_score, z, fp
    summary: DataFrame  # conformation, k, tc, sizes
    bounds: DataFrame  # lo, hi (raw), lower, upper (on the grid)
    per_cluster: DataFrame  # of the clusters with thresholds inside the bounds: count, mean_z, min_z, std_z, trustworthy
    judged: DataFrame  # the trustworthy ones: t_stat, good
    picks: DataFrame  # conformation, source, cluster_id, compound_id, ad4_score, cluster_size, roles
    kept: DataFrame  # statistics of the clusters that gave picks


def scaffold_groups(hits: DataFrame, backend: Backend | None = None) -> DataFrame:
    """``hits`` (conformation, compound_id, rank, ad4_score, block) with fp, scaffold, group. Written.

    A compound whose scaffold fails is a group of its own; "" (no ring) is a group like any other.
    """
    seen = featurise(hits.select("conformation", "compound_id", F.col("rank").cast("long").alias("rank"), "ad4_score", "block"), backend)
    name = F.coalesce("scaffold", F.concat(F.lit("__ERROR__"), "compound_id"))
    return cut_lineage(seen.withColumn("scaffold", name).withColumn("group", F.concat(F.length("conformation"), F.lit("/"), "conformation", F.lit("/"), "scaffold")))


def _conformation(group: Column) -> Column:
    """What :func:`scaffold_groups` put into a group's name, whatever it holds."""
    n = F.substring_index(group, "/", 1)
    return F.substring(group, F.length(n) + 2, n.cast("int"))


def group_table(featured: DataFrame) -> DataFrame:
    """conformation, bm_group_id (from 0, by size, then by first rank), size, scaffold."""
    sizes = featured.groupBy("conformation", "scaffold").agg(F.count(F.lit(1)).alias("size"), F.min("rank").alias("first"))
    placed = ranked(sizes.withColumn("less", -F.col("size")), ["less", "first"], ["conformation"], "place")
    return placed.select("conformation", (F.col("place") - 1).alias("bm_group_id"), "size", "scaffold")


def informative_range(summary: DataFrame, grid: Sequence[int] = GRID) -> DataFrame:
    """lo, hi, lower, upper over all conformations: where the counts still climb, and where the top ten level off."""
    curve = summary.select("conformation", "tc", F.col("n_clusters").cast("double").alias("n"), F.col("top10_pct").alias("top"))
    upper = half_maximum(slopes(curve, "tc", "n", ["conformation"]), ["conformation"])
    lower = local_minimum(slopes(curve, "tc", "top", ["conformation"]), ["conformation"])
    return intersection(upper.join(lower, "conformation"), [k / 20 for k in grid])


def cluster_hits(hits: DataFrame, backend: Backend | None = None, grid: Sequence[int] = GRID, least: int = 10, picked: int = PICKED, lone_cut: float = -3.0) -> Clusters:
    """All stages over ``hits``: conformation, compound_id, rank, ad4_score, block.

    Conformations are never mixed. Nodes are ranks, so ties go to the better rank. Picks are made at
    the threshold ``picked`` whatever the range says; a cluster's members without a fingerprint are
    passed over by the medoid.
    """
    featured = scaffold_groups(hits, backend)
    nodes = featured.select("group", F.col("rank").alias("node"), "fp")
    found = nested_of_fingerprints(nodes, grid, least).withColumn("conformation", _conformation(F.col("group")))
    found = cut_lineage(numbered(found, least, ["conformation", "k"]))
    scored = pool_zscore(featured, "ad4_score", ["conformation"])
    members = found.select(*CLUSTER, F.col("node").alias("rank")).join(scored.select("conformation", "rank", "compound_id", "ad4_score", "z", "fp"), ["conformation", "rank"])
    members = cut_lineage(members)
    tc = F.col("k") / 20
    summary = cut_lineage(size_summary(members, ["conformation", "k"], ["cluster_id"]).withColumn("tc", tc))
    bounds = cut_lineage(informative_range(summary, grid))
    stats = cut_lineage(describe_clusters(members, CLUSTER))
    inside = stats.withColumn("tc", tc).join(F.broadcast(bounds.select("lower", "upper")), F.col("tc").between(F.col("lower") - 1e-9, F.col("upper") + 1e-9)).drop("lower", "upper", "tc")
    at = lambda df: df.where(F.col("k") == picked)
    judged = judge_clusters(stats)
    good = at(judged).where("good")
    alone = at(stats).where("count = 1").select(*CLUSTER)
    outliers = at(members).join(alone, CLUSTER, "left_semi").where(F.col("z") <= lone_cut)
    chosen = at(members).join(good.select(*CLUSTER), CLUSTER, "left_semi").where("fp is not null")
    middle = cluster_medoids(chosen.select(*CLUSTER, F.col("rank").alias("node"), "fp"), CLUSTER)
    middle = chosen.join(middle, CLUSTER).where(F.col("rank") == F.col("medoid")).select(*CLUSTER, "compound_id")
    picks = cut_lineage(pick_list(at(members), good, outliers, CLUSTER, middle))
    return Clusters(group_table(featured), members, summary, bounds, inside, judged.join(inside.select(*CLUSTER), CLUSTER, "left_semi"), picks.drop("k"), kept_clusters(picks, at(judged), CLUSTER).drop("k"))


def pick_tags(cluster_id: str = "cluster_id") -> dict[str, Column]:
    """Properties of a pick's record, in order."""
    return {"COMPOUND_ID": F.col("compound_id"), "CONFORMATION": F.col("conformation"), "CLUSTER_ID": F.col(cluster_id), "ROLE": F.col("roles"), "AD4_SCORE": F.format_string("%.3f", "ad4_score"), "SOURCE": F.col("source")}


def tagged_picks(picks: DataFrame, hits: DataFrame) -> DataFrame:
    """``picks`` with their blocks, properties added."""
    both = picks.join(hits.select("conformation", "compound_id", "block"), ["conformation", "compound_id"])
    return both.withColumn("block", add_properties(F.col("block"), pick_tags()))
