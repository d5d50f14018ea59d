"""The funnel from pose files to the ranked, deduplicated hit list, as one lineage.

Every step takes ``by``, columns (a conformation) that keep rows of the same compound apart; several
conformations then go through in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievespark.chem.molblock import describe_poses, nearest_charged
from sievespark.chem.tables import maybe_charged
from sievespark.functions.scalar import bad_score, base_id, winner_first
from sievespark.operators.lookups import missing_keys, require_none, with_default
from sievespark.operators.ranking import best_per_key, best_pose, cut_prefix, ranked


#: The texts of the report's error column.
NOTHING_READ, NO_CHARGE, BAD_SCORE = "rdkit failed to parse", "no charged N atom found in any pose", "could not convert string to float: "


def geometric_filter(poses: DataFrame, target: tuple[float, float, float] | DataFrame, limit: float = 5.0, expected: DataFrame | None = None, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(report, winners): every compound's outcome, and each passing compound's winning pose.

    ``target`` is a place, or a table of ``by``, x, y, z with a place for each. A pose that cannot be
    parsed, or has no charged nitrogen, has no distance and is passed over; the others decide. A
    score that is no number makes the whole compound an error. Spark's readers pass over files
    without a byte; with ``expected`` (``by``, compound_id) those compounds are reported as empty.
    """
    key = [*by, "compound_id"]
    seen = describe_poses(poses, wanted=maybe_charged(F.col("block")))
    if isinstance(target, DataFrame):
        places = target.select(*by, F.struct("x", "y", "z").alias("target_place"))  # a row each
        seen = seen.join(F.broadcast(places), list(by))
        target = tuple(F.col("target_place")[c] for c in "xyz")
    seen = seen.withColumn("distance", nearest_charged(F.col("atoms"), target))
    near = F.col("distance") <= limit
    # Blocks stay out of what is grouped: it is sorted, as texts are aggregated.
    narrow = seen.select(*key, "pose_idx", "distance", F.col("block").isNotNull().alias("there"), bad_score(F.col("block")).alias("broken"))
    per = narrow.groupBy(*key).agg(
        F.count_if("there").alias("n"), F.count("distance").alias("charged"), F.count_if(near).alias("near"), F.min_by("broken", F.when(F.col("broken").isNotNull(), F.col("pose_idx"))).alias("broken")
    )
    if expected is not None:
        per = expected.select(*key).distinct().join(per, key, "left").fillna(0, ["n", "charged", "near"])
    report = per.select(
        *key,
        F.when(F.col("broken").isNotNull(), "error").when(F.col("near") > 0, "True").otherwise("False").alias("passed"),
        F.when(F.col("broken").isNotNull(), F.concat(F.lit(BAD_SCORE + "'"), "broken", F.lit("'"))).when(F.col("n") == 0, NOTHING_READ).when(F.col("charged") == 0, NO_CHARGE).alias("error"),
    )
    passing = report.where("passed = 'True'").select(*key)
    won = best_pose(seen.where(near), key, "score", "distance", ["pose_idx"], [c for c in ("seq",) if c in poses.columns])
    return report, won.join(passing, key, "left_semi")


def moved_poses(poses: DataFrame, winners: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(``by``, compound_id, text, moved): each winner's file with the winning pose in front, the others in order."""
    key = [*by, "compound_id"]
    files = poses.where("block is not null").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("pose_idx", "block"))).alias("b"))  # up to nine poses
    both = files.join(winners.select(*key, F.col("pose_idx").alias("winner")), key)
    blocks = F.transform("b", lambda x: x["block"])
    return both.select(*key, F.array_join(winner_first(blocks, F.col("winner")), "").alias("text"), (F.col("winner") > 0).alias("moved"))


def fetch_blocks(hits: DataFrame, poses: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``hits`` (``by``, compound_id, pose_idx) with the pose's block; hits without one fall out, see :func:`lookups.missing_keys`."""
    key = [*by, "compound_id", "pose_idx"]
    return hits.join(poses.select(*key, "block"), key)


def review_set(hits: DataFrame, poses: DataFrame, n: int = 100, rank: str = "rank", by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` hits of each ``by`` with their blocks; a hit without one is an error."""
    top = hits.where(F.col(rank) <= n)
    found = fetch_blocks(top, poses, by)
    require_none(missing_keys(top, found, [*by, "compound_id"]), "no pose is there for")
    return found


def review_files(hits: DataFrame, poses: DataFrame, n: int = 10, rank: str = "rank", by: Sequence[str] = ()) -> DataFrame:
    """(``by``, rank, compound_id, text, moved): the whole file of each of the first ``n`` hits, its winning pose in front."""
    key = [*by, "compound_id"]
    top = hits.where(F.col(rank) <= n)
    wanted = poses.join(F.broadcast(top.select(*key)), key, "left_semi")  # n rows for each of by
    found = moved_poses(wanted, top, by)
    require_none(missing_keys(top, found, key), "no pose is there for")
    return found.join(F.broadcast(top.select(*key, F.col(rank).alias("rank"))), key)


def survivors(scores: DataFrame, strain: DataFrame, paths: DataFrame | None = None, moved: DataFrame | None = None, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(hits, missing): compounds that passed both filters, from the stage tables.

    ``scores``: ranked_hits; ``strain``: strain_filter_report; ``paths``: scores (compound_id, path);
    ``moved``: reordered_compounds. Tables with several rows a compound count by any of them in
    scores and strain, so keys are to be unique there. hits: compound_id, ad4_score, total_TEU,
    single_TEU, path, pose_idx (0 where the winner was in front), seq (rank among all scored).
    missing: compounds without a path.
    """
    key = [*by, "compound_id"]
    passed = strain.where("strained = false").select(*key, "total_TEU", "single_TEU")
    both = scores.select(*key, F.col("winning_pose_score").alias("ad4_score"), F.col("rank").alias("seq")).join(passed, key)
    missing = both.where("false").select(*key)
    if paths is not None:
        missing = missing_keys(both, paths, key)
        both = both.join(paths.select(*key, "path"), key)
    if moved is None:
        return both.withColumn("pose_idx", F.lit(0)), missing
    index = moved.select(*key, F.col("winning_pose_index_0based").cast("int").alias("pose_idx"))
    return with_default(both, index, key, {"pose_idx": 0}), missing


def cut_hits(hits: DataFrame, cutoff: float | None = None, variants: bool = True, tie: str = "seq", by: Sequence[str] = ()) -> DataFrame:
    """Hits at or below the cutoff, one a base id (``variants``), ranked within ``by``; ties go by ``tie``."""
    if cutoff is not None:
        hits = cut_prefix(hits, "ad4_score", cutoff)
    if variants:
        hits = best_per_key(hits.withColumn("base", base_id(F.col("compound_id"))), [*by, "base"], [F.col("ad4_score"), F.col(tie)]).drop("base")
    return ranked(hits, ["ad4_score", tie], by)


def hit_list(winners: DataFrame, strain: DataFrame, cutoff: float = -7.0, variants: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Winners that are not strained and score at or below the cutoff, one a base id, ranked.

    ``strain`` has ``by``, compound_id, total, single, strained. Compounds without a score fall out.
    Ties go by ``seq`` (the files' order) where ``winners`` has it, else by compound_id.
    """
    tie = "seq" if "seq" in winners.columns else "compound_id"
    more = [F.col("seq")] if tie == "seq" else []
    scored = winners.where("score is not null").select(*by, "compound_id", "pose_idx", F.col("score").alias("ad4_score"), *more)
    passed = strain.where("strained = false").select(*by, "compound_id", "total", "single")
    return cut_hits(scored.join(passed, [*by, "compound_id"]), cutoff, variants, tie, by).drop("seq")
