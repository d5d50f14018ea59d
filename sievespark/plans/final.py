"""From rescored picks to the final ranking: best of each cluster, contacts, novelty, annotations, rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievespark.operators.ranking import ranked
from sievespark.operators.rescoring import best_per_cluster, split_results
from sievespark.operators.similarity import max_similarity

#: Similarities from which a candidate counts as known, or as near to it.
KNOWN, BORDERLINE = 0.55, 0.35


def novelty(candidates: DataFrame, actives: DataFrame, key: Sequence[str], fp: str = "fp", known: float = KNOWN, borderline: float = BORDERLINE) -> DataFrame:
    """``candidates`` with max_tc to ``actives`` (fp) and flag: known, borderline or novel.

    Without a fingerprint, or without actives, max_tc is null and the flag novel.
    """
    named = candidates.withColumn("candidate", F.struct(*key))
    best = max_similarity(named, "candidate", fp, actives, "fp").withColumnRenamed("candidate", "of")
    tc = F.col("max_tc")
    flag = F.when(tc >= known, "known").when(tc >= borderline, "borderline").otherwise("novel")
    return named.join(best, F.col("candidate") == F.col("of"), "left").drop("candidate", "of").withColumn("flag", flag)


def annotated(candidates: DataFrame, annotations: DataFrame, key: Sequence[str], rejects: str | None = None) -> DataFrame:
    """``candidates`` with the columns of a supplied table, joined by ``key``; rows where its boolean ``rejects`` is true go.

    Candidates that the table does not name stay, with nulls. A key that it names twice is an error.
    """
    twice = annotations.groupBy(*key).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"annotated twice: {tuple(twice[0])[:-1]}")
    both = candidates.join(annotations, list(key), "left")
    return both if rejects is None else both.where(~F.coalesce(F.col(rejects), F.lit(False))).drop(rejects)


def final_ranking(rescored: DataFrame, within: Sequence[str] = ("conformation",), actives: DataFrame | None = None, annotations: DataFrame | None = None, rejects: str | None = None, top: int = 30) -> DataFrame:
    """The full ranking: the best of each cluster by mmgbsa_dg and all lone picks, rank within ``within``, in_top30.

    ``rescored`` has ``within``, cluster_id, source, compound_id, mmgbsa_dg, and fp where ``actives``
    (fp) are given. Rows without a score are out. ``annotations`` are joined by ``within`` and
    compound_id. Ties go by compound_id.
    """
    good, _ = split_results(rescored)
    rows = best_per_cluster(good, [*within, "cluster_id"], "mmgbsa_dg")
    key = [*within, "compound_id"]
    if actives is not None:
        rows = novelty(rows, actives, key)
    if annotations is not None:
        rows = annotated(rows, annotations, key, rejects)
    placed = ranked(rows, ["mmgbsa_dg", "compound_id"], within)
    return placed.withColumn(f"in_top{top}", F.col("rank") <= top)
