"""One command a stage: ``python -m sievespark.cli <stage> ...``, to be run by spark-submit on a cluster.

Paths are read and written by Spark, so they may be of any file system it knows. The commands with
``--root`` pass tables on below one folder, partitioned by conformation: ``poses``, ``strain``,
``collect``, ``groups``, ``review``, ``rescore``, ``final``. They take any number of conformations
(``--poses c1=folder ref1=folder``, or ``--only c1``), and leave the others' parts as they are.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievespark.chem.molblock import featurise
from sievespark.functions.scalar import base_id
from sievespark.operators import lookups, receptor, rescoring, strain
from sievespark.operators.quantiles import quantiles
from sievespark.operators.ranking import best_per_key, cut_prefix, ranked, require_some, require_sorted
from sievespark.plans import clusters, final, funnel
from sievespark.session import build_session, cut_lineage
from sievespark.sources import readers, writers


def _done(args: argparse.Namespace, what: str, df: DataFrame, write: object) -> None:
    if args.dry_run:
        print(f"{what}: {df.count()} rows, nothing written")
    else:
        write()  # type: ignore[operator]
        print(f"{what}: written")


def run_filter(spark: SparkSession, args: argparse.Namespace) -> None:
    """Geometric filter: report, winners' indexes, ranked scores, and the files with the winner in front."""
    rec = receptor.atoms(readers.read_receptor(spark, args.receptor))
    at = receptor.target_atom(rec, args.residue, args.number, args.atom).first()
    poses = readers.read_poses(spark, args.poses, numbered=True)
    report, won = funnel.geometric_filter(poses, (at["x"], at["y"], at["z"]), args.limit)
    hits = ranked(won.where("score is not null").select("compound_id", "seq", F.col("score").alias("winning_pose_score")), ["winning_pose_score", "seq"])
    index = won.where("pose_idx > 0").select("compound_id", F.col("pose_idx").alias("winning_pose_index_0based"), F.col("distance").alias("distance_A"))
    out = args.out.rstrip("/")

    def write() -> None:
        writers.write_csv(report, "interaction_filter_report", f"{out}/interaction_filter_report")
        writers.write_csv(index, "reordered_compounds", f"{out}/reordered_compounds")
        writers.write_csv(hits, "ranked_hits", f"{out}/ranked_hits")
        funnel.moved_poses(poses, won).write.mode("overwrite").parquet(f"{out}/passed")

    _done(args, "filter", report, write)


def run_cutoff(spark: SparkSession, args: argparse.Namespace) -> None:
    """Hits at or below a cutoff; the input has to be sorted, and some row has to be left."""
    hits = require_sorted(readers.read_stage_table(spark, "final_hits", args.hits), "rank", "ad4_score")
    kept = require_some(cut_prefix(hits, "ad4_score", args.cutoff), f"score <= {args.cutoff:g}")
    _done(args, "cutoff", kept, lambda: writers.write_csv(kept, "final_hits", args.out))


def run_dedup(spark: SparkSession, args: argparse.Namespace) -> None:
    """The best scorer of each base id, ranked anew."""
    hits = readers.read_stage_table(spark, "final_hits", args.hits)
    best = best_per_key(hits.withColumn("base", base_id(F.col("compound_id"))), ["base"], [F.col("ad4_score"), F.col("rank")])
    out = ranked(best.drop("base").withColumnRenamed("rank", "old"), ["ad4_score", "old"]).drop("old")
    _done(args, "dedup", out, lambda: writers.write_csv(out, "final_hits", args.out))


def run_cluster(spark: SparkSession, args: argparse.Namespace) -> None:
    """Scaffold groups, nested clusters, range, statistics and picks, from a table of ranked hits with their blocks."""
    out = clusters.cluster_hits(spark.read.parquet(args.hits), least=args.min_group_size)

    def write() -> None:
        for name in ("groups", "summary", "bounds", "per_cluster", "judged", "picks", "kept"):
            getattr(out, name).write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
        out.members.drop("fp").write.mode("overwrite").partitionBy("conformation", "k").parquet(f"{args.out.rstrip('/')}/members")

    _done(args, "cluster", out.picks, write)


def run_caps(spark: SparkSession, args: argparse.Namespace) -> None:
    """A receptor with its merged caps split out."""
    lines = receptor.capped_lines(readers.read_receptor(spark, args.receptor))
    _done(args, "caps", lines, lambda: lines.coalesce(1).sortWithinPartitions("seq").select("value").write.mode("overwrite").text(args.out))


def run_gap(spark: SparkSession, args: argparse.Namespace) -> None:
    """A receptor with a TER line at its chain gap."""
    lines = receptor.gap_lines(readers.read_receptor(spark, args.receptor), args.last)
    _done(args, "gap", lines, lambda: lines.coalesce(1).sortWithinPartitions("seq").select("value").write.mode("overwrite").text(args.out))


BY = ("conformation",)


def _named(pairs: Sequence[str]) -> dict[str, str]:
    return dict(p.split("=", 1) for p in pairs)


def _table(spark: SparkSession, args: argparse.Namespace, name: str) -> DataFrame:
    return writers.read_part(spark, args.root, name, args.only)


def _put(args: argparse.Namespace, **tables: DataFrame) -> None:
    first = next(iter(tables.values()))
    parts = args.only or [r[0] for r in writers.read_part(first.sparkSession, args.root, "interaction_filter_report").select(*BY).distinct().collect()]
    if args.dry_run:
        print(f"{args.stage}: " + ", ".join(f"{n} {t.count()} rows" for n, t in tables.items()) + ", nothing written")
        return
    for name, table in tables.items():
        writers.write_part(table, args.root, name, parts)
    print(f"{args.stage}: {', '.join(tables)} written for {', '.join(sorted(parts))}")


def run_poses(spark: SparkSession, args: argparse.Namespace) -> None:
    """Geometric filter of several conformations: reports, ranked scores, moved winners, and the winners' blocks."""
    folders, receptors = _named(args.poses), _named(args.receptor)
    args.only = sorted(folders)
    if set(folders) != set(receptors):
        raise ValueError("each conformation has one folder of poses and one receptor")
    at = {c: receptor.target_atom(receptor.atoms(readers.read_receptor(spark, p)), args.residue, args.number, args.atom).first() for c, p in receptors.items()}
    target = spark.createDataFrame([(c, a["x"], a["y"], a["z"]) for c, a in at.items()], "conformation string, x double, y double, z double")
    poses = cut_lineage(readers.read_conformations(spark, folders, numbered=True))
    report, won = funnel.geometric_filter(poses, target, args.limit, by=BY)
    won = cut_lineage(won)
    hits = ranked(won.where("score is not null").select(*BY, "compound_id", "seq", F.col("score").alias("winning_pose_score")), ["winning_pose_score", "seq"], BY)
    index = won.where("pose_idx > 0").select(*BY, "compound_id", F.col("pose_idx").cast("long").alias("winning_pose_index_0based"), F.col("distance").alias("distance_A"))
    paths = poses.select(*BY, "compound_id", "path").distinct()
    _put(args, interaction_filter_report=report, reordered_compounds=index, ranked_hits=hits.drop("seq"), scores=paths, winners=funnel.fetch_blocks(won.select(*BY, "compound_id", "pose_idx"), poses, BY), pose_files=poses.select(*BY, "compound_id", "pose_idx", "block"))


def run_strain(spark: SparkSession, args: argparse.Namespace) -> None:
    """Torsion strain of every winner."""
    rules = readers.read_torsion_rules(spark, args.rules)
    poses = _table(spark, args, "winners").select(F.struct(*BY, "compound_id").alias("of"), F.to_json(F.struct(*BY, "compound_id")).alias("name"), "block")
    report = strain.strain_of_poses(poses, rules, key="name", total_limit=args.total, single_limit=args.single)
    kind = poses.schema["of"].dataType
    named = report.withColumn("of", F.from_json("compound", kind))
    _put(args, strain_filter_report=named.select("of.*", F.col("total").alias("total_TEU"), F.col("single").alias("single_TEU"), "flagged", F.col("n_torsions").cast("long").alias("n_torsions"), "strained", "error"))


def run_collect(spark: SparkSession, args: argparse.Namespace) -> None:
    """Compounds that passed both filters, cut, one a base id, ranked, with their blocks; and the range of scores."""
    hits, missing = funnel.survivors(*(_table(spark, args, n) for n in ("ranked_hits", "strain_filter_report", "scores", "reordered_compounds")), by=BY)
    lost = missing.limit(5).collect()
    if lost:
        print(f"without a path, passed over: {[tuple(r) for r in lost]} ...")
    hits = require_some(cut_lineage(funnel.cut_hits(hits, args.cutoff, not args.variants, by=BY)), "both filters")
    ranges = quantiles(hits.withColumns({c: F.col(c).cast("double") for c in RANGED}), RANGED, [0.0, 0.5, 1.0], BY)
    means = hits.groupBy(*BY).agg(*[F.avg(c).alias(c) for c in RANGED])
    report = ranges.groupBy(*BY, "of").pivot("share", [0.0, 0.5, 1.0]).agg(F.first("value")).toDF(*BY, "of", "min", "median", "max")
    listed = means.select(*BY, F.explode(F.map_from_arrays(F.array(*map(F.lit, RANGED)), F.array(*RANGED))).alias("of", "mean"))
    blocks = _table(spark, args, "winners").select(*BY, "compound_id", "block")
    _put(args, hits=hits.drop("seq").join(blocks, [*BY, "compound_id"]), score_range_report=report.join(listed, [*BY, "of"]))


RANGED = ["ad4_score", "total_TEU", "single_TEU"]


def run_groups(spark: SparkSession, args: argparse.Namespace) -> None:
    """Scaffold groups, nested clusters, statistics and picks over the hits of all conformations."""
    out = clusters.cluster_hits(_table(spark, args, "hits"), least=args.min_group_size, lone_cut=args.lone_cut)
    hits = _table(spark, args, "hits")
    _put(args, groups=out.groups, cluster_summary=out.summary, q3_per_cluster=out.per_cluster, q4_per_cluster=out.judged, picks=clusters.tagged_picks(out.picks, hits), kept_clusters=out.kept)


def run_review(spark: SparkSession, args: argparse.Namespace) -> None:
    """The files of the best hits with their winners in front, beside the receptor: a folder for each conformation."""
    hits = _table(spark, args, "ranked_hits")
    index = _table(spark, args, "reordered_compounds").select(*BY, "compound_id", F.col("winning_pose_index_0based").cast("int").alias("pose_idx"))
    files = funnel.review_files(lookups.with_default(hits, index, [*BY, "compound_id"], {"pose_idx": 0}), _table(spark, args, "pose_files"), args.n, by=BY)
    rows = files.select(*BY, F.concat(F.lpad(F.col("rank").cast("string"), 4, "0"), F.lit("_"), "compound_id").alias("file"), F.regexp_replace("text", r"\r?\n\z", "").alias("value"))
    for name, path in _named(args.receptor).items():
        lines = readers.read_receptor(spark, path).agg(F.array_sort(F.collect_list(F.struct("line_no", "value"))).alias("l"))  # one receptor
        rows = rows.unionByName(lines.select(F.lit(name).alias("conformation"), F.lit("receptor").alias("file"), F.array_join(F.transform("l", lambda x: x["value"]), "\n").alias("value")))
    if args.dry_run:
        print(f"review: {rows.count()} files, nothing written")
        return
    rows.repartition(*BY, "file").write.mode("overwrite").partitionBy(*BY, "file").text(args.out)
    print(f"review: {args.out} written")


def run_rescore(spark: SparkSession, args: argparse.Namespace) -> None:
    """Scores of the picks by an external program; what is scored is kept, what failed is done again."""
    words = args.program.split()
    scorer = rescoring.external_scorer(lambda record, result, row: [w.format(record=record, result=result, **row) for w in words], args.timeout)
    picks = _table(spark, args, "picks")
    done = _table(spark, args, "rescored") if args.resume else None
    scored = rescoring.rescore(picks, scorer, done)
    if done is not None:
        scored = done.where("error is null").select(*scored.columns).unionByName(scored)
    _put(args, rescored=scored)


def run_final(spark: SparkSession, args: argparse.Namespace) -> None:
    """Best of each cluster, novelty, annotations, and the final rank within each conformation."""
    rows, actives = _table(spark, args, "rescored"), None
    if args.actives:
        rows = featurise(rows).drop("scaffold")
        actives = featurise(readers.read_poses(spark, args.actives)).where("fp is not null").select("fp")
    notes = spark.read.option("header", True).option("inferSchema", True).csv(args.annotations) if args.annotations else None
    _put(args, final_ranked=final.final_ranking(rows, BY, actives, notes, args.rejects, args.top).drop("fp", "block"))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sievespark", description=__doc__)
    top.add_argument("--master", help="only for local runs; spark-submit sets it otherwise")
    stages = top.add_subparsers(required=True)

    def stage(name: str, run: object, *paths: str) -> argparse.ArgumentParser:
        sub = stages.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        for p in (*paths, "out"):
            sub.add_argument(f"--{p}", required=True)
        sub.add_argument("--dry-run", action="store_true", help="report only")
        return sub

    sub = stage("filter", run_filter, "poses", "receptor")
    for name, kind, value in (("residue", str, "ASP"), ("number", int, 116), ("atom", str, "CG"), ("limit", float, 5.0)):
        sub.add_argument(f"--{name}", type=kind, default=value)
    stage("cutoff", run_cutoff, "hits").add_argument("--cutoff", type=float, default=-6.0)
    stage("dedup", run_dedup, "hits")
    stage("cluster", run_cluster, "hits").add_argument("--min-group-size", type=int, default=10)
    stage("caps", run_caps, "receptor")
    stage("gap", run_gap, "receptor").add_argument("--last", type=int, required=True)

    def passing(name: str, run: object, *paths: str) -> argparse.ArgumentParser:
        sub = stages.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run, stage=name)
        sub.add_argument("--root", required=True, help="folder of the tables")
        sub.add_argument("--only", nargs="+", help="conformations; all, if not given")
        for p in paths:
            sub.add_argument(f"--{p}", required=True)
        sub.add_argument("--dry-run", action="store_true", help="report only")
        return sub

    sub = passing("poses", run_poses)
    for name in ("poses", "receptor"):
        sub.add_argument(f"--{name}", nargs="+", required=True, metavar="CONFORMATION=PATH")
    for name, kind, value in (("residue", str, "ASP"), ("number", int, 116), ("atom", str, "CG"), ("limit", float, 5.0)):
        sub.add_argument(f"--{name}", type=kind, default=value)
    sub = passing("strain", run_strain, "rules")
    sub.add_argument("--total", type=float, default=7.0)
    sub.add_argument("--single", type=float, default=1.8)
    sub = passing("collect", run_collect)
    sub.add_argument("--cutoff", type=float, help="all scores, if not given")
    sub.add_argument("--variants", action="store_true", help="keep all variants of a base id")
    sub = passing("groups", run_groups)
    sub.add_argument("--min-group-size", type=int, default=10)
    sub.add_argument("--lone-cut", type=float, default=-3.0)
    sub = passing("review", run_review, "out")
    sub.add_argument("--receptor", nargs="+", default=[], metavar="CONFORMATION=PATH")
    sub.add_argument("--n", type=int, default=10)
    sub = passing("rescore", run_rescore, "program")
    sub.add_argument("--timeout", type=float, default=300.0)
    sub.add_argument("--resume", action="store_true")
    sub = passing("final", run_final)
    for name in ("actives", "annotations", "rejects"):
        sub.add_argument(f"--{name}")
    sub.add_argument("--top", type=int, default=30)
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session(master=args.master), args)


if __name__ == "__main__":
    main()
