"""Torsion strain from a table of rule matches."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievespark.chem.patterns import find
from sievespark.functions.scalar import dihedral, histogram_value, quartic_strain, strained
from sievespark.session import cut_lineage

#: (block, patterns) -> [(number of the pattern, atoms), ...].
Matcher = Callable[[str, list[str]], list[tuple[int, tuple[int, ...]]]]
#: The texts of the report's error column.
NOT_PARSED, RIGID, FLAGGED = "could not parse winning pose", "no torsions matched (rigid)", "flagged (unreliable estimate)"


def combine_matches(matches: DataFrame) -> DataFrame:
    """Per compound: total, single, flagged, n_torsions.

    ``matches`` has compound, the atoms a1..a4, rule, seq, energy, specific, not_observed. Atoms are
    put in canonical direction; the same four atoms keep their earliest rule; the same central bond
    keeps a specific rule before a general one, then the highest energy, then the earliest.
    """
    turn = F.col("a2") > F.col("a3")
    c = matches.select("compound", F.when(turn, F.col("a4")).otherwise(F.col("a1")).alias("a1"), F.least("a2", "a3").alias("a2"), F.greatest("a2", "a3").alias("a3"), F.when(turn, F.col("a1")).otherwise(F.col("a4")).alias("a4"), "rule", "seq", "energy", "specific", "not_observed")
    four = Window.partitionBy("compound", "a1", "a2", "a3", "a4").orderBy("rule", "seq", "energy")
    bond = Window.partitionBy("compound", "a2", "a3").orderBy(F.desc("specific"), F.desc("energy"), "rule", "seq", "a1", "a4")
    # Both windows run over one exchange by compound.
    one = c.repartition("compound").withColumn("n", F.row_number().over(four)).where("n = 1")
    two = one.withColumn("n", F.row_number().over(bond)).where("n = 1")
    return two.groupBy("compound").agg(F.sum("energy").alias("total"), F.max("energy").alias("single"), F.bool_or("not_observed").alias("flagged"), F.count(F.lit(1)).alias("n_torsions"))


def match_torsions(poses: DataFrame, rules: DataFrame, matcher: Matcher = find, key: str = "compound", block: str = "block") -> DataFrame:
    """Matches of every rule in every pose, measured: the table that :func:`combine_matches` takes, plus theta and error.

    ``rules`` is a library as :func:`read_torsion_rules` gives it (a few hundred rows). Matches of more
    than four atoms are passed over; fewer are an error of the pose, as is one that cannot be parsed.
    Poses without a match have one row without a rule.
    """
    from sievespark.chem.molblock import parse_block

    patterns = [r["smarts"] for r in rules.select("rule", "smarts").orderBy("rule").collect()]
    point = "struct<x:double,y:double,z:double>"
    kind = f"struct<found:array<struct<rule:int,seq:int,atoms:array<int>,p:array<{point}>>>,error:string>"

    @F.pandas_udf(kind)
    def matched(blocks: pd.Series) -> pd.DataFrame:
        out = []
        for text in blocks:
            try:
                mol = parse_block(text)
            except (ValueError, AttributeError):
                out.append((None, NOT_PARSED))
                continue
            try:
                found = [(rule, atoms) for rule, atoms in matcher(text, patterns) if len(atoms) <= 4]
                rows = [{"rule": rule, "seq": i, "atoms": [atoms[k] for k in range(4)], "p": [dict(zip("xyz", mol.xyz[atoms[k]])) for k in range(4)]} for i, (rule, atoms) in enumerate(found)]
                out.append((rows, None))
            except Exception as e:  # a toolkit may raise anything; it is this pose's error
                out.append((None, str(e)))
        return pd.DataFrame(out, columns=["found", "error"])

    seen = poses.select(F.col(key).alias("compound"), matched(F.col(block)).alias("m")).select("compound", "m.error", F.explode_outer("m.found").alias("f"))
    seen = seen.select("compound", "error", "f.rule", "f.seq", *[F.col("f.atoms")[i].alias(f"a{i + 1}") for i in range(4)], dihedral(*[F.col("f.p")[i] for i in range(4)]).alias("theta"))
    library = rules.select(F.col("rule").alias("of"), (F.col("class") != "GG").alias("specific"), "method", F.transform("bins", lambda b: b["energy"]).alias("bins"), "angles")
    both = seen.join(F.broadcast(library), F.col("rule") == F.col("of"), "left")  # one library
    peak = quartic_strain(F.col("theta"), F.col("angles"))
    exact = F.col("method") == "exact"
    energy = F.when(exact, histogram_value(F.col("theta"), F.col("bins"))).otherwise(peak["energy"])
    return both.select("compound", "a1", "a2", "a3", "a4", "rule", "seq", "theta", F.when(F.col("rule").isNotNull(), energy).alias("energy"), "specific", F.when(exact, False).otherwise(peak["not_observed"]).alias("not_observed"), "error")


def strain_of_poses(poses: DataFrame, rules: DataFrame, matcher: Matcher = find, key: str = "compound", block: str = "block", total_limit: float = 7.0, single_limit: float = 1.8) -> DataFrame:
    """Every pose's strain report, from its block: match, measure, energy, precedence, verdict."""
    found = cut_lineage(match_torsions(poses, rules, matcher, key, block))
    broken = found.where("error is not null").select("compound", F.col("error").alias("why")).distinct()
    report = strain_report(poses.select(F.col(key).alias("compound")).distinct(), found.where("rule is not null"), total_limit, single_limit).join(broken, "compound", "left")
    return report.withColumn("error", F.coalesce("why", "error")).drop("why")


def strain_report(compounds: DataFrame, matches: DataFrame, total_limit: float = 7.0, single_limit: float = 1.8) -> DataFrame:
    """Every compound with its strain, the tri-state ``strained`` and why it could not be scored."""
    out = compounds.join(combine_matches(matches), "compound", "left")
    flagged = F.coalesce("flagged", F.lit(False))
    why = F.when(F.col("n_torsions").isNull(), RIGID).when(flagged, FLAGGED)
    verdict = strained(F.col("total"), F.col("single"), flagged, total_limit, single_limit)
    return out.withColumn("error", why).withColumn("strained", verdict).withColumn("n_torsions", F.coalesce("n_torsions", F.lit(0))).withColumn("flagged", flagged)
