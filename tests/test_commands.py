"""From pose files of three conformations to the final rank, by commands alone."""

import math
import os
import random
import re
import sys

import pytest
from pyspark.sql import functions as F

from sievespark import cli
from sievespark.plans import final
from sievespark.sources import writers
from test_funnel import atom_line, block

NAMES = ("c1", "ref/1", "5")


def molecule(name, ring, tail, score, far=False):
    """A ring of carbons with a tail that ends in a charged nitrogen near the origin, or far from it."""
    shift = 30.0 if far else 0.0
    atoms = [("C", 5 + math.cos(2 * math.pi * i / max(ring, 1)), math.sin(2 * math.pi * i / max(ring, 1)), 0.0) for i in range(ring)]
    bonds = [(i + 1, (i + 1) % ring + 1, 1) for i in range(ring)] if ring else []
    for k in range(tail):
        atoms.append(("C", 4.0 - k + shift, 0.3 * (k % 2), 0.2 * k))
        if len(atoms) > 1:
            bonds.append((len(atoms) - 1, len(atoms), 1))
    atoms.append(("N", 1.0 + shift, 0.0, 0.0))
    bonds.append((len(atoms) - 1, len(atoms), 1))
    return block(name, atoms, bonds, [(len(atoms), 1)], score)


def poses(folder, seed, n=24):
    rng = random.Random(seed)
    os.makedirs(folder, exist_ok=True)
    for i in range(n):
        ring, tail = (0, 5, 6, 7)[i % 4] if i < 20 else i - 12, 4 + i % 3  # four scaffolds, and some that occur once
        score = round(rng.uniform(-11, -10.5) if ring == 6 else rng.uniform(-10, -6), 2)
        name = f"m{i}_S1_T1" if i % 5 else f"m{i - i % 2}_S{i}_T1"
        text = molecule(name, ring, tail, -20.0, far=True) + molecule(name, ring, tail, score) if i % 2 else molecule(name, ring, tail, score)
        with open(f"{folder}/{name}.sdf", "w") as f:
            f.write(text)
    with open(f"{folder}/away.sdf", "w") as f:
        f.write(molecule("away", 6, 4, -30.0, far=True))


@pytest.fixture(scope="module")
def funnel_run(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("run")
    for i, c in enumerate(NAMES):
        poses(f"{at}/poses{i}", i)
        with open(f"{at}/r{i}.pdb", "w") as f:
            f.write(atom_line(1, "CG", "ASP", 116, 0.0).replace("   1.000   2.000", "   0.000   0.000") + "\n" + atom_line(2, "N", "LYS", 228) + "\n")
    bins = "".join(f'<bin energy="0.05" lower="{10 * k - 180}" upper="{10 * k - 170}"/>' for k in range(36))
    with open(f"{at}/rules.xml", "w") as f:
        f.write(f'<library><hierarchyClass name="CC"><torsionRule smarts="CCCC" method="exact"><histogram_converted>{bins}</histogram_converted></torsionRule></hierarchyClass></library>')
    with open(f"{at}/score.py", "w") as f:
        f.write("import sys\nname = open(sys.argv[1]).readline().strip()\nif name == 'm3_S1_T1': sys.exit(3)\nopen(sys.argv[2], 'w').write(f'status,TOTAL\\nS,{-len(name) - float(sys.argv[3])}\\n')\n")
    root = f"{at}/root"
    command = lambda *args: cli.main([*args, "--root", root])
    pairs = lambda what: [f"{c}={at}/{what}{i}" + (".pdb" if what == "r" else "") for i, c in enumerate(NAMES)]
    command("poses", "--poses", *pairs("poses"), "--receptor", *pairs("r"))
    command("strain", "--rules", f"{at}/rules.xml")
    command("collect", "--cutoff", "-6.5")
    command("groups", "--min-group-size", "3", "--lone-cut", "5")
    command("rescore", "--program", f"{sys.executable} {at}/score.py {{record}} {{result}} {{cluster_id}}")
    command("final", "--actives", f"{at}/poses0", "--top", "3")
    command("review", "--receptor", *pairs("r"), "--out", f"{at}/review", "--n", "4")
    return at, root, command, pairs


def table(spark, root, name, only=None):
    return writers.read_part(spark, root, name, only)


def test_all_stages_for_three_conformations(spark, funnel_run):
    at, root, _, _ = funnel_run
    report = table(spark, root, "interaction_filter_report")
    assert {r[0] for r in report.select("conformation").distinct().collect()} == set(NAMES)
    assert {(r.conformation, r.passed) for r in report.where("compound_id = 'away'").collect()} == {(c, "False") for c in NAMES}
    ranks = table(spark, root, "ranked_hits").groupBy("conformation").agg(F.min("rank").alias("a"), F.max("rank").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r.a == 1 and r.b == r.n > 20 for r in ranks)
    hits = table(spark, root, "hits").collect()
    for c in NAMES:
        own = sorted((r for r in hits if r.conformation == c), key=lambda r: r["rank"])
        assert own and [r["rank"] for r in own] == list(range(1, len(own) + 1)) and all(r.ad4_score <= -6.5 for r in own)
        assert [r.ad4_score for r in own] == sorted(r.ad4_score for r in own) and len({r.compound_id.split("_")[0] for r in own}) == len(own)
        assert all(f"ENERGY= {r.ad4_score}" in r.block for r in own)  # the winning pose, not the far one
    ranges = {(r.conformation, r.of): r for r in table(spark, root, "score_range_report").collect()}
    for c in NAMES:
        scores = sorted(r.ad4_score for r in hits if r.conformation == c)
        r = ranges[c, "ad4_score"]
        mid = len(scores) // 2
        assert (r["min"], r["max"]) == (scores[0], scores[-1]) and r["mean"] == pytest.approx(sum(scores) / len(scores))
        assert r["median"] == pytest.approx(scores[mid] if len(scores) % 2 else (scores[mid - 1] + scores[mid]) / 2)
    picks = table(spark, root, "picks")
    assert picks.count() and picks.where("block not like '%>  <ROLE>%'").count() == 0


def test_final_rank(spark, funnel_run):
    _, root, _, _ = funnel_run
    rows = table(spark, root, "final_ranked").collect()
    scored = {(r.conformation, r.compound_id): r for r in table(spark, root, "rescored").collect()}
    assert rows and {r.conformation for r in rows} <= set(NAMES)
    for c in NAMES:
        own = sorted((r for r in rows if r.conformation == c), key=lambda r: r["rank"])
        assert [(r.mmgbsa_dg, r.compound_id) for r in own] == sorted((r.mmgbsa_dg, r.compound_id) for r in own)
        assert [r.in_top3 for r in own] == [i < 3 for i in range(len(own))]
        assert all(r.flag in ("known", "borderline", "novel") and r.max_tc is not None and 0 <= r.max_tc <= 1 for r in own)
        assert all(r.max_tc == 1.0 for r in own if c == "c1")  # its own poses are the actives
    assert all(r.error.startswith("no_output_rc3") for (_, name), r in scored.items() if name == "m3_S1_T1")
    assert not any(r.compound_id == "m3_S1_T1" for r in rows)


def test_review_folder(spark, funnel_run):
    at, root, _, _ = funnel_run
    back = spark.read.text(f"{at}/review", wholetext=True)
    files = {(r.conformation, r.file): r.value for r in back.collect()}
    assert len(files) == 15 and sum(name == "receptor" for _, name in files) == 3
    top = {(r.conformation, f"{r['rank']:04d}_{r.compound_id}"): r for r in table(spark, root, "ranked_hits").where("rank <= 4").collect()}
    for key, r in top.items():
        first = files[key].split("$$$$")[0]
        assert f"ENERGY= {r.winning_pose_score}" in first


def test_one_conformation_written_alone(spark, funnel_run):
    at, root, command, pairs = funnel_run
    before = {n: sorted(map(repr, table(spark, root, n).where("conformation <> 'ref/1'").collect())) for n in ("ranked_hits", "hits", "strain_filter_report")}
    old = table(spark, root, "hits", ["ref/1"]).count()
    for name in os.listdir(f"{at}/poses1"):
        if name.startswith("m1"):
            os.remove(f"{at}/poses1/{name}")
    command("poses", "--poses", pairs("poses")[1], "--receptor", pairs("r")[1])
    command("strain", "--rules", f"{at}/rules.xml", "--only", "ref/1")
    command("collect", "--cutoff", "-6.5", "--only", "ref/1")
    assert {n: sorted(map(repr, table(spark, root, n).where("conformation <> 'ref/1'").collect())) for n in before} == before
    assert 0 < table(spark, root, "hits", ["ref/1"]).count() < old
    plan = table(spark, root, "hits", ["ref/1"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*conformation", plan)
    writers.write_part(table(spark, root, "hits").where("false"), root, "hits", ["ref/1"])
    assert table(spark, root, "hits", ["ref/1"]).count() == 0 and table(spark, root, "hits").count() > 0


def test_annotations_join_by_key(spark):
    df = spark.createDataFrame([("c1", 1, "cluster", "a", -3.0), ("c1", 1, "cluster", "b", -5.0), ("c1", 2, "cluster", "c", -4.0), ("c1", 3, "singleton", "d", None), ("c2", 1, "singleton", "a", -1.0)], "conformation string, cluster_id long, source string, compound_id string, mmgbsa_dg double")
    notes = spark.createDataFrame([("c1", "b", 2.5, True), ("c1", "c", 1.5, False), ("c9", "z", 0.0, True)], "conformation string, compound_id string, logp double, bad boolean")
    got = final.final_ranking(df, annotations=notes, rejects="bad")
    assert [(r.conformation, r.compound_id, r["rank"], r.logp) for r in got.orderBy("conformation", "rank").collect()] == [("c1", "c", 1, 1.5), ("c2", "a", 1, None)]
    with pytest.raises(ValueError):
        final.annotated(df, notes.union(notes), ["conformation", "compound_id"])
