"""The funnel's operators on hand-made fixtures."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievespark.chem import molblock as M
from sievespark.chem import patterns
from sievespark.functions import scalar as S
from sievespark.operators import cluster_stats, clustering, curves, lookups, ranking, receptor, rescoring, selection, similarity, strain
from sievespark.plans import clusters, funnel
from sievespark.sources import readers, writers


def block(name, atoms, bonds=(), charges=(), score=None):
    rows = "".join(f"{x:10.4f}{y:10.4f}{z:10.4f} {s:<3} 0  0\n" for s, x, y, z in atoms)
    links = "".join(f"{a:3d}{b:3d}{o:3d}  0\n" for a, b, o in bonds)
    chg = f"M  CHG{len(charges):3d}" + "".join(f" {a:3d} {c:3d}" for a, c in charges) + "\n" if charges else ""
    tag = f"> <RESULT>\nENERGY= {score}\n\n" if score is not None else ""
    return f"{name}\n  prog\n\n{len(atoms):3d}{len(bonds):3d}  0  0  0  0  0  0  0  0999 V2000\n{rows}{links}{chg}M  END\n{tag}$$$$\n"


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_block_splitter(spark):
    text = "a\n$$$$\nb\r\n$$$$\r\nc\n$$$$\ntail"
    assert one(spark, S.split_blocks(F.lit(text))) == ["a\n$$$$\n", "b\r\n$$$$\r\n", "c\n$$$$\n", "tail"]
    assert one(spark, S.split_blocks(F.lit("a\n$$$$\n \n"))) == ["a\n$$$$\n"]
    assert "".join(one(spark, S.split_blocks(F.lit(text)))) == text


def test_scalar_functions(spark):
    ids = {"A_S1_T2": "A", "A_S11_T1": "A", "B": "B", "C_S1_T1_S2_T3": "C_S1_T1", "D_S1": "D_S1"}
    assert {k: one(spark, S.base_id(F.lit(k))) for k in ids} == ids
    assert one(spark, S.pose_score(F.lit("x ENERGY=  -7.25 y ENERGY=3"))) == -7.25
    assert one(spark, S.pose_score(F.lit("ENERGY=1.2.3"))) is None and one(spark, S.pose_score(F.lit("none"))) is None
    assert one(spark, S.file_stem(F.lit("file:/a/b%20c.x.sdf"))) == "b c.x"
    ramp = F.array(*[F.lit(float(i)) for i in range(36)])
    got = [one(spark, S.histogram_value(F.lit(t), ramp)) for t in (-180.0, -179.9, -10.0, 0.0, 0.1, 179.9, 180.0)]
    want = []
    for t in (-180.0, -179.9, -10.0, 0.0, 0.1, 179.9, 180.0):
        k = math.ceil(t / 10) + 17
        low = (k + 35) % 36
        want.append(float(low) + (float(k % 36) - low) * (t - (math.ceil(t / 10) - 1) * 10) / 10)
    assert got == pytest.approx(want)
    assert [one(spark, S.angle_difference(F.lit(a), F.lit(b))) for a, b in ((170.0, -170.0), (-170.0, 170.0), (180.0, 0.0), (0.0, 180.0))] == [-20.0, 20.0, 180.0, 180.0]
    peaks = F.array(F.struct(F.lit(0.0).alias("theta_0"), F.lit(30.0).alias("tolerance2"), F.lit(2.0).alias("beta_1"), F.lit(1.0).alias("beta_2")))
    assert tuple(one(spark, S.quartic_strain(F.lit(30.0), peaks))) == pytest.approx((2 * 30**2 + 30**4, False))  # degrees
    zs = [-40.0, -9.0, -7.2, -7.0, -3.3, -1.0, 0.0, 0.4, 2.5, 7.3]
    assert [one(spark, S.normal_cdf(F.lit(z))) for z in zs] == pytest.approx([0.5 * math.erfc(-z / math.sqrt(2)) for z in zs], rel=1e-9)
    assert tuple(one(spark, S.quartic_strain(F.lit(31.0), peaks))) == (100.0, True)
    arr = F.array(*map(F.lit, "abcd"))
    assert ["".join(one(spark, S.winner_first(arr, F.lit(i)))) for i in (0, 2, 3, 4, -1)] == ["abcd", "cabd", "dabc", "abcd", "abcd"]


def test_rounding_is_that_of_text(spark):
    rng = random.Random(6)
    values = [2.675, 0.25, 0.125, 1.005, -2.675, -0.00005, 0.00005, 0.00015, 1e-9, 123456.78905, 0.0, 1e15 + 0.5, 5e-324] + [rng.choice([1, -1]) * rng.randint(0, 10**7) / 10**5 for _ in range(300)] + [rng.gauss(0, 3) for _ in range(300)] + [rng.randint(0, 2**20) / 2**5 for _ in range(100)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 3, 4, 5):
        got = [r.r for r in df.select(S.rounded(F.col("v"), digits).alias("r")).collect()]
        assert got == [float(f"{v:.{digits}f}") for v in values]


def test_dihedral_against_vectors(spark):
    rng = random.Random(1)
    for _ in range(5):
        p = [[rng.uniform(-2, 2) for _ in range(3)] for _ in range(4)]
        sub = lambda a, b: [x - y for x, y in zip(b, a)]
        cr = lambda a, b: [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]
        dt = lambda a, b: sum(x * y for x, y in zip(a, b))
        nm = lambda a: [x / math.sqrt(dt(a, a)) for x in a]
        b1, b2, b3 = (nm(sub(p[i], p[i + 1])) for i in range(3))
        n1, n2 = cr(b1, b2), cr(b2, b3)
        want = -math.atan2(dt(cr(n1, b2), n2), dt(n1, n2)) * 180 / math.pi
        got = one(spark, S.dihedral(*[F.struct(*[F.lit(v).alias(k) for k, v in zip("xyz", q)]) for q in p]))
        assert got == pytest.approx(want)


def test_properties_round_trip(spark):
    b = S.add_properties(F.lit("m\nM  END\n$$$$\n"), {"A": F.lit("1"), "B": F.lit(None)})
    again = S.add_properties(b, {"A": F.lit("2")})
    assert one(spark, S.property_map(again)) == {"A": "2", "B": ""}
    assert one(spark, again).count("$$$$") == 1 and one(spark, again).endswith(">  <A>\n2\n\n$$$$\n")
    assert one(spark, S.add_properties(F.lit("m\nM  END$$$$"), {"A": F.lit("1")})) == "m\nM  END\n>  <A>\n1\n\n$$$$\n"
    assert one(spark, S.property_map(F.lit("> <A>\nx\n\n>\t<B_2> \ny\nz\n\n$$$$\n"))) == {"A": "x", "B_2": "y\nz"}


def test_winner_rules(spark):
    rows = [
        ("a", 0, 3.0, -5.0), ("a", 1, 4.0, -6.0), ("a", 2, 4.5, -6.0),  # best score, lowest index on a tie
        ("b", 0, 4.0, None), ("b", 1, 2.0, None), ("b", 2, 2.0, None),  # no score: nearest
        ("c", 0, 1.0, None), ("c", 1, 5.0, 9.0),  # any score beats none
    ]
    df = spark.createDataFrame(rows, "c string, i int, d double, s double")
    got = {r.c: (r.i, r.d, r.s) for r in ranking.best_pose(df, ["c"], "s", "d", ["i"]).collect()}
    assert got == {"a": (1, 4.0, -6.0), "b": (1, 2.0, None), "c": (1, 5.0, 9.0)}


def test_ranks_are_dense_and_stable(spark):
    rng = random.Random(2)
    rows = [(rng.choice("xy"), float(rng.randint(0, 20)), i) for i in range(500)] + [("x", None, 900)]
    df = spark.createDataFrame(rows, "g string, s double, i int")
    got = {(r.g, r.i): r["rank"] for r in ranking.ranked(df, ["s", "i"], ["g"]).collect()}
    for g in "xy":
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, r[1] or 0, r[2]))
        assert [got[g, r[2]] for r in order] == list(range(1, len(order) + 1))
    assert ranking.ranked(df.limit(0), ["s", "i"]).count() == 0
    assert ranking.share_cut(df, 0.1, ["s", "i"]).count() == 51


def test_dedup_last_wins_and_guards(spark):
    df = spark.createDataFrame([("A", 1.0, 2), ("A", 1.0, 1), ("B", 5.0, 3)], "k string, s double, r int")
    assert sorted((r.k, r.r) for r in ranking.best_per_key(df, ["k"], [F.col("s"), F.col("r")]).collect()) == [("A", 1), ("B", 3)]
    assert {r.k: r.s for r in ranking.last_wins(spark.createDataFrame([("a", 1, 0), ("a", 2, 1)], "k string, s int, q int"), ["k"], ["q"]).collect()} == {"a": 2}
    bad = ranking.inversions(spark.createDataFrame([(1, 1, 1.0), (1, 2, 0.5), (1, 3, 0.7)], "g int, i int, v double"), "i", "v", ["g"])
    assert bad.first().inversions == 1
    with pytest.raises(ValueError):
        lookups.require_none(df, "left over")
    with pytest.raises(ValueError):
        lookups.the_only_row(df, F.col("k") == "A", "A")
    with pytest.raises(ValueError):
        lookups.the_only_row(df, F.col("k") == "Z", "Z")


def test_boundaries_are_inclusive_where_they_should_be(spark):
    got = [one(spark, S.strained(F.lit(t), F.lit(s), F.lit(f))) for t, s, f in ((7.0, 0.0, False), (6.9, 1.8, False), (6.9, 1.7, False), (9.0, 9.0, True))]
    assert got == [True, True, False, None]
    rows = [("c", 1.0), ("c", -1.0)]
    z = cluster_stats.describe_clusters(spark.createDataFrame(rows, "c string, z double"), ["c"])
    assert z.first().trustworthy is False  # deviation 1.41
    one_ = cluster_stats.describe_clusters(spark.createDataFrame([("c", 1.0)], "c string, z double"), ["c"]).first()
    assert one_.std_z == 0.0 and one_.trustworthy is False
    judged = cluster_stats.judge_clusters(spark.createDataFrame([(1, -1.6449, True), (1, -1.6448, True), (4, -9.0, False)], "count long, mean_z double, trustworthy boolean"))
    assert [r.good for r in judged.orderBy("mean_z").collect()] == [True, False]
    p = cluster_stats.p_values(judged).orderBy("mean_z").first()
    assert p.p_value == pytest.approx(0.05, abs=1e-4)
    assert p.p_value == pytest.approx(0.5 * (1 + math.erf(p.t_stat / math.sqrt(2))), rel=1e-12)


def graph(spark, links, n):
    nodes = spark.createDataFrame([("g", i) for i in range(n)], "group string, node long")
    edges = spark.createDataFrame([("g", min(a, b), max(a, b), 10, 10) for a, b in links], "group string, a long, b long, inter int, uni int")
    return nodes, edges


def greedy(links, n):
    near = {i: set() for i in range(n)}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for v in sorted(range(n), key=lambda v: (-len(near[v]), v)):
        if v not in out:
            out[v] = v
            for w in near[v]:
                out.setdefault(w, v)
    return out


@pytest.mark.parametrize("links,n", [([(0, 1), (1, 2), (2, 3)], 4), ([(0, 1), (0, 2), (0, 3)], 4), ([(0, 1), (1, 2), (0, 2)], 4)])
def test_butina_small_graphs(spark, links, n):
    nodes, edges = graph(spark, links, n)
    for run in (clustering.butina_grouped, clustering.butina_rounds):
        assert {r.node: r.centroid for r in run(nodes, edges, (10,)).collect()} == greedy(links, n)


def test_butina_random_graph_invariants(spark):
    rng = random.Random(3)
    links = sorted({tuple(sorted(rng.sample(range(40), 2))) for _ in range(110)})
    nodes, edges = graph(spark, links, 40)
    got = {r.node: r.centroid for r in clustering.butina_rounds(nodes, edges, (10,)).collect()}
    assert got == greedy(links, 40)
    centres = set(got.values())
    assert all(n == c or tuple(sorted((n, c))) in links for n, c in got.items())
    assert not any(a in centres and b in centres for a, b in links)


def test_nested_groups_and_summary(spark):
    nodes = spark.createDataFrame([("small", i) for i in range(9)] + [("large", 100 + i) for i in range(10)], "group string, node long")
    edges = spark.createDataFrame([("small", 0, 1, 1, 20), ("large", 100, 101, 18, 20)], "group string, a long, b long, inter int, uni int")
    out = clustering.nested(nodes, edges, (10,), least=10)
    assert out.where("group = 'small'").select("centroid").distinct().count() == 1
    assert out.where("group = 'large'").select("centroid").distinct().count() == 9
    s = clustering.size_summary(out, ["k"], ["group", "centroid"]).first()
    assert (s.n_compounds, s.n_clusters, s.n_singletons, s.largest_cluster_size, s.median_cluster_size) == (19, 10, 8, 9, 1.0)
    assert s.top10_pct == 100.0


def test_similarity(spark):
    df = spark.createDataFrame([("g", 1, [0b1110]), ("g", 2, [0b0111]), ("g", 3, [0b1000]), ("h", 4, [0b1110])], "g string, n long, fp array<bigint>")
    e = similarity.edges(df, "g", "n", "fp", 10).collect()
    assert [(r.a, r.b, r.inter, r.uni) for r in e] == [(1, 2, 2, 4)]
    best = {r.n: r.max_tc for r in similarity.max_similarity(df, "n", "fp", df.where("n = 3"), "fp").collect()}
    assert best == pytest.approx({1: 1 / 3, 2: 0.0, 3: 1.0, 4: 1 / 3})
    bits = df.select(similarity.sign_bits(F.array(*[F.lit(x) for x in (1.0, -1.0, 0.0, 2.0)])).alias("b")).first().b
    assert bits == [0b1001]


def test_curves(spark):
    ys = [10, 9, 9, 7, 6, 6, 5, 3, 2, 2, 1, 0]
    df = spark.createDataFrame([(0.1 + 0.05 * i, float(y)) for i, y in enumerate(ys)], "t double, y double")
    s = curves.slopes(df, "t", "y")
    got = [(r.mid, r.slope) for r in s.orderBy("mid").collect()]
    want = [((0.1 + 0.05 * i + 0.1 + 0.05 * (i + 1)) / 2, (ys[i + 1] - ys[i]) / 0.05) for i in range(11)]
    assert got == [(pytest.approx(a), pytest.approx(b)) for a, b in want]
    rates = [-b for _, b in want]
    inner = next((want[i][0] for i in range(1, 10) if rates[i] < rates[i - 1] - 1e-9 and rates[i] < rates[i + 1] - 1e-9), want[0][0])
    assert curves.local_minimum(s).first().lower == pytest.approx(inner, abs=0.051)
    flat = curves.slopes(spark.createDataFrame([(0.1 * i, float(i * i)) for i in range(5)], "t double, y double"), "t", "y")
    assert curves.local_minimum(flat, climb=F.col("slope")).first().lower == pytest.approx(0.05)
    assert curves.half_maximum(flat).first().upper == pytest.approx(0.35)


def test_snap_of_midpoints(spark):
    grid = [k / 20 for k in range(7, 19)]
    for value, near in ((0.41, 0.4), (0.44, 0.45), (0.2, 0.35), (0.99, 0.9)):
        assert one(spark, curves.snap(F.lit(value), grid)) == near
    df = spark.createDataFrame([(0.43, 0.81), (0.46, 0.79)], "lower double, upper double")
    r = curves.intersection(df, grid).first()
    assert (r.lower, r.upper) == (0.45, 0.8)


def test_strain_precedence(spark):
    rows = [
        ("m", 1, 2, 3, 4, 5, 0, 1.0, True, False), ("m", 4, 3, 2, 1, 2, 1, 0.5, True, False),  # same four atoms: rule 2 wins
        ("m", 9, 2, 3, 4, 7, 2, 3.0, False, True), ("m", 8, 2, 3, 4, 7, 3, 0.7, True, False),  # same bond: specific, then highest
        ("m", 1, 5, 6, 7, 1, 4, 2.0, False, True),
    ]
    df = spark.createDataFrame(rows, "compound string, a1 int, a2 int, a3 int, a4 int, rule int, seq int, energy double, specific boolean, not_observed boolean")
    r = strain.combine_matches(df).first()
    assert (r.total, r.single, r.flagged, r.n_torsions) == (pytest.approx(2.7), 2.0, True, 2)
    names = spark.createDataFrame([("m",), ("rigid",)], "compound string")
    rep = {r.compound: r for r in strain.strain_report(names, df).collect()}
    assert rep["m"].strained is None and rep["m"].error == strain.FLAGGED and rep["rigid"].strained is None and rep["rigid"].n_torsions == 0 and rep["rigid"].error == strain.RIGID


def atom_line(n, atom, res, num, x=0.0, tail=True):
    field = f" {atom:<3}" if len(atom) < 4 else atom
    return f"ATOM  {n:5d} {field} {res:<3} A{num:4d}    {x:8.3f}{1.0:8.3f}{2.0:8.3f}" + (f"{0.5:6.2f}{9.25:6.2f}          {atom[:1]:>2}" if tail else "")


def test_receptor_target_and_gap(spark, tmp_path):
    text = [atom_line(2, "CG", "ASP", 116, 5.5), atom_line(4, "N", "LYS", 228), "REMARK", atom_line(5, "H", "LYS", 228), atom_line(6, "N", "LYS", 324), "TER", "HEADER"]
    (tmp_path / "r.pdb").write_text("\n".join(text) + "\n")
    lines = readers.read_receptor(spark, str(tmp_path / "r.pdb"))
    rec = receptor.atoms(lines)
    assert rec.count() == 4
    assert receptor.target_atom(rec, "ASP", 116, "CG").first().x == 5.5
    with pytest.raises(ValueError):
        receptor.target_atom(rec, "ASP", 117, "CG").first()
    got = [r.value for r in receptor.gap_lines(lines, 228).orderBy("seq").collect()]
    assert got == text[:4] + ["TER        "] + text[4:]  # not after line 2: a line that is no atom follows
    with pytest.raises(ValueError):
        receptor.gap_lines(lines, 324)


def test_receptor_caps_are_split_out(spark):
    """Two files at once; the second has sites without caps."""
    old = [
        "HEADER    x", "CRYST1",
        *[atom_line(9, a, "ASN", 24, i) for i, a in enumerate(("HY", "CAY", "HY1", "HY2", "HY3", "CY", "OY", "HY", "N", "HYX"))],
        atom_line(30, "CA", "GLY", 100), atom_line(31, "HY", "GLY", 100), "TER      31", "CONECT    9   10",
        *[atom_line(40, a, "SER", 245) for a in ("C", "NT", "CAT", "HT", "HAT1", "HAT2", "HAT3")],
        *[atom_line(50, a, "CYS", 316, tail=False) for a in ("CAY", "HAY1", "HAY2", "HAY3", "CY", "OY", "N")],
        *[atom_line(60, a, "GLN", 422) for a in ("NT", "CAT", "HNT", "HT1", "HT2")], atom_line(65, "CA", "GLN", 422),
        "END",
    ]
    other = [atom_line(7, "N", "ALA", 400), atom_line(3, "N", "ALA", 7)]
    rows = [("a", i, v) for i, v in enumerate(old)] + [("b", i, v) for i, v in enumerate(other)]
    lines = spark.createDataFrame(rows, "path string, line_no int, value string").repartition(3)
    got = receptor.capped_lines(lines, ["path"]).orderBy("seq").collect()

    def cap(n, name, res, num, x=0.0, occ=0.5, temp=9.25):
        field = f" {name:<3}" if len(name) < 4 else name
        return f"ATOM  {n:5d} {field} {res} A{num:4d}    {x:8.3f}{1.0:8.3f}{2.0:8.3f}{occ:6.2f}{temp:6.2f}          {name[:1]:>2}"

    want = ["HEADER    x", "CRYST1"]
    want += [cap(i + 1, n, "ACE", 23, i + 1) for i, n in enumerate(("CH3", "HH31", "HH32", "HH33", "C", "O"))]
    want += [atom_line(7, "N", "ASN", 24, 8), atom_line(8, "HYX", "ASN", 24, 9), atom_line(9, "CA", "GLY", 100), atom_line(10, "HY", "GLY", 100), atom_line(11, "C", "SER", 245)]
    want += [cap(12 + i, n, "NME", 246) for i, n in enumerate(("N", "CH3", "H", "HH31", "HH32", "HH33"))]
    want += ["TER      18"]
    want += [cap(18 + i, n, "ACE", 315, occ=1.0, temp=0.0) for i, n in enumerate(("CH3", "HH31", "HH32", "HH33", "C", "O"))]
    want += [atom_line(24, "N", "CYS", 316, tail=False), atom_line(25, "CA", "GLN", 422)]
    want += [cap(26 + i, n, "NME", 423) for i, n in enumerate(("N", "CH3", "H", "HH31", "HH32"))]
    want += ["TER      31", "END"]
    assert [r.value for r in got if r.path == "a"] == want
    assert [r.value for r in got if r.path == "b"] == [atom_line(1, "N", "ALA", 7), "TER       2", atom_line(2, "N", "ALA", 400), "TER       3", "END"]
    sizes = receptor.cap_sizes(receptor.route(receptor.atoms(lines)), ["path"]).collect()
    assert {(r.path, r.number): r.n for r in sizes} == {("a", 23): 6, ("a", 246): 6, ("a", 315): 6, ("a", 423): 5} | {("b", n): 0 for n in (23, 246, 315, 423)}
    assert sum(r.complete for r in sizes) == 3
    assert receptor.capped_lines(lines.limit(0), ["path"]).count() == 0
    for bad in (atom_line(1, "N", "ALA", 246), "ATOM      1  N   ALA A  x "):
        with pytest.raises(ValueError):
            receptor.capped_lines(spark.createDataFrame([("a", 0, bad)], lines.schema), ["path"])


def test_molecules():
    ring = [("C", *[float(i)] * 3) for i in range(6)] + [("N", 9.0, 9.0, 9.0)]
    bonds = [(i + 1, (i + 1) % 6 + 1, 1) for i in range(6)] + [(1, 7, 1)]
    mol = M.parse_block(block("m", ring, bonds, [(7, 1)]))
    assert mol.charges == {6: 1} and mol.symbols[6] == "N" and len(mol.bonds) == 7
    plain = M.parse_block(block("m", ring[:6], bonds[:6]))
    assert M.scaffold_key(mol) == M.scaffold_key(plain) != ""
    assert M.scaffold_key(M.parse_block(block("c", ring[:3], bonds[:2]))) == ""
    order = [3, 4, 5, 0, 1, 2]
    turned = M.parse_block(block("m", [ring[i] for i in order], [(order.index(a - 1) + 1, order.index(b - 1) + 1, o) for a, b, o in bonds[:6]]))
    assert M.fingerprint(plain) == M.fingerprint(turned) and M.fingerprint(plain) != M.fingerprint(mol)
    with pytest.raises(ValueError):
        M.parse_block("nothing")


def test_funnel_end_to_end(spark, tmp_path):
    def pose(x, charged, score):
        return block("m", [("N", x, 0.0, 0.0)], [], [(1, 1)] if charged else [], score)

    files = {
        "A_S1_T1": pose(3, True, -8.0) + pose(4, True, -9.0) + pose(9, True, -20.0),
        "A_S2_T1": pose(1, True, -10.0),
        "B": pose(5.0, True, -7.0),
        "C": pose(2, False, -9.0),
        "D": pose(6, True, -9.0),
        "E": pose(1, True, None),
        "F": "broken\n$$$$\n",
        "G": pose(1, True, -6.9),
        "H": "",
        "I": "broken\n$$$$\n" + pose(1, True, -6.95),
        "J": pose(1, True, -9.0) + pose(1, True, -9.0).replace("-9.0", "1.2.3"),
    }
    for name, text in files.items():
        (tmp_path / f"{name}.sdf").write_text(text)
    poses = readers.read_poses(spark, str(tmp_path))
    report, won = funnel.geometric_filter(poses, (0.0, 0.0, 0.0), expected=spark.createDataFrame([(c,) for c in files], "compound_id string"))
    got = {r.compound_id: (r.passed, r.error) for r in report.collect()}
    assert got["C"] == got["F"] == ("False", funnel.NO_CHARGE) and got["D"] == ("False", None) and got["H"] == ("False", funnel.NOTHING_READ)
    # A pose that cannot be parsed is passed over, the other decides; a score that is no number is the compound's error.
    assert got["I"] == ("True", None) and got["J"] == ("error", "could not convert string to float: '1.2.3'")
    assert {r.compound_id: r.pose_idx for r in won.collect()} == {"A_S1_T1": 1, "A_S2_T1": 0, "B": 0, "E": 0, "G": 0, "I": 1}
    moved = {r.compound_id: (r.text, r.moved) for r in funnel.moved_poses(poses, won).collect()}
    a, b, c = (pose(x, True, s) for x, s in ((3, -8.0), (4, -9.0), (9, -20.0)))
    assert moved["A_S1_T1"] == (b + a + c, True) and moved["B"] == (files["B"], False)
    won = won.where("compound_id <> 'I'")
    strains = spark.createDataFrame([(c, 1.0, 0.5, False) for c in files], "compound_id string, total double, single double, strained boolean")
    hits = funnel.hit_list(won, strains)
    assert [(r["rank"], r.compound_id) for r in hits.orderBy("rank").collect()] == [(1, "A_S2_T1"), (2, "B")]
    blocks = funnel.review_set(hits, poses)
    with pytest.raises(ValueError):
        funnel.review_set(hits, poses.where("compound_id <> 'B'"))
    writers.write_tagged_blocks(blocks, str(tmp_path / "out"), {"COMPOUND_ID": F.col("compound_id")}, per_file=1)
    back = readers.read_tagged(spark, str(tmp_path / "out" / "*"))
    assert sorted(r.properties["COMPOUND_ID"] for r in back.collect()) == ["A_S2_T1", "B"]
    feats = M.featurise(poses.where("pose_idx = 0")).collect()
    assert sum(r.fp is None for r in feats) == 2


def test_commands(spark, tmp_path, capsys):
    """The stages from the command line: filter, cutoff, dedup, caps, gap; a dry run writes nothing."""
    from sievespark import cli

    poses = tmp_path / "poses"
    for sub, name, score in (("a", "X_S1_T1", -8.0), ("b", "X_S2_T1", -9.0), ("b", "Y", -8.0), ("c", "Z", -5.0)):
        (poses / sub).mkdir(parents=True, exist_ok=True)
        (poses / sub / f"{name}.sdf").write_text(block("m", [("N", 9.0, 0.0, 0.0)], [], [(1, 1)], -20.0) + block("m", [("N", 1.0, 0.0, 0.0)], [], [(1, 1)], score))
    (tmp_path / "r.pdb").write_text("\n".join([atom_line(1, "CG", "ASP", 116, 0.0), atom_line(2, "N", "LYS", 228)]) + "\n")
    at = lambda n: str(tmp_path / n)
    text = (tmp_path / "r.pdb").read_text().replace("   1.000   2.000", "   0.000   0.000")
    (tmp_path / "r.pdb").write_text(text)
    cli.main(["filter", "--poses", str(poses), "--receptor", at("r.pdb"), "--out", at("dry"), "--dry-run"])
    assert not (tmp_path / "dry").exists() and "4 rows" in capsys.readouterr().out
    cli.main(["filter", "--poses", str(poses), "--receptor", at("r.pdb"), "--out", at("f")])
    hits = readers.read_stage_table(spark, "ranked_hits", at("f/ranked_hits")).orderBy("rank").collect()
    assert [(r["rank"], r.compound_id, r.winning_pose_score) for r in hits] == [(1, "X_S2_T1", -9.0), (2, "X_S1_T1", -8.0), (3, "Y", -8.0), (4, "Z", -5.0)]
    assert readers.read_stage_table(spark, "reordered_compounds", at("f/reordered_compounds")).where("winning_pose_index_0based = 1").count() == 4
    moved = spark.read.parquet(at("f/passed")).where("compound_id = 'Z'").first()
    assert moved.moved and moved.text.index("-5.0") < moved.text.index("-20.0")
    final = spark.createDataFrame([(r["rank"], r.compound_id, r.winning_pose_score, 1.0, 0.5) for r in hits], "rank long, compound_id string, ad4_score double, total_TEU double, single_TEU double")
    writers.write_csv(final, "final_hits", at("hits"))
    cli.main(["cutoff", "--hits", at("hits"), "--out", at("cut"), "--cutoff", "-7"])
    cli.main(["dedup", "--hits", at("cut"), "--out", at("one")])
    assert [(r["rank"], r.compound_id) for r in readers.read_stage_table(spark, "final_hits", at("one")).orderBy("rank").collect()] == [(1, "X_S2_T1"), (2, "Y")]
    with pytest.raises(ValueError):
        cli.main(["cutoff", "--hits", at("hits"), "--out", at("none"), "--cutoff", "-70"])
    cli.main(["gap", "--receptor", at("r.pdb"), "--out", at("gap"), "--last", "116"])
    assert [r.value for r in spark.read.text(at("gap")).collect()] == [*text.splitlines()[:1], "TER        ", *text.splitlines()[1:]]
    cli.main(["caps", "--receptor", at("r.pdb"), "--out", at("caps")])
    assert [r.value[:3] for r in spark.read.text(at("caps")).collect()] == ["ATO", "ATO", "TER", "END"]


def test_files_in_order(spark, tmp_path):
    import tarfile

    for n, names in (("part00", "abc"), ("part01", "de")):
        (tmp_path / f"{n}.sdf").write_text("".join(f"{c}\nM  END\n>  <COMPOUND_ID>\n{c}\n\n$$$$\n" for c in names))
    back = readers.read_tagged(spark, str(tmp_path / "part*.sdf"), key="COMPOUND_ID", numbered=True)
    assert [r.properties["COMPOUND_ID"] for r in back.orderBy("seq").collect()] == list("abcde") and back.agg(F.max("seq")).first()[0] == 5
    with pytest.raises(ValueError):
        readers.read_tagged(spark, str(tmp_path / "part*.sdf"), key="ROLE")
    assert readers.first_match(spark, str(tmp_path / "part*.sdf")).endswith("part00.sdf")
    with pytest.raises(FileNotFoundError):
        readers.first_match(spark, str(tmp_path / "no*.sdf"))
    df = spark.createDataFrame([("b.sdf", "two"), ("a.sdf", "één")], "name string, text string")
    assert writers.write_archive(df, str(tmp_path / "x.tar.gz"), extra={"r.pdb": "TER"}) == 3
    with tarfile.open(tmp_path / "x.tar.gz") as tar:
        assert [(m.name, tar.extractfile(m).read().decode()) for m in tar] == [("r.pdb", "TER"), ("a.sdf", "één"), ("b.sdf", "two")]
    rows = spark.createDataFrame([("c1", 0.5, 10)], "conformation string, tc double, n_clusters long")
    for first in (True, True, False):
        writers.add_to_stage_table(rows, "q2_cluster_counts", str(tmp_path / "q2"), first)
    assert spark.read.parquet(str(tmp_path / "q2")).count() == 2
    writers.write_single_file(back.withColumn("rank", -F.col("seq")), str(tmp_path / "one"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "one").rglob("part-*")))
    assert [line for line in text.splitlines() if len(line) == 1][::2] == list("edcba")


def test_stream_hands_over_new_files_once(spark, tmp_path):
    from sievespark import streaming

    seen = []
    for name in ("a", "b"):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{name}.sdf").write_text(block(name, [("N", 1.0, 0.0, 0.0)], [], [(1, 1)], -5.0))
        streaming.new_poses(spark, str(tmp_path / "in"), lambda df, n: seen.extend(r.compound_id for r in df.collect()), str(tmp_path / "ck")).awaitTermination()
    assert seen == ["a", "b"]


def test_torsion_rules(spark, tmp_path):
    (tmp_path / "t.xml").write_text('<library><hierarchyClass name="GG"><torsionRule smarts="g" method="exact"/></hierarchyClass><hierarchyClass name="CO"><hierarchySubClass><torsionRule smarts="a" method="approximate"><angleList><angle theta_0="0" tolerance2="30" beta_1="1" beta_2="2"/></angleList></torsionRule></hierarchySubClass><torsionRule smarts="b" method="exact"><histogram_converted><bin energy="1" lower="0" upper="2"/></histogram_converted></torsionRule></hierarchyClass></library>')
    rules = readers.read_torsion_rules(spark, str(tmp_path / "t.xml")).orderBy("rule").collect()
    assert [r.smarts for r in rules] == ["a", "b", "g"] and rules[0].angles[0].tolerance2 == 30.0 and rules[1].bins[0].energy == 1.0


def test_rescoring(spark):
    picks = spark.createDataFrame([("c1", f"m{i}", i // 2, "cluster" if i else "singleton") for i in range(6)], "conformation string, compound_id string, chunk int, source string")

    def scorer(row):
        if row["compound_id"] == "m3":
            raise RuntimeError("x" * 400)
        if row["compound_id"] == "m4":
            raise TimeoutError
        return -float(row["compound_id"][1:])

    out = rescoring.rescore(picks, scorer)
    rows = {r.compound_id: r for r in out.collect()}
    assert rows["m2"].mmgbsa_dg == -2.0 and rows["m4"].error == "timeout" and rows["m3"].error == "exception: " + "x" * 400
    good, bad = rescoring.split_results(out)
    assert good.count() == 4 and bad.count() == 2
    assert rescoring.rescore(picks, scorer, done=out).count() == 2
    assert sorted(r.chunk for r in rescoring.drop_failed_chunks(out, "chunk").collect()) == [0, 0]


def test_external_program(spark, tmp_path):
    """A stand-in program: score from the record, or one of the four kinds of failure; each compound once."""
    script = tmp_path / "score.sh"
    script.write_text('echo x >> "$3"\ncase "$(cat $1)" in ok*) printf "status,TOTAL\\nS,-12.5\\n" > $2;; bad*) printf "status,TOTAL\\nF,1\\n" > $2;; word*) printf "status,TOTAL\\nS,x\\n" > $2;; slow*) sleep 20;; *) echo oops >&2; exit 3;; esac\n')
    rows = [("c", k, k) for k in ("ok", "bad", "word", "slow", "none")]
    calls = tmp_path / "calls"
    scorer = rescoring.external_scorer(lambda record, result, row: ["sh", str(script), record, result, str(calls)], timeout=3)
    out = rescoring.rescore(spark.createDataFrame(rows, "conformation string, compound_id string, block string"), scorer, rows_per_task=2)
    got = {r.compound_id: (r.mmgbsa_dg, r.error) for r in out.collect()}
    assert got["ok"] == (-12.5, None) and got["slow"] == (None, "timeout") and got["none"] == (None, "no_output_rc3: oops\n")
    assert got["bad"][1] == "bad_status: {'status': 'F', 'TOTAL': '1'}" and got["word"][1] == "exception: could not convert string to float: 'x'"
    rescoring.secondary_rank(out.where("mmgbsa_dg is not null").withColumn("ad4", F.lit(1.0)), "mmgbsa_dg", "ad4").collect()
    assert len(calls.read_text().split()) == 5


def test_scaffolds_tell_graphs_apart():
    def mol(n, bonds, doubles=()):
        return M.Molecule(["C"] * n, [(0.0, 0.0, 0.0)] * n, [(a, b, 2 if (a, b) in doubles else 1) for a, b in bonds])

    ring = lambda at, k: [(at + i, at + (i + 1) % k) for i in range(k)]
    decalin = mol(10, [*ring(0, 6), (0, 6), (6, 7), (7, 8), (8, 9), (9, 1)])
    bicyclopentyl = mol(10, [*ring(0, 5), *ring(5, 5), (0, 5)])
    assert M.scaffold_key(decalin) != M.scaffold_key(bicyclopentyl)  # colour refinement alone gives one key
    hexane, ketone = mol(6, ring(0, 6)), mol(7, [*ring(0, 6), (0, 6)], {(0, 6)})
    assert M.scaffold_key(mol(7, [*ring(0, 6), (0, 6)])) == M.scaffold_key(hexane) != M.scaffold_key(ketone)
    assert M.scaffold_key(mol(4, [(0, 1), (1, 2), (2, 3)])) == ""
    prisms = mol(6, [*ring(0, 3), *ring(3, 3), (0, 3), (1, 4), (2, 5)]), mol(6, [(a, b) for a in range(3) for b in range(3, 6)])  # both cubic on six atoms
    assert M.scaffold_key(prisms[0]) != M.scaffold_key(prisms[1])
    rng = random.Random(5)
    for m in (decalin, bicyclopentyl, ketone, *prisms):
        for _ in range(5):
            order = rng.sample(range(len(m.symbols)), len(m.symbols))
            turned = M.Molecule(m.symbols, m.xyz, [(order[a], order[b], o) for a, b, o in rng.sample(m.bonds, len(m.bonds))])
            assert M.scaffold_key(turned) == M.scaffold_key(m)


def flat(symbols, bonds, charges=()):
    return block("m", [(s, float(i), 0.0, 0.0) for i, s in enumerate(symbols)], [(a + 1, b + 1, o) for a, b, o in bonds], [(i + 1, c) for i, c in charges])


def kekule(k, at=0):
    return [(at + i, at + (i + 1) % k, 2 if i % 2 == 0 else 1) for i in range(k)]


@pytest.mark.parametrize(
    "mol,smarts,count",
    [
        ("benzene", "c1ccccc1", 1), ("benzene", "C1CCCCC1", 0), ("benzene", "[c:1]:[c:2]", 6), ("benzene", "[cH1]", 6), ("benzene", "[R1]", 6), ("benzene", "[r6]", 6), ("benzene", "[r5]", 0),
        ("cyclohexane", "C1CCCCC1", 1), ("cyclohexane", "c", 0), ("cyclohexane", "C@C", 6), ("cyclohexane", "C!@C", 0), ("cyclohexane", "[CX4;H2]", 6), ("cyclohexane", "[^3]", 6),
        ("pyrrole", "[nH]", 1), ("pyrrole", "n", 1), ("pyrrole", "[#7;a]", 1), ("naphthalene", "c1ccc2ccccc2c1", 1), ("naphthalene", "[R2]", 2), ("naphthalene", "[x3]", 2),
        ("amide", "[CX3](=O)[NX3]", 1), ("amide", "[O:1]=[C:2]-[N:3]-[C:4]", 1), ("amide", "[$([CX3]=O)]", 1), ("amide", "[!$([CX3]=O);#6]", 2), ("amide", "C[N,O]", 2), ("amide", "[C,N]=O", 1), ("amide", "C#N", 0), ("amide", "C~[!#6]", 3),
        ("ammonium", "[N+]", 1), ("ammonium", "[N+;X4]", 1), ("ammonium", "[NX3]", 0), ("ammonium", "[#1]", 1), ("ammonium", "[H][N+]", 1), ("quinone", "c", 0), ("quinone", "C=O", 2), ("ester", "O=C-O-C", 1), ("ester", "C(=O)(O)C", 1),
    ],
)
def test_patterns(mol, smarts, count):
    made = {
        "benzene": flat("CCCCCC", kekule(6)),
        "cyclohexane": flat("CCCCCC", [(i, (i + 1) % 6, 1) for i in range(6)]),
        "pyrrole": flat("NCCCC", [(0, 1, 1), (1, 2, 2), (2, 3, 1), (3, 4, 2), (4, 0, 1)]),
        "naphthalene": flat("CCCCCCCCCC", [*kekule(6), (5, 6, 1), (6, 7, 2), (7, 8, 1), (8, 9, 2), (9, 0, 1)]),
        "amide": flat("CCONC", [(0, 1, 1), (1, 2, 2), (1, 3, 1), (3, 4, 1)]),
        "ammonium": flat("CNH", [(0, 1, 1), (1, 2, 1)], [(1, 1)]),
        "quinone": flat("CCCCCCOO", [(0, 1, 1), (1, 2, 2), (2, 3, 1), (3, 4, 1), (4, 5, 2), (5, 0, 1), (0, 6, 2), (3, 7, 2)]),
        "ester": flat("CCOOC", [(0, 1, 1), (1, 2, 2), (1, 3, 1), (3, 4, 1)]),
    }
    assert len(patterns.find(made[mol], [smarts])) == count


def test_patterns_that_cannot_be_read_are_passed_over():
    got = patterns.find(flat("CCCC", [(0, 1, 1), (1, 2, 1), (2, 3, 1)]), ["[Q]", "C(", "CCCC", "[C"])
    assert got == [(2, (0, 1, 2, 3))]


def test_strain_from_molecules(spark):
    """Match by an injected matcher, measure, energy, precedence, verdict."""
    def bent(angle):
        t = math.radians(angle)
        return [("C", 1.0, 0.0, 0.0), ("C", 0.0, 0.0, 0.0), ("C", 0.0, 0.0, 1.0), ("C", math.cos(t), math.sin(t), 1.0)]

    chain = [(1, 2, 1), (2, 3, 1), (3, 4, 1)]
    poses = [("g60", block("g", bent(60), chain)), ("g100", block("g", bent(100), chain)), ("rigid", block("r", bent(0)[:3], chain[:2])), ("broken", "x\n$$$$\n"), ("short", block("s", bent(5), chain)), ("long", block("l", bent(7), chain))]
    rules = spark.createDataFrame(
        [
            (0, "CC", "CCCC", "exact", [{"energy": float(k), "lower": 0.0, "upper": 0.0} for k in range(36)], []),
            (1, "GG", "*", "approximate", [], [{"theta_0": 60.0, "tolerance2": 10.0, "beta_1": 0.01, "beta_2": 0.0}]),
        ],
        "rule int, class string, smarts string, method string, bins array<struct<energy:double,lower:double,upper:double>>, angles array<struct<theta_0:double,tolerance2:double,beta_1:double,beta_2:double>>",
    )

    def matcher(text, patterns):
        assert patterns == ["CCCC", "*"]
        if text.startswith("s"):
            return [(0, (0, 1))]
        if text.startswith("l"):
            return [(0, (0, 1, 2, 3, 0))]
        return [(1, (0, 1, 2, 3)), (0, (3, 2, 1, 0))] if "V2000" in text and text.startswith("g") else []

    got = {r.compound: r for r in strain.strain_of_poses(spark.createDataFrame(poses, "compound string, block string"), rules, matcher).collect()}
    theta = strain.match_torsions(spark.createDataFrame(poses[:1], "compound string, block string"), rules, matcher).collect()
    assert sorted(abs(r.theta) for r in theta) == pytest.approx([60.0, 60.0], abs=0.01)
    # The same four atoms: the first rule wins; at 60 degrees the histogram of 0 .. 35 gives about 23 or 11.
    assert got["g60"].n_torsions == 1 and got["g60"].total == pytest.approx(17 + theta[0].theta / 10) and got["g60"].strained is True
    assert got["rigid"].error == got["long"].error == strain.RIGID and got["broken"].error == strain.NOT_PARSED and "tuple index" in got["short"].error
    only = rules.where("rule = 1").withColumn("rule", F.lit(0))
    loose = {r.compound: r for r in strain.strain_of_poses(spark.createDataFrame(poses[:2], "compound string, block string"), only, lambda t, p: [(0, (0, 1, 2, 3))]).collect()}
    assert loose["g100"].flagged and loose["g100"].strained is None and loose["g100"].error == strain.FLAGGED
    # The same by the module's own patterns.
    own = rules.withColumn("smarts", F.when(F.col("rule") == 0, "[CH3:1][C:2]!@[CX4:3][C:4]").otherwise("[*:1]~[*:2]~[*:3]~[*:4]"))
    mine = {r.compound: r for r in strain.strain_of_poses(spark.createDataFrame(poses, "compound string, block string"), own).collect()}
    assert mine["g60"].total == pytest.approx(got["g60"].total) and mine["rigid"].error == strain.RIGID and mine["broken"].error == strain.NOT_PARSED
    back = {r.compound: r.not_observed for r in strain.match_torsions(spark.createDataFrame(poses[:2], "compound string, block string"), only, lambda t, p: [(0, (0, 1, 2, 3))]).collect()}
    assert back["g100"] and back["g60"] == (theta[0].theta < 0)


def test_clusters_end_to_end(spark):
    """Pose blocks to picks, against the stages written as plain loops."""
    rng = random.Random(8)

    def ring(k, tail, symbol="C"):
        atoms = [("C", float(i), 0.0, 0.0) for i in range(k)] + [(symbol if i == tail - 1 else "C", 0.0, float(i), 1.0) for i in range(tail)]
        bonds = [(i + 1, (i + 1) % k + 1, 1) for i in range(k)] + [(1 if i == 0 else k + i, k + i + 1, 1) for i in range(tail)]
        return block("m", atoms, bonds)

    rows = []
    for conf in ("c1", "c5"):
        blocks = [ring(6, 1 + i % 9, rng.choice("CNO")) for i in range(30)] + [ring(5, i) for i in range(4)] + [block("m", [("C", 0.0, 0.0, 0.0)] * 2, [(1, 2, 1)])] * 2 + ["broken\n$$$$\n"]
        tails = [1 + i % 9 for i in range(30)] + [rng.randint(1, 9) for _ in blocks[30:]]
        blocks = [b for _, b in sorted(zip(tails, blocks), key=lambda x: x[0] + rng.random())]  # alike in structure, alike in score
        scores = sorted(rng.gauss(-8, 1.5) for _ in blocks[:-1]) + [-3.0]
        scores[0] -= 1  # an outlier
        rows += [(conf, f"{conf}m{i}", i + 1, s, b) for i, (s, b) in enumerate(zip(scores, blocks))]
    hits = spark.createDataFrame(rows, "conformation string, compound_id string, rank int, ad4_score double, block string").repartition(5)
    grid = (7, 10, 12, 15)
    out = clusters.cluster_hits(hits, M.Backend(lambda b: M.fingerprint(M.parse_block(b))), grid=grid, least=10, picked=15, lone_cut=-1.0)
    got = {(r.conformation, r.k, r.compound_id): r.cluster_id for r in out.members.collect()}
    tc = lambda a, b: sum((x & y & ((1 << 64) - 1)).bit_count() for x, y in zip(a, b)) / sum(((x | y) & ((1 << 64) - 1)).bit_count() for x, y in zip(a, b))
    want, stats, fps = {}, {}, {}
    for conf in ("c1", "c5"):
        mine = [r for r in rows if r[0] == conf]
        groups = {}
        for _, cid, rank, _, b in mine:
            try:
                m = M.parse_block(b)
                fps[cid], key = M.fingerprint(m), M.scaffold_key(m)
            except ValueError:
                key = "__ERROR__" + cid
            groups.setdefault(key, []).append((rank, cid))
        for k in grid:
            next_id = 0
            for members in [g for g in groups.values() if len(g) < 10]:
                want |= {(conf, k, c): next_id for _, c in members}
                next_id += 1
            for members in [g for g in groups.values() if len(g) >= 10]:
                links = [(a, b) for i, (a, x) in enumerate(members) for b, y in members[i + 1 :] if round(tc(fps[x], fps[y]) * 1e9) >= round(k / 20 * 1e9)]
                near = {a: set() for a, _ in members}
                for a, b in links:
                    near[a].add(b)
                    near[b].add(a)
                centre, ids = {}, {}
                for v in sorted(near, key=lambda v: (-len(near[v]), v)):
                    if v not in centre:
                        centre[v] = v
                        for w in near[v]:
                            centre.setdefault(w, v)
                for rank, cid in members:
                    if centre[rank] not in ids:
                        ids[centre[rank]] = next_id
                        next_id += 1
                    want[conf, k, cid] = ids[centre[rank]]
        values = [r[3] for r in mine]
        mean = sum(values) / len(values)
        std = math.sqrt(sum((x - mean) ** 2 for x in values) / len(values))
        stats |= {r[1]: (r[3], (r[3] - mean) / std, r[2]) for r in mine}
    assert got == want
    for r in out.summary.collect():
        sizes = {}
        for (conf, k, _), c in want.items():
            if (conf, k) == (r.conformation, r.k):
                sizes[c] = sizes.get(c, 0) + 1
        ordered = sorted(sizes.values())
        assert (r.n_compounds, r.n_clusters, r.n_singletons, r.largest_cluster_size) == (37, len(sizes), ordered.count(1), ordered[-1])
        assert r.median_cluster_size == (ordered[(len(ordered) - 1) // 2] + ordered[len(ordered) // 2]) / 2
        assert r.top10_pct == pytest.approx(100 * sum(ordered[-10:]) / 37) and r.mean_cluster_size == pytest.approx(37 / len(sizes))
    picks = set()
    for conf in ("c1", "c5"):
        sets = {}
        for (c, k, cid), n in want.items():
            if (c, k) == (conf, 15):
                sets.setdefault(n, []).append(cid)
        for n, cids in sets.items():
            z = [stats[c][1] for c in cids]
            m = sum(z) / len(z)
            if len(cids) == 1:
                if z[0] <= -1.0:
                    picks.add((conf, "singleton", n, cids[0], "singleton_outlier"))
                continue
            sd = math.sqrt(sum((x - m) ** 2 for x in z) / (len(z) - 1))
            if sd < 1.0 and round(m, 4) * math.sqrt(len(z)) <= S.GOOD_T:
                cids.sort(key=lambda c: stats[c][2])
                known = [c for c in cids if c in fps]
                roles = {min(cids, key=lambda c: stats[c][0]): ["best_scorer"]}
                roles.setdefault(max(known, key=lambda c: (round(sum(tc(fps[c], fps[d]) for d in known if d != c) / max(1, len(known) - 1), 12), -stats[c][2])), []).append("medoid")
                picks |= {(conf, "cluster", n, c, "+".join(r)) for c, r in roles.items()}
    assert {(r.conformation, r.source, r.cluster_id, r.compound_id, r.roles) for r in out.picks.collect()} == picks and len(picks) > 3
    assert {(r.conformation, r.cluster_id) for r in out.kept.collect()} == {p[:1] + p[2:3] for p in picks if p[1] == "cluster"}
    assert out.groups.where("conformation = 'c1' and bm_group_id = 0").first()["size"] == 30 and out.groups.count() == 8
    b = out.bounds.first()
    assert b.lower <= b.upper and out.per_cluster.count() > 0 and out.judged.count() <= out.per_cluster.count()
    tagged = clusters.tagged_picks(out.picks, hits).select(S.property_map(F.col("block")).alias("p")).collect()
    assert {r.p["COMPOUND_ID"] for r in tagged} == {p[3] for p in picks} and {r.p["SOURCE"] for r in tagged} <= {"cluster", "singleton"}


def test_large_groups_go_by_rounds(spark, monkeypatch):
    monkeypatch.setattr(clustering, "GROUP", 20)
    rng = random.Random(9)
    links = sorted({tuple(sorted(rng.sample(range(40), 2))) for _ in range(110)})
    nodes, links_ = graph(spark, links, 40)
    nodes = nodes.unionByName(spark.createDataFrame([("s", 0), ("s", 1)], nodes.schema))
    got = {r.node: r.centroid for r in clustering.butina(nodes, links_, (10,)).where("group = 'g'").collect()}
    assert got == greedy(links, 40)


def test_blocks_of_edges_and_references(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 7)
    rng = random.Random(10)
    fps = {i: rng.getrandbits(64) & rng.getrandbits(64) for i in range(60)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([("g" if i < 50 else "h", i, [signed(x)]) for i, x in fps.items()], "g string, n long, fp array<bigint>")
    want = {(a, b) for a in fps for b in fps if a < b and (a < 50) == (b < 50) and 20 * (fps[a] & fps[b]).bit_count() >= 6 * (fps[a] | fps[b]).bit_count()}
    assert sorted((r.a, r.b) for r in similarity.edges(df, "g", "n", "fp", 6).collect()) == sorted(want)
    best = {r.n: r.max_tc for r in similarity.max_similarity(df, "n", "fp", df.where("n % 3 = 0"), "fp").collect()}
    assert best == pytest.approx({a: max((x & y).bit_count() / (x | y).bit_count() for b, y in fps.items() if b % 3 == 0) for a, x in fps.items()})


def test_tied_scores_are_ranked_in_parts(spark):
    rows = [("x" if i % 10 else None, 1.0, i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, s double, i int").repartition(6)
    got = {(r.g, r.i): r["rank"] for r in ranking.ranked(df, ["s", "i"], ["g"]).collect()}
    for g in ("x", None):
        assert [got[g, i] for k, _, i in rows if k == g] == list(range(1, 1 + sum(k == g for k, _, _ in rows)))
    bad = [(g, i, rng_) for g, rng_list in (("a", [1.0, 3.0, 2.0, 2.0, 5.0, None, 1.0]), ("b", list(map(float, range(200)))), ("c", list(map(float, range(200, 0, -1))))) for i, rng_ in enumerate(rng_list)]
    got = {r.g: r.inversions for r in ranking.inversions(spark.createDataFrame(bad, "g string, i int, v double").repartition(5), "i", "v", ["g"]).collect()}
    assert got == {"a": 1, "b": 0, "c": 199}
    with pytest.raises(ValueError):
        ranking.require_sorted(spark.createDataFrame(bad, "g string, i int, v double"), "i", "v", ["g"])
    with pytest.raises(ValueError):
        ranking.require_some(df.limit(0), "hits")


def test_pick_list_merges_roles(spark):
    m = spark.createDataFrame([("c", 1, "a", -9.0, -2.0), ("c", 1, "b", -8.0, -1.0), ("c", 1, "d", -7.0, -1.4), ("c", 2, "e", -9.5, -2.2)], "conformation string, cluster_id int, compound_id string, ad4_score double, z double")
    good = spark.createDataFrame([("c", 1, 3, -1.45), ("c", 2, 1, -2.2)], "conformation string, cluster_id int, count long, mean_z double")
    out = selection.pick_list(m, good, m.limit(0), ["conformation", "cluster_id"]).collect()
    assert sorted((r.compound_id, r.roles) for r in out) == [("a", "best_scorer"), ("d", "medoid"), ("e", "best_scorer+medoid")]


# ---- selection


@pytest.mark.parametrize("bracket", [10, 1_000_000])
def test_quantiles_by_selection(spark, bracket):
    """Groups of skew, ties, one value, nulls and NaN alone, against numpy."""
    from sievespark.operators import quantiles

    rng = random.Random(7)
    rows = [("wide", rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300), 1.0) for _ in range(3000)]
    rows += [("ties", float(rng.choice([3, 3, 3, 3, rng.random()])), None) for _ in range(2001)] + [("one", 5.0, 2.0)]
    rows += [("none", None, None), ("none", float("nan"), None), (None, 1.0, 7.0), (None, 2.0, float("nan")), (None, -4.0, 8.0)]
    df = spark.createDataFrame(rows, "g string, a double, b double")
    got = {(r.g, r.of, r.share): r.value for r in quantiles.quantiles(df, ["a", "b"], [0.0, 0.25, 0.5, 1.0], ["g"], bracket).collect()}
    for g in {r[0] for r in rows}:
        for k, c in ((1, "a"), (2, "b")):
            own = sorted(r[k] for r in rows if r[0] == g and r[k] is not None and r[k] == r[k])
            for q in (0.0, 0.25, 0.5, 1.0):
                assert got[g, c, q] == (pytest.approx(float(np.quantile(own, q))) if own else None)


def test_share_cut_ranks_ties_alone(spark):
    from sievespark.operators.ranking import share_cut

    rng = random.Random(3)
    rows = [(g, rng.choice([1.0, 2.0, 2.0, 2.0, rng.random(), None, float("nan")]), i, "x", "y") for g in ("a", "b", None) for i in range(157)]
    df = spark.createDataFrame(rows, "g string, s double, i long, rank string, at string")
    key = lambda r: (r[1] is None, r[1] is not None and r[1] != r[1], r[1] if r[1] is not None and r[1] == r[1] else 0, r[2])
    for share in (0.0, 0.01, 0.3, 0.6, 1.0):
        want = []
        for g in ("a", "b", None):
            own = sorted((r for r in rows if r[0] == g), key=key)
            want += [(g, r[2]) for r in own[: math.ceil(len(own) * share)]]
        got = share_cut(df, share, ["s", "i"], ["g"])
        assert got.columns == df.columns and sorted(((r.g, r.i) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert share_cut(df, 0.5, ["rank", "i"]).count() == 236 and share_cut(df.limit(0), 0.5, ["s"]).count() == 0


def test_helper_columns_leave_the_users_alone(spark):
    from sievespark.operators import ranking
    from sievespark.operators.rescoring import best_per_cluster

    df = spark.createDataFrame([(1, 2.0, 7, 8, 9, "s", "a"), (1, 1.0, 4, 5, 6, "s", "b")], "k int, v double, __n int, at int, slot int, source string, compound_id string")
    more = df.withColumns({c: F.lit(c) for c in ("place", "n", "first", "shift", "won", "__at", "__slot")})
    assert ranking.best_per_key(more, ["k"], [F.col("v")]).columns == more.columns
    assert ranking.ranked(more, ["v"]).columns == [*more.columns, "rank"]
    assert {r["at"] for r in ranking.ranked(more, ["v"], ["k"]).collect()} == {8, 5}
    assert best_per_cluster(more, ["k"], "v").columns == more.columns
    assert ranking.last_wins(more.withColumn("row", F.lit(1)), ["k"], ["v"]).first()["__n"] == 7


# ---- similarity in blocks


def random_fps(rng, n, bits, size, words):
    """Fingerprints with some common and many rare bits, near copies among them."""
    out = []
    for _ in range(n):
        if out and rng.random() < 0.3:
            own = set(rng.choice(out)) ^ set(rng.sample(range(bits), rng.randint(0, 2)))
        else:
            own = {b for b in (int(rng.paretovariate(0.4)) - 1 for _ in range(rng.randint(0, size))) if b < bits} | set(rng.sample(range(bits), rng.randint(0, 3)))
        out.append(sorted(own))
    packed = []
    for own in out:
        w = [0] * words
        for b in own:
            w[b // 64] |= 1 << (b % 64)
        packed.append([x - (1 << 64) if x >> 63 else x for x in w])
    return out, packed


def tanimoto(a, b):
    return len(set(a) & set(b)), len(set(a) | set(b))


@pytest.mark.parametrize("t, block", [(6, 4096), (12, 7), (17, 7), (20, 7), (1, 50)])
def test_edges_of_both_plans(spark, monkeypatch, t, block):
    monkeypatch.setattr(similarity, "BLOCK", block)
    rng = random.Random(t)
    sets, packed = random_fps(rng, 120, 256, 20, 4)
    df = spark.createDataFrame([(f"g{i % 3}", i, f) for i, f in enumerate(packed)] + [(None, 500, packed[0]), ("g0", 501, None), ("g1", 1, packed[1])], "grp string, id long, fp array<long>")
    want = set()
    for a in range(120):
        for b in range(a + 1, 120):
            inter, uni = tanimoto(sets[a], sets[b])
            if a % 3 == b % 3 and inter * 20 >= uni * t:
                want.add((f"g{a % 3}", a, b, inter, uni))
    for plan in ("blocks", "bits", "auto"):
        got = [tuple(r) for r in similarity.edges(df, "grp", "id", "fp", t, plan).collect()]
        assert set(got) == want and (block < 4096 or len(got) >= len(want))


def test_prefixes_bring_few_pairs_together(spark):
    rng = random.Random(9)
    sets = [rng.sample(range(2048), 50) for _ in range(400)]
    packed = [[sum(1 << (b % 64) for b in s if b // 64 == w) for w in range(32)] for s in sets]
    packed = [[x - (1 << 64) if x >> 63 else x for x in p] for p in packed]
    rows = spark.createDataFrame([("g", i, p) for i, p in enumerate(packed)], "group string, node long, fp array<long>").withColumn("n", similarity.bit_count(F.col("fp")))
    listed = similarity.prefixes(rows, 17, similarity._bit_order(rows))
    met = sum(r["c"] * (r["c"] - 1) // 2 for r in listed.groupBy("token").agg(F.count(F.lit(1)).alias("c")).collect())
    assert listed.count() == 400 * (50 - 43 + 1) and met < 400 * 399 / 2 / 10


@pytest.mark.parametrize("block", [4096, 10])
def test_highest_similarity_visits_near_counts(spark, monkeypatch, block):
    monkeypatch.setattr(similarity, "BLOCK", block)
    rng = random.Random(block)
    sets, packed = random_fps(rng, 150, 128, 40, 2)
    df = spark.createDataFrame([(i, f) for i, f in enumerate(packed[:60])] + [(99, None)], "id long, fp array<long>")
    refs = spark.createDataFrame([(f,) for f in packed[60:]] + [(None,)], "r array<long>")
    want = {i: max(x / y if y else 0.0 for x, y in (tanimoto(sets[i], r) for r in sets[60:])) for i in range(60)}
    got = {r.id: r.max_tc for r in similarity.max_similarity(df, "id", "fp", refs, "r").collect()}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i]) for i in want)
    assert similarity.max_similarity(df, "id", "fp", refs.limit(0), "r").count() == 0


def medoid_by_hand(sets, nodes):
    sims = {n: sum(x / y if y else 0.0 for m in nodes if m != n for x, y in [tanimoto(sets[n], sets[m])]) for n in nodes}
    return min(nodes, key=lambda n: (-round(sims[n], 9), n))


@pytest.mark.parametrize("block", [4096, 16])
def test_medoids_without_pairs(spark, block):
    rng = random.Random(5)
    sets, packed = random_fps(rng, 200, 128, 30, 2)
    of = {i: None if i < 20 else "big" if i < 140 else f"c{i % 25}" for i in range(200)}
    rows = [(of[i], i % 2, i, f, "x") for i, f in enumerate(packed)] + [("empty", 0, 900, None, "x"), ("lone", 1, 901, packed[0], "x")]
    df = spark.createDataFrame(rows, "c string, d long, node long, fp array<long>, place string")
    got = {(r.c, r.d): r.medoid for r in similarity.cluster_medoids(df, ["c", "d"], block=block).collect()}
    want = {k: medoid_by_hand(sets, [i for i in range(200) if (of[i], i % 2) == k]) for k in {(of[i], i % 2) for i in range(200)}}
    assert got == {**want, ("lone", 1): 901}


def test_medoid_of_a_large_cluster(spark):
    """20,000 members: blocks against blocks, after the bound has dropped most; the centre is planted."""
    rng = np.random.default_rng(6)
    bits = np.zeros((20_000, 128), np.uint8)
    bits[:, :64] = 1
    for i in range(1, 20_000):  # flips around the centre, the more the further on
        flips = rng.choice(128, size=int(rng.integers(1, 60)), replace=False)
        bits[i, flips] ^= 1
    words = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
    df = spark.createDataFrame([(1, i, [int(x) for x in w]) for i, w in enumerate(words.tolist())], "c int, node long, fp array<long>")
    assert similarity.cluster_medoids(df, ["c"]).first().medoid == 0


def test_symmetric_scaffolds_have_keys():
    """Rings of rings, cages and unions of equal parts: the same key however they are numbered."""
    rng = random.Random(1)
    graphs = []
    for n in (6, 20, 60):
        graphs.append([(i, (i + 1) % n) for i in range(n)])
    graphs.append([(i, j) for i in range(9) for j in range(9, 18)])  # complete bipartite
    graphs.append([(6 * k + i, 6 * k + (i + 1) % 6) for k in range(8) for i in range(6)])  # eight rings apart
    cube = [(a, a ^ 1 << k) for a in range(64) for k in range(6) if a < a ^ 1 << k]
    graphs.append(cube)
    graphs.append([(0, 6 * k + 1) for k in range(10)] + [(6 * k + 1 + i, 6 * k + 1 + (i + 1) % 6) for k in range(10) for i in range(6)])  # ten rings on one atom
    keys = []
    for edges in graphs:
        nodes = sorted({x for e in edges for x in e})
        found = set()
        for _ in range(3):
            name = dict(zip(nodes, rng.sample(nodes, len(nodes))))
            near = {i: set() for i in nodes}
            for a, b in edges:
                near[name[a]].add(name[b])
                near[name[b]].add(name[a])
            found.add(M.canonical_edges(near))
        assert len(found) == 1
        keys.append(found.pop())
    assert len(set(keys)) == len(graphs)


def test_features_fail_apart(spark):
    def broken(block):
        raise ValueError("no")

    df = spark.createDataFrame([("x",)], "block string")
    for tool, want in ((M.Backend(lambda b: [1], broken), ([1], None)), (M.Backend(broken, lambda b: "k"), (None, "k"))):
        r = M.featurise(df, tool).first()
        assert (r.fp, r.scaffold) == want


# ---- numbers as text


def test_significant_digits_as_python_writes_them(spark):
    rng = random.Random(12)
    values = [0.0, -0.0, 1.0, -1.5, 1e-4, 9.9999949e-5, 99999.95, 999999.5, 999998.5, 1234565.0, 1234575.0, 100000.0, 1e16, 1e22, 2.3e-308, 1.7e308, float("inf"), float("-inf"), float("nan"), 0.1, 0.30000000000000004, 2.675, 1e-38]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(40_000)]
    values += [float(f"{rng.choice(['', '-'])}{rng.randint(10**5, 10**6 - 1)}5e{rng.randint(-40, 20)}") for _ in range(50_000)]  # halves in decimals
    values += [rng.randint(1, 10**8) / 2 ** rng.randint(0, 30) for _ in range(20_000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(-1, None)], "i int, v double").repartition(4)
    got = {r.i: (r.a, r.b) for r in df.select("i", S.significant(F.col("v")).alias("a"), S.significant(F.col("v"), 3).alias("b")).collect()}
    assert got.pop(-1) == (None, None)
    wrong = [(v, got[i]) for i, v in enumerate(values) if got[i] != (f"{v:g}", f"{v:.3g}")]
    assert wrong == []


def test_rounds_store_fewer_links_each_time(spark):
    rng = random.Random(17)
    nodes = [(g, i) for g in ("x", "y") for i in range(150)]
    edges = [(g, a, b, rng.randint(1, 20), 20) for g in ("x", "y") for a in range(150) for b in range(a + 1, 150) if rng.random() < (0.08 if g == "x" else 0.02)]
    nd, ed = spark.createDataFrame(nodes, "group string, node long"), spark.createDataFrame(edges, "group string, a long, b long, inter int, uni int")
    want = sorted(map(tuple, clustering.butina_grouped(nd, ed, (2, 8, 14)).select("group", "k", "node", "centroid").collect()))
    for rest in (0, 200, 10**9):
        stored = []
        got = clustering.butina_rounds(nd, ed, (2, 8, 14), rest, stored)
        assert sorted(map(tuple, got.select("group", "k", "node", "centroid").collect())) == want
        assert (stored == []) == (rest == 10**9) and all(b < a for a, b in zip(stored, stored[1:]))
        if rest == 0:
            assert stored[0] == sum(e[3] >= k for e in edges for k in (2, 8, 14)) and stored[1] < stored[0] / 2


# ---- contacts


def test_neighbours_by_cells(spark):
    from sievespark.operators import contacts

    rng = random.Random(4)
    p = [(i, *(rng.uniform(-9, 9) for _ in range(3))) for i in range(150)] + [(900, None, 1.0, 1.0)]
    q = [(f"r{i}", *(rng.uniform(-9, 9) for _ in range(3))) for i in range(150)] + [("none", 0.0, None, 0.0)] + [("edge", p[0][1] + 2.5, p[0][2], p[0][3])]
    points, atoms = spark.createDataFrame(p, "cell int, u double, v double, w double"), spark.createDataFrame(q, "name string, x double, y double, z double")
    want = {(a[0], b[0]) for a in p for b in q if None not in a and None not in b and math.dist(a[1:], b[1:]) <= 2.5}
    for limit in (contacts.STRUCTURE, 10):
        old, contacts.STRUCTURE = contacts.STRUCTURE, limit
        try:
            got = contacts.neighbours(points, atoms, ["u", "v", "w"], ["x", "y", "z"], 2.5, ["name"])
            assert {(r.cell, r.name) for r in got.collect()} == want and got.columns == ["cell", "u", "v", "w", "name", "distance"]
        finally:
            contacts.STRUCTURE = old
    with pytest.raises(ValueError):
        contacts.moved(F.lit(1), F.lit(1), F.lit(1), ((1, 0, 0),))


def test_group_contacts_of_poses(spark):
    from sievespark.operators import contacts

    def record(shift):
        atoms = [("C", 0.0), ("C", 1.5), ("N", 2.66)]
        lines = ["m", "", "", "  3  2  0  0  0  0  0  0  0  0999 V2000"]
        lines += [f"{x + shift:10.4f}{0:10.4f}{0:10.4f} {s:<3} 0  0" for s, x in atoms]
        return "\n".join([*lines, "  1  2  1  0", "  2  3  3  0", "M  END", "$$$$", ""])

    poses = spark.createDataFrame([("a", record(0.0)), ("b", record(10.0)), ("c", "no record"), ("d", record(0.0).replace("  2  3  3", "  2  3  1"))], "compound_id string, block string")
    groups = contacts.group_atoms(poses)
    assert sorted((r.compound_id, round(r.ax, 2), round(r.bx, 2)) for r in groups.collect()) == [("a", 1.5, 2.66), ("b", 11.5, 12.66)]
    atoms = spark.createDataFrame([(2.66, 3.0, 0.0, "SER", 7), (2.66, -3.0, 0.0, "ASP", 7), (2.66, 3.0, 0.0, "GLY", 9)], "x double, y double, z double, resname string, resnum int")
    got = {r.compound_id: r for r in contacts.group_contacts(groups, ["compound_id"], atoms, ((0, 0, 0), (0, 1, 0))).collect()}
    assert (got["a"].residue, got["a"].distance, got["a"].contact, round(got["a"].angle, 6)) == ("ASP7", 3.0, True, 90.0)
    assert (got["b"].residue, got["b"].contact) == (None, False)


def test_environments_in_columns(spark):
    """The same environments as the row-wise form tells apart, however the atoms are numbered; bad records say why."""
    from sievespark.chem import tables

    rng = random.Random(23)
    records = {}
    for k in range(30):
        n = rng.randint(1, 14)
        atoms = [(rng.choice("CCCNOS"), *(round(rng.uniform(-5, 5), 3) for _ in range(3))) for _ in range(n)]
        bonds = [(rng.randint(1, i), i + 1, rng.choice([1, 1, 2, 3])) for i in range(1, n)] + ([(1, n, 1)] if n > 3 else [])
        charges = [(i + 1, rng.choice([-1, 1])) for i in range(n) if rng.random() < 0.15]
        order = rng.sample(range(n), n)
        place = {old + 1: new + 1 for new, old in enumerate(order)}
        records[k] = block("m", atoms, bonds, charges)
        records[k + 100] = block("m", [atoms[i] for i in order], [(place[b], place[a], o) for a, b, o in bonds], [(place[a], c) for a, c in charges]).replace("\n", "\r\n")
    df = spark.createDataFrame(list(records.items()), "id int, block string")
    t = tables.connection_table(F.col("block"))
    got = {r.id: r for r in df.select("id", t.alias("t"), tables.environments(t).alias("e"), tables.folded(tables.environments(t), 256).alias("w")).collect()}

    def rowwise(text):
        mol = M.parse_block(text)
        near = mol.neighbours()
        codes = [M._hash(s, len(near[i]), mol.charges.get(i, 0)) for i, s in enumerate(mol.symbols)]
        found = set(codes)
        for level in (1, 2):
            codes = [M._hash(level, codes[i], tuple(sorted((o, codes[j]) for j, o in near[i]))) for i in range(len(codes))]
            found |= set(codes)
        return found

    own = {k: rowwise(v) for k, v in records.items()}
    for k, r in got.items():
        mol = M.parse_block(records[k])
        assert [(a.symbol, a.charge, a.x, a.y, a.z) for a in r.t.atoms] == [(s, mol.charges.get(i, 0), *xyz) for i, (s, xyz) in enumerate(zip(mol.symbols, mol.xyz))]
        assert [tuple(b) for b in r.t.bonds] == mol.bonds and r.t.error is None
        assert len(set(r.e)) == len(r.e) == len(own[k]) and set(got[k % 100].e) == set(r.e)
        assert sum(bin(w & (1 << 64) - 1).count("1") for w in r.w) == len({c % 256 for c in r.e}) and len(r.w) == 4
    for a in range(30):
        for b in range(a):
            assert len(set(got[a].e) & set(got[b].e)) == len(own[a] & own[b])
    good = records[3]
    bad = {0: (None, tables.NO_COUNTS), 1: ("", tables.NO_COUNTS), 2: (good[: good.index("V2000") + 30], tables.CUT_OFF), 3: (good.replace("V2000", "V3000"), tables.NO_COUNTS)}
    n = int(good.splitlines()[3][:3])
    bad[4] = ("\n".join([*good.splitlines()[:4], "nonsense", *good.splitlines()[5:]]), tables.NO_NUMBER)
    assert n
    rows = spark.createDataFrame([(i, x) for i, (x, _) in bad.items()], "id int, block string").select("id", t.alias("t"), tables.folded(tables.environments(t)).alias("w")).collect()
    assert {r.id: (r.t.error, r.t.atoms, r.w) for r in rows} == {i: (why, None, None) for i, (_, why) in bad.items()}


def test_a_pattern_with_very_many_matches():
    """More than a thousand matches of one pattern are all there."""
    star = block("m", [("C", 0.0, 0.0, 0.0)] + [("F", float(i), 1.0, 0.0) for i in range(60)], [(1, i + 2, 1) for i in range(60)])
    assert len(patterns.find(star, ["FCF"])) == 60 * 59 // 2
