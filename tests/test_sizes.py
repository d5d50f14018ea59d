"""Queries and steps on inputs that the smallest tables do not hold."""

import random
import re

import duckdb
import pytest

import __spark_entry__ as entry


def both(spark, folder, name, **tables):
    """Rows of a query over ``tables``, by Spark and by its SQL."""
    con = duckdb.connect()
    for t, df in tables.items():
        df.write.parquet(f"{folder}/{t}.parquet")
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    want = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    got = entry.queries()[name](spark, str(folder)).select(*names).collect()
    return sorted(map(repr, map(tuple, got))), sorted(map(repr, want.fetchall()))


def test_blocks_of_texts_with_dollars(spark, tmp_path):
    texts = ["one$$$\ntwo$$$$ three\n$\n", "$$$$$\n$$$$", "\x01a\x01b$\n\x01", "plain", "", "\n\n \n", None]
    got, want = both(spark, tmp_path, "block_splitter", documents=spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert got == want and len(got) == 11


def bits(rng, n):
    words = [rng.getrandbits(64) & (rng.getrandbits(64) | rng.getrandbits(64)) for _ in range(n)]
    return [[x - (1 << 64) if x >> 63 else x] for x in words]


def test_clusters_of_fingerprints_as_of_links(spark, monkeypatch):
    """Counts and clusters without links are those of the links, in blocks and batches of any size."""
    from sievespark.operators import clustering, similarity

    rng = random.Random(5)
    rows = [("a", i, f) for i, f in enumerate(bits(rng, 600))] + [("b", 1000 + i, f) for i, f in enumerate(bits(rng, 40))] + [("c", 2000, [0]), ("c", 2001, [0]), ("c", 2002, [5]), ("d", 3000, [7]), ("d", 3001, None)]
    df = spark.createDataFrame(rows, "group string, node long, fp array<bigint>").repartition(3).cache()
    grid = (5, 8, 11)
    links = similarity.edges(df, "group", "node", "fp", 5).cache()
    ordered = lambda d, *c: sorted(map(tuple, d.select(*c).collect()))
    degree, cluster = ("group", "k", "node", "degree"), ("group", "k", "node", "centroid")
    degrees = ordered(clustering.degrees(df.select("group", "node"), links, grid), *degree)
    clusters = ordered(clustering.butina_grouped(df.select("group", "node"), links, grid), *cluster)
    assert ordered(clustering.degrees_of_fingerprints(df, grid), *degree) == degrees
    assert ordered(clustering.butina_of_fingerprints(df, grid), *cluster) == clusters
    monkeypatch.setattr(similarity, "BLOCK", 90)
    assert ordered(clustering.degrees_of_fingerprints(df, grid), *degree) == degrees
    assert ordered(clustering.butina_of_fingerprints(df, grid, batch=64, first=8), *cluster) == clusters


@pytest.mark.parametrize("name", ["butina_clusters", "butina_by_rounds", "nested_assignment", "medoid_per_cluster", "degree_per_threshold"])
def test_clusters_write_no_links(spark, monkeypatch, name):
    from sievespark.operators import similarity

    def none(*a, **k):
        raise AssertionError("links are quadratic in a group")

    monkeypatch.setattr(similarity, "edges", none)
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").columns


def test_edges_come_a_strip_at_a_time():
    import pyarrow as pa

    from sievespark.operators import similarity

    n, schema = 1000, pa.schema([("group", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("inter", pa.int32()), ("uni", pa.int32())])
    table = pa.table({"group": pa.array([1] * n, pa.int32()), "node": list(range(n)), "fp": [[3]] * n, "n": [2] * n, "own": [0] * n, "i": [0] * n, "j": [0] * n})
    found = [b.num_rows for b in similarity._compared(table, 10, schema)]
    assert sum(found) == n * (n - 1) // 2 and max(found) <= similarity.ROWS * n


def test_nearest_without_pairs(spark, monkeypatch):
    """The nearest atom and its ties as all pairs give them, inside a dense structure, beside it and far off."""
    from sievespark.operators import contacts

    rng = random.Random(8)
    p = [(i, *(rng.uniform(-8, 12) for _ in range(3))) for i in range(400)] + [(900, None, 1.0, 1.0), (901, 40.0, 0.0, 0.0), (902, 1.0, 1.0, 1.0)]
    q = [(f"r{i % 7}", i, *(round(rng.uniform(-3, 4), 1) for _ in range(3))) for i in range(900)] + [("b", 5, 1.0, 1.0, 1.25), ("a", 5, 1.0, 1.0, 0.75), ("none", 6, None, 0.0, 0.0)]
    points, atoms = spark.createDataFrame(p, "i int, u double, v double, w double"), spark.createDataFrame(q, "name string, number int, x double, y double, z double")
    want = {}
    for i, *a in p:
        met = [(d, n, name) for name, n, *b in q if None not in a and None not in b and (d := sum((x - y) ** 2 for x, y in zip(a, b)) ** 0.5) <= 3.0]
        want[i] = min(met, default=(None, None, None))
    pairs = []
    monkeypatch.setattr(contacts, "neighbours", lambda *a, **k: pairs.append(a))
    monkeypatch.setattr(contacts, "LISTED", 4)
    got = contacts.nearest(points, atoms, ["u", "v", "w"], ["x", "y", "z"], 3.0, ["number", "name"]).select("i", "nearest.*").collect()
    assert len(got) == len(p) and pairs == []
    for r in got:
        d, n, name = want[r.i]
        assert (r.number, r.name) == (n, name) and (r.distance == pytest.approx(d) if n is not None else r.distance is None)


def test_poses_are_read_where_they_have_charges(spark):
    """Each compound's outcome is that of reading every block; blocks without charges are not read, and none is grouped."""
    from pyspark.sql import functions as F

    from sievespark.chem import molblock, tables
    from sievespark.plans import funnel

    def pose(x, charge="M  CHG  1   1   1\n", score="-8.0", name="m"):
        return f"{name}\n\n\n  1  0  0  0  0  0  0  0  0  0999 V2000\n{x:>10}    0.0000    0.0000 N   0  0\n{charge}M  END\n> <R>\nENERGY= {score}\n\n$$$$\n"

    near, none = pose("3.0000"), pose("3.0000", "")
    files = {
        1: [near], 2: [near.replace("\n", "\r\n")], 3: [none], 4: [none, near], 5: [pose("6.0000"), none], 6: [pose("x")], 7: [pose("x", "")], 8: [pose("x"), near], 9: [None],
        10: [none.replace("M  END\n", "M  END\nM  CHG  1   1   1\n")], 11: [pose("3.0000", "", name="M  CHG  1   1   1")], 12: [pose("3.0000", "M  CHG  1   1  -1\n")], 13: ["M  CHG  1   1   1\nENERGY= 1.2.3"], 14: [None, near],
    }
    scores = ["1.2.3", "..", ".", "-.", "-.5", "1.", "-1.5", "7", "-", "", "0." + "1" * 400, "-..5", "--1", "1.2.3d"]
    files |= {100 + i: [pose("3.0000", score=s)] for i, s in enumerate(scores)} | {200: [near, pose("9.0000", "", "4.5.6"), pose("9.0000", "", "1.2.3")]}

    def outcome(blocks):
        found, broken = [], []
        for b in filter(None, blocks):
            m = re.search(r"ENERGY=\s*(-?[\d.]+)", b)
            try:
                float(m.group(1) if m else 0)
            except ValueError:
                broken.append(m.group(1))
            try:
                mol = molblock.parse_block(b)
            except ValueError:
                continue
            found += [abs(xyz[0]) for i, (s, xyz) in enumerate(zip(mol.symbols, mol.xyz)) if s == "N" and mol.charges.get(i, 0) > 0]
        why = f"could not convert string to float: '{broken[0]}'" if broken else funnel.NOTHING_READ if not any(blocks) else None if found else funnel.NO_CHARGE
        return "error" if broken else str(any(d <= 5 for d in found)), why

    rows = [(c, i, b, None) for c, blocks in files.items() for i, b in enumerate(blocks)]
    poses = spark.createDataFrame(rows, "compound_id int, pose_idx int, block string, score double").repartition(3)
    report, won = funnel.geometric_filter(poses, (0.0, 0.0, 0.0))
    got = {r.compound_id: (r.passed, r.error) for r in report.collect()}
    assert got == {c: outcome(blocks) for c, blocks in files.items()}
    assert {r.compound_id: r.pose_idx for r in won.collect()} == {c: next(i for i, b in enumerate(files[c]) if b and "3.0000" in b and "CHG" in b) for c, (p, _) in got.items() if p == "True"}
    grouped = [x for x in report._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate [" in x]
    assert len(grouped) == 1 and "block" not in grouped[0]
    read = {(r.compound_id, r.pose_idx): r.atoms for r in molblock.describe_poses(poses, wanted=tables.maybe_charged(F.col("block"))).collect()}
    assert read[3, 0] is read[4, 0] is read[7, 0] is read[9, 0] is None and len(read[4, 1]) == len(read[2, 0]) == 1


@pytest.mark.parametrize("name", ["tier_table", "cluster_stats_q3", "pick_list_q5"])
def test_pools_are_not_dealt_to_a_task_each(spark, tmp_path, name):
    """Rows stay where they are when they meet their pool, however large it is; rows as by the SQL, with a pool of single clusters and one without good ones."""
    rng = random.Random(15)
    orders = [(i, rng.choice([1, 1, 1, *range(2, 90)]), rng.choice("FOP"), rng.choice(["1-URGENT", "2-HIGH"]), round(rng.uniform(1000, 300000), 2)) for i in range(1500)]
    orders += [(i, i, "F", "3-ALONE", round(rng.uniform(1000, 300000), 2)) for i in range(2000, 2040)] + [(3000 + i, i // 2, "O", "4-NONE", 1000.0 * (i // 2 % 2) + i / 7) for i in range(8)]
    orders += [(4000 + i, 500 + i // 20, "O", "5-GOOD", round(100000.0 * (i // 20) + rng.uniform(0, 9000), 2)) for i in range(100)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where a pool's rows are many
    try:
        got, want = both(spark, tmp_path, name, orders=spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_totalprice double"))
        plan = entry.queries()[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want and len(got) > 0
    if name == "tier_table":
        assert len(got) == 5 and plan.count("FileScan") == 2 and "Join" in plan
    assert not re.search(r"Join \[conformation#\d+\], \[conformation#\d+\], Inner\n", plan + "\n"), plan


def test_released_shuffle_files_go(spark):
    """At once, not at the next release: what a written table was dealt by must not fill the disk beside it."""
    import time

    from sievespark import session

    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    for _ in range(2):
        session.release(spark)
        time.sleep(1)
    before = files()
    table = session.cut_lineage(spark.range(10_000).repartition(8, "id").mapInArrow(lambda b: b, "id long"))
    assert files() > before
    session.release(spark, wait=0.5)
    for _ in range(20):
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before
    assert table.count() == 10_000


def test_written_edges_are_small(spark, tmp_path):
    """Edges are more than anything they come from, so their order has to suit what they are written to."""
    rng = random.Random(3)
    rows = [(0, rng.getrandbits(40), [rng.choice((-1.0, 1.0)) for _ in range(64)]) for _ in range(1200)]
    spark.createDataFrame(rows, "label int, vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    entry.queries()["tanimoto_edges"](spark, str(tmp_path)).write.parquet(f"{tmp_path}/out")
    edges = spark.read.parquet(f"{tmp_path}/out").count()
    assert edges > 400_000
    assert sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet")) < 3 * edges


def test_similarities_round_as_in_sql(spark):
    """All fractions of up to 64 bits."""
    got = spark.range(1, 65).selectExpr("id as uni", "explode(sequence(0L, id)) as inter").selectExpr("round(inter / uni, 6) as want", "((2000000L * inter + uni) div (2 * uni)) / 1e6D as got", "inter", "uni").collect()
    con = duckdb.connect()
    assert len(got) == 2144
    for r in got:
        assert r["got"] == r["want"] == con.execute(f"select round({r['inter']}::bigint / {r['uni']}::bigint, 6)").fetchone()[0]
