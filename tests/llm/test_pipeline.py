"""The pipeline's stages against brute force, and its registration."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sievespark.llm import queries, sharding
from test_operators import brute_components, brute_hits, prose


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(21)
    words = ["kala mato suri pelo tani vero luma nasi robe dila", "brung stett wopp krix dorf halm zwick pfau quell rand"]
    rows = []
    for i in range(150):
        k = i % 2
        rows.append((i, prose(rng, rng.randint(8, 60), words[k]), ("xx", "yy")[k], f"src{i % 4}", 0))
    item = prose(rng, 15, words[0])
    rows += [(200 + i, rows[i][1] if i % 3 else rows[i][1] + " extra", rows[i][2], "src1", 0) for i in range(40)]
    rows += [(300 + i, prose(rng, 10, words[0]) + " " + item, "xx", "src2", 0) for i in range(5)]
    rows += [(400, None, None, None, None), (401, "", "xx", None, 0), (402, "12 34", None, "src0", 0)]
    at = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("n_chars", F.length("text").cast("long")).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at), rows, [(1, item)]


def test_stages(spark, tables, tmp_path):
    sf_dir, rows, items = tables
    start = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs, held = start, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        held[name] = [r.asDict() for r in docs.collect()]
        if name != "shard":
            assert docs.columns == start.columns
    ids = lambda name: sorted(r["doc_id"] for r in held[name])
    assert ids("language_id") == sorted(r[0] for r in rows if r[0] < 400)
    whole = [(r["doc_id"], r["text"]) for r in held["language_id"]]
    assert ids("near_dedup") == sorted(d for d, _, c in brute_components(whole, 5) if d == c)
    whole = [(r["doc_id"], r["text"]) for r in held["near_dedup"]]
    assert ids("decontaminate") == sorted(h[0] for h in brute_hits(whole, items) if not h[5])
    assert not set(ids("decontaminate")) & set(range(300, 305))
    sizes, got = {}, {}
    for name, into in (("decontaminate", sizes), ("mix", got)):
        for r in held[name]:
            into[r["source"]] = into.get(r["source"], 0) + len(r["text"].split())
    from sievespark.llm.mixing import targets

    order = sorted(sizes)
    want = targets([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5 * sum(sizes.values()), 2)
    half = max(len(r["text"].split()) for r in held["decontaminate"]) / 2 + 1  # whole documents only
    assert all(abs(got.get(s, 0) - w) <= half for s, w in zip(order, want))
    assert {r["text"] for r in held["mix"]} <= {r["text"] for r in held["decontaminate"]}
    table = sharding.lookup_table(corpus_pipeline.SHARDS)
    assert len(held["shard"]) == len(held["mix"]) and all(r["shard"] == corpus_pipeline.SHARDS[table[r["slot"]]] for r in held["shard"])
    run = corpus_pipeline.run(spark, sf_dir)
    key = lambda r: (r["doc_id"], r["text"], r["shard"])
    assert sorted(key(r.asDict()) for r in run.collect()) == sorted(map(key, held["shard"]))


def test_every_operator_has_one_query():
    names = list(queries.queries())
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)


def test_op1_whole_table(spark, tables):
    out = queries.op1_mix(spark, tables[0])
    assert out.count() == len(tables[1])


@pytest.mark.parametrize("kind", ["empty", "nulls", "repeats"])
def test_stages_on_tables_without_much_in_them(spark, tables, kind):
    """No rows; rows of nulls and texts without words; rows that repeat an id, or have none."""
    rows = {
        "empty": [],
        "nulls": [(None, None, None, None, None)] * 3 + [(1, "", None, None, 0), (2, "12 34", None, "s", 5)],
        "repeats": [(None, "kala mato suri pelo", "xx", "a", 1)] * 4 + [(7, "kala mato suri pelo", "xx", None, 3), (7, "tani vero luma", "xx", None, 3)],
    }[kind]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("__row", F.lit("x")).withColumn("r", F.lit(1))
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables[0])
        assert name == "shard" or docs.columns == names
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect())
    if kind != "repeats":
        assert got == []
    else:  # of an id's two texts one stays, rows without an id are documents of their own; sources are filled with second copies
        assert set(got) <= {(True, 0), (False, 7)} and 4 <= len(got) <= 10


def test_stages_keep_columns_of_every_kind(spark, tables, tmp_path):
    """Maps, variants and structs with odd names pass through all stages, written and read again."""
    start = spark.read.parquet(f"{tables[0]}/documents.parquet")
    docs = start.withColumns({"m": F.create_map(F.lit("k"), F.col("doc_id")), "v": F.parse_json(F.concat(F.lit('{"a": '), F.col("doc_id"), F.lit("}"))), "odd": F.struct(F.col("doc_id").alias("a b"), F.lit("x").alias("c.d"), F.array(F.struct(F.lit(1).alias("`"))).alias("e")), "hits": F.lit(1), "c0": F.lit("y")})
    docs = docs.union(docs.where("doc_id < 20"))
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, tables[0]).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns[: len(names)] == names
        bad = docs.where((F.col("m")["k"] != F.col("doc_id")) | (F.variant_get("v", "$.a", "long") != F.col("doc_id")) | (F.col("odd")["a b"] != F.col("doc_id")))
        assert docs.count() > 20 and bad.count() == 0
