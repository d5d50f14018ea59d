"""Poses in buckets, and resuming by content."""

import os

import pytest
from pyspark.sql import functions as F

from sievespark.sources import ledger, pose_store


def poses(spark, n=400):
    rows = [(c, f"m{i}", k, f"block {c} {i} {k}") for c in ("c1", "ref/1", "c 5") for i in range(n) for k in range(2)]
    return spark.createDataFrame(rows, "conformation string, compound_id string, pose_idx int, block string")


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "poses")
    pose_store.write_store(poses(spark), path, buckets=16)
    return path


def test_pose_side_is_not_moved(spark, store):
    held = pose_store.PoseStore(spark, store)
    big = held.poses().select("conformation", "compound_id", "pose_idx").withColumn("ad4_score", F.lit(1.0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = held.fetch(big.where("pose_idx = 1"))
        assert out.count() == 1200 and out.columns == ["conformation", "compound_id", "pose_idx", "ad4_score", "block"]
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        assert [line for line in plan.splitlines() if "Exchange" in line and "compound_id" not in line] == []
        assert sum("Exchange" in line for line in plan.splitlines()) == 1  # the hits go to the buckets
        grouped = held.poses().groupBy("compound_id").count()
        assert grouped.count() == 400 and "Exchange" not in grouped._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        held.close()


def test_few_hits_read_few_files(spark, store):
    held = pose_store.PoseStore(spark, store)
    hits = spark.createDataFrame([("ref/1", "m7", 1, -9.0), ("ref/1", "m8", 0, -8.0), ("c1", "m7", 0, -7.0), ("c 5", "none", 0, -7.0), (None, "m7", 0, 1.0), ("ref/1", "m7", 9, 2.0)], "conformation string, compound_id string, pose_idx int, ad4_score double")
    files = held.files(hits)
    assert 0 < len(files) <= 4 and all("ref%2F1" in f or "c1" in f or "c 5" in f or "c%205" in f for f in files)
    out = held.fetch(hits)
    assert sorted((r.compound_id, r.block) for r in out.collect()) == [("m7", "block c1 7 0"), ("m7", "block ref/1 7 1"), ("m8", "block ref/1 8 0")]
    read = {f.rsplit("/", 1)[-1] for f in out.inputFiles() if "poses/" in f}
    assert read == {f.rsplit("/", 1)[-1] for f in files}
    assert held.fetch(hits.limit(0)).count() == 0
    held.close()


def test_a_store_is_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    for n in (5, 3):
        pose_store.write_store(poses(spark, n), path, buckets=2)
    held = pose_store.PoseStore(spark, path)
    assert held.poses().count() == 18
    held.close()


# ---- ledger


def put(folder, **files):
    for name, text in files.items():
        with open(f"{folder}/{name}.sdf", "w") as f:
            f.write(text)


@pytest.fixture
def bench(spark, tmp_path):
    files, tried = tmp_path / "in", []
    files.mkdir()
    put(files, a="one", b="two", c="bad", d=" ")

    def work(open_):
        rows = open_.select("path", F.decode("content", "utf-8").alias("text"))
        tried.append(sorted(os.path.basename(r.path)[0] for r in rows.collect()))
        some = rows.where("text <> ' '")
        return some.select("path", F.length("text").alias("n"), F.when(F.col("text") == "bad", "no number").alias("error"))

    def go(**parameters):
        book = ledger.Ledger(spark, str(tmp_path / "book"), **parameters)
        again = parameters.pop("again", True)
        book.run(ledger.listed(spark, str(files)), work, again)
        rows = book.results(ledger.listed(spark, str(files)))
        return {os.path.basename(r.path)[0]: r.n for r in rows.collect()}

    return files, tried, go, str(tmp_path / "book")


def test_changed_new_failed_and_deleted_files(spark, bench):
    files, tried, go, folder = bench
    assert go(cut=1) == {"a": 3, "b": 3} and tried[-1] == ["a", "b", "c", "d"]
    assert go(cut=1) == {"a": 3, "b": 3} and tried[-1] == ["c"]  # only what failed; a file without rows is done
    put(files, b="three", e="new!!!")
    os.remove(files / "a.sdf")
    assert go(cut=1) == {"b": 5, "e": 6} and tried[-1] == ["b", "c", "e"]
    put(files, c="good")
    assert go(cut=1) == {"b": 5, "c": 4, "e": 6} and tried[-1] == ["c"]
    assert go(cut=1) == {"b": 5, "c": 4, "e": 6} and tried[-1] == []
    assert go(cut=2) == {"b": 5, "c": 4, "e": 6} and tried[-1] == ["b", "c", "d", "e"]  # other parameters
    before = len(ledger.Ledger(spark, folder).batches())
    ledger.Ledger(spark, folder, cut=2).compact()
    assert before == 5 and len(ledger.Ledger(spark, folder).batches()) == 1
    assert go(cut=2) == {"b": 5, "c": 4, "e": 6} and tried[-1] == []


def test_batches_are_there_as_a_whole_or_not(spark, bench, monkeypatch):
    files, tried, go, folder = bench
    book = ledger.Ledger(spark, folder, cut=1)

    def broken(open_):
        return open_.select("path", F.raise_error(F.lit("lost")).cast("int").alias("n"), F.lit(None).cast("string").alias("error"))

    with pytest.raises(Exception):
        book.run(ledger.listed(spark, str(files)), broken)
    assert book.batches() == [] and book.results() is None and book.entries().count() == 0
    os.makedirs(f"{folder}/_batch-left/entries")  # what a lost driver leaves is passed over
    assert go(cut=1) == {"a": 3, "b": 3}
    entries = book.entries().limit(1).select("path", "length", "digest", "error")
    monkeypatch.setattr(book, "batches", lambda: [])
    with pytest.raises(RuntimeError):
        book.commit(entries, None)  # a run that did not see the other's batch
    assert go(cut=1) == {"a": 3, "b": 3}
    put(files, c="still bad"[6:])
    assert tried[-1] == ["c"]
