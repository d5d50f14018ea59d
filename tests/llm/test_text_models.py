"""Ranked search, the Merkle manifest and language-model scores against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievespark.llm import lm_score, manifest, ranked_search

#: Extra columns named like what the operators make inside.
EXTRA = ("id", "size", "terms", "times", "item", "rank", "score", "of", "no", "part", "tree", "idx", "key", "digest", "depth", "block", "path", "radix_group", "n", "start", "chunk", "row", "words", "counts", "held", "held_out", "seg", "c", "w")
LOWER = {i: i + 32 for i in range(65, 91)}


def docs(spark, rows):
    """rows: (doc_id, text[, lang])."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in EXTRA]])
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or ""), *["x"] * len(EXTRA)) for r in rows], schema)


def prose(rng, n, words="the of And in to it Was thát be is 42 x"):
    return " ".join(rng.choice(words.split()) + rng.choice(["", "", "", "er", "ing", "S"]) + rng.choice(["", "", ",", ".\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = [(i, prose(rng, rng.randint(1, 80)), rng.choice(["a", "a", "a", "b", None, "é"])) for i in range(200)]
    out += [(300, None, "a"), (301, "", "b"), (302, " \n\t", None), (303, "wordy Word " * 3000, "c"), (None, "no id of the", "b"), (None, "no id of the", "b"), (-4, "below zero", "a")]
    return out + [(5, *out[5][1:])] * 3 + [(2**62, "far", "a"), (-(2**63), "least", "a")] + [(400, "x" * 500 + " tail", "b")]


# ---- ranked search


def ranked_by_hand(rows, items, k=20):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    bags = [(i, collections.Counter(term.findall((t or "").translate(LOWER)))) for i, t, *_ in rows]
    bags = [(i, b) for i, b in bags if b]
    n, every = len(bags), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        asked = term.findall((text or "").translate(LOWER))
        scored = []
        for doc, b in bags:
            m = 75 + (25 * sum(b.values()) * n) // every
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m)) for t in asked if t in b)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "the of, THE far"), (2, None), (3, "nothing-here zzz"), (4, "xer"), (5, "in in in it wasing thát"), (6, ""), (None, "no id"), (7, "below"), (7, "zero word")]


@pytest.mark.parametrize("k, held, terms", [(20, 2_000_000, 500_000), (3, 40, 500_000), (500, 40, 4)])
def test_search_ranks_like_brute_force(spark, rows, monkeypatch, k, held, terms):
    monkeypatch.setattr(ranked_search, "SHARD_POSTINGS", held)
    monkeypatch.setattr(ranked_search, "PASS_TERMS", terms)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("score", F.lit(1))
    got = ranked_search.top_documents(docs(spark, rows).repartition(3), items, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == ranked_by_hand(rows, ITEMS, k)


def test_search_over_nothing(spark, rows):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked_search.top_documents(docs(spark, rows).limit(0), items).count() == 0
    assert ranked_search.top_documents(docs(spark, rows), items.limit(0)).count() == 0
    assert ranked_search.top_documents(docs(spark, [(1, None), (2, " - ")]), items).count() == 0


def test_wand_skips_and_loses_nothing():
    rng = np.random.default_rng(3)
    n_docs, n_terms = 30_000, 30
    weight = [int(w) for w in rng.integers(1, 3000, n_terms)]
    doc, term, tf = [], [], []
    for t in range(n_terms):
        some = np.flatnonzero(rng.random(n_docs) < 30 / (30 + weight[t]))
        doc.append(some)
        term.append(np.full(len(some), t))
        tf.append(rng.integers(1, 9, len(some)))
    doc, term, tf = (np.concatenate(x) for x in (doc, term, tf))
    sizes = rng.integers(5, 500, n_docs)
    shard = ranked_search.Shard(sizes, doc, term, tf, n_docs, int(sizes.sum()))
    heap = ranked_search.Heap(10)
    scored = ranked_search.wand(shard, list(enumerate(weight)), heap, [(False, i) for i in range(n_docs)])
    all_scores = np.zeros(n_docs, np.int64)
    np.add.at(all_scores, doc, np.array(weight)[term] * ranked_search.impacts(tf, ranked_search.lengths(sizes, n_docs, int(sizes.sum()))[doc]))
    want = sorted(range(n_docs), key=lambda i: (-all_scores[i], i))[:10]
    assert [(s, k[1]) for s, k in heap.rows] == [(int(all_scores[i]), i) for i in want]
    assert scored < len(np.unique(doc)) / 2


def test_lengths_beyond_64_bits():
    assert ranked_search.lengths(np.array([10**9, 3]), 10**12, 10**15).tolist() == [75 + 25 * 10**9 * 10**12 // 10**15, 75]


# ---- manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, lower=False):
    text = r[1].translate(LOWER) if lower and r[1] is not None else r[1]
    values = [r[0], "s", r[2], len(r[1] or ""), text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """(root, siblings of every node from its level up)."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(place):
            first = p // 8 * 8
            paths[i].append((nodes[first:p], nodes[p + 1 : first + 8]))
        nodes, place = [H(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)], [p // 8 for p in place]
    return nodes[0], paths


def proofs_by_hand(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in names:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = own, *climb([leaf(r) for r in own])
    root, over = climb([trees[g][1] for g in names])
    out = []
    for g, up in zip(names, over):
        own, subroot, paths = trees[g]
        for r, path in zip(own, paths):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            end = leaf(r, bad)
            for left, right in path + up:
                end = H(*left, end, *right)
            proof = H(*[x for left, right in path + up for x in [*left, *right]])
            out.append((r[0], leaf(r), subroot, root, proof, end, end == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("prefix_rows", [50_000, 7, 1])
def test_manifest_like_brute_force(spark, rows, monkeypatch, prefix_rows):
    monkeypatch.setattr(manifest, "PREFIX_ROWS", prefix_rows)
    frame = docs(spark, rows).repartition(3)
    got, _ = manifest.manifest(frame, change=(manifest.tampered(frame["doc_id"]), "text", manifest.lower_cased(frame["text"])), prefix_rows=prefix_rows)
    got = [tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in got.collect()]
    assert sorted(got, key=repr) == proofs_by_hand(rows)
    assert {False, True} == {r[-1] for r in got}


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_manifest_of_few_groups(spark, n):
    some = [(i, f"Text {i}", "one") for i in range(n)]
    got = manifest.verify_documents(docs(spark, some)).collect()
    assert sorted(map(tuple, got), key=repr) == proofs_by_hand(some)


def test_manifest_of_many_groups_and_none(spark):
    some = [(i, f"Text {i}", f"g{i % 90}" if i % 91 else None) for i in range(300)]
    assert sorted((tuple(r) for r in manifest.verify_documents(docs(spark, some)).collect()), key=repr) == proofs_by_hand(some)
    empty = manifest.verify_documents(docs(spark, some).limit(0))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


def test_manifest_reduces_blocks_of_many_levels(spark):
    """More leaves than one block holds: floors above floors."""
    frame = spark.range(9000).select(F.col("id").alias("doc_id"), F.lit("x").alias("lang"), F.concat(F.lit("T"), "id").alias("text"))
    got, floors = manifest.manifest(frame, fields=("doc_id", "text"))
    leaves = [H(*[f"{len(v)}:{v}" for v in (str(i), f"T{i}")]) for i in range(9000)]
    root, paths = climb(leaves)
    rows = {r["doc_id"]: r for r in got.collect()}
    assert all(r["root"] == r["folded_root"] == root and r["verified"] for r in rows.values())
    for i in (0, 1, 4095, 4096, 8191, 8192, 8999):
        assert rows[i]["proof_sha256"] == H(*[x for left, right in paths[i] for x in [*left, *right]]) and rows[i]["rank"] == i
    assert [f.count() for f in floors][:3] == [9000, 3, 1]


def test_radix_ranks_split_crowded_prefixes(spark):
    rng = random.Random(1)
    keys = {f"{rng.randrange(16**2):02x}{'0' * 6}{rng.randrange(16**8):08x}" for _ in range(2000)} | {f"ff{i:014x}" for i in range(500)}
    table = spark.createDataFrame([(i % 2, k) for i, k in enumerate(sorted(keys))], "g long, k string")
    got = {r["k"]: (r["g"], r["rank"]) for r in manifest.radix_ranks(table, "g", "k", prefix_rows=20).collect()}
    for g in (0, 1):
        own = sorted(k for k, (x, _) in got.items() if x == g)
        assert [got[k][1] for k in own] == list(range(len(own)))


# ---- language model


def scored_by_hand(rows, prior=lm_score.PRIOR):
    """The same model over exact sets: what the filter gives when no probe hits by chance."""
    texts = [re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(LOWER)) + [""] for r in rows]
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    taught = [t for t, h in zip(texts, held) if not h]
    single = collections.Counter(w for t in taught for w in t)
    pairs = collections.Counter(p for t in taught for p in zip(["", *t[:-1]], t))
    n, v = sum(single.values()), len(single)
    about = lambda c: float(lm_score.counts_of(lm_score.levels_of(np.array([c])))[0]) if c else 0.0
    out = []
    for r, t, h in zip(rows, texts, held):
        base = sum(math.log10((single[w] + 1) / (n + v + 1)) for w in t)
        score = 0.0
        for before, w in zip(["", *t[:-1]], t):
            own, past = (about(single[w]) + 1) / (n + v + 1), about(single[before])
            score += math.log10(min(1.0, (min(about(pairs[before, w]), past) + prior * own) / (past + prior)))
        out.append((r[0], h, len(t), sum(single[w] > 0 for w in t), n, round(base, 6), round(score, 6)))
    return sorted(out, key=repr)


def plain(frame):
    return sorted(((*tuple(r)[:5], round(r["base_score"], 6), round(r["score"], 6)) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("chunk, keys, held, filter_bytes", [(1 << 20, 1 << 22, 1 << 22, 1 << 27), (50, 100, 300, 1 << 27), (50, 100, 300, 0)])
def test_scores_like_brute_force(spark, rows, monkeypatch, chunk, keys, held, filter_bytes):
    for name, value in (("CHUNK", chunk), ("SEGMENT_TOKENS", keys), ("HELD", held)):
        monkeypatch.setattr(lm_score, name, value)
    frame = docs(spark, rows).repartition(3)
    got = lm_score.scores(frame, lm_score.held_out(frame["doc_id"]), filter_bytes=filter_bytes, bits_per_key=4000)  # no probe hits by chance
    assert plain(got) == scored_by_hand(rows)


def test_broadcast_and_routed_filters_agree(spark, rows, monkeypatch):
    monkeypatch.setattr(lm_score, "SEGMENT_TOKENS", 200)
    frame = docs(spark, rows)
    one, two = (lm_score.scores(frame, lm_score.held_out(frame["doc_id"]), filter_bytes=b) for b in (1 << 27, 0))
    assert plain(one) == plain(two)


def test_blocks_travel_many_to_a_batch(spark, monkeypatch):
    """A block for each of 100 chunks and 64 segments; their Arrow batches must not grow likewise."""
    for name, value in (("CHUNK", 400), ("SEGMENT_TOKENS", 512)):
        monkeypatch.setattr(lm_score, name, value)
    rows_, batches_ = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def counted(self, func, schema, *args, **kwargs):
        def run(batches):
            for batch in func(batches):
                rows_.add(batch.num_rows)
                batches_.add(1)
                yield batch

        return plain_map(self, run, schema, *args, **kwargs)

    rng = np.random.default_rng(5)
    frame = docs(spark, [(i, " ".join(f"w{x}" for x in rng.integers(0, 3000, 99))) for i in range(400)]).coalesce(1)
    kind = type(frame)
    plain_map = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", counted)
    assert lm_score.scores(frame, lm_score.held_out(frame["doc_id"]), filter_bytes=0).count() == 400
    assert rows_.value > 10_000
    assert batches_.value * 20 < rows_.value


def test_scores_of_nothing_learnt(spark, rows):
    frame = docs(spark, rows)
    assert lm_score.scores(frame.limit(0), F.lit(False)).count() == 0
    got = lm_score.scores(frame, F.lit(True)).collect()
    assert {(r["train_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got} == {(0, 0, 0.0, 0.0)}


def test_levels_come_back_from_the_filter():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 1 << 63, 50_000).astype(np.uint64)
    keys = np.unique(keys)
    counts = rng.zipf(1.6, len(keys)).clip(1, 10**9)
    segment = lm_score.segment_of(keys, 5)
    model = lm_score.LogFilter(5, [(s, lm_score.segment_bits(keys[segment == s], counts[segment == s])) for s in range(5)])
    got, want = model.levels(keys), lm_score.levels_of(counts)
    assert (got >= want).all() and (got == want).mean() > 0.95
    strange = rng.integers(0, 1 << 63, 50_000).astype(np.uint64)
    assert (model.levels(strange) > 0).mean() < 0.05


def test_counts_of_levels_are_near():
    counts = np.array([1, 2, 3, 5, 10, 1000, 123_456_789])
    assert (np.abs(np.log(lm_score.counts_of(lm_score.levels_of(counts)) / counts)) < 0.25).all()


def test_model_beats_base_on_held_out_text(spark):
    rng = random.Random(4)
    follow = {w: rng.sample(range(300), 4) for w in range(300)}

    def text():
        w, out = rng.randrange(300), []
        for _ in range(80):
            w = rng.choice(follow[w])
            out.append(f"w{w}")
        return " ".join(out)

    got = lm_score.score_documents(docs(spark, [(i, text()) for i in range(400)])).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert got[1] > 0.75 * got[0]


def test_bars_come_from_all_held_out_rows(spark):
    """The exact quantile of every labelled row's score, however many there are; copies count once."""
    import numpy as np

    from sievespark.llm import language_id

    rows = [(i, f"word{i % 7} " * (1 + i % 5) + "".join(chr(97 + (i * j) % 26) for j in range(1, 30)), "en") for i in range(2500)]
    frame = spark.createDataFrame([*rows, *rows[:400]], "doc_id int, text string, lang string")
    filters = language_id.train(frame.where("doc_id < 300"))
    scores = [filters.predict(t)[1] for t in {t for _, t, _ in rows}]
    assert len(scores) > 50 and language_id.bars(frame, filters) == pytest.approx({"en": 0.6 * np.percentile(scores, 5)}, abs=1e-12)
    assert "rows" not in language_id.bars.__code__.co_varnames
