"""Each operator against a brute-force version, on small fixtures with nulls, ties, repeats and clashing names."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievespark.llm import chat_format, decontamination, graph, language_id, mixing, near_dedup, secrets, sharding, suffix_dedup, token_counts, topk_search

#: Extra columns named like what operators make inside.
EXTRA = ("id", "size", "pattern", "copies", "part", "kept", "hits", "row_id", "words", "score", "c0", "slot", "shard", "rank", "key", "rep", "comp", "mark", "data", "h", "n", "base", "tokens", "__row", "__id", "__key", "__slot", "key_", "found", "found_key", "true", "text_", "r")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in EXTRA]])
LOWER = {i: i + 32 for i in range(65, 91)}


def docs(spark, rows):
    """rows: (doc_id, text[, source[, lang]])."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else None, r[2] if len(r) > 2 else None, len(r[1] or ""), *["x"] * len(EXTRA)) for r in rows]
    return spark.createDataFrame(full, DOCS)


def prose(rng, n, words="the of and in to it was that be is"):
    return " ".join(rng.choice(words.split()) + rng.choice(["", "", "er", "ing", "s"]) for _ in range(n))


@pytest.fixture(scope="module")
def mixed_rows():
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(1, 60)), rng.choice(["a", "a", "a", "b", "c", "é", None])) for i in range(300)]
    rows += [(300, None, "a"), (301, "", "b"), (302, "  \n\t", None), (303, "word " * 5000, "c"), (None, "no id here", "b"), (5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2])]
    return rows


def water(sizes, weights, budget, cap):
    """Bisection on the level."""
    low, high = 0.0, 1e12
    for _ in range(300):
        mid = (low + high) / 2
        if sum(min(cap * s, mid * w) for s, w in zip(sizes, weights)) < budget:
            low = mid
        else:
            high = mid
    return [min(cap * s, high * w) for s, w in zip(sizes, weights)]


def test_mixing_meets_targets(spark, mixed_rows):
    got = mixing.mix_documents(docs(spark, mixed_rows)).collect()
    assert len(got) == len(mixed_rows)
    word = re.compile(r"[^\x20\x09-\x0D]+")
    size = {}
    for r in mixed_rows:
        size.setdefault(r[2], 0)
        size[r[2]] += len(word.findall(r[1] or ""))
    order = sorted(s for s in size if s is not None) + [None]
    want = dict(zip(order, water([size[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5 * sum(size.values()), 2)))
    texts = {(r[0], r[1]): r for r in mixed_rows}
    source = {r[0]: r[2] for r in texts.values()}
    taken = dict.fromkeys(order, 0)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == size[s] and r.target == pytest.approx(want[s], rel=1e-6)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size + r.part
        taken[s] += r.taken
    for s in order:
        assert abs(taken[s] - want[s]) <= 1
    again = mixing.mix_documents(docs(spark, mixed_rows[::-1])).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix_documents(docs(spark, [])).count() == 0


def test_mixed_rows_hold_what_is_taken(spark, mixed_rows):
    """Whole documents, so a source misses its target by half a document at most."""
    rows = docs(spark, mixed_rows)
    plan = mixing.mix_documents(rows).join(rows.select("doc_id", "source").distinct(), "doc_id")
    out = mixing.mixed_rows(rows)
    assert out.columns == rows.columns
    assert {r.text for r in out.collect()} <= {r[1] for r in mixed_rows}
    due = {r.source: (r.n, r.m) for r in plan.groupBy("source").agg(F.sum("taken").alias("n"), F.max("size").alias("m")).collect()}
    got = {r.source: r.n for r in out.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    assert all(abs(got.get(s, 0) - n) <= (m + 1) / 2 for s, (n, m) in due.items() if s is not None)


def test_mix_sql_agrees(spark, mixed_rows, tmp_path):
    docs(spark, mixed_rows).select("doc_id", "text", "source").coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    want = con.execute(mixing.ORACLE).fetchall()
    assert [x[0] for x in con.description] == ["doc_id", "size", "source_size", "target", "taken", "copies", "part"]
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, mixing.mix_documents(docs(spark, mixed_rows)).collect()), key=order) == sorted(want, key=order)


def test_mixing_many_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_PATTERNS", 10)
    rows = [(i, prose(random.Random(i), 1 + i % 7), f"s{i % 400:03d}") for i in range(1200)]
    got = mixing.mix_documents(docs(spark, rows)).collect()
    by = {}
    for r in got:
        by.setdefault(rows[r.doc_id][2], [0, r.target])[0] += r.taken
    assert len(by) == 400 and all(abs(n - t) <= 1 for n, t in by.values())


def test_flow_is_a_cheapest_one():
    """Against a linear program solved by enumeration of small cases."""
    import itertools

    rng = random.Random(4)
    for _ in range(60):
        cap = [rng.randint(0, 3) for _ in range(3)]
        member = [sorted(rng.sample(range(2), rng.randint(1, 2))) for _ in cap]
        quota = [rng.randint(0, 6) for _ in range(2)]
        sent = mixing.min_cost_flow(cap, member, quota, 2)

        def cost(total, c):
            first = min(total, c)
            return first + 4 * (total - first)

        best = None
        ways = [[(a, b) for a in range(2 * c + 1) for b in range(2 * c + 1 - a) if (0 in m or not a) and (1 in m or not b)] for c, m in zip(cap, member)]
        for pick in itertools.product(*ways):
            if all(sum(x[s] for x in pick) <= quota[s] for s in range(2)):
                value = (-sum(map(sum, pick)), sum(cost(sum(x), c) for x, c in zip(pick, cap)))
                best = value if best is None else min(best, value)
        totals = [sum(x) for x in sent]
        assert all(t <= 2 * c for t, c in zip(totals, cap))
        for s in range(2):
            assert sum(x[m.index(s)] for x, m in zip(sent, member) if s in m) <= quota[s]
        assert (-sum(totals), sum(map(cost, totals, cap))) == best


def test_flow_prefers_fresh_text():
    # One document set belongs to both sources; the other only to the first.
    sent = mixing.min_cost_flow([100, 100], [[0, 1], [0]], [100, 100], 2)
    assert sent == [[0, 100], [100]]
    sent = mixing.min_cost_flow([100, 10], [[0, 1], [0]], [60, 100], 2)
    taken = [sum(x) for x in sent]
    assert sum(taken) == 160 and sent[0][1] == 100 and taken[0] >= 100 and taken[1] >= 10  # all fresh text first
    assert mixing.min_cost_flow([0], [[0]], [0], 2) == [[0]]


def test_token_counts_match_the_library(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(1)
    bits = ["'s", "'ll", "'re", "'r", "'", " ", "  ", "\n", "\t", "a", "Zé", "12", "!?", "日本", "😀", "​", " ", "<|endoftext|>", "hello", " world", "ii" * 40, "\r\n", "½"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 50)))) for i in range(400)]
    rows += [(400, None), (401, ""), (402, "a" * 30_000), (403, " " * 5000), (404, "x y\n" * 20_000), (1, rows[1][1])]
    got = token_counts.token_counts(docs(spark, rows), path).collect()
    want = sorted((i, len((t or "").encode()), n, n > 512) for (i, t), n in zip(rows, [len(e.ids) for e in library.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]))
    assert sorted(tuple(r) for r in got) == want
    assert token_counts.token_counts(docs(spark, []), path).count() == 0


def test_token_files_that_are_not_compiled_are_refused():
    import json

    spec = json.loads(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    spec["model"] |= {"vocab": {chr(c): i for i, c in enumerate(token_counts.byte_letters().values())}, "merges": []}
    spec["model"]["vocab"] = {k: i for i, k in enumerate(token_counts.byte_letters())}
    token_counts.Tokenizer(json.dumps(spec))
    changes = [("pre_tokenizer", {"use_regex": False}), ("pre_tokenizer", {"add_prefix_space": True}), ("model", {"ignore_merges": True}), ("model", {"byte_fallback": True}), ("model", {"end_of_word_suffix": "x"})]
    for part, change in changes:
        with pytest.raises(ValueError):
            token_counts.Tokenizer(json.dumps(spec | {part: spec[part] | change}))
    for flag in ("single_word", "lstrip", "rstrip"):
        with pytest.raises(ValueError):
            token_counts.Tokenizer(json.dumps(spec | {"added_tokens": [{"content": "<x>", flag: True}]}))
    both = token_counts.Tokenizer(json.dumps(spec | {"added_tokens": [{"content": "ab"}, {"content": "bcd"}, {"content": "abc"}]}))
    assert both.count_all(["abcd", "bcdab", "xabx"]) == [2, 2, 3]


def test_token_count_parts_and_chunks(monkeypatch):
    counter = token_counts.Tokenizer(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    rng = random.Random(2)
    texts = ["".join(rng.choices(["'s", " ", "\n", "ab", "9", "'v", "e", "é", "!"], k=2000)) for _ in range(10)]
    whole = counter.count_all(texts)
    monkeypatch.setattr(token_counts, "BLOCK", 50)
    monkeypatch.setattr(token_counts, "CHUNK", 7)
    assert counter.count_all(texts) == whole


def test_chat_links_orders_and_validates(spark):
    call = '{"tool_calls":[{"id":"c1","name":"add","arguments":{"b":1,"a":2}}],"content":null}'
    uses = '{"tool_calls":[{"id":"c2","name":"add","arguments":"{\\"a\\": {\\"$result\\": \\"c1\\"}}"}]}'
    rows = [
        (1, 0, "user", "hi"), (1, 1, "tool", '{"tool_call_id":"c1","content":"3"}'), (1, 2, "assistant", call), (1, 3, "assistant", uses),
        (1, 4, "tool", '{"tool_call_id":"zz"}'), (2, 0, None, None), (2, None, "user", '{"broken'), (None, 1, "user", ""), (2, 0, None, None),
        (3, 0, "assistant", '{"tool_calls":[{"id":"p","name":"add","arguments":{"a":{"$result":"q"},"b":1}},{"name":"x"}]}'),
        (3, 1, "assistant", '{"tool_calls":[{"id":"q","name":"nope","arguments":{"a":{"$result":"p"}}}]}'),
        (3, 2, "tool", '{"tool_call_id":"p"}'), (3, 3, "tool", '{"tool_call_id":"q"}'),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("at", F.lit(1)).withColumn("json", F.lit("x"))
    schema = {"add": {"type": "object", "properties": {"a": {}, "b": {"type": "integer"}}, "required": ["a", "b"]}}
    out = chat_format.format_messages(df, schema).collect()
    assert len(out) == len(rows)
    one = {r.turn: r for r in out if r.conv_id == 1}
    order = sorted(one.values(), key=lambda r: (r["at"], r.level, r.turn))
    assert [r.turn for r in order] == [0, 2, 1, 3, 4]
    assert one[1].answers_turn == 2 and one[1].problems == []
    assert one[2].json == '{"content":null,"role":"assistant","tool_calls":[{"arguments":{"a":2,"b":1},"id":"c1","name":"add"}]}'
    assert one[3].problems == ["c2: $: b is missing", "c2: no result"] and one[4].problems == ["zz: no call"]
    three = {r.turn: r for r in out if r.conv_id == 3}
    assert all("cycle" in three[t].problems for t in range(4)) and "a call has no id" in three[0].problems and "q: unknown tool" in three[1].problems
    assert chat_format.format_messages(df.limit(0), schema).count() == 0


HOSTILE = [
    '{"tool_calls":[{"id":"i","name":"add","arguments":{"a":1,"b":1' + "0" * 400 + "}}]}",  # an integer beyond doubles
    '{"tool_calls":[{"id":"n","name":{"x":1},"arguments":{}}]}',
    '{"tool_call_id":"zz","content":"\\ud800 half"}',
    '{"tool_calls":[{"id":"\\udc00","name":"add","arguments":{"a":1,"b":2}}]}',
    '{"tool_calls":[{"id":"deep","name":"add","arguments":{"a":' + "[" * 5000 + "]" * 5000 + ',"b":1}}]}',
    '{"tool_calls":[{"id":"s","name":"add","arguments":"' + "[" * 200_000 + '"}]}',
    '{"tool_calls":[{"id":"inf","name":"add","arguments":{"a":1e400,"b":1}}]}',
    '{"tool_calls":[{"id":"nan","name":"add","arguments":{"a":NaN,"b":1}}]}',
    '{"tool_calls":7}', '{"tool_calls":[7,{"id":3},{"id":"z"}]}', '{"tool_call_id":{}}', "{" * 100_000, '{"tool_calls":[{"id":"l","name":"add","arguments":{"b":1.0,"a":' + "1" * 5000 + "}}]}",
]


def test_chat_survives_hostile_texts(spark):
    import json

    rows = [(1, i, "assistant", t) for i, t in enumerate(HOSTILE)] + [(None, 1, "assistant", '{"tool_calls":[{"id":"c1","name":"add","arguments":{"a":1,"b":2}}]}'), (None, 2, "tool", '{"tool_call_id":"c1"}'), (2, 5, "tool", '{"tool_call_id":"c1"}'), (3, 1, "user", "x" * 1_000_000)]
    out = chat_format.format_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), {"add": ADD}).collect()
    assert len(out) == len(rows)
    for r in out:
        json.loads(r.json, parse_constant=lambda x: pytest.fail(x))
    one = {r.turn: r for r in out if r.conv_id == 1}
    assert one[0].problems == ["i: no result"] and one[1].problems == ["n: unknown tool", "n: no result"]
    assert one[2].json == '{"content":"\\ud800 half","role":"assistant","tool_call_id":"zz"}' and one[3].problems == ["\\udc00: no result"]
    assert all("tool_calls" not in json.loads(one[i].json) for i in (4, 6, 7, 8, 10, 11, 12)) and one[5].problems[0] == "s: arguments are not JSON"
    none = {r.turn: r for r in out if r.conv_id is None}
    assert none[2].answers_turn == 1 and none[1].problems == none[2].problems == []
    assert [r.problems for r in out if r.conv_id == 2] == [["c1: no call"]]


def chats(rng, n):
    """Rows with calls, results and uses in any order, ids called again, missing ones, cycles."""
    import json

    rows = []
    for conv in [*range(n), None]:
        ids = [f"c{k}" for k in range(rng.randint(1, 8))]
        turns = list(range(3 * len(ids) + 3))
        rng.shuffle(turns)
        for i in ids:
            uses = {"$result": rng.choice(ids)} if rng.random() < 0.6 else 3
            rows.append((conv, turns.pop(), "assistant", json.dumps({"tool_calls": [{"id": i, "name": "add", "arguments": {"a": uses, "b": rng.choice([1, "x", 2.5])}}]})))
            for _ in range(rng.choice([0, 1, 1, 1, 2])):
                rows.append((conv, turns.pop(), "tool", json.dumps({"tool_call_id": rng.choice([i, i, "lost"]), "content": "é"})))
        if rng.random() < 0.3:
            rows.append((conv, turns.pop(), "assistant", json.dumps({"tool_calls": [{"id": ids[0], "name": "add", "arguments": {"a": 1, "b": 1}}]})))
        rows.append((conv, turns.pop(), "user", "plain"))
    return rows


def brute_chat(rows):
    import json

    out = []
    for conv in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == conv]
        call, answer, uses, again = {}, {}, {}, set()
        for _, turn, _, text in mine:
            body = json.loads(text) if text[0] == "{" else {}
            for c in body.get("tool_calls", []):
                call.setdefault(c["id"], []).append(turn)
                used = c["arguments"]["a"]
                if isinstance(used, dict):
                    uses.setdefault(turn, set()).add(used["$result"])
            if "tool_call_id" in body:
                answer.setdefault(body["tool_call_id"], []).append(turn)
        before = {}  # turn -> turns it waits for
        for i in call:
            if i in answer:
                before.setdefault(min(answer[i]), set()).add(min(call[i]))
        for turn, ids in uses.items():
            before.setdefault(turn, set()).update(min(answer[i]) for i in ids if i in answer)

        def stuck(t, path=()):
            return t in path or any(stuck(b, (*path, t)) for b in before.get(t, ()))

        def key(t):
            return max([(t, 0), *((a, n + 1) for a, n in map(key, before.get(t, ())))])

        for _, turn, _, text in mine:
            body, problems = json.loads(text) if text[0] == "{" else {}, []
            late = stuck(turn)
            for c in body.get("tool_calls", []):
                b = c["arguments"]["b"]
                problems += [f"{c['id']}: $.b: not of type integer"] if not isinstance(b, int) else []
                problems += [f"{c['id']}: called again"] if turn > min(call[c["id"]]) else [f"{c['id']}: no result"] if c["id"] not in answer else []
            i = body.get("tool_call_id")
            problems += [f"{i}: no call"] if i is not None and i not in call else []
            out.append((conv, turn, *((turn, 0) if late else key(turn)), min(call[i]) if i in call else None, problems + ["cycle"] * late))
    return out


ADD = {"type": "object", "properties": {"a": {}, "b": {"type": "integer"}}, "required": ["a", "b"]}


@pytest.mark.parametrize("group", [100_000, 6])
def test_chat_matches_brute_force(spark, group, monkeypatch):
    monkeypatch.setattr(chat_format, "GROUP", group)
    rows = chats(random.Random(21), 40)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [(r.conv_id, r.turn, r["at"], r.level, r.answers_turn, r.problems) for r in chat_format.format_messages(df, {"add": ADD}).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=order) == sorted(brute_chat(rows), key=order)


def test_chat_replies(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a"), (1, 3, "assistant", "more"), (1, 4, "user", None), (None, 1, "user", "q"), (None, 2, "assistant", "a"), (2, None, "user", "q"), (1, 1, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {(r.conv_id, r.turn): r for r in chat_format.format_messages(df, {"reply": {"type": "object"}}, "reply").collect()}
    assert {k: r.answers_turn for k, r in out.items() if r.answers_turn is not None} == {(1, 2): 1, (None, 2): 1}
    assert {k: r.problems for k, r in out.items() if r.problems} == {(1, 3): ["turn-2: no call"], (1, 4): ["turn-4: no result"]}
    assert out[1, 1].json == '{"content":"q","role":"user"}' and out[1, 2].json == '{"content":"a","role":"assistant"}'  # links are told in columns


def test_enum_tells_true_from_one():
    assert chat_format.violations(True, {"enum": [1]}) and not chat_format.violations(1.0, {"enum": [1]}) and not chat_format.violations(True, {"enum": [True]})


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(260)]
    rows += [(i, rows[7][1]) for i in range(260, 300)]  # many ties
    rows += [(300, None), (301, [float("nan")] * 8), (302, [None] * 8), (303, [float("inf")] + [0.0] * 7), (None, rows[3][1]), (350, []), (400, rows[4][1][:3]), (50, rows[50][1]), (9, rows[9][1])]
    schema = "vec_id long, embedding array<double>"
    df = spark.createDataFrame(rows, schema).withColumn("v", F.lit("x")).withColumn("id", F.lit("y"))
    got = [tuple(r) for r in topk_search.top_k(df, df["vec_id"] % 50 == 0).collect()]
    good = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in {(i, tuple(v)) for i, v in good if i % 50 == 0}:
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:5]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted(got) == sorted(want)
    assert topk_search.top_k(df.limit(0), df["vec_id"] % 50 == 0).count() == 0


def test_top_k_of_huge_components_is_exact(spark):
    rng = random.Random(8)
    pick = lambda: rng.choice([0.5, -1.25, 3.0, 1e7, -1e9, 1e17, -1e17, 1e17 + 64, 1e300, -1.7e308, 5e-324])
    rows = [(i, [pick() for _ in range(3)]) for i in range(60)] + [(i, [rng.random() for _ in range(3)]) for i in range(60, 120)] + [(200, [1e17, 1e17, 0.0]), (201, [1e17, 1e17, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [math.floor(Fraction(x) * 256) for x in v] for i, v in rows}
    want = []
    for q in (i for i in whole if i % 10 == 0):
        best = sorted((-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in whole.items() if i != q)[:5]
        want += [(q, n, i, max(-(2**63), min(2**63 - 1, -s))) for n, (s, i) in enumerate(best, 1)]
    for rows_ in (1 << 20, 16):
        got = topk_search.top_k(df, df["vec_id"] % 10 == 0) if rows_ > 16 else topk_search.top_k(df.repartition(5), df["vec_id"] % 10 == 0)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_blocks_of_vectors_go_by_bytes():
    assert topk_search._sides(2_000_000, 100_000_000, 64) == (31, 1526)  # 65,536 vectors of 64 components a block: candidates are copied 31 times
    assert topk_search._sides(1, 10, 3) == (1, 1) and topk_search._sides(0, 0, 0) == (1, 1)


def test_long_runs_of_letters_keep_few_states():
    pieces = token_counts.Tokenizer(open(public_tokenizers.path("byte_bpe_50k.json")).read()).pieces
    rng = random.Random(2)
    data = bytes(rng.choices(b"abcdefghijklmnopqrstuvwxyz", k=30_000))
    want = pieces.count(data)
    small = token_counts.MEMO_STATES
    try:
        token_counts.MEMO_STATES = 500
        pieces._reset()
        assert pieces.count(data) == want and len(pieces.states) <= 500
    finally:
        token_counts.MEMO_STATES = small


def test_contracting_links_is_not_quadratic():
    import time

    rng = np.random.default_rng(1)
    n = 800_000
    hi = rng.integers(1, 1 << 40, n)
    batches = [pa.RecordBatch.from_arrays([pa.array(hi[i : i + 10_000]), pa.array(hi[i : i + 10_000] // 2)], ["hi", "lo"]) for i in range(0, n, 10_000)]
    start = time.process_time()
    out = list(graph._settled(iter(batches)))
    assert sum(b.num_rows for b in out) >= n * 0.99 and time.process_time() - start < 8


def brute_repeats(rows):
    """Byte masks by the contract; rows: distinct (id, text) in order."""
    seen, out = set(), {}
    for key, text in rows:
        data = (text or "").encode()
        mask = bytearray(len(data))
        for s in range(len(data) - 99):
            w = data[s : s + 100]
            if w in seen:
                mask[s : s + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(b for b, m in zip(data, mask) if not m)
        spans = sum(1 for i in range(len(mask)) if mask[i] and (i == 0 or not mask[i - 1]))
        out[key] = (len(data), sum(mask), spans, hashlib.sha256(kept).hexdigest())
    return out


def repeat_rows():
    rng = random.Random(8)
    passage = prose(rng, 60)
    base = [prose(rng, rng.randint(5, 150), "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi") for _ in range(60)]
    rows = list(enumerate(base))
    rows += [(100 + i, prose(rng, 20, "uno due tre") + passage + prose(rng, 20, "eins zwei drei")) for i in range(40)]
    rows += [(200 + i, base[i]) for i in range(10)] + [(300, None), (301, ""), (302, "a" * 3000), (303, "ab" * 700 + "é" * 300), (304, "a" * 99), (305, "x" * 100), (306, "x" * 101)]
    rows += [(320 + i, base[20][:150] + base[21][50:180] + base[20][20:170]) for i in range(5)] + [(None, base[3] + passage)]
    return rows


def test_suffix_dedup_matches_brute_force(spark):
    rows = repeat_rows()
    got = suffix_dedup.remove_repeats(docs(spark, rows + rows[:3]).repartition(5)).collect()
    want = brute_repeats(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)))
    assert len(got) == len(rows) + 3
    assert {r.doc_id: tuple(r)[1:] for r in got} == want
    assert suffix_dedup.remove_repeats(docs(spark, [])).count() == 0


def test_suffix_dedup_sql_agrees(spark, tmp_path):
    rows = repeat_rows()
    docs(spark, rows).select("doc_id", "text").coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    want = {r[0]: r[1:] for r in con.execute(suffix_dedup.ORACLE).fetchall()}
    assert want == brute_repeats(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)))


def test_hot_owners_are_found_across_tasks(spark, monkeypatch):
    """A passage that stands once in each of many tasks is as hot as one that stands often in one."""
    monkeypatch.setattr(suffix_dedup, "HOT_PIECES", 100)
    rng = random.Random(2)
    once = "".join(rng.choices("abcdefgh", k=140))
    rows = docs(spark, [(i, "".join(rng.choices("ijklmnop", k=50)) + once + "".join(rng.choices("ijklmnop", k=50))) for i in range(400)]).repartition(400)
    hot = suffix_dedup._hot_owners(suffix_dedup.keyed_rows(rows, "doc_id", "text"))
    assert len(hot) and set(hot) <= set(suffix_dedup.Batch([(0, 0, once.encode())]).owner) | set(hot)
    assert set(suffix_dedup.Batch([(0, 0, once.encode())]).owner) & set(hot)


def test_suffix_dedup_across_batches_and_hot_owners(monkeypatch):
    """The bucket path without Spark: tiny batches, every owner hot or none."""
    rows = [(i, t) for i, t in repeat_rows() if i is not None]
    texts = [(t or "").encode() for _, t in rows]
    want = brute_repeats(sorted(rows))
    for block, hot_share in ((1000, 0), (1000, 1), (150_000, 0)):
        monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", block)
        monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 700 if block == 1000 else block)
        batches = [suffix_dedup.batches_of(np.array([i]), np.array([0]), [t]) for (i, _), t in zip(rows, texts)]
        ranges = {i: [] for i, _ in rows}
        pieces = []
        for one in batches:
            for ids, _, segs in one:
                batch = suffix_dedup.Batch(segs)
                hot = np.unique(batch.owner) if hot_share else np.zeros(0, np.uint64)
                done, key, first, count = batch.open_pieces(hot)
                row, offset = batch.place(done)
                ranges[int(ids[0])] += [(int(o), int(o) + 100) for o in offset]
                row, offset = batch.place(first)
                pieces += [(int(ids[0]), int(o), int(n), batch.raw[f : f + n + 99].tobytes()) for o, f, n in zip(offset, first, count)]
        raw = np.frombuffer(b"".join(p[3] for p in pieces), np.uint8)
        count = np.array([p[2] for p in pieces])
        time = np.array([p[0] * (1 << 40) + p[1] for p in pieces])
        piece, window, size = suffix_dedup.repeats(raw, np.cumsum(count + 99) - count - 99, count, time)
        for p, w, n in zip(piece.tolist(), window.tolist(), size.tolist()):
            ranges[pieces[p][0]].append((pieces[p][1] + w, pieces[p][1] + w + n))
        for (i, _), text in zip(rows, texts):
            mask = suffix_dedup.removed_mask(len(text), [{"start": a, "end": b} for a, b in ranges[i]])
            assert int(mask.sum()) == want[i][1], (block, hot_share, i)


def test_maximal_repeats_list_all_occurrences():
    rng = random.Random(4)
    a, b = (bytes(rng.choices(range(97, 123), k=130)) for _ in range(2))
    texts = [b"1" + a + b"2", b"3" + a + b"4" + b, b + b"5", b"6" + a[:110] + b"7", b"short"]
    found = {(n, tuple(p)) for n, p in suffix_dedup.maximal_repeats(texts)}
    assert found == {(130, ((0, 1), (1, 1))), (110, ((0, 1), (1, 1), (3, 1))), (130, ((1, 132), (2, 0)))}


def test_language_id(spark):
    rng = random.Random(6)
    sets = {"xx": "kala mato suri pelo", "yy": "brung stett wopp krix", "zz": "qui çeau lément éou"}
    rows = [(i, prose(rng, rng.randint(2, 40), sets[k]), "s", k) for i, k in enumerate(random.Random(1).choices(list(sets), k=400))]
    rows += [(400, None, "s", "xx"), (401, "", "s", None), (402, "12 34 !!", "s", "yy"), (403, "KALA " * 20_000, "s", None), (None, "brung stett", "s", "yy"), (3, rows[3][1], "s", rows[3][3])]
    got = language_id.identify(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    held = [(by[r[0]].lang_pred, r[3]) for r in rows[:400] if by[r[0]].held_out]
    assert sum(a == b for a, b in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    assert [by[i].lang_pred for i in (400, 401, 402)] == ["und"] * 3 and by[403].lang_pred == "xx"
    kept = language_id.accepted(docs(spark, rows))
    assert kept.columns == docs(spark, []).columns and kept.count() == len(rows) - 3
    assert language_id.identify(docs(spark, [])).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs(spark, [(1, "abc", "s", None)])).collect()} == {"und"}


def test_language_matches_brute_force(spark):
    """Training and prediction with plain sets of n-grams in place of hashes and filters."""
    import unicodedata
    from collections import Counter

    rng = random.Random(16)
    sets = {f"l{k}": " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzäöéñ"[k : k + 12], k=rng.randint(3, 7))) for _ in range(60)) for k in range(6)}
    rows = [(i, prose(rng, rng.randint(1, 30), sets[k] if rng.random() < 0.95 else sets["l0"]) + rng.choice(["", " 12-ab!", " É\u0301x"]), "s", k) for i, k in enumerate(rng.choices(list(sets), k=600))]
    rows += [(1000, "\u0301\u0301", "s", "l1"), (1001, None, "s", "l1"), (1002, "ø \u0301", "s", None)]

    def grams(text):
        kept = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower())
        t = " " + " ".join(kept.split()) + " " if kept.split() else " "
        for n in (1, 2, 3, 4):
            for i in range(len(t) - n + 1):
                if any(unicodedata.category(c)[0] == "L" for c in t[i : i + n]):
                    yield t[i : i + n]

    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    counts = {k: Counter() for k in sets}
    for text, k in {(r[1], r[3]) for r in rows if r[3] and r[1] and not held(r[0])}:
        counts[k].update(grams(text))
    share = {k: {g: n / sum(c.values()) for g, n in c.items()} for k, c in counts.items()}
    most = {}
    for c in share.values():
        for g, x in c.items():
            most[g] = max(most.get(g, 0), x)
    known = {k: {g for g, x in c.items() if x >= 0.05 * most[g]} for k, c in share.items()}
    got = {r.doc_id: r for r in language_id.identify(docs(spark, rows), rows_per_language=10**6, grams_per_language=10**6).collect()}
    for i, text, _, _ in rows:
        mine = list(grams(text or ""))
        if not mine:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        want = {k: sum(g in s for g in mine) / len(mine) for k, s in known.items()}
        top = max(want.values())
        assert abs(want[got[i].lang_pred] - top) < 0.02 and abs(got[i].score - top) < 0.02


def test_more_languages_than_a_mask_word(spark):
    rng = random.Random(17)
    names = [f"x{i:03d}" for i in range(600)]
    sets = {k: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for k in names}
    rows = [(i, " ".join(["".join(rng.choices(sets[k], k=6)) for _ in range(12)]), "s", k) for i, k in enumerate(names * 3)]
    filters = language_id.train(docs(spark, rows))
    assert filters.languages == names and filters.predict(rows[5][1])[0] == names[5]


def test_languages_of_many_characters_are_accepted(spark):
    """A script of 3,500 characters has more n-grams than a filter keeps; its rows stay, those of no known language go."""
    rng = random.Random(12)
    signs = [chr(0x4E00 + i) for i in range(3500)]
    often = [1 / (i + 10) for i in range(3500)]
    rows = [(i, "".join(rng.choices(signs, often, k=300)), "s", "ideo") for i in range(300)]
    rows += [(i, prose(rng, 40, "kala mato suri pelo"), "s", "xx") for i in range(300, 500)]
    rows += [(i, prose(rng, 40, "брат вода земля дом"), "s", None) for i in range(500, 520)]
    frame = docs(spark, rows)
    scores = [r.score for r in language_id.identify(frame).collect() if r.doc_id < 300]
    assert max(scores) < 0.5 and {r.doc_id for r in language_id.accepted(frame).collect()} == set(range(500))


@pytest.mark.parametrize("seed", range(4))
def test_language_training_counts_each_text_once(spark, seed):
    """A text that makes up a third of its language, drawn or not, changes neither the sample nor the n-grams."""
    rng = random.Random(13)
    rows = [(i, " ".join("".join(rng.choices("abcdefghijklmno", k=5)) for _ in range(20)), "s", "xx") for i in range(400)]
    copies = [(1000 + i, rows[0][1], "s", "xx") for i in range(200)]
    once, often = (language_id.train(docs(spark, x), rows_per_language=100, grams_per_language=600, seed=seed) for x in (rows, rows + copies))
    assert (once.table == often.table).all()


def test_language_blocks_lose_nothing(monkeypatch):
    text = "Straße über alles, naïve 12 café " * 50
    whole = np.sort(np.concatenate(list(language_id.text_hashes(text))))
    monkeypatch.setattr(language_id, "BLOCK", 37)
    assert (np.sort(np.concatenate(list(language_id.text_hashes(text)))) == whole).all()


def test_filters_return_all_languages_and_correct_rates():
    rng = np.random.default_rng(1)
    grams = [rng.integers(0, 1 << 64, 3000, np.uint64) for _ in range(70)]
    grams[69][:1000] = grams[0][:1000]
    f = language_id.Filters([str(i) for i in range(70)], grams, bits=16)
    n = f.counts(grams[0])
    assert n[0] == 3000 and n[69] >= 1000
    other = rng.integers(0, 1 << 64, 50_000, np.uint64)
    assert np.abs(f.counts(other) / 50_000 - f.false_rate).max() < 0.005


def base_spans(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secret_scan(spark):
    rng = random.Random(9)
    base62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    natural = ["getUserAccountByIdentifier", "internationalization_module", "com/example/project/source/main", "a" * 29, base62[:36], "____________________________", "AbstractSingletonProxyFactoryBean", "12345678901234567890123"]
    rows = [(i, "é 😀 see " + "".join(rng.choices(base62, k=rng.choice([28, 32, 40]))) + " end") for i in range(60)]
    rows += [(i, f"{rng.choice(natural)} and {rng.choice(natural)}") for i in range(60, 200)]
    rows += [
        (200, None), (201, ""), (202, "😀 Password: 'abc123' secret=token: abcdefg token=ab"), (203, "AKIA" + "A1" * 8 + " AKIASHORT " + "0f" * 12 + " " + "0f" * 11),
        (204, "api_key = deadbeefdeadbeefdeadbeef00, apikey:'x' SECRET=" + "Z" * 50), (205, "token=abcdef " * 3000), (206, "f" * 100_000), (204, "passwd=longenough"), (None, "token: abcdefgh"),
    ]
    got = secrets.secret_report(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    names = ("assign", "access", "hex")
    want = {}
    for i, t in rows:
        s = base_spans(t or "")
        line = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in s)
        want.setdefault(i, []).append((*[sum(k == x for _, k, _ in s) for x in range(3)], hashlib.sha256(line.encode()).hexdigest()))
    for r in got:
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) in want[r.doc_id]
        if r.doc_id != 204:
            only = ",".join(x for x in r.spans.split(",") if not x.startswith("random"))
            assert hashlib.sha256(only.encode()).hexdigest() == r.base_sha256
    found = {r.doc_id for r in got if "random" in r.spans}
    assert len(found & set(range(60))) >= 54 and not found & set(range(60, 300))
    assert secrets.secret_report(docs(spark, [])).count() == 0


def brute_null(texts):
    counts, turns, pairs = dict.fromkeys(secrets.LOWER, 0), 0, 0
    for t in texts:
        plain = re.sub("[^a-z]+", " ", (t or "").lower())
        for c in counts:
            counts[c] += plain.count(c)
        for a, b in zip(plain, plain[1:]):
            if a != " " and b != " ":
                pairs += 1
                turns += (a in "aeiouy") != (b in "aeiouy")
    letters = [counts[c] + 1e6 * p / sum(secrets.LETTERS) for c, p in zip(secrets.LOWER, secrets.LETTERS)]
    return [x / sum(letters) for x in letters], (turns + 1e6 * 0.56) / (pairs + 1e6)


def brute_battery(token, letters, vowels):
    from math import log, sqrt

    v = token.rstrip("=") if re.fullmatch("[A-Z2-7]{14,}={1,6}", token) else token
    n, lower = len(v), v.lower()
    cased = v in (v.lower(), v.upper())
    e = 0 if set(v) <= set("0123456789abcdef") or set(v) <= set("0123456789ABCDEF") else 1 if v.isalpha() and cased else None
    if e is None:
        e = 2 if cased and set(lower) <= set("abcdefghijklmnopqrstuvwxyz234567") else 3 if cased and v.isalnum() else 4 if v.isalnum() else 5
    size = (16, 26, 32, 36, 62, 66)[e]
    digits, capitals, signs = ((0.5, 0, 0), (0, 0, 0), (0.1, 0, 0), (0.1, 0, 0), (0.05, 0.15, 0), (0.05, 0.15, 0.08))[e]
    some = letters[:6] if e == 0 else letters
    shares = [x / sum(some) for x in some]
    rest = 1 - digits - capitals - signs
    table = [x * rest for x in shares] + [x * capitals for x in shares] + [digits / 10] * 10 + [signs / 4] * 4
    two, three = sum(x**2 for x in table), sum(x**3 for x in table)
    counts = [v.count(c) for c in set(v)]
    same = sum(c * (c - 1) for c in counts)
    uniform = (n * (n - 1) * two - same) / sqrt(2 * n * (n - 1) * (two - two**2) + 4 * n * (n - 1) * (n - 2) * (three - two**2))
    chi2 = sum((c - n / size) ** 2 / (n / size) for c in counts) + (size - len(counts)) * n / size
    codes = [ord(c) for c in v]
    mean = sum(codes) / n
    spread = sum((x - mean) ** 2 for x in codes)
    serial = sum((x - mean) * (y - mean) for x, y in zip(codes, codes[1:])) / spread if spread > 0.5 else 1.0

    def deviance(x, n, p):
        if n < 1:
            return 0.0
        above = x > n * p
        s = min(1 - 1e-9, max(1e-9, (x + (-0.5 if above else 0.5)) / n))
        if (s > p) != above:
            return 0.0
        return (1 if above else -1) * sqrt(max(0.0, 2 * n * (s * log(s / p) + (1 - s) * log((1 - s) / (1 - p)))))

    changed = lambda f: sum(f(a) != f(b) for a, b in zip(v, v[1:]))
    both = [(a, b) for a, b in zip(lower, lower[1:]) if a.isalpha() and b.isalpha()]
    turns = deviance(sum((a in "aeiouy") != (b in "aeiouy") for a, b in both), len(both), vowels)
    weights = [log(1 / 26 / max(x, 0.01)) for x in letters]
    expect = sum(x * w for x, w in zip(letters, weights))
    sd = sqrt(sum(x * (w - expect) ** 2 for x, w in zip(letters, weights)))
    held = [weights[ord(c) - 97] for c in lower if c.isalpha()]
    k = max(1, len(held))
    rare = (sum(held) - k * expect) / (sd * sqrt(k))
    word = (2 * rare + uniform - turns) / sqrt(9.8)
    number = deviance(changed(str.isdigit), n - 1, 0.1)
    kind = lambda c: "d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s"
    classes = (changed(kind) - (n - 1) * 0.25) / sqrt((n - 1) * 0.25 * 0.75)
    mixed = (2 * uniform + 2 * classes + (0.35 - abs(serial)) * sqrt(n)) / 3
    z = (uniform + 2 * number) / sqrt(5) if e == 0 else word if e == 1 else (1.5 * word + number) / sqrt(3.25) if e <= 3 else mixed
    return -40.0 if chi2 > size - 1 + 5 * sqrt(2 * (size - 1)) or abs(serial) * sqrt(n) > 4 else max(-40.0, min(40.0, z))


def brute_added(texts, q=0.001):
    """Random spans of each text, by the bars of Benjamini-Hochberg in each length band."""
    from math import erfc, floor, sqrt

    letters, vowels = brute_null(texts)
    tests = []
    for i, t in enumerate(texts):
        base = base_spans(t or "")
        for m in re.finditer(secrets.TOKEN, t or ""):
            if not any(a < m.end() and m.start() < b for a, _, b in base):
                band = sum(len(m[0]) >= x for x in (28, 40, 64))
                tests.append((i, m.start(), m.end(), band, floor(brute_battery(m[0], letters, vowels) / 0.05)))
    out = [[] for _ in texts]
    for band in range(4):
        mine = [x for x in tests if x[3] == band]
        bins = sorted((x[4] for x in mine), reverse=True)
        passed = [b for b in set(bins) if 0.5 * erfc(b * 0.05 / sqrt(2)) * len(bins) <= q * sum(x >= b for x in bins)]
        for i, a, b, _, x in mine:
            if passed and x >= min(passed):
                out[i].append((a, b))
    return [sorted(x) for x in out]


def test_secret_battery_matches_brute_force(spark):
    """Tokens of every encoding and length among prose, names, numbers and paths: the same spans, and the same statistic."""
    rng = random.Random(31)
    alphabets = ["0123456789abcdef", "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyz0123456789", secrets.ALPHABET[:62], secrets.ALPHABET[:66], "0123456789", "ab", "A="]
    words = "account total error user name index value first last token node list tree path open read write".split()
    tokens = ["".join(rng.choices(rng.choice(alphabets), k=rng.choice([20, 22, 28, 35, 41, 64, 90]))) for _ in range(300)]
    tokens += ["".join(rng.choices([w.title() if k else w for w in words], k=6)) for k in range(2) for _ in range(200)] + ["/".join(rng.choices(words, k=5)) for _ in range(100)] + ["MFRGGZDFMZTWQ2LK" + "ABCD======", "z" * 40, "=" * 25, "ab" * 15]
    rng.shuffle(tokens)
    texts = [f"{prose(rng, 8)} é {a} {prose(rng, 4)}, 😀 {b}" for a, b in zip(tokens[::2], tokens[1::2])] + [None, ""]
    frame = docs(spark, list(enumerate(texts)))
    got = {r.id: [(x.start, x.end) for x in r.added] for r in secrets.scan(frame).collect()}
    want = brute_added(texts)
    assert [got[i] for i in range(len(texts))] == want and sum(map(len, want)) > 100
    letters, vowels = secrets.base_null(frame)
    again, vowels_ = brute_null(texts)
    assert letters == pytest.approx(again) and vowels == pytest.approx(vowels_)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "i int, t string").select("i", F.array(F.struct(F.lit(0).alias("start"), F.lit(3).alias("kind"), F.length("t").alias("end"), F.col("t").alias("value"))).alias("x"))
    zs = {r.i: r.z for r in rows.select("i", secrets.battery(F.col("x"), letters, vowels)[0]["z"].alias("z")).collect()}
    assert [zs[i] for i in range(len(tokens))] == pytest.approx([brute_battery(t, letters, vowels) for t in tokens], abs=1e-6)


def test_secret_scan_is_linear_in_long_texts(spark):
    """One token of a million characters and 30,000 short ones: seconds, not hours."""
    import time

    rng = random.Random(3)
    long_ = "".join(rng.choices(secrets.ALPHABET[:62], k=1_000_000))
    many = " ".join("".join(rng.choices("abcdefgh", k=21)) for _ in range(30_000))
    before = time.time()
    got = {r.doc_id: r.spans for r in secrets.secret_report(docs(spark, [(1, long_), (2, many), (3, "a:" * 100_000)])).collect()}
    assert got[1] == f"random:0:{len(long_)}" and got[3] == "" and time.time() - before < 60


def test_secrets_of_one_case_among_prose(spark):
    """Planted at 1 % of the tokens each: upper-case hex, base32, a-z; words run together are left alone."""
    rng = random.Random(11)
    words = "account address balance builder cluster column config connection context control data default delivery document element error event factory field filter folder format function handler header image index input internal language list manager message method model number object option order output package parameter parser process project property protocol provider query record remote report request resource response result schema screen search section select server service session setting source standard state storage string structure support system table target template text thread time transaction transfer update user value version window workshop".split()

    def name():
        s = "".join(rng.choices(words, k=8))[: rng.randint(28, 39)]
        s = s[:-4] + str(rng.randint(1990, 2030)) if rng.random() < 0.2 else s
        return s.upper() if rng.random() < 0.5 else s

    alphabets = ("0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyz")
    rows = [(i, "see " + name() + " end") for i in range(2910)]
    rows += [(3000 + 100 * a + i, "see " + "".join(rng.choices(s, k=32)) + " end") for a, s in enumerate(alphabets) for i in range(30)]
    rows += [(4000 + i, t) for i, t in enumerate(("XVXVXVMMMVXMXVXVXVXVXVXVXVXVXVXV", "dmku" * 8, "z" * 32, "0" * 32, "A" * 16 + "======", "12345678901234567890123456789012"))]
    found = {r.doc_id for r in secrets.secret_report(docs(spark, rows)).collect() if "random" in r.spans}
    for a in range(3):
        assert len(found & set(range(3000 + 100 * a, 3030 + 100 * a))) >= 18, a
    assert len(found & set(range(2910))) <= 1 and not found & set(range(4000, 4100))


def test_sharding_table_and_placement(spark):
    shards = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(shards, 251, seed=3)
    # Brute force: whole permutations, then turns.
    walks = []
    for s in shards:
        offset, skip = sharding._hash(3, "offset", s) % 251, sharding._hash(3, "skip", s) % 250 + 1
        walks.append([(offset + j * skip) % 251 for j in range(251)])
        assert sorted(walks[-1]) == list(range(251))
    slow, turn = {}, 0
    while len(slow) < 251:
        shard = turn % 7
        slow[next(x for x in walks[shard] if x not in slow)] = shard
        turn += 1
    assert [slow[i] for i in range(251)] == table
    sizes = np.bincount(table)
    assert sizes.max() - sizes.min() <= 1
    fewer = sharding.lookup_table(shards[:6], 251, seed=3)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 0.25 * 251
    double = np.bincount(sharding.lookup_table(shards, 1009, {"s0": 2}, 3))
    assert double[0] > 1.8 * double[1]
    rows = [(i, "t") for i in range(500)] + [(None, "n"), (None, "m"), (7, "again")]
    out = sharding.place(docs(spark, rows), "doc_id", shards, 251)
    got = out.collect()
    look = sharding.lookup_table(shards, 251)
    assert len(got) == len(rows) and all(r["shard"] == shards[look[r["slot"]]] for r in got)
    assert len({r["shard"] for r in got if r.doc_id == 7}) == 1 and len({r["shard"] for r in got if r.doc_id is None}) == 1
    assert sharding.place(docs(spark, []), "doc_id", shards, 251).count() == 0
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, 250)


def brute_hits(rows, items, n=10):
    token = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    cut = lambda t: token.findall((t or "").translate(LOWER))
    wins = {}
    for i, t in items:
        w = cut(t)
        k = min(n, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            wins.setdefault(tuple(w[a : a + k]), set()).add(i)
    out = []
    for i, t in rows:
        w, hit, met = cut(t), set(), set()
        for k in {len(x) for x in wins}:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in wins:
                    hit.update(range(a, a + k))
                    met |= wins[tuple(w[a : a + k])]
        ids = ",".join(sorted(str(x) for x in met if x is not None))
        out.append((i, len(w), len(hit), sum(x is not None for x in met), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def leaks(rng):
    items = [(i, prose(rng, rng.randint(12, 20), "alpha beta gamma delta epsilon zeta")) for i in range(8)]
    items += [(20, "Only Three Words"), (21, None), (22, ""), (9, items[1][1]), (23, "!!! ???"), (24, "Ünïcode ß 12")]
    rows = [(i, prose(rng, rng.randint(1, 80))) for i in range(60)]
    rows += [(100 + i, prose(rng, 10) + "! " + items[i % 8][1].upper() + " -- " + prose(rng, 9)) for i in range(20)]
    rows += [(200, None), (201, ""), (202, "only, three; WORDS"), (203, " ".join(items[2][1].split()[:9])), (204, items[3][1] + " " + items[3][1]), (205, (items[4][1] + " x ") * 1500), (None, items[5][1]), (0, rows[0][1]), (100, "clean now"), (206, "Ünïcode ß 12 Ünïcode")]
    return items, rows


@pytest.mark.parametrize("most", [200_000, 0])
def test_decontamination_matches_brute_force(spark, most, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", most)
    items, rows = leaks(random.Random(11))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1)).withColumn("len", F.lit(1))
    got = [tuple(r) for r in decontamination.contamination(docs(spark, rows), bench).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want = brute_hits(rows, items)
    assert sorted(got, key=order) == sorted(want, key=order)
    assert [tuple(r)[2:4] for r in decontamination.contamination(docs(spark, rows[:5]), bench.limit(0)).collect()] == [(0, 0)] * 5
    assert decontamination.contamination(docs(spark, []), bench).count() == 0
    clean = decontamination.clean_documents(docs(spark, rows), bench)
    assert clean.columns == docs(spark, []).columns and clean.count() == sum(not w[5] for w in want)
    cut = {r.doc_id: r.text for r in decontamination.clean_documents(docs(spark, rows), bench, remove="spans").collect()}
    assert cut[202] == ", ; " and cut[3] == rows[3][1] and cut[200] is None and cut[206] == "   Ünïcode"
    assert cut[205] == " " * (len(items[4][1].split()) - 1) + " x " + (" " * (len(items[4][1].split()) - 1) + " x ") * 1499


def near_rows():
    rng = random.Random(12)
    base = [prose(rng, 120, "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau") for _ in range(12)]
    rows = [(1000 + i, t) for i, t in enumerate(base)]
    for k in range(100):  # a chain of edits: neighbours are linked, far ends are not
        words = base[0].split() if k == 0 else rows[-1][1].split()
        words[(k * 7) % len(words)] = f"edit{k}"
        rows.append((k, " ".join(words)))
    rows += [(500 + k, base[1].upper() if k % 2 else base[1].replace(" ", "\n")) for k in range(60)]
    rows += [(700 + k, " ".join(rng.sample("p q r s t u v w x y".split(), rng.randint(1, 4)))) for k in range(60)]
    rows += [(900, None), (901, ""), (902, " \t "), (903, "one"), (904, "ONE"), (905, "one two"), (906, "a b " * 3000), (907, "a  b " * 2999 + "a b"), (None, base[2]), (1003, base[3])]
    rows += [(950, base[4]), (950, base[5]), (951, base[6]), (952, base[6] + " x"), (950, base[6] + " y")]  # an id with three texts ties three groups
    return rows


def brute_components(rows, width):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    sets = []
    for _, t in rows:
        w = word.findall((t or "").translate(LOWER))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            both = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] or sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(s), least[root(i)] if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("width,block", [(2, 512), (5, 512), (2, 3)])
def test_near_dedup_matches_brute_force(spark, width, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = near_rows()
    got = near_dedup.near_duplicates(docs(spark, rows).repartition(3), width=width).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = brute_components(rows, width)
    assert sorted([tuple(r)[:3] for r in got], key=order) == sorted(want, key=order)
    assert all(r.kept == (r.component_id == r.doc_id or r.doc_id is None) for r in got)
    assert near_dedup.near_duplicates(docs(spark, [])).count() == 0
    kept = near_dedup.keep_one(docs(spark, rows), width=width)
    assert kept.columns == docs(spark, []).columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted({d for d, _, c in want if d is not None and d == c})


def test_near_dedup_sql_agrees(spark, tmp_path):
    rows = near_rows()[:-7]
    con = duckdb.connect()
    docs(spark, rows).select("doc_id", "text").coalesce(1).write.parquet(str(tmp_path / "d"))
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    want = sorted(con.execute(near_dedup.ORACLE).fetchall())
    got = sorted(tuple(r) for r in near_dedup.near_duplicates(docs(spark, rows)).collect())
    assert got == want


def test_registers_estimate_jaccard():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 63, 3000, np.uint64)
    for shared in (0, 500, 900):
        a, b = np.unique(pool[:1000]), np.unique(np.concatenate([pool[:shared], pool[1500 : 2500 - shared]]))
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        r = near_dedup.registers([a, b])
        assert abs(near_dedup.estimate(r[:1], r[1:])[0] - j) < 0.12


def block_of(regs, texts, own=None, k=1, bi=0, bj=0):
    packed = [near_dedup.zstandard.ZstdCompressor().compress(t) for t in texts]
    n = len(texts)
    cols = {"k": [k] * n, "bi": [bi] * n, "bj": [bj] * n, "band": [0] * n, "own": own or [0] * n, "comp": list(range(n)), "n": [5] * n, "regs": [r.tobytes() for r in regs], "body": packed}
    return near_dedup.pa.table(cols)


def test_near_dedup_estimates_pairs_from_all_registers():
    """A pair with 50 of its first 90 registers equal, and 140 of all 180, is compared; one with 100 of 180 is not, whatever its text."""
    base = np.arange(near_dedup.BANDS * near_dedup.ROWS).astype(">u2")
    near, far = base.copy(), base.copy()
    near[50:90] += 1000
    far[100:] += 1000
    texts = [b"a b c d e f"] * 3
    assert near_dedup._compared(block_of((base, near, far), texts), 0.8, 2) == ([1], [0])
    assert near_dedup._compared(block_of((base, near), [texts[0], b"g h i j k"]), 0.8, 2) == ([], [])
    # The others' block against the largest component's: only across.
    assert near_dedup._compared(block_of((base, base, base), texts, [0, 1, 1], 1, 0, 1), 0.8, 2) == ([1, 2], [0, 0])


def test_near_dedup_recall_at_the_threshold():
    """Thousands of pairs planted at a similarity of just over 0.8: bands and estimate let all of them through."""
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(3000):
        pool = rng.integers(0, 1 << 64, 110, np.uint64)
        sets += [np.unique(pool[:100]), np.unique(pool[11:])]  # 89 of 110
    regs = near_dedup.registers(sets)
    equal = regs[0::2] == regs[1::2]
    met = equal.reshape(len(equal), near_dedup.BANDS, near_dedup.ROWS).all(axis=2).any(axis=1)
    assert met.all() and (near_dedup.corrected(equal.mean(axis=1)) >= 0.8 - near_dedup.SLACK).all()


def labels_of(links):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up if root(x) != x}


@pytest.mark.parametrize("kind", ["chain", "star", "hub", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(7)
    links = {
        "chain": [(i, i + 1) for i in range(200)],
        "star": [(0, i) for i in range(1, 200)],
        "hub": [(1000, i) for i in range(200)] + [(5, 5)],
        "random": [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)],
        "none": [(3, 3)],
    }[kind]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    assert {r.id: r.comp for r in graph.components(df).collect()} == labels_of(links)
