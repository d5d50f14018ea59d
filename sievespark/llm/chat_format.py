"""Chat formatting: tool-call linking, ordering, argument validation and canonical JSON.

A message's text may be a JSON object. An assistant's ``{"tool_calls": [{"id", "name",
"arguments"}, ...], "content": ...}`` makes calls; a tool's ``{"tool_call_id": ..., "content":
...}`` answers one. An argument ``{"$result": "<call id>"}`` uses another call's result. Where a
``reply`` tool is named, plain turns are linked too: a user's turn n counts as a call of it with the
id ``turn-n``, and an assistant's turn n + 1 as its result. Such links are told in columns only; the
canonical JSON has the calls and results that the texts have.

Calls and results are joined by (conversation, call id). Order is topological: a result comes
after its call, a call after the results it uses, and otherwise turns stay as they are. The order
is returned as a sort key a message (``at``, ``level``). Conversations of up to GROUP links are
ordered in one Arrow call each, longer ones by rounds of joins, one for each level of their links.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievespark.llm.common import sliced
from sievespark.session import cut_and_count, cut_lineage

#: Links of a conversation that are ordered in one call (about 3 MB), and the deepest nesting read as JSON.
GROUP, DEPTH = 100_000, 200
_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
_LONE = re.compile("[\ud800-\udfff]")


def escaped(text: str) -> str:
    """Half surrogate pairs, which UTF-8 cannot hold, as JSON escapes."""
    return _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value: object) -> str:
    """Sorted keys, no spaces, text as it is."""
    return escaped(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def _finite(digits: str) -> float:
    value = float(digits)
    if value in (float("inf"), float("-inf")):
        raise ValueError("beyond the range of a double")
    return value


def _refuse(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


def read_json(text: str) -> object:
    """The value of a JSON text; ValueError if it is none, is nested deeper than DEPTH, or holds what JSON cannot write."""
    try:
        value = json.loads(text, parse_float=_finite, parse_constant=_refuse)
    except RecursionError:
        raise ValueError("nested too deeply") from None
    open_ = [(value, 1)]
    while open_:
        v, depth = open_.pop()
        if depth > DEPTH:
            raise ValueError("nested too deeply")
        if isinstance(v, (dict, list)):
            open_ += [(x, depth + 1) for x in (v.values() if isinstance(v, dict) else v) if isinstance(x, (dict, list))]
    return value


def violations(value: object, schema: dict, where: str = "$") -> list[str]:
    """What breaks a JSON schema (type, enum, required, properties, additionalProperties, items, bounds)."""
    out: list[str] = []
    kind = schema.get("type")
    if kind in ("number", "integer"):
        right = isinstance(value, int) and not isinstance(value, bool) or isinstance(value, float) and (kind == "number" or value.is_integer())
    else:
        right = kind is None or isinstance(value, _TYPES[kind])
    if not right:
        return [f"{where}: not of type {kind}"]
    if "enum" in schema and not any(value == x and isinstance(value, bool) == isinstance(x, bool) for x in schema["enum"]):
        out.append(f"{where}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if "minimum" in schema and value < schema["minimum"] or "maximum" in schema and value > schema["maximum"]:
            out.append(f"{where}: out of bounds")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{where}: {k} is missing" for k in schema.get("required", []) if k not in value]
        for k, v in sorted(value.items()):
            if k in known:
                out += violations(v, known[k], f"{where}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{where}: {k} is unknown")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += violations(v, schema["items"], f"{where}[{i}]")
    return out


def used_results(value: object) -> set[str]:
    """Call ids whose results an argument uses."""
    found, open_ = set(), [value]
    while open_:
        v = open_.pop()
        if isinstance(v, dict):
            if len(v) == 1 and isinstance(v.get("$result"), str):
                found.add(v["$result"])
            open_ += v.values()
        elif isinstance(v, list):
            open_ += v
    return found


def parse(role: str | None, text: str | None, turn: int | None, schemas: dict[str, dict], reply: str | None = None) -> dict:
    """One message: its canonical JSON, the ids it calls, answers and uses, and what is wrong with it."""
    body: object = None
    if text and text.lstrip()[:1] == "{":
        try:
            body = read_json(text)
        except ValueError:
            body = None  # a plain text
    message: dict = {"role": role, "content": text}
    calls, uses, errors, answers, asked, told = [], [], [], None, None, True
    if isinstance(body, dict) and isinstance(body.get("tool_calls"), list):
        message, asked = {"role": role, "content": body.get("content")}, body["tool_calls"]
    elif isinstance(body, dict) and isinstance(body.get("tool_call_id"), str):
        answers = body["tool_call_id"]
        message = {"role": role, "content": body.get("content")}
    elif reply and turn is not None and role == "user":
        asked, told = [{"id": f"turn-{turn}", "name": reply, "arguments": {"turn": turn}}], False
    elif reply and turn is not None and role == "assistant":
        answers, told = f"turn-{turn - 1}", False
    if asked is not None:
        made: list[dict] = []
        if told:
            message["tool_calls"] = made
        for call in asked:
            if not isinstance(call, dict) or not isinstance(call.get("id"), str):
                errors.append("a call has no id")
                continue
            name, given = call.get("name"), call.get("arguments")
            if isinstance(given, str):
                try:
                    given = read_json(given)
                except ValueError:
                    errors.append(f"{call['id']}: arguments are not JSON")
            if not isinstance(name, str) or name not in schemas:
                errors.append(f"{call['id']}: unknown tool")
            else:
                errors += [f"{call['id']}: {x}" for x in violations(given, schemas[name])]
            calls.append(call["id"])
            uses += sorted(used_results(given))
            made.append({"id": call["id"], "name": name, "arguments": given})
    if answers is not None and told:
        message["tool_call_id"] = answers
    safe = lambda xs: [escaped(x) for x in xs]
    return {"json": canonical(message), "calls": safe(calls), "uses": safe(uses), "answers": None if answers is None else escaped(answers), "errors": safe(errors)}


def ordered(edges: list[tuple[int, int]]) -> dict[int, tuple[int, int] | None]:
    """Sort key (at, level) of every turn of one conversation's links (from, to); None: it waits for itself."""
    after: dict[int, set[int]] = {}
    waits: dict[int, int] = {}
    for a, b in set(edges):
        after.setdefault(a, set()).add(b)
        waits[b] = waits.get(b, 0) + 1
    keys: dict[int, tuple[int, int] | None] = dict.fromkeys([*after, *waits])
    due = {t: (t, 0) for t in keys}
    ready = [t for t in keys if not waits.get(t)]
    while ready:
        t = ready.pop()
        keys[t] = due[t]
        for b in after.get(t, ()):
            due[b] = max(due[b], (due[t][0], due[t][1] + 1))
            waits[b] -= 1
            if not waits[b]:
                ready.append(b)
    return keys


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join that takes null conversations for one; the right side's keys go."""
    named = right.select(*[F.col(c).alias(f"_{c}") if c in on else F.col(c) for c in right.columns])
    out = left.join(named, [_same(c, f"_{c}") for c in on], how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_{c}" for c in on])


def _by_rounds(edges: DataFrame, kind: str) -> DataFrame:
    """(conv_id, turn, at, level) of conversations of any size: whatever waits for nothing any more gets its key."""
    here = ["conv_id", "turn"]
    pending = edges.select("conv_id", F.explode(F.array("a", "b")).alias("turn")).distinct()
    own, keys = F.struct(F.col("turn").alias("at"), F.lit(0).alias("level")), None
    while True:
        waits = _joined(edges, pending.withColumnRenamed("turn", "a"), ["conv_id", "a"], "left_semi").select("conv_id", F.col("b").alias("turn"))
        ready = _joined(pending, waits, here, "left_anti")
        if keys is None:
            fresh = ready.select(*here, own.alias("k"))
        else:
            due = _joined(edges, keys.withColumnRenamed("turn", "a"), ["conv_id", "a"])
            due = due.groupBy("conv_id", F.col("b").alias("turn")).agg(F.max(F.struct(F.col("k.at").alias("at"), (F.col("k.level") + 1).alias("level"))).alias("due"))
            fresh = _joined(ready, due, here, "left").select(*here, F.greatest(own, F.col("due")).alias("k"))
        fresh, n = cut_and_count(fresh)
        if not n:
            break
        keys = fresh if keys is None else cut_lineage(keys.unionByName(fresh))
        pending = cut_lineage(_joined(pending, fresh, here, "left_anti"))
    late = pending.select(*here, F.lit(None).cast(f"struct<at:{kind},level:int>").alias("k"))
    return (late if keys is None else keys.unionByName(late)).select(*here, "k.at", "k.level")


def _sort_keys(edges: DataFrame) -> DataFrame:
    """(conv_id, turn, at, level) of every linked turn; null keys: it waits for itself."""
    types = dict(edges.dtypes)
    edges = cut_lineage(edges)
    large, n = cut_and_count(edges.groupBy("conv_id").count().where(F.col("count") > GROUP).select("conv_id"))
    small = _joined(edges, large, ["conv_id"], "left_anti") if n else edges

    def run(table: pa.Table) -> pa.Table:
        keys = ordered(list(zip(table.column("a").to_pylist(), table.column("b").to_pylist())))
        conv = table.column("conv_id")[0].as_py()
        cols = [[conv] * len(keys), list(keys), [k and k[0] for k in keys.values()], [k and k[1] for k in keys.values()]]
        kinds = [table.schema.field("conv_id").type, table.schema.field("a").type, table.schema.field("a").type, pa.int32()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)], names=["conv_id", "turn", "at", "level"])

    schema = f"conv_id {types['conv_id']}, turn {types['a']}, at {types['a']}, level int"
    keys = small.groupBy("conv_id").applyInArrow(run, schema)
    return keys.unionByName(_by_rounds(_joined(edges, large, ["conv_id"], "left_semi"), types["a"])) if n else keys


def format_messages(df: DataFrame, schemas: dict[str, dict] | None = None, reply: str | None = None) -> DataFrame:
    """Per row of (conv_id, turn, role, text): conv_id, turn, at, level, role, answers_turn, problems, json.

    ``at`` and ``level`` order a conversation; ``answers_turn`` is the turn of the call that a
    result answers (the first, if an id is called again). ``problems`` lists schema violations,
    ids called again, results without a call, calls without a result, and cycles. Null roles and
    texts are formatted as JSON null; rows without a turn are never linked; rows without a
    conversation are one conversation. Texts that are no JSON, that JSON could not write (infinite
    numbers) or that are nested deeper than DEPTH are plain texts. Repeated rows are formatted each
    by itself and share their links; an empty table gives no rows; other columns are not read.
    """
    known = dict(schemas or {})
    rows = df.select("conv_id", "turn", "role", "text")
    kind = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"json": pa.string(), "calls": pa.list_(pa.string()), "uses": pa.list_(pa.string()), "answers": pa.string(), "errors": pa.list_(pa.string())}
        for batch in sliced(batches):
            found = [parse(r, t, n, known, reply) for n, r, t in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *[pa.array([x[k] for x in found], kind) for k, kind in kinds.items()]], ["conv_id", "turn", "role", *kinds])

    parsed = cut_lineage(rows.mapInArrow(run, f"conv_id {kind['conv_id']}, turn {kind['turn']}, role string, json string, calls array<string>, uses array<string>, answers string, errors array<string>"))
    linked = parsed.where("turn is not null")
    calls = linked.select("conv_id", F.explode("calls").alias("call"), "turn")
    called = calls.groupBy("conv_id", "call").agg(F.min("turn").alias("call_turn"))
    answered = linked.where("answers is not null").groupBy("conv_id", F.col("answers").alias("call")).agg(F.min("turn").alias("answer_turn"))
    theirs = answered.select(F.col("conv_id").alias("c"), F.col("call").alias("i"), "answer_turn")
    pairs = cut_lineage(called.join(theirs, _same("conv_id", "c") & (F.col("call") == F.col("i")), "left").select("conv_id", "call", "call_turn", "answer_turn"))
    # Links (from, to) between turns of a conversation.
    edges = pairs.where("answer_turn is not null").select("conv_id", F.col("call_turn").alias("a"), F.col("answer_turn").alias("b"))
    uses = linked.select("conv_id", F.explode("uses").alias("call"), F.col("turn").alias("b"))
    needs = _joined(uses, answered, ["conv_id", "call"]).select("conv_id", F.col("answer_turn").alias("a"), "b")
    keys = _sort_keys(edges.unionByName(needs).distinct())
    # Turns with calls: first calls that no result answers, and ids that were called before.
    first = _joined(calls.distinct(), pairs, ["conv_id", "call"])
    what = F.when(F.col("turn") > F.col("call_turn"), F.lit(": called again")).when(F.col("answer_turn").isNull(), F.lit(": no result"))
    open_ = first.where(what.isNotNull()).groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.concat("call", what))).alias("open"))
    notes = keys.withColumn("linked", F.lit(True)).select("conv_id", "turn", F.struct("at", "level", "linked").alias("k"))
    out = _joined(_joined(parsed, notes, ["conv_id", "turn"], "left"), open_, ["conv_id", "turn"], "left")
    out = _joined(out, pairs.select("conv_id", F.col("call").alias("answers"), "call_turn"), ["conv_id", "answers"], "left")
    empty = F.array().cast("array<string>")
    turned = F.col("turn").isNotNull()
    problems = F.concat(
        "errors",
        F.when(F.size("calls") > 0, F.coalesce("open", empty)).otherwise(empty),
        F.when(F.col("answers").isNotNull() & (F.col("call_turn").isNull() | ~turned), F.array(F.concat("answers", F.lit(": no call")))).otherwise(empty),
        F.when(F.col("k.linked") & F.col("k.at").isNull(), F.array(F.lit("cycle"))).otherwise(empty),
    )
    return out.select("conv_id", "turn", F.coalesce("k.at", "turn").alias("at"), F.coalesce("k.level", F.lit(0)).alias("level"), "role", F.when(turned, F.col("call_turn")).alias("answers_turn"), problems.alias("problems"), "json")


#: The same rows in SQL, for conversations in which no text is a JSON object; plain turns are linked by the tool ``reply``.
ORACLE = """
with m as (select *, row_number() over () as rid from conversations),
called as (select distinct conv_id, turn from m where role = 'user' and turn is not null),
answered as (select distinct conv_id, turn from m where role = 'assistant' and turn is not null)
select m.conv_id, m.turn, m.turn as at, cast(0 as integer) as level, m.role, case when m.role = 'assistant' then c.turn end as answers_turn,
  cast(case when m.role = 'assistant' and m.turn is not null and c.turn is null then 1 when m.role = 'user' and m.turn is not null and a.turn is null then 1 else 0 end as integer) as n_problems,
  '{"content":' || coalesce(to_json(text)::varchar, 'null') || ',"role":' || coalesce(to_json(role)::varchar, 'null')
  || '}' as json
from m left join called c on c.conv_id is not distinct from m.conv_id and c.turn = m.turn - 1
left join answered a on a.conv_id is not distinct from m.conv_id and a.turn = m.turn + 1
"""
