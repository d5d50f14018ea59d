"""Mixing overlapping sources to target weights by min-cost flow.

1. Documents are aggregated by membership pattern (the set of sources they belong to).
2. A flow network routes token capacity from patterns to source quotas. Each pattern offers its
   tokens in layers, one per repetition; layer r costs r**2, so cost is convex in repetition and
   the flow repeats nothing before it has used fresh text elsewhere.
3. Each pattern's routed tokens are turned into documents in the order of a seeded hash: all
   complete passes, then a prefix of the order whose last document is cut where the quota ends.

Only per-pattern and per-hash-range sums reach the driver or a single task. The cut of a hot
pattern is found by two histograms over the hash (each ``BINS`` sums per pattern) and then within
one of ``BINS``**2 hash ranges, so no task ever sorts a pattern.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievespark.llm.common import word_count
from sievespark.session import cut_lineage

BINS = 1024
#: Patterns whose plan may be broadcast (about 100 bytes each); a longer plan is joined.
BROADCAST_PATTERNS = 100_000


def targets(sizes: list[int], weights: list[float], budget: float, cap: float) -> list[float]:
    """Share ``budget`` by weight; no target above ``cap`` times its size, the excess is reshared."""
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(budget)
    while open_ and left > 0:
        total = sum(weights[i] for i in open_)
        if total <= 0:
            break
        full = [i for i in open_ if left * weights[i] / total > cap * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = cap * float(sizes[i])
            open_.discard(i)
        left = float(budget) - sum(out[i] for i in range(len(sizes)) if i not in open_)
    return out


def min_cost_flow(capacity: list[int], member: list[list[int]], quota: list[int], repeats: int) -> list[list[int]]:
    """Tokens each pattern sends to each of its sources (aligned with ``member``).

    start -> pattern (``repeats`` parallel layers of the pattern's capacity, cost r**2), pattern ->
    source (free), source -> end (its quota). Patterns of a single source that no other pattern
    shares are settled at once. For the rest, primal-dual: potentials by shortest paths, then
    blocking flows over the edges that cost nothing, so there is one round for each different cost
    of a path, not for each path.
    """
    patterns: dict[int, list[int]] = {}
    for p, sources in enumerate(member):
        for s in sources:
            patterns.setdefault(s, []).append(p)
    sent = [[0] * len(m) for m in member]
    tied = [p for p, m in enumerate(member) if len(m) != 1 or len(patterns[m[0]]) > 1]
    for p in set(range(len(member))).difference(tied):
        sent[p] = [min(quota[member[p][0]], repeats * capacity[p])]
    names = {s: i for i, s in enumerate(sorted({s for p in tied for s in member[p]}))}
    n_p = len(tied)
    start, end = n_p + len(names), n_p + len(names) + 1
    head: list[int] = []
    room: list[int] = []
    cost: list[int] = []
    out: list[list[int]] = [[] for _ in range(end + 1)]

    def edge(a: int, b: int, c: int, w: int) -> int:
        for x, y, r, k in ((a, b, c, w), (b, a, 0, -w)):
            out[x].append(len(head))
            head.append(y)
            room.append(r)
            cost.append(k)
        return len(head) - 2

    for i, p in enumerate(tied):
        for r in range(1, repeats + 1):
            edge(start, i, capacity[p], r * r)
    arcs = [[edge(i, n_p + names[s], 1 << 62, 0) for s in member[p]] for i, p in enumerate(tied)]
    for s, i in names.items():
        edge(n_p + i, end, quota[s], 0)
    height = [0] * (end + 1)

    def raised() -> bool:
        """Shortest distances by reduced cost, added to the potentials; False if the end is out of reach."""
        dist, heap, done = {start: 0}, [(0, start)], set()
        while heap:
            d, v = heapq.heappop(heap)
            if v in done:
                continue
            done.add(v)
            for e in out[v]:
                if room[e] > 0 and (w := d + cost[e] + height[v] - height[head[e]]) < dist.get(head[e], 1 << 62):
                    dist[head[e]] = w
                    heapq.heappush(heap, (w, head[e]))
        if end not in dist:
            return False
        for v in range(end + 1):
            height[v] += min(dist.get(v, dist[end]), dist[end])
        return True

    def free(v: int, e: int) -> bool:
        return room[e] > 0 and cost[e] + height[v] == height[head[e]]

    def levels() -> list[int]:
        level = [-1] * (end + 1)
        level[start], queue = 0, [start]
        for v in queue:
            for e in out[v]:
                if level[head[e]] < 0 and free(v, e):
                    level[head[e]] = level[v] + 1
                    queue.append(head[e])
        return level

    while raised():
        while (level := levels())[end] >= 0:
            at = [0] * (end + 1)
            path: list[int] = []
            v = start
            while True:
                if v == end:
                    flow = min(room[e] for e in path)
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    v, path = start, []
                while at[v] < len(out[v]) and not (level[head[out[v][at[v]]]] == level[v] + 1 and free(v, out[v][at[v]])):
                    at[v] += 1
                if at[v] < len(out[v]):
                    path.append(out[v][at[v]])
                    v = head[path[-1]]
                elif path:
                    v = head[path.pop() ^ 1]
                    at[v] += 1
                else:
                    break
    for i, p in enumerate(tied):
        sent[p] = [room[e ^ 1] for e in arcs[i]]
    return sent


def plan_mix(patterns: list[tuple[list[str | None], int]], weight_cycle: tuple[float, ...], share: float, cap: int) -> tuple[list[str | None], list[int], list[float], list[int]]:
    """Sources in order, their sizes and targets, and the tokens to take from each pattern."""
    sources: list[str | None] = sorted({s for m, _ in patterns for s in m if s is not None})
    if any(s is None for m, _ in patterns for s in m):
        sources.append(None)
    index = {s: i for i, s in enumerate(sources)}
    sizes = [0] * len(sources)
    for m, n in patterns:
        for s in set(m):
            sizes[index[s]] += n
    total = sum(n for _, n in patterns)
    goal = targets(sizes, [weight_cycle[i % len(weight_cycle)] for i in range(len(sources))], share * total, cap)
    quota = [min(int(g + 0.5), cap * n) for g, n in zip(goal, sizes)]
    sent = min_cost_flow([n for _, n in patterns], [[index[s] for s in dict.fromkeys(m)] for m, _ in patterns], quota, cap)
    return sources, sizes, goal, [sum(x) for x in sent]


def mix_sources(df: DataFrame, id_col: str, size: Column, members: Column, seed: int = 0, weight_cycle: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2, keep: Column | None = None, also: Column | None = None) -> DataFrame:
    """Per row of ``df``: ``keep``, id, size, pattern (array of sources), copies, part, taken.

    ``copies`` complete passes over the row plus the first ``part`` words of one more are taken;
    ``taken = copies * size + part`` never exceeds ``cap * size``. Null and empty texts have size 0
    and are never taken; a null source is a source of its own, sorted last; repeated rows count as
    separate rows and are taken alike if their ids are equal and they lie before the cut (ties of
    the hash are ordered by id and size, equal rows share the cut evenly in order). An empty
    table gives an empty result. ``keep`` comes as column ``kept``; other columns of ``df`` are
    dropped, so no name can clash. ``also`` (a string) goes into the hash beside the id, so that rows
    without an id are not all in one place. One row a pattern comes to the driver, however many there are.
    """
    spark = df.sparkSession
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(df[id_col].cast("string"), F.lit("null")), F.lit(":"), also if also is not None else F.lit("")))
    shown = df.select(*([keep.alias("kept")] if keep is not None else []), df[id_col].alias("id"), size.alias("size"), F.array_sort(F.array_distinct(members)).alias("pattern"), F.conv(F.substring(hashed, 1, 15), 16, 10).cast("long").alias("h"))
    base = cut_lineage(shown.select("id", "size", "pattern", "h"))
    span = (1 << 60) // BINS
    first, second = F.expr(f"h div {span}L"), F.expr(f"(h % {span}L) div {span // BINS}L")
    sums = base.groupBy("pattern").agg(F.sum("size").alias("n"))
    found = sorted(sums.collect(), key=lambda r: [(s is None, s or "") for s in r["pattern"] or []])
    patterns = [(list(r["pattern"]), int(r["n"])) for r in found if r["pattern"]]
    sources, sizes, goal, sent = plan_mix(patterns, weight_cycle, share, cap)
    known = {s: (n, g) for s, n, g in zip(sources, sizes, goal)}
    rows = [(m, t // n if n else 0, t % n if n else 0, known[m[0]][0], known[m[0]][1]) for (m, n), t in zip(patterns, sent)]
    kinds = pa.list_(pa.string())
    cols = list(zip(*rows)) if rows else [[]] * 5
    table = pa.table([pa.array(list(cols[0]), kinds), *[pa.array(list(c), t) for c, t in zip(cols[1:], (pa.int64(), pa.int64(), pa.int64(), pa.float64()))]], names=["p", "copies", "rest", "source_size", "target"])
    small = F.broadcast if table.num_rows <= BROADCAST_PATTERNS else lambda d: d
    plan = small(spark.createDataFrame(table))
    same = lambda a, b: a.eqNullSafe(b)

    # The cut: the hash range, of BINS and then of BINS within it, where the running sum passes `rest`.
    def cut(hist: DataFrame, by: str, rest: str) -> DataFrame:
        run = Window.partitionBy("p").orderBy(by)
        runs = hist.withColumn("before", F.sum("n").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n"))
        return runs.where((F.col("before") <= F.col(rest)) & (F.col("before") + F.col("n") > F.col(rest)))

    h1 = base.groupBy(F.col("pattern").alias("q"), first.alias("b1")).agg(F.sum("size").alias("n"))
    h1 = h1.join(plan, same(F.col("q"), F.col("p"))).select("p", "b1", "n", "rest")
    c1 = cut(h1.where("n > 0"), "b1", "rest").select("p", "b1", (F.col("rest") - F.col("before")).alias("rest1"))
    c1 = small(cut_lineage(c1))  # one row a pattern
    h2 = base.join(c1, same(F.col("pattern"), F.col("p")) & (first == F.col("b1"))).groupBy("p", "b1", second.alias("b2")).agg(F.sum("size").alias("n"), F.first("rest1").alias("rest1"))
    c2 = cut(h2.where("n > 0"), "b2", "rest1").select("p", F.col("b1"), "b2", (F.col("rest1") - F.col("before")).alias("rest2"))
    c2 = small(cut_lineage(c2))
    # Rows of the one range of each pattern that holds the cut, in order.
    order = Window.partitionBy("p").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = base.join(c2, same(F.col("pattern"), F.col("p")) & (first == F.col("b1")) & (second == F.col("b2"))).where("size > 0")
    edge = edge.select("p", "id", "size", "h", "rest2").withColumn("before", F.sum("size").over(order) - F.col("size"))
    edge = edge.select(F.col("p").alias("ep"), F.col("h").alias("eh"), F.col("id").alias("eid"), F.col("size").alias("esize"), F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest2") - F.col("before"))).alias("part"))
    edge = edge.groupBy("ep", "eh", "eid", "esize").agg(F.sort_array(F.collect_list("part"), asc=False).alias("parts"))
    full = (shown if keep is not None else base).join(plan, same(F.col("pattern"), F.col("p")), "left").drop("p")
    full = full.join(c2.select(F.col("p").alias("cp"), F.col("b1").alias("cb1"), F.col("b2").alias("cb2")), same(F.col("pattern"), F.col("cp")), "left")
    here = F.struct(first, second)
    there = F.struct(F.col("cb1"), F.col("cb2"))
    inside = full.withColumn("at", F.when(F.col("cp").isNull() | (F.col("size") == 0), 0).when(here < there, 1).when(here > there, 0).otherwise(2))
    settled = inside.where("at < 2").withColumn("part", F.when(F.col("at") == 1, F.col("size")).otherwise(F.lit(0)).cast("long"))
    # Equal rows (same id and size) of the cut's range take the parts of their group in turn.
    twin = Window.partitionBy("pattern", "h", "id", "size").orderBy(F.lit(0))
    open_ = inside.where("at = 2").withColumn("turn", F.row_number().over(twin))
    open_ = open_.join(edge, same(F.col("pattern"), F.col("ep")) & (F.col("h") == F.col("eh")) & same(F.col("id"), F.col("eid")) & (F.col("size") == F.col("esize")), "left")
    open_ = open_.withColumn("part", F.coalesce(F.element_at("parts", F.col("turn")), F.lit(0)).cast("long"))
    final = [*(["kept"] if keep is not None else []), "id", "size", "pattern", "source_size", "target", F.coalesce(F.col("copies"), F.lit(0)).cast("long").alias("copies"), "part"]
    both = settled.select(*final).unionByName(open_.select(*final))
    done = both.withColumn("copies", F.when(F.col("part") == F.col("size"), F.col("copies") + F.when(F.col("size") > 0, 1).otherwise(0)).otherwise(F.col("copies")))
    done = done.withColumn("part", F.when(F.col("part") == F.col("size"), F.lit(0)).otherwise(F.col("part")))
    return done.withColumn("taken", F.col("copies") * F.col("size") + F.col("part"))


def _digest(docs: DataFrame) -> Column:
    return F.md5(F.coalesce(docs["text"], F.lit("")))


def mix_documents(docs: DataFrame, seed: int = 0, **how: object) -> DataFrame:
    """The mix over a documents table, each row's ``source`` its only membership.

    Returns doc_id, size, source_size, target, taken, copies, part; see :func:`mix_sources`.
    """
    mixed = mix_sources(docs, "doc_id", word_count(docs["text"]), F.array(docs["source"]), seed, also=_digest(docs), **how)
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", F.round("target", 6).alias("target"), "taken", "copies", "part")


def mixed_rows(docs: DataFrame, seed: int = 0, **how: object) -> DataFrame:
    """``docs`` as the mix takes it, each row ``copies`` times; the row at the cut once more, whole, if half of it or more is due.

    The columns of ``docs`` stay as they are; a source's words miss its target by half a document at most.
    """
    cols = docs.columns
    row = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(cols)])
    mixed = mix_sources(docs, "doc_id", word_count(docs["text"]), F.array(docs["source"]), seed, keep=row, also=_digest(docs), **how)
    turns = F.col("copies") + F.when((F.col("part") > 0) & (2 * F.col("part") >= F.col("size")), 1).otherwise(0)
    rows = mixed.withColumn("turns", turns).where("turns > 0").select("kept", F.explode(F.sequence(F.lit(1).cast("long"), F.col("turns"))))
    return rows.select(*[F.col("kept")[f"c{i}"].alias(c) for i, c in enumerate(cols)])


#: The rows of the mix in SQL (seed 0, one source a document): the level of the targets, then each source's documents by hash.
ORACLE = r"""
with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    cast('0x' || substr(md5('0:' || coalesce(cast(doc_id as varchar), 'null') || ':' || md5(coalesce(text, ''))), 1, 15) as bigint) as h from documents),
s as (select source, cast(sum(size) as bigint) as n, [3.0::double, 1.0, 2.0][cast((row_number() over (order by source nulls last) - 1) % 3 as integer) + 1] as w from d group by source),
r as (select *, 2.0::double * n / w as full_at, 1.5::double * sum(n) over () as budget,
    coalesce(sum(2.0::double * n) over (order by 2.0::double * n / w, source rows between unbounded preceding and 1 preceding), 0) as spent,
    sum(w) over (order by 2.0::double * n / w, source rows between current row and unbounded following) as open_w from s),
l as (select max((budget - spent) / open_w) filter ((budget - spent) / open_w <= full_at) as level from r),
t as (select source, n, least(2.0::double * n, coalesce(level, 2.0::double * n / w) * w) as target from r, l),
q as (select *, least(cast(floor(target + 0.5) as bigint), 2 * n) as quota from t),
p as (select d.doc_id, d.size, q.n, q.target, case when q.n > 0 then q.quota // q.n else 0 end as copies, case when q.n > 0 then q.quota % q.n else 0 end as rest,
    sum(d.size) over (partition by d.source order by h, d.doc_id nulls first, d.size rows between unbounded preceding and current row) - d.size as before
  from d join q on d.source is not distinct from q.source),
x as (select *, greatest(0, least(size, rest - before)) as part from p),
y as (select doc_id, size, n, target, case when part = size and size > 0 then copies + 1 else copies end as copies, case when part = size then 0 else part end as part from x)
select doc_id, size, n as source_size, round(target, 6) as target, cast(copies * size + part as bigint) as taken, cast(copies as bigint) as copies, cast(part as bigint) as part from y
"""
