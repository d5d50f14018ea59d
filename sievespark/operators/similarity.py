"""Bit-vector fingerprints: packing, Tanimoto edges and their counts inside groups, novelty against a reference set, medoids.

Fingerprints meet in blocks of bounded size, and a block is one product of 0/1 matrices. What keeps
blocks apart are bounds: shared rare bits (edges of large groups), bit counts (novelty), and the
triangle inequality of the Tanimoto distance (medoids of large clusters).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sievespark.session import cut_lineage, drop

#: Fingerprints (about 300 bytes each at 2048 bits) that meet in one block.
BLOCK = 4096
#: Rows of a block that are multiplied at once.
STRIP = 1024
#: The same where each pair may be an edge to write (about 60 bytes each in Python).
ROWS = 256
#: Members of a large cluster that all others are measured against, for the bound.
PIVOTS = 16
#: Similarities are summed as whole numbers of this fraction, so that sums do not hang on their order.
UNIT = 1 << 40


def sign_bits(vector: Column, dims: int = 64) -> Column:
    """Words of 64 bits, bit i set where component i is positive."""
    words = []
    for start in range(0, dims, 64):
        part = F.slice(vector, start + 1, 64)
        words.append(F.aggregate(F.transform(part, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b)))
    return F.array(*words)


def shared_bits(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y)).cast("int")), F.lit(0), lambda s, n: s + n)


def all_bits(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseOR(y)).cast("int")), F.lit(0), lambda s, n: s + n)


def bit_count(fp: Column) -> Column:
    return F.aggregate(F.transform(fp, lambda x: F.bit_count(x).cast("int")), F.lit(0), lambda s, n: s + n)


def bit_matrix(fps: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """0/1 rows of word lists (shorter ones are filled up with 0)."""
    fps = fps.combine_chunks() if isinstance(fps, pa.ChunkedArray) else fps
    flat, sizes = fps.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(fps.offsets.to_numpy())
    words = np.zeros((len(fps), int(sizes.max(initial=0))), np.int64)
    words[np.repeat(np.arange(len(fps)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")


def _matrices(*fps: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """Matrices of one width, ready to be multiplied (products are exact up to 2^24 bits)."""
    out = [bit_matrix(f) for f in fps]
    wide = max(m.shape[1] for m in out)
    return [np.pad(m, ((0, 0), (0, wide - m.shape[1]))).astype(np.float32) for m in out]


def _shared(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shared bits, bits of either) of all rows of ``a`` with all of ``b``."""
    inter = (a @ b.T).astype(np.int64)
    return inter, a.sum(axis=1).astype(np.int64)[:, None] + b.sum(axis=1).astype(np.int64)[None] - inter


def _sorted(table: pa.Table, column: str) -> np.ndarray:
    return np.argsort(table.column(column).to_numpy(), kind="stable")


def _edge_schema(df: DataFrame, group: str, node: str) -> T.StructType:
    kinds = {"group": df.schema[group].dataType, "a": df.schema[node].dataType, "b": df.schema[node].dataType, "inter": T.IntegerType(), "uni": T.IntegerType()}
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


def linked(a: np.ndarray, b: np.ndarray, twentieths: int) -> np.ndarray:
    """Whether rows of ``a`` reach the threshold with rows of ``b``; whole numbers, exact in single precision."""
    n, m = a.sum(axis=1), b.sum(axis=1)
    return (a @ b.T) * np.float32(20 + twentieths) >= (n * twentieths)[:, None] + (m * twentieths)[None]


def _ranks(nodes: pa.Array) -> np.ndarray:
    """Places of nodes in their order; all 0 for kinds that Arrow cannot order."""
    try:
        return pc.rank(nodes, tiebreaker="dense").to_numpy()
    except (pa.ArrowNotImplementedError, pa.ArrowInvalid):
        return np.zeros(len(nodes), np.int64)


def _compared(table: pa.Table, twentieths: int, schema: pa.Schema, token: int | None = None, order: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Edges between the blocks ``i`` and ``j`` of one group, a few rows against a block at a time.

    With a ``token`` only those whose first shared bit, in ``order``, it is, so that a pair comes from
    one of its shared bits alone. Rows are taken by bit count: those too short or too long are not met.
    Edges come in runs, since nothing is as large as they are: all of a row, as ``a`` and then as ``b``,
    by shared bits and the bits of either. So written they take about half the bytes.
    """
    table = table.take(pa.array(_sorted(table, "n")))
    own, first, second = (table.column(c).to_numpy() for c in ("own", "i", "j"))
    left, right = np.flatnonzero(own == first), np.flatnonzero(own == second)
    (bits,) = _matrices(table.column("fp"))
    if order is not None:
        bits = bits[:, order[order < bits.shape[1]]]
    n = bits.sum(axis=1).astype(np.int64)
    node = table.column("node").combine_chunks()
    group = table.column("group")[0]
    rank = _ranks(node)
    for at in range(0, len(left), ROWS):
        some = left[at : at + ROWS]
        low, high = n[some[0]] * twentieths, n[some[-1]] * 20
        meet = right[(n[right] * 20 >= low) & (n[right] * twentieths <= high)]
        hit = linked(bits[some], bits[meet], twentieths)
        if first[0] == second[0]:
            hit &= some[:, None] < meet[None]
        x, y = np.nonzero(hit)
        del hit
        if token is not None and token >= 0 and len(x):
            once = np.concatenate([(bits[some[x[k : k + STRIP]]] * bits[meet[y[k : k + STRIP]]]).argmax(axis=1) for k in range(0, len(x), STRIP)]) == token
            x, y = x[once], y[once]
        if len(x):
            inter = (bits[some] @ bits[meet].T)[x, y].astype(np.int32)
            width = bits.shape[1] + 1
            place = (x * 2 + (rank[some[x]] > rank[meet[y]])) * width + inter
            runs = np.argsort(place.astype(np.uint16) if 2 * ROWS * width < 1 << 16 else place, kind="stable")  # partners ascend by bit count
            x, y, inter = x[runs], y[runs], inter[runs]
            uni = (n[some[x]] + n[meet[y]]).astype(np.int32) - inter
            yield pa.RecordBatch.from_arrays([pa.repeat(group, len(x)), node.take(pa.array(some[x])), node.take(pa.array(meet[y])), pa.array(inter), pa.array(uni)], schema=schema)


def _pairs_of_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """``rows`` with own (their block) once for each pair of blocks i <= j that they are in."""
    placed = rows.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other")


def _bit_order(rows: DataFrame) -> list[int]:
    """All bits, the rarest first; as many as a fingerprint has."""
    width = (rows.agg(F.max(F.size("fp"))).first()[0] or 0) * 64
    counted = rows.select(F.posexplode("fp").alias("w", "x")).select("w", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("b"), "x").where(F.expr("getbit(x, b) = 1"))
    seen = {r["at"]: r["c"] for r in counted.groupBy((F.col("w") * 64 + F.col("b")).alias("at")).agg(F.count(F.lit(1)).alias("c")).collect()}  # a row a bit
    return sorted(range(width), key=lambda i: (seen.get(i, 0), i))


def prefixes(rows: DataFrame, twentieths: int, order: list[int]) -> DataFrame:
    """(group, token, node, fp, n): each row once for each of its rarest bits that an edge cannot miss.

    A partner shares ceil(t n) bits, so one of the first n - ceil(t n) + 1 at least. A token is the
    bit's place in ``order``; rows without a bit have the token -1.
    """
    schema = T.StructType([*[rows.schema[c] for c in ("group", "node", "fp", "n")], T.StructField("token", T.IntegerType())])
    rank = np.array(order, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = bit_matrix(batch.column(2))
            bits = bits[:, rank[rank < bits.shape[1]]]
            n = batch.column(3).to_numpy()
            most = n - -(-n * twentieths // 20) + 1
            row, token = np.nonzero((bits == 1) & (np.cumsum(bits, axis=1, dtype=np.int32) <= most[:, None]))
            empty = np.flatnonzero(n == 0)
            row, token = np.concatenate([row, empty]), np.concatenate([token, np.full(len(empty), -1)])
            yield pa.RecordBatch.from_arrays([*[c.take(pa.array(row)) for c in batch.columns], pa.array(token.astype(np.int32))], schema.names)

    return rows.select("group", "node", "fp", "n").mapInArrow(run, schema)


def edges(df: DataFrame, group: str, node: str, fp: str, twentieths: int, plan: str = "auto") -> DataFrame:
    """(group, a, b, inter, uni) for pairs a < b of a group with Tanimoto of ``twentieths`` / 20 or more.

    The threshold is compared in integers. Made once at the lowest threshold, the edges serve every
    higher one. Groups are dealt into blocks of about BLOCK nodes and the blocks meet pair by pair
    (``plan="blocks"``). Groups so large that a row would be copied more often for that than it has
    rare bits to be joined by, and whose rare bits bring fewer pairs together, meet by these bits
    (``plan="bits"``); a bit that many rows have is dealt into blocks like a group. Both give the
    same edges. Rows without a group or fingerprint have none; a node that is there twice has none
    with itself.
    """
    rows = df.select(F.col(group).alias("group"), F.col(node).alias("node"), F.col(fp).alias("fp"), bit_count(F.col(fp)).alias("n")).where("group is not null and fp is not null")
    schema = _edge_schema(df, group, node)
    arrow = to_arrow_schema(schema)
    sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("size"))

    def in_blocks(some: DataFrame) -> DataFrame:
        sized = some.join(sizes.select("group", F.ceil(F.col("size") / BLOCK).alias("blocks")), "group")
        dealt = _pairs_of_blocks(sized, F.col("blocks")).groupBy("group", "i", "j")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _compared(pa.Table.from_batches(list(batches)), twentieths, arrow)

        return dealt.applyInArrow(run, schema)

    def by_bits(some: DataFrame) -> DataFrame:
        order = _bit_order(some)
        rank = np.array(order, np.int64)
        listed = prefixes(some, twentieths, order)
        lists = listed.groupBy("group", "token").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
        dealt = _pairs_of_blocks(listed.join(lists, ["group", "token"]), F.col("blocks")).groupBy("group", "token", "i", "j")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(list(batches))
            yield from _compared(table, twentieths, arrow, table.column("token")[0].as_py(), rank)

        return dealt.applyInArrow(run, schema)

    if plan == "bits":
        found = by_bits(rows)
    elif plan == "blocks" or not twentieths or sizes.where(F.col("size") > BLOCK).isEmpty():
        found = in_blocks(rows)
    else:
        large = rows.join(sizes.where(F.col("size") > BLOCK), "group")
        lists = prefixes(large.select("group", "node", "fp", "n"), twentieths, _bit_order(large)).groupBy("group", "token").agg(F.count(F.lit(1)).alias("c"))
        cost = lists.groupBy("group").agg(F.sum(F.col("c").cast("double") * F.col("c")).alias("met"), F.sum("c").alias("copies")).join(sizes, "group")
        better = cut_lineage(cost.where((F.col("met") < F.col("size") * F.col("size").cast("double")) & (F.col("copies") < F.col("size") * F.ceil(F.col("size") / BLOCK))).select("group"))
        found = in_blocks(rows.join(better, "group", "left_anti"))
        if not better.isEmpty():
            found = found.unionByName(by_bits(rows.join(better, "group", "left_semi")))
    return found.select("group", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "inter", "uni").where("a <> b")


def link_counts(df: DataFrame, group: str, node: str, fp: str, twentieths: Sequence[int]) -> DataFrame:
    """(group, node, n<k> for each k of ``twentieths``): how many others of the group are at Tanimoto k / 20 or more.

    Blocks meet as for the edges, but a pair of blocks gives its rows' counts only, so what is written
    grows with rows times blocks of their group, never with pairs. A node is one row of its group; rows
    without a group or fingerprint have no links.
    """
    names = [f"n{k}" for k in twentieths]
    rows = df.select(F.col(group).alias("group"), F.col(node).alias("node"), F.col(fp).alias("fp"), bit_count(F.col(fp)).alias("n"))
    schema = T.StructType([rows.schema["group"], rows.schema["node"], *[T.StructField(c, T.LongType()) for c in names]])
    arrow = to_arrow_schema(schema)

    def count(table: pa.Table) -> pa.Table:
        own, i, j = (table.column(c).to_numpy() for c in ("own", "i", "j"))
        same = i[0] == j[0]
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        (bits,) = _matrices(table.column("fp"))
        n = bits.sum(axis=1)
        # Unlike fractions of a union of w bits are 1 / 20 w apart, so half of that is room for rounding.
        kind = np.float32 if bits.shape[1] < 1 << 16 else np.float64
        bars = [kind(k / 20 - 1 / (40 * max(1, bits.shape[1]))) for k in twentieths]
        found = np.zeros((len(own), len(bars)), np.int64)
        for at in range(0, len(left), STRIP):
            some = left[at : at + STRIP]
            tc = (bits[some] @ bits[right].T).astype(kind, copy=False)
            uni = (n[some][:, None] + n[right][None]) - tc
            tc[uni == 0] = 1  # two empty ones are alike
            tc /= np.maximum(uni, 1, out=uni)
            if same:
                tc[np.arange(len(some)), np.arange(at, at + len(some))] = -1  # itself
            for c, bar in enumerate(bars):
                hit = tc >= bar
                found[some, c] += np.bitwise_count(np.packbits(hit, axis=1)).sum(axis=1, dtype=np.int64)
                if not same:
                    found[right, c] += hit.view(np.int8).sum(axis=0, dtype=np.int16)
        return pa.table([table.column("group"), table.column("node"), *[pa.array(x) for x in found.T]], schema=arrow)

    known = rows.where("group is not null and n is not null")
    sizes = known.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    met = _pairs_of_blocks(known.join(sizes, "group"), F.col("blocks")).groupBy("group", "i", "j").applyInArrow(count, schema)
    every = rows.select("group", "node", *[F.lit(0).cast("long").alias(c) for c in names]).unionByName(met)
    return every.groupBy("group", "node").agg(*[F.sum(c).alias(c) for c in names])


def max_similarity(df: DataFrame, node: str, fp: str, known: DataFrame, known_fp: str) -> DataFrame:
    """Per row of ``df`` the highest Tanimoto to a row of ``known``, a stated reference set of any size.

    References are put into blocks of neighbouring bit counts. A row with n bits is compared with the
    block of its own count first; its best similarity there is what a block of counts c must be able
    to beat, min(n, c) / max(n, c), to be visited at all. Inside a block references go from the
    nearest count outward, and a row stops when their bound falls to its best. Rows without a
    fingerprint are left out; without references nothing is returned; rows that repeat a node are one.
    """
    rows = df.select(F.col(node).alias("node"), F.col(fp).alias("fp"), bit_count(F.col(fp)).alias("n")).where("fp is not null")
    refs = known.select(F.col(known_fp).alias("fp"), bit_count(F.col(known_fp)).alias("n")).where("fp is not null")
    counts = {r["n"]: r["c"] for r in refs.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}  # a row a bit count
    lows, highs, of, size = [], [], {}, BLOCK
    for n, c in sorted(counts.items()):
        parts = -(-c // BLOCK)
        if parts > 1 or size + c > BLOCK:  # a count of many references has blocks of its own
            of[n] = (len(lows), parts)
            lows += [n] * parts
            highs += [n] * parts
            size = BLOCK if parts > 1 else c
        else:
            of[n] = (len(lows) - 1, 1)
            highs[-1] = n
            size += c
    low, high = np.array(lows, np.int64), np.array(highs, np.int64)
    cast = T.StructType([T.StructField("node", rows.schema["node"].dataType), T.StructField("tc", T.DoubleType())])
    arrow = to_arrow_schema(cast)
    if not counts:
        return df.sparkSession.createDataFrame([], T.StructType([T.StructField(node, rows.schema["node"].dataType), T.StructField("max_tc", T.DoubleType())]))
    table = df.sparkSession.createDataFrame([(n, at, parts) for n, (at, parts) in of.items()], "k int, at int, parts int")
    placed = refs.withColumn("u", F.monotonically_increasing_id()).join(F.broadcast(table), F.col("n") == F.col("k"))
    blocks = placed.select((F.col("at") + F.pmod(F.xxhash64("u"), F.col("parts"))).cast("int").alias("block"), "fp")
    asked = T.StructType([*rows.schema.fields, T.StructField("tc", T.DoubleType()), T.StructField("block", T.IntegerType())])

    def send(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n, best = batch.column(2).to_numpy()[:, None], batch.column(3).to_numpy()[:, None]
                nearest = np.clip(n, low[None], high[None])
                bound = np.minimum(n, nearest) / np.maximum(1, np.maximum(n, nearest))
                home = bound.argmax(axis=1)
                if first:
                    row, block = np.arange(len(n)), home
                else:
                    open_ = bound > best
                    open_[np.arange(len(n)), home] = False
                    row, block = np.nonzero(open_)
                yield pa.RecordBatch.from_arrays([*[c.take(pa.array(row)) for c in batch.columns], pa.array(block.astype(np.int32))], asked.names)

        return run

    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return arrow.empty_table()
        ours, theirs = _matrices(left.column("fp"), right.column("fp"))
        mine, other, best = ours.sum(axis=1).astype(np.int64), theirs.sum(axis=1).astype(np.int64), left.column("tc").to_numpy().copy()
        for n in np.unique(mine):
            live = np.flatnonzero(mine == n)
            kinds = np.unique(other)
            bounds = np.minimum(n, kinds) / np.maximum(1, np.maximum(n, kinds))
            for k in np.argsort(-bounds, kind="stable"):
                live = live[best[live] < bounds[k]]
                if not len(live):
                    break
                meet = np.flatnonzero(other == kinds[k])
                for at in range(0, len(live), STRIP):
                    some = live[at : at + STRIP]
                    inter, uni = _shared(ours[some], theirs[meet])
                    best[some] = np.maximum(best[some], (inter / np.maximum(uni, 1)).max(axis=1))
        return pa.table([left.column("node"), pa.array(np.maximum(best, 0.0))], schema=arrow)

    def round_(some: DataFrame, first: bool) -> DataFrame:
        return some.select("node", "fp", "n", "tc").mapInArrow(send(first), asked).groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(visit, cast)

    start = cut_lineage(rows.withColumn("tc", F.lit(-1.0)))
    near = cut_lineage(round_(start, True))
    if len(lows) == 1:
        met = near
    else:
        best = near.groupBy(F.col("node").alias("k")).agg(F.max("tc").alias("tc"))
        met = near.unionByName(round_(start.drop("tc").join(best, F.col("node").eqNullSafe(F.col("k"))), False))
    return met.groupBy(F.col("node").alias(node)).agg(F.max("tc").alias("max_tc"))


def _sums(dealt: DataFrame, cluster: list[str], node: T.DataType) -> DataFrame:
    """(cluster, node, total): each row of block ``i`` against those of block ``j``, whose pairs stay in the task."""
    schema = T.StructType([*[dealt.schema[c] for c in cluster], T.StructField("node", node), T.StructField("total", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
        (bits,) = _matrices(table.column("fp"))
        place, total = table.column("place").to_numpy(), np.zeros(len(left), np.int64)
        for at in range(0, len(left), STRIP):
            some = left[at : at + STRIP]
            inter, uni = _shared(bits[some], bits[right])
            sims = np.floor(inter / np.maximum(uni, 1) * UNIT + 0.5).astype(np.int64)
            sims[place[some][:, None] == place[right][None]] = 0  # itself
            total[at : at + STRIP] = sims.sum(axis=1)
        first = table.take(pa.array(left))
        return pa.table([*[first.column(c) for c in cluster], first.column("node"), pa.array(total)], schema=arrow)

    return dealt.groupBy(*cluster, "i", "j").applyInArrow(run, schema)


def cluster_medoids(members: DataFrame, cluster: Sequence[str], node: str = "node", fp: str = "fp", pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """(cluster, medoid): the member with the highest mean Tanimoto to the others; ties go to the smallest node.

    Sums are made block against block; no pair leaves a task. In clusters of more than one block
    every member is first measured against a few pivots: the Tanimoto distance is a metric, so
    n d(a, p) - E(p) and E(p) - n d(a, p) bound the sum E(a) of a member's distances from below, and
    members whose bound is above the best pivot's sum are not summed. Members without a fingerprint
    are left out (a cluster of none has no medoid); a lone member is its own. Clusters may be null.
    """
    cluster = list(cluster)
    kind = members.schema[node].dataType
    rows = members.where(F.col(fp).isNotNull()).select(*[F.col(c).alias(f"g{i}") for i, c in enumerate(cluster)], F.col(node).alias("node"), F.col(fp).alias("fp"))
    keys = [f"g{i}" for i in range(len(cluster))]
    same = lambda a, b: reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])
    rows = cut_lineage(rows.withColumn("place", F.monotonically_increasing_id()))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    placed = cut_lineage(rows.alias("a").join(sizes.alias("b"), same("a", "b")).select("a.*", "size", "blocks", F.pmod(F.xxhash64("place"), F.col("blocks")).cast("int").alias("own")))
    small, large = placed.where("blocks = 1"), placed.where("blocks > 1")
    asking = small
    old = [rows, placed]
    if not large.isEmpty():
        first = Window.partitionBy(*keys).orderBy(F.xxhash64("place"))
        chosen = large.withColumn("k", F.row_number().over(first)).where(F.col("k") <= pivots).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("k", "fp"))).alias("p"))  # a few a cluster
        with_ = large.alias("a").join(chosen.alias("b"), same("a", "b")).select("a.*", F.col("p.fp").alias("p"))

        def distance(a: Column, b: Column) -> Column:
            uni = all_bits(a, b)
            return F.when(uni > 0, 1 - shared_bits(a, b) / uni).otherwise(1.0)

        far = cut_lineage(with_.select(*placed.columns, F.transform("p", lambda x: distance(F.col("fp"), x)).alias("d")))
        # A pivot's distance to itself is 0 for all but empty fingerprints; one more distance is no matter for a bound that is lowered by 2.
        sums = far.groupBy(*keys).agg(F.array(*[F.sum(F.try_element_at("d", F.lit(i + 1))) for i in range(pivots)]).alias("e"))
        bound = F.array_max(F.zip_with("d", "e", lambda d, e: F.abs(e - F.col("size") * d)))
        asking = small.unionByName(far.alias("a").join(sums.alias("b"), same("a", "b")).where(bound - 2 <= F.array_min("e") + 2).select(*[f"a.{c}" for c in placed.columns]))
        old.append(far)
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    # Askers and those asked are dealt by blocks of their own; a pair of blocks is one task.
    asks = asking.withColumns({"asks": F.lit(True), "i": F.col("own")}).withColumn("j", each)
    asked = placed.withColumns({"asks": F.lit(False), "j": F.col("own")}).withColumn("i", each)
    columns = [*keys, "node", "fp", "place", "own", "asks", "i", "j"]
    partial = _sums(asks.select(*columns).unionByName(asked.select(*columns)), keys, kind)
    total = partial.groupBy(*keys, "node").agg(F.sum("total").alias("total"))
    out = cut_lineage(total.groupBy(*keys).agg(F.min_by("node", F.struct((-F.col("total")).alias("t"), F.col("node"))).alias("medoid")))
    drop(*old)
    return out.select(*[F.col(k).alias(c) for k, c in zip(keys, cluster)], "medoid")
