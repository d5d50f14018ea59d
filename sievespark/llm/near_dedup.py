"""Near-duplicates by HyperMinHash, banding and exact verification.

Each document's set of word shingles is hashed to 64 bits. For every one of ``BANDS * ROWS`` hash
functions the minimum is stored as a HyperMinHash register: its count of leading zeros and the
mantissa bits after them, 16 bits in all. Documents with equal sets are one class; bands of ``ROWS``
registers bring classes together in buckets.

1. In every bucket, pairs with two pivots are made. A pair first has to pass the Jaccard estimate
   from the compressed registers, corrected for chance collisions; then the full sets are compared.
   That connects nearly all that belongs together.
2. Buckets that still hold several components are compared in blocks of bounded size, in place: the
   same estimate, then the full sets, for all pairs of different components. No pair is ever written.

A pair at the threshold of 0.8 misses all bands with probability (1 - 0.8**5)**36 < 1e-6, and the
estimate with less than 1e-9.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievespark.llm.common import orderable, sliced
from sievespark.llm.graph import components, compose
from sievespark.session import cut_and_count, cut_lineage, drop

BANDS, ROWS = 36, 5
#: How far below the threshold the estimate from all registers may fall (seven deviations).
SLACK = 0.21
MANTISSA = 10
#: Classes, and their shingles, in one block of a bucket.
BLOCK, WEIGHT = 512, 1 << 21
#: Slots of the table that says which texts are wanted again (2 to 4 MB).
SLOTS = 1 << 18
STEP = 1 << 14
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(33))) * _M2
    return h ^ (h >> np.uint64(33))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse, modulo 2**64."""
    size = max(1 << 16, 1 << n.bit_length())
    if not any(k >= n for k in _POWERS):
        _POWERS.clear()
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return next(iter(_POWERS.values()))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of lower-cased UTF-8 bytes."""
    if not data:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    raw = np.frombuffer(data, np.uint8)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(raw))
    total = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], dtype=np.uint64)])
    h = (total[ends] - total[starts]) * down[starts]
    return _mixed(h ^ ((ends - starts).astype(np.uint64) * _M2)), starts


def shingle_sets(texts: list[bytes], width: int = 2) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text (lower-cased UTF-8)."""
    hashes, starts = word_hashes(b" ".join(texts))
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    edges = np.searchsorted(starts, at)
    joined = hashes
    for k in range(1, width):
        joined = _mixed(joined[:-1] * _M1 + hashes[k:]) if len(joined) > 1 else joined[:0]
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(joined[a : b - width + 1]))
        elif b > a:  # fewer words: the whole sequence is one shingle
            out.append(np.frombuffer(hashlib.blake2b(hashes[a:b].tobytes(), digest_size=8).digest(), np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _functions(n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers [text, function] of 16 bits: leading zeros, then mantissa bits."""
    k = BANDS * ROWS
    scale, shift = _functions(k)
    low = np.empty((len(sets), k), np.uint64)
    i = 0
    while i < len(sets):
        j, size = i, 0
        while j < len(sets) and (j == i or size + len(sets[j]) <= STEP):
            size += len(sets[j])
            j += 1
        part = np.concatenate(sets[i:j])
        at = np.cumsum([0] + [len(s) for s in sets[i:j]])[:-1]
        for f in range(k):
            low[i:j, f] = np.minimum.reduceat(part * scale[f] + shift[f], at)
        i = j
    # Leading zeros, from the exponent of the top 53 bits (exact as float64).
    top = (low >> np.uint64(11)).astype(np.float64)
    bits = np.frexp(top)[1].astype(np.int64) + 11
    bits[top == 0] = 0
    zeros = np.minimum(63, 64 - bits)
    mantissa = (low << (zeros.astype(np.uint64) + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return ((zeros << MANTISSA) | mantissa.astype(np.int64)).astype(">u2")


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimate of register rows, corrected for collisions of different minima."""
    return corrected((a == b).mean(axis=1))


def corrected(equal: np.ndarray) -> np.ndarray:
    """Share of equal registers, less what chance adds."""
    # Two different minima of n and m values agree in zeros and mantissa about once in 1.5 * 2**MANTISSA.
    chance = 1.0 / (1.5 * (1 << MANTISSA))
    return np.clip((equal - chance) / (1 - chance), 0, 1)


def _packed(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace").lower()


def _runs(texts: list[bytes], most: int = 1 << 20) -> Iterator[list[bytes]]:
    """Texts in runs of about ``most`` bytes."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size < most):
            size += len(texts[to])
            to += 1
        yield texts[at:to]
        at = to


def _described(texts: list[bytes], width: int) -> tuple[list[bytes | None], list[int], list[bytes | None]]:
    """Digest of the shingle set (None if empty), its size and its registers, for each text."""
    digests: list[bytes | None] = []
    counts: list[int] = []
    regs: list[bytes | None] = []
    for run in _runs(texts):
        sets = shingle_sets(run, width)
        full = [s for s in sets if len(s)]
        found = iter(registers(full)) if full else iter(())
        for s in sets:
            counts.append(len(s))
            digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            regs.append(next(found).tobytes() if len(s) else None)
    return digests, counts, regs


def signatures(df: DataFrame, id_col: str, text_col: str, width: int = 2) -> DataFrame:
    """doc_id, digest of the shingle set (null if empty), n (its size), regs."""
    rows = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            digests, counts, regs = _described([_packed(t) for t in batch.column(1).to_pylist()], width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), pa.array(regs, pa.binary())], ["doc_id", "digest", "n", "regs"])

    return rows.mapInArrow(run, "doc_id long, digest binary, n long, regs binary")


def _bodies(df: DataFrame, id_col: str, text_col: str, nodes: DataFrame, width: int) -> DataFrame:
    """rep, n, regs and compressed lower-cased text of the ``nodes`` (and of a few more), one row a text.

    A table of SLOTS slots of the nodes' hashes is sent out, so that most other texts are never packed.
    """
    slot = F.pmod(F.xxhash64("rep"), F.lit(SLOTS))
    slots = F.broadcast(nodes.select(slot.alias("slot")).distinct())  # at most SLOTS rows
    rows = df.select(df[id_col].cast("long").alias("rep"), df[text_col].alias("text")).where("rep is not null and text is not null")
    rows = rows.join(slots, slot == F.col("slot"), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in sliced(batches):
            texts = [_packed(t) for t in batch.column(1).to_pylist()]
            digests, counts, regs = _described(texts, width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), pa.array(regs, pa.binary()), pa.array([press.compress(t) for t in texts], pa.binary())], ["rep", "digest", "n", "regs", "body"])

    packed = rows.mapInArrow(run, "rep long, digest binary, n long, regs binary, body binary").where("digest is not null")
    return cut_lineage(packed.dropDuplicates(["rep", "digest"]).drop("digest"))


def _fits(n: str, m: str, threshold: float) -> Column:
    """Sets of these sizes can reach the threshold."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * round(100 * threshold)


def _members(classes: DataFrame) -> DataFrame:
    """(key, band, rep, n, m, place) of classes that share a bucket; m: its size, place: the most central class comes first."""
    band = lambda i: F.xxhash64(i, F.substring(F.col("regs"), i * (2 * ROWS) + 1, F.lit(2 * ROWS)))
    rows = classes.select("rep", "n", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), band)).alias("band", "key"))
    members = cut_lineage(rows.join(rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "key"))
    # How often a class meets others: the middle of a group of variants meets the most.
    central = members.groupBy("rep").agg(F.sum("m").alias("met"))
    place = -F.least("met", F.lit(1 << 38)) * (1 << 24) + F.pmod(F.xxhash64("rep"), F.lit(1 << 24))
    out = cut_lineage(members.join(central, "rep").select("key", "band", "rep", "n", place.alias("place")))
    drop(members)
    return out


def _pivot_links(members: DataFrame, bodies: DataFrame, threshold: float, width: int) -> DataFrame:
    """Links (a, b) between members and two pivots of their buckets: the most central class, and the first by hash."""
    firsts = [[F.min_by(c, o).alias(f"{c}{i}") for c in ("rep", "n")] for i, o in enumerate((F.col("place"), F.xxhash64("rep")))]
    pivots = members.groupBy("key").agg(*firsts[0], *firsts[1])
    met = members.join(pivots, "key").select("rep", "n", F.explode(F.array(*[F.struct(F.col(f"rep{i}").alias("b"), F.col(f"n{i}").alias("m")) for i in range(2)])).alias("p")).select("rep", "n", "p.b", "p.m")
    pairs = met.where((F.col("rep") != F.col("b")) & _fits("n", "m", threshold))
    pairs = pairs.select(F.greatest("rep", "b").alias("rep"), F.least("rep", "b").alias("b")).groupBy("rep").agg(F.collect_set("b").alias("bs"))  # two a band at most
    one = pairs.join(bodies, "rep").select(F.col("rep").alias("a"), F.col("regs").alias("ra"), F.col("body").alias("ba"), F.explode("bs").alias("rep"))
    both = one.join(bodies.select("rep", "regs", "body"), "rep").select("a", F.col("rep").alias("b"), "ra", F.col("regs").alias("rb"), "ba", F.col("body").alias("bb"))
    percent = round(100 * threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        last: tuple[bytes, np.ndarray] = (b"", np.zeros(0, np.uint64))
        for batch in sliced(batches):
            ra, rb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), ">u2").reshape(batch.num_rows, -1) for i in (2, 3))
            batch = batch.filter(pa.array(estimate(ra, rb) >= threshold - SLACK)).select(["a", "b", "ba", "bb"])
            keep, right = [], iter(batch.column(3).to_pylist())
            for part in _runs([unpack.decompress(x) for x in batch.column(2).to_pylist()]):
                for left in shingle_sets(part, width):
                    body = next(right)
                    if body != last[0]:  # sorted by b, where the join sorts
                        last = (body, shingle_sets([unpack.decompress(body)], width)[0])
                    inter = len(np.intersect1d(left, last[1], assume_unique=True))
                    keep.append(100 * inter >= percent * (len(left) + len(last[1]) - inter))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _open(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Members of buckets that hold several components, dealt into blocks (key, bi, bj).

    A bucket's largest component is never compared with itself. The others are dealt into blocks
    0 .. k - 1 and meet each other in (bi, bj), bi <= bj < k; the largest is dealt into blocks from
    k on, each of which meets the others' blocks. A block has about BLOCK classes and WEIGHT
    shingles at most, but for single larger texts.
    """
    own = comps.select(F.col("id").alias("rep"), "comp")
    placed = cut_lineage(members.join(own, "rep", "left").select("key", "band", "rep", "n", F.coalesce("comp", "rep").alias("comp")))
    sizes = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))
    top = sizes.groupBy("key").agg(F.max_by("comp", "c").alias("top"), F.count(F.lit(1)).alias("many"), F.max("c").alias("c1"), F.max_by("w", "c").alias("w1"), F.sum("c").alias("cs"), F.sum("w").alias("ws")).where("many > 1")
    blocks = lambda c, w: F.greatest(F.lit(1), F.ceil(c / BLOCK), F.ceil(w / WEIGHT)).cast("int")
    top = top.select("key", "top", blocks(F.col("cs") - F.col("c1"), F.col("ws") - F.col("w1")).alias("k"), blocks(F.col("c1"), F.col("w1")).alias("l"))
    live = placed.join(top, "key").withColumn("large", F.col("comp") == F.col("top"))
    mine = F.pmod(F.xxhash64("rep"), F.when(F.col("large"), F.col("l")).otherwise(F.col("k"))).cast("int")
    live = live.select("key", "band", "rep", "comp", "k", "l", F.when(F.col("large"), F.col("k") + mine).otherwise(mine).alias("own"))
    others = F.sequence(F.lit(0), F.when(F.col("own") < F.col("k"), F.col("k") + F.col("l")).otherwise(F.col("k")) - 1)
    return live.select("key", "band", "rep", "comp", "k", "own", F.explode(others).alias("o")).select("key", F.least("own", "o").alias("bi"), F.greatest("own", "o").alias("bj"), "k", "band", "own", "rep", "comp")


def _compared(block: pa.Table, threshold: float, width: int) -> tuple[list[int], list[int]]:
    """Pairs of components (a, b) that links between the rows of a block join, as many as connect them.

    Sizes first, then the estimate, then the full sets. Two classes are compared in the first band they share only.
    """
    percent = round(100 * threshold)
    band, bi, bj, k = (int(block.column(c)[0].as_py()) for c in ("band", "bi", "bj", "k"))
    own, comp, n = (block.column(c).to_numpy() for c in ("own", "comp", "n"))
    bodies = block.column("body")
    regs = np.frombuffer(b"".join(block.column("regs").to_pylist()), ">u2").reshape(len(own), -1)
    up = {c: c for c in comp.tolist()}
    sets: dict[int, np.ndarray] = {}

    def root(c: int) -> int:
        while up[c] != c:
            up[c] = c = up[up[c]]
        return c

    def full(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingle_sets([zstandard.ZstdDecompressor().decompress(bodies[i].as_py())], width)[0]
        return sets[i]

    first, second = [], []
    lefts = np.flatnonzero(own == bi)
    rights = lefts if bi == bj else np.flatnonzero(own == bj)
    for at, i in enumerate(lefts.tolist()):
        j = rights[at + 1 :] if bi == bj else rights
        j = j[(comp[j] != comp[i]) & (np.minimum(n[j], n[i]) * 100 >= np.maximum(n[j], n[i]) * percent)]
        if not len(j):
            continue
        equal = regs[j] == regs[i]
        j = j[(equal.reshape(len(j), BANDS, ROWS).all(axis=2).argmax(axis=1) == band) & (corrected(equal.mean(axis=1)) >= threshold - SLACK)]
        for x in j.tolist():
            p, q = root(int(comp[i])), root(int(comp[x]))
            if p == q:
                continue
            inter = len(np.intersect1d(full(i), full(x), assume_unique=True))
            if 100 * inter >= percent * (len(full(i)) + len(full(x)) - inter):
                up[max(p, q)] = min(p, q)
                first.append(max(p, q))
                second.append(min(p, q))
    return first, second


def _cross_links(live: DataFrame, bodies: DataFrame, threshold: float, width: int) -> DataFrame:
    """Links (a, b) between the components of open buckets, found block by block and in place."""
    cols = ["key", "bi", "bj", "k", "band", "own", "rep", "comp", "n", "regs", "body"]
    rows = live.join(bodies, "rep").select(*cols).repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def done() -> pa.RecordBatch:
            a, b = _compared(pa.Table.from_batches(held), threshold, width)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(i).to_numpy() for i in range(3)])
            cuts = np.flatnonzero(np.concatenate([[True], (ids[:, 1:] != ids[:, :-1]).any(axis=0), [True]]))
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                here = tuple(ids[:, x].tolist())
                if here != last and held:
                    yield done()
                last = here
                held.append(batch.slice(x, y - x))
        if held:
            yield done()

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, width: int = 2) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept.

    Null and empty texts have an empty set and are linked with nothing; so are rows with a null id
    (component_id null, kept). Rows that repeat an id are one document, whose links are those of all
    its texts. Equal sets are one class, however many rows they have, and are never expanded into
    pairs. An empty table gives no rows; columns other than the two named are not read.
    """
    sigs = cut_lineage(signatures(df, id_col, text_col, width))
    some = sigs.where("digest is not null and doc_id is not null")
    classes = cut_lineage(some.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("regs").alias("regs")))
    names = classes.select("digest", "rep")
    # An id with several texts ties their classes.
    which = F.xxhash64("digest")
    several, n = cut_and_count(some.groupBy("doc_id").agg(F.min(which).alias("x"), F.max(which).alias("y")).where("x <> y").select("doc_id"))
    members = _members(classes)
    bodies = _bodies(df, id_col, text_col, members.select("rep").distinct(), width)
    links = _pivot_links(members, bodies, threshold, width)
    if n:
        links = links.unionByName(some.join(several, "doc_id").join(names, "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    links = cut_lineage(links)
    drop(several)
    comps = components(links)
    live = cut_lineage(_open(members, comps))
    drop(links, members)
    links = cut_lineage(_cross_links(live, bodies, threshold, width))
    drop(live, bodies)
    more = components(links)
    labels = compose(comps, more).withColumnRenamed("id", "rep")
    found = names.join(labels, "rep", "left").select("digest", F.coalesce("comp", "rep").alias("comp"))
    placed = sigs.select("doc_id", "digest", "n").join(found, "digest", "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    out = cut_lineage(placed.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"), F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept")))
    drop(sigs, classes, comps, links, more)
    return out


def keep_one(docs: DataFrame, **how: object) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, its columns unchanged.

    Rows that repeat an id are one document: the least row stays, by the columns that have an order
    (any of them, where rows differ in maps, variants and the like alone). Rows without an id are
    documents of their own.
    """
    cols = docs.columns
    order = F.struct(F.lit(0), *[F.col(f"r.c{i}") for i, f in enumerate(docs.schema.fields) if orderable(f.dataType)])
    row = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(cols)])
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row.alias("r"))
    found = near_duplicates(docs, **how).where("kept and doc_id is not null").select("doc_id").distinct()
    one = rows.join(found, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by("r", order).alias("r")).select("r")
    both = one.unionByName(rows.where("doc_id is null").select("r"))
    return both.select(*[F.col("r")[f"c{i}"].alias(c) for i, c in enumerate(cols)])


#: The same rows in SQL.
ORACLE = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
  from documents
), sh as (
  select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) = 1 then [ws[1]]
    else list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) end) as g
  from w
), n as (
  select w.doc_id, count(g) as n_shingles from w left join sh using (doc_id) group by w.doc_id
), inter as (
  select a.doc_id as x, b.doc_id as y, count(*) as c from sh a join sh b on a.g = b.g and a.doc_id < b.doc_id group by all
), link as (
  select x, y from inter join n p on p.doc_id = x join n q on q.doc_id = y
  where 100 * c >= 80 * (p.n_shingles + q.n_shingles - c)
), sym as (
  select x, y from link union select y, x from link
), reach as (
  select doc_id, doc_id as r from n union select reach.doc_id, sym.y from reach join sym on reach.r = sym.x
), comp as (
  select doc_id, min(r) as component_id from reach group by doc_id
)
select n.doc_id, cast(n_shingles as bigint) as n_shingles, component_id, component_id = n.doc_id as kept
from n join comp using (doc_id)
"""
