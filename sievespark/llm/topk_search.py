"""Exact top-k by inner product: exhaustive term-at-a-time accumulation.

Vectors are rows of (term, weight). Queries and candidates are dealt into blocks of bounded size;
each pair of blocks is one task. There the candidates' postings are gathered by term, each query
row scatters its weighted postings into a dense array of scores, and a partition selection keeps
the best k of the block. The survivors (k a query and block) are merged by rank.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievespark.session import cut_and_count

#: Bytes of vectors in a block, and pairs that a task scores where the tables are small.
BLOCK_BYTES, TASK_PAIRS = 32 << 20, 1 << 24
#: Dense scores held at once in a task.
STRIP = 128
LONG = 1 << 63


def takes_part(vector: Column) -> Column:
    """Neither the vector nor a component is null, NaN or infinite."""
    bad = F.exists(vector, lambda x: F.isnull(x) | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~bad


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) for each component, as long; components beyond the range of long saturate."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def exact(vector: np.ndarray, scale: int = 256) -> list[int]:
    """The same of any size."""
    return [math.floor(Fraction(float(x)) * scale) for x in vector]


def beyond(score: int) -> bytes:
    """Orders scores that a long cannot hold: below, within (all alike), above."""
    if -LONG <= score < LONG:
        return b"\x01"
    size = abs(score).bit_length() // 8 + 1
    key = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return b"\x02" + key if score > 0 else b"\x00" + bytes(255 - x for x in key)


def scores(queries: list[np.ndarray], candidates: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """Strips of dense scores: (first query, array [queries, candidates]).

    Postings of a term are the candidates with a weight other than 0; components beyond the
    shorter vector count as 0.
    """
    terms = max(map(len, candidates), default=0)
    weights = np.zeros((terms, len(candidates)), np.int64)
    for j, v in enumerate(candidates):
        weights[: len(v), j] = v
    postings = [np.flatnonzero(w) for w in weights]
    for at in range(0, len(queries), STRIP):
        strip = queries[at : at + STRIP]
        out = np.zeros((len(strip), len(candidates)), np.int64)
        for term in range(terms):
            where = postings[term]
            asked = [(i, v[term]) for i, v in enumerate(strip) if len(v) > term and v[term]]
            if not asked or not len(where):
                continue
            rows, factors = np.array([i for i, _ in asked]), np.array([w for _, w in asked], np.int64)
            if len(where) == len(candidates) and len(rows) == len(strip):
                out += factors[:, None] * weights[term]
            elif len(where) == len(candidates):
                out[rows] += factors[:, None] * weights[term]
            else:
                out[rows[:, None], where] += factors[:, None] * weights[term, where]
        yield at, out


def best(row: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Positions of the k best scores, ties to the smaller id, the query's own id left out."""
    open_ = np.flatnonzero(ids != own)
    if len(open_) > k:
        bar = np.partition(row[open_], len(open_) - k)[len(open_) - k]
        above = open_[row[open_] > bar]
        ties = open_[row[open_] == bar]
        ties = ties[np.argsort(ids[ties], kind="stable")][: k - len(above)]
        open_ = np.concatenate([above, ties])
    return open_


def _sides(n_queries: int, n_rows: int, widest: int) -> tuple[int, int]:
    """Blocks of queries and of candidates: as large as BLOCK_BYTES allows, since each side is copied once for each block of the other, and smaller where that leaves few tasks."""
    most = max(1, BLOCK_BYTES // (8 * max(1, widest)))
    side = min(most, math.isqrt(max(TASK_PAIRS, n_queries * n_rows // 64)))
    return max(1, -(-n_queries // side)), max(1, -(-n_rows // side))


def top_k(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), the id column, score: each query's k highest inner products.

    Candidates are all rows but those with the query's own id. Rows with a null id (ids are whole
    numbers) or a vector that is null or holds null, NaN or infinity are neither. Equal query rows are one query;
    rows that repeat an id with other vectors are queries and candidates of their own. Ranks go by
    exact integers: vectors whose products might not fit in 64 bits are scored in integers of any
    size, and a score beyond the range of long is given as that range's end. Fewer than k
    candidates are all returned; an empty table gives no rows.
    """
    rows = df.select(df[id_col].cast("long").alias("id"), df[vector_col].alias("x"), is_query.alias("q")).where(F.col("id").isNotNull() & takes_part(F.col("x")))
    # Sums of products of components up to this bound fit; other vectors travel as they are.
    fits = F.floor(F.sqrt(F.lit(2.0**62) / F.greatest(F.lit(1), F.size("x"))))
    large = F.exists("x", lambda x: F.abs(x.cast("double")) * scale >= fits - 1)
    rows = rows.select("id", F.when(~large, quantised(F.col("x"), scale)).alias("v"), F.when(large, F.transform("x", lambda x: x.cast("double"))).alias("x"), F.size("x").alias("size"), "q")
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("w")).first()
    # Each distinct query has a number, written once, so that its vector need not travel with its results.
    asked, n_queries = cut_and_count(rows.where("q").select("id", "v", "x").distinct().select(F.monotonically_increasing_id().alias("qn"), "id", "v", "x"))
    q_blocks, c_blocks = _sides(n_queries, seen["n"], seen["w"] or 0)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select(F.pmod(F.xxhash64("qn"), F.lit(q_blocks)).cast("int").alias("qb"), every(c_blocks).alias("cb"), "qn", "id", "v", "x")
    # Rows that repeat exactly are dealt over all blocks by their place in the scan.
    spread = F.pmod(F.xxhash64("id", "v", F.monotonically_increasing_id()), F.lit(c_blocks)).cast("int")
    right = rows.select(spread.alias("cb"), "id", "v", "x").select(every(q_blocks).alias("qb"), "cb", "id", "v", "x")

    def search(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []  # (number of the query, place of the candidate, exact score)
        ids = two["id"].to_numpy(np.int64) if len(two) else np.zeros(0, np.int64)
        keys = one["id"].to_numpy(np.int64) if len(one) else np.zeros(0, np.int64)
        if len(ids) and len(keys):
            plain, asks = (np.flatnonzero(t["v"].notna().to_numpy()) for t in (two, one))
            wide, odd = np.flatnonzero(two["v"].isna().to_numpy()), np.flatnonzero(one["v"].isna().to_numpy())
            far = {j: exact(two["x"].iloc[j], scale) for j in wide.tolist()}
            dot = lambda a, b: sum(x * y for x, y in zip(a, b))
            if len(plain):
                for at, strip in scores(list(one["v"].iloc[asks]), list(two["v"].iloc[plain])):
                    for i, row in zip(asks[at : at + len(strip)].tolist(), strip):
                        top = best(row, ids[plain], keys[i], k)
                        found += [(i, int(plain[j]), int(row[j])) for j in top.tolist()]
            for i in asks.tolist() if far else ():
                own = one["v"].iloc[i].tolist()
                found += [(i, j, dot(own, v)) for j, v in far.items() if ids[j] != keys[i]]
            for i in odd.tolist():
                own = exact(one["x"].iloc[i], scale)
                all_ = ((j, dot(own, far[j] if j in far else two["v"].iloc[j].tolist())) for j in range(len(ids)) if ids[j] != keys[i])
                found += [(i, j, s) for j, s in heapq.nsmallest(k, all_, key=lambda r: (-r[1], ids[r[0]]))]
        i, j, score = (list(x) for x in zip(*found)) if found else ([], [], [])
        return pd.DataFrame({"qn": one["qn"].to_numpy()[i] if found else np.zeros(0, np.int64), "query_id": keys[i] if found else np.zeros(0, np.int64), "id": ids[j] if found else np.zeros(0, np.int64), "score": np.array([max(-LONG, min(LONG - 1, s)) for s in score], np.int64), "beyond": [beyond(s) for s in score]})

    found = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(search, "qn long, query_id long, id long, score long, beyond binary")
    order = Window.partitionBy("qn").orderBy(F.desc("score"), F.desc("beyond"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


#: The same rows in SQL (queries: every 50th id).
ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as w
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from s qualify rank <= 5
"""
