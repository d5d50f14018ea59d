"""Ranked lexical search: WAND per document shard, with the shards' heaps merged.

One scan of the documents writes an index of what the items ask for: for each document its length
and the asked terms it holds. The corpus's statistics (documents, words, documents a term) are sums
over that index, and each term's weight follows. Then each task cuts its rows into shards of bounded size. A shard has a list of
(document, impact) a term, in document order, and the term's largest impact. For each item the
lists' cursors are put in the order of their current documents; the first cursor at which the sum
of largest impacts reaches the heap's threshold is the pivot, and all documents before it are
skipped. From the pivot on, one run of documents is tested by the largest impacts of the terms that
each holds, those that can still win are scored, and the heap takes them. A task's heap goes on
from shard to shard. Heaps are merged in two steps, so that no task sees those of all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sievespark.llm.common import columns, sliced
from sievespark.llm.words import byte_table, int_lists, split_words
from sievespark.session import cut_lineage, drop

#: What separates terms: all of ASCII but digits and letters (a fixed value of the contract).
TERMS = byte_table([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: Distinct (item, term) pairs asked for in one pass over the index; more items take further passes.
PASS_TERMS = 500_000
#: Postings of a shard (about 40 bytes each while it is built); a task has as many shards as it needs.
SHARD_POSTINGS = 2_000_000
#: Documents tested at once from a pivot on.
RUN = 4096
#: First merges of the heaps.
MERGES = 256


def term_weight(n: int, df: int) -> int:
    """floor(1000 ln((2 n + 2) / (2 df + 1)))."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def lengths(sizes: np.ndarray, n: int, all_terms: int) -> np.ndarray:
    """Each document's m: 75 + (25 size n) div all_terms."""
    if not len(sizes) or int(sizes.max()) * 25 * n < 1 << 63:
        return 75 + 25 * sizes.astype(np.int64) * n // max(1, all_terms)
    return np.array([75 + 25 * x * n // all_terms for x in sizes.tolist()], np.int64)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 12 m)."""
    return 1_000_000_000 * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + 12 * m)


class Shard:
    """Postings of one shard by term, each list in document order, with the term's largest impact."""

    def __init__(self, sizes: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, n: int, all_terms: int):
        self.documents = len(sizes)
        order = np.lexsort((doc, term))
        term, self.doc = term[order], doc[order].astype(np.int64)
        self.impact = impacts(tf[order], lengths(sizes, n, all_terms)[self.doc])
        terms, first = np.unique(term, return_index=True)
        ends = np.append(first[1:], len(term))
        peaks = np.maximum.reduceat(self.impact, first) if len(first) else first
        self.lists = {t: (a, b, p) for t, a, b, p in zip(terms.tolist(), first.tolist(), ends.tolist(), peaks.tolist())}


class Heap:
    """The best k (score, document) so far; ties to the smaller key (id missing, id)."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def bar(self) -> int:
        """What a document must reach to be looked at: 1, or the k-th score (a tie may win by its id)."""
        return self.rows[-1][0] if len(self.rows) == self.k else 1

    def offer(self, scores: list[int], keys: list[tuple]) -> None:
        self.rows = sorted([*self.rows, *zip(scores, keys)], key=lambda r: (-r[0], r[1]))[: self.k]


def wand(shard: Shard, asked: list[tuple[int, int]], heap: Heap, keys: list[tuple], run: int = RUN) -> int:
    """Offers ``heap`` every document of ``shard`` that can enter it; returns how many were scored.

    ``asked``: (term, weight times repeats); ``keys``: the documents' order among equal scores,
    ascending with the document.
    """
    lists = [(shard.doc[a:b], shard.impact[a:b], w, w * p) for t, w in asked if w > 0 and t in shard.lists for a, b, p in [shard.lists[t]]]
    at, scored = [0] * len(lists), 0
    while True:
        heads = sorted((int(docs[i]), j) for j, ((docs, _, _, _), i) in enumerate(zip(lists, at)) if i < len(docs))
        reach, pivot = 0, None
        for head, j in heads:
            reach += lists[j][3]
            if reach >= heap.bar:
                pivot = head
                break
        if pivot is None:
            return scored
        bound, parts = np.zeros(run, np.int64), []
        for j, (docs, impact, weight, peak) in enumerate(lists):
            low = at[j] + int(np.searchsorted(docs[at[j] :], pivot))
            high = low + int(np.searchsorted(docs[low:], pivot + run))
            at[j] = high
            if high > low:
                where = docs[low:high] - pivot
                bound[where] += peak
                parts.append((where, impact[low:high], weight))
        open_ = bound >= heap.bar
        if not open_.any():
            continue
        scores = np.zeros(run, np.int64)
        for where, impact, weight in parts:
            some = open_[where]
            scores[where[some]] += weight * impact[some]
        scored += int(open_.sum())
        best = np.flatnonzero(scores >= heap.bar)
        if len(best) > heap.k:  # in document order, so that the first of a tie stay
            best = best[np.argsort(-scores[best], kind="stable")[: heap.k]]
        heap.offer(scores[best].tolist(), [keys[pivot + i] for i in best.tolist()])


def bags(df: DataFrame, id_col: Column, text: Column, terms: pa.Array | None = None) -> DataFrame:
    """(id, size, terms, times) per row: its number of terms, its distinct terms and how often each occurs.

    With ``terms`` only those are kept, as positions in it.
    """
    spark = df.sparkSession
    rows = df.select(id_col.alias("id"), text.alias("text"))
    known = spark.sparkContext.broadcast(terms)  # at most PASS_TERMS
    kind = "string" if terms is None else "int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            offsets, words = split_words(batch.column(1), TERMS)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            if known.value is None:
                coded = words.dictionary_encode()
                values, codes = coded.dictionary, coded.indices.to_numpy()
            else:
                values, codes = None, pc.fill_null(pc.index_in(words, value_set=known.value), -1).to_numpy()
                owner, codes = owner[codes >= 0], codes[codes >= 0]
            wide = int(codes.max(initial=0)) + 1
            both, times = np.unique(owner * wide + codes, return_counts=True)
            code = (both % wide).astype(np.int32)
            sizes = np.bincount(both // wide, minlength=batch.num_rows)
            found = int_lists(code, sizes)
            if values is not None:
                found = pa.ListArray.from_arrays(found.offsets, values.take(pa.array(code)).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), found, int_lists(times.astype(np.int64), sizes)], ["id", "size", "terms", "times"])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *columns(f"size long, terms {kind}[], times long[]")])
    return rows.mapInArrow(run, schema)


def _heaps(index: DataFrame, asked: list[tuple[int, list[tuple[int, int]]]], n: int, all_terms: int, k: int) -> DataFrame:
    """(item, id, score): each task's best k for each item."""
    spark, id_type = index.sparkSession, index.schema["id"].dataType
    queries = spark.sparkContext.broadcast(asked)  # at most PASS_TERMS pairs
    arrow_type = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps, held, postings = {item: Heap(k) for item, _ in queries.value}, [], 0

        def search() -> None:
            if not held:
                return
            rows = pa.Table.from_batches(held)
            ids = rows.column("id").to_pylist()
            keys = [(x is None, x) if x is not None else (True,) for x in ids]
            order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            terms, times = rows.column("terms").combine_chunks(), rows.column("times").combine_chunks()
            doc = place[np.repeat(np.arange(len(ids)), pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64))]
            shard = Shard(rows.column("size").to_numpy()[order], doc, terms.flatten().to_numpy(), times.flatten().to_numpy(), n, all_terms)
            ordered = [keys[i] for i in order.tolist()]
            for item, wanted in queries.value:
                wand(shard, wanted, heaps[item], ordered)
            held.clear()

        for batch in sliced(batches, 10_000):
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column(2)), 0))
            held.append(batch)
            postings += len(batch.column(2).flatten())
            if postings > SHARD_POSTINGS:
                search()
                postings = 0
        search()
        items, scores, ids = [], [], []
        for item, heap in heaps.items():
            for score, key in heap.rows:
                items.append(item)
                scores.append(score)
                ids.append(None if key[0] else key[1])
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(ids, arrow_type), pa.array(scores, pa.int64())], ["item", "id", "score"])

    return index.select("id", "size", "terms", "times").mapInArrow(run, T.StructType([T.StructField("item", T.LongType()), T.StructField("id", id_type), T.StructField("score", T.LongType())]))


def _best(rows: DataFrame, k: int, *group: Column) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), F.col("id").asc_nulls_last()))
    return rows.withColumn("rank", place).where(F.col("rank") <= k)


def top_documents(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The item's id column, rank (from 1), the document's id column, score: each item's best ``k`` documents.

    Scores are above 0 and 64-bit integers; ties go to the smaller id, null ids last. Each row of
    ``docs`` is a document and each row of ``items`` an item of its own, whether or not its id or
    text is repeated or null. Texts that are null or hold no term match nothing and do not count as
    documents; an item without a term, or whose terms no document holds, has no rows, and neither
    has any item where the documents are an empty table. Other columns are not read. Ids of the
    documents are of a type that can be ordered in Python (numbers, strings, dates).
    Items are asked in blocks of about PASS_TERMS distinct terms, each one pass over the documents.
    """
    spark = docs.sparkSession
    bags_of = bags(items, F.struct(F.monotonically_increasing_id().alias("no"), items[item_col].alias("of")), items[item_text])
    wanted = cut_lineage(bags_of.select("id.no", "id.of", "terms", "times").where(F.size("terms") > 0))
    blocks = -(-(wanted.agg(F.sum(F.size("terms"))).first()[0] or 0) // PASS_TERMS)
    out, old = [], [wanted]
    for block in range(blocks):
        table = wanted.where(F.pmod(F.xxhash64("no"), F.lit(blocks)) == block).select("no", "terms", "times").toArrow()  # about PASS_TERMS terms
        lists = table.column("terms").combine_chunks()
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        coded = lists.flatten().cast(pa.large_string()).dictionary_encode()
        index = cut_lineage(bags(docs, docs[id_col], docs[text_col], coded.dictionary))
        old.append(index)
        n, all_terms = index.agg(F.count_if(F.col("size") > 0), F.coalesce(F.sum("size"), F.lit(0))).first()
        weights = {r["t"]: term_weight(n, r["df"]) for r in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()}  # the terms asked for
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        ends, codes, times = np.cumsum(sizes), coded.indices.to_pylist(), table.column("times").combine_chunks().flatten().to_pylist()
        asked = [(no, [(c, weights.get(c, 0) * t) for c, t in zip(codes[e - s : e], times[e - s : e])]) for no, s, e in zip(table.column("no").to_pylist(), sizes.tolist(), ends.tolist())]
        out.append(_heaps(index, asked, n, all_terms, k))
    if not out:
        none = T.StructType([T.StructField(item_col, items.schema[item_col].dataType), T.StructField("rank", T.IntegerType()), T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.LongType())])
        drop(*old)
        return spark.createDataFrame([], none)
    found = reduce(DataFrame.unionByName, out)
    some = _best(found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGES))), k, F.col("item"), F.col("part")).drop("part", "rank")
    best = cut_lineage(_best(some, k, F.col("item")))
    named = best.join(wanted.select("no", "of"), F.col("item") == F.col("no"))
    return named.select(F.col("of").alias(item_col), "rank", F.col("id").alias(id_col), "score")


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
#: The same rows in SQL (integer division rounds down here, as all values are positive).
ORACLE = f"""
with d as (select row_number() over () as rid, doc_id, {_TERMS} as w from documents),
b as (select row_number() over () as no, item_id, unnest({_TERMS}) as t from benchmark),
k as (select count(*) as n, sum(len(w))::bigint as l from d where len(w) > 0),
tf as (select rid, t, count(*) as tf from (select rid, unnest(w) as t from d) where t in (select t from b) group by rid, t),
wt as (select t, cast(floor(1000 * ln((2 * n + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w from tf, k group by t, n),
m as (select rid, doc_id, 75 + (25 * len(w)::bigint * n) // l as m from d, k where len(w) > 0),
s as (select no, item_id, rid, doc_id, cast(sum(wt.w * ((1000000000 * tf) // (1000 * tf + 12 * m))) as bigint) as score
  from b join tf using (t) join wt using (t) join m using (rid) group by no, item_id, rid, doc_id)
select item_id, cast(row_number() over (partition by no order by score desc, doc_id nulls last) as integer) as rank, doc_id, score
from s where score > 0 qualify rank <= 20
"""
