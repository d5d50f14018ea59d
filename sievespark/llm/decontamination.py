"""Benchmark decontamination with a broadcast hash set of normalised n-grams (DataFrame functions only).

Benchmark items become word windows; equal windows of several items are one row. Each document's
words are hashed once, every window of the document becomes one 64-bit hash, and a hash join
against the broadcast set leaves the few candidate windows, by a key of the text. They are joined
back to the documents and verified word by word in the text itself; a benchmark too large to be
broadcast is joined by hash in the same plan, with nothing but keys, positions and hashes dealt out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievespark.llm.common import ascii_lower, let
from sievespark.session import cut_lineage

#: Words of the contract: ASCII letters and digits after lower-casing, and anything beyond ASCII.
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What stands between them.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words in a text as it is written.
WORD_AS_WRITTEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Windows that may be broadcast (about 200 bytes each); a larger benchmark is joined by shuffle.
BROADCAST_WINDOWS = 200_000
#: Slots of the table that says which texts may have a candidate (2 to 4 MB).
SLOTS = 1 << 18


def words_of(text: Column) -> Column:
    """Lower-cased words, split at what is none (several times faster than extracting them); null has none."""
    text = F.coalesce(text, F.lit(""))
    lower = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(ascii_lower(text))
    return F.array_remove(F.split(lower, BETWEEN, -1), "")


def _gram(hashes: Column, length: Column | int) -> Column:
    """One hash for a window of word hashes; its length is part of it."""
    return F.xxhash64(F.lit(length) if isinstance(length, int) else length, hashes)


def benchmark_windows(bench: DataFrame, n: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows: len, hash, words and the items (as strings) that hold them."""
    items = bench.select(bench[id_col].cast("string").alias("item"), words_of(bench[text_col]).alias("w")).where(F.size("w") > 0)
    items = items.withColumn("len", F.least(F.size("w"), F.lit(n)))
    wins = items.select("item", "len", F.explode(F.transform(F.sequence(F.lit(0), F.size("w") - F.col("len")), lambda i: F.slice(F.col("w"), i + 1, F.col("len")))).alias("gram"))
    wins = wins.groupBy("len", "gram").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return wins.select(F.col("len").alias("b_len"), _gram(F.transform("gram", lambda x: F.xxhash64(x)), F.col("len")).alias("b_hash"), F.col("gram").alias("b_words"), "items")


def _key(text: Column) -> Column:
    """128 bits of a text: rows of one text have the same hits."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def _candidates(docs: DataFrame, bench: DataFrame, n: int, text_col: str) -> DataFrame:
    """(key, found): per text with a window hash of the benchmark, all (pos, end, words, items). Written.

    What is dealt out is a key, a position and a hash a window; texts without a hit have no row.
    """
    wins = benchmark_windows(bench, n)
    lengths = sorted(r[0] for r in wins.select("b_len").distinct().collect())  # at most n values
    if lengths and wins.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS:
        wins = F.broadcast(wins)
    rows = docs.select(_key(docs[text_col]).alias("key"), F.transform(words_of(docs[text_col]), lambda x: F.xxhash64(x)).alias("hashes"))

    def windows(k: int) -> DataFrame:
        # A filter on the size would split every text a second time.
        places = F.when(F.size("hashes") >= k, F.sequence(F.lit(0), F.size("hashes") - k)).otherwise(F.array().cast("array<int>"))
        at = rows.select("key", "hashes", F.explode(places).alias("pos"))
        return at.select("key", F.lit(k).alias("len"), "pos", _gram(F.slice("hashes", F.col("pos") + 1, k), k).alias("hash"))

    met = reduce(DataFrame.unionByName, map(windows, lengths or [n])).join(wins, (F.col("hash") == F.col("b_hash")) & (F.col("len") == F.col("b_len")))
    found = F.struct("pos", (F.col("pos") + F.col("len")).alias("end"), F.col("b_words").alias("words"), "items")
    return cut_lineage(met.groupBy("key").agg(F.collect_set(found).alias("found")))


def find_hits(docs: DataFrame, bench: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text", keep: Column | None = None) -> DataFrame:
    """Per row of ``docs``: id, n_words, hits (sorted array of word ranges), items (array); with ``keep`` also kept and text.

    A window is ``n`` consecutive words of an item; an item of fewer words is one window, one of
    none has no window. Null and empty texts have no words and no hits; rows that repeat an id are
    judged each by itself; null item ids count as hits without an item. Columns other than those
    named are not read. The windows are broadcast up to BROADCAST_WINDOWS, and joined by hash beyond.
    """
    found = _candidates(docs, bench, n, text_col)
    slot = lambda key: F.pmod(key["a"], F.lit(SLOTS))
    slots = F.broadcast(found.select(slot(F.col("key")).alias("slot")).distinct())  # at most SLOTS rows
    text = docs[text_col]
    rows = docs.select(docs[id_col].alias("id"), _key(text).alias("key"), text.alias("text"), *([keep.alias("kept")] if keep is not None else []))
    # Texts that cannot have a candidate pass by; only the others are dealt out and verified, word by word in the text itself.
    near = slot(F.col("key")) == F.col("slot")
    none = F.array().cast(found.schema["found"].dataType)
    clear = rows.join(slots, near, "left_anti").withColumn("true", none)
    open_ = rows.join(slots, near, "left_semi").join(found.select(F.col("key").alias("found_key"), "found"), F.col("key") == F.col("found_key"), "left")
    true = let(words_of(F.col("text")), lambda w: F.filter("found", lambda f: F.slice(w, f["pos"] + 1, f["end"] - f["pos"]) == f["words"]))
    open_ = open_.withColumn("true", F.when(F.col("found").isNotNull(), true).otherwise(none)).select(*clear.columns)
    hits = F.sort_array(F.transform("true", lambda f: F.struct(f["pos"].alias("pos"), f["end"].alias("end"))))
    items = F.sort_array(F.array_distinct(F.flatten(F.transform("true", lambda f: f["items"]))))
    rest = ["kept", "text"] if keep is not None else []
    return clear.unionByName(open_).select("id", F.size(words_of(F.col("text"))).cast("long").alias("n_words"), hits.alias("hits"), items.alias("items"), *rest)


def covered(hits: Column) -> Column:
    """Words in the union of sorted ranges."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(a: Column, x: Column) -> Column:
        return F.struct(F.greatest(a["end"], x["end"]).alias("end"), (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["end"], x["pos"]))).cast("long").alias("n"))

    return F.aggregate(hits, zero, step, lambda a: a["n"])


def contamination(docs: DataFrame, bench: DataFrame, n: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated; see :func:`find_hits`."""
    hits = find_hits(docs, bench, n).withColumn("n_hit", covered(F.col("hits")))
    return hits.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, bench: DataFrame, n: int = 10, remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated rows (``remove="documents"``) or without the hit words ("spans").

    The columns of ``docs`` stay as they are; rows without a hit are returned unchanged.
    """
    cols = docs.columns
    hits = find_hits(docs, bench, n, keep=F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(cols)]))
    whole = [F.col("kept")[f"c{i}"].alias(c) for i, c in enumerate(cols)]
    if remove == "documents":
        return hits.where(F.size("hits") == 0).select(*whole)
    text = F.col("text")

    def without(words: Column, gone: Column) -> Column:
        every = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
        # Position i as 2 i + 1 where it stays, as 2 i where it goes: sorted, the last bit of entry i says which.
        flags = F.sort_array(F.concat(F.transform(F.array_except(every, gone), lambda i: 2 * i + 1), F.transform(gone, lambda i: 2 * i)))
        left = F.zip_with(words, flags, lambda w, f: F.when(f % 2 == 1, w).otherwise(F.lit("")))
        return F.array_join(F.zip_with(F.split(text, WORD_AS_WRITTEN, -1), left, lambda g, w: F.concat(g, F.coalesce(w, F.lit("")))), "")

    gone = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["pos"], h["end"] - 1))))
    parts = let(F.struct(F.regexp_extract_all(text, F.lit(WORD_AS_WRITTEN), F.lit(0)).alias("words"), gone.alias("gone")), lambda x: without(x["words"], x["gone"]))
    cleaned = F.when((F.size("hits") == 0) | text.isNull(), text).otherwise(parts)
    return hits.select(*[(cleaned.alias(c) if c == "text" else x) for c, x in zip(cols, whole)])


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: The same rows in SQL.
ORACLE = f"""
with d as (select row_number() over () as rid, doc_id, {_WORDS} as w from documents),
b as (select cast(item_id as varchar) as item, {_WORDS} as w from benchmark),
bg as (select distinct item, n, list_slice(w, i, i + n - 1) as g
  from (select item, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0)),
dg as (select rid, n, i, list_slice(w, i, i + n - 1) as g
  from (select rid, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from bg) where len(w) >= n)),
hit as (select rid, i, n, item from dg join bg using (n, g)),
words as (select rid, count(*) as n_hit from (select distinct rid, unnest(range(i, i + n)) as p from hit) group by rid),
items as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct rid, item from hit where item is not null) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (rid) left join items using (rid)
"""
