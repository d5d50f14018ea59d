"""Language identification with language-bitmask n-gram filters.

Training keeps each language's most frequent character n-grams and stores them in bit-sliced Bloom
filters: one table of slots, each slot a bit mask of languages. Looking an n-gram up is the AND of
its slots and returns every language that contains it. A text's masks are popcounted per language;
each count is corrected for that language's false-positive rate, and the best corrected share
decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievespark.llm.common import columns, sliced
from sievespark.operators.quantiles import quantiles
from sievespark.session import cut_lineage, drop

UNKNOWN = "und"
ORDERS = (1, 2, 3, 4)
PROBES = 2
MIX = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 1 << 19
LETTER, MARK = 2, 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def ngram_hashes(codes: np.ndarray, letter: np.ndarray) -> list[np.ndarray]:
    """Hashes of all n-grams of the text's code points, for each order; those without a letter are left out.

    Runs of other characters have been folded to single spaces, so word ends count as characters.
    """
    symbols = (codes.astype(np.uint64) + np.uint64(1)) * MIX
    symbols ^= symbols >> np.uint64(32)
    out, h, any_letter = [], symbols, letter
    for order in range(1, max(ORDERS) + 1):
        if order > 1:
            if len(codes) < order:
                break
            h = h[:-1] * np.uint64(0xD6E8FEB86659FD93) + symbols[order - 1 :]
            any_letter = any_letter[:-1] | letter[order - 1 :]
        if order in ORDERS:
            out.append(_mixed(h[any_letter] + np.uint64(order)))
    return out


def letters_table() -> np.ndarray:
    """LETTER, MARK (kept inside words, but no letter) or 0 for every code point."""
    import unicodedata

    kind = {"L": LETTER, "M": MARK}
    return np.fromiter((kind.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)), np.uint8, 0x110000)


_LETTERS: list[np.ndarray] = []


def folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points with everything but letters and marks as single spaces, and which are letters."""
    if not _LETTERS:
        _LETTERS.append(letters_table())
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _LETTERS[0][codes]
    inside = kind > 0
    keep = inside.copy()
    keep[0] = True
    keep[1:] |= inside[:-1]  # one blank after each run of letters and marks
    codes, kind = codes[keep], kind[keep]
    return np.where(kind > 0, codes, np.uint32(32)), kind == LETTER


def text_hashes(text: str) -> Iterator[np.ndarray]:
    """n-gram hashes of a whole text, in blocks that overlap so that no n-gram is lost or counted twice."""
    codes, letter = folded(text)
    for at in range(0, len(codes), BLOCK):
        reach = min(len(codes), at + BLOCK + max(ORDERS) - 1)
        part = ngram_hashes(codes[at:reach], letter[at:reach])
        if reach - at <= BLOCK:
            yield from part
        else:  # the overlap belongs to the next block, but for n-grams that begin in this one
            for order in ORDERS:
                stop = at + BLOCK + order - 1
                sub = ngram_hashes(codes[at:stop], letter[at:stop])
                yield sub[ORDERS.index(order)]


class Filters:
    """Bit-sliced Bloom filters: ``table[slot]`` is a row of mask words over the languages."""

    def __init__(self, languages: list[str], grams: list[np.ndarray], bits: int = 20):
        self.languages, self.bits = languages, bits
        words = -(-max(1, len(languages)) // 64)
        self.table = np.zeros((1 << bits, words), np.uint64)
        for i, hashes in enumerate(grams):
            for slots in self._slots(hashes):
                self.table[slots, i // 64] |= np.uint64(1 << (i % 64))
        filled = np.array([((self.table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
        self.false_rate = filled**PROBES

    def _slots(self, hashes: np.ndarray) -> list[np.ndarray]:
        step = np.uint64(64 - self.bits)
        return [(hashes >> step).astype(np.int64), ((hashes * MIX) >> step).astype(np.int64)][:PROBES]

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """How many of the n-grams each language contains, by popcount of the masks."""
        a, b = self._slots(hashes)
        masks = self.table[a] & self.table[b]
        out = np.empty(len(self.languages), np.int64)
        for i in range(len(out)):
            out[i] = np.count_nonzero(masks[:, i // 64] & np.uint64(1 << (i % 64)))
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages:
            return UNKNOWN, 0.0
        hits, n = np.zeros(len(self.languages), np.int64), 0
        for hashes in text_hashes(text):
            hits += self.counts(hashes)
            n += len(hashes)
        if not n:
            return UNKNOWN, 0.0
        share = (hits / n - self.false_rate) / np.maximum(1e-9, 1 - self.false_rate)
        best = int(share.argmax())  # the first language in order wins a tie
        return self.languages[best], float(min(1.0, max(0.0, share[best])))


def _sizes(labelled: DataFrame) -> DataFrame:
    """(of, size): different texts of each language; a row a language. Written."""
    return cut_lineage(labelled.select(F.col("lang").alias("of"), F.xxhash64("text")).distinct().groupBy("of").agg(F.count(F.lit(1)).alias("size")))


def _drawn(labelled: DataFrame, sizes: DataFrame, rows: int, seed: int) -> DataFrame:
    """About ``rows`` different texts of each language, once each, by a seeded hash of the text."""
    scale = 1 << 30
    bar = F.least(F.lit(scale), F.floor(F.lit(scale) / F.col("size") * rows))
    both = labelled.join(F.broadcast(sizes), F.col("lang") == F.col("of"))  # a row a language
    return both.where(F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(scale)) < bar).select("lang", "text").distinct()


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", rows_per_language: int = 4000, grams_per_language: int = 20_000, stray: float = 0.05, seed: int = 0) -> Filters:
    """Learn from the rows of ``df`` with a language.

    A seeded sample of about ``rows_per_language`` texts a language is used (all, if fewer): the
    documented bound on labelled rows. Null labels and null texts teach nothing; repeated rows count
    by their text, once each; an empty table gives filters without languages.
    """
    spark = df.sparkSession
    labelled = df.select(df[lang_col].alias("lang"), df[text_col].alias("text")).where("lang is not null and text is not null")
    sizes = _sizes(labelled)
    names = sorted(r["of"] for r in sizes.collect())  # the languages: a list of names
    if not names:
        return Filters([], [])
    chosen = _drawn(labelled, sizes, rows_per_language, seed)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, (h, n) in seen.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(h)), pa.array(h.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])
            seen.clear()

        for batch in sliced(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for hashes in text_hashes(text):
                    h, n = np.unique(hashes, return_counts=True)
                    if lang in seen:
                        h, where = np.unique(np.concatenate([seen[lang][0], h]), return_inverse=True)
                        n = np.bincount(where, np.concatenate([seen[lang][1], n])).astype(np.int64)
                    seen[lang] = (h, n)
                if sum(len(x) for x, _ in seen.values()) > 2_000_000:
                    yield from rows()
        yield from rows()

    counted = chosen.mapInArrow(grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = F.broadcast(counted.groupBy("lang").agg(F.sum("n").alias("all")))  # a row a language
    shares = counted.join(totals, "lang").withColumn("share", F.col("n") / F.col("all"))
    # Strays from foreign passages: far rarer here than in the n-gram's own language.
    own = shares.withColumn("most", F.max("share").over(Window.partitionBy("gram"))).where(F.col("share") >= stray * F.col("most"))
    top = own.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("place") <= grams_per_language)
    table = top.select("lang", "gram").toArrow()  # grams_per_language rows a language: the model
    drop(sizes)
    found: dict[str, list[np.ndarray]] = {name: [] for name in names}
    langs = table.column("lang").combine_chunks().dictionary_encode() if table.num_rows else None
    if langs is not None:
        values, codes = table.column("gram").to_numpy().view(np.uint64), langs.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        edges = np.searchsorted(codes[order], np.arange(len(langs.dictionary) + 1))
        for name, a, b in zip(langs.dictionary.to_pylist(), edges[:-1], edges[1:]):
            found[name].append(values[order[a:b]])
    return Filters(names, [np.sort(np.concatenate(found[n])) if found[n] else np.zeros(0, np.uint64) for n in names])


def predict(df: DataFrame, filters: Filters, text: Column | str, keep: list[Column]) -> DataFrame:
    """``keep`` (as struct kept) plus lang_pred and score for each row; every text is read whole.

    ``text`` is a column, or the name of the one of ``keep`` that holds it.

    Null texts and texts without a letter give ``und`` and 0; repeated rows are judged alike.
    """
    spark = df.sparkSession
    model = spark.sparkContext.broadcast(filters)  # a table of fixed size

    inside = text if isinstance(text, str) else None
    rows = df.select(F.struct(*keep).alias("kept"), *([] if inside else [text.alias("text")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column(0).field(inside) if inside else batch.column(1)
            found = [model.value.predict(t) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())], ["kept", "lang_pred", "score"])

    return rows.mapInArrow(run, T.StructType([T.StructField("kept", rows.schema["kept"].dataType), *columns("lang_pred string, score double")]))


def held_out(id_col: Column) -> Column:
    """Rows that training leaves aside: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, **how: object) -> DataFrame:
    """doc_id, held_out, lang_pred, score; trained on the rows that are not held out."""
    filters = train(docs.where(~held_out(docs["doc_id"])), **how)
    out = predict(docs, filters, docs["text"], [docs["doc_id"].alias("doc_id"), held_out(docs["doc_id"]).alias("held_out")])
    return out.select("kept.doc_id", "kept.held_out", "lang_pred", "score")


def bars(held: DataFrame, filters: Filters, text_col: str = "text", lang_col: str = "lang", below: float = 0.6) -> dict[str, float]:
    """Per language ``below`` times the 5 % quantile of the scores that its labelled rows get when found.

    ``held`` are rows that training left aside; all of their different texts count, once each, and the
    quantile is exact. Scripts of many characters score lower than alphabets, since a filter holds a
    smaller share of their n-grams.
    """
    labelled = held.select(held[lang_col].alias("lang"), held[text_col].alias("text")).where("lang is not null and text is not null")
    if not filters.languages:
        return {}
    each = predict(labelled, filters, labelled["text"], [F.col("lang").alias("lang"), F.xxhash64("text").alias("of")]).where("kept.lang = lang_pred")
    scored = cut_lineage(each.groupBy("lang_pred", "kept.of").agg(F.max("score").alias("score")))
    low = quantiles(scored, ["score"], [0.05], ["lang_pred"])
    out = {r["lang_pred"]: below * r["value"] for r in low.collect()}  # a row a language
    drop(scored)
    return out


def accepted(docs: DataFrame, min_score: float = 0.5, **how: object) -> DataFrame:
    """The rows of ``docs`` whose text is in a known language: not ``und``, and a score of ``min_score`` or more.

    Where a language's own rows score low, its bar is lower, see :func:`bars`. The columns of
    ``docs`` stay as they are.
    """
    filters = train(docs.where(~held_out(docs["doc_id"])), **how)
    low = bars(docs.where(held_out(docs["doc_id"])), filters, **{k: v for k, v in how.items() if k in ("text_col", "lang_col")})
    bar = F.lit(min_score)
    if low:
        known = F.create_map(*[F.lit(x) for lang, value in sorted(low.items()) for x in (lang, min(min_score, value))])
        bar = F.coalesce(F.try_element_at(known, F.col("lang_pred")), bar)
    cols = docs.columns
    out = predict(docs, filters, f"c{cols.index('text')}", [docs[c].alias(f"c{i}") for i, c in enumerate(cols)])
    kept = out.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= bar))
    return kept.select(*[F.col("kept")[f"c{i}"].alias(c) for i, c in enumerate(cols)])
