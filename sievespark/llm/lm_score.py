"""Language-model scores from a log-frequency Bloom filter.

One scan turns the texts into chunks: token streams over a dictionary of the chunk's own, written
once. The dictionaries are dealt by segment of the words' hashes; there the exact counts of words
are sums by word, and go back to the chunks. Pairs of consecutive tokens of the training rows are
counted by hash: summed inside tasks, dealt by segment and summed again. A segment of the filter holds each word and pair under the keys (hash, 1) to
(hash, level), where the level is 1 + floor(log of the count, base BASE); it has as many bits as its own
keys need, so the filter grows with the corpus. Asking for levels 1, 2, ... until one is missing
gives the quantised count back. Filters of up to FILTER_BYTES are broadcast; beyond that the
chunks' questions are dealt to the segments and the answers back to the chunks, with equal results.
What is dealt out are blocks of words, hashes or counts, not a row each. There is a block for each
chunk and segment, so blocks grow with the square of the corpus: they travel many to an Arrow batch, and
a segment counts or answers those of many chunks at once.

A token's probability is the pair's count smoothed by the word's (Dirichlet):
(c(h w) + K p(w)) / (c(h) + K), with p(w) = (c(w) + 1) / (N + V + 1), all c from the filter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sievespark.llm.common import columns, sliced
from sievespark.llm.words import WHITE, byte_table, int_lists, split_words
from sievespark.session import cut_lineage, drop, release

WORDS = byte_table(WHITE)
#: The token after the last word of a text, and before the first; no word is a blank.
END = " "
#: UTF-8 bytes beyond which a word is known by its digest (after a blank, which no word holds).
LONG_WORD = 80
#: Tokens of a chunk; longer texts are cut into several.
CHUNK = 1 << 19
#: Pairs held in a task before they are summed and dealt out (about 100 bytes each on the way).
HELD = 1 << 21
#: Training tokens a segment (so it has at most twice as many keys, of words and pairs).
SEGMENT_TOKENS = 1 << 20
#: Keys that are asked for at once.
ASKED = 1 << 17
#: Bytes of blocks that travel in one Arrow batch, about, and blocks.
BATCH_BYTES, BATCH_BLOCKS = 1 << 21, 1 << 13
#: Size of a filter that is broadcast.
FILTER_BYTES = 128 << 20
BASE, PROBES, BITS_PER_KEY = 1.5, 4, 8
#: Weight K of the word's own probability.
PRIOR = 500.0
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def thresholds(base: float = BASE) -> np.ndarray:
    """The least count of each level from 1."""
    out, x = [1], 1.0
    while out[-1] < 1 << 60:
        x *= base
        out.append(max(out[-1] + 1, int(np.ceil(x))))
    return np.array(out, np.int64)


_LEAST = thresholds()


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(_LEAST, counts, side="right")


def counts_of(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level; 0 for level 0."""
    middle = np.concatenate([[0.0], (_LEAST[:-1] + _LEAST[1:] - 1) / 2, _LEAST[-1:].astype(float)])
    return middle[levels]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def plane(values: np.ndarray) -> bytes:
    """Integers with their low bytes first, then the next ones: what is small packs well."""
    return np.ascontiguousarray(values.astype("<i8" if values.dtype.itemsize == 8 else "<i4").view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes()


def unplane(data: bytes, size: int) -> np.ndarray:
    flat = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T)
    return flat.view(f"<i{size}").reshape(-1).astype(np.int64)


def packed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def ascending(keys: np.ndarray) -> bytes:
    """Ascending keys by their differences."""
    return plane(np.diff(keys, prepend=np.uint64(0)).view(np.int64))


def unascending(data: bytes) -> np.ndarray:
    return np.cumsum(unplane(data, 8).view(np.uint64), dtype=np.uint64)


def joined(words: pa.Array) -> bytes:
    """Words, each with a line feed behind it."""
    if not len(words):
        return b""
    lines = pc.binary_join_element_wise(words, pa.scalar("", words.type), pa.scalar("\n", words.type))
    return lines.buffers()[2].to_pybytes()[: np.frombuffer(lines.buffers()[1], np.int64)[len(lines)]]


def split(data: bytes) -> pa.Array:
    return pc.split_pattern(pa.array([data[:-1].decode()], pa.large_string()), "\n").flatten() if data else pa.array([], pa.large_string())


#: Random values by place and byte, from a fixed seed: a word's hash is their sum (tabulation).
_PLACES = np.random.Generator(np.random.PCG64(13)).integers(0, 1 << 64, (LONG_WORD + 2, 256), np.uint64, endpoint=False)


def word_hashes(data: bytes) -> np.ndarray:
    """Hashes of :func:`joined` words."""
    flat = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(flat == 10)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    place = np.arange(len(flat)) - np.repeat(starts, ends - starts + 1)
    return mixed(np.add.reduceat(_PLACES[place, flat], starts)) if len(starts) else np.zeros(0, np.uint64)


def word_keys(words: np.ndarray) -> np.ndarray:
    return mixed(words + _A)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(mixed(first * _B + _C) + second)


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    """Segments in the order of the keys."""
    return ((keys >> np.uint64(40)) * np.uint64(segments) >> np.uint64(24)).astype(np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _slots(keys: np.ndarray, level: int, sizes: np.ndarray | int) -> Iterator[np.ndarray]:
    h = mixed(keys + np.uint64(level * int(_B) % (1 << 64)))
    step = mixed(h ^ _C) | np.uint64(1)
    for _ in range(PROBES):
        yield (h % np.uint64(sizes) if isinstance(sizes, int) else h % sizes).astype(np.int64)
        h = h + step


def segment_bits(keys: np.ndarray, counts: np.ndarray, bits_per_key: int = BITS_PER_KEY) -> bytes:
    """The bits of one segment."""
    levels = levels_of(counts)
    size = -(-max(64, bits_per_key * int(levels.sum())) // 8) * 8
    flags = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for slots in _slots(keys[levels >= level], level, size):
            flags[slots] = True
    return np.packbits(flags, bitorder="little").tobytes()


class LogFilter:
    """Segments of a filter, end to end."""

    def __init__(self, segments: int, parts: list[tuple[int, bytes]]):
        self.segments = segments
        held = dict(parts)
        sizes = np.array([len(held.get(s, b"")) for s in range(segments)], np.int64)
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        self.bits = np.frombuffer(b"".join(held[s] for s in sorted(held)), np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The highest level up to which all keys are there, by asking for 1, 2, ..."""
        if len(keys) > ASKED:
            return np.concatenate([self.levels(keys[at : at + ASKED]) for at in range(0, len(keys), ASKED)])
        out = np.zeros(len(keys), np.uint8)
        segment = segment_of(keys, self.segments)
        start, size = self.at[segment], ((self.at[segment + 1] - self.at[segment]) * 8).astype(np.uint64)
        open_ = np.flatnonzero(size > 0)
        for level in range(1, len(_LEAST) + 1):
            if not len(open_):
                break
            at, alive = start[open_], np.ones(len(open_), bool)
            for slots in _slots(keys[open_], level, size[open_]):
                alive &= (self.bits[at + (slots >> 3)] >> (slots & 7).astype(np.uint8)) & 1 == 1
            open_ = open_[alive]
            out[open_] = level
        return out


def _coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(codes, dictionary); code 0 is END, and long words are in the dictionary by their digest."""
    found = words.dictionary_encode()
    values = found.dictionary
    long_ = np.flatnonzero(pc.greater(pc.binary_length(values), LONG_WORD).to_numpy(zero_copy_only=False))
    if len(long_):
        plain = values.to_pylist()
        for i in long_.tolist():
            plain[i] = " " + hashlib.blake2b(plain[i].encode(), digest_size=16).hexdigest()
        values = pa.array(plain, pa.large_string())
    return found.indices.to_numpy().astype(np.int64) + 1, pa.concat_arrays([pa.array([END], pa.large_string()), values])


def _chunk_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([*columns("chunk long, lead int, stream binary, words binary, counts binary, rows long[], held boolean[], sizes int[], taught long"), T.StructField("ids", T.ArrayType(id_type))])


def chunked(docs: DataFrame, id_col: Column, held: Column, text: Column) -> DataFrame:
    """Chunks of the texts. Written.

    stream: codes of the chunk's ``words``; lead: the code before the first; for each text (or
    piece of one) its row number, id, held and tokens; counts: how often each word occurs in rows
    that are not held, taught: their sum.
    """
    rows = docs.select(id_col.alias("id"), held.alias("held"), text.alias("text"))
    schema = _chunk_schema(rows.schema["id"].dataType)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = row = TaskContext.get().partitionId() << 33
        parts: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal chunk, row
            codes, values = _coded(pa.concat_arrays([p[0] for p in parts]))
            sizes, held_ = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
            ids = pa.concat_arrays([p[3] for p in parts])
            parts.clear()
            ends = np.cumsum(sizes + 1)
            stream = np.zeros(int(ends[-1]) + 1, np.int64)  # END before the first
            stream[1 + np.delete(np.arange(ends[-1]), ends - 1)] = codes
            for a in range(0, int(ends[-1]), CHUNK):
                b = min(int(ends[-1]), a + CHUNK)
                first, last = (int(x) for x in np.searchsorted(ends, [a, b - 1], side="right"))
                some, local = np.unique(stream[a : b + 1], return_inverse=True)
                piece = np.minimum(ends[first : last + 1], b) - np.maximum(np.concatenate([[0], ends])[first : last + 1], a)
                taught = np.repeat(~held_[first : last + 1], piece)
                counts = np.bincount(local[1:][taught], minlength=len(some))
                one = {"chunk": chunk, "lead": int(local[0]), "stream": packed(plane(local[1:].astype(np.int32))), "words": packed(joined(values.take(pa.array(some)))), "counts": packed(plane(counts.astype(np.int32))), "taught": int(counts.sum())}
                lists = {"rows": np.arange(row + first, row + last + 1), "held": held_[first : last + 1], "sizes": piece.astype(np.int32)}
                whole = {c: pa.array([x], arrow.field(c).type) for c, x in one.items()} | {c: int_lists(x, np.array([len(x)])) for c, x in lists.items()}
                whole["ids"] = pa.ListArray.from_arrays(pa.array([0, last + 1 - first], pa.int32()), ids[first : last + 1])
                yield pa.RecordBatch.from_arrays([whole[c] for c in arrow.names], arrow.names)
                chunk += 1
            row += len(sizes)

        tokens = 0
        for batch in sliced(batches, 100):
            offsets, words = split_words(batch.column(2), WORDS)
            more = len(words) + batch.num_rows
            if parts and tokens + more > CHUNK:  # what is beyond would be a small chunk of its own
                yield from flush()
                tokens = 0
            parts.append((words, np.diff(offsets), batch.column(1).to_numpy(zero_copy_only=False).astype(bool), batch.column(0)))
            tokens += more
        if parts:
            yield from flush()

    return cut_lineage(rows.mapInArrow(run, schema))


def _tasks(segments: int) -> int:
    """Tasks over all segments; where there are many a task takes several, one after the other."""
    return segments if segments <= 64 else 64 + (segments - 64) // 4


def _runs(segment: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(segment, from, to) of ascending segments."""
    first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]])).tolist() if len(segment) else []
    for a, b in zip(first, [*first[1:], len(segment)]):
        yield int(segment[a]), a, b


def _batched(names: str, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of columns "name kind, ..."; a batch of its own costs more than most blocks, so many share one."""
    schema = to_arrow_schema(T.StructType(columns(names)))
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size >= BATCH_BYTES or len(held) >= BATCH_BLOCKS:
            yield batch()
            held.clear()
            size = 0
    if held:
        yield batch()


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


_BLOB, _ASK, _TOLD = "seg int, keys binary, counts binary", "seg int, of long, words binary, counts binary", "seg int, of long, keys binary, counts binary"


def word_counts(chunks: DataFrame, segments: int) -> DataFrame:
    """Exact counts of words. Written.

    (seg, of, counts): for each chunk its words of the segment, in its order, 8 bytes a count; (seg,
    null, keys, counts): the segment's words that occur in rows that are not held.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for of, words, counts in _in_order(batches):
            words, counts = unpacked(words), unplane(unpacked(counts), 4)
            segment = segment_of(word_keys(word_hashes(words)), segments)
            order = np.argsort(segment, kind="stable")
            words, counts = joined(split(words).take(pa.array(order))), counts[order].astype("<i4").tobytes()
            at = [0, *(np.flatnonzero(np.frombuffer(words, np.uint8) == 10) + 1).tolist()]
            for s, a, b in _runs(segment[order]):
                yield s, of, words[at[a] : at[b]], counts[4 * a : 4 * b]

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, held = None, []

        def done() -> Iterator[tuple]:
            if not held:
                return
            coded = split(b"".join(words for _, words, _ in held)).dictionary_encode()
            codes, sums = coded.indices.to_numpy(), np.zeros(len(coded.dictionary), np.int64)
            np.add.at(sums, codes, np.frombuffer(b"".join(n for _, _, n in held), "<i4"))
            told, at = sums[codes].astype("<i8").tobytes(), 0
            for of, _, n in held:
                yield now, of, None, told[at : at + 2 * len(n)]
                at += 2 * len(n)
            some = sums > 0
            keys = word_keys(word_hashes(joined(coded.dictionary)))[some]
            order = np.argsort(keys, kind="stable")
            yield now, None, ascending(keys[order]), plane(sums[some][order])
            held.clear()

        for segment, of, words, counts in _in_order(batches):
            if segment != now:
                yield from done()
                now = segment
            held.append((of, words, counts))
        yield from done()

    asked = chunks.select("chunk", "words", "counts").mapInArrow(lambda b: _batched(_ASK, ask(b)), T.StructType(columns(_ASK)))
    return cut_lineage(asked.repartition(_tasks(segments), "seg").sortWithinPartitions("seg", "of").mapInArrow(lambda b: _batched(_TOLD, tell(b)), T.StructType(columns(_TOLD))))


def _pairs(lead: int, stream: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(code before, code) of each token of a chunk's stream."""
    code = unplane(unpacked(stream), 4)
    return np.concatenate([[lead], code[:-1]]).astype(np.int64), code


def build_filter(chunks: DataFrame, words: DataFrame, segments: int, bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """(seg, bits) of the words and pairs of rows that are not held. Written."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        found, n = [], 0

        def flush() -> Iterator[tuple]:
            keys, times = np.unique(np.concatenate(found), return_counts=True)
            found.clear()
            for s, a, b in _runs(segment_of(keys, segments)):
                yield s, ascending(keys[a:b]), plane(times[a:b].astype(np.int64))

        for lead, stream, words_, held, sizes in _in_order(batches):
            before, code = _pairs(lead, stream)
            taught, hashes = np.repeat(~np.array(held, bool), sizes), word_hashes(unpacked(words_))
            found.append(pair_keys(hashes[before[taught]], hashes[code[taught]]))
            n += len(found[-1])
            if n >= HELD:
                yield from flush()
                n = 0
        if found:
            yield from flush()

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, held, n = None, [], 0

        def merge() -> None:
            held[:] = [summed(*(np.concatenate(x) for x in zip(*held)))]

        def done() -> Iterator[tuple]:
            if held:
                merge()
                yield now, segment_bits(*held[0], bits_per_key)
            held.clear()

        for segment, keys, times in _in_order(batches):
            if segment != now:
                yield from done()
                now, n = segment, 0
            held.append((unascending(keys), unplane(times, 8)))
            n += len(held[-1][0])
            if n >= SEGMENT_TOKENS:
                merge()
                n = 0
        yield from done()

    both = chunks.select("lead", "stream", "words", "held", "sizes").mapInArrow(lambda b: _batched(_BLOB, pairs(b)), T.StructType(columns(_BLOB))).unionByName(words.where("of is null").select("seg", "keys", "counts"))
    return cut_lineage(both.repartition(_tasks(segments), "seg").sortWithinPartitions("seg").mapInArrow(lambda b: _batched("seg int, bits binary", bits(b)), "seg int, bits binary"))


def _asked(hashes: np.ndarray, before: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all keys of a chunk, ascending; place of each word's key; place of each token's pair)."""
    pair, which = np.unique(before * len(hashes) + code, return_inverse=True)
    keys, place = np.unique(np.concatenate([word_keys(hashes), pair_keys(hashes[pair // len(hashes)], hashes[pair % len(hashes)])]), return_inverse=True)
    return keys, place[: len(hashes)], place[len(hashes) :][which]


def _gathered(told: DataFrame, what: str) -> DataFrame:
    """(of, ``what``): a chunk's blocks, in the order of their segments."""
    return told.groupBy("of").agg(F.sort_array(F.collect_list(F.struct("seg", what))).alias("told")).select("of", F.col(f"told.{what}").alias(what))


def _routed(chunks: DataFrame, parts: DataFrame, segments: int) -> DataFrame:
    """(of, seg, levels): for each chunk the levels of its keys, by segment; for filters that are not broadcast. Written.

    The questions are most of what is dealt out, so their shuffle files go before the answers are joined. A segment's bits come first in its task, then the questions of the chunks pass by, ASKED keys at once.
    """
    kind, told = "seg int, of long, data binary", "of long, seg int, levels binary"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for lead, stream, words, of in _in_order(batches):
            keys, _, _ = _asked(word_hashes(unpacked(words)), *_pairs(lead, stream))
            for s, a, b in _runs(segment_of(keys, segments)):
                yield s, of, ascending(keys[a:b])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, known, held, n = None, LogFilter(1, []), [], 0

        def done() -> Iterator[tuple]:
            if not held:
                return
            levels, at = known.levels(np.concatenate([keys for _, keys in held])).tobytes(), 0
            for of, keys in held:
                yield of, now, levels[at : at + len(keys)]
                at += len(keys)
            held.clear()

        for segment, of, data in _in_order(batches):
            if segment != now:
                yield from done()
                now, known, n = segment, LogFilter(1, []), 0
            if of is None:
                known = LogFilter(1, [(0, data)])
                continue
            held.append((of, unascending(data)))
            n += len(held[-1][1])
            if n >= ASKED:
                yield from done()
                n = 0
        yield from done()

    asked = chunks.select("lead", "stream", "words", "chunk").mapInArrow(lambda b: _batched(kind, ask(b)), T.StructType(columns(kind)))
    bits = parts.select("seg", F.lit(None).cast("long").alias("of"), F.col("bits").alias("data"))
    dealt = bits.unionByName(asked).repartition(_tasks(segments), "seg").sortWithinPartitions(F.col("seg"), F.col("of").asc_nulls_first())
    return cut_lineage(dealt.mapInArrow(lambda b: _batched(told, answer(b)), told))


def scores(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", prior: float = PRIOR, filter_bytes: int = FILTER_BYTES, bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """The id column, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of ``docs``.

    Rows whose ``held`` is false or null teach. Tokens are the words of the text, A-Z lower-cased,
    and one end; null and empty texts have the end alone. base_score: sum of log10((c + 1) / (N + V +
    1)) with exact counts; score: the model's log10 probability of the tokens. Repeated rows teach
    as often as they are there and are scored each by itself; ids may be null; an empty table has no
    rows; without rows that teach all scores are 0. Other columns are not read. All counts are of
    all rows that teach.
    """
    spark = docs.sparkSession
    out_ = F.coalesce(held, F.lit(False))
    chunks = chunked(docs, docs[id_col], out_, docs[text_col])
    taught = int(chunks.agg(F.sum("taught")).first()[0] or 0)
    segments = -(-taught // SEGMENT_TOKENS) or 1
    told = word_counts(chunks, segments)
    distinct = int(told.where("of is null").agg(F.sum(F.length("keys"))).first()[0] or 0) // 8
    parts = build_filter(chunks, told, segments, bits_per_key)
    release(spark, wait=0.5)
    rows = chunks.join(_gathered(told.where("of is not null"), "counts").withColumnRenamed("counts", "exact"), F.col("chunk") == F.col("of")).drop("of")
    model, answers_ = None, []
    if (parts.agg(F.sum(F.length("bits"))).first()[0] or 0) <= filter_bytes:
        table = parts.toArrow()  # at most filter_bytes
        model = spark.sparkContext.broadcast(LogFilter(segments, list(zip(table.column("seg").to_pylist(), table.column("bits").to_pylist()))))
        del table
        rows = rows.withColumn("levels", F.lit(None).cast("array<binary>"))
    else:
        answers_ = [_routed(chunks, parts, segments)]
        release(spark, wait=0.5)
        rows = rows.join(_gathered(answers_[0], "levels"), F.col("chunk") == F.col("of")).drop("of")
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", id_type), *columns("row long, held_out boolean, n_tokens long, n_known long, base_score double, score double")])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lead, stream, data, answers, answered = (batch.column(j)[i].as_py() for j in range(5))
                hashes, (before, code) = word_hashes(unpacked(data)), _pairs(lead, stream)
                keys, words, pairs = _asked(hashes, before, code)
                levels = model.value.levels(keys) if model else np.frombuffer(b"".join(answers), np.uint8)
                about = counts_of(levels)
                single, both = about[words], about[pairs]
                own = (single + 1) / (taught + distinct + 1)
                chance = (np.minimum(both, single[before]) + prior * own[code]) / (single[before] + prior)
                exact = np.empty(len(hashes), np.int64)
                exact[np.argsort(segment_of(word_keys(hashes), segments), kind="stable")] = np.frombuffer(b"".join(answered), "<i8")
                base = np.log10((exact + 1) / (taught + distinct + 1))
                sizes = batch.column(5)[i].values.to_numpy()
                starts = np.cumsum(sizes) - sizes
                over = lambda x: np.add.reduceat(x, starts)
                parts_ = [batch.column(8)[i].values, batch.column(6)[i].values, batch.column(7)[i].values, pa.array(sizes.astype(np.int64)), pa.array(over((exact > 0)[code].astype(np.int64))), pa.array(over(base[code])), pa.array(over(np.log10(np.minimum(chance, 1.0))))]
                yield pa.RecordBatch.from_arrays(parts_, arrow.names)

    pieces = rows.select("lead", "stream", "words", "levels", "exact", "sizes", "rows", "held", "ids").mapInArrow(run, schema)
    whole = pieces.groupBy("row").agg(F.first("id").alias(id_col), F.first("held_out").alias("held_out"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    out = cut_lineage(whole.select(id_col, "held_out", "n_tokens", "n_known", F.lit(taught).cast("long").alias("train_tokens"), "base_score", "score"))
    drop(chunks, told, parts, *answers_)
    return out


def held_out(id_col: Column) -> Column:
    """Rows that training leaves aside: crc32 of the id as text, modulo 7, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``."""
    return scores(docs, held_out(docs["doc_id"]))
