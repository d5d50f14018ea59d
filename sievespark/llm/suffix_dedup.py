"""Removal of repeated byte strings with a distributed enhanced suffix array.

Every ``LENGTH``-byte window is owned by its leftmost least ``GRAM``-byte gram (by hash), a choice
that depends on the window's bytes alone, so equal windows have equal owners wherever they stand.
The windows with one owner at one place form a piece of text (about 140 bytes for 41 windows).

1. Pieces are dealt by owner as headers of a few bytes; those whose owner stands alone drop out.
2. The others are cut out of their documents and dealt by owner, so that all occurrences of a
   string meet in one bucket. There the windows that occur twice or more are named, windows all of
   whose occurrences extend to the left alike are passed over (their group is the shifted group of
   a longer string), and over the rest an enhanced suffix array is built and stack-scanned: each
   node of the common-prefix interval tree is a maximal repeat group with all its occurrences, and
   every occurrence but a group's first is marked.

Hot owners: windows that repeat inside one map batch are settled there, so a bucket gets each
distinct window at most once a batch; owners that are frequent in the corpus (a bounded set, found
by a count over all documents) deal each window by its own hash instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievespark.llm.common import sliced

LENGTH, GRAM = 100, 20
#: Text bytes handled at once in a map task (in blocks that fit the cache), and behind one bucket.
BATCH_BYTES, BLOCK_BYTES, BUCKET_BYTES = 1 << 22, 1 << 17, 1 << 23
#: An owner of so many pieces is hot; only the most frequent HOT_OWNERS are sent out (8 MB).
HOT_PIECES, HOT_OWNERS, SINGLES = 2000, 1 << 20, 16
#: Tasks that buckets are dealt to at most; there are more of both as the data grow.
MOST_TASKS = 100_000
LAST_ID = (1 << 63) - 1
_U = np.uint64
_MUL = 0x9DDFEA08EB382D69
_TABLE = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 63, 256, np.uint64) * _U(2) + _U(1)


def _power(n: int) -> np.uint64:
    return _U(pow(_MUL, n, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(29))


def rolling(raw: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all substrings of ``length`` bytes, by doubling."""
    h, size, out, held = _TABLE[raw], 1, None, 0
    while True:
        if length & size:  # parts from the short to the long: each new one stands before the others
            out = h if out is None else h[: len(h) - held] * _power(held) + out[size:]
            held += size
        if size * 2 > length:
            return _mixed(out[: max(0, len(raw) - length + 1)])
        h = h[:-size] * _power(size) + h[size:]
        size *= 2


def owners(gram_hash: np.ndarray, windows: int) -> np.ndarray:
    """Position of the owning gram of each window: the leftmost minimum."""
    span = LENGTH - GRAM + 1
    v = (gram_hash & _U(0xFFFFFFFF00000000)) | np.arange(len(gram_hash), dtype=np.uint64)
    size = 1
    while size * 2 <= span:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    if size < span:
        v = np.minimum(v[: len(v) - (span - size)], v[span - size :])
    return (v[:windows] & _U(0xFFFFFFFF)).astype(np.int64)


class Batch:
    """Segments of texts (sorted by order of documents) and the pieces of their windows."""

    def __init__(self, segments: list[tuple[int, int, bytes]]):
        self.row = np.array([s[0] for s in segments])
        self.base = np.array([s[1] for s in segments])
        sizes = np.array([len(s[2]) for s in segments])
        self.edge = np.concatenate([[0], np.cumsum(sizes)])
        self.raw = np.frombuffer(b"".join(s[2] for s in segments), np.uint8)
        found, i = [], 0
        while i < len(segments):
            j = max(i + 1, int(np.searchsorted(self.edge, self.edge[i] + BLOCK_BYTES, side="right")) - 1)
            found.append(self._runs(int(self.edge[i]), sizes[i:j]))
            i = j
        self.first, self.count, self.owner = (np.concatenate(x) for x in zip(*found))

    def _runs(self, at: int, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of a block of segments: first window, number of windows, owner."""
        raw = self.raw[at : at + int(sizes.sum())]
        n = len(raw) - LENGTH + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        grams = rolling(raw, GRAM)
        own = owners(grams, n)
        start = np.cumsum(sizes) - sizes
        fits = sizes >= LENGTH
        step = np.zeros(len(raw) + 1, np.int8)  # windows that end in their segment
        np.add.at(step, start[fits], 1)
        np.add.at(step, start[fits] + sizes[fits] - LENGTH + 1, -1)
        valid = np.cumsum(step[:n], dtype=np.int8).astype(bool)
        change = own[1:] != own[:-1]
        new, end = valid.copy(), valid.copy()
        new[1:] &= change | ~valid[:-1]
        end[:-1] &= change | ~valid[1:]
        first = np.flatnonzero(new)
        return first + at, np.flatnonzero(end) - first + 1, grams[own[first]]

    def open_pieces(self, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(settled windows, key, first window, number of windows).

        Settled: windows that also start earlier in this batch. The rest stays open, as pieces keyed
        by owner, or window by window where the owner is hot.
        """
        _, inverse, counts = np.unique(self.owner, return_inverse=True, return_counts=True)
        busy = counts[inverse] > 1
        is_hot = np.zeros(len(self.owner), bool)
        if len(hot) and len(self.owner):
            is_hot = hot[np.minimum(np.searchsorted(hot, self.owner), len(hot) - 1)] == self.owner
            busy |= is_hot
        if not busy.any():
            return np.zeros(0, np.int64), self.owner, self.first, self.count
        first, count = self.first[busy], self.count[busy]
        raw = gather(self.raw, first, count + LENGTH - 1)
        at = expand(np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1), count)
        place = expand(first, count)
        hashes = rolling(raw, LENGTH)[at]
        order = np.argsort(hashes, kind="stable")
        head = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])
        lead = order[np.flatnonzero(head)][np.cumsum(head) - 1]
        again = order[~head]
        done = np.zeros(len(at), bool)
        done[again] = equal_rows(raw, at[again], at[lead[~head]])
        # Runs of open windows, within pieces.
        new_piece = np.zeros(len(at), bool)
        new_piece[np.cumsum(count) - count] = True
        piece = np.repeat(np.arange(len(first)), count)
        start, stop = ~done, ~done
        start[1:] &= done[:-1] | new_piece[1:]
        stop = stop.copy()
        stop[:-1] &= done[1:] | new_piece[1:]
        a, b = np.flatnonzero(start), np.flatnonzero(stop)
        single = is_hot[busy][piece[a]]
        each = expand(a[single], b[single] - a[single] + 1)
        a, b = a[~single], b[~single]
        key = np.concatenate([self.owner[~busy], self.owner[busy][piece[a]], hashes[each]])
        from_ = np.concatenate([self.first[~busy], place[a], place[each]])
        return place[done], key, from_, np.concatenate([self.count[~busy], b - a + 1, np.ones(len(each), np.int64)])

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and offset in its text of each position."""
        seg = np.searchsorted(self.edge, at, side="right") - 1
        return self.row[seg], at - self.edge[seg] + self.base[seg]


def expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenated ranges first .. first + count."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    skip = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    return np.arange(total) + skip


def equal_rows(raw: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """Which of the LENGTH-byte strings at a and at b are equal, byte by byte."""
    view = np.lib.stride_tricks.sliding_window_view(raw, LENGTH)
    out = np.empty(len(a), bool)
    for i in range(0, len(a), step):
        out[i : i + step] = (view[a[i : i + step]] == view[b[i : i + step]]).all(axis=1)
    return out


def gather(raw: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    return raw[expand(first, length)]


def interval_tree(lcp: list[int], time: list[int], least: int, group: Callable[[int, int, int], None] | None = None) -> list[int]:
    """Stack-scan of an enhanced suffix array.

    ``lcp[i]`` is the common prefix of suffixes i - 1 and i (0 below ``least``), ``time`` orders
    their occurrences. Returns for each suffix the longest common prefix with an earlier occurrence
    (0: none): the depth of the deepest node of which it is not the first. ``group(depth, lo, hi)``
    is called for every node, whose occurrences are lo .. hi.
    """
    n = len(time)
    out = [0] * n
    stack: list[list[int]] = []  # depth, first leaf, earliest leaf
    current, start = 0, 0

    def settle(a: int, b: int, depth: int) -> int:
        """The earlier of two; the later one is marked. Equal times are one place, met twice."""
        if time[b] < time[a]:
            a, b = b, a
        if time[a] < time[b] and not out[b]:
            out[b] = depth
        return a

    for i in range(1, n + 1):
        depth = lcp[i] if i < n else 0
        while stack and stack[-1][0] > depth:
            d, lo, early = stack.pop()
            current = settle(early, current, d)
            start = lo
            if group:
                group(d, lo, i - 1)
        if depth >= least:
            if stack and stack[-1][0] == depth:
                stack[-1][2] = settle(stack[-1][2], current, depth)
            else:
                stack.append([depth, start, current])
        current = start = i
    return out


def repeats(raw: np.ndarray, first: np.ndarray, count: np.ndarray, time: np.ndarray, collect: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, window in it, length) of every occurrence that is not the first of its group.

    ``raw`` holds the pieces, piece i with ``count[i]`` windows from ``first[i]``; ``time`` is the
    rank of each piece's first window among all places, windows count on from it. ``collect``
    gets (length, [(piece, window), ...]) for every maximal repeat group.
    """
    none = (np.zeros(0, np.int64),) * 3
    at = expand(first, count)
    if len(at) < 2:
        return none
    piece = np.repeat(np.arange(len(first)), count)
    offset = at - first[piece]
    hashes = rolling(raw, LENGTH)[at]
    order = np.argsort(hashes, kind="stable")
    head = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])
    if not equal_rows(raw, at[order[1:]], at[order[:-1]])[~head[1:]].all():  # a hash collision: name by the bytes
        rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, LENGTH)[at]).view(f"V{LENGTH}").ravel()
        names = np.unique(rows, return_inverse=True)[1]
        order = np.argsort(names, kind="stable")
        head = np.concatenate([[True], names[order][1:] != names[order][:-1]])
    name = np.empty(len(at), np.int64)
    name[order] = np.cumsum(head) - 1
    # Left extension: the name of the window before, or none at the start of a piece.
    before = np.where(offset > 0, np.concatenate([[-1], name[:-1]]), -1)
    starts = np.flatnonzero(head)
    sizes = np.diff(np.concatenate([starts, [len(at)]]))
    least, most = (f.reduceat(before[order], starts) for f in (np.minimum, np.maximum))
    diverse = (sizes > 1) & ((least != most) | (least == -1))
    chosen = order[np.repeat(diverse, sizes)]
    if not len(chosen):
        return none
    # The suffixes of these windows: the name stands for the first LENGTH bytes, the rest in words.
    limit = first[piece[chosen]] + count[piece[chosen]] - 1 - at[chosen]  # bytes beyond the window
    width = max(8, -(-int(limit.max()) // 8) * 8)
    padded = np.concatenate([raw, np.zeros(width + LENGTH, np.uint8)])
    view = np.lib.stride_tricks.sliding_window_view(padded, width)
    rest = view[at[chosen] + LENGTH].copy()
    rest[np.arange(width)[None, :] >= limit[:, None]] = 0
    words = rest.view(">u8").astype(np.uint64)
    suffix = np.lexsort((*[words[:, k] for k in range(words.shape[1] - 1, -1, -1)], name[chosen]))
    rest, limit, chosen = rest[suffix], limit[suffix], chosen[suffix]
    same = name[chosen][1:] == name[chosen][:-1]
    unequal = np.concatenate([rest[1:] != rest[:-1], np.ones((len(chosen) - 1, 1), bool)], axis=1)
    common = np.minimum(unequal.argmax(axis=1), np.minimum(limit[1:], limit[:-1]))
    lcp = np.concatenate([[0], np.where(same, LENGTH + common, 0)])
    when = time[piece[chosen]] + offset[chosen]
    rank = np.unique(when, return_inverse=True)[1]
    group = None
    if collect is not None:
        kept, byte = chosen, np.where(offset[chosen] > 0, raw[np.maximum(at[chosen] - 1, 0)].astype(np.int64), -1)

        def group(depth: int, lo: int, hi: int) -> None:
            left = byte[lo : hi + 1]
            if left.min() != left.max() or left.min() == -1:  # diverse to the left
                collect.append((depth, list(zip(piece[kept[lo : hi + 1]].tolist(), offset[kept[lo : hi + 1]].tolist()))))

    found = np.array(interval_tree(lcp.tolist(), rank.tolist(), LENGTH, group), np.int64)
    hit = found > 0
    return piece[chosen[hit]], offset[chosen[hit]], found[hit]


def maximal_repeats(texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]]]]:
    """Maximal repeat groups of LENGTH or more bytes in a few texts: (length, [(text, start), ...])."""
    long_ = [i for i, t in enumerate(texts) if len(t) >= LENGTH]
    if not long_:
        return []
    raw = np.frombuffer(b"".join(texts[i] for i in long_), np.uint8)
    size = np.array([len(texts[i]) for i in long_])
    first = np.cumsum(size) - size
    out: list = []
    repeats(raw, first, size - LENGTH + 1, first, out)
    return [(n, sorted((long_[p], o) for p, o in places)) for n, places in out]


def segments_of(texts: list[bytes]) -> list[tuple[int, int, bytes]]:
    """Texts as (row, offset, bytes), long ones in parts that share LENGTH - 1 bytes."""
    out = []
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), BLOCK_BYTES):
            out.append((row, at, text[at : at + BLOCK_BYTES + LENGTH - 1]))
    return out


def batches_of(ids: np.ndarray, marks: np.ndarray, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int, bytes]]]]:
    """Distinct rows in order of (id, mark), in batches of about BATCH_BYTES."""
    order = np.lexsort((marks, ids))
    keep = np.concatenate([[True], (np.diff(ids[order]) != 0) | (np.diff(marks[order]) != 0)]) if len(order) else np.zeros(0, bool)
    order = order[keep]
    held, size = [], 0
    for seg in segments_of([texts[i] for i in order]):
        held.append(seg)
        size += len(seg[2])
        if size >= BATCH_BYTES:
            yield ids[order], marks[order], held
            held, size = [], 0
    if held:
        yield ids[order], marks[order], held


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    return batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_pylist()


def _hot_owners(rows: DataFrame) -> np.ndarray:
    """Owners of so many pieces that they would fill a bucket; a bounded number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def merged() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            held.clear()
            # Owners met once stand for SINGLES of their kind, chosen by chance: sums stay right, most rows go.
            some = (n > 1) | (rng.integers(0, SINGLES, len(h)) == 0)
            return pa.RecordBatch.from_arrays([pa.array(h[some].view(np.int64)), pa.array(np.where(n[some] > 1, n[some], SINGLES))], ["owner", "n"])

        rng = np.random.Generator(np.random.PCG64(11))
        for batch in sliced(batches):
            for _, _, segs in batches_of(*_rows(batch)):
                held.append(Batch(segs).owner)
            if sum(map(len, held)) > 4_000_000:
                yield merged()
        yield merged()

    counts = rows.mapInArrow(count, "owner long, n long").groupBy("owner").agg(F.sum("n").alias("n"))
    counts = counts.where(F.col("n") >= HOT_PIECES).orderBy(F.desc("n")).limit(HOT_OWNERS).select("owner")
    return np.sort(counts.toArrow().column("owner").to_numpy().view(np.uint64))


_PRESS = {"level": 3}


def _packed(arrays: list[np.ndarray], text: bytes = b"") -> bytes:
    """Arrays of one length, then bytes, compressed."""
    head = np.array([len(arrays[0])], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(**_PRESS).compress(head + text)


def _unpacked(blob: bytes, kinds: list[type]) -> tuple[list[np.ndarray], np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int(np.frombuffer(data, np.int64, 1)[0]), 8, []
    for kind in kinds:
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out, np.frombuffer(data, np.uint8, offset=at)


HEADER = [np.int64, np.uint32, np.int64, np.uint8, np.uint32]  # id, mark, offset, windows, short key
RANGE = [np.int64, np.uint32, np.int64, np.int64]  # id, mark, start, end
CUT = [np.int64, np.uint32, np.int64, np.uint8]  # id, mark, offset, windows; the text follows


def _deltas(ids: np.ndarray) -> np.ndarray:
    return np.diff(ids, prepend=np.int64(0))


def _dealt(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(bucket, slice) of sorted bucket numbers."""
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(1, np.int64)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(bucket[a]), slice(a, b)


def _blob_rows(rows: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 4096):
        part = list(zip(*rows[i : i + 4096]))
        yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int64()), pa.array(part[1], pa.int8()), pa.array(part[2], pa.binary())], ["bucket", "kind", "blob"])


BLOBS = "bucket long, kind byte, blob binary"


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, start, end): byte ranges to remove, overlapping; id is LAST_ID for null.

    ``mark`` is the CRC of the text. Rows that repeat an id with another text come in order of
    their marks; rows that repeat both are one document. Null and empty texts have no ranges.
    """
    spark = docs.sparkSession
    rows = keyed_rows(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES + 1)
    hot = spark.sparkContext.broadcast(_hot_owners(rows))

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Headers of open pieces by bucket (kind 0), and ranges settled in the batch (kind 1)."""
        for rec in sliced(batches):
            for ids, marks, segs in batches_of(*_rows(rec)):
                batch, out = Batch(segs), []
                done, key, first, count = batch.open_pieces(hot.value)
                if len(done):
                    a = np.flatnonzero(np.diff(done, prepend=-2) != 1)
                    b = np.append(a[1:], len(done)) - 1
                    row, offset = batch.place(done[a])
                    # Windows of neighbouring documents are never neighbours, so a run has one row.
                    out.append((int(ids[row[0]] % buckets), 1, _packed([_deltas(ids[row]), marks[row].astype(np.uint32), offset, offset + done[b] - done[a] + LENGTH])))
                bucket = (key % _U(buckets)).astype(np.int64)
                order = np.lexsort((first, bucket))
                key, first, count, bucket = key[order], first[order], count[order], bucket[order]
                row, offset = batch.place(first)
                short = (key >> _U(32)).astype(np.uint32)
                for to, part in _dealt(bucket):
                    out.append((to, 0, _packed([_deltas(ids[row[part]]), marks[row[part]].astype(np.uint32), offset[part], count[part].astype(np.uint8), short[part]])))
                yield from _blob_rows(out)

    def repeated(table: pa.Table) -> pa.Table:
        """Pieces whose key occurs again, and the settled ranges, by document."""
        cols: list[list[np.ndarray]] = [[], [], [], [], [], []]
        keys = []
        bucket = table.column("bucket")[0].as_py()
        for kind, blob in zip(table.column("kind").to_pylist(), table.column("blob").to_pylist()):
            if kind:
                (ids, marks, a, b), _ = _unpacked(blob, RANGE)
                keys.append(np.full(len(ids), -1, np.int64))
            else:
                (ids, marks, a, b, short), _ = _unpacked(blob, HEADER)
                keys.append(short.astype(np.int64))
            for col, x in zip(cols, (np.cumsum(ids), marks, a, b, np.full(len(ids), kind), np.full(len(ids), bucket))):
                col.append(x.astype(np.int64))
        flat = [np.concatenate(c) for c in cols]
        _, inverse, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        some = (times[inverse] > 1) | (flat[4] == 1)
        return pa.table([pa.array(c[some]) for c in flat], names=["id", "mark", "a", "b", "kind", "bucket"])

    tasks = min(buckets, MOST_TASKS)
    spans = rows.mapInArrow(head, BLOBS).repartition(tasks, "bucket").groupBy("bucket").applyInArrow(repeated, "id long, mark long, a long, b long, kind long, bucket long")
    by_doc = spans.groupBy(F.col("id").alias("rid"), F.col("mark").alias("rmark")).agg(F.collect_list(F.struct("bucket", "kind", "a", "b")).alias("spans"))
    texts = rows.join(by_doc, (F.col("id") == F.col("rid")) & (F.col("mark") == F.col("rmark"))).select("id", "mark", "data", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pieces' texts, by bucket (kind 0), and the settled ranges (kind 1)."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = turn = 0

        def flush() -> list[tuple[int, int, bytes]]:
            nonlocal size, turn
            heads = np.concatenate([h for h, _ in held], axis=1)
            raw = np.concatenate([t for _, t in held])
            at = np.cumsum([0] + [len(t) for _, t in held])[np.repeat(np.arange(len(held)), [h.shape[1] for h, _ in held])]
            bucket, kind, ids, marks, a, b = heads
            out = []
            done = kind == 1
            if done.any():
                turn += 1
                order = np.lexsort((a[done], ids[done]))
                out.append((int((ids[done][0] + turn) % buckets), 1, _packed([_deltas(ids[done][order]), marks[done][order].astype(np.uint32), a[done][order], b[done][order]])))
            order = np.flatnonzero(~done)
            order = order[np.lexsort((a[order], ids[order], bucket[order]))]
            for to, part in _dealt(bucket[order]):
                i = order[part]
                text = gather(raw, at[i] + a[i], b[i] + LENGTH - 1).tobytes()
                out.append((to, 0, _packed([_deltas(ids[i]), marks[i].astype(np.uint32), a[i], b[i].astype(np.uint8)], text)))
            held.clear()
            size = 0
            return out

        for batch in sliced(batches):
            for id_, mark, data, part in zip(*(batch.column(i) for i in range(4))):
                fields = part.values.flatten()
                bucket, kind, a, b = (x.to_numpy(zero_copy_only=False) for x in fields)
                raw = np.frombuffer(data.as_buffer(), np.uint8)
                held.append((np.stack([bucket, kind, np.full(len(a), id_.as_py()), np.full(len(a), mark.as_py()), a, b]), raw))
                size += len(raw)
                if size >= BATCH_BYTES:
                    yield from _blob_rows(flush())
        if held:
            yield from _blob_rows(flush())

    def join(table: pa.Table) -> pa.Table:
        ranges, heads, raws = [], [], []
        for kind, blob in zip(table.column("kind").to_pylist(), table.column("blob").to_pylist()):
            cols, raw = _unpacked(blob, RANGE if kind else CUT)
            cols[0] = np.cumsum(cols[0])
            (ranges if kind else heads).append(np.stack([c.astype(np.int64) for c in cols]))
            if not kind:
                raws.append(raw)
        if heads:
            ids, marks, offset, count = np.concatenate(heads, axis=1)
            length = count + LENGTH - 1
            first = np.cumsum(length) - length
            # Places in order of document, then offset; documents lie far apart.
            order = np.lexsort((offset, marks, ids))
            new = np.concatenate([[False], (np.diff(ids[order]) != 0) | (np.diff(marks[order]) != 0)])
            time = np.empty(len(order), np.int64)
            time[order] = np.cumsum(new) * (1 << 40) + offset[order]
            piece, window, size_ = repeats(np.concatenate(raws), first, count, time)
            at = offset[piece] + window
            ranges.append(np.stack([ids[piece], marks[piece], at, at + size_]))
        flat = np.concatenate(ranges, axis=1) if ranges else np.zeros((4, 0), np.int64)
        return pa.table([pa.array(c) for c in flat], names=["id", "mark", "start", "end"])

    return texts.mapInArrow(cut, BLOBS).repartition(tasks, "bucket").groupBy("bucket").applyInArrow(join, "id long, mark long, start long, end long")


def keyed_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    data = F.coalesce(docs[text_col], F.lit("")).cast("binary")
    return docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(LAST_ID)).alias("id"), F.crc32(data).alias("mark"), data.alias("data"))


def removed_mask(size: int, ranges: list[dict] | None) -> np.ndarray:
    edge = np.zeros(size + 1, np.int64)
    if ranges:
        np.add.at(edge, [r["start"] for r in ranges], 1)
        np.add.at(edge, [r["end"] for r in ranges], -1)
    return np.cumsum(edge[:size]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked, kept (the bytes left).

    A byte goes if a LENGTH-byte string that covers it also starts earlier: in a smaller id (null
    last), or earlier in the same document. Texts are judged as given and never joined; null texts
    count as empty; rows that repeat id and text are treated alike and are no repeats of each
    other; an empty table gives no rows; other columns are not read.
    """
    ranges = repeated_ranges(docs, id_col, text_col)
    gone = ranges.groupBy(F.col("id").alias("rid"), F.col("mark").alias("rmark")).agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    rows = keyed_rows(docs, id_col, text_col)
    both = rows.join(gone, (F.col("id") == F.col("rid")) & (F.col("mark") == F.col("rmark")), "left").select("id", "data", "ranges")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            cols: list[list] = [[] for _ in range(5)]
            for data, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                mask = removed_mask(len(data), found)
                kept = np.frombuffer(data, np.uint8)[~mask].tobytes() if found else data
                spans = int(mask[:1].sum()) + int((mask[1:] & ~mask[:-1]).sum())
                for col, x in zip(cols, (len(data), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None)):
                    col.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = both.mapInArrow(clean, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    id_: Column = F.when(F.col("id") != LAST_ID, F.col("id")).alias(id_col)
    return out.select(id_, "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else []))


#: The same rows in SQL, for ids that are not repeated.
ORACLE = r"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
w as (select doc_id, s, substr(x, cast(2 * s + 1 as bigint), 200) as g from (select doc_id, x, unnest(range(0, len(x) // 2 - 99)) as s from d)),
again as (select doc_id, s from w qualify row_number() over (partition by g order by doc_id nulls last, s) > 1),
runs as (select doc_id, min(s) as a, max(s) + 100 as b from (
  select doc_id, s, sum(fresh) over (partition by doc_id order by s) as run from (
    select doc_id, s, case when s <= lag(s) over (partition by doc_id order by s) + 100 then 0 else 1 end as fresh from again)) group by doc_id, run),
gaps as (select doc_id, a, coalesce(lag(b) over (partition by doc_id order by a), 0) as from_, b from runs),
left_ as (select g.doc_id, count(*) as n_spans, sum(b - a) as n_removed, max(b) as last_,
    string_agg(substr(x, cast(2 * from_ + 1 as bigint), cast(2 * (a - from_) as bigint)), '' order by a) as head
  from gaps g join d on d.doc_id is not distinct from g.doc_id group by g.doc_id)
select d.doc_id, cast(len(x) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, cast(coalesce(n_spans, 0) as bigint) as n_spans,
  sha256(unhex(case when l.n_spans is null then x else head || substr(x, cast(2 * last_ + 1 as bigint)) end)) as kept_sha256
from d left join left_ l on l.doc_id is not distinct from d.doc_id
"""
