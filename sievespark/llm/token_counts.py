"""Exact token counts from a tokenizer compiled to finite-state transducers.

Two deterministic transducers work one after the other.

* The splitter works on character classes. Its transitions are annotated with the cuts they emit
  (before the current and before the previous character, which settles the one character of
  look-ahead that white space and contractions need). A long text is cut into chunks; each chunk's
  map from every entry state to its exit state is computed for all chunks at once, the maps are
  composed by a parallel prefix scan, and with the entry states known the cuts are read off.
* The piece transducer works on bytes. A state is what the merges can still change: the longest
  suffix that a token may go on from, and for each position in it the last token of the encoding
  up to there and the number of tokens since. States are made as they are met (determinised
  lazily) and each transition is annotated with the change in the number of tokens.

Both are compiled from the tokenizer's own file. Nothing is shuffled. Only the splitter's chunk maps
are composed by the scan; the piece transducer has too many states for maps over all of them, so it
runs over each distinct piece from its start, and a chunk's tokens are the sum over its pieces.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievespark.llm.common import sliced

#: Character classes of the splitter.
LETTER, STMD, RV, ELL, EE, DIGIT, SPACE, WHITE, QUOTE, OTHER, END = range(11)
#: Its states; FRESH: the next character starts a piece. *2: a run of two or more white-space characters.
FRESH, L, N, O, S1, W1, S2, W2, Q, QR, QL = range(11)
STATES, CLASSES = 11, 11
CUT_HERE, CUT_BEFORE = 16, 32
CHUNK, HEAD = 256, 16
#: Memo limits of a worker; a full memo is emptied, which changes no result.
MEMO_PIECES, MEMO_STATES = 400_000, 200_000
#: Characters handled at once; longer texts are parted where a piece surely ends.
BLOCK = 1 << 20
PART = re.compile(r"\S(?=[ \n\r\t])")


def splitter() -> np.ndarray:
    """``table[state * CLASSES + class]`` = next state + cut bits."""
    letters = (LETTER, STMD, RV, ELL, EE)
    start = {**dict.fromkeys(letters, L), DIGIT: N, SPACE: S1, WHITE: W1, QUOTE: Q, OTHER: O}
    table = np.zeros((STATES, CLASSES), np.uint8)
    for c in range(END):
        fresh = start[c] | CUT_HERE
        blank = c in (SPACE, WHITE)
        joined = L if c in letters else N if c == DIGIT else O  # after one leading space
        table[FRESH, c] = fresh
        table[L, c] = L if c in letters else fresh
        table[N, c] = N if c == DIGIT else fresh
        table[O, c] = O if c in (OTHER, QUOTE) else fresh
        run = S2 if c == SPACE else W2
        table[S1, c] = run if blank else joined
        table[W1, c] = run if blank else fresh
        table[S2, c] = run if blank else joined | CUT_BEFORE
        table[W2, c] = run if blank else fresh | CUT_BEFORE
        # A quote that starts a piece: 's 't 'm 'd 're 've 'll are pieces of their own.
        table[Q, c] = {STMD: FRESH, RV: QR, ELL: QL, OTHER: O, QUOTE: O}.get(c, fresh)
        table[QR, c] = FRESH if c == EE else L | CUT_BEFORE if c in letters else fresh | CUT_BEFORE
        table[QL, c] = FRESH if c == ELL else L | CUT_BEFORE if c in letters else fresh | CUT_BEFORE
    table[[QR, QL], END] = CUT_BEFORE  # 'r, 'v and 'l were no contractions
    return table.reshape(-1)


def class_table() -> np.ndarray:
    """Class of every code point, from the Unicode categories."""
    out = np.full(0x110000, OTHER, np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))
        if kind[0] == "L":
            out[i] = LETTER
        elif kind[0] == "N":
            out[i] = DIGIT
        elif kind in ("Zs", "Zl", "Zp") or i in (9, 10, 11, 12, 13, 0x85):
            out[i] = WHITE
    for chars, c in (("stmd", STMD), ("rv", RV), ("l", ELL), ("e", EE), (" ", SPACE), ("'", QUOTE)):
        out[[ord(x) for x in chars]] = c
    return out


def compose_chunks(maps: np.ndarray) -> np.ndarray:
    """Entry state of each chunk: an exclusive scan of the chunk maps by recursive doubling."""
    scan, step = maps.copy(), 1
    while step < len(scan):
        scan[step:] = np.take_along_axis(scan[step:], scan[:-step], axis=1)
        step *= 2
    return np.concatenate([[FRESH], scan[:-1, FRESH]]).astype(np.uint8)


def find_cuts(texts: list[np.ndarray], table: np.ndarray) -> list[list[int]]:
    """Starts of the pieces of each text, given as arrays of classes."""
    sizes = np.array([len(t) for t in texts])
    chunks = sizes // CHUNK + 1  # at least one END after each text
    first = np.concatenate([[0], np.cumsum(chunks)])
    k = int(first[-1])
    grid = np.full(k * CHUNK, END, np.uint8)
    for t, at in zip(texts, (first * CHUNK).tolist()):
        grid[at : at + len(t)] = t
    columns = np.ascontiguousarray(grid.reshape(k, CHUNK).T)
    # The map of each chunk, from every state; nearly all are constant after a few characters.
    maps = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (k, STATES)).copy()
    wide = np.arange(k)
    for j in range(CHUNK):
        maps[wide] = table[maps[wide] * CLASSES + columns[j, wide][:, None]] & 15
        if j % HEAD == HEAD - 1:
            same = (maps[wide] == maps[wide, :1]).all(axis=1)
            narrow, wide = wide[same], wide[~same]
            state, rest = maps[narrow, 0], np.ascontiguousarray(columns[j + 1 :, narrow])
            for column in rest:
                state = table[state * CLASSES + column] & 15
            maps[narrow] = state[:, None]
            if not len(wide):
                break
    state = compose_chunks(maps)
    emitted = np.empty((CHUNK, k), np.uint8)
    for j in range(CHUNK):
        emitted[j] = table[state * CLASSES + columns[j]]
        state = emitted[j] & 15
    flat = np.ascontiguousarray(emitted.T).reshape(-1)
    here = (flat & CUT_HERE) != 0
    here[np.flatnonzero(flat & CUT_BEFORE) - 1] = True
    cuts = np.flatnonzero(here)
    edges = np.searchsorted(cuts, first * CHUNK)
    return [(cuts[i:j] - at).tolist() for i, j, at in zip(edges, edges[1:], (first * CHUNK).tolist())]


class Pieces(dict):
    """Piece (str) -> number of tokens, by running the lazily determinised piece transducer."""

    def __init__(self, vocab: dict[bytes, int], ranks: dict[tuple[bytes, bytes], int]):
        super().__init__()
        self.ranks = ranks
        self.longest = max(map(len, vocab), default=1)
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        # Tokens that the merges can produce on their own; the others never occur in an encoding.
        self.tokens = {t for t in vocab if len(t) == 1 or self._merge(t) == [t]} | {bytes([b]) for b in range(256)}
        self.prefixes = {t[:i] for t in self.tokens for i in range(1, len(t) + 1)}
        self._reset()

    def _reset(self) -> None:
        self.ids = {(b"", ((None, 0),)): 0}
        self.states = [(b"", ((None, 0),))]
        self.moves: list[dict[int, tuple[int, int]]] = [{}]

    def _merge(self, text: bytes) -> list[bytes]:
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get((parts[i], parts[i + 1]), 1 << 60))
            pair = (parts[best], parts[best + 1])
            if pair not in self.ranks:
                break
            merged, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    merged.append(pair[0] + pair[1])
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        """Make the transition: next state and the change in tokens."""
        suffix, past = self.states[state]
        grown = suffix + bytes([byte])
        size = len(grown)
        for n in range(min(size, self.longest), 0, -1):
            token = grown[size - n :]
            if token not in self.tokens:
                continue
            # past[i] is the last token of the encoding that ends i bytes before the current end.
            before, since = past[n - 1]
            if before is not None:
                pair = (before, token)
                ok = self.fits.get(pair)
                if ok is None:
                    if len(self.fits) > 2_000_000:
                        self.fits.clear()
                    ok = self.fits[pair] = self._merge(before + token) == [before, token]
                if not ok:
                    continue
            change = 1 - since
            break
        else:
            raise AssertionError("every byte is a token")
        keep = size
        while keep and grown[size - keep :] not in self.prefixes:
            keep -= 1
        new_past = ((token, 0), *((t, c + change) for t, c in past[:keep]))
        key = (grown[size - keep :], new_past)
        to = self.ids.get(key)
        if to is None:
            full = len(self.states) >= MEMO_STATES
            if full:  # also in the middle of a piece: all states go but the one in hand
                self._reset()
            to = self.ids[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            if full:
                return to, change
        self.moves[state][byte] = (to, change)
        return to, change

    def count(self, data: bytes) -> int:
        state, total = 0, 0
        for byte in data:
            hop = self.moves[state].get(byte) or self._step(state, byte)
            state = hop[0]
            total += hop[1]
        return total

    def __missing__(self, piece: str) -> int:
        n = self.count(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= 64:
            if len(self) > MEMO_PIECES:
                self.clear()
            self[piece] = n
        return n


def byte_letters() -> dict[str, int]:
    """The usual printable stand-ins of byte-level vocabularies: letter -> byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizer:
    """Counts tokens as the library does for a byte-level BPE file."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model, letters = data["model"], byte_letters()
        pre = data.get("pre_tokenizer") or {}
        added = data.get("added_tokens") or []
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        odd += [k for t in added for k in ("single_word", "lstrip", "rstrip", "normalized") if t.get(k) and not (k == "normalized" and not data.get("normalizer"))]
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or pre.get("use_regex") is False or data.get("normalizer") or odd:
            raise ValueError(f"only plain byte-level BPE files without a normalizer are compiled {odd}")
        raw = lambda s: bytes(letters[c] for c in s)
        special = {t["content"] for t in added}
        vocab = {raw(t): i for t, i in model["vocab"].items() if t not in special}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.pieces = Pieces(vocab, {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)})
        # Leftmost, then longest, as the library takes them.
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.table, self.classes = splitter(), class_table()

    def _parts(self, text: str) -> Iterator[str]:
        """The text in parts of about BLOCK characters; white space never joins what stands before it."""
        at = 0
        while len(text) - at > BLOCK and (end := PART.search(text, at + BLOCK)):
            yield text[at : end.start() + 1]
            at = end.start() + 1
        yield text[at:] if at else text

    def _count_parts(self, parts: list[str]) -> list[int]:
        codes = [self.classes[np.frombuffer(p.encode("utf-32-le", "surrogatepass"), np.uint32)] for p in parts]
        of, out = self.pieces.__getitem__, []
        for part, cuts in zip(parts, find_cuts(codes, self.table)):
            cuts.append(len(part))
            out.append(sum(map(of, [part[a:b] for a, b in zip(cuts, cuts[1:])])))
        return out

    def count_all(self, texts: list[str | None]) -> list[int]:
        """Tokens of each whole text (null: 0); a special token's string counts as one token."""
        out, parts, owners, held = [0] * len(texts), [], [], 0

        def flush() -> None:
            for owner, n in zip(owners, self._count_parts(parts) if parts else []):
                out[owner] += n
            parts.clear()
            owners.clear()

        for i, text in enumerate(texts):
            spans = [text] if text else []
            if self.special and text:
                spans = self.special.split(text)
                out[i] += len(spans) - 1
            for part in (p for x in spans if x for p in self._parts(x)):
                parts.append(part)
                owners.append(i)
                held += len(part)
                if held >= BLOCK:
                    flush()
                    held = 0
        flush()
        return out


def token_counts(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Null texts count as empty; repeated rows are counted each by itself; texts of any length are
    read whole; an empty table gives an empty result; other columns are not read.
    """
    spark = df.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:  # of the driver; its content goes out once
        spec = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = compiled(spec)
        for batch in sliced(batches):
            counts = tokenizer.count_all(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    text = F.coalesce(df[text_col], F.lit(""))
    rows = df.select(df[id_col].alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


_COMPILED: dict[int, Tokenizer] = {}


def compiled(spec: object) -> Tokenizer:
    """One compiled tokenizer a worker process."""
    key = hash(spec.value)
    if key not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[key] = Tokenizer(spec.value)
    return _COMPILED[key]

