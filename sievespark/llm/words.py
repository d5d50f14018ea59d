"""Words of whole Arrow text columns, without a Python object a word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = 0x20
WHITE = [SPACE, *range(0x09, 0x0E)]


def byte_table(between: list[int]) -> np.ndarray:
    """What becomes of each UTF-8 byte: A-Z are lower-cased, ``between`` (ASCII) separates words."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[between] = SPACE
    return table


def split_words(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(offsets, words): text i has the words offsets[i] to offsets[i + 1]; nulls have none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer((at - at[0]).tobytes()), pa.py_buffer(table[data].tobytes()))
    parts = pc.ascii_split_whitespace(plain)
    sizes, words = pc.list_value_length(parts).to_numpy(zero_copy_only=False), parts.flatten()
    some = pc.greater(pc.binary_length(words), 0)  # the splitter gives empty words at the ends
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))]).astype(np.int64)
    return before[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)], words.filter(some)


def int_lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Lists of ``sizes`` over ``values``."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))
