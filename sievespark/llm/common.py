"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What stands between words: ASCII white space (a fixed value of the contracts).
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words as long, by splitting between them (faster than counting matches); null text has none."""
    return F.when(text.isNull(), 0).otherwise(F.size(F.array_remove(F.split(text, GAP, -1), ""))).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often and however deep in lambdas it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, since single texts may be very long (Spark bounds batches by bytes)."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def unused(names: list[str], wanted: str) -> str:
    """``wanted``, lengthened until it is none of ``names`` (in any case)."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


_KINDS = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType(), "binary": T.BinaryType()}


def columns(spec: str) -> list[T.StructField]:
    """Fields from "name kind, ..."; ``[]`` behind a kind makes it an array of that kind."""
    parts = [x.split() for x in spec.split(",")]
    return [T.StructField(n, T.ArrayType(_KINDS[k[:-2]]) if k.endswith("[]") else _KINDS[k]) for n, k in parts]


def orderable(kind: T.DataType) -> bool:
    """Whether Spark can sort and compare values of this type."""
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))
