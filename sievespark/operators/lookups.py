"""Lookups by key: semi, anti and defaulted joins, with their completeness checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def only_keys(df: DataFrame, wanted: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.join(wanted.select(*key), list(key), "left_semi")


def missing_keys(wanted: DataFrame, found: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys asked for but not there."""
    return wanted.select(*key).distinct().join(found.select(*key), list(key), "left_anti")


def with_default(df: DataFrame, lookup: DataFrame, key: Sequence[str], defaults: dict[str, object]) -> DataFrame:
    """Left join; columns of ``defaults`` are filled where the lookup has no row."""
    out = df.join(lookup, list(key), "left")
    for name, value in defaults.items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return out


def require_none(df: DataFrame, what: str) -> None:
    """Stop if ``df`` has a row; shows the first few."""
    some = df.limit(5).collect()
    if some:
        raise ValueError(f"{what}: {[tuple(r) for r in some]}")


def the_only_row(df: DataFrame, where: Column, what: str) -> DataFrame:
    """The one row that meets ``where``; none or several are an error."""
    found = df.where(where).limit(2)
    n = found.count()
    if n != 1:
        raise ValueError(f"{what}: {'none' if n == 0 else 'more than one'} found")
    return found
