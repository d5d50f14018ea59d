"""Connection tables and circular fingerprints as column expressions: no Python on the way.

A record's atoms and bonds become arrays of structs; what an atom sees around it is a hash over
those arrays, level by level. Everything is per row, so nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievespark.functions.scalar import let

#: Why a record is not read.
NO_COUNTS, CUT_OFF, NO_NUMBER = "no V2000 counts line", "the table is cut off", "a number cannot be read"


def connection_table(block: Column) -> Column:
    """(atoms, bonds, error) of a V2000 record.

    atoms: symbol, charge, x, y, z in order; bonds: a, b (places from 0), order. Where error is not
    null the others are. A null record has no counts line.
    """

    def table(lines: Column) -> Column:
        counts = F.coalesce(F.get(lines, 3), F.lit(""))
        return let(lambda lines, n, m, v2000: rows(lines, n, m, v2000), lines=lines, n=F.substring(counts, 1, 3).try_cast("int"), m=F.substring(counts, 4, 3).try_cast("int"), v2000=F.contains(counts, F.lit("V2000")))

    def rows(lines: Column, n: Column, m: Column, v2000: Column) -> Column:
        some = v2000 & (n >= 0) & (m >= 0) & (F.size(lines) >= n + m + 4)
        part = lambda start, size: F.when(some, F.slice(lines, start, size)).otherwise(F.array().cast("array<string>"))
        number = lambda r, a, size, kind: F.trim(F.substring(r, a, size)).try_cast(kind)
        zero = F.lit(0)
        atoms = F.transform(part(F.lit(5), F.coalesce(n, zero)), lambda r: F.struct(F.trim(F.substring(r, 32, 3)).alias("symbol"), *[number(r, a, 10, "double").alias(c) for c, a in (("x", 1), ("y", 11), ("z", 21))]))
        bonds = F.transform(part(F.coalesce(n, zero) + 5, F.coalesce(m, zero)), lambda r: F.struct((number(r, 1, 3, "int") - 1).alias("a"), (number(r, 4, 3, "int") - 1).alias("b"), number(r, 7, 3, "int").alias("order")))
        rest = F.when(some, F.slice(lines, n + m + 5, F.size(lines))).otherwise(F.array().cast("array<string>"))
        return let(lambda atoms, bonds, rest, some, n, v2000: whole(atoms, bonds, rest, some, n, v2000), atoms=atoms, bonds=bonds, rest=rest, some=some, n=n, v2000=v2000)

    def whole(atoms: Column, bonds: Column, rest: Column, some: Column, n: Column, v2000: Column) -> Column:
        end = F.array_position(F.transform(rest, lambda r: r.startswith("M  END")), F.lit(True))
        own = F.when(end > 0, F.slice(rest, 1, end.cast("int"))).otherwise(rest)
        marks = F.transform(F.filter(own, lambda r: r.startswith("M  CHG")), lambda r: F.filter(F.split(F.substring(r, 7, 1000), r"\s+"), lambda x: x != ""))
        pairs = F.flatten(F.transform(marks, lambda w: F.transform(F.when(F.size(w) >= 3, F.sequence(F.lit(2), F.size(w) - 1, F.lit(2))).otherwise(F.array().cast("array<int>")), lambda i: F.struct((F.get(w, i - 1).try_cast("int") - 1).alias("at"), F.get(w, i).try_cast("int").alias("charge")))))
        bad = F.exists(atoms, lambda a: a["x"].isNull() | a["y"].isNull() | a["z"].isNull()) | F.exists(bonds, lambda b: b["a"].isNull() | b["b"].isNull() | b["order"].isNull()) | F.exists(pairs, lambda p: p["at"].isNull() | p["charge"].isNull())
        stray = F.exists(bonds, lambda b: (b["a"] < 0) | (b["b"] < 0) | (b["a"] >= n) | (b["b"] >= n))
        error = F.when(~F.coalesce(v2000, F.lit(False)), NO_COUNTS).when(~F.coalesce(some, F.lit(False)), CUT_OFF).when(bad | stray, NO_NUMBER)
        return let(lambda atoms, bonds, pairs, error: found(atoms, bonds, pairs, error), atoms=atoms, bonds=bonds, pairs=pairs, error=error)

    def found(atoms: Column, bonds: Column, pairs: Column, error: Column) -> Column:
        last = lambda i: F.element_at(F.concat(F.array(F.lit(0)), F.transform(F.filter(pairs, lambda p: p["at"] == i), lambda p: p["charge"])), -1)  # noqa: E731  a later line counts
        charged = F.transform(atoms, lambda a, i: F.struct(a["symbol"].alias("symbol"), last(i).alias("charge"), *[a[c].alias(c) for c in "xyz"]))
        good = error.isNull()
        return F.struct(F.when(good, charged).alias("atoms"), F.when(good, bonds).alias("bonds"), error.alias("error"))

    return let(table, lines=F.split(F.replace(F.coalesce(block, F.lit("")), F.lit("\r\n"), F.lit("\n")), "\n"))


def maybe_charged(block: Column) -> Column:
    """Whether a record has a line of charges; atoms of any other have none, whether it can be read or not."""
    return F.contains(block, F.lit("\nM  CHG"))


def environments(table: Column, radius: int = 2) -> Column:
    """Codes of the distinct circular environments up to ``radius``, as longs; null where the table has an error."""

    def start(atoms: Column, bonds: Column) -> Column:
        turned = F.transform(bonds, lambda b: F.struct(b["b"].alias("a"), b["a"].alias("b"), b["order"].alias("order")))
        both = F.concat(bonds, turned)
        near = F.transform(atoms, lambda _, i: F.transform(F.filter(both, lambda b: b["a"] == i), lambda b: F.struct(b["order"].alias("order"), b["b"].alias("j"))))
        return let(lambda atoms, near: first(atoms, near), atoms=atoms, near=near)

    def first(atoms: Column, near: Column) -> Column:
        codes = F.zip_with(atoms, near, lambda a, e: F.xxhash64(a["symbol"], F.size(e), a["charge"]))
        return let(lambda codes, near: grown(codes, near, codes, 1), codes=codes, near=near)

    def grown(codes: Column, near: Column, every: Column, level: int) -> Column:
        if level > radius:
            return F.array_distinct(every)
        seen = lambda e: F.array_sort(F.transform(e, lambda x: F.struct(x["order"].alias("order"), F.get(codes, x["j"]).alias("code"))))
        more = F.zip_with(codes, near, lambda c, e: F.xxhash64(F.lit(level), c, seen(e)))
        return let(lambda more, near, every: grown(more, near, F.concat(every, more), level + 1), more=more, near=near, every=every)

    return F.when(table["error"].isNull(), let(start, atoms=table["atoms"], bonds=table["bonds"]))


def folded(codes: Column, bits: int = 2048) -> Column:
    """Codes as set bits of ``bits`` / 64 words."""

    def words(places: Column) -> Column:
        bit = lambda p: F.call_function("shiftleft", F.lit(1).cast("long"), (p % 64).cast("int"))
        word = lambda w: F.aggregate(F.filter(places, lambda p: F.floor(p / 64) == w), F.lit(0).cast("long"), lambda a, p: a.bitwiseOR(bit(p)))
        return F.transform(F.sequence(F.lit(0), F.lit(bits // 64 - 1)), word)

    return F.when(codes.isNotNull(), let(words, places=F.transform(codes, lambda c: F.pmod(c, F.lit(bits)))))
