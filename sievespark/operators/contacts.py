"""Contacts of a group of atoms (a nitrile, say) with a reference structure, after superposition.

Positions are columns. A superposition is a 3 x 4 matrix; neighbours within a radius are found by
an equality join on cells as wide as the radius, each point looking into the 27 cells around it. The
nearest one is found without these pairs: cells of points keep lists of the atoms that can be nearest
to a point inside, and halve until the lists are short.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievespark.chem.molblock import parse_block
from sievespark.chem.patterns import find
from sievespark.functions.scalar import distance as between
from sievespark.functions.scalar import let
from sievespark.operators.names import unused
from sievespark.session import cut_lineage, drop

#: Rows of a structure that are sent to all executors (about 100 bytes each); larger ones are joined by cell.
STRUCTURE = 200_000
#: Atoms a cell on average at which cells are small enough, and how often they are halved at most.
LISTED, HALVED = 32, 6


def moved(x: Column, y: Column, z: Column, matrix: Sequence[Sequence[float]]) -> list[Column]:
    """The point after rotation and shift: three rows of (r1, r2, r3, shift)."""
    if len(matrix) != 3 or any(len(row) != 4 for row in matrix):
        raise ValueError("a superposition is three rows of four numbers")
    return [x * F.lit(float(a)) + y * F.lit(float(b)) + z * F.lit(float(c)) + F.lit(float(t)) for a, b, c, t in matrix]


def group_atoms(poses: DataFrame, smarts: str = "C#N", block: str = "block") -> DataFrame:
    """``poses`` once for each match of a two-atom pattern, with its number and ax ay az, bx by bz (the two atoms' places).

    Poses that do not parse, or hold no match, have no row.
    """
    (found,) = unused(poses.columns, "found")
    point = "ax:double,ay:double,az:double,bx:double,by:double,bz:double"

    @F.pandas_udf(f"array<struct<number:int,{point}>>")
    def match(blocks: pd.Series) -> pd.Series:
        out = []
        for text in blocks:
            try:
                mol = parse_block(text)
                out.append([(i, *mol.xyz[a[0]], *mol.xyz[a[1]]) for i, (_, a) in enumerate(find(text, [smarts]))])
            except (ValueError, AttributeError, IndexError):
                out.append(None)
        return pd.Series(out)

    return poses.withColumn(found, F.explode(match(F.col(block)))).select(*poses.columns, f"{found}.*")


def neighbours(points: DataFrame, structure: DataFrame, at: Sequence[str], to: Sequence[str], radius: float, columns: Sequence[str]) -> DataFrame:
    """Pairs of a point and a row of ``structure`` up to ``radius`` apart: the point's columns, ``columns`` of the structure, distance.

    ``at`` and ``to`` name the three places. Points or atoms without a place have no neighbours. The
    structure's rows are copied to the 27 cells around them; where it has up to STRUCTURE rows it is
    sent out, so that no cell of the points is gathered in one task.
    """
    if radius <= 0:
        raise ValueError("the radius is above 0")
    taken = [*points.columns, *columns]
    cell, distance = unused(taken, "cell", "distance")
    spot = unused([*taken, cell, distance], "x", "y", "z")
    whole = lambda c: F.floor(c.cast("double") / radius)
    around = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    places = structure.where(" and ".join(f"`{c}` is not null" for c in to)).select(*[F.col(c).cast("double").alias(s) for c, s in zip(to, spot)], *columns)
    shifts = places
    for s in spot:
        (step,) = unused([*shifts.columns, *taken], f"{s}_step")
        shifts = shifts.withColumn(step, F.explode(around))
    steps = shifts.columns[-3:]
    near = shifts.select(*places.columns, F.struct(*[(whole(F.col(s)) + F.col(d)).alias(n) for s, d, n in zip(spot, steps, "abc")]).alias(cell))
    if structure.limit(STRUCTURE + 1).count() <= STRUCTURE:
        near = F.broadcast(near)
    mine = F.struct(*[whole(F.col(c)).alias(n) for c, n in zip(at, "abc")])
    rows = points.where(" and ".join(f"`{c}` is not null" for c in at))
    (own,) = unused([*taken, *spot, cell, distance], "own_cell")
    met = rows.withColumn(own, mine).join(near, F.col(own) == F.col(cell))
    d = [F.col(a) - F.col(s) for a, s in zip(at, spot)]
    apart = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])
    return met.withColumn(distance, apart).where(F.col(distance) <= radius).select(*points.columns, *columns, F.col(distance).alias("distance"))


def _can_be_nearest(atoms: Column, cell: Sequence[Column], width: float, radius: float) -> Column:
    """Those of ``atoms`` that may be nearest to, and within the radius of, some point of the cell.

    The nearest to a point is at most half a diagonal further from it than the nearest to the middle
    is from the middle, so it is within a whole diagonal more of the middle.
    """
    middle = [(c + 0.5) * width for c in cell]
    half = width * 3**0.5 / 2

    def near(atoms: Column, d: Column) -> Column:
        bar = F.least(F.array_min(d) + 2 * half, F.lit(radius + half)) * (1 + 1e-9)
        return let(lambda atoms, d, bar: F.filter(atoms, lambda a, i: F.get(d, i) <= bar), atoms=atoms, d=d, bar=bar)

    return let(near, atoms=atoms, d=F.transform(atoms, lambda a: between([a[x] for x in "xyz"], middle)))


def _atom_lists(points: DataFrame, structure: DataFrame, at: Sequence[str], to: Sequence[str], radius: float, columns: Sequence[str]) -> tuple[DataFrame, float]:
    """(cell, atoms) for the cells that points are in and atoms are near, and the cells' width.

    Cells as wide as the radius take the atoms of the 27 cells around them; then each halves, and its
    parts keep those of its atoms that can be nearest.
    """
    abc = [F.col(f"cell.{c}") for c in "abc"]
    cells = lambda width: points.select(F.struct(*[F.floor(F.col(c) / width).alias(n) for c, n in zip(at, "abc")]).alias("cell")).distinct()
    atom = F.struct(*[F.col(c).cast("double").alias(x) for c, x in zip(to, "xyz")], *columns)
    placed = structure.where(" and ".join(f"`{c}` is not null" for c in to)).select(atom.alias("atom")).distinct()
    for x in "xyz":
        placed = placed.withColumn(f"{x}_cell", F.explode(F.array(*[F.floor(F.col(f"atom.{x}") / radius) + i for i in (-1, 0, 1)])))
    placed = placed.select(F.struct(*[F.col(f"{x}_cell").alias(n) for x, n in zip("xyz", "abc")]).alias("cell"), "atom")
    width, halved = float(radius), 0
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, much work: tasks are not to be merged
    lists = placed.join(cells(width), "cell").repartition(n, "cell").groupBy("cell").agg(F.collect_list("atom").alias("atoms"))
    while True:
        table = cut_lineage(lists.select("cell", _can_be_nearest(F.col("atoms"), abc, width, radius).alias("atoms")))
        if halved:
            drop(last)
        kept = table.where(F.size("atoms") > 0)
        sizes = kept.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("atoms")).alias("all")).first()
        if halved == HALVED or (sizes["all"] or 0) <= LISTED * sizes["n"]:
            return kept, width
        last, width, halved = table, width / 2, halved + 1
        parts = cells(width).repartition(n, "cell").withColumn("parent", F.struct(*[F.floor(c / 2).alias(n) for c, n in zip(abc, "abc")]))
        lists = parts.join(kept.withColumnRenamed("cell", "parent"), "parent").select("cell", "atoms")


def nearest(points: DataFrame, structure: DataFrame, at: Sequence[str], to: Sequence[str], radius: float, columns: Sequence[str]) -> DataFrame:
    """``points`` with ``nearest``: distance and ``columns`` of the nearest row of ``structure`` up to ``radius`` away, else null.

    Ties go to the least ``columns``. Points without a place have none nearest.
    """
    if radius <= 0:
        raise ValueError("the radius is above 0")
    lists, width = _atom_lists(points, structure, at, to, radius, columns)
    cell, found, met = unused(points.columns, "cell", "found", "atoms")
    mine = points.withColumn(cell, F.struct(*[F.floor(F.col(c) / width).alias(n) for c, n in zip(at, "abc")]))
    both = mine.join(lists.select(F.col("cell").alias(found), F.col("atoms").alias(met)), F.col(cell) == F.col(found), "left")

    def apart(a: Column) -> Column:
        d = [F.col(c) - a[x] for c, x in zip(at, "xyz")]
        return F.struct(F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]).alias("distance"), *[a[c].alias(c) for c in columns])

    first = F.array_min(F.transform(met, apart))
    return both.select(*points.columns, let(lambda a: F.when(a["distance"] <= radius, a), a=first).alias("nearest"))


def angle(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Degrees between two directions; null if one has no length."""
    dot = lambda p, q: p[0] * q[0] + p[1] * q[1] + p[2] * q[2]
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / size)))))


def group_contacts(groups: DataFrame, key: Sequence[str], structure: DataFrame, reference: tuple[Sequence[float], Sequence[float]], matrix: Sequence[Sequence[float]] = ((1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0)), radius: float = 6.0, contact: float = 3.5) -> DataFrame:
    """``key``, offset, angle, residue, distance, contact of every group of atoms.

    ``groups`` has ``key`` and ax ay az, bx by bz (the atoms of the group, the second at its head);
    ``structure`` has x, y, z, resname, resnum. After ``matrix`` is applied to the group: offset from
    the reference's head, angle between the two directions in degrees, the residue (name and number)
    nearest to the head within ``radius``, ties to the smaller number, then name (null if there is
    none), and whether it is within ``contact``. Rows that repeat a key are one group each only if
    they differ in place; groups without a place have nulls.
    """
    a, b = (moved(*[F.col(f"{p}{x}") for x in "xyz"], matrix) for p in "ab")
    tail, head = ([F.lit(float(v)) for v in p] for p in reference)
    d = [p - q for p, q in zip(b, head)]
    names = [f"group_{x}" for x in "xyz"]
    rows = groups.select(*key, *[c.alias(n) for c, n in zip(b, names)], F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]).alias("offset"), angle([q - p for p, q in zip(a, b)], [q - p for p, q in zip(tail, head)]).alias("angle")).distinct()
    rows = cut_lineage(rows)
    met = nearest(rows, structure, names, ["x", "y", "z"], radius, ["resnum", "resname"])
    residue = F.concat("nearest.resname", F.col("nearest.resnum").cast("string"))
    return met.select(*key, "offset", "angle", residue.alias("residue"), F.col("nearest.distance").alias("distance"), F.coalesce(F.col("nearest.distance") <= contact, F.lit(False)).alias("contact"))
