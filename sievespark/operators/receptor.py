"""Receptor files as records: fixed columns, cap split-out, fragment ends, serial numbers, chain gaps.

Caps (ACE before a chain, NME after it) may be merged into the residues they cap, under names of
their own. They are split out as residues with standard names, residues are put in order, a TER
line closes each fragment, and atoms are numbered anew. Files are told apart by the columns
``within``, so any number of receptors is one job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievespark.functions.scalar import pdb_atom


@dataclass(frozen=True)
class Site:
    """A residue that carries a merged cap, the cap's own residue number, and the fragment it belongs to."""

    residue: int
    number: int
    fragment: int
    cap: str


#: Merged cap atoms and their standard names (the element is the first letter).
CAP_ATOMS = {
    "ACE": {"CAY": "CH3", "HY1": "HH31", "HY2": "HH32", "HY3": "HH33", "CY": "C", "OY": "O", "HAY1": "HH31", "HAY2": "HH32", "HAY3": "HH33"},
    "NME": {"NT": "N", "CAT": "CH3", "HNT": "H", "HT": "H", "HT1": "HH31", "HT2": "HH32", "HT3": "HH33", "HAT1": "HH31", "HAT2": "HH32", "HAT3": "HH33"},
}
#: The sites of the capped receptors, the stray atom beside an ACE, the last residue of their first fragment.
SITES = (Site(24, 23, 1, "ACE"), Site(316, 315, 2, "ACE"), Site(245, 246, 1, "NME"), Site(422, 423, 2, "NME"))
STRAY = {"ACE": ("HY",)}
BREAKS = (245,)
CAP_SIZE = 6


def _is_atom(line: Column) -> Column:
    return line.startswith("ATOM") | line.startswith("HETATM")


def atoms(lines: DataFrame, line: str = "value") -> DataFrame:
    """Fixed-column records; lines that are no atoms, or whose residue number is none, fall out."""
    at = lambda a, b: F.trim(F.substring(F.col(line), a + 1, b - a))
    out = lines.where(_is_atom(F.col(line))).select(
        "*", at(12, 16).alias("atom"), at(17, 20).alias("resname"), at(21, 22).alias("chain"), at(22, 26).try_cast("int").alias("resnum"),
        *[at(a, a + 8).try_cast("double").alias(c) for c, a in (("x", 30), ("y", 38), ("z", 46))],
        *[F.coalesce(at(a, a + 6).try_cast("double"), F.lit(v)).alias(c) for c, a, v in (("occupancy", 54, 1.0), ("temperature", 60, 0.0))],
    )
    return out.where("resnum is not null")


def target_atom(records: DataFrame, resname: str, resnum: int, atom: str) -> DataFrame:
    """The one atom of that name; none or several are an error."""
    from sievespark.operators.lookups import the_only_row

    where = (F.col("resname") == resname) & (F.col("resnum") == resnum) & (F.col("atom") == atom)
    return the_only_row(records, where, f"{resname} {resnum} {atom}")


def route(records: DataFrame, sites: Sequence[Site] = SITES, breaks: Sequence[int] = BREAKS) -> DataFrame:
    """Columns ``part`` (cap, drop or body), ``name``, ``residue`` (cap or own name), ``number`` and ``fragment``.

    At a site, atoms with one of the cap's merged names go to the cap's residue under their standard
    names and stray atoms are dropped; everything else stays in its residue. A cap's fragment is its
    site's, another residue's follows from the ``breaks`` (last residues of fragments).
    """
    part, name, number = F.lit("body"), F.col("atom"), F.col("resnum")
    residue = F.col("resname")
    fragment = sum((F.when(F.col("resnum") > last, 1).otherwise(0) for last in breaks), F.lit(1))
    for s in sites:
        here, names = F.col("resnum") == s.residue, CAP_ATOMS[s.cap]
        cap = here & F.col("atom").isin(*names)
        new = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
        part = F.when(cap, "cap").when(here & F.col("atom").isin(*STRAY.get(s.cap, ())), "drop").otherwise(part)
        name = F.when(cap, F.element_at(new, F.col("atom"))).otherwise(name)
        residue = F.when(cap, s.cap).otherwise(residue)
        number = F.when(cap, s.number).otherwise(number)
        fragment = F.when(cap, s.fragment).otherwise(fragment)
    return records.withColumns({"part": part, "name": name, "residue": residue, "number": number, "fragment": fragment})


def cap_sizes(routed: DataFrame, within: Sequence[str] = (), sites: Sequence[Site] = SITES) -> DataFrame:
    """(within, residue, number, n, complete) for every site of every file, also where a cap has no atom."""
    here = [(F.col("part") == "cap") & (F.col("residue") == s.cap) & (F.col("number") == s.number) for s in sites]
    per = routed.groupBy(*within).agg(*[F.count_if(c).alias(f"n_{i}") for i, c in enumerate(here)])  # one pass, a row a file
    each = F.explode(F.array(*[F.struct(F.lit(s.cap).alias("residue"), F.lit(s.number).alias("number"), F.col(f"n_{i}").alias("n")) for i, s in enumerate(sites)]))
    out = per.select(*within, each.alias("site")).select(*within, "site.*")
    return out.withColumn("complete", F.col("n") == CAP_SIZE)


def number_fragments(records: DataFrame, within: Sequence[str], order: Sequence[str], fragment: str | Column) -> DataFrame:
    """``ter_before``: another fragment starts here; ``serial``: running number. A TER line uses up no number."""
    w = Window.partitionBy(*within).orderBy(*order)
    kind = F.col(fragment) if isinstance(fragment, str) else fragment
    return records.withColumn("ter_before", F.coalesce(F.lag(kind).over(w) != kind, F.lit(False))).withColumn("serial", F.row_number().over(w))


def capped_lines(lines: DataFrame, within: Sequence[str] = (), sites: Sequence[Site] = SITES, breaks: Sequence[int] = BREAKS) -> DataFrame:
    """(within, seq, value): the lines of the prepared files.

    Lines (``line_no``, ``value``) that are no atoms come first, but for TER, END and CONECT (whose
    serial numbers no longer hold); then the residues by number, atoms in their old order; TER
    before a new fragment and at the end, with the next atom's number; END (``seq`` of both holds it). An atom without a
    residue number, or a residue whose number a cap needs, is an error. No lines, no rows.
    """
    text = F.col("value")
    out = [*within, "seq", "value"]
    routed = route(atoms(lines), sites, breaks)
    number = F.trim(F.substring(text, 23, 4)).try_cast("int")
    # A cap's residue number holds no body atom; where it is a site's as well, that site's merged cap atoms go elsewhere.
    wrong = lines.where(_is_atom(text)).where(number.isNull() | number.isin(*[s.number for s in sites]))
    taken = route(atoms(wrong), sites, breaks).where("part = 'body'").where(F.col("number").isin(*[s.number for s in sites]))
    if not wrong.isEmpty() and not (wrong.where(number.isNull()).isEmpty() and taken.isEmpty()):
        raise ValueError("an atom has no residue number, or a cap's residue number is taken")
    header = lines.where(~(_is_atom(text) | text.startswith("TER") | text.startswith("END") | text.startswith("CONECT")))
    header = header.select(*within, F.struct(F.lit(0).alias("part"), F.col("line_no").cast("long").alias("a"), F.lit(0).alias("b")).alias("seq"), "value")
    chain = F.max_by(F.substring(text, 22, 1), "line_no").over(Window.partitionBy(*within))  # caps take the last atom's chain
    placed = number_fragments(routed.withColumn("chain", chain).where("part <> 'drop'"), within, ["number", "line_no"], "fragment")
    serial = F.lpad(F.col("serial").cast("string"), 5, " ")
    cap = pdb_atom(F.col("serial"), F.col("name"), F.col("residue"), F.col("chain"), F.col("number"), *[F.col(c) for c in ("x", "y", "z", "occupancy", "temperature")], F.substring("name", 1, 1))
    line = F.when(F.col("part") == "cap", cap).otherwise(F.concat(F.substring(text, 1, 6), serial, F.substring(text, F.lit(12), F.length(text))))
    row = lambda part, a, b, value: F.struct(F.struct(F.lit(part).alias("part"), a.cast("long").alias("a"), F.lit(b).alias("b")).alias("seq"), value.alias("value"))
    own, after = F.col("serial"), F.col("serial") + 1
    one = F.when(F.col("ter_before"), F.array(row(1, own, 0, F.concat(F.lit("TER   "), serial)), row(1, own, 1, line))).otherwise(F.array(row(1, own, 0, line)))
    end = F.array(row(2, after, 0, F.concat(F.lit("TER   "), F.lpad(after.cast("string"), 5, " "))), row(2, after, 1, F.lit("END")))
    last = F.lead("serial").over(Window.partitionBy(*within).orderBy("number", "line_no")).isNull()
    placed = placed.withColumn("last_atom", last)
    body = placed.select(*within, F.explode(F.when(F.col("last_atom"), F.concat(one, end)).otherwise(one)).alias("row")).select(*within, "row.*")
    return header.unionByName(body).select(*out)


def gap_marks(lines: DataFrame, last: int, within: Sequence[str] = ()) -> DataFrame:
    """``ter_after``: an atom of residue ``last`` whose very next line is an atom of another residue.

    ``lines`` are all lines of the files (``line_no``, ``value``), since any line in between breaks the pair.
    """
    text = F.col("value")
    number = F.when(_is_atom(text), F.trim(F.substring(text, 23, 4)).try_cast("int"))
    after = F.lead(number).over(Window.partitionBy(*within).orderBy("line_no"))
    return lines.withColumn("ter_after", F.coalesce((number == last) & (after != last), F.lit(False)))


def gap_lines(lines: DataFrame, last: int, within: Sequence[str] = ()) -> DataFrame:
    """(within, seq, value): the lines with a TER line at the chain gap; an error if there is no gap."""
    marked = gap_marks(lines, last, within)
    if marked.where("ter_after").isEmpty():
        raise ValueError(f"no chain breaks after residue {last}")
    both = F.when(F.col("ter_after"), F.array("value", F.rpad(F.lit("TER"), 11, " "))).otherwise(F.array("value"))
    rows = marked.select(*within, "line_no", F.posexplode(both).alias("b", "value"))
    return rows.select(*within, F.struct(F.lit(1).alias("part"), F.col("line_no").cast("long").alias("a"), "b").alias("seq"), "value")
