"""Rings and aromaticity of a connection table, as far as patterns ask for them.

Rings are the shortest cycles through each bond. A ring of five to seven atoms is aromatic if every
atom can lend it 0, 1 or 2 electrons and they are 4 n + 2: 1 with a double bond in a ring, 2 from a
lone pair (N, O, S, P, or a negative carbon), 0 from a carbon doubly bonded to an electronegative
atom outside, or a positive one. This is a model of its own; toolkits differ in rare ring systems.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass, field

from sievespark.chem.molblock import Molecule

#: Usual valences, and atomic numbers of the elements that occur in drug-like molecules.
VALENCE = {"H": 1, "B": 3, "C": 4, "N": 3, "O": 2, "F": 1, "Si": 4, "P": 3, "S": 2, "Cl": 1, "Br": 1, "I": 1}
NUMBER = {"H": 1, "B": 5, "C": 6, "N": 7, "O": 8, "F": 9, "Na": 11, "Mg": 12, "Si": 14, "P": 15, "S": 16, "Cl": 17, "K": 19, "Ca": 20, "Zn": 30, "Se": 34, "Br": 35, "I": 53}


@dataclass
class Perceived:
    """What patterns ask of a molecule, per atom and bond (bonds keyed by the smaller atom first)."""

    symbols: list[str]
    charges: list[int]
    near: list[dict[int, int]]
    hydrogens: list[int] = field(default_factory=list)
    rings: list[tuple[int, ...]] = field(default_factory=list)
    ring_bonds: set[tuple[int, int]] = field(default_factory=set)
    aromatic: set[int] = field(default_factory=set)
    aromatic_bonds: set[tuple[int, int]] = field(default_factory=set)


def bond(a: int, b: int) -> tuple[int, int]:
    return (a, b) if a < b else (b, a)


def _shortest_ring(near: list[dict[int, int]], a: int, b: int) -> tuple[int, ...] | None:
    """The shortest cycle through bond a-b."""
    before, queue = {a: a}, deque([a])
    while queue:
        v = queue.popleft()
        for w in near[v]:
            if w in before or (v, w) == (a, b):
                continue
            before[w] = v
            if w == b:
                path = [b]
                while path[-1] != a:
                    path.append(before[path[-1]])
                return tuple(path)
            queue.append(w)
    return None


def _lent(p: Perceived, i: int, order: int = 2) -> int | None:
    """Electrons that a ring atom lends, None if it cannot be aromatic."""
    symbol, charge = p.symbols[i], p.charges[i]
    double = [j for j, o in p.near[i].items() if o == order]
    if any(bond(i, j) in p.ring_bonds for j in double):
        return 1
    if double:
        return 0 if symbol == "C" and any(p.symbols[j] in ("O", "N", "S") for j in double) else None
    if any(o > order and o != 4 for o in p.near[i].values()):
        return None
    if symbol in ("N", "O", "S", "P", "Se"):
        return 2 if charge <= 0 else None
    if symbol == "C" and charge:
        return 2 if charge < 0 else 0
    return 0 if symbol == "B" else None


def perceive(mol: Molecule) -> Perceived:
    near: list[dict[int, int]] = [{} for _ in mol.symbols]
    for a, b, order in mol.bonds:
        near[a][b] = near[b][a] = order
    p = Perceived(list(mol.symbols), [mol.charges.get(i, 0) for i in range(len(mol.symbols))], near)
    rings = {}
    for a, b, _ in mol.bonds:
        ring = _shortest_ring(near, a, b)
        if ring:
            rings.setdefault(frozenset(ring), ring)
            p.ring_bonds.update(bond(x, y) for x, y in zip(ring, ring[1:] + ring[:1]))
    p.rings = list(rings.values())
    for i, s in enumerate(mol.symbols):
        explicit = sum(mol.symbols[j] == "H" for j in near[i])
        used = sum(1.5 if o == 4 else o for o in near[i].values())
        usual = VALENCE.get(s, 0) + (p.charges[i] if s in ("N", "O", "P", "S") else -abs(p.charges[i]))
        p.hydrogens.append(explicit + max(0, int(usual - used)))
    for ring in p.rings:
        pairs = [bond(x, y) for x, y in zip(ring, ring[1:] + ring[:1])]
        lent = [_lent(p, i) for i in ring]
        given = all(p.near[a][b] == 4 for a, b in pairs)  # already written as aromatic
        if given or 5 <= len(ring) <= 7 and None not in lent and sum(lent) % 4 == 2:
            p.aromatic.update(ring)
            p.aromatic_bonds.update(pairs)
    return p
