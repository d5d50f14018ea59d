"""Names that operators use inside."""

from __future__ import annotations

from collections.abc import Iterable


def unused(taken: Iterable[str], *wanted: str) -> list[str]:
    """Each of ``wanted``, lengthened until it is none of ``taken`` (in any case) and no other of them."""
    held, out = {t.lower() for t in taken}, []
    for name in wanted:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out
