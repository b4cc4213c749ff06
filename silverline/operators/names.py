"""Names for columns that an operator adds for a while."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(taken: Iterable[str], base: str) -> str:
    """`base`, with underscores in front until no column is called that, whatever the case."""
    known = {c.lower() for c in taken}
    while base.lower() in known:
        base = f"_{base}"
    return base
