"""Names for columns that an operator adds for its own use."""

from __future__ import annotations

from collections.abc import Iterable


def unused_names(columns: Iterable[str], *wanted: str) -> list[str]:
    """``wanted``, with a number behind each name that ``columns`` has in any case of letters."""
    taken = {name.lower() for name in columns}
    found = []
    for name in wanted:
        free = next(
            tried for tried in (name, *(f"{name}{n}" for n in range(1, len(taken) + 2))) if tried.lower() not in taken
        )
        taken.add(free.lower())
        found.append(free)
    return found
