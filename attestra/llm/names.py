"""Column names that clash with none."""

from __future__ import annotations


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores until no column is called so."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name
