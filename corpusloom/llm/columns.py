"""Names that clash with no column of a caller's table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores put before it until no column of ``df`` has it (any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
