"""Names for joined columns that the caller's table does not have."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores put before it until no column of ``docs`` is called so.

    Case does not matter, as in Spark.
    """
    taken = {c.lower() for c in docs.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found
