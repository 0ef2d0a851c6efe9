"""Key -> label lookups.

A fixed dictionary becomes a literal map expression: no join, no shuffle, stays in codegen.
A lookup *table* is joined; it is broadcast only after its row count is checked.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def map_lookup(key: Column, mapping: Mapping, default: str | None = None) -> Column:
    """Label for ``key`` from a fixed mapping; a miss is ``default`` (NULL if None)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    if mapping and all(isinstance(k, int) for k in mapping):
        number = key.try_cast("double")  # ids may arrive as text; what is not an integer misses
        key = F.when(number == F.floor(number), number.try_cast("int"))
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def join_lookup(df: DataFrame, table: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Join a lookup table; Spark broadcasts it where its measured bytes are under the session's
    threshold, else it is a shuffle join."""
    return df.join(table, on, how)
