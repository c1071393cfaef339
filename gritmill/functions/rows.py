"""Turn a one-row aggregate into a long report table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_from(one_row: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One output row per mapping; all mappings share their keys and types."""
    structs = [F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows]
    return one_row.select(F.inline(F.array(*structs)))
