"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def concat_records(tables: list[DataFrame]) -> DataFrame:
    """All rows of all tables, duplicates kept, columns matched by name."""
    if not tables:
        raise ValueError("nothing to concatenate")
    return reduce(DataFrame.unionByName, tables)
