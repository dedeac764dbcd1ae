"""Insert-if-absent for source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyhouse.operators.aggregate import first_wins


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, key: str, order: list[str]
) -> DataFrame:
    """The incoming rows to append: the first per key, unless ``existing`` has the key."""
    fresh = first_wins(incoming, [key], order)
    return fresh.join(existing.select(key), key, "left_anti").select(*incoming.columns)
