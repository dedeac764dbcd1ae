"""Exports for spreadsheets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.analytics import Day, as_day


def export_csv(view: DataFrame, path: str, since: Day) -> None:
    """Rows of a rollup from a date on, as CSV with a header. Files are written in parallel."""
    rows = view.where(F.col("date") >= F.lit(as_day(since)))
    rows.write.mode("overwrite").option("header", True).csv(path)
