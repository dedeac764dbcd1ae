"""The three source tables: scans, value defaults, row counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import asc
from tallyhouse.operators.analytics import Day, as_day
from tallyhouse.schemas import Feed


def _midnight(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp_ntz")


def scan_feed(
    table: DataFrame, feed: Feed, start: Day | None = None, end: Day | None = None
) -> DataFrame:
    """The feed's columns, optionally for an inclusive range of dates, in date order.

    The range is put on the timestamp itself (from midnight, up to the next midnight), which
    reaches the file or database scan; a date function around the column would not. The record key
    makes the order total, so rows that share one timestamp can still be sorted by several tasks.
    """
    rows = table.select(*feed.columns)
    if start is not None:
        rows = rows.where(F.col(feed.date) >= _midnight(as_day(start)))
    if end is not None:
        rows = rows.where(F.col(feed.date) < _midnight(as_day(end) + dt.timedelta(days=1)))
    return rows.orderBy(asc(feed.date), asc(feed.key))


def with_defaults(rows: DataFrame, feed: Feed) -> DataFrame:
    """Empty amounts as the feed gives them out: null or 0 becomes the column's default."""
    filled = {
        name: F.when(F.coalesce(F.col(name), F.lit(0)) == 0, F.lit(default))
        .otherwise(F.col(name))
        .cast(rows.schema[name].dataType)
        for name, default in feed.defaults.items()
    }
    return rows.withColumns(filled)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per source table."""
    counts = [
        table.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("source"), "row_count")
        for name, table in tables.items()
    ]
    out, *rest = counts
    for count in rest:
        out = out.unionByName(count)
    return out
