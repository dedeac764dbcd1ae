"""Exact distinct counts that add up: bitmaps of surrogate keys per day, and per month, and retailer.

A bitmap stands for 32,768 neighbouring keys. Those of any days are joined by OR, so a range of dates
needs no fact to count its products, customers and stores, however often each was sold to: whole
months are answered by their own bitmaps, the days at both ends by theirs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.aggregate import spread
from tallyhouse.schemas import Star

#: What is counted, the keys it has in the facts, and the name of its count.
KINDS = {"product": "product_id", "customer": "customer_id", "store": "store_id"}


def daily_members(star: Star) -> DataFrame:
    """(month_id, date_id, retailer_id, kind, bucket, bits) of the keys in the facts; null keys count nowhere.

    Facts move once, by day and retailer, before they become a row for each kind; bitmaps are made where
    all keys of theirs are, not merged from half-empty ones. A key that comes again sets the same bit.
    """
    keys = F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(column).alias("id")) for kind, column in KINDS.items()))
    where = ["month_id", "date_id", "retailer_id", "kind"]
    sold = spread(star.fact.select(*where[:-1], *KINDS.values()), "date_id", "retailer_id")
    seen = sold.select(*where[:-1], F.inline(keys)).where("id is not null")
    placed = seen.select(*where, F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("bit"))
    by = [*where, "bucket"]
    return placed.groupBy(*by).agg(F.bitmap_construct_agg("bit").alias("bits"))


def monthly_members(daily: DataFrame) -> DataFrame:
    """The bitmaps of whole months: a few rows for each, joined from its days'."""
    by = ["month_id", "retailer_id", "kind", "bucket"]
    return daily.groupBy(*by).agg(F.bitmap_or_agg("bits").alias("bits"))


@dataclass(frozen=True)
class Members:
    """Both tables, kept by month."""

    daily: DataFrame
    monthly: DataFrame

    def between(self, start: dt.date, end: dt.date, retailer_id: int | None = None) -> DataFrame:
        """The bitmaps (retailer_id, kind, bucket, bits) that together are the keys of the range."""
        first = start if start.day == 1 else (start.replace(day=1) + dt.timedelta(days=31)).replace(day=1)
        behind = end + dt.timedelta(days=1)  # the last whole month is the one before this day's
        last = behind.replace(day=1) - dt.timedelta(days=1)
        low, high = (x.year * 100 + x.month for x in (start, end))
        from_, to = (x.year * 100 + x.month for x in (first, last))
        whole = F.col("month_id").between(from_, to)
        edges = F.col("month_id").between(low, high) & ~whole
        days = F.col("date_id").between(*(x.year * 10000 + x.month * 100 + x.day for x in (start, end)))
        found = self.monthly.where(whole).unionByName(self.daily.where(edges & days).drop("date_id"))
        return found if retailer_id is None else found.where(F.col("retailer_id") == retailer_id)


def count_members(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per ``by`` how many different products, customers and stores: one row if ``by`` is empty."""
    joined = bitmaps.groupBy(*by, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    counts = [
        F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).alias(f"unique_{kind}s") for kind in KINDS
    ]
    return joined.groupBy(*by).agg(*counts) if by else joined.agg(*counts)
