"""Parameterised analytics over the star schema.

Date ranges are inclusive. They reach the fact table as ranges on its partition column and its
date key, so only the months asked for are listed and read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.columns import asc, desc, mean, share, total
from tallyhouse.operators.aggregate import (
    group_with_distincts,
    products_per_group,
    total_with_distincts,
)
from tallyhouse.operators.members import Members, count_members
from tallyhouse.schemas import Star

Day = dt.date | str


def as_day(day: Day) -> dt.date:
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def month_start(day: Day) -> dt.date:
    return as_day(day).replace(day=1)


def month_end(day: Day) -> dt.date:
    return (month_start(day) + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)


def quarter_start(day: Day) -> dt.date:
    start = month_start(day)
    return start.replace(month=(start.month - 1) // 3 * 3 + 1)


def days_before(day: Day, days: int) -> dt.date:
    return as_day(day) - dt.timedelta(days=days)


def _key(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def sales_between(
    star: Star, start: Day | None, end: Day | None, retailer_id: int | None = None
) -> DataFrame:
    """Facts of the range with their date columns; an open end and no retailer mean 'all'."""
    fact, dates = star.fact, star.dates
    if start is not None:
        first = _key(as_day(start))
        fact = fact.where((F.col("month_id") >= first // 100) & (F.col("date_id") >= first))
        dates = dates.where(F.col("date") >= F.lit(as_day(start)))
    if end is not None:
        last = _key(as_day(end))
        fact = fact.where((F.col("month_id") <= last // 100) & (F.col("date_id") <= last))
        dates = dates.where(F.col("date") <= F.lit(as_day(end)))
    if retailer_id is not None:
        fact = fact.where(F.col("retailer_id") == retailer_id)
    # The calendar has 366 rows a year at most, so it is always broadcast.
    columns = dates.select("date_id", "date", "year", "quarter", "month", "week")
    return fact.join(F.broadcast(columns), "date_id")


def sales_summary(
    star: Star, start: Day, end: Day, retailer_id: int | None = None, members: Members | None = None
) -> DataFrame:
    """One row of totals, extremes and distinct counts.

    With ``members`` the facts are read once, for the measures and transactions; products, customers
    and stores are counted from the bitmaps of the range's months and days.
    """
    lines = sales_between(star, start, end, retailer_id)
    measures = [
        F.count("*").alias("total_line_items"),
        F.sum("quantity").alias("total_quantity"),
        total("total_amount").alias("total_revenue"),
        mean("total_amount").alias("avg_transaction_amount"),
        F.min("total_amount").alias("min_transaction_amount"),
        F.max("total_amount").alias("max_transaction_amount"),
    ]
    transactions = {"total_transactions": "transaction_id"}
    uniques = {"unique_products": "product_id", "unique_customers": "customer_id", "unique_stores": "store_id"}
    if members is None:
        return total_with_distincts(lines, measures, transactions | uniques)
    counted = count_members(members.between(as_day(start), as_day(end), retailer_id))
    found = counted.select(F.struct(*uniques)).scalar()
    out = total_with_distincts(lines, measures, transactions).withColumn("_found", found)
    return out.select("*", *(F.col(f"_found.{x}").alias(x) for x in uniques)).drop("_found")


def top_products(
    star: Star, start: Day, end: Day, top_n: int = 10, retailer_id: int | None = None
) -> DataFrame:
    """The ``top_n`` products by revenue; the SKU settles ties."""
    sold = sales_between(star, start, end, retailer_id).groupBy("product_id").agg(
        total("total_amount").alias("total_revenue"),
        F.sum("quantity").alias("total_quantity_sold"),
        F.count("*").alias("transaction_count"),
        mean("unit_price").alias("avg_unit_price"),
    )
    products = star.products.select("product_id", "product_sku", "product_name", "category")
    return (
        sold.join(products, "product_id")
        .select(
            "product_id", "product_sku", "product_name", "category", "total_revenue",
            "total_quantity_sold", "transaction_count", "avg_unit_price",
        )
        .orderBy(desc("total_revenue"), asc("product_sku"))
        .limit(top_n)
    )


def _padded(name: str) -> Column:
    return F.lpad(F.col(name).cast("string"), 2, "0")


# The columns each period groups by and the label it shows.
_PERIODS = {
    "daily": (("date",), lambda: F.date_format("date", "yyyy-MM-dd")),
    "weekly": (("year", "week"), lambda: F.concat("year", F.lit("-W"), _padded("week"))),
    "monthly": (("year", "month"), lambda: F.concat("year", F.lit("-"), _padded("month"))),
    "quarterly": (("year", "quarter"), lambda: F.concat("year", F.lit("-Q"), "quarter")),
}


def sales_trends(
    star: Star,
    start: Day,
    end: Day,
    period: str = "daily",
    retailer_id: int | None = None,
) -> DataFrame:
    """Revenue per day, ISO week of the calendar year, month or quarter, in order.

    Start and end are the first and last date with sales, not the calendar bounds. Weeks group by
    calendar year and ISO week only, so 30 December joins the first week of the same year.
    """
    if period not in _PERIODS:
        raise ValueError(f"Invalid period: {period}. Must be one of: {', '.join(_PERIODS)}")
    keys, label = _PERIODS[period]
    lines = sales_between(star, start, end, retailer_id).withColumn("day", F.col("date"))
    grouped = group_with_distincts(
        lines,
        keys,
        [
            F.min("day").alias("period_start"),
            F.max("day").alias("period_end"),
            total("total_amount").alias("total_revenue"),
            F.sum("quantity").alias("total_quantity"),
            mean("total_amount").alias("avg_transaction_amount"),
        ],
        {"transaction_count": "transaction_id"},
    )
    return grouped.orderBy(*[asc(key) for key in keys]).select(
        label().alias("period_label"), "period_start", "period_end", "total_revenue",
        "total_quantity", "transaction_count", "avg_transaction_amount",
    )


def _all_rows(column: str) -> Column:
    """The total over grouped rows, of which there are as many as categories or retailers."""
    return F.coalesce(F.sum(column).over(Window.partitionBy(F.lit(1))), F.lit(0))


def sales_by_category(
    star: Star, start: Day, end: Day, retailer_id: int | None = None
) -> DataFrame:
    """Per category with its share of the revenue of all categorised sales."""
    categories = star.products.where("category is not null").select("product_id", "category")
    every_line = sales_between(star, start, end, retailer_id)
    lines = every_line.join(categories, "product_id")
    grouped = group_with_distincts(
        lines,
        ["category"],
        [
            total("total_amount").alias("total_revenue"),
            F.sum("quantity").alias("total_quantity"),
            mean("unit_price").alias("avg_unit_price"),
        ],
        {"transaction_count": "transaction_id"},
    )
    return (
        grouped.join(products_per_group(every_line, categories, ["category"]), "category")
        .withColumn("revenue_percentage", share(F.col("total_revenue"), _all_rows("total_revenue")))
        .select(
            "category", "total_revenue", "total_quantity", "transaction_count", "unique_products",
            "avg_unit_price", "revenue_percentage",
        )
        .orderBy(desc("total_revenue"), asc("category"))
    )


def retailer_performance(star: Star, start: Day, end: Day, members: Members | None = None) -> DataFrame:
    """Per retailer with its share of all revenue; ``members`` as in :func:`sales_summary`."""
    transactions = {"transaction_count": "transaction_id"}
    uniques = {"unique_products": "product_id", "unique_customers": "customer_id"}
    grouped = group_with_distincts(
        sales_between(star, start, end),
        ["retailer_id"],
        [
            total("total_amount").alias("total_revenue"),
            F.sum("quantity").alias("total_quantity"),
            mean("total_amount").alias("avg_transaction_amount"),
        ],
        transactions if members is not None else transactions | uniques,
    )
    if members is not None:
        counted = count_members(members.between(as_day(start), as_day(end)), ["retailer_id"])
        # a retailer all of whose keys are null has no bitmap
        grouped = grouped.join(counted.drop("unique_stores"), "retailer_id", "left").fillna(0, list(uniques))
    return (
        grouped.join(star.retailers.select("retailer_id", "retailer_name"), "retailer_id")
        .withColumn("revenue_percentage", share(F.col("total_revenue"), _all_rows("total_revenue")))
        .select(
            "retailer_id", "retailer_name", "total_revenue", "total_quantity",
            "transaction_count", "unique_products", "unique_customers", "avg_transaction_amount",
            "revenue_percentage",
        )
        .orderBy(desc("total_revenue"), asc("retailer_id"))
    )


def recent_sales(
    star: Star, as_of: Day, days_back: int = 7, retailer_id: int | None = None
) -> DataFrame:
    """Per day for the last ``days_back`` days including ``as_of``; later dates count too."""
    grouped = group_with_distincts(
        sales_between(star, days_before(as_of, days_back - 1), None, retailer_id),
        ["date"],
        [
            total("total_amount").alias("total_revenue"),
            F.sum("quantity").alias("total_quantity"),
            mean("total_amount").alias("avg_transaction_amount"),
        ],
        {"transaction_count": "transaction_id"},
    )
    return grouped.orderBy(desc("date"))


def database_statistics(star: Star) -> DataFrame:
    """One row: fact count, date range, revenue and the size of each dimension."""
    lines = star.fact.join(F.broadcast(star.dates.select("date_id", "date")), "date_id")
    return lines.agg(
        F.count("*").alias("total_sales_records"),
        F.min("date").alias("date_range_start"),
        F.max("date").alias("date_range_end"),
        total("total_amount").alias("total_revenue"),
    ).select(
        "*",
        star.products.agg(F.count("*")).scalar().alias("total_products"),
        star.customers.agg(F.count("*")).scalar().alias("total_customers"),
        star.stores.agg(F.count("*")).scalar().alias("total_stores"),
        star.retailers.agg(F.count("*")).scalar().alias("total_retailers"),
    )
