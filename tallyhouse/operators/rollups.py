"""The six rollups kept as tables, each a DataFrame over the star schema.

Facts are aggregated on their integer keys first wherever the dimensions only add labels, so the
joins with retailers and products see aggregated rows. Only the calendar, which cannot grow with
sales, is broadcast by force; the other sides are left to Spark's size check
(autoBroadcastJoinThreshold, and again at run time under AQE), and a product that dominates a
shuffle join is split by AQE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import days_in_quarter, mean, total
from tallyhouse.operators.aggregate import group_with_distincts, products_per_group, spread
from tallyhouse.schemas import Star

TRANSACTIONS = {"unique_transactions": "transaction_id"}


def _dates(star: Star, *columns: str) -> DataFrame:
    """Date columns to join by key. The calendar has 366 rows a year at most: always broadcast."""
    return F.broadcast(star.dates.select("date_id", *columns))


def _dated(fact: DataFrame, star: Star, *columns: str) -> DataFrame:
    return fact.join(_dates(star, *columns), "date_id")


def _by_transaction(star: Star) -> DataFrame:
    """Facts by transaction: each is counted where it is, and what then moves is a few rows a group and task.

    Nearly every fact is a transaction of its own in a group, so groups made before the shuffle would
    be as many as the facts, and wider.
    """
    return spread(star.fact, "transaction_id")


def _by_product(star: Star) -> DataFrame:
    """Facts by product: groups with the product among their keys, and the join with products, need no other shuffle."""
    return spread(star.fact, "product_id")


def _with_retailer_name(df: DataFrame, star: Star) -> DataFrame:
    return df.join(star.retailers.select("retailer_id", "retailer_name"), "retailer_id")


def daily_sales_summary(star: Star) -> DataFrame:
    """Per date and retailer."""
    days = group_with_distincts(
        _by_transaction(star),
        ["date_id", "retailer_id"],
        [
            F.count("*").alias("transaction_count"),
            F.sum("quantity").alias("total_quantity"),
            total("total_amount").alias("total_revenue"),
            mean("unit_price").alias("avg_unit_price"),
            F.min("total_amount").alias("min_transaction_amount"),
            F.max("total_amount").alias("max_transaction_amount"),
        ],
        TRANSACTIONS,
    )
    dated = days.join(_dates(star, "date", "year", "month", "quarter"), "date_id")
    return _with_retailer_name(dated, star).select(
        "date", "year", "month", "quarter", "retailer_id", "retailer_name", "transaction_count",
        "unique_transactions", "total_quantity", "total_revenue", "avg_unit_price",
        "min_transaction_amount", "max_transaction_amount",
    )


def monthly_sales_by_category(star: Star) -> DataFrame:
    """Per month, category and retailer; products without a category are left out."""
    keys = ["year", "month", "quarter", "category", "retailer_id"]
    categories = star.products.where("category is not null").select("product_id", "category")
    lines = _dated(star.fact, star, "year", "month", "quarter")
    categorised = spread(star.fact.join(categories, "product_id"), "transaction_id")
    months = group_with_distincts(
        _dated(categorised, star, "year", "month", "quarter"),
        keys,
        [
            F.count("*").alias("transaction_count"),
            F.sum("quantity").alias("total_quantity"),
            total("total_amount").alias("total_revenue"),
            mean("unit_price").alias("avg_unit_price"),
        ],
        TRANSACTIONS,
    ).join(products_per_group(lines, categories, keys), keys)
    return _with_retailer_name(months, star).select(
        *keys, "retailer_name", "transaction_count", "unique_transactions", "unique_products",
        "total_quantity", "total_revenue", "avg_unit_price",
    )


def top_products_by_revenue(star: Star) -> DataFrame:
    """Per product and retailer, all time, unsorted."""
    sold = group_with_distincts(
        _by_product(star),
        ["product_id", "retailer_id"],
        [
            F.count("*").alias("transaction_count"),
            F.sum("quantity").alias("total_quantity_sold"),
            total("total_amount").alias("total_revenue"),
            mean("unit_price").alias("avg_unit_price"),
            F.min("unit_price").alias("min_unit_price"),
            F.max("unit_price").alias("max_unit_price"),
        ],
        TRANSACTIONS,
    )
    return _labelled_products(sold, star)


def product_months(star: Star) -> DataFrame:
    """What each month adds to :func:`top_products_by_revenue`: sums, counts and extremes that merge."""
    return group_with_distincts(
        _by_product(star),
        ["month_id", "product_id", "retailer_id"],
        [
            F.count("*").alias("transaction_count"),
            F.sum("quantity").alias("total_quantity_sold"),
            total("total_amount").alias("total_revenue"),
            F.sum("unit_price").alias("price_sum"),
            F.count("unit_price").alias("price_count"),
            F.min("unit_price").alias("min_unit_price"),
            F.max("unit_price").alias("max_unit_price"),
        ],
        TRANSACTIONS,
    )


def top_products_of_months(months: DataFrame, star: Star) -> DataFrame:
    """:func:`top_products_by_revenue` from :func:`product_months`.

    A transaction has a product once per retailer, as the loads see to, so the months' counts of
    transactions add up.
    """
    sold = spread(months, "product_id").groupBy("product_id", "retailer_id").agg(
        F.sum("transaction_count").alias("transaction_count"),
        F.sum("unique_transactions").alias("unique_transactions"),
        F.sum("total_quantity_sold").alias("total_quantity_sold"),
        F.sum("total_revenue").cast("decimal(20,2)").alias("total_revenue"),
        F.try_divide(F.sum("price_sum").cast("double"), F.sum("price_count")).alias("avg_unit_price"),
        F.min("min_unit_price").alias("min_unit_price"),
        F.max("max_unit_price").alias("max_unit_price"),
    )
    return _labelled_products(sold, star)


def _labelled_products(sold: DataFrame, star: Star) -> DataFrame:
    products = star.products.select("product_id", "product_sku", "product_name", "category")
    return _with_retailer_name(sold.join(products, "product_id"), star).select(
        "product_id", "product_sku", "product_name", "category", "retailer_id", "retailer_name",
        "transaction_count", "unique_transactions", "total_quantity_sold", "total_revenue",
        "avg_unit_price", "min_unit_price", "max_unit_price",
    )


def weekly_sales_trends(star: Star) -> DataFrame:
    """Per calendar year, ISO week, quarter and retailer.

    The year is the calendar year, so the last days of December may carry week 1; grouping by
    quarter as well keeps them apart from early January.
    """
    keys = ["year", "week", "quarter", "retailer_id"]
    weeks = group_with_distincts(
        _dated(_by_transaction(star), star, "date", "year", "week", "quarter"),
        keys,
        [
            F.count("*").alias("transaction_count"),
            days_in_quarter(F.col("date")).alias("days_with_sales"),
            F.sum("quantity").alias("total_quantity"),
            total("total_amount").alias("total_revenue"),
            mean("total_amount").alias("avg_transaction_amount"),
            F.min("date").alias("week_start_date"),
            F.max("date").alias("week_end_date"),
        ],
        TRANSACTIONS,
    )
    return _with_retailer_name(weeks, star).select(
        *keys, "retailer_name", "transaction_count", "unique_transactions", "days_with_sales",
        "total_quantity", "total_revenue", "avg_transaction_amount", "week_start_date",
        "week_end_date",
    )


def quarterly_sales_summary(star: Star) -> DataFrame:
    """Per quarter and retailer; lines whose product is unknown drop out."""
    keys = ["year", "quarter", "retailer_id"]
    known = star.products.select("product_id")
    lines = _dated(star.fact, star, "date", "year", "quarter")
    sold = spread(star.fact.join(known, "product_id"), "transaction_id")
    quarters = group_with_distincts(
        _dated(sold, star, "date", "year", "quarter"),
        keys,
        [
            F.count("*").alias("transaction_count"),
            days_in_quarter(F.col("date")).alias("days_with_sales"),
            F.sum("quantity").alias("total_quantity"),
            total("total_amount").alias("total_revenue"),
            mean("total_amount").alias("avg_transaction_amount"),
        ],
        TRANSACTIONS,
    ).join(products_per_group(lines, known, keys), keys)
    return _with_retailer_name(quarters, star).select(
        *keys, "retailer_name", "transaction_count", "unique_transactions", "days_with_sales",
        "unique_products", "total_quantity", "total_revenue", "avg_transaction_amount",
    )


def daily_sales_by_product(star: Star) -> DataFrame:
    """Per date, product and retailer."""
    days = _by_product(star).groupBy("date_id", "product_id", "retailer_id").agg(
        F.count("*").alias("transaction_count"),
        F.sum("quantity").alias("total_quantity_sold"),
        total("total_amount").alias("total_revenue"),
        mean("unit_price").alias("avg_unit_price"),
    )
    dates = _dates(star, "date", "year", "month")
    products = star.products.select("product_id", "product_sku", "product_name", "category")
    labelled = days.join(dates, "date_id").join(products, "product_id")
    return _with_retailer_name(labelled, star).select(
        "date", "year", "month", "product_id", "product_sku", "product_name", "category",
        "retailer_id", "retailer_name", "transaction_count", "total_quantity_sold",
        "total_revenue", "avg_unit_price",
    )


ROLLUPS: dict[str, Callable[[Star], DataFrame]] = {
    "mv_daily_sales_summary": daily_sales_summary,
    "mv_monthly_sales_by_category": monthly_sales_by_category,
    "mv_top_products_by_revenue": top_products_by_revenue,
    "mv_weekly_sales_trends": weekly_sales_trends,
    "mv_quarterly_sales_summary": quarterly_sales_summary,
    "mv_daily_sales_by_product": daily_sales_by_product,
}


def sales_enriched(star: Star) -> DataFrame:
    """Every fact with its dimensions: the wide form for ad-hoc queries.

    Date, product and retailer must exist; customer and store may be unknown. Unknown ones join by a
    negative number that no dimension has, different from transaction to transaction, so that they
    don't meet in one task.
    """
    nobody = -1 - F.pmod(F.xxhash64("transaction_id"), F.lit(1 << 20))
    customers = star.customers.select(F.col("customer_id").alias("customer"), "customer_external_id")
    stores = star.stores.select(F.col("store_id").alias("store"), "store_external_id")
    return (
        star.fact.join(F.broadcast(star.dates.drop("created_at")), "date_id")
        .join(star.products.drop("created_at", "updated_at"), "product_id")
        .join(star.retailers, "retailer_id")
        .join(customers, F.coalesce("customer_id", nobody) == F.col("customer"), "left")
        .join(stores, F.coalesce("store_id", nobody) == F.col("store"), "left")
        .drop("customer", "store")
    )
