"""Report, chart and panel data sets.

Most read the persisted rollups, passed in as a mapping of rollup name to frame; the rest call the
analytics functions. ``as_of`` stands for today. Every limit has natural-key tie-breakers, so a
report is the same on every run.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import asc, desc, mean, total
from tallyhouse.operators import analytics
from tallyhouse.operators.analytics import Day, as_day, days_before
from tallyhouse.schemas import RETAILERS, Star

Views = Mapping[str, DataFrame]
RETAILER_NAMES = [name for _, _, name in RETAILERS]


def _from(day: Day) -> Column:
    """Dates from ``day`` on; the month is compared too, as large rollups are kept by month."""
    day = as_day(day)
    month = F.col("year") * 12 + F.col("month")
    return (month >= day.year * 12 + day.month) & (F.col("date") >= F.lit(day))


def _since(as_of: Day, days: int) -> Column:
    return _from(days_before(as_of, days))


def _this_year(as_of: Day) -> Column:
    return F.col("year") == as_day(as_of).year


# Example reports ---------------------------------------------------------------------------


def daily_dashboard(views: Views, as_of: Day) -> DataFrame:
    return (
        views["mv_daily_sales_summary"]
        .where(_since(as_of, 7))
        .orderBy(desc("date"), desc("total_revenue"), asc("retailer_name"))
        .limit(20)
        .select(
            "date", "retailer_name", "total_revenue", "transaction_count", "total_quantity",
            "avg_unit_price",
        )
    )


def _top_rollup(views: Views, n: int) -> DataFrame:
    return (
        views["mv_top_products_by_revenue"]
        .orderBy(desc("total_revenue"), asc("product_sku"), asc("retailer_id"))
        .limit(n)
    )


def top_products(views: Views) -> DataFrame:
    return _top_rollup(views, 10).select(
        "product_name", "category", "retailer_name", "total_revenue", "total_quantity_sold",
        "avg_unit_price",
    )


def category_performance(views: Views, as_of: Day) -> DataFrame:
    return (
        views["mv_monthly_sales_by_category"]
        .where(_this_year(as_of))
        .orderBy(
            desc("year"), desc("month"), desc("total_revenue"), asc("category"),
            asc("retailer_name"),
        )
        .limit(20)
        .select(
            "year", "month", "category", "retailer_name", "total_revenue", "unique_products",
            "avg_unit_price",
        )
    )


def weekly_trends(views: Views, as_of: Day) -> DataFrame:
    return (
        views["mv_weekly_sales_trends"]
        .where(_this_year(as_of))
        .orderBy(desc("year"), desc("week"), asc("quarter"), asc("retailer_name"))
        .limit(10)
        .select(
            "year", "week", "retailer_name", "total_revenue", "avg_transaction_amount",
            "days_with_sales", "week_start_date", "week_end_date",
        )
    )


def quarterly_summary(views: Views, as_of: Day) -> DataFrame:
    return (
        views["mv_quarterly_sales_summary"]
        .where(_this_year(as_of))
        .orderBy(asc("retailer_name"), asc("quarter"))
        .select(
            "retailer_name", "year", "quarter", "total_revenue", "unique_products",
            "transaction_count", "avg_transaction_amount",
        )
    )


def top_product_trends(views: Views, as_of: Day) -> DataFrame:
    """Daily rows of the top five; a product that is there for two retailers counts twice."""
    best = _top_rollup(views, 5).select(
        "product_id", "product_name", F.col("retailer_id").alias("top_retailer_id")
    )
    daily = views["mv_daily_sales_by_product"].where(_since(as_of, 30)).drop("product_name")
    return (
        daily.join(F.broadcast(best), "product_id")  # five rows
        .orderBy(
            desc("date"), desc("total_revenue"), asc("product_sku"), asc("retailer_id"),
            asc("top_retailer_id"),
        )
        .limit(20)
        .select(
            "date", "product_name", "retailer_name", "total_revenue", "total_quantity_sold",
            "avg_unit_price",
        )
    )


def retailer_comparison(views: Views, as_of: Day) -> DataFrame:
    return (
        views["mv_daily_sales_summary"]
        .where(_since(as_of, 30))
        .groupBy("retailer_name")
        .agg(
            F.count_distinct("date").alias("days_active"),
            F.sum("total_revenue").alias("total_revenue"),
            F.sum("transaction_count").alias("total_transactions"),
            mean("total_revenue").alias("avg_daily_revenue"),
            F.max("total_revenue").alias("max_daily_revenue"),
        )
        .orderBy(desc("total_revenue"), asc("retailer_name"))
    )


def category_growth(views: Views, as_of: Day) -> DataFrame:
    def in_quarter(quarter: int) -> Column:
        hit = F.ceil(F.col("month") / 3) == quarter
        return F.sum(F.when(hit, F.col("total_revenue")).otherwise(0)).alias(f"q{quarter}_revenue")

    return (
        views["mv_monthly_sales_by_category"]
        .where(_this_year(as_of))
        .groupBy("category", "retailer_name")
        .agg(*[in_quarter(q) for q in (1, 2, 3, 4)], F.sum("total_revenue").alias("total_revenue"))
        .where("total_revenue > 0")
        .orderBy(desc("total_revenue"), asc("category"), asc("retailer_name"))
        .limit(15)
    )


# Chart data sets ---------------------------------------------------------------------------


def _by_retailer(df: DataFrame, key: str) -> DataFrame:
    """One column of revenue per retailer: the known ones, then any others that have sales."""
    named = df.select("retailer_name").distinct().where("retailer_name is not null")
    found = {row["retailer_name"] for row in named.collect()}  # a row for each retailer
    names = [*RETAILER_NAMES, *sorted(found.difference(RETAILER_NAMES))]
    return df.groupBy(key).pivot("retailer_name", names).agg(F.sum("total_revenue"))


def chart_daily(views: Views, as_of: Day) -> DataFrame:
    return _by_retailer(views["mv_daily_sales_summary"].where(_since(as_of, 30)), "date").orderBy(
        asc("date")
    )


def chart_top_products(views: Views) -> DataFrame:
    name = F.col("product_name")
    short = F.when(F.length(name) > 30, F.concat(F.substring(name, 1, 30), F.lit("..."))).otherwise(
        name
    )
    return _top_rollup(views, 10).select(
        "product_name", "total_revenue", "retailer_name", short.alias("product_name_short")
    )


def chart_categories(views: Views, as_of: Day) -> DataFrame:
    best = (
        views["mv_monthly_sales_by_category"]
        .where(_this_year(as_of))
        .groupBy("category", "retailer_name")
        .agg(F.sum("total_revenue").alias("total_revenue"))
        .where("total_revenue > 0")
        .orderBy(desc("total_revenue"), asc("category"), asc("retailer_name"))
        .limit(15)
    )
    return _by_retailer(best, "category").na.fill(0).orderBy(asc(RETAILER_NAMES[0]))


def chart_weekly(views: Views, as_of: Day) -> DataFrame:
    """A week that spans two quarters has two rollup rows; they are added up."""
    return _by_retailer(views["mv_weekly_sales_trends"].where(_this_year(as_of)), "week").orderBy(
        asc("week")
    )


def chart_retailers(views: Views, as_of: Day) -> DataFrame:
    return retailer_comparison(views, as_of).drop("days_active", "max_daily_revenue")


# Dashboard panels --------------------------------------------------------------------------


def _daily_range(views: Views, start: Day, end: Day) -> DataFrame:
    day = F.col("date")
    inside = day.between(F.lit(as_day(start)), F.lit(as_day(end)))
    return views["mv_daily_sales_summary"].where(inside).orderBy(asc("date"), asc("retailer_name"))


def panel_daily_revenue(views: Views, start: Day, end: Day) -> DataFrame:
    return _daily_range(views, start, end).select(
        F.col("date").alias("time"), "retailer_name", "total_revenue"
    )


def panel_daily_transactions(views: Views, start: Day, end: Day) -> DataFrame:
    return _daily_range(views, start, end).select(
        F.col("date").alias("time"), "retailer_name", "transaction_count"
    )


def panel_retailer_week(star: Star, as_of: Day) -> DataFrame:
    return analytics.retailer_performance(star, days_before(as_of, 7), as_of).select(
        "retailer_name", F.col("total_revenue").alias("revenue")
    )


def panel_today(star: Star, as_of: Day) -> DataFrame:
    return analytics.retailer_performance(star, as_of, as_of).select(
        "retailer_name", "total_revenue"
    )


def panel_top_revenue(star: Star, start: Day, end: Day) -> DataFrame:
    return analytics.top_products(star, start, end).select("product_name", "total_revenue")


def panel_top_quantity(star: Star, start: Day, end: Day) -> DataFrame:
    """The ten best by revenue, shown by quantity."""
    return (
        analytics.top_products(star, start, end)
        .orderBy(desc("total_quantity_sold"), asc("product_sku"))
        .select("product_name", "total_quantity_sold")
    )


def panel_category_monthly(views: Views, start: Day, end: Day) -> DataFrame:
    """Revenue per category and month whose first day lies in the range."""
    return (
        views["mv_monthly_sales_by_category"]
        .withColumn("time", F.make_date("year", "month", F.lit(1)))
        .where(F.col("time").between(F.lit(as_day(start)), F.lit(as_day(end))))
        .groupBy("time", "category")
        .agg(F.sum("total_revenue").alias("revenue"))
        .orderBy(asc("time"), asc("category"))
    )


def panel_category_heatmap(views: Views, start: Day, end: Day) -> DataFrame:
    return panel_category_monthly(views, start, end).select("category", "time", "revenue")


def panel_weekly(star: Star, start: Day, end: Day) -> DataFrame:
    return (
        analytics.sales_trends(star, start, end, "weekly")
        .orderBy(asc("period_start"))
        .select(F.col("period_start").alias("time"), "total_revenue")
    )


def panel_quarterly(star: Star, start: Day, end: Day) -> DataFrame:
    return (
        analytics.sales_trends(star, start, end, "quarterly")
        .orderBy(desc("period_start"))
        .select(F.col("period_label").alias("year_quarter"), "total_revenue", "transaction_count")
    )


# Documented queries ------------------------------------------------------------------------


def daily_by_retailer(star: Star) -> DataFrame:
    days = star.fact.groupBy("date_id", "retailer_id").agg(
        total("total_amount").alias("total_revenue"), F.count("*").alias("transaction_count")
    )
    return (
        days.join(star.dates.select("date_id", "date"), "date_id")
        .join(star.retailers.select("retailer_id", "retailer_name"), "retailer_id")
        .groupBy("date", "retailer_name")
        .agg(
            F.sum("total_revenue").alias("total_revenue"),
            F.sum("transaction_count").alias("transaction_count"),
        )
        .orderBy(desc("date"), asc("retailer_name"))
    )


def top_by_name(star: Star, n: int = 20) -> DataFrame:
    """Top products by name and category: SKUs that share both are one product here."""
    sold = star.fact.groupBy("product_id").agg(
        total("total_amount").alias("total_revenue"), F.sum("quantity").alias("total_quantity")
    )
    return (
        sold.join(star.products.select("product_id", "product_name", "category"), "product_id")
        .groupBy("product_name", "category")
        .agg(
            F.sum("total_revenue").alias("total_revenue"),
            F.sum("total_quantity").alias("total_quantity"),
        )
        .orderBy(desc("total_revenue"), asc("product_name"), asc("category"))
        .limit(n)
    )


def monthly_revenue(star: Star) -> DataFrame:
    days = star.fact.groupBy("date_id").agg(total("total_amount").alias("revenue"))
    return (
        days.join(star.dates.select("date_id", "year", "month"), "date_id")
        .groupBy("year", "month")
        .agg(F.sum("revenue").alias("monthly_revenue"))
        .orderBy(asc("year"), asc("month"))
    )


def by_retailer(star: Star) -> DataFrame:
    sold = star.fact.groupBy("retailer_id").agg(
        F.count("*").alias("record_count"), total("total_amount").alias("total_revenue")
    )
    return sold.join(star.retailers, "retailer_id").select(
        "retailer_name", "record_count", "total_revenue"
    )


def category_year(views: Views, as_of: Day) -> DataFrame:
    return (
        views["mv_monthly_sales_by_category"]
        .where(_this_year(as_of))
        .groupBy("category")
        .agg(F.sum("total_revenue").alias("revenue"))
        .orderBy(desc("revenue"), asc("category"))
    )


def daily_one_retailer(views: Views, retailer: str, since: Day) -> DataFrame:
    return (
        views["mv_daily_sales_summary"]
        .where((F.col("retailer_name") == retailer) & _from(since))
        .orderBy(desc("date"))
        .select("date", "total_revenue", "transaction_count", "total_quantity")
    )


def daily_one_sku(views: Views, sku: str, retailer: str, since: Day) -> DataFrame:
    wanted = (F.col("product_sku") == sku) & (F.col("retailer_name") == retailer)
    return (
        views["mv_daily_sales_by_product"]
        .where(wanted & _from(since))
        .orderBy(desc("date"))
        .select("date", "total_revenue", "total_quantity_sold", "avg_unit_price")
    )


def average_daily_revenue(views: Views, as_of: Day) -> DataFrame:
    return retailer_comparison(views, as_of).select(
        "retailer_name", "total_revenue", "avg_daily_revenue"
    )


def top_one_retailer(views: Views, retailer: str) -> DataFrame:
    return (
        views["mv_top_products_by_revenue"]
        .where(F.col("retailer_name") == retailer)
        .orderBy(desc("total_revenue"), asc("product_sku"))
        .limit(10)
        .select("product_name", "category", "total_revenue", "total_quantity_sold")
    )


def monthly_one_retailer(views: Views, retailer: str, year: int) -> DataFrame:
    return (
        views["mv_monthly_sales_by_category"]
        .where((F.col("retailer_name") == retailer) & (F.col("year") == year))
        .orderBy(asc("year"), asc("month"), desc("total_revenue"), asc("category"))
        .select("year", "month", "category", "total_revenue", "unique_products")
    )


def weekly_one_retailer(views: Views, retailer: str, year: int) -> DataFrame:
    return (
        views["mv_weekly_sales_trends"]
        .where((F.col("retailer_name") == retailer) & (F.col("year") == year))
        .orderBy(asc("year"), asc("week"), asc("quarter"))
        .select("year", "week", "total_revenue", "avg_transaction_amount", "days_with_sales")
    )


def quarterly_year(views: Views, year: int) -> DataFrame:
    return (
        views["mv_quarterly_sales_summary"]
        .where(F.col("year") == year)
        .orderBy(asc("retailer_name"), asc("quarter"))
        .select("retailer_name", "year", "quarter", "total_revenue", "unique_products")
    )


def top_current_month(star: Star, as_of: Day) -> DataFrame:
    start, end = analytics.month_start(as_of), analytics.month_end(as_of)
    return analytics.top_products(star, start, end, 20).select(
        "product_name", "category", "total_revenue", "total_quantity_sold", "transaction_count"
    )


def retailers_last_quarter(star: Star, as_of: Day) -> DataFrame:
    end = days_before(analytics.quarter_start(as_of), 1)
    return analytics.retailer_performance(star, analytics.quarter_start(end), end).select(
        "retailer_name", "total_revenue", F.col("revenue_percentage").alias("market_share"),
        "avg_transaction_amount", "unique_customers",
    )


def top20(views: Views) -> DataFrame:
    return _top_rollup(views, 20).select(
        "product_name", "category", "total_revenue", "total_quantity_sold"
    )


def monthly_category_list(views: Views, as_of: Day) -> DataFrame:
    return (
        views["mv_monthly_sales_by_category"]
        .where(_this_year(as_of))
        .orderBy(asc("year"), asc("month"), asc("category"), asc("retailer_name"))
        .select("year", "month", "category", "total_revenue")
    )


def quarterly_list(views: Views) -> DataFrame:
    return (
        views["mv_quarterly_sales_summary"]
        .orderBy(desc("year"), desc("quarter"), asc("retailer_name"))
        .select("year", "quarter", "retailer_name", "total_revenue", "transaction_count")
    )


def load_activity(star: Star) -> DataFrame:
    """When the fact table was last loaded and how many rows it has."""
    return star.fact.agg(
        F.max("created_at").alias("last_loaded"), F.count("*").alias("fact_count")
    )


def newest_rows(star: Star, n: int = 10) -> DataFrame:
    """The ``n`` rows loaded last; the fact key settles ties."""
    return star.fact.orderBy(
        desc("created_at"), asc("transaction_id"), asc("product_id"), asc("retailer_id")
    ).limit(n)
