"""Rollups and analytics on hand-made facts: calendar edges, nulls, orphans, dominant keys."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest

from tallyhouse.operators import analytics, rollups
from tests.stars import line, star_of

PRODUCTS = [(1, "A", "Anvil", "Tools"), (2, "B", "Bolt", ""), (3, "C", "Cog", None)]


def rows(df):
    return [row.asDict() for row in df.collect()]


def test_iso_week_with_calendar_year(spark):
    star = star_of(
        spark,
        [line("2024-12-30", 1, "t1", amount="5.00"), line("2024-01-02", 1, "t2", amount="7.00")],
        PRODUCTS,
    )
    weekly = rows(rollups.weekly_sales_trends(star))
    assert sorted((r["year"], r["week"], r["quarter"]) for r in weekly) == [(2024, 1, 1), (2024, 1, 4)]
    trend = rows(analytics.sales_trends(star, "2024-01-01", "2024-12-31", "weekly"))
    assert [(r["period_label"], r["total_revenue"]) for r in trend] == [("2024-W01", Decimal("12.00"))]
    assert trend[0]["period_start"] == dt.date(2024, 1, 2)
    assert trend[0]["period_end"] == dt.date(2024, 12, 30)


def test_date_attributes(spark):
    star = star_of(spark, [line("2023-01-01", 1, "t")], PRODUCTS)
    day = star.dates.first().asDict()
    assert (day["year"], day["week"], day["day_of_week"]) == (2023, 52, 7)
    assert (day["day_name"], day["is_weekend"]) == ("Sunday", True)


def test_null_category_is_left_out_and_empty_is_kept(spark):
    star = star_of(spark, [line("2024-05-01", p, f"t{p}") for p in (1, 2, 3)], PRODUCTS)
    found = rows(rollups.monthly_sales_by_category(star))
    assert sorted(r["category"] for r in found) == ["", "Tools"]
    shares = rows(analytics.sales_by_category(star, "2024-01-01", "2024-12-31"))
    assert [r["revenue_percentage"] for r in shares] == [Decimal("50.00")] * 2


def test_orphan_product_counts_by_day_but_not_by_quarter(spark):
    star = star_of(spark, [line("2024-05-01", 1, "t1"), line("2024-05-01", 99, "t2")], PRODUCTS)
    assert rows(rollups.daily_sales_summary(star))[0]["transaction_count"] == 2
    assert rows(rollups.quarterly_sales_summary(star))[0]["transaction_count"] == 1


def test_same_transaction_id_at_two_retailers_counts_once(spark):
    star = star_of(
        spark, [line("2024-05-01", 1, "t1", 1), line("2024-05-01", 1, "t1", 2)], PRODUCTS
    )
    found = rows(analytics.sales_summary(star, "2024-05-01", "2024-05-01"))[0]
    assert (found["total_transactions"], found["total_line_items"]) == (1, 2)


def test_empty_range(spark):
    star = star_of(spark, [line("2024-05-01", 1, "t1")], PRODUCTS)
    summary = rows(analytics.sales_summary(star, "2020-01-01", "2020-01-02"))[0]
    assert (summary["total_line_items"], summary["total_revenue"]) == (0, None)
    assert rows(analytics.retailer_performance(star, "2020-01-01", "2020-01-02")) == []


def test_shares_are_zero_without_revenue(spark):
    star = star_of(spark, [line("2024-05-01", 1, "t1", amount="0.00")], PRODUCTS)
    found = rows(analytics.retailer_performance(star, "2024-05-01", "2024-05-01"))
    assert found[0]["revenue_percentage"] == 0


def test_unknown_period(spark):
    star = star_of(spark, [line("2024-05-01", 1, "t1")], PRODUCTS)
    with pytest.raises(ValueError, match="Invalid period"):
        analytics.sales_trends(star, "2024-05-01", "2024-05-01", "hourly")


def test_recent_sales_has_no_upper_bound(spark):
    days = ["2024-05-01", "2024-05-02", "2024-05-08", "2024-05-09"]
    star = star_of(spark, [line(day, 1, day) for day in days], PRODUCTS)
    found = [str(r["date"]) for r in rows(analytics.recent_sales(star, "2024-05-08", 7))]
    assert found == ["2024-05-09", "2024-05-08", "2024-05-02"]


def test_dates_of_month_and_quarter():
    assert analytics.month_end("2024-02-11") == dt.date(2024, 2, 29)
    assert analytics.quarter_start("2024-12-01") == dt.date(2024, 10, 1)


def skewed_lines(seed=7, n=3000):
    """A third of the lines belong to one transaction, one to product 1, one to one day."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        hot = i % 3
        day = "2024-03-31" if hot == 0 else str(dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(366)))
        product = 1 if hot == 1 else rng.randrange(1, 40)
        txn = "hot" if hot == 2 else f"t{rng.randrange(400)}"
        out.append(line(day, product, txn, rng.randrange(1, 4), rng.randrange(1, 9), "2.50"))
    return out


def test_dominant_keys_match_brute_force(spark):
    lines = skewed_lines()
    products = [(i, f"P{i}", f"Product {i}", f"K{i % 4}") for i in range(1, 40)]
    star = star_of(spark, lines, products)

    groups = defaultdict(list)
    for row in lines:
        groups[row[0], row[4]].append(row)
    want = {
        key: (len(g), len({r[5] for r in g}), sum(r[6] for r in g), sum(r[8] for r in g))
        for key, g in groups.items()
    }
    got = {
        (int(str(r["date"]).replace("-", "")), r["retailer_id"]): (
            r["transaction_count"], r["unique_transactions"], r["total_quantity"],
            r["total_revenue"],
        )
        for r in rows(rollups.daily_sales_summary(star))
    }
    assert got == want

    quarters = defaultdict(list)
    for row in lines:
        quarters[(row[0] // 100 % 100 - 1) // 3 + 1, row[4]].append(row)
    want = {
        key: (len({r[0] for r in g}), len({r[1] for r in g}), len({r[5] for r in g}))
        for key, g in quarters.items()
    }
    got = {
        (r["quarter"], r["retailer_id"]): (
            r["days_with_sales"], r["unique_products"], r["unique_transactions"]
        )
        for r in rows(rollups.quarterly_sales_summary(star))
    }
    assert got == want


def test_rollups_agree_with_the_facts(spark):
    lines = skewed_lines(seed=11, n=900)
    products = [(i, f"P{i}", f"Product {i}", f"K{i % 4}") for i in range(1, 40)]
    star = star_of(spark, lines, products)
    want = sum(row[8] for row in lines)
    for rollup in rollups.ROLLUPS.values():
        assert sum(r["total_revenue"] for r in rows(rollup(star))) == want


def test_range_reaches_the_partition_column(spark, folder):
    star = star_of(spark, [line("2024-05-01", 1, "a"), line("2024-07-01", 1, "b")], PRODUCTS)
    star.fact.write.partitionBy("month_id").parquet(f"{folder}/fact")
    from dataclasses import replace

    stored = replace(star, fact=spark.read.parquet(f"{folder}/fact"))
    df = analytics.sales_between(stored, "2024-07-01", "2024-07-31")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_id" in plan
    assert "GreaterThanOrEqual(date_id,20240701)" in plan
    assert df.count() == 1
