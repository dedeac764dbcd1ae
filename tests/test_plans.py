"""How often plans read the facts, and what the reports and refreshes do in rare cases."""

import pytest

from tallyhouse.operators import analytics, members, quality, reports, rollups
from tallyhouse.plans import queries, refresh
from tallyhouse.plans.store import TableStore
from tallyhouse.sources import tables
from tests.stars import line, star_of

DAY = "2024-05-02"
PRODUCTS = [(1, "A", "Anvil", "Tools"), (2, "B", "Bolt", "Parts")]


def bitmaps(star):
    """The bitmaps as tables of their own, as a store has them."""
    spark, columns = star.fact.sparkSession, "month_id int, date_id int, retailer_id int, kind string, bucket bigint, bits binary"
    daily = spark.createDataFrame([tuple(x) for x in members.daily_members(star).collect()], columns)
    monthly = [tuple(x) for x in members.monthly_members(daily).collect()]
    return members.Members(daily, spark.createDataFrame(monthly, columns.replace("date_id int, ", "")))


@pytest.fixture
def star(spark, folder):
    from dataclasses import replace

    made = star_of(spark, [line(DAY, 1, "t1"), line(DAY, 2, "t1"), line("2024-05-03", 1, "t2")], PRODUCTS)
    store = TableStore(spark, f"{folder}/star")
    return replace(made, fact=store.write("fact_sales", made.fact, ["month_id"] if "month_id" in made.fact.columns else []))


def fact_scans(df) -> int:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation [" in x and "total_amount#" in x for x in plan.splitlines())


@pytest.mark.parametrize(("most", "query"), [
    (4, lambda s: analytics.sales_summary(s, DAY, DAY)),
    (1, lambda s: analytics.sales_summary(s, DAY, DAY, members=bitmaps(s))),
    (1, lambda s: analytics.retailer_performance(s, DAY, DAY, members=bitmaps(s))),
    (2, lambda s: analytics.sales_by_category(s, DAY, DAY)),
    (3, lambda s: analytics.retailer_performance(s, DAY, DAY)),
    (1, lambda s: analytics.sales_trends(s, DAY, DAY, "weekly")),
    (1, lambda s: rollups.daily_sales_summary(s)),
    (2, lambda s: rollups.monthly_sales_by_category(s)),
    (1, lambda s: rollups.top_products_by_revenue(s)),
    (1, lambda s: rollups.weekly_sales_trends(s)),
    (2, lambda s: rollups.quarterly_sales_summary(s)),
    (2, lambda s: quality.quality_report(s, DAY, DAY)),
    (1, lambda s: quality.quality_summary(s, DAY, DAY)),
])
def test_fact_scans(star, most, query):
    assert 1 <= fact_scans(query(star)) <= most


def test_a_further_retailer_has_its_column(spark):
    rows = [("2024-05-01", 2024, 5, "Retailer 1", 10.0), ("2024-05-01", 2024, 5, "Retailer 4", 7.0)]
    view = spark.createDataFrame(rows, "date string, year int, month int, retailer_name string, total_revenue double")
    view = view.withColumn("date", view["date"].cast("date"))
    got = reports.chart_daily({"mv_daily_sales_summary": view}, DAY).first().asDict()
    assert (got["Retailer 1"], got["Retailer 2"], got["Retailer 4"]) == (10.0, None, 7.0)


def test_refresh_of_all_or_none(spark, star, folder, monkeypatch):
    store = TableStore(spark, f"{folder}/store")
    assert refresh.refresh_together(star, store).where("successful").count() == 6
    status = {r["view_name"]: r["row_count"] for r in refresh.refresh_status(store).collect()}
    assert len(status) == 6 and min(status.values()) > 0
    shown = {name: store.path(name) for name in rollups.ROLLUPS}

    def broken(_):
        raise RuntimeError("no space")

    monkeypatch.setitem(rollups.ROLLUPS, "mv_weekly_sales_trends", broken)
    monkeypatch.setattr(refresh, "refresh_all", lambda *_: "one by one")
    assert refresh.refresh_together(star, store) == "one by one"
    assert shown == {name: store.path(name) for name in rollups.ROLLUPS}


def test_freshness_names_the_newest_date(star):
    got = {str(r["date"]): r["details"] for r in quality.check_freshness(star, "2024-05-01", "2024-05-04", "2024-05-04").collect()}
    assert [got[f"2024-05-0{i}"]["latest_date"] for i in (1, 2, 3, 4)] == [None, DAY, "2024-05-03", "2024-05-03"]


def test_unknown_customers_stay_unknown(spark):
    star = star_of(spark, [line(DAY, 1, f"t{i}") for i in range(5)], PRODUCTS)
    wide = rollups.sales_enriched(star)
    assert wide.count() == 5 and len(wide.columns) == len(set(wide.columns))


def test_bitmaps_count_what_facts_have(spark):
    lines = [
        line(f"2024-{4 + i % 3:02}-{1 + i % 9 * 3:02}", 1 + (i * 40_000) % 999_999, f"t{i}", 1 + i % 3, customer=i % 7 or None, store=None if i % 3 == 0 else 5)
        for i in range(200)
    ]
    star = star_of(spark, [*lines, *lines[:20], line("2024-05-31", None, "no product", 4, customer=None, store=None)], PRODUCTS)
    bits = bitmaps(star)
    ranges = (
        ("2024-04-01", "2024-06-30"), ("2024-04-04", "2024-06-10"), ("2024-04-02", "2024-05-31"), ("2024-05-01", "2024-06-29"),
        ("2024-05-07", "2024-05-13"), ("2024-04-30", "2024-05-01"), ("2024-05-01", "2024-05-31"), ("2023-01-01", "2023-01-02"),
    )
    for start, end in ranges:
        for retailer in (None, 2):
            plain = analytics.sales_summary(star, start, end, retailer).first()
            assert analytics.sales_summary(star, start, end, retailer, members=bits).first() == plain, (start, end)
        plain = analytics.retailer_performance(star, start, end).collect()
        assert analytics.retailer_performance(star, start, end, members=bits).collect() == plain


def exchanges(df) -> list[str]:
    """The shuffles of a plan; joins are not broadcast."""
    spark, key = df.sparkSession, "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    return [x.split("Exchange ")[1] for x in plan.splitlines() if "Exchange hashpartitioning" in x]


def test_lines_move_once_to_become_facts(spark):
    moved = exchanges(tables.fact_sales(spark, "/root/testdata/sf0.001"))
    assert len(moved) == 2 and all(x.startswith("hashpartitioning(order_number#") for x in moved)


@pytest.mark.parametrize(("name", "by"), [
    ("mv_daily_sales_summary", "transaction_id"), ("mv_weekly_sales_trends", "transaction_id"),
    ("mv_top_products_by_revenue", "product_id"), ("mv_daily_sales_by_product", "product_id"),
])
def test_facts_move_once_and_as_they_are(star, name, by):
    plan = rollups.ROLLUPS[name](star)._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(i for i, x in enumerate(plan) if "FileScan" in x and "total_amount" in x)
    last = max(i for i in range(scan) if "Exchange hashpartitioning" in plan[i])
    assert f"Exchange hashpartitioning({by}#" in plan[last] and not any("Aggregate" in x for x in plan[last:scan])


def test_facts_move_once_to_become_bitmaps(star):
    assert len(exchanges(members.daily_members(star))) == 1


def test_lines_keep_their_parts_in_the_join_with_orders(spark):
    moved = exchanges(tables.sales_lines(spark, "/root/testdata/sf0.001"))
    assert any(x.startswith("hashpartitioning(order_number#") and "REPARTITION_BY_NUM" in x for x in moved)


def test_raw_feeds_move_orders_and_parts_once(spark, folder, monkeypatch):
    """And each feed's records that don't convert come back, those with an unknown part or order in none."""
    lines = [  # supplier 3 sells as retailer_1, 4 as retailer_2, 5 as retailer_3
        (order, part, supplier, number, float(quantity), 10.0 * quantity)
        for supplier in (3, 4, 5) for order, part, number, quantity in
        ((1, 1, 1, 50), (1, 1, 1, 50), (1, 2, 2, 49), (2, 1, 1, 47), (2, 2, 7, 49), (2, 2, 3, 48), (9, 1, 1, 50), (1, 9, 3, 50), (None, 1, 4, 50))
    ]
    made = {
        "lineitem": (lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double"),
        "orders": ([(1, 7, "1998-03-01"), (2, 10, "1998-03-02")], "o_orderkey bigint, o_custkey bigint, o_orderdate string"),
        "part": ([(1, "anvil", "STEEL"), (2, "bolt", "PROMO")], "p_partkey bigint, p_name string, p_type string"),
    }
    for name, (rows, schema) in made.items():
        df = spark.createDataFrame(rows, schema)
        if name == "orders":
            df = df.withColumn("o_orderdate", df["o_orderdate"].cast("timestamp"))
        df.write.parquet(f"{folder}/{name}.parquet")
    written, write = [], TableStore.write
    monkeypatch.setattr(TableStore, "write", lambda self, name, df, *a: written.append(df) or write(self, name, df, *a))
    found = sorted(tuple(x) for x in queries.normalize_rejects(spark, folder).collect())
    each = (("1", "1", "anvil", "STEEL", "7"), ("1", "1", "anvil", "STEEL", "7"), ("1", "2", "bolt", None, "7"),
            ("2", "1", "anvil", "STEEL", None), ("2", "2", "bolt", None, None))
    assert found == [(f"retailer_{s - 2}", *x, str(s)) for s in (3, 4, 5) for x in each]

    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}  # with AQE reuse shows only when the plan has run
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        plans = [df.select("*")._jdf.queryExecution().executedPlan().toString() for df in written]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    for table in ("o_custkey", "p_name"):
        scans = [x for plan in plans for x in plan.splitlines() if "FileScan" in x and table in x]
        assert len(scans) == 1, table
