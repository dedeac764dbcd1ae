"""Refreshing by touched months: the same rows as from all facts, and no file of another month."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import rollups
from tallyhouse.plans import refresh
from tallyhouse.plans.store import TableStore
from tests.stars import line, star_of

PRODUCTS = [(1, "A", "Anvil", "Tools"), (2, "B", "Bolt", "Parts"), (3, "C", "Cog", None)]
EARLY = [
    line(f"2024-{month:02}-{day:02}", product, f"t{month}-{day}-{product}", retailer, price="3.50")
    for month in (1, 2, 3, 4, 11, 12) for day in (1, 28) for product in (1, 2, 3) for retailer in (1, 2)
]
LATE = [
    line("2024-02-28", 1, "late", 3, price="9.99"), line("2024-02-29", 2, "t2-28-2", 1),
    line("2025-01-01", 1, "new"), line("2025-01-01", None, "no product"),
]


@pytest.fixture
def star(spark):
    return star_of(spark, [*EARLY, *LATE], PRODUCTS)


def early(star):
    return replace(star, fact=star.fact.where(~F.col("transaction_id").isin("late", "new", "no product") & (F.col("date_id") != 20240229)))


def rows(df):
    return sorted(map(repr, (r.asDict() for r in df.select(*sorted(df.columns)).collect())))


def files(store, name):
    return {x.split("/v=")[1] for x in store.read(name).inputFiles()}


def test_refresh_of_touched_months(spark, star, folder):
    store = TableStore(spark, f"{folder}/store")
    refresh.refresh_all(early(star), store)
    refresh.refresh_months(early(star), store, ())
    before = {name: files(store, name) for name in ("mv_daily_sales_by_product", refresh.PRODUCT_MONTHS)}
    status = refresh.refresh_months(star, store, {202402, 202501})
    assert status.where("successful").count() == 6
    for name, rollup in rollups.ROLLUPS.items():
        assert rows(store.read(name)) == rows(rollup(star)), name
    for name, old in before.items():
        months = ("year=2024/month=2", "year=2025/month=1", "month_id=202402", "month_id=202501")
        touched = {x for x in old if any(m + "/" in x for m in months)}
        new = files(store, name)
        assert touched and old - touched <= new and not touched & new
        assert all(any(m + "/" in x for m in months) for x in new - old)


def test_facts_of_other_months_are_not_read(spark, star, folder):
    facts = TableStore(spark, f"{folder}/facts")
    kept = replace(star, fact=facts.write("fact_sales", star.fact, ["month_id"]))
    for name in refresh.MONTHLY + refresh.BY_MONTH:
        plan = rollups.ROLLUPS[name](refresh._facts_of(kept, {202402}))._jdf.queryExecution().executedPlan().toString()
        scans = [x for x in plan.splitlines() if "FileScan" in x and "month_id" in x]
        assert scans and all("PartitionFilters: [isnotnull(month_id" in x or "month_id#" in x.split("PartitionFilters")[1] for x in scans)


def test_versions_share_files_until_no_one_names_them(spark, star, folder):
    store = TableStore(spark, f"{folder}/store")
    state = rollups.product_months(star)
    store.write("t", state, ["month_id"])
    want = rows(state)
    for month in (202402, 202403, 202402, 202404):
        store.replace_parts("t", rollups.product_months(refresh._facts_of(star, {month})), ["month_id"], [(month,)])
        store.drop_old("t")
        assert rows(store.read("t")) == want
    assert rows(store.read("t").where("month_id = 202411")) == rows(state.where("month_id = 202411"))
    assert len(store.versions("t")) <= 4
    gone = store.replace_parts("t", state.where("false"), ["month_id"], [(202402,)])
    assert rows(gone) == rows(state.where("month_id <> 202402"))
    with pytest.raises(ValueError, match="other partitions"):
        store.replace_parts("t", state, ["month_id"], [(202402,)])


def test_products_that_change_touch_their_months(spark, star, folder):
    store = TableStore(spark, f"{folder}/store")
    assert refresh.months_of_changed(star.products, star.products, store) == set()
    refresh.refresh_months(star, store, ())
    renamed = star.products.withColumn("category", F.when(F.col("product_id") == 3, "Gears").otherwise(F.col("category")))
    assert refresh.months_of_changed(star.products, renamed, store) == {202401, 202402, 202403, 202404, 202411, 202412}
    changed = replace(star, products=renamed)
    refresh.refresh_months(changed, store, refresh.months_of_changed(star.products, renamed, store))
    for name, rollup in rollups.ROLLUPS.items():
        assert rows(store.read(name)) == rows(rollup(changed)), name


def test_a_rollup_that_fails_stays_as_it_was(spark, star, folder, monkeypatch):
    store = TableStore(spark, f"{folder}/store")
    refresh.refresh_months(early(star), store, ())
    shown = store.path("mv_weekly_sales_trends")

    def broken(_):
        raise RuntimeError("no space")

    monkeypatch.setitem(rollups.ROLLUPS, "mv_weekly_sales_trends", broken)
    with pytest.raises(refresh.RefreshFailed) as failed:
        refresh.refresh_months(star, store, {202402, 202501})
    assert [name for name, ok, _ in failed.value.status if not ok] == ["mv_weekly_sales_trends"]
    assert store.path("mv_weekly_sales_trends") == shown
    day = store.read("mv_daily_sales_summary").where(F.col("date") == dt.date(2024, 2, 29))
    assert day.count() == 1
