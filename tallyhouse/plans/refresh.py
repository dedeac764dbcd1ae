"""Refreshing the rollups and looking at them."""

from __future__ import annotations

from collections.abc import Collection, Iterable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.members import Members, daily_members, monthly_members
from tallyhouse.operators.rollups import ROLLUPS, product_months, top_products_of_months
from tallyhouse.plans.store import TableStore
from tallyhouse.schemas import Star

# The rollup that grows with days and products is kept by month, so that reports on recent days
# read only those; the others are small.
BY_MONTH = ("mv_daily_sales_by_product",)
# Rollups of months and of quarters: a month that is touched changes no row of another period.
MONTHLY = ("mv_daily_sales_summary", "mv_monthly_sales_by_category")
QUARTERLY = ("mv_weekly_sales_trends", "mv_quarterly_sales_summary")
# What each month adds to the rollup over all time, kept by month.
PRODUCT_MONTHS, ALL_TIME = "part_product_months", "mv_top_products_by_revenue"
# Bitmaps of what was sold on each day, and in each month, kept by month.
DAILY_MEMBERS, MONTHLY_MEMBERS = "daily_members", "monthly_members"
STATUS = "view_name string, successful boolean, error string"


class RefreshFailed(Exception):
    """Some rollups could not be refreshed; ``status`` has a row per rollup."""

    def __init__(self, status: list[tuple[str, bool, str | None]]):
        failed = [f"{name}: {error}" for name, ok, error in status if not ok]
        super().__init__(
            f"Failed to refresh {len(failed)} out of {len(status)} rollups: " + "; ".join(failed)
        )
        self.status = status


def write_rollup(star: Star, store: TableStore, name: str) -> DataFrame:
    """Compute a rollup and write it as a new version."""
    rollup = ROLLUPS[name](star)
    if name not in BY_MONTH:
        return store.write(name, rollup)
    months = ["year", "month"]
    return store.write(name, rollup.hint("rebalance", *months), months)


def refresh_one(star: Star, store: TableStore, name: str) -> DataFrame:
    """Recompute one rollup into a new version and return it."""
    if name not in ROLLUPS:
        raise ValueError(f"Unknown rollup: {name}")
    view = write_rollup(star, store, name)
    store.drop_old(name)
    return view


def refresh_all(star: Star, store: TableStore) -> DataFrame:
    """Refresh every rollup and return one status row each.

    A rollup that fails keeps its previous version and does not stop the others; the run fails at
    the end if any did.
    """
    status: list[tuple[str, bool, str | None]] = []
    for name in ROLLUPS:
        try:
            refresh_one(star, store, name)
            status.append((name, True, None))
        except Exception as error:  # any failure is reported, and raised below
            status.append((name, False, str(error).splitlines()[0]))
    if not all(ok for _, ok, _ in status):
        raise RefreshFailed(status)
    return store.spark.createDataFrame(status, STATUS)


def _facts_of(star: Star, months: Collection[int]) -> Star:
    return replace(star, fact=star.fact.where(F.col("month_id").isin(sorted(months))))


def _quarter(month: int) -> tuple[int, int]:
    return month // 100, (month % 100 + 2) // 3


def _fold(star: Star, store: TableStore, name: str, months: Collection[int]) -> None:
    """Rows of the touched periods computed anew, beside the others as they are.

    These rollups have a row for each day, week or category and retailer, so they are written whole.
    """
    if name in MONTHLY:
        codes, code = set(months), F.col("year") * 100 + F.col("month")
    else:
        quarters = {_quarter(x) for x in months}
        codes, code = {y * 10 + q for y, q in quarters}, F.col("year") * 10 + F.col("quarter")
        months = {y * 100 + 3 * q - i for y, q in quarters for i in range(3)}
    kept = store.read(name).where(~code.isin(sorted(codes)))
    store.write(name, kept.unionByName(ROLLUPS[name](_facts_of(star, months))).hint("rebalance"))


def _swap_by_month(star: Star, store: TableStore, name: str, months: Collection[int]) -> None:
    """The touched months' partitions computed anew; no other file is read or written."""
    by = ["year", "month"]
    rows = ROLLUPS[name](_facts_of(star, months)).hint("rebalance", *by)
    store.replace_parts(name, rows, by, [divmod(x, 100) for x in months])


def _merge_months(star: Star, store: TableStore, name: str, months: Collection[int]) -> None:
    """The touched months' parts computed anew, and all months' parts merged."""
    if store.exists(PRODUCT_MONTHS):
        rows = product_months(_facts_of(star, months)).hint("rebalance", "month_id")
        store.replace_parts(PRODUCT_MONTHS, rows, ["month_id"], [(x,) for x in months])
    else:
        store.write(PRODUCT_MONTHS, product_months(star).hint("rebalance", "month_id"), ["month_id"])
    store.write(name, top_products_of_months(store.read(PRODUCT_MONTHS), star))
    store.drop_old(PRODUCT_MONTHS)


def write_members(star: Star, store: TableStore, months: Collection[int] = ()) -> Members:
    """The bitmaps of the touched months anew; of all months if there are none yet."""
    by = ["month_id"]
    if not store.exists(MONTHLY_MEMBERS):
        daily = store.write(DAILY_MEMBERS, daily_members(star).hint("rebalance", *by), by)
        return Members(daily, store.write(MONTHLY_MEMBERS, monthly_members(daily).hint("rebalance", *by), by))
    gone, touched = [(x,) for x in months], F.col("month_id").isin(sorted(months))
    daily = store.replace_parts(DAILY_MEMBERS, daily_members(_facts_of(star, months)).hint("rebalance", *by), by, gone)
    rows = monthly_members(daily.where(touched)).hint("rebalance", *by)
    monthly = store.replace_parts(MONTHLY_MEMBERS, rows, by, gone)
    for name in (DAILY_MEMBERS, MONTHLY_MEMBERS):
        store.drop_old(name)
    return Members(daily, monthly)


def read_members(store: TableStore) -> Members:
    return Members(store.read(DAILY_MEMBERS), store.read(MONTHLY_MEMBERS))


def refresh_months(star: Star, store: TableStore, months: Collection[int]) -> DataFrame:
    """Bring every rollup up to date when only facts of ``months`` (yyyymm) changed; a status row each.

    Facts of these months are read, and of their quarters for the rollups by week and quarter. A
    rollup that isn't there yet is computed whole, and one that fails keeps its previous version, as
    in :func:`refresh_all`. Bitmaps of daily keys follow, if the store has them. Without a month
    nothing is done.
    """
    status: list[tuple[str, bool, str | None]] = []
    if months and store.exists(MONTHLY_MEMBERS):
        write_members(star, store, months)
    for name in ROLLUPS:
        try:
            if not store.exists(name):
                write_rollup(star, store, name)
            if name == ALL_TIME and (months or not store.exists(PRODUCT_MONTHS)):
                _merge_months(star, store, name, months)
            elif months:
                (_swap_by_month if name in BY_MONTH else _fold)(star, store, name, months)
            store.drop_old(name)
            status.append((name, True, None))
        except Exception as error:  # any failure is reported, and raised below
            status.append((name, False, str(error).splitlines()[0]))
    if not all(ok for _, ok, _ in status):
        raise RefreshFailed(status)
    return store.spark.createDataFrame(status, STATUS)


def months_of_changed(before: DataFrame | None, after: DataFrame, store: TableStore) -> set[int]:
    """The months that have sales of products whose name or category changed: rollups show both."""
    if before is None or not store.exists(PRODUCT_MONTHS):
        return set()
    labels = ("product_name", "category")
    old = before.select("product_id", *(F.col(c).alias(f"old_{c}") for c in labels))
    same = F.lit(True)
    for c in labels:
        same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    changed = after.join(old, "product_id").where(~same).select("product_id")
    sold = store.read(PRODUCT_MONTHS).join(changed, "product_id", "left_semi")
    return {x.month_id for x in sold.select("month_id").distinct().collect()}  # as many as months


def refresh_together(star: Star, store: TableStore) -> DataFrame:
    """Refresh every rollup or none: all are computed first, and shown when all are there.

    If one fails, the others are thrown away, and each is refreshed by itself as
    :func:`refresh_all` does.
    """
    with store.pending() as shown_later:
        try:
            for name in ROLLUPS:
                write_rollup(star, shown_later, name)
        except Exception:  # any failure sends all to the other way
            shown_later.discard()
            return refresh_all(star, store)
        shown_later.publish()
    for name in ROLLUPS:
        store.drop_old(name)
    return store.spark.createDataFrame([(name, True, None) for name in ROLLUPS], STATUS)


def refresh_status(store: TableStore) -> DataFrame:
    """Per rollup whether it is there, with the rows and the revenue that its table holds."""
    rows = []
    for name in ROLLUPS:
        view = store.read(name)
        rows.append(
            view.agg(
                F.count("*").alias("row_count"), F.sum("total_revenue").alias("total_revenue")
            ).select(
                F.lit(name).alias("view_name"), F.lit(True).alias("successful"), "row_count", "total_revenue"
            )
        )
    return _union(rows)


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    out, *rest = frames
    for frame in rest:
        out = out.unionByName(frame)
    return out


def view_info(store: TableStore) -> DataFrame:
    """Per rollup: does it exist, and how many rows has it."""
    rows = []
    for name in ROLLUPS:
        view = store.read_if_exists(name)
        if view is None:
            view = store.spark.createDataFrame([], "none int")
        rows.append(
            view.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("view_name"),
                F.lit(store.exists(name)).alias("exists"),
                "row_count",
            )
        )
    return _union(rows)


def view_row_counts(store: TableStore) -> DataFrame:
    """Rows per existing rollup."""
    return view_info(store).where("exists").select("view_name", "row_count")


def verify_views(store: TableStore) -> DataFrame:
    """Per rollup: exists, has rows, can be queried, its columns and the issues found."""
    rows = []
    for name in ROLLUPS:
        view = store.read_if_exists(name)
        exists = view is not None
        columns = view.columns if exists else []
        if not exists:
            view = store.spark.createDataFrame([], "none int")
        sample = view.limit(1).agg(F.count("*") > 0).scalar()
        rows.append(
            view.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("view_name"),
                F.lit(exists).alias("exists"),
                "row_count",
                (F.col("row_count") > 0).alias("has_data"),
                sample.alias("queryable"),
                F.lit(", ".join(columns)).alias("columns"),
            )
        )
    issue = (
        F.when(~F.col("exists"), "View does not exist")
        .when(~F.col("has_data"), "No data (0 rows)")
        .when(~F.col("queryable"), "Cannot query view")
    )
    return _union(rows).withColumn("issue", issue)
