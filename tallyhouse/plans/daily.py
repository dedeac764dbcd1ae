"""The daily run: land, load, check, refresh."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import dims, facts, quality, validate
from tallyhouse.operators.analytics import Day
from tallyhouse.operators.normalize import (
    accepted,
    normalize_maps,
    normalize_table,
    serializable,
)
from tallyhouse.plans.refresh import PRODUCT_MONTHS, months_of_changed, refresh_all, refresh_months
from tallyhouse.plans.store import TableStore
from tallyhouse.schemas import FEED_BY_CODE, Star
from tallyhouse.sources import feeds, landing

EMPTY_FACT = (
    "date_id int, product_id bigint, customer_id bigint, store_id bigint, retailer_id int, "
    "transaction_id string, quantity int, unit_price decimal(10,2), total_amount decimal(10,2), "
    "created_at timestamp_ntz, month_id int"
)


def read_star(store: TableStore) -> Star:
    """The star schema as loaded so far."""
    fact = store.read_if_exists("fact_sales")
    if fact is None:
        fact = store.spark.createDataFrame([], EMPTY_FACT)
    names = ("dates", "products", "customers", "stores", "retailers")
    return Star(fact=fact, **{name: store.read(f"dim_{name}").drop("bucket") for name in names})


def land_feeds(
    tables: Mapping[str, DataFrame], root: str, day: Day, now: Column | None = None
) -> dict[str, str]:
    """Normalise each feed's records of a day and land them; returns the feeds that failed.

    ``tables`` holds, per retailer code, a typed source table or, with a ``record`` column, the
    feed's untyped maps of that day. A feed that fails does not stop the others.
    """
    failed: dict[str, str] = {}
    folders = landing.partition_columns(F.lit(str(day)).cast("date"))
    for code, table in tables.items():
        feed = FEED_BY_CODE[code]
        try:
            if "record" in table.columns:
                moment = F.current_timestamp() if now is None else now
                records = accepted(normalize_maps(table, feed, moment), "record")
            else:
                rows = feeds.with_defaults(feeds.scan_feed(table, feed, day, day), feed)
                pairs = [
                    part
                    for name in feed.columns
                    for part in (F.lit(name), F.col(name).cast("string"))
                ]
                rows = rows.withColumn("record", F.create_map(*pairs))
                records = normalize_table(rows, feed, "record")
            landed = serializable(records, raw=F.col("record"))
            order = ("transaction_date", "transaction_id", "product_id", "quantity", "total_amount")
            landing.land(landed.withColumns({"retailer": F.lit(code), **folders}), root, order=order)
        except Exception as error:  # reported to the caller; the other feeds still land
            failed[code] = str(error).splitlines()[0]
    return failed


@dataclass(frozen=True)
class LoadResult:
    """What a load did: the star schema after it, the records with their status, the counters.

    ``rejected_files`` (file, retailer, file_date, reason) are those that gave no record at all;
    ``touched_months`` (yyyymm) those with new facts, or with sales of products that changed.
    """

    star: Star
    records: DataFrame
    counters: DataFrame
    rejected_files: DataFrame | None = None
    touched_months: frozenset[int] = frozenset()


@dataclass(frozen=True)
class DailyResult:
    """A daily run: feeds that failed and why, what was loaded, the status of the refresh."""

    failed_feeds: dict[str, str]
    load: LoadResult
    refreshed: DataFrame


def load_records(
    store: TableStore, records: DataFrame, load_ts: Column, whole_folders: bool = True
) -> LoadResult:
    """Load typed records (with ``status`` and ``load_seq``) into the star schema.

    Records are kept as a table first, so that the dimensions and the facts read the same rows and
    only the columns they need. Dimensions are written before facts refer to their keys. Accepted
    records of landing files also go to the processed zone: with ``whole_folders`` they are all there
    is of their retailers and days and stand for what was there, else files not there yet are added.
    """
    records = store.write("staged", records)
    valid = records.where("status = 'valid'")
    if "file_date" in records.columns:
        _keep_processed(store, records, valid, whole_folders)
    # A record without SKU or product name fails at its product, after its date was created.
    named = valid.where("product_id is not null and product_name is not null")

    def existing(name: str) -> DataFrame | None:
        return store.read_if_exists(f"dim_{name}")

    def add(name: str, new: DataFrame) -> None:
        store.append(f"dim_{name}", new)

    add("dates", dims.new_dates(valid, existing("dates"), load_ts))
    known, products = upsert_products(store, named, load_ts)
    add("customers", dims.new_customers(named, existing("customers"), load_ts))
    add("stores", dims.new_stores(named, existing("stores"), load_ts))
    if existing("retailers") is None:
        store.write("dim_retailers", dims.seed_retailers(store.spark))
    star = read_star(store)
    before = store.read_if_exists("fact_sales")
    new = facts.laid_out(facts.new_facts(valid, star, before, load_ts))
    seen = Observation()  # counts the rows while they are written
    counted = [F.count("*").alias("inserted"), F.collect_set("month_id").alias("months")]
    store.append("fact_sales", new.observe(seen, *counted), ["month_id"])
    touched = {*(seen.get.get("months") or []), *months_of_changed(known, products, store)}
    for table in ("staged", "staged_products", "dim_products"):
        store.drop_old(table)
    return LoadResult(
        star=read_star(store),
        records=records,
        counters=facts.load_counters(records, star, seen.get.get("inserted", 0)),
        touched_months=frozenset(touched),
    )


def upsert_products(store: TableStore, records: DataFrame, load_ts: Column) -> tuple[DataFrame | None, DataFrame]:
    """Bring the product table up to date: only the buckets with SKUs of the records are read and written.

    Returns the products of these buckets before (none in the first load) and after. The driver sees
    the numbers of the buckets. A table that isn't in buckets yet is rewritten once.
    """
    latest = store.write("staged_products", dims.latest_products(records, written=True))
    touched = sorted(x["bucket"] for x in latest.select("bucket").distinct().collect())
    before = store.read_if_exists("dim_products")
    if before is not None and "bucket" not in before.columns:
        before = store.write("dim_products", dims.in_buckets(before).hint("rebalance", "bucket"), ["bucket"])
    used = dims.largest_id(before, "product_id")
    known = None if before is None else before.where(F.col("bucket").isin(touched))
    if before is None or touched:
        merged = dims.merge_products(latest, known, used, load_ts)
        before = store.replace_parts("dim_products", merged, ["bucket"], [(x,) for x in touched])
    return known, before.where(F.col("bucket").isin(touched))


def _keep_processed(store: TableStore, records: DataFrame, accepted: DataFrame, whole_folders: bool) -> None:
    """Accepted records into the processed zone, by retailer and day, each file's once.

    A folder that is loaded again, landed anew or not, is replaced, also by nothing. The driver sees
    the folders' names, as it does in listing them.
    """
    folders = ["retailer", "file_date"]
    if whole_folders:
        covered = [tuple(x) for x in records.select(*folders).distinct().collect()]
        if store.exists("processed") and not covered:
            return
        store.replace_parts("processed", accepted.hint("rebalance", *folders), folders, covered)
    else:
        before = store.read_if_exists("processed")
        if before is not None:
            files = before.select(*folders, "file").distinct()
            accepted = accepted.join(files, [*folders, "file"], "left_anti")
        store.add_parts("processed", accepted.hint("rebalance", *folders), folders)
    store.drop_old("processed")


def load_day(
    spark: SparkSession,
    store: TableStore,
    root: str,
    day: Day | None,
    load_ts: Column,
    without: Collection[str] = (),
) -> LoadResult:
    """Load the landing files of a day, or of all days, of line and of array files alike.

    The retailers in ``without`` are left out: what lies in their folders is of an earlier run. A
    day without any record loads nothing.
    """
    files = landing.scan_files(spark, root, day).where(~F.col("retailer").isin(list(without)))
    parsed, rejected = landing.parse_files(spark, files)
    typed = validate.typed_records(parsed, "retailer", "file_date", "file", "load_seq")
    return replace(load_records(store, typed, load_ts), rejected_files=rejected)


def run_daily(
    spark: SparkSession,
    store: TableStore,
    root: str,
    tables: Mapping[str, DataFrame],
    day: Day,
    as_of: Day,
    load_ts: Column | None = None,
) -> DailyResult:
    """One day from source tables to refreshed rollups.

    A feed that fails is named in the result, and nothing of its folder is loaded. Raises
    :class:`quality.QualityCheckFailed` before the refresh if a check fails.
    """
    stamp = F.current_timestamp().cast("timestamp_ntz") if load_ts is None else load_ts
    failed = land_feeds(tables, root, day)
    loaded = load_day(spark, store, root, day, stamp, without=failed)
    quality.require_passed(quality.run_all_checks(loaded.star, day, day, as_of))
    if store.exists(PRODUCT_MONTHS):
        return DailyResult(failed, loaded, refresh_months(loaded.star, store, loaded.touched_months))
    refreshed = refresh_all(loaded.star, store)
    refresh_months(loaded.star, store, ())  # the parts by month, for the next run
    return DailyResult(failed, loaded, refreshed)
