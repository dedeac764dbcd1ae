"""Dimension upserts: set-based versions of get-or-create.

Input records are those that pass the gate and have a readable date, not only those that become
facts: a record refused later has already left its date, product, customer and store behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.columns import date_key, not_blank
from tallyhouse.schemas import RETAILERS
from tallyhouse.session import dropping_shuffles


def date_attributes(dates: DataFrame) -> DataFrame:
    """The date dimension's columns for a frame of distinct ``date`` values.

    The year is the calendar year while the week is the ISO week; days count from Monday = 1.
    """
    date = F.col("date")
    weekday = F.weekday(date) + 1
    return dates.select(
        date_key(date).alias("date_id"),
        "date",
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        F.month(date).alias("month"),
        F.weekofyear(date).alias("week"),
        F.dayofmonth(date).alias("day"),
        weekday.alias("day_of_week"),
        F.date_format(date, "EEEE").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
    )


def new_dates(records: DataFrame, existing: DataFrame | None, load_ts: Column) -> DataFrame:
    """Date rows that the records need and ``existing`` does not have."""
    dates = records.select(F.to_date("transaction_date").alias("date")).distinct()
    if existing is not None:
        dates = dates.join(existing.select("date"), "date", "left_anti")
    return date_attributes(dates).withColumn("created_at", load_ts)


def assign_ids(new: DataFrame, id_column: str, existing: DataFrame | None) -> DataFrame:
    """Surrogate keys above the largest one in use, unique but with gaps.

    Every partition numbers its own rows, so no task sees them all. The numbers depend on the run:
    write the result before anything refers to it.
    """
    number = F.monotonically_increasing_id() + 1
    if existing is not None:
        number = number + largest_id(existing, id_column)
    return new.select(number.alias(id_column), *new.columns)


#: So many SKUs are sent to all tasks at most.
MOST_UNCLEAR = 200_000
#: The product table is kept in so many parts by the hash of the SKU. A load rewrites the parts of its SKUs alone.
PRODUCT_BUCKETS = 64


def in_buckets(products: DataFrame) -> DataFrame:
    """Products with the ``bucket`` their SKU belongs to."""
    return products.withColumn("bucket", F.pmod(F.xxhash64("product_sku"), F.lit(PRODUCT_BUCKETS)).cast("int"))


def latest_products(records: DataFrame, written: bool = False) -> DataFrame:
    """Name, category and bucket of each SKU in the records: those of the last one in load order.

    Of a ``written`` table not all records are sorted for that, see :func:`_last_of_table`.
    """
    named = records.where("product_id is not null and product_name is not null").select(
        F.col("product_id").alias("product_sku"), "product_name", "category", "load_seq"
    )
    return in_buckets(_last_of_table(named) if written else _last(named))


def _last(named: DataFrame) -> DataFrame:
    last = F.max_by(F.struct("product_name", "category"), "load_seq").alias("last")
    return named.groupBy("product_sku").agg(last).select("product_sku", "last.product_name", "last.category")


def _last_of_table(named: DataFrame) -> DataFrame:
    """The same with few sorted records: :func:`_last` sorts them all, with their load order, in the map tasks.

    The first field of the load order, such as the day, tells which of a SKU's names and categories is the
    last, unless two of them share the newest value; only records of such SKUs, which are sent to all tasks,
    are compared by the whole order. With more than MOST_UNCLEAR of them all records are. That is asked at
    once, so ``named`` is read three times.
    """
    spark, order = named.sparkSession, named.schema["load_seq"].dataType
    first = F.col("load_seq")[order.names[0]] if isinstance(order, T.StructType) else F.col("load_seq")
    variants = named.groupBy("product_sku", "product_name", "category").agg(F.max(first).alias("newest"))
    of_sku = Window.partitionBy("product_sku")
    newest = variants.withColumn("rank", F.rank().over(of_sku.orderBy(F.desc_nulls_last("newest")))).where("rank = 1")
    newest = newest.withColumn("alike", F.count("*").over(of_sku))
    with dropping_shuffles(spark):
        unclear = newest.where("alike > 1").select("product_sku").distinct().limit(MOST_UNCLEAR + 1).collect()
    if len(unclear) > MOST_UNCLEAR:
        return _last(named)
    clear = newest.where("alike = 1").select("product_sku", "product_name", "category")
    if not unclear:
        return clear
    some = F.broadcast(spark.createDataFrame(unclear, "product_sku string"))
    return clear.unionByName(_last(named.join(some, "product_sku", "left_semi")))


def merge_products(latest: DataFrame, existing: DataFrame | None, used: Column, load_ts: Column) -> DataFrame:
    """``existing`` products (with their bucket) after ``latest``; new ones get keys above ``used``.

    A product seen again also gets a new updated_at, even within the batch that created it. Rows are
    laid out by bucket first and numbered then, so that nothing moves after a key is given.
    """
    number = F.monotonically_increasing_id() + 1 + used
    if existing is None:
        created = latest.hint("rebalance", "bucket").select(number.alias("product_id"), *latest.columns)
        return created.withColumn("created_at", load_ts).withColumn("updated_at", load_ts)
    seen = latest.select(
        "bucket",
        "product_sku",
        F.col("product_name").alias("new_name"),
        F.col("category").alias("new_category"),
        F.lit(True).alias("seen"),
    )
    merged = existing.join(seen, ["bucket", "product_sku"], "full_outer").hint("rebalance", "bucket")
    return merged.select(
        F.coalesce("product_id", number).alias("product_id"),
        "product_sku",
        F.when(F.col("seen"), F.col("new_name")).otherwise(F.col("product_name")).alias(
            "product_name"
        ),
        F.when(F.col("seen"), F.col("new_category")).otherwise(F.col("category")).alias("category"),
        "bucket",
        F.coalesce("created_at", load_ts).alias("created_at"),
        F.when(F.col("seen"), load_ts).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def largest_id(existing: DataFrame | None, id_column: str) -> Column:
    """The largest surrogate key in use, 0 without any."""
    if existing is None:
        return F.lit(0).cast("bigint")
    return existing.agg(F.coalesce(F.max(id_column), F.lit(0).cast("bigint"))).scalar()


def upsert_products(
    records: DataFrame, existing: DataFrame | None, load_ts: Column, written: bool = False
) -> DataFrame:
    """The whole product dimension after the records, which may be a ``written`` table.

    The SKU is the key over all retailers. The latest record in load order sets name and category.
    """
    known, latest = None if existing is None else in_buckets(existing), latest_products(records, written)
    return merge_products(latest, known, largest_id(existing, "product_id"), load_ts).drop("bucket")


def _new_members(
    records: DataFrame, existing: DataFrame | None, source: str, name: str, load_ts: Column
) -> DataFrame:
    external = f"{name}_external_id"
    ids = (
        records.select(not_blank(F.col(source)).alias(external))
        .where(F.col(external).isNotNull())
        .distinct()
    )
    if existing is not None:
        ids = ids.join(existing.select(external), external, "left_anti")
    created = assign_ids(ids, f"{name}_id", existing)
    return created.withColumn("created_at", load_ts).withColumn("updated_at", load_ts)


def new_customers(records: DataFrame, existing: DataFrame | None, load_ts: Column) -> DataFrame:
    """Customers not seen before; a null or empty id is no customer."""
    return _new_members(records, existing, "customer_id", "customer", load_ts)


def new_stores(records: DataFrame, existing: DataFrame | None, load_ts: Column) -> DataFrame:
    """Stores not seen before; a null or empty id is no store."""
    return _new_members(records, existing, "store_id", "store", load_ts)


def seed_retailers(spark: SparkSession, existing: DataFrame | None = None) -> DataFrame:
    """The seeded retailers, added to those already there unless their code exists."""
    names = ("retailer_id", "retailer_code", "retailer_name")
    rows = [
        F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row)])
        for row in RETAILERS
    ]
    seed = spark.range(1).select(F.inline(F.array(*rows)))
    if existing is None:
        return seed
    missing = seed.join(existing.select("retailer_code"), "retailer_code", "left_anti")
    return existing.select(*seed.columns).unionByName(missing.select(*seed.columns))
