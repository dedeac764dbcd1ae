"""Loading the fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import asc, date_key, month_of_key, not_blank
from tallyhouse.operators.aggregate import first_wins_if_repeated
from tallyhouse.operators.validate import satisfies_constraints
from tallyhouse.schemas import FACT_KEY, Star


#: What FACT_KEY is in the records.
NATURAL_KEY = ("transaction_id", "product_id", "retailer_id")
#: The columns of the records that facts are made of, and their load order.
_NEEDED = (
    *NATURAL_KEY, "quantity", "unit_price", "total_amount", "transaction_date", "customer_id", "store_id", "load_seq",
)


def resolve_keys(records: DataFrame, star: Star) -> DataFrame:
    """Replace natural keys by surrogate keys.

    Product and retailer must exist; customer and store may be unknown. The date key is computed
    from the date itself. The dimension sides are broadcast only while Spark finds them small
    enough; beyond that these are shuffle joins whose hot keys AQE splits. The smaller dimensions come
    first, so that what moves carries their keys and not their texts. Rows without a customer
    or store get a key of their own there, which matches nothing, so they don't meet in one task.
    """
    products = star.products.select(
        F.col("product_sku").alias("sku"), F.col("product_id").alias("product_key")
    )
    retailers = star.retailers.select("retailer_code", F.col("retailer_id").alias("retailer_key"))
    customers = star.customers.select(
        "customer_external_id", F.col("customer_id").alias("customer_key")
    )
    stores = star.stores.select("store_external_id", F.col("store_id").alias("store_key"))
    r = records
    return (
        r.withColumn("date_id", date_key(F.to_date("transaction_date")))
        .join(retailers, r["retailer_id"] == retailers["retailer_code"])
        .join(stores, _spread(r["store_id"], r) == F.col("store_external_id"), "left")
        .join(products, r["product_id"] == products["sku"])
        .join(customers, _spread(r["customer_id"], r) == F.col("customer_external_id"), "left")
        .select(
            "date_id",
            F.col("product_key").alias("product_id"),
            F.col("customer_key").alias("customer_id"),
            F.col("store_key").alias("store_id"),
            F.col("retailer_key").alias("retailer_id"),
            "transaction_id",
            "quantity",
            "unit_price",
            "total_amount",
        )
    )


def _spread(natural: Column, records: DataFrame) -> Column:
    """The natural key, or a text that no key is, different from transaction to transaction."""
    return F.coalesce(not_blank(natural), F.concat(F.lit("\0"), records["transaction_id"]), F.lit("\0"))


def not_yet_loaded(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """The batch rows whose key is not in the fact table.

    The repeated keys are found first with the batch as the build side: while a day's keys are
    small the fact table is scanned for its three key columns and not shuffled.
    """
    key = list(FACT_KEY)
    repeated = existing.select(*key).join(batch.select(*key), key, "left_semi")
    return batch.join(repeated, key, "left_anti")


def new_facts(
    records: DataFrame, star: Star, existing: DataFrame | None, load_ts: Column
) -> DataFrame:
    """Rows to append: valid records, first in load order per key, not loaded before.

    The first is found by the natural keys, which stand for the surrogate keys one to one: repeated
    records and their load order, the widest column, don't reach the joins with the dimensions. Keys seldom
    repeat, so only records that share theirs move for it; ``records`` must be a written table.
    """
    retailers = star.retailers.select(F.col("retailer_code").alias("retailer_id"))
    known = records.where(satisfies_constraints()).join(retailers, "retailer_id", "left_semi")
    first = first_wins_if_repeated(known.select(*_NEEDED), NATURAL_KEY, ["load_seq"])
    batch = resolve_keys(first.drop("load_seq"), star)
    if existing is not None:
        batch = not_yet_loaded(batch, existing)
    return batch.withColumn("created_at", load_ts).withColumn(
        "month_id", month_of_key(F.col("date_id"))
    )


def laid_out(facts: DataFrame) -> DataFrame:
    """Facts arranged for writing: by month, split evenly, in date order within a file.

    The rebalance gives each month as many files as its size asks for, so a month with a third of
    all rows is written by many tasks; date order lets file statistics skip other days.
    """
    return facts.hint("rebalance", "month_id").sortWithinPartitions("month_id", "date_id")


def load_counters(records: DataFrame, star: Star, inserted: int) -> DataFrame:
    """Records inserted and skipped, the latter split by reason. ``records`` carry their status."""
    known = star.retailers.select(
        F.col("retailer_code").alias("retailer_id"), F.lit(True).alias("known")
    )
    reason = (
        F.when(F.col("status") != "valid", F.col("status"))
        .when(F.col("known").isNull(), "unknown_retailer")
        .when(~satisfies_constraints(), "constraint")
        .otherwise("loadable")
    )
    counted = (
        records.join(known, "retailer_id", "left")
        .groupBy(reason.alias("outcome"))
        .agg(F.count("*").alias("records"))
    )
    inserted_count = F.lit(inserted).cast("bigint")
    outcome = F.col("outcome")
    split = F.when(
        outcome == "loadable",
        F.array(
            F.struct(F.lit("inserted").alias("outcome"), inserted_count.alias("records")),
            F.struct(
                F.lit("duplicate").alias("outcome"),
                (F.col("records") - inserted_count).alias("records"),
            ),
        ),
    ).otherwise(F.array(F.struct("outcome", "records")))
    return counted.select(F.explode(split).alias("c")).select("c.*").where("records > 0")


def first_errors(errors: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` error texts in load order."""
    return errors.orderBy(asc("load_seq")).limit(n).select("error")
