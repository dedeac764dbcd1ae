"""The gate between landed records and the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import MONEY
from tallyhouse.operators.normalize import iso_timestamp
from tallyhouse.schemas import REQUIRED_FIELDS


def missing_fields(record: Column) -> Column:
    """The required keys a record map does not have; a key with a null value is present."""
    return F.array_except(F.array(*[F.lit(name) for name in REQUIRED_FIELDS]), F.map_keys(record))


def has_required_fields(record: Column) -> Column:
    return F.size(missing_fields(record)) == 0


def missing_field_errors(parsed: DataFrame) -> DataFrame:
    """One error text per record that lacks a required key, with its position in the file."""
    missing = missing_fields(F.col("record"))
    listing = F.concat(F.lit("['"), F.array_join("missing", "', '"), F.lit("']"))
    return (
        parsed.withColumn("missing", missing)
        .where(F.size("missing") > 0)
        .withColumn(
            "error",
            F.concat(
                F.lit("Record "), F.col("position"), F.lit(": Missing required fields: "), listing
            ),
        )
        .drop("missing")
    )


def record_errors(parsed: DataFrame, retailers: DataFrame) -> DataFrame:
    """One error text for each record that cannot become a fact, with the reason.

    ``parsed`` has ``record``, ``position`` and ``load_seq``. A record counts under the first
    reason that holds, in the order in which the load finds them.
    """
    known = retailers.select(F.col("retailer_code").alias("retailer_id"), F.lit(True).alias("known"))
    typed = typed_records(parsed, "position", "load_seq", missing_fields(F.col("record")).alias("missing"))
    nulls = F.array_compact(F.array(*[F.when(F.col(name).isNull(), name) for name in NEEDED]))
    listing = F.concat(F.lit("['"), F.array_join("missing", "', '"), F.lit("']"))
    status = F.col("status")
    reason = (
        F.when(status == "unreadable", "Not a JSON object")
        .when(status == "missing_fields", F.concat(F.lit("Missing required fields: "), listing))
        .when(status == "bad_date", "Unreadable transaction_date")
        .when(F.col("known").isNull(), F.concat(F.lit("Unknown retailer "), F.coalesce("retailer_id", F.lit("null"))))
        .when(~satisfies_constraints(), F.concat(F.lit("No value for "), F.array_join(nulls, ", ")))
    )
    judged = typed.join(known, "retailer_id", "left").withColumn("reason", reason)
    error = F.concat(F.lit("Record "), F.col("position"), F.lit(": "), F.col("reason"))
    return judged.where("reason is not null").select("product_id", "load_seq", error.alias("error"))


def typed_records(parsed: DataFrame, *extra: str | Column) -> DataFrame:
    """Landed record maps as typed columns; what does not convert becomes null.

    A missing category is the empty text, a null category stays null; a quantity may be written as
    a whole decimal number. ``status`` says what keeps a record out so far: it is not a JSON object
    (a null record), a required key is missing, or the date is not ISO.
    """
    record = F.col("record")
    category = F.when(F.map_contains_key(record, "category"), record["category"]).otherwise("")
    money = lambda key: record[key].try_cast(MONEY)
    typed = parsed.select(
        *extra,
        record["retailer_id"].alias("retailer_id"),
        record["transaction_id"].alias("transaction_id"),
        record["product_id"].alias("product_id"),
        record["product_name"].alias("product_name"),
        category.alias("category"),
        whole_number(record["quantity"]).alias("quantity"),
        money("unit_price").alias("unit_price"),
        money("total_amount").alias("total_amount"),
        iso_timestamp(record["transaction_date"]).alias("transaction_date"),
        record["customer_id"].alias("customer_id"),
        record["store_id"].alias("store_id"),
        record.isNull().alias("unreadable"),
        has_required_fields(record).alias("complete"),
    )
    status = (
        F.when(F.col("unreadable"), "unreadable")
        .when(~F.col("complete"), "missing_fields")
        .when(F.col("transaction_date").isNull(), "bad_date")
        .otherwise("valid")
    )
    return typed.withColumn("status", status).drop("unreadable", "complete")


def whole_number(text: Column) -> Column:
    """``2`` and ``2.0`` are 2, any other text is null."""
    number = text.try_cast("decimal(38,10)")
    return F.when(number == F.floor(number), number.try_cast("int"))


def unknown_retailers(records: DataFrame, retailers: DataFrame) -> DataFrame:
    """Records whose retailer code is not in the retailer dimension."""
    known = retailers.select(F.col("retailer_code").alias("retailer_id"))
    return records.join(known, "retailer_id", "left_anti")


def constraint_violations(records: DataFrame) -> DataFrame:
    """Valid records the fact or product table would refuse because a needed value is null."""
    return records.where(~satisfies_constraints())


#: What a fact and its product need.
NEEDED = ("product_id", "product_name", "transaction_id", "quantity", "unit_price", "total_amount")


def satisfies_constraints() -> Column:
    ok = F.lit(True)
    for name in NEEDED:
        ok = ok & F.col(name).isNotNull()
    return ok
