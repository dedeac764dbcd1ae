"""The given order tables, seen as sales of three retailers.

Every order line is a sale: the order is the transaction, the part the product, the supplier the
store, and the supplier's number decides the retailer. One part type counts as 'no category', every
tenth customer and every twenty-fifth store as unknown, so nulls occur. Amounts are whole cents.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.columns import MONEY, date_key, month_of_key
from tallyhouse.operators.aggregate import first_wins, spread
from tallyhouse.operators.dims import date_attributes, seed_retailers
from tallyhouse.schemas import FEED_BY_CODE, Feed, Star

NO_CATEGORY = "PROMO"

LINE_ORDER = ("line_number", "store_number", "cents", "quantity")


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def span(spark: SparkSession, folder: str) -> tuple[str, str]:
    """The first and the last day with orders; the reports take the last one as today.

    Without any order both are the first day of 1970.
    """
    date = F.to_date("o_orderdate")
    days = read(spark, folder, "orders").agg(F.min(date).cast("string"), F.max(date).cast("string")).first()
    return days[0] or "1970-01-01", days[1] or "1970-01-01"


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    quantity = F.col("l_quantity").cast("int")
    return read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_number"),
        F.col("l_partkey").alias("part_number"),
        F.col("l_suppkey").alias("store_number"),
        F.col("l_linenumber").alias("line_number"),
        quantity.alias("quantity"),
        cents.alias("cents"),
    )


def priced(lines: DataFrame) -> DataFrame:
    """With the retailer and the unit price in cents, which follow from the line: no shuffle need carry them."""
    # Rounded half-up with integers only.
    unit_cents = F.expr("(2 * cents + quantity) div (2 * quantity)")
    retailer = (F.col("store_number") % 3 + 1).cast("int")
    return lines.withColumns({"retailer_number": retailer, "unit_cents": unit_cents})


def money(cents: str) -> Column:
    """Whole cents as an amount; a product of decimals, which is cheaper than their quotient."""
    return (F.col(cents).cast("decimal(12,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("o_custkey")
    return read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_number"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ordered_at"),
        F.when(number % 10 != 0, number).alias("customer_number"),
    )


def _category() -> Column:
    return F.when(F.col("p_type") != NO_CATEGORY, F.col("p_type"))


def _store(number: Column) -> Column:
    return F.when(number % 25 != 0, number)


def first_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The first line per (order, part, retailer) with its order, date and month: what facts are made of.

    Lines move once, by order: the window over all three keys and the join with orders need no
    other shuffle. A line without an order joins none.
    """
    lines = spread(_lines(spark, folder).where("order_number is not null"), "order_number")
    retailer = F.col("store_number") % 3
    first = first_wins(lines.withColumn("of", retailer), ["order_number", "part_number", "of"], LINE_ORDER)
    date = F.to_date("ordered_at")
    return (
        first.drop("of", "line_number")
        .join(_orders(spark, folder), "order_number")
        .withColumns({"ordered_on": date, "date_id": date_key(date)})
        .withColumn("month_id", month_of_key(F.col("date_id")))
        .drop("ordered_at")
    )


def as_facts(lines: DataFrame) -> DataFrame:
    """The facts of :func:`first_lines`, row by row. The given keys are integers already, so none is looked up.

    Each row counts as loaded by the nightly job, at two o'clock after its date.
    """
    midnight = F.date_trunc("day", F.col("ordered_on").cast("timestamp_ntz"))
    night = midnight + F.expr("interval '1 2' day to hour")
    return priced(lines).select(
        "date_id",
        F.col("part_number").alias("product_id"),
        F.col("customer_number").alias("customer_id"),
        _store(F.col("store_number")).alias("store_id"),
        F.col("retailer_number").alias("retailer_id"),
        F.col("order_number").cast("string").alias("transaction_id"),
        "quantity",
        money("unit_cents").alias("unit_price"),
        money("cents").alias("total_amount"),
        night.cast("timestamp_ntz").alias("created_at"),
        "month_id",
    )


def fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The fact table."""
    return as_facts(first_lines(spark, folder))


def dimensions(spark: SparkSession, folder: str, fact: DataFrame) -> Star:
    """The dimensions of the given tables, with the rows the facts refer to."""
    parts = read(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_partkey").cast("string").alias("product_sku"),
        F.col("p_name").alias("product_name"),
        _category().alias("category"),
    )
    day = F.to_date(F.col("date_id").cast("string"), "yyyyMMdd")

    def members(name: str) -> DataFrame:
        number = F.col(f"{name}_id")
        return fact.where(number.isNotNull()).select(number).distinct().withColumn(
            f"{name}_external_id", number.cast("string")
        )

    return Star(
        fact=fact,
        dates=date_attributes(fact.select("date_id").distinct().select(day.alias("date"))),
        products=parts.join(fact.select("product_id").distinct(), "product_id", "left_semi"),
        customers=members("customer"),
        stores=members("store"),
        retailers=seed_retailers(spark),
    )


def sales_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line with its order and part, duplicates included; not yet :func:`priced`.

    The join with orders keeps as many parts as there are shuffle partitions, so that what a task sorts is
    a share of the table, not all that AQE would pack into one part.
    """
    parts = read(spark, folder, "part").select(
        F.col("p_partkey").alias("part_number"),
        F.col("p_name").alias("product_name"),
        _category().alias("category"),
    )
    lines = spread(_lines(spark, folder).where("order_number is not null"), "order_number")
    return lines.join(_orders(spark, folder), "order_number").join(parts, "part_number")


def source_table(spark: SparkSession, folder: str, code: str) -> DataFrame:
    """One retailer's lines in the shape of its own source table.

    ``load_order`` carries the order of the lines along; the extra columns get values that make
    the defaults matter: zero and null where the source has nothing to say.
    """
    feed = FEED_BY_CODE[code]
    rows = priced(sales_lines(spark, folder)).where(F.col("retailer_number") == int(code[-1]))
    line = F.col("line_number")
    common = {
        "transaction_id": F.col("order_number").cast("string"),
        "product_id": F.col("part_number").cast("string"),
        "product_name": F.col("product_name"),
        "category": F.col("category"),
        "quantity": F.col("quantity"),
        "unit_price": money("unit_cents"),
        "total_amount": money("cents"),
        "transaction_date": F.col("ordered_at"),
        "customer_id": F.col("customer_number").cast("string"),
        "store_id": _store(F.col("store_number")).cast("string"),
    }
    extra = {
        "discount_percentage": F.when(line > 2, line.cast("decimal(5,2)")),
        "payment_method": F.when(line % 2 == 0, "Cash").otherwise("Credit Card"),
        "tax_amount": F.when(line != 3, line.cast(MONEY)),
        "loyalty_points_earned": F.when(line > 1, F.col("quantity")),
        "promotion_code": F.when(line == 7, "PROMO-10"),
        "sales_rep_id": F.concat(F.lit("REP-"), line),
        "shipping_cost": F.when(line < 5, line.cast(MONEY)),
        "warranty_months": F.when(line % 2 == 1, line * 6),
        "return_policy_days": F.when(line == 1, 0).when(line == 2, 60),
        "supplier_id": F.concat(F.lit("SUP-"), F.col("store_number")),
    }
    mapped = {feed.mapping[name]: column for name, column in common.items()}
    columns = [(mapped.get(name, extra.get(name))).alias(name) for name in feed.columns]
    return rows.select(*columns, F.struct(*LINE_ORDER).alias("load_order"))


def _map_without(values: dict[str, Column], *dropped: str) -> Column:
    kept = [(F.lit(name), value) for name, value in values.items() if name not in dropped]
    return F.create_map(*[part for pair in kept for part in pair])


def raw_records(spark: SparkSession, folder: str, feed: Feed) -> DataFrame:
    """A retailer's records as its feed sends them: untyped maps, some of them damaged.

    Fixed rules spoil whole classes of lines: line 7 lacks its amount key, quantity 50 is sent as
    the word 'fifty', quantity 49 has a null price, quantity 48 lacks the date, quantity 47 has a
    date that does not exist, quantity 46 a null transaction id, quantity 45 lacks the category.
    """
    rows = source_table(spark, folder, feed.code)
    key = feed.mapping
    quantity = F.col(key["quantity"])
    line = F.col("load_order.line_number")
    values = {name: F.col(name).cast("string") for name in feed.columns}
    values[key["quantity"]] = F.when(quantity == 50, "fifty").otherwise(values[key["quantity"]])
    values[key["unit_price"]] = F.when(quantity != 49, values[key["unit_price"]])
    values[key["transaction_date"]] = F.when(quantity == 47, "2001-02-30").otherwise(
        values[key["transaction_date"]]
    )
    values[key["transaction_id"]] = F.when(quantity != 46, values[key["transaction_id"]])
    record = (
        F.when(line == 7, _map_without(values, key["total_amount"]))
        .when(quantity == 48, _map_without(values, key["transaction_date"]))
        .when(quantity == 45, _map_without(values, key["category"]))
        .otherwise(_map_without(values))
    )
    return rows.select(record.alias("record"), "load_order")


def raw_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all feeds, each with its ``retailer``.

    One plan for all: the shuffles of orders and parts, which every feed joins, are the same and made once.
    """
    out, *rest = [
        raw_records(spark, folder, feed).withColumn("retailer", F.lit(feed.code)) for feed in FEED_BY_CODE.values()
    ]
    for records in rest:
        out = out.unionByName(records)
    return out


def damaged(records: DataFrame) -> DataFrame:
    """Common records with the date as text and some values spoilt.

    Fixed rules by quantity: 47 has an unreadable date, 46 an unknown retailer, 45 a null quantity,
    44 a null product name, 42 an empty customer id.
    """
    quantity = F.col("quantity")
    iso = F.date_format("transaction_date", "yyyy-MM-dd'T'HH:mm:ss")
    return records.withColumns({
        "transaction_date": F.when(quantity == 47, "yesterday").otherwise(iso),
        "retailer_id": F.when(quantity == 46, "retailer_9").otherwise(F.col("retailer_id")),
        "product_name": F.when(quantity != 44, F.col("product_name")),
        "customer_id": F.when(quantity == 42, "").otherwise(F.col("customer_id")),
        "quantity": F.when(quantity != 45, quantity),
    })


def landed_maps(records: DataFrame) -> DataFrame:
    """The damaged records as untyped maps, of which some lack a key.

    Fixed rules by quantity: 50 lacks its price, 49 its retailer, 48 both its id and its date, 43
    its category.
    """
    names = [name for name in records.columns if name != "load_seq"]
    values = {name: F.col(name).cast("string") for name in names}
    quantity = F.col("quantity")
    record = (
        F.when(quantity == 50, _map_without(values, "unit_price"))
        .when(quantity == 49, _map_without(values, "retailer_id"))
        .when(quantity == 48, _map_without(values, "transaction_id", "transaction_date"))
        .when(quantity == 43, _map_without(values, "category"))
        .otherwise(_map_without(values))
    )
    return damaged(records).select(record.alias("record"), "load_seq")


def faulty(star: Star) -> Star:
    """A star schema with what the quality checks look for.

    Fixed rules by quantity: facts of 50 refer to a product and those of 46 to a retailer that does
    not exist; 49 has no product, 48 no price, 47 no quantity, 45 no amount, 44 no retailer.
    """
    quantity = F.col("quantity")
    return replace(star, fact=star.fact.withColumns({
        "product_id": F.when(quantity == 50, -F.col("product_id")).when(quantity != 49, F.col("product_id")),
        "retailer_id": F.when(quantity == 46, 9).when(quantity != 44, F.col("retailer_id")),
        "unit_price": F.when(quantity != 48, F.col("unit_price")),
        "total_amount": F.when(quantity != 45, F.col("total_amount")),
        "quantity": F.when(quantity != 47, quantity),
    }))
