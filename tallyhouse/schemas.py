"""Fixed schemas: the three feeds, the common record and the star schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Each feed's code, table name, record key, date column, the common field each of
# its columns becomes, and its columns with the value given out when a column is empty.
COMMON_FIELDS = (
    "transaction_id",
    "product_id",
    "product_name",
    "category",
    "quantity",
    "unit_price",
    "total_amount",
    "transaction_date",
    "customer_id",
    "store_id",
)


@dataclass(frozen=True)
class Feed:
    code: str
    table: str
    key: str
    date: str
    columns: tuple[str, ...]
    mapping: dict[str, str]
    defaults: dict[str, int]


FEEDS = (
    Feed(
        code="retailer_1",
        table="sales",
        key="order_id",
        date="order_date",
        columns=(
            "order_id", "order_date", "customer_id", "store_id", "sku", "product_name", "category",
            "quantity", "price", "total", "discount_percentage", "payment_method",
        ),
        mapping=dict(zip(COMMON_FIELDS, (
            "order_id", "sku", "product_name", "category", "quantity", "price", "total",
            "order_date", "customer_id", "store_id",
        ))),
        defaults={"discount_percentage": 0},
    ),
    Feed(
        code="retailer_2",
        table="transactions",
        key="transaction_number",
        date="date",
        columns=(
            "transaction_number", "date", "member_id", "location_id", "item_code", "item_name",
            "department", "qty", "unit_cost", "amount", "tax_amount", "loyalty_points_earned",
            "promotion_code", "sales_rep_id",
        ),
        mapping=dict(zip(COMMON_FIELDS, (
            "transaction_number", "item_code", "item_name", "department", "qty", "unit_cost",
            "amount", "date", "member_id", "location_id",
        ))),
        defaults={"tax_amount": 0, "loyalty_points_earned": 0},
    ),
    Feed(
        code="retailer_3",
        table="purchases",
        key="sale_id",
        date="timestamp",
        columns=(
            "sale_id", "timestamp", "buyer_id", "outlet_id", "product_code", "name", "type",
            "count", "price_per_unit", "revenue", "shipping_cost", "warranty_months",
            "return_policy_days", "supplier_id",
        ),
        mapping=dict(zip(COMMON_FIELDS, (
            "sale_id", "product_code", "name", "type", "count", "price_per_unit", "revenue",
            "timestamp", "buyer_id", "outlet_id",
        ))),
        defaults={"shipping_cost": 0, "warranty_months": 0, "return_policy_days": 30},
    ),
)
FEED_BY_CODE = {feed.code: feed for feed in FEEDS}

# Keys a landed record must carry, in the order error messages list them.
REQUIRED_FIELDS = (
    "transaction_date",
    "product_id",
    "product_name",
    "transaction_id",
    "quantity",
    "unit_price",
    "total_amount",
    "retailer_id",
)

# The seeded retailers (retailer_id, retailer_code, retailer_name).
RETAILERS = (
    (1, "retailer_1", "Retailer 1"),
    (2, "retailer_2", "Retailer 2"),
    (3, "retailer_3", "Retailer 3"),
)

_MONEY = T.DecimalType(10, 2)
RECORD_SCHEMA = (
    T.StructType()
    .add("retailer_id", T.StringType())
    .add("transaction_id", T.StringType())
    .add("product_id", T.StringType())
    .add("product_name", T.StringType())
    .add("category", T.StringType())
    .add("quantity", T.IntegerType())
    .add("unit_price", _MONEY)
    .add("total_amount", _MONEY)
    .add("transaction_date", T.TimestampNTZType())
    .add("customer_id", T.StringType())
    .add("store_id", T.StringType())
)

DATE_COLUMNS = (
    "date_id", "date", "year", "quarter", "month", "week", "day", "day_of_week", "day_name",
    "is_weekend",
)

FACT_KEY = ("transaction_id", "product_id", "retailer_id")


@dataclass(frozen=True)
class Star:
    """The warehouse: one fact and five dimensions.

    ``fact`` has date_id (yyyymmdd), product_id, customer_id, store_id, retailer_id,
    transaction_id, quantity, unit_price, total_amount, created_at and the partition column
    month_id (yyyymm).
    """

    fact: DataFrame
    dates: DataFrame
    products: DataFrame
    customers: DataFrame
    stores: DataFrame
    retailers: DataFrame
