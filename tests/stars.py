"""Small hand-made star schemas."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tallyhouse.operators.dims import date_attributes, seed_retailers
from tallyhouse.plans.daily import EMPTY_FACT
from tallyhouse.schemas import Star


def line(date, product, txn, retailer=1, quantity=1, price="1.00", amount=None, customer=1, store=1):
    """One fact row; the amount defaults to quantity times price."""
    key = int(date.replace("-", ""))
    if amount is None and quantity is not None and price is not None:
        amount = Decimal(price) * quantity
    money = [None if value is None else Decimal(value) for value in (price, amount)]
    loaded = dt.datetime.fromisoformat(date) + dt.timedelta(days=1)
    return (key, product, customer, store, retailer, txn, quantity, *money, loaded, key // 100)


def star_of(spark, lines, products, dates=None):
    """``products`` as (id, sku, name, category); ``dates`` default to those of the lines."""
    fact = spark.createDataFrame(lines, EMPTY_FACT)
    if dates is None:
        dates = sorted({
            f"{str(row[0])[:4]}-{str(row[0])[4:6]}-{str(row[0])[6:]}" for row in lines
        })
    days = spark.createDataFrame([(dt.date.fromisoformat(day),) for day in dates], "date date")
    customers = sorted({row[2] for row in lines if row[2] is not None})
    stores = sorted({row[3] for row in lines if row[3] is not None})
    return Star(
        fact=fact,
        dates=date_attributes(days),
        products=spark.createDataFrame(
            products, "product_id bigint, product_sku string, product_name string, category string"
        ),
        customers=spark.createDataFrame(
            [(c, f"C{c}") for c in customers], "customer_id bigint, customer_external_id string"
        ),
        stores=spark.createDataFrame(
            [(s, f"S{s}") for s in stores], "store_id bigint, store_external_id string"
        ),
        retailers=seed_retailers(spark),
    )
