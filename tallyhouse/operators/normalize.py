"""Feed records to the common record."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import MONEY
from tallyhouse.schemas import COMMON_FIELDS, RECORD_SCHEMA, Feed

# Fixed value: the ISO date and time forms a transaction date may have.
ISO_TIMESTAMP = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d{3}(\d{3})?)?)?)?"
    r"(Z|[+-]\d{2}:\d{2}(:\d{2})?)?)?$"
)


def iso_timestamp(text: Column) -> Column:
    """The wall-clock time of an ISO text, or null; partial dates such as '2024-01' are refused."""
    return F.when(text.rlike(ISO_TIMESTAMP), text.try_cast("timestamp_ntz"))


def union_feeds(frames: Iterable[DataFrame]) -> DataFrame:
    """All feeds that loaded, as one frame of common records."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def normalize_table(df: DataFrame, feed: Feed, *extra: str) -> DataFrame:
    """Common records of a typed source table: rename and cast.

    ``extra`` columns are carried along, such as the order in which rows were loaded.
    """
    types = {field.name: field.dataType for field in RECORD_SCHEMA}
    fields = [F.col(feed.mapping[name]).cast(types[name]).alias(name) for name in COMMON_FIELDS]
    return df.select(F.lit(feed.code).alias("retailer_id"), *fields, *extra)


def _text_field(record: Column, key: str) -> Column:
    """The value under ``key``, the empty text when the key is missing, null when it is null."""
    return F.when(F.map_contains_key(record, key), record[key]).otherwise("")


def _amount_field(record: Column, key: str, convert: Callable[[Column], Column]) -> Column:
    """As above with 0 for a missing key; null marks a value that does not convert."""
    return F.when(F.map_contains_key(record, key), convert(record[key])).otherwise(F.lit(0))


def normalize_maps(df: DataFrame, feed: Feed, now: Column, record: str = "record") -> DataFrame:
    """Common records of untyped feed records, kept as ``map<string,string>`` in ``record``.

    A missing key takes its default ('' or 0, and ``now`` for the date); a key that is present with
    null keeps the null, except that ids are text and show it as 'None'. ``convertible`` is false
    for records whose numbers or date cannot be read: they are to be dropped one by one.
    """
    raw = F.col(record)
    key = feed.mapping
    date = raw[key["transaction_date"]]
    money = lambda text: text.try_cast("double").try_cast(MONEY)
    fields = {
        "retailer_id": F.lit(feed.code),
        "transaction_id": F.coalesce(_text_field(raw, key["transaction_id"]), F.lit("None")),
        "product_id": F.coalesce(_text_field(raw, key["product_id"]), F.lit("None")),
        "product_name": _text_field(raw, key["product_name"]),
        "category": _text_field(raw, key["category"]),
        "quantity": _amount_field(raw, key["quantity"], lambda text: text.try_cast("int")),
        "unit_price": _amount_field(raw, key["unit_price"], money),
        "total_amount": _amount_field(raw, key["total_amount"], money),
        "transaction_date": F.when(
            F.map_contains_key(raw, key["transaction_date"]), iso_timestamp(date)
        ).otherwise(now.cast("timestamp_ntz")),
        "customer_id": raw[key["customer_id"]],
        "store_id": raw[key["store_id"]],
    }
    readable = F.lit(True)
    for name in ("quantity", "unit_price", "total_amount", "transaction_date"):
        readable = readable & F.col(name).isNotNull()
    return df.withColumns(fields).withColumn("convertible", readable)


def accepted(normalized: DataFrame, *extra: str) -> DataFrame:
    """The records that convert."""
    return normalized.where("convertible").select(*RECORD_SCHEMA.names, *extra)


def rejected(normalized: DataFrame) -> DataFrame:
    """The records that do not."""
    return normalized.where("not convertible")


def iso_text(date: Column) -> Column:
    """A time as ISO text, with microseconds only when there are any."""
    whole = F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss")
    with_micros = F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(F.date_format(date, "SSSSSS") == "000000", whole).otherwise(with_micros)


def serializable(records: DataFrame, *extra: str, raw: Column | None = None) -> DataFrame:
    """Records as they are landed: dates in ISO form, the feed's own record under ``raw_data``."""
    members = [
        iso_text(F.col(name)).alias(name) if name == "transaction_date" else F.col(name)
        for name in RECORD_SCHEMA.names
    ]
    raw_data = F.lit(None).cast("map<string,string>") if raw is None else raw
    return records.select(*extra, *members, raw_data.alias("raw_data"))


def serialize(records: DataFrame, raw: Column | None = None) -> DataFrame:
    """The same as one JSON text per record. Nulls are written out: to the loader a null value is
    not a missing key."""
    rows = serializable(records, raw=raw)
    return rows.select(
        F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")
    )
