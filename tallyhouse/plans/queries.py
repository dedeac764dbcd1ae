"""The registered queries: every operator over the whole of the given tables.

Queries on facts and rollups read the warehouse, which Spark derives from the given tables on
first use and keeps in the shared folder. Results use plain types: money as double, dates as text.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable
from dataclasses import replace
from operator import attrgetter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators import analytics as fn
from tallyhouse.operators import dims, facts, merge, quality, reports, rollups, validate
from tallyhouse.operators import normalize as nrm
from tallyhouse.plans import daily, refresh
from tallyhouse.plans.store import TableStore
from tallyhouse.plans.warehouse import Warehouse, warehouse
from tallyhouse.schemas import FEED_BY_CODE, FEEDS, RECORD_SCHEMA
from tallyhouse.sources import export, feeds, landing, tables

Query = Callable[[SparkSession, str], DataFrame]

LOADED_AT = "2001-08-02 02:00:00"
NOW = "2001-08-01 12:00:00"
SCD1_SPLIT = "1998-06-01"
DELIVERY = "2001-08-31"
#: Arguments of registered queries that the warehouse knows: the last and the first day of its orders.
AS_OF, FIRST_DAY = attrgetter("as_of"), attrgetter("first_day")
SPAN = (FIRST_DAY, AS_OF)
#: Records in a landing file of arrays or lines.
PER_FILE = 100_000


def _time(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def plain(df: DataFrame) -> DataFrame:
    """The same rows with money as double and dates and times as ISO text."""
    def convert(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        return column.alias(field.name)

    return df.select(*[convert(field) for field in df.schema])


# Landing and loading over the given tables -------------------------------------------------


def _code() -> Column:
    """The code of a line's retailer."""
    return F.concat(F.lit("retailer_"), F.col("retailer_number").cast("string"))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line with its order and part, as :func:`_keep_lines` kept them or joined anew."""
    store = warehouse(spark, folder).store
    return tables.priced(store.read("lines") if store.exists("lines") else tables.sales_lines(spark, folder))


def _keep_lines(spark: SparkSession, folder: str) -> None:
    """Write the joined lines for steps that go through them several times, unless they are there."""
    store = warehouse(spark, folder).store
    if not store.exists("lines"):
        store.write("lines", tables.sales_lines(spark, folder))


def _all_records(spark: SparkSession, folder: str) -> DataFrame:
    """Common records of all lines; ``load_seq`` is day, retailer and the order of the lines."""
    return _records(_lines(spark, folder))


def _records(lines: DataFrame, *extra: str) -> DataFrame:
    code = _code()
    return lines.select(
        *extra,
        code.alias("retailer_id"),
        F.col("order_number").cast("string").alias("transaction_id"),
        F.col("part_number").cast("string").alias("product_id"),
        "product_name",
        "category",
        "quantity",
        tables.money("unit_cents").alias("unit_price"),
        tables.money("cents").alias("total_amount"),
        F.col("ordered_at").alias("transaction_date"),
        F.col("customer_number").cast("string").alias("customer_id"),
        F.when(F.col("store_number") % 25 != 0, F.col("store_number"))
        .cast("string")
        .alias("store_id"),
        F.struct(
            F.to_date("ordered_at").alias("date"), code.alias("retailer"), "order_number",
            "line_number", "store_number", "cents", "quantity",
        ).alias("load_seq"),
    )


def _maps(spark: SparkSession, folder: str, once: bool = False) -> DataFrame:
    """All records as untyped, partly damaged maps, written on first use.

    For a reader that goes through them ``once`` they are not written for its sake.
    """
    store = warehouse(spark, folder).store
    if not store.exists("raw_maps"):
        maps = tables.landed_maps(_all_records(spark, folder))
        if once:
            return maps
        store.write("raw_maps", maps)
    return store.read("raw_maps")


def _folders(date: Column, retailer: Column) -> dict[str, Column]:
    """Folder columns: each retailer delivers a month's sales on the last day of the month."""
    return {"retailer": retailer, **landing.partition_columns(F.last_day(date))}


def _delivered(records: DataFrame) -> DataFrame:
    return records.withColumns(_folders(F.col("load_seq.date"), F.col("load_seq.retailer"))).drop("load_seq")


def _landing_root(spark: SparkSession, folder: str) -> str:
    """The landing zone of the given tables, written on first use."""
    store = warehouse(spark, folder).store
    if not store.exists("landing"):
        records = tables.damaged(_all_records(spark, folder))
        landing.land(_delivered(records), f"{store.root}/landing/all", replace=False, compression="lz4")
    return store.versions("landing")[-1]


def _landed(spark: SparkSession, folder: str) -> DataFrame:
    return landing.parse_lines(landing.scan_files(spark, _landing_root(spark, folder)))


_LOADS: dict[str, daily.LoadResult] = {}


def _loaded(spark: SparkSession, folder: str) -> daily.LoadResult:
    """The damaged records loaded through the ordinary load job, once per warehouse."""
    root = f"{warehouse(spark, folder).store.root}/loaded"
    if root not in _LOADS:
        records = validate.typed_records(_maps(spark, folder, once=True), "load_seq")
        _LOADS[root] = daily.load_records(TableStore(spark, root), records, _time(LOADED_AT))
    return _LOADS[root]


# Sources -----------------------------------------------------------------------------------


def scan_source(code: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        feed = FEED_BY_CODE[code]
        table = tables.source_table(spark, folder, code)
        return feeds.scan_feed(table, feed, *tables.span(spark, folder))

    return run


def source_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """How often each value of the defaulted columns goes out, per feed."""
    out = []
    for feed in FEEDS:
        rows = feeds.with_defaults(tables.source_table(spark, folder, feed.code), feed)
        pairs = F.array(*[
            F.struct(F.lit(name).alias("column_name"), F.col(name).cast("double").alias("value"))
            for name in feed.defaults
        ])
        out.append(rows.select(F.lit(feed.code).alias("source"), F.explode(pairs).alias("p")))
    return (
        nrm.union_feeds(out)
        .groupBy("source", "p.column_name", "p.value")
        .agg(F.count("*").alias("rows"))
    )


def source_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.row_counts(
        {feed.table: tables.source_table(spark, folder, feed.code) for feed in FEEDS}
    )


def source_insert_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """Sales of feed 1 by order: those since the split arrive on top of the earlier ones."""
    rows = tables.source_table(spark, folder, "retailer_1")
    order = ["sku", "load_order"]
    old = F.col("order_date") < _time(SCD1_SPLIT)
    existing = merge.insert_if_absent(rows.limit(0), rows.where(old), "order_id", order)
    added = merge.insert_if_absent(existing, rows, "order_id", order)
    keep = ["order_id", "sku", "quantity", "total"]
    return existing.select(*keep, F.lit(False).alias("added")).unionByName(
        added.select(*keep, F.lit(True).alias("added"))
    )


def landing_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    landed = _landed(spark, folder)
    return validate.typed_records(landed).select(*RECORD_SCHEMA.names, "status")


def _mixed_root(spark: SparkSession, folder: str) -> str:
    """A landing zone with files of PER_FILE records at most per retailer and month, written on first use.

    Retailers 1 and 3 deliver arrays, retailer 2 lines. Faults stand beside the sales, in place of
    none, by fixed rules: one more file with an empty array in March and with one that breaks off
    in February, and in a file of lines of each month one more line that is no JSON.
    """
    store = warehouse(spark, folder).store
    if not store.exists("mixed_files"):
        _keep_lines(spark, folder)  # counted, then dealt to their files
        lines = _lines(spark, folder)
        folders = _folders(F.to_date("ordered_at"), _code())
        dealt = landing.dealt_records(lines.withColumns(folders).drop("retailer_number", "unit_cents"), PER_FILE)
        records = tables.damaged(_records(tables.priced(dealt), *landing.PARTITIONS, "chunk"))
        item = F.to_json(F.struct(*RECORD_SCHEMA.names), {"ignoreNullFields": "false"})
        rows = landing.placed_items(records, item)
        first, of_chunk_0 = F.col("place") == 1, F.col("chunk") == 0
        array = F.concat(F.when(first, "[").otherwise(""), "item", F.when(F.col("last"), "]").otherwise(","))
        line = F.concat("item", F.when(F.col("last") & of_chunk_0, "\n\n{oops").otherwise(""))
        value = F.when(F.col("retailer") == "retailer_2", line).otherwise(array)
        broken = F.when(F.col("month") == "03", "[]").when(
            F.col("month") == "02", F.concat(F.lit("["), "item", F.lit(",\n{"))
        )
        # the first item of a folder brings the folder's faulty file along, as a chunk of its own
        faulty = F.when(first & of_chunk_0 & (F.col("retailer") != "retailer_2"), broken)
        own = F.struct("chunk", value.alias("value"))
        both = F.when(faulty.isNull(), F.array(own)).otherwise(
            F.array(own, F.struct(F.lit(-1).cast("bigint").alias("chunk"), faulty.alias("value")))
        )
        lines = rows.select(*landing.PARTITIONS, "place", F.inline(both))
        landing.land_lines(lines, f"{store.root}/mixed_files/all")
    return store.versions("mixed_files")[-1]


def _mixed_files(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The records and the rejected files of that landing zone."""
    return landing.parse_files(spark, landing.scan_files(spark, _mixed_root(spark, folder), pattern="*.txt.lz4"))


def landing_parse_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Per retailer and day of delivery: records, and what the gate makes of them."""
    records, _ = _mixed_files(spark, folder)
    typed = validate.typed_records(records, "retailer", "file_date")
    return typed.groupBy("retailer", "file_date", "status").agg(
        F.count("*").alias("records"), F.sum("quantity").alias("quantity")
    )


def landing_rejected_files(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed_files(spark, folder)[1].select("retailer", "file_date", "reason")


def landing_scan_day(spark: SparkSession, folder: str) -> DataFrame:
    files = landing.list_files(spark, _mixed_root(spark, folder), DELIVERY, "*.txt.lz4")
    return files.groupBy("retailer").agg(
        F.count("*").alias("files"), F.every(F.col("file_size") > 0).alias("has_data")
    )


def landing_parse(spark: SparkSession, folder: str) -> DataFrame:
    """How many records carry each key, and with a value."""
    return (
        _landed(spark, folder)
        .select("retailer", F.explode("record").alias("field", "value"))
        .groupBy("retailer", "field")
        .agg(F.count("*").alias("present"), F.count("value").alias("with_value"))
    )


def path_partition_values(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _landed(spark, folder)
        .groupBy("retailer", "file_date")
        .agg(F.count("*").alias("records"))
    )


def processed_zone(spark: SparkSession, folder: str) -> DataFrame:
    """Records that pass the gate, landed again, per retailer and day."""
    passed = _maps(spark, folder).where(validate.has_required_fields(F.col("record")))
    names = RECORD_SCHEMA.names
    rows = passed.select(*[F.col("record")[name].alias(name) for name in names], "load_seq")
    root = f"{warehouse(spark, folder).store.root}/processed_zone"
    landing.land(_delivered(rows), root, compression="lz4")
    return (
        landing.parse_lines(landing.scan_files(spark, root))
        .groupBy("retailer", "file_date")
        .agg(
            F.count("*").alias("records"),
            F.count(F.col("record")["quantity"]).alias("with_quantity"),
        )
    )


def landing_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Per retailer: files, records and the keys of the first record of the files."""
    records, _ = _mixed_files(spark, folder)
    files = landing.inventory(records.where("record is not null"))
    keys = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("record_keys")))), ",").alias("record_keys")
    whole = landing.retailer_inventory(files, keys).withColumn("all_filled", F.col("bytes") > 2 * F.col("files"))
    return whole.select("retailer", "files", "records", "all_filled", "record_keys")


def landing_external_table(spark: SparkSession, folder: str) -> DataFrame:
    """SQL over the landed files as a table of the catalogue."""
    root = _landing_root(spark, folder)
    name = f"raw_sales_{hashlib.sha256(root.encode()).hexdigest()[:12]}"
    landing.external_table(spark, root, name)
    return spark.sql(f"""
        SELECT retailer, year, COUNT(*) AS records, COUNT(unreadable) AS unreadable, SUM(quantity) AS quantity,
          COUNT_IF(transaction_date = 'yesterday') AS bad_dates
        FROM {name} GROUP BY retailer, year""")


def export_daily_summary(spark: SparkSession, folder: str) -> DataFrame:
    wh = warehouse(spark, folder)
    path = f"{wh.store.root}/export/daily_sales_summary"
    view = wh.views["mv_daily_sales_summary"]
    export.export_csv(view, path, "1996-01-01")
    return spark.read.schema(view.schema).option("header", True).csv(path)


# Normalise and validate --------------------------------------------------------------------


def normalize_source(code: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return nrm.normalize_table(
            tables.source_table(spark, folder, code), FEED_BY_CODE[code]
        )

    return run


def union_sources(spark: SparkSession, folder: str) -> DataFrame:
    return nrm.union_feeds(normalize_source(feed.code)(spark, folder) for feed in FEEDS)


def _normalized_maps(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Each feed's damaged records, kept in a table as if they had arrived, and normalised.

    A file holds records of one feed, so a scan for one skips the files of the others.
    """
    store = warehouse(spark, folder).store
    if not store.exists("raw_feeds"):
        store.write("raw_feeds", tables.raw_feeds(spark, folder))
    raw = store.read("raw_feeds")
    return [
        nrm.normalize_maps(raw.where(F.col("retailer") == feed.code).drop("retailer"), feed, _time(NOW))
        for feed in FEEDS
    ]


def normalize_defaults(spark: SparkSession, folder: str) -> DataFrame:
    return nrm.union_feeds(nrm.accepted(df) for df in _normalized_maps(spark, folder))


def normalize_rejects(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("retailer_id", "transaction_id", "product_id", "product_name", "category",
               "customer_id", "store_id")
    return nrm.union_feeds(
        nrm.rejected(df).select(*columns) for df in _normalized_maps(spark, folder)
    )


def serialize_record(spark: SparkSession, folder: str) -> DataFrame:
    """With two members of the feed's own record, one of which may be null."""
    own = F.create_map(F.lit("part"), "product_id", F.lit("customer"), "customer_id")
    return nrm.serialize(_all_records(spark, folder), own)


def required_fields_gate(spark: SparkSession, folder: str) -> DataFrame:
    complete = validate.has_required_fields(F.col("record"))
    return (
        _maps(spark, folder)
        .groupBy(F.col("load_seq.retailer").alias("retailer"), complete.alias("complete"))
        .agg(F.count("*").alias("records"))
    )


def missing_field_errors(spark: SparkSession, folder: str) -> DataFrame:
    parsed = _maps(spark, folder).withColumn("position", F.col("load_seq.line_number"))
    return validate.missing_field_errors(parsed).select(
        F.col("record")["product_id"].alias("product_id"), "error"
    )


def _errors(spark: SparkSession, folder: str) -> DataFrame:
    parsed = _maps(spark, folder).withColumn("position", F.col("load_seq.line_number"))
    return validate.record_errors(parsed, dims.seed_retailers(spark))


def load_errors(spark: SparkSession, folder: str) -> DataFrame:
    """The first ten error texts in load order, of whatever kind."""
    return facts.first_errors(_errors(spark, folder))


def record_errors(spark: SparkSession, folder: str) -> DataFrame:
    return _errors(spark, folder).drop("load_seq")


def unknown_retailer_rejects(spark: SparkSession, folder: str) -> DataFrame:
    valid = _loaded(spark, folder).records.where("status = 'valid'")
    rejects = validate.unknown_retailers(valid, dims.seed_retailers(spark))
    return rejects.select("retailer_id", "transaction_id", "product_id", "quantity")


def bad_date_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rejects = _loaded(spark, folder).records.where("status = 'bad_date'")
    return rejects.select("retailer_id", "transaction_id", "product_id", "quantity")


# Dimensions and facts ----------------------------------------------------------------------


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return _loaded(spark, folder).star.dates.drop("created_at")


def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    products = _loaded(spark, folder).star.products
    return products.select("product_sku", "product_name", "category")


def dim_product_scd1(spark: SparkSession, folder: str) -> DataFrame:
    """Products loaded up to the split date, then upserted with the later, renamed records."""
    store = TableStore(spark, f"{warehouse(spark, folder).store.root}/scd1")
    records = _all_records(spark, folder)
    early = F.col("load_seq.date") < F.lit(SCD1_SPLIT).cast("date")
    first = _time(f"{SCD1_SPLIT} 02:00:00")
    before = store.write(
        "dim_products", dims.upsert_products(records.where(early), None, first)
    )
    renamed = records.where(~early).withColumn(
        "product_name", F.concat("product_name", F.lit(" v2"))
    )
    after = store.write("dim_products", dims.upsert_products(renamed, before, _time(LOADED_AT)))
    return after.select("product_sku", "product_name", "category", "created_at", "updated_at")


def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return _loaded(spark, folder).star.customers.select("customer_external_id")


def dim_store(spark: SparkSession, folder: str) -> DataFrame:
    return _loaded(spark, folder).star.stores.select("store_external_id")


def dim_surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Per dimension: members, different keys, whether all lie above 0, members that another load would change.

    That load has the same records again: it must add no member and give none another key.
    """
    loaded = _loaded(spark, folder)
    star, records = loaded.star, loaded.records.where("status = 'valid' and product_name is not null")
    again = {
        "product": dims.upsert_products(records, star.products, _time(LOADED_AT), written=True),
        "customer": dims.new_customers(records, star.customers, _time(LOADED_AT)),
        "store": dims.new_stores(records, star.stores, _time(LOADED_AT)),
    }
    natural = {"product": "product_sku", "customer": "customer_external_id", "store": "store_external_id"}
    out = []
    for name, key in natural.items():
        members, pair = getattr(star, f"{name}s"), [f"{name}_id", key]
        changed = again[name].select(*pair).join(members.select(*pair), pair, "left_anti")
        out.append(members.agg(
            F.count(key).alias("members"), F.count_distinct(f"{name}_id").alias("keys"),
            (F.min(f"{name}_id") > 0).alias("above_zero"),
        ).select(F.lit(name).alias("dimension"), "*", changed.agg(F.count("*")).scalar().alias("changed")))
    return nrm.union_feeds(out)


def dim_retailer(spark: SparkSession, folder: str) -> DataFrame:
    """The seed put on top of the retailers the loaded facts refer to: nothing is added twice."""
    star = _loaded(spark, folder).star
    # three numbers a task: the facts themselves would meet in a task for each retailer
    sold = star.fact.select("retailer_id").distinct()
    used = star.retailers.join(sold, "retailer_id", "left_semi")
    return dims.seed_retailers(spark, used)


def fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The loaded facts with their natural keys."""
    return rollups.sales_enriched(_loaded(spark, folder).star).select(
        "date", "product_sku", "customer_external_id", "store_external_id", "retailer_code",
        "transaction_id", "quantity", "unit_price", "total_amount",
    )


def fact_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    return tables.fact_sales(spark, folder).drop("created_at", "month_id")


def fact_idempotent_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Loading the same records again: rows before, rows that would be added."""
    loaded = _loaded(spark, folder)
    again = facts.new_facts(
        loaded.records.where("status = 'valid'"), loaded.star, loaded.star.fact, _time(LOADED_AT)
    )
    return loaded.star.fact.agg(F.count("*").alias("facts_before")).select(
        "facts_before", again.agg(F.count("*")).scalar().alias("inserted")
    )


def load_counters(spark: SparkSession, folder: str) -> DataFrame:
    return _loaded(spark, folder).counters


def fact_constraint_rejects(spark: SparkSession, folder: str) -> DataFrame:
    valid = _loaded(spark, folder).records.where("status = 'valid'")
    return validate.constraint_violations(valid).select(
        "retailer_id", "transaction_id", "product_id", "product_name", "quantity"
    )


def process_date_summary(spark: SparkSession, folder: str) -> DataFrame:
    listed = landing.list_files(spark, _mixed_root(spark, folder), DELIVERY, "*.txt.lz4")
    records, _ = _mixed_files(spark, folder)
    found = records.where(F.col("record").isNotNull() & (F.col("file_date") == F.lit(DELIVERY).cast("date")))
    star = _loaded(spark, folder).star
    loaded = (
        fn.sales_between(star, fn.month_start(DELIVERY), DELIVERY)
        .groupBy("retailer_id")
        .agg(F.count("*").alias("records_loaded"))
        .join(star.retailers, "retailer_id")
        .select(F.col("retailer_code").alias("retailer"), "records_loaded")
    )
    return landing.day_summary(listed, found, loaded)


# Registry ----------------------------------------------------------------------------------

def _known(wh: Warehouse, args: tuple) -> list:
    """The arguments, those asked of the warehouse among them."""
    return [x(wh) if callable(x) else x for x in args]


def _star(function: Callable, *args) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        wh = warehouse(spark, folder)
        return function(wh.star, *_known(wh, args))

    return run


def _counted(function: Callable, *args) -> Query:
    """With the bitmaps of daily keys."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        wh = warehouse(spark, folder)
        return function(wh.star, *_known(wh, args), members=wh.members)

    return run


def _views(function: Callable, *args) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        wh = warehouse(spark, folder)
        return function(wh.views, *_known(wh, args))

    return run


def _checks(function: Callable, *args) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        wh = warehouse(spark, folder)
        results = function(tables.faulty(wh.star), *_known(wh, (*SPAN, *args)))
        return results.withColumn("details", F.to_json("details"))

    return run


def _refreshed(function: Callable[[Warehouse], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        wh = warehouse(spark, folder)
        for name in wh.views:
            wh.views[name]  # written on first use
        return function(wh)

    return run


def _refresh_store(spark: SparkSession, folder: str, name: str) -> TableStore:
    return TableStore(spark, f"{warehouse(spark, folder).store.root}/{name}")


def refresh_all_status(spark: SparkSession, folder: str) -> DataFrame:
    """Every rollup refreshed one by one, and what its new table holds."""
    store = _refresh_store(spark, folder, "refresh")
    refresh.refresh_all(warehouse(spark, folder).star, store)
    return refresh.refresh_status(store)


def refresh_together_status(spark: SparkSession, folder: str) -> DataFrame:
    store = _refresh_store(spark, folder, "refresh_together")
    refresh.refresh_together(warehouse(spark, folder).star, store)
    return refresh.refresh_status(store)


_TOUCHED = threading.Lock()


def _touched(spark: SparkSession, folder: str) -> TableStore:
    """A store whose rollups were built without some sales, and refreshed by the months these are of.

    The newest month is missing at first, and of the same month a year before one retailer.
    """
    star, store = warehouse(spark, folder).star, _refresh_store(spark, folder, "touched")
    with _TOUCHED:
        if not store.exists("done"):
            newest = star.fact.agg(F.max("month_id")).first()[0]
            late = (F.col("month_id") == newest) | ((F.col("month_id") == newest - 100) & (F.col("retailer_id") == 2))
            early = replace(star, fact=star.fact.where(~late))
            refresh.refresh_all(early, store)
            refresh.refresh_months(early, store, ())
            refresh.write_members(early, store)
            refresh.refresh_months(star, store, [newest, newest - 100])
            store.write("done", spark.range(1))
    return store


def _touched_rollup(name: str) -> Query:
    return lambda spark, folder: _touched(spark, folder).read(name)


def _plain(query: Query) -> Query:
    return lambda spark, folder: plain(query(spark, folder))


TOUCHED_ROLLUPS = [name.removeprefix("mv_") for name in rollups.ROLLUPS]


def _last(days: int) -> tuple:
    """From so many days before today until today."""
    return (lambda wh: fn.days_before(wh.as_of, days)), AS_OF


def _last_year(wh: Warehouse) -> int:
    return int(wh.as_of[:4]) - 1


def _touched_sales_summary(spark: SparkSession, folder: str) -> DataFrame:
    wh = warehouse(spark, folder)
    return fn.sales_summary(wh.star, *_known(wh, SPAN), members=refresh.read_members(_touched(spark, folder)))


_QUERIES: dict[str, Query] = {
    # sources and landing
    "scan_source_1": scan_source("retailer_1"),
    "scan_source_2": scan_source("retailer_2"),
    "scan_source_3": scan_source("retailer_3"),
    "source_defaults": source_defaults,
    "source_row_counts": source_row_counts,
    "source_insert_if_absent": source_insert_if_absent,
    "landing_roundtrip": landing_roundtrip,
    "landing_parse_arrays": landing_parse_arrays,
    "landing_rejected_files": landing_rejected_files,
    "landing_scan_day": landing_scan_day,
    "landing_parse": landing_parse,
    "path_partition_values": path_partition_values,
    "processed_zone": processed_zone,
    "landing_inventory": landing_inventory,
    "landing_external_table": landing_external_table,
    "export_daily_summary": export_daily_summary,
    # normalise and validate
    "normalize_source_1": normalize_source("retailer_1"),
    "normalize_source_2": normalize_source("retailer_2"),
    "normalize_source_3": normalize_source("retailer_3"),
    "normalize_defaults": normalize_defaults,
    "normalize_rejects": normalize_rejects,
    "union_sources": union_sources,
    "serialize_record": serialize_record,
    "required_fields_gate": required_fields_gate,
    "missing_field_errors": missing_field_errors,
    "unknown_retailer_rejects": unknown_retailer_rejects,
    "bad_date_rejects": bad_date_rejects,
    # dimensions and facts
    "dim_date": dim_date,
    "dim_product": dim_product,
    "dim_product_scd1": dim_product_scd1,
    "dim_customer": dim_customer,
    "dim_store": dim_store,
    "dim_retailer": dim_retailer,
    "dim_surrogate_keys": dim_surrogate_keys,
    "fact_sales": fact_sales,
    "fact_dedupe": fact_dedupe,
    "fact_idempotent_reload": fact_idempotent_reload,
    "load_counters": load_counters,
    "load_errors": load_errors,
    "record_errors": record_errors,
    "fact_constraint_rejects": fact_constraint_rejects,
    "process_date_summary": process_date_summary,
    "sales_enriched": _star(
        lambda star: rollups.sales_enriched(star).drop("created_at", "month_id")
    ),
    # rollups
    "daily_sales_summary": _star(rollups.daily_sales_summary),
    "monthly_sales_by_category": _star(rollups.monthly_sales_by_category),
    "top_products_by_revenue": _star(rollups.top_products_by_revenue),
    "weekly_sales_trends": _star(rollups.weekly_sales_trends),
    "quarterly_sales_summary": _star(rollups.quarterly_sales_summary),
    "daily_sales_by_product": _star(rollups.daily_sales_by_product),
    "refresh_one": lambda spark, folder: refresh.refresh_one(
        warehouse(spark, folder).star, warehouse(spark, folder).store, "mv_weekly_sales_trends"
    ),
    "refresh_all_status": refresh_all_status,
    "refresh_together_status": refresh_together_status,
    **{f"touched_{name}": _touched_rollup(f"mv_{name}") for name in TOUCHED_ROLLUPS},
    "touched_sales_summary": _touched_sales_summary,
    "touched_status": lambda spark, folder: refresh.refresh_status(_touched(spark, folder)),
    "view_info": _refreshed(lambda wh: refresh.view_info(wh.store)),
    "verify_views": _refreshed(lambda wh: refresh.verify_views(wh.store)),
    "view_row_counts": _refreshed(lambda wh: refresh.view_row_counts(wh.store)),
    # parameterised analytics
    "sales_summary": _counted(fn.sales_summary, *SPAN),
    "sales_summary_retailer": _counted(fn.sales_summary, *SPAN, 2),
    "top_products": _star(fn.top_products, *SPAN, 10),
    "top_products_retailer": _star(fn.top_products, *SPAN, 25, 3),
    "sales_trends_daily": _star(fn.sales_trends, *SPAN, "daily"),
    "sales_trends_weekly": _star(fn.sales_trends, *SPAN, "weekly"),
    "sales_trends_monthly": _star(fn.sales_trends, *SPAN, "monthly"),
    "sales_trends_quarterly": _star(fn.sales_trends, *SPAN, "quarterly"),
    "sales_trends_retailer": _star(fn.sales_trends, *SPAN, "weekly", 1),
    "sales_by_category": _star(fn.sales_by_category, *SPAN),
    "sales_by_category_retailer": _star(fn.sales_by_category, *SPAN, 1),
    "retailer_performance": _counted(fn.retailer_performance, *SPAN),
    "recent_sales": _star(fn.recent_sales, AS_OF, 7),
    # the same over the days, weeks and months before today
    "sales_summary_30d": _counted(fn.sales_summary, *_last(30)),
    "top_products_90d": _star(fn.top_products, *_last(90), 20),
    "sales_trends_90d": _star(fn.sales_trends, *_last(90), "weekly"),
    "sales_by_category_90d": _star(fn.sales_by_category, *_last(90)),
    "retailer_performance_30d": _counted(fn.retailer_performance, *_last(30)),
    "dq_report_30d": _star(quality.quality_report, *_last(30)),
    "dq_summary_30d": _star(quality.quality_summary, *_last(30)),
    "database_statistics": _star(fn.database_statistics),
    # quality
    "dq_record_count": _checks(quality.check_record_count),
    "dq_completeness": _checks(quality.check_completeness),
    "dq_business_rules": _checks(quality.check_business_rules),
    "dq_referential_integrity": _checks(quality.check_referential_integrity),
    "dq_freshness": _checks(quality.check_freshness, AS_OF),
    "dq_latest_by_retailer": _star(quality.latest_by_retailer, AS_OF, AS_OF),
    "dq_run_all": _checks(quality.run_all_checks, AS_OF),
    "dq_run_summary": _star(
        lambda star, *days: quality.summarize_checks(quality.run_all_checks(tables.faulty(star), *days)), *SPAN, AS_OF
    ),
    "dq_report": _star(quality.quality_report, *SPAN),
    "dq_summary": _star(quality.quality_summary, *SPAN),
    # example reports
    "rpt_daily_dashboard": _views(reports.daily_dashboard, AS_OF),
    "rpt_top_products": _views(reports.top_products),
    "rpt_category_performance": _views(reports.category_performance, AS_OF),
    "rpt_weekly_trends": _views(reports.weekly_trends, AS_OF),
    "rpt_quarterly_summary": _views(reports.quarterly_summary, AS_OF),
    "rpt_top_product_trends": _views(reports.top_product_trends, AS_OF),
    "rpt_retailer_comparison": _views(reports.retailer_comparison, AS_OF),
    "rpt_category_growth": _views(reports.category_growth, AS_OF),
    # charts
    "chart_daily_pivot": _views(reports.chart_daily, AS_OF),
    "chart_top_products": _views(reports.chart_top_products),
    "chart_category_pivot": _views(reports.chart_categories, AS_OF),
    "chart_weekly_pivot": _views(reports.chart_weekly, AS_OF),
    "chart_retailer_comparison": _views(reports.chart_retailers, AS_OF),
    # panels
    "panel_daily_revenue": _views(reports.panel_daily_revenue, *SPAN),
    "panel_daily_txn": _views(reports.panel_daily_transactions, *SPAN),
    "panel_retailer_7d": _star(reports.panel_retailer_week, AS_OF),
    "panel_today": _star(reports.panel_today, AS_OF),
    "panel_top_revenue": _star(reports.panel_top_revenue, *SPAN),
    "panel_top_quantity": _star(reports.panel_top_quantity, *SPAN),
    "panel_category_monthly": _views(reports.panel_category_monthly, *SPAN),
    "panel_weekly": _star(reports.panel_weekly, *SPAN),
    "panel_quarterly": _star(reports.panel_quarterly, *SPAN),
    "panel_category_heatmap": _views(reports.panel_category_heatmap, *SPAN),
    # documented queries
    "doc_daily_by_retailer": _star(reports.daily_by_retailer),
    "doc_top_by_name": _star(reports.top_by_name),
    "doc_monthly_revenue": _star(reports.monthly_revenue),
    "doc_by_retailer": _star(reports.by_retailer),
    "doc_category_year": _views(reports.category_year, AS_OF),
    "doc_daily_one_retailer": _views(reports.daily_one_retailer, "Retailer 1", FIRST_DAY),
    "doc_daily_one_sku": _views(reports.daily_one_sku, "77", "Retailer 1", FIRST_DAY),
    "doc_average_daily_revenue": _views(reports.average_daily_revenue, AS_OF),
    "doc_top_one_retailer": _views(reports.top_one_retailer, "Retailer 1"),
    "doc_monthly_one_retailer": _views(reports.monthly_one_retailer, "Retailer 1", _last_year),
    "doc_weekly_one_retailer": _views(reports.weekly_one_retailer, "Retailer 1", _last_year),
    "doc_quarterly_year": _views(reports.quarterly_year, _last_year),
    "doc_top_current_month": _star(reports.top_current_month, AS_OF),
    "doc_retailers_last_quarter": _star(reports.retailers_last_quarter, AS_OF),
    "doc_top20": _views(reports.top20),
    "doc_monthly_category_list": _views(reports.monthly_category_list, AS_OF),
    "doc_quarterly_list": _views(reports.quarterly_list),
    "load_activity": _star(reports.load_activity),
    "newest_rows": _star(lambda star: reports.newest_rows(star).drop("month_id")),
}

QUERIES: dict[str, Query] = {name: _plain(query) for name, query in _QUERIES.items()}
