"""Landing files, the daily run and the refresh."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import rollups
from tallyhouse.operators.quality import QualityCheckFailed
from tallyhouse.plans import daily, refresh
from tallyhouse.plans.store import TableStore
from tallyhouse.sources import export, landing
from tallyhouse.streaming.landing import load_new_files
from tests.stars import line, star_of

DAY = "2024-05-02"
SALES = (
    "order_id string, order_date timestamp_ntz, customer_id string, store_id string, sku string, "
    "product_name string, category string, quantity int, price decimal(10,2), "
    "total decimal(10,2), discount_percentage decimal(5,2), payment_method string"
)


def put(tmp_path, name, text, retailer="retailer_1", day="month=05/day=02"):
    path = Path(tmp_path) / f"raw/{retailer}/year=2024/{day}/{name}"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def sales(spark, *rows):
    from datetime import datetime
    from decimal import Decimal

    full = [
        (order, datetime.fromisoformat(when), "c1", "s1", sku, f"Item {sku}", "Tools", q,
         Decimal("2.00"), Decimal("2.00") * q if total is None else Decimal(total), None, "Cash")
        for order, when, sku, q, total in rows
    ]
    return spark.createDataFrame(full, SALES)


def test_array_files_and_rejects(spark, tmp_path, folder):
    put(tmp_path, "sales_data.json", json.dumps([{"a": 1.50, "b": None}, {"a": "x"}]))
    put(tmp_path, "object.json", '{"a": 1}', "retailer_2")
    put(tmp_path, "broken.json", "[{", "retailer_2")
    put(tmp_path, "none.json", "[]", "retailer_3")
    put(tmp_path, "notes.txt", '[{"a": 1}]', "retailer_3")
    files = landing.scan_files(spark, f"{folder}/raw", DAY, whole=True)
    got = landing.parse_arrays(files).orderBy("load_seq").collect()
    assert [(r["position"], r["record"]) for r in got] == [(0, {"a": "1.5", "b": None}), (1, {"a": "x"})]
    reasons = {Path(r["file"]).name: r["reason"] for r in landing.rejected_files(files).collect()}
    assert reasons["none.json"] == "no records"
    assert set(reasons) == {"object.json", "broken.json", "none.json"}


def test_list_files_of_a_day(spark, tmp_path, folder):
    put(tmp_path, "a.json", "[]")
    put(tmp_path, "b.txt", "[]")
    put(tmp_path, "c.json", "[]", "somebody_else")
    put(tmp_path, "d.json", "[]", day="month=05/day=03")
    found = landing.list_files(spark, f"{folder}/raw", DAY).collect()
    assert [Path(r["path"]).name for r in found] == ["a.json"]


def test_no_folder_means_no_rows(spark, folder):
    assert landing.scan_files(spark, f"{folder}/raw", DAY).count() == 0
    assert landing.parse_lines(landing.scan_files(spark, f"{folder}/raw", DAY)).count() == 0


def test_path_parts_are_padded(spark):
    df = spark.createDataFrame([("file:/x/raw/retailer_2/year=2024/month=5/day=2/f.json",),
                                ("file:/x/retailer=retailer_3/year=2024/month=05/day=02/f",),
                                ("file:/x/other/f.json",)], "p string")
    parts = landing.path_parts(F.col("p"))
    got = [tuple(r) for r in df.select(parts["retailer"], parts["file_date"].cast("string")).collect()]
    assert got == [("retailer_2", DAY), ("retailer_3", DAY), ("", None)]


def test_landing_a_day_again_replaces_only_that_day(spark, folder):
    root = f"{folder}/raw"
    day1 = sales(spark, ("o1", "2024-05-01 09:00:00", "A", 1, None), ("o2", f"{DAY} 09:00:00", "A", 1, None))
    daily.land_feeds({"retailer_1": day1}, root, "2024-05-01")
    daily.land_feeds({"retailer_1": day1}, root, DAY)
    more = sales(spark, ("o3", f"{DAY} 09:30:00.250000", "B", 2, None), ("o4", "2024-05-03 00:00:00", "B", 1, None))
    daily.land_feeds({"retailer_1": more}, root, DAY)
    parsed = landing.parse_lines(landing.scan_files(spark, root)).collect()
    assert sorted(r["record"]["transaction_id"] for r in parsed) == ["o1", "o3"]
    record = next(r["record"] for r in parsed if r["record"]["transaction_id"] == "o3")
    assert record["transaction_date"] == "2024-05-02T09:30:00.250000"
    assert json.loads(record["raw_data"])["sku"] == "B"
    table = landing.external_table(spark, root, "raw_sales")
    assert spark.sql("SELECT sum(quantity) FROM raw_sales").first()[0] == 3 and "day" in table.columns


def test_external_table_keeps_unreadable_lines_and_reads_the_folders_asked_for(spark, folder):
    good = '{"transaction_id": "t%d", "quantity": 2, "transaction_date": "yesterday"}'
    rows = [("2024", "05", "01", good % 1), ("2024", "05", "01", "{oops"), ("2024", "06", "01", good % 2),
            ("2024", "06", "01", '{"transaction_id": "t3", "quantity": "many"}')]
    texts = spark.createDataFrame(rows, "year string, month string, day string, value string")
    root = f"{folder}/o'raw"
    landing.land_texts(texts.withColumn("retailer", F.lit("retailer_1")), root)
    landing.external_table(spark, root, "odd_sales")
    found = spark.sql("SELECT month, count(*), sum(quantity), count(unreadable), min(unreadable) FROM odd_sales GROUP BY month")
    assert {tuple(x) for x in found.collect()} == {
        ("05", 2, 2, 1, "{oops"), ("06", 2, 2, 1, '{"transaction_id": "t3", "quantity": "many"}')
    }
    may = spark.sql("SELECT transaction_id, unreadable FROM odd_sales WHERE month = '05'")
    assert len(may.inputFiles()) == 2 and {x.transaction_id for x in may.collect()} == {"t1", None}
    plan = may._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan.split("PartitionFilters")[1].split("]")[0]
    landing.land_texts(texts.limit(0).withColumn("retailer", F.lit("x")), f"{folder}/none")
    assert landing.external_table(spark, f"{folder}/none", "no_sales").count() == 0
    spark.sql("DROP TABLE odd_sales")
    assert landing.scan_files(spark, root, pattern="*.txt").count() == 4  # the files stay


def test_a_file_is_in_order(spark, folder):
    rows = [(f"o{i * 7 % 10}", f"{DAY} 09:{i * 7 % 10:02d}:00", "A", 1, None) for i in range(10)]
    daily.land_feeds({"retailer_1": sales(spark, *rows).repartition(4)}, f"{folder}/raw", DAY)
    parsed = landing.parse_lines(landing.scan_files(spark, f"{folder}/raw")).orderBy("load_seq").collect()
    assert [r["record"]["transaction_id"] for r in parsed] == [f"o{i}" for i in range(10)]


def test_a_failing_feed_does_not_stop_the_others(spark, folder):
    good = sales(spark, ("o1", f"{DAY} 09:00:00", "A", 1, None))
    failed = daily.land_feeds({"retailer_2": good, "retailer_1": good}, f"{folder}/raw", DAY)
    assert list(failed) == ["retailer_2"]
    assert landing.scan_files(spark, f"{folder}/raw", DAY).count() == 1


def test_daily_run(spark, folder):
    store, root = TableStore(spark, f"{folder}/store"), f"{folder}/raw"
    table = sales(spark, ("o1", f"{DAY} 09:00:00", "A", 1, None), ("o1", f"{DAY} 09:00:00", "B", 2, None))
    status = daily.run_daily(spark, store, root, {"retailer_1": table}, DAY, DAY)
    assert status.refreshed.where("successful").count() == 6 and status.failed_feeds == {}
    assert store.read("mv_daily_sales_summary").first()["total_quantity"] == 3
    again = daily.run_daily(spark, store, root, {"retailer_1": table}, DAY, DAY)
    assert again.refreshed.count() == 6
    assert store.read("fact_sales").count() == 2


def test_failed_check_stops_the_refresh(spark, folder):
    store, root = TableStore(spark, f"{folder}/store"), f"{folder}/raw"
    wrong = sales(spark, ("o1", f"{DAY} 09:00:00", "A", 2, "99.00"))
    with pytest.raises(QualityCheckFailed, match="business_rules"):
        daily.run_daily(spark, store, root, {"retailer_1": wrong}, DAY, DAY)
    assert not store.exists("mv_daily_sales_summary")


def test_new_files_are_loaded_once(spark, folder):
    store, root, memory = TableStore(spark, f"{folder}/store"), f"{folder}/raw", f"{folder}/seen"
    for day in ("2024-05-01", DAY):
        table = sales(spark, (f"o-{day}", f"{day} 09:00:00", "A", 1, None))
        daily.land_feeds({"retailer_1": table}, root, day)
        load_new_files(spark, store, root, memory)
    load_new_files(spark, store, root, memory)
    assert store.read("fact_sales").count() == 2
    assert len(store.versions("staged")) == 2
    assert store.read("processed").count() == 2


def test_the_processed_zone_is_the_same_after_any_rerun(spark, tmp_path, folder):
    days = ("2024-05-01", DAY, "2024-05-03")
    for n, day in enumerate(days):
        table = sales(spark, *((f"o{day}{i}", f"{day} 09:00:00", "A", 1 + i, None) for i in range(3 + n)))
        daily.land_feeds({"retailer_1": table}, f"{folder}/raw", day)
        load_day(spark, folder, day)
    store = TableStore(spark, f"{folder}/store")

    def zone():
        return sorted((str(r.file_date), r.transaction_id) for r in store.read("processed").collect())

    once = zone()
    assert len(once) == 12 and len(set(once)) == 12
    load_day(spark, folder, None)
    assert zone() == once
    load_day(spark, folder, DAY)
    again = sales(spark, *((f"o{DAY}{i}", f"{DAY} 09:00:00", "A", 1 + i, None) for i in range(4)))
    daily.land_feeds({"retailer_1": again.repartition(3)}, f"{folder}/raw", DAY)
    load_day(spark, folder, DAY)
    assert zone() == once
    load_new_files(spark, store, f"{folder}/raw", f"{folder}/seen")
    assert {x[0] for x in zone()} == set(days) and store.read("fact_sales").count() == 12


def test_a_stream_keeps_rejects_and_counters(spark, tmp_path, folder):
    store, root, memory = TableStore(spark, f"{folder}/store"), f"{folder}/raw", f"{folder}/seen"
    put(tmp_path, "good.json", json.dumps([RECORD]))
    put(tmp_path, "broken.json", "[{", "retailer_2")
    load_new_files(spark, store, root, memory)
    put(tmp_path, "more.json", json.dumps([RECORD, {**RECORD, "transaction_id": "t2"}]))
    put(tmp_path, "empty.json", "[]")
    load_new_files(spark, store, root, memory)
    load_new_files(spark, store, root, memory)
    rejected = store.read("rejected_files").orderBy("batch").collect()
    assert [(Path(r.file).name, r.reason, r.batch) for r in rejected] == [("broken.json", "not JSON", 0), ("empty.json", "no records", 1)]
    counters = {(r.batch, r.outcome): r.records for r in store.read("load_counters").collect()}
    assert counters == {(0, "inserted"): 1, (1, "inserted"): 1, (1, "duplicate"): 1}


RECORD = {
    "transaction_date": f"{DAY}T10:00:00", "product_id": "A", "product_name": "Anvil", "transaction_id": "t1",
    "quantity": 2.0, "unit_price": 3.0, "total_amount": 6.0, "retailer_id": "retailer_1", "category": "Tools",
}


def load_day(spark, folder, day=DAY):
    stamp = F.lit(f"{DAY} 22:00:00").cast("timestamp_ntz")
    return daily.load_day(spark, TableStore(spark, f"{folder}/store"), f"{folder}/raw", day, stamp)


def counted(result):
    return {r["outcome"]: r["records"] for r in result.counters.collect()}


def test_array_and_line_files_load_alike(spark, tmp_path, folder):
    lines = [json.dumps({**RECORD, "transaction_id": f"l{i}"}) for i in range(2)]
    put(tmp_path, "lines 1.json", "\n\n" + "\n".join(lines) + "\n")
    put(tmp_path, "pretty a.json", json.dumps([{**RECORD, "transaction_id": f"p{i}"} for i in range(3)], indent=2))
    put(tmp_path, "one.json", json.dumps([RECORD]))
    put(tmp_path, "broken.json", "[{", "retailer_2")
    put(tmp_path, "other.json", json.dumps([RECORD]), "somebody_else")
    loaded = load_day(spark, folder)
    assert counted(loaded) == {"inserted": 6}
    assert [(Path(r["file"]).name, r["reason"]) for r in loaded.rejected_files.collect()] == [("broken.json", "not JSON")]
    assert loaded.star.fact.where("quantity = 2").count() == 6


def test_unreadable_lines_are_counted(spark, tmp_path, folder):
    put(tmp_path, "a.json", "\n".join([json.dumps(RECORD), "{oops", "", json.dumps({**RECORD, "transaction_id": "t2"})]))
    assert counted(load_day(spark, folder)) == {"inserted": 2, "unreadable": 1}


def test_an_empty_day_harms_nothing(spark, tmp_path, folder):
    assert counted(load_day(spark, folder)) == {}
    put(tmp_path, "a.json", "{oops")
    assert counted(load_day(spark, folder)) == {"unreadable": 1}
    put(tmp_path, "b.json", json.dumps(RECORD), day="month=05/day=03")
    assert counted(load_day(spark, folder, "2024-05-03")) == {"inserted": 1}
    assert counted(load_day(spark, folder, "2024-05-04")) == {}
    assert counted(load_day(spark, folder, "2024-05-03")) == {"duplicate": 1}
    store = TableStore(spark, f"{folder}/store")
    assert store.read("fact_sales").count() == 1 and store.read("processed").count() == 1
    assert landing.list_files(spark, f"{folder}/raw", "2024-05-04").count() == 0


def test_a_failed_feed_is_named_and_its_old_files_stay_out(spark, folder):
    store, root = TableStore(spark, f"{folder}/store"), f"{folder}/raw"
    good = sales(spark, ("o1", f"{DAY} 09:00:00", "A", 1, None))
    daily.land_feeds({"retailer_1": good}, root, DAY)
    broken = good.drop("order_id")
    failed = daily.land_feeds({"retailer_1": broken}, root, DAY)
    loaded = daily.load_day(spark, store, root, DAY, F.lit(f"{DAY} 22:00:00").cast("timestamp_ntz"), without=failed)
    assert list(failed) == ["retailer_1"] and loaded.records.count() == 0


def test_new_files_of_any_kind_are_one_load(spark, tmp_path, folder):
    early, late = {**RECORD, "quantity": 3, "product_name": "Early"}, {**RECORD, "quantity": 7, "product_name": "Late"}
    put(tmp_path, "a.json", json.dumps([late]), day="month=05/day=03")
    put(tmp_path, "a.json", json.dumps(early))
    store = TableStore(spark, f"{folder}/store")
    load_new_files(spark, store, f"{folder}/raw", f"{folder}/seen")
    assert store.read("fact_sales").first()["quantity"] == 3
    assert store.read("dim_products").first()["product_name"] == "Late"


def test_refresh_reports_failures_and_keeps_old_versions(spark, folder, monkeypatch):
    store = TableStore(spark, f"{folder}/store")
    star = star_of(spark, [line(DAY, 1, "t1")], [(1, "A", "Anvil", "Tools")])
    missing = {r["view_name"]: r for r in refresh.verify_views(store).collect()}
    assert missing["mv_weekly_sales_trends"]["issue"] == "View does not exist"
    refresh.refresh_all(star, store)
    assert refresh.view_row_counts(store).count() == 6
    assert refresh.verify_views(store).where("issue is not null").count() == 0

    def broken(_):
        raise RuntimeError("no space")

    monkeypatch.setitem(rollups.ROLLUPS, "mv_weekly_sales_trends", broken)
    with pytest.raises(refresh.RefreshFailed, match="1 out of 6") as caught:
        refresh.refresh_all(star, store)
    assert sum(ok for _, ok, _ in caught.value.status) == 5
    assert store.read("mv_weekly_sales_trends").count() == 1
    with pytest.raises(ValueError, match="Unknown rollup"):
        refresh.refresh_one(star, store, "mv_hourly")


def test_old_versions_are_dropped(spark, folder):
    store = TableStore(spark, f"{folder}/store")
    for n in range(4):
        store.write("t", spark.range(n))
    store.drop_old("t")
    assert len(store.versions("t")) == 2 and store.read("t").count() == 3
    with pytest.raises(LookupError):
        store.read("u")


def test_csv_export(spark, folder):
    star = star_of(spark, [line(DAY, 1, "t1"), line("2023-01-01", 1, "t2")], [(1, "A", "Anvil", "Tools")])
    export.export_csv(rollups.daily_sales_summary(star), f"{folder}/csv", "2024-01-01")
    back = spark.read.option("header", True).csv(f"{folder}/csv")
    assert [r["date"] for r in back.collect()] == [DAY]


def test_shared_folder_is_the_configured_one(spark):
    from tallyhouse.session import shared_dir

    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured
    else:
        assert shared_dir(spark) == shared_dir(spark)


def test_a_large_folder_is_cut_into_arrays(spark, folder):
    rows = [("retailer_1", "2024", "05", "02", f"t{i}") for i in range(1000)] + [("retailer_2", "2024", "05", "02", "t")]
    records = spark.createDataFrame(rows, [*landing.PARTITIONS, "transaction_id"])
    files = landing.chunked(records, F.to_json(F.struct("transaction_id")), 100)
    sizes = [len(r["items"]) for r in files.where("retailer = 'retailer_1'").collect()]
    assert len(sizes) == 10 and sum(sizes) == 1000 and max(sizes) < 200
    value = F.concat(F.lit("["), F.array_join("items", ","), F.lit("]"))
    landing.land_texts(files.withColumn("value", value).coalesce(1), f"{folder}/raw")
    parsed, rejected = landing.parse_files(spark, landing.scan_files(spark, f"{folder}/raw", pattern="*.txt"))
    assert parsed.select("file").distinct().count() == 11 and rejected.count() == 0
    assert sorted(r["record"]["transaction_id"] for r in parsed.collect()) == sorted(r[4] for r in rows)


def test_chunks_are_written_as_lines(spark, folder):
    """Arrays line by line, a file for each chunk, compressed, and in order however small the sorts' memory."""
    rows = [("retailer_1", "2024", "05", "02", f"t{i}") for i in range(1000)] + [("retailer_2", "2024", "05", "02", "t")] * 2
    records = spark.createDataFrame(rows, [*landing.PARTITIONS, "transaction_id"])
    lines = landing.chunk_lines(records, F.to_json(F.struct("transaction_id")), 100)
    value = F.concat(F.when(F.col("place") == 1, "[").otherwise(""), "item", F.when(F.col("last"), "]").otherwise(","))
    landing.land_lines(lines.withColumn("value", value), f"{folder}/raw")
    files = landing.scan_files(spark, f"{folder}/raw", pattern="*.txt.lz4")
    parsed, rejected = landing.parse_files(spark, files)
    assert parsed.select("file").distinct().count() == 11 and rejected.count() == 0
    assert sorted(r["record"]["transaction_id"] for r in parsed.collect()) == sorted(r[4] for r in rows)
    assert landing.list_files(spark, f"{folder}/raw", "2024-05-02", "*.txt.lz4").count() == 11


def test_lines_beside_arrays_do_not_move(spark, tmp_path):
    put(tmp_path, "a.json", json.dumps([RECORD]))
    put(tmp_path, "b.json", json.dumps(RECORD), "retailer_2")
    records, _ = landing.parse_files(spark, landing.scan_files(spark, f"file://{tmp_path}"))
    assert records.count() == 2
    assert "Exchange hashpartitioning" not in records._jdf.queryExecution().executedPlan().toString()


def test_compressed_lines_are_read_as_others(spark, folder):
    rows = [("retailer_1", "2024", "05", "02", str(i)) for i in range(50)]
    records = spark.createDataFrame(rows, [*landing.PARTITIONS, "transaction_id"])
    landing.land(records, f"{folder}/raw", compression="lz4")
    files = landing.scan_files(spark, f"{folder}/raw")
    assert all(r["file"].endswith(".json.lz4") for r in files.select("file").distinct().collect())
    assert {r["record"]["transaction_id"] for r in landing.parse_lines(files).collect()} == {r[4] for r in rows}


def test_landing_needs_no_star(spark, folder, tmp_path):
    from tallyhouse.plans.warehouse import Warehouse

    days = "select 1L o_orderkey, 1L o_custkey, timestamp'2024-05-02' o_orderdate"
    spark.sql(days).write.parquet(f"{folder}/orders.parquet")
    wh = Warehouse(spark, folder)  # lineitem isn't there
    assert wh.first_day == wh.as_of == "2024-05-02" and not wh.store.exists("fact_sales")


def test_the_inventory_parses_each_file_once(spark, tmp_path):
    """And sorts no record; the first record of a file counts, not the first line."""
    put(tmp_path, "a.json", json.dumps([{"a": 1, "b": None}, {"c": 1}, {"c": 2}]))
    put(tmp_path, "b.json", "\n" + "\n".join(['{oops', '{"z": 1}', '{"a": 1}', '{"a": 2}']))
    put(tmp_path, "c.json", "[null, {}]", "retailer_2")
    put(tmp_path, "d.json", "[]", "retailer_2")
    put(tmp_path, "e.json", "  [\n" + json.dumps({"y": 1}) + "]", "retailer_2")
    put(tmp_path, "f.json", "[{", "retailer_3")
    records, rejected = landing.parse_files(spark, landing.scan_files(spark, f"file://{tmp_path}"))
    files = landing.inventory(records.where("record is not null"))
    found = {Path(x.file).name: (x.records, x.record_keys) for x in files.collect()}
    assert found == {"a.json": (3, ["a", "b"]), "b.json": (3, ["z"]), "c.json": (1, []), "e.json": (1, ["y"])}
    assert {Path(x.file).name for x in rejected.collect()} == {"d.json", "f.json"}
    whole = landing.retailer_inventory(files, F.collect_set("record_keys").alias("keys"))
    assert {x.retailer: (x.files, x.records) for x in whole.collect()} == {"retailer_1": (2, 6), "retailer_2": (2, 2)}
    plan = whole.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 2 and plan.count("from_json(ArrayType") == 1
    of_records = plan.split("Union")[0].split("Exchange")[-1]
    assert "HashAggregate" in of_records and "Sort" not in of_records


def test_records_move_to_their_chunk_before_they_become_items(spark):
    rows = [("retailer_1", "2024", "05", "02", f"t{i}", i, None) for i in range(500)]
    records = spark.createDataFrame(rows, "retailer string, year string, month string, day string, t string, n int, o int")
    lines = landing.chunk_lines(records, F.to_json(F.struct("t", "n")), 100)
    made, moved = lines._jdf.queryExecution().executedPlan().toString().split("REPARTITION_BY_NUM")
    assert "AS item#" in made and "AS item#" not in moved
    found = lines.collect()
    assert sorted(json.loads(x.item)["n"] for x in found) == list(range(500))
    chunks = {x.chunk: [y.item for y in sorted(found, key=lambda y: y.place) if y.chunk == x.chunk] for x in found}
    assert len(chunks) == 5 and all(x == sorted(x) for x in chunks.values())
    assert sum(x.last for x in found) == 5 and all(x.place == len(chunks[x.chunk]) for x in found if x.last)


def test_the_mixed_zone_and_the_load_are_made_of_the_same_lines(spark, folder, monkeypatch):
    """The lines are joined once; a line without order or part is in neither."""
    from tallyhouse.plans import queries
    from tallyhouse.sources import tables

    made = {
        "lineitem": ([(1, 1, 3, 1, 5.0, 50.0), (1, 1, 3, 1, 5.0, 50.0), (1, 2, 4, 2, 47.0, 60.0), (1, 9, 5, 3, 7.0, 70.0), (8, 1, 5, 3, 7.0, 70.0)],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double"),
        "orders": ([(1, 7, "2001-08-01")], "o_orderkey bigint, o_custkey bigint, o_orderdate string"),
        "part": ([(1, "anvil", "STEEL"), (2, "bolt", "PROMO")], "p_partkey bigint, p_name string, p_type string"),
    }
    for name, (rows, schema) in made.items():
        df = spark.createDataFrame(rows, schema)
        if name == "orders":
            df = df.withColumn("o_orderdate", df["o_orderdate"].cast("timestamp"))
        df.write.parquet(f"{folder}/{name}.parquet")
    joined, join = [], tables.sales_lines
    monkeypatch.setattr(tables, "sales_lines", lambda *a: joined.append(1) or join(*a))
    found = {tuple(x) for x in queries.process_date_summary(spark, folder).collect()}
    assert found == {("retailer_1", 1, 1, 2, 1), ("retailer_2", 1, 1, 1, 0)} and len(joined) == 1
    first = {tuple(x)[:3] for x in queries.landing_inventory(spark, folder).collect()}
    assert first == {("retailer_1", 1, 2), ("retailer_2", 1, 1)} and len(joined) == 1
