"""Dimensions, facts and reruns on hand-made records."""

import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import aggregate, dims, facts, merge, normalize, validate
from tallyhouse.plans import daily, queries
from tallyhouse.plans.store import TableStore
from tallyhouse.schemas import FEED_BY_CODE

GOOD = {
    "transaction_date": "2024-05-02T10:00:00", "product_id": "A", "product_name": "Anvil",
    "transaction_id": "t1", "quantity": "2", "unit_price": "3.00", "total_amount": "6.00",
    "retailer_id": "retailer_1", "category": "Tools", "customer_id": "c1", "store_id": "s1",
}


def record(*drop, **changes):
    return {k: v for k, v in {**GOOD, **changes}.items() if k not in drop}


def parsed(spark, records):
    rows = [(position, r) for position, r in enumerate(records)]
    df = spark.createDataFrame(rows, "position bigint, record map<string,string>")
    return df.withColumn("load_seq", F.struct("position"))


def load(spark, store, records, hour=2):
    typed = validate.typed_records(parsed(spark, records), "load_seq")
    return daily.load_records(store, typed, F.lit(f"2024-05-03 {hour:02d}:00:00").cast("timestamp_ntz"))


def counters(result):
    return {r["outcome"]: r["records"] for r in result.counters.collect()}


@pytest.fixture
def store(spark, folder):
    return TableStore(spark, f"{folder}/store")


def test_first_fact_wins_and_last_product_wins(spark, store):
    result = load(spark, store, [
        record(quantity="2"),
        record(quantity="9", product_name="Big anvil", category=None),
    ])
    assert counters(result) == {"inserted": 1, "duplicate": 1}
    assert result.star.fact.first()["quantity"] == 2
    product = result.star.products.first()
    assert (product["product_name"], product["category"]) == ("Big anvil", None)


def test_reload_adds_nothing_and_keeps_keys(spark, store):
    records = [record(), record(transaction_id="t2", product_id="B", product_name="Bolt")]
    first = load(spark, store, records)
    keys = {r["product_sku"]: r["product_id"] for r in first.star.products.collect()}
    again = load(spark, store, records, hour=3)
    assert counters(again) == {"duplicate": 2}
    assert again.star.fact.count() == 2
    assert {r["product_sku"]: r["product_id"] for r in again.star.products.collect()} == keys
    product = again.star.products.first()
    assert product["created_at"] < product["updated_at"]
    for frame in (again.star.customers, again.star.stores, again.star.dates):
        assert frame.count() == 1


def _part_files(store):
    """The files of the product table as it stands, by bucket."""
    out = {}
    for path in store.read("dim_products").inputFiles():
        out.setdefault(path.rsplit("/", 2)[1], set()).add(path)
    return out


def test_products_seen_again_rewrite_their_buckets_alone(spark, store):
    many = [record(transaction_id=f"t{i}", product_id=f"P{i}", product_name=f"Part {i}") for i in range(300)]
    first = load(spark, store, many)
    keys = {r["product_sku"]: r["product_id"] for r in first.star.products.collect()}
    assert len(set(keys.values())) == 300 and min(keys.values()) > 0
    before = _part_files(store)
    changed = [record(transaction_id=f"u{i}", product_id=f"P{i}", product_name="New") for i in range(0, 50, 5)]
    again = load(spark, store, [*changed, record(transaction_id="u", product_id="Q", product_name="Q")], hour=3)
    after = _part_files(store)
    skus = [*(f"P{i}" for i in range(0, 50, 5)), "Q"]
    rows = spark.createDataFrame([(x,) for x in skus], "product_sku string")
    touched = {f"bucket={r['bucket']}" for r in dims.in_buckets(rows).collect()}
    assert {x for x in after if after[x] != before.get(x)} == touched and len(touched) < len(after)
    products = {r["product_sku"]: r for r in again.star.products.collect()}
    assert "bucket" not in again.star.products.columns and len(products) == 301
    assert {x: products[x]["product_id"] for x in keys} == keys
    assert products["Q"]["product_id"] > max(keys.values())
    assert {x for x in products if products[x]["product_name"] in ("New", "Q")} == set(skus)
    assert {x for x in keys if products[x]["updated_at"] > products[x]["created_at"]} == set(skus) - {"Q"}


def test_a_product_table_without_buckets_is_taken_over(spark, store):
    old = spark.createDataFrame(
        [(7, "A", "Old", None), (9, "Z", "Zinc", "Metal")],
        "product_id bigint, product_sku string, product_name string, category string",
    )
    stamp = F.lit("2024-05-01 00:00:00").cast("timestamp_ntz")
    store.write("dim_products", old.withColumns({"created_at": stamp, "updated_at": stamp}))
    result = load(spark, store, [record(), record(transaction_id="t2", product_id="B", product_name="Bolt")])
    products = {r["product_sku"]: (r["product_id"], r["product_name"]) for r in result.star.products.collect()}
    assert products["A"] == (7, "Anvil") and products["Z"] == (9, "Zinc") and products["B"][0] > 9
    nothing = load(spark, store, [], hour=4)
    assert nothing.star.products.count() == 3


def test_new_keys_lie_above_the_old(spark, store):
    load(spark, store, [record()])
    old = store.read("dim_products").first()["product_id"]
    result = load(spark, store, [record(product_id="B", transaction_id="t2", customer_id="c2")])
    ids = [r["product_id"] for r in result.star.products.orderBy("product_id").collect()]
    assert ids[0] == old and ids[1] > old
    customers = [r["customer_id"] for r in result.star.customers.collect()]
    assert len(set(customers)) == 2


def test_rejects_and_what_they_leave_behind(spark, store):
    result = load(spark, store, [
        record(),
        record("quantity", transaction_id="t2", product_id="gone"),
        record(transaction_date="soon", transaction_id="t3", product_id="gone"),
        record(transaction_date="2024-05", transaction_id="t3", product_id="gone"),
        record(retailer_id="retailer_9", transaction_id="t4", product_id="B", customer_id="c9"),
        record(quantity=None, transaction_id="t5", product_id="C"),
        record(product_name=None, transaction_id="t6", product_id="D", customer_id="c6",
               transaction_date="2024-06-01"),
    ])
    assert counters(result) == {
        "inserted": 1, "missing_fields": 1, "bad_date": 2, "unknown_retailer": 1, "constraint": 2,
    }
    assert {r[0] for r in result.star.products.select("product_sku").collect()} == {"A", "B", "C"}
    assert {r[0] for r in result.star.customers.select("customer_external_id").collect()} == {
        "c1", "c9"}
    assert result.star.dates.count() == 2


def test_blank_ids_and_missing_category(spark, store):
    result = load(spark, store, [
        record("category", customer_id="", store_id=None),
        record("customer_id", transaction_id="t2", category=None, product_id="B"),
    ])
    facts_ = result.star.fact.collect()
    assert [r["customer_id"] for r in facts_] == [None, None]
    assert result.star.customers.count() == 0
    categories = {r["product_sku"]: r["category"] for r in result.star.products.collect()}
    assert categories == {"A": "", "B": None}


def test_amounts_are_rounded_half_up(spark, store):
    result = load(spark, store, [record(unit_price="2.675", total_amount="5.345")])
    row = result.star.fact.first()
    assert (row["unit_price"], row["total_amount"]) == (Decimal("2.68"), Decimal("5.35"))


def test_dominant_key_in_a_batch(spark, store):
    rng = random.Random(3)
    records = [record(quantity=str(i + 1)) for i in range(600)]
    records += [
        record(transaction_id=f"t{rng.randrange(300)}", product_id=f"P{rng.randrange(20)}",
               customer_id=f"c{rng.randrange(9)}")
        for _ in range(1200)
    ]
    want = {}
    for r in records:
        want.setdefault((r["transaction_id"], r["product_id"]), int(r["quantity"]))
    result = load(spark, store, records)
    named = result.star.fact.join(result.star.products, "product_id").collect()
    assert {(r["transaction_id"], r["product_sku"]): r["quantity"] for r in named} == want


def test_first_wins_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = aggregate.first_wins(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning") > plan.index("Final")


def test_messages_of_missing_fields(spark):
    errors = validate.missing_field_errors(
        parsed(spark, [record(), record("transaction_id", "transaction_date")])
    )
    assert [r["error"] for r in facts.first_errors(errors).collect()] == [
        "Record 1: Missing required fields: ['transaction_date', 'transaction_id']"
    ]


def test_insert_if_absent(spark):
    existing = spark.createDataFrame([("a", 1)], "k string, v int")
    incoming = spark.createDataFrame([("a", 2), ("b", 3), ("b", 4)], "k string, v int")
    added = merge.insert_if_absent(existing, incoming, "k", ["v"])
    assert [tuple(r) for r in added.collect()] == [("b", 3)]


def test_retailer_seed_keeps_what_is_there(spark):
    existing = spark.createDataFrame(
        [(1, "retailer_1", "Renamed")], "retailer_id int, retailer_code string, retailer_name string"
    )
    found = {r["retailer_code"]: r["retailer_name"] for r in dims.seed_retailers(spark, existing).collect()}
    assert found == {"retailer_1": "Renamed", "retailer_2": "Retailer 2", "retailer_3": "Retailer 3"}


def test_normalize_missing_null_and_unreadable(spark):
    raw = [
        {"order_id": "o1", "sku": "A", "quantity": "2", "price": "1.5", "total": "3",
         "order_date": "2024-05-02T10:00:00"},
        {},
        {"order_id": None, "quantity": "two"},
        {"order_id": None, "category": None},
        {"order_date": "2024"},
        {"price": None},
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, record map<string,string>")
    now = F.lit("2024-01-01 00:00:00")
    out = normalize.normalize_maps(df, FEED_BY_CODE["retailer_1"], now)
    good = {r["i"]: r for r in normalize.accepted(out, "i").collect()}
    assert sorted(good) == [0, 1, 3]
    assert (good[1]["transaction_id"], good[1]["quantity"], good[1]["category"]) == ("", 0, "")
    assert str(good[1]["transaction_date"]) == "2024-01-01 00:00:00"
    assert (good[3]["transaction_id"], good[3]["category"]) == ("None", None)
    assert sorted(r["i"] for r in normalize.rejected(out).collect()) == [2, 4, 5]


def test_iso_times(spark):
    texts = ["2024-05-02", "2024-05-02 10:11:12.123456", "2024-05-02T10:11:12+05:00", "2024-02-30",
             "2024-5-2", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [r[0] for r in df.select(normalize.iso_timestamp(F.col("t")).cast("string")).collect()]
    assert out == ["2024-05-02 00:00:00", "2024-05-02 10:11:12.123456", "2024-05-02 10:11:12",
                   None, None, None, None]


def test_repeated_records_and_their_order_stay_out_of_the_joins(spark, store):
    records = [record(), record(), record(transaction_id="t2", retailer_id="retailer_9"), record(transaction_id="t3")]
    loaded = load(spark, store, records)
    assert counters(loaded) == {"inserted": 2, "duplicate": 1, "unknown_retailer": 1}
    new = facts.new_facts(loaded.records.where("status = 'valid'"), loaded.star, None, F.lit(None).cast("timestamp_ntz"))
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Join") < plan.index("Window") < plan.index("REPARTITION_BY_NUM")
    assert "load_seq" not in plan[: plan.index("Window")]


def test_only_records_that_share_a_key_move_for_the_first(spark, store, monkeypatch):
    rows = [(f"t{i}", "p" if i % 2 else None, i, i % 7) for i in range(200)] + [("t1", "p", 0, 9), ("t2", None, 1, 9), ("t2", None, 0, 8)]
    df = store.write("rows", spark.createDataFrame(rows, "k string, l string, o int, v int"))
    first = sorted(map(tuple, aggregate.first_wins(df, ["k", "l"], ["o"]).collect()), key=str)
    found = aggregate.first_wins_if_repeated(df, ["k", "l"], ["o"])
    assert len(first) == 200 and sorted(map(tuple, found.collect()), key=str) == first
    above, other = found._jdf.queryExecution().optimizedPlan().toString().split("LeftAnti")
    assert "RepartitionByExpression" in above and "RepartitionByExpression" not in other
    alone = df.where("v < 7")  # no key repeats, so no row moves
    plan = aggregate.first_wins_if_repeated(alone, ["k", "l"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    monkeypatch.setattr(aggregate, "MOST_REPEATED", 1)
    found = aggregate.first_wins_if_repeated(df, ["k", "l"], ["o"])
    assert sorted(map(tuple, found.collect()), key=str) == first and "LeftAnti" not in found._jdf.queryExecution().toString()


@pytest.mark.parametrize("most", [0, 200_000])
def test_the_last_product_is_found_without_sorting_all_records(spark, store, monkeypatch, most):
    random.seed(3)
    rows = [
        (f"s{random.randrange(40)}", random.choice(["a", "b", None]), random.choice(["x", None]), (random.randrange(4), i))
        for i in range(400)
    ] + [("once", "a", "x", (0, 900)), ("late", "a", "x", (0, 901)), ("late", "b", None, (9, 902)), (None, "a", "x", (9, 903))]
    schema = "product_id string, product_name string, category string, load_seq struct<day:int,place:int>"
    df = store.write("rows", spark.createDataFrame(rows, schema))
    monkeypatch.setattr(dims, "MOST_UNCLEAR", most)
    last = sorted(map(tuple, dims.latest_products(df).collect()))
    found = dims.latest_products(df, written=True)
    assert ("late", "b", None) in [x[:3] for x in last] and sorted(map(tuple, found.collect()), key=str) == sorted(last, key=str)
    clear = dims.latest_products(df.where("product_id in ('once', 'late')"), written=True)
    plan = clear._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan if most else "SortAggregate" in found._jdf.queryExecution().executedPlan().toString()


def test_shuffles_go_when_their_table_is_written(spark, store):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {x for x in files.split("\n") if "shuffle_" in x}

    moved = spark.range(10_000).repartition(4, "id").withColumn("p", F.lit(1))
    before = shuffled()
    store.write("t", moved, ["p"])
    store.append("t", moved, ["p"])
    assert store.read("t").count() == 20_000
    assert store.replace_parts("t", moved, ["p"], [(1,)]).count() == 10_000
    assert not {x for x in shuffled() - before if x.endswith(".data") and os.path.getsize(x) > 10_000}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_loading_writes_no_second_copy_of_the_raw_records(spark, folder):
    made = {
        "lineitem": ([(1, 1, 3, 1, 5.0, 50.0), (1, 2, 4, 2, 6.0, 60.0)], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double"),
        "orders": ([(1, 7, "1998-03-01")], "o_orderkey bigint, o_custkey bigint, o_orderdate string"),
        "part": ([(1, "anvil", "STEEL"), (2, "bolt", "PROMO")], "p_partkey bigint, p_name string, p_type string"),
    }
    for name, (rows, schema) in made.items():
        df = spark.createDataFrame(rows, schema)
        if name == "orders":
            df = df.withColumn("o_orderdate", df["o_orderdate"].cast("timestamp"))
        df.write.parquet(f"{folder}/{name}.parquet")
    found = {tuple(x) for x in queries.dim_surrogate_keys(spark, folder).collect()}
    assert found == {("product", 2, 2, True, 0), ("customer", 1, 1, True, 0), ("store", 2, 2, True, 0)}
    assert not queries.warehouse(spark, folder).store.exists("raw_maps")


def test_facts_do_not_meet_by_retailer(spark, store, monkeypatch):
    """The retailers that facts refer to come from three numbers a task, not from a join with all facts."""
    loaded = load(spark, store, [record(transaction_id=f"t{i}", retailer_id=f"retailer_{1 + i % 2}") for i in range(6)])
    monkeypatch.setattr(queries, "_loaded", lambda *_: loaded)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = queries.dim_retailer(spark, "")
        plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
        assert sorted(x.retailer_id for x in found.collect()) == [1, 2, 3]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    of_facts = [i for i, x in enumerate(plan) if "FileScan" in x and "month_id" in x]
    assert of_facts
    for i in of_facts:
        moved = max(k for k in range(i) if "Exchange" in plan[k])
        assert any("HashAggregate" in x for x in plan[moved:i])
