"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry
from oracle_queries import ORACLE
from tallyhouse.plans.queries import QUERIES
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    text, _, _ = difference(spark, duck, FOLDER, QUERIES[name], ORACLE[name])
    assert text == ""


def test_entry(spark):
    assert entry(spark).count() > 0


OF_THE_SPAN = (
    "scan_source_2", "sales_summary", "sales_trends_monthly", "top_products_90d", "retailer_performance",
    "dq_record_count", "dq_report_30d", "rpt_daily_dashboard", "rpt_weekly_trends", "panel_daily_revenue",
    "doc_daily_one_retailer", "doc_quarterly_year", "doc_top_current_month", "doc_retailers_last_quarter",
)


def test_the_span_is_that_of_the_tables(spark, folder):
    """The same tables eleven years later: no sale drops out of the ranges."""
    for name in ("lineitem", "part", "orders"):
        table = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        if name == "orders":
            day = F.col("o_orderdate")
            moved = (F.to_date(day) + F.lit(4018)).cast(dict(table.dtypes)["o_orderdate"])
            table = table.withColumn("o_orderdate", moved)
        table.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    con = duckdb.connect()
    for name in ("lineitem", "part", "orders"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder.removeprefix('file://')}/{name}.parquet/*.parquet'")
    found = {}
    for name in OF_THE_SPAN:
        text, _, found[name] = difference(spark, con, folder, QUERIES[name], ORACLE[name])
        assert text == "", name
    assert all(found[x] for x in ("sales_summary", "rpt_daily_dashboard", "doc_quarterly_year", "doc_top_current_month"))
