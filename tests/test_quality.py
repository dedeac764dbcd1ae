"""Quality checks: each failure, days without facts, single pass."""

import pytest

from tallyhouse.operators import quality
from tests.stars import line, star_of

PRODUCTS = [(1, "A", "Anvil", "Tools")]
DAY = "2024-05-02"


def results(df):
    return {r["check_name"]: r for r in df.collect()}


def test_clean_day_passes(spark):
    star = star_of(spark, [line(DAY, 1, "t1", quantity=2, price="3.00")], PRODUCTS)
    found = results(quality.run_all_checks(star, DAY, DAY, DAY))
    assert all(r["passed"] for r in found.values()) and len(found) == 5
    quality.require_passed(quality.run_all_checks(star, DAY, DAY, DAY))


def test_day_without_facts_fails(spark):
    star = star_of(spark, [line("2024-05-01", 1, "t1")], PRODUCTS)
    found = results(quality.run_all_checks(star, DAY, DAY, DAY))
    assert [name for name, r in found.items() if r["passed"]] == ["data_freshness"]
    assert found["business_rules"]["message"] == "No records found for 2024-05-02"
    assert found["business_rules"]["details"] == {"total_records": "0"}
    with pytest.raises(quality.QualityCheckFailed, match="record_count"):
        quality.require_passed(quality.run_all_checks(star, DAY, DAY, DAY))


def test_each_problem_is_found(spark):
    lines = [
        line(DAY, 1, "t1", quantity=None, price="1.00", amount="1.00"),
        line(DAY, 1, "t2", quantity=2, price="1.00", amount="2.02"),
        line(DAY, 1, "t3", quantity=2, price="1.00", amount="2.01"),
        line(DAY, 99, "t4"),
        line(DAY, 1, "t5", retailer=7),
        line(DAY, None, "t6"),
    ]
    found = results(quality.run_all_checks(star_of(spark, lines, PRODUCTS), DAY, DAY, DAY))
    assert found["data_completeness"]["message"] == (
        "Data completeness check: 6 records, Found nulls - quantity: 1, unit_price: 0, "
        "total_amount: 0, product_id: 1, retailer_id: 0"
    )
    assert found["business_rules"]["details"]["rule_violations"] == "1"
    assert found["referential_integrity"]["details"] == {
        "total_records": "6", "orphaned_product": "2", "orphaned_retailer": "1",
    }


def test_freshness_only_looks_back(spark):
    star = star_of(spark, [line(DAY, 1, "t1")], PRODUCTS)
    ages = {day: results(quality.check_freshness(star, DAY, DAY, day))["data_freshness"]["passed"]
            for day in ("2024-05-01", "2024-05-09", "2024-05-10")}
    assert ages == {"2024-05-01": True, "2024-05-09": True, "2024-05-10": False}


def test_report_counts_tuples_with_null_members(spark):
    lines = [line(DAY, None, "t1"), line(DAY, None, "t1"), line(DAY, None, "t2"),
             line(DAY, 1, "t2", amount="0.00", customer=None),
             line(DAY, 1, "t3", quantity=-1, amount="-1.00", store=None)]
    row = quality.quality_report(star_of(spark, lines, PRODUCTS), DAY, DAY).first()
    assert (row["total_records"], row["potential_duplicates"]) == (5, 1)
    assert (row["null_or_zero_amounts"], row["negative_amounts"], row["zero_quantities"]) == (1, 1, 1)
    assert float(row["customer_percentage"]) == 80.0
    summary = quality.quality_summary(star_of(spark, lines, PRODUCTS), DAY, DAY).collect()
    assert len(summary) == 7 and summary[0]["metric_percentage"] is None


def test_report_of_an_empty_range(spark):
    star = star_of(spark, [line(DAY, 1, "t1")], PRODUCTS)
    row = quality.quality_report(star, "2020-01-01", "2020-01-01").first()
    assert (row["total_records"], float(row["store_percentage"])) == (0, 0.0)


def test_latest_by_retailer(spark):
    star = star_of(spark, [line("2024-04-01", 1, "t1", 1), line(DAY, 1, "t2", 2)], PRODUCTS)
    found = {r["retailer_name"]: r for r in quality.latest_by_retailer(star, DAY, DAY).collect()}
    assert [found[f"Retailer {i}"]["passed"] for i in (1, 2, 3)] == [False, True, False]
