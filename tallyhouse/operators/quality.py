"""Data-quality checks: one set of counts per day gives the numbers of every check.

The checks take a range of days, so one run can check a single day (the nightly job) or every day
loaded so far; a day without facts still gets its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.aggregate import total_with_distincts
from tallyhouse.operators.analytics import Day, as_day, sales_between
from tallyhouse.schemas import Star

MAX_DAYS_OLD = 7
CRITICAL = ("quantity", "unit_price", "total_amount", "product_id", "retailer_id")


def _calendar(star: Star, start: Day, end: Day) -> DataFrame:
    """Every calendar day of the range."""
    first, last = F.lit(as_day(start)), F.lit(as_day(end))
    one = star.fact.sparkSession.range(1)
    return one.select(F.explode(F.sequence(first, last)).alias("date"))


def _orphans(lines: DataFrame, dimension: DataFrame, key: str, name: str) -> DataFrame:
    """Per day the number of facts whose key is in no dimension row; a null key is in none."""
    unmatched = lines.select("date", key).join(dimension.select(key), key, "left_anti")
    return unmatched.groupBy("date").agg(F.count("*").alias(name))


def day_metrics(star: Star, start: Day, end: Day) -> DataFrame:
    """Per day of the range: row count, nulls, rule violations and orphans.

    Counts need no join and shrink to one row per day and task before their shuffle. Orphans are
    found by anti joins that read two columns and, while a dimension is small enough to be
    broadcast, do not shuffle facts either.
    """
    lines = sales_between(star, start, end)
    gap = F.abs(F.col("total_amount") - F.col("quantity") * F.col("unit_price"))
    per_day = lines.groupBy("date").agg(
        F.count("*").alias("total_records"),
        *[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in CRITICAL],
        F.count_if(gap > 0.01).alias("rule_violations"),
    )
    products = _orphans(lines, star.products, "product_id", "orphaned_product")
    retailers = _orphans(lines, star.retailers, "retailer_id", "orphaned_retailer")
    return (
        _calendar(star, start, end)
        .join(per_day, "date", "left")
        .join(products, "date", "left")
        .join(retailers, "date", "left")
        .na.fill(0)
    )


def _details(*names: str) -> Column:
    return F.create_map(*[
        part for name in names for part in (F.lit(name), F.col(name).cast("string"))
    ])


def _result(name: str, passed: Column, message: Column, details: Column) -> Column:
    empty = F.col("total_records") == 0
    no_rows = F.concat(F.lit("No records found for "), F.date_format("date", "yyyy-MM-dd"))
    return F.struct(
        F.lit(name).alias("check_name"),
        (passed & ~empty).alias("passed"),
        F.when(empty, no_rows).otherwise(message).alias("message"),
        F.when(empty, _details("total_records")).otherwise(details).alias("details"),
    )


def _record_count() -> Column:
    day = F.date_format("date", "yyyy-MM-dd")
    return F.struct(
        F.lit("record_count").alias("check_name"),
        (F.col("total_records") > 0).alias("passed"),
        F.concat(
            F.lit("Record count check: "), F.col("total_records"), F.lit(" records found for "), day
        ).alias("message"),
        F.create_map(
            F.lit("record_count"), F.col("total_records").cast("string"), F.lit("date"), day
        ).alias("details"),
    )


def _completeness() -> Column:
    nulls = [f"null_{name}" for name in CRITICAL]
    clean = F.lit(True)
    for name in nulls:
        clean = clean & (F.col(name) == 0)
    listing = F.concat_ws(", ", *[
        F.concat(F.lit(f"{name}: "), F.col(f"null_{name}")) for name in CRITICAL
    ])
    found = F.when(clean, "No null values in critical fields").otherwise(
        F.concat(F.lit("Found nulls - "), listing)
    )
    message = F.concat(
        F.lit("Data completeness check: "), F.col("total_records"), F.lit(" records, "), found
    )
    return _result("data_completeness", clean, message, _details("total_records", *nulls))


def _business_rules() -> Column:
    clean = F.col("rule_violations") == 0
    message = F.concat(
        F.lit("Business rules check: "), F.col("total_records"), F.lit(" records, "),
        F.col("rule_violations"), F.lit(" violations found"),
        F.when(clean, "").otherwise(" (total_amount != quantity * unit_price)"),
    )
    return _result("business_rules", clean, message, _details("total_records", "rule_violations"))


def _referential_integrity() -> Column:
    clean = (F.col("orphaned_product") == 0) & (F.col("orphaned_retailer") == 0)
    found = F.when(clean, ", All foreign keys valid").otherwise(
        F.concat(
            F.lit(", Found orphaned records - product: "), F.col("orphaned_product"),
            F.lit(", retailer: "), F.col("orphaned_retailer"),
        )
    )
    message = F.concat(
        F.lit("Referential integrity check: "), F.col("total_records"), F.lit(" records"), found
    )
    return _result(
        "referential_integrity", clean, message,
        _details("total_records", "orphaned_product", "orphaned_retailer"),
    )


def _freshness(as_of: Day) -> Column:
    age = F.datediff(F.lit(as_day(as_of)), "date")
    fresh = age <= MAX_DAYS_OLD
    message = F.concat(
        F.lit("Data freshness check: Data is "), age, F.lit(" days old"),
        F.when(fresh, "").otherwise(f" (exceeds maximum of {MAX_DAYS_OLD} days)"),
    )
    return F.struct(
        F.lit("data_freshness").alias("check_name"),
        fresh.alias("passed"),
        message.alias("message"),
        F.create_map(
            F.lit("target_date"), F.date_format("date", "yyyy-MM-dd"),
            F.lit("days_old"), age.cast("string"),
            F.lit("max_days_old"), F.lit(str(MAX_DAYS_OLD)),
        ).alias("details"),
    )


def _checks(metrics: DataFrame, *checks: Column, latest: bool = False) -> DataFrame:
    if latest:
        checks = tuple(_with_latest(x) for x in checks)
    return metrics.select("date", F.explode(F.array(*checks)).alias("c")).select("date", "c.*")


def check_record_count(star: Star, start: Day, end: Day) -> DataFrame:
    """Pass if the day has facts."""
    return _checks(day_metrics(star, start, end), _record_count())


def check_completeness(star: Star, start: Day, end: Day) -> DataFrame:
    """Pass if no critical column is null."""
    return _checks(day_metrics(star, start, end), _completeness())


def check_business_rules(star: Star, start: Day, end: Day) -> DataFrame:
    """Pass if every amount is quantity times price, within a cent."""
    return _checks(day_metrics(star, start, end), _business_rules())


def check_referential_integrity(star: Star, start: Day, end: Day) -> DataFrame:
    """Pass if every product and retailer key has its dimension row."""
    return _checks(day_metrics(star, start, end), _referential_integrity())


def check_freshness(star: Star, start: Day, end: Day, as_of: Day) -> DataFrame:
    """Pass if the day is at most seven days before ``as_of``; with the newest date of the facts by then.

    The days with facts, and the calendar, have 366 rows a year at most.
    """
    known = sales_between(star, None, end).select(F.col("date").alias("latest")).distinct()
    days = _calendar(star, start, end).select("date", F.lit(None).cast("date").alias("latest"))
    both = days.unionByName(known.select(F.col("latest").alias("date"), "latest"))
    by_day = Window.partitionBy(F.lit(1)).orderBy("date")
    newest = both.groupBy("date").agg(F.max("latest").alias("latest")).withColumn(
        "latest", F.max("latest").over(by_day)
    )
    checks = _checks(newest.where(F.col("date") >= F.lit(as_day(start))), _freshness(as_of), latest=True)
    return checks


def _with_latest(check: Column) -> Column:
    latest = F.create_map(F.lit("latest_date"), F.date_format("latest", "yyyy-MM-dd"))
    return check.withField("details", F.map_concat(check["details"], latest))


def latest_by_retailer(star: Star, target: Day, as_of: Day) -> DataFrame:
    """Per retailer the newest fact date up to ``target`` and its age: freshness of the data."""
    newest = (
        sales_between(star, None, target).groupBy("retailer_id").agg(F.max("date").alias("latest"))
    )
    age = F.datediff(F.lit(as_day(as_of)), "latest")
    return (
        star.retailers.select("retailer_id", "retailer_name")
        .join(newest, "retailer_id", "left")
        .select(
            "retailer_name",
            F.col("latest").alias("latest_date"),
            age.alias("days_old"),
            F.coalesce(age <= MAX_DAYS_OLD, F.lit(False)).alias("passed"),
        )
    )


def run_all_checks(star: Star, start: Day, end: Day, as_of: Day) -> DataFrame:
    """The five checks of every day, from one set of counts."""
    return _checks(
        day_metrics(star, start, end),
        _record_count(), _completeness(), _business_rules(), _referential_integrity(),
        _freshness(as_of),
    )


def summarize_checks(results: DataFrame) -> DataFrame:
    """Per day: number of checks, how many passed and failed, and whether all passed."""
    return results.groupBy("date").agg(
        F.count("*").alias("total_checks"),
        F.count_if(F.col("passed")).alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.every(F.col("passed")).alias("all_passed"),
    )


class QualityCheckFailed(Exception):
    """A day did not pass its checks, so its rollups must not be refreshed."""


def require_passed(results: DataFrame) -> None:
    """Raise if any check failed; names the first twenty and says how many more there are."""
    failed = results.where(~F.col("passed"))
    named = failed.orderBy("date", "check_name").limit(20).collect()
    if named:
        texts = [f"{r.date} {r.check_name}: {r.message}" for r in named]
        more = failed.count() - len(named) if len(named) == 20 else 0
        raise QualityCheckFailed("; ".join([*texts, *[f"and {more} more"] * bool(more)]))


def _range_counts(star: Star, start: Day, end: Day) -> tuple[DataFrame, list[Column]]:
    lines = sales_between(star, start, end)
    amount = F.col("total_amount")
    return lines, [
        F.count("*").alias("total_records"),
        F.count("customer_id").alias("records_with_customer"),
        F.count("store_id").alias("records_with_store"),
        F.count_if(amount.isNull() | (amount == 0)).alias("null_or_zero_amounts"),
        F.count_if(amount < 0).alias("negative_amounts"),
        F.count_if(F.col("quantity") <= 0).alias("zero_quantities"),
    ]


def _percentage(part: str) -> Column:
    exact = F.col(part).cast("decimal(20,0)") / F.col("total_records").cast("decimal(20,0)") * 100
    return F.when(F.col("total_records") > 0, exact.cast("decimal(7,2)")).otherwise(
        F.lit(0).cast("decimal(7,2)")
    )


def quality_report(star: Star, start: Day, end: Day) -> DataFrame:
    """One row: completeness, transactions, potential duplicates and suspicious amounts.

    A duplicate is a repeated (transaction, product, retailer); as a struct it counts even when a
    member is null.
    """
    lines, counts = _range_counts(star, start, end)
    lines = lines.withColumn("line_key", F.struct("transaction_id", "product_id", "retailer_id"))
    row = total_with_distincts(
        lines, counts, {"unique_transactions": "transaction_id", "unique_lines": "line_key"}
    )
    return row.select(
        "total_records",
        "records_with_customer",
        _percentage("records_with_customer").alias("customer_percentage"),
        "records_with_store",
        _percentage("records_with_store").alias("store_percentage"),
        "unique_transactions",
        (F.col("total_records") - F.col("unique_lines")).alias("potential_duplicates"),
        "null_or_zero_amounts",
        "negative_amounts",
        "zero_quantities",
    )


def quality_summary(star: Star, start: Day, end: Day) -> DataFrame:
    """The same as seven rows of name, value and percentage, from one pass."""
    lines, counts = _range_counts(star, start, end)
    row = total_with_distincts(lines, counts, {"unique_transactions": "transaction_id"})
    none = F.lit(None).cast("decimal(7,2)")

    def metric(name: str, percentage: Column) -> Column:
        return F.struct(
            F.lit(name).alias("metric_name"),
            F.col(name).alias("metric_value"),
            percentage.alias("metric_percentage"),
        )

    rows = F.array(
        metric("total_records", none),
        metric("records_with_customer", _percentage("records_with_customer")),
        metric("records_with_store", _percentage("records_with_store")),
        metric("unique_transactions", none),
        metric("null_or_zero_amounts", _percentage("null_or_zero_amounts")),
        metric("negative_amounts", _percentage("negative_amounts")),
        metric("zero_quantities", _percentage("zero_quantities")),
    )
    return row.select(F.explode(rows).alias("m")).select("m.*")
