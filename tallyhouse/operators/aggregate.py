"""Grouping and first-row-wins helpers that stay balanced when one key dominates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.session import dropping_shuffles

#: So many hashes of repeated keys are sent to all tasks at most: 16 MB as rows.
MOST_REPEATED = 1_000_000


def spread(df: DataFrame, *by: str | Column) -> DataFrame:
    """The rows moved once, as they are, so that those with equal ``by`` are in one task.

    Windows, groups and joins by these and further columns need no other shuffle then, and no map task
    holds a sort or groups of its own, which outgrow its memory as tables grow. There are as many parts
    as ``spark.sql.shuffle.partitions`` says: AQE would join them by their compressed size.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def group_with_distincts(
    df: DataFrame, keys: Sequence[str], measures: Sequence[Column], distincts: dict[str, str]
) -> DataFrame:
    """Group by non-null ``keys`` with plain measures and exact distinct counts.

    The first distinct count shares the measures' scan: Spark aggregates by (keys, value) and then
    by keys, so a dominant key is spread over its values. Every other count is an aggregation of its own, whose shuffle holds nothing but (keys, value);
    in one aggregation several distinct counts would copy each row. The results are partitioned by
    ``keys`` already, one row per group, and joined.
    """
    (name, column), *others = distincts.items()
    out = df.groupBy(*keys).agg(*measures, F.count_distinct(column).alias(name))
    for name, column in others:
        counted = df.groupBy(*keys).agg(F.count_distinct(column).alias(name))
        out = out.join(counted, list(keys))
    return out


def products_per_group(lines: DataFrame, products: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``unique_products`` per group, for lines whose product is in ``products``.

    ``keys`` may name columns of ``products``, such as the category. A product is reduced to one
    row per group before the join, so a product with a third of all sales is no larger there than
    any other.
    """
    own = [key for key in keys if key in lines.columns]
    seen = lines.select(*own, "product_id").distinct()
    counted = seen.join(products, "product_id").groupBy(*keys)
    return counted.agg(F.count("*").alias("unique_products"))


def total_with_distincts(
    df: DataFrame, measures: Sequence[Column], distincts: dict[str, str]
) -> DataFrame:
    """The same over the whole frame: one row, each further distinct count a scalar subquery."""
    (first, column), *others = distincts.items()
    counts = [df.agg(F.count_distinct(c)).scalar().alias(name) for name, c in others]
    return df.agg(*measures, F.count_distinct(column).alias(first)).select("*", *counts)


def first_wins_if_repeated(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """:func:`first_wins` for keys that seldom repeat: a row whose key no other row has stays where it is.

    The keys' 64-bit hashes move once, alone. Those that occur again (equal keys, or others by chance) are
    sent to all tasks, and only their rows move and are ranked. With more than MOST_REPEATED of them all rows
    move. That is asked at once, so ``df`` is read three times: pass a written table.
    """
    spark, mark = df.sparkSession, F.xxhash64(*keys)
    marks = spread(df.select(mark.alias("mark")), "mark").groupBy("mark").agg(F.count("*").alias("rows"))
    with dropping_shuffles(spark):
        found = marks.where("rows > 1").select("mark").limit(MOST_REPEATED + 1).collect()
    if not found:
        return df
    if len(found) > MOST_REPEATED:
        return first_wins(spread(df, *keys), keys, order)
    repeated = F.broadcast(spark.createDataFrame(found, "mark long"))
    ranked = first_wins(spread(df.join(repeated, mark == repeated["mark"], "left_semi"), *keys), keys, order)
    return ranked.unionByName(df.join(repeated, mark == repeated["mark"], "left_anti"))


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the earliest row per key.

    ``row_number() = 1`` is planned with a group limit before the shuffle: every map task sends at
    most one row per key, however many copies of a key there are.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
