"""Shards of near equal size for groups that must stay together: longest first, to the least loaded."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import fresh, ranked, salts_of, table, written

#: Runs of more than this many equal groups a shard are dealt by level first, then by the heap.
AT_ONCE = 4


def longest_first(histogram: Iterable[tuple[int, int]], shards: int) -> Iterator[tuple[int, list[int]]]:
    """How many of the groups of each (weight, count) every shard gets: heaviest first, each group to
    the least-loaded shard, of equal ones to the first.

    Through a heap. A long run of equal groups goes to the shards in the order of what each holds
    before a group, so the highest level that takes no more than the run tells what all get at
    once, and the heap deals the rest.
    """
    heap = [(0, i) for i in range(shards)]
    for weight, count in sorted(histogram, reverse=True):
        given = [0] * shards
        if count > AT_ONCE * shards and weight > 0:

            def up_to(level: int) -> list[tuple[int, int]]:
                return [(max(0, -(-(level - load) // weight)), i) for load, i in heap]

            low, high = heap[0][0], heap[0][0] + weight * (count + 1)
            while low < high:
                level = (low + high + 1) // 2
                low, high = (level, high) if sum(n for n, _ in up_to(level)) <= count else (low, level - 1)
            dealt = up_to(low)
            for n, i in dealt:
                given[i] = n
            heap = [(load + n * weight, i) for (load, i), (n, _) in zip(heap, dealt, strict=True)]
            heapq.heapify(heap)
            count -= sum(given)
        for _ in range(count):
            load, i = heap[0]
            heapq.heapreplace(heap, (load + weight, i))
            given[i] += 1
        yield weight, given


def place_groups(rows: DataFrame, shards: int, group_col: str = "group", size_col: str = "size") -> DataFrame:
    """``rows`` with ``shard`` (int): each group of ``group_col`` (binary, no nulls) is placed whole.

    What the heap sees is the histogram of group weights: the driver holds a row for each different
    weight, of which n bytes have no more than the square root of 2 n. Groups of one weight are
    told apart by their rank there, and find their shard by it. Sums are per group and task before
    anything moves, so a group of any size is cheap. Repeated rows are rows of their group; an empty
    table gives no rows. ``rows`` is read twice, so pass a written table.
    """
    spark = rows.sparkSession
    of, to_shard = fresh(rows, "of_group"), fresh(rows, "to_shard")
    sizes = rows.groupBy(F.col(group_col).alias(of)).agg(F.sum(size_col).cast("long").alias("weight"))
    sizes = written(sizes, "group_sizes")
    counted = sizes.groupBy("weight").agg(F.count("*").alias("n")).toArrow()
    histogram = zip(counted["weight"].to_pylist(), counted["n"].to_pylist(), strict=True)
    plan = [(weight, list(accumulate(given))) for weight, given in longest_first(histogram, shards)]
    weights, until = pa.array([w for w, _ in plan], pa.int64()), pa.array([u for _, u in plan], pa.list_(pa.int64()))
    ranks = ranked(sizes, ["weight"], [of], [of], salts_of(spark), "rank")
    dealt = spark.createDataFrame(pa.table({"weight": weights, "until": until}))
    # written, so that the join with a group of very many rows can be split
    shard = F.size(F.filter("until", lambda x: x <= F.col("rank"))).alias(to_shard)
    placed = written(ranks.join(dealt, "weight").select(of, shard), "group_shards")
    return rows.join(placed, F.col(group_col) == F.col(of)).select(
        *(rows[c] for c in rows.columns), F.col(to_shard).alias("shard")
    )


def shard_documents(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row; equal texts share a shard.

    ``size`` is the text's bytes plus 1. A null text has no bytes: it is placed with the empty
    ones. ``slot`` is gapless from 0 in each shard. Repeated rows get slots of their own, an empty
    table gives no rows, other columns are not looked at.
    """
    text = F.coalesce(text_col, F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("group"),
    )
    placed = written(place_groups(written(slim, "sizes"), shards), "placed")
    salts = salts_of(docs.sparkSession)
    slots = ranked(placed, ["shard"], ["id", "group"], ["id", "group"], salts, "slot")
    return slots.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
