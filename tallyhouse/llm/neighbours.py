"""Nearest neighbours by inner product: a permutation index over pivots, then exact reranking."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import table, written

#: Pivots, and how many of them represent a vector: the nearest, in order. The pivots are drawn
#: from PIVOTS x SAMPLE distinct vectors by the hash of their smallest id.
PIVOTS, PREFIX, SAMPLE = 128, 64, 8
#: The share of a block, and the least number of its vectors, that are reranked for a query; more
#: where the last place is shared.
SHARE, LEAST = 0.15, 512
#: Distinct vectors of a block, and queries that meet it together.
BLOCK, CHUNK = 8192, 2048


def permutations(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """For each vector its ``prefix`` nearest pivots, nearest first, ties by the pivot's number."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :prefix]


def pivot_files(order: np.ndarray, pivots: int) -> np.ndarray:
    """The inverted file of each pivot: for every vector, prefix - place of the pivot; 0: not there."""
    rows, prefix = order.shape
    files = np.zeros((pivots, rows), np.uint16)
    for place in range(prefix):
        files[order[:, place], np.arange(rows)] = prefix - place
    return files


def closeness(files: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ranks every vector of the files by footrule distance from one permutation, larger is nearer.

    The footrule of two prefixes, with pivots that one of them lacks at the place behind it, is a
    constant less twice the sum over common pivots of prefix - max(place, place); this is that sum.
    """
    prefix = len(order)
    out, part = np.zeros(files.shape[1], np.uint16), np.empty(files.shape[1], np.uint16)
    for place, pivot in enumerate(order):
        np.minimum(files[pivot], np.uint16(prefix - place), out=part)
        np.add(out, part, out=out)
    return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lists' values one behind the other, and where each list begins and how long it is."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    held = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.cumsum(held) - held, held


def _usable(vector: Column) -> Column:
    """No null, nothing that isn't finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(
    items: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id",
    vector_col: str = "embedding", share: float = SHARE,
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` items of largest inner product with each query.

    Distinct vectors are indexed, each with its k + 1 smallest ids, which is all that a query can
    need of it. They are in blocks by hash, and every query meets every block. In a block a query
    scans the inverted files of its nearest pivots, and the ``share`` of the block that is nearest
    by footrule (LEAST at the least, and all that tie with the last) is scored exactly, in double
    precision; the best give their ids. A row is no candidate for queries of its own id. Ties go to the smaller id. Vectors that are null,
    zero, or hold null or non-finite components take no part, nor those of another length than
    most have. Rows of ``queries`` that repeat id and vector are one query; repeated items are
    candidates each; an empty table gives no rows; other columns are not looked at.

    An inner product is a cosine once vectors are lengthened by one component to the same norm, so
    pivots see the lengthened ones.
    """
    id_type = items.schema[id_col].dataType.simpleString()

    def slim(df: DataFrame) -> DataFrame:
        vector = F.col(vector_col).cast("array<double>")
        return df.select(F.col(id_col).alias("id"), vector.alias("v")).where("id is not null").where(_usable(F.col("v")))

    base, asked = slim(items), slim(queries).dropDuplicates()
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    sizes = base.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.max(square).alias("square"))
    most = sizes.orderBy(F.desc("n"), "dim").first()
    dim, longest = (most.dim, most.square) if most else (1, 1.0)
    base, asked = base.where(F.size("v") == dim), asked.where(F.size("v") == dim)
    copies = base.groupBy("v", "id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("times"))
    smallest = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    distinct = written(
        copies.withColumn("place", smallest).where(F.col("place") <= k + 1)
        .groupBy("v").agg(F.array_sort(F.flatten(F.collect_list(F.array_repeat("id", F.col("times"))))).alias("ids"))
        .withColumn("id", F.element_at("ids", 1)),
        "vectors",
    )
    n = distinct.count()
    drawn = distinct.orderBy(F.xxhash64("id"), "id", "v").limit(PIVOTS * SAMPLE).collect()
    sample = np.array([x.v for x in drawn], np.float64).reshape(len(drawn), dim)

    def lengthened(v: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(longest - (v * v).sum(1, keepdims=True), 0))
        return np.hstack([v, rest])

    _, first = np.unique(sample, axis=0, return_index=True)  # a vector that is frequent is one pivot
    pivots = lengthened(sample[np.sort(first)[:PIVOTS]])
    prefix = min(PREFIX, len(pivots))
    blocks = max(1, -(-n // BLOCK))
    chunks = max(1, -(-asked.count() // CHUNK))
    item_rows = distinct.select(
        "ids", "v", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
    )
    query_rows = asked.select(
        "id", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.pmod(F.xxhash64("id", "v"), F.lit(chunks)).cast("int").alias("chunk"),
        F.xxhash64("v").alias("of"),
    )

    def search(own: pa.Table, queries: pa.Table) -> pa.Table:
        found_q, found_of, found_id, found_score = [], [], [], []
        if len(own) and len(queries):
            vectors, ids, begin, held = _matrix(own["v"]), *_lists(own["ids"])
            wanted, query_ids, of = _matrix(queries["v"]), queries["id"].to_numpy(), queries["of"].to_numpy()
            files = pivot_files(permutations(lengthened(vectors), pivots, prefix), len(pivots))
            orders = permutations(np.hstack([wanted, np.zeros((len(wanted), 1))]), pivots, prefix)
            rows = len(vectors)
            least = min(rows, max(LEAST, k + 1, int(np.ceil(share * rows))))
            for q, order in enumerate(orders):
                near = closeness(files, order)
                kept = np.flatnonzero(near >= np.partition(near, rows - least)[rows - least])
                score = vectors[kept] @ wanted[q]
                if len(kept) > k + 1:  # one of them may have the query's own id alone
                    top = score >= np.partition(score, len(kept) - k - 1)[len(kept) - k - 1]
                    kept, score = kept[top], score[top]
                times = held[kept]
                before = np.cumsum(times) - times
                of_kept = ids[np.repeat(begin[kept] - before, times) + np.arange(times.sum())]
                score = np.repeat(score, times)
                other = of_kept != query_ids[q]
                of_kept, score = of_kept[other], score[other]
                best = np.lexsort((of_kept, -score))[:k]
                found_q.append(np.full(len(best), query_ids[q]))
                found_of.append(np.full(len(best), of[q]))
                found_id.append(of_kept[best])
                found_score.append(score[best])
        columns = [np.concatenate(x) if x else np.zeros(0) for x in (found_q, found_of, found_id, found_score)]
        id_kind = own.schema.field("ids").type.value_type
        kinds = [id_kind, pa.int64(), id_kind, pa.float64()]
        return pa.table({name: pa.array(x, t) for name, x, t in zip(("query_id", "of", "id", "score"), columns, kinds, strict=True)})

    schema = f"query_id {id_type}, of long, id {id_type}, score double"
    both = item_rows.groupBy("block", "chunk").cogroup(query_rows.groupBy("block", "chunk"))
    best = Window.partitionBy("query_id", "of").orderBy(F.desc("score"), "id")
    return (
        both.applyInArrow(search, schema)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)
