"""Helpers of the operators: tables in the shared folder, ranks without hot windows, components."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.session import shared_dir

#: A space that every tokenizer here keeps with the word after it, so cutting before it is safe.
_SAFE_CUT = re.compile(r"(?<=[A-Za-z0-9.,;]) (?=[A-Za-z])")

#: Bits of the largest bitmap that tells which rows may have a partner: 524,288 words.
MOST_BITS = 1 << 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the driver ends."""
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(there)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, lineage cut."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ranked(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], salt: Sequence[str],
    salts: int, name: str,
) -> DataFrame:
    """Adds the rank, gapless from 0, of each row within ``keys``.

    A key may hold any share of the rows: it is cut into ``salts`` parts by the hash of ``salt``,
    each part is ranked alone, and the parts' sizes (keys x salts rows) give the offsets. ``keys``
    must be without nulls. ``df`` is read twice, so pass a written table.
    """
    part, before, count = (fresh(df, x) for x in ("part", "before", "part_rows"))
    parts = df.withColumn(part, F.pmod(F.xxhash64(*salt), F.lit(salts)).cast("int"))
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy(*keys, part).agg(F.count("*").alias(count))
        .withColumn(before, F.coalesce(F.sum(count).over(earlier), F.lit(0)))
        .drop(count)
    )
    within = F.row_number().over(Window.partitionBy(*keys, part).orderBy(*order)) - 1
    return (
        parts.withColumn(name, within)
        .join(offsets, [*keys, part])
        .withColumn(name, (F.col(name) + F.col(before)).cast("long"))
        .drop(part, before)
    )


def salts_of(spark: SparkSession) -> int:
    """Parts for a hot key: several for each shuffle partition, so that they fill the cluster."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


class Likely:
    """A test of 64-bit hashes: true for all in ``hashes`` (one column, without nulls), false for most others.

    A bitmap of 16 bits for each of them, but no more than MOST_BITS, in words of 64 that are broadcast:
    at most MOST_BITS / 64 rows of two numbers. So rows that a join would drop don't have to move to it;
    where the bitmap is full it spares nothing, and the join decides as before. ``hashes`` is read
    twice, so pass a written table.
    """

    def __init__(self, hashes: DataFrame):
        self.scale = min(MOST_BITS, max(64, 16 * hashes.count())).bit_length() - 1
        place = self._place(F.col(hashes.columns[0]))
        one = F.expr("shiftleft(1L, bit)")
        words = hashes.select(F.shiftright(place, 6).alias("word"), (place % 64).cast("int").alias("bit"))
        self.words = written(words.groupBy("word").agg(F.bit_or(one).alias("bits")), "words")

    def _place(self, of: Column) -> Column:
        return F.shiftrightunsigned(of, 64 - self.scale)

    def _tested(self, df: DataFrame, of: Column, has: int) -> DataFrame:
        word, bits = fresh(df, "word_of"), fresh(df, "bits_of")
        words = F.broadcast(self.words.select(F.col("word").alias(word), F.col("bits").alias(bits)))
        bit = F.getbit(F.coalesce(bits, F.lit(0)), (self._place(of) % 64).cast("int"))
        return df.join(words, F.shiftright(self._place(of), 6) == F.col(word), "left").where(bit == has).drop(word, bits)

    def inside(self, df: DataFrame, of: Column) -> DataFrame:
        """The rows of ``df`` whose hash ``of`` may be among the hashes."""
        return self._tested(df, of, 1)

    def outside(self, df: DataFrame, of: Column) -> DataFrame:
        """All other rows; ``of`` must not be null."""
        return self._tested(df, of, 0)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, root), root the smallest node.

    Alternates large and small stars until nothing changes (logarithmically many rounds). Each
    round is joins and aggregates on edges only, written to the shared folder. A node with very
    many edges is one partial minimum per task. Nodes without edges are not returned.
    """
    now = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()
        if tuple(state) == seen or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select("v", "v").distinct()
            )
        seen = tuple(state)
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = written(least, "least")  # not an aggregate any more, so that the join with a hub's edges can be split
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(
            small.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "small"
        )


def safe_pieces(text: str, size: int) -> list[str]:
    """``text`` cut into pieces of about ``size`` characters where no token can cross.

    Pieces are longer where there is no such place.
    """
    if len(text) <= size:
        return [text]
    out, at = [], 0
    while len(text) - at > size:
        cut = _SAFE_CUT.search(text, at + size)
        if cut is None:
            break
        out.append(text[at : cut.start()])
        at = cut.start()
    return [*out, text[at:]]


def by_bytes(texts: Sequence[str], most: int) -> Iterator[range]:
    """Ranges of ``texts`` that hold about ``most`` characters each, one text at least."""
    begin = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            yield range(begin, i)
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield range(begin, len(texts))


def id_slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices whose lists in ``column`` hold about ``most`` items together, one row at least."""
    ends = batch.column(column).offsets.to_numpy()
    cuts = np.flatnonzero(np.diff(ends // most)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def listed(lists: pa.ListArray) -> Iterator[list[int]]:
    """The items of each list as Python numbers; none for a null."""
    items, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy().tolist()
    for a, b, known in zip(ends, ends[1:], lists.is_valid().to_pylist(), strict=False):
        yield items[a:b].tolist() if known else []


def byte_slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices whose texts in ``column`` hold about ``most`` bytes, one row at least.

    Cut before any text becomes a Python object, so that a worker holds one slice of them.
    """
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    begin = 0
    while begin < len(ends):
        before = int(ends[begin - 1]) if begin else 0
        end = max(int(np.searchsorted(ends, before + most, side="right")), begin + 1)
        yield batch.slice(begin, end - begin)
        begin = end
