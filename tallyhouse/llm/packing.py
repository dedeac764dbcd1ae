"""Packing documents into sequences of one length: shortest pack first over the length histogram."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import byte_slices, ranked, salts_of, table, written

#: Characters that every version of Unicode puts into the same class. Texts of these alone are
#: encoded by a second library, several times faster, with the same vocabulary; others by tokenizers.
_PLAIN = re.compile(r"[\t\n\r -~¡-ɏ‐-‧]*")
#: What splits a text before the merges, as in the tokenizer's file (fixed value).
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: Bytes of text that are handled together.
MOST = 1 << 20


class ByteBpe:
    """Ids of texts as tokenizers gives them for a byte-level BPE file, without added special ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.no_truncation()
        self.exact.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [x["content"] for x in spec["added_tokens"]]
        split = spec["pre_tokenizer"]
        usual = split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {
            bytes(byte[c] for c in token): i
            for token, i in spec["model"]["vocab"].items()
            if token not in self.special
        }
        self.quick = (
            tiktoken.Encoding("quick", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
            if usual and not spec["normalizer"]
            else None
        )

    def ids(self, text: str) -> np.ndarray:
        if self.quick and _PLAIN.fullmatch(text) and not any(x in text for x in self.special):
            return np.array(self.quick.encode_ordinary(text), "<u4")
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


def token_pieces(
    docs: DataFrame, path: str, size: int = 1024, end_id: int = 0, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The ids of every text and then ``end_id``, cut into pieces of ``size`` and a last shorter one.

    Rows (id, start, length, ids_crc32, doc_tokens), with ``ids`` too if asked for. A null or empty
    text is one piece of ``end_id``; repeated rows stay; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).ids
        for batch in (rows for batch in batches for rows in byte_slices(batch, 1, MOST)):
            row, start, ids, tokens = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                all_ids = np.append(encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                for at in range(0, len(all_ids), size):
                    row.append(i)
                    start.append(at)
                    ids.append(all_ids[at : at + size])
                    tokens.append(len(all_ids))
            columns = [
                batch.column(0).take(pa.array(row, pa.int64())),
                pa.array(start, pa.int64()),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                pa.array(tokens, pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    schema += ", ids array<int>" * with_ids
    names = [x.split(" ")[0] for x in schema.split(", ")]
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def plan_packs(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Shortest pack first: rows (length, first rank, count, first sequence, offset).

    Lengths are placed longest first, each into the packs that are emptiest so far, else into new
    ones. A pattern is a run of alike packs; it is split when only some of them get another piece.
    Rank r of a length goes to the sequence ``first sequence + r - first rank`` at ``offset``. The
    number of rows depends on ``size`` alone, not on the number of pieces.
    """
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by space left: (first sequence, count)
    out, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, rest, space = 0, histogram[length], size
        while rest:
            while space >= length and not free.get(space):
                space -= 1
            if space < length:  # new packs
                first, count, space = sequences, rest, size
                sequences += rest
            else:
                first, count = free[space].pop()
                if count > rest:
                    free[space].append((first + rest, count - rest))
                    count = rest
            out.append((length, rank, count, first, size - space))
            if space > length:
                free[space - length].append((first, count))
            rank, rest = rank + count, rest - count
    return out


def pack(pieces: DataFrame, size: int = 1024, salt: tuple[str, ...] = ("doc_id", "start")) -> DataFrame:
    """``pieces`` (any columns, ``length`` from 1 to ``size``) with ``sequence_id`` and ``offset``.

    The driver sees the histogram of lengths, at most ``size`` rows; pieces find their place by
    their rank among those of their length. Columns of those names are replaced. ``pieces`` is read several times, so pass a written
    table. An empty table gives no rows; repeated rows get places of their own.
    """
    pieces = pieces.drop("sequence_id", "offset")
    histogram = {n: k for n, k in pieces.groupBy("length").count().collect()}
    if histogram and not 1 <= min(histogram) <= max(histogram) <= size:
        raise ValueError(f"piece lengths must be from 1 to {size}")
    plan = plan_packs(histogram, size)
    by_length = defaultdict(list)
    for length, *rest in plan:
        by_length[length].append(rest)
    places = {n: np.array(rows, np.int64).T for n, rows in by_length.items()}
    schema = pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            length = batch.column(names.index("length")).to_numpy()
            rank = batch.column(names.index("sequence_id")).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                first_rank, _, first_sequence, at = places[int(n)]
                k = np.searchsorted(first_rank, rank[own], side="right") - 1
                sequence[own] = first_sequence[k] + rank[own] - first_rank[k]
                offset[own] = at[k]
            columns = [c for c, x in zip(batch.columns, names, strict=True) if x != "sequence_id"]
            names = [x for x in names if x != "sequence_id"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"]
            )

    order = [c for c in pieces.columns if pieces.schema[c].dataType.typeName() not in ("map", "variant")]
    spark = pieces.sparkSession
    places_of = ranked(pieces, ["length"], order, salt, salts_of(spark), "sequence_id")
    return places_of.select(*pieces.columns, "sequence_id").mapInArrow(run, schema)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(written(token_pieces(table(spark, sf_dir, "documents"), path), "pieces"))
