"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraphs."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import salts_of, table
from tallyhouse.llm.hashing import joined, mix, range_hashes

#: Cells of a fingerprint, a multiple of HASHES; each digest is in HASHES of them. A comparison
#: that can't be peeled is done again with GROWTH times as many.
CELLS, HASHES, GROWTH = 24, 3, 4
#: A line is cut further behind about every so many of its spaces, by the letters before them.
WORDS = 8
#: Bytes handled together, and cells of all sketches that are peeled together.
BATCH_BYTES, BATCH_CELLS = 1 << 20, 1 << 19


def digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all paragraphs of ``texts`` and, sorted, whose they are.

    A paragraph is a line; within a line the letters before a space may end one too, so that a
    change in a long line leaves most of it alone. Every byte is in exactly one paragraph. The n-th
    occurrence of a paragraph in a text has a digest of its own.
    """
    data, starts, ends = joined([x.encode() for x in texts], b"\0\0\0\0")
    before = data.astype(np.uint32)
    near = np.zeros(len(data), np.uint32)
    near[3:] = before[2:-1] * np.uint32(0x9E3779B1) + before[1:-2] * np.uint32(0x85EBCA6B) + before[:-3] * np.uint32(0xC2B2AE35)
    near = (near ^ (near >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    cut = (data == 10) | ((data == 32) & ((near >> np.uint32(20)) % np.uint32(WORDS) == 0))
    begins = np.unique(np.concatenate([starts, ends, np.flatnonzero(cut) + 1]))
    begins = begins[begins < len(data)]
    owner = np.searchsorted(starts, begins, side="right") - 1
    inside = (begins >= starts[owner]) & (begins < ends[owner]) if len(starts) else begins < 0
    following = np.append(begins[1:], len(data))
    begins, owner, lengths = begins[inside], owner[inside], (following - begins)[inside]
    keys = range_hashes(data, begins, lengths)
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    if len(keys):
        new = np.append(True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1]))
        first = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
        keys = mix(keys + (np.arange(len(keys)) - first).astype(np.uint64), 11)
    return keys, owner


def _cells_of(keys: np.ndarray, cells: int) -> list[np.ndarray]:
    each = cells // HASHES
    return [(mix(keys, 20 + j) % np.uint64(each)).astype(np.int64) + j * each for j in range(HASHES)]


Digests = tuple[np.ndarray, np.ndarray]


def sketches(keys: np.ndarray, owner: np.ndarray, texts: int, cells: int) -> tuple[np.ndarray, ...]:
    """Count, sum of keys and sum of key checks of each cell, text after text."""
    count, total, check = (np.zeros(texts * cells, x) for x in (np.int64, np.uint64, np.uint64))
    with np.errstate(over="ignore"):
        for at in _cells_of(keys, cells):
            at = at + owner * cells
            np.add.at(count, at, 1)
            np.add.at(total, at, keys)
            np.add.at(check, at, mix(keys, 30) & np.uint64(0xFFFFFFFF))
    return count, total, check & np.uint64(0xFFFFFFFF)


def peel(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Subtracts sketches pairwise and peels them: (pair, digest, side) and which pairs came out whole.

    A cell with one digest left shows it; taken out of its other cells it leaves more such cells.
    ``side`` is 1 for digests of ``a`` alone and -1 for those of ``b`` alone.
    """
    low = np.uint64(0xFFFFFFFF)
    with np.errstate(over="ignore"):
        count, total, check = a[0] - b[0], a[1] - b[1], (a[2] - b[2]) & low
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        at = np.flatnonzero(np.abs(count) == 1)
        while len(at):
            sign = count[at]
            key = np.where(sign > 0, total[at], np.uint64(0) - total[at])
            right = np.where(sign > 0, check[at], (np.uint64(0) - check[at]) & low) == mix(key, 30) & low
            pair, key, sign = at[right] // cells, key[right], sign[right]
            order = np.lexsort((key, pair))
            pair, key, sign = pair[order], key[order], sign[order]
            new = np.append(True, (pair[1:] != pair[:-1]) | (key[1:] != key[:-1]))[: len(pair)]
            pair, key, sign = pair[new], key[new], sign[new]
            if not len(pair):
                break
            found.append((pair, key, sign))
            touched = []
            signed = sign.astype(np.uint64)  # -1 wraps, as the sums do
            for place in _cells_of(key, cells):
                place = place + pair * cells
                np.subtract.at(count, place, sign)
                np.subtract.at(total, place, signed * key)
                np.subtract.at(check, place, signed * (mix(key, 30) & low))
                touched.append(place)
            check &= low
            at = np.unique(np.concatenate(touched))
            at = at[np.abs(count[at]) == 1]
            if sum(len(x[0]) for x in found) > len(count):  # more than can be there: a false digest
                break
    empty = (count == 0) & (total == 0) & (check == 0)
    whole = empty.reshape(-1, cells).all(axis=1)
    parts = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]
    return *parts, whole


def _serial(sketch: tuple[np.ndarray, ...], cells: int) -> list[str]:
    rows = np.zeros((len(sketch[0]) // cells, cells), np.dtype([("n", "<i4"), ("sum", "<u8"), ("check", "<u4")]))
    for name, values in zip(("n", "sum", "check"), sketch, strict=True):
        rows[name] = values.reshape(rows.shape)
    return [base64.b64encode(x.tobytes()).decode() for x in rows]


def fingerprint(text: str, cells: int = CELLS) -> str:
    """The sketch of one text: its cells' count, sum of digests and sum of checks, in base 64."""
    keys, owner = digests([text])
    return _serial(sketches(keys, owner, 1, cells), cells)[0]


def difference(a: str, b: str) -> tuple[list[int], list[int]] | None:
    """Digests only in ``a`` and only in ``b``, from two fingerprints of a size; None: too many differ."""
    kind = np.dtype([("n", "<i4"), ("sum", "<u8"), ("check", "<u4")])
    x, y = (np.frombuffer(base64.b64decode(s), kind) for s in (a, b))
    both = [(z["n"].astype(np.int64), z["sum"].copy(), z["check"].astype(np.uint64)) for z in (x, y)]
    _, key, sign, whole = peel(*both, len(x))
    return ([int(k) for k in key[sign > 0]], [int(k) for k in key[sign < 0]]) if whole[0] else None


def _differing(a: Digests, b: Digests, texts: int, cells: int) -> np.ndarray:
    """How many digests differ in each pair of texts: peeled, those that fail with larger sketches."""
    out, left = np.zeros(texts, np.int64), np.arange(texts)
    sizes = [np.bincount(x[1], minlength=texts) for x in (a, b)]
    while len(left):
        failed = []
        many = max(1, BATCH_CELLS // cells)
        for begin in range(0, len(left), many):
            part = left[begin : begin + many]
            place = np.full(texts, -1)
            place[part] = np.arange(len(part))
            made = []
            for keys, owner in (a, b):
                own = place[owner] >= 0
                made.append(sketches(keys[own], place[owner[own]], len(part), cells))
            pair, _, _, whole = peel(*made, cells)
            out[part] = np.bincount(pair, minlength=len(part))
            failed.append(part[~whole])
        left = np.concatenate(failed)
        cells *= GROWTH
        # far more room than digests: only two digests in the same cells fail; they differ pairwise
        sure = cells > 64 * (sizes[0][left] + sizes[1][left] + HASHES)
        for i in left[sure]:
            out[i] = len(np.setxor1d(*(keys[owner == i] for keys, owner in (a, b))))
        left = left[~sure]
    return out


def prints(made: Digests, texts: int, cells: int = CELLS) -> list[str]:
    """The fingerprints of texts from their digests."""
    return _serial(sketches(*made, texts, cells), cells)


def likeness(a: Digests, b: Digests, texts: int, cells: int = CELLS) -> np.ndarray:
    """The share of paragraphs that each pair of texts has in common, by what peeling recovers.

    It is 1 - differing / (paragraphs of both); two empty texts are alike.
    """
    n = sum(np.bincount(owner, minlength=texts) for _, owner in (a, b))
    return np.where(n > 0, 1 - _differing(a, b, texts, cells) / np.maximum(n, 1), 1.0)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (part, ahead, id, text), each ``part`` sorted so that a row's next one follows it.

    The order is by id, descending, nulls last, rows with one id by text. Ids (numbers) are cut into
    ranges; the largest id of each range, one for each, goes also to the range before it (the
    first's to the last), marked ``ahead``: texts move once, and no window spans the table.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    ranges = salts_of(docs.sparkSession)
    cuts = slim.approxQuantile("id", [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) < 3:
        splits.insert(1, 0.0)
    bucket = Bucketizer(splits=splits, inputCol="id_", outputCol="part_", handleInvalid="keep")

    def parted(df: DataFrame) -> DataFrame:  # ranges count downwards, nulls are the last
        low = bucket.transform(df.withColumn("id_", F.col("id").cast("double")))
        part = F.when(F.col("id").isNull(), F.lit(len(splits))).otherwise(len(splits) - F.col("part_"))
        return low.withColumn("part", part.cast("int")).drop("id_", "part_")

    heads = parted(slim.select("id")).groupBy("part").agg(F.max("id").alias("id")).orderBy("part").collect()
    before = {h.part: heads[i - 1].part for i, h in enumerate(heads)}
    rows = parted(slim).withColumn("ahead", F.lit(False))
    spark = docs.sparkSession
    kind = slim.schema["id"].dataType
    if heads:
        ahead = spark.createDataFrame(
            [(h.id, before[h.part]) for h in heads], f"head {kind.simpleString()}, goes int"
        )
        matched = slim.join(F.broadcast(ahead), F.col("id").eqNullSafe(F.col("head")))
        rows = rows.union(matched.select("id", "text", F.col("goes").alias("part"), F.lit(True)))
    order = ["part", "ahead", F.col("id").desc_nulls_last(), "text"]
    return rows.select("part", "ahead", "id", "text").repartition("part").sortWithinPartitions(*order)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, next text) of what ``with_next`` gives, in batches of bounded bytes."""
    held, rows, size = None, [], 0
    for batch in batches:
        for part, ahead, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0] == part:
                rows.append((held[1], held[2], text))
                size += len(held[2])
                if size > BATCH_BYTES:
                    yield rows
                    rows, size = [], 0
            held = None if ahead else (part, key, text)
    if rows:
        yield rows


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _edited(batches):
            ids, texts, following = (list(x) for x in zip(*rows, strict=True))
            edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, following, strict=True)]
            own, other, after = digests(texts), digests(edited), digests(following)
            n = len(texts)
            columns = [
                pa.array(ids, pa.int64()),
                pa.array([len(x) for x in texts], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]),
                pa.array(prints(own, n)), pa.array(prints(other, n)),
                pa.array(likeness(own, other, n)), pa.array(likeness(own, after, n)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [x.split(" ")[0] for x in schema.split(", ")]
    return with_next(docs).mapInArrow(run, schema)
