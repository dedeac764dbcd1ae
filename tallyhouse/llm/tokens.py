"""Token counts of whole texts."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import by_bytes, safe_pieces, table

#: Characters in one call of the library, and in one piece of a long text.
BATCH_CHARS, PIECE_CHARS = 1 << 20, 1 << 16


@lru_cache(maxsize=4)
def counter(path: str):
    """A function from a list of texts to their token counts, by the library the file is for."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def lengths(texts: list[str], path: str) -> np.ndarray:
    """Token counts of ``texts``; long ones are cut at safe places and batches hold alike bytes.

    Only a byte-level .json is cut: a .model adds a space before each text it is given.
    """
    cut = not path.endswith(".model")
    pieces, owner = [], []
    for i, text in enumerate(texts):
        own = safe_pieces(text, PIECE_CHARS) if cut else [text]
        pieces += own
        owner += [i] * len(own)
    count, out = counter(path), np.zeros(len(texts), np.int64)
    for part in by_bytes(pieces, BATCH_CHARS):
        np.add.at(out, owner[part.start : part.stop], count(pieces[part.start : part.stop]))
    return out


def count_tokens(
    docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    Only lengths leave the Arrow function. A null text counts as empty; repeated rows stay; an
    empty table gives no rows; other columns of ``docs`` are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = lengths(texts, path)
            size = pa.array([len(x.encode()) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), size, pa.array(n), pa.array(n > limit)],
                names=["id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    schema = f"id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
