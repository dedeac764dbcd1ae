"""From documents to packed training sequences: toxic texts out, boilerplate lines out, one of each
group of near copies, secrets masked, the rest packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import Likely, fresh, shared_path, table, written
from tallyhouse.llm.jaccard import Rule, jaccard_components
from tallyhouse.llm.lines import without_boilerplate
from tallyhouse.llm.packing import pack, token_pieces
from tallyhouse.llm.secrets import BASE, KEY_MARK, MORE, BlobLedger
from tallyhouse.llm.toxicity import fit, without_toxic


def _same_columns(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``; ``n_chars`` follows the text."""
    length = F.length("text").cast(dict(docs.dtypes).get("n_chars", "bigint"))
    return changed.select(*(length.alias(c) if c == "n_chars" else changed[c] for c in docs.columns))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labels that aren't held out, rejects go."""
    return without_toxic(docs, fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites go but for their first place, and texts that lose all of it.

    Marks of key blocks stay: without them the secret scans would not see the keys.
    """
    removed = without_boilerplate(docs, spared=KEY_MARK)
    n_removed = removed[removed.columns[-1]]
    left = removed.where((n_removed == 0) | (F.trim("text") != "") | F.col("text").isNull())
    return _same_columns(left, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents alike in their five-word shingles the first stays.

    That is the one of the smallest doc_id, and of unlike texts under that id the one whose text has
    the smallest hash. Documents without an id stay all. Unlike texts that share a doc_id are
    documents of their own, rows that repeat an id and a text are one document. Documents that are
    alone in their component don't move.
    """
    doc, of_text = fresh(docs, "doc"), fresh(docs, "of_text")
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    named = docs.where("doc_id is not null").select("doc_id", "text", F.struct("doc_id", text_hash.alias("of_text")).alias(doc))
    groups = jaccard_components(named.select(F.col(doc).alias("doc_id"), "text"), Rule(words=5, num=80, den=100))
    is_first = F.col("doc_id") == F.col("component_id")
    found = written(groups.groupBy("doc_id").agg(F.first(is_first).alias("first"), F.count("*").alias("rows")), "found")
    found = found.select(F.col("doc_id.doc_id").alias(doc), F.col("doc_id.of_text").alias(of_text), "first", "rows")
    of_found, of_docs = F.xxhash64(doc, of_text), F.xxhash64("doc_id", text_hash)
    not_alone = Likely(found.where("not first or rows > 1").select(of_found.alias("h")))
    kept = not_alone.inside(found.where("first"), of_found).select(doc, of_text)
    left = not_alone.inside(docs.where("doc_id is not null"), of_docs)
    left = left.join(kept, (F.col("doc_id") == F.col(doc)) & (text_hash == F.col(of_text)))
    left = left.dropDuplicates([doc, of_text]).drop(doc, of_text)
    alone = not_alone.outside(docs.where("doc_id is not null"), of_docs)
    return alone.unionByName(left).unionByName(docs.where("doc_id is null"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind."""
    ledger = BlobLedger(spark, shared_path(spark, "ledger"))
    return _same_columns(ledger.redact(docs, [*BASE, *MORE]), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids and their places in sequences of 1024."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(written(token_pieces(docs, path), "pieces"))


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("secret scans", secrets),
    ("packing", packing),
]

#: Tokens and learnt scores can't be expressed in SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
