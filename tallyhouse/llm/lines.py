"""Line dedup: lines that stand on many sites go everywhere but where they come first."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import fresh, table, written

#: A line goes if it has this many characters and stands on this many sites.
MIN_CHARS, MIN_SITES = 16, 5
#: Sketches have 2 ** LG_K registers; estimates within DEVIATIONS standard errors of the limit are
#: counted exactly.
LG_K, DEVIATIONS = 8, 4


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _row_key(id_col: str, text_col: str) -> list[Column]:
    return [F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("of_text")]


def site_spread(lines: DataFrame, min_sites: int) -> DataFrame:
    """(line, size) of the lines on ``min_sites`` sites or more, of rows (line, size, site).

    A HyperLogLog sketch for each line merges what tasks have seen, so a line costs a few bytes
    however often it stands. Estimates near the limit are settled by the exact count of distinct
    (line, site) pairs, of those lines alone.
    """
    error = DEVIATIONS * 1.04 / math.sqrt(1 << LG_K)
    spread = written(
        lines.groupBy("line", "size")
        .agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
        .select("line", "size", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= min_sites / (1 + error) - 1),
        "spread",
    )
    sure = F.col("sites") > min_sites * (1 + error) + 1
    exact = (
        lines.join(spread.where(~sure), ["line", "size"], "left_semi")
        .select("line", "size", "site").distinct()
        .groupBy("line", "size").agg(F.count("*").alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    return spread.where(sure).union(exact).select("line", "size")


def without_boilerplate(
    docs: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS,
    id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", spared: str | None = None,
) -> DataFrame:
    """``docs`` with its texts less the lines that stand on ``min_sites`` sites, and two counts.

    Adds ``n_lines`` and ``n_removed`` (with ``_`` behind where ``docs`` has them). Each such line
    stays where it comes first: in the row of the smallest id (nulls last), at its first place
    there; rows that repeat an id and text are alike. Lines are compared exactly, up to their 64-bit
    hash and length; those under ``min_chars`` characters always stay, and so do those that contain
    ``spared``. A null site is one site. A null text has one empty line and stays null, a text whose
    lines all go becomes empty, and an empty table gives no rows.
    """
    spared_line = F.lit(False) if spared is None else F.col("text").contains(spared)
    occurrences = written(
        docs.select(
            *_row_key(id_col, text_col),
            F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("site"),
            F.posexplode(_lines(F.col(text_col))).alias("place", "text"),
        )
        .where((F.length("text") >= min_chars) & ~spared_line)
        .select("id", "of_text", "site", "place", F.xxhash64("text").alias("line"), F.octet_length("text").alias("size")),
        "lines",
    )
    # structs compare field by field; the flag puts a null id behind all others
    where = F.struct(F.col("id").isNull().alias("no_id"), "id", "place")
    spread = (
        occurrences.join(written(site_spread(occurrences, min_sites), "boilerplate"), ["line", "size"])
        .groupBy("line", "size").agg(F.min(where).alias("first"))
    )
    gone_id, gone_text, places = (fresh(docs, x) for x in ("gone_id", "gone_text", "gone"))
    gone = (
        occurrences.join(written(spread, "first"), ["line", "size"])
        .where(where != F.col("first"))
        .groupBy(F.col("id").alias(gone_id), F.col("of_text").alias(gone_text))
        .agg(F.collect_set("place").alias(places))
    )
    key, digest = _row_key(id_col, text_col)
    marked = docs.join(
        gone, key.eqNullSafe(F.col(gone_id)) & digest.eqNullSafe(F.col(gone_text)), "left"
    )
    lines = _lines(F.col(text_col))
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(places, i)), "\n")
    n_lines, n_removed = fresh(docs, "n_lines"), fresh(docs, "n_removed")
    return marked.select(
        *(
            F.when(F.col(places).isNull(), docs[c]).otherwise(kept).alias(c) if c == text_col else docs[c]
            for c in docs.columns
        ),
        F.size(lines).cast("long").alias(n_lines),
        F.coalesce(F.size(places), F.lit(0)).cast("long").alias(n_removed),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return without_boilerplate(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


#: The same in SQL: exact spreads, places from 0.
OP8_SQL = f"""
WITH split AS (
  SELECT doc_id, coalesce(source, '') AS site, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), line AS (
  SELECT doc_id, site, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split
), spread AS (
  SELECT line, min((doc_id, place)) AS first FROM line WHERE length(line) >= {MIN_CHARS}
  GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}
), judged AS (
  SELECT doc_id, line.line, place, spread.line IS NOT NULL AND first <> (doc_id, place) AS gone
  FROM line LEFT JOIN spread ON line.line = spread.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
