"""Secret scans over a ledger of blobs: each content is scanned once for each version of a rule."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyhouse.llm.common import Likely, byte_slices, fresh, shared_path, table, written


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters; raise ``version`` with any change.

    A text without any of ``needs`` can't match and isn't searched.
    """

    kind: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1
    any_case: bool = False
    needs: tuple[str, ...] = ("",)


#: The base rules, in the order in which spans with one start are listed (fixed values).
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6, group=2, any_case=True, needs=(":", "="),
    ),
    Rule("access", "AKIA[A-Z0-9]+", 20, needs=("AKIA",)),
    Rule("hex", "[0-9a-f]{24,}", 24),  # the same as [0-9a-f]+ of 24 or more characters
)
#: Marks of a private key block, and what may stand between its lines, in strings of code as well.
KEY_MARK = "PRIVATE KEY"
_LABEL = f"(?:[A-Z]+ )*{KEY_MARK}(?: BLOCK)?-----"
_GAP = r"""(?:[\s"'>#*,|+]|\\[nr])*"""
#: A key block goes up to its end mark, but not into another block. If the end is missing it goes as
#: far as headers and then base64 do; the last line may be short, and a checksum may follow.
_PEM = (
    rf"-----BEGIN {_LABEL}"
    rf"(?:(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END {_LABEL}"
    rf"|(?:{_GAP}(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID):[^\n\\]*)*"
    rf"(?:{_GAP}[A-Za-z0-9+/]{{16,}}+={{0,2}})*"
    rf"""(?:{_GAP}[A-Za-z0-9+/]+={{0,2}}(?=[\x20\t\r"',+]*(?:\n|\\[nr]|\Z)))?"""
    rf"(?:{_GAP}=[A-Za-z0-9+/]{{4}}(?![A-Za-z0-9+/]))?)"
)
_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "glpat-", "xox")
#: What the ledger looks for besides: private key blocks and prefixed access tokens.
MORE = (
    Rule("pem", _PEM, 1, version=2, needs=("-----BEGIN ",)),
    Rule("prefixed", "(?:gh[pousr]_|glpat-|xox[abpr]-)[A-Za-z0-9_-]{20,}", 24, needs=_PREFIXES),
)

#: Bytes of text that are handled together.
MOST = 1 << 22

LEDGER = "blob string, kind string, version int"
FINDINGS = "blob string, kind string, version int, start long, end long"
PLACES = "path string, revision string, blob string"


def spans(text: str, rule: Rule) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches that are long enough: start and end in code points."""
    if not any(x in text for x in rule.needs):
        return []
    found = _compiled(rule).finditer(text)
    return [m.span() for m in found if len(m.group(rule.group)) >= rule.least]


@lru_cache(maxsize=256)
def _compiled(rule: Rule) -> re.Pattern:
    return re.compile(rule.pattern, re.ASCII | (re.IGNORECASE if rule.any_case else 0))


class BlobLedger:
    """What was scanned, what was found and where contents stood, as Parquet tables that only grow.

    ``scanned`` has a row for each pair of blob and rule version, ``findings`` one for each span,
    ``places`` one for each path and revision of it that held a blob. A scan writes its findings
    first, so that one that breaks off is done again; all are read distinct, so nothing counts twice.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        files = there.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(there):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def scanned(self) -> DataFrame:
        return self._read("scanned", LEDGER).distinct()

    def findings(self) -> DataFrame:
        return self._read("findings", FINDINGS).distinct()

    def places(self) -> DataFrame:
        return self._read("places", PLACES).distinct()

    def located(self) -> DataFrame:
        """All findings at all paths and revisions that ever held their blobs, also ones long gone."""
        return self.places().join(self.findings(), "blob")

    def owed(self, rules: Sequence[Rule]) -> DataFrame:
        """(blob, kind, version) of known contents that weren't scanned for a rule's present version."""
        listed = F.array(*(_rule(i, x) for i, x in enumerate(rules)))
        pairs = self.places().select("blob").distinct().select("blob", F.inline(listed)).drop("place")
        return pairs.join(self.scanned(), ["blob", "kind", "version"], "left_anti")

    def scan(
        self, docs: DataFrame, rules: Sequence[Rule], id_col: str = "doc_id", text_col: str = "text",
        revision_col: str | None = None,
    ) -> DataFrame:
        """Scan every pair of a content in ``docs`` and a rule version that the ledger doesn't have.

        Each row is one revision of a path: ``id_col``, as text, names the path and ``revision_col`` its
        revision (empty without it). ``places`` keeps them all, so that ``located`` tells of rows that
        later scans don't get any more.

        Returns the rows of ``docs``, as (id, ``blob``, ``found``): ``found`` is the array of all
        spans (start, place, kind, end) of the given rules, sorted; ``place`` is the rule's place in
        ``rules``. A null text is the empty content; repeated rows stay; an empty table gives no
        rows; other columns are not looked at.

        Only ids and addresses are grouped, one row of each content is chosen, and its text alone
        goes to the scan. Copies and contents scanned before stay where they are, but for the few that
        a bitmap takes for chosen. Where most contents are new, as in a first scan, their texts move to
        meet their addresses, sorted, so that any number fits; where few are, Spark is free to broadcast
        the addresses if they are small, and then no text moves.
        """
        if len({x.kind for x in rules}) < len(rules):
            raise ValueError("rules must be of different kinds")
        spark, by_kind = self.spark, {x.kind: x for x in rules}
        texts = docs.select(
            F.col(id_col).alias("id"),
            F.coalesce(text_col, F.lit("")).alias("text"),
            F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("blob"),
            (F.lit("") if revision_col is None else F.col(revision_col).cast("string")).alias("revision"),
        )
        here = texts.select(F.col("id").cast("string").alias("path"), "revision", "blob").distinct().alias("h")
        known = [F.col(f"h.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("path", "revision", "blob")]
        stood = self._read("places", PLACES).alias("p")
        here.join(stood, known, "left_anti").write.mode("append").parquet(f"{self.path}/places")
        texts = texts.drop("revision")
        listed = F.array(*(_rule(i, x) for i, x in enumerate(rules)))
        blobs = texts.groupBy("blob").agg(F.min("id").alias("id"))
        pairs = blobs.select("blob", "id", F.inline(listed))
        unseen = pairs.join(self.scanned(), ["blob", "kind", "version"], "left_anti")
        todo = written(unseen.groupBy("blob", "id").agg(F.collect_set("kind").alias("kinds")), "todo")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (rows for whole in batches for rows in byte_slices(whole, 2, MOST)):
                rows = []
                for blob, kinds, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    for kind in kinds:
                        rule = by_kind[kind]
                        rows += [(blob, kind, rule.version, *x) for x in spans(text, rule)]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, _ARROW, strict=True)], names=_NAMES
                )

        chosen = F.col("c.blob").eqNullSafe(F.col("t.blob")) & F.col("c.id").eqNullSafe(F.col("t.id"))
        mostly_new = 2 * todo.count() > blobs.count()
        picked = todo.hint("merge") if mostly_new else todo
        one_of_each = Likely(todo.select(F.xxhash64("blob", "id").alias("h")))
        new = one_of_each.inside(texts, F.xxhash64("blob", "id")).alias("t").join(picked.alias("c"), chosen)
        found = new.select("t.blob", "kinds", "text").mapInArrow(run, FINDINGS)
        found.write.mode("append").parquet(f"{self.path}/findings")
        versions = F.array(*(F.struct(F.lit(x.kind).alias("kind"), F.lit(x.version).alias("version")) for x in rules))
        done = todo.select("blob", "kinds", F.inline(versions)).where(F.array_contains("kinds", F.col("kind")))
        done.select("blob", "kind", "version").write.mode("append").parquet(f"{self.path}/scanned")

        rule_of = spark.range(1).select(F.inline(listed))  # as many rows as there are rules
        by_blob = (
            self.findings()
            .join(F.broadcast(rule_of), ["kind", "version"])
            .groupBy("blob")
            .agg(F.array_sort(F.collect_list(F.struct("start", "place", "kind", "end"))).alias("found"))
        )
        empty = F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>")
        return (
            texts.select("id", "blob")
            .join(by_blob, "blob", "left")
            .select(F.col("id").alias(id_col), "blob", F.coalesce("found", empty).alias("found"))
        )

    def redact(
        self, docs: DataFrame, rules: Sequence[Rule], id_col: str = "doc_id", text_col: str = "text"
    ) -> DataFrame:
        """``docs`` with each span that ``scan`` finds replaced by its kind in brackets.

        Spans that overlap are replaced together, by the first one's kind. Rows without findings,
        null texts among them, stay as they are, and most of them stay where they are.
        """
        scanned = self.scan(docs, rules, id_col, text_col)
        found = scanned.where(F.size("found") > 0).groupBy("blob").agg(F.first("found").alias("found"))
        blob, spans_found = fresh(docs, "found_in"), fresh(docs, "spans_found")
        found = written(found.select(F.col("blob").alias(blob), F.col("found").alias(spans_found)), "found")
        text, there = F.col(text_col), F.col(spans_found).isNotNull()
        # only texts with findings go to Python
        clean = F.when(there, _masked(F.when(there, text), F.col(spans_found))).otherwise(text)
        address = F.sha2(F.coalesce(text, F.lit("")), 256)
        has_spans = Likely(found.select(F.xxhash64(blob).alias("h")))
        touched = has_spans.inside(docs, F.xxhash64(address))
        # sorted, not broadcast below some size: a plan that is the same for any number of findings
        marked = touched.join(found.hint("merge"), address == F.col(blob), "left")
        masked = marked.select(*(clean.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))
        return has_spans.outside(docs, F.xxhash64(address)).unionByName(masked)


def mask(text: str, found: list[dict]) -> str:
    """``text`` with its sorted spans replaced; those that overlap together, by the first one's kind."""
    out, at = [], 0
    for span in found:
        if span["start"] >= at:
            out += [text[at : span["start"]], f"[{span['kind']}]"]
        at = max(at, span["end"])
    return "".join([*out, text[at:]])


@F.arrow_udf(StringType())
def _masked(text: pa.Array, found: pa.Array) -> pa.Array:
    both = ((t.as_py(), s.as_py()) for t, s in zip(text, found, strict=True))
    return pa.array([None if t is None or s is None else mask(t, s) for t, s in both], pa.string())


def _rule(place: int, rule: Rule) -> Column:
    return F.struct(
        F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version")
    )


_NAMES = [x.split(" ")[0] for x in FINDINGS.split(", ")]
_ARROW = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]


def _is_kind(kind: str, span: Column) -> Column:
    return span["kind"] == kind


def span_text(found: Column, base_only: bool = False) -> Column:
    """``kind:start:end`` of the spans, by start and then place, joined by commas."""
    if base_only:
        found = F.filter(found, lambda x: x["place"] < len(BASE))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = BlobLedger(spark, shared_path(spark, "ledger"))
    scanned = ledger.scan(table(spark, sf_dir, "documents"), [*BASE, *MORE])
    counts = [
        F.size(F.filter("found", partial(_is_kind, rule.kind))).cast("long").alias(f"n_{rule.kind}")
        for rule in BASE
    ]
    return scanned.select(
        "doc_id",
        *counts,
        F.sha2(span_text(F.col("found"), base_only=True), 256).alias("base_sha256"),
        span_text(F.col("found")).alias("spans"),
    )
