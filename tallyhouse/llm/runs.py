"""Periodic runs of words: Lyndon roots extended both ways by common prefixes from suffix trees."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import byte_slices, table

#: A run has this many words, and repeats its period this often, at least.
LEAST, TIMES = 6, 4
#: Bytes of text that are handled together.
MOST = 1 << 20
#: Rounds in which places that can't be in a run are ruled out; more would rule out little more.
ROUNDS = 16


def suffix_tree(text: list[int]) -> tuple[array, array, dict[int, int], int]:
    """Ukkonen's tree of ``text``, whose last symbol stands nowhere else.

    Where each node's edge begins and ends in the text (a leaf's end is the text's), and the nodes
    below each node: by node * size + symbol. The root is node 0.
    """
    n, size = len(text), max(text) + 1
    begin, end, link = array("q", [0]), array("q", [0]), array("q", [0])
    below: dict[int, int] = {}
    active = edge = length = waiting = 0
    for i, symbol in enumerate(text):
        made = 0
        waiting += 1
        while waiting:
            if not length:
                edge = i
            key = active * size + text[edge]
            child = below.get(key)
            if child is None:
                below[key] = len(begin)
                begin.append(i)
                end.append(n)
                link.append(0)
                if made:
                    link[made] = active
                    made = 0
            else:
                from_, to = begin[child], end[child]
                span = (to if to <= i else i + 1) - from_
                if length >= span:
                    edge += span
                    length -= span
                    active = child
                    continue
                if text[from_ + length] == symbol:
                    if made:
                        link[made] = active
                    length += 1
                    break
                split = len(begin)
                below[key] = split
                begin.append(from_)
                end.append(from_ + length)
                link.append(0)
                below[split * size + symbol] = split + 1
                begin.append(i)
                end.append(n)
                link.append(0)
                begin[child] = from_ + length
                below[split * size + text[from_ + length]] = child
                if made:
                    link[made] = split
                made = split
            waiting -= 1
            if active:
                active = link[active]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return begin, end, below, size


class Prefixes:
    """Lengths of common prefixes of two suffixes, in constant time each.

    The Euler tour of the suffix tree, children in the order of their symbols, with an inner node
    noted between any two of its children: leaves and inner nodes take turns, and the least depth
    between two leaves is that of their lowest common ancestor. A table of minima over ranges of
    powers of two finds it. ``rank`` is the place of each suffix among the leaves.
    """

    def __init__(self, text: list[int]):
        begin, end, below, size = suffix_tree(text)
        n, nodes = len(text), len(begin)
        keys = np.fromiter(below.keys(), np.int64, len(below))
        order = np.argsort(keys)
        children = np.fromiter(below.values(), np.int64, len(below))[order].tolist()
        first = np.searchsorted(keys[order] // size, np.arange(nodes + 1)).tolist()
        depth = [0] * nodes
        leaves, between, stack = [], [], [0]
        while stack:
            x = stack.pop()
            if x < 0:
                between.append(~x)
            elif first[x] == first[x + 1]:
                leaves.append(n - depth[x])
            else:
                here = depth[x]
                for child in children[first[x] : first[x + 1]][::-1]:
                    depth[child] = here + end[child] - begin[child]
                    stack += (child, ~here)
                stack.pop()
        self.rank = np.empty(n, np.int64)
        self.rank[leaves] = np.arange(n)
        self.least = [np.array(between, np.int32)]
        while (half := 1 << (len(self.least) - 1)) * 2 <= len(between):
            last = self.least[-1]
            self.least.append(np.minimum(last[:-half], last[half:]))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The lengths of the common prefixes of the suffixes at ``i`` and at ``j``, none the same."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        step = np.frexp(high - low)[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(step):
            of, row = step == k, self.least[k]
            out[of] = np.minimum(row[low[of]], row[high[of] - (1 << int(k))])
        return out


def _next_below(rank: list[int]) -> list[int]:
    """For each place the next one of a lower rank; the end where there is none."""
    out, stack = [len(rank)] * len(rank), []
    for j, x in enumerate(rank):
        while stack and rank[stack[-1]] > x:
            out[stack.pop()] = j
        stack.append(j)
    return out


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of at least LEAST words and TIMES periods, sorted.

    The longest Lyndon word at a place goes up to the next smaller suffix, and in the opposite order
    of symbols up to the next greater one. One of them is a root in the first period of any run; the
    run goes as far to the right as the suffixes at the root and behind it agree, and to the left as
    far as those of the reversed text do.
    """
    n = len(words)
    symbols = (np.unique(words, return_inverse=True)[1] + 1).tolist()
    forward = Prefixes([*symbols, 0])
    rank = forward.rank[:n]
    places = np.arange(n)
    ends = [np.array(_next_below(x.tolist()), np.int64) for x in (rank, -rank)]
    start, after = np.concatenate([places, places]), np.concatenate(ends)
    start, after = start[after < n], after[after < n]
    period = after - start
    right = forward.common(start, after)
    # from its first root on, a run has less than a period before, so this much is still to come
    long = right >= (TIMES - 2) * period + 1
    start, after, period, right = (x[long] for x in (start, after, period, right))
    if not len(start):
        return []
    backward = Prefixes([*symbols[::-1], 0])
    left = backward.common(n - start, n - after)
    found = np.unique(np.stack([start - left, left + period + right, period], 1), axis=0)
    keep = found[:, 1] >= np.maximum(LEAST, TIMES * found[:, 2])
    return sorted(map(tuple, found[keep].tolist()), key=lambda x: (x[0], x[2]))


def stretches(words: np.ndarray) -> list[tuple[int, int]]:
    """Where runs can be: disjoint ranges such that every run is inside one of them.

    Within a run of period q every three words behind the first period stood q words before, so the
    distance to where they stood last is at most q, and there are 3 q - 2 such places in a row or
    more. Rows of places that are too short for their distances can't be in a run.
    """
    n, width = len(words) - 2, int(words.max()) + 1 if len(words) else 1
    if n < LEAST - 2:
        return []
    pairs = words[:-1] * width + words[1:]
    if width > 1 << 20:
        pairs, width = np.unique(pairs, return_inverse=True)[1], 1 << 31
    grams = pairs[:-1] * width + words[2:]
    order = np.argsort(grams, kind="stable")
    back = np.full(n, n + 3, np.int64)
    again = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    if len(again) < LEAST - 3:
        return []
    back[order[again + 1]] = order[again + 1] - order[again]
    maybe = back <= n
    for _ in range(ROUNDS):
        edges = np.diff(np.concatenate([[False], maybe, [False]]).astype(np.int8))
        begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        size = np.zeros(n, np.int64)
        size[maybe] = np.repeat(ends - begins, ends - begins)
        left = maybe & (back <= (size + 2) // 3) & (size >= LEAST - 3)
        if (left == maybe).all():
            break
        maybe = left
    edges = np.diff(np.concatenate([[False], maybe, [False]]).astype(np.int8))
    out: list[tuple[int, int]] = []
    for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
        low, high = max(a - (b - a + 2) // 3, 0), b + 2
        while out and out[-1][1] >= low:
            low, high = min(low, out[-1][0]), max(high, out.pop()[1])
        out.append((low, high))
    return out


def find_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a text's words; trees are built where runs can be."""
    names: dict[bytes, int] = {}
    numbers = np.array([names.setdefault(x, len(names)) for x in words], np.int64)
    found = [(low + s, size, q) for low, high in stretches(numbers) for s, size, q in runs_of(numbers[low:high])]
    return sorted(found, key=lambda x: (x[0], x[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains behind its first period, one space between."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, size, period in runs:
        gone[start + period] += 1
        gone[start + size] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0)])


_RUNS = "array<struct<start: long, length: long, period: long>>"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``runs`` sorted by start and period, and ``collapsed``.

    Words are bytes between ASCII white space, numbered from 0. A run is a longest stretch with a
    smallest period that holds LEAST words and TIMES periods. ``collapsed`` keeps the first period of
    each run, words joined by one space. Null texts, empty ones and those without words have no runs
    and an empty ``collapsed``; repeated rows stay; an empty table gives no rows; other columns are
    not looked at. Memory is a few hundred bytes for each word of the longest stretch that repeats.
    """
    struct = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in byte_slices(batch, 1, MOST):
                found, texts = [], []
                for text in rows.column(1):
                    words = text.as_py().split()
                    found.append(find_runs(words))
                    texts.append(collapsed(words, found[-1]))
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                flat = np.array([x for own in found for x in own], np.int64).reshape(-1, 3)
                all_runs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(struct))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.ListArray.from_arrays(pa.array(ends), all_runs), pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["id", "runs", "collapsed"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).cast("binary").alias("text"))
    return slim.mapInArrow(run, f"id {kind}, runs {_RUNS}, collapsed string").withColumnRenamed("id", id_col)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of ``docs``; in a tenth of the texts, by their id, all from some word on repeats."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    n = F.size(words)
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    root = F.slice(words, a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(root, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return docs.select("doc_id", F.when((h % 10 == 0) & (n > 0), planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text")))
    ranked = F.transform(
        "runs",
        lambda x: F.struct(x["length"].alias("length"), (-x["start"]).alias("back"), (-x["period"]).alias("short")),
    )
    top = F.array_max(ranked)
    line = F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"]))
    listed = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-top["back"]).alias("start"),
        top["length"].alias("length"),
        (-top["short"]).alias("period"),
        F.floor(1000 * top["length"] / -top["short"]).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
