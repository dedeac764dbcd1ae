"""Jaccard join of word n-gram sets: small sets by enumerated subsets, large ones by inverted lists."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import Likely, byte_slices, components, table, written
from tallyhouse.llm.hashing import joined, mix, range_hashes

#: Bytes of text handled together.
BATCH_BYTES = 1 << 20
#: Sets from this size on always go to the lists; the boundary is chosen below it.
LARGEST_SMALL = 64
#: What an entry of an inverted list costs against a subset: its pairs must still be compared.
LIST_COST = 2
#: Lists up to this length give all pairs that may meet. Longer ones are cleared in two rounds, which
#: move all shingles of their sets.
SHORT = 64
#: A shingle in FREQUENT sets of a chunk of CHUNK shingles is taken for frequent, and ordered behind
#: all others; at most MARKED are marked so. That changes what lists cost, not what is found.
FREQUENT, CHUNK, MARKED = 2, 1 << 21, 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


@dataclass(frozen=True)
class Rule:
    """Sets of ``words``-word shingles link if ``den`` * intersection >= ``num`` * union."""

    words: int = 3
    num: int = 90
    den: int = 100

    def overlap(self, n: int, m: int) -> int:
        """The least intersection of linked sets of sizes n and m."""
        return -(-self.num * (n + m) // (self.num + self.den))

    def partners(self, n: int) -> range:
        """Sizes that a set linked to one of size n can have."""
        return range(-(-n * self.num // self.den), n * self.den // self.num + 1)

    def subsets(self, n: int) -> int:
        """How many subsets a set of size n has to enumerate."""
        return sum(comb(n, self.overlap(n, m)) for m in self.partners(n) if self.overlap(n, m) <= min(n, m))

    def prefix(self, n: int) -> int:
        """Two linked sets share one of so many first shingles of each, in any order of shingles."""
        return n - -(-self.num * n // self.den) + 1


def shingle_sets(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct shingles of all texts, sorted within each, and whose they are.

    Letters A-Z count as a-z; words are runs of bytes other than ASCII white space. A text of fewer
    words is one shingle, one without words has none.
    """
    data, starts, _ = joined([x.encode().lower() for x in texts], b" ")
    inner = ~_SPACE[data]
    edges = np.diff(np.concatenate([[False], inner, [False]]).astype(np.int8))
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    hashes = range_hashes(data, begins, ends - begins)
    owner = np.searchsorted(starts, begins, side="right") - 1
    count = np.bincount(owner, minlength=len(texts))
    with np.errstate(over="ignore"):
        run = np.zeros(len(hashes), np.uint64)
        length = np.zeros(len(hashes), np.uint64)
        for i in range(words):  # short texts and the last words of a text keep a shorter run
            here = slice(0, len(hashes) - i)
            same = owner[here] == owner[i:]
            run[here] = np.where(same, mix(run[here] + hashes[i:], 40 + i), run[here])
            length[here] += same.astype(np.uint64)
        first = np.append(True, owner[1:] != owner[:-1])[: len(owner)]
        whole = (length == words) | (first & (count[owner] < words))
        run = mix(run + length, 50)[whole]
    owner = owner[whole]
    order = np.lexsort((run, owner))
    run, owner = run[order], owner[order]
    new = np.append(True, (run[1:] != run[:-1]) | (owner[1:] != owner[:-1]))[: len(run)]
    return run[new], owner[new]


def _keys(sets: list[np.ndarray]) -> list[tuple[int, str]]:
    """Two names of each set: a number, and one of 128 bits that stands for its content."""
    out = []
    with np.errstate(over="ignore"):
        for x in sets:
            a, b = int(mix(x, 60).sum(dtype=np.uint64)), int(mix(x, 61).sum(dtype=np.uint64))
            short = a - (1 << 64) if a >> 63 else a
            out.append((short, f"{a:016x}{b:016x}"))
    return out


def _read(batches: Iterator[pa.RecordBatch], column: int, words: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches with the shingle sets of their texts."""
    for batch in batches:
        for rows in byte_slices(batch, column, BATCH_BYTES):
            hashes, owner = shingle_sets(rows.column(column).to_pylist(), words)
            cuts = np.searchsorted(owner, np.arange(1, rows.num_rows))
            yield rows, np.split(hashes, cuts)


def _subset_keys(x: np.ndarray, rule: Rule, below: int) -> np.ndarray:
    """For each partner size: the sum of each subset as large as the overlap must be.

    Only pairs whose smaller set is below the boundary are found by subsets.
    """
    n, low = len(x), (1 << 64) - 1
    marks = [int(v) for v in mix(x, 70)]
    total, sums, kinds = sum(marks), [], []
    for m in rule.partners(n):
        overlap = rule.overlap(n, m)
        if min(n, m) < below and overlap <= min(n, m):
            found = [(total - sum(out)) & low for out in combinations(marks, n - overlap)]
            sums += found
            kinds += [(min(n, m) << 20) + max(n, m)] * len(found)
    return mix(np.array(sums, np.uint64), 71) ^ np.array(kinds, np.uint64)


def _prefix_keys(x: np.ndarray, rule: Rule, marked: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a set: those not marked by hash, then the marked by count and hash."""
    most = rule.prefix(len(x))
    if len(marked):
        at = np.minimum(np.searchsorted(marked, x), len(marked) - 1)
        known = marked[at] == x
        if known.any():
            count = np.where(known, counts[at], 0)
            return x[np.lexsort((x, count))[:most]]
    return x[:most]


def _bits(x: np.ndarray) -> np.ndarray:
    """A parity bitmap of at least as many bits as shingles, as 64-bit numbers.

    Bitmaps differ in no more bits than their sets do in shingles.
    """
    size = max(64, 1 << max(len(x) - 1, 0).bit_length())
    odd = np.bincount((mix(x, 90) % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def choose_boundary(sizes: dict[int, int], rule: Rule) -> int:
    """Sets below the returned size enumerate subsets: the boundary at which all cost least.

    ``sizes`` has the number of sets of each size below LARGEST_SMALL.
    """
    saved, best, boundary = 0, 0, 1
    for n in range(1, LARGEST_SMALL):
        saved += sizes.get(n, 0) * (LIST_COST * rule.prefix(n) - rule.subsets(n))
        if saved > best:
            best, boundary = saved, n + 1
    return boundary


def _frequent(chunk: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    shingles, count = np.unique(np.concatenate(chunk), return_counts=True)
    often = count >= FREQUENT
    return shingles[often], count[often]


def _marked(often: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles (k, often), MARKED at most, sorted, and their counts."""
    total = written(often.groupBy("k").agg(F.sum("often").alias("often")), "often")
    least, left = 1 << 62, MARKED
    for r in total.groupBy(F.floor(F.log2("often") * 4).alias("step")).agg(F.count("*").alias("n"), F.min("often").alias("least")).orderBy(F.desc("step")).collect():
        left -= r.n  # a few hundred steps
        if left < 0:
            break
        least = r.least
    rows = total.where(F.col("often") >= least).toArrow()
    k, count = rows["k"].to_numpy().view(np.uint64), rows["often"].to_numpy()
    order = np.argsort(k)
    return k[order], count[order]


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scans sorted lists (sig, k, at, n) and gives those of two or more sets, without repetitions.

    ``short`` tells those of SHORT sets or fewer. No more than the begin of a list is held from
    batch to batch, however long it is.
    """
    names = ["sig", "k", "at", "n"]
    rows = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)]
    going: int | None = None  # a long list that was given in part

    def give(rows: list[np.ndarray], ended: bool) -> tuple[pa.RecordBatch, list[np.ndarray], int | None]:
        sig, k = rows[:2]
        other = np.append(True, (sig[1:] != sig[:-1]) | (k[1:] != k[:-1]))[: len(sig)]
        rows = [x[other] for x in rows]
        sig = rows[0]
        begins = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])[: len(sig)])
        length = np.diff(np.append(begins, len(sig)))
        fresh = sig != going if going is not None else np.ones(len(sig), bool)
        short = np.repeat(length <= SHORT, length) & fresh
        keep = ~(np.repeat(length == 1, length) & fresh)
        hold, long = len(sig), going
        if not ended and len(sig):
            hold = int(begins[-1])
            if not short[-1]:  # all but its last entry, which may be repeated, can go
                long, hold = int(sig[-1]), len(sig) - 1
        out = [x[:hold][keep[:hold]] for x in (*rows, short)]
        batch = pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=[*names, "short"])
        return batch, [x[hold:] for x in rows], long

    for batch in batches:
        new = [batch.column(i).to_numpy() for i in range(4)]
        out, rows, going = give([np.append(x, y) for x, y in zip(rows, new, strict=True)], False)
        yield out
    yield give(rows, True)[0]


def _hopeful(long: DataFrame, rule: Rule) -> DataFrame:
    """The entries of long lists that may be the first common one of a linked pair.

    A set has too few shingles from there on, even for the smallest set it can meet in the list, if
    too many that nobody there has come before: so it is with sets that are not quite alike.
    """
    low = written(long.groupBy("sig").agg(F.min("n").alias("low")), "low")  # so that the join can be split
    smallest = F.greatest(F.col("low"), F.ceil(F.col("n") * rule.num / rule.den))
    overlap = F.ceil((F.col("n") + smallest) * rule.num / (rule.num + rule.den))
    return long.join(low, "sig").where(F.col("n") - F.col("at") >= overlap).select("sig", "k")


def _may_meet(x: str, y: str, rule: Rule) -> Column:
    """Enough shingles from the first common one on, in both sets?"""
    most = F.least(F.col(f"{x}.n") - F.col(f"{x}.at"), F.col(f"{y}.n") - F.col(f"{y}.at"))
    return most * (rule.num + rule.den) >= (F.col(f"{x}.n") + F.col(f"{y}.n")) * rule.num


def _stars(shared: DataFrame) -> DataFrame:
    """Pairs (a, b) of each set of a list and its most central one: the one that most others meet."""
    length = written(shared.groupBy("sig").agg(F.count("*").alias("length")), "length")
    central = written(shared.join(length, "sig").groupBy("k").agg(F.sum("length").alias("met")), "central")
    lead = shared.join(central, "k").groupBy("sig").agg(F.max(F.struct("met", "k"))["k"].alias("a"))
    stars = shared.join(written(lead, "lead"), "sig").where("k <> a")
    return stars.select(F.least("a", "k").alias("a"), F.greatest("a", "k").alias("b")).distinct()


def _sets(texts: DataFrame, classes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(k, key, shingles) of the sets ``wanted`` (k), made again from one text of each: these move, and few others."""
    chosen = written(classes.join(wanted, "k", "left_semi").select("k", "key", "rep", "of_text"), "chosen")
    # by its hash and id a text meets its own class alone, whatever ids are repeated or null
    same = (F.xxhash64("text") == F.col("of_text")) & F.col("id").eqNullSafe(F.col("rep"))
    reps = Likely(chosen.select(F.xxhash64("of_text", "rep").alias("h")))
    own = reps.inside(texts, F.xxhash64(F.xxhash64("text"), "id")).join(chosen, same).select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for rows, found in _read(batches, 1, words):
            keep = []
            for x, (short, key), is_key in zip(found, _keys(found), rows.column(0).to_pylist(), strict=True):
                if key == is_key and key not in seen:  # else a repeated row
                    seen.add(key)
                    keep.append((short, key, x.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in keep], t) for i, t in enumerate((pa.int64(), pa.string(), pa.list_(pa.int64())))],
                names=["k", "key", "shingles"],
            )

    return own.mapInArrow(run, "k long, key string, shingles array<long>")


def _may_link(classes: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """The ``pairs`` (a, b) that sizes and bitmaps of ``classes`` (k, n, bits) don't rule out.

    A bitmap twice as long as the other is folded to its length first.
    """

    def xor(x: Column, y: Column) -> Column:
        return F.zip_with(x, y, lambda v, w: v.bitwiseXOR(w))

    def folded(x: Column, y: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.when(F.size(x) > F.size(y), xor(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half))).otherwise(x)

    x, y = (classes.select(F.col("k").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in "ab")
    bits_a, bits_b = F.col("bits_a"), F.col("bits_b")
    total = F.col("n_a") + F.col("n_b")
    overlap = F.ceil(total * rule.num / (rule.num + rule.den))
    differ = F.aggregate(
        xor(folded(bits_a, bits_b), folded(bits_b, bits_a)), F.lit(0), lambda so_far, v: so_far + F.bit_count(v)
    )
    sizes = overlap <= F.least("n_a", "n_b")
    return pairs.join(x, "a").join(y, "b").where(sizes & (differ <= total - 2 * overlap)).select("a", "b")


def _linked(sets: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose sets are alike, as edges between their long names."""
    x, y = (sets.select(F.col("k").alias(c), F.col("key").alias(f"key_{c}"), F.col("shingles").alias(f"set_{c}")) for c in "ab")
    both = F.size(F.array_intersect("set_a", "set_b")) * (rule.num + rule.den)
    alike = both >= (F.size("set_a") + F.size("set_b")) * rule.num
    return (
        pairs.join(x, "a").join(y, "b").where(alike)
        .select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))
    )


def _across(sets: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (k, root) of different roots that may be linked.

    Of each set the rarest shingles among these sets, so many that linked sets have one of them in
    common, go to the lists of shingles. A set that differs from all others by more than a link
    allows has none but its own there, so a crowd of sets that are not quite alike gives no pairs.
    """
    grams = sets.join(nodes, "k").select("k", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    often = grams.groupBy("s").agg(F.count("*").alias("often"))
    least = F.ceil(F.col("n") * rule.num / rule.den).cast("int")
    rarest = (
        grams.join(often, "s").groupBy("k", "root", "n")
        .agg(F.array_sort(F.collect_list(F.struct("often", "s"))).alias("all"))
        .select("k", "root", "n", F.posexplode(F.slice("all", F.lit(1), F.col("n") - least + 1)).alias("at", "gram"))
        .where("gram.often > 1")
        .select("k", "root", "n", "at", "gram.s")
    )
    rarest = written(rarest, "rarest")
    x, y = rarest.alias("x"), rarest.alias("y")
    apart = F.col("x.root") < F.col("y.root")
    pairs = x.join(y, (F.col("x.s") == F.col("y.s")) & apart & _may_meet("x", "y", rule))
    return pairs.select(F.col("x.k").alias("a"), F.col("y.k").alias("b")).distinct()


def jaccard_components(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``.

    Rows are linked if their sets are alike by ``rule``, and components are what links join;
    ``component_id`` is the smallest id in it. Equal sets are one node, so copies cost nothing
    further. Null and empty texts, and those without words, have no set and are components of
    their own. Null ids are larger than any; a component of nothing else has a null id. Repeated
    rows stay, an empty table gives no rows, other columns are not looked at.

    Two sets below the boundary, or one below and one above, share a subset of the size that their
    intersection must have. Two larger ones share one of their first shingles, in an order that has
    frequent shingles last; inverted lists are scanned of these alone. Short lists give all their
    pairs. In a long one each set is paired with the list's most central set; if the links found
    leave a long list in several components, its sets are paired across these where they share one
    of the rarest shingles. Sizes and bitmaps rule out most pairs, the sets decide on the others.
    Any link between components is found by that.
    """
    words = rule.words
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    hashed = texts.select("id", "text", F.xxhash64("text").alias("of_text"))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        chunk, held = [], 0

        def frequent() -> pa.RecordBatch:
            found, count = _frequent(chunk)
            rest = [pa.nulls(len(found), t) for t in (ids, pa.int64(), pa.string(), pa.list_(pa.int64()), pa.int64())]
            columns = [*rest[:2], pa.array(found.view(np.int64)), *rest[2:], pa.array(count.astype(np.int64))]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for rows, sets in _read(batches, 1, words):
            keys, ids = _keys(sets), rows.schema.field(0).type
            columns = [
                rows.column(0), pa.array([len(x) for x in sets], pa.int64()),
                pa.array([a for a, _ in keys], pa.int64()), pa.array([b for _, b in keys], pa.string()),
                pa.array([_bits(x) for x in sets], pa.list_(pa.int64())), rows.column(2), pa.nulls(len(sets), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            for x, (_, key) in zip(sets, keys, strict=True):
                if key not in seen:
                    seen.add(key)
                    chunk.append(x)
                    held += len(x)
            if held > CHUNK:
                yield frequent()
                seen, chunk, held = set(), [], 0
        if chunk:
            yield frequent()

    schema = f"id {id_type}, n long, k long, key string, bits array<long>, of_text long, often long"
    names = [x.split(" ")[0] for x in schema.split(", ")]
    found = written(hashed.mapInArrow(sizes, schema), "sets")
    named = found.where("often is null")
    small = named.where((F.col("n") > 0) & (F.col("n") < LARGEST_SMALL)).groupBy("n").count()
    below = choose_boundary({x.n: x["count"] for x in small.collect()}, rule)
    marked, counts = _marked(found.where("often is not null").select("k", "often"))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for _, sets in _read(batches, 1, words):
            out: list[tuple[np.ndarray, int, np.ndarray, int]] = []
            for x, (short, key) in zip(sets, _keys(sets), strict=True):
                if not len(x) or key in seen:
                    continue
                if len(seen) < 1 << 18:
                    seen.add(key)
                if rule.partners(len(x)).start < below:
                    sig = _subset_keys(x, rule, below)
                    out.append((sig, short, np.zeros(len(sig), np.int32), len(x)))
                if len(x) >= below:
                    sig = _prefix_keys(x, rule, marked, counts)
                    out.append((sig, short, np.arange(len(sig), dtype=np.int32), len(x)))
            if out:
                columns = [
                    np.concatenate([s.view(np.int64) for s, *_ in out]),
                    np.repeat(np.array([k for _, k, *_ in out], np.int64), [len(s) for s, *_ in out]),
                    np.concatenate([at for _, _, at, _ in out]),
                    np.repeat(np.array([n for *_, n in out], np.int32), [len(s) for s, *_ in out]),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["sig", "k", "at", "n"])

    entry_schema = "sig long, k long, at int, n int"
    lists = texts.mapInArrow(entries, entry_schema).repartition("sig").sortWithinPartitions("sig", "k")
    shared = written(lists.mapInArrow(_lists, f"{entry_schema}, short boolean"), "lists")
    one_text = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "of_text")).alias("one")
    classes = named.where("n > 0").groupBy("k", "key").agg(one_text, F.first("n").alias("n"), F.first("bits").alias("bits"))
    classes = written(classes.select("k", "key", "one.id", "one.of_text", "n", "bits").withColumnRenamed("id", "rep"), "classes")
    long = written(_hopeful(shared.where("not short"), rule), "long")
    x, y = (shared.where("short").alias(c) for c in "xy")
    one = F.col("x.k") < F.col("y.k")
    near = x.join(y, (F.col("x.sig") == F.col("y.sig")) & one & _may_meet("x", "y", rule))
    pairs = near.select(F.col("x.k").alias("a"), F.col("y.k").alias("b")).union(_stars(long)).distinct()
    first = written(_may_link(classes, pairs, rule), "pairs")
    links = written(_linked(written(_sets(texts, classes, _ends(first), words), "shingles"), first, rule), "links")
    root = written(components(links), "roots")
    # long lists whose sets are still in several components: compare across these
    placed = classes.join(root, F.col("key") == F.col("node"), "left").select("k", F.coalesce("root", "key").alias("root"))
    entry = written(long.join(placed, "k"), "entries")
    still = entry.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    nodes = written(entry.join(still, "sig", "left_semi").select("k", "root").distinct(), "open")
    if not nodes.isEmpty():
        sets = written(_sets(texts, classes, nodes.select("k"), words), "open_sets")
        across = written(_may_link(classes, _across(sets, nodes, rule), rule), "across")
        more = written(_linked(sets, across, rule), "more_links")
        if not more.isEmpty():
            root = written(components(links.union(more)), "roots")
    # one row for each set; written, so that the join with its copies can be split
    joined_to = classes.join(root, F.col("key") == F.col("node"), "left").withColumn("root", F.coalesce("root", "key"))
    joined_to = written(joined_to.select("key", "root", "rep"), "joined_to")
    least = joined_to.groupBy("root").agg(F.min("rep").alias("component"))
    labels = written(joined_to.join(written(least, "least"), "root").select("key", "component"), "labels")
    return named.join(labels, "key", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"),
    )


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("k")).union(pairs.select("b")).distinct()


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), Rule(words=3, num=90, den=100))
