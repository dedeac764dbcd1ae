"""Shards, neighbours, toxicity, the Jaccard join and the pipeline against brute force."""

import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyhouse.llm import common, jaccard, neighbours, shards, toxicity
from tallyhouse.llm.common import Likely, components, ranked, table, written
from tests.llm.cases import documents, prose, texts

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


def test_ranks_are_gapless_for_a_hot_key(spark):
    rows = spark.range(3000).selectExpr("id % 30 div 29 as k", "id", "1 as part")
    got = defaultdict(list)
    for r in ranked(rows, ["k"], ["id"], ["id"], 7, "rank").collect():
        got[r.k].append(r["rank"])
    assert {k: sorted(v) == list(range(len(v))) for k, v in got.items()} == {0: True, 1: True}


@pytest.mark.parametrize(("rows", "most"), [(0, 1 << 25), (5000, 1 << 25), (5000, 1 << 10)])
def test_bitmaps_hold_all_hashes(spark, monkeypatch, rows, most):
    monkeypatch.setattr(common, "MOST_BITS", most)
    hashes = spark.range(rows).selectExpr("xxhash64(id) as h").union(spark.range(rows // 3).selectExpr("xxhash64(7L)"))
    test = Likely(hashes)
    assert test.outside(hashes, F.col("h")).isEmpty()
    assert test.inside(hashes, F.col("h")).count() == hashes.count()
    others = test.inside(spark.range(10_000, 20_000), F.xxhash64("id")).count()
    assert others <= (10_000 if most < 1 << 25 else 900)
    assert others == 0 or rows


@pytest.mark.parametrize("edges", [[], [("a", "a")], [("b", "a"), ("c", "b"), ("e", "d")], [(f"{i:03}", f"{i + 1:03}") for i in range(60)], [("hub", f"{i:03}") for i in range(80)]])
def test_components(spark, edges):
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {k: v for k, v in plain_components(edges).items() if any(a != b and k in (a, b) for a, b in edges)}


def plain_components(edges, nodes=()):
    root = {x: x for e in edges for x in e} | {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in root}


def plain_longest_first(sizes, n):
    loads = [0] * n
    for size in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += size
    return loads


def test_longest_first():
    pick = np.random.default_rng(2)
    cases = [[7, 7, 6, 5, 4, 4, 3], [1000] + [1] * 500, [50, 49] + [7] * 300 + [1] * 5, [], [3] * 24]
    cases += [pick.integers(1, pick.integers(2, 40), pick.integers(1, 300)).tolist() for _ in range(60)]
    for sizes in cases:
        for n in (1, 3, 8):
            loads, counts = [0] * n, Counter()
            for weight, given in shards.longest_first(Counter(sizes).items(), n):
                counts[weight] += sum(given)
                loads = [load + weight * x for load, x in zip(loads, given, strict=True)]
            assert counts == Counter(sizes) and sorted(loads) == sorted(plain_longest_first(sizes, n))


def test_shards(spark, docs):
    rows = shards.shard_documents(docs, 3).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in texts()
    )
    by_text, slots = {}, defaultdict(list)
    for r in rows:
        assert by_text.setdefault((r.size, r.text_crc32), r.shard) == r.shard
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert shards.shard_documents(documents(spark, [])).count() == 0


def test_small_groups_go_longest_first(spark):
    rows = [(i, prose(i, 1 + i % 50), "a") for i in range(2000)] + [(5000 + i, "copy of one", "b") for i in range(900)]
    got = shards.shard_documents(documents(spark, rows), 8).collect()
    loads, groups = Counter(), Counter()
    for r in got:
        loads[r.shard] += r.size
    for _, text, _ in rows:
        groups[text] += len(text.encode()) + 1
    assert sorted(loads.values()) == sorted(plain_longest_first(groups.values(), 8))
    assert len({r.shard for r in got if r.doc_id >= 5000}) == 1


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, None, None, None) for i, v in rows], "vec_id long, embedding array<float>, id long, v string, block long")


def test_neighbours_are_the_nearest(spark):
    pick = np.random.default_rng(3)
    data = pick.normal(size=(3000, 24)) * pick.uniform(0.2, 3, size=(3000, 1))
    data = data.astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    bad = [[float("nan")] * 24, [0.0] * 24, None, [None] * 24, [float("inf")] * 24, [1.0] * 5]
    rows += [(3000 + i, v) for i, v in enumerate(bad)]
    items = vectors(spark, rows)
    got = defaultdict(list)
    for r in neighbours.nearest(items, items.where("vec_id % 20 = 0"), 20).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 3000, 20))
    wide, hits = data.astype(float), 0
    for q, found in got.items():
        found.sort()
        score = wide @ wide[q]
        assert [x[0] for x in found] == list(range(1, 21)) and q not in [x[1] for x in found]
        assert all(abs(score[i] - s) < 1e-9 for _, i, s in found)
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        score[q] = -np.inf
        hits += len(set(np.argsort(-score)[:20]) & {x[1] for x in found})
    assert hits / (20 * len(got)) >= 0.9


def test_neighbours_of_few_and_equal_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(100, [0.0, 1.0]), (0, [1.0, 0.0])]
    items = vectors(spark, rows)
    got = [(r["rank"], r.vec_id, r.score) for r in neighbours.nearest(items, items.where("vec_id = 0"), 40).orderBy("rank").collect()]
    assert got == [(i, i, 1.0) for i in range(1, 30)] + [(30, 100, 0.0)]
    assert neighbours.nearest(vectors(spark, []), vectors(spark, [])).count() == 0


def test_neighbours_in_a_large_group_of_equal_vectors(spark):
    pick = np.random.default_rng(9)
    data = pick.normal(size=(4000, 24)).astype(np.float32)
    group = np.sort(pick.permutation(4000)[:1400])  # beyond both SHARE of the block and LEAST
    data[group] = data[group[-1]]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)] + [(int(group[3]), [float(x) for x in data[group[3]]])]
    items = vectors(spark, rows)
    got = defaultdict(list)
    asked = sorted(int(i) for i in {*group[:60:4], *group[-5:], *range(0, 4000, 200)})
    for r in neighbours.nearest(items, items.where(items.vec_id.isin(asked)), 20).collect():
        got[r.query_id].append((r["rank"], r.vec_id))
    ids = sorted([*group.tolist(), int(group[3])])
    assert sorted(got) == asked
    for q in set(asked) & set(ids):
        assert [x for _, x in sorted(got[q])] == [i for i in ids if i != q][:20]
    near = data[group[-1]].astype(float) + pick.normal(size=24) / 100
    found = neighbours.nearest(items, vectors(spark, [(9999, [float(x) for x in near])]), 20).orderBy("rank").collect()
    assert [r.vec_id for r in found] == ids[:20]


def test_footrule_of_prefixes():
    pick = np.random.default_rng(1)
    order = np.array([pick.permutation(12)[:6] for _ in range(50)])
    files, query = neighbours.pivot_files(order, 12), pick.permutation(12)[:6]

    def footrule(a, b):
        place = lambda x, p: list(x).index(p) if p in x else len(x)
        return sum(abs(place(a, p) - place(b, p)) for p in {*a, *b})

    near = neighbours.closeness(files, query).astype(int)
    assert [6 * 7 - 2 * x for x in near] == [footrule(a, query) for a in order]


def plain_sets(text, words):
    found = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if len(found) < words:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(zip(*(found[i:] for i in range(words)), strict=False))


def plain_jaccard(rows, rule):
    """(doc_id, n, component) of every row, by comparing all pairs."""
    sets = [plain_sets(t, rule.words) for _, t, *_ in rows]
    links = [
        (i, j)
        for i, a in enumerate(sets) for j, b in enumerate(sets[:i])
        if a and b and rule.den * len(a & b) >= rule.num * len(a | b)
    ]
    root = plain_components(links, range(len(rows)))
    least = defaultdict(list)
    for i, (key, *_) in enumerate(rows):
        if key is not None:
            least[root[i]].append(key)
    return Counter(
        (key, len(sets[i]), min(least[root[i]], default=None) if sets[i] else key) for i, (key, *_) in enumerate(rows)
    )


def edited(seed, n):
    """Texts of ``n`` words each with some words changed: sets around the limit of a link."""
    pick = np.random.default_rng(seed)
    base = [f"w{x}" for x in pick.integers(0, 40 * n, n)]
    out = []
    for _ in range(25):
        own = list(base)
        for at in pick.integers(0, n, pick.integers(0, max(2, n // 12))):
            own[at] = f"v{pick.integers(0, 10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("rule", [jaccard.Rule(3, 90, 100), jaccard.Rule(5, 80, 100), jaccard.Rule(1, 2, 3)])
def test_jaccard_components(spark, rule):
    rows = [(d, t) for d, t, _ in texts() if d != 10]
    for k, n in enumerate((3, 5, 9, 11, 13, 14, 16, 21, 23, 30, 60, 150, 400)):
        rows += [(1000 * (k + 1) + i, t) for i, t in enumerate(edited(k, n))]
    docs = documents(spark, [(d, t, "a") for d, t in rows])
    got = Counter(tuple(r) for r in jaccard.jaccard_components(docs, rule).collect())
    assert got == plain_jaccard(rows, rule)


@pytest.mark.parametrize("below", [1, 8, 25])
def test_jaccard_at_any_boundary(spark, monkeypatch, below):
    monkeypatch.setattr(jaccard, "choose_boundary", lambda sizes, rule: below)
    rows = [(100 * n + i, t) for n in (6, 10, 14, 20, 24, 28) for i, t in enumerate(edited(n, n))]
    docs = documents(spark, [(d, t, "a") for d, t in rows])
    got = Counter(tuple(r) for r in jaccard.jaccard_components(docs, jaccard.Rule(1, 80, 100)).collect())
    assert got == plain_jaccard(rows, jaccard.Rule(1, 80, 100))


def test_jaccard_of_nothing(spark):
    assert jaccard.jaccard_components(documents(spark, [])).count() == 0


@pytest.mark.parametrize("short", [2, 5])
def test_jaccard_of_long_lists(spark, monkeypatch, short):
    """Crowds of near copies, most of them not quite alike, in lists of all lengths."""
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "FREQUENT", 4)
    rows = [(1000 * n + i, t) for n in (40, 90, 200) for i, t in enumerate(edited(n, n) + edited(n, n + 4))]
    docs = documents(spark, [(d, t, "a") for d, t in rows])
    for rule in (jaccard.Rule(3, 90, 100), jaccard.Rule(2, 70, 100)):
        got = Counter(tuple(r) for r in jaccard.jaccard_components(docs, rule).collect())
        assert got == plain_jaccard(rows, rule)


def test_lists_across_batches(monkeypatch):
    monkeypatch.setattr(jaccard, "SHORT", 3)
    pick = np.random.default_rng(6)
    for _ in range(200):
        rows = sorted((int(a), int(b)) for a, b in zip(pick.integers(0, 6, 40), pick.integers(0, 9, 40), strict=True))
        cuts = [0, *sorted(pick.integers(0, 41, 6).tolist()), 40]
        batches = [
            pa.RecordBatch.from_arrays(
                [pa.array([f(r) for r in rows[a:b]], t) for f, t in (
                    (lambda r: r[0], pa.int64()), (lambda r: r[1], pa.int64()),
                    (lambda r: 2 * r[1], pa.int32()), (lambda r: 9, pa.int32()),
                )],
                names=["sig", "k", "at", "n"],
            )
            for a, b in zip(cuts, cuts[1:], strict=False)
        ]
        got = [tuple(r.values()) for b in jaccard._lists(iter(batches)) for r in b.to_pylist()]
        sets = defaultdict(set)
        for a, b in rows:
            sets[a].add(b)
        assert got == [(a, b, 2 * b, 9, len(x) <= 3) for a, x in sorted(sets.items()) if len(x) > 1 for b in sorted(x)]


def test_bitmaps_rule_out_no_link():
    pick = np.random.default_rng(4)
    for n in (5, 60, 64, 65, 300, 1000):
        universe = np.unique(pick.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * 2)
        a, b = universe[:n], np.sort(universe[n // 5 : n + n // 10])
        x, y = sorted((jaccard._bits(a), jaccard._bits(b)), key=len)
        if len(x) < len(y):
            y = y[: len(x)] ^ y[len(x) :]
        assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= len(np.setxor1d(a, b))


def test_segments_are_all_maximal():
    pick = np.random.default_rng(8)
    for _ in range(300):
        scores = pick.choice([-3.0, -1.0, -0.5, 1.0, 2.0, 4.0], pick.integers(0, 25)).tolist()
        assert [(b, e) for b, e, _ in toxicity.segments(scores)] == plain_segments(scores, 0)
        assert all(abs(sum(scores[b:e]) - s) < 1e-9 for b, e, s in toxicity.segments(scores))


def test_segments_take_linear_time():
    pick = np.random.default_rng(1)
    falling = pick.choice([-1.0, 0.5], 1_000_000, p=[0.6, 0.4]).tolist()
    for scores in (falling, [1.0, -1.5] * 500_000, [1.0] * 1_000_000):
        begin = time.process_time()
        found = toxicity.segments(scores)
        assert found and time.process_time() - begin < 10


def plain_segments(scores, offset):
    """The best segment (shortest, leftmost of equals), then the same on both sides of it."""
    best = max(((sum(scores[i:j]), i - j, -i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    i, j = -best[2], -best[2] - best[1]
    return plain_segments(scores[:i], offset) + [(offset + i, offset + j)] + plain_segments(scores[j:], offset + j)


def test_toxicity_on_held_out_labels(spark):
    rows = [(i, prose(i, 60).replace("loser", "at").replace("worthless", "on").replace("trash", "or"), "a") for i in range(600)]
    rows = [(d, f"{t} you Loser! worthless trash" if d % 4 == 0 else t, s) for d, t, s in rows]
    labels = spark.createDataFrame([(d, int(d % 4 == 0)) for d, *_ in rows] + [(None, 1), (9999, None)], "doc_id long, toxic int")
    docs = documents(spark, rows)
    model = toxicity.fit(docs, labels)
    held, right = 0, 0
    for r in toxicity.score_texts(docs, model).collect():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
            held, right = held + 1, right + (r.predicted == int(r.doc_id % 4 == 0))
    assert held > 80 and right / held > 0.97
    text = "Fine words here. İ " + "you Loser! worthless trash" + " and more of them"
    found = toxicity.passages(text, toxicity.Weights(model.words, model.stems), model)
    assert found and all("Loser" in text[b:e] for b, e, *_ in found)
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, *_ in rows if d % 4}


def test_toxicity_of_odd_rows(spark, docs):
    for labels in ([], [(1, 1), (2, 1)], [(1, 1), (1, 0), (7, 0), (8, 0), (4, 1), (15, None)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        got = Counter(r.doc_id for r in toxicity.score_texts(docs, model).collect())
        assert got == Counter(d for d, *_ in texts())
    assert toxicity.score_texts(documents(spark, []), model).count() == 0


def test_pipeline_stages(spark):
    docs = table(spark, SMALL, "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, before, SMALL), "stage")
        if name != "packing":
            assert after.columns == docs.columns
        old, new = before.collect(), after.collect()
        texts_of = {r.doc_id: r.text for r in old}
        if name == "toxicity":
            model = toxicity.fit(before, table(spark, SMALL, "labels"))
            scored = {r.doc_id: r.predicted for r in toxicity.score_texts(before, model).collect()}
            assert {r.doc_id: r.text for r in new} == {d: t for d, t in texts_of.items() if not scored[d]}
        elif name == "near duplicates":
            rule = jaccard.Rule(5, 80, 100)
            groups = plain_jaccard([(r.doc_id, r.text) for r in old], rule)
            assert {r.doc_id: r.text for r in new} == {c: texts_of[c] for _, _, c in groups}
        elif name == "packing":
            assert {r.doc_id for r in new} == set(texts_of)
        else:
            assert {r.doc_id for r in new} <= set(texts_of)
            assert all(r.n_chars == len(r.text) for r in new)
        before = after
    assert corpus_pipeline.run(spark, SMALL).count() == len(new)


def test_repeated_ids_are_documents_of_their_own(spark):
    one, other, third = (prose(i, 80) for i in (1, 2, 3))
    rows = [(1, one, "a"), (1, other, "b"), (1, one, "a"), (2, one, "c"), (3, third, "a"), (None, one, "a"), (None, one, "a"), (4, None, "a"), (4, "", "a")]
    left = corpus_pipeline.near_duplicates(spark, documents(spark, rows), "")
    assert left.columns == documents(spark).columns
    got = Counter((r.doc_id, r.text or "") for r in left.collect())
    assert got == Counter([(1, one), (1, other), (3, third), (None, one), (None, one), (4, "")])


def test_hot_copies_of_a_text(spark):
    """A third of all rows is one text, some under one id; the others are near it or alone."""
    hot = prose(1, 120)
    near = [hot.replace(hot.split()[60 + i], f"other{i}", 1) for i in range(3)]
    rows = [(i, hot, "a") for i in range(20, 50)] + [(20, hot, "b")] * 10
    rows += [(100 + i, x, "c") for i, x in enumerate(near)] + [(200 + i, prose(5 + i, 60), "d") for i in range(70)]
    left = corpus_pipeline.near_duplicates(spark, documents(spark, rows), "")
    rule = jaccard.Rule(5, 80, 100)
    firsts = {c for _, _, c in plain_jaccard([(d, t) for d, t, _ in rows], rule)}
    assert Counter(r.doc_id for r in left.collect()) == Counter(firsts)
    assert len(firsts) < len(rows) - 40


def test_pipeline_stages_are_the_five(spark):
    assert [x for x, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "near duplicates", "secret scans", "packing",
    ]


def test_pipeline_on_odd_rows(spark, tmp_path):
    folder = f"file://{tmp_path}"
    documents(spark).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() > 10
    empty = f"{folder}/empty"
    documents(spark, []).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
