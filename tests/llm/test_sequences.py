"""Byte pairs, repaired conversations and periodic runs against plain versions of themselves."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallyhouse.llm import bytepairs, dialogues, runs
from tests.llm.cases import documents, texts
from tests.llm.test_text_operators import odd_texts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(model, text):
    return memoryview(model.encode(text)).cast("i").tolist()


def test_bytepairs_are_the_librarys(library, monkeypatch):
    monkeypatch.setattr(bytepairs, "REMEMBERED", 50)
    monkeypatch.setattr(bytepairs, "PAIRS", 50)
    model = bytepairs.BytePairs(RANKS, public_tokenizers.PATTERN)
    some = [*odd_texts(3000), *(t or "" for _, t, _ in texts()), "ab" * 20_000, "=" * 9_999, "漢字" * 9_000, "\x1c \x85\xa0"]
    for text in some:
        ids = ids_of(model, text)
        assert ids == library.encode_ordinary(text), text[:80]
        assert model.decode(ids) == text.encode()


def test_every_code_point_splits_as_in_the_library(library):
    model = bytepairs.BytePairs(RANKS, public_tokenizers.PATTERN)
    for c in range(0, 0x30000, 7):
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}1{chr(c)} {chr(c)}  a"
            assert ids_of(model, text) == library.encode_ordinary(text), hex(c)


def test_op11_over_a_table(docs, library, spark, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = bytepairs.op11_bytepairs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = Counter()
    for key, text, _ in texts():
        ids = library.encode_ordinary(text or "")
        want[key, len(ids), sha(",".join(map(str, ids))), sha(text or "")] += 1
    assert Counter(map(tuple, got.collect())) == want


def test_decoding_other_ids(spark):
    rows = spark.createDataFrame([(1, [300, 5]), (2, []), (3, None)], "doc_id long, ids array<int>")
    got = bytepairs.decode_bytepairs(rows, RANKS, public_tokenizers.PATTERN).collect()
    model = bytepairs.BytePairs(RANKS, public_tokenizers.PATTERN)
    assert {x.doc_id: bytes(x.bytes) for x in got} == {1: model.decode([300, 5]), 2: b"", 3: b""}
    none = bytepairs.encode_bytepairs(documents(spark, []), RANKS, public_tokenizers.PATTERN)
    assert none.count() == 0


SPACES = " \t\n\x0b\x0c\r"


def plain_repair(rows):
    """(counts, cost, audit, repaired) of rows (turn, role, text) by trying all targets in full."""
    faults, seen = [], set()
    for _, role, text in rows:
        trimmed = text.strip(SPACES)
        faults.append(
            "blank" if not trimmed else "duplicate" if (role, text) in seen else "truncated" if trimmed[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    n, best = len(rows), None
    goals = [("s" if x % 2 else "") + "ua" * (x // 2) for x in range(2 * n + 3) if x != 1]
    for goal in goals:
        m = len(goal)
        cell = {(n, m): (0, "")}
        for i in range(n, -1, -1):
            for j in range(m, -1, -1):
                ways = []
                if i < n:
                    cost, audit = cell[i + 1, j]
                    ways.append((cost + 4, "D" + audit))
                if i < n and j < m and faults[i] not in ("blank", "duplicate"):
                    cost, audit = cell[i + 1, j + 1]
                    cost += 3 * (faults[i] == "truncated")
                    if rows[i][1][:1] == goal[j]:
                        ways.append((cost, "K" + audit))
                    if goal[j] != "s":
                        ways.append((cost + 3, "R" + audit))
                if j < m and goal[j] != "s":
                    cost, audit = cell[i, j + 1]
                    ways.append((cost + 3, "I" + audit))
                cell[i, j] = min([*ways, *([cell[i, j]] if (i, j) in cell else [])], default=(1 << 30, ""))
        best = min(x for x in (best, (*cell[0, 0], goal)) if x is not None)
    cost, audit, goal = best
    out, i, j = [], 0, 0
    for edit in audit:
        if edit in "KRI":
            role = {"u": "user", "a": "assistant"}.get(goal[j])
            out.append(("" if edit == "I" else rows[i][2], rows[i][1] if edit == "K" else role))
            j += 1
        i += edit != "I"
    numbers = [t for t, *_ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, sha("\n".join(f"{r}:{t}" for t, r in out)))


def plain_dialogues(conversations):
    want = {}
    for conv, turn, role, text in conversations:
        rows = want.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        rows += [] if fate == 0 else [(turn, role, text)] * (2 if fate == 3 else 1)
    for rows in want.values():
        digest = {x: hashlib.sha256(f"{len(x[1])}:{x[1]}{x[2]}".encode()).hexdigest() for x in rows}
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], digest[x]))
    return {conv: plain_repair(rows) for conv, rows in want.items()}


def conversations(seed, many):
    pick = random.Random(seed)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None]
    said = ["Yes.", "No!", "why?", "cut off", "", " \n", None, "the same.", "漢字。", "end. \t"]
    rows = []
    for conv in [*range(many), None]:
        size = pick.choice([1, 2, 3, 5, 8, 13])
        turns = [pick.choice([*range(size), None]) if pick.random() < 0.2 else t for t in range(size)]
        usual = ["system"] * (conv is not None and conv % 3 == 0) + ["user", "assistant"] * size
        for t, role in zip(turns, usual, strict=False):
            odd = pick.random() < 0.25
            rows.append((conv, t, pick.choice(roles) if odd else role, pick.choice(said) if odd else f"words {pick.randrange(99)}."))
    long = [(-5, t, ("user", "assistant")[pick.random() < 0.5], f"turn {pick.randrange(40)}.") for t in range(90)]
    pick.shuffle(rows)
    return [*rows, *rows[:9], *long]


@pytest.mark.parametrize("block", [1, 4, 24])
def test_blocks_join_to_the_least_audit(block):
    pick = random.Random(block)
    for _ in range(250):
        size = pick.randrange(9)
        turns = [(pick.choice("suaa u"), pick.choice([0, 0, 0, 1, 2, 3])) for _ in range(size)]
        texts_of = {0: "whole.", 3: "cut off"}
        rows = [(i, x, f"{i} {texts_of.get(f, '')}" if f in texts_of else "") for i, (x, f) in enumerate(turns)]
        turns = [(x, dialogues.BLANK if f in (1, 2) else f) for x, f in turns]
        cut = [turns[i : i + block] for i in range(0, size, block)]
        states = range(4)
        blocks = [{s: dialogues.options(x, s) for s in (states if i else [0])} for i, x in enumerate(cut)]
        assert dialogues.join_blocks(blocks) == plain_repair(rows)[5:7], turns


@pytest.mark.parametrize("block", [3, 24])
def test_op12_over_a_table(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(dialogues, "BLOCK", block)
    rows = conversations(block, 60)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("conv", "body", "fault", "digest", "audit", "gone", "copy"):
        frame = frame.withColumn(c, F.lit(7))
    frame.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = dialogues.op12_dialogues(spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = [tuple(x) for x in got.collect()]
    want = plain_dialogues(rows)
    assert len(found) == len(want)
    assert {x[0]: x[1:] for x in found} == want


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    audits = dialogues.audit_turns(none)
    assert audits.count() == 0
    assert dialogues.repaired_turns(none, audits).count() == 0


def plain_runs(words):
    """Runs by comparing all words at each distance."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            run = words[start : i + q]
            smaller = any(run[d:] == run[:-d] for d in range(1, q))
            if len(run) >= max(6, 4 * q) and not smaller:
                out.append((start, len(run), q))
    return sorted(out, key=lambda x: (x[0], x[2]))


def periodic(pick):
    kinds, words = pick.choice([1, 2, 2, 3, 4, 8]), []
    while len(words) < pick.randrange(60):
        part = [b"%d" % pick.randrange(kinds) for _ in range(pick.randrange(1, 7))]
        words += part * pick.choice([1, pick.randrange(1, 8)])
    return words


def test_runs_are_all_there():
    pick = random.Random(9)
    for _ in range(1500):
        words = periodic(pick)
        want = plain_runs(words)
        assert runs.find_runs(words) == want, words
        if words:  # trees over the whole text find the same
            assert runs.runs_of(np.unique(words, return_inverse=True)[1]) == want


@pytest.mark.parametrize("words", [[b"x"] * 50_000, [b"%d" % (i % 9_000) for i in range(50_000)]])
def test_long_runs_take_linear_time(words):
    period = len(set(words))
    assert runs.find_runs(words) == [(0, 50_000, period)]
    assert runs.collapsed(words, runs.find_runs(words)) == b" ".join(words[:period])


def test_common_prefixes():
    pick = random.Random(4)
    text = [pick.randrange(1, 4) for _ in range(200)]
    found = runs.Prefixes([*text, 0])
    i, j = np.array([(a, b) for a in range(200) for b in range(a + 1, 200)]).T

    def plain(a, b):
        return next((k for k in range(200 - b) if text[a + k] != text[b + k]), 200 - b)

    assert found.common(i, j).tolist() == [plain(a, b) for a, b in zip(i, j, strict=True)]


def plain_op13(key, text):
    words = (text or "").encode().split()
    n = len(words)
    h = None if key is None else zlib.crc32(str(key).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words) if n < 3_000 else runs.find_runs(words)
    top = min(((-size, s, q) for s, size, q in found), default=None)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    kept = b" ".join(x for i, x in enumerate(words) if i not in gone)
    best = (None,) * 4 if top is None else (top[1], -top[0], top[2], -1000 * top[0] // top[2])
    return (len(found), *best, sha("".join(f"{s},{size},{q}\n" for s, size, q in found)), sha(kept))


def test_op13_over_a_table(spark, tmp_path):
    pick = random.Random(2)
    rows = [*texts(), *((i, b" ".join(periodic(pick)).decode(), "a") for i in range(1000, 1200))]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = runs.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    want = Counter((key, *plain_op13(key, text)) for key, text, _ in rows)
    assert Counter(map(tuple, got.collect())) == want
    assert runs.periodic_runs(documents(spark, [])).count() == 0
