"""The registered queries over the smallest tables, whole, against plain versions by the contract's words."""

import hashlib
import heapq
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from __spark_entry__ import queries
from tests.llm.cases import documents
from tests.llm.cases import texts as odd_texts

FOLDER = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts() -> dict[int, str]:
    """Text by doc_id; ids are unique in this table."""
    table = pd.read_parquet(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"])
    assert table.doc_id.is_unique
    return {int(i): t or "" for i, t in zip(table.doc_id, table.text, strict=True)}


@pytest.fixture(scope="module")
def rows(spark):
    """The rows of a registered query."""
    registered, kept = queries(), {}

    def of(start: str) -> list:
        name = next(x for x in registered if x.startswith(start))
        if name not in kept:
            kept[name] = registered[name](spark, FOLDER).collect()
        return kept[name]

    return of


def by_doc(found: list, texts: dict) -> dict:
    """A row for each document, no more."""
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    return {r["doc_id"]: r for r in found}


ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def secrets_of(text: str) -> tuple:
    """What the base columns must say, and the base spans."""
    assign = [m.span() for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 6]
    access = [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    hexes = [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = (("assign", assign), ("access", access), ("hex", hexes))
    spans = sorted((a, place, kind, b) for place, (kind, ab) in enumerate(kinds) for a, b in ab)
    named = [f"{kind}:{a}:{b}" for a, _, kind, b in spans]
    return len(assign), len(access), len(hexes), sha(",".join(named)), named


def test_op1(rows, texts):
    for i, r in by_doc(rows("op1_"), texts).items():
        *want, named = secrets_of(texts[i])
        assert [r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]] == want
        assert set(named) <= set(r["spans"].split(",")) | {""}


def test_op1_on_odd_rows(spark, tmp_path):
    """Repeated rows and ids, null ids and texts, and secrets, which the table above has none of."""
    given = odd_texts()
    documents(spark, given).write.parquet(f"file://{tmp_path}/documents.parquet")
    found = queries()["op1_secret_scan"](spark, f"file://{tmp_path}").collect()
    base = [(r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in found]
    want = [(i, *secrets_of(text or "")[:4]) for i, text, _ in given]
    assert sorted(base, key=repr) == sorted(want, key=repr) and sum(x[1] + x[2] + x[3] for x in want) == 4


def test_op2(rows, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = by_doc(rows("op2_"), texts)
    for i, text in texts.items():
        ids = library.encode(text)
        want = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
        assert (found[i]["n_tokens"], found[i]["ids_sha256"], found[i]["decoded_sha256"]) == want


def test_op3(rows):
    table = pd.read_parquet(f"{FOLDER}/embeddings.parquet")
    column = next(c for c in table.columns if c != "vec_id" and hasattr(table[c].iloc[0], "__len__") and not isinstance(table[c].iloc[0], str))
    usable = [(int(i), np.asarray(v, float)) for i, v in zip(table.vec_id, table[column], strict=True) if v is not None]
    usable = [(i, v) for i, v in usable if np.isfinite(v).all() and v.any()]
    ids, vectors = np.array([i for i, _ in usable]), np.stack([v for _, v in usable])
    found = defaultdict(list)
    for r in rows("op3_"):
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    asked = [i for i in ids if i % 20 == 0]
    assert sorted(found) == sorted(asked)
    hits = wanted = 0
    for q in asked:
        scores = vectors @ vectors[ids == q][0]
        order = [k for k in np.lexsort((ids, -scores)) if ids[k] != q][:20]
        got = sorted(found[q])
        assert [r for r, _, _ in got] == list(range(1, len(order) + 1))
        assert [(-s, v) for _, v, s in got] == sorted((-s, v) for _, v, s in got)
        at = {int(i): k for k, i in enumerate(ids)}
        assert all(abs(s - scores[at[v]]) < 1e-9 for _, v, s in got)
        hits, wanted = hits + len({v for _, v, _ in got} & {int(ids[k]) for k in order}), wanted + len(order)
    assert hits >= 0.9 * wanted


def test_op4(rows, texts):
    library, found = Tokenizer.from_file(JSON), by_doc(rows("op4_"), texts)
    for i, text in texts.items():
        n = len(library.encode(text, add_special_tokens=False).ids)
        r = found[i]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 512)


def test_op5(rows, texts):
    found = by_doc(rows("op5_"), texts)
    slots, loads, places, weights = defaultdict(list), [0] * 8, defaultdict(set), defaultdict(int)
    for i, text in texts.items():
        r, size = found[i], len(text.encode()) + 1
        assert (r["size"], r["text_crc32"], r["law"]) == (size, zlib.crc32(text.encode()), "bytes")
        assert r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += size
        places[text].add(r["shard"])
        weights[text] += size
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) <= set(range(8))
    assert all(len(x) == 1 for x in places.values())
    plain = [0] * 8
    for weight in sorted(weights.values(), reverse=True):
        heapq.heapreplace(plain, plain[0] + weight)
    assert sorted(loads) == sorted(plain)


def test_op6(rows, texts):
    library, pieces, sequences = Tokenizer.from_file(JSON), defaultdict(list), defaultdict(list)
    for r in rows("op6_"):
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids, at = [*library.encode(text, add_special_tokens=False).ids, 0], 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
    total = sum(n for x in sequences.values() for _, n in x)
    assert total >= 0.98 * 1024 * len(sequences)


def test_op7(rows, texts):
    sets = {}
    for i, text in texts.items():
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = re.findall("[^\x20\x09-\x0d]+", lower)
        sets[i] = {tuple(words[k : k + 3]) for k in range(max(len(words) - 2, min(len(words), 1)))}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ordered = sorted(sets)
    for k, a in enumerate(ordered):
        for b in ordered[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 10 * min(len(x), len(y)) >= 9 * max(len(x), len(y)) and 100 * len(x & y) >= 90 * len(x | y):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    found = by_doc(rows("op7_"), texts)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == {i: (len(sets[i]), top(i)) for i in sets}


def test_op9(rows, texts):
    for i, r in by_doc(rows("op9_"), texts).items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_op10(rows, texts):
    found, down = by_doc(rows("op10_"), texts), sorted(texts, reverse=True)
    for i, after in zip(down, [*down[1:], down[0]], strict=True):
        text, cut, r = texts[i], len(texts[i]) // 3, found[i]
        edited = text[: len(text) - cut] + texts[after][:cut]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), sha(edited))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["fingerprint"] == r["edited_fingerprint"]) >= (text == edited)
        assert r["near_next"] == 1 or texts[after] != text
    prints = defaultdict(set)
    for i, r in found.items():
        prints[texts[i]].add(r["fingerprint"])
    assert all(len(x) == 1 for x in prints.values())
