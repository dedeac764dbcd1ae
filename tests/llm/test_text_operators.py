"""Tokens, pieces, packing, secrets, fingerprints and lines against plain versions of themselves."""

import hashlib
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from tallyhouse.llm import fingerprints, lines, packing, pieces, secrets, tokens
from tallyhouse.llm.common import written
from tests.llm.cases import documents, texts

JSON = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    *"abcdeinorst", " ", "  ", "\n", "\t", "\r", ".", ",", "'", "é", "ß", "漢", "😀", "ﬁ", "▁", "́", " ",
    "<s>", "0", "9", "the", " " * 37, "tion", "aaaa", "====", "<|endoftext|>", "'ll", "²", "—",
]


def odd_texts(n: int) -> list[str]:
    pick = random.Random(5)
    return ["".join(pick.choice(ODD) for _ in range(pick.randrange(40))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(JSON)


def counted(rows):
    return Counter(tuple(r) for r in rows)


def test_token_counts(docs, tokenizer, spark):
    got = counted(tokens.count_tokens(docs, JSON).collect())
    want = Counter()
    for key, text, _ in texts():
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        want[key, len((text or "").encode()), n, n > 512] += 1
    assert got == want
    assert tokens.count_tokens(documents(spark, []), JSON).count() == 0


def test_token_counts_of_a_model():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    some = odd_texts(200)
    assert tokens.lengths(some, MODEL).tolist() == [len(x) for x in model.encode(some)]


def test_long_texts_are_cut_where_no_token_crosses(tokenizer):
    text = " ".join(odd_texts(3000))
    from tallyhouse.llm.common import safe_pieces

    cut = safe_pieces(text, 500)
    assert "".join(cut) == text and len(cut) > 10
    assert sum(len(tokenizer.encode(x).ids) for x in cut) == len(tokenizer.encode(text).ids)


def test_pieces_are_those_of_the_library(docs, spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    own = pieces.PieceBpe(MODEL)
    for text in odd_texts(3000):
        ids = np.frombuffer(own.encode(text), "<i4").tolist()
        assert ids == model.encode(text)
        assert own.decode(ids) == model.decode(ids)
    both = pieces.decode_pieces(pieces.encode_pieces(docs, MODEL), MODEL).collect()
    got = Counter((r.doc_id, tuple(r.ids), r.text) for r in both)
    want = Counter()
    for key, text, _ in texts():
        ids = model.encode(text or "")
        want[key, tuple(ids), model.decode(ids)] += 1
    assert got == want
    assert pieces.encode_pieces(documents(spark, []), MODEL).count() == 0


def test_both_encoders_agree(tokenizer):
    own = packing.ByteBpe(JSON)
    for text in odd_texts(3000):
        assert own.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_places_every_id_once(docs, tokenizer, spark):
    cut = written(packing.token_pieces(docs, JSON, with_ids=True), "pieces")
    rows = packing.pack(cut).collect()
    assert set(packing.pack(cut).columns) == {*cut.columns, "sequence_id", "offset"}
    by_doc, by_sequence = {}, {}
    for r in rows:
        ids = np.array(r.ids, "<u4")
        assert r.ids_crc32 == zlib.crc32(ids.tobytes()) and r.length == len(ids)
        by_doc.setdefault(r.doc_id, []).append((r.start, r.ids, r.doc_tokens))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    unique = {d: t for d, t, _ in texts() if d not in (None, 3)}
    for key, text in unique.items():
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(by_doc[key])
        assert [i for _, ids, _ in own for i in ids] == want and {n for *_, n in own} == {len(want)}
    assert len(by_doc[3]) == 2 * len({s for s, *_ in by_doc[3]})
    empty = written(packing.token_pieces(documents(spark, []), JSON), "pieces")
    assert packing.pack(empty).count() == 0


def test_packing_wastes_little():
    pick = random.Random(2)
    sizes = {n: pick.randrange(1, 60) for n in range(1, 1025)}
    plan = packing.plan_packs(sizes, 1024)
    assert Counter({n: sum(c for x, _, c, *_ in plan if x == n) for n in sizes}) == Counter(sizes)
    packs = 1 + max(first + count for _, _, count, first, _ in plan) - 1
    assert sum(n * c for n, c in sizes.items()) / (1024 * packs) > 0.97


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return found + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


def test_secret_spans(docs, spark, folder):
    ledger = secrets.BlobLedger(spark, f"{folder}/ledger")
    got = Counter(
        (r.doc_id, r.blob, tuple((x.start, x.place, x.kind, x.end) for x in r.found))
        for r in ledger.scan(docs, secrets.BASE).collect()
    )
    want = Counter()
    for key, text, _ in texts():
        blob = hashlib.sha256((text or "").encode()).hexdigest()
        want[key, blob, tuple(sorted(base_spans(text or "")))] += 1
    assert got == want and any(found for _, _, found in got)


def test_ledger_scans_each_blob_and_rule_version_once(spark, folder):
    ledger = secrets.BlobLedger(spark, f"{folder}/ledger")
    first = documents(spark, [(1, "token=abcdef1", "a"), (2, "token=abcdef1", "b"), (3, "none", "c")])
    assert {r.doc_id: len(r.found) for r in ledger.scan(first, secrets.BASE).collect()} == {1: 1, 2: 1, 3: 0}
    assert ledger.scanned().count() == 2 * 3
    found = spark.read.parquet(f"{folder}/ledger/findings").count()
    again = documents(spark, [(1, "token=abcdef1", "a"), (4, "token=zzzzzz9", "b")])
    assert {r.doc_id: len(r.found) for r in ledger.scan(again, secrets.BASE).collect()} == {1: 1, 4: 1}
    assert spark.read.parquet(f"{folder}/ledger/findings").count() == found + 1  # the old blob wasn't read again
    newer = [secrets.Rule("assign", "token=(z+)", 1, group=1, version=2), *secrets.BASE[1:]]
    assert {r.doc_id: len(r.found) for r in ledger.scan(again, newer).collect()} == {1: 0, 4: 1}
    assert ledger.scanned().where("kind = 'assign' and version = 2").count() == 2
    assert ledger.scan(documents(spark, []), secrets.BASE).count() == 0


def test_findings_join_back_to_all_paths_and_revisions(spark, folder):
    ledger = secrets.BlobLedger(spark, f"{folder}/ledger")
    schema = "file string, commit string, text string, revision int"
    old = [("a", "c1", "token=abcdef1", 5), ("b", "c1", "token=abcdef1", 5), ("a", "c2", "clean", 5), (None, None, None, 5)]
    ledger.scan(spark.createDataFrame(old, schema), secrets.BASE, "file", "text", "commit").count()
    new = [("a", "c3", "clean", 5), ("c", "c3", "token=abcdef1", 5), ("a", "c2", "clean", 5)]
    ledger.scan(spark.createDataFrame(new, schema), secrets.BASE, "file", "text", "commit").count()
    got = {(r.path, r.revision, r.kind, r.start, r.end) for r in ledger.located().collect()}
    assert got == {(p, c, "assign", 0, 13) for p, c in (("a", "c1"), ("b", "c1"), ("c", "c3"))}
    assert ledger.places().count() == spark.read.parquet(f"{folder}/ledger/places").count() == 6
    assert ledger.owed(secrets.BASE).count() == 0
    newer = [*secrets.BASE[1:], secrets.Rule("assign", "clean", 1, version=2)]
    assert ledger.owed(newer).select("kind", "version").distinct().collect() == [("assign", 2)]
    assert ledger.owed(newer).count() == 3


def test_one_new_document_moves_no_other_text(spark, folder, docs):
    ledger = secrets.BlobLedger(spark, f"{folder}/ledger")
    ledger.scan(docs, secrets.BASE).count()
    more = docs.unionByName(documents(spark, [(900, "token=abcdef1", "a")]))
    plans = []
    given = type(docs).mapInArrow

    def noted(self, *args, **kwargs):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return given(self, *args, **kwargs)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(docs), "mapInArrow", noted)
        found = ledger.scan(more, secrets.BASE)
    assert {r.doc_id: len(r.found) for r in found.collect()}[900] == 1
    assert len(plans) == 1 and "BroadcastHashJoin" in plans[0] and "Exchange hashpartitioning" not in plans[0]


def test_masking_many_spans_takes_linear_time():
    found = [{"start": 30 * i, "end": 30 * i + 24, "kind": "hex"} for i in range(100_000)]
    assert secrets.mask("x" * 3_000_000, found) == "[hex]xxxxxx" * 100_000


def test_redaction_leaves_no_span(docs, spark, folder):
    ledger = secrets.BlobLedger(spark, f"{folder}/ledger")
    out = ledger.redact(docs, secrets.BASE)
    assert out.columns == docs.columns
    for r in out.collect():
        assert not base_spans(r.text or "")
    clean = Counter((d, t) for d, t, _ in texts() if not base_spans(t or ""))
    assert clean <= Counter((r.doc_id, r.text) for r in out.collect())
    masked = ledger.redact(documents(spark, [(1, "é token=abcdef1 z", "a")]), secrets.BASE).first().text
    assert masked == "é [assign] z"


def key_block(seed: int, label: str = "RSA PRIVATE KEY", head: str = "") -> list[str]:
    pick = random.Random(seed)
    body = ["".join(pick.choices(string.ascii_letters + string.digits + "+/", k=64)) for _ in range(25)]
    return [f"-----BEGIN {label}-----", *head.splitlines(), *body, body[0][:21] + "Q==", f"-----END {label}-----"]


def key_texts() -> list[str]:
    """Key blocks in many forms, each between "before" and "after"."""
    plain, other = key_block(1), key_block(2, "PRIVATE KEY")
    sealed = key_block(3, head="Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00112233445566778899AABBCCDDEEFF\n\n")
    pgp = key_block(4, "PGP PRIVATE KEY BLOCK", "Version: GnuPG v2\n\n")
    pgp.insert(-1, "=aB3d")
    quoted = ' +\n  '.join(f'"{x}\\n"' for x in plain)
    forms = ["\n".join(x) for x in (plain, other, sealed, pgp)]
    forms += ["\r\n".join(plain), "\\n".join(plain), " ".join(plain), "\n".join("> " + x for x in plain), quoted]
    forms += ["\n".join(x[:-1]) for x in (plain, sealed, pgp)] + ["\\n".join(plain[:-1])]  # the end is missing
    forms += ["\n".join(plain[:-1] + other), "\n".join(plain[:5]), "\n".join(plain[:-1]) + "\n-----END RSA PRIV"]
    return [f"before it\n{x}\nafter it all" for x in forms]


def test_no_key_line_survives_redaction(spark, folder):
    ledger = secrets.BlobLedger(spark, f"{folder}/ledger")
    masked = ledger.redact(documents(spark, [(i, t, "a") for i, t in enumerate(key_texts())]), secrets.MORE).collect()
    for r in masked:
        assert not re.search("[A-Za-z0-9+/]{16}|Q==|BEGIN|aB3d|DEK", r.text), r.text
        assert "before it" in r.text and "after it all" in r.text and "[pem]" in r.text


def test_text_without_a_key_stays():
    rule = secrets.MORE[0]
    for text in ("-----BEGIN PRIVATE KEY----- opens such a block, and so on", "-----BEGIN CERTIFICATE-----\nMIIB"):
        assert [text[a:b] for a, b in secrets.spans(text, rule)] == re.findall("-----BEGIN PRIVATE KEY-----", text)
    half = "-----BEGIN PRIVATE KEY-----" + " - x" * 100_000
    assert secrets.spans(half, rule) == [(0, 27)]


def test_marks_of_keys_outlive_line_dedup(spark):
    rows = [(i, "\n".join(["words", *key_block(i), "a line that is on many sites"]), f"s{i}") for i in range(8)]
    docs = corpus_pipeline.line_dedup(spark, documents(spark, rows), "")
    for r in corpus_pipeline.secrets(spark, docs, "").collect():
        assert not re.search("[A-Za-z0-9+/]{16}", r.text)


def plain_difference(a: str, b: str) -> tuple[int, int]:
    x, y = (Counter(fingerprints.digests([t])[0].tolist()) for t in (a, b))
    return sum((x - y).values()) + sum((y - x).values()), sum(x.values()) + sum(y.values())


def test_fingerprints_recover_differences():
    some = [t or "" for _, t, _ in texts()]
    other = [t[: len(t) // 2] + "changed" + t[len(t) // 2 :] for t in some]
    both = fingerprints.digests(some), fingerprints.digests(other)
    got = fingerprints.likeness(*both, len(some))
    for a, b, near in zip(some, other, got, strict=True):
        differ, n = plain_difference(a, b)
        assert near == pytest.approx(1 - differ / n if n else 1.0)
    unlike = fingerprints.likeness(both[0], fingerprints.digests(other[::-1]), len(some))
    for a, b, near in zip(some, other[::-1], unlike, strict=True):  # larger sketches until they peel
        differ, n = plain_difference(a, b)
        assert near == pytest.approx(1 - differ / n if n else 1.0)
    assert fingerprints.prints(both[0], len(some)) == [fingerprints.fingerprint(t) for t in some]


def test_fingerprints_subtract():
    a = "\n".join(f"paragraph number {i} stays" for i in range(200))
    b = a.replace("number 17 stays", "number 17 goes").replace("number 90 stays", "number 90 goes")
    gone, new = fingerprints.difference(fingerprints.fingerprint(a), fingerprints.fingerprint(b))
    x, y = (set(fingerprints.digests([t])[0].tolist()) for t in (a, b))
    assert set(gone) == x - y and set(new) == y - x
    assert fingerprints.difference(fingerprints.fingerprint(a), fingerprints.fingerprint("\n".join("xyz"))) is None


def test_next_documents(docs, spark):
    rows = [r for r in documents(spark).orderBy("doc_id").collect()]
    order = sorted(((r.doc_id, r.text or "") for r in rows), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    following = order[1:] + order[:1]
    got, last = [], {}
    for part, ahead, key, text in (tuple(r) for r in fingerprints.with_next(docs).collect()):
        if part in last:
            got.append((last[part], (key, text)))
        last.pop(part, None)
        if not ahead:
            last[part] = (key, text)
    assert Counter(got) == Counter(zip(order, following, strict=True))
    assert fingerprints.with_next(documents(spark, [])).count() == 0
    one = fingerprints.with_next(documents(spark, [(5, "only", "a")])).collect()
    assert [(r.ahead, r.text) for r in one] == [(False, "only"), (True, "only")]


def plain_lines(rows, min_sites):
    sites, first = {}, {}
    for key, text, site in rows:
        for place, line in enumerate((text or "").split("\n")):
            if len(line) >= lines.MIN_CHARS:
                sites.setdefault(line, set()).add(site or "")
                at = (key is None, key if key is not None else 0, place)
                first[line] = min(first.get(line, at), at)
    out = Counter()
    for key, text, _ in rows:
        kept = []
        for place, line in enumerate((text or "").split("\n")):
            at = (key is None, key if key is not None else 0, place)
            if len(sites.get(line, ())) < min_sites or first[line] == at:
                kept.append(line)
        n = (text or "").count("\n") + 1
        out[key, text if len(kept) == n else "\n".join(kept), n, n - len(kept)] += 1
    return out


@pytest.mark.parametrize("min_sites", [2, 3, 5, 8])
def test_lines(docs, spark, min_sites):
    out = lines.without_boilerplate(docs, min_sites=min_sites)
    assert out.columns == [*docs.columns, "n_lines_", "n_removed_"]
    got = Counter((r.doc_id, r.text, r.n_lines_, r.n_removed_) for r in out.collect())
    assert got == plain_lines(texts(), min_sites)
    assert lines.without_boilerplate(documents(spark, [])).count() == 0


def test_spread_is_exact_near_the_limit(spark):
    rows = [(line, 9, f"s{i}") for line in range(60) for i in range(line * 5)]
    found = lines.site_spread(spark.createDataFrame(rows, "line long, size int, site string"), 100)
    assert {r.line for r in found.collect()} == set(range(20, 60))


def test_lists_are_handled_in_slices():
    """A worker holds few lists at once, and each is the list it was: nulls, empty ones and slices too."""
    import pyarrow as pa

    from tallyhouse.llm.common import id_slices, listed

    rows = [[1, 2, 3], None, [], [4] * 5, [], [5]] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(18)), pa.array(rows, pa.list_(pa.int32()))], names=["id", "ids"])
    for part, want in ((batch, rows), (batch.slice(3, 9), rows[3:12]), (batch.slice(0, 0), [])):
        slices = [*id_slices(part, 1, 4)]
        assert [x for s in slices for x in listed(s.column(1))] == [x or [] for x in want]
        assert sum(s.num_rows for s in slices) == len(want)
    assert len([*id_slices(batch, 1, 4)]) > 3


def test_encoders_give_small_batches(spark, monkeypatch):
    """A batch of long texts is cut by bytes before it is worked on, and comes out in parts."""
    import public_tokenizers
    import pyarrow as pa

    from tallyhouse.llm import packing, pieces

    docs, caught = spark.createDataFrame([(1, "a")], "doc_id long, text string"), []
    whole = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, run, schema: caught.append(run) or whole(df, run, schema))
    pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["some words " * 30_000] * 8
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["id", "text"])
    for run in caught:
        out = [*run(iter([batch]))]
        assert len(out) > 1 and {x for rows in out for x in rows.column(0).to_pylist()} == set(range(8))
