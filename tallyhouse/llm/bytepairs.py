"""Byte-level BPE by ranks: encoding by backtracking from longest matches, and decoding."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import byte_slices, id_slices, listed, table

#: Distinct matches of the pattern that a worker remembers (twice as many before the older half
#: goes), the longest that it remembers, and the token pairs whose test it remembers.
REMEMBERED, LONGEST, PAIRS = 300_000, 64, 400_000
#: Bytes of text, and ids, that are handled together.
MOST, MOST_IDS = 1 << 20, 1 << 18


class Apart(dict):
    """Do the merges leave two tokens, side by side, as they are? Keys are left * tokens + right."""

    def __init__(self, ranks: BytePairs):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, pair: int) -> bool:
        ranks = self.ranks
        a, b = divmod(pair, ranks.size)
        if len(self) >= PAIRS:
            self.clear()
        got = self[pair] = ranks.merged(ranks.latin[a] + ranks.latin[b]) == [a, b]
        return got


class Alone(dict):
    """Do the merges make a token of its own bytes?"""

    def __init__(self, ranks: BytePairs):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, token: int) -> bool:
        got = self[token] = self.ranks.merged(self.ranks.latin[token]) == [token]
        return got


class BytePairs:
    """Ids of texts for a file of ranks, each match of ``pattern`` encoded separately.

    Bytes are mapped to the Latin-1 letters of the same numbers, so that the automaton works on
    strings. A match that is a token is that token. In any other, adjacent tokens that the merges
    leave apart, pair by pair, are what the merges leave of the whole; so it is enough to find the
    sequence all of whose pairs pass. From each place the longest token is tried first, then the
    next shorter one. Where none passes the place is marked dead and the token before it gives way:
    a prefix has one such sequence at most, so no place is entered twice.
    """

    def __init__(self, path: str, pattern: str):
        lines = [x.split() for x in open(path, "rb") if x.strip()]
        by_rank = {int(rank): base64.b64decode(token) for token, rank in lines}
        self.size = max(by_rank) + 1
        self.tokens = [by_rank.get(i, b"") for i in range(self.size)]
        self.latin = [x.decode("latin-1") for x in self.tokens]
        self.ids = {x: i for i, x in enumerate(self.latin) if x}
        if any(chr(x) not in self.ids for x in range(256)):
            raise ValueError("every byte must be a token")
        self.lengths = [len(x) for x in self.latin]
        self.split = regex.compile(pattern)
        self.apart, self.alone = Apart(self), Alone(self)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for token, i in self.ids.items():
            found.add_word(token, i)
        found.make_automaton()
        return found

    @cached_property
    def shorter(self) -> list[int]:
        """The longest token that is a proper prefix of each token; -1: none."""
        found = []
        for token in self.latin:
            ends = range(len(token) - 1, 0, -1)
            found.append(next((self.ids[token[:x]] for x in ends if token[:x] in self.ids), -1))
        return found

    def merged(self, word: str) -> list[int]:
        """What is left when the adjacent pair of the lowest rank is merged again and again.

        For two tokens side by side, so a few dozen bytes: each step looks at all pairs.
        """
        ids, none = self.ids, self.size
        parts = list(word)
        ranks = [ids.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = ids.get(parts[i - 1] + parts[i], none)
            if i < len(ranks):
                ranks[i] = ids.get(parts[i] + parts[i + 1], none)
        return [ids[x] for x in parts]

    def word(self, word: str) -> list[int]:
        """The ids of a match, given as Latin-1 letters."""
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        lengths, shorter, apart, alone = self.lengths, self.shorter, self.apart, self.alone
        longest = [-1] * len(word)
        for end, token in self.automaton.iter(word):  # by growing end, so the longest comes last
            longest[end + 1 - lengths[token]] = token
        alive = bytearray(b"\1") * (len(word) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < len(word):
            while token >= 0:
                if alive[at + lengths[token]] and (apart[out[-1] * self.size + token] if out else alone[token]):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += lengths[token]
                token = longest[at] if at < len(word) else -1
            else:
                alive[at] = 0
                token = out.pop()
                at -= lengths[token]
        return out

    def learnt(self, match: str) -> bytes:
        """The ids of a match that isn't remembered."""
        got = self.known.get(match) or self.before.get(match)
        if got is None:
            got = array("i", self.word(match.encode().decode("latin-1"))).tobytes()
        if len(match) <= LONGEST:
            if len(self.known) >= REMEMBERED:
                self.before, self.known = self.known, {}
            self.known[match] = got
        return got

    def encode(self, text: str) -> bytes:
        """The ids as consecutive 32-bit integers."""
        matches = self.split.findall(text)
        found = [*map(self.known.get, matches)]
        if None in found:
            for i, got in enumerate(found):
                if got is None:
                    found[i] = self.learnt(matches[i])
        return b"".join(found)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def ranks(path: str, pattern: str) -> BytePairs:
    return BytePairs(path, pattern)


def encode_bytepairs(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id and ``ids`` (array of int), special strings as ordinary text.

    ``path`` is a file of ranks and has to be on every executor. A null or empty text has no ids;
    repeated rows stay; an empty table gives no rows; other columns are not looked at. Batches are
    cut by bytes, and time is linear in a text, also in one without any white space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ranks(path, pattern).encode
        for batch in batches:
            for rows in byte_slices(batch, 1, MOST):
                ids = [encode(x.as_py()) for x in rows.column(1)]
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                lists = pa.ListArray.from_arrays(pa.array(ends), flat)
                yield pa.RecordBatch.from_arrays([rows.column(0), lists], names=["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return slim.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_bytepairs(
    encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """One row per row of ``encoded``: id, ``ids`` and ``bytes``; no ids (or null) give none.

    Bytes, not a text: ids in any other order than an encoding's need not be UTF-8.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = ranks(path, pattern).decode
        for batch in batches:
            for rows in id_slices(batch, 1, MOST_IDS):
                out = [*map(decode, listed(rows.column(1)))]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(out, pa.binary())], names=["id", "ids", "bytes"])

    kind = encoded.schema[id_col].dataType.simpleString()
    slim = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return slim.mapInArrow(run, f"id {kind}, ids array<int>, bytes binary").withColumnRenamed("id", id_col)


def op11_bytepairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    both = decode_bytepairs(encode_bytepairs(table(spark, sf_dir, "documents"), path, pattern), path, pattern)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
