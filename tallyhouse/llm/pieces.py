"""SentencePiece (BPE) encoding by a table of each prefix's last token, and decoding."""

from __future__ import annotations

import heapq
import re
import string
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import byte_slices, id_slices, listed, table

_SPACE = "▁"
#: Distinct words that a worker remembers at least; from twice as many, those not seen since the
#: last half go. Token pairs are kept up to this number too.
REMEMBERED = 300_000
#: Bytes of text, and ids, that are handled together.
MOST, MOST_IDS = 1 << 20, 1 << 18


class Apart(dict):
    """Do the merges leave two tokens, side by side, as they are? By left * pieces + right."""

    def __init__(self, model: PieceBpe):
        super().__init__()
        self.model, self.pieces = model, len(model.scores)

    def __missing__(self, pair: int) -> bool:
        a, b = (self.model.names[x] for x in divmod(pair, self.pieces))
        if len(self) >= REMEMBERED:
            self.clear()
        got = self[pair] = self.model.merged(a + b) == [a, b]
        return got


class PieceBpe:
    """Ids of texts for a BPE model with byte fallback, a dummy prefix and no other normalising.

    A text is cut before each run of spaces and around line ends: no piece crosses those, so the
    words between are encoded alone. Within a word every prefix has exactly one last token: the
    piece that ends there (an automaton finds these) whose pair with the last token of what is
    before it would be left apart by the merges. Following last tokens backwards gives the ids.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize(" a  ﬁ ") != f"{_SPACE}{_SPACE}a{_SPACE}{_SPACE}ﬁ{_SPACE}":
            raise ValueError("the model must keep texts as they are, with one space before")
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.scores.append(model.get_score(i))
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.bytes_of.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i):
                self.bytes_of.append(b"")
            elif model.is_unknown(i):
                self.bytes_of.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.bytes_of.append(piece.replace(_SPACE, " ").encode())
        if any("\n" in p or _SPACE in p.lstrip(_SPACE) or p[:2] == _SPACE * 2 != p[:1] + p[-1] for p in self.ids):
            raise ValueError("a piece of the model crosses words")
        self.starts = {i for p, i in self.ids.items() if p[0] == _SPACE}
        self.names = {i: p for p, i in self.ids.items()}
        self.words = re.compile(f"{_SPACE}+[^{_SPACE}\n]*|\n|[^{_SPACE}\n]+")
        letter = r"[^\W\d_]"
        after_letter = {x[-1] for p in self.ids for x in re.findall(rf"(?=({letter}.))", p)}
        marks = "".join(x for x in string.punctuation if x not in after_letter)
        # a letter and then a mark that no piece has behind a letter
        self.joints = re.compile(rf"(?<=[^\W\d_])(?=[{re.escape(marks)}])" if marks else "(?!)")
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.apart = Apart(self)

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Finds the pieces in a word that the merges can make of their own characters."""
        found = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.merged(piece) == [piece]:
                found.add_word(piece, (i, len(piece)))
        found.make_automaton()
        return found

    def merged(self, word: str) -> list[str]:
        """The pieces left when the best adjacent pair is merged again and again, leftmost first."""
        parts: list[str | None] = list(word)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts) and (got := self.ids.get(both := parts[i] + parts[j])) is not None:
                heapq.heappush(queue, (-self.scores[got], i, j, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, both = heapq.heappop(queue)
            if parts[i] is None or parts[j] is None or after[i] != j or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [x for x in parts if x is not None]

    def word(self, word: str) -> list[int]:
        if word[:2] == _SPACE * 2:  # runs of spaces are scored out of the order of their lengths
            return [y for x in self.merged(word) for y in self.spelt(x)]
        # the last token of the prefix that ends at each place, times the number of pieces; -1: a
        # character without a piece. The prefix before the first place is the list's last entry.
        last = [-1] * (len(word) + 1)
        sizes = [1] * len(word)
        apart = self.apart
        for end, (token, size) in self.automaton.iter(word):
            if last[end] < 0:
                left = last[end - size]
                if left < 0 or apart[left + token]:
                    last[end], sizes[end] = token * apart.pieces, size
        out: list[int] = []
        at = len(word)
        while at:
            token, start = last[at - 1], at - sizes[at - 1]
            if token >= 0:
                out.append(token // apart.pieces)
            else:
                out += self.spelt(word[start:at])[::-1]
            at = start
        return out[::-1]

    def spelt(self, piece: str) -> list[int]:
        """The id of a piece, or of its bytes."""
        got = self.ids.get(piece)
        return [self.byte_ids[b] for b in piece.encode()] if got is None else [got]

    def encode(self, text: str) -> bytes:
        """The ids as consecutive 32-bit integers."""
        if not text:
            return b""
        words = self.words.findall(_SPACE + text.replace(" ", _SPACE))
        found = [*map(self.known.get, words)]
        if None in found:
            for i, got in enumerate(found):
                if got is None:
                    found[i] = self.learnt(words[i])
        return b"".join(found)

    def learnt(self, word: str) -> bytes:
        """The ids of a word that isn't remembered. What is before a joint is a word by itself."""
        got = self.known.get(word) or self.before.get(word)
        if got is None:
            joint = self.joints.search(word)
            if joint:
                got = self.learnt(word[: joint.start()]) + self.learnt(word[joint.start() :])
            else:
                got = array("i", self.word(word)).tobytes()
        if len(self.known) >= REMEMBERED:
            self.before, self.known = self.known, {}
        self.known[word] = got
        return got

    def decode(self, ids: list[int]) -> str:
        if not ids:
            return ""
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if ids[0] in self.starts else text


@lru_cache(maxsize=2)
def model(path: str) -> PieceBpe:
    return PieceBpe(path)


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and ``ids`` (array of int), without begin and end ids.

    A null or empty text has no ids; repeated rows stay; an empty table gives no rows; other
    columns are not looked at. Batches are cut by bytes, so that a worker holds few texts at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = model(path).encode
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


def decode_pieces(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ``encoded``: id, ``ids`` and ``text``; no ids (or null) give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = model(path).decode
        for batch in batches:
            for rows in id_slices(batch, 1, MOST_IDS):
                texts = [*map(decode, listed(rows.column(1)))]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(texts, pa.string())], names=["id", "ids", "text"]
                )

    kind = encoded.schema[id_col].dataType.simpleString()
    slim = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return slim.mapInArrow(run, f"id {kind}, ids array<int>, text string").withColumnRenamed("id", id_col)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    both = decode_pieces(encode_pieces(table(spark, sf_dir, "documents"), path), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
