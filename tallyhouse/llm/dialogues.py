"""Conversation structure repair: turns aligned with the alternating grammar at the least cost."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import byte_slices, table, written

#: What edits cost; a cut-off turn that stays costs CUT_OFF more.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: Turns that are aligned together.
BLOCK = 24
#: Bytes of text that are handled together.
MOST = 1 << 20
#: What may stand between words, and what ends a whole turn.
_SPACES, _ENDS = " \t\n\x0b\x0c\r", ".!?"
#: Nothing yet; after a system turn; after a user's; after an assistant's. The first and last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
_NONE = 1 << 40
#: What may follow in each state, by the letter written.
_LETTERS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_NAMES = {"u": "user", "a": "assistant"}
#: Faults of a row, and a row that only tells that its conversation exists.
WHOLE, BLANK, DUPLICATE, TRUNCATED, GONE = range(5)

Turn = tuple[str, int]  # initial of the role, fault
Option = tuple[int, str]  # cost, audit


@lru_cache(maxsize=1 << 12)
def targets(entry: int, size: int) -> tuple[tuple[str, int], ...]:
    """The strings of ``size`` letters that may follow the state ``entry``, with the state they end in."""
    if not size:
        return (("", entry),)
    first = {START: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}[entry]
    return tuple((x + rest, end) for x in first for rest, end in targets(_LETTERS[x], size - 1))


def align(turns: Sequence[Turn], target: str, most: int) -> Option | None:
    """The cheapest edits of ``turns`` into ``target``, and of these the ASCII-least audit.

    None if they cost more than ``most``. The table of Wagner and Fischer over suffixes: no path of
    that cost leaves Ukkonen's band, since being k deletions or insertions off the diagonal costs k
    of them, and getting back to the end the rest. Insertions stand before a turn, never behind
    the last one.
    """
    n, m = len(turns), len(target)
    if not n:
        return None if m else (0, "")
    wide = [m + 1] * (n + 1)
    cost = [wide] * (n + 1)
    cost[n] = [_NONE] * m + [0]
    for i in range(n - 1, -1, -1):
        initial, fault = turns[i]
        must_go = fault in (BLANK, DUPLICATE)
        extra = CUT_OFF if fault == TRUNCATED else 0
        below, row = cost[i + 1], [_NONE] * (m + 1)
        for j in range(m, -1, -1):
            off, left = i - j, (n - i) - (m - j)  # deletions so far, at least, and still to come
            bound = (off * DELETE if off > 0 else -off * INSERT) + (left * DELETE if left > 0 else -left * INSERT)
            if bound > most:
                continue
            best = below[j] + DELETE
            if j < m:
                if not must_go:
                    best = min(best, below[j + 1] + extra + (0 if initial == target[j] else REROLE if target[j] != "s" else _NONE))
                best = min(best, row[j + 1] + INSERT if target[j] != "s" else _NONE)
            row[j] = best
        cost[i] = row
    if cost[0][0] > most:
        return None
    audit, i, j = [], 0, 0
    while i < n:  # letters in ASCII order, each if a cheapest path goes on with it
        here = cost[i][j]
        if cost[i + 1][j] + DELETE == here:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and cost[i][j + 1] + INSERT == here:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i][0] == target[j] else "R")
            i, j = i + 1, j + 1
    return cost[0][0], "".join(audit)


def options(turns: Sequence[Turn], entry: int) -> dict[int, Option]:
    """For each state that ``turns`` can end in after ``entry``: the least cost and its audit.

    Targets of every feasible length are tried, nearest to the number of turns first; those whose
    difference alone costs more than the best so far in their state can't be better.
    """
    n = len(turns)
    best: dict[int, Option] = {}
    sizes = sorted(range(0, 2 * n + 3), key=lambda size: (abs(size - n), size))
    for size in sizes:
        least = (n - size) * DELETE if size < n else (size - n) * INSERT
        for target, end in targets(entry, size):
            so_far = best.get(end, (DELETE * n + INSERT * 2 * (n + 2), ""))
            if least <= so_far[0]:
                got = align(turns, target, so_far[0])
                if got is not None and (end not in best or got < so_far):
                    best[end] = got
    return best


def join_blocks(blocks: Sequence[dict[int, dict[int, Option]]]) -> tuple[int, str]:
    """The cheapest way through blocks one after another, and of these the ASCII-least audit.

    Of two audits of a block that cost the same and start in one state none begins with the other
    (both end with a turn's letter), so the least audit of the whole is least block by block.
    """
    closing = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}
    after = [{state: cost for state, (cost, _) in closing.items()}]
    for block in reversed(blocks):
        later = after[-1]
        after.append({s: min(c + later[t] for t, (c, _) in found.items()) for s, found in block.items()})
    after.reverse()
    state, audit = START, []
    for block, here, later in zip(blocks, after, after[1:], strict=False):
        best = min((text, t) for t, (c, text) in block[state].items() if c + later[t] == here[state])
        audit.append(best[0])
        state = best[1]
    return after[0][START], "".join(audit) + closing[state][1]


_NOTHING = object()


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _records(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[tuple]:
    for batch in batches:
        for begin in range(0, batch.num_rows, at_once):
            yield from zip(*(c.to_pylist() for c in batch.slice(begin, at_once).columns), strict=True)


def _given(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_MOVE = pa.struct([("entry", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_COUNTS = [(x, pa.int64()) for x in ("blank", "duplicate", "truncated", "illegal")]
_BLOCK = [
    ("part", pa.int32()), ("number", pa.int64()), *_COUNTS, ("first_turn", pa.int64()), ("last_turn", pa.int64()),
    ("turns", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string()), ("moves", pa.list_(_MOVE)),
]
_BLOCK_SQL = (
    "part int, number long, blank long, duplicate long, truncated long, illegal long, first_turn long, last_turn long, "
    "turns long, first_initial string, last_initial string, "
    "moves array<struct<entry: int, end: int, cost: long, audit: string>>"
)
_AUDIT_SQL = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


@lru_cache(maxsize=1 << 16)
def _options(turns: tuple[Turn, ...], entry: int) -> dict[int, Option]:
    return options(turns, entry)


def _block(rows: list[tuple[int | None, str, int]], first: bool) -> tuple:
    """What a block of rows (turn, initial, fault) says; ``first``: it begins its conversation."""
    there = [x for x in rows if x[2] != GONE]
    numbers = [turn for turn, *_ in there if turn is not None]
    initials, faults = [x for _, x, _ in there], [x for *_, x in there]
    turns = tuple(zip(initials, faults, strict=True))
    entries = (START,) if first else (START, SYSTEM, USER, ASSISTANT)
    moves = [
        {"entry": s, "end": t, "cost": cost, "audit": audit}
        for s in entries
        for t, (cost, audit) in _options(turns, s).items()
    ]
    illegal = sum(not _legal(a, b) for a, b in zip(initials, initials[1:], strict=False))
    return (
        *(faults.count(x) for x in (BLANK, DUPLICATE, TRUNCATED)), illegal,
        *((numbers[0], numbers[-1]) if numbers else (None, None)), len(set(numbers)),
        *((initials[0], initials[-1]) if initials else (None, None)), moves,
    )


def _to_blocks(conv_type: pa.DataType):
    """From rows (conv, turn, initial, digest, fault), sorted, to blocks of BLOCK rows at most."""
    schema = pa.schema([("conv", conv_type), *_BLOCK])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, out = TaskContext.get().partitionId(), 0, []
        conv, before, rows, first = _NOTHING, None, [], False
        for key, turn, initial, digest, fault in _records(batches, 4096):
            if key != conv or len(rows) == BLOCK:
                if rows:
                    out.append((conv, part, number, *_block(rows, first)))
                    number += 1
                    if len(out) == 1024:
                        yield _given(out, schema)
                        out = []
                # the first conversation of a task may have begun in the task before
                first = key != conv and conv is not _NOTHING
                before = before if key == conv else None
                conv, rows = key, []
            if fault in (WHOLE, TRUNCATED) and before == (turn, digest):
                fault = DUPLICATE
            rows.append((turn, initial, fault))
            if fault != GONE:
                before = (turn, digest)
        if rows:
            out.append((conv, part, number, *_block(rows, first)))
        yield _given(out, schema)

    return run


def _to_audits(conv_type: pa.DataType):
    """From sorted blocks to one row for each conversation."""
    names = [x.strip().split(" ")[0] for x in _AUDIT_SQL.split(",")]
    schema = pa.schema([("conv", conv_type), *((x, pa.string() if x == "audit" else pa.int64()) for x in names)])

    def audit(conv, blocks: list[tuple]) -> tuple:
        counts = [sum(x) for x in zip(*(b[:4] for b in blocks), strict=True)]
        numbered = [b for b in blocks if b[6]]
        distinct = sum(b[6] for b in numbered) - sum(a[5] == b[4] for a, b in zip(numbered, numbered[1:], strict=False))
        gaps = numbered[-1][5] - numbered[0][4] + 1 - distinct if numbered else 0
        said = [b for b in blocks if b[7] is not None]
        counts[3] += sum(not _legal(a[8], b[7]) for a, b in zip(said, said[1:], strict=False))
        return (conv, gaps, *counts, *join_blocks([b[9] for b in blocks]))

    def by_entry(moves: list[dict]) -> dict[int, dict[int, Option]]:
        found: dict[int, dict[int, Option]] = {}
        for x in moves:
            found.setdefault(x["entry"], {})[x["end"]] = (x["cost"], x["audit"])
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, blocks, out = _NOTHING, [], []
        for key, _, _, *rest, moves in _records(batches, 1024):
            if key != conv:
                if blocks:
                    out.append(audit(conv, blocks))
                    if len(out) == 1024:
                        yield _given(out, schema)
                        out = []
                conv, blocks = key, []
            blocks.append((*rest, by_entry(moves)))
        if blocks:
            out.append(audit(conv, blocks))
        yield _given(out, schema)

    return run


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def _turns(turns: DataFrame, conv: str, turn: str, role: str, text: str, gone: str | None) -> DataFrame:
    """(conv, turn, role, text, initial, digest, fault) without duplicates marked."""
    spoken, said = F.coalesce(role, F.lit(" ")), F.coalesce(text, F.lit(" "))
    trimmed = F.rtrim(said, F.lit(_SPACES))
    whole = F.right(trimmed, F.lit(1)).isin(*_ENDS)
    fault = F.when(trimmed == "", BLANK).when(whole, WHOLE).otherwise(TRUNCATED)
    if gone is not None:
        fault = F.when(F.col(gone), GONE).otherwise(fault)
    return turns.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), spoken.alias("role"), said.alias("text"),
        F.substring(spoken, 1, 1).alias("initial"),
        F.sha2(F.concat(F.length(spoken), F.lit(":"), spoken, said), 256).alias("digest"), fault.alias("fault"),
    )


def audit_turns(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", gone_col: str | None = None,
) -> DataFrame:
    """One row for each conversation: what is wrong with it, and the cheapest repair.

    Columns: id, ``gaps`` in the numbers of turns, ``blank``, ``duplicate`` and ``truncated`` turns (by
    their first fault), ``illegal`` neighbours, ``cost`` and ``audit``: the initials of Keep, Rerole,
    Delete and Insert, in order. Nulls of role and text count as one space, turns without a number
    come first, turns with one number by role and then by a hash; a null id is a conversation of its
    own. Rows marked by ``gone_col`` aren't there, but their conversation is: it has zeros and an
    empty audit. An empty table gives no rows, other columns are not looked at.

    Turns are sorted over all tasks, so a long conversation is cut where tasks meet and into blocks.
    Each block is aligned from each state of the grammar, to targets of every feasible length; the
    blocks of a conversation, a few letters a turn and without texts, are then joined in order.
    """
    rows = _turns(turns, conv_col, turn_col, role_col, text_col, gone_col)
    at = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    spoken = rows.where(~F.col("fault").isin(BLANK, GONE))
    again = (
        spoken.groupBy(F.col("conv").alias("in_conv"), F.col("digest").alias("of"))
        .agg(F.min(at).alias("first"), F.max(at).alias("last"))
        .where(F.col("first") != F.col("last"))
        .select("in_conv", "of", "first")
    )
    same = F.col("conv").eqNullSafe(F.col("in_conv")) & (F.col("digest") == F.col("of"))
    later = F.col("fault").isin(WHOLE, TRUNCATED) & (at > F.col("first"))
    slim = (
        rows.select("conv", "turn", "role", "initial", "digest", "fault")
        .join(written(again, "said_again"), same, "left")
        .withColumn("fault", F.when(F.coalesce(later, F.lit(False)), DUPLICATE).otherwise(F.col("fault")))
    )
    order = ["conv", "turn", "role", "digest"]
    kind, conv_type = turns.schema[conv_col].dataType.simpleString(), _arrow(turns, conv_col)
    placed = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = placed.select("conv", "turn", "initial", "digest", "fault").mapInArrow(
        _to_blocks(conv_type), f"conv {kind}, {_BLOCK_SQL}"
    )
    blocks = written(blocks, "blocks").repartition("conv").sortWithinPartitions("conv", "part", "number")
    return blocks.mapInArrow(_to_audits(conv_type), f"conv {kind}, {_AUDIT_SQL}").withColumnRenamed("conv", conv_col)


def repaired_turns(
    turns: DataFrame, audits: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", gone_col: str | None = None,
) -> DataFrame:
    """The turns that ``audits`` (as ``audit_turns`` gives them) leave: id, ``place``, ``role``, ``text``.

    Each conversation's rows come in order and together; those left empty have none. A conversation
    is read as a stream behind its audit, so no more than one batch of its texts is held.
    """
    rows = _turns(turns, conv_col, turn_col, role_col, text_col, gone_col).where(F.col("fault") != GONE)
    heads = audits.select(F.col(conv_col).alias("conv"), F.lit(0).alias("body"), F.col("audit").alias("text"))
    stream = rows.select("conv", F.lit(1).alias("body"), "turn", "role", "digest", "text").unionByName(
        heads, allowMissingColumns=True
    )
    order = ["conv", "body", "turn", "role", "digest"]
    kind, conv_type = turns.schema[conv_col].dataType.simpleString(), _arrow(turns, conv_col)
    schema = pa.schema([("conv", conv_type), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair: _Repair | None = None
        for batch in batches:
            for rows in byte_slices(batch, 3, MOST):
                out: list[tuple] = []
                for key, body, spoken, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    if body:
                        repair.turn(spoken, text, out)
                    else:
                        repair = _Repair(key, text)
                yield _given(out, schema)

    placed = stream.repartition("conv").sortWithinPartitions(*order).select("conv", "body", "role", "text")
    return placed.mapInArrow(run, f"conv {kind}, place long, role string, text string").withColumnRenamed("conv", conv_col)


class _Repair:
    """An audit that is applied to the turns of its conversation one by one."""

    def __init__(self, conv, audit: str):
        self.conv, self.audit = conv, audit
        self.at, self.state, self.place = 0, START, 0
        self.behind = len(audit.rstrip("I"))  # where insertions behind the last turn begin

    def put(self, role: str | None, said: str, out: list[tuple]) -> None:
        letter = {USER: "a"}.get(self.state, "u") if role is None else role[:1]
        out.append((self.conv, self.place, _NAMES[letter] if role is None else role, said))
        self.state, self.place = _LETTERS[letter], self.place + 1

    def insert(self, out: list[tuple]) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.put(None, "", out)
            self.at += 1

    def turn(self, role: str, text: str, out: list[tuple]) -> None:
        self.insert(out)
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self.put(role if edit == "K" else None, text, out)
        if self.at == self.behind:
            self.insert(out)


def _digests(conv_type: pa.DataType):
    """From rows (conv, role, text), together and in order, to SHA-256 of ``role:text`` lines."""
    schema = pa.schema([("conv", conv_type), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, going = _NOTHING, None
        for batch in batches:
            out = []
            for key, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != conv or conv is _NOTHING:
                    if going is not None:
                        out.append((conv, going.hexdigest()))
                    conv, going = key, hashlib.sha256()
                else:
                    going.update(b"\n")
                going.update(f"{role}:{text}".encode())
            yield _given(out, schema)
        if going is not None:
            yield _given([(conv, going.hexdigest())], schema)

    return run


def digests(repaired: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(id, ``repaired_sha256``) of what ``repaired_turns`` gives, for conversations that have turns left."""
    kind, conv_type = repaired.schema[conv_col].dataType.simpleString(), _arrow(repaired, conv_col)
    found = repaired.select(F.col(conv_col).alias("conv"), "role", "text").mapInArrow(
        _digests(conv_type), f"conv {kind}, digest string"
    )
    return found.select(F.col("conv").alias(conv_col), F.col("digest").alias("repaired_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns of ``conversations`` with faults put in by a hash of their place; ``gone``: dropped."""

    def named(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate("text", _ENDS, "")).otherwise(F.col("text"))
    role = F.when(fate == 4, "user").otherwise(F.col("role"))
    times = F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (fate == 0).alias("gone"), F.explode(times).alias("copy")
    )
    return rows.drop("copy")


def op12_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = damaged(table(spark, sf_dir, "conversations"))
    audits = written(audit_turns(turns, gone_col="gone"), "audits")
    left = digests(repaired_turns(turns, audits, gone_col="gone"))
    both = audits.alias("a").join(left.alias("d"), F.col("a.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    nothing = F.sha2(F.lit(""), 256)
    return both.select("a.*", F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
