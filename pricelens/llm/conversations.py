"""Cheapest repair of conversations whose turns were damaged.

A repaired conversation's role initials read ``(s?(ua)+)?``. Edits are read
from left to right: Keep a row, Rerole it, Delete it, Insert an empty turn;
the four states of the pattern (start, after s, after u, after a) and the place
in the conversation make the dynamic programme. ``solve`` runs it backward,
storing the vector of costs still to come only at every square-rootth row;
walking forward, it computes a block's vectors again from the checkpoint at
its end and emits, of the edits that are tight, the one whose letter is least.

In Spark the rows are range-partitioned in the order of the conversations. A
conversation that lies within one task, and within one block of rows, is
solved there. The others (those at a task's edges, and long ones, however
much of the table they hold) are cut into blocks, each a row of a table:
blocks learn which of their turns stood in an earlier block, give their costs
as a 4 x 4 matrix, get their end's cost vector from the matrices behind them
and their first state from the blocks before them, and are walked side by
side. What passes through one task for a conversation is a row a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, staged

# Costs and letters of the edits (fixed values of the contract).
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"

BLOCK_ROWS = 4096
BLOCK_CHARS = 1 << 20
OUT_ROWS = 1000
NEVER = 1 << 60
PREFIX = 64  # characters of a text that order the rows of one turn; equal ones go by the MD5 of the text

# A row's code: its role's initial (s, u, a, other), plus 4 if it is truncated; or 8 if it must go.
INITIALS = {"s": 0, "u": 1, "a": 2}
OTHER, GONE = 3, 8
LEGAL = {(0, 1), (1, 2), (2, 1)}  # initials that may be neighbours
KEEP_TO = ((1, None, None, None), (2, 2, None, 2), (None, None, 3, None), (None,) * 4)
TURN_TO = (2, 2, 3, 2)  # the state after a user or assistant turn that is written at will
LAST = (0, 6, 3, 0)  # costs still to come behind the last row

Vector = tuple[int, int, int, int]


def back(code: int, v: Vector) -> Vector:
    """Costs before a row, inserts there included, from those after it."""
    u = [DELETE + c for c in v]
    if code < GONE:
        extra = TRUNCATED if code & 4 else 0
        for s, (kept, turn) in enumerate(zip(KEEP_TO[code & 3], TURN_TO)):
            u[s] = min(u[s], REROLE + extra + v[turn])
            if kept is not None:
                u[s] = min(u[s], KEEP + extra + v[kept])
    after_u, after_a = min(u[2], INSERT + u[3]), min(u[3], INSERT + u[2])
    return min(u[0], INSERT + after_u), min(u[1], INSERT + after_u), after_u, after_a


def start_costs(codes: bytes, v: Vector) -> Vector:
    for code in reversed(codes):
        v = back(code, v)
    return v


def solve(codes: bytes, state: int = 0, end: Vector = LAST, final: bool = True) -> tuple[str, int, int]:
    """The least letters of the cheapest edits, their cost and the state they lead to.

    ``state`` is the state before the first row and ``end`` the costs behind
    the last one; turns may be inserted there if it is the ``final`` one.
    """
    n = len(codes)
    step = isqrt(n) + 1
    v, checkpoints = end, {n: end}
    for i in range(n - 1, -1, -1):
        v = back(codes[i], v)
        if i % step == 0:
            checkpoints[i] = v
    out, cost = [], 0
    for low in range(0, n, step):
        high = min(low + step, n)
        vectors = [checkpoints[high]]
        for i in range(high - 1, low - 1, -1):
            vectors.append(back(codes[i], vectors[-1]))
        i = low
        while i < high:
            here, then, code = vectors[high - i], vectors[high - i - 1], codes[i]
            now, turn, extra = here[state], TURN_TO[state], TRUNCATED if code & 4 else 0
            kept = KEEP_TO[code & 3][state] if code < GONE else None
            if DELETE + then[state] == now:
                letter, spent, to = "D", DELETE, state
            elif INSERT + here[turn] == now:
                letter, spent, to, i = "I", INSERT, turn, i - 1
            elif kept is not None and KEEP + extra + then[kept] == now:
                letter, spent, to = "K", KEEP + extra, kept
            else:
                letter, spent, to = "R", REROLE + extra, turn
            out.append(letter)
            cost, state, i = cost + spent, to, i + 1
    while final and end[state]:
        out.append("I")
        cost, state = cost + INSERT, TURN_TO[state]
    return "".join(out), cost, state


@lru_cache(maxsize=50_000)
def _solve_short(codes: bytes) -> tuple[str, int]:
    return solve(codes)[:2]


def row_code(role: str, text: str) -> tuple[int, bool, bool]:
    """The row's code as far as it does not depend on others; is it blank, is it truncated?"""
    said = text.strip(SPACE)
    if not said:
        return INITIALS.get(role[:1], OTHER), True, False
    cut = said[-1] not in ENDS
    return INITIALS.get(role[:1], OTHER) + 4 * cut, False, cut


def repaired(audit: str, rows: list[tuple[str, str]], state: int = 0) -> list[dict]:
    """The turns that the edits leave."""
    out, at = [], 0
    for letter in audit:
        role, text = rows[at] if letter != "I" else ("", "")
        at += letter != "I"
        if letter == "D":
            continue
        if letter == "K":
            state = KEEP_TO[INITIALS[role[0]]][state]
        else:
            state = TURN_TO[state]
            role = "user" if state == 2 else "assistant"
        out.append({"role": role, "text": text})
    return out


def _judge(rows: list[tuple[str, str]], is_seen) -> tuple[bytes, int, int, int]:
    """Codes of the rows; how many are blank, else seen before, else truncated."""
    codes, blank, duplicate, truncated = bytearray(), 0, 0, 0
    for role, text in rows:
        code, is_blank, is_cut = row_code(role, text)
        is_copy = not is_blank and is_seen(role, text)
        blank, duplicate, truncated = blank + is_blank, duplicate + is_copy, truncated + (is_cut and not is_copy)
        codes.append(GONE if is_blank or is_copy else code)
    return bytes(codes), blank, duplicate, truncated


def _illegal(roles: list[int]) -> int:
    return sum(pair not in LEGAL for pair in zip(roles, roles[1:]))


def _gaps(turns: list[int]) -> int:
    """Numbers left out between sorted turns."""
    return sum(max(b - a - 1, 0) for a, b in zip(turns, turns[1:]))


def _initials(rows: list[tuple[str, str]]) -> list[int]:
    return [INITIALS.get(role[:1], OTHER) for role, _ in rows]


def _digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
PIECE = pa.schema([
    ("key", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("whole", pa.bool_()),
    ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("turns", TURNS),
    ("hashes", pa.list_(pa.binary())), ("first_turn", pa.int64()), ("last_turn", pa.int64())])
PIECE_SQL = ("key string, part int, seq int, whole boolean, gaps bigint, blank bigint, duplicate bigint, "
             "truncated bigint, illegal bigint, cost bigint, audit string, turns array<struct<role:string,text:string>>, "
             "hashes array<binary>, first_turn bigint, last_turn bigint")
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _piece(key: str, part: int, seq: int, whole: bool, rows: list, turns: list[int]) -> dict:
    """A conversation, solved; or a block of one, as it is."""
    out = {"key": key, "part": part, "seq": seq, "whole": whole, "gaps": _gaps(turns),
           "illegal": _illegal(_initials(rows)), "first_turn": turns[0] if turns else None,
           "last_turn": turns[-1] if turns else None}
    if not whole:
        hashes = [_digest(role, text) for role, text in rows]
        return out | {"turns": [{"role": r, "text": t} for r, t in rows], "hashes": hashes}
    seen: set = set()

    def is_seen(role: str, text: str) -> bool:
        size = len(seen)
        seen.add((role, text))
        return len(seen) == size

    codes, blank, duplicate, truncated = _judge(rows, is_seen)
    audit, cost = _solve_short(codes) if len(codes) < 64 else solve(codes)[:2]
    return out | {"blank": blank, "duplicate": duplicate, "truncated": truncated, "cost": cost, "audit": audit,
                  "turns": repaired(audit, rows)}


def _pack(block_rows: int, block_chars: int):
    """Rows in order -> conversations, solved, and blocks of those that may go on elsewhere."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, chars = TaskContext.get().partitionId(), [], 0
        key, is_first, seq, rows, turns, size = None, True, 0, [], [], 0
        for batch in batches:
            for k, turn, role, text, copies in zip(*[batch.column(c).to_pylist() for c in (
                    "key", "turn", "role", "text", "copies")]):
                if k != key or len(rows) >= block_rows or size >= block_chars:
                    if key is not None:
                        ends = k != key
                        out.append(_piece(key, part, seq, ends and not seq and not is_first, rows, turns))
                        is_first, seq = is_first and not ends, 0 if ends else seq + 1
                        if len(out) >= OUT_ROWS or chars >= block_chars:
                            yield pa.RecordBatch.from_pylist(out, PIECE)
                            out, chars = [], 0
                    key, rows, turns, size = k, [], [], 0
                if copies:
                    rows.extend([(role, text)] * copies)
                    size, chars = size + len(text) * copies, chars + len(text) * copies
                    if turn is not None:
                        turns.append(turn)
        if key is not None:
            out.append(_piece(key, part, seq, False, rows, turns))
            yield pa.RecordBatch.from_pylist(out, PIECE)

    return run


SLIM = pa.schema([
    ("key", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("codes", pa.binary()), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("first_role", pa.int32()), ("last_role", pa.int32()),
    ("costs", pa.list_(pa.int64()))])
SLIM_SQL = ("key string, part int, seq int, codes binary, blank bigint, duplicate bigint, truncated bigint, "
            "first_role int, last_role int, costs array<bigint>")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes of a block's rows, now that earlier blocks are known, and its costs from state to state."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            seen = set(r["seen"] or [])

            def is_seen(role: str, text: str) -> bool:
                h, size = _digest(role, text), len(seen)
                seen.add(h)
                return len(seen) == size

            rows = [(t["role"], t["text"]) for t in r["turns"]]
            codes, blank, duplicate, truncated = _judge(rows, is_seen)
            # by the state at the end, then by the state at the start
            costs = [c for t in range(4) for c in start_costs(codes, tuple(0 if s == t else NEVER for s in range(4)))]
            roles = _initials(rows)
            out.append({"key": r["key"], "part": r["part"], "seq": r["seq"], "codes": codes, "blank": blank,
                        "duplicate": duplicate, "truncated": truncated, "costs": costs,
                        "first_role": roles[0] if roles else None, "last_role": roles[-1] if roles else None})
        yield pa.RecordBatch.from_pylist(out, SLIM)


ENDS_SQL = "key string, part int, seq int, end array<bigint>, final boolean"


def _end_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's costs behind it, from its conversation's last block backward."""
    key, v = None, LAST
    for batch in batches:
        ends, final = [], []
        for k, costs in zip(batch.column("key").to_pylist(), batch.column("costs").to_pylist()):
            final.append(k != key)
            key, v = k, LAST if k != key else v
            ends.append(list(v))
            v = tuple(min(costs[4 * t + s] + v[t] for t in range(4)) for s in range(4))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("key", "part", "seq")], pa.array(ends, pa.list_(pa.int64())), pa.array(final)],
            ["key", "part", "seq", "end", "final"])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state that a block's walk leads to, from each of the four it may begin in (-1: none)."""
    for batch in batches:
        exits = []
        for codes, end in zip(batch.column("codes").to_pylist(), batch.column("end").to_pylist()):
            begin = start_costs(codes, tuple(end))
            exits.append([solve(codes, s, tuple(end), False)[2] if begin[s] < NEVER else -1 for s in range(4)])
        names = ["key", "part", "seq", "first_role", "last_role", "first_turn", "last_turn"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(exits, pa.list_(pa.int32()))],
                                         [*names, "exits"])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's first state, and what its border with the block before adds to the counts."""
    key = None
    for batch in batches:
        entry, gaps, illegal = [], [], []
        for r in batch.to_pylist():
            if r["key"] != key:
                key, state, role, turn = r["key"], 0, None, None
            entry.append(state)
            has_border = role is not None and r["first_role"] is not None
            illegal.append(int(has_border and (role, r["first_role"]) not in LEGAL))
            gaps.append(max(r["first_turn"] - turn - 1, 0) if turn is not None and r["first_turn"] is not None else 0)
            state = r["exits"][state]
            role = role if r["last_role"] is None else r["last_role"]
            turn = turn if r["last_turn"] is None else r["last_turn"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("key", "part", "seq")], pa.array(entry, pa.int32()), pa.array(gaps, pa.int64()),
             pa.array(illegal, pa.int64())], ["key", "part", "seq", "entry", "more_gaps", "more_illegal"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            audit, cost, _ = solve(r["codes"], r["entry"], tuple(r["end"]), r["final"])
            rows = [(t["role"], t["text"]) for t in r["turns"]]
            out.append({c: r[c] for c in PIECE.names if c in r} | {
                "whole": False, "hashes": None, "cost": cost, "audit": audit, "turns": repaired(audit, rows, r["entry"])})
        yield pa.RecordBatch.from_pylist(out, PIECE)


def _walked(parts: DataFrame) -> DataFrame:
    """The blocks of conversations that lie in several, repaired."""
    place = ["key", "part", "seq"]
    here = F.struct("part", "seq")
    turns = parts.select(*place, F.explode(F.array_distinct("hashes")).alias("h"))
    first = F.min(here).over(Window.partitionBy("key", "h"))
    later = turns.withColumn("first", first).filter(here > F.col("first"))
    seen = later.groupBy(*place).agg(F.collect_list("h").alias("seen"))  # at most the rows of a block
    blocks = staged(parts.join(seen, place, "left").mapInArrow(_blocks, SLIM_SQL), "conversation-blocks")
    in_order = lambda df, *by: df.repartition("key").sortWithinPartitions("key", *by)
    ends = in_order(blocks.select(*place, "costs"), F.desc("part"), F.desc("seq")).mapInArrow(_end_vectors, ENDS_SQL)
    ends = staged(ends, "conversation-ends")
    judged = blocks.join(ends, place).join(parts.select(*place, "first_turn", "last_turn"), place)
    exits = judged.mapInArrow(_exits, "key string, part int, seq int, first_role int, last_role int, "
                                      "first_turn bigint, last_turn bigint, exits array<int>")
    entries = in_order(exits, "part", "seq").mapInArrow(
        _entries, "key string, part int, seq int, entry int, more_gaps bigint, more_illegal bigint")
    known = blocks.drop("first_role", "last_role", "costs").join(ends, place).join(entries, place)
    raw = parts.select(*place, "turns", "gaps", "illegal", "first_turn", "last_turn")
    met = raw.join(known, place).withColumn("gaps", F.col("gaps") + F.col("more_gaps")).withColumn(
        "illegal", F.col("illegal") + F.col("more_illegal"))
    return met.mapInArrow(_walk, PIECE_SQL)


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, copies``: the rows with the contract's damage, by a hash of their place.

    NULLs count as one blank (but a NULL turn stays one). ``copies`` is 0 for a
    row that is lost, 2 for one that is repeated.
    """
    blank = F.lit(" ")
    said = F.coalesce(F.col(text), blank)
    of = lambda c: F.coalesce(F.col(c).cast("string"), blank)
    kind = F.crc32(F.concat(of(conv_id), F.lit(":"), of(turn)).cast("binary")) % 20
    return rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce(F.col(role), blank)).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Repairs ``conv_id, turn, role, text, copies``; returns conversations in pieces.

    Columns: ``conv_id``; ``piece`` (their order in the conversation) and
    ``whole`` (the piece is all of it); ``gaps, blank, duplicate, truncated,
    illegal, cost`` (of a conversation: their sums); ``audit`` and ``turns``
    (of a conversation: the pieces' one after another).

    Rows go by turn, NULLs first, then by role, the text's first ``PREFIX``
    characters and its MD5: equal rows are neighbours and any order of the
    input gives the same result. A row of 0 copies only says that its
    conversation exists: one without other rows has an empty audit and no
    turns. A NULL conv_id is a conversation too. An empty table gives no rows.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    lost = F.col("copies") == 0
    empty = lambda c: F.when(~lost, F.coalesce(c, F.lit(" "))).otherwise("").alias(c)
    keyed = small_batches(rows).select(key.alias("key"), "turn", empty("role"), empty("text"), "copies")
    placed = keyed.select("*", F.substring("text", 1, PREFIX).alias("t1"), F.md5("text").alias("t2"),
                          F.monotonically_increasing_id().alias("salt"))
    order = ["key", "turn", "role", "t1", "t2"]
    # the salt splits copies of one row over tasks; they are alike, so it does not matter which goes where
    ordered = placed.repartitionByRange(*order, "salt").sortWithinPartitions(*order).drop("t1", "t2", "salt")
    pieces = staged(ordered.mapInArrow(_pack(block_rows, block_chars), PIECE_SQL), "conversations")
    out = pieces.filter("whole").unionAll(_walked(pieces.filter("NOT whole")))
    conv = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30).cast(kind))
    place = F.col("part").cast("bigint") * (1 << 32) + F.col("seq")
    return out.select(conv.alias("conv_id"), place.alias("piece"), "whole", *COUNTS, "audit", "turns")


SUMMARY = pa.schema([("key", pa.string()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()),
                     ("repaired_sha256", pa.string())])


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation, from its pieces in order; of the turns only the running hash is held."""
    key, now, audit, sha, is_begun = None, None, [], None, False

    def row() -> dict:
        return now | {"key": key, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}

    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["key"] != key:
                if key is not None:
                    out.append(row())
                key, now, audit, sha, is_begun = r["key"], dict.fromkeys(COUNTS, 0), [], hashlib.sha256(), False
            for c in COUNTS:
                now[c] += r[c]
            audit.append(r["audit"])
            for t in r["turns"]:
                sha.update(f"{chr(10) if is_begun else ''}{t['role']}:{t['text']}".encode())
                is_begun = True
        yield pa.RecordBatch.from_pylist(out, SUMMARY)
    if key is not None:
        yield pa.RecordBatch.from_pylist([row()], SUMMARY)


def summaries(pieces: DataFrame) -> DataFrame:
    """``conv_id``, the counts, ``audit`` and ``repaired_sha256`` (of ``role:text``, newline-joined) a conversation."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    whole = pieces.filter("whole").select("conv_id", *COUNTS, "audit", F.sha2(F.concat_ws("\n", lines), 256).alias("repaired_sha256"))
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    parts = pieces.filter("NOT whole").withColumn("key", key).drop("conv_id", "whole")
    rest = parts.repartition("key").sortWithinPartitions("key", "piece").mapInArrow(
        _summaries, "key string, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string")
    conv = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30).cast(kind))
    return whole.unionAll(rest.select(conv.alias("conv_id"), *COUNTS, "audit", "repaired_sha256"))
