"""Conversation structure repair: the cheapest edits that make role sequences legal, ties settled by prefix-doubling path ranking.

Rows of a conversation are taken by turn (nulls first), rows of one turn by a digest of role and text. A row is blank (no visible
character), else duplicate (role and text were there before), else truncated (its last visible character ends no sentence), else sound.
Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (the only one for blank and duplicate rows), Insert an empty user or assistant row 5; a
truncated row that stays adds 5. What is left has role initials ``(s?(ua)+)?``. The audit is the initials of the cheapest edits in order;
among equally cheap ones it is the least in ASCII.

Cost: a node is a place between rows and a state (start, after s, u or a). Costs to the end come from one pass over a row code per row,
right to left; the few vectors of cost differences are states of a table that is filled as they occur. Path: each node knows its optimal
arcs. Nodes are ranked by their least audit prefix of 1, 2, 4, ... letters, each round by the pair of ranks at the node and at its pointer,
which doubles too; a node takes the arc with the least letter and then the least ranked end, and paths are read off the doubled pointers.

A conversation's structure (some 400 bytes a row while it is ranked) is held by one task; its texts never are: they stream past the audit in order. Nulls in role or
text count as one space; rows without conv_id form a conversation. Repeated rows are duplicates of the first. Very long texts are taken
whole. Empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

START, S, U, A = range(4)
#: State after a row of each initial that is kept (s, u, a, other), -1 if it is not legal.
KEPT = np.array([[S, U, -1, -1], [-1, U, -1, -1], [-1, -1, A, -1], [-1, U, -1, -1]])
#: State after a user or assistant row that is put in or takes over a row.
TURN = np.array([U, U, A, U])
LETTERS = b"DIKR"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SOUND, CUT, GONE = range(3)
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Rows whose conversations are ranked together, unless one conversation is longer.
RANK_ROWS = 1 << 16

_VISIBLE = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"


class CostTable:
    """Transitions of cost vectors, found once each: (row code, vector) to (fall in cost, vector, optimal arcs of the four states)."""

    def __init__(self):
        self.vectors: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        self.known: dict[int, tuple[int, int, int]] = {}
        costs = _with_inserts([0, None, None, 0])
        self.end, self.end_arcs = self._vector(tuple(costs)), _arc_bits([[None, None, None, None]] * 4, costs, accept=(START, A))

    def _vector(self, costs: tuple[int, ...]) -> int:
        if costs not in self.number:
            self.number[costs] = len(self.vectors)
            self.vectors.append(costs)
        return self.number[costs]

    def step(self, code: int, vector: int) -> tuple[int, int, int]:
        """``code`` is 3 * initial + kind of the row before which the new vector stands."""
        key = vector * 12 + code
        if key not in self.known:
            initial, kind = divmod(code, 3)
            after, stay = self.vectors[vector], TRUNCATED * (kind == CUT)
            arcs = []
            for q in range(4):
                kept = int(KEPT[q, initial])
                keep = None if kind == GONE or kept < 0 else KEEP + stay + after[kept]
                rerole = None if kind == GONE else REROLE + stay + after[TURN[q]]
                arcs.append([DELETE + after[q], None, keep, rerole])
            costs = _with_inserts([min(x for x in a if x is not None) for a in arcs])
            low = min(costs)
            self.known[key] = (low, self._vector(tuple(c - low for c in costs)), _arc_bits(arcs, costs))
        return self.known[key]


def _with_inserts(costs: list[int | None]) -> list[int]:
    """Costs of the four states once rows may be put in before going on."""
    for _ in range(3):
        costs = [min(x for x in (c, None if costs[TURN[q]] is None else INSERT + costs[TURN[q]]) if x is not None)
                 if c is not None or costs[TURN[q]] is not None else None for q, c in enumerate(costs)]
    return costs  # type: ignore[return-value]


def _arc_bits(arcs: list, costs: list[int], accept: tuple[int, ...] = ()) -> int:
    """Bit 4 * state + letter for each arc on a cheapest path. A node that ends the conversation has none."""
    bits = 0
    for q in range(4):
        if q in accept:
            continue
        ways = list(arcs[q])
        ways[1] = INSERT + costs[TURN[q]]
        bits |= sum(1 << (4 * q + i) for i, w in enumerate(ways) if w == costs[q])
    return bits


def costs(codes: np.ndarray, begin: np.ndarray, table: CostTable) -> tuple[np.ndarray, np.ndarray]:
    """Least cost of each conversation, and the optimal arcs at every place (one more than rows per conversation)."""
    total, arcs = np.zeros(len(begin) - 1, np.int64), np.zeros(len(codes) + len(begin) - 1, np.uint16)
    known, ends = table.known, begin.tolist()
    rows = codes.tolist()
    for c in range(len(ends) - 1):
        vector, low = table.end, 0
        bits = [table.end_arcs]
        for i in range(ends[c + 1] - 1, ends[c] - 1, -1):
            found = known.get(vector * 12 + rows[i]) or table.step(rows[i], vector)
            low += found[0]
            vector = found[1]
            bits.append(found[2])
        total[c] = low + table.vectors[vector][START]
        arcs[ends[c] + c : ends[c + 1] + c + 1] = bits[::-1]
    return total, arcs


def least_paths(codes: np.ndarray, begin: np.ndarray, arcs: np.ndarray, longest: int) -> list[bytes]:
    """The least audit of each conversation among its cheapest; none is longer than ``longest``."""
    n_conv = len(begin) - 1
    place = np.arange(len(arcs))
    initial = np.zeros(len(arcs), np.int64)  # of the row after a place; a last place has no arc that asks for it
    last = begin[1:] + np.arange(n_conv)
    inner = np.ones(len(arcs), bool)
    inner[last] = False
    initial[inner] = codes // 3
    state = np.arange(4)
    target = np.empty((len(arcs), 4, 4), np.int32)  # place, state, letter
    target[:, :, 0] = 4 * (place[:, None] + 1) + state
    target[:, :, 1] = 4 * place[:, None] + TURN
    target[:, :, 2] = 4 * (place[:, None] + 1) + KEPT.T[initial]
    target[:, :, 3] = 4 * (place[:, None] + 1) + TURN
    target = target.reshape(-1, 4)
    open_ = (arcs[:, None] >> np.arange(16, dtype=np.uint16) & 1).astype(bool).reshape(-1, 4)
    node, first = np.arange(len(target)), open_.argmax(axis=1)
    ended = ~open_.any(axis=1)
    rank = np.where(ended, 0, first + 1).astype(np.int64)
    jump = np.where(ended, node, target[node, first]).astype(np.int32)
    rounds, classes = max(1, int(longest).bit_length()), 0
    step = jump
    for _ in range(rounds):  # ranks by 2, 4, 8, ... letters
        seen, rank = np.unique(rank * (len(rank) + 5) + rank[step], return_inverse=True)
        if len(seen) == classes:
            break  # no prefix tells more nodes apart, so no longer one will
        classes, step = len(seen), step[step]
    ways = np.where(open_, np.arange(4) * (len(rank) + 1) + rank[np.where(open_, target, 0)], np.iinfo(np.int64).max)
    letter = ways.argmin(axis=1)
    pointers = [np.where(ended, node, target[node, letter]).astype(np.int32)]
    while len(pointers) < rounds:
        pointers.append(pointers[-1][pointers[-1]])
    path = (4 * (begin[:-1] + np.arange(n_conv)) + START)[:, None]
    for step in reversed(pointers):
        path = np.stack((path, step[path]), axis=2).reshape(n_conv, -1)
    spelled = np.where(ended, 0, np.frombuffer(LETTERS, np.uint8)[letter]).astype(np.uint8)[path]
    return [x.tobytes().rstrip(b"\0") for x in spelled]


def audits(codes: np.ndarray, begin: np.ndarray, table: CostTable) -> tuple[np.ndarray, list[bytes]]:
    """Least cost and audit of every conversation; those of like length are ranked together."""
    total, arcs = costs(codes, begin, table)
    size = np.diff(begin)
    bound = size + total // INSERT + 1
    grade = np.frexp(bound.astype(np.float64))[1]
    out: list[bytes] = [b""] * len(size)
    for g in np.unique(grade):
        members = np.flatnonzero(grade == g)
        parts = np.cumsum(size[members]) // RANK_ROWS
        for part in np.split(members, np.flatnonzero(np.diff(parts)) + 1):
            rows = np.concatenate([np.arange(begin[c], begin[c + 1]) for c in part])
            places = np.concatenate([np.arange(begin[c] + c, begin[c + 1] + c + 1) for c in part])
            found = least_paths(codes[rows], np.cumsum([0, *size[part]]), arcs[places], int(bound[part].max()))
            for c, audit in zip(part.tolist(), found, strict=True):
                out[c] = audit
    return total, out


# --- rows ----------------------------------------------------------------------------------------------------------------


def rows_of(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text and a digest of role and text; nulls in role and text are one space."""
    role_, text_ = (F.coalesce(F.col(c), F.lit(" ")) for c in (role, text))
    digest = F.unhex(F.md5(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_)))
    return conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), role_.alias("role"), text_.alias("text"), digest.alias("digest"))


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def report(rows: DataFrame) -> DataFrame:
    """conv_id, n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation of ``rows_of``; texts are not moved."""
    visible, ended = F.col("text").rlike(_VISIBLE), F.col("text").rlike(_ENDED)
    shape = (F.when(~visible, 0).when(~ended, 1).otherwise(2) + 3 * _initial(F.col("role"))).cast("tinyint")
    narrow = rows.select("conv_id", "turn", "digest", shape.alias("shape")).repartition("conv_id") \
        .sortWithinPartitions(F.asc("conv_id"), F.asc("turn"), F.asc("digest"))
    counts = ["n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = CostTable()
        for whole in _whole_conversations(batches):
            begin, ids = _runs(whole["conv_id"])
            measured = _measured(whole, begin, table)
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(measured[c], pa.int64()) for c in counts], pa.array([a.decode() for a in measured["audit"]], pa.string())],
                                             names=["conv_id", *counts, "audit"])

    return narrow.mapInArrow(run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {', '.join(f'{c} bigint' for c in counts)}, audit string")


def _whole_conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that end where a conversation ends, from sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in (b for b in batches if b.num_rows):
        begin, _ = _runs(batch["conv_id"])
        cut = int(begin[-2])  # the last conversation may go on
        if held and not _same(held[-1]["conv_id"][-1], batch["conv_id"][0]):
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _same(a: pa.Scalar, b: pa.Scalar) -> bool:
    return a.as_py() == b.as_py()


def _runs(ids) -> tuple[np.ndarray, pa.Array]:
    """The n + 1 places where runs of equal ids begin and end, and the id of each."""
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    runs = pa.compute.run_end_encode(ids.dictionary_encode(null_encoding="encode").indices)
    begin = np.concatenate(([0], runs.run_ends.to_numpy().astype(np.int64)))
    return begin, ids.take(pa.array(begin[:-1]))


def _measured(rows: pa.Table, begin: np.ndarray, table: CostTable) -> dict:
    """Faults, costs and audits of whole conversations in order."""
    n, n_conv = rows.num_rows, len(begin) - 1
    conv = np.repeat(np.arange(n_conv), np.diff(begin))
    shape = rows["shape"].to_numpy().astype(np.int64)
    initial, look = shape // 3, shape % 3
    digest = np.frombuffer(b"".join(rows["digest"].to_pylist()), "<u8").reshape(n, 2)
    order = np.lexsort((np.arange(n), digest[:, 1], digest[:, 0], conv))
    again = np.zeros(n, bool)
    a, b = order[:-1], order[1:]
    again[b] = (conv[a] == conv[b]) & (digest[a] == digest[b]).all(axis=1)
    blank = look == 0
    duplicate, truncated = again & ~blank, (look == 1) & ~again
    kind = np.where(blank | duplicate, GONE, np.where(truncated, CUT, SOUND))
    total, audit = audits(3 * initial + kind, begin, table)
    per = lambda mask: np.bincount(conv, weights=mask, minlength=n_conv).astype(np.int64)
    next_to = np.zeros(n, bool)
    next_to[1:] = conv[1:] == conv[:-1]
    legal = np.zeros((4, 4), bool)
    legal[tuple(np.array(sorted(LEGAL)).T)] = True
    before = np.concatenate(([0], initial[:-1]))
    return {"n_rows": np.diff(begin), "gaps": _gaps(rows["turn"].combine_chunks(), conv, begin), "blank": per(blank), "duplicate": per(duplicate),
            "truncated": per(truncated), "illegal": per(next_to & ~legal[before, initial]), "cost": total, "audit": audit}


def _gaps(turn: pa.Array, conv: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Turns missing between the first and the last; rows are sorted by turn, nulls first."""
    known, value = np.asarray(turn.is_valid()), turn.fill_null(0).to_numpy()
    out = np.zeros(len(begin) - 1, np.int64)
    conv, value = conv[known], value[known]
    if len(conv):
        first = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
        last = np.append(first[1:], len(conv)) - 1
        new = np.concatenate(([True], (conv[1:] != conv[:-1]) | (value[1:] != value[:-1])))
        out[conv[first]] = value[last] - value[first] + 1 - np.add.reduceat(new.astype(np.int64), first)
    return out


def repaired(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, place (from 1), edit, role, text. Partitions hold whole conversations in order.

    Rows pass the audit of their conversation one by one in order; only the audit is held.
    """
    kinds = rows.schema
    lead = reports.select("conv_id", F.lit(0).alias("tag"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("role"),
                          F.lit(None).cast("string").alias("text"))
    both = lead.unionByName(rows.withColumn("tag", F.lit(1))).repartition("conv_id") \
        .sortWithinPartitions(F.asc("conv_id"), F.asc("tag"), F.asc("turn"), F.asc("digest")).select("conv_id", "tag", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "place", "edit", "role", "text"]
        conv, audit, at, state, place = None, "", 0, START, 0
        out: list[tuple] = []

        def put(edit: str, role: str, text: str) -> None:
            nonlocal place
            place += 1
            out.append((conv, place, edit, role, text))

        def inserts() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                state = TURN[state]
                put("I", "user" if state == U else "assistant", "")
                at += 1

        for b in batches:
            for c, tag, role, text in zip(*(b[x].to_pylist() for x in ("conv_id", "tag", "role", "text")), strict=True):
                if tag == 0:
                    inserts()  # of the conversation before
                    conv, audit, at, state, place = c, role, 0, START, 0
                    continue
                inserts()
                edit = audit[at]
                at += 1
                if edit == "K":
                    state = {"s": S, "u": U, "a": A}[role[0]]
                    put("K", role, text)
                elif edit == "R":
                    state = TURN[state]
                    put("R", "user" if state == U else "assistant", text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                out.clear()
        inserts()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(kinds["conv_id"].dataType), pa.int64(), pa.string(), pa.string(), pa.string()]
    return both.mapInArrow(run, f"conv_id {kinds['conv_id'].dataType.simpleString()}, place bigint, edit string, role string, text string")


def text_digests(repaired_rows: DataFrame) -> DataFrame:
    """sha256 of ``role:text``, newline-joined, of every conversation with repaired rows, hashed as the rows of ``repaired`` pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, conv = None, None
        for b in batches:
            done: list[tuple] = []
            for c, place, role, text in zip(*(b[x].to_pylist() for x in ("conv_id", "place", "role", "text")), strict=True):
                if place == 1:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    digest, conv = hashlib.sha256(), c
                digest.update(f"{role}:{text}".encode() if place == 1 else f"\n{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], b.schema.field("conv_id").type), pa.array([x[1] for x in done])], names=names)
            kind = b.schema.field("conv_id").type
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()])], names=names)

    names = ["conv_id", "repaired_sha256"]
    rows = repaired_rows.select("conv_id", "place", "role", "text")
    return rows.mapInArrow(run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, by the checksum of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 removes ends of
    sentences, 3 repeats it, 4 makes it the user's. Nulls are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")
