"""Chat formatting with minimum-cost role repair.

A conversation is legal if it is an optional system message followed by user and assistant messages in
turn, beginning with the user and ending with the assistant. Dynamic programming over the automaton of
legal turns finds the cheapest repair: a message keeps its role, takes another, or joins the message
before it, and empty messages of either side may be put in. The repaired messages are then rendered.

The step of one message is a small matrix in the (min, +) algebra, and matrices of neighbouring messages
combine to one. Rows are dealt by ranges of (conversation, turn), so a conversation of any length lies in
as many parts as it needs: each part yields its matrix, and the matrices of conversations that cross parts,
two for each part at most, are combined on the driver to the costs that each part is entered with. From these
such parts tell by which state they are entered for each one that they could be left by, the driver goes
through these backward, and every part then repairs its own messages.

Costs: fixed values below. Ties are broken from the end backward, by the lower state and then the earlier choice in
the order of CHOICES, in a whole conversation as in one that lies in many parts: results do not depend on them.

Defined results: a null role or one that is not known counts as foreign, whose relabelling is cheap; a
null or empty text stays as an empty message; a text of any length is one row and is never cut; messages of equal
turn go by role, then text, nulls first;
rows with a null conversation form one conversation; repeated rows each stay a message; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

SYSTEM, USER, ASSISTANT = "system", "user", "assistant"
ROLES = (SYSTEM, USER, ASSISTANT)
#: Costs of relabelling a known and a foreign role, of joining a message to the one before
#: of the same and of another role, and of putting in an empty message.
RELABEL, FOREIGN, JOIN, JOIN_OTHER, INSERT = 4, 1, 1, 6, 3
#: States: nothing yet, and the role of the last message.
START, STATES = 0, 4
AFTER = {SYSTEM: 1, USER: 2, ASSISTANT: 3}
_FAR = 1 << 40
#: What may be put in before a message: nothing, one empty side, or both sides.
CHOICES = ((), (USER,), (ASSISTANT,), (USER, ASSISTANT), (ASSISTANT, USER))
TEMPLATE = "<|{role}|>\n{text}<|end|>\n"


def _next(state: int, role: str) -> int | None:
    """The state after a message of role, if that is legal."""
    if role == SYSTEM:
        return 1 if state == START else None
    if role == USER:
        return 2 if state in (START, 1, 3) else None
    return 3 if state == 2 else None


@dataclass(frozen=True)
class Move:
    cost: int
    to: int
    inserted: tuple[str, ...]
    role: str
    join: bool


def moves(role: str | None, previous: str | None) -> list[list[Move]]:
    """For each state what a message may do; previous: the raw role before it, which a join compares."""
    out: list[list[Move]] = []
    for state in range(STATES):
        found = []
        for inserted in CHOICES:
            at: int | None = state
            for r in inserted:
                at = _next(at, r) if at is not None else None
            if at is None:
                continue
            for target in ROLES:
                if (to := _next(at, target)) is not None:
                    change = 0 if target == role else RELABEL if role in ROLES else FOREIGN
                    found.append(Move(change + INSERT * len(inserted), to, inserted, target, False))
        if state != START:
            found.append(Move(JOIN if role == previous else JOIN_OTHER, state, (), ROLES[state - 1], True))
        out.append(found)
    return out


_MOVES: dict[tuple[str | None, str | None], tuple[list[list[Move]], np.ndarray]] = {}


def _step(role: str | None, previous: str | None) -> tuple[list[list[Move]], np.ndarray]:
    """Moves and their matrix; roles outside ROLES are alike, but for being equal to the one before."""
    key = (role if role in ROLES else "*", previous if previous in ROLES else "*" if role == previous else "?")
    if key not in _MOVES:
        own = moves(None if key[0] == "*" else key[0], None if key[1] == "*" else key[1])
        matrix = np.full((STATES, STATES), _FAR, np.int64)
        for s, options in enumerate(own):
            for m in options:
                matrix[s, m.to] = min(matrix[s, m.to], m.cost)
        _MOVES[key] = own, matrix
    return _MOVES[key]


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), _FAR)


#: What it costs to end in each state: an assistant's message must come last; a system message alone needs both.
FINISH = ((), (USER, ASSISTANT), (ASSISTANT,), ())
_END = np.asarray([0, 2 * INSERT, INSERT, 0], np.int64)


def _costs(roles: list[str | None], entry: np.ndarray, previous: str | None) -> tuple[list[np.ndarray], list]:
    """What each state costs before the first and after every message, and the moves of each."""
    costs, steps = [entry], []
    for role in roles:
        own, matrix = _step(role, previous)
        steps.append(own)
        costs.append(np.minimum((costs[-1][:, None] + matrix).min(axis=0), _FAR))
        previous = role
    return costs, steps


def _back(costs: list[np.ndarray], steps: list, state: int) -> tuple[list[Move], int]:
    """The moves that end in state, and the state that they begin in."""
    out = []
    for k in range(len(steps) - 1, -1, -1):
        found = ((s, m) for s in range(STATES) for m in steps[k][s] if m.to == state and costs[k][s] + m.cost == costs[k + 1][state])
        state, move = next(found)
        out.append(move)
    return out[::-1], state


def repair(roles: list[str | None], entry: np.ndarray, leave: int | None = None, previous: str | None = None) -> list[Move]:
    """The cheapest moves of a run of messages: entry, what each state before it costs; leave: the state that it has
    to end in, without one that which is the cheapest to finish."""
    costs, steps = _costs(roles, entry, previous)
    return _back(costs, steps, int(np.argmin(costs[-1] + _END)) if leave is None else leave)[0]


_FIRST = np.asarray([0, _FAR, _FAR, _FAR], np.int64)


_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _groups(batches: Iterator[pa.RecordBatch]):
    """(part, run, conversation, rows) in order, a run of equal conversations in a part each; rows: (turn, role, text)."""
    now, held, run = None, [], 0
    for batch in batches:
        for part, conv, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and (part, conv) != now:
                yield now[0], run, now[1], held
                run, held = run + 1 if part == now[0] else 0, []
            now = (part, conv)
            held.append(row)
    if held:
        yield now[0], run, now[1], held


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Writes each row's part and place down, so that later passes agree on them."""
    part, place = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(np.arange(place, place + n)), *batch.columns], ["part", "place", "conv", "turn", "role", "text"])
        place += n


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last run of each part, which may go on elsewhere: its matrix and outer roles."""
    runs: list[tuple] = []
    for part, run, conv, rows in _groups(batches):
        total, previous = None, None
        for j, (_, role, _) in enumerate(rows):
            if j:  # the first message's step depends on the part before
                own = _step(role, previous)[1]
                total = own if total is None else _times(total, own)
            previous = role
        if total is None:
            total = np.where(np.eye(STATES, dtype=bool), 0, _FAR).astype(np.int64)
        if run > 1:
            runs.pop()
        runs.append((part, run, conv, len(rows), rows[0][1], rows[-1][1], total.ravel().tolist()))
    yield _batch(runs, _RUNS)


_RUNS = "part int, run long, conv long, n long, first string, last string, matrix array<long>"


@dataclass
class Border:
    """A part of a conversation that crosses parts: costs at its entry, the raw role and the number of messages before
    it, the state that it is left by, and whether the conversation ends in it."""

    entry: np.ndarray
    previous: str | None
    before: int
    leave: int | None = None
    end: bool = False


def _chains(rows: list) -> list[list[tuple[tuple[int, int], Border]]]:
    """The parts of each conversation that has several, in order; the last one's leave is known."""
    chains: dict = {}
    for r in sorted(rows, key=lambda r: (r.part, r.run)):
        chains.setdefault(r.conv, []).append(r)
    out = []
    for chain in chains.values():
        if len(chain) < 2:
            continue
        entry, previous, before, found = _FIRST, None, 0, []
        for r in chain:
            found.append(((r.part, r.run), Border(entry, previous, before)))
            whole = _times(_step(r.first, previous)[1], np.asarray(r.matrix, np.int64).reshape(STATES, STATES))
            entry = np.minimum((entry[:, None] + whole).min(axis=0), _FAR)
            previous, before = r.last, before + r.n
        found[-1][1].leave, found[-1][1].end = int(np.argmin(entry + _END)), True
        out.append(found)
    return out


_OUT = "conv_id long, message long, piece long, turn long, role string, text string, change string, rendered string"


def format_chats(messages: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row for each message of the repaired conversations: conv_id, message, piece, turn, role, text, change, rendered.

    message numbers a conversation's messages as they were given, from 0; (message, piece) orders the rows, as
    inserted messages come with that before which, or at the end after which, they stand. change is kept,
    relabelled, joined or inserted; a joined message is rendered as the continuation of the one before. rendered,
    concatenated in order, is the whole conversation in the template's form."""
    head, _, tail = template.partition("{text}")
    rows = messages.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), "role", "text")
    dealt = rows.repartitionByRange("conv", "turn", "role", F.xxhash64("text")).sortWithinPartitions("conv", "turn", "role", "text")
    dealt = keep(dealt.mapInArrow(_numbered, "part int, place long, conv long, turn long, role string, text string"))
    dealt = dealt.repartition("part").sortWithinPartitions("part", "place").select("part", "conv", "turn", "role", "text")
    spark = messages.sparkSession
    chains = _chains(dealt.mapInArrow(_parts, _RUNS).collect())  # two rows for each partition at most
    borders = {key: border for chain in chains for key, border in chain}
    if chains:
        entries = spark.sparkContext.broadcast(borders)

        def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = []
            for part, k, _, rows in _groups(batches):
                if (own := entries.value.get((part, k))) is not None:
                    costs, steps = _costs([r for _, r, _ in rows], own.entry, own.previous)
                    found.append((part, k, [_back(costs, steps, s)[1] if costs[-1][s] < _FAR else -1 for s in range(STATES)]))
            yield _batch(found, "part int, run long, ways array<long>")

        entered = {(r.part, r.run): r.ways for r in dealt.mapInArrow(ways, "part int, run long, ways array<long>").collect()}
        for chain in chains:
            for (key, later), (_, border) in zip(chain[:0:-1], chain[-2::-1], strict=True):
                border.leave = entered[key][later.leave]
    sent = spark.sparkContext.broadcast(borders)
    whole = Border(_FIRST, None, 0, None, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for part, k, conv, rows in _groups(batches):
            own = sent.value.get((part, k), whole)
            plan = repair([r for _, r, _ in rows], own.entry, own.leave, own.previous)
            opened, message = own.before > 0, own.before
            for message, ((turn, role, text), m) in enumerate(zip(rows, plan, strict=True), own.before):
                for piece, r in enumerate(m.inserted):
                    out.append((conv, message, piece, None, r, "", "inserted", (tail if opened else "") + head.format(role=r)))
                    opened = True
                change = "joined" if m.join else "kept" if m.role == role else "relabelled"
                start = "\n" if m.join else (tail if opened else "") + head.format(role=m.role)
                out.append((conv, message, len(m.inserted), turn, m.role, text or "", change, start + (text or "")))
                opened = True
            if own.end:
                for piece, r in enumerate(FINISH[plan[-1].to], out[-1][2] + 1):
                    out.append((conv, message, piece, None, r, "", "inserted", tail + head.format(role=r)))
                *rest, last = out.pop()
                out.append((*rest, last + tail))
            if len(out) > 20_000:
                yield _batch(out, _OUT)
                out = []
        yield _batch(out, _OUT)

    return dealt.mapInArrow(run, _OUT)
