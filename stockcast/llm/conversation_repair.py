"""Repair of conversations to user/assistant turns by iterative-deepening A*.

The rows of a conversation, in order, are edited until their role initials read `(s?(ua)+)?`: Keep costs 0, Rerole 3, Delete 4
(required for a row that is blank or repeats an earlier one), Insert of an empty user or assistant turn 3; a truncated row that
is not deleted adds 3. Among the cheapest ways the one with the ASCII-least string of edit initials wins.

`cheapest` finds it: depth-first search in the order D, I, K, R under a bound on cost so far plus a lower bound of the rest,
raised to the least value that exceeded it until a path is accepted. (place, state) pairs that failed are kept with the budget they had. A state
is what the initials so far ask for: nothing yet, after s, after u, after a; it also says which role a Rerole or an Insert gives. As the
lower bound never exceeds the real cost, the first accepted path is the cheapest, and as edits are tried in ASCII order, the least.

Rows are dealt by ranges of (conversation, turn, role, text) and sorted, so a conversation of any length may span tasks. A task
cuts its rows into pieces of at most PIECE rows. A conversation that lies in one piece inside one task is repaired there. Pieces of
the others (the long ones, and those at a task's ends) are written down; for each the search gives the cheapest edits from every state to
every state, and the pieces are then joined in order. Two equally cheap strings over the same rows and states are never one the beginning of the
other, so joining the least ones gives the least whole. Joining carries only costs and edit letters; texts are read once more to
write the repaired rows, piece by piece, into the checksum.

Order: turn (nulls first), then role, then text. Defined cases: a null role or text is one space. Rows with a null conversation id are one
conversation. The first character of a role is its initial; an empty role has none. Repeated rows count as often as they occur. A
conversation without rows has zeros, an empty audit and the checksum of the empty string. Other columns are ignored, whatever their names. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockcast.llm.text import materialize, on_batches

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: rows of a piece, and characters after which a piece is closed
PIECE, PIECE_CHARACTERS = 128, 1 << 22
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
ACCEPTING = (NOTHING, AFTER_A)
#: the state behind an initial; what is missing is not allowed
NEXT = {(NOTHING, "s"): AFTER_S, (NOTHING, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
#: the initial a Rerole or an Insert gives in each state
WANTED = ("u", "u", "a", "u")
ROLE = {"u": "user", "a": "assistant"}
ADJACENT = {"su", "ua", "au"}

#: (has to be deleted, cost of not deleting, initial) of a row
Turn = tuple[bool, int, str]


def lower_bounds(turns: list[Turn], initials: str = "sua") -> list[int]:
    """At each place a cost that the turns from there on have at least: what each turn costs by itself, and 3 or more for two
    neighbours that cannot both stay without an edit or something between them. Turns with other `initials` cannot be kept."""
    least = lambda extra: min(DELETE, extra)
    out, after = [0] * (len(turns) + 1), None  # after: the next turn that may stay
    for k in range(len(turns) - 1, -1, -1):
        gone, extra, initial = turns[k]
        known = initial != "" and initial in initials
        own = DELETE if gone else least(extra if known else extra + REROLE)
        out[k] = own + out[k + 1]
        if gone:
            continue
        if known and after is not None:
            _, extra2, initial2 = turns[after]
            if initial2 and initial2 in initials and initial + initial2 not in ADJACENT:
                both = min(extra + extra2 + min(REROLE, INSERT), DELETE + least(extra2), DELETE + least(extra))
                out[k] = max(out[k], both + DELETE * (after - k - 1) + out[after + 1])
        after = k
    return out


def _reachable(turns: list[Turn], begin: int, end: int) -> bool:
    """Whether any edits lead from state to state: only a conversation's first kept s leads to AFTER_S, and nothing leads back."""
    if end in (AFTER_U, AFTER_A):
        return True
    return begin == end or (end == AFTER_S and begin == NOTHING and any(not gone and i == "s" for gone, _, i in turns))


def cheapest(turns: list[Turn], begin: int = NOTHING, end: int | None = None) -> tuple[int, str] | None:
    """Cost and edit initials of the cheapest way from state `begin` to state `end` (None: any accepting state), or None."""
    ends = ACCEPTING if end is None else (end,)
    if not any(_reachable(turns, begin, e) for e in ends):
        return None
    n = len(turns)
    if end in (NOTHING, AFTER_S):  # nothing leads back there: every turn goes, but for one kept s on the way from the start

        def least(k: int, state: int) -> float:
            return math.inf if state not in (NOTHING, end) else DELETE * max(0, n - k - (state != end))
    else:
        rest = lower_bounds(turns, "ua")  # an s can only be kept at the start, and there only one
        start = [max(a, b - DELETE) for a, b in zip(lower_bounds(turns), rest, strict=True)]

        def least(k: int, state: int) -> float:
            return (rest if state != NOTHING else start)[k]

    bound = least(0, begin)
    while True:
        failed, above = {}, math.inf

        def go(k: int, state: int, left: int) -> list[str] | None:
            nonlocal above
            if k == n and state in ends:
                return []
            if failed.get((k, state), -1) >= left:
                return None
            moves = [("I", k, NEXT[state, WANTED[state]], INSERT)]
            if k < n:
                gone, extra, initial = turns[k]
                moves.insert(0, ("D", k + 1, state, DELETE))
                if not gone:
                    if (state, initial) in NEXT:
                        moves.append(("K", k + 1, NEXT[state, initial], KEEP + extra))
                    moves.append(("R", k + 1, NEXT[state, WANTED[state]], REROLE + extra))
            for edit, at, to, cost in moves:
                over = cost + least(at, to) - left
                if over > 0:
                    above = min(above, bound + over)
                elif (path := go(at, to, left - cost)) is not None:
                    path.append(edit)
                    return path
            failed[k, state] = left
            return None

        path = go(0, begin, bound)
        if path is not None:
            return bound, "".join(reversed(path))
        bound = above


def edited(audit: str, begin: int, rows: list[tuple[str, str]]) -> list[str]:
    """The repaired `role:text` lines; `begin` is the state before the rows."""
    out, state, k = [], begin, 0
    for edit in audit:
        if edit == "D":
            k += 1
            continue
        initial = rows[k][0][:1] if edit == "K" else WANTED[state]
        role = rows[k][0] if edit == "K" else ROLE[initial]
        out.append(f"{role}:{'' if edit == 'I' else rows[k][1]}")
        k += edit != "I"
        state = NEXT[state, initial]
    return out


def is_blank(text: str) -> bool:
    return not text.strip(" \t\n\v\f\r")


def is_truncated(text: str) -> bool:
    return text.rstrip(" \t\n\v\f\r")[-1:] not in (".", "!", "?")


def turns_of(rows: list[tuple[str, str]], repeated: set[int]) -> list[tuple[str, Turn]]:
    """(fault, turn) of each row; `repeated` are the places of rows that occurred before."""
    out = []
    for k, (role, text) in enumerate(rows):
        fault = "blank" if is_blank(text) else "duplicate" if k in repeated else "truncated" if is_truncated(text) else ""
        out.append((fault, (fault in ("blank", "duplicate"), TRUNCATED * (fault == "truncated"), role[:1])))
    return out


def repeats(rows: list[tuple[str, str]]) -> set[int]:
    seen: set[tuple[str, str]] = set()
    return {k for k, row in enumerate(rows) if row in seen or seen.add(row)}


class Tally:
    """What is counted along a conversation: faults, gaps of turn numbers, neighbours whose roles do not fit."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first = self.last = self.initial = None

    def add(self, turns: Iterable[int | None], faults: Iterable[str], initials: Iterable[str]) -> None:
        for turn, fault, initial in zip(turns, faults, initials, strict=True):
            if fault:
                setattr(self, fault, getattr(self, fault) + 1)
            self.illegal += self.initial is not None and self.initial + initial not in ADJACENT
            self.initial = initial
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last, self.distinct = turn, self.distinct + 1

    def values(self) -> dict[str, int]:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return {"gaps": gaps, **{c: getattr(self, c) for c in ("blank", "duplicate", "truncated", "illegal")}}


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT = "conv string, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
PIECES = RESULT + ", part long, turns array<long>, roles array<string>, texts array<string>, digests array<binary>"


def _columns(schema: str) -> list[str]:
    return [part.strip().split(" ")[0] for part in schema.split(",")]


def _digest(row: tuple[str, str]) -> bytes:
    role, text = (s.encode("utf-8", "surrogatepass") for s in row)
    return hashlib.sha256(b"%d:%b%b" % (len(role), role, text)).digest()


def _repaired(lines: list[str]) -> bytes:
    return "\n".join(lines).encode("utf-8", "surrogatepass")


def _whole(conv: str, turns: list, rows: list[tuple[str, str]]) -> dict[str, Any]:
    """The result row of a conversation that lies in one piece."""
    judged = turns_of(rows, repeats(rows))
    tally = Tally()
    tally.add(turns, [f for f, _ in judged], [role[:1] for role, _ in rows])
    cost, audit = cheapest([t for _, t in judged])
    sha = hashlib.sha256(_repaired(edited(audit, NOTHING, rows))).hexdigest()
    return {"conv": conv, **tally.values(), "cost": cost, "audit": audit, "repaired_sha256": sha}


def _cut(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Sorted rows of a task: result rows of the conversations inside it, pieces of those that may go on elsewhere."""
    names = _columns(PIECES)
    number = TaskContext.get().partitionId() << 32
    out: list[dict] = []
    conv, turns, rows, size = None, [], [], 0
    first, several = True, False  # the conversation is the task's first; has pieces before this one

    def close(open_: bool) -> None:
        nonlocal turns, rows, size, number
        if open_:
            out.append({"conv": conv, "part": number, "turns": turns, "roles": [r for r, _ in rows], "texts": [t for _, t in rows],
                        "digests": [_digest(row) for row in rows]})
            number += 1
        else:
            out.append(_whole(conv, turns, rows))
        turns, rows, size = [], [], 0

    def flushed() -> dict:
        made = {c: [row.get(c) for row in out] for c in names}
        out.clear()
        return made

    for batch in parts:
        columns = (batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text"))
        for one, turn, role, text in zip(*columns, strict=True):
            if one != conv and conv is not None:
                close(first or several)
                first = several = False
            elif len(rows) >= PIECE or size >= PIECE_CHARACTERS:
                close(True)
                several = True
            conv = one
            turns.append(turn)
            rows.append((role, text))
            size += len(text)
        if out:
            yield flushed()
    if rows:
        close(True)  # the next task may go on with it
        yield flushed()


def _with_repeats(pieces: DataFrame) -> DataFrame:
    """Each piece with the places of its rows that occurred before in their conversation."""
    each = pieces.select("conv", "part", F.posexplode("digests").alias("at", "digest"))
    before = Window.partitionBy("conv", "digest").orderBy("part", "at")
    later = each.withColumn("nth", F.row_number().over(before)).where("nth > 1").groupBy("conv", "part").agg(F.collect_list("at").alias("repeated"))
    return pieces.drop("digests").join(later, ["conv", "part"], "left")


def _rows(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in parts:
        yield from batch.to_pylist()


WAYS = [(a, b) for a in range(4) for b in range(4)]
LIGHT = "conv string, part long, turns array<long>, faults array<string>, initials array<string>, costs array<long>, audits array<string>"


def _ways(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Per piece the cheapest edits between any two states."""
    for row in _rows(parts):
        rows = list(zip(row["roles"], row["texts"], strict=True))
        judged = turns_of(rows, set(row["repeated"] or ()))
        ways = [cheapest([t for _, t in judged], a, b) for a, b in WAYS]
        yield {"conv": [row["conv"]], "part": [row["part"]], "turns": [row["turns"]], "faults": [[f for f, _ in judged]],
               "initials": [[t[2] for _, t in judged]],
               "costs": [[None if w is None else w[0] for w in ways]], "audits": [[None if w is None else w[1] for w in ways]]}


JOINED = RESULT + ", parts array<long>, begins array<long>, edits array<string>"


def _join(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Pieces by conversation and place: the cheapest whole, and what it does in each piece."""
    names = _columns(JOINED)
    conv, tally, best, trail, numbers = None, Tally(), {}, [], []

    def done() -> dict:
        (cost, audit), end = min((best[e], e) for e in ACCEPTING if e in best)
        begins, edits = [], []
        for came in reversed(trail):
            begin, edit = came[end]
            begins.append(begin)
            edits.append(edit)
            end = begin
        row = {"conv": conv, **tally.values(), "cost": cost, "audit": audit, "parts": numbers, "begins": begins[::-1], "edits": edits[::-1]}
        return {c: [row.get(c)] for c in names}

    for row in _rows(parts):
        if row["conv"] != conv:
            if conv is not None:
                yield done()
            conv, tally, best, trail, numbers = row["conv"], Tally(), {NOTHING: (0, "")}, [], []
        tally.add(row["turns"], row["faults"], row["initials"])
        to: dict[int, tuple[int, str]] = {}
        came: dict[int, tuple[int, str]] = {}
        for (a, b), cost, audit in zip(WAYS, row["costs"], row["audits"], strict=True):
            if a in best and cost is not None:
                whole = (best[a][0] + cost, best[a][1] + audit)
                if b not in to or whole < to[b]:
                    to[b], came[b] = whole, (a, audit)
        best = to
        trail.append(came)
        numbers.append(row["part"])
    if conv is not None:
        yield done()


def _lines(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for row in _rows(parts):
        lines = edited(row["edit"], row["begin"], list(zip(row["roles"], row["texts"], strict=True)))
        yield {"conv": [row["conv"]], "part": [row["part"]], "n": [len(lines)], "lines": [_repaired(lines)]}


def _checksums(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Repaired lines by conversation and place, read one piece at a time."""
    conv, sha, some = None, None, False
    for row in _rows(parts):
        if row["conv"] != conv:
            if conv is not None:
                yield {"conv": [conv], "sha": [sha.hexdigest()]}
            conv, sha, some = row["conv"], hashlib.sha256(), False
        if row["n"]:
            sha.update((b"\n" if some else b"") + row["lines"])
            some = True
    if conv is not None:
        yield {"conv": [conv], "sha": [sha.hexdigest()]}


def _joined(pieces: DataFrame) -> DataFrame:
    """Result rows of the conversations that lie in several pieces."""
    known = materialize(_with_repeats(pieces.select("conv", "part", "turns", "roles", "texts", "digests")))
    light = materialize(on_batches(known, _ways, LIGHT, 64))
    ordered = light.repartition("conv").sortWithinPartitions("conv", "part")
    found = materialize(on_batches(ordered, _join, JOINED, 64))
    each = found.select("conv", F.explode(F.arrays_zip("parts", "begins", "edits")).alias("e"))
    each = each.select("conv", F.col("e.parts").alias("part"), F.col("e.begins").alias("begin"), F.col("e.edits").alias("edit"))
    lines = on_batches(known.join(each, ["conv", "part"]), _lines, "conv string, part long, n long, lines binary", 16)
    lines = materialize(lines).repartition("conv").sortWithinPartitions("conv", "part")
    sums = materialize(on_batches(lines, _checksums, "conv string, sha string", 16))
    return found.join(sums, "conv").withColumn("repaired_sha256", F.col("sha")).select(*_columns(RESULT))


def repair(rows: DataFrame, every: DataFrame) -> DataFrame:
    """`rows`: conv_id, turn, role, text; `every`: the conv_ids to report. One row per conversation: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256."""
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    order = ("conv", "turn", "role", "text")
    sorted_rows = (
        rows.select(key, F.col("turn").cast("long").alias("turn"), or_space("role"), or_space("text"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
    )
    cut = materialize(on_batches(sorted_rows, _cut, PIECES, 500))
    pieces = cut.where("part is not null")
    found = cut.where("part is null").select(*_columns(RESULT)).unionByName(_joined(pieces))
    empty = {**{c: F.lit(0) for c in COUNTS}, "audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    all_ids = every.select("conv_id", key).distinct()
    return all_ids.join(found, "conv", "left").select(
        "conv_id", *[F.coalesce(F.col(c), value).cast(found.schema[c].dataType).alias(c) for c, value in empty.items()])


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, by a checksum of conversation and turn: dropped, emptied, without closing marks, doubled, or with
    the role user."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind: Column = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(or_space("text"), ".!?", "")).otherwise(or_space("text"))
    copies = F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))
    return conversations.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(or_space("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")
    ).drop("copy")
