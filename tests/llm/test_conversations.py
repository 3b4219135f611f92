"""Conversation repair against a plain version and SQL."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from catalog.compare import connect
from stockcast.llm import conversation_repair as cr
from stockcast.llm.oracles import ORACLES

SCHEMA = StructType([
    StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()), StructField("text", StringType()),
    *[StructField(c, StringType()) for c in ("conv", "part", "cost", "audit", "copy", "at", "digest")],
])


def plain_cheapest(turns, begin, ends):
    """Row by row the least (cost, edits) of each state."""
    def inserted(best):
        for _ in range(3):
            for s, (c, a) in list(best.items()):
                to = cr.NEXT[s, cr.WANTED[s]]
                best[to] = min(best.get(to, (10**9, "")), (c + 3, a + "I"))
        return best

    best = inserted({begin: (0, "")})
    for gone, extra, initial in turns:
        after = {}
        for s, (c, a) in best.items():
            moves = [(s, c + 4, a + "D")]
            if not gone:
                moves.append((cr.NEXT[s, cr.WANTED[s]], c + 3 + extra, a + "R"))
                if (s, initial) in cr.NEXT:
                    moves.append((cr.NEXT[s, initial], c + extra, a + "K"))
            for to, cost, edits in moves:
                after[to] = min(after.get(to, (10**9, "")), (cost, edits))
        best = inserted(after)
    return min((best[e] for e in ends if e in best), default=None)


def random_turns(draw, n):
    return [(draw.random() < 0.15, 3 * (draw.random() < 0.2), draw.choice("uuaasx")) for _ in range(n)]


def test_cheapest_equals_plain_version():
    draw = random.Random(7)
    for _ in range(600):
        turns = random_turns(draw, draw.randint(0, 14))
        assert cr.cheapest(turns) == plain_cheapest(turns, cr.NOTHING, cr.ACCEPTING)
        for a, b in itertools.product(range(4), repeat=2):
            assert cr.cheapest(turns, a, b) == plain_cheapest(turns, a, (b,)), (turns, a, b)


def test_cheapest_of_all_edit_strings():
    """Every edit string up to a length, tried one by one."""
    draw = random.Random(8)
    for _ in range(40):
        turns = random_turns(draw, draw.randint(0, 4))
        found = []
        for n in range(2 * len(turns) + 3):
            for edits in itertools.product("DIKR", repeat=n):
                k, state, cost = 0, cr.NOTHING, 0
                for e in edits:
                    gone, extra, initial = turns[k] if k < len(turns) else (True, 0, "")
                    if e != "I" and k == len(turns) or e in "KR" and gone or e == "K" and (state, initial) not in cr.NEXT:
                        break
                    cost += {"D": 4, "I": 3, "K": extra, "R": 3 + extra}[e]
                    state = state if e == "D" else cr.NEXT[state, initial if e == "K" else cr.WANTED[state]]
                    k += e != "I"
                else:
                    if k == len(turns) and state in cr.ACCEPTING:
                        found.append((cost, "".join(edits)))
            if n >= 6:
                break
        best = min(found)
        assert len(best[1]) < 6 and cr.cheapest(turns) == best


def test_bounds_never_exceed_the_cost():
    draw = random.Random(9)
    for _ in range(400):
        turns = random_turns(draw, draw.randint(0, 12))
        for k, low in enumerate(cr.lower_bounds(turns)):
            assert low <= min(plain_cheapest(turns[k:], s, (e,))[0] for s in range(4) for e in (cr.AFTER_U, cr.AFTER_A))
            assert low <= plain_cheapest(turns[k:], cr.NOTHING, cr.ACCEPTING)[0]


@pytest.mark.parametrize("roles", ["u", "a", "s", "x", "su", "uua", "ssa", "xau", "random"])
def test_long_pieces_of_odd_roles(roles):
    draw = random.Random(3)
    turns = random_turns(draw, cr.PIECE) if roles == "random" else [(False, 0, c) for c in (roles * cr.PIECE)[: cr.PIECE]]
    assert cr.cheapest(turns) == plain_cheapest(turns, cr.NOTHING, cr.ACCEPTING)
    for a, b in cr.WAYS:
        assert cr.cheapest(turns, a, b) == plain_cheapest(turns, a, (b,))


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_repair(rows, ids):
    out = set()
    for conv in ids:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, turns = set(), [], []
        for _, role, text in own:
            shown = text.strip(" \t\n\v\f\r")
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            turns.append((fault in ("blank", "duplicate"), 3 * (fault == "truncated"), role[:1]))
        numbers = [t for t, _, _ in own if t is not None]
        cost, audit = plain_cheapest(turns, cr.NOTHING, cr.ACCEPTING)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        lines = "\n".join(cr.edited(audit, cr.NOTHING, [r[1:] for r in own]))
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        out.add((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                 hashlib.sha256(lines.encode()).hexdigest()))
    return out


def random_rows(seed):
    draw = random.Random(seed)
    texts = ["Hello.", "Hello.", "no end", "", " \n", "What?", "x" * 3000 + "!", ".", None, "é ß"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "s", "urgent", "User"]
    rows = []
    for conv in [*range(40), None]:
        for turn in range(draw.randint(1, 9)):
            rows.append((conv, None if draw.random() < 0.05 else turn + draw.choice((0, 0, 0, 2)), draw.choice(roles), draw.choice(texts) if draw.random() < 0.7 else f"t{draw.random()}."))
    return rows + rows[5:9]


def table(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 7) for r in rows], SCHEMA)


def repaired(spark, rows):
    frame = table(spark, rows)
    got = cr.repair(cr.damaged(frame), frame)
    assert got.columns == ["conv_id", *cr.COUNTS, "audit", "repaired_sha256"]
    return [tuple(r) for r in got.collect()]


@pytest.mark.parametrize("piece", [cr.PIECE, 2])
def test_edge_rows(spark, monkeypatch, piece):
    monkeypatch.setattr(cr, "PIECE", piece)
    rows = random_rows(piece)
    got = repaired(spark, rows)
    ids = {r[0] for r in rows}
    assert len(got) == len(ids) and set(got) == plain_repair(plain_damage(rows), ids)


def test_empty_table(spark):
    assert repaired(spark, []) == []


def test_long_conversation_in_many_pieces(spark, monkeypatch):
    """One conversation holds nearly all rows; it spans tasks and pieces, with repeats far apart."""
    monkeypatch.setattr(cr, "PIECE", 16)
    draw = random.Random(4)
    rows = [(5, k, draw.choice(("user", "assistant", "user", "assistant", "system")), draw.choice(("same.", f"t{k}.", f"open {k}"))) for k in range(900)]
    rows += [(c, 0, "user", "hi.") for c in range(4)]
    got = repaired(spark, rows)
    assert set(got) == plain_repair(plain_damage(rows), {r[0] for r in rows})


def test_conversation_whose_rows_all_go(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert repaired(spark, [(conv, 0, "user", "hi.")]) == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_sql_agrees_on_edge_rows(spark):
    rows = random_rows(11)
    db = connect("/root/testdata/sf0.001")
    db.execute("drop view conversations")
    db.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    db.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    want = {tuple(r) for r in db.execute(ORACLES["op13_conversation_repair"]).fetchall()}
    assert want == plain_repair(plain_damage(rows), {r[0] for r in rows})


def test_rows_are_not_lost_over_tasks(spark):
    """The sorted rows of many tasks: every conversation once."""
    rows = [(c, t, ("user", "assistant")[t % 2], f"{c} {t}.") for c in range(300) for t in range(4)]
    frame = table(spark, rows)
    got = cr.repair(frame, frame)
    assert got.count() == 300 and got.agg(F.sum("cost")).first()[0] == 0
