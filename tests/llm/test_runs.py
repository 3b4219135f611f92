"""Periodic runs against a brute-force version."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stockcast.llm import periodic_runs as pr
from stockcast.llm import queries
from stockcast.llm.text import words
from tests.llm.conftest import SF, as_rows, frame


def plain_runs(x):
    """Every lag, every stretch; the smallest lag of equal stretches."""
    found = {}
    for q in range(1, len(x)):
        k = 0
        while k + q < len(x):
            if x[k] != x[k + q]:
                k += 1
                continue
            start = k
            while k + q < len(x) and x[k] == x[k + q]:
                k += 1
            if k + q - start >= max(6, 4 * q):
                found.setdefault((start, k + q - start), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    w = words(text, lower=False)
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    drop = {k for s, length, q in runs for k in range(s + q, s + length)}
    s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), s, length, q, None if q is None else 1000 * length // q,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(v for k, v in enumerate(w) if k not in drop)))


def repetitive(draw):
    """Words with runs inside runs, neighbouring runs and broken ones."""
    x = []
    for _ in range(draw.randint(1, 6)):
        part = [draw.randint(0, draw.choice((1, 3, 50))) for _ in range(draw.randint(1, 40))]
        if draw.random() < 0.5:
            part = part * draw.randint(1, 7) + part[: draw.randint(0, len(part))]
        x += part
    if draw.random() < 0.3:
        x = x * draw.randint(2, 5)
    if draw.random() < 0.4:
        x[draw.randrange(len(x))] = 99
    return x


def test_random_repeats():
    draw = random.Random(3)
    for _ in range(400):
        x = repetitive(draw)
        assert pr.runs(np.array(x, np.int64)) == plain_runs(x), x


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120))
def test_few_letters(x):
    assert pr.runs(np.array(x, np.int64)) == plain_runs(x)


@pytest.mark.parametrize("period", [1, 4, 5, 7, 8, 9, 16, 17, 31, 64, 100, 257, 1000])
def test_each_scale(period):
    draw = random.Random(period)
    turn = [draw.randint(0, 10**6) for _ in range(period)]
    for length in (4 * period - 1, 4 * period, 4 * period + 1, 5 * period + period // 2):
        x = [-1, *(turn * 6)[:length], -2]
        want = [(1, length, period)] if length >= max(6, 4 * period) else []
        assert pr.runs(np.array(x, np.int64) + 2) == want


def test_texts_do_not_meet():
    texts = [[b"a"] * 5, [b"a"] * 5, [], [b"a", b"b"] * 4, [b"a", b"b"] * 4]
    assert pr.runs_of_texts(texts) == [[], [], [], [(0, 8, 2)], [(0, 8, 2)]]
    assert pr.runs_of_texts([]) == []


def test_colliding_hashes_are_searched_again(monkeypatch):
    """With hashes of a few bits every scale collides; other salts are tried until none does."""
    mixed, calls = pr._mixed, []

    def narrow(x):
        calls.append(1)
        return mixed(x) & np.uint64(0xFF) if len(calls) < 40 else mixed(x)

    monkeypatch.setattr(pr, "_mixed", narrow)
    draw = random.Random(1)
    x = [draw.randint(0, 500) for _ in range(3000)]
    x += x[-400:] * 4
    assert pr.runs(np.array(x, np.int64)) == plain_runs(x)
    assert len(calls) >= 40


def test_long_texts_stay_cheap():
    """A million equal words and a million words of a Fibonacci word: pairs go by stretches, not by words."""
    assert pr.runs(np.zeros(10**6, np.int64)) == [(0, 10**6, 1)]
    word, after = "a", "ab"
    while len(after) < 10**5:
        word, after = after, after + word
    assert pr.runs(np.array([ord(c) for c in after], np.int64)) == []  # no repetition of exponent 4 in it


def test_edge_rows(spark, edge, empty):
    got = pr.run_digests(pr.find_runs(edge, pr.with_planted_run))
    small = [(d, t) for d, t in as_rows(edge) if len(t or "") < 10_000]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == edge.count()
    want = [plain_digest(d, t) for d, t in small]
    assert not [w for w in want if w not in rows]
    assert pr.run_digests(pr.find_runs(empty)).collect() == []


def test_long_row_and_repeats(spark):
    turn = " ".join(f"w{k}" for k in range(7000))
    rows = [(1, " ".join([turn] * 5), None, None, None)] * 2 + [(None, "a " * 9, None, None, None)]
    got = pr.find_runs(frame(spark, rows)).collect()
    assert sorted((r["n_words"], r["starts"], r["lengths"], r["periods"]) for r in got) == [
        (9, [0], [9], [1]), (35_000, [0], [35_000], [7000]), (35_000, [0], [35_000], [7000])]
    assert {bytes(r["collapsed"]) for r in got} == {turn.encode(), b"a"}


def test_query_against_brute_force(spark, documents):
    got = {r["doc_id"]: tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()}
    rows = [(d, t) for d, t in as_rows(documents) if len(t or "") < 6000]
    assert len(rows) > 150 and len(got) == documents.count()
    for doc_id, text in rows:
        assert got[doc_id] == plain_digest(doc_id, text)
