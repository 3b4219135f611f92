"""Periodic runs of words by multi-scale minimizers, and texts with the repeats taken out.

A run is a stretch of words whose smallest period is q, at least max(6, 4 q) words long, that no neighbouring word extends. The
words of many texts lie behind each other in one array of numbers, a number of its own between two texts, so no repeat
reaches over an end and a batch of small texts costs as much as one long text.

* Periods up to SHORT: each lag is scanned directly; words equal to the word a lag later form stretches.
* Longer periods, scale by scale: scale t has the grams of K = 2**t words and looks for periods above K / 2 and up to K. A
  gram is selected if it is the least of some window of K / 2 + 1 neighbours. A run at least four periods long holds two full
  turns of windows, so it selects equal grams one period apart; as K words cover a whole period, no equal gram lies between
  them. Each selected gram is therefore only paired with the next equal one: at most two pairs in K / 2 words, so all scales
  together give a number of pairs that grows with the words.
* A pair is a seed: the stretch of equal words around it is extended in both directions, in growing blocks, unless a
  stretch of the same lag already covers it. Grams are 64-bit hashes; a seed whose words differ shows a collision, and the array is
  then searched again under another salt, so no run depends on hashes being different.

Stretches with the same ends and several lags are one run, of the smallest lag.

Texts are read whole. Work and memory go with the words of the largest text of a task; texts are searched in groups of about
BLOCK_WORDS words. Defined cases: null, empty and blank texts have no words and no runs, and their collapsed text is empty. Among
longest runs the smallest start, then the smallest period is reported. Repeated rows, repeated and null ids are rows like others;
other columns are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.text import on_batches, words

SHORT = 4
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: words searched together; a longer text is a group of its own
BLOCK_WORDS = 1 << 18
BATCH_ROWS = 256

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _window_least(x: np.ndarray, size: int) -> np.ndarray:
    """The least value of each window of `size` neighbours, by doubling."""
    have = 1
    while have < size:
        step = min(have, size - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def selected(x: np.ndarray, size: int) -> np.ndarray:
    """Places whose value is the least of some window of `size` places that holds them, ties included."""
    if len(x) < size:
        return np.zeros(0, np.int64)
    least = np.pad(_window_least(x, size), size - 1)  # a window that reaches over an end counts as 0
    return np.flatnonzero(x == ~_window_least(~least, size))


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and behind-last place of each stretch of true values."""
    edges = np.flatnonzero(np.diff(same.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    return edges[::2], edges[1::2]


def _equal_ahead(x: np.ndarray, a: int, b: int) -> int:
    """How many words from `a` on equal those from `b` on; b > a."""
    done, size = 0, 64
    while b + done < len(x):
        different = x[a + done : a + done + size][: len(x) - b - done] != x[b + done : b + done + size]
        if different.any():
            return done + int(different.argmax())
        done += len(different)
        size *= 2
    return done


def _equal_behind(x: np.ndarray, a: int, b: int) -> int:
    """How many words before `a` equal those before `b`; b > a."""
    done, size = 0, 64
    while done < a:
        size = min(size, a - done)
        different = (x[a - done - size : a - done] != x[b - done - size : b - done])[::-1]
        if different.any():
            return done + int(different.argmax())
        done += size
        size *= 2
    return done


class _Collision(Exception):
    """Different grams have one hash."""


def _seeded(x: np.ndarray, longest: int, salt: int) -> Iterator[tuple[int, int, int]]:
    grams, t = _mixed(x.astype(np.uint64) ^ np.uint64(salt << 40)), 0
    while (1 << t) < 2 * SHORT or LEAST_PERIODS * ((1 << t) // 2 + 1) <= longest:
        size = 1 << t
        if size >= 2 * SHORT:
            places = selected(grams, size // 2 + 1)
            values = grams[places]
            order = np.lexsort((places, values))
            a, b = places[order[:-1]], places[order[1:]]
            near = (values[order[:-1]] == values[order[1:]]) & (b - a <= size)
            a, lag = a[near], (b - a)[near]
            by = np.lexsort((a, lag))
            a, lag = a[by], lag[by]
            at, behind = 0, 0
            while at < len(a):
                start, q = int(a[at]), int(lag[at])
                if at >= behind:
                    behind = int(np.searchsorted(lag, q, "right"))
                ahead = _equal_ahead(x, start, start + q)
                if ahead < size:
                    raise _Collision
                begin = start - _equal_behind(x, start, start + q)
                if q > size // 2:
                    yield begin, ahead + start + q - begin, q
                at += int(np.searchsorted(a[at:behind], start + ahead - size, "right"))  # the others inside this stretch
        t += 1
        if len(grams) <= size:
            return
        grams = _mixed(grams[: len(grams) - size] * _ODD + grams[size:])


def runs(x: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the numbers `x`, by start, then period. No run is longer than `longest`."""
    longest = len(x) if longest is None else longest
    found: dict[tuple[int, int], int] = {}

    def take(start: int, length: int, q: int) -> None:
        if length >= max(LEAST_WORDS, LEAST_PERIODS * q):
            found[start, length] = min(q, found.get((start, length), q))

    for q in range(1, min(SHORT, len(x) - 1) + 1):
        begin, end = _stretches(x[:-q] == x[q:])
        long = end - begin + q >= max(LEAST_WORDS, LEAST_PERIODS * q)
        for a, b in zip(begin[long].tolist(), end[long].tolist(), strict=True):
            take(a, b - a + q, q)
    salt = 0
    while True:
        try:
            seeds = list(_seeded(x, longest, salt))
            break
        except _Collision:
            salt += 1
    for seed in seeds:
        take(*seed)
    return sorted(((start, length, q) for (start, length), q in found.items()), key=lambda r: (r[0], r[2]))


def runs_of_texts(texts: Iterable[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text's words, counted from the text's start; all texts are searched together."""
    texts = list(texts)
    numbers: dict[bytes, int] = {}
    ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    x = np.empty(int(ends[-1]) if texts else 0, np.int64)
    for t, end in zip(texts, ends.tolist(), strict=True):
        x[end - 1 - len(t) : end - 1] = [numbers.setdefault(w, len(numbers)) for w in t]
    x[ends - 1] = np.arange(len(texts)) + len(numbers)  # a number of its own between two texts
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, q in runs(x, max(map(len, texts), default=0)):
        k = int(np.searchsorted(ends, start, "right"))
        out[k].append((start - (int(ends[k - 1]) if k else 0), length, q))
    return out


def collapsed(text: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not found:
        return text
    depth = np.zeros(len(text) + 1, np.int64)
    for start, length, q in found:
        depth[start + q] += 1
        depth[start + length] -= 1
    return [text[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


Change = Callable[[int | None, list[bytes]], list[bytes]]


def find_runs(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, its runs by start, then period (starts, lengths, periods), and `collapsed`: the bytes
    of the words that no run holds behind its first period, joined by one space. `change` maps a document's id and words to the words to search."""

    def found(ids: list, held: list[list[bytes]]) -> dict:
        each = runs_of_texts(held)
        return {
            "doc_id": ids,
            "n_words": [len(t) for t in held],
            "starts": [[r[0] for r in own] for own in each],
            "lengths": [[r[1] for r in own] for own in each],
            "periods": [[r[2] for r in own] for own in each],
            "collapsed": [b" ".join(collapsed(t, own)) for t, own in zip(held, each, strict=True)],
        }

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in parts:
            ids, held, size = [], [], 0
            for one, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = words(text.as_py(), lower=False)
                ids.append(one)
                held.append(change(one, own) if change else own)
                size += len(own)
                if size >= BLOCK_WORDS:
                    yield found(ids, held)
                    ids, held, size = [], [], 0
            if ids:
                yield found(ids, held)

    schema = "doc_id long, n_words long, starts array<long>, lengths array<long>, periods array<long>, collapsed binary"
    return on_batches(docs.select(F.col("doc_id").cast("long"), "text"), work, schema, BATCH_ROWS)


def with_planted_run(doc_id: int | None, text: list[bytes]) -> list[bytes]:
    """For one id in ten, by its checksum, the words from some place on become repeats of the first of them. A null id counts as
    the empty text."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(text), h // 10
    if h % 10 or not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    turn = text[a : a + p]
    return text[:a] + (turn * ((n - a) // p + 1))[: n - a]


def run_digests(found: DataFrame) -> DataFrame:
    """Per document its number of runs, its longest run, and checksums of all runs and of the collapsed text."""
    run = F.arrays_zip("starts", "lengths", "periods")
    line = lambda r: F.concat(F.concat_ws(",", r["starts"], r["lengths"], r["periods"]), F.lit("\n"))
    rank = lambda r: F.struct(r["lengths"].alias("length"), (-r["starts"]).alias("before"), (-r["periods"]).alias("shorter"))
    return found.withColumn("best", F.array_max(F.transform(run, rank))).select(
        "doc_id",
        F.size("starts").cast("long").alias("n_runs"),
        (-F.col("best.before")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.shorter")).alias("period"),
        F.expr("1000 * best.length div -best.shorter").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(run, line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
