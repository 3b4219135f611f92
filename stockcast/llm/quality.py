"""Quality rules with risk-controlled thresholds.

A rule rejects a document whose measure exceeds a cutoff. For each stratum (a language) and each cutoff of a fixed grid,
the labelled documents give the number of good ones that the cutoff would reject, and the exact binomial (Clopper-Pearson)
upper bound on the share of good documents it rejects. A cutoff is admissible if that bound, at confidence 1 - delta / tests,
stays below the rule's part of the allowed false rejection; tests counts all rules, strata and cutoffs (Bonferroni), so with
probability 1 - delta every chosen cutoff keeps its promise and all rules together reject at most `alpha` of a stratum's
good documents. Of the admissible cutoffs the one that rejects the most bad documents, less `price` per good one, is chosen,
the laxest of equals. A rule with no gain, or a stratum with too few labels for the promise, rejects nothing.

The counts of labelled documents go by stratum, one small group each, so any number of strata is chosen for in tasks.

Defined cases: a null text has no words and fails the base rule. A null language is the stratum ""; one without labels rejects by
the base rule only. Labels of unknown documents and null labels are ignored; contradicting labels of one document count each, as do
rows that repeat. Very long texts count whole. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.text import Interned, materialize, on_batches

SYMBOLS, SPACE = b"#*$%&|<>", b" \t\n\r\x0b\x0c"
UPPER, DIGITS, SHOUT = bytes(range(65, 91)), b"0123456789", b"!"
WINDOW, MIN_WORDS, REPEAT_PERCENT = 8, 20, 30
#: rule names, all shares from 0 up where more is worse
RULES = ["symbol_share", "upper_share", "digit_share", "shout_share", "repeat_share", "dup_line_share", "same_word_share",
         "long_word_share"]
#: cutoffs tried for every rule, from lax to strict
GRID = [float(x) for x in np.round(np.geomspace(0.9, 0.005, 32), 4)]
ALPHA, DELTA, PRICE = 0.08, 0.05, 3.0
_MIX = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for each run of `size` words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = (out ^ hashes[k : k + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def repeated_words(hashes: np.ndarray, size: int = WINDOW) -> int:
    """Words that lie in a window of `size` words found twice or more."""
    windows = window_hashes(hashes, size)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    ordered = windows[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows) + 1, bool)
    twice[1:-1] |= same
    twice[:-2] |= same
    edges = np.zeros(len(hashes) + 1, np.int64)
    starts = order[twice[:-1]]
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def count_of(raw: bytes, kinds: bytes) -> int:
    return len(raw) - len(raw.translate(None, kinds))


def measure(text: str | None, table: Interned) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then the rules' shares in order."""
    if not text:
        return (0, 0, 0, 0, 0, *[0.0] * len(RULES))
    raw = text.encode("utf-8", "surrogatepass")
    tokens = raw.split()
    n = len(tokens)
    hashes = np.fromiter(map(table.__getitem__, tokens), np.uint64, n)
    chars = len(text) - count_of(raw, SPACE)
    symbols = count_of(raw, SYMBOLS)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(hashes)
    per, word = max(chars, 1), max(n, 1)
    long_words = sum(1 for x in tokens if len(x) > 30)
    return (
        n, chars, symbols, dup_lines, repeats,
        symbols / per, count_of(raw, UPPER) / per, count_of(raw, DIGITS) / per, count_of(raw, SHOUT) / per,
        repeats / word, dup_lines / max(len(lines), 1), 1 - len(np.unique(hashes)) / word, long_words / word,
    )


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
ROW = "doc_id long, stratum string, " + ", ".join(f"{x} long" for x in MEASURES) + ", " + ", ".join(f"{x} double" for x in RULES)


def measures(docs: DataFrame) -> DataFrame:
    """One row per document: the base counts and the rules' shares."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        table = Interned()
        for batch in batches:
            if batch.num_rows:
                found = zip(*(measure(x.as_py(), table) for x in batch.column(2)), strict=True)
                yield {"doc_id": batch.column(0), "stratum": batch.column(1)} | {
                    name: list(values) for name, values in zip(MEASURES + RULES, found, strict=True)
                }

    wanted = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"), F.col("text").cast("string")
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return on_batches(wanted, work, ROW).withColumn("base_failed", failed)


def beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta integral, 1 + d1 / (1 + d2 / (1 + ...)), by Lentz's method. For x below
    (a + 1) / (a + b + 2) its terms are about the square root of a + b at most."""
    value = above = 1.0
    below, m = 0.0, 0
    while True:
        m += 1
        k = m // 2
        if m % 2:
            d = -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))
        else:
            d = k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k))
        below = 1 / ((1 + d * below) or 1e-300)
        above = (1 + d / above) or 1e-300
        value *= above * below
        if not d or abs(above * below - 1) < 1e-14:
            return value


def binomial_tail(bad: int, n: int, rate: float) -> float:
    """The probability of `bad` or fewer of `n`, bad < n, as an incomplete beta integral: no sum over `bad` terms."""
    if rate <= 0:
        return 1.0
    if rate >= 1:
        return 0.0

    def integral(a: float, b: float, x: float) -> float:
        return exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log1p(-x)) / (a * beta_fraction(a, b, x))

    a, b = n - bad, bad + 1
    return integral(a, b, 1 - rate) if 1 - rate < (a + 1) / (a + b + 2) else 1 - integral(b, a, rate)


def upper_bound(bad: int, n: int, miss: float) -> float:
    """Clopper-Pearson: the largest rate at which `bad` or fewer of `n` still has probability `miss`."""
    if bad >= n:
        return 1.0
    low, high = bad / n, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if binomial_tail(bad, n, middle) > miss else (low, middle)
    return high


def _rejections(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Per stratum, rule and quality: how many labelled documents each step of the grid rejects, as one row per step."""
    label = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality")).where(
        "quality in (0, 1)"
    )
    judged = rows.where(~F.col("base_failed")).join(label, F.col("doc_id") == F.col("id"))
    # the strictness that already rejects: the first step of the grid below the measure
    step = lambda rule: F.size(F.filter(F.array(*map(F.lit, GRID)), lambda cut: cut >= F.col(rule)))
    each = F.explode(F.array(*[F.struct(F.lit(rule).alias("rule"), step(rule).alias("step")) for rule in RULES]))
    return (
        judged.select("stratum", "quality", each.alias("x"))
        .groupBy("stratum", "quality", "x.rule", "x.step")
        .agg(F.count("*").alias("n"))
    )


def choose(counts: list[tuple], total: int | None = None, alpha: float = ALPHA, delta: float = DELTA, price: float = PRICE) -> list[tuple]:
    """(stratum, rule, cutoff) of the chosen cutoffs. counts: (stratum, quality, rule, step, n). total: all strata, if more than here."""
    strata = sorted({c[0] for c in counts})
    steps = len(GRID)
    table = {(s, q, r): np.zeros(steps + 1, np.int64) for s in strata for q in (0, 1) for r in RULES}
    for stratum, quality, rule, step, n in counts:
        table[stratum, quality, rule][step] += n
    tests = max(1, (total or len(strata)) * len(RULES) * steps)
    chosen = []
    for stratum in strata:
        for rule in RULES:
            good, bad = (table[stratum, q, rule] for q in (1, 0))
            lost, caught = np.cumsum(good)[:steps], np.cumsum(bad)[:steps]  # rejected if the cutoff lies below the measure
            gain = caught - price * lost
            if gain.max() <= 0:
                continue
            # a stricter cutoff loses as many good documents or more, so the admissible ones come first
            rate = lambda k: upper_bound(int(lost[k]), int(good.sum()), delta / tests)  # noqa: B023, E731
            admissible = bisect_right(range(steps), alpha / len(RULES), key=rate)
            if admissible and gain[:admissible].max() > 0:
                chosen.append((stratum, rule, GRID[int(gain[:admissible].argmax())]))
    return chosen


def cutoffs(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Per stratum one column per rule: the cutoff, or null. As many rows as there are strata with a cutoff."""
    counts = materialize(_rejections(rows, labels).select("stratum", "quality", "rule", "step", "n"))
    total = counts.agg(F.count_distinct("stratum")).first()[0]
    kinds = [("at", pa.string()), *((f"cut_{r}", pa.float64()) for r in RULES)]

    def pick(table: pa.Table) -> pa.Table:  # one stratum: 2 x rules x (grid + 1) rows at most
        found = {rule: cut for _, rule, cut in choose([tuple(r.values()) for r in table.to_pylist()], total)}
        made = [{"at": table.column("stratum")[0].as_py()} | {f"cut_{r}": found.get(r) for r in RULES}] if found else []
        return pa.Table.from_pylist(made, pa.schema(kinds))

    chosen = counts.groupBy("stratum").applyInArrow(pick, "at string, " + ", ".join(f"cut_{r} double" for r in RULES))
    return materialize(chosen)


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with its counts, base_failed, kept and the rules that rejected it."""
    rows = materialize(measures(docs))
    chosen = cutoffs(rows, labels)
    broken = F.filter(
        F.array(*[F.when(F.col(r) > F.col(f"cut_{r}"), F.lit(r)) for r in RULES]), lambda x: x.isNotNull()
    )
    return (
        rows.join(chosen, rows["stratum"] == chosen["at"], "left")
        .withColumn("rejected_by", F.coalesce(broken, F.array().cast("array<string>")))
        .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
        .select("doc_id", *MEASURES, "base_failed", "kept", F.array_join("rejected_by", ",").alias("rejected_by"))
    )
