"""Personal data by candidate gradient boosting.

1. Fixed rules find the base spans (mail address, IPv4 address, card number, telephone number); these always stay.
2. High-recall generators propose overlapping candidates: addresses without a dot or spelled with (at) and [dot], any four
   numbers of a longer dotted chain, any run of whole digit groups inside a longer digit run, telephone numbers without a plus.
3. Boosted trees score each candidate from its format and context. They learn from candidates whose kind the rules settle: base
   spans are positive; candidates that break a hard rule (checksum, a part over 255, no domain, digits of another kind's
   base span) are negative; all others are unlabelled and only scored. In the order of a hash of id and place every
   second one fits the trees, the others calibrate: a logistic curve turns the trees' sum into a probability, and each kind's threshold is the smallest
   probability above which the share of positives is at least `PRECISION`.
4. Candidates above their threshold that touch no base span are taken greedily by probability, no two of them overlapping.

All labelled candidates of all texts count. The bins' edges are exact quantiles, equal binned candidates become one row with
their number, and each level of a tree needs only the sums per node, feature and bin. Gradients are rounded to whole multiples of
2**-`FRACTION`, so that the sums, and with them the model, do not depend on how the rows are dealt. Up to `ONE_TASK` distinct
binned candidates are added up in one place; beyond, each level is one pass of tasks over the written rows, which gives the same
sums. Calibration counts the other half by score, which is the trees' sum rounded to a grid of 2 * `GRID` * `TOP` + 1 values.

Defined cases: null and empty texts have no spans. Null and repeated ids are rows like others. Long texts are scanned in linear time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockcast.llm.text import appended, materialize, on_batches

KINDS = ("email", "ip", "card", "phone")
TREES, DEPTH, RATE, BINS, PRECISION = 40, 3, 0.2, 32, 0.98
#: bits of a gradient behind the point; steps of a score and its largest size; distinct rows that one task adds up
FRACTION, GRID, TOP, ONE_TASK = 30, 256, 16, 50_000
#: leading bits of a hash that name a row's slice
SLICE_BITS = 12
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[(] ?dot ?[\])] ?)[A-Za-z0-9-]{1,63}){1,4}", re.I)
_AT = re.compile(r"[\[(] ?at ?[\])]", re.I).search
_LOCAL_PHONE = re.compile(r"(?:\+?[0-9]{1,3}[ .-])?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-][0-9]{3,4}[ .-]?[0-9]{3,4}")
_ANY = re.compile(r"[0-9@]").search

Span = tuple[int, int, int]  # kind number, start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if k % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _mails(text: str) -> Iterator[tuple[int, int, bool]]:
    """Start, end and whether the rule holds, of what stands around each @. The part before an @ is the whole run of its
    characters since the last match, as @ itself is none of them."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            found = _DOMAIN.match(text, at + 1)
            if found:
                yield start, found.end(), True
                last = found.end()
            else:
                loose = _LABEL.match(text, at + 1)
                if loose:
                    yield start, loose.end(), False
                last = at + 1
        else:
            last = at + 1
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    if "@" in text:
        out += [(0, a, b) for a, b, ok in _mails(text) if ok]
    if _ANY(text):
        for m in _CHAIN.finditer(text):
            if "." in m[0]:
                out += [(1, a, b) for a, b in _quads(m) if _is_ip(text[a:b])]
        for m in _DIGITS.finditer(text):
            if m.end() - m.start() >= 12:
                digits = only_digits(m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(only_digits(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[1], x[0]))


def _parts(chain: re.Match) -> list[tuple[int, int]]:
    return [m.span() for m in re.compile("[0-9]+").finditer(chain.string, *chain.span())]


def _quads(chain: re.Match) -> list[tuple[int, int]]:
    """The rule's leftmost matches in a chain of dotted numbers: four by four."""
    parts = _parts(chain)
    return [(parts[k][0], parts[k + 3][1]) for k in range(0, len(parts) - 3, 4)]


def _is_ip(text: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in text.split("."))


def candidates(text: str) -> list[Span]:
    """Overlapping spans that might be personal data, base spans among them."""
    out: set[Span] = set()
    if "@" in text:
        out.update((0, a, b) for a, b, _ in _mails(text))
    if _AT(text):
        out.update((0, *m.span()) for m in _SPELLED.finditer(text))
    if _ANY(text):
        for m in _CHAIN.finditer(text):
            if m[0].count(".") >= 3:
                parts = _parts(m)
                out.update((1, parts[k][0], parts[k + 3][1]) for k in range(len(parts) - 3))
        for m in _DIGITS.finditer(text):
            if m.end() - m.start() >= 12:
                groups = _parts(m)
                for k, (start, _) in enumerate(groups):
                    digits = 0
                    for a, b in groups[k : k + 19]:
                        digits += b - a
                        if digits > 19:
                            break
                        if digits >= 12:
                            out.add((2, start, b))
        if "+" in text:
            out.update((3, *m.span()) for m in _PHONE.finditer(text) if m.end() - m.start() <= 40)
        out.update((3, *m.span()) for m in _LOCAL_PHONE.finditer(text))
    return sorted(out, key=lambda x: (x[1], x[0], x[2]))


NAMES = [
    "kind", "length", "digits", "spaces", "dashes", "dots", "parens", "plus", "letters", "checksum", "groups", "longest group",
    "shortest group", "first digit", "largest part", "before", "after", "word before", "word after", "digits near", "line start",
    "dot label", "rank in run", "run length",
]


def _class(char: str) -> int:
    if not char:
        return 0
    if char.isspace():
        return 1
    if char.isdigit():
        return 2
    if char.isalpha():
        return 3
    return 4 if char in ".,;:!?" else 5


def features(text: str, span: Span) -> list[float]:
    kind, a, b = span
    own = text[a:b]
    digits = only_digits(own)
    groups = re.findall("[0-9]+", own) or [""]
    before, after = text[max(0, a - 24) : a], text[b : b + 24]
    left, right = before.split(), after.split()
    run_a, run_b = a, b
    while run_a > 0 and a - run_a < 64 and (text[run_a - 1].isdigit() or text[run_a - 1] in " -."):
        run_a -= 1
    while run_b < len(text) and run_b - b < 64 and (text[run_b].isdigit() or text[run_b] in " -."):
        run_b += 1
    return [
        kind, b - a, len(digits), own.count(" "), own.count("-"), own.count("."), own.count("(") + own.count(")"), own.count("+"),
        sum(c.isalpha() for c in own), float(bool(digits) and luhn(digits)), len(groups), max(map(len, groups)), min(map(len, groups)),
        int(digits[0]) if digits else -1, max((int(g[:4] or 0) for g in groups), default=0), _class(text[a - 1 : a] if a else ""),
        _class(text[b : b + 1]), len(left[-1]) if left else 0, len(right[0]) if right else 0,
        sum(c.isdigit() for c in before + after), float(a == 0 or text[a - 1] == "\n"),
        len(own.rsplit(".", 1)[-1]) if "." in own else 0, sum(c.isdigit() for c in text[run_a:a]), run_b - run_a,
    ]


def label(text: str, span: Span, base: list[Span]) -> int:
    """1 and 0 where the rules settle it, else -1."""
    kind, a, b = span
    if span in base:
        return 1
    own = text[a:b]
    digits = only_digits(own)
    if kind == 0:
        return -1 if "." in own.rsplit("@", 1)[-1] or "dot" in own.lower() else 0
    if kind == 1:
        return -1 if _is_ip(own) else 0
    if kind == 2:
        return -1 if luhn(digits) else 0
    if any(k != kind and x < b and a < y for k, x, y in base) or not 7 <= len(digits) <= 15:
        return 0
    return -1


# boosted trees on binned features


Tree = tuple[np.ndarray, np.ndarray, np.ndarray]  # per inner node the feature and bin (left if below or equal), per leaf its value


def sums(bins: np.ndarray, y: np.ndarray, n: np.ndarray, model: dict, grown: Tree, level: int) -> np.ndarray:
    """Gradient and curvature of `n` times each row, summed by node of the growing tree's `level`, feature and bin."""
    p = 1 / (1 + np.exp(-raw_margin(model, bins)))
    parts = np.rint(np.stack([y - p, p * (1 - p)]) * 2.0**FRACTION).astype(np.int64) * n.astype(np.int64)
    feature, cut, _ = grown
    node = np.zeros(len(bins), np.int64)
    for _ in range(level):
        node = 2 * node + 1 + (bins[np.arange(len(bins)), feature[node]] > cut[node])
    node -= 2**level - 1
    out = np.zeros((2, 2**level, bins.shape[1], BINS), np.int64)
    for f in range(bins.shape[1]):
        for k in range(2):
            np.add.at(out[k, :, f], (node, bins[:, f]), parts[k])
    return out


def grow(total: Callable[[Tree, int], np.ndarray], width: int, depth: int) -> Tree:
    """One regression tree of full depth from the sums of each level."""
    grown = np.zeros(2**depth - 1, np.int32), np.full(2**depth - 1, BINS, np.int32), np.zeros(2**depth)
    feature, cut, value = grown
    for level in range(depth):
        nodes = 2**level
        g, h = (total(grown, level) / 2.0**FRACTION).cumsum(axis=3)
        all_g, all_h = g[:, :, -1:], h[:, :, -1:]
        gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
        for node in range(nodes):
            best = 1e-6
            for f in range(width):
                where = gain[node, f].argmax()
                if gain[node, f, where] > best:
                    best, feature[nodes - 1 + node], cut[nodes - 1 + node] = gain[node, f, where], f, where
            if level == depth - 1:
                f, where = feature[nodes - 1 + node], min(cut[nodes - 1 + node], BINS - 1)
                left, whole = (g[node, f, where], h[node, f, where]), (all_g[node, f, 0], all_h[node, f, 0])
                value[2 * node] = left[0] / (left[1] + 1)
                value[2 * node + 1] = (whole[0] - left[0]) / (whole[1] - left[1] + 1)
    return grown


QUANTILES = np.linspace(0, 1, BINS + 1)[1:-1]


def tree_values(tree: Tree, bins: np.ndarray) -> np.ndarray:
    feature, cut, value = tree
    node = np.zeros(len(bins), np.int64)
    while node.size and node[0] < len(feature):
        node = 2 * node + 1 + (bins[np.arange(len(bins)), feature[node]] > cut[node])
    return value[node - len(feature)]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)]).astype(np.int32)


def fitted(total: Callable[[dict, Tree, int], np.ndarray], model: dict, trees: int = TREES, depth: int = DEPTH) -> dict:
    """The model (edges, start, rate) with its trees, each from the sums that `total` gives for the model so far."""
    for _ in range(trees):
        tree = grow(lambda grown, level: total(model, grown, level), len(model["edges"]), depth)
        model = {**model, "trees": [*model["trees"], tree]}
    return model


def empty_model(edges: list[np.ndarray], positive: int, n: int, rate: float = RATE) -> dict:
    return {"edges": edges, "start": float(np.log((positive + 1) / (n - positive + 1))), "rate": rate, "trees": []}


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> dict:
    edges = [np.unique(np.quantile(x[:, k], QUANTILES)) for k in range(x.shape[1])]
    bins, once = binned(x, edges), np.ones(len(y), np.int64)
    return fitted(lambda *state: sums(bins, y, once, *state), empty_model(edges, int(y.sum()), len(y), rate), trees, depth)


def raw_margin(model: dict, bins: np.ndarray) -> np.ndarray:
    return model["start"] + model["rate"] * sum((tree_values(t, bins) for t in model["trees"]), np.zeros(len(bins)))


def margin(model: dict, x: np.ndarray) -> np.ndarray:
    return raw_margin(model, binned(x, model["edges"]))


def scores(margins: np.ndarray) -> np.ndarray:
    """Margins as whole steps of the grid that calibration counts by."""
    return np.rint(np.clip(margins, -TOP, TOP) * GRID).astype(np.int32)


def probability(score: np.ndarray, curve: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(score / GRID * curve[0] + curve[1], -30, 30)))


def calibrate(kinds: np.ndarray, score: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list[float]]:
    """Slope and offset of the logistic curve, and each kind's threshold; above 1 where no threshold is precise enough. Each row
    stands for `n` candidates."""
    w = np.array([1.0, 0.0])
    x = np.column_stack([score / GRID, np.ones(len(score))])
    for _ in range(50):
        p = probability(score, w)
        w += np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2), x.T @ (n * (y - p)) - 1e-2 * (w - [1.0, 0.0]))
    p = probability(score, w)
    limits = []
    for kind in range(len(KINDS)):
        own = np.flatnonzero(kinds == kind)
        values, group = np.unique(-p[own], return_inverse=True)  # the highest first; equal ones pass or fail together
        positive, all_n = np.bincount(group, weights=(n * y)[own]), np.bincount(group, weights=n[own])
        last = np.flatnonzero(positive.cumsum() / all_n.cumsum() >= PRECISION) if len(own) else []
        limits.append(max(0.5, float(-values[last[-1]])) if len(last) and positive.any() else 2.0)
    return w, limits


SCAN = "doc_id long, base array<string>, spans binary, features binary, labels binary, serial long"


def scan(docs: DataFrame) -> DataFrame:
    """Per document the base spans and the candidates with features and labels."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {"doc_id": batch.column(0), "base": [], "spans": [], "features": [], "labels": [], "serial": []}
            for k, text in enumerate(batch.column(1).to_pylist()):
                text = text or ""
                base, found = base_spans(text), candidates(text)
                known = set(base)
                out["base"].append(named(base))
                out["spans"].append(np.array(found, np.int64).tobytes())
                out["features"].append(np.array([features(text, s) for s in found], np.float32).tobytes())
                out["labels"].append(np.array([1 if s in known else label(text, s, base) for s in found], np.int8).tobytes())
                out["serial"].append(k)
            yield out

    return on_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), work, SCAN)


def named(spans: list[Span]) -> list[str]:
    return [f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans, key=lambda x: (x[1], x[0], x[2]))]


def labelled(scanned: DataFrame) -> DataFrame:
    """Every candidate whose kind the rules settle: whether it fits the trees or calibrates, its label and its features."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:  # one batch out for each one in: each has 27 columns of its own in the JVM
            ids, places, kinds, parts = [], [], [], []
            for doc_id, data, labels in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                y = np.frombuffer(labels, np.int8)
                at = np.flatnonzero(y >= 0)
                if len(at):
                    ids += [doc_id] * len(at)
                    places.append(at)
                    kinds.append(y[at])
                    parts.append(np.frombuffer(data, np.float32).reshape(len(y), -1)[at])
            if ids:
                x = np.concatenate(parts).astype(float)
                yield {"doc_id": ids, "at": np.concatenate(places), "y": np.concatenate(kinds), **{f"x{k}": x[:, k] for k in range(x.shape[1])}}

    schema = "doc_id long, at int, y int, " + ", ".join(f"x{k} double" for k in range(len(NAMES)))
    rows = on_batches(scanned.where("length(labels) > 0").select("doc_id", "features", "labels"), work, schema)
    return alternated(rows.withColumn("hash", F.xxhash64("doc_id", "at")), "hash").drop("hash", "doc_id", "at")


def alternated(rows: DataFrame, key: str) -> DataFrame:
    """Add `fits`, true for every second row in the order of the hash `key`, then of all columns. The hash's leading bits cut the rows
    into slices, each numbered by itself and shifted by the rows of the slices before it."""
    sliced = materialize(rows.withColumn("slice", F.shiftright(key, 64 - SLICE_BITS)))
    counts = sliced.groupBy("slice").agg(F.count(F.lit(1)).alias("size"))  # at most 2**SLICE_BITS rows
    before = counts.select("slice", (F.sum("size").over(Window.orderBy("slice")) - F.col("size")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("slice").orderBy(key, *rows.columns))
    placed = sliced.withColumn("inside", inside).join(before, "slice")
    return placed.select(*rows.columns, ((F.col("before") + F.col("inside")) % 2 == 1).alias("fits"))


def binned_rows(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """Equal binned candidates of one half, kind and label as one row with their number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            x = np.column_stack([batch.column(f"x{k}").to_numpy() for k in range(len(edges))])
            bins = binned(x, edges).astype(np.uint8)
            yield {"fits": batch.column("fits"), "kind": x[:, 0].astype(int), "y": batch.column("y"), "bins": [b.tobytes() for b in bins]}

    made = on_batches(rows, work, "fits boolean, kind int, y int, bins binary", 10_000)
    return made.groupBy("fits", "kind", "y", "bins").agg(F.count(F.lit(1)).alias("n"))


def _arrays(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, -1).astype(np.int32)
    return bins, batch.column("y").to_numpy().astype(float), batch.column("n").to_numpy()


def summed_in_tasks(rows: DataFrame) -> Callable[[dict, Tree, int], np.ndarray]:
    """The sums of one level by one pass over the written rows: each task sends its sums, whose size does not grow with its rows."""

    def total(model: dict, grown: Tree, level: int) -> np.ndarray:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            own = sum((sums(*_arrays(batch), model, grown, level) for batch in batches if batch.num_rows), np.int64(0))
            if own.ndim:
                yield {"sums": [own.tobytes()]}

        got = on_batches(rows, work, "sums binary", ONE_TASK).toArrow().column("sums").to_pylist()
        return sum(np.frombuffer(x, np.int64) for x in got).reshape(2, 2**level, len(model["edges"]), BINS)

    return total


def learn(scanned: DataFrame, one_task: int = ONE_TASK) -> dict | None:
    """Trees, calibration and thresholds from all labelled candidates; None if there are few or a class is missing in a half."""
    rows = materialize(labelled(scanned))
    counts = [F.count_if((F.col("fits") == half) & (F.col("y") == y)) for half in (True, False) for y in (0, 1)]
    quantiles = [F.percentile(F.when(F.col("fits"), F.col(f"x{k}")), F.lit(QUANTILES.tolist())) for k in range(len(NAMES))]
    got = rows.agg(F.array(*counts), F.array(*quantiles)).first()
    (negative, positive, *others), edges = got[0], got[1]
    if negative + positive + sum(others) < 20 or not all(got[0]):
        return None
    model = empty_model([np.unique(e) for e in edges], positive, negative + positive)
    groups = materialize(binned_rows(rows, model["edges"]))
    fit = groups.where("fits").select("bins", "y", "n")
    distinct = fit.count()
    if distinct <= one_task:
        held = _arrays(fit.toArrow())
        model = fitted(lambda *state: sums(*held, *state), model)
    else:
        parts = -(-distinct // max(one_task, 1))
        model = fitted(summed_in_tasks(materialize(fit.repartition(parts))), model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                own = scores(raw_margin(model, _arrays(batch)[0]))
                yield {"kind": batch.column("kind"), "score": own, "y": batch.column("y"), "n": batch.column("n")}

    by_score = on_batches(groups.where("not fits").select("kind", "bins", "y", "n"), scored, "kind int, score int, y int, n long")
    table = by_score.groupBy("kind", "score", "y").agg(F.sum("n").alias("n")).orderBy("kind", "score", "y").toArrow()
    model["curve"], model["limits"] = calibrate(*(table.column(c).to_numpy() for c in ("kind", "score", "y", "n")))
    return model


def chosen(model: dict, found: np.ndarray, x: np.ndarray, base: list[Span]) -> list[Span]:
    """Candidates above their kind's threshold that touch neither a base span nor a better candidate."""
    p = probability(scores(margin(model, x)), model["curve"])
    fit = np.flatnonzero(p >= np.array(model["limits"])[found[:, 0]])
    order = fit[np.lexsort((found[fit, 1], -(found[fit, 2] - found[fit, 1]), -p[fit]))]
    taken = sorted((a, b) for _, a, b in base)
    out: list[Span] = []
    from bisect import bisect_left, insort

    latest = 0  # base spans of two kinds may overlap, so the farthest end before a start counts
    ends, starts = [], []
    for a, b in taken:
        latest = max(latest, b)
        starts.append(a)
        ends.append(latest)
    added: list[tuple[int, int]] = []
    for k in order.tolist():
        kind, a, b = found[k].tolist()
        at = bisect_left(starts, b)
        if at and ends[at - 1] > a:
            continue
        at = bisect_left(added, (b, 0))
        if at and added[at - 1][1] > a:
            continue
        insort(added, (a, b))
        out.append((kind, a, b))
    return out


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id, base counts, base_sha256, all spans and the number of added ones, for every document."""
    scanned = materialize(scan(docs))
    model = learn(scanned)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in RESULT_NAMES}
            for row in batch.to_pylist():
                base = [_span(x) for x in row["base"]]
                found = np.frombuffer(row["spans"], np.int64).reshape(-1, 3)
                more = []
                if model and len(found):
                    x = np.frombuffer(row["features"], np.float32).reshape(len(found), -1).astype(float)
                    more = chosen(model, found, x, base)
                out["doc_id"].append(row["doc_id"])
                for k, kind in enumerate(KINDS):
                    out[f"n_{kind}"].append(sum(s[0] == k for s in base))
                out["base_sha256"].append(hashlib.sha256(",".join(named(base)).encode()).hexdigest())
                out["spans"].append(",".join(named(base + more)))
                out["n_added"].append(len(more))
            yield out

    return on_batches(scanned.select("doc_id", "base", "spans", "features"), work, RESULT)


RESULT_NAMES = [x.strip().split(" ")[0] for x in RESULT.split(",")]


def _span(text: str) -> Span:
    kind, a, b = text.split(":")
    return KINDS.index(kind), int(a), int(b)


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span's kind in its place; overlapping spans become one, named after the first."""
    out, last = [], 0
    merged: list[list[int]] = []
    for kind, a, b in sorted(spans, key=lambda x: (x[1], x[0])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[last:a], f"[{KINDS[kind].upper()}]"]
        last = b
    return "".join([*out, text[last:]])


def redact(docs: DataFrame) -> DataFrame:
    """All documents, their spans masked and n_chars, if there is one, set to the new length; all other columns as they are."""
    model = learn(materialize(scan(docs)))
    name = "text without personal data"

    def start():
        def clean(texts: list[str | None]) -> list[str | None]:
            out = []
            for text in texts:
                if text:
                    base, found = base_spans(text), candidates(text)
                    if model and found:
                        x = np.array([features(text, s) for s in found], np.float32).astype(float)
                        base = base + chosen(model, np.array(found, np.int64), x, base)
                    text = mask(text, base) if base else text
                out.append(text)
            return out

        return clean

    made = appended(docs, "text", name, "string", start)
    new = {"text": F.col(name)}
    if "n_chars" in docs.columns:
        changed = ~F.col("text").eqNullSafe(F.col(name))
        new["n_chars"] = F.when(changed, F.length(name)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return made.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])
