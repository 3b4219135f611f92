"""Toxic passages by maximum-scoring segments.

Token scores are log-odds of a word in toxic against clean labelled texts. Rare words lean on their beginnings: the Dirichlet
prior of a word's counts is what other words with its seven first letters show, whose prior are the six first, down to
three, so every word has a score and the informative ones keep their own. Scores near 0 are set to 0 and each token costs a small drift.

A linear scan (Ruzzo and Tompa) finds all maximal-scoring segments of a text. Under clean text the largest segment of m tokens
follows an extreme-value law, P(S > x) = 1 - exp(-K m exp(-rate x)); rate and K are fitted on clean labelled texts. A segment is a
passage if its own expected number in clean text of that length is small. The best segment's tail probability and the
number of passages give the document's probability by logistic regression; each half of the labelled texts is measured there with
word scores of the other half.

Labels come from at most `max_labelled` labelled documents outside the held-out fold (those with the smallest hash of the id), so the
model has a known bound; every document is scored, over its whole text.

Defined cases: null and empty texts have no segment and get the score of a text without toxic words. Without labels of
both kinds the score is 0. Contradicting labels of a document each count. Null ids are scored like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockcast.llm.text import REMEMBERED_WORDS, appended, fold, materialize, on_batches, words

MAX_LABELLED, MAX_KEYS = 20_000, 200_000
PRIOR, NEUTRAL, DRIFT, CEILING, EXPECTED, THRESHOLD = 4.0, 0.9, 0.04, 6.0, 0.05, 0.3
SHORTEST, LONGEST, LEAST = 3, 7, 3
STRIP = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words without punctuation at their ends; a word of punctuation alone is empty but keeps its place."""
    return [w.strip(STRIP) for w in words(text.lower() if text else text, lower=False)]


def beginnings(word: bytes) -> list[bytes]:
    """From the shortest beginning to the word itself, marked as such. Letters are cut whole."""
    chars = word.decode("utf-8", "surrogatepass")
    return [chars[:n].encode("utf-8", "surrogatepass") for n in range(SHORTEST, min(LONGEST, len(chars)) + 1)] + [b"=" + word]


def labelled(docs: DataFrame, labels: DataFrame, learn: Column, bound: int) -> DataFrame:
    """text, toxic, half of the labelled documents to learn from. The labels are at most `bound` rows and are broadcast."""
    wanted = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & learn)
        .withColumn("order", F.xxhash64("id"))
        .orderBy("order", "id", "toxic").limit(bound)
    )
    return docs.select(F.col("doc_id").cast("long").alias("own"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(wanted), F.col("own") == F.col("id")
    ).dropDuplicates(["text", "toxic"]).select("text", "toxic", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half"))


def key_counts(rows: DataFrame) -> tuple[list[tuple[bytes, int, int]], tuple[int, int]]:
    """(key, clean, toxic): labelled texts with a word of that beginning, for keys in LEAST toxic ones or more; and all texts."""

    def counted(sums: dict[bytes, list[int]]) -> dict:
        return {"key": list(sums), "clean": [x[0] for x in sums.values()], "toxic": [x[1] for x in sums.values()]}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sums: dict[bytes, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                for key in {k for word in set(tokens(text.as_py())) if word for k in beginnings(word)}:
                    sums.setdefault(key, [0, 0])[toxic] += 1
            if len(sums) >= REMEMBERED_WORDS:  # the shuffle adds up what a task counts in several parts
                yield counted(sums)
                sums.clear()
        yield counted(sums)

    parts = on_batches(rows.select("text", "toxic"), work, "key binary, clean long, toxic long")
    table = parts.groupBy("key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    got = table.where(F.col("toxic") >= LEAST).toArrow()
    sizes = dict(rows.groupBy("toxic").agg(F.count("*")).collect())
    return list(zip(*(got.column(k).to_pylist() for k in range(3)), strict=True)), (sizes.get(0, 0), sizes.get(1, 0))


def log_odds(counts: list[tuple[bytes, int, int]], texts: tuple[int, int], prior: float = PRIOR) -> dict[bytes, float]:
    """Log-odds of each key. The mean of its Dirichlet prior is the share among the other words with the same next shorter
    beginning, so that no text counts twice. Keys whose odds add nothing to that beginning's are left out, and beyond MAX_KEYS the
    least telling ones."""
    scale = max(1, texts[1]) / max(1, texts[0])  # clean counts as if there were as many clean texts as toxic ones
    sums = {key: (clean * scale, float(toxic)) for key, clean, toxic in counts}

    def parent(key: bytes) -> bytes | None:
        if key[:1] == b"=":
            return (beginnings(key[1:])[:-1] or [None])[-1]
        short = key.decode("utf-8", "surrogatepass")[:-1]
        return short.encode("utf-8", "surrogatepass") if len(short) >= SHORTEST else None

    def share(key: bytes | None, less: tuple[float, float] = (0.0, 0.0)) -> float:
        """Of the texts with this key, without those in `less`, the toxic part."""
        if key not in sums:
            return 0.5
        clean, toxic = max(0.0, sums[key][0] - less[0]), max(0.0, sums[key][1] - less[1])
        return (toxic + prior * share(parent(key), sums[key])) / (clean + toxic + prior)

    odds = {key: float(np.log(x / (1 - x))) for key in sums for x in [share(key)]}
    gain = {key: abs(x - odds.get(parent(key), 0.0)) for key, x in odds.items()}
    kept = sorted((k for k in odds if gain[k] > 0.1), key=lambda k: (-gain[k], k))[:MAX_KEYS]
    return {k: odds[k] for k in kept}


class TokenScores(dict):
    """Score of each word, found once: its longest known beginning's log-odds, 0 if near 0, less the drift."""

    LIMIT = REMEMBERED_WORDS

    def __init__(self, odds: dict[bytes, float]) -> None:
        super().__init__()
        self.odds = odds

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.LIMIT:
            self.clear()
        value = next((self.odds[k] for k in reversed(beginnings(word)) if k in self.odds), 0.0) if word else 0.0
        self[word] = value = (0.0 if abs(value) < NEUTRAL else max(-CEILING, min(CEILING, value))) - DRIFT
        return value


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, score) of all maximal-scoring segments, in linear time."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[float, float, int, int, int]] = []  # left sum, right sum, start, end, the one before with a smaller left sum
    for at in np.flatnonzero(scores > 0).tolist():
        left, right, start, end = float(sums[at]), float(sums[at + 1]), at, at + 1
        while True:
            before = len(found) - 1
            while before >= 0 and found[before][0] >= left:
                before = found[before][4]
            if before < 0 or found[before][1] >= right:
                found.append((left, right, start, end, before))
                break
            left, start = found[before][0], found[before][2]
            del found[before:]
    return [(start, end, right - left) for left, right, start, end, _ in found]


def log_tail(score: np.ndarray, length: np.ndarray, law: tuple[float, float]) -> np.ndarray:
    """-log P(a clean text of that length has a segment of that score or more)."""
    rate, log_k = law
    expected = np.exp(np.minimum(log_k + np.log(np.maximum(length, 1)) - rate * score, 50))
    return np.minimum(-np.log(np.maximum(-np.expm1(-expected), 1e-300)), 60)


def features(text: str | None, table: TokenScores, law: tuple[float, float] | None) -> tuple[float, int, int]:
    """Best segment, tokens, and segments rarer in clean texts than EXPECTED."""
    own = tokens(text)
    scores = np.fromiter(map(table.__getitem__, own), np.float64, len(own))
    found = segments(scores)
    best = max((x[2] for x in found), default=0.0)
    if law is None:
        return best, len(own), 0
    rate, log_k = law
    limit = (log_k + np.log(max(len(own), 1)) - np.log(EXPECTED)) / rate
    return best, len(own), sum(x[2] >= limit for x in found)


def fit_law(best: np.ndarray, length: np.ndarray) -> tuple[float, float]:
    """Rate and log K from the tail: log(-log(1 - share above x)) = log(K * mean length) - rate * x at several quantiles x. The top
    two percent stay out, as some texts labelled clean are not."""
    if not len(best):
        return 1.0, -3.0
    at = np.unique(np.quantile(best, np.linspace(0.5, 0.98, 25)))
    above = np.array([(best >= x).mean() for x in at])
    at, above = at[(above > 0) & (above < 1)], above[(above > 0) & (above < 1)]
    if len(at) < 2:
        return 1.0, -float(np.log(max(length.mean(), 1)))
    slope, level = np.polyfit(at, np.log(-np.log1p(-above)), 1)
    return float(np.clip(-slope, 0.05, 5.0)), float(level - np.log(max(length.mean(), 1)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights of 1 and the columns of x, by Newton steps on the penalised likelihood."""
    full = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(full.shape[1])
    ridge = np.eye(len(w)) * penalty
    ridge[0, 0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        step = np.linalg.solve((full * (p * (1 - p))[:, None]).T @ full + ridge, full.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(tail: np.ndarray, passages: np.ndarray, weights: np.ndarray) -> np.ndarray:
    x = weights[0] + weights[1] * tail + weights[2] * np.log1p(passages)
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, learn: Column, max_labelled: int = MAX_LABELLED) -> dict | None:
    """learn: which label rows (column id) may be used. Each half of the labelled texts is measured with the word scores of the other
    half; that gives the extreme-value law and the logistic weights. The model's own word scores come from both halves."""
    rows = materialize(labelled(docs, labels, learn, max_labelled))
    send = docs.sparkSession.sparkContext.broadcast
    halves = [send(log_odds(*key_counts(rows.where(F.col("half") != half)))) for half in (0, 1)]  # at most MAX_KEYS keys each

    def measured(law: tuple[float, float] | None) -> pa.Table:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            tables = [TokenScores(x.value) for x in halves]
            for batch in batches:
                if batch.num_rows:
                    texts, own = batch.column(0).to_pylist(), batch.column(2).to_pylist()
                    best, length, found = zip(*(features(x, tables[h], law) for x, h in zip(texts, own, strict=True)), strict=True)
                    yield {"toxic": batch.column(1), "best": list(best), "length": list(length), "passages": list(found)}

        return on_batches(rows.select("text", "toxic", "half"), work, "toxic int, best double, length long, passages long").toArrow()

    first = measured(None)  # at most max_labelled rows
    toxic = first.column("toxic").to_numpy()
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    clean = toxic == 0
    law = fit_law(first.column("best").to_numpy()[clean], first.column("length").to_numpy()[clean])
    second = measured(law)
    y = second.column("toxic").to_numpy()
    tail = log_tail(second.column("best").to_numpy(), second.column("length").to_numpy(), law)
    weights = fit_logistic(np.column_stack([tail, np.log1p(second.column("passages").to_numpy())]), y)
    return {"odds": send(log_odds(*key_counts(rows))), "law": law, "weights": weights}


def scored(docs: DataFrame, model: dict | None, name: str) -> DataFrame:
    """docs with the score of its column `text`, the only input, as column `name`."""
    if model is None:
        return docs.withColumn(name, F.lit(0.0))

    def start():
        table = TokenScores(model["odds"].value)

        def score(texts: list[str | None]) -> np.ndarray:
            if not texts:
                return np.empty(0)
            best, length, passages = map(np.array, zip(*(features(x, table, model["law"]) for x in texts), strict=True))
            return probability(log_tail(best, length, model["law"]), passages, model["weights"])

        return score

    return appended(docs, "text", name, "double", start)


def passages(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, first token, end token, score and tail of every significant toxic passage."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        table, (rate, log_k) = TokenScores(model["odds"].value), model["law"]
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "begin": [], "end": [], "score": [], "expected": []}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = tokens(text)
                for begin, end, score in segments(np.fromiter(map(table.__getitem__, own), np.float64, len(own))):
                    expected = float(np.exp(log_k - rate * score)) * len(own)
                    if expected <= EXPECTED:
                        for name, value in zip(out, (doc_id, begin, end, score, expected), strict=True):
                            out[name].append(value)
            yield out

    return on_batches(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), work,
        "doc_id long, begin int, end int, score double, expected double",
    )


def toxicity(docs: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), (fold("doc_id", parts) == held).alias("held_out"))
    model = train(own, labels, fold("id", parts) != held)
    return scored(own, model, "score").drop("text").withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """The documents below the threshold, with all their columns."""
    name = "toxicity of text"
    model = train(docs, labels, fold("id", parts) != held)
    return scored(docs, model, name).where(F.col(name) < THRESHOLD).select(*docs.columns)
