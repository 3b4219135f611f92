"""Language identification with hyperdimensional profiles.

Every letter of Unicode, lower-cased, has a random vector of +1 and -1 of its own, drawn by a seeded hash of its code point. An n-gram's vector is the product (binding) of its letters' vectors, each
rotated (permuted) by its distance from the end; a text's vector is the sum (bundle) of its n-grams' vectors, and a language's
prototype is the bundle of all its training texts. A text gets the language whose prototype has the largest cosine.

Since bundles are sums, a text's vector is its n-gram counts times the n-gram vectors: counts are gathered per batch and
multiplied in slices of n-grams, whatever the number of letters. Training needs only the counts per language, added up by Spark.

Defined cases: null text or no letter gives "und" with score 0, as does training without a language. Ties go to the
smaller language value. Whole texts count, very long ones too; a text is never cut. Rows that repeat count each time they
occur. An empty table gives an empty result. More than MAX_LANGUAGES languages are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.text import fold, on_batches

DIMENSIONS, SEED = 1024, 7
#: bits of a code point in an n-gram's code
POINT = 21
#: n-grams whose vectors are made at a time, and sums a task holds before it hands them on
SLICE, HELD = 4096, 1 << 20


def symbols() -> np.ndarray:
    """Per code point: 0 if it is no letter, else the code point of its lower case."""
    table = np.zeros(0x110000, np.int32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            table[code] = ord(char.lower()[0])
    return table


def letter_vectors(points: np.ndarray, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """+1 and -1 by the bits of a hash (splitmix64) of seed, code point and place."""
    per = -(-dimensions // 64)
    x = (np.uint64(seed) << np.uint64(40)) + points.astype(np.uint64)[:, None] * np.uint64(per) + np.arange(per, dtype=np.uint64)
    x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    bits = np.unpackbits(x.astype("<u8").view(np.uint8), axis=1)[:, :dimensions]
    return 2 * bits.astype(np.float32) - 1


def gram_vectors(codes: np.ndarray, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """The vectors of some 3-grams; callers go by slices, as each takes 4 bytes a dimension."""
    parts = [codes >> 2 * POINT, codes >> POINT & (1 << POINT) - 1, codes & (1 << POINT) - 1]
    points, place = np.unique(np.concatenate(parts), return_inverse=True)
    first, second, third = np.split(place, 3)
    letters = letter_vectors(points, dimensions, seed)
    out = np.roll(letters, 2, axis=1)[first]
    out *= np.roll(letters, 1, axis=1)[second]
    out *= letters[third]
    return out


def grams(texts: list[str | None], kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text number and code of every 3-gram of letters and word edges whose middle is a letter."""
    joined = "\n".join(x or "" for x in texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    marks = np.concatenate([[0], kinds[points], [0]]).astype(np.int64)
    middle = np.flatnonzero(marks)
    codes = marks[middle - 1] << 2 * POINT | marks[middle] << POINT | marks[middle + 1]
    ends = np.cumsum([len(x or "") + 1 for x in texts])
    return np.searchsorted(ends, middle - 1, side="right"), codes


def distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different codes, in order, and the place of each code among them. Few letters are numbered anew, which saves the sort."""
    parts = [codes >> 2 * POINT, codes >> POINT & (1 << POINT) - 1, codes & (1 << POINT) - 1]
    letters = np.flatnonzero(np.bincount(parts[1], minlength=1))
    letters = np.concatenate([[0], letters])  # the neighbours of a letter are letters of the same texts, or an edge
    size = len(letters)
    if size**3 > 1 << 24:
        return np.unique(codes, return_inverse=True)
    number = np.zeros(int(letters[-1]) + 1, np.int64)
    number[letters] = np.arange(size)
    small = (number[parts[0]] * size + number[parts[1]]) * size + number[parts[2]]
    flags = np.bincount(small, minlength=1) > 0
    seen = np.flatnonzero(flags)
    whole = letters[seen // size**2] << 2 * POINT | letters[seen // size % size] << POINT | letters[seen % size]
    return whole, (np.cumsum(flags) - 1)[small]


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, code, n over `docs` (text, lang): each task sends one sum per language and 3-gram, or a few where it meets very many."""
    kinds = docs.sparkSession.sparkContext.broadcast(symbols())  # 4.5 MB, always

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        none = np.empty(0, np.int64)
        for batch in batches:
            langs = batch.column(1).to_pylist()
            owner, codes = grams(batch.column(0).to_pylist(), kinds.value)
            names = sorted(set(langs))
            order = {name: k for k, name in enumerate(names)}
            number = np.array([order[x] for x in langs], np.int64)[owner]
            for k, name in enumerate(names):
                seen, place = distinct(codes[number == k])
                old, sums = totals.get(name, (none, none))
                both, at = np.unique(np.concatenate([old, seen]), return_inverse=True)
                new = np.zeros(len(both), np.int64)
                new[at[: len(old)]] += sums
                new[at[len(old) :]] += np.bincount(place, minlength=len(seen))
                totals[name] = both, new
            if sum(len(x) for x, _ in totals.values()) >= HELD:
                yield from emit(totals)
                totals = {}
        yield from emit(totals)

    def emit(totals: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[dict]:
        for name, (seen, sums) in totals.items():
            yield {"lang": [name] * len(seen), "code": seen, "n": sums}

    return on_batches(docs.select("text", "lang"), work, "lang string, code long, n long").groupBy("lang", "code").agg(
        F.sum("n").alias("n")
    )


def prototypes(counts: DataFrame, dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """One unit vector per language."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_numpy(zero_copy_only=False)
            codes, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for name in set(langs):
                own = langs == name
                part = n[own].astype(np.float64) @ gram_vectors(codes[own], dimensions, seed)
                sums[name] = sums.get(name, 0) + part
        for name, total in sums.items():
            yield {"lang": [name] * dimensions, "place": np.arange(dimensions), "x": total}

    parts = on_batches(counts, bundle, "lang string, place int, x double")
    return (
        parts.groupBy("lang", "place").agg(F.sum("x").alias("x"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "x"))).alias("v"))
        .select("lang", F.col("v.x").alias("vector"))
    )


#: languages of a model: a prototype has DIMENSIONS numbers, so the model sent to the tasks has a known size
MAX_LANGUAGES = 10_000


def train(docs: DataFrame, held_out) -> dict[str, np.ndarray]:
    """Language to unit prototype, from the documents outside the held-out ones."""
    learned = docs.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = prototypes(gram_counts(learned)).limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    made = {r["lang"]: np.array(r["vector"], np.float32) for r in sorted(rows, key=lambda r: r["lang"])}
    return {k: v / max(np.linalg.norm(v), 1e-12) for k, v in made.items()}


def cosines(texts: list[str | None], model: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosine of each text with each prototype, and which texts have a letter."""
    owner, codes = grams(texts, kinds)
    has = np.bincount(owner, minlength=len(texts)) > 0
    seen, place = distinct(codes)
    # counts of (n-gram, text), n-grams in order
    pairs, counts = np.unique(place * max(len(texts), 1) + owner, return_counts=True)
    gram, text = np.divmod(pairs, max(len(texts), 1))
    vectors = np.zeros((len(texts), model.shape[1]), np.float32)
    for begin in range(0, len(seen), SLICE):
        own = slice(*np.searchsorted(gram, [begin, begin + SLICE]))
        rows, row = np.unique(text[own], return_inverse=True)
        table = np.zeros((len(rows), min(SLICE, len(seen) - begin)), np.float32)
        table[row, gram[own] - begin] = counts[own]
        vectors[rows] += table @ gram_vectors(seen[begin : begin + SLICE], model.shape[1])
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.maximum(norm, 1e-12)) @ model.T, has


def identify(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """lang_pred and score of every document; the text alone is read, all else is carried along."""
    kinds = docs.sparkSession.sparkContext.broadcast(symbols())
    langs, vectors = list(model), np.array(list(model.values()), np.float32)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            if langs:
                found, has = cosines(texts, vectors, kinds.value)
                best = found.argmax(axis=1)
                score = np.clip(found[np.arange(len(texts)), best], 0, 1)
            else:
                has = np.zeros(len(texts), bool)
            yield {
                "doc_id": batch.column(0), "held_out": batch.column(1),
                "lang_pred": [langs[best[k]] if has[k] else "und" for k in range(len(texts))],
                "score": [float(score[k]) if has[k] else 0.0 for k in range(len(texts))],
            }

    return on_batches(docs.select("doc_id", "held_out", "text"), work, "doc_id long, held_out boolean, lang_pred string, score double")


def predict_languages(docs: DataFrame, parts: int = 3, held: int = 1) -> DataFrame:
    own = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"),
        (fold("doc_id", parts) == held).alias("held_out"),
    )
    return identify(own, train(own, F.col("held_out")))
