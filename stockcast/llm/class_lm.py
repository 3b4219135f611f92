"""Language-model scores from Brown class-based bigrams.

1. Documents are packed into blocks, one row each: the block's own word list (64-bit hashes), each token's place in it,
   and the documents' lengths. Later steps read these rows; the text is split once.
2. Every block sends its words' training counts to hash owners; an owner adds them up, answers each block with the totals
   of the words it asked about, and reports its most frequent words. So every word of every document gets its exact
   count, however large the vocabulary, and no task or driver holds all of it.
3. Exchange clustering assigns the `head` most frequent words to classes. Bigram counts lie with the owners of their words;
   each round, every owner moves its words to the class that raises the class-bigram likelihood most, given the others'
   classes and the class-by-class counts. Half of the words may move in a round, so that they do not swap in step.
   The best assignment seen stays. Until then all rarer words count as one class; the end of a text is a class by itself.
4. Every rarer word goes to a class by the same gain: blocks send its training neighbours' classes to its hash owner, which
   adds them up and answers the blocks with the word's class. Blocks then count class bigrams with all words in their classes.
5. P(w | v) = mix * P(class of w | class of v) * P(w | class of w) + (1 - mix) * (c(w) + 1) / (N + V + 1).
   Rarer words have add-one emissions within their class. A word without training counts may come from every class, which
   holds one count for it, and tells nothing about the next word.

Defined cases: a null or empty text is the end token alone. Without training documents all counts are 0. Rows with equal or
null ids are scored one by one. Words are told apart by their 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.text import fold, materialize, on_batches, owners, packed, unpacked, words

#: words that are clustered by exchange, and the classes of all words: the model sent to tasks is bounded by these
HEAD, CLASSES, ROUNDS, MIX = 20_000, 64, 8, 0.95
#: rows of an Arrow batch where a row is a block or an owner
FEW = 2
#: tokens of a block: what one row and its task hold
BLOCK_TOKENS = 1 << 18
#: rarer words whose gains an owner holds at a time
WORDS_AT_ONCE = 4096
#: the end of a text: no word hash, as the word list of a block holds it under this number
END = np.uint64(0)

BLOCK = "block long, ids binary, held binary, unnamed binary, lengths binary, places binary, vocabulary binary, counts binary"


def _blocks(docs: DataFrame, block_tokens: int) -> DataFrame:
    """docs: doc_id, text, held_out."""

    class Places(dict):
        def __missing__(self, word: bytes) -> int:
            self[word] = place = len(self) + 1
            return place

    def flush(block: int, ids: list, held: list, places: list[np.ndarray], table: Places) -> dict:
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) or 1 for w in table), np.uint64, len(table))
        order = np.argsort(hashes, kind="stable")
        rank = np.empty(len(order) + 1, np.int32)
        rank[0] = 0  # the end token
        rank[order + 1] = np.arange(1, len(order) + 1, dtype=np.int32)
        lengths = np.array([len(x) for x in places], np.int32)
        tokens = rank[np.concatenate(places)]
        learned = np.repeat(~np.array(held, bool), lengths)
        counts = np.bincount(tokens[learned], minlength=len(order) + 1).astype(np.int32)
        return {
            "block": [block], "ids": [np.array([x or 0 for x in ids], np.int64).tobytes()], "held": [np.array(held, np.uint8).tobytes()],
            "unnamed": [np.array([x is None for x in ids], np.uint8).tobytes()], "lengths": [lengths.tobytes()],
            "places": [packed(tokens)], "vocabulary": [np.concatenate([[END], hashes[order]]).astype(np.uint64).tobytes()],
            "counts": [packed(counts)],
        }

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, serial, size = TaskContext.get().partitionId(), 0, 0
        ids, held, places, table = [], [], [], Places()
        for batch in batches:
            for doc_id, text, out in zip(*(batch.column(k) for k in range(3)), strict=True):
                tokens = words(text.as_py())
                own = np.zeros(len(tokens) + 1, np.int32)  # the last stays 0: the end
                own[:-1] = np.fromiter(map(table.__getitem__, tokens), np.int32, len(tokens))
                ids.append(doc_id.as_py())
                held.append(out.as_py())
                places.append(own)
                size += len(own)
                if size >= block_tokens:
                    yield flush((part << 32) | serial, ids, held, places, table)
                    serial, size, ids, held, places, table = serial + 1, 0, [], [], [], Places()
        if ids:
            yield flush((part << 32) | serial, ids, held, places, table)

    return on_batches(docs.select("doc_id", "text", "held_out"), work, BLOCK)


def _cut(hashes: np.ndarray, shares: int) -> np.ndarray:
    """Where the sorted hashes of each owner begin."""
    owner = ((hashes >> np.uint64(32)) * np.uint64(shares)) >> np.uint64(32)
    return np.searchsorted(owner, np.arange(shares + 1, dtype=np.uint64))


def _asked(blocks: DataFrame, shares: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for block, vocabulary, counts in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                hashes, n = np.frombuffer(vocabulary, np.uint64), unpacked(counts, np.int32)
                cuts = _cut(hashes, shares)
                full = [k for k in range(shares) if cuts[k + 1] > cuts[k]]
                yield {
                    "block": [block] * len(full), "owner": full,
                    "hashes": [hashes[cuts[k] : cuts[k + 1]].tobytes() for k in full],
                    "counts": [packed(n[cuts[k] : cuts[k + 1]]) for k in full],
                }

    return on_batches(
        blocks.select("block", "vocabulary", "counts"), work, "block long, owner int, hashes binary, counts binary", FEW
    )


def _totals(asked: DataFrame, head: int) -> DataFrame:
    """Answers to blocks (block, owner, totals) and one row per owner without a block: its tokens, words and top words."""

    def own(table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        counts = np.concatenate([unpacked(x, np.int32) for x in table.column("counts").to_pylist()])
        distinct, place = np.unique(np.concatenate(lists), return_inverse=True)
        totals = np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)
        answers = [packed(x) for x in np.split(totals[place], np.cumsum([len(x) for x in lists])[:-1])]
        order = np.lexsort((distinct, -totals))[:head]
        order = order[(totals[order] > 0) & (distinct[order] != END)]
        n = len(answers)
        return pa.table({
            "block": pa.array([*table.column("block").to_pylist(), None], pa.int64()),
            "owner": pa.array([*table.column("owner").to_pylist(), table.column("owner")[0].as_py()], pa.int32()),
            "totals": pa.array([*answers, None], pa.binary()),
            "tokens": pa.array([None] * n + [int(totals.sum())], pa.int64()),
            "words": pa.array([None] * n + [int((totals > 0).sum())], pa.int64()),
            "top": pa.array([None] * n + [distinct[order].view(np.int64)], pa.list_(pa.int64())),
            "top_n": pa.array([None] * n + [totals[order]], pa.list_(pa.int64())),
        })

    return asked.groupBy("owner").applyInArrow(
        own, "block long, owner int, totals binary, tokens long, words long, top array<long>, top_n array<long>"
    )


def _head_words(totals: DataFrame, head: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the most frequent words, at most `head`, and their counts."""
    tops = totals.where("block is null").select(F.explode(F.arrays_zip("top", "top_n")).alias("x"))
    rows = tops.select("x.top", "x.top_n").orderBy(F.desc("top_n"), "top").limit(head).toArrow()
    hashes = rows.column("top").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], rows.column("top_n").to_numpy()[order]


def _numbers(hashes: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Per hash: its place among the head words, len(head) for rarer words, len(head) + 1 for the end."""
    place = np.searchsorted(head, hashes)
    place[place == len(head)] = 0
    found = head[place] == hashes if len(head) else np.zeros(len(hashes), bool)
    return np.where(hashes == END, len(head) + 1, np.where(found, place, len(head))).astype(np.int64)


def _bigrams(blocks: DataFrame, head: np.ndarray, shares: int) -> DataFrame:
    """One row per owner of words: sorted codes (word number * width + neighbour) of training bigrams with their counts, once
    from the left word's side (0), once from the right one's (1). Written once, each round reads it where it lies."""
    width = len(head) + 2

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                numbers = _numbers(np.frombuffer(row["vocabulary"], np.uint64), head)
                tokens = numbers[unpacked(row["places"], np.int32)]
                lengths = np.frombuffer(row["lengths"], np.int32)
                learned = np.repeat(np.frombuffer(row["held"], np.uint8) == 0, lengths)
                left = np.concatenate([[width - 1], tokens[:-1]])  # a text begins after an end
                codes, n = np.unique((left * width + tokens)[learned], return_counts=True)
                for kind, own in ((0, codes), (1, codes % width * width + codes // width)):
                    order = np.argsort(own)
                    own, sums = own[order], n[order]
                    cuts = np.searchsorted(own // width, np.arange(shares + 1) * (-(-width // shares)))
                    full = [k for k in range(shares) if cuts[k + 1] > cuts[k]]
                    if full:
                        yield {
                            "owner": full, "kind": [kind] * len(full),
                            "codes": [packed(np.diff(own[cuts[k] : cuts[k + 1]], prepend=0)) for k in full],
                            "counts": [packed(sums[cuts[k] : cuts[k + 1]].astype(np.int32)) for k in full],
                        }

    needed = blocks.select("vocabulary", "places", "lengths", "held")
    parts = on_batches(needed, work, "owner int, kind int, codes binary, counts binary", FEW)

    def add(table: pa.Table) -> pa.Table:
        kinds, made = table.column("kind").to_numpy(), {"owner": table.column("owner")[:1]}
        for kind in (0, 1):
            own = table.filter(pa.array(kinds == kind))
            codes = np.concatenate([np.empty(0, np.int64), *(np.cumsum(unpacked(x.as_py(), np.int64)) for x in own.column("codes"))])
            counts = np.concatenate([np.empty(0, np.int32), *(unpacked(x.as_py(), np.int32) for x in own.column("counts"))])
            codes, place = np.unique(codes, return_inverse=True)
            sums = np.bincount(place, weights=counts, minlength=len(codes)).astype(np.int64)
            made[f"codes_{kind}"] = pa.array([packed(codes)], pa.binary())
            made[f"counts_{kind}"] = pa.array([packed(sums)], pa.binary())
        return pa.table(made)

    return parts.groupBy("owner").applyInArrow(
        add, "owner int, codes_0 binary, counts_0 binary, codes_1 binary, counts_1 binary"
    )


def _class_counts(bigrams: DataFrame, classes: np.ndarray, total: int) -> np.ndarray:
    """Bigrams by class and class."""
    width = len(classes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for codes, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = unpacked(codes, np.int64)
                pair = classes[own // width] * total + classes[own % width]
                sums = np.bincount(pair, weights=unpacked(counts, np.int64), minlength=total * total)
                seen = np.flatnonzero(sums)
                yield {"pair": seen, "n": sums[seen].astype(np.int64)}

    return _summed(on_batches(bigrams.select("codes_0", "counts_0"), work, "pair int, n long", FEW), total)


def _summed(rows: DataFrame, total: int) -> np.ndarray:
    out = np.zeros(total * total, np.int64)
    for row in rows.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # at most (CLASSES + 2) ** 2 rows
        out[row["pair"]] = row["n"]
    return out.reshape(total, total)


def likelihood(table: np.ndarray) -> float:
    """Of the class bigram model, up to the words' own entropy."""
    full = table[table > 0].astype(float)
    out = float((full * np.log(full)).sum())
    for axis in (0, 1):
        sums = table.sum(axis=axis).astype(float)
        sums = sums[sums > 0]
        out -= float((sums * np.log(sums)).sum())
    return out


def gains(after: np.ndarray, before: np.ndarray, table: np.ndarray, free: int) -> np.ndarray:
    """For words with counts by class of the next word (`after`) and of the one before: what each class gains by them.

    Moving a word's n tokens into class b adds about after . log T[b, :] + before . log T[:, b] - n (log T[b, .] + log T[., b]).
    """
    smooth = table[:free].astype(float) + 0.5
    into = table[:, :free].astype(float) + 0.5
    n_after, n_before = after.sum(axis=1), before.sum(axis=1)
    rows, columns = table[:free].sum(axis=1) + 1.0, table[:, :free].sum(axis=0) + 1.0
    return after @ np.log(smooth).T + before @ np.log(into) - np.outer(n_after, np.log(rows)) - np.outer(n_before, np.log(columns))


def best_classes(after: np.ndarray, before: np.ndarray, table: np.ndarray, now: np.ndarray, free: int) -> np.ndarray:
    """The class that gains most; a word's own counts are first taken out of its present class."""
    smooth = table[:free].astype(float) + 0.5
    into = table[:, :free].astype(float) + 0.5
    n_after, n_before = after.sum(axis=1), before.sum(axis=1)
    rows, columns = table[:free].sum(axis=1) + 1.0, table[:, :free].sum(axis=0) + 1.0
    score = gains(after, before, table, free)
    own_after = np.log(np.maximum(smooth[now] - after, 0.5))
    own_before = np.log(np.maximum(into[:, now].T - before, 0.5))
    score[np.arange(len(now)), now] = (
        (after * own_after).sum(axis=1) + (before * own_before).sum(axis=1)
        - n_after * np.log(np.maximum(rows[now] - n_after, 1.0)) - n_before * np.log(np.maximum(columns[now] - n_before, 1.0))
    )
    return score.argmax(axis=1)


def _moves(bigrams: DataFrame, classes: np.ndarray, table: np.ndarray, turn: int, free: int) -> np.ndarray:
    """The classes after one round of exchanges."""
    width, total, head = len(classes), len(table), len(classes) - 2

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes, counts = (
                    [unpacked(data[k], np.int64) for k in (0, 2)], [unpacked(data[k], np.int64) for k in (1, 3)]
                )
                word = np.unique(np.concatenate([x // width for x in codes]))
                word = word[(word < head) & (word % 2 == turn % 2)]
                if not len(word):
                    continue
                sides = []
                for own, n in zip(codes, counts, strict=True):
                    place = np.searchsorted(word, own // width)
                    place[place == len(word)] = 0
                    mine = word[place] == own // width
                    cells = place[mine] * total + classes[own[mine] % width]
                    sides.append(np.bincount(cells, weights=n[mine], minlength=len(word) * total).reshape(-1, total))
                yield {"word": word, "class": best_classes(*sides, table, classes[word], free)}

    columns = bigrams.select("codes_0", "counts_0", "codes_1", "counts_1")
    rows = on_batches(columns, work, "word int, class int", FEW).toArrow()  # at most HEAD rows
    out = classes.copy()
    out[rows.column("word").to_numpy()] = rows.column("class").to_numpy()
    return out


def cluster(bigrams: DataFrame, counts: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Class of every head word, then of rarer words and of the end; and the class-by-class counts."""
    head = len(counts)
    free = max(1, min(classes, head))
    now = np.empty(head + 2, np.int64)
    now[np.lexsort((np.arange(head), -counts))] = np.arange(head) % free  # spread by frequency
    now[head:] = free, free + 1
    best = None
    for turn in range(rounds + 1):
        table = _class_counts(bigrams, now, free + 2)
        value = likelihood(table)
        if best is None or value > best[0]:
            best = (value, now, table)
        if turn < rounds and head:
            now = _moves(bigrams, now, table, turn, free)
    return best[1], best[2]


def _contexts(blocks: DataFrame, head: np.ndarray, classes: np.ndarray, shares: int) -> DataFrame:
    """Per block and owner: hashes of the block's words outside the head, and sorted codes ((place among them * 2 + side) * classes
    + class) of their training neighbours with counts; side 0 is the next word, 1 the one before."""
    width, total = len(head) + 2, int(classes[-1]) + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes = np.frombuffer(row["vocabulary"], np.uint64)
                numbers = _numbers(hashes, head)
                rare = numbers == len(head)
                place = (np.cumsum(rare) - 1)[unpacked(row["places"], np.int32)]
                tokens = numbers[unpacked(row["places"], np.int32)]
                lengths = np.frombuffer(row["lengths"], np.int32)
                learned = np.repeat(np.frombuffer(row["held"], np.uint8) == 0, lengths)
                left = np.concatenate([[width - 1], tokens[:-1]])
                left_place = np.concatenate([[0], place[:-1]])
                after, before = learned & (left == len(head)), learned & (tokens == len(head))
                codes, n = np.unique(np.concatenate([
                    left_place[after] * 2 * total + classes[tokens[after]], (place[before] * 2 + 1) * total + classes[left[before]]
                ]), return_counts=True)
                cuts = _cut(hashes[rare], shares)
                at = np.searchsorted(codes, cuts * 2 * total)
                full = [k for k in range(shares) if cuts[k + 1] > cuts[k]]
                if full:
                    yield {
                        "block": [row["block"]] * len(full), "owner": full,
                        "hashes": [hashes[rare][cuts[k] : cuts[k + 1]].tobytes() for k in full],
                        "codes": [packed(np.diff(codes[at[k] : at[k + 1]] - cuts[k] * 2 * total, prepend=0)) for k in full],
                        "counts": [packed(n[at[k] : at[k + 1]].astype(np.int32)) for k in full],
                    }

    needed = blocks.select("block", "vocabulary", "places", "lengths", "held")
    return on_batches(needed, work, "block long, owner int, hashes binary, codes binary, counts binary", FEW)


def _assigned(contexts: DataFrame, table: np.ndarray, free: int) -> DataFrame:
    """Answers to blocks (block, owner, classes) and one row per owner without a block: words and tokens it put into each class.
    A word without training counts gets the number `free`."""
    total = len(table)

    def own(rows: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, np.uint64) for x in rows.column("hashes").to_pylist()]
        distinct, place = np.unique(np.concatenate(lists), return_inverse=True)
        starts = np.cumsum([0, *(len(x) for x in lists)])
        cells = []
        for start, codes in zip(starts, rows.column("codes"), strict=False):
            code = np.cumsum(unpacked(codes.as_py(), np.int64))
            cells.append(place[start + code // (2 * total)] * 2 * total + code % (2 * total))
        cells = np.concatenate(cells)
        counts = np.concatenate([unpacked(x.as_py(), np.int32) for x in rows.column("counts")])
        order = np.argsort(cells)
        cells, counts = cells[order], counts[order]
        kind, tokens = np.full(len(distinct), free, np.int32), np.zeros(len(distinct), np.int64)
        for first in range(0, len(distinct), WORDS_AT_ONCE):
            size = min(WORDS_AT_ONCE, len(distinct) - first)
            lo, hi = np.searchsorted(cells, [first * 2 * total, (first + size) * 2 * total])
            sides = np.bincount(cells[lo:hi] - first * 2 * total, weights=counts[lo:hi], minlength=size * 2 * total).reshape(size, 2, total)
            seen = sides[:, 1].sum(axis=1).astype(np.int64)  # every training token has a word or an end before it
            best = gains(sides[:, 0], sides[:, 1], table, free).argmax(axis=1)
            kind[first : first + size] = np.where(seen > 0, best, free)
            tokens[first : first + size] = seen
        answers = [packed(x) for x in np.split(kind[place], starts[1:-1])]
        n = len(answers)
        return pa.table({
            "block": pa.array([*rows.column("block").to_pylist(), None], pa.int64()),
            "owner": pa.array([*rows.column("owner").to_pylist(), rows.column("owner")[0].as_py()], pa.int32()),
            "classes": pa.array([*answers, None], pa.binary()),
            "words": pa.array([None] * n + [np.bincount(kind, minlength=total)[:free]], pa.list_(pa.int64())),
            "tokens": pa.array([None] * n + [np.bincount(kind, weights=tokens, minlength=total)[:free].astype(np.int64)], pa.list_(pa.int64())),
        })

    return contexts.groupBy("owner").applyInArrow(
        own, "block long, owner int, classes binary, words array<long>, tokens array<long>"
    )


def _rare_sums(assigned: DataFrame, free: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and tokens outside the head by class."""
    each = assigned.where("block is null").select(F.posexplode(F.arrays_zip("words", "tokens")).alias("class", "x"))
    out = np.zeros((2, free), np.int64)
    for row in each.groupBy("class").agg(F.sum("x.words").alias("v"), F.sum("x.tokens").alias("n")).collect():  # one row per class
        out[:, row["class"]] = row["v"], row["n"]
    return out[0], out[1]


FILLED = "ids binary, unnamed binary, held binary, lengths binary, places binary, totals binary, classes binary, rare binary"


def _filled(blocks: DataFrame, totals: DataFrame, assigned: DataFrame, head: np.ndarray, classes: np.ndarray) -> DataFrame:
    """Blocks with the answers of the owners in place of the word list: per word its count, its class and whether it is rare."""
    both = totals.where("block is not null").select("block", F.lit(0).alias("kind"), "owner", F.col("totals").alias("data")).unionByName(
        assigned.where("block is not null").select("block", F.lit(1).alias("kind"), "owner", F.col("classes").alias("data"))
    )
    answers = both.groupBy(F.col("block").alias("to")).agg(F.sort_array(F.collect_list(F.struct("kind", "owner", "data"))).alias("x")).select(
        "to", F.col("x.kind").alias("kinds"), F.col("x.data").alias("answers")
    )
    joined = blocks.join(answers, blocks["block"] == answers["to"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                numbers = _numbers(np.frombuffer(row["vocabulary"], np.uint64), head)
                found = {0: [np.empty(0, np.int64)], 1: [np.empty(0, np.int32)]}
                for kind, data in zip(row["kinds"], row["answers"], strict=True):
                    found[kind].append(unpacked(data, np.int32 if kind else np.int64))
                own, rare = classes[numbers].astype(np.int32), numbers == len(head)
                own[rare] = np.concatenate(found[1])
                yield {
                    **{c: [row[c]] for c in ("ids", "unnamed", "held", "lengths", "places")},
                    "totals": [packed(np.concatenate(found[0]))], "classes": [packed(own)], "rare": [packed(rare)],
                }

    columns = ("ids", "unnamed", "held", "lengths", "places", "vocabulary", "kinds", "answers")
    return on_batches(joined.select(*columns), work, FILLED, FEW)


def _word_classes(filled: DataFrame, total: int) -> np.ndarray:
    """Training bigrams by class and class, every word in its class."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                now = unpacked(row["classes"], np.int32).astype(np.int64)[unpacked(row["places"], np.int32)]
                learned = np.repeat(np.frombuffer(row["held"], np.uint8) == 0, np.frombuffer(row["lengths"], np.int32))
                left = np.concatenate([[total - 1], now[:-1]])
                sums = np.bincount((left * total + now)[learned], minlength=total * total)
                seen = np.flatnonzero(sums)
                yield {"pair": seen, "n": sums[seen]}

    rows = on_batches(filled.select("classes", "places", "held", "lengths"), work, "pair int, n long", FEW)
    return _summed(rows, total)


def score_block(row: dict, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per document of a block: tokens, known tokens, base score and model score."""
    lengths = np.frombuffer(row["lengths"], np.int32)
    places, totals, kind = unpacked(row["places"], np.int32), unpacked(row["totals"], np.int64), unpacked(row["classes"], np.int32)
    unigram = (totals + 1) / (model["tokens"] + model["words"] + 1)
    emission = (totals + unpacked(row["rare"], bool)) / model["class_sizes"][kind]
    now = kind[places]
    before = np.concatenate([[len(model["move"]) - 1], now[:-1]])  # the end's class is the last
    emission[kind == len(model["move"]) - 1] = emission[kind == len(model["move"]) - 2] = 1.0  # the end, words without counts
    mixed = model["mix"] * model["move"][before, now] * emission[places] + (1 - model["mix"]) * unigram[places]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    add = lambda x: np.add.reduceat(x, starts)
    return lengths, add((totals > 0)[places].astype(np.int64)), add(np.log10(unigram)[places]), add(np.log10(mixed))


def _scores(filled: DataFrame, model: dict) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                n, known, base, score = score_block(row, model)
                named = np.frombuffer(row["unnamed"], np.uint8) == 0
                ids = np.frombuffer(row["ids"], np.int64)
                yield {
                    "doc_id": pa.array(ids, mask=~named), "held_out": np.frombuffer(row["held"], np.uint8).astype(bool),
                    "n_tokens": n, "n_known": known, "train_tokens": np.full(len(n), model["tokens"]),
                    "base_score": base, "score": score,
                }

    return on_batches(
        filled, work,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double", FEW,
    )


def transitions(table: np.ndarray, strength: float = 1.0) -> np.ndarray:
    """P(next class | class), each row drawn a little towards the classes' overall shares."""
    share = (table.sum(axis=0) + 1.0) / (table.sum() + len(table))
    return (table + strength * share) / (table.sum(axis=1, keepdims=True) + strength)


def class_scores(docs: DataFrame, parts: int = 7, held: int = 2, head: int = HEAD, classes: int = CLASSES,
                 rounds: int = ROUNDS, mix: float = MIX, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Scores of all documents by a model of those whose id's fold is not `held`."""
    shares = owners(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), (fold("doc_id", parts) == held).alias("held_out"))
    blocks = materialize(_blocks(own, block_tokens))
    totals = materialize(_totals(_asked(blocks, shares), head))
    sums = totals.where("block is null").agg(F.sum("tokens").alias("n"), F.sum("words").alias("v")).first()
    top, counts = _head_words(totals, head)
    bigrams = materialize(_bigrams(blocks, top, shares))
    kind, table = cluster(bigrams, counts, classes, rounds)
    free = len(table) - 2
    assigned = materialize(_assigned(_contexts(blocks, top, kind, shares), table, free))
    rare_words, rare_tokens = _rare_sums(assigned, free)
    filled = materialize(_filled(blocks, totals, assigned, top, kind))
    class_tokens = rare_tokens + np.bincount(kind[: len(top)], weights=counts, minlength=free)[:free]
    sizes = np.concatenate([class_tokens + rare_words + 1, [1, 1]])  # one more for words without counts
    move = transitions(_word_classes(filled, len(table)))
    move[:, free] += (move[:, :free] / sizes[:free]).sum(axis=1)
    model = {"move": move, "class_sizes": sizes, "mix": mix, "tokens": int(sums["n"] or 0), "words": int(sums["v"] or 0)}
    return _scores(filled, model)
