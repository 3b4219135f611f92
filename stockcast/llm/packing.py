"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become pieces of at most `size` tokens (only longer ones are cut); pieces are dealt into blocks of a bounded number.
Each block is packed by several islands, each with a population of packings of its own, one task per block and island:

* a packing is one bin number per piece, better with fewer bins, then with a larger sum of squared fills;
* crossover injects well-filled whole bins of one parent into the other, removes the bins that hold one of their pieces
  again, and puts the pieces so displaced back by best fit, largest first;
* mutation empties some of the least filled bins and refits their pieces;
* after each epoch, every island sends its best packing (its elite) to the next island of the block, by a join.

A block that reaches its lower bound rests. In the end the bins of a block that are not well filled are pooled with those of other
blocks and packed once more, level by level while that saves bins, so that cutting into blocks costs almost nothing.

Defined cases: a null text is the empty one, whose only token is the closing 0. Null and repeated ids are rows like others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.text import materialize, on_batches
from stockcast.llm.tokenizing import REMEMBERED, ByteLevel

SIZE = 2048
#: pieces of a block, and the search: islands of a block, epochs between migrations, offspring of an epoch, population
BLOCK, ISLANDS, EPOCHS, OFFSPRING, POPULATION = 1 << 12, 3, 3, 6, 4
#: a bin this full is injected by crossover and closed between levels
WELL_FILLED = 0.995
LEVELS = 2


def cut_points(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: the first takes what is over, all others are full."""
    first = length - size * (-(-length // size) - 1)
    return [(0, first), *((start, size) for start in range(first, length, size))]


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, size: int = SIZE, path: str | None = None) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tokens, known = ByteLevel(path), {}

        def measured(text: str) -> list[tuple[int, int, int]]:
            ids = np.append(tokens.ids(text), np.uint32(0)).astype("<u4")
            return [(a, n, zlib.crc32(ids[a : a + n].tobytes())) for a, n in cut_points(len(ids), size)]

        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or ""
                key = xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))
                if key not in known:
                    if len(known) >= REMEMBERED:
                        known.pop(next(iter(known)))
                    known[key] = measured(text)
                for k, (start, length, crc) in enumerate(known[key]):
                    for name, value in zip(out, (doc_id, k, start, length, crc), strict=True):
                        out[name].append(value)
            yield out

    return on_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), work, PIECE)


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """Bins that any packing needs: Martello and Toth's bound over all split lengths."""
    count = np.bincount(lengths, minlength=size + 1)
    weight = count * np.arange(size + 1)
    n, w = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(weight)])  # [k]: of lengths below k
    half = size // 2
    low = np.arange(0, half + 1)
    large = n[-1] - n[size - low + 1]
    middle, middle_w = n[size - low + 1] - n[half + 1], w[size - low + 1] - w[half + 1]
    small_w = w[half + 1] - w[low]
    return int((large + middle + np.maximum(0, -(-(small_w - (middle * size - middle_w)) // size))).max())


def best_fit(lengths: np.ndarray, order: np.ndarray, size: int, bins: np.ndarray, room: np.ndarray, fresh: int) -> np.ndarray:
    """A bin for each piece in `order`: the fullest open bin that takes it, else a new one from number `fresh`. `bins` with `room`
    are open at first. Bit r of `free` says that a bin with room r is open."""
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    free = 0
    for b, r in zip(bins.tolist(), room.tolist(), strict=True):
        if r > 0:
            by_room[r].append(b)
            free |= 1 << r
    out = []
    for n in lengths[order].tolist():
        fitting = free >> n
        if fitting:
            r = n + (fitting & -fitting).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                free ^= 1 << r
        else:
            b, r, fresh = fresh, size, fresh + 1
        out.append(b)
        left = r - n
        if left:
            by_room[left].append(b)
            free |= 1 << left
    return np.array(out, np.int32)


def renumbered(packing: np.ndarray) -> np.ndarray:
    return np.unique(packing, return_inverse=True)[1].astype(np.int32)


def fitness(packing: np.ndarray, lengths: np.ndarray) -> tuple[int, float]:
    """To be made small: bins, then minus the sum of squared fills."""
    fill = np.bincount(packing, weights=lengths)
    return int((fill > 0).sum()), -float((fill * fill).sum())


def refit(packing: np.ndarray, lost: np.ndarray, lengths: np.ndarray, size: int, rng: np.random.Generator, noise: float) -> np.ndarray:
    """The packing after its pieces `lost` (flags) were taken out and put back by best fit, about largest first."""
    kept = np.flatnonzero(~lost)
    fill = np.bincount(packing[kept], weights=lengths[kept]).astype(np.int64)
    bins = np.flatnonzero(fill)
    order = np.flatnonzero(lost)
    order = order[np.argsort(-lengths[order] * (1 + noise * rng.random(len(order))), kind="stable")]
    out = packing.copy()
    out[order] = best_fit(lengths, order, size, bins, size - fill[bins], len(fill))
    return renumbered(out)


def crossover(giver: np.ndarray, taker: np.ndarray, lengths: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    fill = np.bincount(giver, weights=lengths)
    injected = (fill >= WELL_FILLED * size) & (rng.random(len(fill)) < 0.5)
    given = injected[giver]
    if not given.any():
        return taker
    hit = np.zeros(int(taker.max()) + 1, bool)
    hit[taker[given]] = True  # bins of the taker with a piece that comes in again
    child = np.where(given, giver + len(hit), taker).astype(np.int32)
    return refit(renumbered(child), hit[taker] & ~given, lengths, size, rng, 0.02)


def mutation(packing: np.ndarray, lengths: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    fill = np.bincount(packing, weights=lengths)
    chosen = fill < np.quantile(fill, rng.uniform(0.02, 0.2))
    chosen |= rng.random(len(fill)) < 0.02
    return refit(packing, chosen[packing], lengths, size, rng, 0.2)


def first_packings(lengths: np.ndarray, size: int, island: int, rng: np.random.Generator, population: int) -> list[np.ndarray]:
    """Best fit in order of size, exactly so for the first packing of the first island, else with noise."""
    empty, every = np.zeros(len(lengths), np.int32), np.ones(len(lengths), bool)
    return [refit(empty, every, lengths, size, rng, 0.05 * (k + island)) for k in range(population)]


def evolve(population: list[np.ndarray], lengths: np.ndarray, size: int, rng: np.random.Generator, offspring: int, goal: int) -> list[np.ndarray]:
    """The population after some offspring, the best first; its size stays."""
    ranked = sorted(((fitness(p, lengths), k, p) for k, p in enumerate(population)), key=lambda x: x[:2])
    for step in range(offspring):
        if ranked[0][0][0] <= goal:
            break
        a, b = rng.choice(len(ranked), 2, replace=False) if len(ranked) > 1 else (0, 0)
        child = crossover(ranked[a][2], ranked[b][2], lengths, size, rng)
        if rng.random() < 0.5:
            child = mutation(child, lengths, size, rng)
        ranked.append((fitness(child, lengths), len(population) + step, child))
        ranked = sorted(ranked, key=lambda x: x[:2])[: len(population)]
    return [p for _, _, p in ranked]


STATE = "block int, island int, packings binary, bins int, goal int"


def _unpack(data: bytes, n: int) -> list[np.ndarray]:
    return list(np.frombuffer(data, np.int32).reshape(-1, n))


def _epoch(blocks: DataFrame, state: DataFrame | None, epoch: int, islands: int, offspring: int, population: int, size: int) -> DataFrame:
    """One row per block and island: its population after an epoch, with the neighbour's elite taken in before."""
    if state is None:
        rows = blocks.select("block", "lengths", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
        rows = rows.repartition("block", "island").withColumns({c: F.lit(None).cast("binary") for c in ("packings", "elite")})
    else:
        elite = state.select(
            F.col("block").alias("of"), ((F.col("island") + 1) % islands).alias("to"),
            F.expr("substring(packings, 1, cast(length(packings) / :n as int))".replace(":n", str(population))).alias("elite"),
        )
        rows = (
            state.join(elite, (F.col("block") == F.col("of")) & (F.col("island") == F.col("to")))
            .join(blocks.select("block", "lengths"), "block").select("block", "lengths", "island", "packings", "elite")
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for block, data, island, packings, elite in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lengths = np.frombuffer(data, np.int64)
                rng = np.random.default_rng([epoch, island, block])
                if packings is None:
                    own = first_packings(lengths, size, island, rng, population)
                else:  # the elite takes the worst one's place
                    own = [*_unpack(packings, len(lengths))[:-1], np.frombuffer(elite, np.int32)]
                goal = lower_bound(lengths, size)
                own = evolve(own, lengths, size, rng, offspring, goal)
                yield {"block": [block], "island": [island], "packings": [np.concatenate(own).tobytes()],
                       "bins": [fitness(own[0], lengths)[0]], "goal": [goal]}

    return on_batches(rows.select("block", "lengths", "island", "packings", "elite"), work, STATE)


COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32")


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """Written rows dealt evenly into blocks: one row per block with its pieces' columns, packed."""
    count = max(1, -(-rows.count() // block))

    def gather(group: pa.Table) -> pa.Table:
        ids = group.column("doc_id")
        made = {"block": group.column("block")[:1], "unnamed": pa.array([np.array(ids.is_null()).astype(np.uint8).tobytes()], pa.binary())}
        for name in COLUMNS:
            values = np.array(group.column(name).fill_null(0)).astype(np.int64)
            made["lengths" if name == "length" else name] = pa.array([values.tobytes()], pa.binary())
        return pa.table({k: made[k] for k in ("block", "unnamed", "doc_id", "piece", "start", "lengths", "ids_crc32")})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)).cast("int"))
    return dealt.groupBy("block").applyInArrow(
        gather, "block int, unnamed binary, doc_id binary, piece binary, start binary, lengths binary, ids_crc32 binary"
    )


PLACED = PIECE + ", sequence_id long, offset long, filled long"


def _placed(blocks: DataFrame, best: DataFrame, level: int, size: int) -> DataFrame:
    """The pieces of all blocks with their sequence, place and the sequence's fill."""
    joined = blocks.join(best, "block")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], np.int64)
                packing = np.frombuffer(row["packing"], np.int32)
                order = np.argsort(packing, kind="stable")
                ordered = lengths[order]
                ends = np.cumsum(ordered)
                new = np.ones(len(order), bool)
                new[1:] = packing[order][1:] != packing[order][:-1]
                begin = (ends - ordered)[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
                fill = np.bincount(packing, weights=lengths).astype(np.int64)
                take = lambda name: np.frombuffer(row[name], np.int64)[order]
                unnamed = np.frombuffer(row["unnamed"], np.uint8)[order] > 0
                yield {
                    "doc_id": pa.array(take("doc_id"), mask=unnamed), "piece": take("piece"), "start": take("start"),
                    "length": ordered, "ids_crc32": take("ids_crc32"),
                    "sequence_id": (np.int64(level) << 56) | (np.int64(row["block"]) << 24) | packing[order].astype(np.int64),
                    "offset": ends - ordered - begin, "filled": fill[packing[order]],
                }

    return on_batches(joined, work, PLACED)


def _pack_level(rows: DataFrame, level: int, size: int, block: int, islands: int, epochs: int, offspring: int, population: int) -> DataFrame:
    blocks = materialize(_blocks(rows, block))
    state = materialize(_epoch(blocks, None, 0, islands, offspring, population, size))
    for epoch in range(1, epochs):
        solved = state.groupBy("block").agg(F.min("bins").alias("bins"), F.max("goal").alias("goal")).where("bins > goal").isEmpty()
        if solved:
            break
        state = materialize(_epoch(blocks, state, epoch, islands, offspring, population, size))
    elite = F.expr(f"substring(packings, 1, cast(length(packings) / {population} as int))")
    ranked = state.groupBy("block").agg(F.min(F.struct("bins", "island")).alias("best")).select("block", "best.island")
    best = state.join(ranked, ["block", "island"]).select("block", elite.alias("packing"))
    return materialize(_placed(blocks, best, level, size))


def pack(docs: DataFrame, size: int = SIZE, block: int = BLOCK, islands: int = ISLANDS, epochs: int = EPOCHS,
         offspring: int = OFFSPRING, population: int = POPULATION, levels: int = LEVELS, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    rows = materialize(pieces(docs, size, path))
    placed, closed = _pack_level(rows, 0, size, block, islands, epochs, offspring, population), []
    full = F.col("filled") >= int(WELL_FILLED * size)
    for level in range(1, levels):
        loose = placed.where(~full)
        again = _pack_level(loose.select(*COLUMNS), level, size, block, islands, epochs, offspring, population)
        sequences = lambda table: table.where("offset = 0").count()
        if sequences(again) >= sequences(loose):
            break
        closed.append(placed.where(full))
        placed = again
    for part in closed:
        placed = placed.unionByName(part)
    return placed.drop("filled")
