"""Jaccard join on word n-grams: size-banded tiles, hashed bitmap signatures, exact intersections.

Sets. A document's words give 64-bit hashes, each run of five words one 64-bit hash; its set is sorted and distinct. Documents
with the same set are one node from the start, named by a 64-bit hash of the set, so copies are never paired.

Tiles. All sets order their shingles by one rarity: the corpus count of the shingle's hash bucket (2**20 buckets, a table of
fixed size), then the hash. Two sets with Jaccard t or more share one of their first |s| - ceil(t |s|) + 1 shingles in any common
order. A tile is the list of sets that share such a shingle, sorted by size; inside it a set is only compared within its size
band, t |s| to |s| / t. Tiles with the same members are one tile.

Bitmaps. Each set has a parity bitmap, its width growing with the set. A shingle in one set only flips one bit, so
(|a| + |b| - differing bits) / 2 bounds the intersection from above (the wider map is folded to the narrower). Pairs whose bound is
too small end there; the others get their sorted arrays and an exact intersection.

Groups. In each of the first rounds every set is compared with one other only: the smallest, by a hash that changes each round, of
the hubs of its tiles. Later, members that are already linked with each other need no comparison, so a group of a million near
copies costs a million comparisons a round, not their square. The last round compares what is still apart: tiles are cut
into blocks by size, and the members of a block that have a pair allowed by the bitmaps get their arrays. Exact intersections
run where the block is; what leaves it is a spanning forest of the links found, so rows grow with the members, not with
their pairs. Every pair above the threshold is thus compared, or its two sets are already connected.

Defined cases: fewer than five words make one shingle; null, empty or blank texts have no set and no links. Every row
counts by its own set, also without an id or with one used before; rows are told apart by id and a 64-bit hash of the text. A
component is named by its smallest id, by none if no row of it has one; ids go before none where one row stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockcast.llm.graph import components
from stockcast.llm.text import Interned, materialize, on_batches, owners, words

SHINGLE, NUMERATOR, DENOMINATOR = 5, 75, 100
BUCKETS = 1 << 20
HUB_ROUNDS = 3
#: members of a tile that are compared as one block, and shingles whose arrays travel together in the last round
TILE_BLOCK, BLOCK_SHINGLES = 4096, 1 << 20
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _STEP
    return x ^ (x >> np.uint64(27))


def shingles(text: str | None, table: Interned, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams."""
    tokens = words(text)
    if not tokens:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(table.__getitem__, tokens), np.uint64, len(tokens))
    n = max(1, len(hashes) - size + 1)
    out = np.full(n, np.uint64(len(hashes) if len(hashes) < size else size), np.uint64)
    for k in range(min(size, len(hashes))):
        out = mixed((out + hashes[k : k + n]) * _MIX)
    return np.unique(out)


def set_key(array: np.ndarray) -> int:
    """64-bit name of a set, below 2**63."""
    total = np.add.reduce(mixed(array * _MIX), dtype=np.uint64, keepdims=True) + np.uint64(len(array))
    return int(mixed(total * _MIX)[0] >> np.uint64(1))


def bitmap(array: np.ndarray) -> bytes:
    """Parity bits of the hashes; the width is a power of two, four times the set's size or more, from 64 to 16384 bits."""
    width = 1 << min(14, max(6, int(4 * len(array) - 1).bit_length()))
    bits = np.bincount((array & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ, the wider folded to the narrower."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def prefix_length(n, num: int = NUMERATOR, den: int = DENOMINATOR):
    return n - -(-n * num // den) + 1


def close(shared, a, b, num: int = NUMERATOR, den: int = DENOMINATOR):
    """The link rule, on integers: shared / (a + b - shared) >= num / den."""
    return den * shared >= num * (a + b - shared)


def _with_text(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text, F.xxhash64(text).alias("mark"))


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """Shingles of the corpus by hash bucket: a table of BUCKETS numbers, whatever the corpus."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        table, sums, seen = Interned(), np.zeros(BUCKETS, np.int64), set()
        for batch in batches:
            arrays = []
            for text in batch.column(1):
                array = shingles(text.as_py(), table)
                if len(array) and (key := set_key(array)) not in seen:  # a task counts copies once
                    if len(seen) < 1 << 18:
                        seen.add(key)
                    arrays.append(array)
            if arrays:
                sums += np.bincount((np.concatenate(arrays) >> np.uint64(44)).astype(np.int64), minlength=BUCKETS)
        # slices of the table, so that adding them up is spread too
        for k in range(0, BUCKETS, BUCKETS // 64):
            part = sums[k : k + BUCKETS // 64]
            if part.any():
                yield {"slice": [k], "sums": [part.astype(np.int32 if part.max() < 2**31 else np.int64).tobytes()], "wide": [bool(part.max() >= 2**31)]}

    def add(group: pa.Table) -> pa.Table:
        total = sum(
            np.frombuffer(x, np.int64 if wide else np.int32).astype(np.int64)
            for x, wide in zip(group.column("sums").to_pylist(), group.column("wide").to_pylist(), strict=True)
        )
        return pa.table({"slice": group.column("slice")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(BUCKETS, np.int64)
    slices = on_batches(_with_text(docs), work, "slice int, sums binary, wide boolean")
    for row in slices.groupBy("slice").applyInArrow(add, "slice int, sums binary").collect():
        part = np.frombuffer(row["sums"], np.int64)
        out[row["slice"] : row["slice"] + len(part)] = part
    return out


ENTRY = "kind int, doc_id long, mark long, n long, key long, map binary, owner int, tokens binary, places binary, keys binary, sizes binary"


def _entries(docs: DataFrame, counts: np.ndarray, shares: int, num: int, den: int) -> DataFrame:
    """Kind 0: one row per document with its set's key, size and bitmap. Kind 1: per batch and owner, the prefix shingles of the
    batch's sets, packed."""
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(counts, 2**31 - 1).astype(np.int32))  # 4 MB, always

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        table, seen, rarity = Interned(), set(), shared.value
        for batch in batches:
            ids, rows, maps, sets = batch.column(0).to_pylist(), [], [], []
            for text in batch.column(1):
                array = shingles(text.as_py(), table)
                key = set_key(array) if len(array) else None
                fresh = key is not None and key not in seen
                rows.append((len(array), key))
                maps.append(bitmap(array) if key is not None else None)
                if fresh:
                    if len(seen) < 1 << 18:
                        seen.add(key)
                    sets.append((key, array))
            k = len(ids)
            yield {"kind": [0] * k, "doc_id": ids, "mark": batch.column(2), "n": [x[0] for x in rows], "key": [x[1] for x in rows], "map": maps,
                   **{c: [None] * k for c in ("owner", "tokens", "places", "keys", "sizes")}}
            if not sets:
                continue
            firsts = []
            for _, array in sets:
                take = int(prefix_length(len(array), num, den))
                rare = rarity[(array >> np.uint64(44)).astype(np.int64)]
                firsts.append(array[np.lexsort((array, rare))[:take]])
            tokens = mixed(np.concatenate(firsts) * _MIX)  # spread over owners, whatever the order above
            places = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in firsts])
            owner = ((tokens >> np.uint64(32)) * np.uint64(shares) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(shares + 1))
            keys = np.array([x[0] for x in sets], np.int64)
            sizes = np.array([len(x[1]) for x in sets], np.int32)
            sent: dict[str, list] = {c: [] for c in ("owner", "tokens", "places", "keys", "sizes")}
            for o in range(shares):
                own = order[cuts[o] : cuts[o + 1]]
                if len(own):
                    used, local = np.unique(places[own], return_inverse=True)
                    for c, value in zip(sent, (o, tokens[own].tobytes(), local.astype(np.int32).tobytes(), keys[used].tobytes(), sizes[used].tobytes()), strict=True):
                        sent[c].append(value)
            k = len(sent["owner"])
            yield {"kind": [1] * k, **{c: [None] * k for c in ("doc_id", "mark", "n", "key", "map")}, **sent}

    return on_batches(_with_text(docs), work, ENTRY)


def _tiles(entries: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct tiles (keys and sizes of two members or more, by size)."""

    def own(group: pa.Table) -> pa.Table:
        column = lambda name, kind: [np.frombuffer(x, kind) for x in group.column(name).to_pylist()]
        tokens, places = np.concatenate(column("tokens", np.uint64)), column("places", np.int32)
        keys, sizes = column("keys", np.int64), column("sizes", np.int32)
        starts = np.cumsum([0, *(len(x) for x in keys)])
        place = np.concatenate([p + s for p, s in zip(places, starts[:-1], strict=True)])
        distinct, first, number = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        size_of = np.concatenate(sizes)[first]
        number = number[place]
        order = np.lexsort((number, size_of[number], tokens))
        tokens, number = tokens[order], number[order]
        keep = np.ones(len(tokens), bool)
        keep[1:] = (tokens[1:] != tokens[:-1]) | (number[1:] != number[:-1])  # the same set from several batches
        tokens, number = tokens[keep], number[keep]
        size = size_of[number].astype(np.int64)
        cut = np.ones(len(tokens) + 1, bool)
        # a new tile begins with a new shingle, or where the size leaves the band of the one before
        cut[1:-1] = (tokens[1:] != tokens[:-1]) | (den * size[:-1] < num * size[1:])
        edges = np.flatnonzero(cut)
        found: dict[bytes, np.ndarray] = {}
        for a, b in zip(edges[:-1][np.diff(edges) > 1], edges[1:][np.diff(edges) > 1], strict=True):
            members = number[a:b]
            found[members.tobytes()] = members
        return pa.table({
            "keys": pa.array([distinct[x] for x in found.values()], pa.list_(pa.int64())),
            "sizes": pa.array([size_of[x] for x in found.values()], pa.list_(pa.int32())),
        })

    tiles = entries.where("kind = 1").select("owner", "tokens", "places", "keys", "sizes")
    tiles = tiles.groupBy("owner").applyInArrow(own, "keys array<long>, sizes array<int>")
    return tiles.groupBy(F.xxhash64("keys").alias("tile")).agg(F.first("keys").alias("keys"), F.first("sizes").alias("sizes"))


PAIR = "x long, y long, a long, b long"


def _hub_pairs(tiles: DataFrame, turn: int, num: int, den: int) -> DataFrame:
    """One pair (hub x, set y) for each set: of its tiles' hubs that it is not connected with, the smallest by this turn's hash.
    tiles: keys, sizes, and roots from the second turn on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            parts = []
            for row in range(batch.num_rows):
                keys, sizes, roots = (batch.column(c)[row].values.to_numpy().astype(np.int64) for c in range(3))
                order = mixed(keys.astype(np.uint64) * _MIX + np.uint64(turn))
                hub = int(np.argmin(order))
                fit = (den * np.minimum(sizes, sizes[hub]) >= num * np.maximum(sizes, sizes[hub])) & (roots != roots[hub])
                n = int(fit.sum())
                if n:
                    parts.append((keys[fit], sizes[fit], np.full(n, keys[hub]), np.full(n, sizes[hub]), np.full(n, order[hub] >> np.uint64(1)).astype(np.int64)))
            if parts:
                y, b, x, a, order = map(np.concatenate, zip(*parts, strict=True))
                first = np.lexsort((order, y))
                first = first[np.concatenate([[True], y[first][1:] != y[first][:-1]])]
                yield {"x": x[first], "y": y[first], "a": a[first], "b": b[first], "rank": order[first]}

    roots = "roots" if "roots" in tiles.columns else "keys"
    rows = on_batches(tiles.select("keys", "sizes", F.col(roots).alias("roots")), work, PAIR + ", rank long")
    return rows.groupBy("y").agg(F.min(F.struct("rank", "x", "a", "b")).alias("hub")).select("hub.x", "y", "hub.a", "hub.b")


def _members(tiles: DataFrame) -> DataFrame:
    return tiles.select("tile", F.posexplode(F.arrays_zip("keys", "sizes")).alias("at", "m")).select(
        "tile", "at", F.col("m.keys").alias("key"), F.col("m.sizes").alias("size")
    )


def _open_tiles(tiles: DataFrame, roots: DataFrame) -> DataFrame:
    """Tiles whose members are in two components or more, with the members' components."""
    members = _members(tiles)
    known = members.join(roots, members["key"] == roots["node"], "left").select(
        "tile", "at", "key", "size", F.coalesce("root", "key").alias("root")
    )
    return (
        known.groupBy("tile")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"),
             F.sort_array(F.collect_list(F.struct("at", "key", "size", "root"))).alias("m"))
        .where("low < high")
        .select("tile", F.col("m.key").alias("keys"), F.col("m.size").alias("sizes"), F.col("m.root").alias("roots"))
    )


def folded(maps: list[bytes], width: int) -> np.ndarray:
    """The bitmaps as rows of 64-bit words, the wider folded to `width` bytes; narrower ones are empty rows."""
    out = np.zeros((len(maps), width), np.uint8)
    for k, data in enumerate(maps):
        x = np.frombuffer(data, np.uint8)
        while len(x) > width:
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        if len(x) == width:
            out[k] = x
    return out.view(np.uint64)


def allowed_pairs(left: dict, right: dict | None, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of pairs that are apart, within the size band, and whose bitmaps allow a link: within `left`, or between
    `left` and `right` whose sizes are not smaller. Sizes ascend."""
    other = right or left
    widths = np.array([len(x) for x in left["maps"]])
    tables = {int(w): (folded(left["maps"], int(w)), folded(other["maps"], int(w))) for w in np.unique(widths)}
    ends = np.searchsorted(other["sizes"] * num, left["sizes"] * den, side="right")
    found_i, found_j = [], []
    for i in range(len(widths)):
        begin = 0 if right else i + 1
        if ends[i] <= begin:
            continue
        own, rest = tables[int(widths[i])]
        at = np.flatnonzero(other["roots"][begin : ends[i]] != left["roots"][i]) + begin
        if not len(at):
            continue
        apart = np.bitwise_count(rest[at] ^ own[i]).sum(axis=1, dtype=np.int64)
        a, b = int(left["sizes"][i]), other["sizes"][at]
        at = at[close((a + b - apart) // 2, a, b, num, den)]
        found_i.append(np.full(len(at), i))
        found_j.append(at)
    if not found_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def _chunks(sizes: np.ndarray) -> np.ndarray:
    """A number for each place: consecutive places with at most about BLOCK_SHINGLES shingles have the same."""
    return (np.cumsum(sizes.astype(np.int64)) - 1) // BLOCK_SHINGLES


def _tasks(tiles: DataFrame, sets: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """Blocks of open tiles, each by itself and with the later blocks of its tile that its size band reaches."""
    tiles = tiles if "roots" in tiles.columns else tiles.withColumn("roots", F.col("keys"))
    roots = tiles.select("tile", F.posexplode(F.arrays_zip("keys", "sizes", "roots")).alias("at", "m")).select(
        "tile", "at", F.col("m.keys").alias("of"), F.col("m.sizes").alias("size"), F.col("m.roots").alias("root")
    )
    members = roots.join(sets.select("key", "map"), F.col("of") == F.col("key"))
    blocks = (
        members.groupBy("tile", F.floor(F.col("at") / block).alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "key", "size", "root", "map"))).alias("m"))
        .select("tile", "block", F.col("m.key").alias("keys"), F.col("m.size").alias("sizes"), F.col("m.root").alias("roots"),
                F.col("m.map").alias("maps"))
    )
    blocks = materialize(blocks)
    columns = ("keys", "sizes", "roots", "maps")
    later = blocks.where("block > 0").select(F.col("tile").alias("t"), F.col("block").alias("b"), *[F.col(c).alias(f"{c} 2") for c in columns])
    across = blocks.join(later, (F.col("tile") == F.col("t")) & (F.col("block") < F.col("b"))).where(
        F.expr(f"{num} * `sizes 2`[0] <= {den} * sizes[size(sizes) - 1]")
    )
    empty = [F.lit(None).cast(blocks.schema[c].dataType).alias(f"{c} 2") for c in columns]
    return blocks.select(*columns, *empty).unionByName(across.select(*columns, *[f"{c} 2" for c in columns]))


INVOLVED = "task long, side array<int>, keys array<long>, sizes array<long>, roots array<long>"


def _involved(tasks: DataFrame, num: int, den: int) -> DataFrame:
    """Per task the members that have a pair the bitmaps allow, in portions whose arrays fit together. Side 1 is compared with side
    0, or side 0 with itself if there is no side 1."""

    def part(batch: pa.RecordBatch, row: int, first: int) -> dict | None:
        if not batch.column(first)[row].is_valid:
            return None
        keys, sizes, roots = (batch.column(first + c)[row].values.to_numpy().astype(np.int64) for c in range(3))
        return {"keys": keys, "sizes": sizes, "roots": roots, "maps": batch.column(first + 3)[row].as_py()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for row in range(batch.num_rows):
                left, right = part(batch, row, 0), part(batch, row, 4)
                i, j = allowed_pairs(left, right, num, den)
                if not len(i):
                    continue
                other = right or left
                portions = np.stack([_chunks(left["sizes"])[i], _chunks(other["sizes"])[j]])
                for p, q in np.unique(portions, axis=1).T.tolist():
                    fit = (portions[0] == p) & (portions[1] == q)
                    if right is None and p == q:
                        sides = [(left, np.unique(np.concatenate([i[fit], j[fit]])))]
                    else:
                        sides = [(left, np.unique(i[fit])), (other, np.unique(j[fit]))]
                    yield {
                        "task": [number], "side": [[k for k, (_, at) in enumerate(sides) for _ in at]],
                        **{c: [np.concatenate([x[c][at] for x, at in sides])] for c in ("keys", "sizes", "roots")},
                    }
                    number += 1

    # two sets often share many tiles: the same members are compared once
    return materialize(materialize(on_batches(tasks, work, INVOLVED, 64)).dropDuplicates(["side", "keys"]))


def forest(left: dict, right: dict | None, num: int, den: int) -> tuple[list[int], list[int]]:
    """Keys (x, y) of links that connect what links between the members connect; each has its array. Pairs already connected
    by others are not compared."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    other = right or left
    xs, ys = [], []
    for i, j in zip(*(at.tolist() for at in allowed_pairs(left, right, num, den)), strict=True):
        a, b = root(int(left["roots"][i])), root(int(other["roots"][j]))
        if a == b:
            continue
        p, q = left["arrays"][i], other["arrays"][j]
        both = np.sort(np.concatenate([p, q]), kind="stable")
        if close(int((both[1:] == both[:-1]).sum()), len(p), len(q), num, den):
            parent[a] = b
            xs.append(int(left["keys"][i]))
            ys.append(int(other["keys"][j]))
    return xs, ys


def _rest_links(docs: DataFrame, tiles: DataFrame, sets: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """x, y: links that connect all linked sets of the open tiles, exactly; written down."""
    involved = _involved(_tasks(tiles, sets, num, den, block), num, den)
    if involved.isEmpty():
        return docs.sparkSession.createDataFrame([], "x long, y long")
    each = involved.select("task", F.posexplode(F.arrays_zip("side", "keys", "sizes", "roots")).alias("at", "m"))
    each = each.select("task", "at", *[F.col(f"m.{c}").alias(c) for c in ("side", "keys", "sizes", "roots")])
    arrays = _arrays(docs, each.select(F.col("keys").alias("key")).distinct(), sets).dropDuplicates(["key"])
    whole = each.join(arrays, F.col("keys") == F.col("key")).groupBy("task").agg(
        F.sort_array(F.collect_list(F.struct("at", "side", "keys", "sizes", "roots", "array"))).alias("m"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for members in batch.column(0).to_pylist():
                sides = []
                for side in (0, 1):
                    own = [m for m in members if m["side"] == side]
                    arrays = [np.frombuffer(m["array"], np.uint64) for m in own]
                    sides.append(own and {
                        **{c: np.array([m[c] for m in own], np.int64) for c in ("keys", "sizes", "roots")},
                        "maps": list(map(bitmap, arrays)), "arrays": arrays})
                x, y = forest(sides[0], sides[1] or None, num, den)
                yield {"x": x, "y": y}

    return materialize(on_batches(whole.select("m"), work, "x long, y long", 4)).distinct()


def _possible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose bitmaps allow a link."""
    left, right = (sets.select(F.col("key").alias(f"{s} key"), F.col("map").alias(f"{s} map")) for s in "xy")
    joined = pairs.join(left, pairs["x"] == left["x key"]).join(right, F.col("y") == F.col("y key"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            a, b = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            apart = np.fromiter(
                (differing(p, q) for p, q in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)),
                np.int64, batch.num_rows,
            )
            fit = close((a + b - apart) // 2, a, b, num, den)
            yield {"x": batch.column(0).to_numpy()[fit], "y": batch.column(1).to_numpy()[fit], "a": a[fit], "b": b[fit]}

    return on_batches(joined.select("x", "y", "a", "b", "x map", "y map"), work, PAIR)


def _arrays(docs: DataFrame, wanted: DataFrame, sets: DataFrame) -> DataFrame:
    """key, array of the wanted sets (key), made again from the text of one document each."""
    wanted = materialize(wanted.join(sets, "key").select(F.col("doc_id").alias("id"), F.col("mark").alias("hash"), F.col("key").alias("wanted")))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(wanted, F.col("doc_id") == F.col("id"))
    texts = texts.select("wanted", "text")
    unnamed = wanted.where("id is null")
    if not unnamed.isEmpty():
        found = _with_text(docs).where("doc_id is null").join(unnamed, F.col("mark") == F.col("hash"))
        texts = texts.unionByName(found.select("wanted", "text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        table = Interned()
        for batch in batches:
            arrays = [shingles(x.as_py(), table) for x in batch.column(1)]
            keys = batch.column(0).to_pylist()
            fit = [k for k, x in enumerate(arrays) if len(x) and set_key(x) == keys[k]]  # an id may have several texts
            yield {"key": [keys[k] for k in fit], "array": [arrays[k].tobytes() for k in fit]}

    return materialize(on_batches(texts, work, "key long, array binary"))


def _links(docs: DataFrame, pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that hold the threshold, exactly."""
    pairs = materialize(pairs)
    if pairs.isEmpty():
        return pairs.select("x", "y")
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("key")).distinct()
    arrays = _arrays(docs, wanted, sets).dropDuplicates(["key"])
    left, right = (arrays.select(F.col("key").alias(f"{s} key"), F.col("array").alias(f"{s} array")) for s in "xy")
    joined = pairs.join(left, pairs["x"] == left["x key"]).join(right, F.col("y") == F.col("y key"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            fit = []
            for p, q in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                both = np.sort(np.concatenate([p, q]), kind="stable")
                fit.append(bool(close(int((both[1:] == both[:-1]).sum()), len(p), len(q), num, den)))
            yield {"x": batch.column(0).to_numpy()[fit], "y": batch.column(1).to_numpy()[fit]}

    return materialize(on_batches(joined.select("x", "y", "x array", "y array"), work, "x long, y long"))


def _first() -> Column:
    """Of a group's rows, the one with the smallest id; rows without an id are last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("mark")))


def similar_sets(docs: DataFrame, num: int = NUMERATOR, den: int = DENOMINATOR, block: int = TILE_BLOCK) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, mark, n, key; roots: node, root) of all documents and of the linked sets."""
    shares = owners(docs.sparkSession)
    entries = materialize(_entries(docs, bucket_counts(docs), shares, num, den))
    rows = entries.where("kind = 0").select("doc_id", "mark", "n", "key", "map")
    sets = rows.where("key is not null").groupBy("key").agg(_first().alias("first"), F.first("map").alias("map"))
    sets = materialize(sets.select("key", "first.doc_id", F.expr("if(first.unnamed, first.mark, null)").alias("mark"), "map"))
    tiles = materialize(_tiles(entries, num, den))
    session = docs.sparkSession
    links = session.createDataFrame([], "x long, y long")
    roots = session.createDataFrame([], "node long, root long")
    for turn in range(HUB_ROUNDS + 1):
        if turn:
            tiles = materialize(_open_tiles(tiles, roots))
            if tiles.isEmpty():
                break
        if turn < HUB_ROUNDS:
            found = _links(docs, _possible(_hub_pairs(tiles, turn, num, den), sets, num, den), sets, num, den)
        else:
            found = _rest_links(docs, tiles, sets, num, den, block)
        if not found.isEmpty():
            links = links.unionByName(found)
            roots = materialize(components(links.select(F.col("x").alias("u"), F.col("y").alias("v"))))
    return rows.select("doc_id", "mark", "n", "key"), roots


def _rooted(docs: DataFrame, num: int, den: int, block: int) -> DataFrame:
    rows, roots = similar_sets(docs, num, den, block)
    return rows.join(roots, rows["key"] == roots["node"], "left").select(
        "doc_id", "mark", "n", F.coalesce("root", "key").alias("root")
    )


def near_duplicates(docs: DataFrame, num: int = NUMERATOR, den: int = DENOMINATOR, block: int = TILE_BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    rooted = _rooted(docs, num, den, block)
    # written, so that Spark may split a large component's rows in the join
    smallest = materialize(rooted.where("root is not null").groupBy(F.col("root").alias("of")).agg(F.min("doc_id").alias("component_id")))
    return rooted.join(smallest, F.col("root") == F.col("of"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """One document of each component, the first by id, with all its columns; rows without words stay."""
    rooted = _rooted(docs, NUMERATOR, DENOMINATOR, TILE_BLOCK).where("root is not null")
    kept = materialize(rooted.groupBy(F.col("root").alias("of")).agg(_first().alias("kept")))
    stays = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("mark") == F.col("kept.mark"))
    rows = rooted.join(kept, F.col("root") == F.col("of")).groupBy(F.col("doc_id").alias("id"), F.col("mark").alias("hash"))
    lost = materialize(rows.agg(F.first(stays).alias("stays"), F.count("*").alias("n")).where("not stays or n > 1"))
    keyed = docs.select(*docs.columns, F.xxhash64(F.col("text").cast("string")).alias("hash of text"))
    same = lambda rows: keyed["doc_id"].eqNullSafe(rows["id"]) & (keyed["hash of text"] == rows["hash"])
    repeated = lost.where("stays")
    alone = keyed.join(lost, same(lost), "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return alone
    once = keyed.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "hash of text"]).select(*docs.columns)
    return alone.unionByName(once)
