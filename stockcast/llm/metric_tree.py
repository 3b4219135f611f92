"""Exact top-k inner products by best-first search of M-trees.

Vectors are whole numbers. With one more coordinate, sqrt(M**2 - |x|**2) for a vector x and 0 for a query q, where M is the
largest norm, the squared distance is |q|**2 + M**2 - 2 <q, x>: the largest products are the smallest distances of a metric, so an
M-tree applies.

* Vectors are dealt to the nearest of at most PIVOTS sampled ones (a bounded sample, see `pivot_count`; it only shapes the trees).
  Each cell is cut into trees of about TREE_ROWS vectors by a hash of the row, however many equal vectors it holds.
* A tree is bulk-loaded in one task and written as one row. Its nodes are pages of at most PAGE entries; a page has a
  routing vector, a covering radius and the distance to the routing vector of the page above, an entry its distance to that of its page.
* The roots (routing vector, radius) form directory pages of DIRECTORY trees. Queries travel in blocks of QUERIES.
  Round one searches the nearest tree of each query, which gives its k-th score so far. Round two sends a query to every other
  tree whose root may hold as good a score, and to no more; only these queries' numbers are shuffled.
* In a tree pages are taken from a heap by their least possible distance until that is beyond the k-th best. A page
  or an entry is passed over without computing a distance if |d(q, parent) - d(parent, it)| - radius is already beyond.

Bounds are in floating point with a margin (`SLACK`); scores are exact whole numbers. Ties go to the smaller id.

Defined cases: a vector that is null or holds null or non-finite components takes no part, nor does one of n components with one
beyond sqrt(2**63 / n), whose scores need not fit a long. Vectors of different lengths are not compared; empty vectors have score 0
with each other. A null id is larger than any other and never a query. Of rows with one id each is a candidate, and each a
query of its own, also to the others. Other columns are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockcast.llm.text import materialize, on_batches, packed, unpacked

PIVOTS, ROWS_A_PIVOT, TREE_ROWS, PAGE, DIRECTORY, QUERIES = 4096, 1024, 8192, 256, 512, 256
PIVOT_BYTES, TREE_BYTES = 32 << 20, 16 << 20
#: of the largest norm: more than the rounding of a distance (about 1e-7 of it near 0)
SLACK = 1e-6


def pivot_count(rows: int, dims: int) -> int:
    """One pivot for ROWS_A_PIVOT rows, at most PIVOTS and PIVOT_BYTES."""
    return max(1, min(PIVOTS, PIVOT_BYTES // (8 * max(1, dims)), -(-rows // ROWS_A_PIVOT)))


def whole_vectors(table: DataFrame, vector_id: str, vector: str, scale: int = 256) -> DataFrame:
    """row (a number of its own), id, v (whole numbers): floor(scale * x) of the vectors that take part. Written, so that rows keep
    their numbers."""
    x = F.col(f"`{vector}`")
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    limit = F.sqrt(F.lit(float(2**63)) / F.greatest(F.size(x), F.lit(1))) - 1
    fits = F.forall(x, lambda c: F.abs(c.cast("double") * scale) < limit)
    floors = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    rows = table.where(x.isNotNull() & usable).where(fits)
    return materialize(rows.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{vector_id}`").cast("long").alias("id"), floors.alias("v")))


def _matrix(lists: pa.Array) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, whole numbers) for each length of the vectors in a column."""
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    flat, first = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()[:-1]
    out = []
    for dims in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == dims)
        out.append((dims, at, flat[first[at][:, None] + np.arange(dims)].astype(np.int64)))
    return out


def _small(x: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest type that holds them."""
    most = int(np.abs(x).max(initial=0))
    return x.astype(next(t for t in (np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def _unsmall(data: bytes, width: int, shape: tuple[int, int]) -> np.ndarray:
    return unpacked(data, f"i{width}").reshape(shape).astype(np.int64)


def _lifted(x: np.ndarray, most: float) -> np.ndarray:
    """The vectors with their further coordinate; `most` is the square of the largest norm."""
    x = x.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(0, most - (x * x).sum(1)))])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T
    return np.sqrt(np.maximum(0, square))


class Tree:
    """Pages of a bulk-loaded M-tree. Page k covers `count[k]` entries from `first[k]` on: pages, or vectors if `leaf[k]`."""

    PARTS = (("v", None), ("id", "i8"), ("row", "i8"), ("near", "f8"), ("centre", "i8"), ("radius", "f8"), ("above", "f8"),
             ("first", "i8"), ("count", "i8"), ("leaf", "i8"))

    def __init__(self, **parts: np.ndarray) -> None:
        self.__dict__.update(parts)
        self.floats = self.v.astype(np.float64)
        self.routes = self.floats[self.centre]

    @classmethod
    def load(cls, v: np.ndarray, ids: np.ndarray, rows: np.ndarray, most: float, page: int = PAGE) -> Tree:
        lifted, draw = _lifted(v, most), np.random.default_rng(len(v))
        nodes: list[list] = [[0, 0.0, 0.0, 0, 0, 0]]
        order, near = [], []
        middle = int(_distances(lifted, lifted.mean(0, keepdims=True))[:, 0].argmin())
        todo = [(0, np.arange(len(v)), middle, -1)]
        for k, own, centre, parent in todo:  # grows while it is read: pages of one level follow each other
            far = _distances(lifted[own], lifted[[centre]])[:, 0]
            up = float(_distances(lifted[[centre]], lifted[[parent]])[0, 0]) if parent >= 0 else 0.0
            if len(own) <= page:
                nodes[k] = [centre, float(far.max()), up, len(order), len(own), 1]
                order.extend(own.tolist())
                near.extend(far.tolist())
                continue
            parts = -(-len(own) // page)
            heads = own[np.sort(draw.choice(len(own), min(page, max(2, parts)), replace=False))]
            which = _distances(lifted[own], lifted[heads]).argmin(1)
            groups = [(int(h), own[which == j]) for j, h in enumerate(heads)]
            if max(len(g) for _, g in groups) > len(own) * 3 // 4:  # equal vectors: halves make progress where distance does not
                groups = [(int(g[0]), g) for g in np.array_split(own[np.argsort(far, kind="stable")], 2)]
            groups = [(h, g) for h, g in groups if len(g)]
            nodes[k] = [centre, float(far.max()), up, len(nodes), len(groups), 0]
            for h, g in groups:
                todo.append((len(nodes), g, h, centre))
                nodes.append([])
        place = np.empty(len(v), np.int64)
        place[order] = np.arange(len(v))
        columns = list(zip(*nodes, strict=True))
        return cls(
            v=v[order], id=ids[order], row=rows[order], near=np.array(near), centre=place[list(columns[0])],
            radius=np.array(columns[1], float), above=np.array(columns[2], float),
            first=np.array(columns[3], np.int64), count=np.array(columns[4], np.int64), leaf=np.array(columns[5], np.int64),
        )

    def packed(self) -> dict[str, bytes | int]:
        small = _small(self.v)
        return {n: packed(small if n == "v" else getattr(self, n)) for n, _ in self.PARTS} | {"width": small.itemsize, "n": len(small), "dims": small.shape[1]}

    @classmethod
    def unpacked(cls, row: dict) -> Tree:
        v = _unsmall(row["v"], row["width"], (row["n"], row["dims"]))
        return cls(v=v, **{n: unpacked(row[n], kind) for n, kind in cls.PARTS[1:]})

    def search(self, q: np.ndarray, own: int, k: int, most: float, bound: int | None) -> tuple[list[tuple[int, int, int]], int]:
        """The k best (score, id, row) that reach `bound`, best first, without the query's own row; and how many distances were computed."""
        floats = q.astype(np.float64)
        norm = float(floats @ floats)
        exact = math.sqrt(norm * most) < 2**53  # else sums of doubles may be rounded
        margin = SLACK * math.sqrt(max(norm, most, 1.0))
        best: list[tuple[int, int, int]] = []

        def reach() -> float:
            """Vectors farther than this cannot belong to the k best."""
            least = best[-1][0] if len(best) == k else bound
            return math.inf if least is None else math.sqrt(max(0.0, norm + most - 2.0 * least)) + margin

        to = lambda scores: np.sqrt(np.maximum(0.0, norm + most - 2.0 * scores))
        distance = float(to(self.routes[0] @ floats))
        computed, limit = 1, reach()
        heap = [(max(0.0, distance - self.radius[0] - margin), 0, distance)]
        while heap and heap[0][0] <= limit:
            _, node, distance = heapq.heappop(heap)
            a, b = int(self.first[node]), int(self.first[node] + self.count[node])
            if not self.leaf[node]:
                kept = a + np.flatnonzero(np.abs(distance - self.above[a:b]) - self.radius[a:b] <= limit + margin)
                each = to(self.routes[kept] @ floats)
                computed += len(kept)
                least = np.maximum(0.0, each - self.radius[kept] - margin)
                for j in np.flatnonzero(least <= limit).tolist():
                    heapq.heappush(heap, (float(least[j]), int(kept[j]), float(each[j])))
                continue
            kept = a + np.flatnonzero(np.abs(distance - self.near[a:b]) <= limit + margin)
            within = slice(a, b) if len(kept) == b - a else kept  # no copy of a whole page
            scores = (self.floats[within] @ floats).astype(np.int64) if exact else self.v[within] @ q
            computed += len(kept)
            floor = best[-1][0] if len(best) == k else bound
            good = self.row[kept] != own
            if floor is not None:
                good &= scores >= floor
            if good.any():
                kept, scores = kept[good], scores[good]
                if len(kept) > k:
                    pick = np.lexsort((self.row[kept], self.id[kept], -scores))[:k]
                    kept, scores = kept[pick], scores[pick]
                new = zip(scores.tolist(), self.id[kept].tolist(), self.row[kept].tolist(), strict=True)
                best = sorted([*best, *new], key=lambda r: (-r[0], r[1], r[2]))[:k]
                limit = reach()
        return best, computed


#: stands for a null id in arrays: larger than any other in order
NO_ID = np.iinfo(np.int64).max


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False)


def build(vectors: DataFrame, rows: int, dims: int, most: float, page: int = PAGE, tree_rows: int = TREE_ROWS) -> DataFrame:
    """One row per tree, written down. `dims` is the greatest length of a vector."""
    sample = vectors.orderBy(F.xxhash64("row"), "row").select("v").limit(pivot_count(rows, dims)).toArrow()
    by = {n: _lifted(heads, most) for n, _, heads in _matrix(sample.column("v"))} if rows else {}

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in parts:
            cell, size = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for n, at, v in _matrix(batch.column("v")):
                size[at] = n
                if n in by:
                    cell[at] = _distances(_lifted(v, most), by[n]).argmin(1)
            yield {"row": batch.column("row"), "id": batch.column("id"), "v": batch.column("v"), "dims": size, "cell": cell}

    dealt = materialize(on_batches(vectors, deal, "row long, id long, v array<long>, dims long, cell long", 4096))
    most_rows = F.least(F.lit(tree_rows), F.greatest(F.lit(page), F.lit(TREE_BYTES) / (8 * (F.col("dims") + 1)))).cast("long")
    cells = dealt.groupBy("dims", "cell").agg(F.count("*").alias("held")).select(
        "dims", "cell", F.ceil(F.col("held") / most_rows).alias("trees"))
    salted = dealt.join(cells, ["dims", "cell"]).withColumn("salt", F.pmod(F.xxhash64("row", F.lit(1)), "trees"))

    schema = ("tree string, dims long, n long, width long, root binary, root_radius double, v binary, id binary, row binary, near binary, "
              "centre binary, radius binary, above binary, first binary, count binary, leaf binary")

    def load(key: tuple, group: pa.Table) -> pa.Table:
        dims, cell, salt = (k.as_py() for k in key)
        (_, at, v), = _matrix(group.column("v"))
        ids, rows_ = (_ids(group.column(c).combine_chunks())[at] for c in ("id", "row"))
        tree = Tree.load(v, ids, rows_, most, page)
        row = tree.packed() | {"tree": f"{dims}/{cell}/{salt}", "root": packed(tree.v[tree.centre[0]]), "root_radius": float(tree.radius[0])}
        return pa.table({name: [row[name]] for name in (part.strip().split(" ")[0] for part in schema.split(","))})

    return materialize(salted.select("row", "id", "v", "dims", "cell", "salt").groupBy("dims", "cell", "salt").applyInArrow(load, schema))


def _directory(trees: DataFrame) -> tuple[DataFrame, Column]:
    """Pages of at most DIRECTORY roots, written down; their numbers (one for some millions of vectors) as an array."""

    def collect(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        number = TaskContext.get().partitionId() << 32
        for batch in parts:
            yield {"page": [number], "roots": [batch.column("root").to_pylist()], "trees": [batch.column("tree").to_pylist()],
                   "radii": [batch.column("root_radius").to_pylist()], "sizes": [batch.column("dims").to_pylist()]}
            number += 1

    light = trees.select("tree", "root", "root_radius", "dims").repartition(max(1, -(-trees.count() // DIRECTORY)))
    schema = "page long, roots array<binary>, trees array<string>, radii array<double>, sizes array<long>"
    written = materialize(on_batches(light, collect, schema, DIRECTORY))
    numbers = [F.lit(r["page"]) for r in written.select("page").collect()]
    return written, F.array(*numbers).cast("array<long>")


def _page_views(row: dict, dims: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Names, routing vectors and radii of the page's trees of one vector length."""
    at = [j for j, d in enumerate(row["sizes"]) if d == dims]
    roots = np.array([unpacked(row["roots"][j], "i8") for j in at], np.int64).reshape(len(at), dims)
    return [row["trees"][j] for j in at], roots, np.array([row["radii"][j] for j in at], float)


def _root_bounds(q: np.ndarray, roots: np.ndarray, radii: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Distances of queries to roots and the least distances to anything below them."""
    q, roots = q.astype(np.float64), roots.astype(np.float64)
    norms = (q * q).sum(1)
    each = np.sqrt(np.maximum(0.0, norms[:, None] + most - 2.0 * q @ roots.T))
    margin = SLACK * np.sqrt(np.maximum(np.maximum(norms, most), 1.0))[:, None]
    return each, np.maximum(0.0, each - radii - 2 * margin)


BLOCK = "block long, dims long, width long, q binary, q_id array<long>, q_row array<long>"


def _blocks(queries: DataFrame, count: int) -> DataFrame:
    """The queries in blocks of at most QUERIES of one length, written down."""

    def collect(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        number = TaskContext.get().partitionId() << 32
        for batch in parts:
            ids, rows = _ids(batch.column("id")), _ids(batch.column("row"))
            for dims, at, v in _matrix(batch.column("v")):
                small = _small(v)
                yield {"block": [number], "dims": [dims], "width": [small.itemsize], "q": [packed(small)],
                       "q_id": [ids[at].tolist()], "q_row": [rows[at].tolist()]}
                number += 1

    dealt = queries.select("row", "id", "v").repartition(max(1, -(-count // QUERIES)))
    return materialize(on_batches(dealt, collect, BLOCK, QUERIES))


VISIT = "tree string, dims long, width long, q binary, q_id array<long>, q_row array<long>, bound array<long>"


def _visit(tree: str, row: dict, q: np.ndarray, at: np.ndarray, bound: list[int | None]) -> dict:
    return {"tree": [tree], "dims": [row["dims"]], "width": [row["width"]], "q": [packed(q[at].astype(f"i{row['width']}"))],
            "q_id": [[row["q_id"][j] for j in at]], "q_row": [[row["q_row"][j] for j in at]], "bound": [[bound[j] for j in at]]}


def _block_view(row: dict) -> np.ndarray:
    return _unsmall(row["q"], row["width"], (len(row["q_id"]), row["dims"]))


def _nearest(blocks: DataFrame, directory: DataFrame, pages: Column, most: float) -> DataFrame:
    """block, at (place in the block), tree: the tree each query looks at first."""
    each = blocks.withColumn("page", F.explode(pages))

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row in _rows(parts):
            names, roots, radii = _page_views(row, row["dims"])
            if names:
                far, least = _root_bounds(_block_view(row), roots, radii, most)
                pick = np.lexsort((far, least), axis=1)[:, 0]
                take = np.arange(len(pick))
                yield {"block": [row["block"]] * len(pick), "at": take.tolist(), "tree": [names[j] for j in pick],
                       "least": least[take, pick].tolist(), "far": far[take, pick].tolist()}

    found = on_batches(each.join(directory, "page"), work, "block long, at int, tree string, least double, far double", 16)
    return materialize(found.groupBy("block", "at").agg(F.min_by("tree", F.struct("least", "far", "tree")).alias("tree")))


def _rows(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in parts:
        yield from batch.to_pylist()


def _search(visits: DataFrame, trees: DataFrame, k: int, most: float) -> DataFrame:
    """q_row, q_id, id, row, score of every visit's best vectors, written down."""
    inner = trees.select("tree", "n", F.col("width").alias("tree_width"), *[F.col(n).alias(f"t_{n}") for n, _ in Tree.PARTS])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        name, tree = None, None
        for row in _rows(parts):
            if row["tree"] != name:
                name = row["tree"]
                tree = Tree.unpacked({n: row[f"t_{n}"] for n, _ in Tree.PARTS} | {"width": row["tree_width"], "n": row["n"], "dims": row["dims"]})
            out: dict[str, list] = {c: [] for c in ("q_row", "q_id", "id", "row", "score")}
            for q, q_id, q_row, bound in zip(_block_view(row), row["q_id"], row["q_row"], row["bound"], strict=True):
                for score, one, at in tree.search(q, q_row, k, most, bound)[0]:
                    for c, value in zip(out, (q_row, q_id, None if one == NO_ID else one, at, score), strict=True):
                        out[c].append(value)
            yield out

    return materialize(on_batches(visits.join(inner, "tree"), work, "q_row long, q_id long, id long, row long, score long", 4))


def top_products(vectors: DataFrame, is_query: Column, k: int, page: int = PAGE, tree_rows: int = TREE_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: of every row of `vectors` (from `whole_vectors`) for which `is_query` holds, the k rows with the
    largest inner products, without the row itself."""
    norm = F.aggregate("v", F.lit(0.0), lambda total, c: total + c.cast("double") * c)
    facts = vectors.agg(F.count("*").alias("n"), F.max(norm).alias("most"), F.count_if(is_query).alias("queries"), F.max(F.size("v")).alias("dims")).first()
    most = facts["most"] or 0.0
    trees = build(vectors, facts["n"], facts["dims"] or 0, most, page, tree_rows)
    directory, pages = _directory(trees)
    blocks = _blocks(vectors.where(is_query), facts["queries"])
    home = _nearest(blocks, directory, pages, most)

    placed = home.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "tree"))).alias("homes"))

    def first_visits(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row in _rows(parts):
            q, by = _block_view(row), {}
            for one in row["homes"]:
                by.setdefault(one["tree"], []).append(one["at"])
            for tree, at in by.items():
                yield _visit(tree, row, q, np.array(at), [None] * len(q))

    known = blocks.join(placed, "block")
    first = _search(materialize(on_batches(known, first_visits, VISIT, 16)), trees, k, most)

    kth = first.groupBy("q_row").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
    at_query = blocks.select("block", F.posexplode("q_row").alias("at", "q_row")).join(kth, "q_row")
    bounds = at_query.groupBy("block").agg(F.collect_list(F.struct("at", F.col("kth").alias("kth"))).alias("bounds"))

    def other_visits(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row in _rows(parts):
            names, roots, radii = _page_views(row, row["dims"])
            if not names:
                continue
            q, bound = _block_view(row), [None] * len(row["q_id"])
            for one in row["bounds"] or ():
                bound[one["at"]] = one["kth"]
            homes = {one["at"]: one["tree"] for one in row["homes"]}
            norms = (q.astype(np.float64) ** 2).sum(1)
            least = np.array([-math.inf if b is None else b for b in bound])
            reach = np.sqrt(np.maximum(0.0, norms + most - 2.0 * least))
            _, nearest = _root_bounds(q, roots, radii, most)
            for j, name in enumerate(names):
                at = np.array([a for a in np.flatnonzero(nearest[:, j] <= reach).tolist() if homes[a] != name], np.int64)
                if len(at):
                    yield _visit(name, row, q, at, bound)

    each = known.join(bounds, "block", "left").withColumn("page", F.explode(pages)).join(directory, "page")
    rest = _search(materialize(on_batches(each, other_visits, VISIT, 16)), trees, k, most)

    place = Window.partitionBy("q_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select(F.col("q_id").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
