"""Exact top-k search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from stockcast.llm import metric_tree as mt

SCHEMA = StructType([
    StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType())),
    *[StructField(c, StringType()) for c in ("row", "id", "v", "tree", "cell", "score", "rank")],
])


def table(spark, rows):
    return spark.createDataFrame([(i, v, *["x"] * 7) for i, v in rows], SCHEMA)


def plain(rows, k, every):
    """(query_id, rank, vec_id, score) of all rows, by comparing each query with each vector."""
    usable = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    usable = [(i, v) for i, v in usable if all(abs(c) < math.sqrt(2**63 / max(1, len(v))) - 2 for c in v)]
    out = []
    for at, (i, q) in enumerate(usable):
        if i is None or i % every:
            continue
        scores = [(-sum(a * b for a, b in zip(q, v, strict=True)), j is None, j or 0) for o, (j, v) in enumerate(usable) if o != at and len(v) == len(q)]
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def searched(spark, rows, k=5, every=7, **sizes):
    vectors = mt.whole_vectors(table(spark, rows), "vec_id", "embedding")
    return sorted((tuple(r) for r in mt.top_products(vectors, F.col("id") % every == 0, k, **sizes).collect()), key=str)


def clustered(seed, n, dims, spread):
    draw = np.random.default_rng(seed)
    heads = draw.normal(size=(12, dims))
    x = heads[draw.integers(0, 12, n)] + spread * draw.normal(size=(n, dims))
    x[draw.random(n) < 0.3] = heads[0]  # a third of all rows are one vector
    return [(int(i), v.tolist()) for i, v in zip(draw.permutation(n), x, strict=True)]


@pytest.mark.parametrize(("dims", "spread", "sizes"), [
    (8, 0.05, {"page": 8, "tree_rows": 64}), (64, 1.0, {"page": 16, "tree_rows": 100}), (3, 0.3, {})])
def test_top_products_equal_brute_force(spark, monkeypatch, dims, spread, sizes):
    monkeypatch.setattr(mt, "ROWS_A_PIVOT", 50)
    monkeypatch.setattr(mt, "DIRECTORY", 4)
    monkeypatch.setattr(mt, "QUERIES", 16)
    rows = clustered(dims, 700, dims, spread)
    assert searched(spark, rows, **sizes) == plain(rows, 5, 7)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [-3.0, 0.5]), (7, None), (14, [1.0, None]), (21, [nan, 1.0]), (28, [inf, 0.0]),
            (None, [5.0, 5.0]), (None, [1.0, 2.0]), (35, [1.0, 2.0, 3.0]), (1, []), (42, []), (49, [1e30, 1.0]), (2, [0.0, 0.0]),
            (56, [1e6, -1e6]), (3, [1e6, -1e6]), (-7, [0.0039, -0.0039])]
    assert searched(spark, rows) == plain(rows, 5, 7)
    assert searched(spark, rows[:1]) == []  # a query alone
    assert searched(spark, []) == []


def test_large_components_are_exact(spark):
    """Products beyond 2**53 are still whole numbers."""
    draw = np.random.default_rng(2)
    rows = [(k, (draw.integers(-(2**22), 2**22, 4) + draw.integers(0, 256, 4) / 256).tolist()) for k in range(80)]
    assert searched(spark, rows, page=4) == plain(rows, 5, 7)


def test_bounds_save_distances():
    """In clusters, far less than all distances are computed, and none of the k best is lost."""
    draw = np.random.default_rng(4)
    heads = draw.normal(size=(40, 16)) * 200
    x = np.floor(heads[draw.integers(0, 40, 4000)] + draw.normal(size=(4000, 16))).astype(np.int64)
    most = float((x.astype(float) ** 2).sum(1).max())
    tree = mt.Tree.load(x, np.arange(4000), np.arange(4000), most, 32)
    again = mt.Tree.unpacked(tree.packed())
    total = 0
    for q in range(0, 4000, 50):
        best, computed = again.search(x[q], q, 5, most, None)
        scores = x @ x[q]
        want = sorted((-int(s), j) for j, s in enumerate(scores) if j != q)[:5]
        assert [(-s, j) for s, j, _ in best] == want
        total += computed
    assert total < 80 * 4000 * 0.25


def test_covering_radii_and_parent_distances():
    draw = np.random.default_rng(6)
    x = draw.integers(-50, 50, (500, 5))
    most = float((x.astype(float) ** 2).sum(1).max())
    tree = mt.Tree.load(x, np.arange(500), np.arange(500), most, 8)
    lifted = mt._lifted(tree.v, most)

    def below(k):
        a, b = int(tree.first[k]), int(tree.first[k] + tree.count[k])
        return list(range(a, b)) if tree.leaf[k] else [v for c in range(a, b) for v in below(c)]

    assert sorted(below(0)) == list(range(500)) and tree.count.max() <= 8
    for k in range(len(tree.leaf)):
        assert mt._distances(lifted[below(k)], lifted[[tree.centre[k]]]).max() <= tree.radius[k] + 1e-3
        a, b = int(tree.first[k]), int(tree.first[k] + tree.count[k])
        entries, known = (np.arange(a, b), tree.near[a:b]) if tree.leaf[k] else (tree.centre[a:b], tree.above[a:b])
        assert np.allclose(mt._distances(lifted[entries], lifted[[tree.centre[k]]])[:, 0], known, atol=1e-3)
