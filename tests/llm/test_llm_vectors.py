"""Cover trees and links of near vectors against brute force."""

import collections

import numpy as np
import pytest
from pyspark.sql import types as T

from gazette.llm import cover_tree as trees

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("v", T.ArrayType(T.DoubleType())),
        *[T.StructField(c, T.StringType()) for c in ("num", "cell", "size", "kept")],
    ]
)


def brute(rows, threshold):
    ok = [
        i
        for i, (vec_id, label, v) in enumerate(rows)
        if vec_id is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    n = collections.Counter()
    for a in ok:
        for b in ok:
            x, y = np.array(rows[a][2]), np.array(rows[b][2])
            if a < b and rows[a][1] == rows[b][1] and len(x) == len(y):
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    n[a] += 1
                    n[b] += 1
                    up[root(a)] = root(b)
    least = {}
    for i in ok:
        least[root(i)] = min(rows[i][0], least.get(root(i), rows[i][0]))
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        component = least[root(i)] if i in ok else vec_id
        out.append((vec_id, n[i], component, vec_id is not None and vec_id == component))
    return sorted(map(str, out))


def run(spark, rows, threshold=trees.THRESHOLD):
    table = spark.createDataFrame([(*r, *["x"] * 4) for r in rows], SCHEMA)
    got = trees.near_vectors(spark, table, threshold)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(str(tuple(r)) for r in got.collect())


def cloud(rng, n, width, spread):
    """Clusters of several sizes and widths, chains, and lone vectors."""
    centres = rng.normal(size=(6, width))
    out = [centres[rng.integers(6)] + rng.normal(size=width) * spread * rng.choice([0.01, 0.1, 1]) for _ in range(n)]
    step = np.linspace(0, 1, 12)[:, None]
    return np.concatenate([out, centres[:1] * (1 - step) + centres[1:2] * step, rng.normal(size=(n // 4, width))])


@pytest.mark.parametrize("block, centres", [(4096, 256), (40, 8), (6, 3)])
def test_links_at_any_depth(spark, monkeypatch, block, centres):
    """The whole tree in a task, or most of its levels made by Spark."""
    for name, value in (("BLOCK", block), ("CENTRES", centres), ("DEALT", 50)):
        monkeypatch.setattr(trees, name, value)
    rng = np.random.default_rng(block)
    rows = [(i, "a" if i % 3 else "b", v.tolist()) for i, v in enumerate(cloud(rng, 150, 5, 0.2))]
    rows += [(1000 + i, "a", rows[1][2]) for i in range(60)]  # copies
    rows += [(2000 + i, "a", (np.array(rows[4][2]) * (1 + i)).tolist()) for i in range(30)]  # one direction
    assert run(spark, rows) == brute(rows, trees.THRESHOLD)


def test_awkward_vectors(spark):
    rows = [
        (1, "a", [1.0, 0.0]),
        (2, "a", [1.0, 0.0]),
        (2, "a", [1.0, 0.0]),
        (2, "a", [0.0, 3.0]),
        (3, "a", [1e300, 1e290]),
        (4, "a", [1e-300, 0.0]),
        (5, "a", [-0.0, 5.0]),
        (6, "a", [0.0, 0.0]),
        (7, "a", None),
        (8, "a", []),
        (9, "a", [1.0, None]),
        (10, "a", [float("nan"), 1.0]),
        (11, "a", [float("inf"), 1.0]),
        (12, None, [1.0, 0.0]),
        (None, "a", [1.0, 0.0]),
        (13, "b", [1.0, 0.0]),
        (14, "a", [1.0, 0.0, 0.0]),
        (15, "a/1", [1.0, 0.0]),
        (16, "", [1.0, 0.0]),
        (17, "", [1.0, 0.01]),
    ]
    assert run(spark, rows) == brute(rows, trees.THRESHOLD)
    assert run(spark, []) == []


def test_a_third_of_all_rows_are_copies(spark):
    rng = np.random.default_rng(8)
    rows = [(i, "a", [1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(900)]
    assert run(spark, rows, 0.9999) == brute(rows, 0.9999)


def test_tree_is_nested_and_covers(monkeypatch):
    rng = np.random.default_rng(1)
    points = trees.unit(cloud(rng, 400, 4, 0.3))
    tree = trees.Tree.grow(points)
    below = {}

    def visit(node):
        inner = [] if tree.count[node] == 0 else list(tree.children(node))
        if inner:
            assert tree.centre[inner[0]] == tree.centre[node]
            assert all(tree.radius[c] <= max(tree.radius[node], 1e-12) for c in inner)
        below[node] = [tree.centre[node]] if not inner else [p for c in inner for p in visit(c)]
        far = trees.chord(points[below[node]] @ points[tree.centre[node]])
        assert far.max() <= tree.radius[node] + trees.SLACK
        return below[node]

    assert sorted(visit(0)) == list(range(len(points)))
    block = trees.Block(np.arange(len(points)), np.ones(len(points), np.int64), points, tree)
    assert np.array_equal(trees._unpack(trees._pack(block)).rows, points)


def test_traversal_leaves_far_pairs(monkeypatch):
    """Tight clusters: far fewer products than pairs."""
    rng = np.random.default_rng(2)
    centres = trees.unit(rng.normal(size=(40, 16)))
    points = trees.unit(np.repeat(centres, 50, 0) + rng.normal(size=(2000, 16)) * 0.002)
    block = trees.Block(np.arange(2000), np.ones(2000, np.int64), points)
    products = []
    plain = trees.chord
    monkeypatch.setattr(trees, "chord", lambda c: products.append(np.size(c)) or plain(c))
    found = trees.dual_traversal(block, block, 0.98)
    assert (found.n == 49).all() and sum(products) < 2000 * 2000 / 10
