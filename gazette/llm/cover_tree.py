"""Exact near duplicates of vectors by dual traversal of cover trees.

Vectors of one label are compared by their chords on the unit sphere.  A tree's
levels are nested (a node's centre is the centre of one of its children) and their radii
halve; two nodes whose centres are further apart than both covering radii and
the chord of the threshold hold no link, and their pair is left.

The upper levels are made by Spark: a cell with more than ``BLOCK`` vectors is
split around centres taken from a bounded sample of it, every vector goes to
its nearest centre, and the covering radius is measured over all of them, so
bounds hold whatever the sample was.  A cell that is small enough becomes a
block with a tree of its own.  Pairs of cells descend level by level; the pairs of
blocks that are left descend in tasks, down to single vectors.

Equal vectors are one class from the start, so groups of copies cost nothing.
A task sends each vector's number of links and its root within the two blocks,
never the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.llm.common import bounded_batches, look_up, materialise, name_of
from gazette.llm.components import components

THRESHOLD = 0.98
#: Vectors of a block; centres of a cell, at most; vectors that one task deals to centres.
BLOCK, CENTRES, DEALT = 4096, 256, 1 << 16
#: Radii of the distributed levels.  Below the last, all vectors of a cell are near each other.
RADII = (1.0, 0.5, 0.25, 0.125, 0.0625)
#: Centres after which a node that covers too little keeps its other vectors as single children.
TRIED = 64
#: Rounding that bounds allow for; products this close to the threshold are computed anew.
SLACK, CLOSE = 1e-7, 1e-9
#: Rows of matrix products at a time; classes of copies whose rows are looked up in a broadcast table.
TILE, OFTEN = 1024, 1000


def chord(cosine: float | np.ndarray) -> float | np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows, each scaled by a power of two so that squares neither overflow nor vanish."""
    rows = len(column)
    flat = pa.chunked_array(column).combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    out = np.array(flat, np.float64).reshape(rows, -1)
    return out / np.exp2(np.frexp(np.abs(out).max(axis=1, initial=0))[1])[:, None] if rows else out


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows**2).sum(1))[:, None]


class Tree:
    """A cover tree over the rows of a matrix of unit vectors.

    Node 0 is the root; ``first`` and ``count`` give each node's children,
    which stand together.  A node without children is a single vector.
    """

    def __init__(self, centre: np.ndarray, radius: np.ndarray, first: np.ndarray, count: np.ndarray) -> None:
        self.centre, self.radius, self.first, self.count = centre, radius, first, count

    @classmethod
    def grow(cls, points: np.ndarray) -> Tree:
        centre, radius, first, count = [0], [0.0], [0], [0]
        todo = [(0, np.arange(len(points)), chord(points @ points[0]), 2.0)]
        while todo:
            node, members, far, r = todo.pop()
            radius[node] = float(far.max())
            if len(members) == 1:
                continue
            while r >= radius[node] and r > RADII[-1]:
                r /= 2
            first[node] = len(centre)
            left, tried = members, 0
            while len(left):
                if tried == TRIED and len(left) > len(members) // 2 or r <= RADII[-1]:
                    children = [(left[i : i + 1], np.zeros(1)) for i in range(len(left))]
                    left = left[:0]
                else:
                    away = chord(points[left] @ points[left[0]])
                    away[0] = 0
                    inside = away <= r
                    children = [(left[inside], away[inside])]
                    left, tried = left[~inside], tried + 1
                for inner, away in children:
                    count[node] += 1
                    if len(inner) > 1:
                        todo.append((len(centre), inner, away, r))
                    centre.append(int(inner[0]))
                    radius.append(0.0)
                    first.append(0)
                    count.append(0)
        return cls(np.array(centre), np.array(radius), np.array(first), np.array(count))

    def children(self, node: int) -> np.ndarray:
        if not self.count[node]:
            return np.array([node])
        return np.arange(self.first[node], self.first[node] + self.count[node])


class Block:
    """Vectors with their numbers, class sizes and tree."""

    def __init__(self, numbers: np.ndarray, sizes: np.ndarray, rows: np.ndarray, tree: Tree | None = None) -> None:
        self.numbers, self.sizes, self.rows = numbers, sizes, rows
        self.unit = unit(rows)
        self.tree = tree or Tree.grow(self.unit)


class Links:
    """Numbers of links and roots of the vectors of two blocks (or of one)."""

    def __init__(self, numbers: np.ndarray) -> None:
        self.n = np.zeros(len(numbers), np.int64)
        self.up = list(range(len(numbers)))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, members: np.ndarray) -> None:
        roots = {self.root(i) for i in members.tolist()}
        least = min(roots)
        for r in roots:
            self.up[r] = least

    def add(self, hit: np.ndarray, i: np.ndarray, j: np.ndarray, sizes_i: np.ndarray, sizes_j: np.ndarray) -> None:
        """Count the links hit[a, b] between i[a] and j[b], and join what they connect."""
        rows, columns = hit.any(1), hit.any(0)
        hit, i, j, sizes_i, sizes_j = hit[rows][:, columns], i[rows], j[columns], sizes_i[rows], sizes_j[columns]
        np.add.at(self.n, i, hit @ sizes_j)
        np.add.at(self.n, j, sizes_i @ hit)
        left = np.ones(len(i), bool)
        while left.any():
            these = np.zeros(len(i), bool)
            these[np.argmax(left)] = True
            reached = 0
            while reached != these.sum():
                reached = these.sum()
                met = hit[these].any(0)
                these |= hit[:, met].any(1)
            self.join(np.concatenate([i[these], j[met]]))
            left &= ~these


def dual_traversal(a: Block, b: Block, threshold: float) -> Links:
    """Links of cosine ``threshold`` between two blocks, or within one (the same object)."""
    same = a is b
    limit = float(chord(threshold)) + SLACK
    out = Links(a.numbers if same else np.concatenate([a.numbers, b.numbers]))
    offset = 0 if same else len(a.numbers)
    todo = [(0, 0)]
    while todo:
        x, y = todo.pop()
        cols = b.tree.children(y)
        for at in range(0, len(kids := a.tree.children(x)), TILE):
            rows = kids[at : at + TILE]
            p, q = a.tree.centre[rows], b.tree.centre[cols]
            cosine = a.unit[p] @ b.unit[q].T
            near = chord(cosine) <= a.tree.radius[rows][:, None] + b.tree.radius[cols] + limit
            one, other = a.tree.count[rows] == 0, b.tree.count[cols] == 0
            single = one[:, None] & other
            if same and x == y:  # each pair of children once; a single vector has no pair with itself
                near &= (rows[:, None] < cols) | ((rows[:, None] == cols) & ~single)
            hit = near & single & (cosine >= threshold - CLOSE)
            for i, j in np.argwhere(hit & (cosine < threshold + CLOSE)):
                u, v = a.rows[p[i]], b.rows[q[j]]
                hit[i, j] = u @ v / (np.sqrt(u @ u) * np.sqrt(v @ v)) >= threshold
            if hit.any():
                out.add(hit, p, q + offset, a.sizes[p], b.sizes[q])
            todo.extend((int(rows[i]), int(cols[j])) for i, j in np.argwhere(near & ~single))
    return out


def _assign(radius: float):
    """Members of a cell to their nearest centre; centres are thinned to be ``radius`` apart."""

    def run(members: pa.Table, centres: pa.Table) -> pa.Table:
        if not members.num_rows:
            return pa.table({c: pa.array([], t) for c, t in _ASSIGNED_TYPES})
        order = np.argsort(centres.column("num").to_numpy())
        around = unit(matrix(centres.column("v")))[order]
        kept: list[int] = []
        for i in range(len(around)):
            if not kept or chord(around[kept] @ around[i]).min() > radius:
                kept.append(i)
        numbers = centres.column("num").to_numpy()[order][kept]
        points = unit(matrix(members.column("v")))
        best, far = np.empty(len(points), np.int64), np.empty(len(points))
        for at in range(0, len(points), TILE):
            cosine = points[at : at + TILE] @ around[kept].T
            best[at : at + TILE] = cosine.argmax(1)
            far[at : at + TILE] = chord(cosine.max(1))
        return pa.table(
            {
                "num": members.column("num"),
                "parent": members.column("cell"),
                "centre": pa.array(numbers[best]),
                "far": pa.array(far),
                "size": members.column("size"),
                "v": members.column("v").cast(pa.list_(pa.float64())),
            }
        )

    return run


_ASSIGNED_TYPES = [
    ("num", pa.int64()),
    ("parent", pa.string()),
    ("centre", pa.int64()),
    ("far", pa.float64()),
    ("size", pa.int64()),
    ("v", pa.list_(pa.float64())),
]
_ASSIGNED = "num bigint, parent string, centre bigint, far double, size bigint, v array<double>"
_BLOCK = "cell string, block string, data binary, radius double, middle array<double>"
_FIELDS = (("numbers", "<i8"), ("sizes", "<i8"), ("centre", "<i4"), ("radius", "<f8"), ("first", "<i4"), ("count", "<i4"))


def _pack(block: Block) -> bytes:
    exact = block.rows.astype("<f4")
    rows = exact if (exact == block.rows).all() else block.rows.astype("<f8")
    parts = [np.array([len(block.numbers), len(block.tree.centre), rows.shape[1], rows.itemsize], "<i8")]
    for name, kind in _FIELDS:
        parts.append(getattr(block if name in ("numbers", "sizes") else block.tree, name).astype(kind))
    return b"".join(p.tobytes() for p in [*parts, rows])


def _unpack(data: bytes) -> Block:
    n, nodes, width, item = np.frombuffer(data, "<i8", 4).tolist()
    at, found = 32, {}
    for name, kind in _FIELDS:
        found[name] = np.frombuffer(data, kind, n if name in ("numbers", "sizes") else nodes, at)
        at += found[name].nbytes
    rows = np.frombuffer(data, f"<f{item}", n * width, at).reshape(n, width).astype(np.float64)
    tree = Tree(found["centre"], found["radius"], found["first"], found["count"])
    return Block(found["numbers"], found["sizes"], rows, tree)


def _block(members: pa.Table) -> pa.Table:
    order = np.argsort(members.column("num").to_numpy())
    numbers, sizes = (members.column(c).to_numpy()[order].astype(np.int64) for c in ("num", "size"))
    block = Block(numbers, sizes, matrix(members.column("v"))[order])
    cell, part = members.column("cell")[0].as_py(), members.column("part")[0].as_py()
    return pa.table(
        {
            "cell": pa.array([cell]),
            "block": pa.array([f"{cell}#{part}"]),
            "data": pa.array([_pack(block)], pa.binary()),
            "radius": pa.array([float(block.tree.radius[0])]),
            "middle": pa.array([block.unit[0].tolist()], pa.list_(pa.float64())),
        }
    )


def _compare(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, other in zip(batch.column("data_a"), batch.column("data_b")):
                a = _unpack(one.as_py())
                b = _unpack(other.as_py()) if other.is_valid else a
                found = dual_traversal(a, b, threshold)
                numbers = a.numbers if a is b else np.concatenate([a.numbers, b.numbers])
                linked = np.nonzero(found.n)[0]
                roots = np.array([found.root(i) for i in linked.tolist()], np.int64)
                columns = (numbers[linked], found.n[linked], numbers[roots] if len(roots) else roots)
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["num", "n", "root"])

    return run


def _near(middle_a: str, radius_a: str, middle_b: str, radius_b: str, limit: float) -> Column:
    cosine = F.aggregate(F.zip_with(middle_a, middle_b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(2 - 2 * cosine, F.lit(0.0))) <= F.col(radius_a) + F.col(radius_b) + F.lit(limit)


def _split(spark: SparkSession, members: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Members with their final ``cell`` and its size ``n``, and each level's
    nodes (node, parent, middle, radius)."""
    done: list[DataFrame] = []
    levels: list[DataFrame] = []
    for radius in (*RADII, None):
        sizes = materialise(spark, members.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), "cells")
        cells, large = sizes.agg(F.count(F.lit(1)), F.count_if(F.col("n") > BLOCK)).first()
        members = look_up(members, sizes, ["cell"], cells)
        if radius is None or not large:
            done.append(members)
            break
        done.append(members.filter(F.col("n") <= BLOCK))
        wide = members.filter(F.col("n") > BLOCK)
        order = Window.partitionBy("cell").orderBy(F.xxhash64("num"), "num")
        wanted = F.least(F.lit(CENTRES), F.ceil(4 * F.col("n") / BLOCK))
        centres = wide.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= CENTRES).filter(F.col("nth") <= wanted)
        centres = materialise(spark, centres.select("cell", "n", "num", "v"), "centres")
        parts = F.ceil(F.col("n") / DEALT)
        dealt = centres.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
        wide = wide.withColumn("part", F.pmod(F.xxhash64("num"), parts))
        assigned = (
            wide.groupBy("cell", "part").cogroup(dealt.select("cell", "part", "num", "v").groupBy("cell", "part")).applyInArrow(_assign(radius), _ASSIGNED)
        )
        assigned = assigned.withColumn("cell", F.concat_ws("/", "parent", F.col("centre").cast("string")))
        assigned = materialise(spark, assigned, "assigned")
        nodes = assigned.groupBy("cell", "parent", "centre").agg(F.max("far").alias("radius"))
        at = centres.select(F.col("cell").alias("parent"), F.col("num").alias("centre"), "v")
        nodes = nodes.join(at, ["parent", "centre"]).select(F.col("cell").alias("node"), "parent", _unit("v").alias("middle"), "radius")
        levels.append(materialise(spark, nodes, "nodes"))
        members = assigned.select("num", "cell", "size", "v")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out, levels


def _unit(vector: str) -> Column:
    v = F.col(vector)
    largest = F.array_max(F.transform(v, lambda x: F.abs(x)))
    scaled = F.transform(v, lambda x: x / largest)
    length = F.sqrt(F.aggregate(scaled, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(scaled, lambda x: x / length)


def _pairs_of_cells(spark: SparkSession, roots: DataFrame, levels: list[DataFrame], limit: float) -> DataFrame:
    """Pairs of final cells (a, b) that may hold a link, by descending from each root's pair with itself."""
    nothing = F.lit(None).cast("array<double>"), F.lit(None).cast("double")
    pairs = roots.select(F.col("cell").alias("a"), F.col("cell").alias("b"))
    for side in "ab":
        pairs = pairs.withColumns({f"middle_{side}": nothing[0], f"radius_{side}": nothing[1]})
    for nodes in levels:
        pairs = pairs.withColumn("same", F.col("a") == F.col("b"))
        for side in "ab":
            inner = nodes.select(
                F.col("parent").alias(side), F.col("node").alias("child"), F.col("middle").alias("m"), F.col("radius").alias("r")
            )
            met = pairs.join(inner, side, "left")
            pairs = met.select(
                F.coalesce("child", side).alias(side),
                F.coalesce("m", f"middle_{side}").alias(f"middle_{side}"),
                F.coalesce("r", f"radius_{side}").alias(f"radius_{side}"),
                *[c for c in pairs.columns if not c.endswith(side)],
            )
        kept = F.coalesce(_near("middle_a", "radius_a", "middle_b", "radius_b", limit), F.lit(True))
        # a cell's pair with itself gives both orders of each pair of children
        once = ~F.col("same") | (F.col("a") <= F.col("b"))
        pairs = materialise(spark, pairs.filter(once & kept).drop("same"), "cell-pairs")
    return pairs.select("a", "b")


def linked(spark: SparkSession, classes: DataFrame, threshold: float) -> DataFrame:
    """``(num, n, root)`` of classes (num, cell, size, v) with links, one row for
    each pair of blocks in which a class has any: vectors that it is linked with there, and a root."""
    limit = float(chord(threshold)) + SLACK
    members, levels = _split(spark, classes.select("num", "cell", "size", "v"))
    members = members.withColumn("part", F.pmod(F.xxhash64("num"), F.ceil(F.col("n") / BLOCK)))
    blocks = members.select("num", "cell", "size", "v", "part").groupBy("cell", "part").applyInArrow(_block, _BLOCK)
    blocks = materialise(spark, blocks, "blocks")
    roots = classes.select("cell").distinct()
    cells = _pairs_of_cells(spark, roots, levels, limit)
    ball = blocks.select("cell", "block", "middle", "radius")
    one, other = (
        ball.select(F.col("cell").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("block", "middle", "radius")]) for s in "ab"
    )
    pairs = cells.join(one, "a").join(other, "b").filter((F.col("a") != F.col("b")) | (F.col("block_a") <= F.col("block_b")))
    pairs = pairs.filter((F.col("block_a") == F.col("block_b")) | _near("middle_a", "radius_a", "middle_b", "radius_b", limit))
    pairs = materialise(spark, pairs.select("block_a", "block_b"), "block-pairs")
    data = [blocks.select(F.col("block").alias(f"block_{s}"), F.col("data").alias(f"data_{s}")) for s in "ab"]
    # a block's pair with itself carries it once
    alone = pairs.filter("block_a = block_b").join(data[0], "block_a").select("data_a", F.lit(None).cast("binary").alias("data_b"))
    both = pairs.filter("block_a <> block_b").join(data[0], "block_a").join(data[1], "block_b").select("data_a", "data_b")
    found = "num bigint, n bigint, root bigint"
    rows = alone.mapInArrow(_compare(threshold), found).unionByName(both.mapInArrow(_compare(threshold), found))
    return materialise(spark, rows, "linked")


def near_vectors(spark: SparkSession, table: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of
    ``table(vec_id, label, v)``.

    Rows of one label and vector length are linked at a cosine of ``threshold``
    or more, repeated rows and repeated ids each as a vector of their own.  A
    null label, and a vector that is null, empty, zero or holds a null or
    non-finite component, links with nothing.  A null id takes no part: no
    link, no component, not kept.  Equal cosines need no order, ids are told
    apart by their component's smallest.  An empty table gives no rows.
    """
    bounded_batches(spark)
    v = F.col("v").cast("array<double>")
    table = table.select("vec_id", F.col("label").cast("string").alias("label"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists("v", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & ~bad & ~zero, F.lit(False))
    table = materialise(spark, table.withColumn("usable", usable), "vectors")
    rows = table.filter("usable")

    key = ["label", "v"]
    classes = rows.groupBy(*key).agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("size"))
    cell = F.concat_ws("|", F.size("v").cast("string"), F.sha2(F.col("label").cast("binary"), 256))
    classes = classes.withColumn("cell", cell).withColumn("num", F.monotonically_increasing_id())
    classes = materialise(spark, classes, "classes")
    found = linked(spark, classes, threshold)

    links = found.groupBy("num").agg(F.sum("n").alias("n"))
    roots = components(spark, found.select(F.col("num").alias("a"), F.col("root").alias("b")))
    roots = roots.select(F.col("node").alias("num"), "root")
    named = roots.join(classes.select("num", "least"), "num")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))  # the hot root combines before the shuffle
    count = rows.count()
    often = F.col("size") > max(1, count // OFTEN)
    joined = _component_ids(roots, least)
    judged = classes.join(links, "num", "left").join(joined, "num", "left").select(
        *key,
        "size",
        (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"),
    )
    judged = materialise(spark, judged, "judged")
    few = judged.filter(often).drop("size")  # at most OFTEN classes
    rest = judged.filter(~often).drop("size")
    copies = rows.join(F.broadcast(few), key)
    others = rows.join(F.broadcast(few.select(*key)), key, "left_anti").join(rest, key)
    lone = table.filter(~F.col("usable")).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    columns = ["vec_id", "n_links", "component_id"]
    out = copies.select(*columns).unionByName(others.select(*columns)).unionByName(lone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _component_ids(roots: DataFrame, least: DataFrame) -> DataFrame:
    """(num, component_id), however many nodes one root has."""
    deal = F.pmod(F.xxhash64("num"), F.lit(16)).cast("int")
    copied = least.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(15))))
    return roots.withColumn("deal", deal).join(copied, ["root", "deal"]).select("num", "component_id")


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (
  SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS length FROM v
  WHERE e IS NOT NULL AND label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.length * b.length) >= 0.98),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, least(v.vec_id, coalesce(m.b, v.vec_id)) AS component_id,
       v.vec_id <= coalesce(m.b, v.vec_id) AS kept
FROM v LEFT JOIN counts c ON c.a = v.vec_id LEFT JOIN least m ON m.a = v.vec_id
"""


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``embeddings`` with its links of cosine 0.98 within its label."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return near_vectors(
        spark,
        rows.select(
            rows[name_of("vec_id")].cast("bigint").alias("vec_id"),
            rows[name_of("label")].alias("label"),
            rows[name_of("embedding")].alias("v"),
        ),
    )
