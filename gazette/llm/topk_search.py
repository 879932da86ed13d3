"""Exact top-k inner products over integer vectors.

Candidates are range-sorted by descending length and searched in groups
against groups of queries.  Both are rotated by the right singular vectors of
all candidates, so a few leading coordinates carry most of a product; the
Cauchy-Schwarz bound of the rest (residual length times residual length)
discards a candidate that cannot reach a query's k-th best score so far.  The
longest candidates give every query a first threshold.  Survivors are scored
exactly in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.llm.common import materialise, name_of

#: Rows of a candidate group, of a query group, and of the block that is bounded at once.
CANDIDATES, QUERIES, BLOCK = 32_768, 4_096, 1_024
#: Coordinates of the partial product, as a share of all.
LEADING = 4


def _matrix(lists: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), np.int64)
    for i, values in enumerate(lists):
        out[i, : len(values)] = values
    return out


def _gram(width: int):
    """Cells of the sum of outer products, one set for each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column("q").to_pylist(), width).astype(np.float64)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width * width)), pa.array(total.ravel())], ["cell", "value"]
        )

    return run


def _blocks(width: int):
    """Rows of a range partition as blocks, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                cut = batch.slice(at, BLOCK)
                ids = cut.column("id").to_numpy(zero_copy_only=False).astype("<i8")
                m = _matrix(cut.column("q").to_pylist(), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int64()),
                        pa.array([ids.tobytes()], pa.binary()),
                        pa.array([m.astype("<i8").tobytes()], pa.binary()),
                        pa.array([float(np.sqrt((m.astype(float) ** 2).sum(1).max()))]),
                    ],
                    ["part", "ids", "rows", "longest"],
                )

    return run


class Side:
    """Vectors with what their bounds need."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, rotation: np.ndarray) -> None:
        self.ids, self.rows = ids, rows
        turned = rows.astype(np.float64) @ rotation
        lead = max(1, rows.shape[1] // LEADING)
        self.lead = turned[:, :lead]
        self.rest = np.sqrt((turned[:, lead:] ** 2).sum(1))
        self.length = np.sqrt((turned**2).sum(1))
        self.largest = int(np.abs(rows).max(initial=0))


def products(a: Side, b: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact products of the pairs (a[i], b[j])."""
    if len(i) * LEADING * 4 > len(a.ids) * len(b.ids) and a.largest * b.largest * a.rows.shape[1] < 2**53:
        return (a.rows.astype(np.float64) @ b.rows.astype(np.float64).T)[i, j].astype(np.int64)
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), 65_536):
        out[at : at + 65_536] = np.einsum("ij,ij->i", a.rows[i[at : at + 65_536]], b.rows[j[at : at + 65_536]])
    return out


class Best:
    """The k best (score, then smaller id) of each query so far."""

    def __init__(self, queries: Side, k: int) -> None:
        self.queries, self.k = queries, k
        self.floor = np.full(len(queries.ids), -np.inf)
        self.found: list[list[tuple[int, int]]] = [[] for _ in queries.ids]

    def offer(self, cands: Side, collect: bool = True) -> None:
        q = self.queries
        reach = q.lead @ cands.lead.T + np.outer(q.rest, cands.rest)
        slack = 1e-9 * np.outer(q.length, cands.length) + 1e-6
        i, j = np.nonzero(reach + slack >= self.floor[:, None])
        other = q.ids[i] != cands.ids[j]
        i, j = i[other], j[other]
        score = products(q, cands, i, j)
        order = np.lexsort((cands.ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        first = np.searchsorted(i, np.arange(len(q.ids)))
        rank = np.arange(len(i)) - first[i]
        near = rank < self.k
        for n, c, s in zip(i[near].tolist(), cands.ids[j[near]].tolist(), score[near].tolist()):
            self.found[n].append((-s, c))
        for n in np.unique(i).tolist():
            best = sorted(self.found[n])[: self.k]
            if len(best) == self.k:
                self.floor[n] = max(self.floor[n], -best[-1][0])
            self.found[n] = best if collect else []


def _search(rotation: np.ndarray, width: int, k: int, head: Side):
    def run(cands: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list[int]] = [[], [], []]
        if cands.num_rows and queries.num_rows:
            q = Side(queries.column("id").to_numpy(), _matrix(queries.column("q").to_pylist(), width), rotation)
            best = Best(q, k)
            best.offer(head, collect=False)
            blocks = sorted(
                zip(*(cands.column(c).to_pylist() for c in ("longest", "ids", "rows"))), key=lambda b: -b[0]
            )
            for longest, ids, rows in blocks:
                if (q.length * longest * (1 + 1e-9) + 1e-6 < best.floor).all():
                    break
                numbers = np.frombuffer(ids, "<i8")
                best.offer(Side(numbers, np.frombuffer(rows, "<i8").reshape(len(numbers), width), rotation))
            for query, found in zip(q.ids.tolist(), best.found):
                for negative, cand in found:
                    for column, value in zip(out, (query, cand, -negative)):
                        column.append(value)
        return pa.table([pa.array(c, pa.int64()) for c in out], ["query_id", "vec_id", "score"])

    return run


def usable(vector: Column) -> Column:
    """No null vector, no null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def quantised(vector: Column) -> Column:
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * 256).cast("bigint"))


def topk(spark: SparkSession, table: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of (id, q) rows, where q
    are integer vectors and ``is_query`` picks the queries.

    Shorter vectors count as padded with zeros.  Rows with a null id take no
    part.  A repeated id is one query (its smallest vector) and excludes all
    rows of that id from its own result; repeated candidates keep a rank each.
    Scores must fit a long.  Without queries or candidates there are no rows.
    """
    table = materialise(spark, table.filter("id IS NOT NULL"), "search-vectors")
    n, width = table.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("q")), F.lit(0))).first()
    empty = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not n:
        return spark.createDataFrame([], empty)
    width = max(width, 1)
    cells = table.mapInArrow(_gram(width), "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("v"))
    gram = np.zeros(width * width)
    for r in cells.collect():  # width * width rows
        gram[r["cell"]] = r["v"]
    gram = gram.reshape(width, width)
    rotation = np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1].copy()

    squares = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    groups = max(1, -(-n // CANDIDATES))
    cands = materialise(
        spark,
        table.withColumn("len2", squares)
        .repartitionByRange(groups, F.desc("len2"), F.col("id"))
        .sortWithinPartitions(F.desc("len2"), "id")
        .select("id", "q")
        .mapInArrow(_blocks(width), "part bigint, ids binary, rows binary, longest double"),
        "search-blocks",
    )
    top = cands.orderBy(F.desc("longest"), "part").first()  # one block
    numbers = np.frombuffer(top["ids"], "<i8")
    head = Side(numbers, np.frombuffer(top["rows"], "<i8").reshape(len(numbers), width), rotation)

    queries = table.filter(is_query).groupBy("id").agg(F.min("q").alias("q"))
    sets = max(1, -(-queries.count() // QUERIES))
    queries = queries.withColumn("qset", F.pmod(F.xxhash64("id"), F.lit(sets)).cast("bigint"))
    last = cands.agg(F.max("part")).first()[0]
    left = cands.withColumn("qset", F.explode(F.sequence(F.lit(0), F.lit(sets - 1)))).withColumn(
        "qset", F.col("qset").cast("bigint")
    )
    right = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(last)))).withColumn(
        "part", F.col("part").cast("bigint")
    )
    found = (
        left.groupBy("part", "qset")
        .cogroup(right.groupBy("part", "qset"))
        .applyInArrow(_search(rotation, width, k, head), "query_id bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(generate_series(1, len(a.q)), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best of every fiftieth vector of ``embeddings`` against all rows."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col(name_of("vec_id")).cast("bigint").alias("id"), F.col(name_of("embedding")).alias("v")
    )
    table = rows.filter(usable(F.col("v"))).select("id", quantised(F.col("v")).alias("q"))
    return topk(spark, table, F.col("id") % 50 == 0)
