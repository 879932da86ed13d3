"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import materialise, release


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang every node's larger (large star) or smaller-or-equal (small star)
    neighbours on the smallest node of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.filter("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hung = both.join(least, "u")
    if large:
        rows = hung.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        rows = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return rows.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``; the root is the
    smallest node that it reaches.  Stops when a round changes nothing."""
    edges = materialise(
        spark,
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )

    def mark(df: DataFrame) -> tuple:
        return tuple(
            df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        )

    before = mark(edges)
    while before[0]:
        former = edges
        edges = materialise(spark, _star(_star(former, True), False), "stars")
        release(spark, former)
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def extend(spark: SparkSession, roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` as ``components`` gave them (and as a written table), with more
    links: only these are contracted, between the roots that they connect."""
    name = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
    between = links.join(name("a"), "a", "left").join(name("b"), "b", "left").select(
        F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")
    )
    merged = components(spark, between).withColumnRenamed("root", "top")
    moved = roots.join(merged.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    known = roots.select("node")
    return moved.unionByName(merged.join(known, "node", "left_anti").select("node", F.col("top").alias("root")))
