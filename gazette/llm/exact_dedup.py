"""Exact duplicates by distributed MSD radix partitioning.

A document's key is its length followed by its bytes (A-Z lower-cased).  The
first digit (length and ``FIRST`` bytes) splits all documents; groups of one
are done.  Each further level splits the remaining groups by their next
``WIDTHS`` bytes, until every group is a singleton or its key has ended.  No
digest decides equality; the SHA-256 in the result is output only.

Digits are counted with map-side combine and joined back, so a group of copies
never meets in one task (AQE splits the skewed side of the join).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import ascii_lower, bounded_batches, materialise, name_of

FIRST = 32
WIDTHS = (4096, 1 << 16, 1 << 20, 1 << 24, 1 << 28)


def _widths() -> Iterator[int]:
    yield from WIDTHS
    while True:
        yield WIDTHS[-1]


def exact_dedup(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One row per input row: ``row`` (struct of the ``carry`` columns),
    ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Of equal texts the row with the largest id stays.  Null text equals empty
    text.  Null ids are smallest; of rows that also share the id (repeated
    rows) exactly one stays.  An empty table gives no rows.  Extra columns
    travel inside ``row`` only, so their names cannot clash.
    """
    bounded_batches(spark)
    text = docs[name_of(text_col)]
    body = ascii_lower(text)
    scan = docs.select(
        F.struct(*[docs[name_of(c)].alias(c) for c in carry]).alias("row"),
        docs[name_of(id_col)].alias("id"),
        text.alias("text"),
        body.alias("body"),
    )
    first = scan.select(
        "row",
        "id",
        "text",
        F.sha2("body", 256).alias("sha"),
        F.octet_length("body").cast("long").alias("n"),
        F.substring("body", 1, FIRST).alias("digit"),
    )
    sizes = first.groupBy("n", "digit").agg(F.count(F.lit(1)).alias("size"))
    open_text = F.when(F.col("size") > 1, F.col("text"))
    split = (
        first.join(sizes, ["n", "digit"])
        .select("row", "id", "sha", "n", "digit", "size", ascii_lower(open_text).alias("body"))
        .select(
            F.monotonically_increasing_id().alias("uid"),
            "row",
            "id",
            "sha",
            "n",
            "size",
            F.concat(F.col("n").cast("string").cast("binary"), F.lit(b":"), "digit").alias("grp"),
            F.expr(f"substring(body, {FIRST + 1})").alias("rest"),
        )
    )
    split = materialise(spark, split, "radix-0")
    alone = split.filter("size = 1")
    active = split.filter("size > 1").select("uid", "id", "grp", "rest")
    longest = split.filter("size > 1").agg(F.max("n")).first()[0] or 0

    done, widths, level = FIRST, _widths(), 0
    while done < longest:
        width, level = next(widths), level + 1
        cut = active.select(
            "uid",
            "id",
            "grp",
            F.substring("rest", 1, width).alias("digit"),
            F.expr(f"substring(rest, {width + 1})").alias("rest"),
        )
        sizes = cut.groupBy("grp", "digit").agg(
            F.min("uid").alias("gid"), F.count(F.lit(1)).alias("size")
        )
        active = materialise(
            spark,
            cut.join(sizes, ["grp", "digit"]).select(
                "uid",
                "id",
                F.col("gid").cast("string").cast("binary").alias("grp"),
                F.when(F.col("size") > 1, F.col("rest")).otherwise(F.lit(b"")).alias("rest"),
            ),
            f"radix-{level}",
        )
        done += width

    groups = active.groupBy("grp").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct("id", (-F.col("uid")).alias("back"))).alias("best"),
    )
    decided = active.join(groups, "grp").select(
        "uid",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("uid") == -F.col("best.back")).alias("kept"),
    )
    copies = (
        split.filter("size > 1")
        .select("uid", "row", "sha")
        .join(decided, "uid")
        .select("row", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))
    )
    return alone.select(
        "row",
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"),
    ).unionByName(copies)


ORACLE = """
WITH d AS (
  SELECT doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with the row that stays for its text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return exact_dedup(spark, docs).select(
        "row.doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )
