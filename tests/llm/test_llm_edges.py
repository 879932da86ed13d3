"""Extra checks of the corpus operators: long texts, hot groups, determinism."""

import numpy as np
from pyspark.sql import functions as F

from gazette.llm import exact_dedup as exact
from gazette.llm import near_dedup as near
from gazette.llm.sentence_pieces import sentence_pieces
from gazette.llm.token_counts import token_counts


def test_hot_groups_of_copies(spark):
    """A third of all rows are copies of one text; nothing is lost or capped."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, words).otherwise(F.concat(F.lit(words + " "), F.col("id"), F.lit(" a b c d e f g h"))).alias("text"),
    )
    rows = exact.exact_dedup(spark, docs).select("row.doc_id", "keep_id", "group_size", "kept").collect()
    assert {r.group_size for r in rows if r.doc_id % 3 == 0} == {200} and sum(r.kept for r in rows) == 401
    assert {r.keep_id for r in rows if r.doc_id % 3 == 0} == {597}
    near_rows = near.near_dedup(spark, docs).select("row.doc_id", "component_id", "kept").collect()
    assert len(near_rows) == 600
    assert {r.component_id for r in near_rows if r.doc_id % 3 == 0} == {0}


def test_very_long_text(spark):
    long = "lorem ipsum dolor sit amet " * 60_000
    docs = spark.createDataFrame([(1, long), (2, long.upper()), (3, "x" * 300_000)], "doc_id long, text string")
    assert exact.exact_dedup(spark, docs).filter("kept").count() == 2
    sizes = {r.id: (r.n_bytes, r.n_tokens) for r in token_counts(docs).collect()}
    assert sizes[1][0] == len(long) and sizes[3][0] == 300_000 and sizes[1][1] > 300_000
    assert sentence_pieces(docs.filter("doc_id < 3")).filter("decoded <> text").count() == 0
    assert near.near_dedup(spark, docs).filter("kept").count() == 2


def test_same_result_whatever_the_partitions(spark):
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 4)) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(words, 12))) for i in range(80)] + [(100 + i, " ".join(words[:40] + [str(i)])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    results = [
        sorted(map(tuple, near.near_dedup(spark, docs.repartition(n)).select("row.doc_id", "n_shingles", "component_id", "kept").collect()))
        for n in (1, 5)
    ]
    assert results[0] == results[1]
