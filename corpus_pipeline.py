"""The corpus pipeline: language ID, exact and near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import materialise, name_of
from gazette.llm.exact_dedup import exact_dedup
from gazette.llm.language_id import UNKNOWN, has_letter, held_out, predictor, train
from gazette.llm.near_dedup import near_dedup
from gazette.llm.packing import pieces


def _kept(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.filter("kept").select(*[F.col("row")[c].alias(c) for c in columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is undetermined (no letter at all).  If
    no label taught a language, that is decided without a model."""
    model = train(spark, docs.filter(~held_out(docs["doc_id"])))
    if not model.languages:
        return docs.filter(has_letter(docs["text"]))
    whole = docs.select(
        F.struct(*[docs[name_of(c)].alias(c) for c in docs.columns]).alias("row"),
        predictor(model)(docs["text"]).alias("guess"),
    )
    return whole.filter(F.col("guess.lang_pred") != UNKNOWN).select(
        *[F.col("row")[c].alias(c) for c in docs.columns]
    )


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each text."""
    return _kept(exact_dedup(spark, docs, carry=tuple(docs.columns)), docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate component."""
    return _kept(near_dedup(spark, docs, carry=tuple(docs.columns)), docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into training sequences."""
    return pieces(spark, docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("packing", packing_stage),
]

#: Near duplicates and the tokenizer are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
