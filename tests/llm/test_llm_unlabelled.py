"""The pipeline's language stage where no label teaches a language."""

import corpus_pipeline
from conftest import SF_SMALL
from llm_tables import awkward, nothing  # noqa: F401
from pyspark.sql import functions as F

from gazette.llm.language_id import held_out


def test_language_stage_keeps_letters_without_labels(spark, awkward):
    order = lambda rows: sorted(map(tuple, rows), key=str)
    unlabelled = F.lit(None).cast("string")
    tables = {
        "no label": awkward.withColumn("lang", unlabelled),
        "labels in the held-out fold": awkward.withColumn("lang", F.when(held_out(F.col("doc_id")), "en").otherwise(unlabelled)),
    }
    for name, docs in tables.items():
        out = corpus_pipeline.language_stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
        letters = [r for r in docs.collect() if any(c.isalpha() for c in r.text or "")]
        assert 0 < len(letters) < docs.count() and order(out.collect()) == order(letters), name
