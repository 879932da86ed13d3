"""The pipeline against brute force, and the registration of the queries."""

import re

import corpus_pipeline
import public_tokenizers
from conftest import SF_SMALL
from llm_tables import awkward, nothing  # noqa: F401
from test_llm_dedup import brute_components, lower
from test_llm_tokens import check_packing
from tokenizers import Tokenizer

import __spark_entry__ as entry


def brute_kept(rows):
    """Documents that the three filtering stages keep."""
    rows = [r for r in rows if r.text and any(c.isalpha() for c in r.text)]
    last = {}
    for r in rows:
        last[lower(r.text)] = max(r.doc_id, last.get(lower(r.text), r.doc_id))
    texts = {r.doc_id: r.text for r in rows if last[lower(r.text)] == r.doc_id}
    return {i: texts[i] for i, (_, c) in brute_components(texts).items() if c == i}


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    kept = brute_kept(docs.collect())
    assert {r.doc_id for r in got} == kept.keys()
    check_packing(got, kept, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))


def test_stages_keep_the_columns(spark, awkward):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, awkward, SF_SMALL)
        assert out.columns == awkward.columns, name
        assert 0 < out.count() < awkward.count(), name
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, awkward.limit(0), SF_SMALL).count() == 0, name


def test_registered():
    names = entry.queries()
    assert [n for n in range(1, 11) if not any(re.match(rf"op{n}_", x) for x in names)] == []
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
    assert len(corpus_pipeline.STAGES) == 4
