"""Every registered query against its DuckDB twin (sf0.001), plus the
entry smoke check."""

import datetime as dt
import decimal

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
from gazette.plans.oracles import ORACLES
from gazette.plans.registry import all_queries
from gazette.sources.tables import TABLES, table_path


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, (float, decimal.Decimal)):
        return f"{round(float(v), 6):.6f}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con




def test_every_query_has_a_twin():
    assert set(all_queries()) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = all_queries()[name](spark, SF_SMALL)
    s_rows = df.collect()
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, s_rows) == _rows(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "web_title" in df.columns


def test_nfkc_against_python(spark):
    import unicodedata

    from pyspark.sql import functions as F

    from gazette.functions.text import nfkc
    from gazette.sources.tables import read_table

    docs = read_table(spark, SF_SMALL, "documents", "doc_id", "text")
    marked = docs.withColumn("text", F.concat("text", F.lit(" \u2460\ufb01\uff21\u00b2")))
    for r in marked.unionByName(docs).select("text", nfkc("text").alias("n")).collect():
        assert r.n == unicodedata.normalize("NFKC", r.text)
