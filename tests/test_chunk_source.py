"""The chunk database as a data source: records, pushed filters, pruning."""

import json
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gazette.plans import catalog_db as Q
from gazette.sources import chunkdb as C
from gazette.sources.chunk_source import ChunkDatabase, common, merged, read_chunkdb

from conftest import SF_SMALL

HEADER = ["id", "type", "note"]
NOTES = [None, "plain", 'quo"te', "back\\slash", "Ünï 日本", {"a": [1, 2, {"b": None}]}, [], ["x, y", 1.5], 7, -2.5, True, "", "null", "[1]"]


def write(root, n, size=4, group=2, document=True):
    """A database of n records as the site lays it out; the last chunk ends in half a record."""
    rng = random.Random(n)
    records = [[i, rng.choice(["18", "1", 1, None]), NOTES[i % len(NOTES)]] for i in range(n)]
    version = os.path.join(root, "3", "abc")
    os.makedirs(os.path.join(version, "indexes", "type"))
    for c in range(-(-n // size)):
        flat = [v for r in records[c * size : (c + 1) * size] for v in r]
        folder = os.path.join(version, "data", str(c // group))
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, f"chunk_{c}.json"), "w", encoding="utf-8") as f:
            json.dump(flat + (flat[:1] if c == (n - 1) // size else []), f, ensure_ascii=c % 2 == 0, indent=1 if c % 3 == 0 else None)
    index = []
    for value in ("1", "18"):
        ids = [i for i, r in enumerate(records) if r[1] is not None and str(r[1]) == value]
        cut = [ids[i : i + size] for i in range(0, len(ids), size)]
        index.append({"value": value, "total_records": len(ids), "first_sort_id_per_chunk": [x[0] for x in cut],
                      "last_sort_id_per_chunk": [x[-1] for x in cut]})
    with open(os.path.join(version, "indexes", "type", "index.json"), "w") as f:
        json.dump(index, f)
    meta = {"header": HEADER, "indexes": ["type"] if document else [], "chunk_size": size, "chunk_group_size": group, "total_records": n}
    with open(os.path.join(version, "metadata.json"), "w") as f:
        json.dump(meta, f)
    with open(os.path.join(root, "versions.json"), "w") as f:
        json.dump([{"version": "3", "hash": "abc"}, {"version": "1", "hash": "old"}], f)
    return version, meta


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("n", [0, 1, 57])
def test_records_equal_the_column_decoder(spark, scratch, n):
    version, meta = write(scratch, n)
    got = read_chunkdb(spark, scratch)
    assert got.columns == ["record_id", "chunk_id", *HEADER]
    if n:
        want = C.decode_chunks(C.read_data_chunks(spark, version), HEADER, meta["chunk_size"])
        assert rows(got.drop("chunk_id")) == rows(want)
        named = read_chunkdb(spark, version, ["note"])  # one version's folder, one field
        assert rows(named.drop("chunk_id")) == rows(want.select("record_id", "note"))
    assert got.count() == n
    with pytest.raises(Exception, match="not in the header"):
        read_chunkdb(spark, scratch, ["nothing"]).count()


def test_conditions_mean_what_filters_mean(spark, scratch):
    write(scratch, 57)
    everything = read_chunkdb(spark, scratch)
    plain = spark.createDataFrame(everything.collect(), everything.schema)
    t, i, note = F.col("type"), F.col("record_id"), F.col("note")
    for where, records, condition in (
        ({"type": ["18"]}, None, t == "18"),
        ({"type": ["none"]}, None, t == "none"),
        ({"type": ["1", "18"]}, (5, 30), t.isNotNull() & i.between(5, 30)),
        ({"type": []}, None, F.lit(False)),
        ({"type": ["1"], "note": ["plain", ""]}, None, (t == "1") & note.isin("plain", "")),
        (None, (8, 11), i.between(8, 11)),
        (None, (-5, 0), i <= 0),
        (None, (3, -1), F.lit(False)),
        (None, (50, 10_000), i >= 50),
    ):
        got = read_chunkdb(spark, scratch, where=where, records=records)
        assert rows(got) == rows(plain.filter(condition)), (where, records)
    with pytest.raises(Exception, match="not in the header"):
        read_chunkdb(spark, scratch, where={"nothing": ["1"]}).count()


def test_one_relation_serves_many_scans(spark, scratch):
    write(scratch, 57)
    df = read_chunkdb(spark, scratch)
    everything = rows(df)
    ones, others = df.filter("type = '1'"), df.filter("type <> '1' OR type IS NULL")
    assert rows(ones.unionByName(others)) == everything == rows(df)


def test_only_chunks_that_the_index_names_are_read(spark, scratch):
    version, meta = write(scratch, 57)
    with open(os.path.join(version, "indexes", "type", "index.json")) as f:
        entry = next(e for e in json.load(f) if e["value"] == "18")
    named = {c for lo, hi in zip(entry["first_sort_id_per_chunk"], entry["last_sort_id_per_chunk"]) for c in range(lo // 4, hi // 4 + 1)}

    def planned(**options):
        reader = ChunkDatabase({"path": scratch, "chunksPerPartition": "1", **options}).reader(None)
        return {c for p in reader.partitions() for c in range(p.first, p.last + 1)}

    assert planned() == set(range(15))
    assert planned(where='{"type": ["18"]}') == named
    assert planned(where='{"type": ["18"]}', records="24:35") == {c for c in named if 6 <= c <= 8}
    assert planned(where='{"type": ["none"]}') == set()
    assert planned(where='{"note": ["plain"]}') == set(range(15))  # no index of it: all are read


def test_database_of_events_prunes_by_both_indexes(spark):
    root = Q._clustered_database(spark, SF_SMALL)
    everything = read_chunkdb(spark, root)
    assert everything.rdd.getNumPartitions() > 0
    read = read_chunkdb(spark, root, where={"block": ["3"]})
    assert {r.chunk_id for r in read.select("chunk_id").distinct().collect()} == {7, 8, 9}
    reader = ChunkDatabase({"path": root, "where": '{"block": ["3"]}'}).reader(None)
    assert reader.chunks == [(7, 9)]
    both = read_chunkdb(spark, root, where={"block": ["3"], "event_type": ["click"]})
    assert rows(both) == rows(everything.filter("block = '3' AND event_type = 'click'"))


def test_index_rows_number_values_over_many_partitions(spark, scratch, monkeypatch):
    from gazette.operators import select

    events = spark.range(2000).select(F.concat(F.lit("v"), F.col("id") % 37).alias("value"), F.col("id").alias("sid"))
    C.write_index_rows(C.index_chunk_stats(events, "value", "sid", 10), os.path.join(scratch, "rows"))
    back = C.read_index_rows(spark, os.path.join(scratch, "rows"))
    assert back.agg(F.sum("n_records")).first()[0] == 2000
    values = back.select("value").distinct()
    want = {v: i for i, v in enumerate(sorted(f"v{i}" for i in range(37)))}
    for per_part in (1 << 20, 5):
        numbered = select.global_ordinal(spark, values, [F.col("value")], "at", per_part)
        assert {r.value: r["at"] for r in numbered.collect()} == want
    got = {r.value: r for r in C.index_values(spark, back).collect()}
    assert all(got[v].index_value_id == i for v, i in want.items())
    assert got["v5"].first_sort_id == 5 and got["v5"].last_sort_id == 5 + 37 * 53 and got["v5"].number_of_chunks == 6
    assert select.global_ordinal(spark, values.limit(0), [F.col("value")], "at").count() == 0


intervals = st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(intervals, intervals)
def test_intervals(a, b):
    def ids(x):
        return {i for lo, hi in x for i in range(lo, hi + 1)}

    one, other = merged(a), merged(b)
    assert ids(one) == ids(a) and all(x[1] + 1 < y[0] for x, y in zip(one, one[1:]))
    assert ids(common(one, other)) == ids(a) & ids(b)
