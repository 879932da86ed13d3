"""Publishing: a reader sees one whole run, whatever happens to the writer."""

import os

import pytest
from pyspark.sql import functions as F

from gazette.operators import sinks as S


def rows(spark, n, mark):
    return spark.range(n).select("id", F.lit(mark).alias("mark"), F.array().cast("array<string>").alias("reasons"))


def marks(df):
    return {(r.namespace, r.mark, r.n) for r in df.groupBy("namespace", "mark").agg(F.count(F.lit(1)).alias("n")).collect()}


def failing(df):
    """Its last row ends the job, after other tasks have written their files."""
    bad = F.when(F.col("id") == 99, F.raise_error(F.lit("broken capture")).cast("string")).otherwise(F.col("mark"))
    return df.repartition(4, "id").withColumn("mark", bad)


def test_a_failed_run_leaves_the_former_one(spark, scratch):
    table = os.path.join(scratch, "t")
    S.write_namespace(rows(spark, 5, "first"), table, "news")
    with pytest.raises(Exception, match="broken capture"):
        S.write_namespace(failing(rows(spark, 100, "second")), table, "news")
    assert marks(S.read_live(spark, table)) == {("news", "first", 5)}
    # the candidates are whole, but the outcome fails: the run as a whole is not live
    with pytest.raises(Exception, match="broken capture"):
        S.write_namespace(rows(spark, 7, "third"), table, "news", failing(rows(spark, 100, "outcome")))
    assert marks(S.read_live(spark, table)) == {("news", "first", 5)}
    # the writer dies between its last file and the marker
    S.stage(rows(spark, 9, "fourth").withColumn("status", F.lit("valid")), table, "news", "f" * 32)
    assert marks(S.read_live(spark, table)) == {("news", "first", 5)}
    S.write_namespace(rows(spark, 3, "fifth"), table, "news")
    assert marks(S.read_live(spark, table)) == {("news", "fifth", 3)}


def test_readers_during_a_run_see_one_version(spark, scratch):
    table = os.path.join(scratch, "t")
    for mark in ("old", "new"):
        before = S.live_runs(spark, table) if mark == "new" else None
        S.write_namespace(rows(spark, 4, mark), table, "a", rows(spark, 1, mark))
        S.write_namespace(rows(spark, 6, mark), table, "b", rows(spark, 2, mark))
    assert marks(S.read_live(spark, table)) == {("a", "new", 4), ("b", "new", 6)}
    assert marks(S.read_live(spark, table, S.OUTCOMES)) == {("a", "new", 1), ("b", "new", 2)}
    # a reader that resolved its runs before keeps them, for both parts
    assert marks(S.read_live(spark, table, runs=before)) == {("a", "old", 4), ("b", "old", 6)}
    assert marks(S.read_live(spark, table, S.OUTCOMES, before)) == {("a", "old", 1), ("b", "old", 2)}


def test_writers_of_one_version_agree_on_the_live_run(spark, scratch):
    table = os.path.join(scratch, "t")
    S.write_namespace(rows(spark, 1, "x"), table, "n")
    runs = ("a" * 32, "b" * 32)
    for run in runs:
        S.stage(rows(spark, 2, run[0]).withColumn("status", F.lit("valid")), table, "n", run)
    live = os.path.join(table, "_live", "namespace=n")
    for run in reversed(runs):  # both saw version 1 as the last
        open(os.path.join(live, f"{2:020d}-{run}"), "w").close()
    assert S.live_runs(spark, table) == {"n": "b" * 32}
    run = S.write_namespace(rows(spark, 3, "y"), table, "n")
    assert S.versions(spark, table, "n")[-1] == (3, run) and marks(S.read_live(spark, table)) == {("n", "y", 3)}
    with pytest.raises(Exception, match="exists"):
        S.switch_live(spark, table, "n", run) and S._hadoop(spark, table)[0].create(
            spark._jvm.org.apache.hadoop.fs.Path(f"{live}/{3:020d}-{run}"), False
        )


def test_empty_runs_and_unknown_tables(spark, scratch):
    table = os.path.join(scratch, "t")
    with pytest.raises(FileNotFoundError):
        S.read_live(spark, table)
    S.write_namespace(rows(spark, 0, "none"), table, "empty")
    assert S.read_live(spark, table).count() == 0 and "status" in S.read_live(spark, table).columns
    for bad in ("", "../x", "a/b", "_live"):
        with pytest.raises(ValueError):
            S.write_namespace(rows(spark, 1, "x"), table, bad)


def test_expiry_keeps_what_readers_need(spark, scratch):
    table = os.path.join(scratch, "t")
    runs = [S.write_namespace(rows(spark, 2, str(i)), table, "n", rows(spark, 1, str(i))) for i in range(4)]
    S.stage(rows(spark, 1, "dead"), table, "n", "d" * 32)
    assert S.expire_runs(spark, table, "n", keep=2) == sorted(runs[:2])  # a young unmarked run may still be written
    assert S.expire_runs(spark, table, "n", keep=2, grace_hours=-1) == ["d" * 32]
    assert marks(S.read_live(spark, table)) == {("n", "3", 2)}
    assert marks(S.read_live(spark, table, S.OUTCOMES, {"n": runs[2]})) == {("n", "2", 1)}
    assert [r for _, r in S.versions(spark, table, "n")] == runs[2:]
    with pytest.raises(ValueError):
        S.expire_runs(spark, table, "n", keep=0)
