"""Importance resampling of documents towards a target collection.

Both collections are bags of hashed word n-grams.  A bucket's gain is the
logarithm of its share in the target over its share in the documents; a
document's weight is the sum of its features' gains.  Gumbel noise from a hash
of the id turns the highest scores into a draw without replacement.

The n-grams come from Arrow kernels: words are dictionary-encoded, shifted
indices pair into codes of longer runs, each distinct run gets its CRC once
(continued from the run it extends), and gains are taken and summed by segment.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.llm.common import bounded_batches, materialise, name_of, slices
from gazette.llm.words import NOT_ALPHANUMERIC, Words, words_of

#: Hash buckets of features, words of the longest feature, seed of the noise.
BUCKETS, LONGEST, SEED = 10_000, 3, 42
#: Words that a document needs to be drawn, per cent of those that are drawn.
LEAST_WORDS, PER_CENT = 20, 5
#: Rows of a partition of the final order.
ORDERED_ROWS = 1 << 20


def _crcs(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, … words: the place of the last word, and the run's CRC."""
    spaced = [b" " + w for w in words.dictionary]
    size = max(len(spaced), 1)
    place = np.arange(len(words.index))
    first = np.array([zlib.crc32(w) for w in words.dictionary], np.uint32)
    run, crc = words.index, first
    yield place, crc[run]
    for _ in range(1, LONGEST):
        # a run that ends here extends the run that ended one word before, in the same segment
        follows = words.segment[place[1:]] == words.segment[place[:-1]]
        follows &= place[1:] == place[:-1] + 1
        code = run[:-1][follows] * size + words.index[place[1:][follows]]
        place = place[1:][follows]
        distinct, run = np.unique(code, return_inverse=True)
        known = crc
        crc = np.fromiter(
            (zlib.crc32(spaced[w], p) for p, w in zip(known[distinct // size].tolist(), (distinct % size).tolist())),
            np.uint32,
            len(distinct),
        )
        yield place, crc[run]


def _features(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(segment, bucket) of every feature; those that end among the words that
    a segment repeats belong to the segment before."""
    starts = np.searchsorted(words.segment, np.arange(len(words.owner)))
    fresh = np.arange(len(words.index)) - starts[words.segment] >= words.lead[words.segment]
    for place, crc in _crcs(words):
        kept = fresh[place]
        yield words.segment[place[kept]], (crc[kept] % BUCKETS).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in slices(batches):
        for words in words_of(batch.column("text"), NOT_ALPHANUMERIC, LONGEST - 1):
            for _, bucket in _features(words):
                total += np.bincount(bucket, minlength=BUCKETS)
    seen = np.nonzero(total)[0]
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])


def _segment_sums(segment: np.ndarray, values: np.ndarray, segments: int) -> np.ndarray:
    out = np.zeros(segments, np.int64)
    if len(segment):
        starts = np.nonzero(np.diff(segment, prepend=-1))[0]
        out[segment[starts]] = np.add.reduceat(values, starts)
    return out


def _weights(gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = np.zeros((3, batch.num_rows), np.int64)
            for words in words_of(batch.column("text"), NOT_ALPHANUMERIC, LONGEST - 1):
                n = len(words.owner)
                fresh = np.bincount(words.segment, minlength=n) - words.lead
                np.add.at(out[0], words.owner, fresh)
                for segment, bucket in _features(words):
                    np.add.at(out[1], words.owner, np.bincount(segment, minlength=n))
                    np.add.at(out[2], words.owner, _segment_sums(segment, gains.take(bucket), n))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, out)], ["doc_id", "n_words", "n_features", "weight"]
            )

    return run


def _noise(id_column: Column) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a SHA-256."""
    text = F.concat(F.lit(f"{SEED}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def bucket_counts(texts: DataFrame) -> DataFrame:
    """``(bucket, n)`` of all features of a ``text`` column; a task sends one row a bucket."""
    counted = texts.select("text").mapInArrow(_counts, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of each of the ``BUCKETS`` buckets, unseen ones included."""
    both = bucket_counts(docs).select("bucket", F.col("n").alias("s")).join(
        bucket_counts(target).select("bucket", F.col("n").alias("t")), "bucket", "full"
    )
    s, t = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in both.collect():  # at most BUCKETS rows
        s[r["bucket"]], t[r["bucket"]] = r["s"] or 0, r["t"] or 0
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def numbered(spark: SparkSession, rows: DataFrame, order: list[Column], count: int) -> DataFrame:
    """``rows`` with their ``place`` (from 1) in a total order: range partitions
    are written in order, and the few partition sizes are summed up."""
    parts = max(1, -(-count // ORDERED_ROWS))
    laid = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    laid = materialise(spark, laid.withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", 33)
    sizes = laid.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))  # one row a partition
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.col("at").bitwiseAND((1 << 33) - 1)
    return laid.withColumn("part", part).join(sizes, "part").withColumn("place", F.col("before") + inside + 1)


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of
    ``docs(doc_id, text)``, drawn towards ``target(text)``.

    Null and empty texts, and texts without words, have no features and weight
    0; long texts are read whole, in segments.  Ranks 1, 2, … go by score, then
    smaller doc_id (nulls first, their noise is that of the empty id); repeated
    rows are drawn each for itself, and rows without a rank were not drawn.  An
    empty target leaves only the documents' own frequencies; empty documents
    give an empty result.
    """
    bounded_batches(spark)
    docs, target = docs.select("doc_id", "text"), target.select("text")
    gains = bucket_gains(docs, target)
    kind = docs.schema["doc_id"].dataType.simpleString()
    weighed = docs.mapInArrow(_weights(gains), f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")
    weighed = weighed.withColumn("score", F.col("weight") + _noise(F.col("doc_id")))
    weighed = materialise(spark, weighed, "weights")
    enough = F.col("n_words") >= LEAST_WORDS
    count, eligible = weighed.agg(F.count(F.lit(1)), F.count_if(enough)).first()
    order = [F.desc(enough), F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("weight")]
    rank = F.when(enough & (F.col("place") <= PER_CENT * eligible // 100), F.col("place"))
    return numbered(spark, weighed, order, count).select(
        "doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank")
    )


#: DuckDB has no CRC: the table of its 256 byte steps comes from the polynomial,
#: and all distinct features advance one byte a round.
ORACLE = r"""
WITH RECURSIVE steps(b, c, k) AS (
  SELECT CAST(b AS UBIGINT), CAST(b AS UBIGINT), 0 FROM range(256) r(b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc_table AS (SELECT b, c FROM steps WHERE k = 8),
texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', CAST(NULL AS BIGINT), text FROM benchmark),
lists AS (
  SELECT row_number() OVER () AS r, side, id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
runs AS (
  SELECT r, array_to_string(w[i : i + n - 1], ' ') AS f
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM lists CROSS JOIN (VALUES (1), (2), (3)) s(n))),
counted AS (SELECT r, f, count(*) AS m FROM runs GROUP BY r, f),
spelled AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)),
crc(f, h, pos, c) AS (
  SELECT f, h, 1, 4294967295::UBIGINT FROM spelled
  UNION ALL
  SELECT f, h, pos + 2, xor(crc.c >> 8, t.c)
  FROM crc JOIN crc_table t ON t.b = xor(crc.c & 255, CAST('0x' || substr(h, pos, 2) AS UBIGINT))
  WHERE pos < len(h)),
hashed AS (SELECT f, CAST(xor(c, 4294967295::UBIGINT) % 10000 AS BIGINT) AS bucket FROM crc WHERE pos > len(h)),
features AS (SELECT r, bucket, sum(m) AS m FROM counted JOIN hashed USING (f) GROUP BY r, bucket),
counts AS (
  SELECT bucket, coalesce(sum(m) FILTER (WHERE side = 'd'), 0) AS s, coalesce(sum(m) FILTER (WHERE side = 'b'), 0) AS t
  FROM features JOIN lists USING (r) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM counts),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000)))) AS BIGINT) AS gain
  FROM counts, totals),
weighed AS (
  SELECT l.r, l.id AS doc_id, len(l.w) AS n_words, coalesce(sum(f.m), 0) AS n_features, coalesce(sum(f.m * g.gain), 0) AS weight
  FROM lists l LEFT JOIN features f ON f.r = l.r LEFT JOIN gains g ON g.bucket = f.bucket
  WHERE l.side = 'd' GROUP BY ALL),
scored AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5)
         / 4294967296.0))) AS BIGINT) AS score FROM weighed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) FILTER (WHERE n_words >= 20) OVER () AS eligible FROM scored)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight,
       CAST(score AS BIGINT) AS score,
       CASE WHEN n_words >= 20 AND place <= (5 * eligible) // 100 THEN CAST(place AS BIGINT) END AS rank
FROM placed
"""


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` weighed and drawn towards the texts of ``benchmark``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resample(
        spark,
        docs.select(docs[name_of("doc_id")].cast("bigint").alias("doc_id"), docs[name_of("text")].alias("text")),
        target.select(target[name_of("text")].alias("text")),
    )
