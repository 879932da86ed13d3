"""How far the sources of a language diverge from each other, and by which words.

Each language's vocabulary comes from ``CountVectorizer`` with a least document
count and no other limit; its sparse document vectors are summed by group, and
pairs of groups are compared on the terms that either of them holds, all other
terms by one product.

``CountVectorizer`` holds its vocabulary on the driver, and that grows with
the corpus.  So terms are dealt by their hash to as many shards as keep each
vocabulary within ``SHARD_TERMS``, and each shard is fitted by itself; terms carry
their language (``lang word``), so one fit serves all languages.  The fit has to know of a term
only whether ``LEAST_DOCUMENTS`` documents hold it.  So a block of documents gives each
language's shard that many rows: the first row has the terms that any of its documents holds, the
second one those that a second document holds, and so on.  A term has as many rows as documents
of the block, up to that number, so over all blocks it has ``LEAST_DOCUMENTS`` rows exactly if
so many documents hold it.  What a group's documents of a block hold is counted first and transformed as rows of
distinct terms, one row for each binary digit of the counts: the vectors times their weights
add up to the same sums as the documents' own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import IllegalArgumentException
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.llm.common import bounded_batches, look_up, materialise, name_of
from gazette.llm.words import NOT_LETTER
from gazette.session import checkpoint_dir

#: Documents of a language that must hold a term; rows of part ``term`` for each group.
LEAST_DOCUMENTS, TERMS = 3, 200
#: CountVectorizer's largest vocabulary.
NO_LIMIT = 2**31 - 1
#: Distinct terms that a shard may have, about; the driver holds those of them that are
#: kept.  One of so many documents is looked at to choose the number of shards.
SHARD_TERMS, LOOKED_AT = 1 << 20, 8
UNIT = 1_000_000_000

#: Rows of documents have weight 0.
_DEALT = "lang string, source string, shard int, counted boolean, weight bigint, terms string"
_LETTER = np.array([c >= 128 or chr(c).isalpha() for c in range(256)])


def _escaped(lang: Column) -> Column:
    """A language without line breaks, which part the terms."""
    return F.replace(F.replace(lang, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _restored(lang: Column) -> Column:
    return F.replace(F.replace(lang, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The row of each word and the words, in the texts' order; words are runs of
    letters (all beyond ASCII count as such), A-Z lower-cased."""
    whole = pc.ascii_lower(texts.cast(pa.large_string()))
    ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    rows = ends - ends[0]
    letter = np.concatenate([[False], _LETTER[data], [False]])
    opens = letter[1:-1] & ~letter[:-2]
    closes = letter[1:-1] & ~letter[2:]
    filled = rows[:-1][np.diff(rows) > 0]  # a text's first letter opens a word, its last one closes one
    opens[filled] = letter[1:-1][filled]
    lasts = rows[1:][np.diff(rows) > 0] - 1
    closes[lasts] = letter[1:-1][lasts]
    starts, stops = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    offsets = np.concatenate([[0], np.cumsum(stops - starts)])
    letters = pa.py_buffer(data[letter[1:-1]].tobytes())
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.tobytes()), letters)
    return np.searchsorted(rows, starts, "right") - 1, words.dictionary_encode()


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash of each word's bytes."""
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    if not len(words):
        return np.zeros(0, np.uint64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]].astype(np.uint64)
    starts, sizes = ends[:-1] - ends[0], np.diff(ends)
    powers = np.cumprod(np.full(sizes.max(), 0x9E3779B97F4A7C15, np.uint64))
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    mixed = np.add.reduceat((data + np.uint64(1)) * powers[place], starts)
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(17)


def _distinct(*columns: np.ndarray, times: np.ndarray | None = None) -> list[np.ndarray]:
    """The distinct rows of columns of numbers, ascending, and how often each occurs."""
    sizes = [int(c.max()) + 1 if len(c) else 1 for c in columns]
    keys = np.zeros(len(columns[0]), np.int64)
    for column, size in zip(columns, sizes):
        keys = keys * size + column
    if times is None:
        keys, times = np.unique(keys, return_counts=True)
    else:
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.diff(keys, prepend=-1) != 0)
        times = np.add.reduceat(times[order], starts) if len(starts) else times
        keys = keys[starts]
    out = [times]
    for size in sizes[::-1]:
        keys, column = np.divmod(keys, size)
        out.insert(0, column)
    return out


def _dealt(shards: int):
    """For each language of a batch, shard and number up to ``LEAST_DOCUMENTS`` one row: the
    terms there that so many documents hold, one a line, each as ``lang word``; and for each
    group of a batch, shard and binary digit of the counts the terms whose count has that digit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, coded = _words(batch.column("text"))
            names = coded.dictionary
            word = coded.indices.to_numpy(zero_copy_only=False)
            homes = (_hashes(names) % np.uint64(shards)).astype(np.int64)
            codes = [batch.column(c).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lang", "source")]
            _, speaks, tongue = np.unique(codes[0], return_index=True, return_inverse=True)
            _, firsts, group = np.unique(codes[0] * (batch.num_rows + 1) + codes[1], return_index=True, return_inverse=True)

            def rows(home: np.ndarray, row: np.ndarray, word: np.ndarray, weight: int) -> pa.RecordBatch:
                starts = np.flatnonzero((np.diff(home, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
                lists = pa.LargeListArray.from_arrays(pa.array(np.append(starts, len(word))), names.take(pa.array(word)))
                first = pa.array(row[starts])
                none, blank, line = (pa.scalar(x, pa.large_string()) for x in ("", " ", "\n"))
                prefix = pc.binary_join_element_wise(batch.column("key").take(first).cast(pa.large_string()), none, blank)
                between = pc.binary_join_element_wise(none, prefix, line)
                terms = pc.binary_join_element_wise(prefix, pc.binary_join(lists, between), none)
                return pa.RecordBatch.from_arrays(
                    [
                        batch.column("lang").take(first),
                        batch.column("source").take(first),
                        pa.array(home[starts].astype(np.int32)),
                        pa.array(np.full(len(starts), weight > 0)),
                        pa.array(np.full(len(starts), weight, np.int64)),
                        terms.cast(pa.string()),
                    ],
                    ["lang", "source", "shard", "counted", "weight", "terms"],
                )

            def by_home(*columns: np.ndarray) -> list[np.ndarray]:
                """Columns, of which the last but one is the word, in the order of the words' shards."""
                order = np.argsort(homes[columns[-2]].astype(np.uint16 if shards <= 1 << 16 else np.int64), kind="stable")
                return [c[order] for c in columns]

            owner, word, times = _distinct(owner, word)
            lang, term, held = by_home(*_distinct(tongue[owner], word))
            for least in range(1, min(int(held.max(initial=0)), LEAST_DOCUMENTS) + 1):
                at = np.flatnonzero(held >= least)
                yield rows(homes[term[at]], speaks[lang[at]], term[at], 0)
            group, word, times = by_home(*_distinct(group[owner], word, times=times))
            for digit in range(int(times.max(initial=0)).bit_length()):
                at = np.flatnonzero(times >> digit & 1)
                yield rows(homes[word[at]], firsts[group[at]], word[at], 1 << digit)
        pa.default_memory_pool().release_unused()

    return run


def _shards(docs: DataFrame) -> int:
    """Enough shards for the distinct terms of all documents.  Every term stands
    in some document, so among one of ``LOOKED_AT`` documents there are at least
    that share of all terms, as a rule far more: the product is an upper estimate."""
    some = docs.filter(F.pmod(F.xxhash64("text"), F.lit(LOOKED_AT)) == 0)
    words = some.select("lang", F.explode(F.split(F.lower("text"), NOT_LETTER)).alias("word"))
    distinct = words.agg(F.approx_count_distinct(F.xxhash64("lang", "word"), 0.02)).first()[0]
    return max(1, -(-distinct * LOOKED_AT // SHARD_TERMS))


def _sums(vectors: DataFrame) -> DataFrame:
    """Sums of sparse vectors, times their weights, by group, as (gid, idx, n)."""
    entry = F.explode(F.arrays_zip(F.col("v.indices").alias("idx"), F.col("v.values").alias("n"))).alias("entry")
    cells = vectors.select("gid", "weight", F.unwrap_udt("vector").alias("v")).select("gid", "weight", entry)
    n = F.sum(F.col("entry.n").cast("bigint") * F.col("weight"))
    return cells.groupBy("gid", F.col("entry.idx").alias("idx")).agg(n.alias("n"))


_NAMED, _COUNTED = "idx int, name string", "gid bigint, idx int, n bigint"


def group_sums(spark: SparkSession, docs: DataFrame, groups: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """``(shard, idx, lang, term)`` of all kept terms, and ``(shard, idx, gid,
    n)`` of their occurrences in the groups ``(gid, lang, source)`` that have them."""
    bounded_batches(spark)
    shards = _shards(docs)
    root = f"{checkpoint_dir(spark).rstrip('/')}/terms-{uuid.uuid4().hex}"
    spread = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards))
    dealt = docs.select("lang", "source", "text", _escaped(F.col("lang")).alias("key")).mapInArrow(_dealt(shards), _DEALT)
    dealt = dealt.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(spread)))
    dealt = dealt.repartition(shards * spread, "shard", "salt").drop("salt")
    dealt.write.partitionBy("shard", "counted").option("compression", "zstd").parquet(f"{root}/dealt")
    for shard in range(shards):  # a few jobs for each SHARD_TERMS terms
        rows = spark.read.schema(_DEALT).parquet(f"{root}/dealt").filter(F.col("shard") == shard)
        rows = rows.withColumn("terms", F.split("terms", "\n"))
        counter = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(LEAST_DOCUMENTS), vocabSize=NO_LIMIT)
        try:
            model = counter.fit(rows.filter("NOT counted"))
        except IllegalArgumentException as e:
            if "vocabulary size" not in str(e):
                raise
            continue  # no term of this shard is in enough documents
        model.save(f"{root}/models/{shard}")
        names = spark.read.parquet(f"{root}/models/{shard}/data").select(F.posexplode("vocabulary").alias("idx", "name"))
        names.write.parquet(f"{root}/vocabulary/shard={shard}")
        vectors = model.transform(look_up(rows.filter("counted"), groups, ["lang", "source"], size))
        _sums(vectors).write.parquet(f"{root}/counts/shard={shard}")
    for kind, schema in (("vocabulary", _NAMED), ("counts", _COUNTED)):
        # a shard without rows, so that the folder is there
        spark.createDataFrame([], schema).write.parquet(f"{root}/{kind}/shard=-1")
    vocabulary = spark.read.schema(f"{_NAMED}, shard int").parquet(f"{root}/vocabulary")
    counts = spark.read.schema(f"{_COUNTED}, shard int").parquet(f"{root}/counts")
    term = F.substring_index("name", " ", -1)  # terms hold no blank
    lang = F.expr("left(name, char_length(name) - char_length(substring_index(name, ' ', -1)) - 1)")
    return vocabulary.select("shard", "idx", _restored(lang).alias("lang"), term.alias("term")), counts


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + terms)), without overflow; 1 where there are no terms."""
    below = f"greatest({total} + {terms}, 1)"
    plain = F.expr(f"({UNIT} * ({n} + 1)) div {below}")
    large = F.expr(f"cast({UNIT} * cast({n} + 1 as decimal(19, 0)) div cast({below} as decimal(19, 0)) as bigint)")
    ratio = F.when(F.expr(f"{n} < 9000000000"), plain).otherwise(large)
    return F.when(F.col(terms) > 0, 1 + ratio).otherwise(F.lit(1).cast("bigint"))


def distance(p: str, q: str) -> Column:
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def audit(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank`` from ``docs(text, lang, source)``.

    Part ``pair`` compares each (lang, source) group with the language's other
    sources, part ``term`` lists up to ``TERMS`` terms that a group uses more
    than its language does.  Null texts, languages and sources count as empty
    strings; empty texts and texts without letters add a group but no term; long
    texts are read whole; repeated rows count as documents each.  Ties go by the
    item's bytes.  A language without kept terms has pairs of value 0.  Empty
    documents give an empty result.  Sums are exact while a language keeps
    fewer than 1e9 terms.
    """
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    groups = docs.select("lang", "source").distinct().withColumn("gid", F.monotonically_increasing_id())
    groups = materialise(spark, groups, "groups")
    size = groups.count()
    vocabulary, counts = group_sums(spark, docs, groups, size)

    terms = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    totals = counts.groupBy("gid").agg(F.sum("n").alias("total"))
    sized = groups.join(totals, "gid", "left").join(terms, "lang", "left").na.fill(0, ["total", "terms"])
    overall = F.sum("total").over(Window.partitionBy("lang"))
    sized = sized.withColumn("overall", overall).withColumn("zero", F.lit(0).cast("bigint"))
    groups = materialise(spark, sized.withColumn("none", share("zero", "total", "terms")).drop("zero"), "sizes")

    # a term belongs to one language, so (shard, idx) is enough to know it
    everywhere = F.sum("n").over(Window.partitionBy("shard", "idx"))
    sizes = groups.select("gid", "none", "total", "overall", "terms")
    cells = look_up(counts.withColumn("all_n", everywhere), sizes, ["gid"], size)
    cells = cells.select("gid", "shard", "idx", "none", share("n", "total", "terms").alias("p"), share("all_n", "overall", "terms").alias("q"))
    cells = materialise(spark, cells, "cells")

    # terms: those of a group beyond their share in the language
    above = cells.filter("p > q").join(vocabulary.select("shard", "idx", "term"), ["shard", "idx"])
    above = above.select("gid", F.col("term").alias("item"), distance("p", "q").alias("value"))
    order = Window.partitionBy("gid").orderBy(F.desc("value"), "item")
    above = above.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TERMS)
    above = above.withColumn("part", F.lit("term"))

    # pairs: all terms as if absent from both, corrected for what each holds, and for what both hold
    other = groups.select("lang", F.col("gid").alias("other"), F.col("none").alias("other_none"))
    absent = distance("none", "other_none")
    grid = look_up(groups.select("lang", "gid", "none", "terms"), other, ["lang"], size).filter("gid <> other")
    grid = grid.select("gid", "other", (F.col("terms") * absent).alias("value"))
    levels = cells.groupBy("gid", "none", "p").agg(F.count(F.lit(1)).alias("m"))
    levels = look_up(levels, groups.select("gid", "lang"), ["gid"], size)
    levels = look_up(materialise(spark, levels, "levels"), other, ["lang"], size).filter("gid <> other")
    mine = levels.select("gid", "other", (F.col("m") * (distance("p", "other_none") - absent)).alias("value"))
    theirs = levels.select(
        F.col("other").alias("gid"),
        F.col("gid").alias("other"),
        (F.col("m") * (distance("other_none", "p") - distance("other_none", "none"))).alias("value"),
    )
    held = cells.select("shard", "idx", F.col("gid").alias("other"), F.col("p").alias("other_p"), F.col("none").alias("other_none"))
    both = cells.select("shard", "idx", "gid", "none", "p").join(held, ["shard", "idx"]).filter("gid <> other")
    shared = distance("p", "other_p") - distance("p", "other_none") - distance("none", "other_p") + absent
    pairs = grid
    for part in (mine, theirs, both.select("gid", "other", shared.alias("value"))):
        pairs = pairs.unionByName(part.groupBy("gid", "other").agg(F.sum("value").alias("value")))
    pairs = pairs.groupBy("gid", "other").agg(F.sum("value").alias("value"))
    named = groups.select(F.col("gid").alias("other"), F.col("source").alias("item"))
    pairs = look_up(pairs, named, ["other"], size).select("gid", "item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    found = look_up(pairs.unionByName(above), groups.select("gid", "lang", "source"), ["gid"], size)
    return found.select("lang", "source", "part", "item", "value", "rank")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(*) >= 3),
gr AS (SELECT DISTINCT lang, source FROM d),
sums AS (SELECT lang, source, term, sum(n) AS n FROM t GROUP BY ALL),
gc AS (
  SELECT g.lang, g.source, k.term, coalesce(s.n, 0)::HUGEINT AS n
  FROM gr g JOIN kept k ON k.lang = g.lang LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term),
gp AS (
  SELECT *, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER w + count(*) OVER w)::HUGEINT AS p
  FROM gc WINDOW w AS (PARTITION BY lang, source)),
lc AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM gc GROUP BY ALL),
lp AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER w + count(*) OVER w)::HUGEINT AS q
  FROM lc WINDOW w AS (PARTITION BY lang)),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM gr a JOIN gr b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN gp x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN gp y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
term AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
  FROM gp JOIN lp USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return audit(spark, docs.select(*[docs[name_of(c)].alias(c) for c in ("text", "lang", "source")]))
