"""Near duplicates from bottom-k sketches of one hash function.

Each document's shingle set keeps its ``SKETCH`` smallest hashes.  Equal sets
collapse to one class first.  The ``LISTED`` smallest values of every class
open inverted lists; two classes that meet in enough lists are a candidate
pair, the Jaccard estimate of their union sketch filters it, and the exact
Jaccard of the full sets confirms it.

Lists longer than ``LONG_LIST`` (a passage that many documents share, a large
family of near copies) are never expanded into all pairs.  The classes whose
sketch could consist of such values alone are joined exactly by prefix: under
a rarest-first order two sets can only be similar if the first sixth of the
smaller and the first quarter of the larger share a shingle.  Prefix lists
that are still long are resolved against their smallest members first, ``PIVOTS`` in
each of ``ROUNDS`` rounds; then the members that are still in different
components are compared with each other.

A pair of similarity 0.75 shares fewer than ``SHARED`` of its listed values,
or estimates under ``LEAST_ESTIMATE``, with a chance below 1e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.llm.common import bounded_batches, byte_list, materialise, name_of, release, slices
from gazette.llm.components import components, extend
from gazette.llm.shingles import shingle_set

SKETCH = 64
LISTED = 24
LONG_LIST = 64
SHARED = 6
LEAST_ESTIMATE = 0.4
#: Counters of the shingle frequency summary that orders prefixes.
SUMMARY = 1 << 20
SECTIONS, BRANCHES = 64, 64
#: Members that a long prefix list is resolved against in each of the rounds before its others meet.
PIVOTS, ROUNDS = 16, 3
#: Bits of the bitmap of wanted ids, as a power of two.
ID_BITS = 22
#: Lists of a class that suppress repeated pairs.
FIRST_LISTS = 64


def _sets(id_type: str, carry_type: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, digests, sketches = [], [], []
            for text in byte_list(batch.column("text")):
                s = shingle_set(text.lower())
                sizes.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else b"")
                sketches.append(s[:SKETCH].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(sketches, pa.binary()),
                ],
                ["row", "id", "n", "digest", "sketch"],
            )

    return run, f"row {carry_type}, id {id_type}, n bigint, digest binary, sketch binary"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        heads = [np.frombuffer(s, np.int64)[:LISTED] for s in batch.column("sketch").to_pylist()]
        counts = [len(h) for h in heads]
        values = np.concatenate(heads) if heads else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(values),
                pa.array(np.repeat(batch.column("cls").to_numpy(), counts)),
                pa.array(np.repeat(batch.column("n").to_numpy(), counts)),
            ],
            ["value", "cls", "n"],
        )


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard estimate from the bottom-k sketch of the union of two sets."""
    union = np.union1d(a, b)
    if len(a) >= SKETCH or len(b) >= SKETCH:
        union = union[:SKETCH]
    both = np.intersect1d(a, b, assume_unique=True)
    return np.isin(union, both, assume_unique=True).sum() / max(len(union), 1)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 75 * union, on full sets."""
    inter = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * inter >= 75 * (len(a) + len(b) - inter)


def _keep_pairs(test):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            left, right = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            keep = [
                test(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))
                for a, b in zip(left, right)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _with_both(pairs: DataFrame, table: DataFrame, what: str) -> DataFrame:
    one = table.select(F.col("cls").alias("a"), F.col(what).alias("x"))
    two = table.select(F.col("cls").alias("b"), F.col(what).alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")


def _need(n: Column) -> Column:
    """Listed values that similar classes share, at least."""
    return F.least(F.lit(SHARED), F.ceil(n * 0.75))


def _size_fits(n1: Column, n2: Column) -> Column:
    return (F.greatest(n1, n2) * 75) <= (F.least(n1, n2) * 100)


def _candidates(lists: DataFrame, long_counts: DataFrame) -> DataFrame:
    """Pairs that meet in short lists often enough to be similar, given how
    many long lists both might share besides."""
    short = lists.filter(F.col("size") <= LONG_LIST)
    x = short.select("value", F.col("cls").alias("a"), F.col("n").alias("na"))
    y = short.select("value", F.col("cls").alias("b"), F.col("n").alias("nb"))
    met = (
        x.join(y, "value")
        .filter((F.col("a") < F.col("b")) & _size_fits(F.col("na"), F.col("nb")))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("met"), F.min(F.least("na", "nb")).alias("n"))
    )
    more = lambda side: long_counts.select(F.col("cls").alias(side), F.col("long").alias(f"long_{side}"))
    return (
        met.join(more("a"), "a", "left")
        .join(more("b"), "b", "left")
        .filter(
            F.col("met") + F.least(F.coalesce("long_a", F.lit(0)), F.coalesce("long_b", F.lit(0)))
            >= _need(F.col("n"))
        )
        .select("a", "b")
    )


_PARTIAL = "section bigint, branch bigint, slots binary, counts binary"


def _partial(section: int, branch: int, counts: np.ndarray) -> pa.RecordBatch:
    slots = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([section], pa.int64()),
            pa.array([branch], pa.int64()),
            pa.array([slots.astype(np.int32).tobytes()], pa.binary()),
            pa.array([counts[slots].astype(np.int64).tobytes()], pa.binary()),
        ],
        ["section", "branch", "slots", "counts"],
    )


def _count_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial shingle counts by hash slot, in sections of the slots."""
    total = np.zeros(SUMMARY, np.int64)
    for batch in batches:
        for data in batch.column("set").to_pylist():
            np.add.at(total, (np.frombuffer(data, np.uint64) % np.uint64(SUMMARY)).astype(np.int64), 1)
    for section, part in enumerate(total.reshape(SECTIONS, -1)):
        if part.any():
            yield _partial(section, TaskContext.get().partitionId() % BRANCHES, part)


def _add_partials(table: pa.Table) -> pa.Table:
    total = np.zeros(SUMMARY // SECTIONS, np.int64)
    for slots, counts in zip(table.column("slots").to_pylist(), table.column("counts").to_pylist()):
        total[np.frombuffer(slots, np.int32)] += np.frombuffer(counts, np.int64)
    return pa.Table.from_batches([_partial(table.column("section")[0].as_py(), 0, total)])


def _summary(sets: DataFrame) -> np.ndarray:
    """How often each hash slot is met by the sets' shingles; added up in two
    steps, so that no task gathers the parts of all tasks."""
    parts = sets.mapInArrow(_count_shingles, _PARTIAL)
    parts = parts.groupBy("section", "branch").applyInArrow(_add_partials, _PARTIAL)
    total = np.zeros((SECTIONS, SUMMARY // SECTIONS), np.int64)
    for r in parts.groupBy("section").applyInArrow(_add_partials, _PARTIAL).collect():  # SECTIONS rows
        total[r["section"], np.frombuffer(r["slots"], np.int32)] = np.frombuffer(r["counts"], np.int64)
    return total.ravel()


def _prefixes(summary: np.ndarray):
    """Rows (value, cls, n, left, indexed) of every set's probing prefix.

    ``left`` counts the shingles from this one on; shingles that the summary
    counts once meet nobody and are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows: list[list[np.ndarray]] = [[], [], [], [], []]
            for cls, data in zip(batch.column("cls").to_pylist(), batch.column("set").to_pylist()):
                s = np.frombuffer(data, np.uint64)
                n = len(s)
                often = summary[(s % np.uint64(SUMMARY)).astype(np.int64)]
                probe, index = n + (-3 * n // 4) + 1, n + (-6 * n // 7) + 1
                order = np.lexsort((s, often))[:probe]
                at = np.flatnonzero(often[order] > 1)
                rows[0].append(s[order[at]].view(np.int64))
                rows[1].append(np.full(len(at), cls))
                rows[2].append(np.full(len(at), n))
                rows[3].append(n - at)
                rows[4].append(at < index)
            if rows[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(r)) for r in rows], ["value", "cls", "n", "left", "indexed"]
                )

    return run


def _reach(n: str, left: str) -> Column:
    """Largest size of a set that can still be similar when the first common
    shingle stands here: 7 * left >= 3 * (n + size)."""
    return F.floor((F.col(left) * 7 - F.col(n) * 3) / 3)


def _prefix_pairs(probe: DataFrame, index: DataFrame) -> DataFrame:
    """Pairs that meet in a list and can still be similar, apart by ``root``.
    Of the lists that both meet in, those after the first are passed over."""

    def side(df: DataFrame, x: str) -> DataFrame:
        return df.select("value", *[F.col(c).alias(c + x) for c in ("cls", "n", "left", "root", "earlier")])

    return side(probe, "_x").join(side(index, "_y"), "value").filter(
        (F.col("root_x") != F.col("root_y"))
        & (F.col("n_y") <= F.col("n_x"))
        & _size_fits(F.col("n_x"), F.col("n_y"))
        & (F.col("n_y") <= _reach("n_x", "left_x"))
        & (F.col("n_x") <= _reach("n_y", "left_y"))
        & ~F.arrays_overlap("earlier_x", "earlier_y")
    ).select(F.least("cls_x", "cls_y").alias("a"), F.greatest("cls_x", "cls_y").alias("b"))


def near_dedup(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One row per input row: ``row`` (struct of the ``carry`` columns),
    ``n_shingles``, ``component_id``, ``kept``.

    Text that is null or has no word has an empty set, is linked with nothing
    and stays.  Null ids sort last; of rows that share the smallest id of a
    component (repeated rows) one stays.  An empty table gives no rows; extra
    columns travel inside ``row`` only.
    """
    bounded_batches(spark)
    rows = docs.select(
        F.struct(*[docs[name_of(c)].alias(c) for c in carry]).alias("row"),
        docs[name_of(id_col)].alias("id"),
        docs[name_of(text_col)].alias("text"),
    )
    kinds = dict(rows.dtypes)
    fn, schema = _sets(kinds["id"], kinds["row"])
    base = materialise(
        spark,
        rows.mapInArrow(fn, schema).withColumn("uid", F.monotonically_increasing_id()),
        "shingle-sketches",
    )
    best = F.struct(F.col("id").isNull().alias("none"), "id", "uid")
    classes = materialise(
        spark,
        base.filter("n > 0")
        .groupBy("n", "digest")
        .agg(F.min("uid").alias("cls"), F.min(best).alias("best"), F.min("sketch").alias("sketch")),
        "shingle-classes",
    )
    opened = classes.select("cls", "n", "sketch").mapInArrow(_listed, "value bigint, cls bigint, n bigint")
    sizes = opened.groupBy("value").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    lists = materialise(spark, opened.join(sizes, "value"), "inverted-lists")
    long_counts = materialise(
        spark,
        lists.filter(F.col("size") > LONG_LIST)
        .groupBy("cls", "n")
        .agg(F.count(F.lit(1)).alias("long")),
        "long-lists",
    )
    guessed = materialise(
        spark,
        _with_both(_candidates(lists, long_counts), classes, "sketch").mapInArrow(
            _keep_pairs(lambda a, b: estimate(a, b) >= LEAST_ESTIMATE), "a bigint, b bigint"
        ),
        "estimated-pairs",
    )
    rich = long_counts.filter(F.col("long") >= _need(F.col("n"))).select("cls")
    wanted = (
        guessed.select(F.col("a").alias("cls"))
        .unionByName(guessed.select(F.col("b").alias("cls")))
        .unionByName(rich)
        .distinct()
    )
    sets = materialise(spark, _full_sets(rows, classes.join(wanted, "cls")), "full-sets")

    def confirm(pairs: DataFrame, name: str) -> DataFrame:
        return materialise(
            spark,
            _with_both(pairs, sets, "set").mapInArrow(_keep_pairs(similar), "a bigint, b bigint"),
            name,
        )

    links = confirm(guessed, "links")
    release(spark, lists, guessed)
    roots = materialise(spark, components(spark, links), "roots")
    release(spark, links)
    if not rich.isEmpty():
        roots = _rich_roots(spark, sets.join(rich, "cls"), roots, confirm)
    release(spark, long_counts, sets)
    rooted = classes.join(roots, classes["cls"] == roots["node"], "left").select(
        "n", "digest", "best", F.coalesce("root", "cls").alias("root")
    )
    heads = rooted.groupBy("root").agg(F.min("best").alias("head"))
    named = rooted.join(heads, "root").select("n", "digest", "head")
    out = base.filter("n > 0").join(named, ["n", "digest"]).select(
        "row",
        F.col("n").alias("n_shingles"),
        F.col("head.id").alias("component_id"),
        (F.col("uid") == F.col("head.uid")).alias("kept"),
    )
    return out.unionByName(
        base.filter("n = 0").select(
            "row", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(True).alias("kept")
        )
    )


def _full_sets(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, set) of classes, from the text of their first document; the
    digest picks the right one where rows share an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, sets = [], []
            for cls, digest, text in zip(
                batch.column("cls").to_pylist(), batch.column("digest").to_pylist(), byte_list(batch.column("text"))
            ):
                data = shingle_set(text.lower()).tobytes()
                if xxhash.xxh3_128_digest(data) == digest:
                    ids.append(cls)
                    sets.append(data)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["cls", "set"])

    first = classes.select("cls", "digest", F.col("best.id").alias("first_id"))
    texts = rows.select("id", "text").filter(_among(first.select(F.xxhash64("first_id").alias("hash")), F.xxhash64("id")))
    texts = texts.join(first, F.col("id").eqNullSafe(F.col("first_id")))
    return texts.select("cls", "digest", "text").mapInArrow(run, "cls bigint, set binary").dropDuplicates(["cls"])


def _among(hashes: DataFrame, of: Column) -> Column:
    """Whether a hash may be among ``hashes``, by a bitmap of fixed size: what is
    surely not stays out of a shuffle.  The more hashes, the less it saves."""
    place = hashes.select(F.shiftrightunsigned("hash", 64 - ID_BITS).alias("place"))
    bits = place.selectExpr("shiftright(place, 6) AS at", "shiftleft(1L, CAST(place & 63 AS INT)) AS bit")
    rows = bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).toLocalIterator()  # at most 2 ** (ID_BITS - 6) rows
    bitmap = np.zeros(1 << (ID_BITS - 6), np.int64)
    for r in rows:
        bitmap[r["at"]] = r["bits"]
    words = bitmap.view(np.uint64)

    @F.arrow_udf("boolean")
    def seen(hash: pa.Array) -> pa.Array:
        at = hash.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) >> np.uint64(64 - ID_BITS)
        return pa.array((words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool))

    return seen(of)


def _rich_roots(spark: SparkSession, sets: DataFrame, roots: DataFrame, confirm) -> DataFrame:
    """Roots after all links among classes whose sketches may share long lists only."""

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        links = confirm(pairs.distinct(), name)
        out = materialise(spark, extend(spark, roots, links), "roots")
        release(spark, links, roots)
        return out

    sets = materialise(spark, sets, "rich-sets")
    prefixes = sets.mapInArrow(
        _prefixes(_summary(sets)), "value bigint, cls bigint, n bigint, left bigint, indexed boolean"
    )
    sizes = (
        prefixes.groupBy("value")
        .agg(F.count(F.lit(1)).alias("size"), F.count_if("indexed").alias("indexes"))
        .filter("size > 1 AND indexes > 0")
    )
    found = materialise(spark, prefixes.join(sizes, "value"), "prefix-lists")
    # a class has at most a quarter of its shingles here
    first = found.groupBy("cls").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("left")).alias("at"), "value"))), 1, FIRST_LISTS).alias("first")
    )
    earlier = F.transform(F.filter("first", lambda f: f["at"] < -F.col("left")), lambda f: f["value"])
    lists = materialise(
        spark, found.join(first, "cls").withColumn("earlier", earlier).withColumn("root", F.col("cls")).drop("first"), "prefix-lists"
    )
    release(spark, found)
    smallest = Window.partitionBy("value").orderBy("n", "cls")
    short, long = lists.filter(F.col("size") <= LONG_LIST), lists.filter(F.col("size") > LONG_LIST)
    pivots = materialise(
        spark,
        long.filter("indexed")
        .withColumn("rank", F.row_number().over(smallest))
        .filter(F.col("rank") <= PIVOTS * ROUNDS),
        "pivots",
    )
    roots = linked(_prefix_pairs(short, short.filter("indexed")), "rich-links")
    for last in range(PIVOTS, PIVOTS * (ROUNDS + 1) + 1, PIVOTS):
        known = roots.withColumnRenamed("root", "found")

        def rooted(rows: DataFrame) -> DataFrame:
            return (
                rows.join(known, rows["cls"] == known["node"], "left")
                .withColumn("root", F.coalesce("found", "root"))
                .drop("node", "found")
            )

        open_lists = rooted(long)
        spread = open_lists.groupBy("value").agg(F.min("root").alias("r0"), F.max("root").alias("r1"))
        spread = spread.filter("r0 <> r1").select("value")
        open_lists = materialise(spark, open_lists.join(spread, "value", "left_semi"), "open-lists")
        if open_lists.isEmpty():
            break
        if last <= PIVOTS * ROUNDS:
            met = rooted(pivots.filter((F.col("rank") > last - PIVOTS) & (F.col("rank") <= last)))
        else:
            met = open_lists.filter("indexed")
        roots = linked(_prefix_pairs(open_lists, met), "long-links")
        release(spark, open_lists)
    release(spark, sets, lists, pivots)
    return roots


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every row of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_dedup(spark, docs).select("row.doc_id", "n_shingles", "component_id", "kept")
