"""Language identification by hierarchical discrimination.

Linear support vector machines on hashed byte 2- to 4-gram vectors first
separate language families, then one-versus-one machines separate the
languages of the predicted family.  They are fitted with Spark ML on a bounded
sample (``TRAIN_PER_LANGUAGE`` documents of each label, spread by a hash of
the id); prediction is one Arrow pass over whole texts.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.llm.common import blocks, bounded_batches, each, fold, materialise, name_of

#: Bound of the training sample, documents per label.
TRAIN_PER_LANGUAGE = 400
BUCKETS = 4096
UNKNOWN = "und"

# FIXED VALUES: families of common language codes; other codes are families of their own.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sr", "uk"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

# ASCII bytes that are no letters read as spaces.
_LETTERS = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


def family_of(code: str) -> str:
    return _FAMILY_OF.get(code, code)


def gram_vector(text: str) -> np.ndarray:
    """Unit vector of hashed byte 2-, 3- and 4-gram counts of a whole text."""
    counts = np.zeros(BUCKETS, np.int64)
    data = b" " + text.lower().encode("utf-8", "replace").translate(_LETTERS) + b" "
    for at, block in enumerate(blocks(data, overlap=3)):
        grams = block.astype(np.uint32)
        code = grams
        for n in (2, 3, 4):
            if len(block) < n:
                break
            code = code[:-1] * np.uint32(0x01000193) ^ grams[n - 1 :]
            # shorter grams of the overlap were counted in the block before
            mixed = code[4 - n if at else 0 :] * np.uint32(0x9E3779B1)
            counts += np.bincount(mixed >> np.uint32(20), minlength=BUCKETS)
    root = np.sqrt(counts)
    return root / max(np.sqrt(counts.sum()), 1.0)


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _vectors(texts: pa.Array) -> pa.Array:
    return pa.array([gram_vector(t or "") for t in each(texts)], pa.list_(pa.float64()))


@dataclass(frozen=True)
class Machine:
    """One linear SVM: a positive margin votes for ``yes``."""

    yes: str
    no: str
    weights: np.ndarray
    intercept: float


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    between: tuple[Machine, ...] = ()
    within: dict[str, tuple[Machine, ...]] = field(default_factory=dict)

    def predict(self, vector: np.ndarray) -> tuple[str, float]:
        families = sorted({family_of(x) for x in self.languages})
        family, sure = _duel(families, self.between, vector)
        members = [x for x in self.languages if family_of(x) == family]
        language, fine = _duel(members, self.within.get(family, ()), vector)
        return language, sure * fine


def _duel(names: list[str], machines: tuple[Machine, ...], vector: np.ndarray) -> tuple[str, float]:
    """Most votes wins, then the larger sum of confidences, then the name."""
    if len(names) == 1:
        return names[0], 1.0
    votes, trust = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
    for m in machines:
        margin = float(vector @ m.weights) + m.intercept
        chance = 1.0 / (1.0 + np.exp(-np.clip(3.0 * margin, -60, 60)))
        votes[m.yes if margin >= 0 else m.no] += 1
        trust[m.yes] += chance
        trust[m.no] += 1.0 - chance
    best = min(names, key=lambda x: (-votes[x], -trust[x], x))
    return best, trust[best] / (len(names) - 1)


def _sample(spark: SparkSession, rows: DataFrame, per_language: int) -> DataFrame:
    """At most ``per_language`` rows of each label, spread by a hash of the id."""
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return rows.limit(0)
    parts = 1_000_000
    share = F.create_map(
        *itertools.chain.from_iterable(
            (F.lit(k), F.lit(min(parts, 1 + 3 * per_language * parts // n))) for k, n in sizes.items()
        )
    )
    order = F.xxhash64("id")
    thin = rows.filter(F.pmod(order, F.lit(parts)) < share[F.col("lang")])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(order, "id", "text"))
    return thin.withColumn("rank", rank).filter(F.col("rank") <= per_language).select("lang", "text")


def _fit(data: DataFrame, yes: str, no: str) -> Machine:
    from pyspark.ml.classification import LinearSVC  # workers do without it

    fitted = LinearSVC(maxIter=25, regParam=1e-3, standardization=False).fit(data)
    return Machine(yes, no, np.asarray(fitted.coefficients.toArray()), float(fitted.intercept))


def train(
    spark: SparkSession,
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = TRAIN_PER_LANGUAGE,
) -> LanguageModel:
    """Fit the two levels on labelled rows; rows without a label or a letter
    teach nothing, and without any such row the model predicts ``und``."""
    bounded_batches(spark)
    rows = labelled.select(
        labelled[name_of(id_col)].cast("string").alias("id"),
        labelled[name_of(text_col)].alias("text"),
        labelled[name_of(lang_col)].alias("lang"),
    ).filter(F.col("lang").isNotNull() & F.coalesce(has_letter(F.col("text")), F.lit(False)))
    table = materialise(
        spark,
        _sample(spark, rows, per_language).select("lang", _vectors("text").alias("vector")),
        "lang-sample",
    )
    languages = tuple(sorted(r["lang"] for r in table.select("lang").distinct().collect()))
    family = F.create_map(*[F.lit(x) for code in languages for x in (code, family_of(code))]) if languages else None

    from pyspark.ml.functions import array_to_vector

    def machines(names: list[str], key: Column) -> tuple[Machine, ...]:
        return tuple(
            _fit(
                table.filter(key.isin(a, b)).select(
                    array_to_vector("vector").alias("features"),
                    (key == a).cast("double").alias("label"),
                ),
                a,
                b,
            )
            for a, b in itertools.combinations(names, 2)
        )

    families = sorted({family_of(x) for x in languages})
    between = machines(families, family[F.col("lang")]) if len(families) > 1 else ()
    within = {
        f: machines([x for x in languages if family_of(x) == f], F.col("lang"))
        for f in families
        if sum(family_of(x) == f for x in languages) > 1
    }
    return LanguageModel(languages, between, within)


def has_letter(text: Column) -> Column:
    return text.rlike("\\p{L}")


def predictor(model: LanguageModel):
    """Arrow UDF text -> (lang_pred, score); null input is undetermined."""

    @F.arrow_udf(T.StructType().add("lang_pred", T.StringType()).add("score", T.DoubleType()))
    def predict(texts: pa.Array) -> pa.Array:
        out = [
            (UNKNOWN, 0.0) if t is None or not model.languages else model.predict(gram_vector(t))
            for t in each(texts)
        ]
        return pa.StructArray.from_arrays(
            [pa.array([x for x, _ in out], pa.string()), pa.array([y for _, y in out], pa.float64())],
            ["lang_pred", "score"],
        )

    return lambda text: predict(F.when(has_letter(text), text))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 3) == 1


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``.

    Text that is null or without a letter is ``und`` with score 0.  Nulls in
    ``lang`` teach nothing; a null id is in the training fold; repeated rows
    are predicted alike; an empty table gives no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(spark, docs.filter(~held_out(F.col("doc_id"))))
    return docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        predictor(model)(F.col("text")).alias("guess"),
    ).select("doc_id", "held_out", "guess.lang_pred", "guess.score")
