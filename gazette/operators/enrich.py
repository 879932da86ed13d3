"""Lookups: dimension joins, gated detail-page joins, correlated flatten.

No join is hinted: the planner's statistics and AQE decide what is small
enough to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette import constants as K
from gazette.functions.text import col

def regulator_dimension(spark: SparkSession) -> DataFrame:
    """The fixed regulator dimension (a row for each known code)."""
    rows = [(code, full, lang, base) for code, full, lang, base in K.REGULATORS]
    return spark.createDataFrame(rows, "code string, full_name string, language string, base_url string")


def join_dimension(
    df: DataFrame, dim: DataFrame, left_key: Column | str, right_key: str, case_insensitive: bool = False
) -> DataFrame:
    """Left join to a small dimension; unmatched rows keep NULL attributes
    (callers turn those into reject reasons)."""
    lk = col(left_key)
    rk = F.col(right_key)
    if case_insensitive:
        dim = dim.withColumn("_dim_key", F.lower(rk))
        cond = F.lower(lk) == F.col("_dim_key")
    else:
        dim = dim.withColumn("_dim_key", rk)
        cond = lk == F.col("_dim_key")
    return df.join(dim, cond, "left").drop("_dim_key")


def reject_unknown_regulators(candidates: DataFrame, spark: SparkSession) -> DataFrame:
    """Candidates whose regulator code (any case) is not in the dimension get
    the reason ``unknown_regulator``; rows without a code are left alone."""
    known = regulator_dimension(spark).select("code", F.lit(True).alias("_known"))
    joined = join_dimension(candidates, known, "regulator", "code", case_insensitive=True)
    unknown = F.col("regulator").isNotNull() & F.col("_known").isNull()
    reasons = F.when(unknown, F.concat("reasons", F.array(F.lit("unknown_regulator")))).otherwise(F.col("reasons"))
    return joined.withColumn("reasons", reasons).select(*candidates.columns)


def gated_lookup(
    listing: DataFrame,
    details: DataFrame,
    on: Sequence[tuple[str, str]],
    gate: Column,
) -> DataFrame:
    """Listing rows left-joined to their detail rows only where ``gate`` holds
    (e.g. regulation type and not a PDF link).  Gate-failing rows are kept
    with NULL detail columns — nothing is fetched for them."""
    cond = gate
    for lcol, rcol in on:
        cond = cond & (listing[lcol] == details[rcol])
    return listing.join(details, cond, "left")


def flatten_children(children: Column | str, field: str) -> Column:
    """``[x for child in children for x in child.field]`` in order."""
    return F.flatten(F.transform(col(children), lambda ch: F.coalesce(ch[field], F.array().cast("array<string>"))))
