"""Free-form JSON as VARIANT: parsed once, then read by typed paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions.text import col


def parse(json_text: Column | str) -> Column:
    """A JSON text as VARIANT; null if it is malformed, empty or null.  As with
    Spark's other JSON functions, what follows a complete value is not read."""
    return F.try_parse_json(col(json_text))


def read(variant: Column | str, paths: Sequence[str] | str, as_type: str) -> Column:
    """The first of ``paths`` that holds a value of ``as_type`` (or one that can
    be cast to it); null if none does."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return F.coalesce(*[F.try_variant_get(col(variant), p, as_type) for p in paths])


def kind(variant: Column | str) -> Column:
    """``object``, ``array``, ``string``, ``number``, ``boolean``, ``null`` for a JSON
    null; null where there is no value."""
    schema = F.schema_of_variant(col(variant))
    return (
        F.when(F.is_variant_null(col(variant)), F.lit("null"))
        .when(schema.startswith("OBJECT"), F.lit("object"))
        .when(schema.startswith("ARRAY"), F.lit("array"))
        .when(schema == "STRING", F.lit("string"))
        .when(schema == "BOOLEAN", F.lit("boolean"))
        .when(schema.isNotNull(), F.lit("number"))
    )


def decode(df: DataFrame, json_column: str, fields: dict[str, tuple[Sequence[str] | str, str]]) -> DataFrame:
    """``df`` with its JSON column parsed once and read as ``fields`` (name →
    paths and type); rows whose text is no JSON have nulls."""
    parsed = df.withColumn("_variant", parse(json_column))
    return parsed.select(*df.columns, *[read("_variant", p, t).alias(n) for n, (p, t) in fields.items()], kind("_variant").alias("json_kind"))
