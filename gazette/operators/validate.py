"""Validate-and-split: every candidate row gets a ``reasons ARRAY<STRING>``;
valid rows have none, rejects keep theirs.  Nothing is raised per row and
nothing is dropped silently — valid + rejects = input.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette import constants as K
from gazette.functions import dates as D
from gazette.functions import urls as U
from gazette.functions.text import col


def missing_fields(**fields: Column | str) -> Column:
    """``missing:<name>`` for every NULL field (required-field check)."""
    return F.array_compact(
        F.array(*[F.when(col(c).isNull(), F.lit(f"missing:{name}")) for name, c in fields.items()])
    )


def typed_fields(df: DataFrame, types: dict[str, str], reasons: str = "reasons") -> DataFrame:
    """Text fields as their declared types; a value that is there but is not of
    its type becomes NULL with the reason ``type:<name>`` (beside the rows' other
    ``reasons``, if they have any), so it is told apart from a missing one."""
    cast = {name: col(name).try_cast(kind) for name, kind in types.items()}
    wrong = F.array_compact(
        F.array(*[F.when(col(n).isNotNull() & c.isNull(), F.lit(f"type:{n}")) for n, c in cast.items()])
    )
    known = F.col(reasons) if reasons in df.columns else F.array().cast("array<string>")
    return df.withColumn(reasons, F.concat(known, wrong)).withColumns(cast)


def title_ok(title: Column | str) -> Column:
    n = F.length(col(title))
    return F.coalesce(n.between(K.MIN_TITLE_LENGTH, K.MAX_TITLE_LENGTH), F.lit(False))


def related_ok(related: Column | str, cap: int = K.MAX_RELATED_URLS) -> Column:
    """A list of at most ``cap`` items, every one a valid URL."""
    r = F.coalesce(col(related), F.array().cast("array<string>"))
    return (F.size(r) <= cap) & F.forall(r, lambda u: U.is_valid_url(u))


def publication_reasons(
    title: Column | str,
    published_at: Column | str,
    web_url: Column | str,
    related: Column | str | None = None,
    as_of: _dt.datetime | None = None,
    related_cap: int = K.MAX_RELATED_URLS,
) -> Column:
    """All reasons a publication row is rejected (empty array = valid)."""
    title, published_at, web_url = col(title), col(published_at), col(web_url)
    checks = [
        F.when(title.isNull(), F.lit("missing:web_title")),
        F.when(title.isNotNull() & ~title_ok(title), F.lit("title_length")),
        F.when(published_at.isNull(), F.lit("missing:published_at")),
        F.when(web_url.isNull(), F.lit("missing:web_url")),
        F.when(web_url.isNotNull() & ~U.is_valid_url(web_url), F.lit("invalid_url")),
    ]
    if related is not None:
        checks.append(F.when(~related_ok(related, related_cap), F.lit("invalid_related_urls")))
    base = F.array_compact(F.array(*checks))
    if as_of is not None:
        base = F.concat(base, D.date_bounds_reasons(published_at, as_of))
    return base


def reject_rows(df: DataFrame, source: Column | str, key: Column | str, name: str = "reasons") -> DataFrame:
    """Rejects table ``(source, key, reason, detail)`` — one row per reason."""
    return df.filter(F.size(F.col(name)) > 0).select(
        col(source).cast("string").alias("source"),
        col(key).cast("string").alias("key"),
        F.explode(F.col(name)).alias("reason"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns if c != name])).alias("detail"),
    )


def reason_summary(rejects: DataFrame) -> DataFrame:
    """Counts per reason (partial aggregation before the shuffle)."""
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
