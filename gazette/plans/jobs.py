"""Namespace jobs: which landed captures feed which flow, per namespace.

A job is data: a list of links (each with the flow that reads it, the
update type and whether the page was rendered lazily), optionally the
chunk database, and the namespace it publishes to.  ``run_job`` restricts
the landed captures to the link manifest (nothing is fetched), then to the
latest of each URL, runs each flow once over its links, looks up only the
detail pages that listings point to, keeps the ten latest valid items per
link, and publishes them as the namespace's live run.  Its outcome (rows, valid
rows, rejects, items cut, empty and short listings) is part of that run.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette import constants as K
from gazette.operators import sinks as S
from gazette.operators.runs import listing_success, require_healthy, resolve_fetches, short_groups, source_health
from gazette.plans import publications as PUB
from gazette.session import written
from gazette.sources.feed import read_feeds

BASES = {code: base for code, _, _, base in K.REGULATORS}


def base_url(job: "Job") -> str:
    return job.base_url or BASES[job.regulator]


@dataclass(frozen=True)
class Link:
    url: str
    flow: str  # "dl" | "search" | "cards"
    lazy: bool = False


@dataclass(frozen=True)
class Job:
    namespace: str
    regulator: str
    update_type: str
    links: tuple[Link, ...] = ()
    year_links: tuple[str, int] | None = None  # (template with {year}, first year), newest first
    use_database: bool = False
    enrich_details: bool = False
    per_link: int | None = K.PER_LINK_LATEST
    base_url: str | None = None  # site root for relative links (default: the regulator's)
    page_atomic: bool = False  # one rejected row loses its listing page
    dedupe_on: str | None = None  # keep one valid row for each value of this column
    strict: bool = False  # raise if an expected listing has no valid row


def job_from_dict(spec: dict) -> Job:
    """A job from plain data (a JSON file): links as ``{url, flow, lazy}``."""
    links = tuple(Link(**link) for link in spec.get("links", ()))
    years = spec.get("year_links")
    return Job(**{**spec, "links": links, "year_links": tuple(years) if years else None})


# ---------------------------------------------------------------------------
# FIXED VALUES — link manifests of the four namespace jobs
# ---------------------------------------------------------------------------
_ECB = BASES["ECB"]
_MAS = BASES["MAS"]
_MAS_REG_QUERY = (
    "/publications?page=1&sort=mas_date_tdt%20desc"
    "&content_type=Financial%20Stability%20Reviews&content_type=Recent%20Economic%20Developments"
    "&content_type=FATF%20Statement&content_type=Macroeconomic%20Reviews&content_type=Staff%20Papers"
    "&content_type=Money%20and%20Banking%20Monthly%20Statistical%20Bulletin&content_type=Economic%20Essays"
    "&content_type=Monographs%2FInformation%20Papers&content_type=Consultations"
)
JOBS: dict[str, Job] = {
    "ecb-regulations": Job(
        namespace="ecb-regulations",
        regulator="ECB",
        update_type="regulation",
        year_links=(_ECB + "/press/accounts/{year}/html/index_include.en.html", 2022),
        links=(Link(_ECB + "/press/pubbydate/html/index.en.html?name_of_publication=Letters%20to%20MEPs", "dl", True),),
        use_database=True,
    ),
    "ecb-news": Job(
        namespace="ecb-news",
        regulator="ECB",
        update_type="news",
        links=(
            Link(_ECB + "/press/stats/paysec/html/index.en.html", "dl"),
            Link(_ECB + "/press/pubbydate/html/index.en.html?name_of_publication=Press%20release", "dl", True),
        ),
        use_database=True,
    ),
    "mas-regulations": Job(
        namespace="mas-regulations",
        regulator="MAS",
        update_type="regulation",
        links=(Link(_MAS + _MAS_REG_QUERY, "search"),),
        enrich_details=True,
    ),
    "mas-news": Job(
        namespace="mas-news",
        regulator="MAS",
        update_type="news",
        links=tuple(
            Link(_MAS + f"/news?page=1&sort=mas_date_tdt%20desc&sectors={s}", "search")
            for s in ("Capital%20Markets", "Banking", "Payments")
        ),
    ),
}


def link_manifest(spark: SparkSession, job: Job, as_of: _dt.datetime) -> DataFrame:
    """The job's links as a control table ``(url, flow, lazy)`` — ``lazy``
    records that the page was captured after client-side rendering; year
    links run from the first year to ``as_of``'s year, newest first."""
    rows = [(lk.url, lk.flow, lk.lazy) for lk in job.links]
    manifest = spark.createDataFrame(rows, "url string, flow string, lazy boolean") if rows else None
    if job.year_links is not None:
        template, first = job.year_links
        years = (
            spark.range(1)
            .select(F.explode(F.sequence(F.lit(first), F.lit(as_of.year))).alias("year"))
            .select(
                F.replace(F.lit(template), F.lit("{year}"), F.col("year").cast("string")).alias("url"),
                F.lit("dl").alias("flow"),
                F.lit(False).alias("lazy"),
                F.col("year"),
            )
            .orderBy(F.desc("year"))
            .drop("year")
        )
        manifest = years if manifest is None else years.unionByName(manifest)
    return manifest


def captures_from_fetches(fetches: DataFrame, listing: bool = True) -> DataFrame:
    """A fetch log ``(url, attempt, status, body)`` → captures ``(url, html)``:
    the first successful attempt of each URL.  Listings count three attempts
    and need a body; feeds and detail pages count six."""
    if listing:
        resolved = resolve_fetches(fetches, success=listing_success(), max_attempts=K.LISTING_MAX_ATTEMPTS)
    else:
        resolved = resolve_fetches(fetches)
    return resolved.filter(F.col("status") == "ok").select("url", F.col("body").alias("html"))


def run_outcome(candidates: DataFrame, kept: DataFrame, expected: DataFrame) -> DataFrame:
    """Per listing, expected or met: rows, valid rows, rejects, valid rows that
    the per-link limit or de-duplication cut, status, and whether it is short."""
    listings = expected.select(F.col("url").alias("listing_url")).unionByName(candidates.select("listing_url")).distinct()
    health = source_health(candidates, listings, "listing_url", F.size("reasons") == 0)
    left = kept.filter(F.size("reasons") == 0).groupBy("listing_url").agg(F.count(F.lit(1)).alias("n_kept"))
    short = short_groups(candidates, "listing_url").select("listing_url", F.lit(True).alias("short"))
    return (
        health.join(left, "listing_url", "left")
        .join(short, "listing_url", "left")
        .select(
            "listing_url",
            "n_rows",
            "n_valid",
            (F.col("n_rows") - F.col("n_valid")).alias("n_rejected"),
            (F.col("n_valid") - F.coalesce("n_kept", F.lit(0))).alias("n_cut"),
            "status",
            (F.coalesce("short", F.lit(False)) | (F.col("n_rows") == 0)).alias("short"),
        )
    )


def read_outcome(spark: SparkSession, out_path: str) -> DataFrame:
    """The outcomes that ``run_job`` published with the live runs of ``out_path``."""
    return S.read_live(spark, out_path, S.OUTCOMES)


def run_job(
    spark: SparkSession,
    job: Job | str,
    captures: DataFrame | None,
    out_path: str | None = None,
    as_of: _dt.datetime | None = None,
    db_root: str | None = None,
    feeds_path: str | None = None,
    fetches: DataFrame | None = None,
) -> DataFrame:
    """Candidates of one namespace job from landed ``captures(url, html
    [, fetched_at])`` or a fetch log, plus landed feed files under
    ``feeds_path``; published, with the outcome, when ``out_path`` is given.

    ``as_of`` (UTC) bounds publication dates; pass it to make runs repeatable.
    A strict job raises before anything is published."""
    job = JOBS[job] if isinstance(job, str) else job
    as_of = as_of or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    base = base_url(job)
    manifest = link_manifest(spark, job, as_of)
    if fetches is not None:
        listed_pages = captures_from_fetches(fetches)
        detail_pages = captures_from_fetches(fetches, listing=False)
    else:
        listed_pages = detail_pages = captures
    frames = []
    if manifest is not None and listed_pages is not None:
        wanted = listed_pages.join(manifest.select("url").distinct(), "url", "left_semi")
        listed = PUB.manifest_join(PUB.latest_captures(wanted).select("url", "html"), manifest)
        for flow in sorted({lk.flow for lk in job.links} | ({"dl"} if job.year_links else set())):
            pages = listed.filter(F.col("flow") == flow).select("url", "html")
            if flow == "dl":
                frames.append(PUB.dl_publications(pages, base, job.update_type, job.regulator, as_of=as_of))
            elif flow == "search":
                details = detail_pages if job.enrich_details else None
                frames.append(PUB.search_publications(pages, details, base, job.update_type, job.regulator, as_of))
            elif flow == "cards":
                frames.append(PUB.card_publications(pages, detail_pages, base, as_of))
    if feeds_path:
        feed = PUB.feed_publications(read_feeds(spark, feeds_path), as_of)
        frames.append(
            feed.withColumn("regulator", F.lit(job.regulator)).withColumn("type", F.lit(job.update_type))
        )
    if job.use_database and db_root:
        frames.append(
            PUB.db_publications(spark, db_root, job.update_type, base, job.regulator, K.PER_LINK_LATEST, as_of=as_of)
        )
    if not frames:
        raise ValueError(f"job {job.namespace} has no sources")
    # extraction runs once; what follows reads the written rows
    candidates = written(spark, S.union_sources(*frames), f"candidates-{job.namespace}")
    judged = PUB.atomic_pages(candidates) if job.page_atomic else candidates
    limited = F.col("source").isin("dl", "search", "cards")
    kept = PUB.keep_latest(judged.filter(limited), job.per_link).unionByName(judged.filter(~limited))
    if job.dedupe_on:
        kept = PUB.first_per_url(kept, job.dedupe_on)
    outcome = written(
        spark,
        run_outcome(judged, kept, manifest if manifest is not None else candidates.select(F.col("listing_url").alias("url"))),
        f"outcome-{job.namespace}",
    )
    if job.strict:
        require_healthy(outcome, "listing_url")
    if out_path:
        PUB.publish([(job.namespace, kept)], out_path, {job.namespace: outcome})
    return kept
