"""URL filters: rules, and link-graph propagation for what no rule judges.

Rules seed the host graph: a host's trust seed is the share of its ruled pages
that rules allow, its distrust seed the share that they block.  Personalised
PageRank carries trust along links and distrust against them; a host whose
distrust exceeds its trust is blocked.  Everything is DataFrame operations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import materialise, name_of, release

DAMPING = 0.85
#: Lineage is cut (a written table) after so many rounds, and the ranks are settled when over
#: these no host's trust or distrust changed by more than this share of it, nor came up.
CUT, SETTLED = 5, 1e-4
#: A seed's mass is below every double after so many rounds (``DAMPING`` ** 4400 < 1e-308).
MOST_ROUNDS = 4400
#: A host is blocked if its distrust is more than this share of trust and distrust.
THRESHOLD = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ANCHOR = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


# FIXED VALUES: the rules of the query.
RULES = (
    Rule("org", "/", True),
    Rule("example.org", "/es/", False),
    Rule("example.org", "/en/1", False),
    Rule("com", "/fr/", True),
    Rule("com", "/de/", False),
)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Name of the longest rule that fits, else null."""
    longest_first = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.lit(r.name),
        )
        for r in longest_first
    ]
    return F.coalesce(*fits, F.lit(None).cast("string"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, w): links between different hosts; relative links stay home."""
    absolute = F.filter(
        F.regexp_extract_all("html", F.lit(_ANCHOR), 1), lambda x: x.rlike("^([A-Za-z][A-Za-z0-9+.-]*:)?//")
    )
    link = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    return (
        pages.filter("host <> '' AND html IS NOT NULL")
        .select(F.col("host").alias("src"), F.explode(absolute).alias("link"))
        .select("src", host_of(link).alias("dst"))
        .filter("dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).cast("double").alias("w"))
    )


def _change(now: str, before: str) -> Column:
    """Change of a mass as a share of the larger one; 1 for one that came up."""
    a, b = F.col(now), F.col(before)
    return F.when(a == b, F.lit(0.0)).otherwise(F.abs(a - b) / F.greatest(a, b))


def propagate(spark: SparkSession, seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """(host, trust, distrust) of all hosts, from seeds (host, trust, distrust)
    and edges (src, dst, w).  Rounds go on until the ranks are settled, however
    long a chain of links from a seed is."""
    edges = materialise(spark, edges, "host-edges")
    out_w = edges.groupBy("src").agg(F.sum("w").alias("out_w"))
    in_w = edges.groupBy("dst").agg(F.sum("w").alias("in_w"))
    edges = materialise(
        spark,
        edges.join(out_w, "src")
        .join(in_w, "dst")
        .select("src", "dst", (F.col("w") / F.col("out_w")).alias("ahead"), (F.col("w") / F.col("in_w")).alias("back")),
        "host-shares",
    )
    ends = edges.select(F.col("src").alias("host")).unionByName(edges.select(F.col("dst").alias("host")))
    nodes = materialise(
        spark,
        seeds.unionByName(ends.select("host", F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust")))
        .groupBy("host")
        .agg(F.max("trust").alias("trust0"), F.max("distrust").alias("distrust0")),
        "host-seeds",
    )
    rank = nodes.select("host", F.col("trust0").alias("trust"), F.col("distrust0").alias("distrust"))
    keep = 1 - DAMPING
    former = rank = materialise(spark, rank, "host-ranks")
    for step in range(1, MOST_ROUNDS + 1):
        sent = edges.join(rank, edges["src"] == rank["host"]).select(
            F.col("dst").alias("host"), (F.col("trust") * F.col("ahead")).alias("t"), F.lit(0.0).alias("d")
        )
        returned = edges.join(rank, edges["dst"] == rank["host"]).select(
            F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("back")).alias("d")
        )
        stay = nodes.select(
            "host", (F.col("trust0") * keep / DAMPING).alias("t"), (F.col("distrust0") * keep / DAMPING).alias("d")
        )
        rank = (
            sent.unionByName(returned)
            .unionByName(stay)
            .groupBy("host")
            .agg((F.sum("t") * DAMPING).alias("trust"), (F.sum("d") * DAMPING).alias("distrust"))
        )
        if step % CUT == 0:
            rank = materialise(spark, rank, "host-ranks")
            before = former.select("host", F.col("trust").alias("trust_was"), F.col("distrust").alias("distrust_was"))
            moved = F.greatest(_change("trust", "trust_was"), _change("distrust", "distrust_was"))
            largest = rank.join(before, "host").agg(F.max(moved)).first()[0]
            release(spark, former)
            former = rank
            if largest is None or largest <= SETTLED:
                break
    return rank


def judge_urls(
    spark: SparkSession,
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule``, ``verdict``, ``distrust`` per row.

    A null url, or one without ``://``, has an empty host and path, fits no
    rule and is allowed; null or empty html has no links; null ids and
    repeated rows pass through; an empty table gives no rows; other columns
    are not read.
    """
    url = F.coalesce(pages[name_of(url_col)], F.lit(""))
    parted = pages.select(
        pages[name_of(id_col)].alias("id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        pages[name_of(html_col)].alias("html"),
    )
    ruled = parted.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    allowed = F.col("rule").isin([r.name for r in rules if r.allow])
    counts = (
        ruled.filter("host <> ''")
        .groupBy("host")
        .agg(F.count_if(allowed).alias("good"), F.count_if(F.col("rule").isNotNull() & ~allowed).alias("bad"))
    )
    all_ruled = F.greatest(F.col("good") + F.col("bad"), F.lit(1))
    seeds = counts.select(
        "host", (F.col("good") / all_ruled).alias("trust"), (F.col("bad") / all_ruled).alias("distrust")
    )
    share = F.round(F.col("distrust") / (F.col("trust") + F.col("distrust")), 9)
    hosts = propagate(spark, seeds, host_edges(parted)).select(
        F.col("host").alias("judged"), F.coalesce(F.when(F.col("trust") + F.col("distrust") > 0, share), F.lit(0.0)).alias("distrust")
    )
    return ruled.join(hosts, ruled["host"] == hosts["judged"], "left").select(
        "id",
        "host",
        "path",
        "rule",
        F.when(allowed, "allow")
        .when(F.col("rule").isNotNull() | (F.coalesce("distrust", F.lit(0.0)) > threshold), "block")
        .otherwise("allow")
        .alias("verdict"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of ``pages``, judged."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return judge_urls(spark, pages).select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "distrust")
