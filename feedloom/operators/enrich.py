"""J2 star enrichment, J5 relationship edges, G1 run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.extract import repo_key


def with_repo_stars(papers: DataFrame, stars: DataFrame, link_col: str = "github_url") -> DataFrame:
    """J2 + P11: left join to a star snapshot keyed ``(owner, repo)``.
    No link -> null link and null stars; unknown repo -> null stars.

    Papers without a repository key, a single hot null key otherwise, get
    keys of their own kind that match nothing and spread over the tasks.  Both
    sides can be large, so the join is left to the planner."""
    from feedloom.functions.once import compute_once
    k = repo_key(F.col(link_col))
    # the salt is a hash of the row, so that a retried task deals it alike
    salt = F.concat(F.lit("/"), F.pmod(F.xxhash64(*[F.col(c) for c in papers.columns]), F.lit(1 << 20)).cast("string"))
    keyed = compute_once(papers, __o=k["owner"], __r=k["repo"])
    keyed = keyed.select("*", F.coalesce("__o", F.lit("")).alias("__owner"), F.coalesce("__r", salt).alias("__repo"))
    # one row per repository (a snapshot may repeat a key; the highest count
    # wins), so the left join never multiplies papers
    s = (stars.where((F.col("owner") != "") & F.col("repo").isNotNull())
              .groupBy(F.col("owner").alias("__owner"), F.col("repo").alias("__repo")).agg(F.max("stars").alias("__stars")))
    return keyed.join(s, ["__owner", "__repo"], "left").select(*papers.columns, F.col("__stars").cast("bigint").alias("github_stars"))


def relationship_edges(startups: DataFrame, products: DataFrame, jobs: DataFrame,
                       papers: DataFrame | None = None) -> DataFrame:
    """``(src, rel, dst)`` edges: startup LAUNCHED product and startup
    POSTED job (one equi-join on the canonical name over both), and paper
    HAS_REPO repository (a projection of ``papers(paper_url, github_url)``)."""
    tagged = products.select("name", F.lit("LAUNCHED").alias("rel"), F.col("id").alias("dst")).unionByName(
        jobs.select("name", F.lit("POSTED").alias("rel"), F.col("id").alias("dst")))
    # an inner join on distinct names: a semi join would be pushed into both
    # branches of the union, and the startups worked out for each
    names = startups.select("name").distinct()
    edges = tagged.join(names, "name").select(F.col("name").alias("src"), "rel", "dst")
    if papers is None:
        return edges
    return edges.unionByName(papers.where(F.col("github_url").isNotNull())
                             .select(F.col("paper_url").alias("src"), F.lit("HAS_REPO").alias("rel"), F.col("github_url").alias("dst")))


def paper_summary(papers: DataFrame) -> DataFrame:
    """G1: total, distinct paper URLs, with and without a repo link."""
    return papers.agg(
        F.count(F.lit(1)).alias("total_collected"),
        F.count_distinct("paper_url").alias("unique_papers"),
        F.count_if(F.col("github_url").isNotNull()).alias("with_github"),
        F.count_if(F.col("github_url").isNull()).alias("without_github"),
    )
