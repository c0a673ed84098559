"""Fork points and the commits forks inherit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.operators.lookup import commits_before


def diff_rows(diffs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged branch diffs as flat rows: (heads, diverging commits, their parents)."""
    heads = diffs.select(
        "fork_id", F.coalesce("ahead_by", F.lit(0)).alias("ahead_by"), F.col("merge_base_commit.sha").alias("merge_base")
    )
    commits = diffs.select("fork_id", F.explode("commits").alias("c")).select(
        "fork_id", F.col("c.sha").alias("sha"), F.col("c.commit.author.date").alias("date"), F.col("c.parents").alias("parents")
    )
    parents = commits.select("fork_id", "sha", F.explode("parents").alias("p")).select("fork_id", "sha", F.col("p.sha").alias("parent_sha"))
    return heads, commits.select("fork_id", "sha", "date"), parents


def fork_points(forks: DataFrame, heads: DataFrame, diverging: DataFrame, parents: DataFrame, commits: DataFrame) -> DataFrame:
    """fork_id -> sha of the commit the fork was made at, null when unknown.

    A known fork point stays. Without a diff there is none. A fork that is not
    ahead forked at the merge base. Otherwise the earliest diverging commit
    decides: it is the fork point itself when it has no parents, else its
    latest known parent is. Ties are settled by sha.
    """
    first = diverging.groupBy("fork_id").agg(F.min_by("sha", F.struct("date", "sha")).alias("first_sha"))
    # Only the parents of the decisive commits are looked up among all commits.
    edges = parents.join(first.withColumnRenamed("first_sha", "sha"), ["fork_id", "sha"])
    dated = edges.join(commits.select(F.col("sha").alias("parent_sha"), "created_at"), "parent_sha", "left")
    chosen = dated.groupBy("fork_id").agg(
        F.max_by("parent_sha", F.when(F.col("created_at").isNotNull(), F.struct("created_at", "parent_sha"))).alias("parent_sha"),
        F.lit(True).alias("has_parents"),
    )
    diverged = F.when(F.col("has_parents"), F.col("parent_sha")).otherwise(F.col("first_sha"))
    return (
        forks.select("fork_id", "fork_sha")
        .join(heads, "fork_id", "left").join(first, "fork_id", "left").join(chosen, "fork_id", "left")
        .select(
            "fork_id",
            F.coalesce(
                "fork_sha",
                F.when(F.col("ahead_by") > 0, diverged).otherwise(F.col("merge_base")),
            ).alias("fork_sha"),
        )
    )


def strategy_of(setting: str | None) -> str:
    """`all`, `fork_point` or `none`; unknown settings mean `fork_point`."""
    text = (setting or "").lower()
    for name in ("all", "fork_point", "none"):
        if name in text:
            return name
    return "fork_point"


def own_commits(feed: DataFrame, points: DataFrame) -> DataFrame:
    """Commits a fork added: its feed from the head down to, without, the fork commit.

    The feed carries page and pos. A fork whose commit does not occur in the
    feed keeps the whole feed; a fork without a known fork point gets nothing.
    """
    known = points.filter("fork_sha is not null")
    place = F.struct("page", "pos")
    cuts = feed.join(known.withColumnRenamed("fork_sha", "sha"), ["fork_id", "sha"], "left_semi").groupBy("fork_id").agg(
        F.min(place).alias("cut")
    )
    return (
        feed.join(known.select("fork_id"), "fork_id", "left_semi")
        .join(cuts, "fork_id", "left")
        .filter(F.col("cut").isNull() | (place < F.col("cut")))
        .select("fork_id", "sha")
        .distinct()
    )


def inherit_commits(
    strategy: str, feed: DataFrame, points: DataFrame, forks: DataFrame, project_commits: DataFrame, commits: DataFrame
) -> DataFrame:
    """(project_id, commit_id) pairs a fork gets under a strategy.

    `forks` has fork_id and parent_id (project ids); `points` has fork_id, fork_sha.
    `all` adds the parent's commits created strictly before the fork commit.
    """
    strategy = strategy_of(strategy)
    ids = commits.select("sha", F.col("id").alias("commit_id"))
    own = own_commits(feed, points).join(ids, "sha").select(F.col("fork_id").alias("project_id"), "commit_id")
    if strategy == "none":
        return own.limit(0)
    if strategy == "fork_point":
        return own
    dated = points.join(commits.select(F.col("sha").alias("fork_sha"), F.col("created_at").alias("fork_ts")), "fork_sha")
    sides = forks.join(dated.select("fork_id", "fork_ts"), "fork_id")
    return own.unionByName(commits_before(project_commits, commits, sides)).distinct()
