"""Repair jobs over stored tables; each returns the repaired table and its counters."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.functions.scalars import url_owner, url_repo
from forgelake.operators.builders.tracker import commit_comment_rows, issue_label_rows, labelled_issues, next_history
from forgelake.operators.changes import delete, delete_by_join, insert_missing, one_per_key, replace
from forgelake.operators.history import TOLERANCE_SECONDS, history_candidates
from forgelake.operators.keys import append_with_ids
from forgelake.operators.lookup import events_by_id, merged_by_commits, merged_by_history, pr_lookup, project_keys, replace_set


class Repaired(NamedTuple):
    table: DataFrame
    counts: DataFrame


def comment_number(raw: DataFrame) -> DataFrame:
    """The pull request number as integer, from issue_id when it is missing; issue_id goes."""
    number = F.coalesce(F.col("pullreq_id").try_cast("bigint"), F.col("issue_id").try_cast("bigint"))
    return raw.withColumn("pullreq_id", number).drop("issue_id")


def unique_pr_comments(raw: DataFrame, order: str = "seq") -> Repaired:
    """One review comment per id: the last inserted. Counts duplicates and rows without any number."""
    last = one_per_key(raw, ["id"], [order], last=True)
    counts = raw.groupBy("id").agg(
        F.count("*").alias("n"),
        F.max_by(F.struct("pullreq_id", "issue_id"), order).alias("last"),
    ).agg(
        F.count("*").alias("processed"), F.sum(F.col("n") - 1).alias("duplicates"),
        F.count_if(F.col("last.pullreq_id").isNull()).alias("no_pullreq_id"),
        F.count_if(F.col("last.pullreq_id").isNull() & F.col("last.issue_id").isNull()).alias("no_number"),
    )
    return Repaired(comment_number(last), counts)


def commit_owners(commits: DataFrame, urls: DataFrame, projects: DataFrame, users: DataFrame) -> Repaired:
    """The project of a commit becomes the repository in its URL, null when that is gone.

    `urls` has sha and url, one per sha. Counts examined, changed and orphaned commits.
    """
    wanted = urls.select("sha", url_owner(F.col("url")).alias("owner"), url_repo(F.col("url")).alias("repo")).join(
        project_keys(projects, users).select("owner", "repo", F.col("project_id").alias("wanted")), ["owner", "repo"], "left"
    ).select("sha", "wanted", F.lit(True).alias("listed"))
    joined = commits.join(wanted, "sha", "left")
    counts = joined.agg(
        F.count("listed").alias("examined"),
        F.count_if(F.col("listed") & ~F.col("wanted").eqNullSafe(F.col("project_id"))).alias("changed"),
        F.count_if(F.col("listed") & F.col("wanted").isNull()).alias("orphaned"),
    )
    fixed = joined.select(*[
        F.when(F.col("listed"), F.col("wanted")).otherwise(F.col(c)).alias(c) if c == "project_id" else F.col(c)
        for c in commits.columns
    ])
    return Repaired(fixed, counts)


def drop_associations(project_commits: DataFrame, commits: DataFrame, urls: DataFrame) -> DataFrame:
    """Associations of the re-owned commits are dropped; they are rebuilt from their pull requests."""
    ids = commits.join(urls.select("sha"), "sha", "left_semi").select(F.col("id").alias("commit_id"))
    return delete_by_join(project_commits, ids, ["commit_id"])


def replace_pr_commits(pr_commits: DataFrame, fresh: DataFrame) -> Repaired:
    """The commit set of each listed pull request is exchanged. Counts removed and added rows."""
    owners = fresh.select("pull_request_id").distinct()
    removed = pr_commits.join(owners, "pull_request_id", "left_semi").agg(F.count("*").alias("n")).select(F.lit("removed").alias("what"), "n")
    added = fresh.distinct().agg(F.count("*").alias("n")).select(F.lit("added").alias("what"), "n")
    return Repaired(replace_set(pr_commits, fresh, ["pull_request_id"]), removed.unionByName(added))


def fork_parents(projects: DataFrame, repos: DataFrame, users: DataFrame) -> Repaired:
    """forked_from from the records' parents, where it is null or different.

    `repos` has owner, name, parent_owner, parent_name. Counts examined, fixed
    and parents that do not exist.
    """
    keys = project_keys(projects, users)
    parents = keys.select(F.col("owner").alias("parent_owner"), F.col("repo").alias("parent_name"), F.col("project_id").alias("parent_id"))
    forks = keys.select("owner", F.col("repo").alias("name"), F.col("project_id").alias("id"))
    links = repos.filter("parent_name is not null").join(parents, ["parent_owner", "parent_name"], "left").join(forks, ["owner", "name"]).select(
        "id", "parent_id", F.lit(True).alias("listed")
    )
    joined = projects.join(links, "id", "left")
    wrong = F.col("parent_id").isNotNull() & ~F.col("forked_from").eqNullSafe(F.col("parent_id"))
    counts = joined.agg(
        F.count("listed").alias("examined"), F.count_if(wrong).alias("fixed"),
        F.count_if(F.col("listed") & F.col("parent_id").isNull()).alias("no_parent"),
    )
    fixed = joined.select(*[
        F.when(wrong, F.col("parent_id")).otherwise(F.col(c)).alias(c) if c == "forked_from" else F.col(f"`{c}`")
        for c in projects.columns
    ])
    return Repaired(fixed, counts)


def rebuild_history(
    history: DataFrame, raw_prs: DataFrame, prs: DataFrame, projects: DataFrame, users: DataFrame,
    tolerance: int = TOLERANCE_SECONDS,
) -> DataFrame:
    """Drop the history of the listed pull requests and build it anew from their records."""
    named = raw_prs.join(pr_lookup(prs, projects, users), ["owner", "repo", "number"])
    kept = delete_by_join(history, named, ["pull_request_id"])
    return next_history(kept, history_candidates(named), users, tolerance)


def backfill_history(
    history: DataFrame, ids: DataFrame, pr_events: DataFrame, prs: DataFrame, projects: DataFrame, users: DataFrame,
    tolerance: int = TOLERANCE_SECONDS,
) -> DataFrame:
    """Add the actions of stored events (owner, repo, number, action, actor, created_at, id), picked by id."""
    picked = events_by_id(ids, pr_events).join(pr_lookup(prs, projects, users), ["owner", "repo", "number"])
    return next_history(history, picked.select("pull_request_id", "action", "created_at", "actor", "id"), users, tolerance)


def missing_issue_labels(
    issue_labels: DataFrame, raw_issues: DataFrame, labels: DataFrame, issues: DataFrame, projects: DataFrame, users: DataFrame
) -> DataFrame:
    """Labels that raw issues carry and the table lacks."""
    rows = issue_label_rows(labelled_issues(raw_issues), labels, issues, projects, users)
    return insert_missing(issue_labels, rows, ["label_id", "issue_id"])


def fake_flags(users: DataFrame, accounts: DataFrame) -> DataFrame:
    """fake is true exactly when no account with the login exists."""
    exists = accounts.select("login").distinct().withColumn("exists_upstream", F.lit(True))
    return users.join(exists, "login", "left").select(*[
        F.col("exists_upstream").isNull().alias(c) if c == "fake" else F.col(f"`{c}`") for c in users.columns
    ])


def reload_comments(table: DataFrame, raw: DataFrame, commits: DataFrame, users: DataFrame) -> DataFrame:
    """Delete the listed comments and store again those whose commit and author are known."""
    rows = commit_comment_rows(raw, commits, users)
    kept = table.join(raw.select(F.col("id").alias("comment_id")), "comment_id", "left_anti").select(*table.columns)
    return append_with_ids(kept, rows, ["comment_id"])


def delete_comment(table: DataFrame, comment_id: int) -> DataFrame:
    kept, _ = delete(table, F.col("comment_id") == comment_id)
    return kept


def fork_column(projects: DataFrame, forks: DataFrame) -> DataFrame:
    """forked_from from old fork edges (forked_project_id, forked_from_id); the first edge counts."""
    edges = forks.groupBy(F.col("forked_project_id").alias("id")).agg(F.min("forked_from_id").alias("source"))
    known = edges.join(projects.select(F.col("id").alias("source")), "source", "left_semi")
    return projects.join(known, "id", "left").select(*[
        F.coalesce("source", "forked_from").alias(c) if c == "forked_from" else F.col(f"`{c}`") for c in projects.columns
    ])


def merge_flags(prs: DataFrame, pr_commits: DataFrame, project_commits: DataFrame, history: DataFrame) -> DataFrame:
    """Pull requests with `merged` inferred and intra_branch corrected."""
    merged = merged_by_commits(prs, pr_commits, project_commits).unionByName(merged_by_history(prs, history)).distinct()
    flags = merged.withColumn("is_merged", F.lit(True))
    same = F.coalesce(F.col("base_repo_id") == F.col("head_repo_id"), F.lit(False))
    columns = [c for c in prs.columns if c != "merged"]
    return prs.join(flags, "id", "left").select(
        *[(F.coalesce(c, F.lit(False)) | same).alias(c) if c == "intra_branch" else F.col(c) for c in columns],
        F.coalesce("is_merged", F.lit(False)).alias("merged"),
    )


def replace_raw(collection: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    return replace(collection, fresh, keys)
