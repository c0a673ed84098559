"""Event handlers: events of one type in, staged rows for the builders out.

Handlers are narrow projections over one event table. Users add an event type by
adding an entry to the registry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions.scalars import (
    forge_ts, full_name_owner, full_name_repo, is_sha, last_segment, url_owner, url_repo, url_sha, watcher_profile,
)
from forgelake.operators.changes import upsert
from forgelake.operators.lookup import registered_commits
from forgelake.operators.running import running_max

LARGE_PUSH = 20  # Fixed value: pushes of this size may hide older commits

Staged = dict[str, DataFrame]


def of_type(events: DataFrame, name: str) -> DataFrame:
    return events.filter(F.col("type") == name)


def event_number() -> Column:
    return F.col("id").try_cast("bigint")


def repo_columns() -> list[Column]:
    return [full_name_owner(F.col("repo.name")).alias("owner"), full_name_repo(F.col("repo.name")).alias("repo")]


def event_ts() -> Column:
    return forge_ts(F.col("created_at").cast("string"))


def push(events: DataFrame) -> Staged:
    """Commits of pushes; owner, repository and sha come from the commit's URL."""
    commits = of_type(events, "PushEvent").select(
        event_number().alias("event_id"), F.posexplode("payload.commits").alias("pos", "c")
    )
    located = commits.select(
        "event_id", "pos", url_owner(F.col("c.url")).alias("owner"), url_repo(F.col("c.url")).alias("repo"),
        url_sha(F.col("c.url")).alias("sha"),
    )
    return {"commits": located.filter(is_sha(F.col("sha")))}


def large_pushes(events: DataFrame) -> DataFrame:
    """Pushes with 20 or more commits: repository and the last commit they list."""
    pushes = of_type(events, "PushEvent").filter(F.size("payload.commits") >= LARGE_PUSH)
    return pushes.select(
        event_number().alias("event_id"), *repo_columns(),
        url_sha(F.element_at("payload.commits", -1)["url"]).alias("last_sha"),
    )


def older_commits(
    events: DataFrame, feed: DataFrame, commits: DataFrame, project_commits: DataFrame, projects: DataFrame, users: DataFrame
) -> DataFrame:
    """Commits behind large pushes: from the last listed one down to the first registered one.

    `feed` is each repository's commit list (owner, repo, pos, sha), newest first.
    """
    starts = large_pushes(events).select("owner", "repo", F.col("last_sha").alias("sha")).distinct().withColumn("is_start", F.lit(True))
    pushed = push(events)["commits"].select("owner", "repo", "sha").distinct().withColumn("is_pushed", F.lit(True))
    repos = starts.select("owner", "repo").distinct()
    lists = feed.join(repos, ["owner", "repo"], "left_semi")
    known = registered_commits(lists, commits, project_commits, projects, users).withColumn("is_known", F.lit(True))
    keys = ["owner", "repo", "sha"]
    marked = lists.join(starts, keys, "left").join(pushed, keys, "left").join(known, keys, "left").select(
        *keys, "pos", "is_pushed", "is_known",
        F.when(F.col("is_start"), F.col("pos")).alias("start"),
        F.when(F.col("is_known") & F.col("is_pushed").isNull(), F.col("pos")).alias("stop"),
    )
    placed = running_max(marked, ["owner", "repo"], "pos", ["start", "stop"])
    reached = F.col("last_start").isNotNull() & (F.col("last_stop").isNull() | (F.col("last_start") > F.col("last_stop")))
    return placed.filter(reached & F.col("is_known").isNull() & F.col("is_pushed").isNull()).select(*keys).distinct()


def watch(events: DataFrame) -> Staged:
    """Full watcher records and dated watcher sightings."""
    stars = of_type(events, "WatchEvent")
    sightings = stars.select(
        *repo_columns(), F.col("actor.login").alias("login"), event_ts().alias("event_ts"),
        F.lit(None).cast("timestamp").alias("record_ts"), event_number().alias("id"),
    )
    return {"watcher_records": watcher_profile(stars), "watchers": sightings}


def follow(events: DataFrame) -> Staged:
    return {"followers": of_type(events, "FollowEvent").select(
        F.col("actor.login").alias("follower"), F.col("payload.target.login").alias("followed"),
        event_ts().alias("event_ts"), event_number().alias("id"),
    )}


def member(events: DataFrame) -> Staged:
    """Membership sightings; the owner is the acting user."""
    return {"project_members": of_type(events, "MemberEvent").select(
        F.col("actor.login").alias("owner"), full_name_repo(F.col("repo.name")).alias("repo"),
        F.col("payload.member.login").alias("login"), event_ts().alias("event_ts"),
    )}


def commit_comment(events: DataFrame) -> Staged:
    return {"commit_comments": of_type(events, "CommitCommentEvent").select(
        *repo_columns(), F.col("payload.comment.id").alias("comment_id"), F.col("payload.comment.commit_id").alias("sha")
    )}


def pull_request(events: DataFrame) -> Staged:
    """Raw pull request records under base owner, base repository and number, with the event's own action."""
    return {"pull_requests": of_type(events, "PullRequestEvent").select(
        F.col("payload.pull_request.base.repo.owner.login").alias("owner"),
        F.col("payload.pull_request.base.repo.name").alias("repo"),
        F.col("payload.number").alias("number"),
        F.col("payload.pull_request.created_at").alias("created_at"),
        F.col("payload.pull_request.merged_at").alias("merged_at"),
        F.col("payload.pull_request.closed_at").alias("closed_at"),
        F.col("payload.pull_request.user").alias("user"),
        F.col("payload.pull_request.merged_by").alias("merged_by"),
        F.col("payload.pull_request.head").alias("head"),
        F.col("payload.pull_request.base").alias("base"),
        F.col("payload.action").alias("event_action"), F.col("actor.login").alias("event_actor"),
        event_ts().alias("event_ts"), event_number().alias("event_id"),
    )}


def fork(events: DataFrame) -> Staged:
    return {"forks": of_type(events, "ForkEvent").select(
        *repo_columns(), F.col("payload.forkee.id").alias("id"), F.col("payload.forkee.url").alias("url"),
        F.col("payload.forkee.full_name").alias("full_name"), event_number().alias("event_id"),
    )}


def review_comment(events: DataFrame) -> Staged:
    """Review comment keys; the pull request number is the last segment of its link."""
    return {"pull_request_comments": of_type(events, "PullRequestReviewCommentEvent").select(
        *repo_columns(), F.col("payload.comment.id").alias("comment_id"),
        last_segment(F.col("payload.comment._links.pull_request.href")).try_cast("bigint").alias("number"), event_number().alias("event_id"),
    )}


def issue(events: DataFrame) -> Staged:
    return {"issues": of_type(events, "IssuesEvent").select(
        *repo_columns(), F.col("payload.issue.number").alias("number"), event_number().alias("event_id")
    )}


def issue_comment(events: DataFrame) -> Staged:
    return {"issue_comments": of_type(events, "IssueCommentEvent").select(
        *repo_columns(), F.col("payload.issue.number").alias("number"), F.col("payload.comment.id").alias("comment_id"),
        event_number().alias("event_id"),
    )}


def create(events: DataFrame) -> Staged:
    """Repositories that were created; other creations (branches, tags) are skipped."""
    return {"repos": of_type(events, "CreateEvent").filter("payload.ref_type = 'repository'").select(*repo_columns())}


HANDLERS: dict[str, Callable[[DataFrame], Staged]] = {
    "PushEvent": push,
    "WatchEvent": watch,
    "FollowEvent": follow,
    "MemberEvent": member,
    "CommitCommentEvent": commit_comment,
    "PullRequestEvent": pull_request,
    "ForkEvent": fork,
    "PullRequestReviewCommentEvent": review_comment,
    "IssuesEvent": issue,
    "IssueCommentEvent": issue_comment,
    "CreateEvent": create,
}


def stage_events(events: DataFrame, handlers: dict[str, Callable[[DataFrame], Staged]] = HANDLERS) -> Staged:
    """All staged frames of a batch, by name."""
    staged: Staged = {}
    for handler in handlers.values():
        for name, rows in handler(events).items():
            staged[name] = staged[name].unionByName(rows, allowMissingColumns=True) if name in staged else rows
    return staged


def upsert_raw(collection: DataFrame, staged: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the raw collection current: later records of a key replace the fields they carry."""
    return upsert(collection, staged, keys, order)
