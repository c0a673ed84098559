"""Followers, organizations, watchers and project members.

Staged rows are reduced to one per natural key before they meet the users and
projects tables, so a very popular user or project costs one lookup per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.operators.changes import insert_missing, kept, update_later, upsert
from forgelake.operators.lookup import project_keys, user_keys


def dated_pairs(staged: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with its last dated sighting by (event_ts, id), null when none is dated."""
    order = F.when(F.col("event_ts").isNotNull(), F.struct("event_ts", "id"))
    return staged.groupBy(*keys).agg(F.max_by("event_ts", order).alias("event_ts"))


def with_user(df: DataFrame, users: DataFrame, login: str, id_name: str, created_name: str) -> DataFrame:
    side = user_keys(users).select(
        F.col("login").alias(login), F.col("user_id").alias(id_name), F.col("user_created_at").alias(created_name)
    )
    return df.join(side, login)


def follower_rows(staged: DataFrame, users: DataFrame) -> DataFrame:
    """follower_id, user_id, created_at, dated. `staged` has follower, followed, event_ts, id.

    Undated sightings get the later of the two accounts' creation dates.
    """
    pairs = dated_pairs(staged, ["follower", "followed"])
    named = with_user(with_user(pairs, users, "follower", "follower_id", "c1"), users, "followed", "user_id", "c2")
    return named.select(
        "follower_id", "user_id", F.coalesce("event_ts", F.greatest("c1", "c2")).alias("created_at"),
        F.col("event_ts").isNotNull().alias("dated"),
    )


def next_followers(table: DataFrame, staged: DataFrame, users: DataFrame, stored: bool = False) -> DataFrame:
    """A dated sighting overwrites the date; an undated one only inserts."""
    rows = kept(follower_rows(staged, users), stored)
    keys = ["follower_id", "user_id"]
    inserted = insert_missing(table, rows.drop("dated"), keys, ["created_at"], stored)
    return upsert(inserted, rows.filter("dated").drop("dated"), keys, ["created_at"], stored=stored)


def watcher_rows(staged: DataFrame, projects: DataFrame, users: DataFrame) -> DataFrame:
    """repo_id, user_id, created_at. `staged` has owner, repo, login, event_ts, record_ts, id.

    The date is the event's, else the record's, else the later of the project's
    and the user's creation.
    """
    keys = ["owner", "repo", "login"]
    order = F.when(F.col("event_ts").isNotNull(), F.struct("event_ts", "id"))
    reduced = staged.groupBy(*keys).agg(F.max_by("event_ts", order).alias("event_ts"), F.max("record_ts").alias("record_ts"))
    named = reduced.join(project_keys(projects, users), ["owner", "repo"]).join(user_keys(users), "login")
    return named.select(
        F.col("project_id").alias("repo_id"), "user_id",
        F.coalesce("event_ts", "record_ts", F.greatest("project_created_at", "user_created_at")).alias("created_at"),
    )


def next_watchers(table: DataFrame, staged: DataFrame, projects: DataFrame, users: DataFrame, stored: bool = False) -> DataFrame:
    return update_later(table, watcher_rows(staged, projects, users), ["repo_id", "user_id"], "created_at", stored)


def project_member_rows(staged: DataFrame, projects: DataFrame, users: DataFrame) -> DataFrame:
    """repo_id, user_id, created_at from membership events (owner, repo, login, event_ts)."""
    reduced = staged.groupBy("owner", "repo", "login").agg(F.min("event_ts").alias("event_ts"))
    named = reduced.join(project_keys(projects, users), ["owner", "repo"]).join(user_keys(users), "login")
    return named.select(
        F.col("project_id").alias("repo_id"), "user_id",
        F.coalesce("event_ts", F.greatest("project_created_at", "user_created_at")).alias("created_at"),
    )


def next_project_members(
    table: DataFrame, staged: DataFrame, projects: DataFrame, users: DataFrame, stored: bool = False
) -> DataFrame:
    return insert_missing(table, project_member_rows(staged, projects, users), ["repo_id", "user_id"], ["created_at"], stored)


def organization_member_rows(staged: DataFrame, users: DataFrame) -> DataFrame:
    """org_id, user_id from member listings (org, login); only organizations have members."""
    orgs = users.filter("type = 'ORG'").select(F.col("login").alias("org"), F.col("id").alias("org_id"))
    members = users.select("login", F.col("id").alias("user_id"))
    return staged.select("org", "login").distinct().join(orgs, "org").join(members, "login").select("org_id", "user_id")


def next_organization_members(table: DataFrame, staged: DataFrame, users: DataFrame) -> DataFrame:
    return insert_missing(table, organization_member_rows(staged, users), ["org_id", "user_id"])
