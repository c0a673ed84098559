"""Three-way synchronisation of projects, and refresh of users and stale projects."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions.scalars import forge_ts, user_type
from forgelake.operators.builders.code import set_parents
from forgelake.operators.changes import delete_by_join, replace, soft_delete, touch
from forgelake.operators.geo import enrich_users
from forgelake.operators.keys import append_with_ids
from forgelake.operators.lookup import project_keys, stale

PROJECT = ["owner", "name"]


def presence(keys: DataFrame, raw: DataFrame, feed: DataFrame, table: DataFrame) -> DataFrame:
    """Presence of each project in the raw store, the fresh feed and the table, and what to do.

    `keys` lists the projects to synchronise; `feed` has owner, name and, for
    answers that failed, is_error. All sides are unique by (owner, name).
    """
    error = F.coalesce(F.col("is_error"), F.lit(False)) if "is_error" in feed.columns else F.lit(False)
    sides = (
        keys.select(*PROJECT).distinct()
        .join(raw.select(*PROJECT).distinct().withColumn("in_raw", F.lit(True)), PROJECT, "left")
        .join(feed.select(*PROJECT, (~error).alias("answered")).withColumn("is_failed", ~F.col("answered")), PROJECT, "left")
        .join(table.select(*PROJECT).distinct().withColumn("in_table", F.lit(True)), PROJECT, "left")
    )
    flat = sides.select(
        *PROJECT, F.coalesce("in_raw", F.lit(False)).alias("in_raw"), F.coalesce("answered", F.lit(False)).alias("in_feed"),
        F.coalesce("in_table", F.lit(False)).alias("in_table"), F.coalesce("is_failed", F.lit(False)).alias("is_failed"),
    )
    action = (
        F.when(F.col("is_failed"), "none")
        .when(F.col("in_feed") & F.col("in_table"), "update")
        .when(F.col("in_feed"), "insert")
        .when(F.col("in_table"), "delete")
        .otherwise("none")
    )
    raw_action = F.when(F.col("is_failed") | ~F.col("in_feed"), "none").when(F.col("in_raw"), "replace").otherwise("store")
    return flat.select(*PROJECT, "in_raw", "in_feed", "in_table", "is_failed", action.alias("action"), raw_action.alias("raw_action"))


def full_presence(raw: DataFrame, feed: DataFrame, table: DataFrame) -> DataFrame:
    """Presence over everything any side knows."""
    keys = raw.select(*PROJECT).unionByName(feed.select(*PROJECT)).unionByName(table.select(*PROJECT))
    return presence(keys, raw, feed, table)


class Synced(NamedTuple):
    projects: DataFrame
    raw: DataFrame
    forks_to_rebuild: DataFrame  # project_id of updated forks, whose commits are built anew
    refreshed: DataFrame  # project_id of updated projects: languages and topics follow


def sync_projects(
    projects: DataFrame, users: DataFrame, raw: DataFrame, feed: DataFrame, fork_points: DataFrame, now: Column,
    worklist: DataFrame | None = None,
) -> Synced:
    """Apply the presence decision to the table and to the raw store.

    `raw` has owner, name and its record columns; `feed` the same columns plus
    parent_owner and parent_name, and is_error. `fork_points` has owner, name and
    fork_commit_id. With a `worklist` (owner, name) only its projects are synchronised,
    without one everything that any side knows.
    """
    keys = project_keys(projects, users).withColumnRenamed("repo", "name")
    plan = full_presence(raw, feed, keys) if worklist is None else presence(worklist, raw, feed, keys)
    owners = users.select(F.col("login").alias("owner"), F.col("id").alias("owner_id"))
    answered = feed.join(plan.filter("in_feed").select(*PROJECT, "action"), PROJECT).join(owners, "owner")

    gone = plan.filter("action = 'delete'").join(keys.select(*PROJECT, F.col("project_id").alias("id")), PROJECT)
    marked = soft_delete(projects, gone, ["id"])

    fields = ["url", "description", "language", "created_at"]
    points = fork_points.select(*PROJECT, "fork_commit_id")
    news = answered.join(points, PROJECT, "left").select(
        "owner_id", "name", F.lit(True).alias("is_fresh"), *[F.col(f).alias(f"new_{f}") for f in fields],
        F.col("fork_commit_id").alias("new_point"), "parent_owner", "parent_name",
    )
    values = {f: F.when(F.col("is_fresh"), F.col(f"new_{f}")).otherwise(F.col(f)) for f in fields}
    values["updated_at"] = F.when(F.col("is_fresh"), now).otherwise(F.col("updated_at"))
    values["forked_commit_id"] = F.when(F.col("is_fresh"), F.col("new_point")).otherwise(F.col("forked_commit_id"))
    values["forked_from"] = F.when(F.col("is_fresh"), F.lit(None)).otherwise(F.col("forked_from"))
    updated = marked.join(news, ["owner_id", "name"], "left").select(*[
        values.get(c, F.col(f"`{c}`")).alias(c) for c in projects.columns
    ])
    fresh = news.select(
        "owner_id", "name", *[F.col(f"new_{f}").alias(f) for f in fields], F.lit(False).alias("deleted"),
        now.alias("updated_at"), F.col("new_point").alias("forked_commit_id"),
    )
    table = set_parents(append_with_ids(updated, fresh, ["owner_id", "name"]), news, users)
    ids = table.select("owner_id", "name", F.col("id").alias("project_id"))
    refreshed = news.join(ids, ["owner_id", "name"])
    stored = replace(raw, feed.join(plan.filter("raw_action != 'none'"), PROJECT, "left_semi").select(*raw.columns), PROJECT)
    return Synced(
        table, stored, refreshed.filter("parent_name is not null").select("project_id"), refreshed.select("project_id")
    )


def rebuild_fork_commits(project_commits: DataFrame, forks: DataFrame, inherited: DataFrame) -> DataFrame:
    """Exchange the commits of the given forks for the inherited ones."""
    kept = delete_by_join(project_commits, forks, ["project_id"])
    wanted = inherited.join(forks.select("project_id"), "project_id", "left_semi")
    return kept.unionByName(wanted.select(*project_commits.columns).distinct())


def refresh_users(users: DataFrame, worklist: DataFrame, feed: DataFrame, geo_cache: DataFrame, now: Column) -> DataFrame:
    """Overwrite the profile of listed users with the fresh record; absent upstream means soft deletion.

    `worklist` has login; `feed` has the raw user record, one per login.
    """
    profile = feed.select(
        "login", "name", "company", "email", "location", user_type(F.col("type")).alias("type"),
        forge_ts(F.col("created_at").cast("string")).alias("created_at"),
    )
    listed = worklist.select("login").distinct().withColumn("is_listed", F.lit(True))
    fresh = profile.select("login", F.struct("name", "company", "email", "location", "type").alias("p"))
    joined = users.join(listed, "login", "left").join(fresh, "login", "left")
    hit = F.col("is_listed") & F.col("p").isNotNull()
    lost = F.col("is_listed") & F.col("p").isNull()
    values = {c: F.when(hit, F.col(f"p.{c}")).otherwise(F.col(c)) for c in ("name", "company", "email", "location", "type")}
    values["deleted"] = F.when(hit, F.lit(False)).when(lost, F.lit(True)).otherwise(F.col("deleted"))
    values["fake"] = F.when(hit, F.lit(False)).otherwise(F.col("fake"))
    values["updated_at"] = F.when(hit, now).otherwise(F.col("updated_at"))
    overwritten = joined.select(*[values.get(c, F.col(f"`{c}`")).alias(c) for c in users.columns])
    unseen = profile.join(listed, "login", "left_semi").withColumns(
        {"fake": F.lit(False), "deleted": F.lit(False), "updated_at": now}
    )
    inserted = append_with_ids(overwritten, unseen, ["login"])
    located = inserted.join(feed.select("login").join(listed, "login", "left_semi"), "login", "left_semi")
    others = inserted.join(located.select("login"), "login", "left_anti")
    return others.select(*users.columns).unionByName(enrich_users(located, geo_cache).select(*users.columns))


def refresh_stale(projects: DataFrame, fresh: DataFrame, now: Column, days: int = 10) -> DataFrame:
    """Touch stale projects that the fresh listing (id) confirms."""
    due = stale(projects, now, days).select("id").join(fresh.select("id"), "id", "left_semi")
    return touch(projects, due, ["id"], now)
