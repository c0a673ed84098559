"""Whole synchronisation of projects and of users: the decision, and everything that follows from it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions.scalars import url_owner, url_repo
from forgelake.operators import forks, sync
from forgelake.operators.builders import code, people
from forgelake.operators.changes import missing, union_all
from forgelake.operators.lookup import project_keys, project_lookup
from forgelake.operators.propagate import apply_changes, change_set, propagate
from forgelake.plans.refresh import Tables, ensure_users, expand_organizations, languages_stage, store_commits, topics_stage
from forgelake.session import cut_lineage

REPO = ["owner", "name"]


class SyncedRepos(NamedTuple):
    tables: Tables
    raw_repos: DataFrame  # the raw store after the synchronisation
    changes: DataFrame  # project_id, commit_id, is_added: what changed in project_commits


def fork_place() -> Column:
    return F.concat_ws("/", "owner", "name")


def fork_commits(tables: Tables, answered: DataFrame, diffs: DataFrame) -> DataFrame:
    """owner, name and fork_sha of the answered forks: the stored fork commit, else what the branch diffs say."""
    wanted = answered.filter("parent_name is not null").select(*REPO).distinct()
    stored = project_lookup(tables["projects"], tables["users"]).select(*REPO, F.col("forked_commit_id").alias("id"))
    known = wanted.join(stored, REPO, "left").join(tables["commits"].select("id", F.col("sha").alias("fork_sha")), "id", "left")
    heads, diverging, parents = forks.diff_rows(diffs.withColumnRenamed("repo", "name").withColumn("fork_id", fork_place()))
    points = forks.fork_points(known.withColumn("fork_id", fork_place()), heads, diverging, parents, tables["commits"])
    return known.withColumn("fork_id", fork_place()).select(*REPO, "fork_id").join(points, "fork_id").select(*REPO, "fork_sha")


def sync_repos(
    tables: Tables, worklist: DataFrame, raw_repos: DataFrame, feed: DataFrame, raw: dict[str, DataFrame], now: Column,
    strategy: str = "fork_point",
) -> SyncedRepos:
    """Listed projects (owner, name) after a synchronisation, with the commits, languages and topics that follow.

    `raw_repos` and `feed` are as `sync.sync_projects` takes them. `raw` holds staged answers:
    users, repos, commits (with seq), branch_diffs and commit_pages (owner, repo, page, pos,
    sha: a fork's commits from its head down), languages and topics.

    Owners and parents that no table has are inserted first. New commits of answered projects
    are stored and go down to their forks; answered forks are worked out anew from their fork
    commit; forks that are not answered get the changes of their parent.
    """
    answered = feed.filter(~F.coalesce("is_error", F.lit(False))) if "is_error" in feed.columns else feed
    answered = cut_lineage(answered.join(worklist.select(*REPO).distinct(), REPO, "left_semi"), "answered")
    parents = answered.select(F.col("parent_owner").alias("owner"), F.col("parent_name").alias("name")).filter("owner is not null and name is not null")
    logins = answered.select("owner").unionByName(parents.select("owner")).select(F.col("owner").alias("login"))
    users = cut_lineage(ensure_users(tables["users"], logins, raw["users"], now), "users")
    known = code.repo_rows(raw["repos"])
    wanted = code.with_parents(parents, known)
    projects = cut_lineage(code.next_projects(tables["projects"], known.join(wanted, REPO, "left_semi"), users, now), "projects")
    tables = {**tables, "users": users, "projects": projects}

    points = cut_lineage(fork_commits(tables, answered, raw["branch_diffs"]), "fork_commits")
    pages = raw["commit_pages"].join(points.filter("fork_sha is not null").select("owner", F.col("name").alias("repo")), ["owner", "repo"], "left_semi")
    placed = raw["commits"].withColumns({"owner": url_owner(F.col("url")), "repo": url_repo(F.col("url"))})
    shas = union_all([
        points.select(F.col("fork_sha").alias("sha")), pages.select("sha"),
        placed.join(answered.filter("parent_name is null").select("owner", F.col("name").alias("repo")), ["owner", "repo"], "left_semi").select("sha"),
    ]).distinct()
    # Commits are rows before they are associations: whose they are is decided below.
    stored = store_commits(tables, raw["commits"].join(shas, "sha", "left_semi"), raw["users"], now)
    commits = cut_lineage(stored["commits"], "commits")
    ids = commits.select("sha", F.col("id").alias("commit_id"), "created_at")
    dated = cut_lineage(points.join(ids.withColumnRenamed("sha", "fork_sha"), "fork_sha", "left").select(*REPO, F.col("commit_id").alias("fork_commit_id"), "created_at"), "fork_commits")

    synced = sync.sync_projects(projects, stored["users"], raw_repos, feed, dated, now, worklist)
    projects = cut_lineage(synced.projects, "projects")
    keys = project_keys(projects, stored["users"]).select("owner", "repo", "project_id")
    listed = cut_lineage(synced.forks_to_rebuild, "listed")
    places = pages.select(F.concat_ws("/", "owner", "repo").alias("fork_id"), "page", "pos", "sha", "owner", "repo")
    own = forks.own_commits(places, points.select(fork_place().alias("fork_id"), "fork_sha"))
    own = own.join(places.select("fork_id", "owner", "repo").distinct(), "fork_id").join(keys, ["owner", "repo"]).join(ids, "sha").select("project_id", "commit_id")

    # New commits of answered projects that are no forks.
    roots = answered.filter("parent_name is null").select("owner", F.col("name").alias("repo")).join(keys, ["owner", "repo"]).select("project_id")
    fresh = missing(stored["project_commits"].select("project_id", "commit_id").join(roots, "project_id", "left_semi"), tables["project_commits"], ["project_id", "commit_id"])
    seeds = cut_lineage(fresh.select("project_id", "commit_id", F.lit(True).alias("is_added")).distinct(), "seeds")
    forked_at = projects.filter("forked_commit_id is not null").select(F.col("id").alias("project_id"), F.col("forked_commit_id").alias("commit_id")).join(
        ids.select("commit_id", F.col("created_at").alias("fork_ts")), "commit_id"
    ).select("project_id", "fork_ts")
    changes = cut_lineage(propagate(tables["project_commits"], projects, commits, listed, own, forked_at, seeds, strategy), "changes")

    result = {
        **tables, "users": stored["users"], "commits": commits, "commit_parents": stored["commit_parents"], "projects": projects,
        "project_commits": apply_changes(tables["project_commits"], changes),
    }
    refreshed = keys.join(synced.refreshed, "project_id", "left_semi").select("owner", "repo")
    for stage in (languages_stage, topics_stage):
        result = stage(result, raw, refreshed, now)
    return SyncedRepos(result, synced.raw, changes)


class Reconciled(NamedTuple):
    table: DataFrame
    gone: DataFrame  # stored edges of the listed accounts that the fresh listings lack; they stay in the table


def reconcile(table: DataFrame, rows: DataFrame, keys: list[str], listed: DataFrame) -> Reconciled:
    """Fresh edges against the stored ones, in both directions.

    `rows` has one row per key; `listed` (id) are the accounts whose listings were fetched.
    Stored edges keep their date. Only the edges that touch a listed account meet the fresh ones.
    """
    one, two = keys
    near = table.join(listed.select(F.col("id").alias(one)), one, "left_semi").select(*keys).unionByName(
        table.join(listed.select(F.col("id").alias(two)), two, "left_semi").select(*keys)
    )
    sides = near.select(*keys, F.lit(True).alias("is_stored"), F.lit(None).cast("boolean").alias("is_fresh")).unionByName(
        rows.select(*keys, F.lit(None).cast("boolean").alias("is_stored"), F.lit(True).alias("is_fresh"))
    )
    met = cut_lineage(sides.groupBy(*keys).agg(F.max("is_stored").alias("is_stored"), F.max("is_fresh").alias("is_fresh")).filter("is_stored is null or is_fresh is null"), "edges")
    new = rows.join(met.filter("is_stored is null").select(*keys), keys, "left_semi")
    return Reconciled(table.unionByName(new, allowMissingColumns=True), met.filter("is_fresh is null").select(*keys))


class SyncedUsers(NamedTuple):
    tables: Tables
    unfollowed: DataFrame  # follower_id, user_id: stored, but in no fresh listing
    left_organizations: DataFrame  # org_id, user_id: the same for memberships


def sync_users(tables: Tables, worklist: DataFrame, feed: DataFrame, raw: dict[str, DataFrame], geo_cache: DataFrame, now: Column) -> SyncedUsers:
    """Listed users (login) with fresh profile and place, followers, following and organizations.

    `feed` has the fresh records, one per login; a listed user without one is soft-deleted and
    nothing more. `raw` holds users, followers (login follows `follows`) and org_members (org,
    login) as listed now. An edge that is new gets the later of both accounts' creation dates.
    Members are listed for organizations only: the listed ones and those that listed users
    belong to. Accounts that listings name are inserted, new organizations with their members.
    As no listing says when an edge ended, edges that are no longer listed are reported, not removed.
    """
    before = tables["users"]
    users = cut_lineage(sync.refresh_users(before, worklist, feed, geo_cache, now), "users")
    answered = cut_lineage(worklist.select("login").distinct().join(feed.select("login"), "login", "left_semi"), "answered")

    def both_ways(rows: DataFrame, columns: list[str]) -> DataFrame:
        parts = [rows.join(answered.withColumnRenamed("login", c), c, "left_semi").select(*columns) for c in columns]
        return cut_lineage(parts[0].unionByName(parts[1]).distinct(), "listed_edges")

    edges = both_ways(raw["followers"], ["login", "follows"])
    belongs = raw["org_members"].join(answered, "login", "left_semi").select("org", "login")
    named = union_all([edges.select("login"), edges.select(F.col("follows").alias("login")), belongs.select(F.col("org").alias("login"))])
    users = cut_lineage(ensure_users(users, named, raw["users"], now), "users")
    # Members of every organization concerned; listings of accounts that are none don't count.
    orgs = users.filter("type = 'ORG'").select(F.col("login").alias("org"))
    concerned = belongs.select("org").unionByName(answered.select(F.col("login").alias("org"))).distinct().join(orgs, "org", "left_semi")
    members = cut_lineage(raw["org_members"].select("org", "login").join(concerned, "org", "left_semi").unionByName(belongs).distinct(), "listed_members")
    users = cut_lineage(ensure_users(users, members, raw["users"], now), "users")

    listed = users.join(answered, "login", "left_semi").select("id")
    sighted = edges.select(F.col("login").alias("follower"), F.col("follows").alias("followed"), F.lit(None).cast("timestamp").alias("event_ts"), F.lit(0).alias("id"))
    followers = reconcile(tables["followers"], people.follower_rows(sighted, users).drop("dated"), ["follower_id", "user_id"], listed)
    expanded = users.join(concerned.withColumnRenamed("org", "login"), "login", "left_semi").select("id").unionByName(listed).distinct()
    joined = reconcile(tables["organization_members"], people.organization_member_rows(members, users), ["org_id", "user_id"], expanded)
    result = {**tables, "users": users, "followers": followers.table, "organization_members": joined.table}
    # Accounts that are new here and organizations bring their members, those already expanded apart.
    seen = before.select("login").unionByName(concerned.withColumnRenamed("org", "login"))
    result = expand_organizations(result, seen, raw, now)
    return SyncedUsers(result, followers.gone, joined.gone)
