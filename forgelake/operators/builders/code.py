"""Projects, commits, languages, topics and forks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions.scalars import (
    DESCRIPTION_LENGTH, blank_to_null, explode_languages, forge_ts, fork_name, full_name_owner, full_name_repo, left, url_owner,
    url_repo, url_sha,
)
from forgelake.operators.changes import insert_missing, missing, one_per_key, tiebreak, union_all
from forgelake.operators.keys import append_with_ids
from forgelake.operators.lookup import latest, no_longer_listed, project_keys, union_distinct
from forgelake.session import cut_lineage

MISSING_PARENT = -1  # Fixed value: forked_from of a fork whose parent is unknown


def repo_rows(raw_repos: DataFrame) -> DataFrame:
    """Staged repository records, one per returned (owner, name), earliest arrival first.

    A renamed or moved repository counts under the owner and name the record carries.
    """
    flat = raw_repos.select(
        F.col("owner.login").alias("owner"), "name", "url", left(F.col("description"), DESCRIPTION_LENGTH).alias("description"),
        "language", forge_ts(F.col("created_at").cast("string")).alias("created_at"),
        F.col("parent.owner.login").alias("parent_owner"), F.col("parent.name").alias("parent_name"),
        *([F.col("seq")] if "seq" in raw_repos.columns else []),
    ).filter("owner is not null and name is not null")
    return one_per_key(flat, ["owner", "name"], tiebreak(flat, ["seq"] if "seq" in flat.columns else ["created_at"]))


def with_parents(requested: DataFrame, repos: DataFrame) -> DataFrame:
    """(owner, name) of the requested repositories and of all their staged ancestors.

    One round per level of the fork chain; each round looks up only the parents
    found in the round before, and the last one finds nothing new: chains of any
    length end, cycles too.
    """
    edges = repos.filter("parent_owner is not null").select("owner", "name", "parent_owner", "parent_name")
    levels = [cut_lineage(requested.select("owner", "name").distinct(), "fork_level")]
    while True:
        parents = levels[-1].join(edges, ["owner", "name"]).select(
            F.col("parent_owner").alias("owner"), F.col("parent_name").alias("name")
        ).distinct()
        found = union_all(levels)
        level = cut_lineage(parents.join(found, ["owner", "name"], "left_anti"), "fork_level")
        if level.isEmpty():
            return found
        levels.append(level)


def next_projects(table: DataFrame, repos: DataFrame, users: DataFrame, now: Column) -> DataFrame:
    """Insert new repositories (rows of `repo_rows`) and set their parent.

    The owner must be a known user. A parent that is in no table becomes -1.
    """
    owners = users.select(F.col("login").alias("owner"), F.col("id").alias("owner_id"))
    owned = repos.join(owners, "owner")
    fresh = cut_lineage(missing(owned, table, ["owner_id", "name"]), "new_projects")
    flat = fresh.select(
        "url", "owner_id", "name", "description", "language", "created_at", F.lit(False).alias("deleted"),
        now.alias("updated_at"),
    )
    inserted = append_with_ids(table, flat, ["owner_id", "name"])
    return set_parents(inserted, fresh.select("owner_id", "name", "parent_owner", "parent_name"), users)


def set_parents(projects: DataFrame, edges: DataFrame, users: DataFrame) -> DataFrame:
    """Set forked_from of the listed projects to their parent's id, -1 when it is unknown."""
    parents = project_keys(projects, users).select(
        F.col("owner").alias("parent_owner"), F.col("repo").alias("parent_name"), F.col("project_id").alias("parent_id")
    )
    links = edges.filter("parent_owner is not null").join(parents, ["parent_owner", "parent_name"], "left").select(
        "owner_id", "name", F.coalesce("parent_id", F.lit(MISSING_PARENT)).alias("parent_id")
    )
    return projects.join(links, ["owner_id", "name"], "left").select(*[
        F.coalesce("parent_id", "forked_from").alias(c) if c == "forked_from" else F.col(f"`{c}`") for c in projects.columns
    ])


def fork_rows(raw_forks: DataFrame) -> DataFrame:
    """(parent_owner, parent_name, owner, name) of staged fork records, one per fork."""
    named = raw_forks.select(
        F.col("owner").alias("parent_owner"), F.col("repo").alias("parent_name"),
        fork_name(F.col("full_name"), F.col("url")).alias("fork"),
    )
    return named.select(
        full_name_owner(F.col("fork")).alias("owner"), full_name_repo(F.col("fork")).alias("name"), "parent_owner", "parent_name"
    ).groupBy("owner", "name").agg(F.min(F.struct("parent_owner", "parent_name")).alias("p")).select("owner", "name", "p.*")


def next_forks(table: DataFrame, raw_forks: DataFrame, users: DataFrame, now: Column) -> DataFrame:
    """Projects for listed forks that are new, and forked_from for those that lack it."""
    edges = cut_lineage(fork_rows(raw_forks), "fork_edges")
    bare = edges.select(
        "owner", "name", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("string").alias("language"), F.lit(None).cast("timestamp").alias("created_at"),
        "parent_owner", "parent_name",
    )
    inserted = next_projects(table, bare, users, now)
    owners = users.select(F.col("login").alias("owner"), F.col("id").alias("owner_id"))
    orphans = inserted.filter("forked_from is null or forked_from = -1").select("owner_id", "name")
    return set_parents(inserted, edges.join(owners, "owner").join(orphans, ["owner_id", "name"], "left_semi"), users)


def first_commits(raw_commits: DataFrame) -> DataFrame:
    """First occurrence of every sha by arrival (seq), with owner and repo from its URL."""
    flat = raw_commits.select(
        "sha", url_owner(F.col("url")).alias("owner"), url_repo(F.col("url")).alias("repo"),
        F.col("author.login").alias("author_login"), F.col("commit.author.name").alias("author_name"),
        F.col("commit.author.email").alias("author_email"), F.col("committer.login").alias("committer_login"),
        F.col("commit.committer.name").alias("committer_name"), F.col("commit.committer.email").alias("committer_email"),
        forge_ts(F.col("commit.author.date").cast("string")).alias("created_at"), "seq",
    )
    return one_per_key(flat, ["sha"], tiebreak(flat, ["seq"]))


def commit_identities(commits: DataFrame) -> DataFrame:
    """Identities named by commits: login, name, email, seq."""
    authors = commits.select(
        F.col("author_login").alias("login"), F.col("author_name").alias("name"), F.col("author_email").alias("email"), "seq"
    )
    committers = commits.select(
        F.col("committer_login").alias("login"), F.col("committer_name").alias("name"),
        F.col("committer_email").alias("email"), "seq",
    )
    return authors.unionByName(committers)


def next_commits(table: DataFrame, commits: DataFrame, resolution: DataFrame, projects: DataFrame, users: DataFrame) -> DataFrame:
    """Insert new commits (rows of `first_commits`); author and committer by the identity resolution."""
    ids = resolution.join(users.select(F.col("login").alias("resolved_login"), "id"), "resolved_login")

    def person(df: DataFrame, role: str) -> DataFrame:
        side = ids.select(
            F.col("login").alias("i_login"), F.col("name").alias("i_name"), F.col("email").alias("i_email"),
            F.col("id").alias(f"{role}_id"),
        )
        match = (
            F.col(f"{role}_login").eqNullSafe(F.col("i_login"))
            & F.trim(f"{role}_name").eqNullSafe(F.col("i_name"))
            & blank_to_null(F.col(f"{role}_email")).eqNullSafe(F.col("i_email"))
        )
        return df.join(side, match, "left").drop("i_login", "i_name", "i_email")

    fresh = missing(commits, table, ["sha"])
    placed = fresh.join(project_keys(projects, users).select("owner", "repo", "project_id"), ["owner", "repo"], "left")
    rows = person(person(placed, "author"), "committer").select("sha", "author_id", "committer_id", "project_id", "created_at")
    return append_with_ids(table, rows, ["sha"])


#: A parent of more commits than this is looked up by broadcast.
MANY_CHILDREN = 100_000


def commit_parent_rows(raw_commits: DataFrame, commits: DataFrame) -> DataFrame:
    """commit_id, parent_id edges; an edge to an unknown parent is dropped."""
    edges = cut_lineage(raw_commits.select("sha", F.explode("parents").alias("p")).select(
        "sha", F.coalesce(url_sha(F.col("p.url")), F.col("p.sha")).alias("parent_sha")
    ), "edges")
    # A parent of very many commits would bring all their edges into one task: its edges are looked up by broadcast.
    # There are few such parents, at most one in MANY_CHILDREN edges; counts are summed before the shuffle.
    counted = edges.groupBy(F.xxhash64("parent_sha").alias("h")).agg(F.count("*").alias("n")).filter(F.col("n") > MANY_CHILDREN)
    many = cut_lineage(counted.select("h"), "many")
    hashed = edges.withColumn("h", F.xxhash64("parent_sha"))
    known = commits.withColumn("h", F.xxhash64("sha")).join(F.broadcast(many), "h", "left_semi")
    frequent = hashed.join(F.broadcast(many), "h", "left_semi").drop("h")
    frequent = frequent.join(F.broadcast(known.select(F.col("sha").alias("parent_sha")).distinct()), "parent_sha", "left_semi")
    others = hashed.join(F.broadcast(many), "h", "left_anti").drop("h")
    named = frequent.distinct().join(commits.select("sha", F.col("id").alias("commit_id")), "sha")
    told = named.join(F.broadcast(known.select(F.col("sha").alias("parent_sha"), F.col("id").alias("parent_id"))), "parent_sha")
    return told.select("commit_id", "parent_id").unionByName(resolve_edges(others.distinct(), commits))


def resolve_edges(edges: DataFrame, commits: DataFrame) -> DataFrame:
    """(sha, parent_sha) to (commit_id, parent_id)."""
    children = commits.select("sha", F.col("id").alias("commit_id"))
    parents = commits.select(F.col("sha").alias("parent_sha"), F.col("id").alias("parent_id"))
    return edges.join(children, "sha").join(parents, "parent_sha").select("commit_id", "parent_id")


def project_commit_rows(pairs: DataFrame, projects: DataFrame, users: DataFrame, commits: DataFrame) -> DataFrame:
    """project_id, commit_id of (owner, repo, sha) sightings, each once: of numbers, behind the joins, not of texts before them."""
    places = project_keys(projects, users).select("owner", "repo", "project_id")
    named = pairs.select("owner", "repo", packed_sha(F.col("sha")).alias("sha")).join(places, ["owner", "repo"])
    known = commits.select(packed_sha(F.col("sha")).alias("sha"), F.col("id").alias("commit_id"))
    return named.join(known, "sha").select("project_id", "commit_id").distinct()


def packed_sha(sha: Column) -> Column:
    """Bytes that stand for one text only, half as many for small hexadecimal digits: what a shuffle carries and a join compares."""
    digits = F.unhex(sha)
    return F.when(F.lower(F.hex(digits)) == sha, F.concat(F.lit(bytearray(b"\x01")), digits)).otherwise(
        F.concat(F.lit(bytearray(b"\x00")), F.encode(sha, "UTF-8"))
    )


def next_project_commits(table: DataFrame, rows: DataFrame, stored: bool = False) -> DataFrame:
    return insert_missing(table, rows, ["project_id", "commit_id"], stored=stored)


def language_rows(staged: DataFrame, projects: DataFrame, users: DataFrame, now: Column) -> DataFrame:
    """Snapshot rows of staged language maps (owner, repo, languages)."""
    exploded = explode_languages(staged.select("owner", "repo", "languages"), "languages")
    return exploded.join(project_keys(projects, users), ["owner", "repo"]).select(
        "project_id", "language", "bytes", now.alias("created_at")
    )


def next_topics(
    table: DataFrame, listed: DataFrame, refreshed: DataFrame, now: Column, revive: bool = False
) -> DataFrame:
    """Topics of refreshed projects: add new ones, soft-delete those no longer listed.

    `listed` has project_id, topic_name; `refreshed` has the project_id of every
    project that was looked at, so an empty listing deletes all its topics. A
    topic deleted once stays deleted, unless `revive` is set.
    """
    keys = ["project_id", "topic_name"]
    rows = listed.select(*keys).distinct().withColumns({"created_at": now, "deleted": F.lit(False)})
    added = insert_missing(table, rows, keys)
    gone = no_longer_listed(added.filter("not deleted"), listed, refreshed, ["project_id"], ["topic_name"])
    marks = gone.select(*keys, F.lit(True).alias("new_deleted"))
    if revive:
        marks = marks.unionByName(listed.select(*keys).distinct().withColumn("new_deleted", F.lit(False)))
    return added.join(marks, keys, "left").select(*[
        F.coalesce("new_deleted", "deleted").alias(c) if c == "deleted" else F.col(c) for c in table.columns
    ])


def harvest(pages: list[DataFrame], keys: list[str]) -> DataFrame:
    """First sighting of users or repositories on listing pages."""
    return union_distinct(pages, keys)


def pr_commit_collection(raw_commits: DataFrame, pr_commits: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Full commit records of pull request commits, tagged with the pull request, one per sha.

    `pr_commits` has sha and pull_request_id; records stored earlier stay.
    """
    owner = pr_commits.groupBy("sha").agg(F.min("pull_request_id").alias("pull_request_id"))
    tagged = latest(raw_commits, ["sha"], ["seq"]).join(owner, "sha")
    return tagged if stored is None else insert_missing(stored, tagged, ["sha"])
