"""Filters, joins, aggregates, ordering and set operators."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgelake import schemas
from forgelake.operators.changes import one_per_key, tiebreak, union_all
from forgelake.session import cut_lineage

STALE_DAYS = 10  # Fixed value: age at which a project is refreshed
FAKE_LOGIN_PATTERN = "[A-Z]{8}"  # Fixed value: shape of placeholder logins

# ---- filters -------------------------------------------------------------


def find(df: DataFrame, query: dict[str, object]) -> DataFrame:
    """Rows whose dotted paths all equal the given values."""
    for dotted, value in query.items():
        df = df.filter(F.col(dotted) == F.lit(value))
    return df


def regex_filter(df: DataFrame, filters: list[str], whole_pattern: bool = True) -> DataFrame:
    """Rows that match every `path=regexp`; a bad filter is refused before anything runs.

    The path ends at the first `=`; the pattern may hold more of them, unless `whole_pattern`
    is off: then it ends at the next one. Patterns are compiled by the engine that runs them.
    """
    compiler = df.sparkSession._jvm.java.util.regex.Pattern
    parsed = []
    for text in filters:
        dotted, found, pattern = text.partition("=")
        pattern = pattern if whole_pattern else pattern.split("=")[0]
        if not found or not dotted or not pattern:
            raise ValueError(f"not a valid filter: {text}")
        try:
            compiler.compile(pattern)
        except (IllegalArgumentException, Py4JJavaError) as problem:
            raise ValueError(f"not a valid filter: {text}") from problem
        parsed.append((dotted, pattern))
    for dotted, pattern in parsed:
        df = df.filter(F.col(dotted).cast("string").rlike(pattern))
    return df


def time_range(df: DataFrame, ts: str, earliest: Column, latest: Column) -> DataFrame:
    return df.filter(F.col(ts).between(earliest, latest))


def limit(df: DataFrame, n: int, order: str = "id") -> DataFrame:
    """The first n rows by id."""
    return df.orderBy(order).limit(n)


def event_window(
    df: DataFrame, after: int | None = None, before: int | None = None, exclude: list[str] | None = None
) -> DataFrame:
    """Events strictly between two ids and not of an excluded type."""
    number = F.col("id").try_cast("bigint")
    if after is not None:
        df = df.filter(number > after)
    if before is not None:
        df = df.filter(number < before)
    if exclude:
        df = df.filter(~F.col("type").isin(exclude))
    return df


def stale(df: DataFrame, now: Column, days: int = STALE_DAYS, column: str = "updated_at") -> DataFrame:
    return df.filter(F.col(column) <= now - F.make_dt_interval(F.lit(days)))


def handled(events: DataFrame) -> DataFrame:
    return events.filter(F.col("type").isin(schemas.HANDLED_EVENTS))


def repository_creations(events: DataFrame) -> DataFrame:
    return events.filter((F.col("type") == "CreateEvent") & (F.col("payload.ref_type") == "repository"))


# ---- joins ---------------------------------------------------------------


def project_lookup(projects: DataFrame, users: DataFrame) -> DataFrame:
    """Projects with the login of their owner."""
    owners = users.select(F.col("id").alias("owner_id"), F.col("login").alias("owner"))
    return projects.join(owners, "owner_id")


def project_keys(projects: DataFrame, users: DataFrame) -> DataFrame:
    """owner, repo -> project_id and its creation date: the lookup side of most builders."""
    return project_lookup(projects, users).select(
        "owner", F.col("name").alias("repo"), F.col("id").alias("project_id"), F.col("created_at").alias("project_created_at")
    )


def user_keys(users: DataFrame) -> DataFrame:
    """login -> user_id and its creation date."""
    return users.select("login", F.col("id").alias("user_id"), F.col("created_at").alias("user_created_at"))


def registered_commits(
    shas: DataFrame, commits: DataFrame, project_commits: DataFrame, projects: DataFrame, users: DataFrame
) -> DataFrame:
    """Which (owner, repo, sha) are already associated with their project."""
    named = (
        shas.select("owner", "repo", "sha").distinct()
        .join(project_keys(projects, users).select("owner", "repo", "project_id"), ["owner", "repo"])
        .join(commits.select("sha", F.col("id").alias("commit_id")), "sha")
    )
    return named.join(project_commits, ["project_id", "commit_id"], "left_semi").select("owner", "repo", "sha")


def unregistered_commits(
    shas: DataFrame, commits: DataFrame, project_commits: DataFrame, projects: DataFrame, users: DataFrame
) -> DataFrame:
    known = registered_commits(shas, commits, project_commits, projects, users)
    return shas.join(known, ["owner", "repo", "sha"], "left_anti")


def follower_logins(followers: DataFrame, users: DataFrame) -> DataFrame:
    """Logins of the followers of every user."""
    names = users.select(F.col("id").alias("follower_id"), "login")
    return followers.join(names, "follower_id").select("user_id", "login")


def following_logins(followers: DataFrame, users: DataFrame) -> DataFrame:
    """Logins every user follows."""
    names = users.select(F.col("id").alias("user_id"), "login")
    return followers.join(names, "user_id").select("follower_id", "login")


def watcher_logins(watchers: DataFrame, users: DataFrame) -> DataFrame:
    return watchers.join(users.select(F.col("id").alias("user_id"), "login"), "user_id").select("repo_id", "login")


def issue_label_names(issue_labels: DataFrame, repo_labels: DataFrame) -> DataFrame:
    return issue_labels.join(repo_labels.select(F.col("id").alias("label_id"), "name"), "label_id").select("issue_id", "name")


def forks_of(projects: DataFrame, users: DataFrame) -> DataFrame:
    """Forks of every project with the login of their owner."""
    return project_lookup(projects.filter("forked_from is not null"), users).select("forked_from", "owner", "name")


def pr_lookup(prs: DataFrame, projects: DataFrame, users: DataFrame) -> DataFrame:
    """owner, repo, number -> pull request id."""
    bases = project_keys(projects, users).select("owner", "repo", F.col("project_id").alias("base_repo_id"))
    return prs.join(bases, "base_repo_id").select("owner", "repo", F.col("pullreq_id").alias("number"), F.col("id").alias("pull_request_id"))


def add_private(users: DataFrame, private: DataFrame) -> DataFrame:
    """Users with the name and e-mail of the private file, null where it has none."""
    return users.drop("name", "email").join(private.select("login", "name", "email"), "login", "left")


def merged_by_commits(prs: DataFrame, pr_commits: DataFrame, project_commits: DataFrame) -> DataFrame:
    """Ids of pull requests one of whose commits is in the base project, base and head differing."""
    cross = prs.filter(F.col("base_repo_id") != F.col("head_repo_id")).select(F.col("id").alias("pull_request_id"), "base_repo_id")
    pairs = pr_commits.select("pull_request_id", "commit_id").join(cross, "pull_request_id")
    landed = pairs.join(
        project_commits.select(F.col("project_id").alias("base_repo_id"), "commit_id"), ["base_repo_id", "commit_id"], "left_semi"
    )
    return landed.select(F.col("pull_request_id").alias("id")).distinct()


def merged_by_history(prs: DataFrame, history: DataFrame) -> DataFrame:
    """Ids of pull requests with a merge in their history."""
    merges = history.filter("action = 'merged'").select(F.col("pull_request_id").alias("id"))
    return prs.select("id").join(merges, "id", "left_semi")


def roles_in_use(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct ids of accounts that occur in any of the six role columns."""
    # The role columns.
    roles = [
        ("pull_request_history", "actor_id"), ("issue_events", "actor_id"), ("project_members", "user_id"),
        ("issues", "reporter_id"), ("issues", "assignee_id"), ("organization_members", "user_id"),
    ]
    used = [tables[t].select(F.col(c).alias("id")) for t, c in roles if t in tables]
    return union_all(used).filter("id is not null").distinct()


def fake_candidates(users: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Accounts that look like placeholders and play no role anywhere."""
    shaped = users.filter(F.col("login").rlike(FAKE_LOGIN_PATTERN))
    return shaped.join(roles_in_use(tables), "id", "left_anti")


COMMIT_BUCKET_SECONDS = 30 * 86_400
BUCKET_SHARE = 100_000  # commits of one bucket that go to one task


def commits_before(
    project_commits: DataFrame, commits: DataFrame, forks: DataFrame, width: int = COMMIT_BUCKET_SECONDS, share: int = BUCKET_SHARE
) -> DataFrame:
    """Commits of the parent created strictly before the fork commit, per fork.

    `forks` has fork_id, parent_id and fork_ts, one row per fork. A range join by time buckets:
    a fork asks for its parent's buckets up to its own date, whole ones by equality alone, and
    only in the last one dates are compared; later buckets are never touched. Large buckets
    are dealt over shares, so a parent with very many commits and forks is many tasks.
    """
    bucket = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / F.lit(width))
    sides = forks.filter("fork_ts is not null").select("fork_id", F.col("parent_id").alias("project_id"), "fork_ts", bucket("fork_ts").alias("last"))
    asked = project_commits.select("project_id", "commit_id").join(sides.select("project_id").distinct(), "project_id", "left_semi")
    dated = asked.join(commits.select(F.col("id").alias("commit_id"), "created_at"), "commit_id").withColumn("bucket", bucket("created_at"))
    dated = cut_lineage(dated.filter("bucket is not null"), "dated_commits")
    sizes = dated.groupBy("project_id", "bucket").agg(F.ceil(F.count("*") / F.lit(share)).alias("shares"))
    wanted = sides.join(sizes, "project_id").filter("bucket <= last").select(
        "fork_id", "project_id", "fork_ts", "bucket", (F.col("bucket") < F.col("last")).alias("whole"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("share"),
    )
    dealt = dated.join(sizes, ["project_id", "bucket"]).withColumn("share", F.pmod(F.xxhash64("commit_id"), F.col("shares")))
    met = dealt.join(wanted, ["project_id", "bucket", "share"]).filter("whole or created_at < fork_ts")
    return met.select(F.col("fork_id").alias("project_id"), "commit_id")


def left_join_known(df: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """A left join on a text key that is often null: null keys are dealt over keys that match nothing.

    A plain left join sends all rows with a null key to one task. `side` has one row per key.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != key]
    dealt = F.coalesce(F.col(key), F.concat(F.lit("\0"), F.xxhash64(*others).cast("string")))
    joined = df.withColumn("dealt_key", dealt).join(side.withColumnRenamed(key, "dealt_key"), "dealt_key", "left")
    return joined.select(*df.columns, *[c for c in side.columns if c != key])


def events_by_id(ids: DataFrame, events: DataFrame) -> DataFrame:
    return events.join(ids.select("id").distinct(), "id", "left_semi")


def resolve_fk(df: DataFrame, dim: DataFrame, on: dict[str, str], value: str, alias: str) -> DataFrame:
    """Add the target's id, null when it is absent. `on` maps columns of df to key columns of dim."""
    side = dim.select(*[F.col(k).alias(f"key_{k}") for k in on.values()], F.col(value).alias(alias))
    condition = None
    for left_name, right_name in on.items():
        part = df[left_name] == side[f"key_{right_name}"]
        condition = part if condition is None else condition & part
    return df.join(side, condition, "left").drop(*[f"key_{k}" for k in on.values()])


def users_by_email(users: DataFrame) -> DataFrame:
    """One account per e-mail: the oldest id."""
    with_mail = users.filter("email is not null")
    return with_mail.groupBy("email").agg(F.min_by("login", "id").alias("login"), F.min("id").alias("id"))


# ---- aggregates ----------------------------------------------------------


def count_where(df: DataFrame, query: dict[str, object]) -> DataFrame:
    return find(df, query).agg(F.count("*").alias("n"))


def max_ids(tables: dict[str, DataFrame]) -> DataFrame:
    """Highest id of each table that has ids."""
    return union_all([
        df.agg(F.max("id").alias("max_id")).select(F.lit(name).alias("table_name"), "max_id")
        for name, df in tables.items() if "id" in df.columns
    ])


def distinct_ids(df: DataFrame, column: str = "id") -> DataFrame:
    return df.select(column).distinct()


def dup_ratio(events: DataFrame, ts: str = "created_at", key: str = "id", width: str = "minute") -> DataFrame:
    """New and duplicate sightings per time unit, and the share of duplicates.

    Sightings are first counted per (id, unit); a repeated id therefore never
    gathers its rows in one task.
    """
    sightings = events.groupBy(key, F.date_trunc(width, ts).alias("bucket")).agg(F.count("*").alias("n"))
    firsts = sightings.groupBy(key).agg(F.min("bucket").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("fresh"))
    totals = sightings.groupBy("bucket").agg(F.sum("n").alias("total"))
    merged = totals.join(firsts, "bucket", "left").select(
        "bucket", "total", F.coalesce("fresh", F.lit(0)).cast("bigint").alias("new_events")
    )
    duplicates = F.col("total") - F.col("new_events")
    return merged.select(
        "bucket", "new_events", duplicates.alias("duplicate_events"), F.try_divide(duplicates, F.col("total")).alias("ratio")
    )


def entity_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table."""
    return union_all([
        df.agg(F.count("*").alias("items")).select(F.lit(name).alias("entity"), "items") for name, df in tables.items()
    ])


def earliest_and_latest(df: DataFrame, keys: list[str], value: str, ts: str) -> DataFrame:
    """Per key the value of the earliest and of the latest row, ties by the value itself."""
    order = F.struct(ts, value)
    return df.groupBy(*keys).agg(F.min_by(value, order).alias("earliest"), F.max_by(value, order).alias("latest"))


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest row of each key."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("picked"))
    return picked.select(*keys, "picked.*")


def latest_moment(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(ts).alias(ts))


def languages_latest(snapshots: DataFrame) -> DataFrame:
    """Bytes and number of languages in the latest snapshot of each project.

    One aggregation per (project, capture), then the latest capture wins.
    """
    totals = snapshots.groupBy("project_id", "created_at").agg(
        F.sum("bytes").alias("bytes"), F.count("*").alias("languages")
    )
    return latest(totals, ["project_id"], ["created_at"])


# ---- ordering ------------------------------------------------------------


def order_events(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("id").try_cast("bigint"))


def best_by(df: DataFrame, keys: list[str], score: str, tie: list[str]) -> DataFrame:
    """The candidate with the highest score per key, ties settled by the given columns."""
    return latest(df, keys, [score, *tie])


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows per key. Spark cuts each partition to k rows per key before the shuffle."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


# ---- set operators -------------------------------------------------------


def union_distinct(pages: list[DataFrame], keys: list[str], order: list[str] | None = None) -> DataFrame:
    """All pages as one set; of records with one key the earliest page's is kept."""
    numbered = [page.withColumn("page_no", F.lit(i)) for i, page in enumerate(pages)]
    combined = union_all(numbered)
    return one_per_key(combined, keys, tiebreak(combined, ["page_no", *(order or [])])).drop("page_no")


def replace_set(table: DataFrame, fresh: DataFrame, owner_key: list[str]) -> DataFrame:
    """Exchange the whole set of each owner that occurs in the fresh rows."""
    owners = fresh.select(*owner_key).distinct()
    return table.join(owners, owner_key, "left_anti").select(*table.columns).unionByName(fresh.select(*table.columns).distinct())


def no_longer_listed(stored: DataFrame, listed: DataFrame, refreshed: DataFrame, owner: list[str], item: list[str]) -> DataFrame:
    """Stored items of refreshed owners that the fresh listing lacks."""
    return stored.join(refreshed.select(*owner).distinct(), owner, "left_semi").join(
        listed.select(*owner, *item), owner + item, "left_anti"
    )


def backfill_project_commits(project_commits: DataFrame, commits: DataFrame) -> DataFrame:
    """Add the (project, commit) pair of every commit that names its project."""
    pairs = commits.filter("project_id is not null").select("project_id", F.col("id").alias("commit_id"))
    return project_commits.unionByName(pairs).distinct()
