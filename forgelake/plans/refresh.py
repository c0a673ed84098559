"""Composite jobs: apply a batch of events, refresh whole repositories."""

from __future__ import annotations

import time
from collections.abc import Callable, Collection

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions.scalars import url_owner, url_repo
from forgelake.operators import handlers, identity
from forgelake.operators.builders import code, people, tracker
from forgelake.operators.changes import missing, touch, union_all
from forgelake.operators.history import history_candidates
from forgelake.operators.keys import append_with_ids
from forgelake.operators.lookup import pr_lookup, project_keys
from forgelake.session import cut_all, cut_lineage, together

Tables = dict[str, DataFrame]


def ensure_users(users: DataFrame, logins: DataFrame, raw_users: DataFrame, now: Column) -> DataFrame:
    """Insert the accounts behind the mentioned logins that the table lacks."""
    wanted = logins.select("login").filter("login is not null").distinct()
    accounts = identity.account_rows(raw_users.join(wanted, "login", "left_semi"), now)
    return append_with_ids(users, accounts, ["login"])


def mentioned_logins(staged: handlers.Staged) -> DataFrame:
    """Logins named by staged rows, as owners (of forks too), actors or members."""
    columns = {
        "commits": ["owner"], "watchers": ["owner", "login"], "followers": ["follower", "followed"],
        "project_members": ["owner", "login"], "pull_requests": ["owner", "event_actor"], "forks": ["owner"],
        "issues": ["owner"], "issue_comments": ["owner"], "pull_request_comments": ["owner"],
        "commit_comments": ["owner"], "repos": ["owner"],
    }
    parts = [staged[name].select(F.col(c).alias("login")) for name, cs in columns.items() if name in staged for c in cs]
    if "pull_requests" in staged:
        prs = staged["pull_requests"]
        parts += [prs.select(F.col(c).alias("login")) for c in ("user.login", "merged_by.login", "head.repo.owner.login")]
    if "forks" in staged:
        parts.append(code.fork_rows(staged["forks"]).select(F.col("owner").alias("login")))
    return union_all(parts).distinct()


def head_repos(prs: DataFrame) -> DataFrame:
    """(owner, name) of the repositories that pull requests come from."""
    return prs.select(F.col("head.repo.owner.login").alias("owner"), F.col("head.repo.name").alias("name")).filter(
        "owner is not null and name is not null"
    )


def mentioned_repos(staged: handlers.Staged) -> DataFrame:
    """(owner, name) of repositories named by staged rows, forks and the heads of pull requests among them."""
    names = ["commits", "watchers", "project_members", "forks", "issues", "issue_comments", "pull_request_comments", "commit_comments", "repos", "pull_requests"]
    parts = [staged[n].select("owner", F.col("repo").alias("name")) for n in names if n in staged]
    if "forks" in staged:
        parts.append(code.fork_rows(staged["forks"]).select("owner", "name"))
    if "pull_requests" in staged:
        parts.append(head_repos(staged["pull_requests"]))
    return union_all(parts).distinct()


def store_commits(tables: Tables, raw_commits: DataFrame, raw_users: DataFrame, now: Column) -> Tables:
    """Commits with their people, parents and project associations."""
    firsts = cut_lineage(code.first_commits(raw_commits), "commits")
    people_found = identity.resolve_identities(code.commit_identities(firsts), tables["users"], raw_users, now)
    cut = cut_all({"users": people_found.users, "resolution": people_found.resolution})
    users, resolution = cut["users"], cut["resolution"]
    commits = code.next_commits(tables["commits"], firsts, resolution, tables["projects"], users)
    return {**tables, "users": users, "commits": commits} | together(commits.sparkSession, {
        "commit_parents": lambda: code.insert_missing(
            tables["commit_parents"], code.commit_parent_rows(raw_commits, commits), ["commit_id", "parent_id"], stored=True
        ),
        "project_commits": lambda: code.next_project_commits(
            tables["project_commits"], code.project_commit_rows(firsts, tables["projects"], users, commits), stored=True
        ),
    })


# Raw collections that a batch of events draws on, beside those of the refresh of created repositories.
EVENT_COLLECTIONS = [
    "users", "org_members", "repos", "commits", "commit_lists", "commit_comments", "pull_requests", "pull_request_comments",
    "pull_commit_lists", "issues", "issue_events", "issue_comments", "repo_labels",
]


def check_collections(raw: dict[str, DataFrame], needed: list[str], skip: Collection[str]) -> None:
    """An error when a collection is neither staged nor named as one to do without."""
    absent = sorted(set(needed) - set(raw) - set(skip))
    if absent:
        raise ValueError(f"not staged, and not to be skipped: {', '.join(absent)}")


def picked(raw: Tables, name: str, keys: DataFrame) -> DataFrame | None:
    """Staged records of a collection under the given keys."""
    return raw[name].join(keys.distinct(), keys.columns, "left_semi") if name in raw else None


PR_KEYS = ["owner", "repo", "number"]


def of_pull_requests(raw: Tables, prs: DataFrame) -> Tables:
    """Commit lists, review comments and discussion of the given pull requests (owner, repo, number)."""
    keys = prs.select(*PR_KEYS)
    found = {}
    if "pull_commit_lists" in raw:
        found["pull_commit_lists"] = picked(raw, "pull_commit_lists", keys)
    if "pull_request_comments" in raw:
        reviews = raw["pull_request_comments"].withColumn("number", tracker.review_number())
        found["pull_request_comments"] = reviews.join(keys.distinct(), PR_KEYS, "left_semi").drop("number")
    if "issue_comments" in raw:
        found["issue_comments"] = picked(raw, "issue_comments", keys.withColumnRenamed("number", "issue_id"))
    return found


def shas_of_pull_requests(prs: DataFrame, children: Tables, projects: DataFrame, users: DataFrame) -> DataFrame:
    """Shas of the commits that pull requests and their children point to; heads of unknown repositories don't count."""
    known = project_keys(projects, users).select(F.col("owner").alias("head_owner"), F.col("repo").alias("head_name"))
    heads = prs.select(F.col("head.sha").alias("sha"), F.col("head.repo.owner.login").alias("head_owner"), F.col("head.repo.name").alias("head_name"))
    parts = [prs.select(F.col("base.sha").alias("sha")), heads.join(known, ["head_owner", "head_name"], "left_semi").select("sha")]
    if "pull_commit_lists" in children:
        parts.append(children["pull_commit_lists"].select("sha"))
    if "pull_request_comments" in children:
        parts.append(children["pull_request_comments"].select(F.col("original_commit_id").alias("sha")))
    return union_all(parts).filter("sha is not null").distinct()


def issues_before_pull_requests(staged: handlers.Staged) -> DataFrame:
    """Numbers (owner, repo, number) that the batch's events name as an issue before any names them as a pull request."""
    def first(names: list[str], column: str) -> DataFrame:
        return union_all([staged[n].select(*PR_KEYS, "event_id") for n in names]).groupBy(*PR_KEYS).agg(F.min("event_id").alias(column))

    issues, prs = first(["issues", "issue_comments"], "issue_id"), first(["pull_requests", "pull_request_comments"], "pr_id")
    return issues.join(prs, PR_KEYS, "left").filter("pr_id is null or issue_id < pr_id").select(*PR_KEYS)


def picked_records(raw: Tables, staged: handlers.Staged) -> Tables:
    """Staged records that the events of a batch call for, by collection.

    A comment brings its pull request or issue, an issue event all of the issue's own
    events and comments, a pull request event its commits, reviews and discussion.
    """
    comments, issues, reviews = staged["issue_comments"], staged["issues"], staged["pull_request_comments"]
    children = of_pull_requests(raw, staged["pull_requests"])
    wanted_issues = issues.select("owner", "repo", "number").unionByName(comments.select("owner", "repo", "number"))
    of_issues = issues.select("owner", "repo", F.col("number").alias("issue_id"))
    found = {
        "commit_comments": picked(raw, "commit_comments", staged["commit_comments"].select(F.col("comment_id").alias("id"), F.col("sha").alias("commit_id"))),
        "pull_requests": picked(raw, "pull_requests", reviews.select("owner", "repo", "number")),
        "pull_request_comments": picked(raw, "pull_request_comments", reviews.select("owner", "repo", F.col("comment_id").cast("string").alias("id"))),
        "issues": picked(raw, "issues", wanted_issues),
        "issue_events": picked(raw, "issue_events", of_issues),
        "repo_labels": picked(raw, "repo_labels", wanted_issues.select("owner", "repo")),
    }
    if "issue_comments" in raw:
        single = picked(raw, "issue_comments", comments.select("owner", "repo", F.col("number").alias("issue_id"), F.col("comment_id").alias("id")))
        found["issue_comments"] = single.unionByName(picked(raw, "issue_comments", of_issues))
    for name, rows in children.items():
        found[name] = rows if found.get(name) is None else found[name].unionByName(rows)
    return cut_all({name: rows for name, rows in found.items() if rows is not None})


def people_of_records(records: Tables) -> list[DataFrame]:
    """Logins named by staged records."""
    columns = {
        "commit_comments": ["user.login"], "pull_requests": ["user.login", "merged_by.login", "head.repo.owner.login"],
        "pull_request_comments": ["user.login"], "issues": ["user.login", "assignee.login"], "issue_events": ["actor.login"],
        "issue_comments": ["user.login"], "watchers": ["login"],
    }
    return [records[n].select(F.col(c).alias("login")) for n, cs in columns.items() if n in records for c in cs]


def apply_events(tables: Tables, events: DataFrame, raw: dict[str, DataFrame], now: Column, skip: Collection[str] = ()) -> Tables:
    """Next tables after a batch of events, given the staged raw collections.

    `raw` holds the staged collections (commits with seq; commit_lists with owner, repo,
    pos and sha). A collection that is not staged is an error, unless `skip` names it;
    what hangs on it is then left out.
    """
    check_collections(raw, [*EVENT_COLLECTIONS, *(c for cs in STAGE_COLLECTIONS.values() for c in cs)], skip)
    # Every handler and many lookups start from the events, so they are parsed once.
    events = cut_lineage(events.filter(F.col("type").isin(list(handlers.HANDLERS))), "events")
    staged = handlers.stage_events(events)
    next_tables = dict(tables)
    repos = code.repo_rows(raw["repos"])
    first = together(events.sparkSession, {
        "records": lambda: picked_records(raw, staged),
        "wanted": lambda: cut_lineage(code.with_parents(mentioned_repos(staged), repos), "wanted_repos"),
    })
    records, wanted = first["records"], first["wanted"]
    logins = union_all([mentioned_logins(staged), wanted.select(F.col("owner").alias("login")), *people_of_records(records)])
    users = cut_lineage(ensure_users(tables["users"], logins, raw["users"], now), "users")
    next_tables["users"] = users
    projects = code.next_projects(tables["projects"], repos.join(wanted, ["owner", "name"], "left_semi"), users, now)
    next_tables["projects"] = cut_lineage(code.next_forks(projects, staged["forks"], users, now), "projects")
    staged_prs = staged["pull_requests"]
    if "pull_requests" in records:
        record_columns = [c for c in staged_prs.columns if c in records["pull_requests"].columns]
        staged_prs = staged_prs.unionByName(records["pull_requests"].select(*record_columns), allowMissingColumns=True)
    staged_prs = cut_lineage(staged_prs, "pull_requests")
    if "commits" in raw:
        shas = staged["commits"].select("sha").unionByName(staged["commit_comments"].select("sha"))
        shas = shas.unionByName(shas_of_pull_requests(staged_prs, records, next_tables["projects"], users))
        if "commit_lists" in raw:
            older = handlers.older_commits(events, raw["commit_lists"], tables["commits"], tables["project_commits"], next_tables["projects"], users)
            shas = shas.unionByName(older.select("sha"))
        next_tables = store_commits(next_tables, raw["commits"].join(shas.distinct(), "sha", "left_semi"), raw["users"], now)
    users, projects, commits = next_tables["users"], next_tables["projects"], next_tables["commits"]

    steps = {
        "tracker": lambda: store_tracker(next_tables, staged, records, staged_prs),
        "followers": lambda: people.next_followers(tables["followers"], staged["followers"], users, stored=True),
        "watchers": lambda: people.next_watchers(tables["watchers"], staged["watchers"], projects, users, stored=True),
        "project_members": lambda: people.next_project_members(tables["project_members"], staged["project_members"], projects, users, stored=True),
    }
    if "commit_comments" in records:
        steps["commit_comments"] = lambda: tracker.next_commit_comments(tables["commit_comments"], records["commit_comments"], commits, users)
    done = together(events.sparkSession, steps)
    next_tables |= done.pop("tracker")
    next_tables |= done
    next_tables = expand_organizations(next_tables, tables["users"], raw, now)
    created = cut_lineage(staged["repos"].select("owner", "repo").distinct(), "created_repos")
    return next_tables if created.isEmpty() else refresh_repos(next_tables, raw, created, now, skip=skip)


def store_tracker(tables: Tables, staged: handlers.Staged, records: Tables, staged_prs: DataFrame) -> Tables:
    """Pull requests and issues of a batch of events, with their histories and children."""
    projects, users, commits = tables["projects"], tables["users"], tables["commits"]
    next_tables = dict(tables)
    prs = cut_lineage(tracker.next_pull_requests(tables["pull_requests"], staged_prs, projects, users, commits), "next_pull_requests")
    numbers = pr_lookup(prs, projects, users)
    named = cut_lineage(staged_prs.join(numbers, ["owner", "repo", "number"]), "named_pull_requests")
    dates = named.join(project_keys(projects, users).select("owner", "repo", F.col("project_id").alias("base_repo_id")), ["owner", "repo"]).groupBy(
        F.col("number").alias("pullreq_id"), "base_repo_id"
    ).agg(F.min(tracker.stamp("created_at")).alias("created_at"))
    next_tables["pull_requests"] = prs
    issues = tables["issues"]
    if "issues" in records:
        early = records["issues"].join(issues_before_pull_requests(staged), PR_KEYS, "left_semi")
        issues = cut_lineage(tracker.next_issues(issues, early, projects, users, prs), "issues")
    next_tables["issues"] = cut_lineage(tracker.next_shadow_issues(issues, prs, dates), "issues")
    reported = named.filter("event_id is not null").select(
        "pull_request_id", F.col("event_action").alias("action"), F.col("event_actor").alias("actor"),
        F.col("event_ts").alias("created_at"), F.col("event_id").alias("id"),
    )

    def discussion() -> Tables:
        issue_tables = {}
        if "issues" in records:
            issue_tables = store_issues(next_tables, {n: rows for n, rows in records.items() if n != "issue_comments"})
        return issue_tables | store_children(next_tables | issue_tables, records)

    done = together(projects.sparkSession, {
        "discussion": discussion,
        "pull_request_history": lambda: tracker.next_history(
            tables["pull_request_history"], cut_lineage(history_candidates(named, reported), "candidates"), users
        ),
    })
    return next_tables | done.pop("discussion") | done


def store_children(tables: Tables, records: Tables) -> Tables:
    """Commits and review comments of pull requests, and comments of issues and pull requests, as far as staged."""
    projects, users, prs, commits = (tables[n] for n in ("projects", "users", "pull_requests", "commits"))
    steps = {}
    if "pull_commit_lists" in records:
        steps["pull_request_commits"] = lambda: tracker.next_pull_request_commits(
            tables["pull_request_commits"],
            tracker.pull_request_commit_rows(records["pull_commit_lists"], prs, projects, users, commits), stored=True,
        )
    if "pull_request_comments" in records:
        steps["pull_request_comments"] = lambda: tracker.next_pull_request_comments(
            tables["pull_request_comments"], records["pull_request_comments"], prs, projects, users, commits, stored=True
        )
    if "issue_comments" in records:
        steps["issue_comments"] = lambda: tracker.next_issue_comments(
            tables["issue_comments"], records["issue_comments"], tables["issues"], projects, users, stored=True
        )
    return together(projects.sparkSession, steps)


def expand_organizations(tables: Tables, before: DataFrame, raw: Tables, now: Column) -> Tables:
    """Members of the organizations that are in the users table but weren't in `before`.

    Members are accounts too; one that is a new organization is expanded in the next
    round, so the last round finds none. Nothing happens where no members are staged.
    """
    if "org_members" not in raw:
        return tables
    users, members, seen = tables["users"], tables["organization_members"], before
    while True:
        fresh = missing(users.filter("type = 'ORG'").select("login"), seen, ["login"])
        listed = raw["org_members"].join(fresh.withColumnRenamed("login", "org"), "org", "left_semi")
        listed = cut_lineage(listed.select("org", "login"), "org_members")
        if listed.isEmpty():
            return {**tables, "users": users, "organization_members": members}
        seen = users
        users = cut_lineage(ensure_users(users, listed, raw["users"], now), "users")
        members = cut_lineage(people.next_organization_members(members, listed, users), "organization_members")


def store_issues(tables: Tables, records: Tables) -> Tables:
    """Issues with their events, assignees, comments and labels, as far as their records are staged."""
    projects, users = tables["projects"], tables["users"]
    issues = cut_lineage(tracker.next_issues(tables["issues"], records["issues"], projects, users, tables["pull_requests"]), "issues")

    def with_events() -> Tables:
        events = tracker.next_issue_events(tables["issue_events"], records["issue_events"], issues, projects, users, stored=True)
        return {"issue_events": events, "issues": cut_lineage(tracker.with_assignees(issues, events), "issues")}

    def with_comments() -> Tables:
        return {"issue_comments": tracker.next_issue_comments(
            tables["issue_comments"], records["issue_comments"], issues, projects, users, stored=True
        )}

    def with_labels() -> Tables:
        labels = tracker.next_repo_labels(tables["repo_labels"], records["repo_labels"], projects, users)
        links = tracker.issue_label_rows(tracker.labelled_issues(records["issues"]), labels, issues, projects, users)
        return {"repo_labels": labels, "issue_labels": tracker.next_issue_labels(tables["issue_labels"], links, stored=True)}

    steps = {"issue_events": with_events, "issue_comments": with_comments, "repo_labels": with_labels}
    result = {"issues": issues}
    for found in together(issues.sparkSession, {n: step for n, step in steps.items() if n in records}).values():
        result |= found
    return result


Stage = Callable[[Tables, dict[str, DataFrame], DataFrame, Column], Tables]


def staged_for(raw: dict[str, DataFrame], name: str, repos: DataFrame) -> DataFrame | None:
    """Staged rows of the listed repositories (owner, repo), when the collection was staged."""
    return raw[name].join(repos, ["owner", "repo"], "left_semi") if name in raw else None


def commits_stage(tables: Tables, raw: dict[str, DataFrame], repos: DataFrame, now: Column) -> Tables:
    # A commit record names its repository in its URL only.
    placed = {n: rows.withColumns({"owner": url_owner(F.col("url")), "repo": url_repo(F.col("url"))}) for n, rows in raw.items() if n == "commits"}
    rows = staged_for(placed, "commits", repos)
    return tables if rows is None else store_commits(tables, rows, raw["users"], now)


def topics_stage(tables: Tables, raw: dict[str, DataFrame], repos: DataFrame, now: Column) -> Tables:
    rows = staged_for(raw, "topics", repos)
    if rows is None:
        return tables
    keys = project_keys(tables["projects"], tables["users"])
    looked_at = rows.join(keys, ["owner", "repo"]).select("project_id", "names")
    listed = looked_at.select("project_id", F.explode("names").alias("topic_name"))
    return {**tables, "project_topics": code.next_topics(tables["project_topics"], listed, looked_at, now)}


def languages_stage(tables: Tables, raw: dict[str, DataFrame], repos: DataFrame, now: Column) -> Tables:
    rows = staged_for(raw, "languages", repos)
    if rows is None:
        return tables
    fresh = code.language_rows(rows, tables["projects"], tables["users"], now)
    return {**tables, "project_languages": tables["project_languages"].unionByName(fresh)}


def pull_requests_stage(tables: Tables, raw: dict[str, DataFrame], repos: DataFrame, now: Column) -> Tables:
    rows = staged_for(raw, "pull_requests", repos)
    if rows is None:
        return tables
    children = cut_all(of_pull_requests(raw, rows))
    if "commits" in raw:
        shas = shas_of_pull_requests(rows, children, tables["projects"], tables["users"])
        tables = store_commits(tables, raw["commits"].join(shas, "sha", "left_semi"), raw["users"], now)
    projects, users = tables["projects"], tables["users"]
    prs = cut_lineage(tracker.next_pull_requests(tables["pull_requests"], rows, projects, users, tables["commits"]), "next_pull_requests")
    named = cut_lineage(rows.join(pr_lookup(prs, projects, users), ["owner", "repo", "number"]), "named_pull_requests")
    dates = named.join(project_keys(projects, users).select("owner", "repo", F.col("project_id").alias("base_repo_id")), ["owner", "repo"]).select(
        F.col("number").alias("pullreq_id"), "base_repo_id", tracker.stamp("created_at").alias("created_at")
    ).groupBy("pullreq_id", "base_repo_id").agg(F.min("created_at").alias("created_at"))
    before = tables

    def shadows_and_children() -> Tables:
        issues = cut_lineage(tracker.next_shadow_issues(before["issues"], prs, dates), "issues")
        return {"issues": issues} | store_children({**before, "pull_requests": prs, "issues": issues}, children)

    done = together(prs.sparkSession, {
        "children": shadows_and_children,
        "pull_request_history": lambda: tracker.next_history(
            before["pull_request_history"], cut_lineage(history_candidates(named), "candidates"), users
        ),
    })
    return before | {"pull_requests": prs} | done.pop("children") | done


def issues_stage(tables: Tables, raw: dict[str, DataFrame], repos: DataFrame, now: Column) -> Tables:
    rows = staged_for(raw, "issues", repos)
    if rows is None:
        return tables
    records = {"issues": rows} | {n: staged_for(raw, n, repos) for n in ("issue_events", "issue_comments", "repo_labels") if n in raw}
    return tables | store_issues(tables, records)


def watchers_stage(tables: Tables, raw: dict[str, DataFrame], repos: DataFrame, now: Column) -> Tables:
    rows = staged_for(raw, "watchers", repos)
    if rows is None:
        return tables
    staged = rows.select(
        "owner", "repo", "login", F.lit(None).cast("timestamp").alias("event_ts"),
        tracker.stamp("created_at").alias("record_ts"), F.lit(0).alias("id"),
    )
    return {**tables, "watchers": people.next_watchers(tables["watchers"], staged, tables["projects"], tables["users"], stored=True)}


def labels_stage(tables: Tables, raw: dict[str, DataFrame], repos: DataFrame, now: Column) -> Tables:
    rows = staged_for(raw, "repo_labels", repos)
    if rows is None:
        return tables
    labels = tracker.next_repo_labels(tables["repo_labels"], rows, tables["projects"], tables["users"])
    result = {**tables, "repo_labels": labels}
    issues = staged_for(raw, "issues", repos)
    if issues is not None:
        links = tracker.issue_label_rows(tracker.labelled_issues(issues), labels, tables["issues"], tables["projects"], tables["users"])
        result["issue_labels"] = tracker.next_issue_labels(tables["issue_labels"], links, stored=True)
    return result


def forks_stage(tables: Tables, raw: dict[str, DataFrame], repos: DataFrame, now: Column) -> Tables:
    rows = staged_for(raw, "forks", repos)
    return tables if rows is None else {**tables, "projects": code.next_forks(tables["projects"], rows, tables["users"], now)}


# The stages of a repository refresh, in order.
STAGES: dict[str, Stage] = {
    "commits": commits_stage,
    "topics": topics_stage,
    "languages": languages_stage,
    "pull_requests": pull_requests_stage,
    "issues": issues_stage,
    "watchers": watchers_stage,
    "labels": labels_stage,
    "forks": forks_stage,
}


# Collections that the stages read.
STAGE_COLLECTIONS: dict[str, list[str]] = {
    "commits": ["commits", "users"],
    "topics": ["topics"],
    "languages": ["languages"],
    "pull_requests": ["pull_requests", "pull_commit_lists", "pull_request_comments", "issue_comments"],
    "issues": ["issues", "issue_events", "issue_comments", "repo_labels"],
    "watchers": ["watchers"],
    "labels": ["repo_labels", "issues"],
    "forks": ["forks"],
}


def prepare_refresh(tables: Tables, raw: dict[str, DataFrame], repos: DataFrame, now: Column) -> Tables:
    """Accounts and projects that the staged records of the listed repositories need, the repositories themselves first."""
    if "users" not in raw:
        return tables
    names = ["pull_requests", "pull_request_comments", "issues", "issue_events", "issue_comments", "watchers"]
    staged = {n: raw[n].join(repos, ["owner", "repo"], "left_semi") for n in names if n in raw}
    wanted = repos.select("owner", F.col("repo").alias("name"))
    if "pull_requests" in staged:
        wanted = wanted.unionByName(head_repos(staged["pull_requests"]))
    logins = people_of_records(staged)
    if "forks" in raw:
        logins.append(code.fork_rows(raw["forks"].join(repos, ["owner", "repo"], "left_semi")).select(F.col("owner").alias("login")))
    known = code.repo_rows(raw["repos"]) if "repos" in raw else None
    wanted = cut_lineage(wanted.distinct() if known is None else code.with_parents(wanted, known), "wanted_repos")
    users = cut_lineage(ensure_users(tables["users"], union_all([wanted.select(F.col("owner").alias("login")), *logins]), raw["users"], now), "users")
    tables = {**tables, "users": users}
    if known is None:
        return tables
    return {**tables, "projects": cut_lineage(code.next_projects(tables["projects"], known.join(wanted, ["owner", "name"], "left_semi"), users, now), "projects")}


def refreshed_now(projects: DataFrame, users: DataFrame, repos: DataFrame, now: Column) -> DataFrame:
    """The projects with the refresh date of the listed repositories set."""
    done = project_keys(projects, users).join(repos, ["owner", "repo"], "left_semi")
    return touch(projects, done.select(F.col("project_id").alias("id")), ["id"], now)


def open_worklist(worklist: DataFrame, quarantined: DataFrame | None) -> DataFrame:
    """(owner, repo) to refresh, without the quarantined."""
    repos = worklist.select("owner", "repo").distinct()
    return cut_lineage(repos if quarantined is None else repos.join(quarantined, ["owner", "repo"], "left_anti"), "worklist")


def check_stages(raw: dict[str, DataFrame], only_stage: str | None, skip: Collection[str]) -> list[str]:
    """Names of the stages to run, whose collections are staged or to be skipped."""
    if only_stage is not None and only_stage not in STAGES:
        raise ValueError(f"not a stage: {only_stage}")
    names = [n for n in STAGES if only_stage in (None, n)]
    check_collections(raw, [c for n in names for c in STAGE_COLLECTIONS[n]], skip)
    return names


def refresh_repos(
    tables: Tables, raw: dict[str, DataFrame], worklist: DataFrame, now: Column, only_stage: str | None = None,
    quarantined: DataFrame | None = None, skip: Collection[str] = (),
) -> Tables:
    """All stages, in order, for every listed repository (owner, repo) at once.

    An empty stage does not end a repository's refresh. Quarantined repositories
    are left out. A single stage leaves the refresh date alone. A collection that is
    not staged is an error, unless `skip` names it.
    """
    names = check_stages(raw, only_stage, skip)
    repos = open_worklist(worklist, quarantined)
    before = tables["users"]
    tables = prepare_refresh(tables, raw, repos, now)
    for name in names:
        tables = STAGES[name](tables, raw, repos, now)
    tables = expand_organizations(tables, before, raw, now)
    if only_stage is None:
        tables = {**tables, "projects": refreshed_now(tables["projects"], tables["users"], repos, now)}
    return tables


REPORT = "owner string, repo string, stage string, outcome string, staged_rows bigint, seconds double"


def reported_refresh(
    tables: Tables, raw: dict[str, DataFrame], worklist: DataFrame, now: Column, only_stage: str | None = None,
    quarantined: DataFrame | None = None, skip: Collection[str] = (),
) -> tuple[Tables, DataFrame]:
    """The refresh, stage by stage, and a report with one row per repository and stage.

    A stage's changed tables are written before the next one starts, so its time is its
    own; the time is the stage's, for all repositories together. Only an error ends the
    refresh: the failed stage is reported with its reason, those behind it have no row, the
    tables are those before it and the refresh date stays. A repository that is in no table
    after the preparation is skipped: its owner or itself is unknown.
    """
    names = check_stages(raw, only_stage, skip)
    repos = open_worklist(worklist, quarantined)
    spark = repos.sparkSession
    before = tables["users"]
    tables = prepare_refresh(tables, raw, repos, now)
    keys = project_keys(tables["projects"], tables["users"]).select("owner", "repo")
    unknown = repos.join(keys, ["owner", "repo"], "left_anti").selectExpr("owner", "repo", "cast(null as string) as stage", "'unknown' as outcome", "0L as staged_rows", "0D as seconds")
    repos = cut_lineage(repos.join(keys, ["owner", "repo"], "left_semi"), "worklist")
    rows = [unknown]
    failed = False
    for name in names:
        started = time.monotonic()
        try:
            after = STAGES[name](tables, raw, repos, now)
            tables = {n: t if t is tables.get(n) else cut_lineage(t, n) for n, t in after.items()}
            outcome = "done"
        except PySparkException as problem:
            outcome, failed = f"error: {str(problem).splitlines()[0]}", True
        seconds = time.monotonic() - started
        staged = [rows_of_stage(raw, c, repos) for c in STAGE_COLLECTIONS[name] if c in raw and c != "users"]
        counts = union_all([repos.select("owner", "repo", F.lit(0).alias("one")), *staged]).groupBy("owner", "repo").agg(F.sum("one").alias("staged_rows"))
        rows.append(counts.select("owner", "repo", F.lit(name).alias("stage"), F.lit(outcome).alias("outcome"), "staged_rows", F.lit(seconds).alias("seconds")))
        if failed:
            break
    report = cut_lineage(spark.createDataFrame([], REPORT).unionByName(union_all(rows)), "report")
    if not failed:
        tables = expand_organizations(tables, before, raw, now)
        if only_stage is None:
            tables = {**tables, "projects": refreshed_now(tables["projects"], tables["users"], repos, now)}
    return tables, report


def rows_of_stage(raw: dict[str, DataFrame], collection: str, repos: DataFrame) -> DataFrame:
    """One row (owner, repo, one) per staged record of the listed repositories."""
    rows = raw[collection]
    if collection == "commits":
        rows = rows.select(url_owner(F.col("url")).alias("owner"), url_repo(F.col("url")).alias("repo"))
    return rows.select("owner", "repo", F.lit(1).alias("one")).join(repos, ["owner", "repo"], "left_semi")
