"""Relational tables, natural keys, references and raw read schemas."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Columns and types of the relational model.
TABLES: dict[str, str] = {
    "users": (
        "id bigint, login string, name string, company string, email string, created_at timestamp, "
        "type string, fake boolean, deleted boolean, `long` decimal(11,8), lat decimal(10,8), "
        "country_code string, state string, city string, location string, updated_at timestamp"
    ),
    "projects": (
        "id bigint, url string, owner_id bigint, name string, description string, language string, "
        "created_at timestamp, forked_from bigint, deleted boolean, updated_at timestamp, "
        "forked_commit_id bigint, etag string"
    ),
    "commits": (
        "id bigint, sha string, author_id bigint, committer_id bigint, project_id bigint, created_at timestamp"
    ),
    "commit_comments": (
        "id bigint, commit_id bigint, user_id bigint, body string, line int, position int, "
        "comment_id bigint, created_at timestamp"
    ),
    "commit_parents": "commit_id bigint, parent_id bigint",
    "followers": "follower_id bigint, user_id bigint, created_at timestamp",
    "pull_requests": (
        "id bigint, head_repo_id bigint, base_repo_id bigint, head_commit_id bigint, "
        "base_commit_id bigint, pullreq_id bigint, intra_branch boolean"
    ),
    "issues": (
        "id bigint, repo_id bigint, reporter_id bigint, assignee_id bigint, pull_request boolean, "
        "pull_request_id bigint, created_at timestamp, issue_id bigint"
    ),
    "issue_comments": "issue_id bigint, user_id bigint, comment_id bigint, created_at timestamp",
    "issue_events": (
        "event_id bigint, issue_id bigint, actor_id bigint, action string, action_specific string, "
        "created_at timestamp"
    ),
    "repo_labels": "id bigint, repo_id bigint, name string",
    "issue_labels": "label_id bigint, issue_id bigint",
    "organization_members": "org_id bigint, user_id bigint, created_at timestamp",
    "project_commits": "project_id bigint, commit_id bigint",
    "project_members": "repo_id bigint, user_id bigint, created_at timestamp, ext_ref_id string",
    "project_languages": "project_id bigint, language string, bytes bigint, created_at timestamp",
    "project_topics": "project_id bigint, topic_name string, created_at timestamp, deleted boolean",
    "pull_request_comments": (
        "pull_request_id bigint, user_id bigint, comment_id bigint, position int, body string, "
        "commit_id bigint, created_at timestamp"
    ),
    "pull_request_commits": "pull_request_id bigint, commit_id bigint",
    "pull_request_history": (
        "id bigint, pull_request_id bigint, created_at timestamp, action string, actor_id bigint"
    ),
    "repo_milestones": "id bigint, repo_id bigint, name string",
    "watchers": "repo_id bigint, user_id bigint, created_at timestamp",
}

# Natural key of every table (project_languages keeps snapshots, no key).
TABLE_KEYS: dict[str, list[str]] = {
    "users": ["login"],
    "projects": ["owner_id", "name"],
    "commits": ["sha"],
    "commit_comments": ["comment_id"],
    "commit_parents": ["commit_id", "parent_id"],
    "followers": ["follower_id", "user_id"],
    "pull_requests": ["pullreq_id", "base_repo_id"],
    "issues": ["repo_id", "issue_id"],
    "issue_comments": ["issue_id", "comment_id"],
    "issue_events": ["event_id", "issue_id"],
    "repo_labels": ["repo_id", "name"],
    "issue_labels": ["label_id", "issue_id"],
    "organization_members": ["org_id", "user_id"],
    "project_commits": ["project_id", "commit_id"],
    "project_members": ["repo_id", "user_id"],
    "project_topics": ["project_id", "topic_name"],
    "pull_request_comments": ["pull_request_id", "comment_id"],
    "pull_request_commits": ["pull_request_id", "commit_id"],
    "watchers": ["repo_id", "user_id"],
}

# Fixed values: (table, column, referenced table); the target column is always id.
FOREIGN_KEYS: list[tuple[str, str, str]] = [
    ("commit_comments", "commit_id", "commits"),
    ("commit_comments", "user_id", "users"),
    ("commit_parents", "commit_id", "commits"),
    ("commit_parents", "parent_id", "commits"),
    ("commits", "author_id", "users"),
    ("commits", "committer_id", "users"),
    ("commits", "project_id", "projects"),
    ("followers", "follower_id", "users"),
    ("followers", "user_id", "users"),
    ("issue_comments", "issue_id", "issues"),
    ("issue_comments", "user_id", "users"),
    ("issue_events", "actor_id", "users"),
    ("issue_events", "issue_id", "issues"),
    ("issue_labels", "issue_id", "issues"),
    ("issue_labels", "label_id", "repo_labels"),
    ("issues", "assignee_id", "users"),
    ("issues", "pull_request_id", "pull_requests"),
    ("issues", "repo_id", "projects"),
    ("issues", "reporter_id", "users"),
    ("organization_members", "org_id", "users"),
    ("organization_members", "user_id", "users"),
    ("project_commits", "commit_id", "commits"),
    ("project_commits", "project_id", "projects"),
    ("project_languages", "project_id", "projects"),
    ("project_members", "repo_id", "projects"),
    ("project_members", "user_id", "users"),
    ("project_topics", "project_id", "projects"),
    ("projects", "forked_commit_id", "commits"),
    ("projects", "forked_from", "projects"),
    ("projects", "owner_id", "users"),
    ("pull_request_comments", "commit_id", "commits"),
    ("pull_request_comments", "pull_request_id", "pull_requests"),
    ("pull_request_comments", "user_id", "users"),
    ("pull_request_commits", "commit_id", "commits"),
    ("pull_request_commits", "pull_request_id", "pull_requests"),
    ("pull_request_history", "actor_id", "users"),
    ("pull_request_history", "pull_request_id", "pull_requests"),
    ("pull_requests", "base_commit_id", "commits"),
    ("pull_requests", "base_repo_id", "projects"),
    ("pull_requests", "head_commit_id", "commits"),
    ("pull_requests", "head_repo_id", "projects"),
    ("repo_labels", "repo_id", "projects"),
    ("repo_milestones", "repo_id", "projects"),
    ("watchers", "repo_id", "projects"),
    ("watchers", "user_id", "users"),
]

# Tables that jobs keep beside the relational model, in the same versions.
JOB_TABLES: dict[str, str] = {
    "replay_marks": "owner string, repo string, event_id bigint",
}

# Order in which the tables are read and written.
TABLE_ORDER: list[str] = [
    "users", "followers", "organization_members", "projects", "project_members", "commits",
    "commit_comments", "commit_parents", "project_commits", "pull_requests", "pull_request_comments",
    "pull_request_history", "pull_request_commits", "repo_labels", "repo_milestones", "watchers",
    "issues", "issue_labels", "issue_comments", "issue_events", "project_languages", "project_topics",
]

# Raw collections and their natural keys.
COLLECTION_KEYS: dict[str, list[str]] = {
    "events": ["id"],
    "users": ["login"],
    "commits": ["sha"],
    "commit_comments": ["commit_id", "id"],
    "repos": ["name", "owner.login"],
    "repo_labels": ["repo", "owner", "name"],
    "repo_collaborators": ["repo", "owner", "login"],
    "followers": ["follows", "login"],
    "org_members": ["org", "login"],
    "watchers": ["repo", "owner", "login"],
    "forks": ["repo", "owner", "id"],
    "pull_requests": ["repo", "owner", "number"],
    "pull_request_comments": ["repo", "owner", "pullreq_id", "id"],
    "issues": ["repo", "owner", "number"],
    "issue_events": ["repo", "owner", "issue_id", "id"],
    "issue_comments": ["repo", "owner", "issue_id", "id"],
    "geo_cache": ["key"],
    "pull_request_commits": ["sha"],
    "topics": ["repo", "owner"],
}

_REPO_REF = "struct<name:string,full_name:string,owner:struct<login:string>>"
_PR_SIDE = f"struct<sha:string,repo:{_REPO_REF}>"
_PULL_REQUEST = (
    "number:bigint,created_at:string,merged_at:string,closed_at:string,user:struct<login:string>,"
    f"merged_by:struct<login:string>,head:{_PR_SIDE},base:{_PR_SIDE}"
)
_COMMIT = (
    "sha string, url string, author struct<login:string>, committer struct<login:string>, "
    "commit struct<comment_count:int,author:struct<name:string,email:string,date:string>,"
    "committer:struct<name:string,email:string>>, parents array<struct<sha:string,url:string>>"
)

# Paths the jobs read, per raw collection. Bulky fields (file patches) are left
# out, so the JSON reader skips them.
RAW: dict[str, str] = {
    "events": (
        "id string, type string, created_at string, "
        "actor struct<id:bigint,login:string,avatar_url:string,gravatar_id:string,url:string>, "
        "repo struct<name:string>, payload struct<"
        "commits:array<struct<sha:string,url:string>>,number:bigint,action:string,"
        f"pull_request:struct<{_PULL_REQUEST}>,"
        "comment:struct<id:bigint,commit_id:string,_links:struct<pull_request:struct<href:string>>>,"
        "issue:struct<number:bigint>,target:struct<login:string>,member:struct<login:string>,"
        "forkee:struct<id:bigint,url:string,full_name:string>,ref_type:string>"
    ),
    "users": (
        "login string, name string, company string, email string, location string, type string, created_at string"
    ),
    "repos": (
        "url string, name string, description string, language string, created_at string, "
        "default_branch string, owner struct<login:string>, parent struct<name:string,owner:struct<login:string>>"
    ),
    "commits": _COMMIT,
    "commit_comments": (
        "id bigint, commit_id string, user struct<login:string>, body string, line int, position int, "
        "created_at string"
    ),
    "repo_labels": "owner string, repo string, name string",
    "repo_collaborators": "owner string, repo string, login string",
    "followers": "follows string, login string",
    "org_members": "org string, login string",
    "watchers": "owner string, repo string, login string, created_at string",
    "forks": "owner string, repo string, id bigint, url string, full_name string",
    "pull_requests": "owner string, repo string, " + ", ".join(
        part.replace(":", " ", 1) for part in (
            "number:bigint", "created_at:string", "merged_at:string", "closed_at:string",
            "user:struct<login:string>", "merged_by:struct<login:string>",
            f"head:{_PR_SIDE}", f"base:{_PR_SIDE}",
        )
    ),
    "pull_request_comments": (
        "id string, owner string, repo string, pullreq_id string, issue_id string, user struct<login:string>, "
        "body string, original_position int, original_commit_id string, created_at string"
    ),
    "issues": (
        "owner string, repo string, number bigint, created_at string, user struct<login:string>, "
        "assignee struct<login:string>, pull_request struct<patch_url:string>, labels array<struct<name:string>>"
    ),
    "issue_events": (
        "id bigint, owner string, repo string, issue_id bigint, event string, commit_id string, "
        "actor struct<login:string>, created_at string"
    ),
    "issue_comments": (
        "id bigint, owner string, repo string, issue_id bigint, user struct<login:string>, created_at string"
    ),
    "geo_cache": (
        "key string, `long` double, lat double, city string, country string, state string, "
        "country_code string, status string"
    ),
    "pull_request_commits": _COMMIT + ", pull_request_id bigint",
    "topics": "owner string, repo string, names array<string>",
    # Staged answers that are no collection of their own.
    "branch_diffs": (
        "owner string, repo string, ahead_by int, behind_by int, merge_base_commit struct<sha:string>, "
        "commits array<struct<sha:string,commit:struct<author:struct<date:string>>,parents:array<struct<sha:string>>>>"
    ),
    "languages": "owner string, repo string, languages map<string,string>",
    "pull_commit_lists": "owner string, repo string, number bigint, sha string, url string",
}

# Event types that have a handler.
HANDLED_EVENTS: list[str] = [
    "PushEvent", "WatchEvent", "FollowEvent", "MemberEvent", "CreateEvent", "CommitCommentEvent",
    "PullRequestEvent", "ForkEvent", "PullRequestReviewCommentEvent", "IssuesEvent", "IssueCommentEvent",
]


def struct_of(ddl: str) -> StructType:
    """Parse a DDL column list."""
    return StructType.fromDDL(ddl)


def table_schema(name: str) -> StructType:
    return struct_of(TABLES[name] if name in TABLES else JOB_TABLES[name])


def raw_schema(name: str) -> StructType:
    """Read schema of a raw collection; an unknown name is an error."""
    if name not in RAW:
        raise ValueError(f"unknown collection: {name}")
    return struct_of(RAW[name])
