"""Tables by natural keys: ids replaced by what they stand for, so that two table sets can be compared row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.operators.changes import union_all
from forgelake.operators.lookup import project_lookup
from forgelake.session import cut_all, cut_lineage

Tables = dict[str, DataFrame]


def _labels(tables: Tables) -> dict[str, DataFrame]:
    """Per table with ids: id and the text that names the row."""
    users = tables["users"].select("id", F.col("login").alias("label"))
    projects = cut_lineage(project_lookup(tables["projects"], tables["users"]).select("id", F.concat_ws("/", "owner", "name").alias("label")), "labels")
    repo = projects.select(F.col("id").alias("repo_id"), F.col("label").alias("repo"))

    def inside(name: str, column: str, mark: str, text: str) -> DataFrame:
        return tables[name].select("id", F.col(column).alias("repo_id"), F.col(text).alias("text")).join(repo, "repo_id").select(
            "id", F.concat_ws(mark, "repo", "text").alias("label")
        )

    return {
        "users": users, "projects": projects, "commits": tables["commits"].select("id", F.col("sha").alias("label")),
        "pull_requests": inside("pull_requests", "base_repo_id", "#", "pullreq_id"), "issues": inside("issues", "repo_id", "!", "issue_id"),
        "repo_labels": inside("repo_labels", "repo_id", ":", "name"),
    }


# What a row of each table says: plain columns, and ids with the table they point to.
SAYS: dict[str, list[str | tuple[str, str]]] = {
    "users": ["login", "type"],
    "followers": [("follower_id", "users"), ("user_id", "users"), "created_at"],
    "organization_members": [("org_id", "users"), ("user_id", "users")],
    "projects": [("owner_id", "users"), "name", ("forked_from", "projects")],
    "project_members": [("repo_id", "projects"), ("user_id", "users"), "created_at"],
    "commits": ["sha", ("author_id", "users"), ("committer_id", "users"), ("project_id", "projects"), "created_at"],
    "commit_comments": [("commit_id", "commits"), ("user_id", "users"), "body", "comment_id", "created_at"],
    "commit_parents": [("commit_id", "commits"), ("parent_id", "commits")],
    "project_commits": [("project_id", "projects"), ("commit_id", "commits")],
    "pull_requests": [("base_repo_id", "projects"), "pullreq_id", ("head_repo_id", "projects"), ("base_commit_id", "commits"), ("head_commit_id", "commits"), "intra_branch"],
    "pull_request_comments": [("pull_request_id", "pull_requests"), ("user_id", "users"), "comment_id", "body", "created_at"],
    "pull_request_history": [("pull_request_id", "pull_requests"), "action", ("actor_id", "users"), "created_at"],
    "pull_request_commits": [("pull_request_id", "pull_requests"), ("commit_id", "commits")],
    "repo_labels": [("repo_id", "projects"), "name"],
    "watchers": [("repo_id", "projects"), ("user_id", "users"), "created_at"],
    "issues": [("repo_id", "projects"), "issue_id", "pull_request", ("reporter_id", "users"), ("assignee_id", "users"), ("pull_request_id", "pull_requests"), "created_at"],
    "issue_labels": [("label_id", "repo_labels"), ("issue_id", "issues")],
    "issue_comments": [("issue_id", "issues"), ("user_id", "users"), "comment_id", "created_at"],
    "issue_events": ["event_id", ("issue_id", "issues"), ("actor_id", "users"), "action", "action_specific", "created_at"],
    "project_languages": [("project_id", "projects"), "language", "bytes"],
    "project_topics": [("project_id", "projects"), "topic_name", "deleted"],
}


def _text(name: str, kind: str) -> Column:
    c = F.col(f"`{name}`")
    return F.coalesce((F.unix_seconds(c) if kind == "timestamp" else c).cast("string"), F.lit("-"))


def natural_rows(tables: Tables, names: list[str] | None = None, without: dict[str, list[str]] | None = None) -> DataFrame:
    """name and row: every row of the named tables as one text, ids written as what they name, null as `-`.

    `without` lists columns to leave out, per table. Labels that take a join are stored: many tables point to them.
    """
    names = names or list(SAYS)
    pointed_to = {said[1] for name in names for said in SAYS[name] if not isinstance(said, str)}
    plain = ("users", "commits", "projects")  # the last is stored already
    labels = {n: rows for n, rows in _labels(tables).items() if n in pointed_to}
    labels |= cut_all({n: rows for n, rows in labels.items() if n not in plain})
    parts = []
    for name in names:
        dropped = (without or {}).get(name, [])
        df, texts = tables[name], []
        kinds = dict(df.dtypes)
        for said in SAYS[name]:
            column, target = (said, None) if isinstance(said, str) else said
            if column in dropped:
                continue
            if target is None:
                texts.append(_text(column, kinds[column]))
            else:
                side = labels[target].select(F.col("id").alias(column), F.col("label").alias(f"{column}_label"))
                df = df.join(side, column, "left")
                texts.append(F.coalesce(f"{column}_label", F.lit("-")))
        parts.append(df.select(F.lit(name).alias("name"), F.concat_ws("|", *texts).alias("row")))
    return union_all(parts)


def difference(one: Tables, two: Tables, names: list[str] | None = None) -> DataFrame:
    """name, row, n: rows that occur n times more often in the first set (less often: n below 0)."""
    signed = natural_rows(one, names).withColumn("n", F.lit(1)).unionByName(natural_rows(two, names).withColumn("n", F.lit(-1)))
    return signed.groupBy("name", "row").agg(F.sum("n").alias("n")).filter("n <> 0")
