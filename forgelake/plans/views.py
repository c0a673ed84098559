"""Forge-shaped views over the driver tables, in SQL that Spark and DuckDB both run.

A query and its check start from the same text. `SPARK_VIEWS` holds the few
views that exist for Spark only (JSON documents) or avoid a cross join there.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forgelake.session import new_path, prepare
from forgelake.sources.entities import read_events

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

# The driver tables and stored intermediate results are packed files, a byte of which is many bytes of rows: keys that
# follow each other take less than one byte each. Taken by the size of their files, tables of millions of rows were
# broadcast, which the driver has to hold. What is small by measure is still broadcast, behind its shuffle.
PACKED_CONF = {"spark.sql.sources.fileCompressionFactor": "16"}

_EVENT_COLUMNS = """event_id as id, ts as created_at, user_id as actor_id,
       'u' || cast(user_id as string) as actor_login,
       case event_type when 'click' then 'WatchEvent' when 'view' then 'PushEvent'
            when 'signup' then 'FollowEvent' when 'purchase' then 'PullRequestEvent'
            else 'GollumEvent' end as type,
       cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k,
       'o' || cast(cast(regexp_extract(props, '([0-9]+)', 1) as bigint) % 10 as string)
           || '/r' || regexp_extract(props, '([0-9]+)', 1) as repo"""

_SHA = "md5(cast(l_orderkey as string) || '-' || cast({pos} as string)) || substr(md5(cast(l_orderkey as string)), 1, 8)"

VIEWS: dict[str, str] = {
    # Events with planted copies.
    "v_events": f"""select {_EVENT_COLUMNS}, value, c.copy
from events cross join (select 0 as copy union all select 1 as copy) c
where c.copy = 0 or event_id % 7 = 0""",
    "v_follows": """select actor_login as follower, 'u' || cast(k as string) as followed, created_at, id
from v_events where type = 'FollowEvent' and copy = 0""",
    "v_users": """select 'u' || cast(c_custkey as string) as login, c_name as name,
       case when c_custkey % 5 = 0 then null
            else 'm' || cast(c_custkey % 1200 as string) || '@n' || cast(c_nationkey as string) || '.example.org' end as email,
       case c_mktsegment when 'BUILDING' then 'Organization' when 'MACHINERY' then null else 'User' end as type,
       ' #' || n_name || ',  ' || r_name || ' ' as location, o.created_at
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
left join (select o_custkey, min(o_orderdate) as created_at from orders group by o_custkey) o on o.o_custkey = c_custkey""",
    "v_identities": """select o_orderkey as seq, o_orderdate as created_at,
       case when o_custkey % 4 = 0 then null when o_orderkey % 50 = 0 then 'gone' || cast(o_custkey as string)
            else 'u' || cast(o_custkey as string) end as login,
       c_name as name,
       'm' || cast(o_custkey % 1300 as string) || '@n' || cast(c_nationkey as string) || '.example.org' as email
from orders join customer on o_custkey = c_custkey""",
    "v_projects": """select 'u' || cast(p_partkey % 150 as string) as owner, 'r' || cast(p_partkey as string) as name,
       p_name || ' ' || p_type as description, p_type as language,
       case when p_partkey % 3 = 1 and p_partkey >= 97 then 'r' || cast(p_partkey % 97 as string) end as parent,
       l.updated_at
from part left join (select l_partkey, max(l_shipdate) as updated_at from lineitem group by l_partkey) l on l.l_partkey = p_partkey""",
    "v_commits": f"""select {_SHA.format(pos='l_linenumber')} as sha,
       l_orderkey as line_id, l_linenumber as pos, 'r' || cast(l_partkey as string) as project,
       's' || cast(l_suppkey as string) as author, l_shipdate as created_at
from lineitem""",
    "v_parents": """select distinct a.sha, b.sha as parent_sha
from v_commits a join v_commits b on a.line_id = b.line_id and a.pos = b.pos + 1""",
    "v_forks": """select 'f' || cast(l_orderkey as string) as fork, 'r' || cast(min(l_partkey) as string) as parent,
       count(*) as ahead_by, min(l_shipdate) as first_diverging
from lineitem group by l_orderkey""",
    "v_prs": """select o_orderkey as number, 'r' || cast(o_custkey % 97 as string) as base,
       case when o_orderkey % 11 = 0 then null else 'r' || cast(o_custkey % 101 as string) end as head,
       'u' || cast(o_custkey as string) as author, o_orderdate as created_at,
       o_orderstatus = 'F' as merged
from orders""",
    "v_pr_events": """select user_id as pr, case event_type when 'signup' then 'opened' when 'purchase' then 'merged' when 'error' then 'closed'
         when 'click' then 'reopened' else 'synchronize' end as action,
       ts as created_at, event_id as id,
       case when event_id % 6 = 0 then null else 'u' || cast(event_id % 40 as string) end as actor
from events""",
    "v_comments": "select conv_id as issue, turn as comment_id, role as author, text as body from conversations",
    "v_topics": """select source as project, lang || cast(n_chars % 20 as string) as topic, doc_id % 2 as snapshot
from documents""",
    "v_locations": """select distinct location as raw from v_users
union all select cast(n_nationkey as string) || '/2, (' || n_name || ')' from nation""",
    "v_logs": """select event_id as id, case when event_type = 'error' then 'WARN' when event_type = 'view' then 'DEBUG' else 'INFO' end
       || ', ' || cast(cast(ts as date) as string) || 'T00:00:00Z, w' || cast(user_id % 8 as string) || ' -- api_client.rb: '
       || case when event_type = 'error'
            then 'Failed request. URL: https://api.github.com/repos/o/r, Status code: 404, Status: Not Found, Access: x, IP: 0.0.0.0, Remaining: '
                 || regexp_extract(props, '([0-9]+)', 1)
            else 'Successful request. URL: https://api.github.com/repos/o/r, Remaining: ' || regexp_extract(props, '([0-9]+)', 1)
                 || ', Total: ' || cast(user_id as string) || ' ms' end as line
from events""",
    # Relational tables: ids are the numbers in the natural keys.
    "w_users": """select cast(substr(login, 2) as bigint) as id, login, name, email,
       case when type = 'User' then 'USR' else 'ORG' end as type, false as fake, false as deleted,
       location, created_at, created_at as updated_at
from v_users""",
    "w_projects": """select cast(substr(name, 2) as bigint) as id, 'https://api.github.com/repos/' || owner || '/' || name as url,
       cast(substr(owner, 2) as bigint) as owner_id, name,
       description, language, updated_at as created_at, cast(substr(parent, 2) as bigint) as forked_from, false as deleted,
       updated_at, cast(null as bigint) as forked_commit_id
from v_projects""",
    "w_commits": """select id, sha, author_id, author_id as committer_id, project_id, created_at from (
  select line_id * 8 + pos as id, sha, cast(substr(author, 2) as bigint) as author_id,
         cast(substr(project, 2) as bigint) as project_id, created_at,
         row_number() over (partition by sha order by created_at, project, author) as rn
  from v_commits) f where rn = 1""",
    "w_project_commits": """select distinct cast(substr(project, 2) as bigint) as project_id, line_id * 8 + pos as commit_id
from v_commits""",
    "w_prs": """select number as id, cast(substr(head, 2) as bigint) as head_repo_id, cast(substr(base, 2) as bigint) as base_repo_id,
       cast(null as bigint) as head_commit_id, cast(null as bigint) as base_commit_id, number as pullreq_id,
       false as intra_branch
from v_prs""",
    "w_pr_commits": "select distinct line_id as pull_request_id, line_id * 8 + pos as commit_id from v_commits",
    "w_history": """select id, pr as pull_request_id, created_at, action, cast(substr(actor, 2) as bigint) as actor_id
from v_pr_events""",
    "w_followers": """select cast(substr(follower, 2) as bigint) as follower_id, cast(substr(followed, 2) as bigint) as user_id,
       max(created_at) as created_at
from v_follows group by 1, 2""",
    "w_watchers": """select k as repo_id, actor_id as user_id, max(created_at) as created_at
from v_events where type = 'WatchEvent' and copy = 0 group by 1, 2""",
    # Issues of projects: the orders of a customer, one number per order.
    "w_issues": """select o_orderkey as id, o_custkey % 97 as repo_id, o_custkey as reporter_id,
       cast(null as bigint) as assignee_id, o_orderstatus = 'F' as pull_request,
       case when o_orderstatus = 'F' then o_orderkey end as pull_request_id, o_orderdate as created_at, o_orderkey as issue_id
from orders""",
    "w_labels": """select p_partkey as id, p_partkey as repo_id, p_brand as name from part""",
    "w_issue_labels": """select l.id as label_id, i.id as issue_id
from w_issues i join w_labels l on i.repo_id = l.repo_id""",
    # Topic listings of two snapshots; both know the same projects.
    "w_topics": """select cast(substr(source, 4) as bigint) as project_id, lang || cast(n_chars % 20 as string) as topic_name,
       n_chars % 2 as snapshot
from documents""",
    # Event feed with all handled types.
    "v_feed": """select id, created_at, actor_id, actor, k, 'u' || cast(k % 10 as string) as owner, 'r' || cast(k as string) as name,
       'u' || cast(k % 10 as string) || '/r' || cast(k as string) as repo, k % 25 as n_commits, 'u' || cast(k as string) as other,
       case kind || cast(k % 3 as string)
            when 'view0' then 'PushEvent' when 'view1' then 'PullRequestEvent' when 'view2' then 'PullRequestReviewCommentEvent'
            when 'click0' then 'WatchEvent' when 'click1' then 'ForkEvent' when 'click2' then 'MemberEvent'
            when 'signup0' then 'FollowEvent' when 'signup1' then 'CreateEvent' when 'signup2' then 'CommitCommentEvent'
            when 'purchase0' then 'IssuesEvent' when 'purchase1' then 'IssueCommentEvent' else 'GollumEvent' end as type,
       case k % 4 when 0 then 'opened' when 1 then 'closed' when 2 then 'merged' else 'reopened' end as action
from (select event_id as id, ts as created_at, user_id as actor_id, 'u' || cast(user_id as string) as actor,
             cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k, event_type as kind
      from events) e""",
    # The feed as a stored table, for jobs that read it many times.
    "w_feed": "select * from v_feed",
}

SPARK_VIEWS: dict[str, str] = {
    # The few columns of events are dealt to all tasks before texts are made of them, however few files they lie in.
    "v_dealt_events": "select /*+ REPARTITION(:tasks) */ event_id, user_id, ts, event_type, props from events",
    "v_feed": VIEWS["v_feed"].replace("from events) e", "from v_dealt_events) e"),
    "v_events": f"""select {_EVENT_COLUMNS}, value, copy
from events lateral view explode(array(0, 1)) c as copy
where copy = 0 or event_id % 7 = 0""",
    # A sha is made of line_id and pos, so rows of one sha are those of one such pair: the numbers are shuffled, and the text is made of what is left.
    "w_commits": f"""select l_orderkey * 8 + l_linenumber as id, {_SHA.format(pos='l_linenumber')} as sha, cast(l_suppkey as bigint) as author_id,
       cast(l_suppkey as bigint) as committer_id, cast(l_partkey as bigint) as project_id, l_shipdate as created_at
from (select *, row_number() over (partition by line_key, pos_key order by l_shipdate, cast(l_partkey as string), cast(l_suppkey as string)) as rn
      from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, case when l_linenumber is not null then l_orderkey end as line_key,
                   case when l_orderkey is not null then l_linenumber end as pos_key from lineitem) k) f where rn = 1""",
    "v_parents": f"""select {_SHA.format(pos='l_linenumber')} as sha, {_SHA.format(pos='(l_linenumber - 1)')} as parent_sha
from (select l_orderkey, l_linenumber, row_number() over (partition by l_orderkey, l_linenumber order by l_linenumber) as rn
      from lineitem a left semi join lineitem b on a.l_orderkey = b.l_orderkey and a.l_linenumber = b.l_linenumber + 1) f where rn = 1""",
    "w_project_commits": "select distinct cast(l_partkey as bigint) as project_id, l_orderkey * 8 + l_linenumber as commit_id from lineitem",
    "w_pr_commits": "select distinct l_orderkey as pull_request_id, l_orderkey * 8 + l_linenumber as commit_id from lineitem",
    # The feed as JSON documents, as the event API delivers them.
    "v_feed_json": """select id, to_json(named_struct(
  'id', cast(id as string), 'type', type, 'created_at', date_format(created_at, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
  'actor', named_struct('id', actor_id, 'login', actor, 'avatar_url', concat('https://avatars.example.org/', actor),
                        'gravatar_id', '', 'url', concat('https://api.github.com/users/', actor)),
  'repo', named_struct('name', repo),
  'payload', named_struct(
    'commits', case when type = 'PushEvent' and n_commits > 0 then transform(sequence(1L, n_commits), i -> named_struct(
        'sha', concat(md5(concat(id, '-', i)), substr(md5(cast(id as string)), 1, 8)),
        'url', concat('https://api.github.com/repos/', repo, '/commits/', md5(concat(id, '-', i)), substr(md5(cast(id as string)), 1, 8)))) end,
    'number', case when type = 'PullRequestEvent' then id end,
    'action', case when type = 'PullRequestEvent' then action end,
    'pull_request', case when type = 'PullRequestEvent' then named_struct(
        'number', id, 'created_at', date_format(created_at, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        'merged_at', case when action = 'merged' then date_format(created_at, "yyyy-MM-dd'T'HH:mm:ss'Z'") end,
        'closed_at', case when action in ('merged', 'closed') then date_format(created_at, "yyyy-MM-dd'T'HH:mm:ss'Z'") end,
        'user', named_struct('login', actor),
        'base', named_struct('sha', md5(cast(id as string)), 'repo', named_struct('name', name, 'full_name', repo, 'owner', named_struct('login', owner))),
        'head', named_struct('sha', md5(cast(k as string)), 'repo', case when k % 5 > 0 then named_struct(
            'name', case when k % 5 = 1 then name else concat('h', k) end, 'full_name', case when k % 5 = 1 then repo else concat(other, '/h', k) end,
            'owner', named_struct('login', case when k % 5 = 1 then owner else other end)) end)) end,
    'comment', case when type in ('CommitCommentEvent', 'IssueCommentEvent', 'PullRequestReviewCommentEvent') then named_struct(
        'id', id + 1000000, 'commit_id', case when type = 'CommitCommentEvent' then md5(cast(k as string)) end,
        '_links', case when type = 'PullRequestReviewCommentEvent' then named_struct('pull_request', named_struct(
            'href', concat('https://api.github.com/repos/', repo, '/pulls/', k))) end) end,
    'issue', case when type in ('IssuesEvent', 'IssueCommentEvent') then named_struct('number', k) end,
    'target', case when type = 'FollowEvent' then named_struct('login', other) end,
    'member', case when type = 'MemberEvent' then named_struct('login', other) end,
    'forkee', case when type = 'ForkEvent' then named_struct('id', id + 2000000, 'url', concat('https://api.github.com/repos/', actor, '/f', k),
        'full_name', case when k % 2 = 0 then concat(actor, '/f', k) end) end,
    'ref_type', case when type = 'CreateEvent' then case when k % 2 = 0 then 'repository' else 'branch' end end))) as value
from v_feed""",
}

_NAME = re.compile(r"\b(?:[vw]_[a-z_]+|" + "|".join(BASE_TABLES) + r")\b")


def is_stored(name: str) -> bool:
    """Relational tables and staged commits are written once; other views are computed in place."""
    return name.startswith("w_") or name in ("v_commits", "v_parents")


def _definition(name: str, spark_dir: str | None, place: Callable[[str], str] | None = None) -> str | None:
    if place is not None and is_stored(name) and name in VIEWS:
        return f"select * from parquet.`{place(name)}`"
    if spark_dir is not None:
        if name in SPARK_VIEWS:
            return SPARK_VIEWS[name]
        if name in BASE_TABLES:
            return f"select * from parquet.`{spark_dir}/{name}.parquet`"
    return VIEWS.get(name)


def expand(sql: str, spark_dir: str | None = None, place: Callable[[str], str] | None = None) -> str:
    """The statement with the views it uses as common table expressions.

    With `spark_dir` base tables are read from that folder; without it they are
    expected to be registered, as in DuckDB. `place` gives the folder of a stored view.
    """
    ordered: list[str] = []
    bodies: dict[str, str] = {}

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in bodies:
                continue
            body = _definition(name, spark_dir, place)
            if body is None:
                continue
            bodies[name] = body
            if name not in BASE_TABLES and not (place and is_stored(name)):
                visit(body)
            ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    parts = ",\n".join(f"{name} as (\n{bodies[name]}\n)" for name in ordered)
    recursive = re.match(r"\s*with\s+recursive\s", sql, re.IGNORECASE)
    plain = re.match(r"\s*with\s", sql, re.IGNORECASE)
    if recursive:
        return f"with recursive {parts},\n{sql[recursive.end():]}"
    if plain:
        return f"with {parts},\n{sql[plain.end():]}"
    return f"with {parts}\n{sql}"


_written: dict[tuple[str, str, str], str] = {}


class Lake:
    """The driver tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = prepare(spark)
        for key, value in PACKED_CONF.items():
            self.spark.conf.set(key, value)
        self.folder = folder.rstrip("/")

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(expand(text, self.folder, self.place).replace(":tasks", str(self.spark.sparkContext.defaultParallelism)))

    def made(self, text: str) -> DataFrame:
        """As `sql`, with stored views computed in place: for a view that is read once, in part or not at all."""
        return self.spark.sql(expand(text, self.folder).replace(":tasks", str(self.spark.sparkContext.defaultParallelism)))

    def feed_files(self) -> str:
        """Folder with the event feed as packed JSON lines, one file per task, written once per session and table folder."""
        key = (self.spark.sparkContext.applicationId, self.folder, "feed")
        if key not in _written:
            path = new_path(self.spark, "feed")
            self.sql("select value from v_feed_json").write.text(path, compression="gzip")
            _written[key] = path
        return _written[key]

    def place(self, name: str) -> str:
        """Folder of a stored view, written once per session and table folder: builders work on stored tables."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _written:
            path = new_path(self.spark, name)
            self.sql(SPARK_VIEWS.get(name, VIEWS[name])).write.parquet(path, compression="zstd")
            _written[key] = path
        return _written[key]

    def staged(self, name: str, text: str) -> DataFrame:
        """A staged collection as stored records, made once per session and table folder: jobs read it many times."""
        key = (self.spark.sparkContext.applicationId, self.folder, f"staged {name}: {text}")
        found = self.sql(text)
        if key not in _written:
            path = new_path(self.spark, name)
            found.write.parquet(path, compression="zstd")
            _written[key] = path
        return self.spark.read.schema(found.schema).parquet(_written[key])

    def feed(self) -> DataFrame:
        """The event feed as the handlers take it."""
        return read_events(self.spark, self.feed_files())

    def __getitem__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if is_stored(name):
            return self.spark.read.parquet(self.place(name))
        return self.sql(f"select * from {name}")
