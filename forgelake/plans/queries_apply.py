"""Events applied to the tables, in batch, as a stream and as a replay; refreshes and synchronisation. All compare rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.functions.scalars import location_key
from forgelake.operators.changes import union_all
from forgelake.plans.catalog import query, secs
from forgelake.plans.natural import natural_rows
from forgelake.plans.queries_builders import NOW_SECS, now
from forgelake.plans.queries_scalars import LOCATION_SQL
from forgelake.plans.refresh import apply_events, refresh_repos, reported_refresh
from forgelake.plans.replay import EventWindow, next_marks, pending, replay_events
from forgelake.plans.sync_job import sync_repos, sync_users
from forgelake.plans.views import Lake
from forgelake.session import cut_lineage, new_path, together
from forgelake.sources.entities import json_reader
from forgelake.sources.tables import TableSet, empty_tables
from forgelake.streaming import jobs

# ---- staged records ------------------------------------------------------

TEXT = "cast(null as string)"
# Commits that the feed's events point to; the last part is what large pushes hide.
FEED_COMMITS = """select md5(cast(k as string)) as sha, repo, owner, min(id) as seq, min(created_at) as created_at from v_feed where type = 'CommitCommentEvent' group by 1, repo, owner
union all select md5(cast(id as string) || '-1') || substr(md5(cast(id as string)), 1, 8), repo, owner, id, created_at from v_feed where type = 'PushEvent' and n_commits > 0
union all select md5('p' || cast(id as string) || '-' || cast(i as string)) as sha, repo, owner, id, created_at from (select *, {one_to}(k % 3) as i from v_feed where type = 'PullRequestEvent' and k % 3 > 0)
union all select md5(cast(id as string) || '-' || cast(i as string)) || substr(md5(cast(id as string)), 1, 8), repo, owner, id, created_at from (select *, n_commits + {one_to}(2) as i from v_feed where type = 'PushEvent' and n_commits >= 20)"""
SPARK_COMMITS = FEED_COMMITS.replace("v_feed", "w_feed").replace("{one_to}(k % 3)", "explode(sequence(1L, k % 3))").replace("n_commits + {one_to}(2)", "explode(array(n_commits + 1, n_commits + 2))")
DUCK_COMMITS = FEED_COMMITS.replace("{one_to}(k % 3)", "unnest(range(1, k % 3 + 1))").replace("{one_to}(2)", "unnest([1, 2])").replace("as string)", "as varchar)")


def feed_raw(lake: Lake) -> dict[str, DataFrame]:
    """Staged records for the feed: accounts, repositories, and what events and refreshes point to.

    Each collection is stored, as a forge's raw records are: stages and batches read it again and again.
    """
    person = "named_struct('login', owner) as user"
    repo = f"named_struct('sha', {TEXT}, 'repo', named_struct('name', name, 'full_name', repo, 'owner', named_struct('login', owner)))"
    mail = f"named_struct('name', owner, 'email', {TEXT}, 'date', cast(created_at as string))"
    texts = {
        "commits": f"""select sha, 'https://api.github.com/repos/' || repo || '/commits/' || sha as url, named_struct('login', owner) as author, named_struct('login', owner) as committer,
            named_struct('author', {mail}, 'committer', {mail}) as commit, cast(array() as array<struct<sha:string,url:string>>) as parents, seq from ({SPARK_COMMITS}) c""",
        "commit_lists": """select owner, name as repo, -id * 100 + case when i <= n_commits then n_commits - i else i end as pos,
            md5(concat(id, '-', i)) || substr(md5(cast(id as string)), 1, 8) as sha from (select *, explode(sequence(1L, n_commits + 2)) as i from w_feed where type = 'PushEvent' and n_commits >= 20)""",
        "commit_comments": f"""select id + 1000000 as id, md5(cast(k as string)) as commit_id, {person}, 'text' as body, 1 as line, 1 as position, cast(created_at as string) as created_at
            from w_feed where type = 'CommitCommentEvent'""",
        "pull_requests": f"""select owner, name as repo, k as number, cast(min(created_at) as string) as created_at, {TEXT} as merged_at, {TEXT} as closed_at, named_struct('login', {TEXT}) as user,
            named_struct('login', {TEXT}) as merged_by, {repo} as head, {repo} as base from w_feed where type = 'PullRequestReviewCommentEvent' group by owner, name, repo, k""",
        "pull_commit_lists": """select owner, name as repo, id as number, md5(concat('p', id, '-', i)) as sha, 'https://api.github.com/repos/' || repo || '/commits/x' as url
            from (select *, explode(sequence(1L, k % 3)) as i from w_feed where type = 'PullRequestEvent' and k % 3 > 0)""",
        "pull_request_comments": f"""select cast(id + 1000000 as string) as id, owner, name as repo, cast(k as string) as pullreq_id, {TEXT} as issue_id, {person}, 'text' as body, 1 as original_position,
            {TEXT} as original_commit_id, cast(created_at as string) as created_at from w_feed where type = 'PullRequestReviewCommentEvent'""",
        "issues": f"""select owner, name as repo, k as number, cast(min(created_at) as string) as created_at, {person}, named_struct('login', {TEXT}) as assignee,
            named_struct('patch_url', {TEXT}) as pull_request, array(named_struct('name', 'bug')) as labels from w_feed where type in ('IssuesEvent', 'IssueCommentEvent') group by owner, name, k""",
        "issue_events": """select id + 3000000 as id, owner, name as repo, k as issue_id, case id % 4 when 0 then 'assigned' when 1 then 'closed' when 2 then 'referenced' else 'labeled' end as event,
            md5(cast(k as string)) as commit_id, named_struct('login', actor) as actor, cast(created_at as string) as created_at from w_feed where type = 'IssuesEvent'""",
        "issue_comments": f"""select id + 1000000 as id, owner, name as repo, k as issue_id, {person}, cast(created_at as string) as created_at from w_feed where type = 'IssueCommentEvent'""",
        "repo_labels": "select distinct owner, name as repo, 'bug' as name from w_feed union all select distinct owner, name, 'l' || cast(k % 5 as string) from w_feed",
        "users": "select login, name, cast(null as string) as company, email, location, type, cast(created_at as string) as created_at from v_users",
        "org_members": "select org, login from (select login as org, 'u' || cast(cast(substr(login, 2) as bigint) + 1 as string) as login from v_users) m where cast(substr(org, 2) as bigint) % 3 < 2",
        "repos": """select named_struct('login', owner) as owner, name, 'url' as url, 'd' as description, 'l' as language, cast(min(created_at) as string) as created_at,
            named_struct('name', cast(null as string), 'owner', named_struct('login', cast(null as string))) as parent from w_feed group by owner, name""",
        "topics": "select owner, name as repo, array('x', 't' || cast(min(k) % 5 as string)) as names from w_feed group by owner, name",
        "languages": "select owner, name as repo, map('Ruby', cast(min(k) * 10 as string)) as languages from w_feed group by owner, name",
        "watchers": "select distinct owner, name as repo, 'u' || cast(k + 7 as string) as login, '2020-01-01 00:00:00' as created_at from w_feed",
        "forks": "select distinct owner, name as repo, k as id, cast(null as string) as url, 'u' || cast(k + 3 as string) || '/g' || cast(k as string) as full_name from w_feed",
    }
    lake.place("w_feed")  # what most of them are made of
    return together(lake.spark, {name: lambda name=name, text=text: lake.staged(name, text) for name, text in texts.items()})


# ---- the same in SQL -----------------------------------------------------

EPOCH = "cast(cast(floor(epoch({})) as bigint) as varchar)".format


def rows_sql(events: str = "select * from v_feed", dates: bool = True) -> str:
    """Natural rows of all tables after some events on empty tables.

    Without `dates`, what depends on the order of stream batches is left out.
    """
    dated = lambda c: f" || '|' || {EPOCH(c)}" if dates else ""
    return f"""with recursive f as ({events}), created as (select distinct owner, name, repo, k from f where type = 'CreateEvent' and k % 2 = 0),
 rc as ({DUCK_COMMITS}),
 r_prs as (select repo, owner, k as number, min(created_at) as created_at from v_feed where type = 'PullRequestReviewCommentEvent' group by all),
 r_issues as (select repo, owner, k as number, min(created_at) as created_at from v_feed where type in ('IssuesEvent', 'IssueCommentEvent') group by all),
 pr_keys as (select repo, id as number from f where type = 'PullRequestEvent' union select repo, number from r_prs where repo in (select repo from created)),
 prs as (select repo, id as number, case when k % 5 = 1 then repo end as head, md5(cast(id as varchar)) as base_sha, case when k % 5 = 1 then md5(cast(k as varchar)) end as head_sha, k % 5 = 1 as intra, created_at from f where type = 'PullRequestEvent'
  union all select repo, number, repo, null, null, true, created_at from r_prs where repo in (select repo from created) or (repo, number) in (select (repo, k) from f where type = 'PullRequestReviewCommentEvent')),
 issue_first as (select repo, k as number, min(id) as id from f where type in ('IssuesEvent', 'IssueCommentEvent') group by all),
 pr_first as (select repo, number, min(id) as id from (select repo, id as number, id from f where type = 'PullRequestEvent' union all select repo, k, id from f where type = 'PullRequestReviewCommentEvent') x group by all),
 own_issues as (select r.* from r_issues r where repo in (select repo from created) or (repo, number) in (select (repo, number) from issue_first)),
 assigned as (select repo, k as number, arg_max(actor, (created_at, id)) as assignee from v_feed where type = 'IssuesEvent' and id % 4 = 0
   and (repo in (select repo from created) or (repo, k) in (select (repo, k) from f where type = 'IssuesEvent')) group by all),
 all_issues as (select coalesce(i.repo, p.repo) as repo, coalesce(i.number, p.number) as number, p.repo is not null as is_pr,
   case when i.repo is not null and (p.repo is null or (a.id is not null and (b.id is null or a.id < b.id))) then i.owner end as reporter,
   case when i.repo is not null and (p.repo is null or (a.id is not null and (b.id is null or a.id < b.id))) then i.created_at else p.created_at end as created_at
   from own_issues i full outer join (select repo, number, min(created_at) as created_at from prs group by all) p on p.repo = i.repo and p.number = i.number
   left join issue_first a on a.repo = i.repo and a.number = i.number left join pr_first b on b.repo = p.repo and b.number = p.number),
 lists as (select repo, id as number, md5('p' || cast(id as varchar) || '-' || cast(i as varchar)) as sha from (select *, unnest(range(1, k % 3 + 1)) as i from v_feed where type = 'PullRequestEvent')
   where (repo, id) in (select (repo, number) from pr_keys)),
 shas as (select md5(cast(k as varchar)) as sha from f where type = 'CommitCommentEvent' union select base_sha from prs union select head_sha from prs union select sha from lists
   union select md5(cast(id as varchar) || '-1') || substr(md5(cast(id as varchar)), 1, 8) from f where type = 'PushEvent' and n_commits > 0
   union select md5(cast(id as varchar) || '-' || cast(n_commits + i as varchar)) || substr(md5(cast(id as varchar)), 1, 8) from (select *, unnest([1, 2]) as i from f where type = 'PushEvent' and n_commits >= 20) o),
 places as (select distinct repo from f where type in ('WatchEvent', 'PullRequestEvent', 'ForkEvent', 'PullRequestReviewCommentEvent', 'IssuesEvent', 'IssueCommentEvent', 'CommitCommentEvent') or (type = 'PushEvent' and n_commits > 0) or (type = 'CreateEvent' and k % 2 = 0) or (type = 'MemberEvent' and actor_id = k % 10)),
 stored as (select sha, case when repo in (select repo from places) then repo end as repo, owner, created_at from (select *, row_number() over (partition by sha order by seq) as rn from rc where sha in (select sha from shas) or repo in (select repo from created)) x where rn = 1),
 comments as (select repo, k as number, id + 1000000 as comment_id, owner, created_at from v_feed v where type = 'IssueCommentEvent'
   and (id in (select id from f) or (repo, k) in (select (repo, k) from f where type = 'IssuesEvent') or (repo, k) in (select (repo, number) from pr_keys) or repo in (select repo from created))),
 reviews as (select repo, k as number, id + 1000000 as comment_id, owner, created_at from v_feed v where type = 'PullRequestReviewCommentEvent' and (id in (select id from f) or (repo, k) in (select (repo, number) from pr_keys))),
 named as (select owner as login from f where type in ('WatchEvent', 'PullRequestEvent', 'ForkEvent', 'PullRequestReviewCommentEvent', 'IssuesEvent', 'IssueCommentEvent', 'CommitCommentEvent') or (type = 'PushEvent' and n_commits > 0) or (type = 'CreateEvent' and k % 2 = 0)
   union select actor from f where type in ('WatchEvent', 'FollowEvent', 'MemberEvent', 'PullRequestEvent', 'ForkEvent') union select other from f where type in ('FollowEvent', 'MemberEvent') or (type = 'PullRequestEvent' and k % 5 > 1)
   union select actor from v_feed where type = 'IssuesEvent' and (repo in (select repo from created) or (repo, k) in (select (repo, k) from f where type = 'IssuesEvent'))
   union select 'u' || cast(k + 7 as varchar) from created union select 'u' || cast(k + 3 as varchar) from created),
 accounts as (select v.login, v.type from v_users v where login in (select login from named)
   union select m.login, m.type from accounts a join v_users m on m.login = 'u' || cast(cast(substr(a.login, 2) as bigint) + 1 as varchar) where a.type is distinct from 'User' and cast(substr(a.login, 2) as bigint) % 3 < 2),
 stars as (select repo, actor as login, created_at from f where type = 'WatchEvent' union all select repo, 'u' || cast(k + 7 as varchar), timestamp '2020-01-01 00:00:00' from created)
select 'users' as name, login || '|' || case when type = 'User' then 'USR' else 'ORG' end as row from accounts
union all select 'followers', actor || '|' || other{dated('max(created_at)')} from f where type = 'FollowEvent' group by actor, other
union all select 'organization_members', a.login || '|' || m.login from accounts a join v_users m on m.login = 'u' || cast(cast(substr(a.login, 2) as bigint) + 1 as varchar) where a.type is distinct from 'User' and cast(substr(a.login, 2) as bigint) % 3 < 2
union all select 'projects', owner || '|' || name || '|' || coalesce(max(parent), '-') from (
   select owner, name, null as parent from f where type in ('WatchEvent', 'PullRequestEvent', 'ForkEvent', 'PullRequestReviewCommentEvent', 'IssuesEvent', 'IssueCommentEvent', 'CommitCommentEvent') or (type = 'PushEvent' and n_commits > 0) or (type = 'CreateEvent' and k % 2 = 0) or (type = 'MemberEvent' and actor_id = k % 10)
   union all select actor, 'f' || cast(k as varchar), repo from f where type = 'ForkEvent' union all select 'u' || cast(k + 3 as varchar), 'g' || cast(k as varchar), repo from created) p group by owner, name
union all select 'project_members', repo || '|' || other{dated('min(created_at)')} from f where type = 'MemberEvent' and actor_id = k % 10 group by repo, other
union all select 'commits', sha || '|' || owner || '|' || owner || '|' || coalesce(repo, '-') || '|' || {EPOCH('created_at')} from stored
union all select 'project_commits', repo || '|' || sha from stored where repo is not null
union all select 'commit_comments', md5(cast(k as varchar)) || '|' || owner || '|text|' || cast(id + 1000000 as varchar) || '|' || {EPOCH('created_at')} from f where type = 'CommitCommentEvent'
union all select 'pull_requests', p.repo || '|' || cast(number as varchar) || '|' || coalesce(head, '-') || '|' || coalesce(b.sha, '-') || '|' || coalesce(h.sha, '-') || '|' || cast(intra as varchar) from prs p left join stored b on b.sha = p.base_sha left join stored h on h.sha = p.head_sha
union all select 'pull_request_comments', repo || '#' || cast(number as varchar) || '|' || owner || '|' || cast(comment_id as varchar) || '|text|' || {EPOCH('created_at')} from reviews
union all select 'pull_request_history', repo || '#' || cast(id as varchar) || '|' || x || '|' || actor || '|' || {EPOCH('created_at')} from (select *, unnest(case action when 'merged' then ['opened', 'closed', 'merged'] when 'opened' then ['opened'] else ['opened', action] end) as x from f where type = 'PullRequestEvent') h
union all select 'pull_request_commits', repo || '#' || cast(number as varchar) || '|' || sha from lists
union all select 'watchers', repo || '|' || login || '|' || {EPOCH('max(created_at)')} from stars group by repo, login
union all select 'repo_labels', repo || '|bug' from (select repo from own_issues union select repo from created) l
union all select 'repo_labels', repo || '|l' || cast(cast(substr(repo, strpos(repo, '/') + 2) as bigint) % 5 as varchar) from (select repo from own_issues union select repo from created) l
union all select 'issues', i.repo || '|' || cast(i.number as varchar) || '|' || cast(is_pr as varchar){" || '|' || coalesce(reporter, '-')" if dates else ""} || '|' || coalesce(assignee, '-') || '|' || case when is_pr then i.repo || '#' || cast(i.number as varchar) else '-' end{dated('i.created_at')}
   from all_issues i left join assigned a on a.repo = i.repo and a.number = i.number
union all select 'issue_labels', repo || ':bug|' || repo || '!' || cast(number as varchar) from own_issues
union all select 'issue_comments', repo || '!' || cast(number as varchar) || '|' || owner || '|' || cast(comment_id as varchar) || '|' || {EPOCH('created_at')} from comments
union all select 'issue_events', cast(id + 3000000 as varchar) || '|' || repo || '!' || cast(k as varchar) || '|' || actor || '|' || case id % 4 when 0 then 'assigned' when 1 then 'closed' when 2 then 'referenced' else 'labeled' end || '|'
   || case when id % 4 in (1, 2) then md5(cast(k as varchar)) else '-' end || '|' || {EPOCH('created_at')} from v_feed where type = 'IssuesEvent' and (repo in (select repo from created) or (repo, k) in (select (repo, k) from f where type = 'IssuesEvent'))
union all select 'project_languages', repo || '|ruby|' || cast(k * 10 as varchar) from created
union all select 'project_topics', repo || '|x|false' from created
union all select 'project_topics', repo || '|t' || cast(k % 5 as varchar) || '|false' from created"""


# Where the order of batches counts: an undated first sighting, or who comes first of an issue and its pull request.
BY_BATCH = {"followers": ["created_at"], "project_members": ["created_at"], "issues": ["reporter_id", "created_at"]}


@query("H1-H11 E1 E2 E8 E9 E10 E11 E12 E13 E15 E16 E17 E18 E19 E20 E22 E23 E24 E27", rows_sql())
def applied_events(lake: Lake) -> DataFrame:
    """All tables, row by row, after the whole feed in one batch on empty tables."""
    return natural_rows(apply_events(empty_tables(lake.spark), lake.feed(), feed_raw(lake), now()))


@query("T5 T4 T7 S11", f"select distinct name, row from ({rows_sql(dates=False)}) r")
def stream_tables(lake: Lake) -> DataFrame:
    """All tables, row by row, maintained from an event stream: each batch gives a version."""
    store = TableSet(lake.spark, new_path(lake.spark, "tables"))
    raw = feed_raw(lake)
    stream = json_reader(lake.spark.readStream.option("maxFilesPerTrigger", 4), "events").json(lake.feed_files())
    jobs.run_to_end(stream, jobs.tables_sink(store, lambda tables, events: apply_events(tables, events, raw, now()), new_path(lake.spark, "rejects")), new_path(lake.spark, "checkpoint"))
    return natural_rows(store.read_all(), without=BY_BATCH).distinct()


# ---- replay --------------------------------------------------------------

REPLAYED = "select * from v_feed where k % 2 = 1 and id > 49 and id < (select max(id) - 49 from v_feed) and type not in ('CreateEvent', 'FollowEvent')"


@query("E25 P5 S3 S10", rows_sql(REPLAYED))
def replayed_events(lake: Lake) -> DataFrame:
    """Stored events of listed repositories inside a window, without two types, in two overlapping calls."""
    raw, events = feed_raw(lake), lake.feed()
    listed = lake.sql("select distinct owner, name as repo from v_feed where k % 2 = 1")
    last, middle = lake.sql("select max(id) - 49, cast(percentile_approx(id, 0.5) as bigint) from v_feed").first()
    tables = empty_tables(lake.spark)
    for window in (EventWindow(49, middle, ("CreateEvent", "FollowEvent")), EventWindow(49, last, ("CreateEvent", "FollowEvent"))):
        tables = replay_events(tables, events, raw, listed, now(), window)
        tables = {n: cut_lineage(t, n) for n, t in tables.items()}
    return natural_rows(tables)


@query("E25 P5", f"""select owner, name as repo, max(id) as event_id from v_feed where k % 2 = 1 and id > 49 and id < (select max(id) - 49 from v_feed) group by all""")
def replay_marks(lake: Lake) -> DataFrame:
    """How far each repository's events are dealt with after the replay of a window."""
    last = lake.sql("select max(id) - 49 from v_feed").first()[0]
    listed = lake.sql("select distinct owner, name as repo from v_feed where k % 2 = 1")
    marks = empty_tables(lake.spark)["replay_marks"]
    return next_marks(marks, pending(lake.feed(), listed, marks, EventWindow(49, last, ("CreateEvent",))))


# ---- refresh -------------------------------------------------------------

# The refresh of a repository says what its creation does.
CREATED = """select min(id) as id, min(created_at) as created_at, min(actor_id) as actor_id, min(actor) as actor, k, owner, name, repo, min(n_commits) as n_commits, min(other) as other, 'CreateEvent' as type, 'opened' as action
from v_feed where k % 2 = 0 group by k, owner, name, repo"""


@query("E25 E2 E7 E13 E15 E19 E22", rows_sql(CREATED))
def refreshed_repos(lake: Lake) -> DataFrame:
    """All refresh stages for a work list of repositories at once, on empty tables: all rows."""
    worklist = lake.sql("select distinct owner, name as repo from v_feed where k % 2 = 0")
    tables = refresh_repos(empty_tables(lake.spark), feed_raw(lake), worklist, now())
    return natural_rows(tables).unionByName(
        tables["projects"].filter(secs("updated_at") != NOW_SECS).select(F.lit("not refreshed").alias("name"), F.col("name").alias("row"))
    )


STAGE_ROWS = f"""with rc as ({DUCK_COMMITS}), e as (select *, owner as o, name as r from v_feed),
 lists as (select o, r from (select *, unnest(range(1, k % 3 + 1)) as i from e where type = 'PullRequestEvent') x),
 prs as (select o, r from e where type = 'PullRequestReviewCommentEvent' group by o, r), reviews as (select o, r from e where type = 'PullRequestReviewCommentEvent'),
 issues as (select o, r from e where type in ('IssuesEvent', 'IssueCommentEvent') group by o, r), issue_events as (select o, r from e where type = 'IssuesEvent'),
 comments as (select o, r from e where type = 'IssueCommentEvent'), labels as (select o, r from e group by o, r, unnest([1, 2])), once as (select o, r from e group by o, r),
 staged as (select 'commits' as stage, owner as o, split_part(repo, '/', 2) as r from rc union all select 'topics', o, r from once union all select 'languages', o, r from once
  union all select 'pull_requests', o, r from prs union all select 'pull_requests', o, r from lists union all select 'pull_requests', o, r from reviews union all select 'pull_requests', o, r from comments
  union all select 'issues', o, r from issues union all select 'issues', o, r from issue_events union all select 'issues', o, r from comments union all select 'issues', o, r from labels
  union all select 'watchers', o, r from once union all select 'labels', o, r from labels union all select 'labels', o, r from issues union all select 'forks', o, r from once)
select o.o as owner, o.r as repo, s.stage, 'done' as outcome, (select count(*) from staged x where x.o = o.o and x.r = o.r and x.stage = s.stage) as staged_rows
from once o cross join (select distinct stage from staged) s
union all select 'nobody', 'nothing', null, 'unknown', 0"""


@query("E25", STAGE_ROWS)
def refresh_report(lake: Lake) -> DataFrame:
    """One row per repository and stage of a refresh; a repository that nobody knows is named too."""
    worklist = lake.sql("select distinct owner, name as repo from v_feed union all select 'nobody', 'nothing'")
    _, report = reported_refresh(empty_tables(lake.spark), feed_raw(lake), worklist, now())
    return report.select("owner", "repo", "stage", "outcome", "staged_rows")


# ---- synchronisation -----------------------------------------------------

# Chains of a project and three forks; ids are part keys + 4, commits those of the part's lines.
CHAIN_TABLE = """select project_id + 4 as project_id, id as commit_id from w_commits where not (project_id % 8 = 0 and id % 5 = 0)
union select project_id + 5, id from w_commits where project_id % 4 < 3 and id % 3 = 0"""
CHAIN_SQL = f"""with e as (select project_id + 4 as p, arg_min(id, (created_at, id)) as id, min(created_at) as ts from w_commits group by 1),
 t0 as (select project_id as p, commit_id as c from ({CHAIN_TABLE}) t), made as (select id as c, created_at from w_commits),
 cur0 as (select p, c from t0 where (p - 4) % 8 = 0 union select project_id + 4, id from w_commits where project_id % 8 = 0),
 own as (select w.project_id + 4 as p, w.id as c from w_commits w join e on e.p = w.project_id + 4 where w.id <> e.id and w.project_id % 8 in (1, 6)),
 w1 as (select p, c from own where (p - 4) % 8 = 1 union select e.p, c.c from e join cur0 c on c.p = e.p - 1 join made on made.c = c.c where (e.p - 4) % 8 = 1 and made.created_at < e.ts),
 w6 as (select p, c from own where (p - 4) % 8 = 6 union select e.p, c.c from e join t0 c on c.p = e.p - 1 join made on made.c = c.c where (e.p - 4) % 8 = 6 and made.created_at < e.ts),
 d12 as (select p, c, true as plus from (select * from w1 except select * from t0) x union all select p, c, false from (select * from t0 where (p - 4) % 8 = 1 except select * from w1) y
   union all select p, c, true from (select * from w6 except select * from t0) x union all select p, c, false from (select * from t0 where (p - 4) % 8 = 6 except select * from w6) y),
 cur2 as (select p, c from t0 where (p - 4) % 8 = 2 and (p, c) not in (select (e.p, d.c) from e join d12 d on d.p = e.p - 1 and not d.plus join made on made.c = d.c where made.created_at < e.ts)
   union select e.p, d.c from e join d12 d on d.p = e.p - 1 and d.plus join made on made.c = d.c where made.created_at < e.ts and (e.p - 4) % 8 = 2),
 d23 as (select p, c, true as plus from (select * from cur2 except select * from t0) x union all select p, c, false from (select * from t0 where (p - 4) % 8 = 2 except select * from cur2) y
   union all select * from d12 where (p - 4) % 8 = 6),
 cur3 as (select p, c from t0 where (p - 4) % 8 in (3, 7) and (p, c) not in (select (e.p, d.c) from e join d23 d on d.p = e.p - 1 and not d.plus join made on made.c = d.c where made.created_at < e.ts)
   union select e.p, d.c from e join d23 d on d.p = e.p - 1 and d.plus join made on made.c = d.c where made.created_at < e.ts and (e.p - 4) % 8 in (3, 7)),
 rows as (select * from cur0 union all select * from w1 union all select * from w6 union all select * from cur2 union all select * from cur3 union all select * from t0 where (p - 4) % 8 in (4, 5))
select 'project_commits' as name, p as project_id, cast(c as varchar) as value from rows
union all select 'project_languages', p_partkey + 4, 'go|' || cast(p_partkey * 3 as varchar) from part where p_partkey % 8 in (0, 1, 6)
union all select 'project_topics', p_partkey + 4, 's' || cast(p_partkey % 3 as varchar) from part where p_partkey % 8 in (0, 1, 6)
union all select 'deleted', p_partkey + 4, '' from part where p_partkey % 8 = 7
union all select 'fork commit', p_partkey + 4, cast(e.id as varchar) from part join e on e.p = p_partkey + 4 where p_partkey % 4 > 0"""


@query("X1 E5 E7 E20 E23 D8 J13 J15", CHAIN_SQL)
def synced_repos(lake: Lake) -> DataFrame:
    """A synchronisation of chains of three forks: commits, languages and topics that follow, level by level."""
    place = "'u' || cast(p_partkey % 150 as string) as owner, 'r' || cast(p_partkey as string) as name"
    repo = "'u' || cast(project_id % 150 as string) as owner, 'r' || cast(project_id as string) as repo"
    nothing = "cast(null as string)"
    first = lake.sql("select project_id + 4 as id, min_by(id, struct(created_at, id)) as forked_commit_id, min_by(sha, struct(created_at, id)) as sha from w_commits group by 1")
    projects = lake.sql(f"""select p_partkey + 4 as id, {place}, p_partkey % 150 as owner_id, case when p_partkey % 4 > 0 then p_partkey + 3 end as forked_from, 'd' as description, 'l' as language, 'url' as url,
        false as deleted, timestamp '2000-01-01 00:00:00' as created_at, timestamp '2000-01-01 00:00:00' as updated_at from part""")
    # Forks that are not answered know their fork commit; the others learn it from their branch diffs.
    stored = projects.join(first.select("id", "forked_commit_id"), "id", "left").withColumn("forked_commit_id", F.expr("case when forked_from is not null and (id - 4) % 8 not in (1, 6) then forked_commit_id end"))
    listed = lake.sql(f"select {place}, p_partkey from part where p_partkey % 8 in (0, 1, 4, 6, 7)")
    feed = lake.sql(f"""select {place}, p_partkey % 8 = 4 as is_error, 'new' as url, 'd' as description, 'l' as language, timestamp '2000-01-01 00:00:00' as created_at,
        case when p_partkey % 4 > 0 then 'u' || cast((p_partkey - 1) % 150 as string) end as parent_owner, case when p_partkey % 4 > 0 then 'r' || cast(p_partkey - 1 as string) end as parent_name
        from part where p_partkey % 8 in (0, 1, 4, 6)""")
    points = listed.filter("p_partkey % 8 in (1, 6)").join(first.withColumn("p_partkey", F.col("id") - 4), "p_partkey").withColumnRenamed("name", "repo")
    diffs = points.selectExpr(
        "owner", "repo", "case when p_partkey % 8 = 6 then 1 else 0 end as ahead_by", "0 as behind_by", "named_struct('sha', case when p_partkey % 8 = 1 then sha end) as merge_base_commit",
        "case when p_partkey % 8 = 6 then array(named_struct('sha', 'x', 'commit', named_struct('author', named_struct('date', '2020-01-01')), 'parents', array(named_struct('sha', sha)))) end as commits",
    )
    person, mail = f"named_struct('login', {nothing})", f"named_struct('name', {nothing}, 'email', {nothing}, 'date', cast(created_at as string))"
    raw = {
        "users": lake.sql("select login, name, cast(null as string) as company, email, location, type, cast(created_at as string) as created_at from v_users"),
        "repos": lake.sql(f"select named_struct('login', owner) as owner, name, 'url' as url, 'd' as description, 'l' as language, {nothing} as created_at, cast(null as struct<name:string,owner:struct<login:string>>) as parent from (select {place} from part) p"),
        "commits": lake.sql(f"""select sha, 'https://api.github.com/repos/u' || cast(project_id % 150 as string) || '/r' || cast(project_id as string) || '/commits/' || sha as url, {person} as author, {person} as committer,
            named_struct('author', {mail}, 'committer', {mail}) as commit, cast(array() as array<struct<sha:string,url:string>>) as parents, id as seq from w_commits where project_id % 8 = 0 and id % 5 = 0"""),
        "branch_diffs": diffs,
        "commit_pages": lake.sql(f"select {repo}, 1 as page, cast(row_number() over (partition by project_id order by created_at desc, id desc) as int) as pos, sha from w_commits where project_id % 8 in (1, 6)"),
        "languages": lake.sql(f"select owner, name as repo, map('Go', cast(p_partkey * 3 as string)) as languages from (select {place}, p_partkey from part) p"),
        "topics": lake.sql(f"select owner, name as repo, array('s' || cast(p_partkey % 3 as string)) as names from (select {place}, p_partkey from part) p"),
    }
    tables = {**empty_tables(lake.spark), "users": lake["w_users"], "projects": stored.drop("owner"), "commits": lake["w_commits"], "project_commits": lake.sql(CHAIN_TABLE)}
    result = sync_repos(tables, listed, stored.select("owner", "name", "description").limit(0), feed, raw, now(), "all").tables
    told = [
        result["project_commits"].select("project_id", F.lit("project_commits").alias("name"), F.col("commit_id").cast("string").alias("value")),
        result["project_languages"].select("project_id", F.lit("project_languages").alias("name"), F.concat_ws("|", "language", F.col("bytes").cast("string")).alias("value")),
        result["project_topics"].select("project_id", F.lit("project_topics").alias("name"), F.col("topic_name").alias("value")),
        result["projects"].filter("deleted").select(F.col("id").alias("project_id"), F.lit("deleted").alias("name"), F.lit("").alias("value")),
        result["projects"].filter("forked_commit_id is not null").select(F.col("id").alias("project_id"), F.lit("fork commit").alias("name"), F.col("forked_commit_id").cast("string").alias("value")),
    ]
    return union_all(told)


USER_LIST = "select distinct 'u' || cast(o_custkey as string) as login from orders where o_orderstatus = 'F' and o_totalprice > 450000"
USER_EDGES = """select 'u' || cast(o_custkey as string) as login, 'u' || cast(o_orderkey % 150 as string) as follows from orders
union select 'u' || cast(o_orderkey % 150 as string), 'u' || cast(o_custkey as string) from orders where o_orderkey % 2 = 0"""
ORG_EDGES = "select distinct 'u' || cast(o_custkey as string) as org, 'u' || cast(o_orderkey % 150 as string) as login from orders"
STORED_EDGES = "select * from w_followers where follower_id % 9 <> 0 and user_id % 9 <> 0"
USERS_SQL = f"""with recursive listed as ({USER_LIST}), a as (select login from listed semi join v_users v on v.login = listed.login and v.type is not null),
 people as (select login, case when type = 'User' then 'USR' else 'ORG' end as type, name, location, created_at from v_users), u0 as (select login from w_users where id % 9 <> 0),
 e as (select * from ({USER_EDGES}) x where login in (select login from a) or follows in (select login from a)), om as ({ORG_EDGES}), b as (select * from om where login in (select login from a)),
 u2 as (select login from u0 union select login from a union select login from e union select follows from e union select org from b),
 concerned as (select login from (select org as login from b union select login from a) x where login in (select login from people where type = 'ORG') and login in (select login from u2)),
 m as (select org, login from om where org in (select login from concerned) union select org, login from b),
 named as (select login from u2 union select login from m), start as (select p.login from people p where p.login in (select login from named) and p.login not in (select login from u0)),
 r as (select login from start union select om.login from r join people p on p.login = r.login and p.type = 'ORG' join om on om.org = r.login
   where r.login not in (select login from concerned) and om.login not in (select login from u0) and om.login in (select login from people)),
 final as (select login from u0 union select login from r),
 late as (select om.org, om.login from om join r on r.login = om.org join people p on p.login = om.org and p.type = 'ORG' where om.org not in (select login from concerned)),
 stored as (select 'u' || cast(follower_id as varchar) as login, 'u' || cast(user_id as varchar) as follows, created_at from ({STORED_EDGES}) s)
select 'users' as name, f.login || '|' || p.type || '|' || case when f.login in (select login from a) then 'fresh ' else '' end || p.name || '|' || cast(f.login in (select login from listed) and f.login in (select login from u0) and f.login not in (select login from a) as varchar)
  || '|' || coalesce(case when f.login in (select login from a) then 'city ' || {LOCATION_SQL.format('p.location')} end, '-') as row from final f join people p on p.login = f.login
union all select 'followers', login || '|' || follows || '|' || cast(cast(floor(epoch(created_at)) as bigint) as varchar) from stored
union all select 'followers', e.login || '|' || e.follows || '|' || coalesce(cast(cast(floor(epoch(greatest(x.created_at, y.created_at))) as bigint) as varchar), '-') from e join people x on x.login = e.login join people y on y.login = e.follows where (e.login, e.follows) not in (select (login, follows) from stored)
union all select 'organization_members', org || '|' || login from (select org, login from m where org in (select login from people where type = 'ORG') and login in (select login from people) union select org, login from late where login in (select login from people)) o
union all select 'unfollowed', login || '|' || follows from stored where (login in (select login from a) or follows in (select login from a)) and (login, follows) not in (select (login, follows) from e)"""


@query("E26 X2 D4 D6 E8 E9 E21", USERS_SQL)
def refreshed_users(lake: Lake) -> DataFrame:
    """Listed users with fresh profile and place, followers, following and organizations; those absent upstream are soft-deleted."""
    users = lake["w_users"].filter("id % 9 <> 0")
    feed = lake.sql("select login, 'fresh ' || name as name, cast(null as string) as company, email, location, type, cast(created_at as string) as created_at from v_users where type is not null")
    cache = lake["v_locations"].select(location_key(F.col("raw")).alias("key")).distinct().select("key", F.lit(1.0).alias("long"), F.lit(2.0).alias("lat"), F.concat(F.lit("city "), "key").alias("city"), F.lit("s").alias("state"), F.lit("cc").alias("country_code"))
    raw = {
        "users": lake.sql("select login, name, cast(null as string) as company, email, location, type, cast(created_at as string) as created_at from v_users"),
        "followers": lake.sql(USER_EDGES), "org_members": lake.sql(ORG_EDGES),
    }
    shaped = empty_tables(lake.spark)["users"].unionByName(users, allowMissingColumns=True)
    tables = {**empty_tables(lake.spark), "users": shaped, "followers": lake.sql(STORED_EDGES)}
    done = sync_users(tables, lake.sql(USER_LIST), feed, raw, cache, now())
    names = done.tables["users"].select("id", "login")
    gone = done.unfollowed.join(names.select(F.col("id").alias("follower_id"), F.col("login").alias("one")), "follower_id").join(names.select(F.col("id").alias("user_id"), F.col("login").alias("two")), "user_id")
    people = done.tables["users"].select(F.lit("users").alias("name"), F.concat_ws("|", "login", "type", "name", F.col("deleted").cast("string"), F.coalesce("city", F.lit("-"))).alias("row"))
    return union_all([people, natural_rows(done.tables, ["followers", "organization_members"]), gone.select(F.lit("unfollowed").alias("name"), F.concat_ws("|", "one", "two").alias("row"))])
