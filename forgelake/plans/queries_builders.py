"""Event handlers and entity builders over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.functions.scalars import has_head, intra_branch, location_key
from forgelake.operators import forks, geo, handlers, history, identity
from forgelake.operators.builders import code, people, tracker
from forgelake.operators.changes import insert_missing
from forgelake.operators.repair import missing_issue_labels
from forgelake.plans.catalog import query, secs
from forgelake.plans.queries_scalars import LOCATION_SQL, feed
from forgelake.plans.views import Lake
from forgelake.session import cut_lineage

NOW = "timestamp '2024-06-01 00:00:00'"
NOW_SECS = 1717200000


def now():
    return F.timestamp_seconds(F.lit(NOW_SECS))


def new_id(table: str, key: str, order: str) -> str:
    """Check SQL of a fresh id: continues after the table's highest, in (bucket, key) order."""
    return f"(select coalesce(max(id), 0) from {table}) + row_number() over (order by substr(md5({key}), 1, 3), {order})"


# ---- handlers ------------------------------------------------------------


@query("H1 F7 F15 F28", """select id as event_id, cast(i - 1 as integer) as pos, owner, name as repo,
  md5(cast(id as string) || '-' || cast(i as string)) || substr(md5(cast(id as string)), 1, 8) as sha
from (select id, owner, name, unnest(range(1, n_commits + 1)) as i from v_feed where type = 'PushEvent')""")
def pushed_commits(lake: Lake) -> DataFrame:
    return handlers.push(feed(lake))["commits"]


COMMIT_LIST = """select owner, name as repo, -id * 100 + case when i <= n_commits then n_commits - i else i end as pos, i, n_commits,
  md5(cast(id as string) || '-' || cast(i as string)) || substr(md5(cast(id as string)), 1, 8) as sha
from (select id, owner, name, n_commits, {} as i from v_feed where type = 'PushEvent' and n_commits > 0)"""


@query("H1 J2", f"""with l as ({COMMIT_LIST.format('unnest(range(1, n_commits + 6))')}),
 m as (select *, max(case when n_commits >= 20 and i = n_commits then pos end) over w as last_start,
   max(case when i > n_commits and substr(sha, 1, 1) in ('0', '1', '2') then pos end) over w as last_stop from l
   window w as (partition by owner, repo order by pos rows between unbounded preceding and 1 preceding))
select owner, repo, sha from m where i > n_commits and substr(sha, 1, 1) not in ('0', '1', '2') and last_start is not null
 and (last_stop is null or last_start > last_stop)""")
def commits_behind_large_pushes(lake: Lake) -> DataFrame:
    rows = lake.sql(COMMIT_LIST.format("explode(sequence(1L, n_commits + 5))"))
    known = rows.filter("substr(sha, 1, 1) in ('0', '1', '2')")
    commits = known.select("sha", F.hash("sha").alias("id")).distinct()
    projects = lake.sql("select distinct k as id, k % 10 as owner_id, name, created_at from (select k, name, min(created_at) as created_at from v_feed group by 1, 2)")
    places = known.select("sha", F.substr("repo", F.lit(2)).cast("bigint").alias("project_id")).distinct()
    associations = places.select("project_id", F.hash("sha").alias("commit_id"))
    return handlers.older_commits(feed(lake), rows.select("owner", "repo", "pos", "sha"), commits, associations, projects, lake["w_users"])


@query("H3", "select id, actor as follower, other as followed, cast(floor(epoch(created_at)) as bigint) as ts from v_feed where type = 'FollowEvent'")
def follow_sightings(lake: Lake) -> DataFrame:
    return handlers.follow(feed(lake))["followers"].select("id", "follower", "followed", secs("event_ts").alias("ts"))


@query("H4", "select actor as owner, name as repo, other as login, cast(floor(epoch(created_at)) as bigint) as ts from v_feed where type = 'MemberEvent'")
def member_sightings(lake: Lake) -> DataFrame:
    return handlers.member(feed(lake))["project_members"].select("owner", "repo", "login", secs("event_ts").alias("ts"))


@query("H5", "select owner, name as repo, id + 1000000 as comment_id, md5(cast(k as string)) as sha from v_feed where type = 'CommitCommentEvent'")
def commit_comment_keys(lake: Lake) -> DataFrame:
    return handlers.commit_comment(feed(lake))["commit_comments"]


@query("H6 D2", """select owner, name as repo, id as number, action, actor as author, k % 5 > 0 as has_head, coalesce(k % 5 = 1, false) as intra
from v_feed where type = 'PullRequestEvent'""")
def pull_request_records(lake: Lake) -> DataFrame:
    """Raw pull request collection kept current from the events."""
    staged = handlers.pull_request(feed(lake))["pull_requests"]
    stored = handlers.upsert_raw(staged.limit(0), staged, ["owner", "repo", "number"], ["event_ts", "event_id"])
    pr = F.struct("head", "base")
    return stored.select(
        "owner", "repo", "number", F.col("event_action").alias("action"), F.col("user.login").alias("author"),
        has_head(pr).alias("has_head"), F.coalesce(intra_branch(pr), F.lit(False)).alias("intra"),
    )


@query("H7 E27", "select actor as owner, 'f' || cast(k as string) as name, min(owner) as parent_owner, min(name) as parent_name from v_feed where type = 'ForkEvent' group by 1, 2")
def fork_edges(lake: Lake) -> DataFrame:
    return code.fork_rows(handlers.fork(feed(lake))["forks"])


@query("H8 F23", "select owner, name as repo, id + 1000000 as comment_id, k as number from v_feed where type = 'PullRequestReviewCommentEvent'")
def review_comment_keys(lake: Lake) -> DataFrame:
    return handlers.review_comment(feed(lake))["pull_request_comments"].drop("event_id")


@query("H9", "select owner, name as repo, k as number from v_feed where type = 'IssuesEvent'")
def issue_keys(lake: Lake) -> DataFrame:
    return handlers.issue(feed(lake))["issues"].drop("event_id")


@query("H10", "select owner, name as repo, k as number, id + 1000000 as comment_id from v_feed where type = 'IssueCommentEvent'")
def issue_comment_keys(lake: Lake) -> DataFrame:
    return handlers.issue_comment(feed(lake))["issue_comments"].drop("event_id")


@query("H11 P8", "select owner, name as repo from v_feed where type = 'CreateEvent' and k % 2 = 0")
def created_repos(lake: Lake) -> DataFrame:
    return handlers.create(feed(lake))["repos"]


@query("H1-H11", """select s, count(*) as n from (
 select case type when 'PushEvent' then 'commits' when 'WatchEvent' then 'watchers' when 'FollowEvent' then 'followers' when 'MemberEvent' then 'project_members'
  when 'CommitCommentEvent' then 'commit_comments' when 'PullRequestEvent' then 'pull_requests' when 'ForkEvent' then 'forks'
  when 'PullRequestReviewCommentEvent' then 'pull_request_comments' when 'IssuesEvent' then 'issues' when 'IssueCommentEvent' then 'issue_comments'
  else 'repos' end as s, unnest(range(case when type = 'PushEvent' then n_commits else 1 end)) from v_feed where type <> 'GollumEvent' and (type <> 'CreateEvent' or k % 2 = 0)) t group by 1""")
def staged_rows(lake: Lake) -> DataFrame:
    """All handlers over one feed: number of staged rows per builder."""
    staged = handlers.stage_events(feed(lake))
    parts = [rows.select(F.lit(name).alias("s")) for name, rows in staged.items() if name != "watcher_records"]
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined.groupBy("s").agg(F.count("*").alias("n"))


# ---- people --------------------------------------------------------------


@query("E8 D1 D7", """with d as (select 'u' || cast(k as string) as followed, actor_login as follower, created_at, id, type from v_events where copy = 0 and type in ('FollowEvent', 'PullRequestEvent')),
 p as (select follower, followed, arg_max(created_at, (created_at, id)) filter (where type = 'FollowEvent') as ts from d group by 1, 2),
 r as (select a.id as follower_id, b.id as user_id, p.ts, greatest(a.created_at, b.created_at) as made from p join w_users a on a.login = p.follower join w_users b on b.login = p.followed),
 t as (select user_id as follower_id, repo_id as user_id, created_at from w_watchers)
select coalesce(t.follower_id, r.follower_id) as follower_id, coalesce(t.user_id, r.user_id) as user_id,
 cast(floor(epoch(coalesce(r.ts, t.created_at, r.made))) as bigint) as created_at
from t full outer join r on r.follower_id = t.follower_id and r.user_id = t.user_id""")
def followers_table(lake: Lake) -> DataFrame:
    """Dated follow events and undated listings meet stored followers."""
    staged = lake.sql("""select actor_login as follower, 'u' || cast(k as string) as followed, id,
      case when type = 'FollowEvent' then created_at end as event_ts from v_events where copy = 0 and type in ('FollowEvent', 'PullRequestEvent')""")
    table = lake.sql("select user_id as follower_id, repo_id as user_id, created_at from w_watchers")
    return people.next_followers(table, staged, lake["w_users"]).select("follower_id", "user_id", secs("created_at").alias("created_at"))


@query("E9", """select distinct o.id as org_id, m.id as user_id from orders join w_users o on o.login = 'u' || cast(o_custkey as string) and o.type = 'ORG'
join w_users m on m.login = 'u' || cast(o_orderkey as string)
union select follower_id, user_id from w_followers""")
def organization_members_table(lake: Lake) -> DataFrame:
    staged = lake.sql("select 'u' || cast(o_custkey as string) as org, 'u' || cast(o_orderkey as string) as login from orders")
    table = lake.sql("select follower_id as org_id, user_id from w_followers")
    return people.next_organization_members(table, staged, lake["w_users"]).select("org_id", "user_id")


@query("E10 A8", """with s as (select k, actor_id, arg_max(case when type = 'WatchEvent' then created_at end, (created_at, id)) filter (where type = 'WatchEvent') as ts,
   max(case when type = 'PushEvent' then created_at + interval 1 hour end) as rec from v_events where copy = 0 and type in ('WatchEvent', 'PushEvent', 'FollowEvent') group by 1, 2),
 r as (select p.id as repo_id, u.id as user_id, coalesce(s.ts, s.rec, greatest(p.created_at, u.created_at)) as at from s join w_projects p on p.id = s.k and p.owner_id = s.k join w_users u on u.id = s.actor_id),
 t as (select follower_id as repo_id, user_id, created_at from w_followers)
select coalesce(t.repo_id, r.repo_id) as repo_id, coalesce(t.user_id, r.user_id) as user_id, cast(floor(epoch(greatest(t.created_at, r.at))) as bigint) as created_at
from t full outer join r on r.repo_id = t.repo_id and r.user_id = t.user_id""")
def watchers_table(lake: Lake) -> DataFrame:
    """Star events, star records and undated listings; the later date wins."""
    staged = lake.sql("""select 'u' || cast(k as string) as owner, 'r' || cast(k as string) as repo, actor_login as login, id,
      case when type = 'WatchEvent' then created_at end as event_ts, case when type = 'PushEvent' then created_at + interval 1 hour end as record_ts
      from v_events where copy = 0 and type in ('WatchEvent', 'PushEvent', 'FollowEvent')""")
    table = lake.sql("select follower_id as repo_id, user_id, created_at from w_followers")
    rows = people.next_watchers(table, staged, lake["w_projects"], lake["w_users"])
    return rows.select("repo_id", "user_id", secs("created_at").alias("created_at"))


@query("E24 H4", """select k as repo_id, u.id as user_id, min(cast(floor(epoch(f.created_at)) as bigint)) as created_at from v_feed f
join w_projects p on p.id = f.k and p.owner_id = f.actor_id join w_users u on u.login = f.other where f.type = 'MemberEvent' group by 1, 2""")
def project_members_table(lake: Lake) -> DataFrame:
    staged = handlers.member(feed(lake))["project_members"]
    empty = lake["w_watchers"].limit(0)
    rows = people.next_project_members(empty, staged, lake["w_projects"], lake["w_users"])
    return rows.select("repo_id", "user_id", secs("created_at").alias("created_at"))


# ---- identities ----------------------------------------------------------

STORED_USERS = """select id, login, name, email, type, fake, deleted, location, created_at, created_at as updated_at,
 cast(null as {0}) as company from w_users where type = 'ORG'"""
IDENTITIES = """select case when seq % 40 = 3 then 'web-flow' else login end as login, name, email, seq from v_identities"""
IDENTITY_SQL = f"""with users as ({STORED_USERS.format('varchar')}),
 acc as (select login, name, email, created_at from v_users where type is not null union all select 'web-flow', 'Web', null, timestamp '2015-01-01 00:00:00'),
 ids as (select login, trim(name) as name, nullif(trim(email), '') as email, min(seq) as seq from ({IDENTITIES}) i group by 1, 2, 3),
 mail as (select email, min(id) as id from users where email is not null group by 1),
 hit as (select email, min(login) as login from acc where email is not null group by 1),
 rules as (select i.*, u.login is not null as known, r.login as row_login, h.login as hit_login,
   case when i.login = 'web-flow' then 'web' when u.login is not null then 'known'
     when a.login is not null and r.login is not null then 'merge' when a.login is not null then 'insert'
     when i.email is null then 'unknown' when r.login is not null then 'email_row' when h.login is not null then 'search_hit' else 'placeholder' end as rule
   from ids i left join users u on u.login = i.login left join acc a on a.login = i.login left join mail m on m.email = i.email
   left join users r on r.id = m.id left join hit h on h.email = i.email),
 firsts as (select * from (select *, row_number() over (partition by login order by seq, email, name) as rn from rules where rule in ('merge', 'insert')) f where rn = 1 and rule = 'merge'),
 winners as (select * from (select *, row_number() over (partition by row_login order by seq, login) as wn from firsts) w where wn = 1),
 fills as (select login, arg_min(name, (seq, email, name)) filter (where name is not null) as name, arg_min(email, (seq, email, name)) filter (where email is not null) as email, min(seq) as seq
   from rules where rule in ('known', 'insert', 'merge') group by 1),
 fresh as (select * from acc where login in (select login from rules where rule in ('insert', 'merge') union select hit_login from rules where rule = 'search_hit' union select login from rules where rule = 'web')
   and login not in (select login from users) and login not in (select login from winners)),
 lacking as (select login from users where email is null union select login from fresh where email is null),
 claims as (select email, arg_min(login, (seq, login)) as login from fills where email is not null and login in (select login from lacking) group by 1),
 holders as (select r.email, arg_min(name, (seq, r.email, name)) filter (where name is not null) as name, upper(translate(substr(md5(r.email), 1, 8), '0123456789abcdef', 'abcdefghijklmnop')) as login from rules r
   where rule = 'placeholder' and r.email not in (select email from claims) group by r.email),
 targets as (select r.login, r.name, r.email, r.seq, r.rule, case when rule in ('web', 'known', 'insert', 'merge') then r.login when rule = 'email_row' then row_login
   when rule = 'search_hit' then hit_login when rule = 'placeholder' then coalesce(c.login, h.login) end as target
   from rules r left join claims c on c.email = r.email left join holders h on h.email = r.email)"""


def resolved(lake: Lake) -> identity.Identities:
    accounts = lake.sql("""select login, name, cast(null as string) as company, email, location, type, cast(created_at as string) as created_at from v_users where type is not null
      union all select 'web-flow', 'Web', null, null, null, 'User', '2015-01-01T00:00:00Z'""")
    return identity.resolve_identities(lake.sql(IDENTITIES), lake.sql(STORED_USERS.format("string")), accounts, now())


@query("E1 J20", f"""{IDENTITY_SQL} select t.login, t.name, t.email, t.seq, t.rule, coalesce(w.login, t.target) as resolved_login
from targets t left join winners w on w.row_login = t.target""")
def resolved_identities(lake: Lake) -> DataFrame:
    """Every distinct commit identity with the rule that applied and the account it belongs to."""
    return resolved(lake).resolution


@query("E1 D5 K1", f"""{IDENTITY_SQL},
 merged as (select u.id, coalesce(w.login, u.login) as login, case when w.login is not null then coalesce(a.name, u.name) else u.name end as name,
    coalesce(w.email, u.email) as email, case when w.login is not null then 'USR' else u.type end as type from users u left join winners w on w.row_login = u.login left join acc a on a.login = w.login),
 kept as (select m.id, m.login, coalesce(a.name, m.name) as name, case when a.login is not null then a.email else m.email end as email, m.type from merged m
   left join (select * from acc where login in (select hit_login from rules where rule = 'search_hit')) a on a.login = m.login),
 added as (select f.login, f.name, f.email, case v.type when 'Organization' then 'ORG' else 'USR' end as type, false as fake from fresh f left join v_users v on v.login = f.login
   union all select login, name, email, 'USR', true from holders)
select k.id, k.login, coalesce(k.name, f.name) as name, coalesce(k.email, f.email) as email, k.type, false as fake from kept k left join fills f on f.login = k.login
union all select {new_id('users', 'a.login', 'a.login')}, a.login, coalesce(a.name, f.name), coalesce(a.email, f.email), a.type, a.fake
from added a left join fills f on f.login = a.login and not a.fake""")
def users_after_resolution(lake: Lake) -> DataFrame:
    """The users table after merges, refreshes, fills, inserts and placeholders."""
    return resolved(lake).users.select("id", "login", "name", "email", "type", "fake")


# ---- code ----------------------------------------------------------------

RAW_REPOS = """select named_struct('login', owner) as owner, name, 'https://api.github.com/repos/' || owner || '/' || name as url, description, language,
  cast(updated_at as string) as created_at,
  case when parent is not null then named_struct('name', case when language = 'PROMO' then 'lost' else parent end, 'owner', named_struct('login', 'u' || substr(parent, 2))) end as parent
from v_projects"""


@query("E2 K1 D1 F10", f"""with t as (select * from w_projects where language = 'SMALL'),
 n as (select p.*, q.parent from w_projects p join v_projects q on q.name = p.name where p.language <> 'SMALL' and p.owner_id in (select id from w_users)),
 f as (select {new_id('t', "cast(owner_id as string) || chr(1) || name", 'owner_id, name')} as id, owner_id, name, substr(description, 1, 255) as description, parent, language from n),
 a as (select id, owner_id, name from t union all select id, owner_id, name from f)
select id, owner_id, name, description, forked_from from t
union all select f.id, f.owner_id, f.name, f.description, case when f.parent is not null then coalesce(case when f.language <> 'PROMO' then a.id end, -1) end
from f left join a on a.name = f.parent and a.owner_id = cast(substr(f.parent, 2) as bigint)""")
def projects_table(lake: Lake) -> DataFrame:
    """New repositories join stored ones; parents are found among both, -1 when unknown."""
    table = lake["w_projects"].filter("language = 'SMALL'")
    repos = code.repo_rows(lake.sql(RAW_REPOS))
    return code.next_projects(table, repos, lake["w_users"], now()).select("id", "owner_id", "name", "description", "forked_from")


@query("E2", """with recursive r as (select p_partkey as p from part where p_size = 50 union select cast(floor(p / 7) as bigint) from r where p >= 7)
select 'u' || cast(p % 150 as string) as owner, 'r' || cast(p as string) as name from r""")
def fork_ancestors(lake: Lake) -> DataFrame:
    """Requested repositories with all ancestors along their fork chains."""
    repos = lake.sql("""select 'u' || cast(p_partkey % 150 as string) as owner, 'r' || cast(p_partkey as string) as name,
      case when p_partkey >= 7 then 'u' || cast(floor(p_partkey / 7) % 150 as string) end as parent_owner,
      case when p_partkey >= 7 then 'r' || cast(floor(p_partkey / 7) as string) end as parent_name, p_size from part""")
    return code.with_parents(repos.filter("p_size = 50"), repos)


RAW_COMMITS = """select sha, 'https://api.github.com/repos/u' || cast(cast(substr(project, 2) as bigint) % 150 as string) || '/' || project || '/commits/' || sha as url,
  named_struct('login', 'u' || substr(author, 2)) as author, named_struct('login', cast(null as string)) as committer,
  named_struct('author', named_struct('name', author, 'email', cast(null as string), 'date', date_format(created_at, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
     'committer', named_struct('name', 'C', 'email', 'm' || cast(pos * 3 as string) || '@n1.example.org')) as commit,
  struct(created_at, project, author, line_id, pos) as seq from v_commits"""


@query("E3 J19 K1", f"""with f as (select * from (select v_commits.*, row_number() over (partition by sha order by created_at, project, author) as rn from v_commits) x where rn = 1),
 mail as (select email, min(id) as id from w_users where email is not null group by 1),
 t as (select 0 as id)
select {new_id('t', 'sha', 'sha')} as id, sha, a.id as author_id, m.id as committer_id, p.id as project_id, cast(floor(epoch(f.created_at)) as bigint) as created_at
from f left join w_users a on a.login = 'u' || substr(f.author, 2) left join mail m on m.email = 'm' || cast(pos * 3 as string) || '@n1.example.org'
left join w_projects p on p.name = f.project and p.owner_id in (select id from w_users)""")
def commits_table(lake: Lake) -> DataFrame:
    """First occurrence of each sha with author and committer resolved through their identities."""
    users = lake["w_users"].withColumn("company", F.lit(None).cast("string"))
    commits = cut_lineage(code.first_commits(lake.made(RAW_COMMITS)), "commits")
    accounts = lake.sql("select login, name, cast(null as string) as company, email, location, type, cast(created_at as string) as created_at from v_users").limit(0)
    found = identity.resolve_identities(code.commit_identities(commits), users, accounts, now())
    known = cut_lineage(found.resolution.filter("rule <> 'placeholder'"), "resolution")
    table = lake.made("select * from w_commits").limit(0)
    rows = code.next_commits(table, commits, known, lake["w_projects"], cut_lineage(found.users, "users"))
    return rows.select("id", "sha", "author_id", "committer_id", "project_id", secs("created_at").alias("created_at"))


@query("E4 J14", "select c.id as commit_id, p.id as parent_id from v_parents e join w_commits c on c.sha = e.sha join w_commits p on p.sha = e.parent_sha")
def commit_parents_table(lake: Lake) -> DataFrame:
    raw = lake.sql("""select sha, array(named_struct('sha', parent_sha, 'url', 'https://api.github.com/repos/o/r/commits/' || parent_sha)) as parents from v_parents
      union all select sha, array(named_struct('sha', 'gone', 'url', cast(null as string))) from v_commits""")
    return code.commit_parent_rows(raw, lake["w_commits"])


@query("E6 D1", "select project_id, commit_id from w_project_commits p join w_projects r on r.id = p.project_id union select pull_request_id, commit_id from w_pr_commits")
def project_commits_table(lake: Lake) -> DataFrame:
    pairs = lake.made("select 'u' || cast(cast(substr(project, 2) as bigint) % 150 as string) as owner, project as repo, sha from v_commits")
    table = lake.sql("select pull_request_id as project_id, commit_id from w_pr_commits")
    commits = lake.made("select id, sha from w_commits")  # read once, two of its columns
    rows = code.project_commit_rows(pairs, lake["w_projects"], lake["w_users"], commits)
    return code.next_project_commits(table, rows)


FORK_POINT_SQL = """with d as (select 'f' || cast(line_id as string) as fork, sha, created_at, pos from v_commits),
 f as (select fork, arg_min(sha, (created_at, sha)) as first_sha, count(*) as n, min(pos) as low, max(sha) as top from d group by 1),
 k as (select f.fork, arg_max(p.parent_sha, (c.created_at, p.parent_sha)) as parent_sha from f join v_parents p on p.sha = f.first_sha join w_commits c on c.sha = p.parent_sha group by 1)
select f.fork as fork_id, case when f.n = 1 then f.top when f.low > 5 then 'kept' else coalesce(k.parent_sha, f.first_sha) end as fork_sha from f left join k on k.fork = f.fork"""


def fork_point_rows(lake: Lake) -> DataFrame:
    """Forks are order lines: one line means the fork is not ahead; a fork with only high positions has a known point."""
    forks_df = lake.sql("select 'f' || cast(line_id as string) as fork_id, case when min(pos) > 5 and count(*) > 1 then 'kept' end as fork_sha from v_commits group by 1")
    heads = lake.sql("select 'f' || cast(line_id as string) as fork_id, case when count(*) = 1 then 0 else count(*) end as ahead_by, max(sha) as merge_base from v_commits group by 1")
    diverging = lake.sql("select 'f' || cast(line_id as string) as fork_id, sha, date_format(created_at, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") as date from v_commits")
    parents = lake.sql("select distinct 'f' || cast(c.line_id as string) as fork_id, p.sha, p.parent_sha from v_parents p join v_commits c on c.sha = p.sha")
    return forks.fork_points(forks_df, heads, diverging, parents, lake["w_commits"])


@query("E5 A6", FORK_POINT_SQL)
def fork_points(lake: Lake) -> DataFrame:
    return fork_point_rows(lake)


FORK_FEED = "select {0} as fork_id, l_linenumber as page, l_suppkey as pos, md5(cast(l_suppkey as string)) as sha, l_orderkey from lineitem"
FORK_HEADS = """select l_orderkey as fork_id, case when min(l_linenumber) > 1 then null when count(*) > 6 then 'elsewhere'
  else md5(cast(max(l_suppkey) as string)) end as fork_sha from lineitem group by 1"""
OWN_SQL = f"""with h as ({FORK_HEADS}), c as (select l.fork_id, min((l.page * 1000000 + l.pos)) as cut from ({FORK_FEED.format('l_orderkey')}) l join h on h.fork_id = l.fork_id and h.fork_sha = l.sha group by 1)
select distinct l.fork_id, l.sha from ({FORK_FEED.format('l_orderkey')}) l join h on h.fork_id = l.fork_id and h.fork_sha is not null left join c on c.fork_id = l.fork_id
where c.cut is null or l.page * 1000000 + l.pos < c.cut"""


@query("E7", OWN_SQL)
def own_fork_commits(lake: Lake) -> DataFrame:
    """Commits of forks from the head down to their fork commit."""
    rows = lake.sql(FORK_FEED.format("l_orderkey")).drop("l_orderkey")
    return forks.own_commits(rows, lake.sql(FORK_HEADS))


@query("E7 J13", """with pt as (select p.id as fork_id, p.forked_from as parent_id, f.sha as fork_sha, f.created_at from w_projects p join (
   select project_id, arg_min(sha, (created_at, sha)) as sha, min(created_at) as created_at from w_commits group by 1) f on f.project_id = p.id where p.forked_from is not null)
select distinct pt.fork_id as project_id, pc.commit_id from pt join w_project_commits pc on pc.project_id = pt.parent_id join w_commits c on c.id = pc.commit_id where c.created_at < pt.created_at""")
def inherited_commits(lake: Lake) -> DataFrame:
    """Strategy `all`: forks get the parent's commits made before the fork commit."""
    points = lake.sql("""select p.id as fork_id, p.forked_from as parent_id, f.sha as fork_sha from w_projects p join (
      select project_id, min_by(sha, struct(created_at, sha)) as sha from w_commits group by 1) f on f.project_id = p.id where p.forked_from is not null""")
    nothing = points.select("fork_id", F.lit(0).alias("page"), F.lit(0).alias("pos"), F.lit("none").alias("sha")).limit(0)
    return forks.inherit_commits("all", nothing, points.select("fork_id", "fork_sha"), points.select("fork_id", "parent_id"), lake["w_project_commits"], lake["w_commits"])


@query("E20 U3 D6", """with s as (select distinct project_id, topic_name from w_topics where snapshot = 0), l as (select distinct project_id, topic_name from w_topics where snapshot = 1 and project_id > 2)
select coalesce(s.project_id, l.project_id) as project_id, coalesce(s.topic_name, l.topic_name) as topic_name,
  coalesce(s.topic_name like 'de%', false) or (s.project_id > 1 and l.topic_name is null) as deleted
from s full outer join l on l.project_id = s.project_id and l.topic_name = s.topic_name""")
def topics_table(lake: Lake) -> DataFrame:
    """New listings add topics and soft-delete unlisted ones; deleted topics stay deleted; project 2 lists nothing."""
    topics = lake["w_topics"]
    stored = topics.filter("snapshot = 0").select("project_id", "topic_name").distinct().select(
        "project_id", "topic_name", now().alias("created_at"), F.col("topic_name").like("de%").alias("deleted")
    )
    listed = topics.filter("snapshot = 1 and project_id > 2").select("project_id", "topic_name")
    refreshed = topics.filter("project_id > 1").select("project_id").distinct()
    return code.next_topics(stored, listed, refreshed, now()).select("project_id", "topic_name", "deleted")


@query("E23 F13", f"""select p.id as project_id, lower(lang) as language, sum(n_chars)::bigint as bytes, {NOW_SECS} as created_at
from documents join w_projects p on p.name = 'r' || substr(source, 4) group by 1, 2""")
def languages_table(lake: Lake) -> DataFrame:
    per_language = lake.sql("select source, lang, sum(n_chars) as n from documents group by 1, 2")
    staged = per_language.groupBy("source").agg(
        F.map_from_entries(F.collect_list(F.struct(F.upper("lang"), F.col("n").cast("string")))).alias("languages")
    ).select(F.concat(F.lit("u"), F.substr("source", F.lit(4))).alias("owner"), F.concat(F.lit("r"), F.substr("source", F.lit(4))).alias("repo"), "languages")
    rows = code.language_rows(staged, lake["w_projects"], lake["w_users"], now())
    return rows.select("project_id", "language", "bytes", secs("created_at").cast("int").alias("created_at"))


@query("E27 J6", f"""with e as (select actor_id as owner_id, 'f' || cast(k as string) as name, min(('u' || cast(k % 10 as string), name)) as p, min(k) as parent from v_feed where type = 'ForkEvent' group by 1, 2),
 n as (select * from e where owner_id in (select id from w_users))
select id, owner_id, name, forked_from from w_projects union all
select {new_id('w_projects', "cast(n.owner_id as string) || chr(1) || n.name", 'n.owner_id, n.name')}, n.owner_id, n.name, coalesce(q.id, -1)
from n left join w_projects q on q.name = 'r' || cast(n.parent as string) and q.owner_id = n.parent % 10""")
def forks_table(lake: Lake) -> DataFrame:
    """Fork events add projects with their parent."""
    raw = handlers.fork(feed(lake))["forks"]
    return code.next_forks(lake["w_projects"], raw, lake["w_users"], now()).select("id", "owner_id", "name", "forked_from")


@query("E29", """select sha, min(line_id) as pull_request_id, min(pos) as pos from v_commits group by 1""")
def pull_request_commit_records(lake: Lake) -> DataFrame:
    raw = lake.sql("select sha, struct(created_at, project, author) as seq, pos from v_commits")
    tags = lake.sql("select distinct sha, line_id as pull_request_id from v_commits")
    return code.pr_commit_collection(raw, tags).select("sha", "pull_request_id", "pos")


# ---- tracker -------------------------------------------------------------

RAW_COMMENTS = """select issue * 1000 + comment_id as id, md5(cast(issue as string) || '-1') || substr(md5(cast(issue as string)), 1, 8) as commit_id,
  named_struct('login', 'u' || cast(issue as string)) as user, body, cast(comment_id as int) as line, cast(issue as int) as position, '2020-01-01T00:00:00Z' as created_at from v_comments"""


@query("E11 F10 R8", f"""with t as (select 0 as id), r as (select c.id as commit_id, m.issue as user_id, substr(m.body, 1, 256) as body, m.issue * 1000 + m.comment_id as comment_id
   from v_comments m join w_commits c on c.sha = md5(cast(issue as string) || '-1') || substr(md5(cast(issue as string)), 1, 8) join w_users u on u.login = 'u' || cast(issue as string))
select {new_id('t', 'cast(comment_id as string)', 'comment_id')} as id, commit_id, user_id, body, comment_id from r""")
def commit_comments_table(lake: Lake) -> DataFrame:
    empty = lake.sql("select cast(null as bigint) as id, cast(null as bigint) as commit_id, cast(null as bigint) as user_id, cast(null as string) as body, cast(null as bigint) as comment_id").limit(0)
    rows = tracker.next_commit_comments(empty, lake.sql(RAW_COMMENTS), lake["w_commits"], lake["w_users"])
    return rows.select("id", "commit_id", "user_id", "body", "comment_id")


RAW_ISSUE_EVENTS = """select event_id as id, 'u' || cast(o_custkey % 97 as string) as owner, 'r' || cast(o_custkey % 97 as string) as repo, o_orderkey as issue_id,
  case event_type when 'click' then 'assigned' when 'view' then 'closed' when 'error' then 'referenced' else event_type end as event, md5(cast(event_id as string)) as commit_id,
  case when event_type <> 'signup' then named_struct('login', 'u' || cast(user_id as string)) end as actor, cast(ts as string) as created_at
from events join orders on o_orderkey = user_id * 3"""
ISSUE_EVENT_SQL = """select event_id, o_orderkey as issue_id, user_id as actor_id, case event_type when 'click' then 'assigned' when 'view' then 'closed' when 'error' then 'referenced' else event_type end as action,
  case when event_type in ('view', 'error') then md5(cast(event_id as string)) end as action_specific, ts from events join orders on o_orderkey = user_id * 3 where event_type <> 'signup'"""


@query("E12 P9 F27", f"select event_id, issue_id, actor_id, action, action_specific from ({ISSUE_EVENT_SQL}) e")
def issue_events_table(lake: Lake) -> DataFrame:
    rows = tracker.issue_event_rows(lake.sql(RAW_ISSUE_EVENTS), lake["w_issues"], lake["w_projects"], lake["w_users"])
    return insert_missing(rows.limit(0), rows, ["event_id", "issue_id"]).select("event_id", "issue_id", "actor_id", "action", "action_specific")


@query("E14 A7", f"""select i.id, a.actor_id as assignee_id from w_issues i left join (
  select issue_id, arg_max(actor_id, (ts, event_id)) as actor_id from ({ISSUE_EVENT_SQL}) e where action = 'assigned' group by 1) a on a.issue_id = i.id""")
def issue_assignees(lake: Lake) -> DataFrame:
    rows = tracker.issue_event_rows(lake.sql(RAW_ISSUE_EVENTS), lake["w_issues"], lake["w_projects"], lake["w_users"])
    return tracker.with_assignees(lake["w_issues"], rows).select("id", "assignee_id")


RAW_ISSUES = """select 'u' || cast(o_custkey % 97 as string) as owner, 'r' || cast(o_custkey % 97 as string) as repo, o_orderkey as number, cast(o_orderdate as string) as created_at,
  named_struct('login', 'u' || cast(o_custkey as string)) as user, case when o_orderpriority = '5-LOW' then named_struct('login', 'u' || cast(o_orderkey as string)) end as assignee,
  case when o_orderstatus = 'F' then named_struct('patch_url', 'https://x.example.org/patch') end as pull_request,
  case when o_orderpriority = '3-MEDIUM' then array(named_struct('name', 'Brand#' || cast(o_orderkey % 30 as string)), named_struct('name', 'bug')) else array() end as labels from orders"""


@query("E13 K1 D2", f"""with t as (select id, repo_id, reporter_id, assignee_id, false as pull_request, issue_id from w_issues where repo_id % 5 = 0),
 pr as (select o_orderkey as pr, o_custkey % 97 as repo_id from orders where o_orderstatus <> 'O'),
 n as (select i.repo_id, i.reporter_id, u.id as assignee_id, o.o_orderstatus = 'F' as pull_request, i.issue_id from w_issues i join orders o on o.o_orderkey = i.id
   left join w_users u on o.o_orderpriority = '5-LOW' and u.id = o.o_orderkey where i.repo_id % 5 <> 0)
select t.id, t.repo_id, t.reporter_id, t.assignee_id, o.o_orderstatus = 'F' as pull_request, case when o.o_orderstatus = 'F' then t.issue_id end as pull_request_id, t.issue_id from t join orders o on o.o_orderkey = t.id
union all select {new_id('t', "cast(repo_id as string) || chr(1) || cast(issue_id as string)", 'repo_id, issue_id')}, repo_id, reporter_id, assignee_id, pull_request, case when pull_request then issue_id end, issue_id from n""")
def issues_table(lake: Lake) -> DataFrame:
    """New issues are inserted; stored ones turn into pull requests when the record shows it."""
    table = lake["w_issues"].filter("repo_id % 5 = 0").withColumns({"pull_request": F.lit(False), "pull_request_id": F.lit(None).cast("bigint")})
    prs = lake.sql("select o_orderkey as id, o_orderkey as pullreq_id, o_custkey % 97 as base_repo_id from orders where o_orderstatus <> 'O'")
    rows = tracker.next_issues(table, lake.sql(RAW_ISSUES), lake["w_projects"], lake["w_users"], prs)
    return rows.select("id", "repo_id", "reporter_id", "assignee_id", "pull_request", "pull_request_id", "issue_id")


@query("E18", f"""with t as (select * from w_issues where repo_id % 5 = 0 and reporter_id % 2 = 0), n as (select number as pr, cast(substr(base, 2) as bigint) as repo_id, created_at from v_prs p
   where not exists (select 1 from t where t.repo_id = cast(substr(p.base, 2) as bigint) and t.issue_id = p.number))
select id, repo_id, reporter_id, issue_id, true as pull_request, issue_id as pull_request_id from t
union all select {new_id('t', "cast(repo_id as string) || chr(1) || cast(pr as string)", 'repo_id, pr')}, repo_id, null, pr, true, pr from n""")
def shadow_issues_table(lake: Lake) -> DataFrame:
    """Every pull request gets an issue: a stored one is flipped, else a bare one is added."""
    table = lake["w_issues"].filter("repo_id % 5 = 0 and reporter_id % 2 = 0")
    dates = lake.sql("select number as pullreq_id, cast(substr(base, 2) as bigint) as base_repo_id, created_at from v_prs")
    rows = tracker.next_shadow_issues(table, lake["w_prs"], dates)
    return rows.select("id", "repo_id", "reporter_id", "issue_id", "pull_request", "pull_request_id")


@query("E15", """select i.id as issue_id, u.id as user_id, e.event_id as comment_id from events e join w_issues i on i.id = e.user_id * 3 left join w_users u on u.id = e.user_id and e.event_type <> 'error'""")
def issue_comments_table(lake: Lake) -> DataFrame:
    raw = lake.sql("""select event_id as id, 'u' || cast(o_custkey % 97 as string) as owner, 'r' || cast(o_custkey % 97 as string) as repo, o_orderkey as issue_id,
      named_struct('login', case when event_type = 'error' then 'nobody' else 'u' || cast(user_id as string) end) as user, cast(ts as string) as created_at from events join orders on o_orderkey = user_id * 3""")
    rows = tracker.issue_comment_rows(raw.unionByName(raw), lake["w_issues"], lake["w_projects"], lake["w_users"])
    return rows.select("issue_id", "user_id", "comment_id")


RAW_PRS = """select number, named_struct('sha', md5(cast(number as string) || '-1') || substr(md5(cast(number as string)), 1, 8), 'repo', named_struct('name', base, 'full_name', 'u' || substr(base, 2) || '/' || base, 'owner', named_struct('login', 'u' || substr(base, 2)))) as base,
  named_struct('sha', md5(cast(number as string) || '-2') || substr(md5(cast(number as string)), 1, 8), 'repo', case when head is not null then named_struct('name', head, 'full_name', 'u' || substr(head, 2) || '/' || head, 'owner', named_struct('login', 'u' || substr(head, 2))) end) as head from v_prs"""


@query("E16 F21 K1", f"""with t as (select 0 as id), n as (select number, cast(substr(base, 2) as bigint) as base_repo_id, cast(substr(head, 2) as bigint) as head_repo_id, coalesce(base = head, false) as intra_branch from v_prs)
select {new_id('t', "cast(number as string) || chr(1) || cast(base_repo_id as string)", 'number, base_repo_id')} as id, number as pullreq_id, base_repo_id, head_repo_id,
  b.id as base_commit_id, case when head_repo_id is not null then h.id end as head_commit_id, intra_branch
from n left join w_commits b on b.id = number * 8 + 1 left join w_commits h on h.id = number * 8 + 2""")
def pull_requests_table(lake: Lake) -> DataFrame:
    rows = tracker.next_pull_requests(lake["w_prs"].limit(0), lake.sql(RAW_PRS), lake["w_projects"], lake["w_users"], lake["w_commits"])
    return rows.select("id", "pullreq_id", "base_repo_id", "head_repo_id", "base_commit_id", "head_commit_id", "intra_branch")


HISTORY_TOLERANCE = 3 * 3600
HISTORY_SQL = f"""with recursive c as (select pr, action, cast(floor(epoch(created_at)) as bigint) as sec, id, actor from v_pr_events),
 k as (select pr, action, min(sec) as sec from c group by 1, 2
   union all select k.pr, k.action, (select min(c.sec) from c where c.pr = k.pr and c.action = k.action and c.sec > k.sec + {HISTORY_TOLERANCE}) from k
   where k.action not in ('opened', 'merged') and k.sec is not null),
 kept as (select * from k where sec is not null)
select k.pr as pull_request_id, k.action, k.sec as created_at, min(c.id) filter (where c.sec = k.sec) as id, arg_min(c.actor, (c.sec, c.id)) filter (where c.actor is not null) as actor
from kept k join c on c.pr = k.pr and c.action = k.action and c.sec between k.sec and k.sec + {HISTORY_TOLERANCE} group by 1, 2, 3"""


@query("E17", HISTORY_SQL)
def pull_request_histories(lake: Lake) -> DataFrame:
    """Greedy tolerance fold of pull request actions, three hours."""
    rows = lake.sql("select pr as pull_request_id, action, created_at, actor, id from v_pr_events")
    kept = history.build_history(rows, HISTORY_TOLERANCE)
    return kept.select("pull_request_id", "action", secs("created_at").alias("created_at"), "actor", "id")


@query("E17", """select id as pull_request_id, x as action, actor, cast(floor(epoch(created_at)) as bigint) as created_at from (
 select id, actor, created_at, action, unnest(case when action = 'merged' then ['opened', 'closed', 'merged'] when action = 'closed' then ['opened', 'closed'] else ['opened', action] end) as x
 from v_feed where type = 'PullRequestEvent') h group by 1, 2, 3, 4""")
def stated_and_reported_actions(lake: Lake) -> DataFrame:
    """Candidates from records and events of one pull request, folded with three seconds."""
    prs = handlers.pull_request(feed(lake))["pull_requests"].withColumn("pull_request_id", F.col("number"))
    reported = prs.select(
        "pull_request_id", F.col("event_action").alias("action"), F.col("event_actor").alias("actor"),
        F.col("event_ts").alias("created_at"), F.col("event_id").alias("id"),
    )
    kept = history.build_history(history.history_candidates(prs, reported))
    return kept.select("pull_request_id", "action", "actor", secs("created_at").alias("created_at"))


@query("E19 F14", """select number as pull_request_id, u.id as user_id, m.issue * 1000 + m.comment_id as comment_id, substr(m.body, 1, 255) as body, c.id as commit_id
from v_comments m join v_prs p on p.number = m.issue join w_users u on u.login = 'u' || cast(m.issue as string) left join w_commits c on c.id = m.issue * 8 + 1""")
def pull_request_comments_table(lake: Lake) -> DataFrame:
    raw = lake.sql("""select cast(issue * 1000 + comment_id as string) as id, 'u' || substr(base, 2) as owner, base as repo,
      case when comment_id % 2 = 0 then cast(issue as string) end as pullreq_id, cast(issue as string) as issue_id, named_struct('login', 'u' || cast(issue as string)) as user, body,
      cast(comment_id as int) as original_position, md5(cast(issue as string) || '-1') || substr(md5(cast(issue as string)), 1, 8) as original_commit_id, '2020-01-01T00:00:00Z' as created_at
      from v_comments join v_prs on number = issue""")
    rows = tracker.pull_request_comment_rows(raw, lake["w_prs"], lake["w_projects"], lake["w_users"], lake["w_commits"])
    return tracker.insert_missing(rows.limit(0), rows, ["pull_request_id", "comment_id"]).select("pull_request_id", "user_id", "comment_id", "body", "commit_id")


@query("E19", "select distinct p.number as pull_request_id, c.commit_id from v_prs p join w_pr_commits c on c.pull_request_id = p.number")
def pull_request_commits_table(lake: Lake) -> DataFrame:
    listed = lake.sql("""select 'u' || substr(base, 2) as owner, base as repo, number, sha from v_prs join v_commits on line_id = number""")
    rows = tracker.pull_request_commit_rows(listed, lake["w_prs"], lake["w_projects"], lake["w_users"], lake["w_commits"])
    return tracker.next_pull_request_commits(rows.limit(0), rows)


LABEL_SQL = """select o_custkey % 97 as repo_id, o_orderkey as number, 'Brand#' || cast(o_orderkey % 30 as string) as name from orders where o_orderpriority = '3-MEDIUM'"""


@query("E22 P11", f"""with n as (select distinct repo_id, name from ({LABEL_SQL} union all select o_custkey % 97, o_orderkey, 'bug' from orders where o_orderpriority = '3-MEDIUM') l
  where not exists (select 1 from w_labels w where w.repo_id = l.repo_id and w.name = l.name))
select id, repo_id, name from w_labels union all select {new_id('w_labels', "cast(repo_id as string) || chr(1) || name", 'repo_id, name')}, repo_id, name from n""")
def repo_labels_table(lake: Lake) -> DataFrame:
    staged = tracker.labelled_issues(lake.sql(RAW_ISSUES))
    return tracker.next_repo_labels(lake["w_labels"], staged, lake["w_projects"], lake["w_users"]).select("id", "repo_id", "name")


@query("E22 R6 P11", f"""select w.id as label_id, l.number as issue_id from ({LABEL_SQL}) l join w_labels w on w.repo_id = l.repo_id and w.name = l.name
union select label_id, issue_id from w_issue_labels""")
def issue_labels_table(lake: Lake) -> DataFrame:
    return missing_issue_labels(
        lake["w_issue_labels"], lake.sql(RAW_ISSUES), lake["w_labels"], lake["w_issues"], lake["w_projects"], lake["w_users"]
    )


# ---- geo -----------------------------------------------------------------

GEO_RESPONSES = """select location, provider, case provider
  when 'osm' then to_json(array(named_struct('lon', cast(key as string), 'lat', '1.5', 'importance', 0.2D, 'address', named_struct('city', 'second', 'country', 'x', 'state', 'y', 'country_code', 'zz')),
      named_struct('lon', cast(key as string) || '.25', 'lat', '2.5', 'importance', 0.9D, 'address', named_struct('city', 'c' || key, 'country', 'x', 'state', 's', 'country_code', 'cc'))))
  when 'bing' then to_json(named_struct('resourceSets', array(named_struct('estimatedTotal', 2, 'resources', array(
      named_struct('confidence', 'Medium', 'point', named_struct('coordinates', array(0D, 0D)), 'address', named_struct('locality', 'no', 'countryRegion', 'no', 'adminDistrict', 'no')),
      named_struct('confidence', 'High', 'point', named_struct('coordinates', array(3.5D, cast(key as double))), 'address', named_struct('locality', 'c' || key, 'countryRegion', n_name, 'adminDistrict', 's')))))))
  when 'gmaps' then to_json(named_struct('results', array(named_struct('address_components', array(
      named_struct('long_name', 'c' || key, 'short_name', 'c', 'types', array('locality', 'political')), named_struct('long_name', 's', 'short_name', 's', 'types', array('administrative_area_level_1')),
      named_struct('long_name', n_name, 'short_name', 'CC', 'types', array('country'))), 'geometry', named_struct('location', named_struct('lat', 4.5D, 'lng', cast(key as double)))))))
  else '[]' end as body
from (select raw as location, n_name, n_nationkey as key, case n_nationkey % 4 when 0 then 'osm' when 1 then 'bing' when 2 then 'gmaps' else 'none' end as provider
  from v_locations join nation on n_name = coalesce(nullif(regexp_extract(raw, '#([^,]+),', 1), ''), regexp_extract(raw, '[(]([^)]+)[)]', 1)))"""
GEO_SQL = f"""select {LOCATION_SQL.format('raw')} as key, n_name, n_nationkey as n, n_nationkey % 4 as provider from v_locations join nation on n_name = coalesce(nullif(regexp_extract(raw, '#([^,]+),', 1), ''), regexp_extract(raw, '[(]([^)]+)[)]', 1))"""


@query("E21 O2 J17", f"""select distinct key, cast(case provider when 0 then n + 0.25 when 1 then n when 2 then n end as double) as long, cast(case provider when 0 then 2.5 when 1 then 3.5 when 2 then 4.5 end as double) as lat,
  case when provider < 3 then 'c' || cast(n as string) end as city, case provider when 0 then 'cc' when 1 then lower(substr(n_name, 1, 3)) when 2 then 'cc' end as country_code,
  case when provider < 3 then 'ok' else 'failed' end as status from ({GEO_SQL}) g""")
def geo_cache_table(lake: Lake) -> DataFrame:
    """Staged answers of three providers become cache rows; failures are cached too."""
    responses = lake.sql(GEO_RESPONSES).withColumn("provider", F.when(F.col("provider") == "none", "osm").otherwise(F.col("provider")))
    codes = lake.sql("select n_name as name, 'zz' as code, 0 as line from nation union all select n_name, lower(substr(n_name, 1, 3)), 1 from nation")
    parsed = geo.parse_responses(responses, codes)
    return geo.next_geo_cache(parsed.limit(0), responses, codes).select("key", "long", "lat", "city", "country_code", "status")


@query("E21 J16 F12", f"""select u.id, cast(c.n as double) as long, c.city from w_users u left join (select key, min(n) as n, 'city' || cast(min(n) as string) as city from ({GEO_SQL}) g group by 1) c
on c.key = {LOCATION_SQL.format('u.location')}""")
def located_users(lake: Lake) -> DataFrame:
    cache = lake.sql("select raw, n_nationkey as n from v_locations join nation on n_name = coalesce(nullif(regexp_extract(raw, '#([^,]+),', 1), ''), regexp_extract(raw, '[(]([^)]+)[)]', 1))").groupBy(
        location_key(F.col("raw")).alias("key")
    ).agg(F.min("n").alias("long")).select(
        "key", "long", F.lit(1.0).alias("lat"), F.lit("cc").alias("country_code"), F.lit("s").alias("state"),
        F.concat(F.lit("city"), F.col("long").cast("string")).alias("city"),
    )
    return geo.enrich_users(lake["w_users"], cache).select("id", F.col("long").cast("double").alias("long"), "city")
