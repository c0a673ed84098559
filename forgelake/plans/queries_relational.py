"""Joins, aggregates, ordering, set operators, keys and table changes over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake import schemas
from forgelake.operators import changes, keys, lookup
from forgelake.operators.sync import refresh_stale
from forgelake.plans.catalog import query, secs
from forgelake.plans.views import Lake

EPOCH = "cast(floor(epoch({})) as bigint)"


# ---- joins ---------------------------------------------------------------


@query("J1", "select p.id, u.login as owner, p.name from w_projects p join w_users u on p.owner_id = u.id")
def project_owners(lake: Lake) -> DataFrame:
    return lookup.project_lookup(lake["w_projects"], lake["w_users"]).select("id", "owner", "name")


@query("J2", """select 'u' || cast(p_partkey % 150 as string) as owner, c.project as repo, c.sha
from v_commits c join part p on 'r' || cast(p_partkey as string) = c.project
where not exists (select 1 from w_commits k where k.sha = c.sha and 'r' || cast(k.project_id as string) = c.project)
group by 1, 2, 3""")
def unregistered_shas(lake: Lake) -> DataFrame:
    """Pushed shas that are not yet associated with their repository."""
    pushed = lake.sql("""select 'u' || cast(p_partkey % 150 as string) as owner, c.project as repo, c.sha
      from v_commits c join part p on 'r' || cast(p_partkey as string) = c.project""").distinct()
    commits = lake["w_commits"]
    associated = commits.select("project_id", F.col("id").alias("commit_id"))
    return lookup.unregistered_commits(pushed, commits, associated, lake["w_projects"], lake["w_users"])


@query("J3", """select f.user_id as account, u.login, 'follower' as side from w_followers f join w_users u on u.id = f.follower_id
union all select f.follower_id, u.login, 'following' from w_followers f join w_users u on u.id = f.user_id""")
def follow_logins(lake: Lake) -> DataFrame:
    followers, users = lake["w_followers"], lake["w_users"]
    sides = [
        lookup.follower_logins(followers, users).select(F.col("user_id").alias("account"), "login", F.lit("follower").alias("side")),
        lookup.following_logins(followers, users).select(F.col("follower_id").alias("account"), "login", F.lit("following").alias("side")),
    ]
    return changes.union_all(sides)


@query("J4", "select w.repo_id, u.login from w_watchers w join w_users u on u.id = w.user_id")
def watcher_logins(lake: Lake) -> DataFrame:
    return lookup.watcher_logins(lake["w_watchers"], lake["w_users"])


@query("J5", "select i.issue_id, l.name from w_issue_labels i join w_labels l on l.id = i.label_id")
def issue_label_names(lake: Lake) -> DataFrame:
    return lookup.issue_label_names(lake["w_issue_labels"], lake["w_labels"])


@query("J6", "select p.forked_from, u.login as owner, p.name from w_projects p join w_users u on u.id = p.owner_id where p.forked_from is not null")
def forks_of_projects(lake: Lake) -> DataFrame:
    return lookup.forks_of(lake["w_projects"], lake["w_users"])


@query("J7", """select u.login as owner, p.name as repo, r.pullreq_id as number, r.id as pull_request_id
from w_prs r join w_projects p on p.id = r.base_repo_id join w_users u on u.id = p.owner_id""")
def pull_request_ids(lake: Lake) -> DataFrame:
    return lookup.pr_lookup(lake["w_prs"], lake["w_projects"], lake["w_users"])


@query("J8", """select follower, followed from v_follows f where not exists (
  select 1 from w_watchers w where 'u' || cast(w.user_id as string) = f.follower and 'u' || cast(w.repo_id as string) = f.followed)
group by 1, 2""")
def missing_rows(lake: Lake) -> DataFrame:
    """Staged pairs whose key the table lacks."""
    table = lake["w_watchers"].select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("follower"),
        F.concat(F.lit("u"), F.col("repo_id").cast("string")).alias("followed"),
    )
    return lookup.union_distinct([lake["v_follows"].select("follower", "followed")], ["follower", "followed"]).transform(
        lambda staged: changes.missing(staged, table, ["follower", "followed"])
    )


@query("J9 D11", """select u.id, u.login, p.name, p.email from w_users u left join (
  select login, name, email from w_users where email is not null) p on p.login = u.login""")
def users_with_private(lake: Lake) -> DataFrame:
    public, private = changes.split_private(lake["w_users"])
    return lookup.add_private(public, private.filter("email is not null")).select("id", "login", "name", "email")


@query("J10", """select id from w_prs r where base_repo_id <> head_repo_id and exists (
  select 1 from w_pr_commits c join w_project_commits p on p.commit_id = c.commit_id
  where c.pull_request_id = r.id and p.project_id = r.base_repo_id)""")
def merged_by_commits(lake: Lake) -> DataFrame:
    return lookup.merged_by_commits(lake["w_prs"], lake["w_pr_commits"], lake["w_project_commits"])


@query("J11", "select id from w_prs r where exists (select 1 from w_history h where h.pull_request_id = r.id and h.action = 'merged')")
def merged_by_history(lake: Lake) -> DataFrame:
    return lookup.merged_by_history(lake["w_prs"], lake["w_history"])


FAKE_USERS = """select c_custkey as id, case when c_mktsegment = 'BUILDING' then upper(translate(substr(md5(c_name), 1, 8), '0123456789', 'ghijklmnop'))
  else 'u' || cast(c_custkey as string) end as login from customer"""


ROLE_ISSUES = "select o_custkey as reporter_id, o_orderkey as assignee_id from orders where o_totalprice > 490000"


@query("J12 A10", f"""select id, login from ({FAKE_USERS}) u where regexp_matches(login, '[A-Z]{{8}}')
and not exists (select 1 from w_history h where h.actor_id = u.id)
and not exists (select 1 from ({ROLE_ISSUES}) i where i.reporter_id = u.id)
and not exists (select 1 from ({ROLE_ISSUES}) i where i.assignee_id = u.id)
and not exists (select 1 from w_watchers m where m.user_id = u.id)""")
def placeholder_accounts(lake: Lake) -> DataFrame:
    """Placeholder-shaped accounts without any role."""
    users = lake.sql(FAKE_USERS)
    tables = {"pull_request_history": lake["w_history"], "issues": lake.sql(ROLE_ISSUES), "project_members": lake["w_watchers"]}
    return lookup.fake_candidates(users, tables)


FORK_SIDES = """select p.id as fork_id, p.forked_from as parent_id, u.fork_ts from w_projects p join (
  select project_id, min(created_at) as fork_ts from w_commits group by project_id) u on u.project_id = p.id where p.forked_from is not null"""


@query("J13", f"""select f.fork_id as project_id, pc.commit_id from ({FORK_SIDES}) f join w_project_commits pc on pc.project_id = f.parent_id
join w_commits c on c.id = pc.commit_id where c.created_at < f.fork_ts""")
def parent_commits_before(lake: Lake) -> DataFrame:
    return lookup.commits_before(lake["w_project_commits"], lake["w_commits"], lake.sql(FORK_SIDES))


@query("J18", "select id, type from v_feed where id in (select user_id from events)")
def events_by_id(lake: Lake) -> DataFrame:
    ids = lake.sql("select user_id as id from events")
    return lookup.events_by_id(ids, lake["v_feed"].select("id", "type"))


@query("J19", """select o.o_orderkey, p.id as project_id, u.id as user_id from orders o
left join w_projects p on p.name = 'r' || cast(o.o_custkey + 1000 as string) left join w_users u on u.login = 'u' || cast(o.o_orderkey as string)""")
def resolved_references(lake: Lake) -> DataFrame:
    rows = lake.sql("""select o_orderkey, 'r' || cast(o_custkey + 1000 as string) as project, 'u' || cast(o_orderkey as string) as login from orders""")
    with_project = lookup.resolve_fk(rows, lake["w_projects"], {"project": "name"}, "id", "project_id")
    return lookup.resolve_fk(with_project, lake["w_users"], {"login": "login"}, "id", "user_id").select("o_orderkey", "project_id", "user_id")


@query("J20", """select i.seq, coalesce(u.login, e.login) as account from v_identities i left join w_users u on u.login = i.login
left join (select email, min(id) as id from w_users where email is not null group by email) m on m.email = i.email
left join w_users e on e.id = m.id""")
def users_by_login_or_email(lake: Lake) -> DataFrame:
    users = lake["w_users"]
    by_mail = lookup.users_by_email(users).select("email", F.col("login").alias("mail_login"))
    known = users.select("login", F.col("login").alias("found"))
    joined = lake["v_identities"].select("seq", "login", "email").join(known, "login", "left").join(by_mail, "email", "left")
    return joined.select("seq", F.coalesce("found", "mail_login").alias("account"))


# ---- aggregates ----------------------------------------------------------

RATIO_SQL = """with firsts as (select id, min({unit}) as bucket from v_events {where} group by id),
 fresh as (select bucket, count(*) as n from firsts group by bucket),
 totals as (select {unit} as bucket, count(*) as n from v_events {where} group by 1)
select cast(floor(epoch(t.bucket)) as bigint) as bucket, coalesce(f.n, 0) as new_events, t.n - coalesce(f.n, 0) as duplicate_events,
 (t.n - coalesce(f.n, 0)) / t.n as ratio from totals t left join fresh f on f.bucket = t.bucket"""


@query("S2 T1 P7 A4", """select type, cast(floor(epoch(date_trunc('day', created_at))) as bigint) as day, count(distinct id) as new_events,
 count(*) - count(distinct id) as duplicate_events from v_events where type <> 'GollumEvent' group by 1, 2""")
def handled_event_ratio(lake: Lake) -> DataFrame:
    """Handled events per type and day: new and duplicate sightings."""
    events = lookup.handled(lake["v_events"])
    sightings = events.groupBy("type", "id", F.date_trunc("day", "created_at").alias("day")).agg(F.count("*").alias("n"))
    return sightings.groupBy("type", "day").agg(F.count("*").alias("new_events"), F.sum(F.col("n") - 1).alias("duplicate_events")).select(
        "type", secs("day").alias("day"), "new_events", "duplicate_events"
    )


@query("A4", RATIO_SQL.format(unit="date_trunc('minute', created_at)", where=""))
def duplicate_ratio(lake: Lake) -> DataFrame:
    return lookup.dup_ratio(lake["v_events"]).withColumn("bucket", secs("bucket"))


@query("A1", "select count(*) as n from v_feed where type = 'WatchEvent'")
def count_by_predicate(lake: Lake) -> DataFrame:
    return lookup.count_where(lake["v_feed"], {"type": "WatchEvent"})


@query("A2", """select 'projects' as table_name, max(id) as max_id from w_projects union all select 'users', max(id) from w_users
union all select 'pull_requests', max(id) from w_prs""")
def highest_ids(lake: Lake) -> DataFrame:
    return lookup.max_ids({"projects": lake["w_projects"], "users": lake["w_users"], "pull_requests": lake["w_prs"], "watchers": lake["w_watchers"]})


@query("A3", "select distinct id from v_events")
def distinct_event_ids(lake: Lake) -> DataFrame:
    return lookup.distinct_ids(lake["v_events"])


@query("A5", """select 'events' as entity, count(*) as items from events union all select 'projects', count(*) from w_projects
union all select 'users', count(*) from w_users union all select 'commits', count(*) from w_commits
union all select 'watchers', count(*) from w_watchers union all select 'followers', count(*) from w_followers""")
def entity_counts(lake: Lake) -> DataFrame:
    names = {"projects": "w_projects", "users": "w_users", "commits": "w_commits", "watchers": "w_watchers", "followers": "w_followers"}
    return lookup.entity_counts({"events": lake["events"], **{k: lake[v] for k, v in names.items()}})


@query("A6", """select project_id, arg_min(sha, (created_at, sha)) as earliest, arg_max(sha, (created_at, sha)) as latest from w_commits group by 1""")
def first_and_last_commit(lake: Lake) -> DataFrame:
    return lookup.earliest_and_latest(lake["w_commits"], ["project_id"], "sha", "created_at")


@query("A7", """select pull_request_id, action, id from (select *, row_number() over (partition by pull_request_id, action order by created_at desc, id desc) as rn
 from w_history) h where rn = 1""")
def latest_history(lake: Lake) -> DataFrame:
    return lookup.latest(lake["w_history"], ["pull_request_id", "action"], ["created_at", "id"]).select("pull_request_id", "action", "id")


@query("A8", "select k as repo_id, actor_id as user_id, max(cast(floor(epoch(created_at)) as bigint)) as ts from v_events where type = 'WatchEvent' group by 1, 2")
def latest_star(lake: Lake) -> DataFrame:
    stars = lake.sql("select k as repo_id, actor_id as user_id, created_at as ts from v_events where type = 'WatchEvent'")
    return lookup.latest_moment(stars, ["repo_id", "user_id"], "ts").withColumn("ts", secs("ts"))


LANGUAGE_SNAPSHOTS = """select cast(substr(source, 4) as bigint) as project_id, lang as language, sum(n_chars) as bytes, doc_id % 5 as created_at
from documents group by 1, 2, 4"""


@query("A11", f"""select s.project_id, s.created_at, sum(bytes)::bigint as bytes, count(*) as languages from ({LANGUAGE_SNAPSHOTS}) s
join (select project_id, max(created_at) as latest from ({LANGUAGE_SNAPSHOTS}) t group by 1) l on l.project_id = s.project_id and l.latest = s.created_at group by 1, 2""")
def latest_languages(lake: Lake) -> DataFrame:
    return lookup.languages_latest(lake.sql(LANGUAGE_SNAPSHOTS))


# ---- ordering ------------------------------------------------------------


@query("O1", "select id, type from v_feed order by id")
def events_in_order(lake: Lake) -> DataFrame:
    return lookup.order_events(lake["v_feed"].select("id", "type"))


@query("O2", """select l_orderkey as key, arg_max(l_linenumber, (l_extendedprice, l_partkey, l_suppkey, l_linenumber)) as line from lineitem group by 1""")
def best_candidate(lake: Lake) -> DataFrame:
    rows = lake.sql("select l_orderkey as key, l_extendedprice as importance, l_partkey, l_suppkey, l_linenumber as line from lineitem")
    return lookup.best_by(rows, ["key"], "importance", ["l_partkey", "l_suppkey", "line"]).select("key", "line")


@query("O4", """select project_id, id, rank::integer as rank from (select project_id, id, row_number() over (partition by project_id order by created_at desc, id) as rank
 from w_commits) c where rank <= 3""")
def top_commits(lake: Lake) -> DataFrame:
    order = [F.col("created_at").desc(), F.col("id")]
    return lookup.top_k(lake["w_commits"], ["project_id"], order, 3).select("project_id", "id", "rank")


# ---- set operators -------------------------------------------------------


@query("U1 E28", """select o_custkey as login, min(page) as page from (select o_custkey, 0 as page from orders where o_orderstatus = 'F'
 union all select c_custkey, 1 from customer) p group by 1""")
def combined_pages(lake: Lake) -> DataFrame:
    first = lake.sql("select o_custkey as login, 0 as page from orders where o_orderstatus = 'F'")
    second = lake.sql("select c_custkey as login, 1 as page from customer")
    return lookup.union_distinct([first, second], ["login"])


@query("U2 R3", """select pull_request_id, commit_id from w_pr_commits c where pull_request_id not in (select o_orderkey from orders where o_orderstatus = 'F')
union all select o_orderkey, o_custkey from orders where o_orderstatus = 'F'""")
def replaced_commit_sets(lake: Lake) -> DataFrame:
    fresh = lake.sql("select o_orderkey as pull_request_id, o_custkey as commit_id from orders where o_orderstatus = 'F'")
    return lookup.replace_set(lake["w_pr_commits"], fresh, ["pull_request_id"])


@query("U3", """select distinct project_id, topic_name from w_topics t where snapshot = 0 and project_id in (select project_id from w_topics where snapshot = 1)
and not exists (select 1 from w_topics n where n.snapshot = 1 and n.project_id = t.project_id and n.topic_name = t.topic_name)""")
def unlisted_topics(lake: Lake) -> DataFrame:
    topics = lake["w_topics"]
    stored, listed = topics.filter("snapshot = 0").select("project_id", "topic_name").distinct(), topics.filter("snapshot = 1")
    return lookup.no_longer_listed(stored, listed, listed, ["project_id"], ["topic_name"])


@query("U4", "select project_id, commit_id from w_project_commits union select project_id, id from w_commits")
def backfilled_commits(lake: Lake) -> DataFrame:
    return lookup.backfill_project_commits(lake["w_project_commits"], lake["w_commits"])


# ---- keys and table changes ----------------------------------------------


@query("K1", """select login, (select max(id) from w_users) + row_number() over (order by substr(md5(login), 1, 3), login) as id
from (select distinct login from v_identities where login like 'gone%') g""")
def dense_ids(lake: Lake) -> DataFrame:
    names = lake["v_identities"].filter("login like 'gone%' or login like 'u%'").select("login")
    return keys.assign_dense_ids(names, lake["w_users"], ["login"])


@query("D1", """select owner, name, 0 as origin from v_projects union all
select owner, name, min(id) + 1 from v_feed f where not exists (select 1 from v_projects p where p.owner = f.owner and p.name = f.name) group by 1, 2""")
def inserted_if_absent(lake: Lake) -> DataFrame:
    table = lake.sql("select owner, name, cast(0 as bigint) as origin from v_projects")
    rows = lake.sql("select owner, name, id + 1 as origin from v_feed")
    return changes.insert_missing(table, rows, ["owner", "name"], ["origin"])


@query("D2", """with ch as (select o_custkey as id, arg_max(o_orderpriority, o_orderkey) filter (where o_orderstatus = 'F') as company,
   count(*) filter (where o_orderstatus = 'F') as n_company,
   arg_max(o_totalprice, o_orderkey) filter (where o_orderstatus <> 'P') as balance, count(*) filter (where o_orderstatus <> 'P') as n_balance from orders group by 1)
select coalesce(c.c_custkey, ch.id) as id, case when n_company > 0 then nullif(company, '5-LOW') else c.c_mktsegment end as company,
  case when n_balance > 0 then balance else c.c_acctbal end as balance
from customer c full outer join ch on ch.id = c.c_custkey""")
def upserted_fields(lake: Lake) -> DataFrame:
    """Records set some fields each; a field set to null stays null, an absent one is kept."""
    table = lake.sql("select c_custkey as id, c_mktsegment as company, c_acctbal as balance from customer")
    rows = lake.sql("""select o_custkey as id, o_orderkey as seq, nullif(o_orderpriority, '5-LOW') as company, o_totalprice as balance,
      case o_orderstatus when 'F' then array('company', 'balance') when 'O' then array('balance') else array() end as present from orders""")
    return changes.upsert(table, rows, ["id"], ["seq"], "present").select("id", "company", "balance")


@query("D3", "select o_orderkey, o_orderstatus from orders where not (o_orderstatus = 'P' and o_totalprice > 1000)")
def deleted_rows(lake: Lake) -> DataFrame:
    kept, _ = changes.delete(lake["orders"], F.expr("o_orderstatus = 'P' and o_totalprice > 1000"))
    return kept.select("o_orderkey", "o_orderstatus")


@query("D4", """select c_custkey as id, c_name as name from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')
union all select o_custkey, 'fresh ' || cast(max(o_orderkey) as string) from orders where o_orderstatus = 'F' group by 1""")
def replaced_rows(lake: Lake) -> DataFrame:
    table = lake.sql("select c_custkey as id, c_name as name from customer")
    rows = lake.sql("select o_custkey as id, 'fresh ' || cast(max(o_orderkey) as string) as name from orders where o_orderstatus = 'F' group by 1")
    return changes.replace(table, rows, ["id"])


@query("D5", """select u.id, u.login, coalesce(u.email, f.email) as email from w_users u left join (
  select login, min(email) as email from v_identities where login is not null group by 1) f on f.login = u.login""")
def filled_nulls(lake: Lake) -> DataFrame:
    fills = lake.sql("select login, min(email) as email from v_identities where login is not null group by 1")
    return changes.fill_null(lake["w_users"], fills, ["login"], ["email"]).select("id", "login", "email")


@query("D6", "select id, id in (select o_custkey from orders where o_orderstatus = 'F') as deleted from w_users")
def soft_deleted(lake: Lake) -> DataFrame:
    gone = lake.sql("select o_custkey as id from orders where o_orderstatus = 'F'")
    return changes.soft_delete(lake["w_users"], gone, ["id"]).select("id", "deleted")


@query("D7", """select follower_id, user_id, max(cast(floor(epoch(created_at)) as bigint)) as created_at from (
  select follower_id, user_id, created_at from w_followers union all
  select actor_id, k, created_at + interval 3 days from v_events where type = 'WatchEvent') f group by 1, 2""")
def later_dates(lake: Lake) -> DataFrame:
    rows = lake.sql("select actor_id as follower_id, k as user_id, created_at + interval 3 days as created_at from v_events where type = 'WatchEvent'")
    moved = changes.update_later(lake["w_followers"], rows, ["follower_id", "user_id"], "created_at")
    return moved.withColumn("created_at", secs("created_at"))


@query("D8", "select project_id, commit_id from w_project_commits where project_id not in (select id from w_projects where forked_from is not null)")
def cascaded_delete(lake: Lake) -> DataFrame:
    forks = lake["w_projects"].filter("forked_from is not null").select(F.col("id").alias("project_id"))
    return changes.delete_by_join(lake["w_project_commits"], forks, ["project_id"])


@query("D9", """select 'user' as kind, id, login as name from w_users union all select 'user', -1, '0xnoone'
union all select 'project', id, name from w_projects union all select 'project', -1, 'noproject'""")
def sentinel_rows(lake: Lake) -> DataFrame:
    users, projects = changes.with_sentinels(*changes.with_sentinels(lake["w_users"], lake["w_projects"]))
    return users.select(F.lit("user").alias("kind"), "id", F.col("login").alias("name")).unionByName(
        projects.select(F.lit("project").alias("kind"), "id", "name")
    )


@query("D10 X3", """select id, case when updated_at <= timestamp '2001-09-01 00:00:00' - interval 10 days and language = 'ECONOMY'
 then 999302400 else cast(floor(epoch(updated_at)) as bigint) end as updated_at from w_projects""")
def touched_projects(lake: Lake) -> DataFrame:
    projects = lake["w_projects"]
    now = F.lit("2001-09-01 00:00:00").cast("timestamp_ntz")
    return refresh_stale(projects, projects.filter("language = 'ECONOMY'"), now).select("id", secs("updated_at").alias("updated_at"))


@query("D12", """select * from (select 'watchers' as table_name, 'user_id' as column_name, count(*) as violations from w_watchers where user_id not in (select id from w_users)
union all select 'watchers', 'repo_id', count(*) from w_watchers where repo_id not in (select id from w_projects)
union all select 'pull_requests', 'head_repo_id', count(*) from w_prs where head_repo_id not in (select id from w_projects)
union all select 'pull_requests', 'base_repo_id', count(*) from w_prs where base_repo_id not in (select id from w_projects)
union all select 'pull_request_history', 'pull_request_id', count(*) from w_history where pull_request_id not in (select id from w_prs)
union all select 'pull_request_commits', 'pull_request_id', count(*) from w_pr_commits where pull_request_id not in (select o_orderkey from orders where o_orderstatus = 'F')
) v where violations > 0""")
def broken_references(lake: Lake) -> DataFrame:
    prs = lake["w_prs"]
    tables = {"users": lake["w_users"], "projects": lake["w_projects"], "watchers": lake["w_watchers"], "pull_requests": prs, "pull_request_history": lake["w_history"]}
    references = [r for r in schemas.FOREIGN_KEYS if r[0] in ("watchers", "pull_request_history") or r[1] in ("head_repo_id", "base_repo_id")]
    general = changes.check_fks(tables, references)
    kept = lake.sql("select o_orderkey as id from orders where o_orderstatus = 'F'")
    return general.unionByName(changes.check_fks(
        {"pull_request_commits": lake["w_pr_commits"], "pull_requests": kept}, [("pull_request_commits", "pull_request_id", "pull_requests")]
    ))


@query("D13 K2", """select 'commits' as table_name, count(*) as repeated_keys, sum(n - 1)::bigint as surplus_rows from (
  select sha, count(*) as n from v_commits group by 1) c where n > 1
union all select 'issue_labels', count(*), sum(n - 1)::bigint from (select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2) l where n > 1""")
def repeated_keys(lake: Lake) -> DataFrame:
    tables = {
        "commits": lake["v_commits"], "users": lake["w_users"], "watchers": lake["w_watchers"],
        "issue_labels": lake.sql("select l_orderkey as label_id, l_linenumber as issue_id from lineitem"),
    }
    return changes.check_unique(tables)
