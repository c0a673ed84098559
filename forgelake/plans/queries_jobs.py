"""Log analytics, dumps, synchronisation, repair and streaming over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.operators import logs, lookup, repair, sync
from forgelake.plans.catalog import query, secs
from forgelake.plans.queries_builders import HISTORY_SQL, HISTORY_TOLERANCE, NOW_SECS, RAW_COMMENTS, now
from forgelake.plans.views import Lake
from forgelake.schemas import struct_of, table_schema
from forgelake.session import cut_lineage, new_path
from forgelake.sources import dump
from forgelake.sources.entities import json_reader, read_entity, read_events, read_worklist
from forgelake.sources.logs import keep_log_lines, read_logs, write_points
from forgelake.sources.tables import TableSet
from forgelake.streaming import jobs, ratio

# ---- logs ----------------------------------------------------------------

LOG_PARTS = """select event_id as id, case when event_type = 'error' then 'WARN' when event_type = 'view' then 'DEBUG' else 'INFO' end as severity,
  cast(cast(ts as date) as varchar) || 'T00:00:00Z' as time, 'w' || cast(user_id % 8 as varchar) as client, 'api_client' as stage,
  event_type = 'error' as failed, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k, user_id from events"""
REQUEST_SQL = f"""select 'api_client' as series, time, severity, client, 'success' as outcome, 'elapsed' as metric, user_id as value from ({LOG_PARTS}) l where not failed and severity <> 'DEBUG'
union all select 'api_client', time, severity, client, 'success', 'remaining', k from ({LOG_PARTS}) l where not failed and severity <> 'DEBUG'
union all select 'api_client', time, severity, client, 'error', 'error_code', 404 from ({LOG_PARTS}) l where failed
union all select 'api_client', time, severity, client, 'error', 'remaining', k from ({LOG_PARTS}) l where failed"""


@query("S8 P10", "select id, line from v_logs union all select -id, 'Info: ' || line from v_logs where line like 'WARN%'")
def log_lines(lake: Lake) -> DataFrame:
    rows = lake.sql("select id, line from v_logs union all select -id, 'Info: ' || line from v_logs where line like 'WARN%' union all select id, 'pretty ' || line from v_logs")
    return keep_log_lines(rows)


@query("G1", f"select id, severity, time, client, stage, true as is_parsed from ({LOG_PARTS}) l union all select -id, null, null, null, null, false from ({LOG_PARTS}) l where failed")
def parsed_logs(lake: Lake) -> DataFrame:
    rows = lake.sql("select id, line from v_logs union all select -id, 'Exception without a format' from v_logs where line like 'WARN%'")
    return logs.parse_logs(rows).select("id", "severity", "time", "client", "stage", "is_parsed")


@query("G2 P10", REQUEST_SQL)
def request_points(lake: Lake) -> DataFrame:
    points = logs.request_points(logs.parse_logs(lake["v_logs"]))
    return points.select("series", "time", "severity", "client", "outcome", "metric", "value")


@query("G3", """select case when event_type = 'error' then 'error' else 'success' end as outcome, event_type as evt_type, user_id as value from events where event_type <> 'view'""")
def processing_points(lake: Lake) -> DataFrame:
    lines = lake.sql("""select case when event_type = 'view' then 'DEBUG' else 'INFO' end || ', 2024-01-01T00:00:00Z, w1 -- data_retrieval.rb: '
      || case when event_type = 'error' then 'Error' else 'Success' end || ' processing event. Type: ' || event_type || 'Event, ID: ' || event_id || ', Time: ' || user_id || ' ms' as line from events""")
    return logs.processing_points(logs.parse_logs(lines)).select("outcome", "evt_type", "value")


@query("G4", """select case event_type when 'view' then 'retriever' when 'click' then 'mirror' when 'signup' then 'mirror' when 'purchase' then 'repo_updater' else 'full_user_retriever' end as series,
  case event_type when 'view' then 'success' when 'click' then 'success' when 'signup' then 'failure' end as outcome,
  case event_type when 'view' then 'repo' when 'click' then 'user' when 'signup' then 'commit_comment' end as entity,
  case event_type when 'purchase' then 'updated' when 'error' then 'deleted' end as action, count(*) as n from events group by 1, 2, 3, 4""")
def outcome_points(lake: Lake) -> DataFrame:
    lines = lake.sql("""select 'INFO, 2024-01-01T00:00:00Z, w1 -- ' || case event_type
        when 'view' then 'retriever.rb: Added repo o -> r' when 'click' then 'mirror.rb: Added user u' when 'signup' then 'mirror.rb: Could not retrieve commit_comment 1. Deleted?'
        when 'purchase' then 'repo_updater.rb: Repo o/r updated' else 'full_user_retriever.rb: User u marked as deleted' end as line from events
      union all select 'INFO, 2024-01-01T00:00:00Z, w1 -- mirror.rb: nothing of note' from events""")
    points = logs.outcome_points(logs.parse_logs(lines))
    return points.groupBy("series", "outcome", "entity", "action").agg(F.sum("value").alias("n"))


@query("G7", f"""select series, client, outcome, metric, severity, cast(floor(epoch(cast(substr(time, 1, 10) as date))) as bigint) as bucket, count(*) as n, round(avg(value), 4) as mean, max(value) as highest
from ({REQUEST_SQL}) p group by 1, 2, 3, 4, 5, 6""")
def point_rollup(lake: Lake) -> DataFrame:
    rolled = logs.rollup(logs.all_points(logs.parse_logs(lake["v_logs"])))
    return rolled.select("series", "client", "outcome", "metric", "severity", secs("bucket").alias("bucket"), "n", F.round("mean", 4).alias("mean"), "highest")


WORKER_PARTS = """select event_id as seq, user_id % 8 as pid, cast(floor(epoch(ts)) as bigint) as ts, event_type as kind, k, user_id from (
  select event_id, user_id, ts, event_type, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from events) e"""
WORKER_LINES = """select event_id as seq, case event_type
  when 'error' then '[x #' || pid || '] WARN api_client.rb: 404 Not Found'
  when 'signup' then '[' || day || '.1 #' || pid || '] INFO api_client.rb: sleeping for ' || k || ' seconds'
  else '[' || day || '.1 #' || pid || '] DEBUG api_client.rb: [10.0.0.' || k || '] Request: https://api.github.com/repos/o/r' || (k % 3) || '/commits?page=1 (' || k || ' remaining) took ' || user_id || ' ms' end as line
from (select event_id, event_type, user_id, user_id % 8 as pid, date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") as day, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from v_dealt_events) e"""
WORKER_SQL = f"""with l as ({WORKER_PARTS}), r as (select *, 'o/r' || cast(k % 3 as varchar) as repo from l where kind not in ('error', 'signup')),
 last as (select pid, arg_max(repo, seq) as repo, max(seq) as seq, arg_max(k, seq) as remaining from r group by 1),
 other as (select r.pid, max(r.seq) as seq from r join last on last.pid = r.pid and r.repo <> last.repo group by 1),
 start as (select r.pid, min(r.seq) as seq, arg_min(r.ts, r.seq) as ts from r left join other o on o.pid = r.pid where o.seq is null or r.seq > o.seq group by 1)
select cast(l.pid as varchar) as pid, case when arg_max(l.kind, l.seq) filter (where l.kind <> 'error') = 'signup' then 'S' else 'A' end as status, max(last.repo) as repo, max(last.remaining) as remaining,
 count(*) filter (where l.kind = 'error' and l.seq > start.seq) as not_found, arg_max(l.ts, l.seq) filter (where l.kind <> 'error') - max(start.ts) as time_in,
 arg_max(l.k, l.seq) filter (where l.kind = 'signup') as sleep_remaining
from l join last on last.pid = l.pid join start on start.pid = l.pid group by l.pid"""
STATE = ["pid", "status", "repo", "remaining", "not_found", "time_in", "sleep_remaining"]


@query("G5 O3", WORKER_SQL)
def worker_states(lake: Lake) -> DataFrame:
    """State of each worker after its last line; active ones by time in task, then sleeping ones."""
    parsed = cut_lineage(logs.parse_worker_lines(lake.sql(WORKER_LINES)), "worker_lines")
    return logs.ordered_workers(logs.worker_latest(parsed)).select(*STATE)


@query("G6", f"""select cast(pid as varchar) as pid, count(*) as requests, round(avg(user_id), 6) as mean_ms, max(user_id) as max_ms from (
  select *, row_number() over (partition by pid order by seq desc) as rn from ({WORKER_PARTS}) l where kind not in ('error', 'signup')) r where rn <= 100 group by 1""")
def recent_latency(lake: Lake) -> DataFrame:
    rows = logs.recent_latency(logs.parse_worker_lines(lake.sql(WORKER_LINES)))
    return rows.withColumn("mean_ms", F.round("mean_ms", 6))


@query("S9", REQUEST_SQL)
def stored_points(lake: Lake) -> DataFrame:
    """Points written to the partitioned store and read back."""
    path = new_path(lake.spark, "points")
    write_points(logs.request_points(logs.parse_logs(lake["v_logs"])), path)
    rows = lake.spark.read.parquet(path)
    tag = lambda name: F.col("tags")[name].alias(name)
    return rows.select("series", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"), tag("severity"), tag("client"), tag("outcome"), tag("metric"), "value")


# ---- sources and dumps ---------------------------------------------------


@query("S1", "select owner, name, case when parent is not null then 'u' || substr(parent, 2) end as parent_owner from v_projects")
def repo_collection(lake: Lake) -> DataFrame:
    """A raw collection written as JSON lines and read by name."""
    path = new_path(lake.spark, "repos")
    lake.sql("""select to_json(named_struct('name', name, 'owner', named_struct('login', owner), 'unread', description,
      'parent', case when parent is not null then named_struct('name', parent, 'owner', named_struct('login', 'u' || substr(parent, 2))) end)) as value from v_projects""").write.text(path)
    return read_entity(lake.spark, "repos", path).select(F.col("owner.login").alias("owner"), "name", F.col("parent.owner.login").alias("parent_owner"))


@query("S2", "select type, count(*) as n, sum(case when type = 'PushEvent' then n_commits else 0 end)::bigint as commits from v_feed group by 1")
def event_feed(lake: Lake) -> DataFrame:
    events = read_events(lake.spark, lake.feed_files())
    return events.groupBy("type").agg(F.count("*").alias("n"), F.sum(F.coalesce(F.size("payload.commits"), F.lit(0))).cast("bigint").alias("commits"))


@query("S10", "select owner as item, name as repo from v_projects where language <> 'SMALL'")
def open_worklist(lake: Lake) -> DataFrame:
    """Work list lines without those done already."""
    path = new_path(lake.spark, "worklist")
    lake.sql("select owner || ' ' || name as value from v_projects union all select owner || '  ' || name from v_projects").write.text(path)
    done = lake.sql("select owner as item, name as repo from v_projects where language = 'SMALL'")
    return read_worklist(lake.spark, path, done)


@query("S4 S5 D11 F11", """select id, login, type, fake, location, cast(floor(epoch(created_at)) as bigint) as created_at from w_users""")
def dump_round_trip(lake: Lake) -> DataFrame:
    """Users written as a dump, public part read back."""
    path = new_path(lake.spark, "dump")
    users = lake["w_users"]
    shaped = users.select(*[(F.col(f"`{f.name}`") if f.name in users.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in table_schema("users").fields])
    dump.write_dump({"users": shaped}, path)
    return dump.read_dump(lake.spark, path, "users").select("id", "login", "type", "fake", "location", secs("created_at").alias("created_at"))


@query("S4 S5", "select doc_id, lang, text, source from documents")
def text_dump_round_trip(lake: Lake) -> DataFrame:
    """Whole texts with quotes, backslashes and line breaks through the dump format."""
    path = new_path(lake.spark, "dump")
    docs = lake.sql("select doc_id, lang, text, source from documents")
    dump.dump_lines(docs, ["doc_id", "lang", "text", "source"]).write.text(path)
    rows = dump.read_text_dump(lake.spark, path, ["doc_id", "lang", "text", "source"])
    return rows.withColumn("doc_id", F.col("doc_id").try_cast("bigint"))


@query("S5", r"""select '"' || cast(o_orderkey as varchar) || '","' || case when o_orderstatus = 'F' then '1' else '0' end || '",' || case when o_orderstatus = 'P' then '\N' else '"' || o_orderpriority || '\"' || '"' end as value from orders""")
def dump_lines(lake: Lake) -> DataFrame:
    rows = lake.sql("""select o_orderkey, o_orderstatus = 'F' as flag, case when o_orderstatus <> 'P' then concat(o_orderpriority, '"') end as label from orders""")
    return dump.dump_lines(rows, ["o_orderkey", "flag", "label"])


@query("S6", r"""select doc_id, replace(replace(replace(text, chr(10), ' '), chr(13), ' '), '\', '\ ') as text, '1970-01-01 00:00:00' as created_at from documents""")
def repaired_texts(lake: Lake) -> DataFrame:
    return dump.normalise_dump(lake.sql("select doc_id, text, '0000-00-00 00:00:00' as created_at from documents"))


def load_orders(lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Orders loaded from text, and the rejected rows."""
    path, rejects = new_path(lake.spark, "load"), new_path(lake.spark, "rejects")
    lake.sql("select o_orderkey || ',' || case when o_orderstatus = 'P' and o_totalprice >= 490000 then 'word' else cast(o_custkey as string) end as value from orders").write.text(path)
    loaded = dump.load_typed(lake.spark, path, struct_of("id bigint, k bigint"), new_path(lake.spark, "loaded"), rejects, max_bad=None)
    return loaded, lake.spark.read.parquet(rejects)


@query("S7", "select o_orderkey as id, o_custkey as k from orders where o_orderstatus <> 'P' or o_totalprice < 490000")
def typed_load(lake: Lake) -> DataFrame:
    """Rows with a word in a number column go to the reject folder."""
    return load_orders(lake)[0]


@query("S7", "select cast(o_orderkey as varchar) as id, 'word' as k, 'k' as reason from orders where o_orderstatus = 'P' and o_totalprice >= 490000")
def rejected_rows(lake: Lake) -> DataFrame:
    """What a load leaves out: source texts and the column at fault."""
    return load_orders(lake)[1]


@query("S11", """select 'users' as name, count(*) as n, 2::bigint as version from w_users union all select 'projects', count(*), 2 from w_projects union all select 'watchers', count(*), 2 from w_watchers""")
def table_versions(lake: Lake) -> DataFrame:
    """Two versions of a table set; readers see the newest complete one, a repeated batch is ignored."""
    store = TableSet(lake.spark, new_path(lake.spark, "tables"))
    store.write_all({"users": lake["w_users"], "projects": lake["w_projects"]}, 1)
    base = store.read_all()
    store.write_all({**base, "watchers": lake["w_watchers"]}, 2, base)
    store.write_all({"users": lake["w_users"].limit(0)}, 2)
    tables = store.read_all()
    counts = lookup.entity_counts({n: tables[n] for n in ("users", "projects", "watchers")})
    return counts.select(F.col("entity").alias("name"), F.col("items").alias("n"), F.lit(store.current()).cast("bigint").alias("version"))


# ---- synchronisation -----------------------------------------------------

RAW_STORE = "select owner, name, description from v_projects where language in ('SMALL', 'PROMO')"
FEED = "select owner, name, description, language, parent, updated_at, language = 'PROMO' as is_error from v_projects where updated_at > timestamp '2001-08-15 00:00:00'"
STORE = "select u.login as owner, p.* from w_projects p join w_users u on u.id = p.owner_id where p.language <> 'ECONOMY'"
PRESENCE_SQL = f"""with raw as ({RAW_STORE}), feed as ({FEED}), t as ({STORE}), k as (select owner, name from raw union select owner, name from feed union select owner, name from t)
select k.owner, k.name, raw.name is not null as in_raw, coalesce(not feed.is_error, false) as in_feed, t.name is not null as in_table, coalesce(feed.is_error, false) as is_failed,
 case when coalesce(feed.is_error, false) then 'none' when feed.name is not null and t.name is not null then 'update' when feed.name is not null then 'insert' when t.name is not null then 'delete' else 'none' end as action,
 case when feed.name is null or feed.is_error then 'none' when raw.name is not null then 'replace' else 'store' end as raw_action
from k left join raw on raw.owner = k.owner and raw.name = k.name left join feed on feed.owner = k.owner and feed.name = k.name left join t on t.owner = k.owner and t.name = k.name"""


@query("X1 J15", PRESENCE_SQL)
def sync_decisions(lake: Lake) -> DataFrame:
    """Presence in raw store, feed and table, and the action for each project."""
    return sync.full_presence(lake.sql(RAW_STORE), lake.sql(FEED), lake.sql(STORE))


@query("X1 D2 D4 D6", f"""with p as ({PRESENCE_SQL})
select p.owner, p.name, p.action = 'delete' as deleted, p.action in ('insert', 'update') as is_fresh,
 case when p.action in ('insert', 'update') then case when v.parent is null then null when exists (select 1 from p q where q.name = v.parent and (q.in_table or q.action = 'insert')) then true else false end
   else s.forked_from is not null end as has_parent
from p join v_projects v on v.owner = p.owner and v.name = p.name join w_projects s on s.name = p.name where p.in_table or p.action = 'insert'""")
def synced_projects(lake: Lake) -> DataFrame:
    """The projects table after synchronisation."""
    users = lake["w_users"]
    projects = lake["w_projects"].filter("language <> 'ECONOMY'")
    feed = lake.sql(FEED).select(
        "owner", "name", "description", "language", "is_error", F.lit("url").alias("url"), F.col("updated_at").alias("created_at"),
        F.col("parent").alias("parent_name"), F.concat(F.lit("u"), F.substr("parent", F.lit(2))).alias("parent_owner"),
    )
    points = lake.sql("select owner, name, cast(null as bigint) as fork_commit_id from v_projects")
    synced = sync.sync_projects(projects, users, lake.sql(RAW_STORE), feed, points, now())
    owned = lookup.project_lookup(synced.projects, users)
    fresh = secs("updated_at") == NOW_SECS
    parent = F.when(fresh, F.when(F.col("forked_from").isNotNull(), F.col("forked_from") >= 0)).otherwise(F.col("forked_from").isNotNull())
    return owned.select("owner", "name", "deleted", fresh.alias("is_fresh"), parent.alias("has_parent"))


@query("X1 E7 D8", """select project_id, commit_id from w_project_commits where project_id not in (select id from w_projects where forked_from is not null)
union select f.id, pc.commit_id from w_projects f join w_project_commits pc on pc.project_id = f.forked_from""")
def rebuilt_fork_commits(lake: Lake) -> DataFrame:
    forks = lake["w_projects"].filter("forked_from is not null").select(F.col("id").alias("project_id"), "forked_from")
    inherited = lake["w_project_commits"].withColumnRenamed("project_id", "forked_from").join(forks, "forked_from").select("project_id", "commit_id")
    return sync.rebuild_fork_commits(lake["w_project_commits"], forks.select("project_id"), inherited)


# ---- repair --------------------------------------------------------------

RAW_PR_COMMENTS = """select cast(user_id as string) as id, event_id as seq, case when event_type = 'view' then cast(k as string) end as pullreq_id,
  case when event_type in ('click', 'view') then cast(k + 1 as string) end as issue_id from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from events) e"""


@query("R1 F14", f"""select cast(id as bigint) as id, case event_type when 'view' then k when 'click' then k + 1 end as pullreq_id from (
  select user_id as id, event_type, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k, row_number() over (partition by user_id order by event_id desc) as rn from events) e where rn = 1""")
def unique_review_comments(lake: Lake) -> DataFrame:
    repaired = repair.unique_pr_comments(lake.sql(RAW_PR_COMMENTS))
    return repaired.table.select(F.col("id").cast("bigint").alias("id"), "pullreq_id")


@query("R1 A9", """select count(*) as processed, sum(n - 1)::bigint as duplicates, count(*) filter (where last <> 'view') as no_pullreq_id, count(*) filter (where last not in ('view', 'click')) as no_number
from (select user_id, count(*) as n, arg_max(event_type, event_id) as last from events group by 1) e""")
def review_comment_counters(lake: Lake) -> DataFrame:
    return repair.unique_pr_comments(lake.sql(RAW_PR_COMMENTS)).counts


COMMIT_URLS = """select sha, 'https://api.github.com/repos/u' || cast(cast(substr(project, 2) as bigint) % 150 as string) || '/' || case when pos > 5 then 'gone' else project end || '/commits/' || sha as url
from (select sha, max(project) as project, max(pos) as pos from v_commits group by 1)"""


@query("R2 F7", """select c.id, case when m.pos > 5 then null else p.id end as project_id from w_commits c join (select sha, max(project) as project, max(pos) as pos from v_commits group by 1) m on m.sha = c.sha
left join w_projects p on p.name = m.project and p.owner_id in (select id from w_users)""")
def commit_ownership(lake: Lake) -> DataFrame:
    fixed = repair.commit_owners(lake["w_commits"], lake.sql(COMMIT_URLS), lake["w_projects"], lake["w_users"])
    return fixed.table.select("id", "project_id")


@query("R2 D8", "select project_id, commit_id from w_project_commits where commit_id % 8 > 5 or commit_id % 8 = 0")
def dropped_associations(lake: Lake) -> DataFrame:
    return repair.drop_associations(lake["w_project_commits"], lake["w_commits"], lake.sql("select distinct sha, 'x' as url from v_commits where pos between 1 and 5"))


@query("R4 A9 P11", """select id, forked_from from (select p.id, case when v.parent is not null then q.id end as forked_from from w_projects p join v_projects v on v.name = p.name left join w_projects q on q.name = v.parent) f""")
def repaired_fork_parents(lake: Lake) -> DataFrame:
    broken = lake["w_projects"].withColumn("forked_from", F.when(F.col("language") == "SMALL", F.col("forked_from")).when(F.col("language") == "PROMO", F.when(F.col("forked_from").isNotNull(), F.lit(0))))
    repos = lake.sql("select owner, name, case when parent is not null then 'u' || substr(parent, 2) end as parent_owner, parent as parent_name from v_projects")
    return repair.fork_parents(broken, repos, lake["w_users"]).table.select("id", "forked_from")


@query("R5 E17", """select h.pull_request_id, h.action, h.created_at, h.actor_id from (
 select number as pull_request_id, 'opened' as action, cast(floor(epoch(created_at)) as bigint) as created_at, cast(substr(author, 2) as bigint) as actor_id from v_prs
 union all select number, 'merged', cast(floor(epoch(created_at)) as bigint), cast(substr(author, 2) as bigint) from v_prs where merged) h""")
def rebuilt_histories(lake: Lake) -> DataFrame:
    """Histories of listed pull requests dropped and rebuilt from their records."""
    raw = lake.sql("""select 'u' || substr(base, 2) as owner, base as repo, number, cast(created_at as string) as created_at, case when merged then cast(created_at as string) end as merged_at,
      cast(null as string) as closed_at, named_struct('login', author) as user, named_struct('login', author) as merged_by from v_prs""")
    table = lake.sql("select number as id, number as pull_request_id, cast(created_at as timestamp) as created_at, 'closed' as action, cast(null as bigint) as actor_id from v_prs")
    rows = repair.rebuild_history(table, raw, lake["w_prs"], lake["w_projects"], lake["w_users"])
    return rows.select("pull_request_id", "action", secs("created_at").alias("created_at"), "actor_id")


@query("R5 J7 J18", """select id, pull_request_id, action from w_history union all
select (select max(id) from w_history) + row_number() over (order by substr(md5(cast(number as varchar) || chr(1) || 'reopened' || chr(1) || strftime(created_at, '%Y-%m-%d %H:%M:%S')), 1, 3), number), number, 'reopened' from v_prs where merged and number >= 150""")
def backfilled_histories(lake: Lake) -> DataFrame:
    """Actions of stored events, picked by id, added to the histories."""
    events = lake.sql("select 'u' || substr(base, 2) as owner, base as repo, number, 'reopened' as action, author as actor, created_at, number as id from v_prs where number >= 150")
    ids = lake.sql("select number as id from v_prs where merged")
    history = lake["w_history"].withColumn("created_at", F.col("created_at").cast("timestamp"))
    rows = repair.backfill_history(history, ids, events, lake["w_prs"], lake["w_projects"], lake["w_users"])
    return rows.select("id", "pull_request_id", "action")


@query("R7", "select id, login, login not in (select login from v_users where type = 'User') as fake from w_users")
def fake_flags(lake: Lake) -> DataFrame:
    accounts = lake.sql("select login from v_users where type = 'User'")
    return repair.fake_flags(lake["w_users"], accounts).select("id", "login", "fake")


@query("R8 D3", """select m.issue * 1000 + m.comment_id as comment_id, substr(m.body, 1, 256) as body from v_comments m join w_commits c on c.id = m.issue * 8 + 1 join w_users u on u.id = m.issue
union all select -issue - 1, 'kept' from v_comments where comment_id = 0 and issue <> 5""")
def reloaded_comments(lake: Lake) -> DataFrame:
    """Comments deleted and loaded again by key; others stay, one is deleted."""
    stored = lake.sql("""select issue as id, issue as commit_id, issue as user_id, 'old' as body, issue * 1000 + comment_id as comment_id from v_comments where comment_id = 1 and issue < 1
      union all select issue + 1000, issue, issue, 'kept', -issue - 1 from v_comments where comment_id = 0""")
    kept = repair.delete_comment(stored, -6)
    return repair.reload_comments(kept, lake.sql(RAW_COMMENTS), lake["w_commits"], lake["w_users"]).select("comment_id", "body")


@query("R9", "select id, coalesce((select min(o_orderkey) from orders where o_custkey = p.id and o_orderkey in (select min(o_orderkey) from orders group by o_custkey) and o_orderkey in (select id from w_projects)), p.forked_from) as forked_from from w_projects p")
def fork_column(lake: Lake) -> DataFrame:
    edges = lake.sql("select o_custkey as forked_project_id, o_orderkey as forked_from_id from orders")
    return repair.fork_column(lake["w_projects"], edges).select("id", "forked_from")


@query("R10 J10 J11", """select id, coalesce(base_repo_id = head_repo_id, false) as intra_branch,
 (base_repo_id <> head_repo_id and exists (select 1 from w_pr_commits c join w_project_commits p on p.commit_id = c.commit_id where c.pull_request_id = r.id and p.project_id = r.base_repo_id)) is true
 or exists (select 1 from w_history h where h.pull_request_id = r.id and h.action = 'merged') as merged from w_prs r""")
def merge_flags(lake: Lake) -> DataFrame:
    rows = repair.merge_flags(lake["w_prs"], lake["w_pr_commits"], lake["w_project_commits"], lake["w_history"])
    return rows.select("id", "intra_branch", "merged")


# ---- streaming -----------------------------------------------------------


def split_files(lake: Lake, sql: str, files: int = 3) -> str:
    """Rows as several files, the input of a stream with several batches."""
    path = new_path(lake.spark, "stream-input")
    lake.sql(sql).repartition(files, "id").write.parquet(path)
    return path


def stream_of(lake: Lake, path: str, files_per_batch: int | None = 1) -> DataFrame:
    schema = lake.spark.read.parquet(path).schema
    reader = lake.spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


@query("T1 T7", "select distinct id, type from v_events")
def stream_dedup(lake: Lake) -> DataFrame:
    """Events with planted copies as a stream; copies within the delay are dropped."""
    path = split_files(lake, "select id, type, cast(created_at as timestamp) as created_at from v_events")
    out = new_path(lake.spark, "deduplicated")
    stream = jobs.dedup_stream(stream_of(lake, path), "60 days")
    jobs.run_to_end(stream, lambda batch, n: jobs.append_batch(out, n, batch), new_path(lake.spark, "checkpoint"))
    return lake.spark.read.parquet(out).select("id", "type")


@query("T1 T5", "select distinct id, type from v_events")
def stream_exact_dedup(lake: Lake) -> DataFrame:
    """All-time dedup against the stored events, however late a copy is."""
    path = new_path(lake.spark, "stream-input")
    lake.sql("select id, type, copy from v_events").repartition(2, "copy").write.parquet(path)
    out = new_path(lake.spark, "exact")
    jobs.run_to_end(stream_of(lake, path).select("id", "type"), jobs.exact_dedup_sink(out), new_path(lake.spark, "checkpoint"))
    return lake.spark.read.parquet(out).select("id", "type")


@query("T2 F17", """select 'evt.projects' as route_key, replace(repo, '/', ' ') as message, count(*) as n from v_feed group by 1, 2
union all select 'evt.' || type, cast(id as varchar), 1 from v_feed where type in ('MemberEvent', 'FollowEvent')""")
def stream_routes(lake: Lake) -> DataFrame:
    """Project names and requeued event types, routed into one partitioned store."""
    out = new_path(lake.spark, "routes")
    stream = json_reader(lake.spark.readStream, "events").json(lake.feed_files())
    jobs.run_to_end(stream, jobs.routes_sink(out, projects_only=True), new_path(lake.spark, "checkpoint"))
    return lake.spark.read.parquet(out).groupBy("route_key", F.col("message").cast("string").alias("message")).agg(F.count("*").alias("n"))


# Copies a few minutes after their event, some of which come in before it.
LATER = "select id, created_at + {} as created_at from v_events"
LATER_SQL = LATER.format("to_minutes(cast(copy * (id % 4) as integer))")


@query("T3 A4", f"""with v as ({LATER_SQL}), firsts as (select id, min(date_trunc('minute', created_at)) as bucket from v group by id), fresh as (select bucket, count(*) as n from firsts group by bucket),
 totals as (select date_trunc('minute', created_at) as bucket, count(*) as n from v group by 1)
select cast(floor(epoch(t.bucket)) as bigint) as bucket, coalesce(f.n, 0) as new_events, t.n - coalesce(f.n, 0) as duplicate_events, (t.n - coalesce(f.n, 0)) / t.n as ratio from totals t left join fresh f on f.bucket = t.bucket""")
def stream_duplicate_ratio(lake: Lake) -> DataFrame:
    """New and duplicate events per minute on a stream in three batches, with copies in later minutes and rows out of order."""
    path = new_path(lake.spark, "stream-input")
    rows = lake.sql(LATER.format("make_dt_interval(0, 0, cast(copy * (id % 4) as int))"))
    rows.select("id", F.col("created_at").cast("timestamp").alias("created_at")).repartition(3, "created_at").write.parquet(path)
    out, firsts = new_path(lake.spark, "ratio"), new_path(lake.spark, "firsts")
    jobs.run_to_end(ratio.sightings(stream_of(lake, path)), ratio.ratio_sink(out, firsts), new_path(lake.spark, "checkpoint"))
    return ratio.folded_ratio(lake.spark.read.parquet(out)).withColumn("bucket", secs("bucket"))


@query("T4", """select reason, count(*) as n from (select case when type = 'FollowEvent' then 'no payload.target.login' when type = 'PushEvent' then 'unparsable' when type = 'GollumEvent' then 'bad timestamp'
  when type = 'PullRequestEvent' then 'no id' end as reason from v_feed) r where reason is not null group by 1""")
def quarantined_events(lake: Lake) -> DataFrame:
    """Events with planted defects by reason."""
    path = new_path(lake.spark, "broken")
    lines = lake.spark.read.text(lake.feed_files())
    v = F.col("value")
    kind = F.get_json_object(v, "$.type")
    broken = (
        F.when(kind == "FollowEvent", F.regexp_replace(v, '"target":\\{[^}]*\\}', '"target":{}'))
        .when(kind == "PushEvent", F.substr(v, F.lit(2)))
        .when(kind == "GollumEvent", F.regexp_replace(v, '"created_at":"[^"]*"', '"created_at":"soon"'))
        .when(kind == "PullRequestEvent", F.regexp_replace(v, '^\\{"id":"[^"]*",', "{"))
        .otherwise(v)
    )
    lines.select(broken.alias("value")).write.text(path)
    _, bad = jobs.quarantine(read_events(lake.spark, path, keep_corrupt=True))
    return bad.groupBy("reason").agg(F.count("*").alias("n"))


@query("T6", HISTORY_SQL)
def stream_histories(lake: Lake) -> DataFrame:
    """Tolerance fold over a stream whose batches interleave in time; equals the batch result."""
    path = split_files(lake, "select pr as pull_request_id, action, created_at, actor, id from v_pr_events", 2)
    candidates, histories = new_path(lake.spark, "candidates"), new_path(lake.spark, "histories")
    last = jobs.run_to_end(stream_of(lake, path), jobs.history_sink(candidates, histories, HISTORY_TOLERANCE), new_path(lake.spark, "checkpoint"))
    rows = lake.spark.read.parquet(f"{histories}/v{last:09d}")
    return rows.select("pull_request_id", "action", secs("created_at").alias("created_at"), "actor", "id")


@query("T8 G5", WORKER_SQL)
def stream_worker_states(lake: Lake) -> DataFrame:
    """Worker states carried from batch to batch of a log stream."""
    path = new_path(lake.spark, "stream-input")
    lines = lake.sql(WORKER_LINES)
    middle = lines.select(F.expr("approx_percentile(seq, 0.5)")).first()[0]
    states, checkpoint = new_path(lake.spark, "states"), new_path(lake.spark, "checkpoint")
    # The log grows and the stream goes on from where it was: each half is one batch, in any number of files.
    for half in (F.col("seq") <= middle, F.col("seq") > middle):
        lines.filter(half).write.mode("append").parquet(path)
        last = jobs.run_to_end(stream_of(lake, path, None), jobs.worker_sink(states), checkpoint)
    return lake.spark.read.parquet(f"{states}/v{last:09d}").select(*STATE)
