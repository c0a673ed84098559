"""Scalar expressions and filters over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.functions import scalars as S
from forgelake.operators import handlers, lookup
from forgelake.plans.catalog import query, secs
from forgelake.plans.views import Lake
from forgelake.schemas import struct_of
from forgelake.sources.entities import read_entity, repo_events


def feed(lake: Lake) -> DataFrame:
    """The parsed event feed."""
    return lake.feed()


@query("F1", "select id, actor as login, case when type = 'FollowEvent' then other end as target, actor_id from v_feed")
def nested_paths(lake: Lake) -> DataFrame:
    parsed = read_entity(lake.spark, "events", lake.feed_files(), keep_raw=True)
    return parsed.select(
        F.col("id").try_cast("bigint").alias("id"), S.path(F.col("actor"), "login").alias("login"),
        S.variant_path(F.col("raw"), "payload.target.login").alias("target"),
        S.variant_path(F.col("raw"), "actor.id", "bigint").alias("actor_id"),
    )


@query("F2", """select o_orderkey as id, 'u' || cast(o_custkey as string) as login, 'repaired' as state, o_orderpriority as label,
  coalesce(case when o_orderstatus = 'F' then o_totalprice end, cast(o_custkey as double)) as amount,
  case when o_orderstatus = 'F' and o_totalprice <> cast(o_custkey as double) then 2 else 1 end as kept_both
from orders""")
def record_merge(lake: Lake) -> DataFrame:
    kind = "struct<login:string,meta:struct<state:string,label:string>,amount:double>"
    rows = lake.sql("""select o_orderkey as id,
      named_struct('login', 'u' || o_custkey, 'meta', named_struct('state', o_orderstatus, 'label', cast(null as string)), 'amount', cast(o_custkey as double)) as a,
      named_struct('login', cast(null as string), 'meta', named_struct('state', cast(null as string), 'label', o_orderpriority), 'amount', case when o_orderstatus = 'F' then o_totalprice end) as b
    from orders""")
    schema = struct_of(f"r {kind}")["r"].dataType
    merged = rows.select("id", S.with_path(S.deep_merge(F.col("a"), F.col("b"), schema), "meta.state", F.lit("repaired")).alias("m"),
                         S.deep_merge(F.col("a"), F.col("b"), schema, overwrite=False).alias("u"))
    return merged.select("id", "m.login", "m.meta.state", "m.meta.label", "m.amount", F.size("u.amount").alias("kept_both"))


@query("F3 F4 F5 F19", r"""select login,
  case when type = 'User' then 'USR' else 'ORG' end as kind,
  regexp_matches(email, '^[a-zA-Z][\w\.-]*[a-zA-Z0-9]@[a-zA-Z0-9][\w\.-]*[a-zA-Z0-9]\.[a-zA-Z][a-zA-Z\.]*[a-zA-Z]$') as valid_email,
  true as login_is_login, false as email_is_login, email as mail
from v_users""")
def account_fields(lake: Lake) -> DataFrame:
    users = lake["v_users"]
    padded = F.concat(F.lit("  "), F.coalesce("email", F.lit("")), F.lit(" "))
    return users.select(
        "login", S.user_type(F.col("type")).alias("kind"), S.is_valid_email(F.col("email")).alias("valid_email"),
        S.is_login(F.col("login")).alias("login_is_login"),
        S.is_login(F.coalesce("email", F.lit("a@b"))).alias("email_is_login"), S.blank_to_null(padded).alias("mail"),
    )


@query("F6", "select seq, trim(name) as name, trim(email) as email from v_identities")
def address_parts(lake: Lake) -> DataFrame:
    full = F.concat(F.col("name"), F.lit(" < "), F.col("email"), F.lit(" >"))
    return lake["v_identities"].select("seq", S.split_address(full).alias("a")).select("seq", "a.name", "a.email")


@query("F7 F15", """select page_id, nullif(split_part(url, '/', 3), '') as site, nullif(split_part(url, '/', 4), '') as section,
  nullif(split_part(url, '/', 8), '') as deep, false as is_sha from pages""")
def url_parts(lake: Lake) -> DataFrame:
    url = F.col("url")
    return lake["pages"].select(
        "page_id", F.nullif(S.url_part(url, 2), F.lit("")).alias("site"), F.nullif(S.url_part(url, 3), F.lit("")).alias("section"),
        F.nullif(S.url_sha(url), F.lit("")).alias("deep"), S.is_sha(S.url_part(url, 2)).alias("is_sha"),
    )


@query("F8 F17 F23", """select id, split_part(repo, '/', 1) as owner, split_part(repo, '/', 2) as name, 'evt.' || type as route,
  replace(repo, '/', ' ') as message, split_part(repo, '/', 2) as last from v_events""")
def repo_names(lake: Lake) -> DataFrame:
    repo = F.col("repo")
    return lake["v_events"].select(
        "id", S.full_name_owner(repo).alias("owner"), S.full_name_repo(repo).alias("name"), S.route_key(F.col("type")).alias("route"),
        S.project_message(repo).alias("message"), S.last_segment(repo).alias("last"),
    )


@query("F9 F18", """select o_orderkey as id, cast(floor(epoch(o_orderdate)) as bigint) as iso,
  cast(floor(epoch(o_orderdate)) as bigint) - 7200 as slashed, 86400 as clamped, cast(null as bigint) as broken,
  cast(floor(epoch(greatest(o_orderdate, timestamp '1998-01-01 00:00:00'))) as bigint) as latest from orders""")
def forge_times(lake: Lake) -> DataFrame:
    day = F.col("o_orderdate")
    iso = F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    slashed = F.concat(F.date_format(day, "yyyy/MM/dd HH:mm:ss"), F.lit(" +0200"))
    return lake["orders"].select(
        F.col("o_orderkey").alias("id"), secs(S.forge_ts(iso)).alias("iso"), secs(S.forge_ts(slashed)).alias("slashed"),
        secs(S.forge_ts(F.concat(F.lit("1969-01-"), F.date_format(day, "dd'T'HH:mm:ss'Z'")))).cast("int").alias("clamped"),
        secs(S.forge_ts(F.concat(F.lit("not "), iso))).alias("broken"),
        secs(S.later(day, F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))).alias("latest"),
    )


@query("F10", "select conv_id, turn, substr(text, 1, 255) as description, substr(text, 1, 256) as comment from conversations")
def cut_texts(lake: Lake) -> DataFrame:
    text = F.col("text")
    return lake["conversations"].select(
        "conv_id", "turn", S.left(text, S.DESCRIPTION_LENGTH).alias("description"), S.left(text, S.COMMIT_COMMENT_LENGTH).alias("comment")
    )


@query("F11", """select o_orderkey as id, case o_orderstatus when 'F' then 1 when 'O' then 0 end as flag,
  case o_orderstatus when 'F' then 1 when 'P' then 0 end as flag_of_null from orders""")
def boolean_flags(lake: Lake) -> DataFrame:
    text = "case o_orderstatus when 'F' then 'true' when 'O' then 'false' else 'maybe' end"
    nullable = "case o_orderstatus when 'F' then 'true' when 'O' then 'maybe' end"
    return lake["orders"].select(
        F.col("o_orderkey").alias("id"), S.bool01(F.expr(text)).alias("flag"), S.bool01(F.expr(nullable)).alias("flag_of_null")
    )


LOCATION_SQL = r"""regexp_replace(regexp_replace(regexp_replace(translate(lower(regexp_replace({0}, '^\s+|\s+$', '', 'g')), '#"<>[]', ''),
  '(?m)^[0-9,/().:]*', '', 'g'), ' +', ' ', 'g'), ',', '', 'g')"""


@query("F12", f"select raw, {LOCATION_SQL.format('raw')} as key from v_locations")
def location_keys(lake: Lake) -> DataFrame:
    return lake["v_locations"].select("raw", S.location_key(F.col("raw")).alias("key"))


@query("F13 E23", """select p.k as project_id, lower(d.lang) as language, sum(d.n_chars)::bigint as bytes from documents d
join (select distinct source, cast(substr(source, 4) as bigint) as k from documents) p on p.source = d.source group by 1, 2""")
def language_bytes(lake: Lake) -> DataFrame:
    per_language = lake.sql("select cast(substr(source, 4) as bigint) as project_id, lang, sum(n_chars) as bytes from documents group by 1, 2")
    maps = per_language.groupBy("project_id").agg(F.map_concat(
        F.map_from_entries(F.collect_list(F.struct(F.upper("lang"), F.col("bytes").cast("string")))),
        F.create_map(F.lit("etag"), F.lit("abc")),
    ).alias("languages"))
    return S.explode_languages(maps, "languages")


@query("F14", """select o_orderkey as id, cast(o_orderkey as string) as id_text, o_custkey = 7 as is_seven,
  o_orderpriority = '5-LOW' as is_low from orders""")
def flexible_ids(lake: Lake) -> DataFrame:
    rows = lake.sql("select cast(o_orderkey as string) as id, o_custkey, o_orderpriority from orders")
    return S.as_id(rows, "id").select(
        "id", "id_text", S.id_eq(F.col("o_custkey"), "7").alias("is_seven"), S.id_eq(F.col("o_orderpriority"), "5-LOW").alias("is_low")
    )


@query("F16", "select c_custkey as id, md5(c_name) as etag from customer")
def entity_tags(lake: Lake) -> DataFrame:
    raw = F.concat(F.lit('W/"'), F.md5("c_name"), F.lit('"'))
    return lake["customer"].select(F.col("c_custkey").alias("id"), S.clean_etag(raw).alias("etag"))


@query("F20", "select l_orderkey as id, count(*) as files, true as patch_gone from lineitem group by 1")
def trimmed_patches(lake: Lake) -> DataFrame:
    rows = lake.sql("""select l_orderkey, l_linenumber, array(named_struct('filename', l_shipdate, 'patch', l_returnflag)) as files from lineitem""")
    trimmed = rows.select("l_orderkey", S.trim_patches(F.col("files")).alias("files"))
    return trimmed.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.sum(F.size("files")).alias("files"), F.bool_and(~F.to_json("files").contains("patch")).alias("patch_gone")
    )


@query("F21", """select number, head is not null as has_head, head is not null and head = base as intra from v_prs""")
def pull_request_sides(lake: Lake) -> DataFrame:
    rows = lake.sql("""select number, named_struct(
      'head', named_struct('sha', 'x', 'repo', case when head is not null then named_struct('full_name', concat('u/', head), 'owner', named_struct('login', 'u')) end),
      'base', named_struct('sha', 'y', 'repo', named_struct('full_name', concat('u/', base), 'owner', named_struct('login', 'u')))) as pr from v_prs""")
    return rows.select("number", S.has_head(F.col("pr")).alias("has_head"), S.intra_branch(F.col("pr")).alias("intra"))


@query("F22", "select id, actor || '/f' || cast(k as string) as fork from v_feed where type = 'ForkEvent'")
def fork_names(lake: Lake) -> DataFrame:
    forks = handlers.fork(feed(lake))["forks"]
    return forks.select(F.col("event_id").alias("id"), S.fork_name(F.col("full_name"), F.col("url")).alias("fork"))


@query("F24 H2", """select id as event_id, owner, name as repo, actor as login, actor_id,
  'https://github.com/' || actor as html_url, 'https://api.github.com/users/' || actor || '/orgs' as organizations_url,
  'https://api.github.com/users/' || actor || '/events{/privacy}' as events_url, false as site_admin
from v_feed where type = 'WatchEvent'""")
def watcher_profiles(lake: Lake) -> DataFrame:
    records = handlers.watch(feed(lake))["watcher_records"]
    return records.select(
        F.col("event_id").try_cast("bigint").alias("event_id"), "owner", "repo", "login", "actor_id", "html_url",
        "organizations_url", "events_url", "site_admin",
    )


@query("F25", "select page_id, split_part(split_part(url, '/', 3), '.', 1) as owner, 'p' || cast(page_id as string) as repo, length(html) as size from pages")
def annotated_records(lake: Lake) -> DataFrame:
    rows = lake["pages"].select("page_id", F.length("html").cast("bigint").alias("size"), "url")
    site = S.url_part(F.col("url"), 2)
    return S.annotate(rows, owner=F.get(F.split(site, r"\."), F.lit(0)), repo=F.concat(F.lit("p"), F.col("page_id").cast("string"))).drop("url")


@query("F26", """select o_custkey as repo, coalesce(arg_max(lower(o_orderpriority), (o_orderdate, o_orderkey)) filter (where o_orderstatus = 'F'), 'master') as default_branch
from orders group by 1""")
def default_branches(lake: Lake) -> DataFrame:
    rows = lake.sql("""select o_custkey as repo, struct(o_orderdate, o_orderkey) as seen,
      case when o_orderstatus = 'F' then lower(o_orderpriority) end as default_branch from orders""")
    return S.default_branch(rows, ["repo"], "seen")


@query("F27", """select id, action, case when action in ('referenced', 'merged', 'closed') then md5(cast(id as string)) end as action_specific
from v_pr_events""")
def action_commits(lake: Lake) -> DataFrame:
    return lake["v_pr_events"].select(
        "id", "action", S.action_specific(F.col("action"), F.md5(F.col("id").cast("string"))).alias("action_specific")
    )


@query("F28", """select id, cast(i - 1 as integer) as pos, md5(cast(id as string) || '-' || cast(i as string)) as part
from (select id, unnest(range(1, n_commits + 1)) as i from v_feed where type = 'PushEvent')""")
def exploded_items(lake: Lake) -> DataFrame:
    pushes = handlers.of_type(feed(lake), "PushEvent")
    items = S.explode_items(pushes, F.col("payload.commits"), "c")
    return items.select(F.col("id").try_cast("bigint").alias("id"), "pos", F.substring("c.sha", 1, 32).alias("part"))


# ---- filters -------------------------------------------------------------


@query("P1", "select id, actor from v_feed where type = 'ForkEvent' and repo = 'u4/r4'")
def found_by_paths(lake: Lake) -> DataFrame:
    hits = lookup.find(feed(lake), {"type": "ForkEvent", "repo.name": "u4/r4"})
    return hits.select(F.col("id").try_cast("bigint").alias("id"), F.col("actor.login").alias("actor"))


@query("P2", "select id, type, repo from v_feed where regexp_matches(type, '^(Push|Pull)') and regexp_matches(repo, 'u[1-4]/r.*7')")
def matched_by_regex(lake: Lake) -> DataFrame:
    hits = lookup.regex_filter(feed(lake), ["type=^(Push|Pull)", "repo.name=u[1-4]/r.*7=ignored"], whole_pattern=False)
    return hits.select(F.col("id").try_cast("bigint").alias("id"), "type", F.col("repo.name").alias("repo"))


@query("P3", "select o_orderkey from orders where o_orderdate between timestamp '1996-01-01 00:00:00' and timestamp '1997-01-01 00:00:00'")
def within_time_range(lake: Lake) -> DataFrame:
    bound = [F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz") for y in (1996, 1997)]
    return lookup.time_range(lake["orders"], "o_orderdate", *bound).select("o_orderkey")


@query("P4", "select id, type from v_feed order by id limit 100")
def first_events(lake: Lake) -> DataFrame:
    return lookup.limit(lake["v_feed"].select("id", "type"), 100)


@query("P5", "select id, type from v_feed where id > 500 and id < 5000 and type not in ('PushEvent', 'ForkEvent')")
def events_between(lake: Lake) -> DataFrame:
    window = lookup.event_window(feed(lake), after=500, before=5000, exclude=["PushEvent", "ForkEvent"])
    return window.select(F.col("id").try_cast("bigint").alias("id"), "type")


@query("P6", "select owner, name from v_projects where updated_at <= timestamp '2001-09-01 00:00:00' - interval 10 days")
def stale_projects(lake: Lake) -> DataFrame:
    now = F.lit("2001-09-01 00:00:00").cast("timestamp_ntz")
    return lookup.stale(lake["v_projects"], now).select("owner", "name")


@query("P7", "select id, type from v_feed where type <> 'GollumEvent'")
def handled_events(lake: Lake) -> DataFrame:
    return lookup.handled(lake["v_feed"]).select("id", "type")


@query("P8", "select id, repo from v_feed where type = 'CreateEvent' and k % 2 = 0")
def repository_creations(lake: Lake) -> DataFrame:
    rows = lookup.repository_creations(feed(lake))
    return rows.select(F.col("id").try_cast("bigint").alias("id"), F.col("repo.name").alias("repo"))


@query("S3", "select id, type from v_feed where repo = 'u5/r5'")
def events_of_repo(lake: Lake) -> DataFrame:
    return repo_events(feed(lake), "u5/r5").select(F.col("id").try_cast("bigint").alias("id"), "type")
