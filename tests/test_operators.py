"""Decision tables, table changes and sources on small fixtures."""

import pytest
from pyspark.sql import functions as F

from forgelake.functions import scalars as S
from forgelake.operators import changes, forks, geo, keys, logs, lookup, sync
from forgelake.operators.builders import code, people, tracker
from forgelake.operators.running import running_max
from forgelake.sources import dump
from forgelake.sources.entities import read_entity, read_worklist
from forgelake.sources.tables import TableSet


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


# ---- changes -------------------------------------------------------------


def test_upsert_tells_absent_from_null(spark):
    table = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "id int, x string, y string")
    change = spark.createDataFrame(
        [(1, None, "new", ["x"], 1), (3, "q", None, ["x"], 1), (1, "last", "z", ["y"], 2)], "id int, x string, y string, present array<string>, seq int"
    )
    assert rows(changes.upsert(table, change, ["id"], ["seq"], "present")) == [(1, None, "z"), (2, "c", "d"), (3, "q", None)]


def test_insert_missing_is_idempotent_and_order_free(spark):
    table = spark.createDataFrame([(1, "kept")], "id int, v string")
    new = spark.createDataFrame([(1, "x"), (2, "b"), (2, "a")], "id int, v string")
    once = changes.insert_missing(table, new, ["id"], ["v"])
    twice = changes.insert_missing(once, new.orderBy(F.desc("v")).repartition(3), ["id"], ["v"])
    assert rows(once) == rows(twice) == [(1, "kept"), (2, "a")]


def test_delete_counts_and_refuses_empty_predicate(spark):
    table = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    kept, counts = changes.delete(table, F.col("id") == 1)
    assert rows(kept) == [(2,), (None,)] and counts.get["deleted"] == 1
    with pytest.raises(ValueError):
        changes.delete(table, None)


def test_dense_ids_do_not_depend_on_partitions(spark):
    dim = spark.createDataFrame([(7, "old")], "id bigint, login string")
    new = spark.range(500).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("login"))
    a = rows(keys.assign_dense_ids(new.repartition(1), dim, ["login"]), "login", "id")
    b = rows(keys.assign_dense_ids(new.unionByName(new).repartition(7), dim, ["login"]), "login", "id")
    assert a == b and sorted(i for _, i in a) == list(range(8, 508))


def test_running_max_equals_a_plain_window(spark):
    from pyspark.sql import Window

    df = spark.range(300).select((F.col("id") % 2).alias("k"), F.col("id").alias("pos"), F.when(F.hash("id") % 5 == 0, F.col("id")).alias("v"))
    w = Window.partitionBy("k").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    assert rows(running_max(df, ["k"], "pos", ["v"], bucket=16)) == rows(df.withColumn("last_v", F.max("v").over(w)))


def test_soft_deleted_topic_stays_deleted_unless_revived(spark):
    table = spark.createDataFrame([(1, "a", None, True), (1, "b", None, False), (2, "c", None, False)], "project_id bigint, topic_name string, created_at timestamp, deleted boolean")
    listed = spark.createDataFrame([(1, "a"), (1, "new")], "project_id bigint, topic_name string")
    refreshed = spark.createDataFrame([(1,), (2,)], "project_id bigint")
    now = F.timestamp_seconds(F.lit(5))
    assert rows(code.next_topics(table, listed, refreshed, now), "topic_name", "deleted") == [("a", True), ("b", True), ("c", True), ("new", False)]
    assert ("a", False) in rows(code.next_topics(table, listed, refreshed, now, revive=True), "topic_name", "deleted")


def test_dated_follow_overwrites_even_with_an_earlier_date(spark):
    users = spark.createDataFrame([(1, "a", 100), (2, "b", 200)], "id bigint, login string, created_at bigint").withColumn("created_at", F.timestamp_seconds("created_at"))
    staged = spark.createDataFrame([("a", "b", None, 1), ("b", "a", 50, 2), ("b", "a", 40, 3)], "follower string, followed string, event_ts bigint, id bigint").withColumn("event_ts", F.timestamp_seconds("event_ts"))
    table = spark.createDataFrame([(2, 1, 900)], "follower_id bigint, user_id bigint, created_at bigint").withColumn("created_at", F.timestamp_seconds("created_at"))
    result = people.next_followers(table, staged, users)
    assert rows(result, "follower_id", "user_id", F.unix_seconds("created_at")) == [(1, 2, 200), (2, 1, 50)]


# ---- decision tables -----------------------------------------------------


def test_fork_point_rules(spark):
    forks_df = spark.createDataFrame([("set", "s0"), ("nodiff", None), ("even", None), ("root", None), ("ahead", None), ("lost", None)], "fork_id string, fork_sha string")
    heads = spark.createDataFrame([("set", 3, "m"), ("even", 0, "base"), ("root", 1, "m"), ("ahead", 2, "m"), ("lost", 1, "m")], "fork_id string, ahead_by int, merge_base string")
    diverging = spark.createDataFrame([("root", "r1", "2020-01-01"), ("ahead", "a2", "2020-01-02"), ("ahead", "a1", "2020-01-01"), ("lost", "l1", "2020-01-01")], "fork_id string, sha string, date string")
    parents = spark.createDataFrame([("ahead", "a1", "p1"), ("ahead", "a1", "p2"), ("ahead", "a2", "p9"), ("lost", "l1", "unknown")], "fork_id string, sha string, parent_sha string")
    commits = spark.createDataFrame([("p1", 10), ("p2", 20), ("p9", 99)], "sha string, created_at bigint").withColumn("created_at", F.timestamp_seconds("created_at"))
    found = dict(rows(forks.fork_points(forks_df, heads, diverging, parents, commits)))
    assert found == {"set": "s0", "nodiff": None, "even": "base", "root": "r1", "ahead": "p2", "lost": None}


def test_fork_commit_strategies(spark):
    feed = spark.createDataFrame([(9, 1, 0, "n2"), (9, 1, 1, "n1"), (9, 2, 0, "cut"), (9, 2, 1, "old"), (8, 1, 0, "x")], "fork_id bigint, page int, pos int, sha string")
    points = spark.createDataFrame([(9, "cut"), (8, None)], "fork_id bigint, fork_sha string")
    sides = spark.createDataFrame([(9, 1), (8, 1)], "fork_id bigint, parent_id bigint")
    commits = spark.createDataFrame([(1, "n2", 50), (2, "n1", 40), (3, "cut", 30), (4, "old", 20), (5, "same", 30)], "id bigint, sha string, created_at bigint").withColumn("created_at", F.timestamp_seconds("created_at"))
    owned = spark.createDataFrame([(1, 3), (1, 4), (1, 5)], "project_id bigint, commit_id bigint")
    run = lambda s: rows(forks.inherit_commits(s, feed, points, sides, owned, commits))
    assert run("none") == []
    assert run("fork_point") == run("whatever") == [(9, 1), (9, 2)]
    assert run("ALL") == [(9, 1), (9, 2), (9, 4)]


def test_sync_actions(spark):
    name = lambda *ns: spark.createDataFrame([("o", n) for n in ns], "owner string, name string")
    feed = spark.createDataFrame([("o", "f", False), ("o", "ft", False), ("o", "rf", False), ("o", "rft", False), ("o", "err", True)], "owner string, name string, is_error boolean")
    plan = sync.presence(name("none", "t", "f", "ft", "r", "rt", "rf", "rft", "err"), name("r", "rt", "rf", "rft"), feed, name("t", "ft", "rt", "rft", "err"))
    assert {n: (a, r) for n, a, r in rows(plan, "name", "action", "raw_action")} == {
        "none": ("none", "none"), "t": ("delete", "none"), "f": ("insert", "store"), "ft": ("update", "store"), "r": ("none", "none"),
        "rt": ("delete", "none"), "rf": ("insert", "replace"), "rft": ("update", "replace"), "err": ("none", "none"),
    }


def test_parent_chain_and_unknown_parent(spark):
    users = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, login string").withColumn("created_at", F.lit(None).cast("timestamp"))
    raw = spark.createDataFrame([
        ("u", "fork", "d" * 300, "c", "2020-01-01T00:00:00Z", ("a",), ("mid", ("b",))), ("u", "mid", None, "c", "2020-01-01T00:00:00Z", ("b",), ("gone", ("x",))),
        ("u", "other", None, "c", "2020-01-01T00:00:00Z", ("a",), None),
    ], "url string, name string, description string, language string, created_at string, owner struct<login:string>, parent struct<name:string,owner:struct<login:string>>")
    repos = code.repo_rows(raw)
    wanted = code.with_parents(spark.createDataFrame([("a", "fork")], "owner string, name string"), repos)
    assert rows(wanted, "owner", "name") == [("a", "fork"), ("b", "mid"), ("x", "gone")]
    table = spark.createDataFrame([], "id bigint, url string, owner_id bigint, name string, description string, language string, created_at timestamp, forked_from bigint, deleted boolean, updated_at timestamp")
    done = code.next_projects(table, repos.join(wanted, ["owner", "name"], "left_semi"), users, F.timestamp_seconds(F.lit(9)))
    found = {r["name"]: r for r in done.collect()}
    assert set(found) == {"fork", "mid"} and found["mid"]["forked_from"] == -1
    assert found["fork"]["forked_from"] == found["mid"]["id"] and len(found["fork"]["description"]) == 255


def test_latest_assigned_event_sets_assignee(spark):
    issues = spark.createDataFrame([(1, 5), (2, 5)], "id bigint, assignee_id bigint")
    events = spark.createDataFrame([(1, "assigned", 7, 10, 1), (1, "assigned", 8, 10, 2), (1, "closed", 9, 99, 3)], "issue_id bigint, action string, actor_id bigint, created_at bigint, event_id bigint")
    assert rows(tracker.with_assignees(issues, events)) == [(1, 8), (2, 5)]


# ---- sources -------------------------------------------------------------


def test_damaged_dump_and_budget(spark, tmp_path):
    text = '1,"a \\"b\\"","x\\\ny",2020-01-01 00:00:00\n2,\\N,"c\\\\d",0000-00-00 00:00:00\nword,"q","r\rs",2020-01-02 00:00:00\n'
    (tmp_path / "t.csv").write_text(text)
    read = dump.read_text_dump(spark, str(tmp_path / "t.csv"), ["id", "a", "b", "ts"])
    found = {r["id"]: r for r in dump.normalise_dump(read).collect()}
    assert found["1"]["a"] == 'a "b"' and found["1"]["b"] == "x y"
    assert found["2"]["a"] is None and found["2"]["ts"] == "1970-01-01 00:00:00"
    from forgelake.schemas import struct_of

    schema = struct_of("id bigint, a string, b string, ts timestamp")
    assert dump.good_rows(read, schema, max_bad=1).count() == 2
    with pytest.raises(ValueError):
        dump.good_rows(read, schema, max_bad=0)


def test_unknown_collection_and_worklist(spark, tmp_path):
    with pytest.raises(ValueError):
        read_entity(spark, "nonsense", str(tmp_path))
    (tmp_path / "w.txt").write_text("a r1\na r2\n\nb\n")
    done = spark.createDataFrame([("a", "r1")], "item string, repo string")
    assert rows(read_worklist(spark, str(tmp_path / "w.txt"), done)) == [("a", "r2"), ("b", None)]


def test_repeated_batch_changes_nothing(spark, tmp_path):
    store = TableSet(spark, str(tmp_path / "tables"))
    watchers = spark.createDataFrame([(1, 2)], "repo_id bigint, user_id bigint")
    assert store.write_all({"watchers": watchers}, 0) and not store.write_all({"watchers": watchers.limit(0)}, 0)
    base = store.read_all()
    assert store.write_all({**base, "followers": spark.createDataFrame([(1, 2)], "follower_id bigint, user_id bigint")}, 1, base)
    version, places = store.newest()
    # The untouched table stays where the first version put it.
    assert version == 2 and places["watchers"].startswith("v000000001") and places["followers"].startswith("v000000002")
    assert store.read_all()["watchers"].count() == 1


# ---- scalars, geo, logs --------------------------------------------------


def test_scalars(spark):
    df = spark.createDataFrame([("  Athens, Greece ", "Ann < a.b@cd.org>", "no mail")], "loc string, addr string, bad string")
    got = df.select(
        S.location_key(F.col("loc")), S.split_address(F.col("addr")), S.split_address(F.col("bad")),
        F.unix_seconds(S.forge_ts(F.lit("2012/07/06 10:00:00 -0700"))), F.unix_seconds(S.forge_ts(F.lit("1970-01-01T00:00:00Z"))),
        S.is_valid_email(F.lit("a.b@cd.org")), S.is_valid_email(F.lit("1@c")), S.url_part(F.lit("a/b"), 7),
    ).first()
    assert tuple(got) == ("athens greece", ("Ann", "a.b@cd.org"), None, 1341594000, 86400, True, False, None)


def test_regex_filter_takes_the_whole_pattern(spark):
    rows = spark.createDataFrame([("a=b",), ("a=c",), ("a",)], "k string")
    assert [r["k"] for r in lookup.regex_filter(rows, ["k=^a=b$"]).collect()] == ["a=b"]
    assert lookup.regex_filter(rows, ["k=^a=b$"], whole_pattern=False).count() == 3
    # Possessive quantifiers are Java's, lookbehinds of open length are not.
    assert lookup.regex_filter(rows, [r"k=^a++\p{Punct}c$"]).count() == 1


def test_bad_regex_filter_is_refused(spark):
    for text in ("type", "=x", "type=(", "type="):
        with pytest.raises(ValueError):
            lookup.regex_filter(spark.range(1), [text])


def test_geo_failures_and_last_code(spark):
    responses = spark.createDataFrame([
        ("osm", "A", "[]"), ("bing", "B", '{"resourceSets":[{"estimatedTotal":1,"resources":[{"confidence":"Low"}]}]}'), ("gmaps", "C", '{"results":[]}'), ("osm", "D", "not json"),
        ("bing", "E", '{"resourceSets":[{"estimatedTotal":1,"resources":[{"confidence":"High","point":{"coordinates":[1.0,2.0]},"address":{"countryRegion":"Finland"}}]}]}'),
    ], "provider string, location string, body string")
    codes = spark.createDataFrame([("Finland", "ax", 1), ("Finland", "fi", 2)], "name string, code string, line int")
    found = {r["key"]: (r["status"], r["country_code"], r["long"]) for r in geo.parse_responses(responses, codes).collect()}
    assert found == {"a": ("failed", None, None), "b": ("failed", None, None), "c": ("failed", None, None), "d": ("failed", None, None), "e": ("ok", "fi", 2.0)}


def test_failed_request_gives_points_and_state_survives_batches(spark):
    line = "WARN, 2020-01-01T00:00:00Z, c -- api_client.rb: Failed request. URL: u, Status code: 409, Status: Conflict, Access: a, IP: 0, Remaining: 33"
    points = logs.request_points(logs.parse_logs(spark.createDataFrame([(line,)], "line string")))
    assert rows(points, "metric", "value") == [("error_code", 409), ("remaining", 33)]
    base = "[2020-01-01T00:0{}:00.1 #7] DEBUG api_client.rb: [1.1.1.1] Request: https://api.github.com/repos/o/{} ({} remaining) took 5 ms"
    lines = [(1, base.format(0, "a", 9)), (2, "[x #7] api_client.rb: 404 Not Found"), (3, base.format(1, "b/issues?page=2", 8)), (4, "[x #7] api_client.rb: 410 Gone"),
             (5, base.format(3, "b", 7)), (6, "[x #7] api_client.rb: Forbidden"), (7, "[2020-01-01T00:04:00.1 #7] api_client.rb: sleeping for 90 s")]
    parsed = logs.parse_worker_lines(spark.createDataFrame(lines, "seq bigint, line string"))
    whole = logs.worker_latest(parsed).select("pid", "status", "repo", "stage", "remaining", "not_found", "forbidden", "time_in", "sleep_remaining")
    assert rows(whole) == [("7", "S", "o/b", "repo", 7, 1, 1, 180, 90)]
    for cut in range(1, 7):
        early = logs.worker_latest(parsed.filter(F.col("seq") <= cut))
        resumed = logs.worker_latest(logs.state_lines(early).unionByName(parsed.filter(F.col("seq") > cut)))
        assert rows(resumed.select(*whole.columns)) == rows(whole), cut
