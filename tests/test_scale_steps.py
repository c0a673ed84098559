"""Steps rewritten to scale give the rows of their plain forms, on rows with nulls, repeats and hot keys."""

import gzip
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from forgelake.operators import keys, logs
from forgelake.operators.builders import code
from forgelake.plans import views
from forgelake.plans.queries_apply import feed_raw
from forgelake.sources.tables import empty_table
from forgelake.streaming import jobs

LINE_SCHEMA = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_shipdate timestamp"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    day = datetime(2024, 1, 1)
    rows = [(1, 1, 10, 5, day), (1, 1, 9, 5, day), (1, 2, 3, 4, None), (1, 2, 3, 4, None), (1, 3, None, 1, day), (2, 2, 7, None, day), (2, 4, 7, 7, day), (None, 1, 3, 3, day), (3, None, 2, 2, day), (None, None, 1, 1, None)]
    spark.createDataFrame(rows, LINE_SCHEMA).write.parquet(f"{folder}/lineitem.parquet")
    events = [(i, i % 5 if i % 4 else None, day, kind, '{"k": %d}' % (i % 9)) for i, kind in enumerate(["view", "click", "signup", "purchase", "error", None] * 12)]
    spark.createDataFrame(events, "event_id bigint, user_id bigint, ts timestamp, event_type string, props string").coalesce(1).write.parquet(f"{folder}/events.parquet")
    return views.Lake(spark, str(folder))


@pytest.mark.parametrize("name", ["w_commits", "v_parents", "w_project_commits", "w_pr_commits"])
def test_stored_commits_are_those_of_the_shared_sql(lake, name):
    plain = views.expand(views.VIEWS[name], lake.folder)
    for word in ("w_commits", "v_parents", "w_project_commits", "w_pr_commits"):
        assert f"{word} as (" not in plain
    wanted = lake.spark.sql(plain)
    found = lake[name]
    assert found.dtypes == wanted.dtypes
    assert sorted(found.collect(), key=str) == sorted(wanted.collect(), key=str)
    # No text of 40 digits goes through a shuffle.
    text = lake.sql(views.SPARK_VIEWS[name])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in text or text.index("md5") < text.index("Window")


def test_feed_is_made_by_all_tasks_and_packed(lake):
    files = [p for p in Path(lake.feed_files()).iterdir() if p.name.startswith("part-")]
    assert len(files) > 1 and all(p.name.endswith(".gz") for p in files)
    lines = [line for p in files for line in gzip.open(p, "rt").read().splitlines()]
    plain = lake.sql("select value from v_feed_json where value is not null")
    assert sorted(x for x in lines if x) == sorted(r["value"] for r in plain.collect())


def test_parents_of_many_commits_are_looked_up_apart(spark, monkeypatch):
    monkeypatch.setattr(code, "MANY_CHILDREN", 3)
    sha = "{:040x}".format
    edges = [(sha(i), [(sha(1000), None), ("gone", None), (None, None)]) for i in range(8)] + [(sha(1), [(sha(2), None), (sha(1000), None)]), (sha(99), [(sha(1), None)])]
    raw = spark.createDataFrame(edges, "sha string, parents array<struct<sha:string,url:string>>")
    commits = spark.createDataFrame([(i, sha(i)) for i in range(8)] + [(1000, sha(1000)), (2000, sha(1000)), (None, None)], "id bigint, sha string")
    found = sorted(map(tuple, code.commit_parent_rows(raw, commits).collect()))
    assert found == sorted([(i, p) for i in range(8) for p in (1000, 2000)] + [(1, 2)])


def test_each_half_of_a_log_is_one_batch_of_any_number_of_files(spark, tmp_path):
    path, states, checkpoint = str(tmp_path / "lines"), str(tmp_path / "states"), str(tmp_path / "checkpoint")
    text = "[2024-01-01T00:00:{:02d}.1 #7] DEBUG api_client.rb: [10.0.0.1] Request: https://api.github.com/repos/o/r{}/commits?page=1 ({} remaining) took 5 ms"
    lines = spark.createDataFrame([(n, text.format(n, n // 15, n) if n % 4 else "[x #7] WARN api_client.rb: 404 Not Found") for n in range(40)], "seq bigint, line string")
    for half in (F.col("seq") < 20, F.col("seq") >= 20):
        lines.filter(half).repartition(4).write.mode("append").parquet(path)
        last = jobs.run_to_end(spark.readStream.schema(lines.schema).parquet(path), jobs.worker_sink(states), checkpoint)
    assert last == 1
    parsed = logs.parse_worker_lines(lines)
    shown = ["pid", "status", "ip", "repo", "stage", "remaining", "not_found", "forbidden", "time_in", "seq"]
    assert spark.read.parquet(f"{states}/v{last:09d}").select(shown).collect() == logs.worker_latest(parsed).select(shown).collect()
    found = parsed.filter("seq in (0, 1)").orderBy("seq").select("pid", "kind", "ip", "repo", "stage", "remaining", "ms").collect()
    assert [tuple(r) for r in found] == [("7", "not_found", None, None, None, None, None), ("7", "request", "10.0.0.1", "o/r0", "commits", 1, 5)]


def test_empty_tables_are_known_to_be_empty(spark):
    empty = empty_table(spark, "commits")
    assert "LocalTableScan" in empty._jdf.queryExecution().executedPlan().toString()
    assert empty.count() == 0


def test_staged_collections_are_stored_once_and_read_without_the_events(lake):
    day = datetime(2024, 1, 1)
    spark = lake.spark
    for name, schema, row in [
        ("customer", "c_custkey bigint, c_name string, c_nationkey bigint, c_mktsegment string", (1, "n", 1, "BUILDING")), ("nation", "n_nationkey bigint, n_name string, n_regionkey bigint", (1, "x", 1)),
        ("region", "r_regionkey bigint, r_name string", (1, "r")), ("orders", "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp", (1, 1, day)), ("labels", "doc_id bigint", (1,)),
    ]:
        spark.createDataFrame([row], schema).write.mode("overwrite").parquet(f"{lake.folder}/{name}.parquet")
    raw, again = feed_raw(lake), feed_raw(lake)
    for name, rows in raw.items():
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan and "regexp_extract" not in plan, name
        assert rows.inputFiles() == again[name].inputFiles()
        assert not any(f"{lake.folder}/" in file for file in rows.inputFiles())
    numbers = lake.sql("select owner, name as repo, id as number, 'x' as s from v_feed where type = 'PullRequestEvent' and k % 3 > 0").select("owner", "repo", "number")
    assert set(raw["pull_commit_lists"].select("owner", "repo", "number").collect()) == set(numbers.collect())
    places = lake.sql("select distinct owner, name from v_feed")
    assert sorted(raw["repos"].select("owner.login", "name").collect(), key=str) == sorted(places.collect(), key=str)


def test_rows_are_computed_once_before_they_are_numbered(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(n):
        made.add(1)
        return f"u{n % 50}" if n else None

    login = F.udf(counted, "string").asNondeterministic()
    table = spark.createDataFrame([(7, "u3", None), (9, None, "x")], "id bigint, login string, name string")
    rows = spark.range(0, 50, 1, 2).select(login("id").alias("login"), F.lit("n").alias("name"))
    found = keys.append_with_ids(table, rows, ["login"]).collect()
    assert made.value == 50
    assert sorted(r["login"] for r in found if r["login"]) == sorted(f"u{n}" for n in range(1, 50))
    # As before, a row without a key gets no id and is left out, yet takes a number.
    assert sum(r["login"] is None for r in found) == 1
    ids = [r["id"] for r in found if r["name"] == "n"]
    assert len(set(ids)) == len(ids) == 48 and min(ids) >= 10 and max(ids) <= 58
