"""Steps of a batch of events: plans grow with the change sets, and steps that don't depend on each other run together."""

import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from forgelake.operators import changes, keys
from forgelake.operators.builders import code
from forgelake.plans import refresh, views
from forgelake.plans.queries import CATALOG
from forgelake.plans.views import Lake
from forgelake.session import cut_lineage, together
from forgelake.sources.tables import empty_tables


def scans(df):
    text = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation [" in line or "LocalRelation" in line or "LogicalRDD" in line for line in text.splitlines())


def test_a_table_that_takes_several_change_sets_names_each_once(spark):
    users = spark.createDataFrame([(1, "ann")], "id bigint, login string")
    projects = spark.createDataFrame([(5, 1, "r")], "id bigint, owner_id bigint, name string").withColumn("created_at", F.lit(None).cast("timestamp"))
    prs = spark.createDataFrame([(7, 5, 3), (8, 5, 4)], "id bigint, base_repo_id bigint, pullreq_id bigint")
    commits = spark.createDataFrame([(n, f"c{n}") for n in range(4)], "id bigint, sha string")
    tables = empty_tables(spark) | {"users": users, "projects": projects, "pull_requests": prs, "commits": commits}
    for n in range(3):
        listed = spark.createDataFrame([("ann", "r", 3, f"c{n}"), ("ann", "r", 3, "c0"), ("ann", "r", 4, "c3"), ("ann", "r", None, "c1")], "owner string, repo string, number bigint, sha string")
        tables |= refresh.store_children(tables, {"pull_commit_lists": listed})
    found = tables["pull_request_commits"]
    assert sorted(map(tuple, found.collect())) == [(7, 0), (7, 1), (7, 2), (8, 3)]
    assert scans(found) <= 4


@pytest.mark.parametrize("stored", [False, True])
def test_stored_change_sets_give_the_same_rows(spark, stored):
    table = spark.createDataFrame([(1, 5, "a"), (None, 6, "b"), (2, None, None)], "k bigint, ts bigint, v string")
    rows = spark.createDataFrame([(1, 9, "c"), (1, 7, None), (3, 1, "d"), (3, 2, "e"), (None, 8, "f")], "k bigint, ts bigint, v string")
    found = {
        "insert": changes.insert_missing(table, rows, ["k"], ["ts"], stored), "upsert": changes.upsert(table, rows, ["k"], ["ts"], stored=stored),
        "later": changes.update_later(table.drop("v"), rows.drop("v"), ["k"], "ts", stored),
    }
    told = {name: sorted(map(tuple, df.collect()), key=str) for name, df in found.items()}
    assert told["insert"] == sorted([(1, 5, "a"), (None, 6, "b"), (2, None, None), (3, 1, "d"), (None, 8, "f")], key=str)
    assert told["upsert"] == sorted([(1, 9, "c"), (None, 6, "b"), (2, None, None), (3, 2, "e"), (None, 8, "f")], key=str)
    assert told["later"] == sorted([(1, 9), (None, 6), (2, None), (3, 2), (None, 8)], key=str)


def test_steps_run_together_and_the_first_error_is_raised(spark):
    meeting = threading.Barrier(2, timeout=30)
    assert together(spark, {n: lambda n=n: (meeting.wait() >= 0, spark.range(n).count()) for n in (1, 2)}) == {1: (True, 1), 2: (True, 2)}
    with pytest.raises(ZeroDivisionError):
        together(spark, {"a": lambda: 1 / 0, "b": lambda: 1})
    assert together(spark, {}) == {}


def test_packed_tables_are_not_broadcast_by_the_size_of_their_files(spark, tmp_path):
    """200,000 keys in a file of far less than a byte-wise copy: rows of 16 bytes each would be broadcast."""
    lake = Lake(spark, str(tmp_path))
    keys = cut_lineage(lake.spark.range(0, 200_000, 1, 1), "keys")
    facts = cut_lineage(lake.spark.range(0, 400_000, 1, 1), "facts")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1600000")
    try:
        joined = facts.join(keys, "id")
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        few = cut_lineage(lake.spark.range(10), "few")
        assert "BroadcastHashJoin" in facts.join(few, "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("last", [False, True])
def test_the_first_row_of_a_key_is_shuffled_once(spark, last):
    rows = spark.createDataFrame(
        [("a", 1, None, 2.0), ("a", 1, "x", 1.0), ("a", None, "y", 5.0), (None, 3, "z", None), (None, 2, "z", 7.0), ("b", 1, "q", 1.0), ("b", 1, "q", 1.0)], "k string, o bigint, t string, f double"
    )
    pick = F.max_by if last else F.min_by
    plain = rows.groupBy("k").agg(pick(F.struct(*rows.columns), F.struct("o", "k", "t", "f")).alias("p")).select("p.*")
    found = changes.one_per_key(rows, ["k"], changes.tiebreak(rows, ["o"]), last)
    assert found.columns == rows.columns
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_by(" not in text and text.count("struct(") == 1
    keys_only = changes.one_per_key(rows.select("o", "k"), ["k", "o"], ["k", "o"])
    assert sorted(map(tuple, keys_only.collect()), key=str) == sorted([(1, "a"), (None, "a"), (3, None), (2, None), (1, "b")], key=str)


def test_rows_are_numbered_as_their_keys_are(spark):
    table = spark.createDataFrame([(41, "u1", 1)], "id bigint, login string, n bigint")
    rows = spark.range(300).select(F.when(F.col("id") % 50 > 0, F.concat(F.lit("u"), F.col("id") % 90)).alias("login"), (F.col("id") % 2).alias("n"), F.col("id").alias("v"))
    ids = keys.assign_dense_ids(rows, table, ["login", "n"])
    wanted = rows.join(ids, ["login", "n"]).select("login", "n", "v", "id")
    found = keys.numbered_rows(changes.missing(rows, table, ["login", "n"]), table, ["login", "n"])
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    # The rows with a null in their key: two numbers, which no row gets.
    assert sorted(set(range(42, 42 + ids.count())) - {r["id"] for r in found.collect()}) == sorted(r["id"] for r in ids.filter("login is null").collect())


def test_commits_are_made_without_storing_the_commits_table(spark, tmp_path):
    day = datetime(2024, 1, 1)
    tables = {
        "lineitem": ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_shipdate timestamp", [(1, 1, 10, 5, day), (1, 1, 9, 5, day), (1, 2, 3, 4, None), (1, 2, 3, 4, None), (2, 3, None, 1, day)]),
        "customer": ("c_custkey bigint, c_name string, c_nationkey bigint, c_mktsegment string", [(5, "n", 1, "BUILDING"), (10, "m", 1, None)]),
        "nation": ("n_nationkey bigint, n_name string, n_regionkey bigint", [(1, "x", 1)]), "region": ("r_regionkey bigint, r_name string", [(1, "r")]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderdate timestamp", [(1, 5, day)]),
        "part": ("p_partkey bigint, p_name string, p_type string", [(9, "a", "b"), (10, "c", "d")]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    lake = Lake(spark, str(tmp_path))
    found = sorted((r["author_id"], r["project_id"]) for r in CATALOG["commits_table"].build(lake).select("author_id", "project_id").na.fill(-1).collect())
    assert found == [(-1, -1), (-1, -1), (5, 10)]
    assert not {name for _, folder, name in views._written if folder == lake.folder} & {"w_commits", "v_commits"}


def test_project_commits_are_made_distinct_as_numbers(spark):
    shas = ["ab" * 20, "AB" * 20, "abc", "", "x" * 40, None, "é"]
    packed = spark.createDataFrame([(s,) for s in shas], "sha string").select("sha", code.packed_sha(F.col("sha")).alias("p")).collect()
    assert len({r["p"] for r in packed}) == 7 and all((r["p"] is None) == (r["sha"] is None) for r in packed)
    assert len(next(r["p"] for r in packed if r["sha"] == "ab" * 20)) == 21
    pairs = spark.createDataFrame([(o, "r", s) for o in ("ann", "bob", None) for s in [*shas, *shas, "gone"]], "owner string, repo string, sha string")
    commits = spark.createDataFrame(list(enumerate(shas)), "id bigint, sha string")
    users = spark.createDataFrame([(1, "ann"), (2, None)], "id bigint, login string")
    projects = spark.createDataFrame([(5, 1, "r"), (6, 2, "r")], "id bigint, owner_id bigint, name string").withColumn("created_at", F.lit(None).cast("timestamp"))
    found = code.project_commit_rows(pairs, projects, users, commits)
    assert sorted(map(tuple, found.collect())) == [(5, n) for n in range(7) if n != 5]
    # One aggregate, of numbers: no text is shuffled to find repeated sightings.
    aggregates = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in line]
    assert len(aggregates) == 1 and "sha" not in aggregates[0]


def test_labels_of_issues_do_not_double_the_plan(spark):
    now = F.timestamp_seconds(F.lit(0))
    users = spark.createDataFrame([(1, "ann")], "id bigint, login string")
    projects = spark.createDataFrame([(5, 1, "r")], "id bigint, owner_id bigint, name string").withColumn("created_at", F.lit(None).cast("timestamp"))
    issues = spark.createDataFrame([(n, 5, n) for n in range(4)], "id bigint, repo_id bigint, issue_id bigint")
    tables = empty_tables(spark) | {"users": users, "projects": projects, "issues": issues}
    repos = spark.createDataFrame([("ann", "r")], "owner string, repo string")
    for n in range(3):
        raw = {
            "repo_labels": spark.createDataFrame([("ann", "r", "bug"), ("ann", "r", f"l{n}"), ("ann", "r", None)], "owner string, repo string, name string"),
            "issues": spark.createDataFrame([("ann", "r", n, [("bug",), (f"l{n}",)]), ("ann", "r", 3, [("bug",)]), ("ann", "r", None, [("bug",)])], "owner string, repo string, number bigint, labels array<struct<name:string>>"),
        }
        tables = refresh.labels_stage(tables, raw, repos, now)
    named = tables["issue_labels"].join(tables["repo_labels"].select(F.col("id").alias("label_id"), "name"), "label_id")
    assert sorted(map(tuple, named.select("issue_id", "name").collect())) == [(0, "bug"), (0, "l0"), (1, "bug"), (1, "l1"), (2, "bug"), (2, "l2"), (3, "bug")]
    assert scans(tables["issue_labels"]) <= 4
