"""Nothing is lost without a trace: deep fork chains, gaps between batches, rejected rows, absent collections."""

import pytest
from pyspark.sql import functions as F

from forgelake.operators.builders import code
from forgelake.plans.refresh import apply_events, refresh_repos
from forgelake.schemas import struct_of
from forgelake.sources import dump
from forgelake.streaming import jobs


def test_fork_chain_of_any_depth(spark):
    depth = 40
    repos = spark.createDataFrame([("o", f"r{i}", "o", f"r{i + 1}") for i in range(depth)], "owner string, name string, parent_owner string, parent_name string")
    wanted = code.with_parents(spark.createDataFrame([("o", "r0")], "owner string, name string"), repos)
    assert wanted.count() == depth + 1


def test_histories_survive_a_gap_and_refuse_another_checkpoint(spark, tmp_path):
    rows = spark.createDataFrame([(1, "opened", 10, "a", 1), (2, "opened", 20, "b", 2)], "pull_request_id bigint, action string, created_at bigint, actor string, id bigint")
    rows = rows.withColumn("created_at", F.timestamp_seconds("created_at"))
    write = jobs.history_sink(str(tmp_path / "candidates"), str(tmp_path / "histories"))
    write(rows.filter("id = 1"), 0)
    write(rows.filter("id = 2"), 2)
    write(rows.filter("id = 2"), 2)
    assert spark.read.parquet(str(tmp_path / "histories" / "v000000002")).count() == 2
    with pytest.raises(RuntimeError):
        write(rows.filter("id = 1"), 1)


def test_a_damaged_store_is_no_empty_store(spark, tmp_path):
    (tmp_path / "part.parquet").write_text("not parquet")
    like = spark.range(1)
    assert jobs.read_or_empty(spark, str(tmp_path / "absent"), like).count() == 0
    with pytest.raises(Exception, match=r"."):
        jobs.read_or_empty(spark, str(tmp_path), like).count()


def test_rejects_are_kept_also_when_the_load_fails(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1,2\nword,3\n4,x\n")
    schema, rejects = struct_of("id bigint, k bigint"), str(tmp_path / "rejects")
    with pytest.raises(ValueError):
        dump.load_typed(spark, str(tmp_path / "t.csv"), schema, str(tmp_path / "out"), rejects, max_bad=1)
    found = sorted(tuple(r) for r in spark.read.parquet(rejects).select("id", "k", "reason").collect())
    assert found == [("4", "x", "k"), ("word", "3", "id")]


def test_absent_collections_are_an_error(spark):
    nothing = spark.createDataFrame([], "owner string, repo string")
    with pytest.raises(ValueError, match="not staged"):
        refresh_repos({}, {}, nothing, F.current_timestamp())
    with pytest.raises(ValueError, match="issue_comments"):
        apply_events({}, nothing, {"users": nothing}, F.current_timestamp())
