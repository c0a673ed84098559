"""Replays add up, marks hold, and version writers don't overwrite each other."""

import pytest
from pyspark.sql import functions as F

from forgelake.plans import replay
from forgelake.plans.replay import EventWindow
from forgelake.sources.tables import TableSet

EVENT = "id string, type string, repo struct<name:string>"


@pytest.fixture
def applied(monkeypatch):
    """Handlers that only note the events they get, in the watchers table; one that dies when told to."""
    told = {"die": False}

    def apply(tables, events, raw, now, skip):
        if told["die"]:
            raise RuntimeError("executor lost")
        noted = events.select(F.col("id").cast("long").alias("repo_id"), F.lit(1).cast("long").alias("user_id"), F.lit(None).cast("timestamp").alias("created_at"))
        return {**tables, "watchers": tables["watchers"].unionByName(noted)}

    monkeypatch.setattr(replay, "apply_events", apply)
    return told


def numbers(store):
    return sorted(r["repo_id"] for r in store.read_all()["watchers"].collect())


def test_jobs_in_slices_add_up_to_one(spark, tmp_path, applied):
    kinds = ["WatchEvent", "FollowEvent", "PushEvent"]
    rows = [(str(i), kinds[i % 3], (f"o/r{i % 4}",)) for i in range(100)] + [("7", "FollowEvent", ("o/r3",)), (None, "PushEvent", ("o/r1",)), ("x", "PushEvent", ("o/r1",))]
    events = spark.createDataFrame(rows, EVENT)
    listed = spark.createDataFrame([("o", "r1"), ("o", "r2"), ("o", "r9")], "owner string, repo string")
    store = TableSet(spark, str(tmp_path / "tables"))
    job = lambda window, slices=1: replay.replay_job(store, events, {}, listed, F.current_timestamp(), window, slices, stages=False)
    wanted = [i for i in range(100) if i % 4 in (1, 2) and 9 < i < 90 and i % 3 != 1]

    assert job(EventWindow(9, 40, ("FollowEvent",))) == 1
    assert numbers(store) == [i for i in wanted if i < 40]
    # A job that dies between slices leaves whole versions; the next one goes on behind them.
    applied["die"] = True
    with pytest.raises(RuntimeError, match="lost"):
        job(EventWindow(9, 90, ("FollowEvent",)), 3)
    applied["die"] = False
    assert numbers(store) == [i for i in wanted if i < 40] and store.current() == 1
    assert job(EventWindow(9, 90, ("FollowEvent",)), 3) == 3
    assert numbers(store) == wanted
    assert job(EventWindow(9, 90, ("FollowEvent",)), 3) == 0
    marks = {r["repo"]: r["event_id"] for r in store.read_all()["replay_marks"].collect()}
    assert marks == {"r1": 89, "r2": 86}


def test_two_writers_of_a_version(spark, tmp_path):
    store = TableSet(spark, str(tmp_path / "tables"))
    labels = lambda *names: spark.createDataFrame([(i, 1, n) for i, n in enumerate(names)], "id long, repo_id long, name string")
    store.write_all({"repo_labels": labels("a")}, 1)
    late = TableSet(spark, store.root)
    stale = late.newest()
    late.newest = lambda: (stale[0], dict(stale[1]))  # it looked before the other one wrote
    store.write_all({"repo_labels": labels("a", "b")}, 2)
    with pytest.raises(RuntimeError, match="another writer"):
        late.write_all({"repo_labels": labels("x", "y", "z")}, 3)
    assert sorted(r["name"] for r in store.read_all()["repo_labels"].collect()) == ["a", "b"]
