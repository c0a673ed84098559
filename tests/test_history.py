"""Tolerance fold: stated cases, and a brute-force comparison across bucket boundaries."""

import random

import pytest
from pyspark.sql import functions as F

from forgelake.operators.history import build_history

SCHEMA = "pull_request_id bigint, action string, sec bigint, actor string, id bigint"


def fold(spark, rows, tolerance=3, bucket=None):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("created_at", F.timestamp_seconds("sec")).drop("sec")
    kept = build_history(df, tolerance, bucket).select("pull_request_id", "action", F.unix_seconds("created_at"), "actor", "id")
    return sorted(tuple(r) for r in kept.collect())


def greedy(rows, tolerance):
    """Row by row, in order of (second, id)."""
    kept = []
    for pr, action, sec, actor, rid in sorted(rows, key=lambda r: (r[2], r[4])):
        same = [k for k in kept if k[0] == pr and k[1] == action]
        if action in ("opened", "merged"):
            hit = same[0] if same else None
            near = hit is not None and sec - hit[2] <= tolerance
        else:
            hit = next((k for k in same if abs(sec - k[2]) <= tolerance), None)
            near = hit is not None
        if hit is None:
            kept.append([pr, action, sec, actor, rid])
        elif near and hit[3] is None:
            hit[3] = actor
    return sorted(tuple(k) for k in kept)


def test_greedy_not_sessionized(spark):
    rows = [(1, "closed", 1000 + s, "a", s) for s in (0, 2, 4, 6, 10, 13, 14)]
    assert [r[2] - 1000 for r in fold(spark, rows)] == [0, 4, 10, 14]


def test_opened_once_and_actor_filled_within_tolerance(spark):
    rows = [
        (1, "opened", 1000, None, 1), (1, "opened", 1002, "a", 2), (1, "opened", 9000, "b", 3),
        (2, "opened", 1000, None, 4), (2, "opened", 9000, "b", 5),
        (3, "closed", 1000, None, 6), (3, "closed", 1003, "c", 7),
    ]
    assert fold(spark, rows) == [(1, "opened", 1000, "a", 1), (2, "opened", 1000, None, 4), (3, "closed", 1000, "c", 6)]


@pytest.mark.parametrize("tolerance,bucket", [(3, 8), (3, 20), (10, 22), (3, None)])
def test_equals_brute_force_over_bucket_boundaries(spark, tolerance, bucket):
    rng = random.Random(tolerance * 100 + (bucket or 0))
    rows = []
    for n in range(900):
        # One pull request holds a third of all rows.
        pr = 0 if n % 3 == 0 else rng.randrange(1, 12)
        action = rng.choice(["closed", "closed", "reopened", "opened"])
        rows.append((pr, action, 10_000 + rng.randrange(0, 400), rng.choice([None, "a", "b"]), n))
    assert fold(spark, rows, tolerance, bucket) == greedy(rows, tolerance)
