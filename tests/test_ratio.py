"""Per-minute ratio of a stream: late, repeated and forgotten sightings, judged by plain folds."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from forgelake.streaming import ratio


def batch_of(spark, rows):
    start = datetime(2024, 1, 1)
    events = spark.createDataFrame([(i, None if m is None else start + timedelta(minutes=m)) for i, m in rows], "id string, created_at timestamp")
    return ratio.sightings(events)


def folded(spark, path):
    rows = ratio.folded_ratio(spark.read.parquet(path)).select(F.minute("bucket"), "new_events", "duplicate_events").collect()
    return sorted((m, n, d) for m, n, d in rows if n or d)


def test_late_sightings_move_the_new_event(spark, tmp_path):
    path, firsts = str(tmp_path / "ratio"), str(tmp_path / "firsts")
    sink = ratio.ratio_sink(path, firsts, width=10)
    batches = [[("1", 5), ("1", 5), ("25", 6), ("x", 7), (None, 1)], [("1", 3), ("25", 9), ("x", None)], [("1", 4), ("x", 2), ("99", 5)]]
    for number, rows in enumerate(batches):
        sink(batch_of(spark, rows), number)
    sink(batch_of(spark, batches[2]), 2)  # a repeated batch replaces itself
    seen = [r for b in batches for r in b if None not in r]
    first = {i: min(m for j, m in seen if j == i) for i, _ in seen}
    minutes = sorted({m for _, m in seen})
    wanted = [(m, sum(f == m for f in first.values()), sum(n == m for _, n in seen) - sum(f == m for f in first.values())) for m in minutes]
    assert folded(spark, path) == [w for w in wanted if w[1] or w[2]]


def test_silent_ids_are_forgotten_and_seen_ones_remembered(spark, tmp_path, monkeypatch):
    path, firsts, clock = str(tmp_path / "ratio"), str(tmp_path / "firsts"), [1000.0]
    monkeypatch.setattr(ratio.time, "time", lambda: clock[0])
    sink = ratio.ratio_sink(path, firsts, forget_after_ms=10_000)
    for number, (now, rows) in enumerate([(1000, [("1", 1), ("2", 1)]), (1008, [("1", 2)]), (1016, [("1", 3), ("2", 3)])]):
        clock[0] = float(now)
        sink(batch_of(spark, rows), number)
    assert folded(spark, path) == [(1, 2, 0), (2, 0, 1), (3, 1, 1)]
