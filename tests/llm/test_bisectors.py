"""Clustering by bisector tests, against plain Python integers."""

import hashlib
import math

import numpy as np
import pytest

from forgelake.llm import bisectors


def plain(vectors, k, rounds, dim, scale=256, seed=2):
    """{row number: (id, cluster, distance, cluster_inertia, inertia, digest)}, every distance computed."""
    kept = []
    for i, (vec_id, v) in enumerate(vectors):
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, vec_id, [math.floor(scale * x) for x in map(float, np.array(v, np.float32))]))
    order = sorted(kept, key=lambda r: (r[1] is None, hashlib.sha256(f"{seed}:{r[1]}".encode()).hexdigest(), r[2]))
    centroids = [r[2] for r in order[:k]]
    for turn in range(rounds + 1):
        best = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)) for _, _, v in kept]
        if turn < rounds:
            for n in range(len(centroids)):
                own = [v for (_, _, v), (_, m) in zip(kept, best, strict=True) if m == n]
                if own:
                    centroids[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    long = lambda d: d if d < 1 << 63 else None
    inertia = {n: [d for d, m in best if m == n] for n in range(len(centroids))}
    add = lambda ds: None if any(long(d) is None for d in ds) else long(sum(ds))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(vec_id, n, long(d), add(inertia[n]), add([x for x, _ in best]), digest[n]) for (_, vec_id, _), (d, n) in zip(kept, best, strict=True)], key=str)


def found(spark, vectors, extra="", **options):
    df = spark.createDataFrame([(i, v, 7, 7) for i, v in vectors], "vec_id long, embedding array<float>, cluster int, distance int").repartition(3)
    return sorted(map(tuple, bisectors.cluster(df, **options).collect()), key=str)


ODD = [(1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 0.0]), (5, [float("inf"), 0.0]), (6, [1.0]), (None, [0.5, 0.25]), (7, [-0.001, 0.0]), (7, [-0.001, 0.0]), (7, [0.3, 0.9]), (8, [1.0, 1.0]), (9, [2.0, -1.0]), (9, [2.0, -1.0])]


def test_odd_rows_and_ties(spark):
    grid = ODD + [(100 + i, [x / 256, y / 256]) for i, (x, y) in enumerate((x, y) for x in range(-4, 5) for y in range(-4, 5))]
    assert found(spark, grid, k=5, rounds=3, dim=2) == plain(grid, 5, 3, 2)
    assert found(spark, ODD, k=40, rounds=2, dim=2) == plain(ODD, 40, 2, 2)


def test_random_vectors(spark):
    rng = np.random.default_rng(3)
    vectors = [(int(i), rng.normal(size=6).astype(np.float32).tolist()) for i in range(400)]
    for k in (1, 2, 7):
        assert found(spark, vectors, k=k, rounds=4, dim=6) == plain(vectors, k, 4, 6)


def test_components_up_to_the_range_of_a_float(spark):
    vectors = [(i, [s * 3.4e38, 1e20 * i, -0.5 * i]) for i in range(12) for s in (1, -1)] + [(50 + i, [float(i), 1.0, 2.0]) for i in range(9)]
    assert found(spark, vectors, k=4, rounds=3, dim=3) == plain(vectors, 4, 3, 3)


def test_no_vectors(spark):
    assert found(spark, [], k=3, rounds=1, dim=2) == []
    assert found(spark, ODD[:6], k=3, rounds=1, dim=2) == []


def test_scale_must_be_exact(spark):
    with pytest.raises(ValueError):
        found(spark, ODD, scale=3)
