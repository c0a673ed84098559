"""Centroid clustering by a tournament of bisector tests.

Two centroids i < j part space along their bisector: a vector v is no nearer to j exactly
when n.v <= t with the normal n = 2 (c_j - c_i) and the threshold t = |c_j|^2 - |c_i|^2.
Normals and thresholds of all pairs are integers and are computed once a round. A vector
then plays k - 1 such sign tests, pair by pair, until one centroid is left; zero goes to the
smaller number. Only the winner's distance is computed.

A round is one pass over the vectors. Each task sends one row per cluster (count and sums),
so what meets in a shuffle follows the number of tasks, not of vectors, and a cluster that
holds a third of all rows costs no more than another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelake.llm.shared import cut_lineage, tune

#: Rows of a block; a block's gathered normals are BLOCK * k/4 * dim numbers.
BLOCK = 1024
_LONG = 1 << 62


def _whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as whole doubles, or as Python integers where a square could leave 2^53.

    scale is a power of two, so the product is exact.
    """
    y = np.floor(x * float(scale))
    return y if _fits(y) else np.vectorize(int, otypes=[object])(y)


def _fits(y: np.ndarray) -> bool:
    return y.dtype != object and (not y.size or float(np.abs(y).max()) * float(np.abs(y).max()) * 8 * y.shape[-1] < 2.0**53)


class Tournament:
    """Integer normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: list[list[int]]):
        self.k = len(centroids)
        self.exact = np.array(centroids, dtype=object)
        pairs = [(i, j) for i in range(self.k) for j in range(i + 1, self.k)]
        self.number = np.zeros((self.k, self.k), dtype=np.int64)
        for at, (i, j) in enumerate(pairs):
            self.number[i, j] = at
        low, high = ([p[side] for p in pairs] for side in (0, 1))
        square = (self.exact * self.exact).sum(axis=1)
        self.normals = 2 * (self.exact[high] - self.exact[low]) if pairs else self.exact[:0]
        self.thresholds = square[high] - square[low] if pairs else square[:0]
        self.peak = max((abs(int(c)) for c in self.exact.ravel()), default=0)
        self.plain = self.peak * self.peak * 8 * self.exact.shape[1] < 2**53
        if self.plain:
            self.fast = self.exact.astype(np.float64), self.normals.astype(np.float64), self.thresholds.astype(np.float64)

    def _tables(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The vectors and the tables in a type in which every test is exact."""
        if self.plain and x.dtype != object and (not x.size or float(np.abs(x).max()) * self.peak * 8 * x.shape[1] < 2.0**53):
            return x, *self.fast
        return x if x.dtype == object else np.vectorize(int, otypes=[object])(x), self.exact, self.normals, self.thresholds

    def winners(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of each row (ties: the smaller number) and the squared distance."""
        x, centroids, normals, thresholds = self._tables(x)
        left = np.broadcast_to(np.arange(self.k), (len(x), self.k))
        while left.shape[1] > 1:
            # Neighbours play, so the left one of a pair always has the smaller number.
            odd = left[:, left.shape[1] & ~1 :]
            one, two = left[:, 0 : left.shape[1] & ~1 : 2], left[:, 1::2]
            pair = self.number[one, two]
            if left.shape[1] == self.k:  # the same pairs for all rows
                side = x @ normals[pair[0]].T if len(x) else np.zeros(pair.shape)
            else:
                side = (normals[pair] * x[:, None, :]).sum(axis=2)
            beaten = (side - thresholds[pair] > 0).astype(bool)
            left = np.concatenate([np.where(beaten, two, one), odd], axis=1)
        best = left[:, 0]
        apart = x - centroids[best]
        return best, (apart * apart).sum(axis=1)


def _blocks(batch: pa.RecordBatch, dim: int, scale: int) -> Iterator[tuple[int, int, np.ndarray]]:
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    for at in range(0, len(flat), BLOCK):
        yield at, min(at + BLOCK, len(flat)), _whole(flat[at : at + BLOCK], scale)


def _sums(rows: DataFrame, centroids: list[list[int]], dim: int, scale: int) -> dict[int, tuple[int, list[int]]]:
    """Count and exact sum of the components of every cluster that isn't empty: k rows to the driver."""
    k = len(centroids)
    shared = rows.sparkSession.sparkContext.broadcast(Tournament(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dim), dtype=object)
        for batch in batches:
            for _, _, x in _blocks(batch, dim, scale):
                best, _ = shared.value.winners(x)
                counts += np.bincount(best, minlength=k)
                # A block's own sums stay far below 2^53 where x is a plain array.
                for c in np.unique(best):
                    sums[c] += np.vectorize(int, otypes=[object])(x[best == c].sum(axis=0))
        seen = np.flatnonzero(counts)
        if len(seen):
            # |sum| = high * 2^62 + low, both with the sum's sign: long columns hold what no long does.
            sign = [[-1 if s < 0 else 1 for s in sums[c]] for c in seen]
            low = [[g * (abs(s) % _LONG) for g, s in zip(gs, sums[c], strict=True)] for gs, c in zip(sign, seen, strict=True)]
            high = [[str(g * (abs(s) // _LONG)) for g, s in zip(gs, sums[c], strict=True)] if any(abs(s) >= _LONG for s in sums[c]) else None for gs, c in zip(sign, seen, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen.astype(np.int32)), pa.array(counts[seen]), pa.array(low, pa.list_(pa.int64())), pa.array(high, pa.list_(pa.string()))], names=["cluster", "n", "low", "high"]
            )

    parts = rows.mapInArrow(run, "cluster int, n long, low array<long>, high array<string>")
    total = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.col("low")[d].cast("decimal(38,0)")) for d in range(dim)]).alias("low"),
        F.array(*[F.sum(F.col("high")[d].cast("decimal(38,0)")) for d in range(dim)]).alias("high"),
    )
    found = {r["cluster"]: (r["n"], [int(a) + _LONG * int(b or 0) for a, b in zip(r["low"], r["high"], strict=True)]) for r in total.collect()}
    shared.destroy()
    return found


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256: one row per kept vector.

    Kept are vectors of exactly `dim` components, none null, NaN, infinite or beyond the
    range of a float; component x counts as floor(scale * x), and all arithmetic is on
    whole numbers. The first centroids are the k kept vectors with the least sha256 of
    `seed:id` (of equal ids the vector that sorts first; null ids last); `rounds` times all
    vectors are assigned and every non-empty centroid moves to its vectors' floored mean;
    then they are assigned once more.

    Repeated rows and ids all stay, each a row of its own. Fewer kept vectors than k make
    as many centroids; none make an empty result. A distance or sum beyond a long is null.
    Other columns of the input don't matter, whatever their names.
    """
    spark = tune(vectors.sparkSession)
    if scale <= 0 or scale & (scale - 1):
        raise ValueError("scale must be a power of two, so that products are exact")
    v = F.col(vector_col)
    sound = v.isNotNull() & (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= 3.4028234663852886e38))
    rows = cut_lineage(vectors.where(F.coalesce(sound, F.lit(False))).select(F.col(id_col).alias("id"), v.alias("v")), "vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last()
    first = rows.orderBy(order, "v").limit(k).select(F.col("v").cast("array<double>").alias("v")).collect()
    id_type = vectors.schema[id_col].dataType
    if not first:
        none = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], T.StructType([T.StructField(id_col, id_type), *T._parse_datatype_string(none).fields]))
    centroids = [[int(c) for c in _whole(np.array([r["v"]], dtype=np.float64), scale)[0]] for r in first]
    for _ in range(rounds):
        for c, (n, total) in _sums(rows, centroids, dim, scale).items():
            centroids[c] = [s // n for s in total]
    shared = spark.sparkContext.broadcast(Tournament(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, apart = np.empty(batch.num_rows, dtype=np.int32), []
            for low, high, x in _blocks(batch, dim, scale):
                best[low:high], distance = shared.value.winners(x)
                apart += [int(d) if d < 1 << 63 else None for d in distance]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(best), pa.array(apart, pa.int64())], names=["id", "cluster", "distance"])

    schema = T.StructType([T.StructField("id", id_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    assigned = cut_lineage(rows.mapInArrow(assign, schema), "assigned")
    # A row per cluster, k at most; a sum is null as soon as one of its distances is.
    per = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)"))).alias("d")).collect()}
    as_long: Callable = lambda d: int(d) if d is not None and d < 1 << 63 else None
    whole = None if None in per.values() else as_long(sum(per.values()))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame([(c, as_long(d), whole, digest[c]) for c, d in sorted(per.items())], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int = 40, rounds: int = 5) -> str:
    """The same in DuckDB, round by round."""
    parts = [
        """kept as materialized (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"""c0 as materialized (
  select row_number() over (order by sha256('2:' || vec_id)) - 1 as cluster, v as c from kept order by sha256('2:' || vec_id) limit {k})""",
    ]
    for r in range(rounds + 1):
        parts.append(f"""a{r} as materialized (
  select row, any_value(vec_id) as vec_id, any_value(v) as v, min(list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::bigint * {k} + cluster) as best
  from kept cross join c{r} group by row)""")
        if r < rounds:
            parts.append(f"""c{r + 1} as materialized (
  select o.cluster, coalesce(n.c, o.c) as c from c{r} o left join (
    select cluster, list((s - ((s % n) + n) % n) // n order by i) as c from (
      select best % {k} as cluster, i, sum(v[i])::bigint as s, count(*) as n from a{r} cross join (select unnest(range(1, 65)) as i) group by 1, 2) group by cluster) n
  on o.cluster = n.cluster)""")
    return (
        "with " + ",\n".join(parts) + f"""
select a.vec_id, (a.best % {k})::int as cluster, a.best // {k} as distance, sum(a.best // {k}) over (partition by a.best % {k})::bigint as cluster_inertia,
  sum(a.best // {k}) over ()::bigint as inertia, sha256(array_to_string(c.c, ',')) as centroid_sha256
from a{rounds} a join c{rounds} c on a.best % {k} = c.cluster
"""
    )


SQL = _sql()
