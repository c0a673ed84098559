"""Exact top-k inner products by best-first search of a paged M-tree.

Largest inner product is a nearest-neighbour search: with M2 the largest squared length of
all vectors, a vector x gets one more coordinate sqrt(M2 - |x|^2) and a query gets 0 there.
Then d(q, x)^2 = |q|^2 + M2 - 2 q.x, a distance, so triangle inequalities bound scores.

The tree has three levels of metric nodes above the vectors: regions around pivots from a
bounded sample, pages of about PAGE vectors of one region, and leaves of about LEAF vectors
of one page. Every node has a routing vector and a covering radius, every entry its
distance to the routing vector of its node. Each page is one row, so a vector that a third
of all rows share only makes more pages.

Queries go in blocks of one region. A first pass searches one page for each query, which
bounds its k-th score; a second pass searches the pages that the bounds do not rule out.
Inside a page, leaves are taken best first; a leaf is skipped for the queries whose bound it
can't reach, and entries are skipped by their stored distance before anything is computed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgelake.llm.shared import cut_lineage, tune

#: Pivots, from so many vectors with the least hash; all vectors are indexed.
PIVOTS = 32
SAMPLE = 2048
PAGE = 1024
LEAF = 64
QUERY_BLOCK = 256


def _slack(m2: float) -> float:
    """More than rounding can take from a distance between vectors of squared length up to m2."""
    return 1e-6 * (1 + np.sqrt(m2))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Integer vectors as rows of doubles, shorter ones filled up with zeros."""
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _lifted(x: np.ndarray, m2: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(m2 - (x * x).sum(axis=1), 0))[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def _spread(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots of a sample, each as far as possible from those before."""
    chosen = [0] if len(sample) else []
    if chosen:
        away = _distances(sample, sample[:1])[:, 0]
        while len(chosen) < count and away.max() > 1e-6:
            chosen.append(int(away.argmax()))
            away = np.minimum(away, _distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def _block(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def _build_page(ids: np.ndarray, x: np.ndarray, pivot: np.ndarray, m2: float) -> dict[str, bytes | float]:
    """One page: routing vectors of page and leaves, radii, distances to the parent, entries by leaf and distance."""
    y = _lifted(x, m2)
    route = y[_distances(y, y.mean(axis=0)[None])[:, 0].argmin()]
    leaves = _spread(y, max(1, len(y) // LEAF))
    near = _distances(y, leaves)
    leaf, away = near.argmin(axis=1), near.min(axis=1)
    order = np.lexsort((ids, away, leaf))
    counts = np.bincount(leaf, minlength=len(leaves))
    radius = np.zeros(len(leaves))
    np.maximum.at(radius, leaf, away)
    return {
        "route": _block(route), "radius": float(_distances(y, route[None]).max()), "from_pivot": float(_distances(route[None], pivot[None])[0, 0]),
        "leaves": _block(leaves), "leaf_radius": _block(radius), "leaf_parent": _block(_distances(leaves, route[None])[:, 0]),
        "leaf_rows": _block(np.cumsum(counts).astype(np.int64)), "ids": _block(ids[order]), "vectors": _block(x[order].astype(np.int32)), "parent": _block(away[order]),
    }


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search_page(page: dict[str, bytes | float], queries: np.ndarray, query_ids: np.ndarray, least: np.ndarray, pivot: np.ndarray, m2: float, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query, the page's entries that can be among its k best: ids and scores, given scores known to be reached."""
    dim = queries.shape[1]
    q = np.hstack([queries, np.zeros((len(queries), 1))])
    level = (q * q).sum(axis=1) + m2
    least = least.astype(np.float64).copy()
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(q)

    def reach(rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Distance at which a score equals the bound, for some of the queries."""
        return np.sqrt(np.maximum(level[rows] - 2 * least[rows], 0)) + _slack(m2)

    # The page by its stored distance to the pivot first, then by its own.
    alive = np.abs(_distances(q, pivot[None])[:, 0] - page["from_pivot"]) - page["radius"] <= reach()
    route = np.frombuffer(page["route"]).reshape(1, dim + 1)
    to_route = np.full(len(q), np.inf)
    to_route[alive] = _distances(q[alive], route)[:, 0]
    alive &= to_route - page["radius"] <= reach()
    rows = np.flatnonzero(alive)
    if not len(rows):
        return found
    leaves, radius, parent = np.frombuffer(page["leaves"]).reshape(-1, dim + 1), np.frombuffer(page["leaf_radius"]), np.frombuffer(page["leaf_parent"])
    ends, ids = np.frombuffer(page["leaf_rows"], np.int64), np.frombuffer(page["ids"], np.int64)
    vectors, away = np.frombuffer(page["vectors"], np.int32).reshape(-1, dim), np.frombuffer(page["parent"])
    near = np.maximum(_distances(q[rows], leaves) - radius[None], np.abs(to_route[rows][:, None] - parent[None]) - radius[None])
    for leaf in np.argsort(near.min(axis=0), kind="stable"):
        bound = reach(rows)
        open_rows = np.flatnonzero(near[:, leaf] <= bound)
        if not len(open_rows):
            continue
        own = rows[open_rows]
        centre = _distances(q[own], leaves[leaf : leaf + 1])[:, 0]
        low, high = ends[leaf - 1] if leaf else 0, ends[leaf]
        # Entries whose distance to the leaf's routing vector already rules them out for all these queries.
        a, b = low + np.searchsorted(away[low:high], (centre - bound[open_rows]).min()), low + np.searchsorted(away[low:high], (centre + bound[open_rows]).max(), side="right")
        if a >= b:
            continue
        scores = queries[own] @ vectors[a:b].T.astype(np.float64)
        for r, line in zip(own, scores, strict=True):
            keep = np.flatnonzero((line >= least[r]) & (ids[a:b] != query_ids[r]))
            if len(keep):
                old = found[r]
                best = _best(np.concatenate([old[0], ids[a:b][keep]]), np.concatenate([old[1], line[keep].astype(np.int64)]), k)
                found[r] = best
                if len(best[0]) == k:
                    least[r] = max(least[r], float(best[1][-1]))
    return found


_PAGE_COLUMNS = ["route", "radius", "from_pivot", "leaves", "leaf_radius", "leaf_parent", "leaf_rows", "ids", "vectors", "parent"]
_PAGE_SCHEMA = "region int, page long, " + ", ".join(f"{c} {'double' if c in ('radius', 'from_pivot') else 'binary'}" for c in _PAGE_COLUMNS)


def _search(joined: DataFrame, pivots, dim: int, m2: float, k: int) -> DataFrame:
    """query_id, vec_id, score of pages joined with query blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                query_ids = np.frombuffer(row["query_ids"], np.int64)
                found = search_page(row, np.frombuffer(row["query_vectors"], np.int32).reshape(-1, dim).astype(np.float64), query_ids, np.frombuffer(row["least"]), pivots.value[row["region"]], m2, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(query_ids, [len(f[0]) for f in found])), pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]))], names=["query_id", "vec_id", "score"]
                )

    return joined.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer inner products, ties to the smaller id.

    `is_query` is a condition on the rows. Components become floor(scale * x). Vectors that
    are null or hold a null or non-finite component take no part, nor do rows with a null
    id; of rows that repeat an id the least vector stands. Vectors of different length are
    compared as if the shorter had zeros at its end; an empty vector scores 0 with all.
    """
    spark = tune(vectors.sparkSession)
    v = F.col(vector_col)
    sound = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(sound).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("v"), is_query.alias("is_query"))
    rows = cut_lineage(rows.groupBy("vec_id").agg(F.min(F.struct("v", "is_query")).alias("x")).select("vec_id", "x.v", "x.is_query"), "vectors")
    square = F.aggregate("v", F.lit(0).cast("long"), lambda total, x: total + x.cast("long") * x)
    top = rows.agg(F.max(square).alias("m2"), F.max(F.size("v")).alias("dim")).first()
    if top["m2"] is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    m2, dim = float(top["m2"]), int(top["dim"])
    taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    sample = np.zeros((len(taken), dim))
    for i, r in enumerate(taken):
        sample[i, : len(r["v"])] = r["v"]
    pivots = spark.sparkContext.broadcast(_spread(_lifted(sample, m2), PIVOTS))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            region = _distances(_lifted(x, m2), pivots.value).argmin(axis=1) if len(x) else np.empty(0, np.int64)
            plain = x.astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([r.tobytes() for r in plain], pa.binary()), pa.array(region.astype(np.int32)), batch.column("is_query")], names=["vec_id", "x", "region", "is_query"])

    placed = cut_lineage(rows.mapInArrow(place, "vec_id long, x binary, region int, is_query boolean"), "placed")
    # A row per region, PIVOTS at most.
    per_region = F.broadcast(placed.groupBy("region").agg(F.count("*").alias("n")))
    paged = placed.join(per_region, "region").withColumn("page", F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("n") / PAGE)))

    def build(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        ids = table.column("vec_id").to_numpy()
        x = np.frombuffer(b"".join(table.column("x").to_pylist()), np.int32).reshape(len(ids), dim).astype(np.float64)
        page = _build_page(ids, x, pivots.value[key[0].as_py()], m2)
        yield pa.RecordBatch.from_pydict({"region": pa.array([key[0].as_py()], pa.int32()), "page": pa.array([key[1].as_py()], pa.int64())} | {c: pa.array([page[c]]) for c in _PAGE_COLUMNS})

    pages = cut_lineage(paged.groupBy("region", "page").applyInArrow(build, _PAGE_SCHEMA), "pages")

    queries = placed.where("is_query")
    per_block = F.broadcast(queries.groupBy("region").agg(F.count("*").alias("nq")))
    blocked = queries.join(per_block, "region").withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.ceil(F.col("nq") / QUERY_BLOCK)))

    def gather(rows: DataFrame) -> DataFrame:
        """One row per query block; a block has a bounded number of queries."""
        return rows.groupBy("q_region", "block").agg(F.sort_array(F.collect_list(F.struct("vec_id", "x", "least"))).alias("q"))

    def packed(blocks: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    q = row["q"]
                    yield pa.RecordBatch.from_pydict({
                        "q_region": pa.array([row["q_region"]], pa.int32()), "block": pa.array([row["block"]], pa.int64()),
                        "query_ids": pa.array([np.array([r["vec_id"] for r in q], np.int64).tobytes()]), "query_vectors": pa.array([b"".join(r["x"] for r in q)]),
                        "least": pa.array([np.array([r["least"] for r in q], np.float64).tobytes()]),
                    })

        return blocks.mapInArrow(run, "q_region int, block long, query_ids binary, query_vectors binary, least binary")

    start = packed(gather(blocked.select(F.col("region").alias("q_region"), "block", "vec_id", "x", F.lit(float("-inf")).alias("least"))))
    home = start.withColumn("region", F.col("q_region")).join(pages.where("page = 0"), "region")
    first = cut_lineage(_search(home, pivots, dim, m2, k), "first")
    bounds = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("lowest")).where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), F.col("lowest").cast("double").alias("least"))
    bounded = blocked.select(F.col("region").alias("q_region"), "block", "vec_id", "x").join(bounds, "vec_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    # Radii of the regions around their pivots rule out whole regions for a block; a row per region.
    radii = {r["region"]: r["r"] for r in pages.groupBy("region").agg(F.max(F.col("from_pivot") + F.col("radius")).alias("r")).collect()}
    spans = spark.sparkContext.broadcast(radii)

    def open_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep_rows, keep_regions = [], []
            for i in range(batch.num_rows):
                q = np.frombuffer(batch.column("query_vectors")[i].as_py(), np.int32).reshape(-1, dim).astype(np.float64)
                q = np.hstack([q, np.zeros((len(q), 1))])
                reach = np.sqrt(np.maximum((q * q).sum(axis=1) + m2 - 2 * np.frombuffer(batch.column("least")[i].as_py()), 0)) + _slack(m2)
                to_pivots = _distances(q, pivots.value)
                for region, radius in spans.value.items():
                    if (to_pivots[:, region] - radius <= reach).any():
                        keep_rows.append(i)
                        keep_regions.append(region)
            rows = pa.array(keep_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keep_regions, pa.int32()), *[c.take(rows) for c in batch.columns]], names=["region", *batch.schema.names])

    second = packed(gather(bounded)).mapInArrow(open_regions, "region int, q_region int, block long, query_ids binary, query_vectors binary, least binary")
    # The page searched in the first pass stays out.
    rest = second.join(pages, "region").where("not (region = q_region and page = 0)")
    both = first.unionByName(_search(rest.repartition("region", "page", "q_region", "block"), pivots, dim, m2, k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The same in DuckDB.
SQL = """
with sound as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
  from sound q join sound c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""
