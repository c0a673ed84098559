"""Streaming forms of the batch operators, over the same functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.functions.scalars import forge_ts, project_message, route_key
from forgelake.operators.changes import replace
from forgelake.operators.history import TOLERANCE_SECONDS, build_history
from forgelake.operators.logs import WORKER_COLUMNS, parse_worker_lines, state_lines, worker_latest
from forgelake.session import cut_lineage
from forgelake.sources.entities import CORRUPT
from forgelake.sources.tables import TableSet

PROJECT_ROUTE = "evt.projects"  # Fixed value
REQUEUED = ["MemberEvent", "FollowEvent"]  # Fixed values: types queued beside project names


def dedup_stream(events: DataFrame, delay: str, ts: str = "created_at", key: str = "id") -> DataFrame:
    """Drop events whose id was seen before, within the delay. The timestamp must be of type timestamp."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def route(events: DataFrame, projects_only: bool = False, requeue: list[str] = REQUEUED) -> DataFrame:
    """route_key and message of each event: by type, or project names plus the requeued types."""
    by_type = events.select(route_key(F.col("type")).alias("route_key"), F.col("id").cast("string").alias("message"))
    if not projects_only:
        return by_type
    projects = events.select(F.lit(PROJECT_ROUTE).alias("route_key"), project_message(F.col("repo.name")).alias("message"))
    return projects.unionByName(by_type.filter(F.col("route_key").isin([f"evt.{t}" for t in requeue])))


# Required paths per event type: without them the handler has nothing to work on.
REQUIRED: dict[str, list[str]] = {
    "PushEvent": ["payload.commits"],
    "WatchEvent": ["repo.name", "actor.login"],
    "FollowEvent": ["actor.login", "payload.target.login"],
    "MemberEvent": ["actor.login", "repo.name", "payload.member.login"],
    "CommitCommentEvent": ["repo.name", "payload.comment.id", "payload.comment.commit_id"],
    "PullRequestEvent": ["payload.number", "payload.pull_request.base.repo.owner.login", "payload.pull_request.base.repo.name"],
    "ForkEvent": ["repo.name", "payload.forkee.id"],
    "PullRequestReviewCommentEvent": ["repo.name", "payload.comment.id", "payload.comment._links.pull_request.href"],
    "IssuesEvent": ["repo.name", "payload.issue.number"],
    "IssueCommentEvent": ["repo.name", "payload.issue.number", "payload.comment.id"],
    "CreateEvent": ["repo.name", "payload.ref_type"],
}


def defect(events: DataFrame) -> Column:
    """Why an event cannot be processed; null for a sound one."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "unparsable") if CORRUPT in events.columns else F.when(F.lit(False), "")
    reason = reason.when(F.col("id").isNull(), "no id").when(F.col("type").isNull(), "no type")
    reason = reason.when(forge_ts(F.col("created_at").cast("string")).isNull(), "bad timestamp")
    for event_type, paths in REQUIRED.items():
        for dotted in paths:
            reason = reason.when((F.col("type") == event_type) & F.col(dotted).isNull(), f"no {dotted}")
    return reason


def quarantine(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sound events, and the others with their reason."""
    marked = events.withColumn("reason", defect(events))
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null")


def read_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table of a folder, or an empty one when there is no such folder; any other failure is an error."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], like.schema)


def previous_batch(spark: SparkSession, folder: str, prefix: str, batch_id: int) -> int | None:
    """Id of the newest complete batch stored before this one; earlier ids need not be consecutive.

    A later one than this means that the stream's checkpoint is not the one the store was
    written with; going on would overwrite the store, so that is an error.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return None
    places = [s.getPath() for s in files.listStatus(root) if s.getPath().getName().startswith(prefix)]
    done = [int(p.getName()[len(prefix):]) for p in places if files.exists(p.suffix("/_SUCCESS"))]
    if any(n > batch_id for n in done):
        raise RuntimeError(f"{folder} already holds batch {max(done)}, after batch {batch_id}: the checkpoint is another one")
    return max((n for n in done if n < batch_id), default=None)


def previous_version(spark: SparkSession, folder: str, batch_id: int, like: DataFrame) -> DataFrame:
    """The newest complete version before a batch; empty when there is none."""
    before = previous_batch(spark, folder, "v", batch_id)
    return spark.createDataFrame([], like.schema) if before is None else spark.read.schema(like.schema).parquet(f"{folder}/v{before:09d}")


def append_batch(path: str, batch_id: int, rows: DataFrame) -> None:
    """Store a batch under its own id, so that a repeated batch replaces itself."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def routes_sink(path: str, projects_only: bool = False) -> Callable[[DataFrame, int], None]:
    """foreachBatch: route each batch into one store partitioned by route."""

    def write(batch: DataFrame, batch_id: int) -> None:
        route(batch, projects_only).write.mode("overwrite").partitionBy("route_key").parquet(f"{path}/batch_id={batch_id}")

    return write


# Ids per folder of the store: event ids grow with time, so a batch meets few folders.
ID_RANGE = 1_000_000
MOST_RANGES = 1_000


def id_range(key: str, width: int = ID_RANGE) -> Column:
    """Folder of an id: its million; ids that are no numbers are dealt by hash below zero."""
    number = F.col(key).try_cast("bigint")
    return F.coalesce(F.floor(number / F.lit(width)), -1 - F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(64)))


def stored_near(spark: SparkSession, path: str, batch: DataFrame, batch_id: int, key: str, width: int, columns: Sequence[str] = ()) -> DataFrame:
    """Keys (and other columns) that earlier batches stored, of the folders that a batch touches only.

    The touched folders, at most MOST_RANGES numbers, become a partition filter; a batch that is
    spread wider reads the whole store.
    """
    like = batch.select(key, *columns).withColumns({"batch_id": F.lit(0), "id_range": F.lit(0).cast("bigint")})
    earlier = read_or_empty(spark, path, like).filter(F.col("batch_id") < batch_id)
    touched = [r["r"] for r in batch.select(id_range(key, width).alias("r")).distinct().limit(MOST_RANGES + 1).collect()]
    return earlier.filter(F.col("id_range").isin(touched)) if len(touched) <= MOST_RANGES else earlier


def exact_dedup_sink(path: str, key: str = "id", width: int = ID_RANGE) -> Callable[[DataFrame, int], None]:
    """foreachBatch: store events whose key no earlier batch stored, however late they come.

    The store is partitioned by batch and by range of ids. A batch is joined only with the
    folders its ids fall into, so its cost follows the batch and not the store: new events have
    new ids, and late copies reach back into few folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        previous_batch(batch.sparkSession, path, "batch_id=", batch_id)
        batch = cut_lineage(batch, "batch")
        earlier = stored_near(batch.sparkSession, path, batch, batch_id, key, width)
        fresh = batch.dropDuplicates([key]).join(earlier.select(key), key, "left_anti").select(*batch.columns, id_range(key, width).alias("id_range"))
        cut_lineage(fresh).repartition("id_range").write.mode("overwrite").partitionBy("id_range").parquet(f"{path}/batch_id={batch_id}")

    return write


def tables_sink(
    table_set: TableSet, apply: Callable[[dict[str, DataFrame], DataFrame], dict[str, DataFrame]], rejects: str
) -> Callable[[DataFrame, int], None]:
    """foreachBatch: current tables and the sound events of a batch give the next version; a repeated batch is skipped.

    Events that cannot be processed go to the `rejects` folder, with their reason.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if table_set.has_batch(batch_id):
            return
        sound, broken = quarantine(cut_lineage(batch, "batch"))
        append_batch(rejects, batch_id, broken)
        tables = table_set.read_all()
        table_set.write_all(apply(tables, sound), batch_id, tables)

    return write


HISTORY_KEYS = ["pull_request_id", "action"]


def history_sink(candidates: str, histories: str, tolerance: int = TOLERANCE_SECONDS) -> Callable[[DataFrame, int], None]:
    """foreachBatch: keep all candidate rows, fold the groups the batch touches anew.

    Late rows therefore give the same histories as a batch over everything.
    Versions of the histories lie side by side; the highest batch id is current.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        previous_batch(spark, histories, "v", batch_id)
        append_batch(candidates, batch_id, batch)
        touched = batch.select(*HISTORY_KEYS).distinct()
        rows = spark.read.schema(batch.schema).parquet(candidates).join(touched, HISTORY_KEYS, "left_semi")
        fresh = build_history(rows, tolerance)
        previous = previous_version(spark, histories, batch_id, fresh)
        replace(previous, fresh, HISTORY_KEYS).write.mode("overwrite").parquet(f"{histories}/v{batch_id:09d}")

    return write


def worker_sink(states: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch over log lines (seq, line): the state of each worker after every batch.

    The stored state of a worker stands for all its earlier lines; a worker's
    lines must arrive in order, as the tail of a log gives them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        lines = cut_lineage(parse_worker_lines(batch).select(*WORKER_COLUMNS), "worker_lines")
        previous = previous_version(spark, states, batch_id, worker_latest(lines))
        touched = previous.join(lines.select("pid").distinct(), "pid", "left_semi")
        fresh = worker_latest(state_lines(touched).unionByName(lines))
        replace(previous, fresh, ["pid"]).write.mode("overwrite").parquet(f"{states}/v{batch_id:09d}")

    return write


def run_to_end(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> int:
    """Process everything that is available in batches and stop; gives the id of the last batch."""
    running = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()
    return running.lastProgress["batchId"] if running.lastProgress else -1
