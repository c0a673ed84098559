"""Log lines in, metric points out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_STARTS = "^[IDEW]"  # Fixed value: info, debug, error and warning lines


def keep_log_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    return lines.filter(F.col(column).rlike(LINE_STARTS))


def read_logs(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Lines of worker logs, in batch or as a stream."""
    reader = spark.readStream if streaming else spark.read
    return keep_log_lines(reader.text(path).withColumnRenamed("value", "line"))


def tagged(points: DataFrame) -> DataFrame:
    """Points with their tags as one map; absent tags are left out."""
    names = [c for c in points.columns if c not in ("series", "time", "value")]
    tags = F.map_filter(
        F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n) for n in names])), lambda _, v: v.isNotNull()
    )
    return points.select("series", F.try_to_timestamp("time").alias("time"), tags.alias("tags"), "value")


def write_points(points: DataFrame, path: str, mode: str = "append") -> None:
    """Append points to a Parquet store partitioned by series."""
    tagged(points).write.mode(mode).partitionBy("series").parquet(path)


def points_sink(path: str):
    """The stream form of `write_points`, for foreachBatch; a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged(batch).write.mode("overwrite").partitionBy("series").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write
