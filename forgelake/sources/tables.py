"""The table set on storage: versions that readers see only when complete."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake import schemas
from forgelake.session import together

COMMIT_SCHEMA = "version bigint, batch_id bigint, places map<string,string>"


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """No rows, and known to have none: joins with it are left out of a plan."""
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.table_schema(name).fields]).limit(0)


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """All tables, empty, in reference order; then those of the jobs."""
    return {name: empty_table(spark, name) for name in [*schemas.TABLE_ORDER, *schemas.JOB_TABLES]}


class TableSet:
    """Tables below one folder. A version becomes visible by one appended commit row.

    The changed tables of a version are written first; the row that names the
    version and where each of its tables lies comes last. A reader never sees half
    a version, unchanged tables are not rewritten, and a batch that is repeated
    after a failure is recognised by its id.

    There may be one writer at a time. Each one writes its tables to places of its own and
    creates the commit entry of its version, which must not exist; of two writers that race
    for a version the second gets an error and has changed nothing. (The file system must
    refuse to create an existing file, as HDFS and local disks do. A writer that dies while it
    writes the entry leaves an empty one, which blocks that version until it is removed.)
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.root}/commits")
        except AnalysisException:
            return self.spark.createDataFrame([], COMMIT_SCHEMA)

    def newest(self) -> tuple[int, dict[str, str]]:
        """The newest complete version and the place of each of its tables; 0 when there is none."""
        row = self._commits().agg(F.max_by(F.struct("version", "places"), "version").alias("c")).first()["c"]
        return (row["version"], dict(row["places"])) if row else (0, {})

    def current(self) -> int:
        return self.newest()[0]

    def has_batch(self, batch_id: int) -> bool:
        return not self._commits().filter(F.col("batch_id") == batch_id).isEmpty()

    def _path(self, name: str, place: str) -> str:
        return f"{self.root}/{name}/{place}"

    def _claim(self, version: int, entry: str) -> None:
        """Create the commit entry of a version; an error when there is one."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits/v{version:09d}.json")
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        try:
            out = files.create(place, False)
        except (PySparkException, Py4JJavaError) as problem:
            raise RuntimeError(f"version {version} of {self.root} was written by another writer") from problem
        try:
            out.write(bytearray(entry.encode()))
        finally:
            out.close()

    def read_all(self) -> dict[str, DataFrame]:
        """All tables of the newest version; empty where it has none."""
        _, places = self.newest()
        return {
            name: self.spark.read.schema(schemas.table_schema(name)).parquet(self._path(name, places[name]))
            if name in places else empty_table(self.spark, name)
            for name in [*schemas.TABLE_ORDER, *schemas.JOB_TABLES]
        }

    def write_job(self, tables: dict[str, DataFrame], base: dict[str, DataFrame]) -> bool:
        """Write a version that belongs to no stream batch; its negative batch id follows from the version."""
        return self.write_all(tables, -(self.current() + 1), base)

    def write_all(self, tables: dict[str, DataFrame], batch_id: int, base: dict[str, DataFrame] | None = None) -> bool:
        """Write a version; false when the batch is already in.

        Tables that are missing, or the very frames of `base`, stay where they are.
        """
        if self.has_batch(batch_id):
            return False
        previous, places = self.newest()
        version = previous + 1
        own = f"v{version:09d}-{uuid.uuid4().hex[:8]}"

        def write(name: str) -> None:
            df = tables[name]
            shaped = df.select(*[
                (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schemas.table_schema(name).fields
            ])
            shaped.write.parquet(self._path(name, own))

        changed = [
            name for name in [*schemas.TABLE_ORDER, *schemas.JOB_TABLES]
            if name in tables and not (base is not None and tables[name] is base.get(name))
        ]
        together(self.spark, {name: lambda name=name: write(name) for name in changed})
        places |= dict.fromkeys(changed, own)
        self._claim(version, json.dumps({"version": version, "batch_id": batch_id, "places": places}) + "\n")
        return True
