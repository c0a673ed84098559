"""Settings and files that the operators share."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.session import cut_lineage, new_path, prepare

__all__ = ["cut_lineage", "filled", "new_path", "open_array", "read_table", "tune", "write_array"]


#: Where Python workers on this machine find the library; on a cluster it is installed or shipped as usual.
_ROOT = str(Path(__file__).resolve().parents[2])


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings; small Arrow batches, since texts can be long."""
    prepare(spark)
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, known)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def filled(column: str) -> Column:
    """A text column with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{os.path.abspath(uri)}" if not uri.startswith("file:") else uri)


def write_array(folder: str, name: str, array: np.ndarray) -> None:
    """Write a plain array into the shared folder. A repeated task replaces the file by the same content."""
    fs, path = _place(folder)
    fs.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        out.write(memoryview(np.ascontiguousarray(array)).cast("B") if array.size else b"")
    fs.move(part, f"{path}/{name}")


def open_array(folder: str, name: str, dtype: str) -> np.ndarray:
    """Map an array of the shared folder into memory, read only; of an object store, by way of a local file without a name."""
    fs, path = _place(folder)
    full = f"{path}/{name}"
    info = fs.get_file_info(full)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(full)
    if not info.size:
        return np.empty(0, dtype=dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(full, dtype=dtype, mode="r")
    import tempfile

    with tempfile.TemporaryFile() as local:
        with fs.open_input_stream(full) as source:
            while chunk := source.read(8 << 20):
                local.write(chunk)
        local.flush()
        return np.memmap(local, dtype=dtype, mode="r")


def binary_rows(values: list[bytes]) -> pa.Array:
    return pa.array(values, type=pa.binary())
