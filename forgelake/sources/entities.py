"""Raw collections, the event feed and work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from forgelake import schemas

CORRUPT = "_corrupt_record"


def parse_lines(lines: DataFrame, name: str, keep_raw: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """JSON lines (column `value`) of a collection as typed columns.

    Only the known paths are parsed; `raw` keeps the whole body as a variant.
    Lines that are no JSON give null columns, and their text in `_corrupt_record`.
    """
    schema = schemas.raw_schema(name)
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())]) if keep_corrupt else schema
    parsed = F.from_json("value", wide, {"columnNameOfCorruptRecord": CORRUPT} if keep_corrupt else {})
    others = [c for c in lines.columns if c != "value"]
    extra = [F.try_parse_json("value").alias("raw")] if keep_raw else []
    return lines.select(*others, parsed.alias("record"), *extra).select(
        *others, "record.*", *(["raw"] if keep_raw else [])
    )


def json_reader(reader, name: str, keep_corrupt: bool = False):
    """Schema and options for the JSON source; unread paths are skipped while parsing."""
    schema = schemas.raw_schema(name)
    if keep_corrupt:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)


def read_entity(spark: SparkSession, name: str, path: str, keep_raw: bool = False) -> DataFrame:
    """A raw collection by name; an unknown name is an error."""
    if keep_raw:
        schemas.raw_schema(name)
        return parse_lines(spark.read.text(path), name, keep_raw=True)
    return json_reader(spark.read, name).json(path)


def read_events(
    spark: SparkSession, path: str | None = None, streaming: bool = False, source: str = "json",
    options: dict[str, str] | None = None, keep_corrupt: bool = False,
) -> DataFrame:
    """The event feed, in batch or as a stream, with one schema.

    `source` is `json` for files, or another built-in source such as `kafka`,
    whose value column then holds the JSON.
    """
    reader = (spark.readStream if streaming else spark.read).options(**(options or {}))
    if source == "json":
        return json_reader(reader, "events", keep_corrupt).json(path)
    loaded = reader.format(source).load(path) if path else reader.format(source).load()
    return parse_lines(loaded.select(F.col("value").cast("string").alias("value")), "events", keep_corrupt=keep_corrupt)


def repo_events(events: DataFrame, full_name: str | Column) -> DataFrame:
    """Events of one repository."""
    name = F.lit(full_name) if isinstance(full_name, str) else full_name
    return events.filter(F.col("repo.name") == name)


def read_worklist(spark: SparkSession, path: str, done: DataFrame | None = None) -> DataFrame:
    """`owner repo` lines or single ids, without those already processed."""
    words = F.split(F.trim("value"), r"\s+")
    items = spark.read.text(path).filter(F.trim("value") != "").select(
        F.get(words, F.lit(0)).alias("item"), F.get(words, F.lit(1)).alias("repo")
    ).distinct()
    if done is None:
        return items
    match = [items["item"].eqNullSafe(done["item"]), items["repo"].eqNullSafe(done["repo"])]
    return items.join(done, match[0] & match[1], "left_anti")
