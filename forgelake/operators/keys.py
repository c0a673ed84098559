"""Dense surrogate ids for new natural keys."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgelake.operators.changes import missing
from forgelake.session import cut_lineage

BUCKET_DIGITS = 3  # hexadecimal digits: 4,096 buckets


def key_bucket(keys: list[str], digits: int = BUCKET_DIGITS) -> Column:
    """Evenly spread bucket of a natural key."""
    text = F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys])
    return F.substring(F.md5(text), 1, digits)


def bucket_offsets(sizes: DataFrame, dim: DataFrame, id_col: str) -> DataFrame:
    """The last id before each bucket (bucket, n): behind the highest of `dim` and the buckets before."""
    highest = dim.agg(F.greatest(F.coalesce(F.max(id_col), F.lit(0)), F.lit(0)).cast("bigint").alias("n")).select(
        F.lit("").alias("bucket"), "n"
    )
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return highest.unionByName(sizes).select("bucket", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("offset"))


def assign_dense_ids(
    rows: DataFrame, dim: DataFrame, keys: list[str], id_col: str = "id", digits: int = BUCKET_DIGITS
) -> DataFrame:
    """New keys with ids that continue from the highest id of `dim`.

    Ids are consecutive by (bucket, key) and do not depend on the partitioning.
    Each bucket is numbered by itself; the offsets of at most 16**digits buckets
    are one small running sum, which is broadcast.
    """
    new_keys = missing(rows.select(*keys).distinct(), dim, keys).withColumn("bucket", key_bucket(keys, digits))
    offsets = bucket_offsets(new_keys.groupBy("bucket").agg(F.count("*").alias("n")), dim, id_col)
    position = F.row_number().over(Window.partitionBy("bucket").orderBy(*keys))
    return (
        new_keys.withColumn("position", position)
        .join(F.broadcast(offsets), "bucket")
        .select(*keys, (F.col("offset") + F.col("position")).cast("bigint").alias(id_col))
    )


def numbered_rows(rows: DataFrame, dim: DataFrame, keys: list[str], id_col: str = "id", digits: int = BUCKET_DIGITS) -> DataFrame:
    """New rows with the ids that `assign_dense_ids` gives their keys; rows with a null in their key get none and are left out.

    The rows themselves are dealt to the buckets, once, instead of their keys and then both to meet again.
    Keys with a null take their number once each, however many rows have them.
    """
    complete = rows.dropna(subset=keys)
    holed = rows.filter(reduce(or_, [F.col(k).isNull() for k in keys])).select(*keys).distinct()
    whole = complete.unionByName(holed, allowMissingColumns=True).withColumn("bucket", key_bucket(keys, digits))
    placed = whole.withColumn("position", F.dense_rank().over(Window.partitionBy("bucket").orderBy(*keys)))
    offsets = bucket_offsets(placed.groupBy("bucket").agg(F.max("position").cast("bigint").alias("n")), dim, id_col)
    return placed.dropna(subset=keys).join(F.broadcast(offsets), "bucket").select(
        *rows.columns, (F.col("offset") + F.col("position")).cast("bigint").alias(id_col)
    )


def append_with_ids(table: DataFrame, rows: DataFrame, keys: list[str], id_col: str = "id") -> DataFrame:
    """Insert the rows whose key is new, with fresh ids; `rows` has one row per key.

    The rows are computed once and written, since numbering reads them several
    times; so are the new ones, which the steps that follow read beside the stored table.
    """
    staged = cut_lineage(rows.drop(id_col), "staged_rows")
    fresh = cut_lineage(numbered_rows(missing(staged, table, keys), table, keys, id_col), "new_rows")
    return table.unionByName(fresh, allowMissingColumns=True)
