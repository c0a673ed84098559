"""Running maxima along a position without gathering a whole key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 100_000


def running_max(df: DataFrame, keys: list[str], pos: str, columns: list[str], bucket: int = BUCKET_ROWS) -> DataFrame:
    """Add `last_<column>`: the highest value of each column among the rows before this one.

    Positions are cut into buckets; a window runs inside each bucket, and the
    maxima of all earlier buckets arrive as one row per bucket.
    """
    cut = df.withColumn("bucket", F.floor(F.col(pos) / F.lit(bucket)))
    per_bucket = cut.groupBy(*keys, "bucket").agg(*[F.max(c).alias(f"top_{c}") for c in columns])
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(*keys, "bucket", *[F.max(f"top_{c}").over(earlier).alias(f"carry_{c}") for c in columns])
    inside = Window.partitionBy(*keys, "bucket").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.select("*", *[F.max(c).over(inside).alias(f"local_{c}") for c in columns])
    return local.join(carried, [*keys, "bucket"]).select(
        *df.columns, *[F.greatest(f"carry_{c}", f"local_{c}").alias(f"last_{c}") for c in columns]
    )
