"""New and duplicate events per minute on a stream, right for any order and lateness.

Per event id the minute of its first sighting is stored, by batch and by range of ids as in the
store of `exact_dedup_sink`. A batch is joined with the ranges its ids fall into; that tells
what it changes: sightings per minute, and a moved `new` when an earlier sighting comes in late.
These changes are stored batch by batch. Nothing is dropped behind a watermark; a late row is a
change like any other. Folding the stored changes gives the batch operator's result at any moment.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.session import cut_lineage
from forgelake.streaming.jobs import ID_RANGE, append_batch, id_range, previous_batch, stored_near


def sightings(events: DataFrame, ts: str = "created_at", key: str = "id", width: str = "minute") -> DataFrame:
    """key and unit (seconds) of each event that has both."""
    units = events.select(F.col(key).alias("key"), F.unix_seconds(F.date_trunc(width, ts)).alias("unit"))
    return units.filter("key is not null and unit is not null")


def ratio_sink(path: str, firsts: str, forget_after_ms: int | None = None, width: int = ID_RANGE):
    """foreachBatch over sightings: what a batch changes (unit, total, fresh), one row per unit, under its own id.

    `firsts` is the folder of the first sightings; it grows by one row per id, and one more when
    an earlier sighting comes in. With `forget_after_ms` an id that was silent so long, in
    processing time, is forgotten; a copy after that counts as new. Then every batch an id is
    seen in stores it anew.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        previous_batch(spark, path, "batch_id=", batch_id)
        now = int(time.time() * 1000)
        batch = cut_lineage(batch, "batch")
        seen = batch.groupBy("key").agg(F.min("unit").alias("low")).withColumn("seen_ms", F.lit(now))
        earlier = stored_near(spark, firsts, seen, batch_id, "key", width, ["low", "seen_ms"])
        if forget_after_ms is not None:
            earlier = earlier.filter(F.col("seen_ms") + forget_after_ms > now)
        known = earlier.groupBy("key").agg(F.min("low").alias("known"))
        moved = F.col("known").isNull() | (F.col("low") < F.col("known"))
        judged = seen.join(known, "key", "left")
        judged = judged.filter(moved) if forget_after_ms is None else judged
        kept = judged.select("key", F.least("low", "known").alias("low"), "seen_ms", "known", id_range("key", width).alias("id_range"))
        kept.repartition("id_range").write.mode("overwrite").partitionBy("id_range").parquet(f"{firsts}/batch_id={batch_id}")
        stored = spark.read.schema(kept.schema).parquet(f"{firsts}/batch_id={batch_id}").filter(moved)
        changes = batch.select("unit", F.lit(1).alias("total"), F.lit(0).alias("fresh")).unionByName(
            stored.select(F.col("low").alias("unit"), F.lit(0).alias("total"), F.lit(1).alias("fresh"))
        ).unionByName(stored.filter("known is not null").select(F.col("known").alias("unit"), F.lit(0).alias("total"), F.lit(-1).alias("fresh")))
        append_batch(path, batch_id, changes.groupBy("unit").agg(F.sum("total").alias("total"), F.sum("fresh").alias("fresh")))

    return write


def folded_ratio(changes: DataFrame) -> DataFrame:
    """bucket, new_events, duplicate_events and ratio of all changes stored so far."""
    sums = changes.groupBy("unit").agg(F.sum("total").alias("total"), F.sum("fresh").alias("new_events"))
    duplicates = F.col("total") - F.col("new_events")
    return sums.select(
        F.timestamp_seconds("unit").alias("bucket"), "new_events", duplicates.alias("duplicate_events"), F.try_divide(duplicates, F.col("total")).alias("ratio")
    )
