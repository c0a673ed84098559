"""Pull request histories with a time tolerance.

A sighting within the tolerance of an already *kept* row of the same pull
request and action is the same happening. This is a greedy rule: with three
seconds, sightings at 0, 2, 4, 6 keep 0 and 4. It is no gap sessionization.

The fold is cut into time buckets, so that one pull request with a very large
share of all rows is worked on by many tasks. What a bucket needs from its
predecessor is only the moment last kept there; those moments are found by a
small fold over the buckets that have rows close to a boundary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions.scalars import forge_ts
from forgelake.operators.changes import union_all

TOLERANCE_SECONDS = 3  # Fixed value
ONCE_ACTIONS = ["opened", "merged"]  # Fixed values: kept at most once per pull request
MIN_BUCKET_SECONDS = 6 * 3600

KEYS = ["pull_request_id", "action"]


def history_candidates(prs: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Candidate rows: opened, merged and closed as the record states, and the event's own action.

    `prs` is the staged record with pull_request_id; `events` has
    pull_request_id, action, actor, created_at and id. The record's merge or
    closure is left out when the event itself reports it. Pull requests whose
    author is unknown yield nothing.
    """
    known = prs.filter("user.login is not null")
    merged = F.col("merged_at").isNotNull()
    own = F.col("event_action") if "event_action" in prs.columns else F.lit(None).cast("string")
    actor = F.col("event_actor") if "event_actor" in prs.columns else F.lit(None).cast("string")
    merger = F.coalesce(F.col("merged_by.login"), actor)
    closer = F.when(merged, merger).otherwise(actor)

    def row(action: str, ts: Column, who: Column, wanted: Column) -> Column:
        return F.when(wanted, F.struct(F.lit(action).alias("action"), forge_ts(ts).alias("created_at"), who.alias("actor")))

    rows = F.array_compact(F.array(
        row("opened", F.col("created_at"), F.col("user.login"), F.lit(True)),
        row("merged", F.col("merged_at"), merger, merged & ~own.eqNullSafe("merged")),
        row("closed", F.col("closed_at"), closer, F.col("closed_at").isNotNull() & ~own.eqNullSafe("closed")),
    ))
    stated = known.select("pull_request_id", F.explode(rows).alias("r"), F.lit(0).cast("bigint").alias("id")).select(
        "pull_request_id", "r.action", "r.created_at", "r.actor", "id"
    )
    if events is None:
        return stated
    reported = events.filter("action is not null").join(known.select("pull_request_id"), "pull_request_id", "left_semi")
    return stated.unionByName(reported.select(*stated.columns))


def moments(candidates: DataFrame) -> DataFrame:
    """One row per pull request, action and second, with the first known actor of that second."""
    second = F.unix_seconds(F.col("created_at").cast("timestamp"))
    return candidates.groupBy(*KEYS, second.alias("sec")).agg(
        F.min("id").alias("id"), F.min_by("actor", F.when(F.col("actor").isNotNull(), F.col("id"))).alias("actor")
    )


def keep_once(points: DataFrame, tolerance: int) -> DataFrame:
    """First moment per key; a missing actor is filled from within the tolerance only."""
    named = F.min_by(F.struct("actor", "sec"), F.when(F.col("actor").isNotNull(), F.col("sec")))
    firsts = points.groupBy(*KEYS).agg(F.min("sec").alias("sec"), F.min_by("id", "sec").alias("id"), named.alias("named"))
    return firsts.select(
        *KEYS, "sec", "id", F.when(F.col("named.sec") - F.col("sec") <= tolerance, F.col("named.actor")).alias("actor")
    )


def keep_tolerant(points: DataFrame, tolerance: int, bucket_seconds: int | None = None) -> DataFrame:
    """Greedy fold per key, with a missing actor filled from the sightings a kept row absorbed."""
    width = max(bucket_seconds or MIN_BUCKET_SECONDS, 2 * (tolerance + 1))
    bucketed = points.groupBy(*KEYS, F.floor(F.col("sec") / F.lit(width)).alias("bucket")).agg(
        F.sort_array(F.collect_list(F.struct("sec", "id", "actor"))).alias("rows")
    )
    entries = bucket_entries(bucketed, tolerance, width)
    opened = bucketed.join(entries, [*KEYS, "bucket"], "left")
    # State of the fold: the moment last kept and, per row, the moment that absorbs it.
    absorbed = F.aggregate(
        "rows",
        F.struct(F.col("entry").alias("last"), F.array().cast("array<bigint>").alias("kept")),
        lambda state, r: F.struct(
            next_kept(state["last"], r["sec"], tolerance).alias("last"),
            F.concat(state["kept"], F.array(next_kept(state["last"], r["sec"], tolerance))).alias("kept"),
        ),
        lambda state: state["kept"],
    )
    rows = opened.select(*KEYS, F.explode(F.arrays_zip(F.col("rows").alias("row"), absorbed.alias("kept"))).alias("z")).select(
        *KEYS, F.col("z.row.sec").alias("sec"), F.col("z.row.id").alias("id"), F.col("z.row.actor").alias("actor"),
        F.col("z.kept").alias("kept"),
    )
    return rows.groupBy(*KEYS, "kept").agg(
        F.min_by("id", "sec").alias("id"), F.min_by("actor", F.when(F.col("actor").isNotNull(), F.col("sec"))).alias("actor")
    ).select(*KEYS, F.col("kept").alias("sec"), "id", "actor")


def next_kept(last: Column, sec: Column, tolerance: int) -> Column:
    return F.when(last.isNull() | (sec > last + tolerance), sec).otherwise(last)


def bucket_entries(bucketed: DataFrame, tolerance: int, width: int) -> DataFrame:
    """The moment last kept before each bucket whose rows may still fall under it.

    Per bucket: for each row that may be the first one kept, the row the fold
    ends with. Buckets without rows near a boundary need no entry and are left out.
    """
    secs = F.transform("rows", lambda r: r["sec"])
    start = F.col("bucket") * width
    near_start = F.element_at("secs", 1) - start <= tolerance
    near_end = start + width - F.element_at("secs", -1) <= tolerance
    edges = bucketed.select(*KEYS, "bucket", secs.alias("secs")).filter(near_start | near_end)
    firsts = F.concat(
        F.filter("secs", lambda s: s <= start + tolerance),
        F.slice(F.filter("secs", lambda s: s > start + tolerance), 1, 1),
    )
    moves = F.transform(firsts, lambda first: F.struct(
        first.alias("first"),
        F.aggregate("secs", first, lambda last, s: F.when(s > last + tolerance, s).otherwise(last)).alias("exit"),
    ))
    chains = edges.select(*KEYS, "bucket", moves.alias("moves")).groupBy(*KEYS).agg(
        F.sort_array(F.collect_list(F.struct("bucket", "moves"))).alias("chain")
    )

    def follow(state: Column, step: Column) -> Column:
        last = state["last"]
        taken = F.get(F.filter(step["moves"], lambda m: last.isNull() | (m["first"] > last + tolerance)), F.lit(0))
        return F.struct(
            F.coalesce(taken["exit"], last).alias("last"),
            F.concat(state["entries"], F.array(F.struct(step["bucket"].alias("bucket"), last.alias("entry")))).alias("entries"),
        )

    start_state = F.struct(
        F.lit(None).cast("bigint").alias("last"), F.array().cast("array<struct<bucket:bigint,entry:bigint>>").alias("entries")
    )
    walked = F.aggregate("chain", start_state, follow, lambda state: state["entries"])
    return chains.select(*KEYS, F.inline(walked))


def build_history(
    candidates: DataFrame, tolerance: int = TOLERANCE_SECONDS, bucket_seconds: int | None = None
) -> DataFrame:
    """History rows: pull_request_id, action, created_at, actor and the id of the first sighting.

    Sightings are ordered by (second, id), so the result does not depend on arrival.
    """
    points = moments(candidates)
    once = keep_once(points.filter(F.col("action").isin(ONCE_ACTIONS)), tolerance)
    others = keep_tolerant(points.filter(~F.col("action").isin(ONCE_ACTIONS)), tolerance, bucket_seconds)
    return union_all([once, others]).select(
        "pull_request_id", "action", F.timestamp_seconds("sec").alias("created_at"), "actor", "id"
    )
