"""Replay of stored events, repository by repository, with one high-water mark each.

The table `replay_marks` holds, per repository, the highest event id that is dealt with. It
is a table of the same version as those the events change, so a mark moves only with a
finished version: a job that dies in between starts again where the last version ends.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions.scalars import full_name_owner, full_name_repo
from forgelake.operators.handlers import event_number
from forgelake.operators.lookup import event_window
from forgelake.plans.refresh import Tables, apply_events, open_worklist, refresh_repos
from forgelake.session import cut_lineage
from forgelake.sources.tables import TableSet

REPO = ["owner", "repo"]


@dataclass(frozen=True)
class EventWindow:
    """Events strictly between two ids, without some types. Either end may be open."""

    after: int | None = None
    before: int | None = None
    exclude: tuple[str, ...] = ()


def located(events: DataFrame, repos: DataFrame) -> DataFrame:
    """Stored events of the listed repositories (owner, repo), with their number; one per id."""
    name = F.col("repo.name")
    placed = events.withColumns({"at_owner": full_name_owner(name), "at_repo": full_name_repo(name), "number": event_number()})
    listed = repos.select(F.col("owner").alias("at_owner"), F.col("repo").alias("at_repo")).distinct()
    return placed.filter("number is not null").join(listed, ["at_owner", "at_repo"], "left_semi").dropDuplicates(["number"])


def pending(events: DataFrame, repos: DataFrame, marks: DataFrame, window: EventWindow) -> DataFrame:
    """Events inside the window and beyond their repository's mark, with `at_owner`, `at_repo` and `number`."""
    inside = event_window(located(events, repos), window.after, window.before)
    old = marks.select(F.col("owner").alias("at_owner"), F.col("repo").alias("at_repo"), F.col("event_id").alias("mark"))
    return inside.join(old, ["at_owner", "at_repo"], "left").filter("mark is null or number > mark").drop("mark")


def next_marks(marks: DataFrame, due: DataFrame) -> DataFrame:
    """The marks after some events; types that were left out count as dealt with, and no mark moves back."""
    seen = due.groupBy(F.col("at_owner").alias("owner"), F.col("at_repo").alias("repo")).agg(F.max("number").alias("event_id"))
    return marks.select(*REPO, "event_id").unionByName(seen).groupBy(*REPO).agg(F.max("event_id").alias("event_id"))


def replay_events(
    tables: Tables, events: DataFrame, raw: dict[str, DataFrame], worklist: DataFrame, now: Column,
    window: EventWindow = EventWindow(), skip: Collection[str] = (),
) -> Tables:
    """Next tables after the pending events of the listed repositories went through the handlers.

    Events of a window are applied as one set: the builders order them by id where order
    matters. What a mark has passed is not applied again, so calls over neighbouring or
    overlapping windows add up to one call over all.
    """
    due = cut_lineage(pending(events, open_worklist(worklist, None), tables["replay_marks"], window), "due_events")
    marks = cut_lineage(next_marks(tables["replay_marks"], due), "replay_marks")
    chosen = event_window(due.drop("at_owner", "at_repo", "number"), exclude=list(window.exclude) or None)
    return {**apply_events({n: t for n, t in tables.items() if n != "replay_marks"}, chosen, raw, now, skip), "replay_marks": marks}


def cut_points(due: DataFrame, slices: int) -> list[int]:
    """Up to slices - 1 ids that part the events into slices of about one size."""
    if slices < 2:
        return []
    shares = [i / slices for i in range(1, slices)]
    found = due.agg(F.percentile_approx("number", shares, 10_000).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def replay_job(
    store: TableSet, events: DataFrame, raw: dict[str, DataFrame], worklist: DataFrame, now: Column,
    window: EventWindow = EventWindow(), slices: int = 1, skip: Collection[str] = (), stages: bool = True,
) -> int:
    """A whole refresh: the stages, then the stored events in id order, slice by slice.

    Every slice is a version with its marks, so a job that is started again after a failure
    goes on behind the last finished slice. Gives the number of versions written.
    """
    repos = open_worklist(worklist, None)
    written = 0
    if stages:
        tables = store.read_all()
        written += store.write_job(refresh_repos(tables, raw, repos, now, skip=skip), tables)
    due = cut_lineage(pending(events, repos, store.read_all()["replay_marks"], window).select("number"), "due_numbers")
    if due.isEmpty():
        return written
    for cut in [*cut_points(due, slices), None]:
        part = EventWindow(window.after, window.before if cut is None else cut + 1, window.exclude)
        tables = store.read_all()
        written += store.write_job(replay_events(tables, events, raw, repos, now, part, skip), tables)
    return written
