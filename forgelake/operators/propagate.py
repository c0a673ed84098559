"""Changed commits of projects on their way down the fork tree, as change sets.

A change set has project_id, commit_id and is_added. Projects are taken level by level, from
the top: what a level changes is known before its forks are looked at, and only changed rows
travel. A listed fork is worked out anew from its own commits and its parent's; any other
fork takes over the part of its parent's changes that was made before it was forked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.operators.changes import union_all
from forgelake.operators.forks import strategy_of
from forgelake.operators.lookup import commits_before
from forgelake.session import cut_lineage

PAIR = ["project_id", "commit_id"]


def apply_changes(project_commits: DataFrame, changes: DataFrame) -> DataFrame:
    """The associations after a change set: removed ones go, added ones come, once."""
    gone = changes.filter("not is_added").select(*PAIR)
    new = changes.filter("is_added").select(*PAIR).distinct().join(project_commits.select(*PAIR), PAIR, "left_anti")
    return project_commits.join(gone, PAIR, "left_anti").select(*project_commits.columns).unionByName(new, allowMissingColumns=True)


def change_set(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    """What turns the stored pairs into the wanted ones: both sides meet in one shuffle."""
    sides = stored.select(*PAIR, F.lit(1).alias("s"), F.lit(0).alias("w")).unionByName(wanted.select(*PAIR, F.lit(0).alias("s"), F.lit(1).alias("w")))
    both = sides.groupBy(*PAIR).agg(F.max("s").alias("s"), F.max("w").alias("w"))
    return both.filter("s <> w").select(*PAIR, (F.col("w") == 1).alias("is_added"))


def descendants(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """project_id of the roots and of all forks below them, by `edges` (project_id, parent_id); a round per level, cycles end."""
    found = level = cut_lineage(roots.select("project_id").distinct(), "fork_tree")
    while True:
        children = edges.join(level.withColumnRenamed("project_id", "parent_id"), "parent_id", "left_semi").select("project_id")
        level = cut_lineage(children.distinct().join(found, "project_id", "left_anti"), "fork_tree")
        if level.isEmpty():
            return found
        found = found.unionByName(level)


def propagate(
    project_commits: DataFrame, projects: DataFrame, commits: DataFrame, listed: DataFrame, own: DataFrame, forked_at: DataFrame,
    seeds: DataFrame, strategy: str,
) -> DataFrame:
    """All changes that the listed forks and the seeds bring about, the seeds included.

    `listed` (project_id) are forks to work out anew, `own` (project_id, commit_id) their own
    commits, `forked_at` (project_id, fork_ts) the dates of known fork commits, `seeds` a change
    set of other projects. Strategy `all` gives forks their parent's commits from before the
    fork; `fork_point` only their own; `none` none: then nothing goes further down. A fork
    without a known fork date inherits nothing. Projects in a cycle of parents are left as they are.
    """
    strategy = strategy_of(strategy)
    listed = cut_lineage(listed.select("project_id").distinct(), "listed_forks")
    mine = own.join(listed, "project_id", "left_semi").select(*PAIR).distinct()
    if strategy != "all":
        stored = project_commits.join(listed, "project_id", "left_semi").select(*PAIR)
        return seeds.unionByName(change_set(stored, mine if strategy == "fork_point" else mine.limit(0)))

    edges = projects.filter("forked_from > 0").select(F.col("id").alias("project_id"), F.col("forked_from").alias("parent_id"))
    affected = descendants(edges, listed.unionByName(seeds.select("project_id")))
    tree = cut_lineage(
        affected.join(edges, "project_id", "left").join(listed.withColumn("is_listed", F.lit(True)), "project_id", "left")
        .join(forked_at.select("project_id", "fork_ts"), "project_id", "left")
        .select("project_id", "parent_id", "fork_ts", F.coalesce("is_listed", F.lit(False)).alias("is_listed")), "fork_tree",
    )
    dates = commits.select(F.col("id").alias("commit_id"), "created_at")
    level = cut_lineage(tree.join(affected.withColumnRenamed("project_id", "parent_id"), "parent_id", "left_anti").select(*tree.columns), "fork_level")
    changes = [cut_lineage(seeds.select(*PAIR, "is_added"), "changes")]
    while not level.isEmpty():
        so_far = union_all(changes)
        changes.append(cut_lineage(_of_level(level, project_commits, commits, dates, mine, so_far), "changes"))
        level = cut_lineage(tree.join(level.select(F.col("project_id").alias("parent_id")), "parent_id", "left_semi").select(*tree.columns), "fork_level")
    return union_all(changes)


def _of_level(level: DataFrame, project_commits: DataFrame, commits: DataFrame, dates: DataFrame, mine: DataFrame, so_far: DataFrame) -> DataFrame:
    """Changes of one level's projects, given those of all levels above."""
    anew = level.filter("is_listed")
    parents = anew.select(F.col("parent_id").alias("project_id")).distinct()
    current = apply_changes(project_commits.join(parents, "project_id", "left_semi").select(*PAIR), so_far.join(parents, "project_id", "left_semi"))
    sides = anew.filter("parent_id is not null and fork_ts is not null").select(F.col("project_id").alias("fork_id"), "parent_id", "fork_ts")
    wanted = mine.join(anew.select("project_id"), "project_id", "left_semi").unionByName(commits_before(current, commits, sides))
    stored = project_commits.join(anew.select("project_id"), "project_id", "left_semi")
    listed_changes = change_set(stored, wanted)

    others = level.filter("not is_listed and fork_ts is not null").select(F.col("project_id").alias("fork_id"), F.col("parent_id").alias("project_id"), "fork_ts")
    passed = so_far.join(others, "project_id").join(dates, "commit_id").filter("created_at < fork_ts")
    passed = passed.select(F.col("fork_id").alias("project_id"), "commit_id", "is_added")
    here = project_commits.select(*PAIR).join(passed.select(*PAIR).distinct(), PAIR, "left_semi").withColumn("is_here", F.lit(True))
    # Only what makes a difference goes further down.
    told = passed.join(here, PAIR, "left").filter("is_added = (is_here is null)").select(*PAIR, "is_added")
    return listed_changes.unionByName(told)
