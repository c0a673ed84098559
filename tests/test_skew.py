"""Null and hot keys: the same result as the plain join, and plans that show the difference."""

from pyspark.sql import functions as F

from forgelake.operators.identity import classify
from forgelake.operators.lookup import commits_before, left_join_known
from forgelake.operators.propagate import change_set, propagate
from forgelake.streaming import jobs


def plain_before(project_commits, commits, forks):
    dated = project_commits.join(commits.select(F.col("id").alias("commit_id"), "created_at"), "commit_id")
    sides = forks.select("fork_id", F.col("parent_id").alias("project_id"), "fork_ts")
    return dated.join(sides, "project_id").filter("created_at < fork_ts").select(F.col("fork_id").alias("project_id"), "commit_id")


def test_commits_of_a_hot_parent(spark):
    """One parent has a third of all commits and 1,000 forks."""
    commits = spark.range(6000).select("id", F.when(F.col("id") % 97 > 0, F.timestamp_seconds(F.col("id") * 40_000)).alias("created_at"))
    owned = commits.select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).cast("long").alias("project_id"), F.col("id").alias("commit_id"))
    forks = spark.range(1000).select((F.col("id") + 1000).alias("fork_id"), F.when(F.col("id") < 900, 1).otherwise(F.col("id") % 50).cast("long").alias("parent_id"), F.when(F.col("id") % 11 > 0, F.timestamp_seconds(F.col("id") * 30_000)).alias("fork_ts"))
    found = commits_before(owned, commits, forks, share=50)
    summary = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("project_id", "commit_id").cast("decimal(38,0)"))).first()
    assert summary(found) == summary(plain_before(owned, commits, forks))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "bucket" in plan and "Cross" not in plan


def test_null_keys_are_dealt_out(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).alias("login"))
    side = spark.range(0, 1000, 20).select(F.col("id").cast("string").alias("login"), F.lit(True).alias("known"))
    key = lambda r: (r["id"], r["known"])
    found = left_join_known(rows, side, "login")
    assert sorted(map(key, found.collect())) == sorted(map(key, rows.join(side, "login", "left").collect()))
    # Of 900 rows with a null key no partition of a join gets more than its share.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = left_join_known(rows, side, "login").select(F.spark_partition_id().alias("p"))
        sizes = [r["count"] for r in dealt.groupBy("p").count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(sizes) < 1000 if len(sizes) > 1 else True


def test_identities_with_mostly_null_logins(spark):
    identities = spark.range(500).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("u"), F.col("id") % 50)).alias("login"), F.concat(F.lit("n"), "id").alias("name"),
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("m"), F.col("id") % 30)).alias("email"), F.col("id").alias("seq"))
    users = spark.range(0, 50, 20).select(F.col("id"), F.concat(F.lit("u"), "id").alias("login"), F.concat(F.lit("m"), "id").alias("email"), F.lit("x").alias("name"))
    accounts = spark.range(0, 50, 10).select(F.concat(F.lit("u"), "id").alias("login"), F.concat(F.lit("m"), F.col("id") % 7).alias("email"))
    rules = classify(identities, users, accounts)
    plan = rules._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftOuter, (dealt_key") == 4
    counts = {r["rule"]: r["n"] for r in rules.groupBy("rule").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == 500 and counts["known"] > 0 and counts["unknown"] > 0


def test_change_sets_go_down_the_fork_tree(spark):
    """1 <- 2 <- 3 <- 4, 5 <- 6 in a cycle; 2 is worked out anew, 3 and 4 get its changes."""
    projects = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, 6), (6, 5)], "id long, forked_from long")
    commits = spark.range(1, 11).select("id", F.timestamp_seconds("id").alias("created_at"))
    pc = "project_id long, commit_id long"
    stored = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 3), (2, 9), (3, 9), (3, 2), (4, 9)], pc)
    dates = spark.createDataFrame([(2, 4), (3, 10), (4, 3), (6, 5)], "project_id long, s long").select("project_id", F.timestamp_seconds("s").alias("fork_ts"))
    own = spark.createDataFrame([(2, 8), (3, 9)], pc)
    seeds = spark.createDataFrame([(1, 2, False), (5, 1, True)], pc + ", is_added boolean")
    listed = spark.createDataFrame([(2,)], "project_id long")

    def told(strategy):
        return sorted(map(tuple, propagate(stored, projects, commits, listed, own, dates, seeds, strategy).collect()))

    # 2 had 3 and 9; its own is 8, of 1's 1 and 3 both lie before the fork (2 left).
    two = [(2, 1, True), (2, 8, True), (2, 9, False)]
    # 3 takes over 1 and 8 and loses 9; 4 was forked before 3, so it gets 1 only.
    assert told("all") == sorted([(1, 2, False), (5, 1, True), *two, (3, 1, True), (3, 8, True), (3, 9, False), (4, 1, True)])
    assert told("fork_point") == sorted([(1, 2, False), (5, 1, True), (2, 3, False), (2, 8, True), (2, 9, False)])
    assert told("none") == sorted([(1, 2, False), (5, 1, True), (2, 3, False), (2, 9, False)])
    assert change_set(stored, stored).count() == 0


def test_exact_dedup_reads_only_touched_folders(spark, tmp_path):
    out = str(tmp_path / "store")
    write = jobs.exact_dedup_sink(out, width=100)
    write(spark.range(0, 1000).select(F.col("id").cast("string").alias("id")), 0)
    batch = spark.createDataFrame([("995",), ("1001",), ("5",), ("x",), ("x",)], "id string")
    near = jobs.stored_near(spark, out, batch, 1, "id", 100)
    folders = {r["f"].split("id_range=")[1].split("/")[0] for r in near.select(F.input_file_name().alias("f")).distinct().collect()}
    assert folders == {"0", "9"}  # 1001 lies in a folder that is not there yet
    scan = next(line for line in near._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert "id_range" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    write(batch, 1)
    write(batch, 1)
    assert sorted(r["id"] for r in spark.read.parquet(out).filter("batch_id = 1").collect()) == ["1001", "x"]
