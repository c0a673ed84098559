"""Metric points from worker logs, and the state of each worker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.operators.changes import union_all
from forgelake.operators.lookup import top_k

# Line formats.
LINE = r"([A-Z]+), (.+), (.+) -- ([^:]*?): (.*)"
SUCCESS = r"Remaining: ([0-9]+), Total: ([0-9]+) ms"
FAILURE = r"Status code: ([^,]+), .*Remaining: ([0-9]+)"
PROCESSED = r"([^ ]+) processing event\. Type: (\D+)Event, .*, Time: ([0-9]+) ms"
SLEEPING = r"\[([^.]+).*#([0-9]+)\].*for ([0-9]+)"
WORKER = r"#([0-9]+).*api_client\.rb"
REQUEST = r"\[([^.]+).*#([0-9]+)\].*api_client\.rb: \[(.*)\].*(https://.*) \(([0-9]+) remaining\).* ([0-9]+) ms$"
LAST_REQUESTS = 100

POINT_COLUMNS = ["series", "time", "severity", "client", "outcome", "metric", "evt_type", "entity", "action", "value"]


def extract(c: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def once(*columns: Column) -> Column:
    """Columns computed once per row: a generator is not merged into what uses its output, a projection is."""
    return F.inline(F.array(F.struct(*columns)))


def parse_logs(lines: DataFrame) -> DataFrame:
    """severity, time, client, stage, message and is_parsed of every line; other columns stay."""
    line = F.col("line")
    return lines.select(*[c for c in lines.columns if c != "line"], once(
        extract(line, LINE, 1).alias("severity"), extract(line, LINE, 2).alias("time"), extract(line, LINE, 3).alias("client"),
        F.get(F.split(extract(line, LINE, 4), r"\."), F.lit(0)).alias("stage"), extract(line, LINE, 5).alias("message"),
        line.rlike(LINE).alias("is_parsed"),
    ))


def useful(parsed: DataFrame) -> DataFrame:
    """Without unparsed and debug lines and empty messages."""
    return parsed.filter(F.col("is_parsed") & (F.lower("severity") != "debug") & F.col("message").isNotNull())


def as_points(rows: DataFrame, points: Column) -> DataFrame:
    """One row per point; points without a value are dropped."""
    exploded = rows.select(
        F.col("stage").alias("series"), "time", "severity", "client", F.explode(F.array_compact(points)).alias("p")
    )
    named = exploded.select("series", "time", "severity", "client", "p.*")
    texts = [c for c in POINT_COLUMNS if c not in named.columns]
    return named.withColumns({c: F.lit(None).cast("string") for c in texts}).select(*POINT_COLUMNS).filter("value is not null")


def point(wanted: Column, value: Column, **tags: Column | str) -> Column:
    fields = [(F.lit(v) if isinstance(v, str) else v).alias(k) for k, v in tags.items()]
    return F.when(wanted, F.struct(*fields, value.try_cast("bigint").alias("value")))


def request_points(parsed: DataFrame) -> DataFrame:
    """Two points per request: time and remaining quota, or error code and remaining quota."""
    rows = useful(parsed).filter("stage = 'api_client'")
    m = F.col("message")
    good, bad = m.startswith("Successful"), m.startswith("Failed")
    return as_points(rows, F.array(
        point(good, extract(m, SUCCESS, 2), outcome="success", metric="elapsed"),
        point(good, extract(m, SUCCESS, 1), outcome="success", metric="remaining"),
        point(bad, extract(m, FAILURE, 1), outcome="error", metric="error_code"),
        point(bad, extract(m, FAILURE, 2), outcome="error", metric="remaining"),
    ))


def processing_points(parsed: DataFrame) -> DataFrame:
    """One point per processed event: outcome, type and duration."""
    rows = useful(parsed).filter(F.col("stage").endswith("data_retrieval"))
    m = F.col("message")
    return as_points(rows, F.array(point(
        m.startswith("Success") | m.startswith("Error"), extract(m, PROCESSED, 3),
        outcome=F.lower(extract(m, PROCESSED, 1)), evt_type=extract(m, PROCESSED, 2),
    )))


def outcome_points(parsed: DataFrame, core_stage: str = "mirror") -> DataFrame:
    """Entities added or failed, and repositories and users updated or deleted; each counts one.

    `core_stage` is the name under which the builder component logs.
    """
    m = F.col("message")
    words = F.split(m, " ")
    one = F.lit(1)
    stage = F.col("stage")
    added = m.startswith("Added")
    lost = (stage == "retriever") & m.startswith("Could not find") | (stage == core_stage) & m.startswith("Could not retrieve")
    entity_stage = stage.isin("retriever", core_stage)
    updated = (stage == "repo_updater") & m.rlike("Repo .* updated") | (stage == "full_user_retriever") & m.rlike("User .* updated")
    deleted = stage.isin("repo_updater", "full_user_retriever") & m.contains("marked as deleted")
    none = F.lit(None).cast("string")
    points = F.array(
        point(entity_stage & added, one, outcome="success", entity=F.get(words, F.lit(1)), action=none),
        point(lost, one, outcome="failure", entity=F.get(words, F.lit(3)), action=none),
        point(updated, one, outcome=none, entity=none, action="updated"),
        point(deleted & ~updated, one, outcome=none, entity=none, action="deleted"),
    )
    return as_points(useful(parsed), points)


def all_points(parsed: DataFrame, core_stage: str = "mirror") -> DataFrame:
    return union_all([request_points(parsed), processing_points(parsed), outcome_points(parsed, core_stage)])


def rollup(points: DataFrame, width: str = "minute") -> DataFrame:
    """Count, mean and maximum per series, tags and time unit."""
    tags = [c for c in POINT_COLUMNS if c not in ("series", "time", "value")]
    bucket = F.date_trunc(width, F.try_to_timestamp("time")).alias("bucket")
    return points.groupBy("series", *tags, bucket).agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), F.max("value").alias("highest")
    )


# ---- worker state --------------------------------------------------------

WORKER_COLUMNS = ["pid", "seq", "kind", "ts", "ip", "repo", "stage", "remaining", "ms", "sleep", "weight"]


def parse_worker_lines(lines: DataFrame) -> DataFrame:
    """Request, sleep, not-found and forbidden lines of the request log (seq, line)."""
    line = F.col("line")
    kind = (
        F.when(line.contains("sleeping"), "sleep")
        .when(line.rlike("Not Found|Gone|Conflict"), "not_found")
        .when(line.contains("Forbidden"), "forbidden")
        .otherwise("request")
    )
    asked = F.col("kind") == "request"
    slept = F.col("kind") == "sleep"
    # Each part of a line is searched for once; what is made of the parts comes after.
    found = lines.filter(line.contains("api_client.rb")).withColumn("kind", kind).select("seq", "line", "kind", once(
        *[F.when(asked, F.regexp_extract(line, REQUEST, n)).alias(f"r{n}") for n in range(1, 7)],
        *[F.when(slept, F.regexp_extract(line, SLEEPING, n)).alias(f"s{n}") for n in range(1, 4)],
    ))

    def part(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(""))

    url = F.split(part("r4"), "/")
    stage = F.coalesce(F.get(F.split(F.get(url, F.lit(6)), r"\?"), F.lit(0)), F.lit("repo"))
    rows = found.select(once(
        F.coalesce(part("r2"), part("s2"), extract(line, WORKER, 1)).alias("pid"),
        F.col("seq"), F.col("kind"),
        F.unix_seconds(F.try_to_timestamp(F.when(asked, part("r1")).when(slept, part("s1")))).alias("ts"),
        part("r3").alias("ip"),
        F.when(asked, F.concat_ws("/", F.get(url, F.lit(4)), F.get(url, F.lit(5)))).alias("repo"),
        F.when(asked, stage).alias("stage"),
        part("r5").try_cast("bigint").alias("remaining"),
        part("r6").try_cast("bigint").alias("ms"),
        part("s3").try_cast("bigint").alias("sleep"),
        F.lit(1).cast("bigint").alias("weight"),
    ))
    return rows.filter("pid is not null")


def worker_latest(rows: DataFrame) -> DataFrame:
    """State of each worker after its last line.

    A worker's stay in a repository begins with its first request after the last
    request to any other repository. That needs, per worker, the two repositories
    visited last; no window over all its lines.
    """
    requests = rows.filter("kind = 'request'")
    visits = requests.groupBy("pid", "repo").agg(F.max("seq").alias("last_seq"))
    last_two = top_k(visits, ["pid"], [F.col("last_seq").desc()], 2)
    stays = last_two.groupBy("pid").agg(F.max(F.when(F.col("rank") == 2, F.col("last_seq"))).alias("other_seq"))
    starts = requests.join(stays, "pid").filter("other_seq is null or seq > other_seq").groupBy("pid").agg(
        F.min("seq").alias("start_seq"), F.min_by("ts", "seq").alias("start_ts")
    )
    asked, slept = F.col("kind") == "request", F.col("kind") == "sleep"
    facts = rows.join(starts, "pid", "left").groupBy("pid").agg(
        F.max_by(F.struct("seq", "ip", "repo", "stage", "remaining"), F.when(asked, F.col("seq"))).alias("r"),
        F.max_by(F.struct("seq", "sleep"), F.when(slept, F.col("seq"))).alias("s"),
        F.max_by(F.struct("kind", "ts"), F.when(asked | slept, F.col("seq"))).alias("l"),
        F.max("start_ts").alias("start_ts"), F.max("start_seq").alias("start_seq"),
        F.sum(F.when((F.col("kind") == "not_found") & (F.col("start_seq").isNull() | (F.col("seq") > F.col("start_seq"))), F.col("weight")).otherwise(0)).alias("not_found"),
        F.sum(F.when(F.col("kind") == "forbidden", F.col("weight")).otherwise(0)).alias("forbidden"),
        F.max("seq").alias("seq"),
    )
    return facts.select(
        "pid", F.when(F.col("l.kind") == "request", "A").when(F.col("l.kind") == "sleep", "S").alias("status"),
        F.col("r.ip").alias("ip"), F.col("r.repo").alias("repo"), F.col("r.stage").alias("stage"),
        F.col("r.remaining").alias("remaining"), "not_found", "forbidden",
        (F.col("l.ts") - F.col("start_ts")).alias("time_in"), F.col("s.sleep").alias("sleep_remaining"),
        "start_seq", "start_ts", F.col("r.seq").alias("request_seq"), F.col("s.seq").alias("sleep_seq"),
        F.col("l.ts").alias("last_ts"), "seq",
    )


def state_lines(states: DataFrame) -> DataFrame:
    """A stored worker state as lines that lead to the same state, so new lines can follow it."""
    none_text, none_number = F.lit(None).cast("string"), F.lit(None).cast("bigint")

    def row(kind, seq, ts=none_number, ip=none_text, repo=none_text, stage=none_text, remaining=none_number, sleep=none_number, weight=F.lit(1)):
        return F.when(seq.isNotNull() & (weight > 0), F.struct(
            seq.alias("seq"), F.lit(kind).alias("kind"), ts.alias("ts"), ip.alias("ip"), repo.alias("repo"), stage.alias("stage"),
            remaining.alias("remaining"), none_number.alias("ms"), sleep.alias("sleep"), weight.cast("bigint").alias("weight"),
        ))

    c = F.col
    lines = F.array_compact(F.array(
        row("request", c("start_seq"), c("start_ts"), c("ip"), c("repo"), c("stage"), c("remaining")),
        row("request", c("request_seq"), F.when(c("request_seq") == c("start_seq"), c("start_ts")).otherwise(c("last_ts")), c("ip"), c("repo"), c("stage"), c("remaining")),
        row("sleep", c("sleep_seq"), c("last_ts"), sleep=c("sleep_remaining")),
        row("not_found", c("seq"), weight=c("not_found")),
        row("forbidden", c("seq"), weight=c("forbidden")),
    ))
    return states.select("pid", F.inline(lines)).select(*WORKER_COLUMNS)


def recent_latency(rows: DataFrame, n: int = LAST_REQUESTS) -> DataFrame:
    """Mean and highest request time over the last n requests of each worker."""
    recent = top_k(rows.filter("kind = 'request'"), ["pid"], [F.col("seq").desc()], n)
    return recent.groupBy("pid").agg(F.count("*").alias("requests"), F.avg("ms").alias("mean_ms"), F.max("ms").alias("max_ms"))


def active_workers(states: DataFrame) -> DataFrame:
    return states.filter("status = 'A'").orderBy(F.col("time_in").desc(), "pid")


def sleeping_workers(states: DataFrame) -> DataFrame:
    return states.filter("status = 'S'").orderBy("sleep_remaining", "pid")


def ordered_workers(states: DataFrame) -> DataFrame:
    """Active workers by time in their task, longest first, then sleeping ones by what is left."""
    active, sleeping = F.col("status") == "A", F.col("status") == "S"
    return states.filter(active | sleeping).orderBy(
        "status", F.when(active, F.col("time_in")).desc_nulls_last(), F.when(sleeping, F.col("sleep_remaining")), "pid"
    )
