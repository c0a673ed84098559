"""Scalar column expressions over raw forge records.

All are compositions of built-in functions, so they stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

# Patterns, formats and lengths that decide results.
EMAIL_PATTERN = r"(?m)^[a-zA-Z][\w\.-]*[a-zA-Z0-9]@[a-zA-Z0-9][\w\.-]*[a-zA-Z0-9]\.[a-zA-Z][a-zA-Z\.]*[a-zA-Z]$"
LOGIN_PATTERN = r"^[\w\-\[\]]*$"
SHA_PATTERN = r"[a-f0-9]{40}$"
SLASH_DATE_FORMAT = "yyyy/MM/dd HH:mm:ss Z"
DESCRIPTION_LENGTH = 255
COMMIT_COMMENT_LENGTH = 256
PULL_REQUEST_COMMENT_LENGTH = 255
FIRST_MOMENT = 86400  # 1970-01-02, stands for every moment at or before the epoch
COMMIT_BOUND_ACTIONS = ["referenced", "merged", "closed"]
WEB_BASE = "https://github.com"
API_BASE = "https://api.github.com"


def path(root: Column, dotted: str) -> Column:
    """Nested field by dotted path; null when any step is null."""
    for step in dotted.split("."):
        root = root.getField(step)
    return root


def variant_path(body: Column, dotted: str, type_name: str = "string") -> Column:
    """Nested field of a variant body; null when a step is missing or of another type."""
    return F.try_variant_get(body, "$." + dotted, type_name)


def with_path(column: Column, dotted: str, value: Column) -> Column:
    """Set a nested field, adding the last step when the struct lacks it."""
    return column.withField(dotted, value)


def deep_merge(left: Column, right: Column, schema: DataType, overwrite: bool = True) -> Column:
    """Merge two records of one schema, field by field at every level.

    With `overwrite` a value on the right wins; without it conflicting leaves
    become the distinct list of both sides.
    """
    if isinstance(schema, StructType):
        merged = F.struct(*[
            deep_merge(left.getField(f.name), right.getField(f.name), f.dataType, overwrite).alias(f.name)
            for f in schema.fields
        ])
        return F.when(left.isNull() & right.isNull(), F.lit(None)).otherwise(merged)
    if overwrite:
        return F.coalesce(right, left)
    if isinstance(schema, ArrayType):
        return F.array_distinct(F.concat(F.coalesce(left, F.array().cast(schema)), F.coalesce(right, F.array().cast(schema))))
    return F.array_distinct(F.array_compact(F.array(left, right)))


def user_type(c: Column) -> Column:
    return F.when(c == "User", F.lit("USR")).otherwise(F.lit("ORG"))


def is_valid_email(c: Column) -> Column:
    return c.rlike(EMAIL_PATTERN)


def is_login(c: Column) -> Column:
    return c.rlike(LOGIN_PATTERN)


def split_address(c: Column) -> Column:
    """`Name <mail>` to struct(name, email), both trimmed; null when it does not split."""
    name = F.trim(F.regexp_extract(c, r"^([^<]*)<", 1))
    mail = F.trim(F.regexp_extract(c, r"<([^>]*)", 1))
    return F.when(c.rlike(r"<[^>]"), F.struct(name.alias("name"), mail.alias("email")))


def url_part(c: Column, index: int) -> Column:
    """Segment of a URL split at `/`, counted from 0; null when there are fewer."""
    return F.get(F.split(c, "/"), F.lit(index))


def url_owner(c: Column) -> Column:
    return url_part(c, 4)


def url_repo(c: Column) -> Column:
    return url_part(c, 5)


def url_sha(c: Column) -> Column:
    return url_part(c, 7)


def full_name_owner(c: Column) -> Column:
    return F.get(F.split(c, "/"), F.lit(0))


def full_name_repo(c: Column) -> Column:
    return F.get(F.split(c, "/"), F.lit(1))


def time_non_zero(ts: Column) -> Column:
    """Moments at or before the epoch become 1970-01-02."""
    return F.when(F.unix_seconds(ts) <= 0, F.timestamp_seconds(F.lit(FIRST_MOMENT))).otherwise(ts)


def forge_ts(c: Column) -> Column:
    """Timestamp from ISO-8601 or `yyyy/MM/dd HH:mm:ss +hhmm` text; null when neither fits."""
    parsed = F.coalesce(F.try_to_timestamp(c), F.try_to_timestamp(c, F.lit(SLASH_DATE_FORMAT)))
    return time_non_zero(parsed)


def left(c: Column, length: int) -> Column:
    return F.substring(c, 1, length)


def bool01(c: Column) -> Column:
    return F.when(c == "true", 1).when((c == "false") | c.isNull(), 0)


def location_key(c: Column) -> Column:
    """Normalised location text, the key of the geo cache. The order of the steps matters."""
    cleaned = F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    cleaned = F.translate(cleaned, '#"<>[]', "")
    cleaned = F.regexp_replace(cleaned, r"(?m)^[0-9,/().:]*", "")
    cleaned = F.regexp_replace(cleaned, " +", " ")
    return F.regexp_replace(cleaned, ",", "")


def explode_languages(df: DataFrame, languages: str) -> DataFrame:
    """One row per language of a name-to-bytes map: lower-cased name, bytes as a number."""
    kept = F.map_filter(F.col(languages), lambda k, _: k != "etag")
    others = [c for c in df.columns if c != languages]
    return (
        df.select(*others, F.explode(kept).alias("name", "size"))
        .select(*others, F.lower("name").alias("language"), F.expr("try_cast(size as bigint)").alias("bytes"))
    )


def as_id(df: DataFrame, column: str) -> DataFrame:
    """Number form of an id kept as number or text, with the original text beside it."""
    text = F.col(column).cast("string")
    return df.withColumn(f"{column}_text", text).withColumn(column, text.try_cast("bigint"))


def id_eq(c: Column, value: str | int) -> Column:
    """Match an id by its number form first, else by its text."""
    text = c.cast("string")
    wanted = F.lit(str(value))
    number = wanted.try_cast("bigint")
    return F.when(number.isNotNull() & text.try_cast("bigint").isNotNull(), text.try_cast("bigint") == number).otherwise(
        text == wanted
    )


def is_sha(c: Column) -> Column:
    return c.rlike(SHA_PATTERN)


def clean_etag(c: Column) -> Column:
    return F.translate(c, 'W"/', "")


def route_key(event_type: Column) -> Column:
    return F.concat(F.lit("evt."), event_type)


def project_message(full_name: Column) -> Column:
    """Repository name as it is announced on the project route."""
    return F.replace(full_name, F.lit("/"), F.lit(" "))


def later(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def trim_patches(files: Column) -> Column:
    return F.transform(files, lambda f: f.dropFields("patch"))


def has_head(pr: Column) -> Column:
    return path(pr, "head.repo").isNotNull()


def intra_branch(pr: Column) -> Column:
    """Head and base are branches of one repository."""
    same_owner = path(pr, "head.repo.owner.login").eqNullSafe(path(pr, "base.repo.owner.login"))
    same_name = path(pr, "head.repo.full_name").eqNullSafe(path(pr, "base.repo.full_name"))
    return has_head(pr) & same_owner & same_name


def fork_name(full_name: Column, url: Column) -> Column:
    return F.coalesce(full_name, F.concat_ws("/", url_owner(url), url_repo(url)))


def last_segment(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def watcher_profile(event: DataFrame) -> DataFrame:
    """Full watcher record of a star event; the links follow from the login."""
    login = F.col("actor.login")
    api = F.concat(F.lit(f"{API_BASE}/users/"), login)
    links = {
        "html_url": F.concat(F.lit(f"{WEB_BASE}/"), login),
        "followers_url": F.concat(api, F.lit("/followers")),
        "following_url": F.concat(api, F.lit("/following{/other_user}")),
        "gists_url": F.concat(api, F.lit("/gists{/gist_id}")),
        "starred_url": F.concat(api, F.lit("/starred{/owner}{/repo}")),
        "subscriptions_url": F.concat(api, F.lit("/subscriptions")),
        "organizations_url": F.concat(api, F.lit("/orgs")),
        "repos_url": F.concat(api, F.lit("/repos")),
        "events_url": F.concat(api, F.lit("/events{/privacy}")),
        "received_events_url": F.concat(api, F.lit("/received_events")),
    }
    return event.select(
        full_name_owner(F.col("repo.name")).alias("owner"),
        full_name_repo(F.col("repo.name")).alias("repo"),
        login.alias("login"),
        F.col("actor.id").alias("actor_id"),
        F.col("actor.avatar_url").alias("avatar_url"),
        F.col("actor.gravatar_id").alias("gravatar_id"),
        F.col("actor.url").alias("url"),
        *[value.alias(name) for name, value in links.items()],
        F.lit(False).alias("site_admin"),
        F.col("created_at"),
        F.col("id").alias("event_id"),
    )


def annotate(df: DataFrame, **keys: Column) -> DataFrame:
    """Add the keys of the owning entity (owner, repo, issue or pull request number)."""
    return df.withColumns(keys)


def action_specific(action: Column, commit_id: Column) -> Column:
    return F.when(action.isin(COMMIT_BOUND_ACTIONS), commit_id)


def default_branch(repos: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Newest known default branch per repository, `master` when none is known."""
    newest = F.max_by("default_branch", F.when(F.col("default_branch").isNotNull(), F.col(order)))
    return repos.groupBy(*keys).agg(F.coalesce(newest, F.lit("master")).alias("default_branch"))


def explode_items(df: DataFrame, items: Column, alias: str, keep_empty: bool = False) -> DataFrame:
    """One row per list element with its position."""
    generate = F.posexplode_outer if keep_empty else F.posexplode
    return df.select("*", generate(items).alias("pos", alias))
