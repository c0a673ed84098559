"""Resolution of commit identities (login, name, e-mail) to accounts.

Works on the distinct identities of a batch, never per commit. The rules depend
on the order of sightings; the order is the given `seq` column, so a batch gives
the same answer for every input order and partitioning.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions.scalars import blank_to_null, forge_ts, user_type
from forgelake.operators.changes import fill_null, missing, one_per_key, union_all
from forgelake.operators.keys import append_with_ids
from forgelake.operators.lookup import left_join_known, users_by_email
from forgelake.session import cut_lineage

WEB_LOGIN = "web-flow"  # Fixed value: account of commits made on the web site
HEX = "0123456789abcdef"
CAPITALS = "ABCDEFGHIJKLMNOP"

IDENTITY = ["login", "name", "email"]


class Identities(NamedTuple):
    resolution: DataFrame  # login, name, email, seq, rule, resolved_login
    users: DataFrame  # next users table


def account_rows(raw_users: DataFrame, now: Column) -> DataFrame:
    """Staged account records in the shape of the users table, one per login."""
    firsts = one_per_key(raw_users, ["login"], ["created_at", "name", "email"])
    return firsts.select(
        "login", "name", "company", blank_to_null(F.col("email")).alias("email"), "location",
        user_type(F.col("type")).alias("type"), F.lit(False).alias("fake"), F.lit(False).alias("deleted"),
        forge_ts(F.col("created_at").cast("string")).alias("created_at"), now.alias("updated_at"),
    )


def placeholder_letters(email: Column) -> Column:
    """32 capitals derived from the e-mail; the first eight are the usual placeholder login."""
    return F.translate(F.md5(email), HEX, CAPITALS)


def distinct_identities(identities: DataFrame) -> DataFrame:
    """Distinct trimmed identities with their first sighting."""
    return identities.groupBy(
        "login", F.trim("name").alias("name"), blank_to_null(F.col("email")).alias("email")
    ).agg(F.min("seq").alias("seq"))


def classify(identities: DataFrame, users: DataFrame, accounts: DataFrame) -> DataFrame:
    """The rule that applies to each distinct identity, before the identities of the batch meet."""
    in_table = users.select("login", F.lit(True).alias("in_table"))
    has_account = accounts.select("login", F.lit(True).alias("has_account"))
    rows = users_by_email(users).select("email", F.col("login").alias("row_login"))
    hits = accounts.filter("email is not null").groupBy("email").agg(F.min("login").alias("hit_login"))
    # Most commits of some hosts name no login, and many no e-mail.
    joined = distinct_identities(identities)
    for side, key in ((in_table, "login"), (has_account, "login"), (rows, "email"), (hits, "email")):
        joined = left_join_known(joined, side, key)
    known = F.coalesce("in_table", F.lit(False))
    exists = F.coalesce("has_account", F.lit(False))
    named = F.col("login").isNotNull()
    rule = (
        F.when(F.col("login") == WEB_LOGIN, F.when(known | exists, "web").otherwise("unknown"))
        .when(named & known, "known")
        .when(named & exists & F.col("row_login").isNotNull(), "merge")
        .when(named & exists, "insert")
        .when(F.col("email").isNull(), "unknown")
        .when(F.col("row_login").isNotNull(), "email_row")
        .when(F.col("hit_login").isNotNull(), "search_hit")
        .otherwise("placeholder")
    )
    return joined.select(*IDENTITY, "seq", rule.alias("rule"), "row_login", "hit_login", known.alias("in_table"))


def merge_winners(rules: DataFrame) -> DataFrame:
    """(login, row_login, email): logins that take over the row of their e-mail.

    A login's first sighting decides whether it merges; of several logins that
    claim one row the earliest wins, the others become accounts of their own.
    """
    fresh = rules.filter(F.col("rule").isin("merge", "insert"))
    first = fresh.groupBy("login").agg(
        F.min_by(F.struct("rule", "row_login", "email", "seq"), F.struct("seq", "email", "name")).alias("first")
    ).select("login", "first.*")
    return first.filter("rule = 'merge'").groupBy("row_login").agg(
        F.min_by(F.struct("login", "email"), F.struct("seq", "login")).alias("w")
    ).select("row_login", "w.login", "w.email")


def earliest(column: str) -> Column:
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.struct("seq", "email", "name")))


def resolve_identities(identities: DataFrame, users: DataFrame, raw_users: DataFrame, now: Column) -> Identities:
    """Resolve a batch of identities against the users table and the staged account records."""
    # These meet each other many times below, so each is computed once.
    accounts = cut_lineage(account_rows(raw_users, now), "accounts")
    rules = cut_lineage(classify(identities, users, accounts), "identities")
    winners = cut_lineage(merge_winners(rules), "merges")

    # Names and e-mails from commits fill what a login lacks.
    fills = rules.filter(F.col("rule").isin("known", "insert", "merge")).groupBy("login").agg(
        earliest("name").alias("name"), earliest("email").alias("email"), F.min("seq").alias("seq")
    )
    new_logins = union_all([
        rules.filter(F.col("rule").isin("insert", "merge")).select("login"),
        rules.filter((F.col("rule") == "search_hit")).select(F.col("hit_login").alias("login")),
        rules.filter((F.col("rule") == "web") & ~F.col("in_table")).select("login"),
    ]).distinct()
    inserted = cut_lineage(accounts.join(
        missing(new_logins, users, ["login"]).join(winners.select("login"), "login", "left_anti"), "login", "left_semi"
    ), "inserted")

    # E-mails a login takes over in this batch, so that nameless commits find it.
    lacking = union_all([
        users.filter("email is null").select("login"), inserted.filter("email is null").select("login")
    ])
    claims = fills.filter("email is not null").join(lacking, "login", "left_semi").groupBy("email").agg(
        F.min_by("login", F.struct("seq", "login")).alias("claim_login")
    )

    open_mails = rules.filter("rule = 'placeholder'").groupBy("email").agg(earliest("name").alias("name")).join(
        claims, "email", "left_anti"
    )
    placeholders = cut_lineage(placeholder_rows(open_mails, users, now), "placeholders")

    renamed = winners.select(F.col("row_login").alias("old_login"), F.col("login").alias("new_login"))
    base = (
        rules.join(claims, "email", "left")
        .join(placeholders.select("email", F.col("login").alias("placeholder_login")), "email", "left")
    )
    target = (
        F.when(F.col("rule").isin("web", "known", "insert", "merge"), F.col("login"))
        .when(F.col("rule") == "email_row", F.col("row_login"))
        .when(F.col("rule") == "search_hit", F.col("hit_login"))
        .when(F.col("rule") == "placeholder", F.coalesce("claim_login", "placeholder_login"))
    )
    resolution = (
        base.withColumn("old_login", target)
        .join(renamed, "old_login", "left")
        .select(*IDENTITY, "seq", "rule", F.coalesce("new_login", "old_login").alias("resolved_login"))
    )

    merged = apply_merges(users, winners, accounts, now)
    refreshed = apply_refresh(merged, rules, accounts)
    filled = fill_null(refreshed, fills, ["login"], ["name", "email"])
    new_rows = fill_null(inserted, fills, ["login"], ["name", "email"]).unionByName(placeholders, allowMissingColumns=True)
    return Identities(resolution, append_with_ids(filled, new_rows, ["login"]))


def placeholder_rows(mails: DataFrame, users: DataFrame, now: Column) -> DataFrame:
    """Placeholder accounts; a login of eight capitals that is taken is extended to 32."""
    lettered = mails.withColumn("letters", placeholder_letters(F.col("email"))).withColumn("login", F.substring("letters", 1, 8))
    shared = lettered.groupBy("login").agg(F.count("*").alias("n")).filter("n > 1").select("login")
    taken = users.select("login").join(lettered.select("login"), "login", "left_semi")
    clash = union_all([shared, taken]).distinct().withColumn("clash", F.lit(True))
    return lettered.join(clash, "login", "left").select(
        F.when(F.col("clash"), F.col("letters")).otherwise(F.col("login")).alias("login"), "name", "email",
        F.lit("USR").alias("type"), F.lit(True).alias("fake"), F.lit(False).alias("deleted"),
        now.alias("created_at"), now.alias("updated_at"),
    )


def apply_merges(users: DataFrame, winners: DataFrame, accounts: DataFrame, now: Column) -> DataFrame:
    """Rows found by e-mail take the login and profile of the account; they keep their id."""
    profile = winners.join(accounts.drop("email"), "login").select(
        F.col("row_login").alias("old_login"), F.struct(
            "login", "name", "company", "location", "email", "created_at"
        ).alias("m"),
    )
    joined = users.withColumnRenamed("login", "old_login").join(profile, "old_login", "left")
    hit = F.col("m").isNotNull()
    values = {
        "login": F.when(hit, F.col("m.login")).otherwise(F.col("old_login")),
        "name": F.coalesce("m.name", "name"),
        "company": F.when(hit, F.col("m.company")).otherwise(F.col("company")),
        "location": F.when(hit, F.col("m.location")).otherwise(F.col("location")),
        "email": F.when(hit, F.col("m.email")).otherwise(F.col("email")),
        "fake": F.when(hit, F.lit(False)).otherwise(F.col("fake")),
        "deleted": F.when(hit, F.lit(False)).otherwise(F.col("deleted")),
        "type": F.when(hit, F.lit("USR")).otherwise(F.col("type")),
        "created_at": F.when(hit, F.col("m.created_at")).otherwise(F.col("created_at")),
        "updated_at": F.when(hit, now).otherwise(F.col("updated_at")) if "updated_at" in users.columns else None,
    }
    return joined.select(*[values.get(c, F.col(f"`{c}`")).alias(c) for c in users.columns])


def apply_refresh(users: DataFrame, rules: DataFrame, accounts: DataFrame) -> DataFrame:
    """Accounts found by e-mail whose login has a row already: the row takes the account's profile."""
    hits = rules.filter("rule = 'search_hit'").select(F.col("hit_login").alias("login")).distinct()
    fields = [c for c in ("name", "company", "email", "location", "fake", "deleted", "created_at", "updated_at") if c in users.columns]
    profile = accounts.join(hits, "login", "left_semi").select("login", F.struct(*fields).alias("p"))
    hit = F.col("p").isNotNull()
    return users.join(profile, "login", "left").select(*[
        F.when(hit, F.col(f"p.{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(f"`{c}`") for c in users.columns
    ])
