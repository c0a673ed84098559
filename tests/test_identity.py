"""One case per row of the identity decision table."""

import pytest
from pyspark.sql import functions as F

from forgelake.operators.identity import placeholder_letters, resolve_identities

USERS = "id bigint, login string, name string, company string, email string, location string, type string, fake boolean, deleted boolean, created_at timestamp, updated_at timestamp"
RAW = "login string, name string, company string, email string, location string, type string, created_at string"
IDS = "login string, name string, email string, seq bigint"

CASES = [
    ("web-flow", "W", "row@x.org", 1),
    (None, "A", "row@x.org", 2),
    (None, "B", "hit@x.org", 3),
    (None, "C", "nobody@x.org", 4),
    ("known", "D", "d@x.org", 5),
    ("gone", "E", "row@x.org", 6),
    ("gone", "F", "lost@x.org", 7),
    ("fresh", "G", "g@x.org", 8),
    ("renamed", "H", "old@x.org", 9),
    ("late", "I", "old@x.org", 10),
    (None, "J", "old@x.org", 11),
    (None, "K", "g@x.org", 12),
    (None, "L", None, 13),
]


@pytest.fixture(scope="module")
def outcome(spark):
    users = spark.createDataFrame([
        (1, "rowuser", "R", None, "row@x.org", None, "USR", False, False, None, None),
        (2, "known", None, None, None, None, "USR", False, False, None, None),
        (3, "OLDLOGIN", "O", None, "old@x.org", None, "USR", True, False, None, None),
    ], USERS)
    raw = spark.createDataFrame([
        ("web-flow", "Web", None, None, None, "User", "2015-01-01T00:00:00Z"),
        ("hitter", "Hit", "acme", "hit@x.org", None, "User", "2015-01-01T00:00:00Z"),
        ("fresh", None, None, " ", None, "User", "2015-01-01T00:00:00Z"),
        ("renamed", "Ren", "corp", None, None, "User", "2015-01-01T00:00:00Z"),
        ("late", "Late", None, None, None, "User", "2015-01-01T00:00:00Z"),
    ], RAW)
    result = resolve_identities(spark.createDataFrame(CASES, IDS), users, raw, F.timestamp_seconds(F.lit(0)))
    rules = {r["seq"]: r for r in result.resolution.collect()}
    rows = {r["login"]: r for r in result.users.collect()}
    letters = spark.range(1).select(placeholder_letters(F.lit("nobody@x.org"))).first()[0]
    return rules, rows, letters


def test_rules(outcome):
    rules, _, letters = outcome
    assert [rules[s]["rule"] for s in range(1, 14)] == [
        "web", "email_row", "search_hit", "placeholder", "known", "email_row", "placeholder", "insert", "merge", "merge",
        "email_row", "placeholder", "unknown",
    ]
    assert [rules[s]["resolved_login"] for s in (1, 2, 3, 5, 6, 8, 9, 10, 11, 12, 13)] == [
        "web-flow", "rowuser", "hitter", "known", "rowuser", "fresh", "renamed", "late", "renamed", "fresh", None,
    ]
    assert rules[4]["resolved_login"] == letters[:8]


def test_users(outcome):
    _, rows, letters = outcome
    assert (rows["renamed"]["id"], rows["renamed"]["name"], rows["renamed"]["fake"]) == (3, "Ren", False)
    assert (rows["known"]["name"], rows["known"]["email"]) == ("D", "d@x.org")
    assert (rows["fresh"]["name"], rows["fresh"]["email"]) == ("G", "g@x.org")
    assert rows[letters[:8]]["fake"] and "OLDLOGIN" not in rows
    assert rows["late"]["id"] > 3 and rows["late"]["email"] == "old@x.org"
    ids = [r["id"] for r in rows.values()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_placeholder_login_extended_when_taken(spark):
    letters = spark.range(1).select(placeholder_letters(F.lit("n@x.org"))).first()[0]
    users = spark.createDataFrame([(1, letters[:8], None, None, "other@x.org", None, "USR", True, False, None, None)], USERS)
    ids = spark.createDataFrame([(None, "N", "n@x.org", 1)], IDS)
    result = resolve_identities(ids, users, spark.createDataFrame([], RAW), F.timestamp_seconds(F.lit(0)))
    assert result.resolution.first()["resolved_login"] == letters
