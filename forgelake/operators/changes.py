"""Table change operators: current table and change set in, next table out.

A change set is usually far smaller than its table. The operators are written
so that only key columns of the table take part in a lookup, and adaptive
execution broadcasts the change set when its measured size allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from forgelake import schemas
from forgelake.session import cut_lineage

SENTINEL_ID = -1


def one_per_key(df: DataFrame, keys: list[str], order: list[Column | str], last: bool = False) -> DataFrame:
    """The first (or last) row of each key. Rows are combined before the shuffle.

    When the order names all other columns, the row is its own order and goes through the shuffle once.
    """
    others = [c for c in df.columns if c not in keys]
    if set(keys) <= set(df.columns) and all(isinstance(o, str) and o in df.columns for o in order) and set(others) <= set(order):
        if not others:
            return df.distinct()
        ordered = [o for o in dict.fromkeys(order) if o in others]
        row = (F.max if last else F.min)(F.struct(*[F.col(f"`{o}`") for o in ordered])).alias("picked")
        return df.groupBy(*keys).agg(row).select(*[F.col(f"`{c}`") if c in keys else F.col(f"picked.`{c}`") for c in df.columns])
    pick = F.max_by if last else F.min_by
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    picked = df.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in df.columns]), ordering).alias("picked"))
    return picked.select("picked.*")


def tiebreak(df: DataFrame, first: list[str]) -> list[str]:
    """Order columns completed by all other sortable columns, so that ties are settled."""
    kinds = dict(df.dtypes)
    return first + [c for c in df.columns if c not in first and not kinds[c].startswith(("map", "variant"))]


def known_keys(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of `rows` that the table holds already; reads only key columns of the table."""
    return table.select(*keys).join(rows.select(*keys), keys, "left_semi")


def missing(staged: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Staged rows whose key is not in the table."""
    return staged.join(known_keys(table, staged, keys), keys, "left_anti")


def kept(rows: DataFrame, stored: bool) -> DataFrame:
    """The rows, written when they are to be: a table that takes several change sets names itself and the set more
    than once in each, so its plan would double with every one."""
    return cut_lineage(rows, "new_rows") if stored else rows


def insert_missing(
    table: DataFrame, rows: DataFrame, keys: list[str], order: list[str] | None = None, stored: bool = False
) -> DataFrame:
    """Insert if absent; of several new rows with one key the first by `order` is taken. `stored` writes the new rows."""
    fresh = one_per_key(rows, keys, tiebreak(rows, order or keys))
    return table.unionByName(kept(missing(fresh, table, keys), stored), allowMissingColumns=True)


def upsert(
    table: DataFrame, rows: DataFrame, keys: list[str], order: list[str], present: str | None = None, stored: bool = False
) -> DataFrame:
    """Set the given fields, keep the others, insert when absent.

    `present` names an array column that lists the fields a row sets; a listed
    field is set even when its value is null. Without it every column of the
    change set is set. Several rows of one key apply in the given order. `stored` writes the
    changes and the new rows.
    """
    fields = [c for c in rows.columns if c not in keys and c != present and c in table.columns]
    ordering = F.struct(*[F.col(o) for o in order])
    sets = {c: F.array_contains(F.col(present), c) if present else F.lit(True) for c in fields}
    # The value sits in a struct: max_by would skip nothing, yet a null value must survive.
    changes = kept(rows.groupBy(*keys).agg(
        *[F.max_by(F.struct(F.col(c).alias("v")), F.when(sets[c], ordering)).alias(f"set_{c}") for c in fields]
    ), stored)
    flagged = changes.withColumn("is_change", F.lit(True))
    updated = table.join(flagged, keys, "left").select(*[
        F.when(F.col(f"set_{c}").isNotNull(), F.col(f"set_{c}.v")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
        for c in table.columns
    ])
    fresh = kept(missing(changes, table, keys).select(*keys, *[F.col(f"set_{c}.v").alias(c) for c in fields]), stored)
    return updated.unionByName(fresh, allowMissingColumns=True)


def delete(table: DataFrame, predicate: Column | None) -> tuple[DataFrame, Observation]:
    """Rows that stay, and an observation whose `deleted` is known after an action."""
    if predicate is None:
        raise ValueError("a delete needs a predicate; refusing to remove every row")
    hit = F.coalesce(predicate, F.lit(False))
    counts = Observation()
    observed = table.observe(counts, F.count_if(hit).alias("deleted"))
    return observed.filter(~hit), counts


def replace(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Delete and store: all rows of the given keys are exchanged."""
    stay = table.join(rows.select(*keys), keys, "left_anti").select(*table.columns)
    return stay.unionByName(rows, allowMissingColumns=True)


def fill_null(table: DataFrame, rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Fill columns of existing rows where they are null; `rows` has one row per key."""
    fills = rows.select(*keys, *[F.col(c).alias(f"fill_{c}") for c in columns])
    return table.join(fills, keys, "left").select(*[
        F.coalesce(F.col(c), F.col(f"fill_{c}")).alias(c) if c in columns else F.col(c) for c in table.columns
    ])


def flag_rows(table: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    """The table with a boolean `is_hit` for the rows whose key is listed."""
    hits = keys_df.select(*keys).distinct().withColumn("is_hit", F.lit(True))
    return table.join(hits, keys, "left").select(*table.columns, F.coalesce("is_hit", F.lit(False)).alias("is_hit"))


def soft_delete(table: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    """Mark the listed rows as deleted."""
    flagged = flag_rows(table, keys_df, keys)
    return flagged.withColumn("deleted", F.col("is_hit") | F.coalesce("deleted", F.lit(False))).drop("is_hit")


def update_later(table: DataFrame, rows: DataFrame, keys: list[str], ts: str, stored: bool = False) -> DataFrame:
    """Insert new keys; for known ones move the timestamp forward, never back. `stored` writes the dates and the new rows."""
    latest = kept(rows.groupBy(*keys).agg(F.max(ts).alias(f"new_{ts}")), stored)
    moved = table.join(latest, keys, "left").select(*[
        F.greatest(ts, f"new_{ts}").alias(ts) if c == ts else F.col(c) for c in table.columns
    ])
    fresh = kept(missing(latest, table, keys).withColumnRenamed(f"new_{ts}", ts), stored)
    return moved.unionByName(fresh, allowMissingColumns=True)


def delete_by_join(table: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Remove the rows that belong to the given parents."""
    return table.join(parents.select(*keys), keys, "left_anti").select(*table.columns)


def with_sentinels(users: DataFrame, projects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add the rows with id -1 that stand for vanished users and projects, once."""
    spark = users.sparkSession
    # The sentinel rows.
    nobody = spark.range(1).select(
        F.lit(SENTINEL_ID).cast("bigint").alias("id"), F.lit("0xnoone").alias("login"),
        F.lit("no@nowhere.noplace").alias("email"),
        F.lit("Fake entry to indicate a missing user previously existing").alias("name"),
    )
    nothing = spark.range(1).select(
        F.lit(SENTINEL_ID).cast("bigint").alias("id"), F.lit("noproject").alias("name"),
        F.lit(SENTINEL_ID).cast("bigint").alias("owner_id"),
        F.lit("Fake entry to indicate a previously existing but currently absent repo").alias("description"),
    )

    def add(table: DataFrame, row: DataFrame) -> DataFrame:
        kept = [c for c in row.columns if c in table.columns]
        return table.filter(F.col("id") != SENTINEL_ID).unionByName(row.select(*kept), allowMissingColumns=True)

    return add(users, nobody), add(projects, nothing)


def touch(table: DataFrame, keys_df: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """Set `updated_at` of the listed rows."""
    flagged = flag_rows(table, keys_df, keys)
    return flagged.withColumn("updated_at", F.when(F.col("is_hit"), now).otherwise(F.col("updated_at"))).drop("is_hit")


# Columns of the public and the private part of the users table.
PUBLIC_USER_COLUMNS = [
    "id", "login", "company", "created_at", "type", "fake", "deleted", "long", "lat", "country_code",
    "state", "city", "location",
]
PRIVATE_USER_COLUMNS = ["login", "name", "email"]


def split_private(users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Public and private projections of the users table."""
    public = [c for c in PUBLIC_USER_COLUMNS if c in users.columns]
    return users.select(*[F.col(f"`{c}`") for c in public]), users.select(*PRIVATE_USER_COLUMNS)


def check_fks(
    tables: dict[str, DataFrame], references: list[tuple[str, str, str]] = schemas.FOREIGN_KEYS
) -> DataFrame:
    """Broken references: table, column, number of rows whose target is missing.

    Values are counted before the join, so a hot value meets the join once.
    """
    parts = []
    for table, column, target in references:
        if table not in tables or target not in tables:
            continue
        values = tables[table].filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("id")).agg(F.count("*").alias("n"))
        lost = values.join(tables[target].select("id"), "id", "left_anti")
        parts.append(lost.agg(F.sum("n").alias("n")).select(
            F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.col("n").alias("violations"),
        ))
    return union_all(parts).filter("violations > 0")


def check_unique(tables: dict[str, DataFrame], table_keys: dict[str, list[str]] = schemas.TABLE_KEYS) -> DataFrame:
    """Tables whose natural key repeats: table, number of repeated keys, surplus rows."""
    parts = []
    for table, keys in table_keys.items():
        if table not in tables:
            continue
        repeated = tables[table].groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
        parts.append(repeated.agg(F.count("*").alias("repeated_keys"), F.sum(F.col("n") - 1).alias("surplus_rows")).select(
            F.lit(table).alias("table_name"), "repeated_keys", "surplus_rows",
        ))
    return union_all(parts).filter("repeated_keys > 0")


def union_all(parts: list[DataFrame]) -> DataFrame:
    if not parts:
        raise ValueError("nothing to combine")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result
