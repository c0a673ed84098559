"""CSV dumps of the tables: reading, writing, repair and typed loading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructType, TimestampType

from forgelake import schemas
from forgelake.operators.changes import PRIVATE_USER_COLUMNS, PUBLIC_USER_COLUMNS, split_private
from forgelake.session import cut_lineage

# Dump format.
NULL = "\\N"
ZERO_DATE = "0000-00-00 00:00:00"
EPOCH = "1970-01-01 00:00:00"


def dump_columns(table: str) -> list[str]:
    """Columns of a table's dump file, in order."""
    if table == "users":
        return PUBLIC_USER_COLUMNS
    if table == "users-private":
        return PRIVATE_USER_COLUMNS
    kept_private = {"projects": ["etag"]}.get(table, [])
    return [f.name for f in schemas.table_schema(table).fields if f.name not in kept_private]


def dump_schema(table: str) -> StructType:
    full = schemas.table_schema("users" if table == "users-private" else table)
    return StructType([full[c] for c in dump_columns(table)])


def read_text_dump(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A dump file as text columns. Quotes are optional, backslash escapes, \\N is null."""
    schema = StructType()
    for name in columns:
        schema = schema.add(name, StringType())
    return spark.read.csv(
        path, schema=schema, quote='"', escape="\\", nullValue=NULL, multiLine=True, mode="PERMISSIVE",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def typed(df: DataFrame, schema: StructType, zero_dates: str = "null") -> DataFrame:
    """Text columns cast to the schema; what does not fit becomes null.

    Zero dates become null or, with `zero_dates="epoch"`, the epoch.
    """
    return df.select(*[
        typed_column(F.col(f"`{f.name}`"), f.dataType, zero_dates).alias(f.name) for f in schema.fields
    ], *[c for c in df.columns if c not in schema.fieldNames()])


def typed_column(c: Column, kind, zero_dates: str) -> Column:
    if isinstance(kind, StringType):
        return c
    if isinstance(kind, BooleanType):
        return F.when(c.isin("1", "t", "true"), True).when(c.isin("0", "f", "false"), False)
    if isinstance(kind, TimestampType):
        stand_in = F.lit(EPOCH) if zero_dates == "epoch" else F.lit(None).cast("string")
        return F.when(c == ZERO_DATE, stand_in).otherwise(c).try_cast("timestamp")
    return c.try_cast(kind)


def read_dump(spark: SparkSession, directory: str, table: str, zero_dates: str = "null") -> DataFrame:
    """One table of a dump directory, typed. Read as text first, so one bad field costs one field.

    Files with embedded newlines cannot be split: a large dump should come as
    many files, or be turned into Parquet once by `load_typed`.
    """
    text = read_text_dump(spark, f"{directory.rstrip('/')}/{table}.csv", dump_columns(table))
    return typed(text, dump_schema(table), zero_dates)


def quoted(c: Column, kind) -> Column:
    """A field in quotes with backslash and quote escaped; null is the bare marker."""
    if isinstance(kind, BooleanType):
        c = c.cast("int")
    if isinstance(kind, TimestampType):
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    text = F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\"))
    escaped = F.replace(text, F.lit('"'), F.lit('\\"'))
    return F.coalesce(F.concat(F.lit('"'), escaped, F.lit('"')), F.lit(NULL))


def dump_lines(df: DataFrame, columns: list[str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(F.concat_ws(",", *[quoted(F.col(f"`{c}`"), kinds[c]) for c in columns]).alias("value"))


def write_dump(tables: dict[str, DataFrame], directory: str, skip: tuple[str, ...] = ()) -> list[str]:
    """Write the tables in reference order; users become a public and a private file."""
    written = []
    base = directory.rstrip("/")
    for table in schemas.TABLE_ORDER:
        if table not in tables or table in skip:
            continue
        df = tables[table]
        parts = {table: df}
        if table == "users":
            public, private = split_private(df)
            parts = {"users": public, "users-private": private}
        for name, part in parts.items():
            columns = [c for c in dump_columns(name) if c in part.columns]
            dump_lines(part, columns).write.mode("overwrite").text(f"{base}/{name}.csv")
            written.append(name)
    return written


def normalise_text(c: Column) -> Column:
    """Line breaks become spaces and a lone backslash gets a space, as plain CSV readers need it."""
    flat = F.regexp_replace(c, r"\\?\n", " ")
    flat = F.regexp_replace(flat, r"\r", " ")
    return F.replace(flat, F.lit("\\"), F.lit("\\ "))


def normalise_dump(df: DataFrame) -> DataFrame:
    """Text columns of a damaged dump, repaired; zero dates become the epoch."""
    return df.select(*[
        F.when(F.col(f"`{f.name}`") == ZERO_DATE, F.lit(EPOCH)).otherwise(normalise_text(F.col(f"`{f.name}`"))).alias(f.name)
        if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def write_plain_csv(df: DataFrame, path: str) -> None:
    """Standard CSV: doubled quotes, empty fields for null."""
    df.write.mode("overwrite").csv(path, quote='"', escape='"', nullValue="", emptyValue='""')


def bad_column(schema: StructType) -> Column:
    """Name of the first column whose non-null text does not fit its type; null for a sound row."""
    reasons = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if not isinstance(f.dataType, StringType):
            reasons.append(F.when(c.isNotNull() & typed_column(c, f.dataType, "epoch").isNull(), f.name))
    return F.coalesce(*reasons, F.lit(None).cast("string"))


def check_budget(flagged: DataFrame, max_bad: int | None) -> None:
    """An error when there are more bad rows than allowed; no limit without a number."""
    n_bad = 0 if max_bad is None else flagged.agg(F.count("reason").alias("n")).first()["n"]
    if max_bad is not None and n_bad > max_bad:
        raise ValueError(f"{n_bad} bad rows, {max_bad} allowed")


def good_rows(text: DataFrame, schema: StructType, max_bad: int = 0) -> DataFrame:
    """Typed rows without the bad ones; an error when there are more bad ones than allowed."""
    flagged = text.withColumn("reason", bad_column(schema))
    check_budget(flagged, max_bad)
    return typed(flagged.filter("reason is null").drop("reason"), schema, "epoch")


def load_typed(
    spark: SparkSession, path: str, schema: StructType, target: str, rejects: str, max_bad: int | None = 0
) -> DataFrame:
    """Load a repaired dump into a Parquet table, replacing it.

    Every bad row lands in the `rejects` folder, with its source texts and, as
    `reason`, the column at fault. The budget only decides whether the load fails;
    the rejects are written also then.
    """
    flagged = cut_lineage(read_text_dump(spark, path, schema.fieldNames()).withColumn("reason", bad_column(schema)), "flagged")
    flagged.filter("reason is not null").write.mode("overwrite").parquet(rejects)
    check_budget(flagged, max_bad)
    typed(flagged.filter("reason is null").drop("reason"), schema, "epoch").write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
