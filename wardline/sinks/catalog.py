"""Catalog tables (K12, K14, K15, K17, K18, S5, S6 by name; J4, J5 over buckets).

DDL for the eight tables is generated from ``schemas``: parquet tables of the session
catalog, with an insert stamp that the table sets itself (``DEFAULT current_timestamp()``)
and, if asked, bucketed by encounter. Buckets of one count lie alike in all tables, so
the joins of retention and of the merge read them side by side, without a shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardline.operators.retention import prune_child, prune_master
from wardline.schemas import CHILD_TABLES, CURRENT, HISTORY, KEY

#: Columns that the table fills where an insert does not name them.
DEFAULTS = {"row_insert_tsp": "current_timestamp()", "insert_user_id": "current_user()"}


def create_statement(name: str, schema: StructType, buckets: int | None = None, key: str = KEY) -> str:
    """CREATE TABLE of a parquet table from its schema."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {DEFAULTS[f.name]}" if f.name in DEFAULTS else "") for f in schema.fields)
    cut = f" CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS" if buckets else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{cut}"


def create_catalog(spark: SparkSession, database: str, buckets: int | None = None, location: str | None = None) -> list[str]:
    """The database (below ``location``, if given) and its eight tables, those that are missing; their names.
    Tables that exist, empty or not, stay (D17)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    for name, schema in {**HISTORY, **CURRENT}.items():
        spark.sql(create_statement(f"{database}.{name}", schema, buckets))
    return [f"{database}.{name}" for name in (*HISTORY, *CURRENT)]


def truncate(spark: SparkSession, names: Iterable[str]) -> None:
    """Empty tables; schema, defaults and buckets stay."""
    for name in names:
        spark.sql(f"TRUNCATE TABLE {name}")


def insert_select(df: DataFrame, name: str) -> None:
    """Positional INSERT … SELECT into a table: as many columns as it has, cast to their types."""
    schema = df.sparkSession.table(name).schema
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns given, {name} has {len(schema.fields)}")
    df.select(*[F.col(f"`{c}`").cast(f.dataType).alias(f.name) for c, f in zip(df.columns, schema.fields, strict=True)]).write.insertInto(name)


def insert_named(df: DataFrame, name: str) -> None:
    """Insert the columns that ``df`` has, by name; the table fills its defaults, the rest is NULL."""
    spark, view = df.sparkSession, f"_rows_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{c}`" for c in df.columns)
    df.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def tail(spark: SparkSession, name: str, max_files: int | None = None) -> DataFrame:
    """Incremental read of a catalog table that is appended to."""
    r = spark.readStream
    return (r.option("maxFilesPerTrigger", max_files) if max_files else r).table(name)


def replace_contents(df: DataFrame, name: str, buckets: int | None = None, key: str = KEY) -> None:
    """A table's contents replaced by rows that may be read from it: a new table is written, then renamed in.

    Rows that come from buckets of that count are written to theirs without a shuffle.
    """
    spark = df.sparkSession
    database, table = name.split(".")
    schema = spark.table(name).schema
    fresh = f"{database}.{table}_{uuid.uuid4().hex[:8]}"
    spark.sql(create_statement(fresh, schema, buckets, key))
    df.select(*schema.fieldNames()).write.insertInto(fresh)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def retention(spark: SparkSession, database: str, days: int = 2, as_of=None, buckets: int | None = None) -> None:
    """R3 over the catalog's four histories: children against the encounters that stay, then the master."""
    master = spark.table(f"{database}.adt_hist")
    kept = prune_master(master, days, as_of)
    for child in CHILD_TABLES:
        replace_contents(prune_child(spark.table(f"{database}.{child}"), kept), f"{database}.{child}", buckets)
    replace_contents(kept, f"{database}.adt_hist", buckets)
