"""Catalog helpers (S8-S12, S15): databases, table writes, reads and counts.

Tables are managed Parquet tables of the session catalog, in their database's location.
``save_table`` never overwrites files that the frame being written may read.  The rows of an existing table
are replaced by writing them to a folder of their own and then pointing the table there, one change in the catalog: whoever
dies, and whenever, leaves the old table or the new one.  A table whose columns change needs a new
definition, and a partitioned one new partitions; these are written beside the old one and renamed, and a swap
that was cut off between its two renames is finished by the next read or write.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.audit import table_counts
from ..session import CODEC, list_folders, remove_folder


def ensure_database(spark: SparkSession, db: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (S12); the caller's current database stays."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")


def drop_database(spark: SparkSession, db: str) -> None:
    """Drop a database with its tables and their files."""
    spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")


def qualified(db: str | None, name: str) -> str:
    return f"`{db}`.`{name}`" if db else f"`{name}`"


def drop_table(spark: SparkSession, name: str, db: str | None = None) -> None:
    """``DROP TABLE IF EXISTS`` (S11); a managed table's files go with it."""
    spark.sql(f"DROP TABLE IF EXISTS {qualified(db, name)}")


VERSION = "__v_"
NEW, OLD = "__new_", "__old_"


def location(spark: SparkSession, name: str, db: str) -> str:
    """The folder that table ``name`` points to."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(db, name)}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def _replaceable(spark: SparkSession, df: DataFrame, name: str, db: str, partition_by: Sequence[str], fmt: str) -> bool:
    """Whether new rows of ``df`` fit the definition of the table, so that it only has to point to them."""
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(db, name)}").collect()}
    columns = lambda x: [(f.name, f.dataType) for f in x.schema.fields]
    same = [(n, t.simpleString()) for n, t in columns(df)] == [(n, t.simpleString()) for n, t in columns(spark.table(qualified(db, name)))]
    return (same and not partition_by and "# Partition Information" not in described and "Num Buckets" not in described and described.get("Provider", "").lower() == fmt
            and described.get("Type") == "MANAGED")


def finish_swap(spark: SparkSession, name: str, db: str) -> None:
    """Finish a swap by renames that was cut off: of a table that is missing, the written one, else the old one, takes the name."""
    if spark.catalog.tableExists(f"{db}.{name}"):
        return
    tables = sorted(r["tableName"] for r in spark.sql(f"SHOW TABLES IN `{db}` LIKE '{name}__*'").collect())
    olds = [t for t in tables if t.startswith(name + OLD)]
    if not olds:
        return   # a table that was never there, or is being written for the first time
    mark = olds[-1].removeprefix(name + OLD)
    kept = name + NEW + mark if name + NEW + mark in tables else olds[-1]
    _rename(spark, qualified(db, kept), qualified(db, name))


def save_table(df: DataFrame, name: str, db: str | None = None, partition_by: Sequence[str] = (),
               fmt: str = "parquet", buckets: tuple[str, int] | None = None) -> str:
    """Overwrite managed table ``name`` of database ``db`` (default: the current one).

    ``df`` may read the table, by name or by path, and a failed write leaves the old one.  ``buckets``: (column, number)
    by which rows are dealt to files and sorted; tables dealt alike are joined and grouped by the column without a
    shuffle.
    """
    spark = df.sparkSession
    db = db or spark.catalog.currentDatabase()
    target = qualified(db, name)

    def written():
        w = df.write.format(fmt)
        return w.options(**CODEC) if fmt == "parquet" else w

    def write(table: str) -> None:
        w = written()
        if partition_by:
            w = w.partitionBy(*partition_by)
        if buckets:
            w = w.bucketBy(buckets[1], buckets[0]).sortBy(buckets[0])
        w.saveAsTable(table)

    finish_swap(spark, name, db)
    if not spark.catalog.tableExists(f"{db}.{name}"):
        write(target)
        return target
    mark = uuid.uuid4().hex[:8]
    if not buckets and _replaceable(spark, df, name, db, partition_by, fmt):
        before = location(spark, name, db)
        folder = f"{before.split(VERSION)[0]}{VERSION}{mark}"
        written().save(folder)
        _point(spark, target, folder)
        remove_folder(spark, before)
        return target
    new, old = (qualified(db, f"{name}{x}{mark}") for x in (NEW, OLD))
    write(new)
    _swap(spark, target, new, old)
    spark.sql(f"DROP TABLE {old}")
    return target


def _point(spark: SparkSession, table: str, folder: str) -> None:
    """The one change that makes written rows the table's."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def _swap(spark: SparkSession, target: str, new: str, old: str) -> None:
    _rename(spark, target, old)
    _rename(spark, new, target)


def _rename(spark: SparkSession, table: str, to: str) -> None:
    """Rename a table; partitions are listed anew, as the catalog keeps their old folders."""
    spark.sql(f"ALTER TABLE {table} RENAME TO {to}")
    if not spark.sql(f"DESCRIBE TABLE EXTENDED {to}").where("col_name = '# Partition Information'").isEmpty():
        spark.sql(f"MSCK REPAIR TABLE {to} SYNC PARTITIONS")


def remove_unused_versions(spark: SparkSession, name: str, db: str) -> int:
    """Remove the folders of versions that a dead writer left; returns their number.  Run it while nobody writes the table."""
    used = location(spark, name, db)
    base = used.split(VERSION)[0]
    unused = [f for f in list_folders(spark, base.rsplit("/", 1)[0]) if f.startswith(base + VERSION) and f != used]
    for f in unused:
        remove_folder(spark, f)
    return len(unused)


def create_table_as_select(spark: SparkSession, name: str, select_sql: str, db: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet AS SELECT``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified(db, name)} USING parquet AS {select_sql}")


def read_table(spark: SparkSession, name: str, db: str | None = None) -> DataFrame:
    """Catalog table scan."""
    if db:
        finish_swap(spark, name, db)
    return spark.table(qualified(db, name))


def counts(spark: SparkSession, names: Iterable[str], db: str | None = None) -> DataFrame:
    """One frame of ``(table_name, row_count)`` for saved tables."""
    return table_counts({n: read_table(spark, n, db) for n in names})
