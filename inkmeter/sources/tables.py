"""Named tables: read, write, append, delete and replace by key.

A table is parquet in the session catalog.  Overwriting writes a new folder
below the table's root and then points the table at it, so a job may read the
table it overwrites, readers never see half a write, and a lost executor
costs a task retry, nothing else.  Tables that are replaced by key are laid out
by key (see ``keyed``), so that a delta rewrites the buckets it touches.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from inkmeter.sources import keyed


class TableMissing(Exception):
    """The named table does not exist."""


def read_table(
    spark: SparkSession, name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    if not spark.catalog.tableExists(name):
        raise TableMissing(name)
    table = spark.table(name).drop(keyed.BUCKET) if keyed.layout_of(spark, name) else spark.table(name)
    return table.select(*columns) if columns else table


def _new_location(spark: SparkSession, name: str) -> str:
    """The next numbered version; the random part keeps two writers apart."""
    schema, table = name.split(".")
    root = f"{spark.catalog.getDatabase(schema).locationUri}/{table}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [v.getPath().getName() for v in files.listStatus(path)] if files.exists(path) else []
    numbers = [int(n[8:16]) for n in names if n.startswith("version=") and n[8:16].isdigit()]
    return f"{root}/version={max(numbers, default=0) + 1:08d}-{uuid.uuid4().hex[:8]}"


def write_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Create or overwrite a table, or append to it matching columns by name."""
    spark = df.sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.split('.')[0]}")
    exists = spark.catalog.tableExists(name)
    layout = keyed.layout_of(spark, name) if exists else None
    if layout is not None:
        if mode != "append":
            raise ValueError(f"{name} is replaced by key, not overwritten")
        keyed.replace_keys(spark, name, df, df.select(layout.key).limit(0))
        return
    if mode == "append" and exists:
        df.select(*spark.table(name).columns).write.insertInto(name)
        return
    location = _new_location(spark, name)
    df.write.parquet(location)
    if exists and spark.table(name).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=location, source="parquet", schema=df.schema)
    spark.catalog.refreshTable(name)
    _drop_superseded(spark, location)


def _drop_superseded(spark: SparkSession, location: str) -> None:
    """Remove a table's older versions but the one before, which a job may still read."""
    jvm = spark.sparkContext._jvm
    current = jvm.org.apache.hadoop.fs.Path(location)
    files = current.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    versions = [
        v
        for v in files.listStatus(current.getParent())
        if v.getPath().getName().startswith("version=")
        and v.getPath().getName() != current.getName()
    ]
    for old in sorted(versions, key=lambda v: v.getPath().getName())[:-1]:
        files.delete(old.getPath(), True)


def ensure_table(spark: SparkSession, name: str, schema: str) -> None:
    """An empty table of that schema, if there is none."""
    if not spark.catalog.tableExists(name):
        write_table(spark.createDataFrame([], schema), name)


def without_keys(table: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows whose key is not listed."""
    return table.join(keys.select(column), column, "left_anti").select(*table.columns)


def delete_where(spark: SparkSession, name: str, keys: DataFrame, column: str) -> None:
    """Delete by a key list; an empty list rewrites nothing.

    A table keyed by that column rewrites the buckets of the keys, another one
    is rewritten as a whole.
    """
    layout = keyed.layout_of(spark, name)
    if layout is not None and layout.key == column:
        keyed.replace_keys(spark, name, None, keys, column)
        return
    if keys.isEmpty():
        return
    write_table(without_keys(spark.table(name), keys, column), name)


def replaced(table: DataFrame, rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The table with the listed keys' rows swapped for the new ones."""
    return without_keys(table, keys, column).unionByName(rows)


def sync_table(
    spark: SparkSession,
    name: str,
    rows: DataFrame,
    todo: DataFrame,
    stale: DataFrame,
    column: str = "work_id",
) -> None:
    """Swap re-measured works' rows in place, drop stale works, keep the rest.

    ``todo`` lists the works that were measured again.  One of them without new
    rows loses its old ones; taking the keys from the new rows would keep them.
    """
    if not spark.catalog.tableExists(name):
        keyed.create_keyed(spark, name, rows.schema, column)
    keys = todo.select(column).union(stale.select(column)).distinct()
    layout = keyed.layout_of(spark, name)
    if layout is not None and layout.key == column:
        keyed.replace_keys(spark, name, rows, keys, column)
        return
    write_table(replaced(spark.table(name), rows, keys, column), name)


def export_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Write each mart as parquet for the report pages."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def stage_table(df: DataFrame, folder: str, *partition_by: str) -> DataFrame:
    """Write an intermediate result that several jobs read; return the reader.

    ``folder`` must be on storage every executor sees.  This, not a local
    checkpoint, is what cuts lineage here.
    """
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)

