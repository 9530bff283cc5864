"""Tables laid out in hash buckets of a key, replaced a bucket at a time.

A keyed table is parquet, partitioned by the bucket of its key.  Replacing or
deleting keys reads and writes the buckets that hold them and no other: the new
bucket is written below the next numbered version, then the table's partition
is pointed at it.  Untouched buckets keep their files, readers never see half a
bucket, and the version before stays for a job that still reads it.  What a
delta costs follows the buckets it touches, not the table; choose their number
so that a bucket is some hundred megabytes.

One writer at a time.  A run that dies between buckets is made whole by running
it again, because replacing by key twice leaves what once does.  Null keys
share a bucket, match no listed key and stay.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "bucket_no"
BUCKETS = 64
KEY_PROPERTY, BUCKETS_PROPERTY = "inkmeter.key", "inkmeter.buckets"
STATEMENT_PARTITIONS = 500


@dataclass(frozen=True)
class Layout:
    """Key column and bucket count of a keyed table."""

    key: str
    buckets: int

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")


def layout_of(spark: SparkSession, name: str) -> Layout | None:
    """The layout of a table, or None when it is not keyed."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    found = {r["key"]: r["value"] for r in rows}
    if KEY_PROPERTY not in found:
        return None
    return Layout(found[KEY_PROPERTY], int(found[BUCKETS_PROPERTY]))


class _Files:
    """The versions below a table's root, on whatever file system holds it."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        schema, table = name.split(".")
        self.jvm = spark.sparkContext._jvm
        self.root = f"{spark.catalog.getDatabase(schema).locationUri}/{table}"
        self.fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):  # noqa: ANN202
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        if not self.fs.exists(self._path(path)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(path)))

    def versions(self) -> list[str]:
        return [n for n in self.names(self.root) if n.startswith("version=")]

    def next_version(self) -> str:
        last = max((int(v.partition("=")[2]) for v in self.versions()), default=0)
        return f"version={last + 1:08d}"

    def make(self, path: str) -> None:
        self.fs.mkdirs(self._path(path))

    def drop(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def drop_superseded(self) -> None:
        """Of each bucket keep the newest folder and the one before it."""
        seen: dict[str, int] = {}
        for version in reversed(self.versions()):
            kept = 0
            for part in self.names(f"{self.root}/{version}"):
                if not part.startswith(f"{BUCKET}="):
                    continue
                seen[part] = seen.get(part, 0) + 1
                if seen[part] > 2:
                    self.drop(f"{self.root}/{version}/{part}")
                else:
                    kept += 1
            if not kept:
                self.drop(f"{self.root}/{version}")


def create_keyed(
    spark: SparkSession, name: str, schema, key: str, buckets: int = BUCKETS  # noqa: ANN001
) -> None:
    """An empty keyed table, if there is none of that name."""
    if spark.catalog.tableExists(name):
        return
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.split('.')[0]}")
    columns = spark.createDataFrame([], schema).schema
    if key not in columns.names or BUCKET in columns.names:
        raise ValueError(f"{name} needs the key column {key} and no column {BUCKET}")
    files = _Files(spark, name)
    files.drop(files.root)  # what a dropped table of that name left
    files.make(files.root)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    spark.sql(
        f"CREATE TABLE {name} ({fields}, {BUCKET} int) USING parquet PARTITIONED BY ({BUCKET}) "
        f"LOCATION '{files.root}' "
        f"TBLPROPERTIES ('{KEY_PROPERTY}'='{key}', '{BUCKETS_PROPERTY}'='{buckets}')"
    )


def _layout(spark: SparkSession, name: str) -> Layout:
    layout = layout_of(spark, name)
    if layout is None:
        raise ValueError(f"{name} is not a keyed table")
    return layout


def _typed(spark: SparkSession, name: str, layout: Layout, keys: DataFrame, column: str) -> DataFrame:
    """Distinct keys in the table's own type, which the bucket hash depends on."""
    kind = spark.table(name).schema[layout.key].dataType
    return keys.select(F.col(column).cast(kind).alias(layout.key)).distinct()


def _touched(layout: Layout, *keys: DataFrame) -> list[int]:
    """Buckets of the keys: at most as many numbers as there are buckets."""
    found: set[int] = set()
    for k in keys:
        found |= {r[0] for r in k.select(layout.bucket(F.col(layout.key))).distinct().collect()}
    return sorted(found)


def read_keyed(
    spark: SparkSession, name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    table = spark.table(name).drop(BUCKET)
    return table.select(*columns) if columns else table


def rows_of(spark: SparkSession, name: str, keys: DataFrame, column: str | None = None) -> DataFrame:
    """The rows of the listed keys, read from their buckets only."""
    layout = _layout(spark, name)
    listed = _typed(spark, name, layout, keys, column or layout.key)
    inside = spark.table(name).where(F.col(BUCKET).isin(_touched(layout, listed)))
    return inside.drop(BUCKET).join(listed, layout.key, "left_semi").select(
        *read_keyed(spark, name).columns
    )


def replace_keys(
    spark: SparkSession,
    name: str,
    rows: DataFrame | None,
    keys: DataFrame,
    column: str | None = None,
) -> list[int]:
    """Swap the listed keys' rows for the new ones; returns the buckets written.

    A listed key without new rows loses its old ones; rows of keys that are not
    listed are added to what is there.
    """
    layout = _layout(spark, name)
    listed = _typed(spark, name, layout, keys, column or layout.key)
    table = read_keyed(spark, name)
    fields = table.schema
    touched_by = [listed]
    if rows is not None:
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
        touched_by.append(rows.select(layout.key))
    buckets = _touched(layout, *touched_by)
    if not buckets:
        return []
    kept = (
        spark.table(name)
        .where(F.col(BUCKET).isin(buckets))
        .drop(BUCKET)
        .join(listed, layout.key, "left_anti")
        .select(*fields.names)
    )
    new = kept if rows is None else kept.unionByName(rows)
    files = _Files(spark, name)
    version = files.next_version()
    # A bucket is one file, or several where its rows are many
    new.withColumn(BUCKET, layout.bucket(F.col(layout.key))).hint("rebalance", BUCKET).write.partitionBy(
        BUCKET
    ).parquet(f"{files.root}/{version}")
    _point(spark, name, files, version, buckets)
    files.drop_superseded()
    return buckets


def _point(
    spark: SparkSession, name: str, files: _Files, version: str, buckets: list[int]
) -> None:
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    places = {f"{BUCKET}={b}": f"{files.root}/{version}/{BUCKET}={b}" for b in buckets}
    written = set(files.names(f"{files.root}/{version}"))
    for part, place in places.items():
        if part not in written:  # nothing is left of this bucket
            files.make(place)
        if part in known:
            spark.sql(f"ALTER TABLE {name} PARTITION ({part}) SET LOCATION '{place}'")
    added = [f"PARTITION ({p}) LOCATION '{at}'" for p, at in places.items() if p not in known]
    for first in range(0, len(added), STATEMENT_PARTITIONS):
        some = " ".join(added[first : first + STATEMENT_PARTITIONS])
        spark.sql(f"ALTER TABLE {name} ADD {some}")
    spark.catalog.refreshTable(name)
