"""Row history: type-2 snapshots and the run log.

``snapshot`` compares two DataFrames.  ``snapshot_table`` keeps a history
between runs in two tables: open rows, laid out by key, and closed rows, one
partition a run, which are only ever added to.  A run writes the keys that
changed and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmeter.functions.keys import fields_hash
from inkmeter.sources import keyed

RUN_LOG_SCHEMA = (
    "invocation_id string, run_started_at timestamp, command string, node string, "
    "resource_type string, status string, execution_time double"
)


def first_snapshot(current: DataFrame, run_ts: str) -> DataFrame:
    return current.select(
        "*",
        F.lit(run_ts).cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def snapshot(history: DataFrame, current: DataFrame, key: str, run_ts: str) -> DataFrame:
    """The history after comparing its open rows with the current table.

    Every column is compared.  An unchanged row stays open; a changed one is
    closed and reopened; a vanished one is closed; a new or returned key is
    opened.  The key is unique on both sides, so one full join decides all,
    and each pair yields the one or two rows it leaves behind.
    """
    run = F.lit(run_ts).cast("timestamp")
    columns = current.columns
    closed = history.filter(F.col("valid_to").isNotNull())
    was = history.filter(F.col("valid_to").isNull()).select(
        F.col(key).alias("_old_key"),
        fields_hash_null(columns).alias("_old_hash"),
        F.struct(*columns, "valid_from").alias("_was"),
    )
    now = current.select(
        F.col(key).alias("_new_key"),
        fields_hash_null(columns).alias("_new_hash"),
        F.struct(*columns).alias("_now"),
    )
    pair = was.join(now, F.col("_old_key") == F.col("_new_key"), "full")
    same = F.coalesce(F.col("_old_hash") == F.col("_new_hash"), F.lit(False))

    def version(side: str, valid_from, valid_to):  # noqa: ANN001, ANN202
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in columns],
            valid_from.alias("valid_from"),
            valid_to.cast("timestamp").alias("valid_to"),
        )

    since = F.col("_was.valid_from")
    versions = F.array(
        F.when(
            F.col("_was").isNotNull(),
            version("_was", since, F.when(~same, run)),
        ),
        F.when(F.col("_now").isNotNull() & ~same, version("_now", run, F.lit(None))),
    )
    left = pair.select(F.explode(versions).alias("v")).filter(F.col("v").isNotNull())
    return closed.select(*columns, "valid_from", "valid_to").unionByName(left.select("v.*"))


RUN = "closed_by"  # partition of the closed rows: digits of the run's time
LAST_RUN = "inkmeter.last_run"


def _run_number(run_ts: str) -> int:
    """The run's time as one number, so that later runs have larger ones."""
    digits = "".join(c for c in run_ts if c.isdigit())
    return int(digits.ljust(20, "0")[:18])


def _last_run(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}_open").collect()
    return int({r["key"]: r["value"] for r in rows}.get(LAST_RUN, 0))


def _root(spark: SparkSession, name: str) -> str:
    schema, table = name.split(".")
    return f"{spark.catalog.getDatabase(schema).locationUri}/{table}"


def _create_history(
    spark: SparkSession, name: str, current: DataFrame, key: str, buckets: int
) -> None:
    since = current.select("*", F.lit(None).cast("timestamp").alias("valid_from"))
    keyed.create_keyed(spark, f"{name}_open", since.schema, key, buckets)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in since.schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name}_closed ({fields}, valid_to timestamp, {RUN} bigint) "
        f"USING parquet PARTITIONED BY ({RUN}) LOCATION '{_root(spark, name)}_closed'"
    )


def read_history(spark: SparkSession, name: str) -> DataFrame:
    """Every version of every row: the open ones and those that completed runs closed."""
    now_open = keyed.read_keyed(spark, f"{name}_open")
    closed = spark.table(f"{name}_closed").where(F.col(RUN) <= _last_run(spark, name))
    return closed.drop(RUN).unionByName(
        now_open.withColumn("valid_to", F.lit(None).cast("timestamp"))
    )


def snapshot_table(
    spark: SparkSession,
    name: str,
    current: DataFrame,
    key: str,
    run_ts: str,
    buckets: int = keyed.BUCKETS,
) -> None:
    """Bring a kept history up to the current table, as ``snapshot`` would.

    The run's changes are written down first and then carried out: closed rows
    go to the run's own partition, the changed keys of the open rows are
    swapped, and the run is marked as done, which lets readers see its closed
    rows.  Each of these steps can be repeated, so a run that died is finished
    from its written changes, by itself or by the next one.  Runs come in order
    of time, repeating the last one does nothing; keys are unique and not null.
    """
    _create_history(spark, name, current, key, buckets)
    log = f"{_root(spark, name)}_changes"
    for found in _pending(spark, log):
        if found > _last_run(spark, name):
            _carry_out(spark, name, key, log, found)
    number, last = _run_number(run_ts), _last_run(spark, name)
    if number < last:
        raise ValueError(f"{name} already has run {last}, and {run_ts} is before it")
    if number == last:
        return
    was = keyed.read_keyed(spark, f"{name}_open").select(
        F.col(key).alias("_old_key"),
        fields_hash_null(current.columns).alias("_old_hash"),
        F.struct(*current.columns, "valid_from").alias("_was"),
    )
    now = current.select(
        F.col(key).alias("_new_key"),
        fields_hash_null(current.columns).alias("_new_hash"),
        F.struct(*current.columns).alias("_now"),
    )
    same = F.coalesce(F.col("_old_hash") == F.col("_new_hash"), F.lit(False))
    was.join(now, F.col("_old_key") == F.col("_new_key"), "full").where(~same).select(
        F.coalesce("_old_key", "_new_key").alias("_key"),
        "_was",
        "_now",
        F.lit(run_ts).cast("timestamp").alias("_run"),
    ).write.mode("overwrite").parquet(f"{log}/{number}")
    _carry_out(spark, name, key, log, number)


def _folder(spark: SparkSession, path: str):  # noqa: ANN202
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pending(spark: SparkSession, log: str) -> list[int]:
    """Runs whose changes are completely written down."""
    folder, files = _folder(spark, log)
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return sorted(int(n) for n in names if files.exists(_folder(spark, f"{log}/{n}/_SUCCESS")[0]))


def _carry_out(spark: SparkSession, name: str, key: str, log: str, number: int) -> None:
    changes = spark.read.parquet(f"{log}/{number}")
    columns = keyed.read_keyed(spark, f"{name}_open").columns
    place = f"{_root(spark, name)}_closed/{RUN}={number}"
    changes.where("_was IS NOT NULL").select("_was.*", F.col("_run").alias("valid_to")).select(
        *columns, "valid_to"
    ).write.mode("overwrite").parquet(place)
    spark.sql(
        f"ALTER TABLE {name}_closed ADD IF NOT EXISTS PARTITION ({RUN}={number}) LOCATION '{place}'"
    )
    spark.catalog.refreshTable(f"{name}_closed")
    opened = changes.where("_now IS NOT NULL").select("_now.*", F.col("_run").alias("valid_from"))
    keyed.replace_keys(spark, f"{name}_open", opened, changes.select("_key"), "_key")
    spark.sql(f"ALTER TABLE {name}_open SET TBLPROPERTIES ('{LAST_RUN}'='{number}')")
    folder, files = _folder(spark, f"{log}/{number}")
    files.delete(folder, True)


def fields_hash_null(columns: list[str]):  # noqa: ANN201
    """Hash that tells a null from an empty value."""
    marks = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in columns])
    return F.concat(fields_hash(columns), F.lit(":"), marks)


def run_log(spark: SparkSession, invocation_id: str, started_at: str, command: str, results: list):
    """Log rows of one run; ``results`` holds (node, type, status, seconds)."""
    rows = [
        (invocation_id, command, node, kind, status, round(float(seconds or 0), 3))
        for node, kind, status, seconds in results
    ]
    logged = spark.createDataFrame(
        rows,
        "invocation_id string, command string, node string, resource_type string, "
        "status string, execution_time double",
    )
    return logged.select(
        "invocation_id",
        F.lit(started_at).cast("timestamp").alias("run_started_at"),
        "command",
        "node",
        "resource_type",
        "status",
        "execution_time",
    )
