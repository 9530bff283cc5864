"""The nightly text ingest as a bounded stream over the landing folder.

The file source remembers which files a run has seen, so a run reads only what
landed since the last one.  Files are hashed and judged where they are read:
what leaves a task is an id, a hash and a status, never the content.  Each
micro-batch writes its outcomes to a folder of its own in the outcome log, so a
batch that is retried overwrites what it wrote before.  When the stream has
ended, the log is merged into the ledger once: the last outcome of a key wins,
and a ledger laid out by key rewrites the buckets of those keys only.  An
outcome carries the time of its run, so merging a log again after a failure
leaves the same ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmeter.functions.catalog import has_marker
from inkmeter.functions.keys import content_hash
from inkmeter.operators import cdc
from inkmeter.sources import keyed
from inkmeter.sources.corpus import file_stem
from inkmeter.sources.tables import read_table, write_table

LANDED_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
OUTCOME_SCHEMA = (
    "catalog_id bigint, catalog_row_hash string, text_hash string, status string, "
    "run_ts timestamp"
)


def landed_outcomes(files: DataFrame, works: DataFrame) -> DataFrame:
    """Ledger rows for landed files: hashed when usable, marked when not."""
    status = cdc.outcome(F.col("content"), has_marker(F.col("content")))
    judged = (
        files.filter(file_stem(F.col("path")).rlike(r"^[0-9]+\z"))
        .select(
            file_stem(F.col("path")).cast("bigint").alias("catalog_id"),
            F.when(status == "ingested", content_hash(F.col("content"))).alias("text_hash"),
            status.alias("status"),
        )
    )
    return judged.join(works.select("catalog_id", "catalog_row_hash"), "catalog_id").select(
        "catalog_id", "catalog_row_hash", "text_hash", "status"
    )


def log_outcomes(outcomes: DataFrame, log: str, batch: int, run_ts: str) -> None:
    """Write a micro-batch's outcomes to its own folder, replacing what a retry finds there."""
    outcomes.withColumn("run_ts", F.lit(run_ts).cast("timestamp")).write.mode("overwrite").parquet(
        f"{log}/batch={batch}"
    )


def _log_folder(spark: SparkSession, log: str):  # noqa: ANN202
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(log)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def merge_log(spark: SparkSession, log: str, ledger: str) -> None:
    """Merge every logged batch into the ledger, then clear the log.

    Only the keys in the log are read and written where the ledger is laid out
    by key.  A work's first sighting stays; its last change is the run that saw it.
    """
    path, files = _log_folder(spark, log)
    if not files.exists(path) or not len(files.listStatus(path)):
        return
    logged = spark.read.schema(f"{OUTCOME_SCHEMA}, batch bigint").parquet(log)
    fields = ["catalog_row_hash", "text_hash", "status", "run_ts"]
    latest = (
        logged.groupBy("catalog_id")
        .agg(
            F.max_by(
                F.struct(*fields),
                # of two outcomes in one batch the larger hash, whichever task saw it first
                F.struct("batch", "run_ts", "status", F.coalesce("text_hash", F.lit(""))),
            ).alias("o")
        )
        .select("catalog_id", "o.*")
    )
    if keyed.layout_of(spark, ledger) is None:
        seen = read_table(spark, ledger)
        write_table(
            seen.join(latest, "catalog_id", "left_anti").unionByName(_entries(latest, seen)), ledger
        )
    else:
        seen = keyed.rows_of(spark, ledger, latest, "catalog_id")
        keyed.replace_keys(spark, ledger, _entries(latest, seen), latest, "catalog_id")
    files.delete(path, True)


def _entries(latest: DataFrame, seen: DataFrame) -> DataFrame:
    """Ledger rows of the latest outcomes."""
    first = seen.select("catalog_id", "first_seen")
    return latest.join(first, "catalog_id", "left").select(
        "catalog_id",
        "catalog_row_hash",
        "text_hash",
        F.coalesce("first_seen", "run_ts").alias("first_seen"),
        F.col("run_ts").alias("last_changed"),
        "status",
    )


def ingest_landed(
    spark: SparkSession,
    folder: str,
    works: DataFrame,
    ledger: str,
    checkpoint: str,
    run_ts: str,
    log: str | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Ingest every file landed since the last run into the ledger table, then stop.

    Files are remembered by their path, so a text that is fetched again has to
    land in another folder below the landing folder, such as one a run.
    ``log`` is the folder of the outcome log, beside the checkpoint unless
    given.  ``files_per_batch`` bounds a micro-batch; without it a run is one.
    """
    log = log or f"{checkpoint.rstrip('/')}-outcomes"
    merge_log(spark, log, ledger)  # what a run that died has left

    def append(batch: DataFrame, number: int) -> None:
        log_outcomes(landed_outcomes(batch, works), log, number, run_ts)

    reader = spark.readStream.format("binaryFile").schema(LANDED_SCHEMA)
    reader = reader.option("pathGlobFilter", "*.txt")
    reader = reader.option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.load(folder)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    merge_log(spark, log, ledger)
