"""Change data capture against a ledger of what was seen.

The ledger has one row per work: (catalog_id, catalog_row_hash, text_hash,
first_seen, last_changed, status).  Its key is unique, so every join here is
one-to-one and cannot skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmeter import fixed_values as fixed

LEDGER_SCHEMA = (
    "catalog_id bigint, catalog_row_hash string, text_hash string, "
    "first_seen timestamp, last_changed timestamp, status string"
)
AUDIT_SCHEMA = (
    "run_ts timestamp, run_type string, books_in_catalog bigint, candidate_new bigint, "
    "candidate_changed bigint, downloaded bigint, failed bigint"
)


def _compared(works: DataFrame, ledger: DataFrame) -> DataFrame:
    seen = ledger.select(
        "catalog_id", F.col("catalog_row_hash").alias("seen_hash"), "status"
    )
    return works.select("catalog_id", "catalog_row_hash").join(seen, "catalog_id", "left")


def _is_new() -> Column:
    return F.col("seen_hash").isNull()


def _is_changed() -> Column:
    return F.coalesce(F.col("seen_hash") != F.col("catalog_row_hash"), F.lit(False))


def diff_counts(works: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row: works in the roster, new ones and changed ones (the run's gate)."""
    return _compared(works, ledger).agg(
        F.count(F.lit(1)).alias("roster_size"),
        F.count_if(_is_new()).alias("candidate_new"),
        F.count_if(_is_changed()).alias("candidate_changed"),
    )


def backlog(works: DataFrame, ledger: DataFrame) -> DataFrame:
    """New, changed or previously failed works, with the hash last seen."""
    return _compared(works, ledger).filter(
        _is_new() | _is_changed() | F.coalesce(F.col("status") == "failed", F.lit(False))
    )


def next_batch(pending: DataFrame, cap: int = fixed.BATCH_CAP) -> DataFrame:
    """The first ``cap`` works by id; the rest waits for the next run."""
    return pending.orderBy("catalog_id").limit(cap)


def outcome(content: Column, has_marker: Column) -> Column:
    """Status of a fetched text: failed, copyrighted or ingested."""
    return (
        F.when(content.isNull(), "failed").when(has_marker, "copyrighted").otherwise("ingested")
    )


def upsert_ledger(ledger: DataFrame, processed: DataFrame, run_ts: str) -> DataFrame:
    """Carry untouched rows; processed ones keep first_seen and are stamped.

    One full join does both halves of the merge.
    """
    run = F.lit(run_ts).cast("timestamp")
    old = ledger.withColumn("_old", F.lit(True)).alias("l")
    new = processed.withColumn("_new", F.lit(True)).alias("p")
    hit = F.col("p._new").isNotNull()

    def taken(name: str) -> Column:
        return F.when(hit, F.col(f"p.{name}")).otherwise(F.col(f"l.{name}")).alias(name)

    return old.join(new, F.col("l.catalog_id") == F.col("p.catalog_id"), "full").select(
        F.coalesce("p.catalog_id", "l.catalog_id").alias("catalog_id"),
        taken("catalog_row_hash"),
        taken("text_hash"),
        F.when(hit, F.coalesce(F.col("l.first_seen"), run))
        .otherwise(F.col("l.first_seen"))
        .alias("first_seen"),
        F.when(hit, run).otherwise(F.col("l.last_changed")).alias("last_changed"),
        taken("status"),
    )


def status_counts(processed: DataFrame) -> DataFrame:
    return processed.groupBy("status").agg(F.count(F.lit(1)).alias("works"))


def ingest_audit(
    run_ts: str, run_type: str, counts: DataFrame, processed: DataFrame
) -> DataFrame:
    """One audit row from a diff's counts and a run's outcomes (one row each)."""

    done = processed.agg(
        F.count_if(F.col("status") == "ingested").alias("downloaded"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    ).withColumn("_run", F.lit(run_ts))
    counts = counts.withColumn("_run", F.lit(run_ts)).join(done, "_run")
    return counts.select(
        F.lit(run_ts).cast("timestamp").alias("run_ts"),
        F.lit(run_type).alias("run_type"),
        F.col("roster_size").alias("books_in_catalog"),
        "candidate_new",
        "candidate_changed",
        "downloaded",
        "failed",
    )


# --- Which works to measure again -------------------------------------------


def measured_at(measurements: DataFrame) -> DataFrame:
    return measurements.groupBy("work_id").agg(F.max("loaded_at").alias("measured_at"))


def needs_measure(
    corpus: DataFrame, measurements: DataFrame, ledger: DataFrame, manifest: DataFrame
) -> DataFrame:
    """Corpus works never measured, or changed since.

    A catalog work changes when the ledger says so, a manual one when its
    manifest stamp moves.  ``corpus`` has (work_id, is_self).
    """
    changed = ledger.select(
        F.col("catalog_id").cast("string").alias("work_id"),
        F.lit(0).alias("is_self"),
        F.col("last_changed").alias("changed_at"),
    ).unionByName(
        manifest.select("work_id", F.lit(1).alias("is_self"), F.col("loaded_at").alias("changed_at"))
    )
    return (
        corpus.select("work_id", "is_self")
        .join(measured_at(measurements), "work_id", "left")
        .join(changed, ["work_id", "is_self"], "left")
        .filter(F.col("measured_at").isNull() | (F.col("changed_at") > F.col("measured_at")))
        .select("work_id", "is_self")
    )


def stale_works(measurements: DataFrame, corpus: DataFrame) -> DataFrame:
    """Measured works that left the corpus."""
    return (
        measurements.select("work_id")
        .distinct()
        .join(corpus.select("work_id"), "work_id", "left_anti")
    )
