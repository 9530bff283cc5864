"""The nightly run over kept tables: refresh the catalog, ingest texts, measure.

Every table is laid out by its key, and each step works out which keys differ
before it writes, so a night on which nothing changed rewrites no data file.
Steps can be repeated: rows are replaced by key, and a run has one audit row for
each of its two kinds, found by the run's time and kind.  A run that died is
repeated with the same time and leaves what one whole run would have left.

Ids of the catalog and of the corpus are unique and not null.  A row's stamps
are those of the run that last changed it.  An empty catalog or corpus empties
the tables that follow it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmeter.operators import cdc, metrics, scope, tokens
from inkmeter.sources import keyed, tables
from inkmeter.streaming.landing import ingest_landed

MEASUREMENTS_SCHEMA = "work_id string, metric string, value double, loaded_at timestamp"
VOCABULARY_SCHEMA = "work_id string, term string, term_count bigint, loaded_at timestamp"


@dataclass(frozen=True)
class Tables:
    """Names of the tables a run keeps, below one schema."""

    schema: str

    @property
    def catalog(self) -> str:
        return f"{self.schema}.catalog"

    @property
    def roster(self) -> str:
        return f"{self.schema}.raw_works"

    @property
    def ledger(self) -> str:
        return f"{self.schema}.watermark"

    @property
    def audit(self) -> str:
        return f"{self.schema}.ingest_audit"

    @property
    def measurements(self) -> str:
        return f"{self.schema}.raw_measurements"

    @property
    def vocabulary(self) -> str:
        return f"{self.schema}.raw_vocab"


def create_tables(
    spark: SparkSession, names: Tables, feed: DataFrame, buckets: int = keyed.BUCKETS
) -> None:
    """The tables that are not there yet; ``feed`` tells the catalog's columns."""
    in_scope = scope.roster(feed)
    for name, schema, key in (
        (names.catalog, feed.schema, "catalog_id"),
        (names.roster, in_scope.schema, "catalog_id"),
        (names.ledger, cdc.LEDGER_SCHEMA, "catalog_id"),
        (names.measurements, MEASUREMENTS_SCHEMA, "work_id"),
        (names.vocabulary, VOCABULARY_SCHEMA, "work_id"),
    ):
        keyed.create_keyed(spark, name, schema, key, buckets)
    keyed.create_keyed(spark, names.audit, f"audit_key string, {cdc.AUDIT_SCHEMA}", "audit_key", 1)


def sync_changed(
    spark: SparkSession, name: str, rows: DataFrame, folder: str, hash_name: str = "catalog_row_hash"
) -> None:
    """Make a keyed table hold these rows, writing only keys that are new, changed or gone.

    ``folder`` holds the differing keys while their buckets are replaced.
    """
    key = keyed.layout_of(spark, name).key
    stored = keyed.read_keyed(spark, name, [key, hash_name]).withColumnRenamed(hash_name, "_stored")
    differing = tables.stage_table(
        rows.select(key, F.col(hash_name).alias("_given"))
        .join(stored, key, "full")
        .where(~F.col("_given").eqNullSafe(F.col("_stored")))
        .select(key),
        folder,
    )
    keyed.replace_keys(spark, name, rows.join(differing, key, "left_semi"), differing, key)


def write_audit(spark: SparkSession, names: Tables, row: DataFrame) -> None:
    """Put one audit row in the place of the one its run and kind has."""
    keyed_row = row.withColumn(
        "audit_key", F.concat_ws("|", F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "run_type")
    )
    # Counted once: replacing by key reads the one row several times
    keyed_row = spark.createDataFrame(keyed_row.toArrow(), keyed_row.schema)
    keyed.replace_keys(spark, names.audit, keyed_row, keyed_row, "audit_key")


def catalog_audit(run_ts: str, catalog: DataFrame, counts: DataFrame) -> DataFrame:
    """Audit row of a catalog refresh: all rows of the feed, and what is new or changed in scope."""
    size = catalog.agg(F.count(F.lit(1)).alias("books_in_catalog")).withColumn("_run", F.lit(run_ts))
    return size.join(counts.withColumn("_run", F.lit(run_ts)), "_run").select(
        F.lit(run_ts).cast("timestamp").alias("run_ts"),
        F.lit("catalog_refresh").alias("run_type"),
        "books_in_catalog",
        "candidate_new",
        "candidate_changed",
        F.lit(0).cast("bigint").alias("downloaded"),
        F.lit(0).cast("bigint").alias("failed"),
    )


def refresh_catalog(
    spark: SparkSession, names: Tables, feed: DataFrame, run_ts: str, folder: str
) -> None:
    """Bring catalog and roster up to a stamped feed and count what is new against the ledger.

    A repeated run keeps the counts it has, as the ledger may have moved since.
    """
    # Written once: finding what differs and replacing it read all rows, and again their buckets
    feed = tables.stage_table(feed, f"{folder}/feed")
    in_scope = tables.stage_table(scope.roster(feed), f"{folder}/in_scope")
    sync_changed(spark, names.catalog, feed, f"{folder}/catalog")
    sync_changed(spark, names.roster, in_scope, f"{folder}/roster")
    if _audited(spark, names, run_ts, "catalog_refresh").isEmpty():
        counts = cdc.diff_counts(
            keyed.read_keyed(spark, names.roster), keyed.read_keyed(spark, names.ledger)
        )
        write_audit(spark, names, catalog_audit(run_ts, feed, counts))


def _audited(spark: SparkSession, names: Tables, run_ts: str, run_type: str) -> DataFrame:
    rows = keyed.read_keyed(spark, names.audit)
    return rows.where(
        (F.col("run_ts") == F.lit(run_ts).cast("timestamp")) & (F.col("run_type") == run_type)
    )


def ingest_texts(
    spark: SparkSession, names: Tables, landing: str, checkpoint: str, run_ts: str
) -> None:
    """Ingest what landed for the roster and audit it.

    What is new or changed is counted and written before the ingest; a repeated
    run keeps those counts, because by then the ledger holds the run's outcomes.
    """
    works = keyed.read_keyed(spark, names.roster)
    if _audited(spark, names, run_ts, "text_ingest").isEmpty():
        counts = cdc.diff_counts(works, keyed.read_keyed(spark, names.ledger))
        none = keyed.read_keyed(spark, names.ledger, ["status"]).limit(0)
        write_audit(spark, names, cdc.ingest_audit(run_ts, "text_ingest", counts, none))
    ingest_landed(spark, landing, works, names.ledger, checkpoint, run_ts)
    outcomes = keyed.read_keyed(spark, names.ledger).where(
        F.col("last_changed") == F.lit(run_ts).cast("timestamp")
    )
    before = _audited(spark, names, run_ts, "text_ingest").select(
        F.col("books_in_catalog").alias("roster_size"), "candidate_new", "candidate_changed"
    )
    write_audit(spark, names, cdc.ingest_audit(run_ts, "text_ingest", before, outcomes))


def prepare_and_measure(
    spark: SparkSession,
    names: Tables,
    corpus: DataFrame,
    manifest: DataFrame,
    run_ts: str,
    folder: str,
    registry: metrics.Registry | None = None,
) -> None:
    """Measure the works that were never measured or changed since; drop those that left.

    ``corpus`` has (work_id, is_self, text).  Which works to measure is written
    down first, because the tables that tell it are the ones that change.  The
    vocabulary is written before the measurements that mark a work as measured,
    so that a run which dies between them measures its works again.
    """
    measured = keyed.read_keyed(spark, names.measurements)
    ledger = keyed.read_keyed(spark, names.ledger)
    todo = tables.stage_table(
        cdc.needs_measure(corpus, measured, ledger, manifest), f"{folder}/todo"
    )
    stale = tables.stage_table(cdc.stale_works(measured, corpus), f"{folder}/stale")
    run = F.lit(run_ts).cast("timestamp")
    docs = corpus.join(todo, ["work_id", "is_self"], "left_semi").select("work_id", "text")
    # A text is tokenised once, for its series and its terms alike
    units = tables.stage_table(metrics.summed_text(docs, registry), f"{folder}/units")
    view = tokens.spelt_view(units)
    # Written once: replacing by key reads its rows for their buckets and to write them
    wide = tables.stage_table(metrics.measure_wide(view, registry), f"{folder}/wide")
    terms = metrics.word_counts(view).select(
        "work_id",
        F.col("word").alias("term"),
        F.col("n").cast("bigint").alias("term_count"),
        run.alias("loaded_at"),
    )
    tables.sync_table(spark, names.vocabulary, terms, todo, stale)
    tables.sync_table(spark, names.measurements, metrics.to_long(wide, run), todo, stale)


def nightly_run(
    spark: SparkSession,
    names: Tables,
    feed: DataFrame,
    corpus: DataFrame,
    manifest: DataFrame,
    run_ts: str,
    folder: str,
    landing: str | None = None,
    checkpoint: str | None = None,
) -> None:
    """One night: catalog, texts where a landing folder is named, measurements."""
    create_tables(spark, names, feed)
    refresh_catalog(spark, names, feed, run_ts, folder)
    if landing is not None:
        ingest_texts(spark, names, landing, checkpoint or f"{folder}/checkpoint", run_ts)
    prepare_and_measure(spark, names, corpus, manifest, run_ts, folder)
