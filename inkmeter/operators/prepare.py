"""Raw text files to clean markdown, as one narrow DataFrame pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmeter.functions import prose
from inkmeter.functions.catalog import display_author, display_title
from inkmeter.functions.strings import text


def to_markdown(files: DataFrame, content: str = "content") -> DataFrame:
    """(work_id, content bytes, title, authors) -> (work_id, status, author, markdown).

    ``status`` says which marker a failed text lacks; its markdown is null.
    Each step is its own projection because the next one reads it repeatedly.
    """
    decoded = files.withColumn(
        "_text", prose.unix_newlines(prose.decode_text(F.col(content)))
    ).withColumn("author", display_author("authors"))
    bodied = (
        decoded.withColumn("_rest", prose.after_start(F.col("_text")))
        .withColumn("_body", prose.before_end(F.col("_rest")))
        .withColumn(
            "status",
            F.when(F.col("_rest").isNull(), "no start marker")
            .when(F.col("_body").isNull(), "no end marker")
            .otherwise("ok"),
        )
    )
    return (
        blocks_to_body(
            bodied.withColumn("_blocks", prose.split_blocks(prose.strip_notes(F.col("_body"))))
        )
        .withColumn("_body", prose.curl_dialogue(F.col("_body")))
        .withColumn(
            "markdown",
            prose.rewrite_emphasis(
                F.concat(
                    F.lit("# "),
                    display_title("title"),
                    F.lit("\n\n*"),
                    F.col("author"),
                    F.lit("*\n\n---\n\n"),
                    F.col("_body"),
                )
            ),
        )
        .select("work_id", "status", "author", "markdown")
    )


def blocks_to_body(df: DataFrame) -> DataFrame:
    """Drop contents, front matter and tail from ``_blocks``; render ``_body``."""
    return (
        df.withColumn("_blocks", prose.drop_contents(F.col("_blocks")))
        .withColumn(
            "_blocks", prose.drop_front_matter(F.col("_blocks"), text("title"), F.col("author"))
        )
        .withColumn("_blocks", prose.drop_tail(F.col("_blocks")))
        .withColumn("_described", prose.describe_blocks(F.col("_blocks")))
        .withColumn("_body", prose.render_described(F.col("_described")))
    )


def strip_outcomes(roster: DataFrame, prepared: DataFrame, run_ts: str) -> DataFrame:
    """One audit row: how many roster works were stripped, failed, had no text."""
    outcome = roster.select("work_id").join(
        prepared.select("work_id", "status"), "work_id", "left"
    )
    status = F.col("status")
    return outcome.agg(
        F.count(F.lit(1)).alias("roster_size"),
        F.count_if(status == "ok").alias("stripped"),
        F.count_if(status.isNotNull() & (status != "ok")).alias("failed"),
        F.count_if(status.isNull()).alias("missing_text"),
    ).select(F.lit(run_ts).cast("timestamp").alias("run_ts"), "*")
