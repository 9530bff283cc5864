"""The data checks that the staging, star and mart tables declare."""

from __future__ import annotations

from inkmeter import fixed_values as fixed
from inkmeter.operators.declared import (
    Check,
    accepted,
    in_range,
    key,
    not_null,
    related,
    unique,
    unique_together,
)

DECLARED: dict[str, list[Check]] = {
    "stg_works": [
        *key("catalog_id"),
        *not_null("title", "author_name", "genre", "is_translation", "is_juvenile", "is_play", "is_poetry"),
        accepted("genre", fixed.GENRES),
    ],
    "int_measurements": related("metric_key", "dim_metric"),
    "int_vocab_jaccard": [
        unique("author_key"),
        *related("author_key", "dim_author"),
        *not_null("loaded_at"),
        in_range("jaccard", 0, 1),
    ],
    "dim_metric": key("metric_key"),
    "dim_date": key("date_key", "date_day"),
    "dim_author": key("author_key"),
    "dim_work": [
        *key("work_key"),
        *not_null("ingested_at", "word_count", "genre", "prose_type"),
        *related("author_key", "dim_author"),
    ],
    "fact_style_measurement": [
        *key("measurement_key"),
        *related("work_key", "dim_work"),
        *related("author_key", "dim_author"),
        *related("metric_key", "dim_metric"),
        *related("loaded_date_key", "dim_date", "date_key"),
    ],
    "fact_vocab_overlap": [
        *key("overlap_key"),
        *related("author_key_a", "dim_author", "author_key"),
        unique("author_key_b"),
        *related("author_key_b", "dim_author", "author_key"),
        in_range("jaccard", 0, 1),
        *related("loaded_date_key", "dim_date", "date_key"),
    ],
    "mart_work": [
        *key("work_key"),
        *related("author_key", "dim_author"),
        *not_null("excess", "series_measured"),
    ],
    "mart_author": [unique("author_key"), *related("author_key", "dim_author"), *not_null("works")],
    "mart_style_long": [
        unique_together("work_key", "metric_name"),
        *related("work_key", "dim_work"),
        *related("author_key", "dim_author"),
        *related("metric_key", "dim_metric"),
        *not_null("value", "loaded_date"),
    ],
}
