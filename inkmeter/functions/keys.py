"""Hashes and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How a key spells a missing part, and the two separators
NULL_PART = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
FIELD_SEPARATOR = "\u001f"


def surrogate_key(*parts: Column | str) -> Column:
    """md5 over the parts as text; stable across runs and engines."""
    texts = [
        F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit(NULL_PART))
        for p in parts
    ]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts))


def fields_hash(columns: list[str]) -> Column:
    """sha256 over the given text columns in order; a null counts as empty."""
    return F.sha2(
        F.concat_ws(
            FIELD_SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
        ),
        256,
    )


def row_hash(df: DataFrame, id_column: str) -> Column:
    """sha256 over every column but the id."""
    return fields_hash([c for c in df.columns if c != id_column])


def content_hash(content: Column | str) -> Column:
    """sha256 of raw bytes (or of a string's UTF-8 bytes)."""
    return F.sha2(content, 256)
