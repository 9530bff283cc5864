"""The whole build, from raw tables to marts, over written tables."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame

from inkmeter.plans import marts, staging, star
from inkmeter.sources.tables import stage_table


@dataclass(frozen=True)
class Warehouse:
    """The dimensions, facts and marts reports read."""

    dim_date: DataFrame
    dim_metric: DataFrame
    dim_author: DataFrame
    dim_work: DataFrame
    fact_style_measurement: DataFrame
    author_vocabulary: DataFrame
    fact_vocab_overlap: DataFrame
    mart_style_long: DataFrame
    mart_work: DataFrame
    mart_author: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def build(
    raw_works: DataFrame,
    manual_works: DataFrame,
    raw_measurements: DataFrame,
    raw_vocab: DataFrame,
    concepts: DataFrame,
    folder: str,
) -> Warehouse:
    """Dimensions, facts and marts, each written below ``folder``, which all executors share.

    Written tables are what the next step reads: lineage stays one step long
    and a lost executor replays one step.
    """

    def keep(df: DataFrame, name: str) -> DataFrame:
        return stage_table(df, f"{folder}/{name}")

    works = staging.stg_works(raw_works)
    measurements = staging.stg_measurements(raw_measurements)
    vocab = staging.stg_vocab(raw_vocab)

    dim_metric = keep(star.dim_metric(concepts), "dim_metric")
    dim_author = keep(star.dim_author(works, manual_works), "dim_author")
    dim_work = keep(star.dim_work(works, manual_works, measurements), "dim_work")
    fact_style = keep(
        star.fact_style_measurement(
            star.normalized_measurements(measurements, dim_metric), dim_work
        ),
        "fact_style_measurement",
    )
    terms = keep(star.author_vocabulary(vocab, dim_work, dim_author), "author_vocabulary")
    fact_overlap = keep(
        star.fact_vocab_overlap(star.vocab_jaccard(terms), dim_author), "fact_vocab_overlap"
    )
    style = keep(
        marts.mart_style_long(fact_style, dim_work, dim_author, dim_metric), "mart_style_long"
    )
    mart_work = keep(marts.mart_work(dim_work, dim_author, style), "mart_work")
    return Warehouse(
        dim_date=keep(star.dim_date(concepts.sparkSession), "dim_date"),
        dim_metric=dim_metric,
        dim_author=dim_author,
        dim_work=dim_work,
        fact_style_measurement=fact_style,
        author_vocabulary=terms,
        fact_vocab_overlap=fact_overlap,
        mart_style_long=style,
        mart_work=mart_work,
        mart_author=keep(marts.mart_author(mart_work, dim_author), "mart_author"),
    )
