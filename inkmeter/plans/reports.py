"""Report queries over the marts.

An author or work given as an argument is bound as a literal, so the filter
reaches the parquet scan; left out, the same report is computed for every
author or work at once.  Ties are broken by name or id, so every report is
deterministic.  ``RANK_DIGITS`` keeps the last float digits, which depend on
summation order, from deciding a rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmeter.plans.warehouse import Warehouse

RANK_DIGITS = 6
FLAGS = {
    "Juvenile": "is_juvenile",
    "Play": "is_play",
    "Poetry": "is_poetry",
    "Translation": "is_translation",
}


def _rank(value: Column) -> Column:
    return F.round(value, RANK_DIGITS)


def _only(df: DataFrame, column: str, value: str | None) -> DataFrame:
    return df if value is None else df.filter(F.col(column) == F.lit(value))


def _yes_no(flag: str) -> Column:
    return F.when(F.col(flag) == 1, "Yes").otherwise("No")


# --- Front page --------------------------------------------------------------


def last_refreshed(wh: Warehouse) -> DataFrame:
    return wh.mart_work.agg(
        F.max("ingested_at").alias("refreshed"), F.count("work_id").alias("work_count")
    )


def outliers(wh: Warehouse, min_words: int = 10_000, top: int = 25) -> DataFrame:
    """Most distinctive prose fiction."""
    return (
        wh.mart_work.filter(
            (F.col("is_play") == 0)
            & (F.col("is_translation") == 0)
            & (F.col("is_juvenile") == 0)
            & (F.col("is_poetry") == 0)
            & (F.col("word_count") >= min_words)
        )
        .orderBy(_rank(F.col("excess")).desc_nulls_last(), "work_id")
        .limit(top)
        .select("title", "author", "genre", "word_count", "excess", work_link())
    )


def kinship(wh: Warehouse, top: int = 25) -> DataFrame:
    """Authors whose vocabulary overlaps most with the self author's."""
    names = wh.dim_author.select("author_key", F.col("name").alias("author"))
    return (
        wh.fact_vocab_overlap.join(names, F.col("author_key_b") == F.col("author_key"))
        .select("author", "jaccard")
        .orderBy(_rank(F.col("jaccard")).desc_nulls_last(), "author")
        .limit(top)
    )


def work_link() -> Column:
    return F.concat(F.lit("/works/"), F.col("work_id")).alias("link")


# --- Authors -------------------------------------------------------------------


def authors_list(wh: Warehouse) -> DataFrame:
    return wh.mart_author.select(
        F.col("author").alias("name"),
        "works",
        F.col("total_words").alias("words"),
        F.concat(F.lit("/authors/"), F.col("author")).alias("link"),
    ).orderBy(F.desc("works"), "name")


def author_summary(wh: Warehouse, author: str | None = None) -> DataFrame:
    return _only(wh.mart_author, "author", author).select("author", "works", "total_words")


def author_distinctive(wh: Warehouse, author: str | None = None) -> DataFrame:
    """Mean z-score per single-valued metric, strongest first."""
    return (
        _only(wh.mart_style_long, "author", author)
        .filter(~F.col("is_multivalue"))
        .groupBy("author", "display_name")
        .agg(F.avg("zscore").alias("zscore"))
        .orderBy("author", F.abs(_rank(F.col("zscore"))).desc_nulls_last(), "display_name")
    )


def _author_series(
    wh: Warehouse, concept: str, measure: str, author: str | None, label: str, value: str
) -> DataFrame:
    return (
        _only(wh.mart_style_long, "author", author)
        .filter(F.col("concept_name") == concept)
        .groupBy("author", F.col("series_label").alias(label))
        .agg(F.avg(F.col(measure).cast("double")).alias(value))
    )


def author_sentence_types(wh: Warehouse, author: str | None = None) -> DataFrame:
    return _author_series(
        wh, "sentence_type_mix", "value", author, "sentence_type", "proportion"
    ).orderBy("author", _rank(F.col("proportion")).desc_nulls_last(), "sentence_type")


def author_punctuation(wh: Warehouse, author: str | None = None) -> DataFrame:
    return _author_series(
        wh, "punctuation_frequency", "zscore", author, "mark", "zscore"
    ).orderBy("author", _rank(F.col("zscore")).desc_nulls_last(), "mark")


def author_function_words(
    wh: Warehouse, author: str | None = None, top: int = 12
) -> DataFrame:
    """The most unusual function-word rates of each author.

    Averages first: the ranking sorts at most one row per author and word.
    """
    means = _author_series(wh, "function_word_frequency", "zscore", author, "word", "zscore")
    return _top_by_size(means, "author", "zscore", "word", top)


def _top_by_size(df: DataFrame, group: str, value: str, tie: str, top: int) -> DataFrame:
    size = F.abs(_rank(F.col(value))).desc_nulls_last()
    order = Window.partitionBy(group).orderBy(size, tie)
    return (
        df.withColumn("_place", F.row_number().over(order))
        .filter(F.col("_place") <= top)
        .drop("_place")
        .orderBy(group, size, tie)
    )


def author_works(wh: Warehouse, author: str | None = None) -> DataFrame:
    return (
        _only(wh.mart_work, "author", author)
        .orderBy("author", F.desc_nulls_last("word_count"), "work_id")
        .select("author", "title", "prose_type", "genre", "word_count", work_link())
    )


def metric_defs(wh: Warehouse) -> DataFrame:
    """Definitions of the single-valued metrics."""
    return (
        wh.dim_metric.filter(~F.col("is_multivalue") & (F.col("metric_name") != "jaccard"))
        .select("display_name", "description")
        .orderBy("display_name")
    )


# --- Works ----------------------------------------------------------------------


def _with_sentinel(values: DataFrame, sentinel: str) -> DataFrame:
    first = values.sparkSession.range(1).select(
        F.lit(sentinel).alias("name"), F.lit(0).alias("ord")
    )
    rest = values.select("name", F.lit(1).alias("ord"))
    return first.unionByName(rest).orderBy("ord", "name").select("name")


def author_list(wh: Warehouse) -> DataFrame:
    return _with_sentinel(wh.mart_author.select(F.col("author").alias("name")), "All authors")


def genre_list(wh: Warehouse) -> DataFrame:
    return _with_sentinel(
        wh.mart_work.select(F.col("genre").alias("name")).distinct(), "All genres"
    )


def _selected(
    wh: Warehouse, author: str | None, genre: str | None, title_search: str
) -> DataFrame:
    works = _only(_only(wh.mart_work, "author", author), "genre", genre)
    return works.filter(F.col("title").ilike(f"%{title_search}%"))


def flag_options(
    wh: Warehouse,
    author: str | None = None,
    genre: str | None = None,
    title_search: str = "",
) -> DataFrame:
    """Yes/No flags of the selected works."""
    return _selected(wh, author, genre, title_search).select(
        *[_yes_no(flag).alias(name.lower()) for name, flag in FLAGS.items()]
    )


def flag_grid(
    wh: Warehouse,
    author: str | None = None,
    genre: str | None = None,
    title_search: str = "",
) -> DataFrame:
    """Works per value of each flag, in one grouping-sets pass."""
    names = [name.lower() for name in FLAGS]
    options = flag_options(wh, author, genre, title_search)
    counted = options.groupingSets([[n] for n in names], *names).agg(
        F.count(F.lit(1)).alias("works"),
        *[F.grouping(n).alias(f"_{n}") for n in names],
    )
    flag = F.coalesce(*[F.when(F.col(f"_{n}") == 0, F.lit(n)) for n in names])
    return counted.select(
        flag.alias("flag"), F.coalesce(*names).alias("answer"), "works"
    ).orderBy("flag", "answer")


def works_list(
    wh: Warehouse,
    author: str | None = None,
    genre: str | None = None,
    title_search: str = "",
    flags: dict[str, str] | None = None,
) -> DataFrame:
    """Selected works, largest first; ``flags`` maps a flag to 'Yes' or 'No'."""
    answers = {name.lower(): _yes_no(flag) for name, flag in FLAGS.items()}
    works = _selected(wh, author, genre, title_search)
    for name, answer in (flags or {}).items():
        works = works.filter(answers[name] == answer)
    set_flags = F.concat_ws(
        ", ", *[F.when(F.col(flag) == 1, F.lit(name)) for name, flag in FLAGS.items()]
    )
    return works.orderBy(F.desc_nulls_last("word_count"), "work_id").select(
        "title",
        "author",
        "genre",
        "word_count",
        *[answer.alias(name) for name, answer in answers.items()],
        set_flags.alias("flags"),
        work_link(),
    )


def work_header(wh: Warehouse, work_id: str | None = None, source_base: str = "") -> DataFrame:
    """Title block; manual works have no link to a source."""
    return _only(wh.mart_work, "work_id", work_id).select(
        "work_id",
        "title",
        "author",
        "genre",
        "prose_type",
        "word_count",
        F.concat(F.lit("/authors/"), F.col("author")).alias("author_link"),
        F.when(F.col("is_self") != 1, F.concat(F.lit(source_base), F.col("work_id"))).alias(
            "work_link"
        ),
    )


def deviation(wh: Warehouse, work_id: str | None = None) -> DataFrame:
    """A work's z-score minus its author's mean, per single-valued metric.

    The author means are aggregated map-side and joined back: however many
    works an author has, no task gathers them.
    """
    style = wh.mart_style_long
    of_authors = style
    if work_id is not None:
        author = style.filter(F.col("work_id") == F.lit(work_id)).select("author_key").distinct()
        of_authors = style.join(author, "author_key", "left_semi")
    single = of_authors.filter(~F.col("is_multivalue"))
    means = single.groupBy("author_key", "metric_key").agg(F.avg("zscore").alias("author_z"))
    delta = F.col("zscore") - F.col("author_z")
    return (
        _only(style, "work_id", work_id)
        .filter(~F.col("is_multivalue"))
        .join(means, ["author_key", "metric_key"])
        .select("work_id", "display_name", delta.alias("delta"))
        .orderBy("work_id", F.abs(_rank(F.col("delta"))).desc_nulls_last(), "display_name")
    )


def signature(wh: Warehouse, work_id: str | None = None) -> DataFrame:
    """A work's single-valued z-scores, strongest first."""
    return (
        _only(wh.mart_style_long, "work_id", work_id)
        .filter(~F.col("is_multivalue"))
        .select("work_id", "display_name", "zscore")
        .orderBy("work_id", F.abs(_rank(F.col("zscore"))).desc_nulls_last(), "display_name")
    )


def work_sentence_types(wh: Warehouse, work_id: str | None = None) -> DataFrame:
    return (
        _only(wh.mart_style_long, "work_id", work_id)
        .filter(F.col("concept_name") == "sentence_type_mix")
        .select(
            "work_id",
            F.col("series_label").alias("sentence_type"),
            F.col("value").alias("proportion"),
        )
        .orderBy("work_id", F.desc_nulls_last("proportion"), "sentence_type")
    )


def work_punctuation(wh: Warehouse, work_id: str | None = None) -> DataFrame:
    return (
        _only(wh.mart_style_long, "work_id", work_id)
        .filter(F.col("concept_name") == "punctuation_frequency")
        .select("work_id", F.col("series_label").alias("mark"), "zscore")
        .orderBy("work_id", _rank(F.col("zscore")).desc_nulls_last(), "mark")
    )


def work_function_words(
    wh: Warehouse, work_id: str | None = None, top: int = 12
) -> DataFrame:
    """Each work's most unusual function-word rates; a work has one row per word."""
    words = (
        _only(wh.mart_style_long, "work_id", work_id)
        .filter(F.col("concept_name") == "function_word_frequency")
        .select("work_id", F.col("series_label").alias("word"), "zscore")
    )
    return _top_by_size(words, "work_id", "zscore", "word", top)
