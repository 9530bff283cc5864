"""Measurements, star schema, marts, reports and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks.duck import FWORD_SQL, MARK_SQL, MEASURE_PARTS, SINGLE, key, oracle, series_sql
from inkmeter import fixed_values as fixed
from inkmeter.operators import declared, metrics, quality
from inkmeter.operators import tokens as tok
from inkmeter.plans import marts, moments, reports, staging, star
from inkmeter.plans.declared_checks import DECLARED
from inkmeter.sources.lookups import metric_concepts

CHECKS: dict = {}
SQL: dict[str, str] = {}


def add(name, fn, sql=None):  # noqa: ANN001
    CHECKS[name] = fn
    if sql is not None:
        SQL[name] = sql


def _columns(names, *, round6=(), text=(), double=()) -> str:  # noqa: ANN001
    parts = []
    for n in names:
        if n in round6:
            parts.append(f"round(CAST({n} AS DOUBLE), 6) AS {n}")
        elif n in text:
            parts.append(f"CAST({n} AS VARCHAR) AS {n}")
        elif n in double:
            parts.append(f"CAST({n} AS DOUBLE) AS {n}")
        else:
            parts.append(n)
    return ", ".join(parts)


# --- Series straight from the corpus ---------------------------------------------------


def _text_series(*names):  # noqa: ANN202
    """Text-only series, measured from the corpus in one pass."""

    def run(spark, sf_dir):
        wide = metrics.measure_wide(tok.text_view(b.corpus(spark, sf_dir)))
        return b.rounded(wide.select("work_id", *names), *names)

    return run


def _parsed_series(*names):  # noqa: ANN202
    def run(spark, sf_dir):
        wide = metrics.measure_wide(tok.parsed_view(b.parsed(spark, sf_dir)))
        return b.rounded(wide.select("work_id", *names), *names)

    return run


def _single_sql(*names):  # noqa: ANN202
    union = " UNION ALL ".join(series_sql(n) for n in names)
    needs = [p for p in MEASURE_PARTS if any(p in SINGLE[n][0] for n in names)]
    columns = ", ".join(f"round(max(value) FILTER (metric = '{n}'), 6) AS {n}" for n in names)
    return oracle(f"SELECT work_id, {columns} FROM ({union}) GROUP BY work_id", *needs)


for _query, _names in {
    "word_count": ("word_count",),
    "mean_word_length": ("mean_word_length",),
    "yules_k": ("yules_k",),
    "archaic_rate": ("archaic_word_rate",),
    "honore_r": ("honore_r",),
    "mean_sentence_length": ("mean_sentence_length",),
    "sentence_stdev": ("sentence_length_stdev",),
    "dialogue_ratio": ("dialogue_narration_ratio",),
}.items():
    add(_query, _text_series(*_names), _single_sql(*_names))

for _query, _names in {
    "tree_depth": ("mean_parse_tree_depth",),
    "sentence_types": ("senttype_simple", "senttype_compound", "senttype_complex"),
    "contractions": ("contraction_rate",),
    "pos_density": ("adjective_density", "adverb_density"),
}.items():
    add(_query, _parsed_series(*_names), _single_sql(*_names))


def word_freq(spark, sf_dir):
    return metrics.word_counts(tok.text_view(b.corpus(spark, sf_dir)))


add("word_freq", word_freq, oracle("SELECT work_id, word, n FROM wc", "wc"))


def _family(prefix):  # noqa: ANN001, ANN202
    def run(spark, sf_dir):
        wide = metrics.measure_wide(tok.text_view(b.corpus(spark, sf_dir)))
        family = wide.select("work_id", *[c for c in wide.columns if c.startswith(prefix)])
        long = metrics.to_long(family, F.lit(None).cast("timestamp")).drop("loaded_at")
        return b.rounded(long, "value")

    return run


def _long_sql(sql: str) -> str:
    return f"SELECT work_id, metric, round(value, 6) AS value FROM ({sql})"


add("function_words", _family("funcword_"), oracle(_long_sql(FWORD_SQL), "fwords", "lex"))
add("punctuation", _family("punct_"), oracle(_long_sql(MARK_SQL), "marks", "lex"))


def sentences(spark, sf_dir):
    """Words, depth and kind of every sentence, tallied."""
    rows = tok.parsed_sentences(b.parsed(spark, sf_dir))
    return rows.groupBy("work_id", "words", "depth", "kind").agg(F.count(F.lit(1)).alias("n"))


add(
    "sentences",
    sentences,
    oracle(
        """SELECT work_id, words, CAST(depth AS BIGINT) AS depth, kind, count(*) AS n
           FROM kinds JOIN depths USING (work_id, para_no, sent_no) GROUP BY ALL""",
        "kinds",
        "depths",
    ),
)

add(
    "vocab_terms",
    b.vocabulary,
    oracle("SELECT work_id, term, term_count FROM vocab", "vocab"),
)
add(
    "measurements_long",
    lambda spark, sf_dir: b.rounded(
        b.as_text(b.raw_measurements(spark, sf_dir), "loaded_at"), "value"
    ),
    oracle(
        """SELECT work_id, metric, round(value, 6) AS value, CAST(c.loaded_at AS VARCHAR) AS loaded_at
           FROM measures JOIN (SELECT work_id, loaded_at FROM corpus) c USING (work_id)""",
        "measures",
    ),
)


def annotate_hook(spark, sf_dir):
    """A caller's annotator run over Arrow batches, then measured."""

    def annotator(texts):  # noqa: ANN001, ANN202
        import regex

        for value in texts:
            yield [
                [
                    {
                        "text": w,
                        "stop": False,
                        "lemma": w.lower(),
                        "pos": "ADV" if w.endswith("ly") else "NOUN",
                        "tag": "X",
                        "dep": "dep" if i else "ROOT",
                        "head": max(i - 1, 0),
                    }
                    for i, w in enumerate(regex.findall(r"\p{L}+", line))
                ]
                for line in value.split("\n")
                if regex.search(r"\p{L}", line)
            ]

    parsed = b.staged(
        spark,
        sf_dir,
        "annotated",
        lambda: tok.annotate(tok.text_units(b.spread_corpus(spark, sf_dir)), annotator),
    )
    wide = metrics.measure_wide(tok.parsed_view(parsed))
    names = ("word_count", "adverb_density", "mean_parse_tree_depth")
    return b.rounded(wide.select("work_id", *names), *names)


add(
    "annotate_hook",
    annotate_hook,
    oracle(
        r"""SELECT work_id, CAST(coalesce(sum(len(ws)), 0) AS DOUBLE) AS word_count,
               round(coalesce(sum(len(list_filter(ws, lambda w: w LIKE '%ly'))) / sum(len(ws)), 0.0), 6) AS adverb_density,
               round(coalesce(avg(len(ws) - 1) FILTER (len(ws) > 0), 0.0), 6) AS mean_parse_tree_depth
           FROM (SELECT work_id, regexp_extract_all(unnest(string_split(text, chr(10))), '\p{L}+') AS ws FROM corpus)
           GROUP BY work_id""",
        "corpus",
    ),
)

# --- Staging and star schema -------------------------------------------------------------

_MEASUREMENT = ("work_id", "metric_name", "value", "loaded_at")
add(
    "stg_measurements",
    lambda spark, sf_dir: b.rounded(
        b.as_text(staging.stg_measurements(b.raw_measurements(spark, sf_dir)), "loaded_at"), "value"
    ),
    oracle(
        f"SELECT {_columns(_MEASUREMENT, round6=('value',), text=('loaded_at',))} FROM stg_measurements",
        "stg_measurements",
    ),
)
add(
    "stg_vocab",
    lambda spark, sf_dir: b.as_text(staging.stg_vocab(b.raw_vocab(spark, sf_dir)), "loaded_at"),
    oracle(
        f"SELECT {_columns(('work_id', 'term', 'term_count', 'loaded_at'), text=('loaded_at',))} FROM stg_vocab",
        "stg_vocab",
    ),
)


def concept_bridge(spark, sf_dir):
    """Measured series, their concept and how many values each has."""
    from inkmeter.functions.catalog import concept_of, series_label

    style = staging.stg_measurements(b.raw_measurements(spark, sf_dir)).filter(
        "metric_name <> 'word_count'"
    )
    concept = concept_of(F.col("metric_name"))
    return style.groupBy(
        "metric_name", concept.alias("concept_name"), series_label(F.col("metric_name"), concept).alias("series_label")
    ).agg(F.count(F.lit(1)).alias("works"))


_CONCEPT = """CASE WHEN starts_with(metric, 'funcword_') THEN 'function_word_frequency'
                   WHEN starts_with(metric, 'punct_') THEN 'punctuation_frequency'
                   WHEN starts_with(metric, 'senttype_') THEN 'sentence_type_mix' ELSE metric END"""
_BRIDGE = oracle(
    f"""SELECT metric AS metric_name, {_CONCEPT} AS concept_name,
               regexp_replace(metric, '^(funcword|punct|senttype)_', '') AS series_label, count(*) AS works
        FROM measures WHERE metric <> 'word_count' GROUP BY ALL""",
    "measures",
)
add("concept_bridge", concept_bridge, _BRIDGE)
add("series_label", concept_bridge, _BRIDGE)


def prose_type(spark, sf_dir):
    from inkmeter.functions.catalog import prose_type as band

    docs = b.table(spark, sf_dir, "documents")
    return docs.select("doc_id", band(F.col("n_chars") * 2).alias("prose_type"))


add(
    "prose_type",
    prose_type,
    """SELECT doc_id, CASE WHEN n_chars * 2 < 10000 THEN 'short-story' WHEN n_chars * 2 < 40000 THEN 'novella'
                           ELSE 'novel' END AS prose_type FROM documents""",
)


def dim_metric(spark, sf_dir):
    """The metric dimension with the values the corpus has for each concept."""
    wh = b.warehouse(spark, sf_dir)
    uses = wh.fact_style_measurement.groupBy("metric_key").agg(F.count(F.lit(1)).alias("measurements"))
    return (
        star.dim_metric(metric_concepts(spark))
        .join(uses, "metric_key", "left")
        .withColumn("is_multivalue", F.col("is_multivalue").cast("int"))
        .fillna(0, ["measurements"])
    )


_METRIC = ", ".join(
    "CAST(d.is_multivalue AS INT) AS is_multivalue" if c == "is_multivalue" else f"d.{c}"
    for c in fixed.METRIC_COLUMNS
)
add(
    "dim_metric",
    dim_metric,
    oracle(
        f"""SELECT d.metric_key, {_METRIC}, count(f.metric_key) AS measurements
            FROM dim_metric d LEFT JOIN fact_style f USING (metric_key) GROUP BY ALL""",
        "dim_metric",
        "fact_style",
    ),
)


def dim_date(spark, sf_dir):
    """The library's whole calendar, with the orders of each day."""
    orders = b.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    counts = orders.groupBy(F.col("day").alias("date_day")).agg(F.count(F.lit(1)).alias("orders"))
    joined = star.dim_date(spark).join(counts, "date_day", "left").fillna(0, ["orders"])
    return b.as_text(joined, "date_day")


add(
    "dim_date",
    dim_date,
    f"""SELECT {key('d')} AS date_key, CAST(d AS VARCHAR) AS date_day, CAST(year(d) AS INT) AS year,
               CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day_of_month,
               CAST(dayofweek(d) AS INT) AS day_of_week, CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
               count(o_orderkey) AS orders
        FROM (SELECT CAST(unnest(generate_series(DATE '{fixed.CALENDAR_START}', DATE '{fixed.CALENDAR_END}', INTERVAL 1 DAY)) AS DATE) AS d)
        LEFT JOIN orders ON o_orderdate::DATE = d GROUP BY ALL""",
)

_WORK = (
    "work_key", "author_key", "work_id", "title", "genre", "is_translation", "is_juvenile", "is_play",
    "is_poetry", "word_count", "prose_type", "issue_date", "ingested_at",
)


def _mart(name, columns, cte, *, round6=(), text=(), double=()):  # noqa: ANN001
    def run(spark, sf_dir):
        df = getattr(b.warehouse(spark, sf_dir), name).select(*columns)
        df = b.rounded(df, *round6) if round6 else df
        df = df.withColumns({c: F.col(c).cast("double") for c in double})
        return b.as_text(df, *text) if text else df

    add(
        cte,
        run,
        oracle(f"SELECT {_columns(columns, round6=round6, text=text, double=double)} FROM {cte}", cte),
    )


_mart("dim_author", ("author_key", "name", "birth_date", "death_date", "is_self"), "dim_author", text=("birth_date", "death_date"))
_mart("dim_work", _WORK, "dim_work", text=("issue_date", "ingested_at"))
_mart(
    "fact_style_measurement",
    ("measurement_key", "work_key", "author_key", "metric_key", "metric_name", "loaded_date_key", "loaded_date", "value"),
    "fact_style",
    round6=("value",),
    text=("loaded_date",),
)
_mart(
    "fact_vocab_overlap",
    ("overlap_key", "author_key_a", "author_key_b", "loaded_date_key", "loaded_date", "my_vocab_size", "their_vocab_size", "shared_terms", "jaccard"),
    "fact_overlap",
    round6=("jaccard",),
    text=("loaded_date",),
)
_mart(
    "mart_style_long",
    ("work_key", "work_id", "author_key", "author", "metric_key", "metric_name", "concept_name", "display_name", "category", "series_label", "value", "zscore", "loaded_date"),
    "mart_style_long",
    round6=("value", "zscore"),
    text=("loaded_date",),
)
_mart(
    "mart_work",
    (*_WORK, "author", "is_self", "excess", "series_measured"),
    "mart_work",
    round6=("excess",),
    text=("issue_date", "ingested_at"),
)
_mart(
    "mart_author",
    ("author_key", "author", "is_self", "birth_date", "death_date", "works", "total_words"),
    "mart_author",
    text=("birth_date", "death_date"),
)


def int_measurements(spark, sf_dir):
    wh = b.warehouse(spark, sf_dir)
    joined = star.normalized_measurements(
        staging.stg_measurements(b.raw_measurements(spark, sf_dir)), wh.dim_metric
    )
    return b.rounded(b.as_text(joined, "loaded_at"), "value")


add(
    "int_measurements",
    int_measurements,
    oracle(
        "SELECT work_id, metric_key, metric_name, round(CAST(value AS DOUBLE), 6) AS value, CAST(loaded_at AS VARCHAR) AS loaded_at FROM int_measurements",
        "int_measurements",
    ),
)


def _author_terms(spark, sf_dir):
    return b.warehouse(spark, sf_dir).author_vocabulary


add(
    "author_vocab",
    lambda spark, sf_dir: _author_terms(spark, sf_dir).drop("loaded_at"),
    oracle("SELECT author_key, is_self, term FROM author_vocab", "author_vocab"),
)
add(
    "jaccard",
    lambda spark, sf_dir: b.rounded(
        b.as_text(star.vocab_jaccard(_author_terms(spark, sf_dir)), "loaded_at"), "jaccard"
    ),
    oracle(
        f"SELECT {_columns(('author_key', 'my_vocab_size', 'their_vocab_size', 'loaded_at', 'shared_terms', 'jaccard'), round6=('jaccard',), text=('loaded_at',))} FROM jaccard",
        "jaccard",
    ),
)

# --- z-scores on a plain table -------------------------------------------------------------

_ZSCORE = """
    SELECT event_id, event_type, round((value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0), 6) AS zscore
    FROM events WINDOW w AS (PARTITION BY event_type)"""


def zscore(spark, sf_dir):
    scored = marts.zscore(b.table(spark, sf_dir, "events"), "value", "event_type")
    return b.rounded(scored.select("event_id", "event_type", "zscore"), "zscore")


def zscore_window(spark, sf_dir):
    scored = b.table(spark, sf_dir, "events").select(
        "event_id", "event_type", marts.zscore_window("value", "event_type").alias("zscore")
    )
    return b.rounded(scored, "zscore")


def zscore_refreshed(spark, sf_dir):
    """z-scores from statistics of the day before, brought up to date by what changed."""
    now = b.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    # The day before: some rows had another value, some are new since, some have gone since
    other = F.when(F.col("event_id") % 11 == 0, F.col("value") * 2 + 1).otherwise(F.col("value"))
    departed = now.where("event_id % 13 = 0").select(
        (-1 - F.col("event_id")).alias("event_id"), "event_type", (F.col("value") + 100).alias("value")
    )
    before = now.where("event_id % 7 <> 0").withColumn("value", other).unionByName(departed)
    kept = moments.moments(before, "value", "event_type")
    gone, come = before.exceptAll(now), now.exceptAll(before)
    kept = moments.refreshed(kept, gone, come, now, "value", "event_type")
    scored = moments.zscore_of(now, "value", "event_type", kept)
    return b.rounded(scored.select("event_id", "event_type", "zscore"), "zscore")


add("zscore", zscore, _ZSCORE)
add("zscore_window", zscore_window, _ZSCORE)
add("zscore_refreshed", zscore_refreshed, _ZSCORE)

# --- Reports ------------------------------------------------------------------------------------


def _report(name, run, sql, *needs, round6=(), text=(), digits=6):  # noqa: ANN001
    def shaped(spark, sf_dir):
        df = run(b.warehouse(spark, sf_dir))
        df = b.rounded(df, *round6, digits=digits) if round6 else df
        return b.as_text(df, *text) if text else df

    add(name, shaped, oracle(sql, *needs))


_report(
    "last_refreshed", reports.last_refreshed,
    "SELECT CAST(max(ingested_at) AS VARCHAR) AS refreshed, count(work_id) AS work_count FROM mart_work",
    "mart_work", text=("refreshed",),
)
_report(
    "outliers", lambda wh: reports.outliers(wh, min_words=100),
    """SELECT title, author, genre, word_count, round(excess, 6) AS excess, concat('/works/', work_id) AS link FROM mart_work
       WHERE is_play = 0 AND is_translation = 0 AND is_juvenile = 0 AND is_poetry = 0 AND word_count >= 100
       ORDER BY round(mart_work.excess, 6) DESC, work_id LIMIT 25""",
    "mart_work", round6=("excess",),
)
_report(
    "kinship", reports.kinship,
    """SELECT a.name AS author, round(o.jaccard, 6) AS jaccard FROM fact_overlap o JOIN dim_author a ON o.author_key_b = a.author_key
       ORDER BY round(o.jaccard, 6) DESC, a.name LIMIT 25""",
    "fact_overlap", "dim_author", round6=("jaccard",),
)
_report(
    "authors_list", reports.authors_list,
    "SELECT author AS name, works, total_words AS words, concat('/authors/', author) AS link FROM mart_author ORDER BY works DESC, author",
    "mart_author",
)
_report(
    "author_list", reports.author_list,
    "SELECT name FROM (SELECT 'All authors' AS name, 0 AS ord UNION ALL SELECT author, 1 FROM mart_author) ORDER BY ord, name",
    "mart_author",
)
_report(
    "genre_list", reports.genre_list,
    "SELECT name FROM (SELECT 'All genres' AS name, 0 AS ord UNION ALL SELECT DISTINCT genre, 1 FROM mart_work) ORDER BY ord, name",
    "mart_work",
)
_YES_NO = """SELECT CASE WHEN is_juvenile = 1 THEN 'Yes' ELSE 'No' END AS juvenile, CASE WHEN is_play = 1 THEN 'Yes' ELSE 'No' END AS play,
             CASE WHEN is_poetry = 1 THEN 'Yes' ELSE 'No' END AS poetry, CASE WHEN is_translation = 1 THEN 'Yes' ELSE 'No' END AS translation,
             * FROM mart_work WHERE title ILIKE '%e%'"""
_report(
    "flag_options", lambda wh: reports.flag_options(wh, title_search="E"),
    f"SELECT juvenile, play, poetry, translation FROM ({_YES_NO})", "mart_work",
)
_report(
    "flag_grid", lambda wh: reports.flag_grid(wh, title_search="E"),
    " UNION ALL ".join(
        f"SELECT '{f}' AS flag, {f} AS answer, count(*) AS works FROM ({_YES_NO}) GROUP BY {f}"
        for f in ("juvenile", "play", "poetry", "translation")
    ),
    "mart_work",
)
_report(
    "works_list", lambda wh: reports.works_list(wh, title_search="E", flags={"poetry": "No"}),
    f"""SELECT title, author, genre, word_count, juvenile, play, poetry, translation,
               concat_ws(', ', CASE WHEN is_juvenile = 1 THEN 'Juvenile' END, CASE WHEN is_play = 1 THEN 'Play' END,
                         CASE WHEN is_poetry = 1 THEN 'Poetry' END, CASE WHEN is_translation = 1 THEN 'Translation' END) AS flags,
               concat('/works/', work_id) AS link
        FROM ({_YES_NO}) WHERE poetry = 'No' ORDER BY word_count DESC NULLS LAST, work_id""",
    "mart_work",
)
_report("author_summary", reports.author_summary, "SELECT author, works, total_words FROM mart_author", "mart_author")
_report(
    "author_distinctive", reports.author_distinctive,
    "SELECT author, display_name, round(avg(zscore), 6) AS zscore FROM mart_style_long WHERE NOT is_multivalue GROUP BY ALL",
    "mart_style_long", round6=("zscore",),
)
_report(
    "metric_defs", lambda wh: reports.metric_defs(wh).join(
        wh.mart_style_long.select("display_name").distinct(), "display_name", "left_semi"
    ),
    """SELECT display_name, description FROM dim_metric WHERE NOT is_multivalue AND metric_name <> 'jaccard'
       AND display_name IN (SELECT display_name FROM mart_style_long)""",
    "dim_metric", "mart_style_long",
)
_report(
    "author_sentence_types", reports.author_sentence_types,
    # Means of six-decimal values fall on ties at the seventh digit: compare more
    """SELECT author, series_label AS sentence_type, round(avg(value::DOUBLE), 12) AS proportion FROM mart_style_long
       WHERE concept_name = 'sentence_type_mix' GROUP BY ALL""",
    "mart_style_long", round6=("proportion",), digits=12,
)
_report(
    "author_punctuation", reports.author_punctuation,
    """SELECT author, series_label AS mark, round(avg(zscore), 6) AS zscore FROM mart_style_long
       WHERE concept_name = 'punctuation_frequency' GROUP BY ALL""",
    "mart_style_long", round6=("zscore",),
)


def _top12(group: str, rows: str) -> str:
    return f"""SELECT {group}, word, round(zscore, 6) AS zscore FROM (
        SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY abs(round(zscore, 6)) DESC NULLS LAST, word) AS place FROM ({rows}))
        WHERE place <= 12"""


_FUNCTION_WORDS = "concept_name = 'function_word_frequency'"
_AUTHOR_TOP = _top12(
    "author",
    f"SELECT author, series_label AS word, avg(zscore) AS zscore FROM mart_style_long WHERE {_FUNCTION_WORDS} GROUP BY ALL",
)
_report("author_function_words", reports.author_function_words, _AUTHOR_TOP, "mart_style_long", round6=("zscore",))
_report("function_word_top12", reports.author_function_words, _AUTHOR_TOP, "mart_style_long", round6=("zscore",))
_report(
    "author_works", reports.author_works,
    "SELECT author, title, prose_type, genre, word_count, concat('/works/', work_id) AS link FROM mart_work", "mart_work",
)
_report(
    "work_header", lambda wh: reports.work_header(wh, source_base="/source/"),
    """SELECT work_id, title, author, genre, prose_type, word_count, concat('/authors/', author) AS author_link,
              CASE WHEN is_self = 1 THEN NULL ELSE concat('/source/', work_id) END AS work_link FROM mart_work""",
    "mart_work",
)
_report(
    "deviation", reports.deviation,
    """SELECT work_id, display_name, round(zscore - author_z, 6) AS delta
       FROM mart_style_long JOIN (SELECT author_key, metric_key, avg(zscore) AS author_z FROM mart_style_long GROUP BY ALL)
       USING (author_key, metric_key) WHERE NOT is_multivalue""",
    "mart_style_long", round6=("delta",),
)
_report(
    "signature", reports.signature,
    "SELECT work_id, display_name, round(zscore, 6) AS zscore FROM mart_style_long WHERE NOT is_multivalue",
    "mart_style_long", round6=("zscore",),
)
_report(
    "work_sentence_types", reports.work_sentence_types,
    """SELECT work_id, series_label AS sentence_type, round(value::DOUBLE, 6) AS proportion FROM mart_style_long
       WHERE concept_name = 'sentence_type_mix'""",
    "mart_style_long", round6=("proportion",),
)
_report(
    "work_punctuation", reports.work_punctuation,
    """SELECT work_id, series_label AS mark, round(zscore, 6) AS zscore FROM mart_style_long
       WHERE concept_name = 'punctuation_frequency'""",
    "mart_style_long", round6=("zscore",),
)
_report(
    "work_function_words", reports.work_function_words,
    _top12("work_id", f"SELECT work_id, series_label AS word, zscore FROM mart_style_long WHERE {_FUNCTION_WORDS}"),
    "mart_style_long", round6=("zscore",),
)


def flagship(spark, sf_dir):
    """Text to word counts to series to z-scores to the most distinctive works."""
    wide = metrics.measure_wide(tok.text_view(b.corpus(spark, sf_dir)))
    lexical = wide.select("work_id", "mean_word_length", "yules_k", "honore_r")
    long = metrics.to_long(lexical, F.lit(None).cast("timestamp"))
    scored = marts.zscore(long.withColumn("value", F.col("value").cast("decimal(18,6)")), "value", "metric")
    ranked = marts.excess_index(scored.withColumnRenamed("work_id", "work_key"))
    ranked = b.rounded(ranked, "excess").withColumnRenamed("work_key", "work_id")
    return ranked.orderBy(F.desc("excess"), "work_id").limit(25)


add(
    "flagship",
    flagship,
    oracle(
        f"""SELECT work_id, round(sum(CASE WHEN abs(z) > 2 THEN abs(z) - 2 ELSE 0 END), 6) AS excess, count(*) AS series_measured
            FROM (SELECT work_id, (v - avg(v) OVER w) / nullif(stddev_pop(v) OVER w, 0) AS z
                  FROM (SELECT work_id, metric, CAST(CAST(value AS DECIMAL(18, 6)) AS DOUBLE) AS v FROM (
                      {' UNION ALL '.join(series_sql(n) for n in ('mean_word_length', 'yules_k', 'honore_r'))}))
                  WINDOW w AS (PARTITION BY metric))
            GROUP BY work_id ORDER BY 2 DESC, 1 LIMIT 25""",
        "lex",
    ),
)

# --- Quality ---------------------------------------------------------------------------------------

add(
    "dq_unique",
    lambda spark, sf_dir: quality.not_unique(b.table(spark, sf_dir, "lineitem"), "l_orderkey"),
    "SELECT l_orderkey, count(*) AS occurrences FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
)
add(
    "dq_not_null",
    lambda spark, sf_dir: quality.is_null(b.catalog(spark, sf_dir), "subjects").select("catalog_id", "title"),
    oracle("SELECT catalog_id, title FROM feed WHERE subjects IS NULL", "feed"),
)
add(
    "dq_accepted_values",
    lambda spark, sf_dir: quality.unaccepted_values(
        b.table(spark, sf_dir, "events"), "event_type", ["view", "click", "purchase"]
    ),
    "SELECT event_type, count(*) AS occurrences FROM events WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY 1",
)
add(
    "dq_relationships",
    lambda spark, sf_dir: quality.unrelated(
        b.table(spark, sf_dir, "documents").select("doc_id", "source"),
        "doc_id",
        b.table(spark, sf_dir, "labels"),
        "doc_id",
    ),
    "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
add(
    "dq_range",
    lambda spark, sf_dir: quality.out_of_range(b.table(spark, sf_dir, "customer"), "c_acctbal", 0, 9000).select(
        "c_custkey", "c_acctbal"
    ),
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000",
)
add(
    "dq_unique_combo",
    lambda spark, sf_dir: quality.unique_combination(b.table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey"),
    "SELECT l_partkey, l_suppkey, count(*) AS occurrences FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)


def concept_completeness(spark, sf_dir):
    """Works short of a concept once the zero values are left out."""
    fact = b.warehouse(spark, sf_dir).fact_style_measurement
    return quality.incomplete_concepts(fact.filter("value <> 0"))


add(
    "concept_completeness",
    concept_completeness,
    oracle(
        """SELECT work_key, count(DISTINCT metric_key) AS concept_count FROM fact_style WHERE value <> 0
           GROUP BY 1 HAVING count(DISTINCT metric_key) <> 14""",
        "fact_style",
    ),
)
add(
    "freshness",
    lambda spark, sf_dir: b.as_text(
        quality.stale_source(b.table(spark, sf_dir, "events"), "ts", "2030-01-01 00:00:00"), "newest"
    ),
    """SELECT CAST(max(ts) AS VARCHAR) AS newest FROM events
       HAVING max(ts) IS NULL OR max(ts) < TIMESTAMP '2030-01-01 00:00:00' - INTERVAL 24 HOURS""",
)


def dq_suite(spark, sf_dir):
    """Every check of the star schema, plus a few on the given tables, as one result."""
    wh = b.warehouse(spark, sf_dir)
    fact, overlap = wh.fact_style_measurement, wh.fact_vocab_overlap
    return quality.suite(
        {
            ("unique work_key", "dim_work"): quality.not_unique(wh.dim_work, "work_key"),
            ("unique author_key", "dim_author"): quality.not_unique(wh.dim_author, "author_key"),
            ("unique measurement_key", "fact_style_measurement"): quality.not_unique(fact, "measurement_key"),
            ("not_null metric_key", "fact_style_measurement"): quality.is_null(fact, "metric_key"),
            ("relationships work_key", "fact_style_measurement"): quality.unrelated(fact, "work_key", wh.dim_work, "work_key"),
            ("relationships metric_key", "fact_style_measurement"): quality.unrelated(fact, "metric_key", wh.dim_metric, "metric_key"),
            ("relationships author_key", "dim_work"): quality.unrelated(wh.dim_work, "author_key", wh.dim_author, "author_key"),
            ("accepted genre", "mart_work"): quality.unaccepted_values(wh.mart_work, "genre", fixed.GENRES),
            ("unique author_key_b", "fact_vocab_overlap"): quality.not_unique(overlap, "author_key_b"),
            ("range jaccard", "fact_vocab_overlap"): quality.out_of_range(overlap, "jaccard", 0, 1),
            ("unique work_key, metric_name", "mart_style_long"): quality.unique_combination(wh.mart_style_long, "work_key", "metric_name"),
            ("complete concepts", "fact_style_measurement"): quality.incomplete_concepts(fact),
            ("unique l_orderkey", "lineitem"): quality.not_unique(b.table(spark, sf_dir, "lineitem"), "l_orderkey"),
            ("range c_acctbal", "customer"): quality.out_of_range(b.table(spark, sf_dir, "customer"), "c_acctbal", 0),
        }
    )


_PASSING = [
    ("unique work_key", "dim_work"), ("unique author_key", "dim_author"), ("unique measurement_key", "fact_style_measurement"),
    ("not_null metric_key", "fact_style_measurement"), ("relationships work_key", "fact_style_measurement"),
    ("relationships metric_key", "fact_style_measurement"), ("relationships author_key", "dim_work"), ("accepted genre", "mart_work"),
    ("unique author_key_b", "fact_vocab_overlap"), ("range jaccard", "fact_vocab_overlap"),
    ("unique work_key, metric_name", "mart_style_long"), ("complete concepts", "fact_style_measurement"),
]
add(
    "dq_suite",
    dq_suite,
    "SELECT check_name, table_name, violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS check_name, '{t}' AS table_name, 0 AS violations" for c, t in _PASSING)
    + """ UNION ALL SELECT 'unique l_orderkey', 'lineitem', (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1))
          UNION ALL SELECT 'range c_acctbal', 'customer', (SELECT count(*) FROM customer WHERE c_acctbal < 0))""",
)


def declared_tables(spark, sf_dir):
    """The tables that declare checks."""
    wh = b.warehouse(spark, sf_dir)
    measurements = staging.stg_measurements(b.raw_measurements(spark, sf_dir))
    return wh.tables() | {
        "stg_works": staging.stg_works(b.roster(spark, sf_dir)),
        "int_measurements": star.normalized_measurements(measurements, wh.dim_metric),
        "int_vocab_jaccard": star.vocab_jaccard(wh.author_vocabulary),
    }


_GIVEN = {
    "orders": [
        *declared.key("o_orderkey"), *declared.related("o_custkey", "customer", "c_custkey"),
        declared.accepted("o_orderstatus", ["O", "F"]), declared.in_range("o_totalprice", 1000, 300000),
    ],
    "lineitem": [
        declared.unique("l_orderkey"), declared.unique_together("l_orderkey", "l_linenumber"),
        *declared.related("l_orderkey", "orders", "o_orderkey"), *declared.related("l_partkey", "customer", "c_custkey"),
        declared.in_range("l_quantity", high=40),
    ],
    "customer": [*declared.key("c_custkey"), declared.in_range("c_acctbal", 0)],
}


def declared_checks(spark, sf_dir):
    """All checks that the built tables declare, and some that the given tables break."""
    given = {t: b.table(spark, sf_dir, t) for t in _GIVEN}
    return declared.run_declared(declared_tables(spark, sf_dir) | given, DECLARED | _GIVEN)


def _declared_sql(table, check):
    columns = ", ".join(check.columns)
    first = check.columns[0]
    counted = {
        "not_null": f"SELECT count(*) FROM {table} WHERE {first} IS NULL",
        "unique": f"SELECT count(*) FROM (SELECT {first} FROM {table} WHERE {first} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
        "unique_together": f"SELECT count(*) FROM (SELECT {columns} FROM {table} GROUP BY ALL HAVING count(*) > 1)",
        "range": f"SELECT count(*) FROM {table} WHERE {first} < {check.low if check.low is not None else '-1e300'} OR {first} > {check.high if check.high is not None else '1e300'}",
        "accepted": f"SELECT count(*) FROM {table} WHERE {first} NOT IN ({', '.join(map(repr, check.values))})",
        "related": f"SELECT count(*) FROM {table} WHERE {first} IS NOT NULL AND {first} NOT IN (SELECT {check.parent_column} FROM {check.parent or table})",
    }[check.kind]
    return f"SELECT '{check.name}' AS check_name, '{table}' AS table_name, ({counted}) AS violations"


add(
    "declared_checks",
    declared_checks,
    "SELECT *, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM ("
    + " UNION ALL ".join(
        [_declared_sql(t, c) for t, cs in _GIVEN.items() for c in cs]
        # The built tables keep what they declare
        + [f"SELECT '{c.name}', '{t}', 0" for t, cs in DECLARED.items() for c in cs]
    )
    + ")",
)
