"""Catalog classification, staging and change capture."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import bindings as b
from checks.duck import FEED_COLUMNS, RUN_TS, oracle
from inkmeter.functions import catalog as c
from inkmeter.functions.keys import content_hash, surrogate_key
from inkmeter.operators import cdc, history, scope
from inkmeter.plans import nightly, staging
from inkmeter.sources import corpus as corpus_source
from inkmeter.sources import keyed, tables
from inkmeter.streaming import landing

CHECKS: dict = {}
SQL: dict[str, str] = {}


def check(sql: str | None = None):  # noqa: ANN201
    def add(fn):  # noqa: ANN001, ANN202
        CHECKS[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


# --- Feed -------------------------------------------------------------------------


@check(oracle("SELECT catalog_id, catalog_row_hash, snapshot_date, CAST(loaded_at AS VARCHAR) AS loaded_at FROM catalog", "catalog"))
def catalog_stamped(spark, sf_dir):
    out = b.catalog(spark, sf_dir).select(
        "catalog_id", "catalog_row_hash", "snapshot_date", "loaded_at"
    )
    return b.as_text(out, "loaded_at")


@check(oracle("SELECT catalog_id, sha256(concat_ws(chr(31), " + ", ".join(f"coalesce({x}, '')" for x in FEED_COLUMNS) + ")) AS row_hash FROM feed", "feed"))
def row_hash(spark, sf_dir):
    return b.catalog(spark, sf_dir).select(
        "catalog_id", F.col("catalog_row_hash").alias("row_hash")
    )


@check("SELECT doc_id, sha256(text) AS text_hash FROM documents")
def text_hash(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents")
    return docs.select("doc_id", content_hash(F.col("text").cast("binary")).alias("text_hash"))


@check(oracle("""
    SELECT path, CASE WHEN folder = 'own' THEN regexp_replace(name, '\\.md$', '') ELSE string_split(name, '-')[1] END AS work_id
    FROM (SELECT concat('/root/', CASE source WHEN 'src0' THEN 'own' ELSE source END, '/', doc_id, '-', lang, '-x.md') AS path,
                 CASE source WHEN 'src0' THEN 'own' ELSE source END AS folder, concat(doc_id, '-', lang, '-x.md') AS name FROM documents)"""))
def source_work_id(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents")
    folder = F.when(F.col("source") == "src0", "own").otherwise(F.col("source"))
    path = F.concat(F.lit("/root/"), folder, F.lit("/"), F.col("doc_id"), F.lit("-"), F.col("lang"), F.lit("-x.md"))
    return docs.select(path.alias("path")).select(
        "path", corpus_source.source_work_id(F.col("path"), "own").alias("work_id")
    )


@check(oracle("SELECT CAST(doc_id AS VARCHAR) AS stem FROM documents WHERE doc_id NOT IN (SELECT catalog_id FROM roster)", "roster"))
def orphan_texts(spark, sf_dir):
    landed = b.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("stem"))
    return corpus_source.orphan_texts(b.roster(spark, sf_dir), landed)


@check("""
    SELECT doc_id, CASE WHEN p > 0 AND strlen(substr(text, 1, p + 5)) <= 2048 THEN 1 ELSE 0 END AS marked
    FROM (SELECT doc_id, text, instr(lower(text), 'tionre') AS p FROM documents)""")
def marker_sniff(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents")
    hit = c.has_marker(F.col("text").cast("binary"), "tionre")
    return docs.select("doc_id", hit.cast("int").alias("marked"))


# --- Classification ------------------------------------------------------------------


@check(oracle("SELECT catalog_id, CAST(regexp_matches(coalesce(bookshelves, ''), '(^|; )(Gothic Fiction|Fantasy)($|;)') AS INT) AS on_shelf FROM feed", "feed"))
def shelf_token(spark, sf_dir):
    return b.catalog(spark, sf_dir).select(
        "catalog_id", c.shelf_token("(Gothic Fiction|Fantasy)").cast("int").alias("on_shelf")
    )


_PREDICATES = ("sf_core", "fantasy_core", "sff_shelf", "sf_theme", "fantasy_theme", "horror_core", "horror_theme")


@check(oracle("SELECT catalog_id, " + ", ".join(f"CAST({p} AS INT) AS {p}" for p in _PREDICATES) + " FROM classified", "classified"))
def genre_predicates(spark, sf_dir):
    return b.catalog(spark, sf_dir).select(
        "catalog_id", *[getattr(c, p)().cast("int").alias(p) for p in _PREDICATES]
    )


@check(oracle("SELECT catalog_id, CAST(is_about AS INT) AS is_about FROM classified", "classified"))
def is_about(spark, sf_dir):
    return b.catalog(spark, sf_dir).select("catalog_id", c.is_about().cast("int").alias("is_about"))


@check(oracle("SELECT catalog_id, genre FROM scoped", "scoped"))
def scope_filter(spark, sf_dir):
    return scope.scoped(b.catalog(spark, sf_dir)).select("catalog_id", "genre")


@check(oracle("SELECT catalog_id, genre FROM labelled", "labelled"))
def genre_label(spark, sf_dir):
    return b.catalog(spark, sf_dir).select("catalog_id", c.genre().alias("genre"))


@check(oracle("SELECT catalog_id, title, authors, genre, catalog_row_hash FROM roster", "roster"))
def dedup_keep_first(spark, sf_dir):
    return b.roster(spark, sf_dir).select("catalog_id", "title", "authors", "genre", "catalog_row_hash")


@check(oracle("SELECT count(*) AS scoped, count(*) FILTER (place = 1) AS kept, count(*) FILTER (place > 1) AS deduped FROM ranked", "ranked"))
def dedup_count(spark, sf_dir):
    return scope.dedup_count(b.catalog(spark, sf_dir))


@check(oracle("SELECT genre, count(*) AS works FROM roster GROUP BY genre ORDER BY genre", "roster"))
def genre_census(spark, sf_dir):
    return scope.genre_census(b.roster(spark, sf_dir))


# --- Authors, titles, flags ---------------------------------------------------------------

from checks import duck  # noqa: E402


@check(oracle(f"SELECT catalog_id, {duck.AUTHOR_NAME} AS author_name FROM feed", "feed"))
def primary_author(spark, sf_dir):
    return b.catalog(spark, sf_dir).select("catalog_id", c.primary_author().alias("author_name"))


@check(oracle(f"SELECT catalog_id, {duck.BIRTH} AS birth_year, {duck.DEATH} AS death_year FROM feed", "feed"))
def author_years(spark, sf_dir):
    return b.catalog(spark, sf_dir).select(
        "catalog_id", c.birth_year().alias("birth_year"), c.death_year().alias("death_year")
    )


@check(oracle(f"SELECT catalog_id, {duck.FLAGS} FROM feed", "feed"))
def work_flags(spark, sf_dir):
    return b.catalog(spark, sf_dir).select(
        "catalog_id",
        c.is_translation().alias("is_translation"),
        c.is_juvenile().alias("is_juvenile"),
        c.is_play().alias("is_play"),
        c.is_poetry().alias("is_poetry"),
    )


@check(oracle(r"""
    SELECT catalog_id, coalesce(nullif(array_to_string(list_transform(list_filter(list_transform(people,
        lambda e: list_filter(list_transform(string_split(regexp_replace(regexp_replace(e, '\([^)]*\)', '', 'g'), '\[[^\]]*\]', '', 'g'), ','),
                         lambda x: trim(x)),
                         lambda x: x <> '' AND NOT regexp_matches(x, '(?i)[0-9]{4}|^[0-9? –-]+$|\bcent(?:ury)?\b'))), lambda p: len(p) > 0),
        lambda p: array_to_string(list_concat(p[2:], p[1:1]), ' ')), '; '), ''), 'Unknown') AS display_author
    FROM (SELECT catalog_id, CASE WHEN len(list_filter(entries, lambda e: NOT regexp_matches(e, '\[[^\]]*\]'))) > 0
                    THEN list_filter(entries, lambda e: NOT regexp_matches(e, '\[[^\]]*\]')) ELSE entries END AS people
          FROM (SELECT catalog_id, list_filter(list_transform(string_split(authors, ';'), lambda e: trim(e)), lambda e: e <> '') AS entries FROM feed))""", "feed"))
def display_author(spark, sf_dir):
    return b.catalog(spark, sf_dir).select("catalog_id", c.display_author().alias("display_author"))


@check(oracle(r"SELECT catalog_id, regexp_replace(regexp_replace(title, '^\s+|\s+$', '', 'g'), '\s*[\r\n]+\s*', ': ', 'g') AS display_title FROM feed", "feed"))
def display_title(spark, sf_dir):
    return b.catalog(spark, sf_dir).select("catalog_id", c.display_title().alias("display_title"))


_ASCII = r"regexp_replace(strip_accents({}), '[^\x00-\x7F]', '', 'g')"


@check(oracle(rf"""
    SELECT catalog_id,
           coalesce(nullif(substr(trim(regexp_replace(lower({_ASCII.format("regexp_extract(title, '^[^:;\\n\\r]*')")}), '[^a-z0-9]+', '-', 'g'), '-'), 1, 60), ''), 'untitled') AS slug,
           coalesce(nullif(trim(regexp_replace({_ASCII.format("string_split(authors, ';')[1]")}, '[^A-Za-z0-9]+', '-', 'g'), '-'), ''), 'Unknown') AS folder
    FROM feed""", "feed"))
def title_slug(spark, sf_dir):
    return b.catalog(spark, sf_dir).select(
        "catalog_id",
        c.title_slug(F.col("title")).alias("slug"),
        c.author_folder(F.col("authors")).alias("folder"),
    )


@check(oracle("SELECT * EXCLUDE (issued, loaded_at), CAST(issued AS VARCHAR) AS issued, CAST(loaded_at AS VARCHAR) AS loaded_at FROM stg_works", "stg_works"))
def stg_works(spark, sf_dir):
    return b.as_text(staging.stg_works(b.roster(spark, sf_dir)), "issued", "loaded_at")


# --- Change capture --------------------------------------------------------------------------

_COMPARED = """(SELECT c.catalog_id, c.catalog_row_hash, l.catalog_row_hash AS seen_hash, l.status
               FROM catalog c LEFT JOIN ledger l USING (catalog_id))"""
_BACKLOG = "seen_hash IS NULL OR seen_hash <> catalog_row_hash OR status = 'failed'"


@check(oracle(f"""
    SELECT count(*) AS roster_size, count(*) FILTER (seen_hash IS NULL) AS candidate_new,
           count(*) FILTER (seen_hash <> catalog_row_hash) AS candidate_changed FROM {_COMPARED}""", "catalog", "ledger"))
def cdc_counts(spark, sf_dir):
    return cdc.diff_counts(b.catalog(spark, sf_dir), b.ledger(spark, sf_dir))


@check(oracle(f"SELECT * FROM {_COMPARED} WHERE {_BACKLOG}", "catalog", "ledger"))
def cdc_backlog(spark, sf_dir):
    return cdc.backlog(b.catalog(spark, sf_dir), b.ledger(spark, sf_dir))


@check(oracle(f"SELECT * FROM {_COMPARED} WHERE {_BACKLOG} ORDER BY catalog_id LIMIT 200", "catalog", "ledger"))
def cdc_batch(spark, sf_dir):
    return cdc.next_batch(cdc.backlog(b.catalog(spark, sf_dir), b.ledger(spark, sf_dir)))


def _processed(spark, sf_dir):
    """Outcomes of the whole backlog, read off the documents' texts."""
    docs = b.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("catalog_id"), F.when(F.col("n_chars") >= 200, F.col("text").cast("binary")).alias("content")
    )
    pending = cdc.backlog(b.catalog(spark, sf_dir), b.ledger(spark, sf_dir))
    status = cdc.outcome(F.col("content"), c.has_marker(F.col("content"), "tionre"))
    return pending.select("catalog_id", "catalog_row_hash").join(docs, "catalog_id").select(
        "catalog_id",
        "catalog_row_hash",
        F.when(status == "ingested", content_hash(F.col("content"))).alias("text_hash"),
        status.alias("status"),
    )


_PROCESSED = f"""
    processed AS (
      SELECT catalog_id, catalog_row_hash, CASE WHEN status = 'ingested' THEN sha256(text) END AS text_hash, status
      FROM (SELECT b.catalog_id, b.catalog_row_hash, text,
                   CASE WHEN n_chars < 200 THEN 'failed'
                        WHEN instr(lower(text), 'tionre') > 0 AND strlen(substr(text, 1, instr(lower(text), 'tionre') + 5)) <= 2048
                        THEN 'copyrighted' ELSE 'ingested' END AS status
            FROM (SELECT * FROM {_COMPARED} WHERE {_BACKLOG}) b JOIN documents ON doc_id = catalog_id))"""


def _with_processed(select: str) -> str:
    body = oracle("@", "catalog", "ledger")
    return body.replace("\n@", f",\n{_PROCESSED}\n{select}")


_MERGED_LEDGER = _with_processed(f"""
    SELECT catalog_id, catalog_row_hash, text_hash, CAST(first_seen AS VARCHAR) AS first_seen, CAST(last_changed AS VARCHAR) AS last_changed, status FROM (
      SELECT * FROM ledger WHERE catalog_id NOT IN (SELECT catalog_id FROM processed)
      UNION ALL
      SELECT p.catalog_id, p.catalog_row_hash, p.text_hash, coalesce(l.first_seen, TIMESTAMP '{RUN_TS}'), TIMESTAMP '{RUN_TS}', p.status
      FROM processed p LEFT JOIN ledger l USING (catalog_id))""")


@check(_MERGED_LEDGER)
def watermark_upsert(spark, sf_dir):
    merged = cdc.upsert_ledger(b.ledger(spark, sf_dir), _processed(spark, sf_dir), RUN_TS)
    return b.as_text(merged, "first_seen", "last_changed")


@check(_MERGED_LEDGER)
def outcome_log(spark, sf_dir):
    """Outcomes logged in three batches, the last one twice, and merged into a kept ledger."""
    name = f"inkmeter_checks.ledger_{uuid.uuid4().hex}"
    seen, done = b.ledger(spark, sf_dir), _processed(spark, sf_dir)
    keyed.create_keyed(spark, name, cdc.LEDGER_SCHEMA, "catalog_id", 16)
    keyed.replace_keys(spark, name, seen, seen.select("catalog_id"))
    log = f"{b.run_folder(spark)}/outcomes-{uuid.uuid4().hex}"
    done = tables.stage_table(done, f"{log}-all")
    for batch in (0, 1, 2, 2):
        landing.log_outcomes(done.where(F.col("catalog_id") % 3 == batch), log, batch, RUN_TS)
    landing.merge_log(spark, log, name)
    return b.as_text(tables.read_table(spark, name), "first_seen", "last_changed")


_NIGHTS = ("2030-01-01 00:00:00", "2030-01-02 00:00:00")


@check(oracle(f"""
    SELECT n.run_ts, 'catalog_refresh' AS run_type, (SELECT count(*) FROM catalog) AS books_in_catalog,
           (SELECT count(*) FROM roster r ANTI JOIN ledger l USING (catalog_id)) AS candidate_new,
           (SELECT count(*) FROM roster r JOIN ledger l USING (catalog_id)
            WHERE l.catalog_row_hash <> r.catalog_row_hash) AS candidate_changed,
           CASE WHEN n.run_ts = '{_NIGHTS[0]}' THEN (SELECT count(*) FROM corpus) ELSE 0 END AS measured
    FROM (VALUES ('{_NIGHTS[0]}'), ('{_NIGHTS[1]}')) n(run_ts)""", "catalog", "ledger", "roster", "corpus"))
def nightly_run(spark, sf_dir):
    """Two nights over kept tables; the second finds nothing to write."""
    names = nightly.Tables(f"inkmeter_nights_{uuid.uuid4().hex}")
    feed, seen = b.catalog(spark, sf_dir), b.ledger(spark, sf_dir)
    nightly.create_tables(spark, names, feed, 16)
    keyed.replace_keys(spark, names.ledger, seen, seen.select("catalog_id"))
    corpus = b.corpus(spark, sf_dir).select("work_id", "is_self", "text")
    for night in _NIGHTS:
        folder = f"{b.run_folder(spark)}/night-{uuid.uuid4().hex}"
        nightly.nightly_run(spark, names, feed, corpus, _manifest(spark, sf_dir), night, folder)
    measured = (
        keyed.read_keyed(spark, names.measurements)
        .groupBy(F.col("loaded_at").alias("run_ts"))
        .agg(F.count_distinct("work_id").alias("measured"))
    )
    audit = keyed.read_keyed(spark, names.audit).join(measured, "run_ts", "left")
    return b.as_text(audit, "run_ts").select(
        "run_ts", "run_type", "books_in_catalog", "candidate_new", "candidate_changed",
        F.coalesce("measured", F.lit(0)).alias("measured"),
    )


@check(_with_processed("SELECT status, count(*) AS works FROM processed GROUP BY status"))
def status_counts(spark, sf_dir):
    return cdc.status_counts(_processed(spark, sf_dir))


@check(_with_processed(f"""
    SELECT '{RUN_TS}' AS run_ts, 'text_ingest' AS run_type, (SELECT count(*) FROM catalog) AS books_in_catalog,
           (SELECT count(*) FROM {_COMPARED} WHERE seen_hash IS NULL) AS candidate_new,
           (SELECT count(*) FROM {_COMPARED} WHERE seen_hash <> catalog_row_hash) AS candidate_changed,
           (SELECT count(*) FROM processed WHERE status = 'ingested') AS downloaded,
           (SELECT count(*) FROM processed WHERE status = 'failed') AS failed"""))
def ingest_audit(spark, sf_dir):
    counts = cdc.diff_counts(b.catalog(spark, sf_dir), b.ledger(spark, sf_dir))
    return b.as_text(
        cdc.ingest_audit(RUN_TS, "text_ingest", counts, _processed(spark, sf_dir)), "run_ts"
    )


# Measurements of an earlier run: one row per document and source it came from
_EARLIER = "(SELECT work_id, loaded_at FROM corpus WHERE n_chars >= 400 UNION ALL SELECT concat('gone-', CAST(doc_id AS VARCHAR)), loaded_at FROM corpus WHERE lang = 'es')"


def _earlier(spark, sf_dir):
    corpus = b.corpus(spark, sf_dir)
    gone = corpus.filter("lang = 'es'").select(
        F.concat(F.lit("gone-"), F.col("doc_id")).alias("work_id"), "loaded_at"
    )
    return corpus.filter("n_chars >= 400").select("work_id", "loaded_at").unionByName(gone)


def _manifest(spark, sf_dir):
    return b.manual_works(spark, sf_dir).select(
        "work_id", (F.col("loaded_at") + F.expr("INTERVAL 1 DAY")).alias("loaded_at")
    )


@check(oracle(f"""
    SELECT c.work_id, c.is_self FROM corpus c
    LEFT JOIN (SELECT work_id, max(loaded_at) AS at FROM {_EARLIER} GROUP BY 1) m USING (work_id)
    LEFT JOIN ledger l ON c.is_self = 0 AND CAST(l.catalog_id AS VARCHAR) = c.work_id
    LEFT JOIN manual_works w ON c.is_self = 1 AND w.work_id = c.work_id
    WHERE m.at IS NULL OR coalesce(l.last_changed, w.loaded_at + INTERVAL 1 DAY) > m.at""", "corpus", "ledger", "manual_works"))
def needs_measure(spark, sf_dir):
    return cdc.needs_measure(
        b.corpus(spark, sf_dir), _earlier(spark, sf_dir), b.ledger(spark, sf_dir), _manifest(spark, sf_dir)
    )


@check(oracle(f"SELECT DISTINCT work_id FROM {_EARLIER} WHERE work_id NOT IN (SELECT work_id FROM corpus)", "corpus"))
def stale_works(spark, sf_dir):
    return cdc.stale_works(_earlier(spark, sf_dir), b.corpus(spark, sf_dir))


@check(oracle(f"""
    SELECT work_id, CAST(loaded_at AS VARCHAR) AS loaded_at FROM {_EARLIER}
    WHERE work_id IN (SELECT work_id FROM corpus) AND work_id NOT IN (SELECT work_id FROM manual_works)
    UNION ALL SELECT work_id, CAST(loaded_at AS VARCHAR) FROM manual_works WHERE is_self = 1""", "corpus", "manual_works"))
def sync_table(spark, sf_dir):
    """Guest works are measured again too, but yield no row, so their old rows go."""
    earlier, todo = _earlier(spark, sf_dir), b.manual_works(spark, sf_dir)
    fresh = todo.where("is_self = 1").select("work_id", "loaded_at")
    name = f"inkmeter_checks.sync_{uuid.uuid4().hex}"
    keyed.create_keyed(spark, name, earlier.schema, "work_id", 16)
    keyed.replace_keys(spark, name, earlier, earlier.select("work_id"))
    tables.sync_table(spark, name, fresh, todo, cdc.stale_works(earlier, b.corpus(spark, sf_dir)))
    return b.as_text(tables.read_table(spark, name), "loaded_at")


@check("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def delete_where(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    closed = b.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    name = f"inkmeter_checks.lines_{uuid.uuid4().hex}"
    keyed.create_keyed(spark, name, lines.schema, "l_orderkey", 16)
    keyed.replace_keys(spark, name, lines, lines.select("l_orderkey"))
    tables.delete_where(spark, name, closed.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    return tables.read_table(spark, name)


# --- History ------------------------------------------------------------------------------------

# Yesterday's parts: the small ones did not exist, ECONOMY was named otherwise,
# and a few since withdrawn were still there
_OLD_PARTS = """SELECT p_partkey, p_name, CASE WHEN p_type = 'ECONOMY' THEN 'BUDGET' ELSE p_type END AS p_type, p_size
                FROM part WHERE p_size > 5"""
_NEW_PARTS = "SELECT p_partkey, p_name, p_type, p_size FROM part WHERE p_size <= 45"


@check(f"""
    SELECT p_partkey, p_name, p_type, p_size, valid_from, valid_to FROM (
      SELECT o.*, '2024-01-01 00:00:00' AS valid_from,
             CASE WHEN n.p_partkey IS NULL OR n.p_type <> o.p_type THEN '{RUN_TS}' END AS valid_to
      FROM ({_OLD_PARTS}) o LEFT JOIN ({_NEW_PARTS}) n USING (p_partkey)
      UNION ALL
      SELECT n.*, '{RUN_TS}', NULL FROM ({_NEW_PARTS}) n LEFT JOIN ({_OLD_PARTS}) o USING (p_partkey)
      WHERE o.p_partkey IS NULL OR n.p_type <> o.p_type)""")
def scd2(spark, sf_dir):
    part = b.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    old = part.filter("p_size > 5").withColumn(
        "p_type", F.when(F.col("p_type") == "ECONOMY", "BUDGET").otherwise(F.col("p_type"))
    )
    name = f"inkmeter_checks.parts_{uuid.uuid4().hex}"
    spark.sql("CREATE SCHEMA IF NOT EXISTS inkmeter_checks")
    history.snapshot_table(spark, name, old, "p_partkey", "2024-01-01 00:00:00", buckets=16)
    history.snapshot_table(spark, name, part.filter("p_size <= 45"), "p_partkey", RUN_TS)
    return b.as_text(history.read_history(spark, name), "valid_from", "valid_to")


# --- Scalar functions -----------------------------------------------------------------------------


@check(rf"""
    SELECT p_partkey, lower(trim(p_name)) AS folded, replace(p_name, ' ', '-') AS dashed,
           concat_ws(', ', p_brand, CASE WHEN p_size > 25 THEN 'large' END) AS tags,
           CAST(p_name ILIKE '%RED%' AS INT) AS is_red, regexp_extract(p_brand, '([0-9]+)$', 1) AS brand_no,
           string_split(p_name, ' ')[1] AS first_word, coalesce(nullif(p_type, 'SMALL'), 'none') AS size_type,
           CAST(make_date(1990 + p_size, 1, 1) AS VARCHAR) AS made_on, dayofweek(make_date(1990 + p_size, 1, 1)) AS made_dow,
           round(abs(ln(p_retailprice) - 7), 6) AS price_log,
           {duck.key('p_partkey', "nullif(p_type, 'SMALL')")} AS part_key, sha256(p_name) AS name_hash,
           CAST(strptime('2024-01-02 03:04:05', '%Y-%m-%d %H:%M:%S') AS VARCHAR) AS stamped
    FROM part""")
def scalar_kit(spark, sf_dir):
    made = F.make_date(1990 + F.col("p_size"), F.lit(1), F.lit(1))
    return b.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.lower(F.trim("p_name")).alias("folded"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("-")).alias("dashed"),
        F.concat_ws(", ", "p_brand", F.when(F.col("p_size") > 25, "large")).alias("tags"),
        F.col("p_name").ilike("%RED%").cast("int").alias("is_red"),
        F.regexp_extract("p_brand", r"([0-9]+)\z", 1).alias("brand_no"),
        F.split("p_name", " ")[0].alias("first_word"),
        F.coalesce(F.nullif(F.col("p_type"), F.lit("SMALL")), F.lit("none")).alias("size_type"),
        made.cast("string").alias("made_on"),
        (F.dayofweek(made) - 1).cast("bigint").alias("made_dow"),
        F.round(F.abs(F.log("p_retailprice") - 7), 6).alias("price_log"),
        surrogate_key("p_partkey", F.nullif(F.col("p_type"), F.lit("SMALL"))).alias("part_key"),
        F.sha2("p_name", 256).alias("name_hash"),
        F.to_timestamp(F.lit("2024-01-02 03:04:05"), "yyyy-MM-dd HH:mm:ss").cast("string").alias("stamped"),
    )
