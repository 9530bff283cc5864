"""Every operator of the package as a query over the given tables, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmeter.llm import (
    exact,
    imatch,
    importance,
    langid,
    mining,
    mixture,
    near,
    pii,
    ppm,
    sentence,
    sharding,
    substring,
    variants,
)
from inkmeter.llm.staging import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.mark_exact(table(spark, sf_dir, "documents"))


def op2_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_edits(table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.mark_near(table(spark, sf_dir, "documents"))


def op4_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mark_mix(table(spark, sf_dir, "documents"))


def piece_file() -> str:
    """The public SentencePiece file of this machine; any other path may be given instead."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_sentencepiece(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence.with_ids(docs, path or piece_file(), check=True).drop("text")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(table(spark, sf_dir, "documents"), "doc_id")
    return placed.select("doc_id", "slot", "shard")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.mark_personal(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return importance.Importance(docs, labels).marked()


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mining.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_imatch_fingerprints": op2_imatch_fingerprints,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_ppm_scores": op4_ppm_scores,
    "op5_mixing": op5_mixing,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_sharding": op7_sharding,
    "op8_personal_data": op8_personal_data,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_importance_resampling": op10_importance_resampling,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_language_id": op12_language_id,
    "op13_spelling_variants": op13_spelling_variants,
}

FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op1_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({FOLDED}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
                   list_inner_product(a.q, b.q)::BIGINT AS score
            FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE alike
            QUALIFY row_number() OVER (
                PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT anchor_id, positive_id,
               (row_number() OVER (PARTITION BY anchor_id, positive_id
                                   ORDER BY score DESC, other_id))::INT AS rank,
               other_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT alike AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
        QUALIFY rank <= 10""",
}
