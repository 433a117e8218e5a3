"""The registered queries of this subpackage: opN_<name> and what SQL can say of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_wrapper, jaccard_join, line_rules, mixing, packing, quality_ranker, secret_scan, sentence_pieces, sharding, spelling, suffix_dedup, token_links, topk


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_classes(table(spark, sf_dir, "documents"), n=3, percent=90)


def op2_automaton_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


def op3_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ranker.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_label_propagation_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op5_line_labelling_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, slot of the document's block in the mix and whether the mix schedules it."""
    rows = mixing.schedule(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "source", F.col("_slot").alias("slot"), F.col("_scheduled").alias("scheduled"))


def op7_suffix_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"), length=200)


def op8_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract(table(spark, sf_dir, "pages"))


def op9_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 100 == 0)


def op11_wavelet_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(spelling.word_counts(table(spark, sf_dir, "documents"), deletion=31), least_length=7, least_count=2)


def op12_backtracking_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digest(table(spark, sf_dir, "documents"))


def op13_cross_tokenizer_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_links.alignment(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_parity_sketch_join": op1_parity_sketch_join,
    "op2_automaton_secret_scan": op2_automaton_secret_scan,
    "op3_pairwise_quality": op3_pairwise_quality,
    "op4_label_propagation_sharding": op4_label_propagation_sharding,
    "op5_line_labelling_rules": op5_line_labelling_rules,
    "op6_pfair_mixing": op6_pfair_mixing,
    "op7_suffix_sort_dedup": op7_suffix_sort_dedup,
    "op8_wrapper_extraction": op8_wrapper_extraction,
    "op9_vector_best_fit": op9_vector_best_fit,
    "op10_threshold_top_k": op10_threshold_top_k,
    "op11_wavelet_spelling_variants": op11_wavelet_spelling_variants,
    "op12_backtracking_pieces": op12_backtracking_pieces,
    "op13_cross_tokenizer_links": op13_cross_tokenizer_links,
}

ORACLES = {
    "op10_threshold_top_k": """
        WITH v AS (
            SELECT row_number() OVER () AS k, CAST(vec_id AS BIGINT) AS vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
        ), s AS (
            SELECT q.k, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.k <> c.k WHERE q.vec_id % 100 = 0
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
}
