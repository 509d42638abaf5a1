"""The contract's query for each operator, over whole tables with production parameters; SQL where it can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe, decontaminate, exact_dedup, html_text, line_dedup, pii, quality, sharding, simhash, suffix_dedup
from corpusloom.llm._common import spread, table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def op1_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")), columns=["doc_id"])
    predicted = F.when(F.col("_score") >= quality.THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", quality.held_out().alias("held_out"), F.col("_score").alias("score"), predicted.alias("predicted"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir), with_kept=False)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_lines(documents(spark, sf_dir))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), kept)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), with_ids=False)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op7_tag_path_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spread(table(spark, sf_dir, "pages"))).select("page_id", "url", "text", "n_chars")


def op8_size_tiered_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, version = sharding.shard(documents(spark, sf_dir))
    return store.read(version).select("doc_id", F.col("_shard").alias("shard"), F.lit(version).alias("version"), "_shard_bytes", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op9_content_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op10_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_neighbour_quality,
        op2_simhash_near_dedup,
        op3_suffix_array_dedup,
        op4_line_dedup,
        op5_byte_bpe,
        op6_benchmark_decontamination,
        op7_tag_path_html,
        op8_size_tiered_shards,
        op9_content_sort_dedup,
        op10_weak_supervision_pii,
    )
}
SQL = {"op4_line_dedup": line_dedup.SQL, "op9_content_sort_dedup": exact_dedup.SQL}
