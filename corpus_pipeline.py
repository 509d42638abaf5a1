"""A cleaned and encoded corpus from documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of documents. Null and
empty texts, repeated rows and empty tables are treated as the operator of each stage says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe, decontaminate, line_dedup, quality, simhash
from corpusloom.llm._common import cut, discard, fresh, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a quality score below the threshold go. The model learns from the documents that the stage is given."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "score")
    return quality.score(docs, model, into=score).where(F.col(score) >= quality.THRESHOLD).select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source go from every text; n_chars follows. Every document stays."""
    lines, removed = fresh(docs, "n_lines"), fresh(docs, "n_removed")
    out = line_dedup.drop_lines(docs, n_lines=lines, n_removed=removed)
    return out.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest id stays."""
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe.encode(docs, with_ids=False)


STAGES = [
    ("quality classifier", classify),
    ("line dedup", drop_lines),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", drop_benchmark),
    ("byte-level bpe", encode),
]

#: SQL can't express the classifier, the fingerprints or the walk; tests/llm holds run() against a plain Python pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read by the next."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, at = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:
            discard(spark, before)
        before = at
    return STAGES[-1][1](spark, docs, sf_dir)
