"""Exact duplicates by content sort, in DataFrame functions alone.

Every text is normalised once and written, with a bounded prefix and a 64-bit hash, to the shared folder. Sampled splitters
(repartitionByRange) deal the rows out by prefix and hash, so that equal texts meet in one partition whatever their ids;
the external sort of the window places them next to each other, each text is compared in full with its neighbour before
it, and the least id of a run of equals is carried along the run. The hash only shortens the comparisons of the sort.

Texts whose copies are too many for one task are found beforehand by sums per hash, taken per task before the shuffle.
Their rows, and theirs alone, get a salt as a last sort key, which cuts the run into slices; a slice ends as one row, and
the rows of a text's slices are brought together by a second sort that compares the texts in full again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm._common import cut, discard, shuffle_partitions

#: Characters of a text that the splitters see; slices that an average partition would hold; rows and bytes that a slice always may have.
PREFIX, SLICES, LEAST_ROWS, LEAST_BYTES = 48, 4, 100, 100_000
#: What the normalisation changes: any white space but a single space.
_CHANGES = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, norm, prefix, h, size, text_sha256 of each row."""
    rows = docs.select(F.col(id_col).alias("id"), F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), _CHANGES, " ").alias("norm"))
    return rows.select("id", "norm", F.substring("norm", 1, PREFIX).alias("prefix"), F.xxhash64("norm").alias("h"), F.octet_length("norm").alias("size"), F.sha2("norm", 256).alias("text_sha256"))


def hot(rows: DataFrame, least_rows: int = LEAST_ROWS, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """h and slices of each text whose copies hold more than a slice.

    A slice is 1 / SLICES of the rows, or of the bytes, that a shuffle partition has on average; so at most 2 * SLICES texts
    for each shuffle partition are hot, of however many rows.
    """
    parts = SLICES * shuffle_partitions(rows.sparkSession)
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    bytes_, n = max(least_bytes, total[0] // parts), max(least_rows, total[1] // parts)
    sums = rows.groupBy("h").agg(F.sum("size").alias("b"), F.count("*").alias("c")).where((F.col("c") > 1) & ((F.col("b") > bytes_) | (F.col("c") > n)))
    return sums.select("h", F.least("c", F.greatest(F.col("b") / bytes_, F.col("c") / n) + 1).cast("int").alias("slices"))


def neighbours(rows: DataFrame, hot_texts: DataFrame) -> DataFrame:
    """id, text_sha256, norm (of a slice's first row, if salted), salt, first, least and n of the slice that each row lies in.

    A row starts a run if its text differs from that of the row before it.
    """
    dealt = rows.join(F.broadcast(hot_texts), "h", "left").withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.col("slices")))
    placed = dealt.repartitionByRange("prefix", "h", "salt")
    run = ["prefix", "h", "salt"]
    w = Window.partitionBy(*run).orderBy("norm", F.asc_nulls_last("id"))
    seen = placed.select("*", (~F.lag("norm").over(w).eqNullSafe(F.col("norm"))).alias("first"))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    carried = seen.select(
        "id", "text_sha256", *run, "first", F.when(F.col("first") & F.col("salt").isNotNull(), F.col("norm")).alias("norm"),
        F.last(F.when(F.col("first"), F.struct("id")), ignorenulls=True).over(upto).alias("least"), F.count_if("first").over(upto).alias("k"),
    )
    return carried.select("id", "text_sha256", "norm", "salt", "first", "least", F.count("*").over(Window.partitionBy(*run, "k")).alias("n"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_rows: int = LEAST_ROWS, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """One row per row of docs: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of white space becomes one space; a null text counts as empty, empty
    texts equal each other. Rows that repeat an id with the same text share one decision. A null id is never the kept one
    unless its group has no other; then keep_id is null and kept true. An empty table gives no rows; other columns are
    ignored.
    """
    rows, at = cut(normalised(docs, id_col, text_col), "normalised")
    found, _ = cut(neighbours(rows, hot(rows, least_rows, least_bytes)), "neighbours")
    discard(docs.sparkSession, at)
    slices = found.where("first and salt is not null").select("norm", "text_sha256", "n", F.when(F.col("least.id").isNotNull(), F.col("least")).alias("least"))
    # a minimum over a struct makes the planner sort the slices and compare neighbours
    whole = slices.groupBy("norm").agg(F.min("least").alias("least"), F.sum("n").alias("group_size"), F.first("text_sha256").alias("text_sha256"))
    whole = F.broadcast(whole.select("text_sha256", F.struct("least", "group_size").alias("whole")))  # a row for each hot text
    easy = found.where("salt is null").select("id", F.col("least.id").alias("keep_id"), F.col("n").alias("group_size"), "text_sha256")
    hard = found.where("salt is not null").join(whole, "text_sha256").select("id", F.col("whole.least.id").alias("keep_id"), F.col("whole.group_size").alias("group_size"), "text_sha256")
    out = easy.unionByName(hard)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


SQL = r"""
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
WINDOW w AS (PARTITION BY text_sha256)
"""
