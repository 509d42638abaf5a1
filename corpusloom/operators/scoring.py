"""Scores from names, for data without a model; what is still to be scored; selection; and the split. chat.py asks models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import cut

GENRES = ("深度评论", "新闻报道", "访谈", "软文广告", "拼盘杂烩")
TOPICS = ("科技", "商业", "社会", "消费", "财经", "其他")


def _digit(k: int):
    return F.conv(F.substring(F.md5(F.col("name").cast("binary")), k, 1), 16, 10).cast("int")


def stub_scores(docs: DataFrame) -> DataFrame:
    """depth, evidence, genre, topic, file, chars from the digits of the name's MD5."""
    return docs.select(
        (_digit(1) % 5 + 1).alias("depth"),
        (_digit(2) % 5 + 1).alias("evidence"),
        F.element_at(F.array(*map(F.lit, GENRES)), _digit(3) % 5 + 1).alias("genre"),
        F.element_at(F.array(*map(F.lit, TOPICS)), _digit(4) % 6 + 1).alias("topic"),
        F.col("name").alias("file"),
        F.col("n").cast("int").alias("chars"),
    )


def todo(docs: DataFrame, done: DataFrame, key: str = "name", done_key: str = "file") -> DataFrame:
    """docs not yet scored."""
    return docs.join(done.select(F.col(done_key).alias(key)).distinct(), key, "left_anti")


def select_core(scores: DataFrame) -> DataFrame:
    return scores.where((F.col("depth") >= 4) & F.col("genre").isin("深度评论", "访谈"))


def supplement(scores: DataFrame, target: int, ideal: int = 3500) -> DataFrame:
    """The best of the second tier, as many as the core lacks of the target."""
    core = select_core(scores).agg(F.count("*").alias("core"))
    pool = scores.where((F.col("depth") == 3) & (F.col("evidence") >= 4) & (F.col("genre") == "深度评论"))
    need = max(0, target - core.first()[0])
    return pool.withColumn("distance", F.abs(F.col("chars") - ideal)).orderBy(F.desc("evidence"), "distance", "file").limit(need).drop("distance")


def limit_n(docs: DataFrame, n: int, order: str = "name") -> DataFrame:
    """The first n by name; 0 means all."""
    return docs.orderBy(order).limit(n) if n else docs


#: Rows with one hash prefix that are few enough to be looked at by the next longer prefix alone.
FEW = 10_000


def split(records: DataFrame, key: str, seed: str = "42", share: float = 0.05) -> DataFrame:
    """records with split: the first max(1, share x n) by a seeded hash of key are val; of an empty table none.

    Counts per hash prefix, at most 65,536 at a time, find the border, so that no task ever orders rows. Of the rows that
    share the border's hash, those of repeated keys, the first in order of reading make up the number.
    """
    own = records.withColumn("_h", F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")).cast("binary")))
    n = own.count()
    need = max(1, int(n * share)) if n else 0
    at, border = need, ""  # of the rows whose hash begins with border, at many are val
    while need and len(border) < 32:
        counts = own.where(F.startswith("_h", F.lit(border))).groupBy(F.substring("_h", 1, len(border) + 4).alias("p")).agg(F.count("*").alias("c"), F.min("_h").alias("least"), F.max("_h").alias("most"))
        for row in sorted(counts.collect(), key=lambda r: r.p):
            border, tied, only = row.p, row.c, row.least == row.most
            if at <= row.c:
                break
            at -= row.c
        if only:
            border = row.least
    side = F.when(F.col("_h") <= F.lit(border), "val").otherwise("train")
    if not need or at == tied:
        return own.withColumn("split", side).drop("_h")
    tie, _ = cut(own.where(F.col("_h") == border).withColumn("_row", F.monotonically_increasing_id()), "tie")
    part, place = F.shiftright("_row", 33), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    for row in sorted(tie.groupBy(part.alias("p")).agg(F.count("*").alias("c")).collect(), key=lambda r: r.p):
        if at <= row.c:
            break
        at -= row.c
    tie = tie.withColumn("split", F.when((part < row.p) | ((part == row.p) & (place < at)), "val").otherwise("train")).drop("_row", "_h")
    return own.where(F.col("_h") != border).withColumn("split", side).drop("_h").unionByName(tie)


def latest(log: DataFrame, key: str, order: list) -> DataFrame:
    """Of each key the row that order, ascending Columns, puts last. One pass that sums up in each task first."""
    rows = log.select(F.col(key).alias("_key"), F.struct(*order).alias("_order"), F.struct(*log.columns).alias("_row"))
    return rows.groupBy("_key").agg(F.max_by("_row", "_order").alias("_row")).select("_row.*")
