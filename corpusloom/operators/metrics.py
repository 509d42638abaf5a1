"""Distribution figures from counts per distinct value, summed in order range by range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import cut


#: Ranges of values that are summed apart.
RANGES = 64


def by_index(df: DataFrame, groups: list[str], value: str, indices: dict[str, Column]) -> DataFrame:
    """groups and for each name the value at an index (from 0) of the group's sorted numeric values. Indices may use column n (rows).

    The distinct values are counted; sums over RANGES of about as many values each say what lies before a range, and within
    a range the counts are summed in order. So a task holds a range of one group and never all values. Nulls are left out.
    """
    counted, _ = cut(df.where(F.col(value).isNotNull()).groupBy(*groups, F.col(value).alias("_v")).agg(F.count("*").alias("_c")), "counted")
    bounds = counted.agg(F.percentile_approx("_v", [k / RANGES for k in range(1, RANGES)]).alias("b")).first()["b"] or []
    ranged = counted.withColumn("_r", sum((F.col("_v") > b).cast("int") for b in sorted(set(bounds))) + F.lit(0))
    by_group = [F.col(g) for g in groups]
    sums = ranged.groupBy(*groups, "_r").agg(F.sum("_c").alias("_s"))
    every = Window.partitionBy(*by_group) if groups else Window.partitionBy(F.lit(0))  # a group's ranges: RANGES rows at most
    sums = sums.select(*groups, "_r", F.sum("_s").over(every).alias("n"), (F.sum("_s").over(every.orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_s")).alias("_before"))
    on = F.lit(True)
    for g in [*groups, "_r"]:
        on = on & F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    joined = ranged.alias("a").join(sums.alias("b"), on).select(*[F.col(f"a.{g}").alias(g) for g in groups], "a._r", "_v", "_c", "n", "_before")
    w = Window.partitionBy(*by_group, "_r").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = joined.withColumn("_upto", F.col("_before") + F.sum("_c").over(w))
    return placed.groupBy(*groups).agg(F.first("n").alias("n"), *[F.min(F.when(F.col("_upto") > i, F.col("_v"))).alias(name) for name, i in indices.items()])


def quantile_index(q: float) -> Column:
    return F.least(F.col("n") - 1, F.floor(F.col("n") * F.lit(q)))


def upper_median() -> Column:
    return F.floor(F.col("n") / 2)


def ab_rank(scored: DataFrame) -> DataFrame:
    """provider, mean, elapsed, n; a null score counts as none, its time counts all the same."""
    return scored.groupBy("provider").agg(F.round(F.avg(F.coalesce("score", F.lit(0))), 6).alias("mean"), F.round(F.avg("elapsed"), 6).alias("elapsed"), F.count("*").alias("n"))


def by_position(rows: DataFrame, tag: str, tags: list[str], key: str) -> DataFrame:
    """place and for each tag the key of its row at that place, in order of key, as far as the shortest tag goes."""
    ranged, _ = cut(rows.where(F.col(tag).isin(*tags)).select(F.col(tag).alias("tag"), F.col(key).alias("key")).repartitionByRange("key").withColumn("part", F.spark_partition_id()), "ranged")
    w = Window.partitionBy("tag").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    before = ranged.groupBy("tag", "part").agg(F.count("*").alias("c")).select("tag", "part", F.coalesce(F.sum("c").over(w), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("tag", "part").orderBy("key"))
    numbered = ranged.withColumn("own", own).join(before, ["tag", "part"]).select("tag", "key", (F.col("before") + F.col("own") - 1).alias("place"))
    wide = numbered.groupBy("place").agg(*[F.max(F.when(F.col("tag") == x, F.col("key"))).alias(x) for x in tags])
    return wide.dropna(subset=tags)
