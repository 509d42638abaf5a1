"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import cut, discard, shared_dir, ship_package, spread

__all__ = ["cut", "discard", "fresh", "packed", "shared_dir", "shipped", "shuffle_partitions", "spread", "table", "unpacked"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data set; only Spark's readers touch the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped(df: DataFrame) -> DataFrame:
    """df, once the workers of its session have this package."""
    ship_package(df.sparkSession)
    return df


def packed(df: DataFrame, *without: str, **columns: Column) -> DataFrame:
    """df's rows, without some columns, as one column, row, beside columns of our own, which so can't clash with df's."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in without]
    return df.select((F.struct(*kept) if kept else F.struct(F.lit(None).alias("none"))).alias("row"), *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame, columns: list[str], **own: Column) -> DataFrame:
    """The columns of row again, in their order, each replaced by one of own of its name; the others of own follow."""
    taken = {n.lower(): n for n in own}
    kept = [own[taken[c.lower()]].alias(c) if c.lower() in taken else F.col("row").getField(c).alias(c) for c in columns]
    held = {c.lower() for c in columns}
    return df.select(*kept, *[c.alias(n) for n, c in own.items() if n.lower() not in held])


def fresh(df: DataFrame, name: str) -> str:
    """name, or where df has such a column, name with as many underscores before it as make it new."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name = "_" + name
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
