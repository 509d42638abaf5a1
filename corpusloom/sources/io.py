"""Sources and sinks of the corpus: Markdown folders, JSON lines and arrays, prioritised unions, topics, append logs, catalogs."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import safe_topic, strip
from corpusloom.session import ship_package

ALPACA = "instruction string, input string, output string, teacher string"
SCORE = "depth int, evidence int, genre string, topic string, file string, chars int"
PROVENANCE = "split string, source string, teacher string, input_head string"
GENERATION = "idx int, input string, reference string, generated_raw string, generated_article string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship_package(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def markdown(spark: SparkSession, folder: str) -> DataFrame:
    """name, text of each *.md file; invalid UTF-8 is dropped, line ends become line feeds."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(folder)
    bad, held = F.lit("\ufffd"), F.lit("\ufdd0")  # what marks invalid bytes, and a stand-in for those marks that the file itself has
    text = F.make_valid_utf8(F.replace(F.col("content").cast("string"), bad, held))
    text = F.replace(F.replace(text, bad, F.lit("")), held, bad)
    return raw.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.regexp_replace(text, "\r\n?", "\n").alias("text"))


def json_lines(spark: SparkSession, path: str, schema: str = ALPACA, strict: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)


def json_array(spark: SparkSession, path: str, schema: str = GENERATION) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def union_sources(parts: list[tuple[DataFrame, str, int]]) -> DataFrame:
    """All rows with their source and priority; columns that a part lacks are null."""
    out = None
    for k, (df, source, priority) in enumerate(parts):
        own = df.withColumns({"source": F.lit(source), "priority": F.lit(priority), "source_order": F.lit(k)})
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def json_sources(spark: SparkSession, sources: list[tuple[str, str, int]], schema: str = ALPACA) -> DataFrame:
    """Rows of all (path or glob, source, priority); sources without any file are passed over, and without rows the result is empty."""
    parts = []
    for path, source, priority in sources:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where):
            parts.append((json_lines(spark, path, schema), source, priority))
    return union_sources(parts or [(spark.createDataFrame([], schema), "", 0)])


def topics(spark: SparkSession, path: str) -> DataFrame:
    """Topics without blanks and comments, with their line number in each file's order of reading."""
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), strip(F.col("value")).alias("topic"))
    return rows.where((F.col("topic") != "") & ~F.col("topic").startswith("#"))


def first_topic(spark: SparkSession, path: str) -> DataFrame:
    return topics(spark, path).orderBy("line").limit(1).select("topic")


def prompt(spark: SparkSession, path: str) -> Column:
    return F.lit(spark.read.text(path, wholetext=True).first()[0].strip())


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_documents(df: DataFrame, path: str, key: str = "name", text: str = "text") -> None:
    """A folder of documents by name: one row each, for what would else be a file each."""
    df.select(key, text).write.mode("overwrite").parquet(path)


def _versions(spark: SparkSession, root: str) -> list[int]:
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/v*")
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) or []
    return sorted(int(s.getPath().getName()[1:]) for s in found)


def write_version(df: DataFrame, root: str) -> int:
    """Write df beside the versions before it, which stay as they are; the new version's number. So a rewrite needs no backup."""
    version = max(_versions(df.sparkSession, root), default=0) + 1
    df.write.parquet(f"{root.rstrip('/')}/v{version}")
    return version


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A version, the newest unless one is named."""
    return spark.read.parquet(f"{root.rstrip('/')}/v{version or max(_versions(spark, root))}")


def write_generations(rows: DataFrame, root: str, stamp: str) -> None:
    """Raw replies and records of generations (topic, reply, instruction, input, output) under one key: the safe topic and a stamp."""
    keyed = rows.withColumn("key", F.concat(safe_topic(F.col("topic")), F.lit("_" + stamp)))
    keyed.select("key", "reply").write.mode("append").parquet(f"{root}/raw")
    keyed.where("output is not null").select("key", "instruction", "input", "output").write.mode("append").json(f"{root}/records")


def report(tables: dict[str, DataFrame], most: int = 1000) -> str:
    """Aggregated tables as Markdown, the first most rows of each in their order."""
    out = []
    for title, df in tables.items():
        rows = df.limit(most).collect()
        out += [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if x is None else str(x).replace("|", "\\|") for x in r) + " |" for r in rows] + [""]
    return "\n".join(out)


def dataset_info(entries: dict[str, str]) -> str:
    """The catalog of data sets as JSON: name -> file."""
    columns = {"prompt": "instruction", "query": "input", "response": "output"}
    return json.dumps({k: {"file_name": v, "columns": columns} for k, v in entries.items()}, ensure_ascii=False, indent=2)
