"""One place for session defaults; a cluster's own settings always win."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.driver.memory", os.environ.get("CORPUSLOOM_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> SparkSession:
    """Give this package to the Python workers of a session, once, as a zip that Spark itself distributes."""
    import shutil
    import tempfile
    from pathlib import Path

    context = spark.sparkContext
    if getattr(context, "_corpusloom_shipped", None) != context.applicationId:
        here = Path(__file__).resolve().parent
        with tempfile.TemporaryDirectory() as at:
            shutil.copytree(here, f"{at}/in/corpusloom", ignore=shutil.ignore_patterns("__pycache__"))
            into = tempfile.mkdtemp(prefix="corpusloom-package-")
            context.addPyFile(shutil.make_archive(f"{into}/corpusloom_package", "zip", f"{at}/in"))
        context._corpusloom_shipped = context.applicationId
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the context's own checkpoint folder.

    Where neither is set, a local session gets a temporary folder; a cluster gets an error, since each of its machines would
    write to a disk of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="corpusloom-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def cut(df: DataFrame, label: str = "cut") -> tuple[DataFrame, str]:
    """Write df as Parquet into the shared folder and read it again: its lineage ends there, and a lost executor costs nothing."""
    path = f"{shared_dir(df.sparkSession)}/corpusloom-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete what cut() wrote, once nothing reads it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def spread(df: DataFrame) -> DataFrame:
    """df, dealt out over the cores if it is read in fewer parts than there are cores; a table of many parts stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
