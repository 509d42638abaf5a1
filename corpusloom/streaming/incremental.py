"""Incremental scoring: a file stream, each name once; restarts go on where the checkpoint ended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run(spark: SparkSession, folder: str, schema, transform, out: str, checkpoint: str, key: str = "name", done_key: str = "file") -> DataFrame:
    """Process all files that are there and not yet done; the whole log afterwards.

    Each batch is written to a folder of its own number, which a retried batch writes anew, so that no row is there twice.
    What is done is read from the log of the batches before, so that the stream keeps no state.
    """

    def process(df: DataFrame, number: int) -> None:
        todo = df.dropDuplicates([key])
        before = [f"{out}/batch={k}" for k in range(number)]
        if before:
            done = spark.read.parquet(*before).select(done_key).withColumnRenamed(done_key, key)
            todo = todo.join(done, key, "left_anti")
        transform(todo).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(folder)
    query = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(out).drop("batch")
