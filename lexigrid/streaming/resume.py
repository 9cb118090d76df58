"""Work in batches that can be taken up again: what is done is known from the results, which are appended batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def remaining(todo: DataFrame, done: DataFrame | None, key: str = "id") -> DataFrame:
    return todo if done is None else todo.join(done.select(key).distinct(), key, "left_anti")


def run_stream(source: DataFrame, work: object, out: str, checkpoint: str, key: str = "id") -> object:
    """Each micro-batch goes through `work` and is appended once: keys that out already has are left out, so a batch may run again."""

    def write(batch: DataFrame, number: int) -> None:
        spark: SparkSession = batch.sparkSession
        try:
            done = spark.read.parquet(out)
        except Exception as missing:  # the first batch
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            done = None
        work(remaining(batch, done, key)).write.mode("append").parquet(out)

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
