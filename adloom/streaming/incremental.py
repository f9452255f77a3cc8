"""Incremental batches: files that come in are processed once, rows whose key is known are left out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.operators.upsert import insert_absent
from adloom.sources.tables import exists


def pending(todo: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key isn't among those done."""
    return todo.join(done.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def process_new_files(spark: SparkSession, source: str, schema: str, work: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, files_a_batch: int = 100) -> None:
    """Run `work` on files that weren't there last time and append the result, each file exactly once; then stop."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).json(source).where(F.col("id").isNotNull())
    work(stream).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def collect_daily(spark: SparkSession, source: str, schema: str, master: str, checkpoint: str, key: str, order: str) -> None:
    """Append ads of new files to the master table unless their key is there, first row of a key in a batch."""

    def add(batch: DataFrame, number: int) -> None:
        # only the master's first batch finds none; a master that can't be read is an error, or every known ad would come again
        known = spark.read.parquet(master) if exists(spark, master) else spark.createDataFrame([], batch.schema)
        insert_absent(known, batch, key, F.col(order)).select(batch.columns).write.mode("append").parquet(master)

    spark.readStream.schema(schema).json(source).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def first_seen(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """A stream's rows without those whose key came before; the state of a key is dropped once the watermark has passed it."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
