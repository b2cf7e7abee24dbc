"""Streams (S1, C7) through the same operators as tables.

Masks and filters are stateless, so a protected stream is ``protect`` applied to every
micro-batch. It runs inside ``foreachBatch`` so that the controls and the entitlement
subqueries are resolved anew for each batch (a changed entitlement applies from the next
batch on). Each batch is written to a folder named by its epoch with overwrite: a batch
replayed after a failure replaces its own output instead of appending twice, which
together with the checkpointed source offsets gives exactly-once output files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def file_stream(spark: SparkSession, folder: str, file_glob: str, schema, max_files: int | None = None) -> DataFrame:
    """A parquet file source over ``folder`` restricted to files matching ``file_glob``."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema, max_files: int | None = None) -> DataFrame:
    """The stream of a driver table, which may be one file or a folder of files. The braces make the
    path a pattern, as the source takes no single file by its plain path."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(f"{sf_dir.rstrip('/')}/{{{name}}}.parquet")


def run_per_batch(stream: DataFrame, build: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> DataFrame:
    """Run ``build`` on every micro-batch until the source is drained (availableNow) and
    return the written result as a batch DataFrame."""
    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        build(batch).write.mode("overwrite").parquet(f"{sink}/epoch={epoch_id}")

    q = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    spark = stream.sparkSession
    return spark.read.option("basePath", sink).parquet(sink).drop("epoch")


def run_aggregate(agg_stream: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """A streaming aggregate in complete mode: its state lives in the checkpointed state
    store; each trigger rewrites the (small) full result. Returns the final result."""
    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink)

    q = (agg_stream.writeStream.outputMode("complete").foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return agg_stream.sparkSession.read.parquet(sink)
