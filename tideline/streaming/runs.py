"""Starting streams and running them over what has arrived so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tideline.sources.store import is_dir


def parquet_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str = "*.parquet",
    files_per_batch: int = 100,
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def table_stream(
    spark: SparkSession, root: str, name: str, schema: T.StructType, files_per_batch: int = 100
) -> DataFrame:
    """Rows of a table of the given tables, which may be one file or a folder of files."""
    path = f"{root.rstrip('/')}/{name}.parquet"
    if is_dir(spark, path):
        return parquet_stream(spark, path, schema, files_per_batch=files_per_batch)
    return parquet_stream(spark, root, schema, f"{name}.parquet", files_per_batch)


def text_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """One message per line; folders in the path pattern are read too."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)


def append_available(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append everything that has arrived to a Parquet folder, then stop.

    Run again with the same checkpoint it continues where it left off.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def each_batch_available(stream: DataFrame, handle, checkpoint: str) -> None:
    """Hand everything that has arrived to ``handle(batch, batch_id)``, then stop."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
