"""Structured Streaming: work through what is new, and take up again where a run stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_available(spark: SparkSession, source: str, schema, target: str, checkpoint: str, change: Callable[[DataFrame], DataFrame] = lambda df: df, files_per_trigger: int | None = None) -> int:
    """Reads the Parquet files that are new in a folder, changes them, appends the result and ends; the number of rows read.

    A second run reads only files that were added since; after a failure the checkpoint lets the batch be done again without doubling rows.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    query = change(reader.parquet(source)).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(int(p["numInputRows"]) for p in query.recentProgress)
