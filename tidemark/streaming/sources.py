"""File streams over table folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.storage import is_directory


def table_stream(
    spark: SparkSession, folder: str, table: str, schema: str, files_per_batch: int | None = None
) -> DataFrame:
    """A stream over ``<folder>/<table>.parquet``, be it a folder of files or a single file."""
    path = f"{folder.rstrip('/')}/{table}.parquet"
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if is_directory(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{table}.parquet").parquet(folder)
