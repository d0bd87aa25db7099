"""Access to a folder of Parquet tables, one ``<name>.parquet`` each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import storage


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of ``folder``; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def version(spark: SparkSession, folder: str, name: str) -> str | None:
    """Version of the content of a table: its files, wherever they lie; None where there are none."""
    return storage.version(spark, f"{folder}/{name}.parquet")
