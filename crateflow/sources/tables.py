"""Parquet table access by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table of this name in the folder. Column pruning and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
