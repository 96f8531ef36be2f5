"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import ship


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table `name`, one Parquet file or a folder of them; columns and filters of later
    steps are pushed into this scan by the optimizer."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
