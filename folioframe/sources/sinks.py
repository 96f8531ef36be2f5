"""Sinks: what is written is whole or absent, by Spark's commit protocol."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_lines(df: DataFrame, path: str) -> None:
    """One JSON object a line; nulls are left out."""
    df.write.mode("overwrite").json(path)


def texts_by(df: DataFrame, path: str, by: Sequence[str], text: str) -> None:
    """A text for each row, in a folder for each value of `by`."""
    df.select(*by, F.col(text).cast("string").alias("value")).write.mode("overwrite").partitionBy(*by).text(path)


def table(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """A Parquet table, in folders by `by` so that readers can prune them."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def provenance(df: DataFrame, **facts: str) -> DataFrame:
    """One row on a table: its rows, columns and a digest of its schema, beside given facts."""
    shape = ", ".join(f"{n} {k}" for n, k in df.dtypes)
    return df.agg(F.count("*").alias("rows")).select("rows", F.lit(len(df.columns)).alias("columns"), F.sha2(F.lit(shape), 256).alias("schema_sha256"), *[F.lit(v).alias(k) for k, v in facts.items()])
