"""Aggregates with a stated rule for ties and even counts, pre-aggregated by value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upper_median(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """by, n, least, upper_median, most: of an even count the upper of the two middle values.
    Nulls are left out. Only the counts of distinct values are sorted."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    window = Window.partitionBy(*by)
    upto = F.sum("_n").over(window.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.withColumns({"_upto": upto, "_all": F.sum("_n").over(window)})
    middle = F.min(F.when(F.col("_upto") > F.floor(F.col("_all") / 2), F.col("_v")))
    return placed.groupBy(*by).agg(F.sum("_n").alias("n"), F.min("_v").alias("least"), middle.alias("upper_median"), F.max("_v").alias("most"))


def most_common(df: DataFrame, by: Sequence[str], value: Column, first: str) -> DataFrame:
    """by, value, n: the most frequent value of each group; of equally frequent ones that whose
    least `first` is smallest, i.e. which is seen first. Nulls are left out."""
    counted = df.withColumn("_v", value).where("_v is not null").groupBy(*by, "_v").agg(F.count("*").alias("n"), F.min(first).alias("_first"))
    return counted.groupBy(*by).agg(F.max_by(F.struct("_v", "n"), F.struct("n", -F.col("_first"))).alias("_b")).select(*by, F.col("_b._v").alias("value"), F.col("_b.n").alias("n"))


def characters(df: DataFrame, by: Sequence[str], text: str, wanted: str) -> DataFrame:
    """by, character, n: how often each character of a regular-expression class occurs. Only the
    wanted characters of a text leave its row."""
    only = F.regexp_extract_all(F.col(text), F.lit(f"({wanted})"), F.lit(1))
    return df.select(*by, F.explode(only).alias("character")).groupBy(*by, "character").agg(F.count("*").alias("n"))


def ordered_text(df: DataFrame, by: Sequence[str], order: Sequence[str], text: str, separator: str) -> DataFrame:
    """by, text: the texts of each group in order, nulls left out. A group is one document, e.g.
    a chapter, and has to fit into a row."""
    held = df.where(F.col(text).isNotNull()).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_t")))).alias("_l"))
    return held.select(*by, F.array_join(F.col("_l._t"), separator).alias("text"))
