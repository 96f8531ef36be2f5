"""Texts as lines, pages and marked parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD_LINES = 9  # lines of a page among which its running head stands


def pages(df: DataFrame, keys: Sequence[str], text: str, first: int = 1) -> DataFrame:
    """keys, page, text: a text split at form feeds, pages numbered from `first`. A null text has none."""
    return df.where(F.col(text).isNotNull()).select(*keys, F.posexplode(F.split(F.col(text), "\f")).alias("_i", "text")).select(*keys, (F.col("_i") + first).alias("page"), "text")


def lines(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """keys, line_no, line: the lines of a text from 1 on; a line end at the very end starts no
    further line. A null text has none, an empty one neither."""
    ended = F.regexp_replace(F.col(text), "\\n\\z", "")
    return df.where(F.length(text) > 0).select(*keys, F.posexplode(F.split(ended, "\n")).alias("_i", "line")).select(*keys, (F.col("_i") + 1).alias("line_no"), "line")


def without_chrome(df: DataFrame, keys: Sequence[str], head: Column) -> DataFrame:
    """Lines (keys, line_no, line) without a page's running head: of the first HEAD_LINES lines
    those that are blank or match `head`, up to the first that is neither. Adds `chrome`, whether
    the line belongs to the head, instead of dropping it."""
    blank = F.trim(F.col("line")) == ""
    content = F.when(~(blank | head) | (F.col("line_no") > HEAD_LINES), F.col("line_no"))
    first = F.min(content).over(Window.partitionBy(*keys))
    return df.withColumn("chrome", ~blank & (F.col("line_no") < F.coalesce(first, F.lit(HEAD_LINES + 1))) & head)


def repeated_lines(df: DataFrame, line: str, least: int) -> DataFrame:
    """shape, n: lines that, their numbers taken out, stand in at least `least` rows: running
    heads and footers. Blank lines and those of numbers alone have the shape `#`."""
    shape = F.trim(F.regexp_replace(F.regexp_replace(F.col(line), "[0-9]+", "#"), "\\s+", " "))
    return df.select(shape.alias("shape")).where("shape <> ''").groupBy("shape").agg(F.count("*").alias("n")).where(F.col("n") >= least)
