"""Sources other than tables: documents, line records, word boxes, caption texts, page files, profiles."""

from __future__ import annotations

import tomllib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the word tables that OCR programs write, in their order.
WORD_COLUMNS = "level page_num block_num par_num line_num word_num left top width height conf text".split()


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row for each JSON file, with its path."""
    return spark.read.schema(schema).json(path, multiLine=True).withColumn("path", F.col("_metadata.file_path"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row for each line that is not blank; a line that is no JSON is an error."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def ocr_words(spark: SparkSession, path: str) -> DataFrame:
    """Words of OCR tables (tab-separated): only word rows with all columns and a text; boxes get
    their right and bottom edges."""
    kinds = ", ".join(f"`{c}` {'string' if c == 'text' else 'double' if c == 'conf' else 'int'}" for c in WORD_COLUMNS)
    rows = spark.read.schema(kinds).csv(path, sep="\t", header=True, quote="", mode="PERMISSIVE")
    kept = rows.where((F.col("level") == 5) & (F.trim("text") != ""))
    return kept.withColumns({"right": F.col("left") + F.col("width"), "bottom": F.col("top") + F.col("height"), "path": F.col("_metadata.file_path")})


def texts(spark: SparkSession, path: str) -> DataFrame:
    """path, text: one row for each text file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def page_files(spark: SparkSession, path: str, pattern: str = "*.png") -> DataFrame:
    """path, page, size_bytes, sha256 of page files, numbered by the digits before their suffix;
    files without digits have no page. An empty folder gives no rows."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    number = F.regexp_extract("path", r"(\d+)\.[A-Za-z]+$", 1).try_cast("int")
    return files.select("path", number.alias("page"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))


def without_done(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The wanted rows that are not done yet: what a resumed pass has left."""
    return wanted.join(done.select(*keys).distinct(), keys, "left_anti")


def profile(path: str, defaults: Mapping) -> dict:
    """A TOML profile over defaults, section by section."""
    with open(path, "rb") as file:
        given = tomllib.load(file)
    out = {k: dict(v) if isinstance(v, Mapping) else v for k, v in defaults.items()}
    for key, value in given.items():
        out[key] = {**out.get(key, {}), **value} if isinstance(value, Mapping) else value
    return out
