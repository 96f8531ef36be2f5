"""Registered queries of the text and corpus problems, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import encoding, leaks, lookalike, scannoise, transducer, truncation

VERSE_SCRIPTS = {"text_devanagari": "devanagari", "text_devanagari_alt": "devanagari_digits", "transliteration": "latin"}


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verse texts that read like others but are not written in the one form."""
    return lookalike.cases(table(spark, sf_dir, "verse"), "verse_id", VERSE_SCRIPTS).select("verse_id", "field")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The byte_bpe_50k ids of every document's whole text."""
    return transducer.token_ids(table(spark, sf_dir, "documents"), "doc_id", "text")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a held-out item, with the item."""
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "evalitem"), "doc_id", "text", "item_id", "passage")


def p7_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words to take out of the same documents."""
    return leaks.removals(table(spark, sf_dir, "documents"), table(spark, sf_dir, "evalitem"), "doc_id", "text", "item_id", "passage")


def _printed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """field, record_id, value of the two fields whose text comes from printed pages."""
    titles = table(spark, sf_dir, "toc_entry").select(F.lit("title_raw").alias("field"), F.col("entry_id").alias("record_id"), F.col("title_raw").alias("value"))
    prose = table(spark, sf_dir, "verse").select(F.lit("translation").alias("field"), F.col("verse_id").alias("record_id"), F.col("translation").alias("value"))
    return titles.unionByName(prose)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles and translations that carry traces of the scanned page."""
    return scannoise.traces(_printed(spark, sf_dir), ["record_id"], "field", "value", ["translation"]).select("field", "record_id").distinct()


def p4_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same values as continuous readable text."""
    return scannoise.repaired(_printed(spark, sf_dir), ["record_id"], "field", "value", ["translation"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles and translations read under a wrong encoding."""
    return encoding.garbled(_printed(spark, sf_dir), ["field", "record_id"], "value").select("field", "record_id").distinct()


def p5_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same values as first written, as far as their words can be restored."""
    return encoding.restored(_printed(spark, sf_dir), ["field", "record_id"], "value")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.endings(table(spark, sf_dir, "documents"), "doc_id", "text", "lang", "source")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text was cut."""
    return _judged(spark, sf_dir).where("cut").select("doc_id")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of cut documents of each source."""
    return truncation.shares(_judged(spark, sf_dir), "source")


QUERIES = {"p4_found": p4_found, "p4_text": p4_text, "p5_found": p5_found, "p5_text": p5_text, "p8_found": p8_found, "p8_shares": p8_shares, "p1_found": p1_found, "p6_ids": p6_ids, "p7_found": p7_found, "p7_spans": p7_spans}

ORACLES = {"p1_found": f"select verse_id, field from ({lookalike.cases_sql('verse', 'verse_id', VERSE_SCRIPTS)})"}
