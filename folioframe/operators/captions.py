"""Captions: cue texts as rows, and what is said in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import seconds
from ..functions.text import without_tags

ECHO = 0.2  # seconds below which a cue only repeats another
_TIMING = r"(?m)^\s*([\d:.]+)\s+-->\s+([\d:.]+)"


def cues(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """keys, cue, start, end, text: the cues of a caption text. A block without a time line
    continues the cue before it; blocks before the first time line, cues shorter than ECHO, blank
    lines, lines of settings and markup are left out."""
    blocks = df.select(*keys, F.posexplode(F.split(F.col(text), "\\n\\s*\\n+")).alias("_i", "_block"))
    timed = F.regexp_extract("_block", _TIMING, 1)
    cue = F.sum((timed != "").cast("long"))
    order = Window.partitionBy(*keys).orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    numbered = blocks.withColumns({"cue": cue.over(order), "_start": seconds(timed), "_end": seconds(F.regexp_extract("_block", _TIMING, 2))}).where("cue > 0")
    body = F.regexp_replace(F.regexp_replace("_block", r"(?s)^.*?-->[^\n]*\n?", ""), r"(?m)^.*(?:align:|vertical:).*$", "")
    joined = numbered.groupBy(*keys, "cue").agg(F.max("_start").alias("start"), F.max("_end").alias("end"), F.array_sort(F.collect_list(F.struct("_i", body.alias("b")))).alias("_l"))
    words = F.trim(F.regexp_replace(F.regexp_replace(without_tags(F.array_join(F.col("_l.b"), "\n")), r"[ \t]*\n\s*", "\n"), r"^\n+|\n+\z", ""))
    return joined.select(*keys, "cue", "start", "end", words.alias("text")).where(F.round(F.col("end") - F.col("start"), 6) >= ECHO).where("text <> ''")
