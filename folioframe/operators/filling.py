"""Missing fields filled from others in a fixed order of preference, with an audit of what came from where."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing(column: Column) -> Column:
    """Null and empty texts are missing."""
    return F.coalesce(column, F.lit("")) == ""


def filled(df: DataFrame, fallbacks: Mapping[str, Sequence[tuple[str, Column]]]) -> DataFrame:
    """Every row with its missing fields filled and, in `<field>_source`, the name of the fallback
    used; null where nothing was missing, `missing` where no fallback helped. Fields are filled in
    the order given, and a later field's fallbacks see what was filled before it."""
    for field, ways in fallbacks.items():
        was = missing(F.col(field))
        value, source = F.col(field), F.when(was, F.lit("missing"))
        for name, way in reversed(ways):
            source = F.when(was & ~missing(way), F.lit(name)).otherwise(source)
        for name, way in reversed(ways):
            value = F.when(was & ~missing(way), way).otherwise(value)
        df = df.withColumns({f"{field}_source": source, field: value})
    return df


def audit(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """keys, field, source: one row for each field that was filled or stayed missing."""
    rows = F.array_compact(F.array(*[F.when(F.col(f"{f}_source").isNotNull(), F.struct(F.lit(f).alias("field"), F.col(f"{f}_source").alias("source"))) for f in fields]))
    return df.select(*keys, F.explode(rows).alias("_a")).select(*keys, "_a.*")
