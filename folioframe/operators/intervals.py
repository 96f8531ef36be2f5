"""Continuous coverage of integer intervals and the gaps between, in two levels.

Level one clips every interval into shards of `width` positions and merges inside each
(entity, shard); level two joins only the runs that touch a shard boundary. No task ever
sees more than `width` distinct starts of one shard or the boundary runs of one entity, so
an entity that holds a third of all rows is spread over its shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_WIDTH = 16384


def _islands(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Merge the intervals [_s, _e] of each group; neighbouring positions are continuous."""
    order = Window.partitionBy(*by).orderBy("_s", "_e")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    opened = df.withColumn("_new", (F.col("_s") > F.coalesce(F.max("_e").over(before) + 1, F.col("_s") - 1)).cast("int"))
    numbered = opened.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "_run").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e")).drop("_run")


def _local_runs(df: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Level one: disjoint runs of each (entity, shard) as (keys, _shard, _s, _e)."""
    w = F.lit(width)
    shard = lambda c: F.expr(f"({c} - pmod({c}, {int(width)}L)) div {int(width)}L")  # noqa: E731 - not by doubles
    ends = df.withColumns({"_a": shard("_s"), "_b": shard("_e")})
    head = F.struct(F.col("_a").alias("_shard"), F.col("_s").alias("_s"), F.least(F.col("_e"), (F.col("_a") + 1) * w - 1).alias("_e"))
    tail = F.struct(F.col("_b").alias("_shard"), (F.col("_b") * w).alias("_s"), F.col("_e").alias("_e"))
    pieces = ends.select(*keys, F.explode(F.when(F.col("_a") == F.col("_b"), F.array(head)).otherwise(F.array(head, tail))).alias("_p")).select(*keys, "_p.*")
    # Shards that lie wholly inside an interval: merged as shard ranges first, so that each
    # entity names each of its shards once however many long intervals it has.
    whole = (
        ends.where(F.col("_b") > F.col("_a") + 1)
        .groupBy(*keys, (F.col("_a") + 1).alias("_s"))
        .agg(F.max(F.col("_b") - 1).alias("_e"))
    )
    whole = _islands(whole, keys).select(*keys, F.explode(F.sequence("_s", "_e")).alias("_shard"))
    whole = whole.select(*keys, "_shard", (F.col("_shard") * w).alias("_s"), ((F.col("_shard") + 1) * w - 1).alias("_e"))
    # Pre-aggregation: at most `width` rows of a shard leave this step, combined map-side.
    starts = pieces.unionByName(whole).groupBy(*keys, "_shard", "_s").agg(F.max("_e").alias("_e"))
    return _islands(starts, [*keys, "_shard"])


def coverage(df: DataFrame, keys: Sequence[str], start: str, end: str, fallback: str | None = None, width: int = SHARD_WIDTH) -> DataFrame:
    """Longest continuous runs (`period`) and the holes between successive runs (`gap`).

    Result: keys, kind, first_page, last_page (integers, both ends included).

    Defined cases: `fallback` stands in for a null start; an interval without a start or an
    end, or whose end lies before its start, covers nothing; null keys form an entity of
    their own; repeated, nested and touching intervals merge; entities that cover nothing
    and empty tables give no rows; other columns of `df` are ignored.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    first = F.coalesce(F.col(start), F.col(fallback)) if fallback else F.col(start)
    spans = df.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], first.cast("long").alias("_s"), F.col(end).cast("long").alias("_e")
    ).where("_s is not null and _e is not null and _e >= _s")
    local = _local_runs(spans, names, width)
    low, high = F.col("_shard") * width, (F.col("_shard") + 1) * width - 1
    touching = (F.col("_s") == low) | (F.col("_e") == high)
    inner = local.where(~touching).select(*names, "_s", "_e")
    stitched = _islands(local.where(touching).select(*names, "_s", "_e"), names)
    periods = inner.unionByName(stitched).withColumn("kind", F.lit("period"))
    # The runs of a shard are its whole coverage, so holes inside it are final; a hole over
    # a boundary lies between the last run of one occupied shard and the first of the next.
    within = Window.partitionBy(*names, "_shard").orderBy("_s")
    inside = local.select(*names, (F.lag("_e").over(within) + 1).alias("_s"), (F.col("_s") - 1).alias("_e"))
    shards = local.groupBy(*names, "_shard").agg(F.min("_s").alias("_first"), F.max("_e").alias("_last"))
    along = Window.partitionBy(*names).orderBy("_shard")
    across = shards.select(*names, (F.lag("_last").over(along) + 1).alias("_s"), (F.col("_first") - 1).alias("_e"))
    gaps = inside.unionByName(across).where("_s <= _e").withColumn("kind", F.lit("gap"))
    return periods.unionByName(gaps).select(
        *[F.col(n).alias(k) for k, n in zip(keys, names)], "kind", F.col("_s").alias("first_page"), F.col("_e").alias("last_page")
    )
