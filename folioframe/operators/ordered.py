"""Ordered analytics: runs, sessions, consecutive repeats, ranges and as-of look-ups.

Each operator sorts inside the groups it is given and pre-aggregates where its result allows,
so that a large group costs its distinct values and not its rows. Ties are broken by the
columns named, never by the order in which rows arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def runs(df: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """Maximal runs of successive integers of each group: by, first_number, last_number.
    Nulls are left out and repeated numbers count once."""
    distinct = df.select(*by, F.col(number).cast("long").alias("_n")).where("_n is not null").distinct()
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_n"))
    return (
        distinct.withColumn("_run", F.col("_n") - place)
        .groupBy(*by, "_run")
        .agg(F.min("_n").alias("first_number"), F.max("_n").alias("last_number"))
        .drop("_run")
    )


def compact_runs(df: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """The numbers of each group as text: by, runs, e.g. `1-3, 5`."""
    one = F.when(F.col("first_number") == F.col("last_number"), F.col("first_number").cast("string")).otherwise(
        F.concat_ws("-", F.col("first_number").cast("string"), F.col("last_number").cast("string"))
    )
    listed = runs(df, by, number).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("first_number", one.alias("text")))).alias("_r"))
    return listed.select(*by, F.array_join(F.col("_r.text"), ", ").alias("runs"))


def missing_numbers(df: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """The numbers from 1 to each group's largest that it does not hold, as runs: by,
    first_number, last_number. The numbers missing between two that are there are one row."""
    held = runs(df.where(F.col(number) >= 1), by, number)
    before = F.coalesce(F.lag("last_number").over(Window.partitionBy(*by).orderBy("first_number")), F.lit(0))
    gaps = held.withColumn("_before", before).where("first_number > _before + 1")
    return gaps.select(*by, (F.col("_before") + 1).alias("first_number"), (F.col("first_number") - 1).alias("last_number"))


def sessions(df: DataFrame, by: Sequence[str], time: str, gap_seconds: float, least: int = 1) -> DataFrame:
    """Clusters of rows no further apart than `gap_seconds`: by, started, ended, n; clusters of
    fewer than `least` rows are left out. Exactly the gap still belongs to the cluster."""
    at = df.where(F.col(time).isNotNull()).groupBy(*by, F.col(time).alias("_t")).agg(F.count("*").alias("_n"))
    order = Window.partitionBy(*by).orderBy("_t")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    apart = micros(F.col("_t")) - micros(F.lag("_t").over(order)) > int(gap_seconds * 1_000_000)
    marked = at.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int"))
    numbered = marked.withColumn("_s", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "_s").agg(F.min("_t").alias("started"), F.max("_t").alias("ended"), F.sum("_n").alias("n")).where(F.col("n") >= least).drop("_s")


def changes(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """The rows whose value differs from that of the row before; blank and null values are
    skipped and do not interrupt a repeat."""
    kept = df.where(F.trim(F.col(value)) != "")
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(*order))
    return kept.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("_before") != F.col(value))).drop("_before")


def range_ends(df: DataFrame, by: Sequence[str], start: str, order: Sequence[str] = (), last: Column | None = None) -> DataFrame:
    """Each row's start with the end of its range: one before the next start, else `last`."""
    following = F.lead(start).over(Window.partitionBy(*by).orderBy(start, *order)) - 1
    return df.withColumn("range_end", F.coalesce(following, last) if last is not None else following)


def as_of(left: DataFrame, right: DataFrame, by: Sequence[str], at: str, ordinal: str, values: Sequence[str]) -> DataFrame:
    """Each left row with the values of the last right row of its group that is not later; of
    right rows at one time the one with the largest `ordinal` counts. One union and one window
    instead of a join on a range; null times match nothing."""
    held = F.struct(*[F.col(v).alias(v) for v in values])
    kept = left.columns
    rows = left.select(F.struct(*kept).alias("_row"), *by, F.col(at).alias("_at"), F.lit(None).cast(right.select(held.alias("x")).schema["x"].dataType).alias("_held"), F.lit(1).alias("_side"), F.lit(None).cast("long").alias("_ord"))
    known = right.where(F.col(at).isNotNull()).select(
        F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), *by, F.col(at).alias("_at"), held.alias("_held"), F.lit(0).alias("_side"), F.col(ordinal).cast("long").alias("_ord")
    )
    order = Window.partitionBy(*by).orderBy("_at", "_side", "_ord").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.unionByName(known).withColumn("_last", F.last("_held", ignorenulls=True).over(order)).where("_side = 1")
    return found.select("_row.*", *[F.when(F.col("_at").isNotNull(), F.col(f"_last.{v}")).alias(v) for v in values])


def page_index(df: DataFrame, by: Sequence[str], start: str, end: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row for each position that a range covers: by, position, values; where ranges overlap,
    the last in `order` counts. Ranges without an end or that end before they start cover nothing."""
    spans = df.where(F.col(start) <= F.col(end))
    each = spans.select(*by, F.explode(F.sequence(start, end)).alias("position"), F.struct(*order).alias("_o"), F.struct(*values).alias("_v"))
    return each.groupBy(*by, "position").agg(F.max_by("_v", "_o").alias("_v")).select(*by, "position", "_v.*")


def numbered_blocks(df: DataFrame, by: Sequence[str], order: Sequence[str], starts: Column) -> DataFrame:
    """Every row with the number of the block it belongs to: how many rows up to it start one."""
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("block", F.sum(F.coalesce(starts, F.lit(False)).cast("long")).over(window))


def chunks(df: DataFrame, by: Sequence[str], order: Sequence[str], size: int) -> DataFrame:
    """Every row with the number, from 0 on, of its chunk of `size` rows in `order`."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("chunk", F.floor((place - 1) / size).cast("long"))


def tiling(df: DataFrame, by: Sequence[str], start: str, end: str, overlap: int = 0) -> DataFrame:
    """Rows that break a tiling: by, start, end, problem. A range must start right after the one
    before, or up to `overlap` positions earlier; `inverted`, `gap` and `overlap` are told apart."""
    before = F.lag(end).over(Window.partitionBy(*by).orderBy(start, end))
    problem = (
        F.when(F.col(end) < F.col(start), "inverted").when(F.col(start) > F.col("_before") + 1, "gap").when(F.col(start) < F.col("_before") + 1 - overlap, "overlap")
    )
    return df.select(*by, start, end).distinct().withColumn("_before", before).withColumn("problem", problem).where("problem is not null").drop("_before")
