"""Streaming forms of the ordered operators: sessions, repeats left out, values that change.

Each takes a streaming DataFrame; late rows are those behind the watermark, and state is dropped
once the watermark has passed it. A stream's checkpoint folder makes a restarted query go on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def files(spark: SparkSession, folder: str, schema: str, a_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder as a stream, at most `a_batch` at once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", a_batch).parquet(folder)


def sessions(df: DataFrame, by: Sequence[str], time: str, gap: str, late: str, least: int = 1) -> DataFrame:
    """Clusters of each key's rows closer together than `gap`: by, started, ended, n, once the
    watermark has passed them. `ended` is the last row's time, without the gap behind it."""
    grouped = df.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("_w"), *by)
    counted = grouped.agg(F.min(time).alias("started"), F.max(time).alias("ended"), F.count("*").alias("n"))
    return counted.where(F.col("n") >= least).select(*by, "started", "ended", "n")


def first_seen(df: DataFrame, keys: Sequence[str], time: str, late: str) -> DataFrame:
    """Rows whose keys were not seen within the watermark's delay: repeated deliveries are dropped."""
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def changes(df: DataFrame, by: str, time: str, order: Sequence[str], value: str, late: str, idle: str) -> DataFrame:
    """The rows whose value differs from the key's last one; the state is one value for each key
    and is dropped once the watermark is `idle` (longer than `late`) behind the key's last row.
    Rows of one batch are taken in `order`."""
    milliseconds = int(pd.Timedelta(idle).total_seconds() * 1000)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(parts)).sort_values(list(order), kind="stable")
        last = state.get[0] if state.exists else None
        said = rows[rows[value].fillna("").str.strip() != ""]
        if len(said):
            yield said[said[value] != said[value].shift(1, fill_value=last)]
            last = said[value].iloc[-1]
        state.update((last,))
        state.setTimeoutTimestamp(int(rows[time].max().timestamp() * 1000) + milliseconds)

    return df.withWatermark(time, late).groupBy(by).applyInPandasWithState(step, df.schema, "last string", "append", GroupStateTimeout.EventTimeTimeout)
