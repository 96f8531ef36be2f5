"""Rules over tables: one row for each row that breaks one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, keys: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """keys, rule: a row for each rule whose condition does not hold; a null condition counts as
    not held. All rules are tried in one pass."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    return df.select(*keys, F.explode(broken).alias("rule"))


def orphans(df: DataFrame, keys: Sequence[str], parent: DataFrame, column: str, parent_column: str | None = None) -> DataFrame:
    """The keys of rows whose `column` names no row of `parent`; a null names none."""
    known = parent.select(F.col(parent_column or column).alias("_p")).distinct()
    return df.join(known, F.col(column) == F.col("_p"), "left_anti").select(*keys)


def repeated(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, n: the keys that more than one row has; null keys are keys."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1")


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """keys, left value, right value, status: `matched`, `mismatch`, or which side alone has the
    key. Both sides hold a key once; null keys meet null keys."""
    a = left.select(*[F.col(k).alias(f"_a{k}") for k in keys], F.col(value).alias(f"{names[0]}_{value}"), F.lit(True).alias("_ina"))
    b = right.select(*[F.col(k).alias(f"_b{k}") for k in keys], F.col(value).alias(f"{names[1]}_{value}"), F.lit(True).alias("_inb"))
    on = reduce(lambda x, y: x & y, [F.col(f"_a{k}").eqNullSafe(F.col(f"_b{k}")) for k in keys])
    status = (
        F.when(F.col("_inb").isNull(), f"{names[0]}_only").when(F.col("_ina").isNull(), f"{names[1]}_only")
        .when(F.col(f"{names[0]}_{value}").eqNullSafe(F.col(f"{names[1]}_{value}")), "matched").otherwise("mismatch")
    )
    return a.join(b, on, "full_outer").select(
        *[F.coalesce(f"_a{k}", f"_b{k}").alias(k) for k in keys], f"{names[0]}_{value}", f"{names[1]}_{value}", status.alias("status")
    )
