"""Differences between two copies of a dataset, field by field.

Each row becomes one element of a finite field (a hash of key and values). Every partition
reduces its elements, bucket by bucket, to the products of (z - h) at a few points
(functions.charpoly.sketch); only these products are shuffled, and the differing elements of a
bucket are the roots of the rational function through them. The elements themselves are
shuffled only for buckets that differ in more elements than the sketch can tell, where the
degree bound doubles until verified. The rows of the recovered elements are fetched by key and
compared. A repeated row makes its element differ once more than it should: that costs a
comparison and never shows in the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.charpoly import recover, sketch, solve
from ..session import durable

ROWS_A_BUCKET = 64
BUCKET_SEED = 7


def digest(value: Column) -> Column:
    """A digest in its one form: lower-case hex without algorithm prefix, spaces or separators."""
    bare = F.regexp_replace(F.lower(value), r"^[\s\u00a0]*(sha-?256[\s\u00a0]*[:=]|0x)", "")
    return F.regexp_replace(bare, r"[\s\u00a0:._-]", "")


def _tagged(df: DataFrame, keys: Sequence[str], fields: Mapping[str, Column], side: int) -> DataFrame:
    return df.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[c.cast("string").alias(f"_v{i}") for i, c in enumerate(fields.values())],
        F.lit(side).cast("tinyint").alias("_side"),
    )


def differences(origin: DataFrame, synced: DataFrame, keys: Sequence[str], fields: Mapping[str, Column], buckets: int | None = None) -> DataFrame:
    """One row per key that one copy lacks (`only_origin`, `only_synced`) and one per field
    whose values differ under a key both hold: keys, difference.

    `fields` maps a field's name to the expression that gives its comparable value; `buckets`
    is by default chosen from the copies' row counts, which for Parquet come from its footers.

    Defined cases: a repeated row counts once; where a key has several rows with unlike
    values in one copy, its sets of values are compared; null equals null only, in keys as
    in fields; an empty table makes every key of the other one-sided; columns outside keys
    and fields are ignored, whatever their names.
    """
    kn, vn = [f"_k{i}" for i in range(len(keys))], [f"_v{i}" for i in range(len(fields))]
    rows = _tagged(origin, keys, fields, 0).unionByName(_tagged(synced, keys, fields, 1))
    # A null leaves xxhash64 as it was, so each value goes in together with its null flag.
    parts = [x for n in [*kn, *vn] for x in (F.col(n), F.col(n).isNull())]
    buckets = buckets or max(1, (origin.count() + synced.count()) // (2 * ROWS_A_BUCKET))
    h = F.xxhash64(*parts).bitwiseAND(F.lit((1 << 61) - 1))
    # The bucket comes from a second hash of the same row: no key can make a bucket large,
    # and two rows are only confused if both hashes collide.
    hashed = rows.withColumns(
        {"_h": F.when(h == (1 << 61) - 1, F.lit(0)).otherwise(h), "_bucket": F.pmod(F.xxhash64(F.lit(BUCKET_SEED), *parts), F.lit(buckets))}
    )
    sketches = hashed.select("_bucket", "_side", "_h").mapInArrow(sketch, "_bucket long, _side tinyint, _n long, _chi binary")
    # Written once: it is read three times below, and a lost executor must not repeat the scans.
    told = durable(sketches.repartition("_bucket").sortWithinPartitions("_bucket").mapInArrow(solve, "_bucket long, _side tinyint, _h long"))
    beyond = told.where("_side = -1").select("_bucket")
    elements = hashed.select("_bucket", "_side", "_h").join(beyond, "_bucket", "left_semi").distinct()
    doubled = elements.repartition("_bucket").sortWithinPartitions("_bucket").mapInArrow(recover, "_bucket long, _side tinyint, _h long")
    recovered = told.where("_side >= 0").unionByName(doubled).distinct()
    # Not a semi join: that would be pushed below the union and recover each bucket twice.
    suspects = hashed.join(recovered, ["_bucket", "_side", "_h"]).select(*kn).distinct()
    wanted = suspects.select(*[F.col(n).alias(f"_w{n}") for n in kn])
    same = [F.col(n).eqNullSafe(F.col(f"_w{n}")) for n in kn]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    fetched = rows.join(wanted, condition, "left_semi")
    # Values per (key, field, value) first, so that a key with many rows is combined map-side.
    long = fetched.select(
        *kn, "_side", F.posexplode(F.array(*vn)).alias("_f", "_v")
    ).groupBy(*kn, "_f", "_v").agg(F.max(F.col("_side") == 0).alias("_a"), F.max(F.col("_side") == 1).alias("_b"))
    names = list(fields)
    per_key = long.groupBy(*kn).agg(
        F.max("_a").alias("_a"), F.max("_b").alias("_b"),
        *[F.max((F.col("_f") == i) & (F.col("_a") != F.col("_b"))).alias(f"_d{i}") for i in range(len(names))],
    )
    verdict = F.when(~F.col("_b"), F.array(F.lit("only_origin"))).when(~F.col("_a"), F.array(F.lit("only_synced"))).otherwise(
        F.array_compact(F.array(*[F.when(F.col(f"_d{i}"), F.lit(n)) for i, n in enumerate(names)]))
    )
    return per_key.select(*[F.col(n).alias(k) for n, k in zip(kn, keys)], F.explode(verdict).alias("difference"))
