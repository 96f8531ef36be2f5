"""The defined cases of the docstrings of coverage (p2_found) and differences (p3_found)."""

import pytest
from pyspark.sql import functions as F

from folioframe.operators.intervals import coverage
from folioframe.operators.reconcile import differences, digest

SPANS = "k int, s int, e int, h int, _s int, _shard int, kind string"
COPY = "k int, page int, sha string, size long, _side int, _h long, _bucket int, _k0 string"


def cover(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SPANS)
    return sorted((tuple(r) for r in coverage(df, ["k"], "s", "e", "h", 4).collect()), key=str)


def test_coverage(spark):
    rows = [(1, 1, 2, None), (1, 1, 2, None), (1, None, 6, 4), (1, 5, None, 5), (1, None, 9, None), (1, 9, 8, None), (None, 3, 3, None), (None, 4, 4, None), (2, None, None, None)]
    assert cover(spark, rows) == sorted([(1, "period", 1, 2), (1, "gap", 3, 3), (1, "period", 4, 6), (None, "period", 3, 4)], key=str)
    assert cover(spark, []) == []


def test_coverage_by_keys_of_its_own_names(spark):
    df = spark.createDataFrame([(1, 1, 2, None, 7, 8, "x")], SPANS)
    assert [tuple(r) for r in coverage(df, ["_s", "_shard"], "s", "e").collect()] == [(7, 8, "period", 1, 2)]


def differ(spark, origin, synced):
    a, b = (spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], COPY) for rows in (origin, synced))
    out = differences(a, b, ["k", "page"], {"sha": digest(F.col("sha")), "size": F.col("size")})
    return sorted((tuple(r) for r in out.collect()), key=str)


ROWS = [(1, 1, "ab12", 5), (1, 2, None, None), (None, 3, "cd", 5)]


@pytest.mark.parametrize(
    "origin, synced, want",
    [
        (ROWS, ROWS * 2, []),
        (ROWS, [], [(1, 1, "only_origin"), (1, 2, "only_origin"), (None, 3, "only_origin")]),
        ([], ROWS[2:], [(None, 3, "only_synced")]),
        ([], [], []),
        ([(1, 1, "ab12", 5)], [(1, 1, " SHA256:AB-12 ", 5)], []),
        ([(1, 1, "ab12", None)], [(1, 1, None, 5)], [(1, 1, "sha"), (1, 1, "size")]),
        ([(1, 1, "ab", 5), (1, 1, "cd", 5)], [(1, 1, "cd", 5), (1, 1, "ab", 5), (1, 1, "ab", 5)], []),
        ([(1, 1, "ab", 5), (1, 1, "cd", 5)], [(1, 1, "cd", 5)], [(1, 1, "sha")]),
    ],
)
def test_differences(spark, origin, synced, want):
    assert differ(spark, origin, synced) == sorted(want, key=str)
