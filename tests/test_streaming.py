"""Streaming forms beside their batch forms."""

from datetime import datetime, timedelta

from folioframe.operators import ordered
from folioframe.streaming import events as E

SCHEMA = "user string, ts timestamp, kind string, id long"


def rows():
    start = datetime(2025, 1, 1)
    at = [("a", 0, "x"), ("a", 1, "x"), ("a", 2, "y"), ("a", 50, "y"), ("b", 5, "x"), ("b", 9, ""), ("b", 12, "x"), ("b", 99, "z"), ("c", 500, "x")]
    return [(u, start + timedelta(minutes=m), k, i) for i, (u, m, k) in enumerate(at)]


def run(df, spark, name, mode="append"):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    return spark.table(name)


def folder(spark, tmp_path, data):
    for i, part in enumerate(data):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def test_sessions(spark, tmp_path):
    path = folder(spark, tmp_path, [rows(), [("z", datetime(2025, 2, 1), "end", 99)]])
    got = run(E.sessions(E.files(spark, path, SCHEMA, 1), ["user"], "ts", "10 minutes", "1 minute"), spark, "s1")
    want = ordered.sessions(spark.createDataFrame(rows(), SCHEMA), ["user"], "ts", 600)
    pick = lambda df: {(r.user, r.started, r.ended, r.n) for r in df.collect()}
    assert pick(got.where("user <> 'z'")) == pick(want)


def test_first_seen(spark, tmp_path):
    path = folder(spark, tmp_path, [rows(), rows()])
    got = run(E.first_seen(E.files(spark, path, SCHEMA, 1), ["id"], "ts", "1 day"), spark, "s2")
    assert sorted(r.id for r in got.collect()) == [r[3] for r in rows()]


def test_changes(spark, tmp_path):
    path = folder(spark, tmp_path, [rows()])
    got = run(E.changes(E.files(spark, path, SCHEMA), "user", "ts", ["ts", "id"], "kind", "1 minute", "9 days"), spark, "s3", "append")
    want = ordered.changes(spark.createDataFrame(rows(), SCHEMA), ["user"], ["ts", "id"], "kind")
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect())
