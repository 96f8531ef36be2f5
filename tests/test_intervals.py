"""p2_found and its operator against marking every page by hand."""

import random

import __spark_entry__
from folioframe.operators import intervals

SCHEMA = "scan_id long, kanda int, start_page int, end_page int, heading_page int, kind string, _s int"


def brute(rows):
    covered = {}
    for scan, kanda, start, end, heading, *_ in rows:
        start = heading if start is None else start
        if start is not None and end is not None and start <= end:
            covered.setdefault((scan, kanda), set()).update(range(start, end + 1))
    out = set()
    for key, pages in covered.items():
        pages = sorted(pages)
        first = last = pages[0]
        for page in [*pages[1:], None]:
            if page is not None and page == last + 1:
                last = page
                continue
            out.add((*key, "period", first, last))
            if page is not None:
                out.add((*key, "gap", last + 1, page - 1))
                first = last = page
    return out


def readings(seed, count=150):
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        start = rng.choice([None, rng.randrange(-40, 280), rng.randrange(-40, 280)])
        heading = rng.choice([None, rng.randrange(-40, 280)])
        end = rng.choice([None, (start or heading or 0) + rng.choice([-3, 0, 0, 1, 2, 5, 15, 16, 31, 130])])
        rows.append((rng.choice([None, 1, 2, 3]), rng.choice([None, 4, 5]), start, end, heading, "x", 7))
    # whole shards, touching at a boundary, repeated and nested
    return rows + [(9, 1, 0, 15, None, "x", 7), (9, 1, 16, 31, None, "x", 7), (9, 1, 16, 31, None, "x", 7), (9, 1, 20, 21, None, "x", 7), (9, 1, 64, 191, None, "x", 7), (9, 1, 193, 193, None, "x", 7)]


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_every_width_gives_the_same(spark):
    rows = readings(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(1)
    for width in (1, 3, 16, 64, 16384):
        assert got(intervals.coverage(df, ["scan_id", "kanda"], "start_page", "end_page", "heading_page", width)) == brute(rows), width


def test_query_clips_and_stitches(spark, tmp_path, monkeypatch):
    rows = readings(2)
    spark.createDataFrame(rows, SCHEMA).repartition(1).write.parquet(f"{tmp_path}/sarga_span.parquet")
    shards, local_runs = [], intervals._local_runs

    def spied(df, keys, width):
        shards.append(local_runs(df, keys, width))
        return shards[-1]

    monkeypatch.setattr(intervals, "_local_runs", spied)
    assert got(__spark_entry__.queries()["p2_found"](spark, str(tmp_path))) == brute(rows)
    assert shards[0].select("_shard").distinct().count() > 2
