"""Words in the smallest box around them."""

import time

import duckdb
import numpy as np
import pandas as pd

from folioframe.operators import boxes as B

WORDS = "page int, word string, x double, y double"
BOXES = "page long, box long, l double, t double, r double, b double"
SQL = """with m as (select w.page, w.word, box, row_number() over (partition by w.page, w.word order by round((r - l) * (b - t), 9), box) k
 from w join b on w.page = b.page and x between l - 0.005 and r + 0.005 and y between t - 0.005 and b + 0.005)
 select w.page, w.word, m.box from w left join m on w.page = m.page and w.word = m.word and m.k = 1"""


def by_sql(words, boxes):
    db = duckdb.connect()
    db.execute("create table w (page int, word varchar, x double, y double)")
    db.execute("create table b (page bigint, box bigint, l double, t double, r double, b double)")
    db.executemany("insert into w values (?, ?, ?, ?)", words)
    if boxes:
        db.executemany("insert into b values (?, ?, ?, ?, ?, ?)", boxes)
    return sorted(map(repr, db.execute(SQL).fetchall()))


def test_odd_rows_equal_the_sql(spark):
    nan, inf = float("nan"), float("inf")
    words = [(1, "a", 0.5, 0.5), (1, "a", 0.1, 0.1), (1, "b", 0.205, 0.2), (1, "c", None, 0.2), (1, None, 0.5, 0.5), (None, "d", 0.5, 0.5), (2, "e", nan, 0.5), (2, "f", inf, 0.5), (3, "g", 0.5, 0.5), (4, "h", -7.0, 1e9), (2, "i", 0.5, 0.5), (2, "i", 0.5, 0.5)]
    boxes = [(1, 9, 0.0, 0.0, 0.2, 0.2), (1, 8, 0.0, 0.0, 0.2, 0.2), (1, 7, 0.4, 0.4, 0.6, 0.6), (1, 6, 0.0, 0.0, 1.0, 1.0), (1, 5, None, 0.0, 1.0, 1.0), (None, 4, 0.0, 0.0, 1.0, 1.0), (2, 3, 0.0, 0.0, nan, 1.0), (2, 2, 0.0, 0.0, 1.0, 1.0), (5, 1, 0.0, 0.0, 1.0, 1.0), (4, 11, -8.0, 0.0, -6.0, 1e10)]
    for held in (boxes, []):
        got = B.smallest_box(spark.createDataFrame(words, WORDS), spark.createDataFrame(held, BOXES), "page", "word", "box")
        assert got.columns == ["page", "word", "box"]
        assert sorted(repr(tuple(r)) for r in got.collect()) == by_sql(words, held)
    assert B.smallest_box(spark.createDataFrame([], WORDS), spark.createDataFrame(boxes, BOXES), "page", "word", "box").collect() == []


def test_first_around_equals_all_pairs():
    rng = np.random.default_rng(3)
    for n, m, size in ((3000, 900, 0.2), (2000, 2000, 0.01), (500, 700, 1.0), (1, 5, 0.5), (0, 3, 0.1), (4, 0, 0.1)):
        x, y = np.round(rng.random((2, n)), 2)
        l, t = np.round(rng.random((2, m)), 2)
        r, b = l + np.round(rng.random(m) * size, 2), t + np.round(rng.random(m) * size, 2)
        inside = (l <= x[:, None]) & (x[:, None] <= r) & (t <= y[:, None]) & (y[:, None] <= b)
        want = np.where(inside.any(1), inside.argmax(1) if m else -1, -1)
        assert (B.first_around(x, y, l, t, r, b) == want).all()


def test_a_page_of_many_words_and_boxes(spark):
    """30,000,000,000 pairs of one page, of which few may be compared."""
    rng = np.random.default_rng(5)
    n, m = 300_000, 100_000
    words = pd.DataFrame({"page": 1, "word": np.arange(n), "x": rng.random(n), "y": rng.random(n)})
    l, t, w, h = rng.random((4, m))
    boxes = pd.DataFrame({"page": 1, "box": np.arange(m), "l": l, "t": t, "r": l + 0.01 + w / 9, "b": t + 0.01 + h / 9})
    began = time.time()
    got = B.smallest_box(spark.createDataFrame(words), spark.createDataFrame(boxes), "page", "word", "box").toPandas()
    assert time.time() - began < 60 and sorted(got.word) == list(range(n))
    area = np.round((boxes.r - boxes.l) * (boxes.b - boxes.t), 9)
    for word, box in got.sort_values("word").iloc[:: n // 100][["word", "box"]].itertuples(index=False):
        x, y = words.x[word], words.y[word]
        around = (boxes.l - 0.005 <= x) & (x <= boxes.r + 0.005) & (boxes.t - 0.005 <= y) & (y <= boxes.b + 0.005)
        assert box == min(zip(area[around], boxes.box[around]))[1] if around.any() else pd.isna(box)
