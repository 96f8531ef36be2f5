"""Scalar expressions against values written by hand."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioframe.functions import geometry as G
from folioframe.functions import numerals as N
from folioframe.functions import text as X
from folioframe.operators import boxes as B


def one(spark, expression, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(expression.alias("x")).first().x


@pytest.mark.parametrize(
    "function, value, want",
    [
        (N.roman_to_int, "XLII", 42), (N.roman_to_int, " mcmxc ", 1990), (N.roman_to_int, "XLA", None), (N.roman_to_int, None, None), (N.int_to_roman, 3999, "MMMCMXCIX"), (N.int_to_roman, 0, None),
        (N.repaired_roman, "|xl!", "IXII"), (N.letter_key, "Canto", "ACNOT"), (N.word_number, "Twenty-eighth", 28), (N.word_number, "one hundred and eleventh", 111), (N.word_number, "hundredth", 100), (N.word_number, "many", None),
        (N.ascii_digits, "४.२ x", "4.2 x"), (X.page_reference, "Title . . . . 59", 59), (X.page_reference, "Ten 5", None), (X.danda_spaced, "क।ख।।ग", "क । ख ।। ग"), (X.without_tags, "a<b>c</b>", "ac"), (X.is_non_speech, " [music] ", True),
        (X.escaped, "<a & 'b'>", "&lt;a &amp; &#x27;b&#x27;&gt;"), (G.clock, 3725.9, "01:02:05"), (G.seconds, "01:02:05.5", 3725.5), (G.seconds, "02:05", 125.0), (G.seconds, "x", None), (G.padded_pages, 20, 20), (G.padded_pages, 21, 24), (X.script_of, "क1", "devanagari"),
    ],
)
def test_values(spark, function, value, want):
    kind = "string" if isinstance(want, str) or isinstance(value, str) else "double" if isinstance(value, float) else "int"
    args = (F.col("v"), 8) if function is G.padded_pages else (F.col("v"),)
    assert one(spark, function(*args), v=value) == want if value is not None else one(spark, function(F.lit(None).cast(kind))) == want


def test_transliteration():
    assert X.romanised("कृष्णः") == "kṛṣṇaḥ" and X.romanised("ऐभमीतु भीक्षोटाजी ।। ४.२ ।।") == "aibhamītu bhīkṣoṭājī || 4.2 ||"


def test_signatures(spark):
    counts = spark.createDataFrame([(20,), (6,), (1,)], "n long").withColumn("g", F.explode(F.sequence(F.lit(1).cast("long"), G.padded_pages(F.col("n"), 8))))
    got = G.slots(counts, "g", F.col("n"), 8).collect()
    assert max(r.signature for r in got if r.n == 20) == 3 and sorted(r.g for r in got if r.n == 6 and r.blank) == [7, 8] and len([r for r in got if r.n == 1]) == 4
    for n in (20, 6, 1):  # every side of every leaf has one page in each of its slots
        places = [(r.signature, r.depth, r.side, r.slot) for r in got if r.n == n]
        assert len(places) == len(set(places))
    outer = {r.g: (r.side, r.slot) for r in got if r.n == 20 and r.signature == 1 and r.depth == 0}
    assert set(outer) == {1, 2, 7, 8} and outer[1][0] == outer[8][0] and outer[2][0] == outer[7][0]


def test_images(spark):
    flat, sharp = np.full((20, 20), 128), np.tile([0, 255], (20, 10))
    assert B.laplacian_variance(flat) == 0 < B.laplacian_variance(sharp)
    page = np.full((200, 300), 255)
    for y in range(20, 180, 20):
        for x in range(300):
            page[y + round(x * math.tan(math.radians(1.5))) : y + 3 + round(x * math.tan(math.radians(1.5))), x] = 0
    assert abs(B.skew_angle(page) - 1.5) <= 0.2 and B.skew_angle(np.full((9, 9), 255)) == 0
    df = spark.createDataFrame([(1, [0, 0, 10, 20, 30, 255])], "k int, p array<int>")
    [row] = B.levels(B.counts_of_values(df, ["k"], "p"), ["k"], 0.4, 0.8).collect()
    assert (row.black, row.white) == (10, 30) and one(spark, B.stretched(F.lit(20), F.lit(10), F.lit(30))) == 128 and one(spark, B.stretched(F.lit(20), F.lit(7), F.lit(7))) == 20
