"""Page records of one page written by hand."""

from folioframe.operators import records as R


def test_a_page(spark):
    words = [
        (1, 0, "AYODHYA", 90.0, 0.1, 0.02, 0.3, 0.05, 0), (1, 1, "401", 95.0, 0.8, 0.02, 0.9, 0.05, 0), (1, 2, "12", 95.0, 0.05, 0.02, 0.1, 0.05, 0),
        (1, 3, "Canto", 90.0, 0.3, 0.1, 0.4, 0.12, 1), (1, 4, "IV", 90.0, 0.5, 0.1, 0.55, 0.12, 1),
        (1, 5, "The", 80.0, 0.1, 0.2, 0.2, 0.22, 2), (1, 6, "king", 80.0, 0.25, 0.2, 0.35, 0.22, 2), (1, 7, "(4)", 80.0, 0.4, 0.2, 0.45, 0.22, 2),
        (1, 8, "zr~|", 20.0, 0.1, 0.5, 0.2, 0.52, 3), (1, 9, "&%", -1.0, 0.25, 0.5, 0.35, 0.52, 3),
    ]
    boxes = [(1, 0, "text", 0.05, 0.15, 0.6, 0.3), (1, 1, "text", 0.05, 0.45, 0.6, 0.6), (1, 2, "page", 0.0, 0.0, 1.0, 1.0), (2, 0, "picture", 0.0, 0.0, 1.0, 1.0)]
    got = {r.page: r for r in R.page_records(spark.createDataFrame(words, R.WORD), spark.createDataFrame(boxes, R.BOX)).collect()}
    one = got[1]
    assert (one.printed_page, one.heading, one.verse_numbers, one.english_words, one.other_words) == (401, "IV", [4], 4, 2)
    assert one.labels == {"text": 2, "page": 1} and tuple(one.english_box) == (0.1, 0.1, 0.55, 0.22) and tuple(one.other_box) == (0.1, 0.5, 0.35, 0.52)
    assert got[2].labels == {"picture": 1} and got[2].english_words is None
