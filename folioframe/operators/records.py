"""Page records: what layout boxes and recognised words of a page say together.

Words come with their boxes as fractions of the page, from the top; see `WORD` for the columns.
Everything is one join on pages and one aggregation; no page is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_english_word
from .boxes import smallest_box

WORD = "page int, word int, text string, conf double, l double, t double, r double, b double, line int"
BOX = "page int, box int, label string, l double, t double, r double, b double"
HEAD = 0.065  # the part of a page's height that its head takes
FOOT = 0.955  # where its foot begins
SURE = 50.0  # confidence from which a word counts
SURE_ITEM = 60.0  # mean confidence from which an item counts


def _union(wanted: Column, name: str) -> Column:
    """The box around the wanted words, to four digits; null without any."""
    edge = lambda f, c: F.bround(f(F.when(wanted, F.col(c))), 4)
    box = F.struct(edge(F.min, "l").alias("l"), edge(F.min, "t").alias("t"), edge(F.max, "r").alias("r"), edge(F.max, "b").alias("b"))
    return F.when(F.count(F.when(wanted, 1)) > 0, box).alias(name)


def page_records(words: DataFrame, boxes: DataFrame, heading: str = r"^\s*Canto\s+([IVXLCDM]+)\s*$") -> DataFrame:
    """page, labels (how many boxes of each), mean_conf (0 to 1, to four digits), printed_page (the
    rightmost number of the head), heading (of the first line that is one), verse_numbers, counts
    and boxes of English and of other words in the body.

    An item is English if its words' mean confidence is SURE_ITEM at least and any of them is an
    English word. Defined cases: words in no box count by their own text; pages without words have
    a record if they have boxes; a confidence below 0 is none.
    """
    centres = words.select("page", "word", ((F.col("l") + F.col("r")) / 2).alias("x"), ((F.col("t") + F.col("b")) / 2).alias("y"))
    placed = words.join(smallest_box(centres, boxes, "page", "word", "box"), ["page", "word"], "left")
    english = is_english_word(F.trim("text"))
    items = placed.where("box is not null").groupBy("page", "box").agg(
        (F.coalesce(F.avg(F.when(F.col("conf") >= 0, F.col("conf"))), F.lit(0.0)) >= SURE_ITEM).alias("_sure"), F.bool_or(english).alias("_any")
    ).select("page", "box", (F.col("_sure") & F.col("_any")).alias("_english_item"))
    known = placed.join(items, ["page", "box"], "left")
    body = (F.col("t") > HEAD) & (F.col("b") < FOOT)
    is_english = body & (F.col("box").isNull() | F.coalesce("_english_item", F.lit(False))) & (F.col("conf") >= SURE) & english
    is_other = body & F.col("box").isNotNull() & ~F.coalesce("_english_item", F.lit(False))
    printed = F.when((F.col("b") <= HEAD) & (F.col("conf") >= SURE_ITEM) & F.trim("text").rlike(r"^\d{1,4}$"), F.trim("text").try_cast("int"))
    number = F.regexp_extract("text", r"^\((\d+)\)$", 1).try_cast("int")
    counted = known.groupBy("page").agg(
        F.bround(F.avg(F.when(F.col("conf") >= 0, F.col("conf"))) / 100, 4).alias("mean_conf"), F.max_by(printed, F.when(printed.isNotNull(), F.col("r"))).alias("printed_page"),
        F.array_sort(F.collect_set(F.when(F.col("conf") >= 25, number))).alias("verse_numbers"), F.count_if(is_english).alias("english_words"), F.count_if(is_other).alias("other_words"),
        _union(is_english, "english_box"), _union(is_other, "other_box"),
    )
    texts = words.groupBy("page", "line").agg(F.array_join(F.array_sort(F.collect_list(F.struct("l", "word", "text")))["text"], " ").alias("_text"))
    found = F.regexp_extract("_text", heading, 1)
    headings = texts.where(found != "").groupBy("page").agg(F.min_by(found, "line").alias("heading"))
    labels = boxes.groupBy("page", "label").count().groupBy("page").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "count")))).alias("labels"))
    return labels.join(counted, "page", "full_outer").join(headings, "page", "left")
