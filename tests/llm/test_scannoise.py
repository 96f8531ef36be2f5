"""p4_found: a small press whose noise is known."""

import random

import __spark_entry__
from folioframe.llm import scannoise as S

NOUNS = "river hermit garden mountain chariot elephant minister daughter thunder lantern harbour merchant feather blossom captain shelter".split()
VERBS = "carried honoured followed gathered lamented counted mentioned answered".split()
WRONG = [("e", "c"), ("h", "li"), ("n", "ri"), ("d", "cl")]


def clean(rng):
    one = lambda: f"the {rng.choice(NOUNS)} {rng.choice(VERBS)} the {rng.choice(NOUNS)} and the mother- and sister-{rng.choice(NOUNS)}"
    return f"{one().capitalize()}. {one().capitalize()}. ({rng.randrange(1, 30)})"


def misread(rng, text):
    words = text.split(" ")
    pick = lambda w: [x for x in WRONG if w in NOUNS and x[0] in w]
    k = rng.choice([i for i, w in enumerate(words) if pick(w)])
    a, b = rng.choice(pick(words[k]))
    words[k] = words[k].replace(a, b, 1)
    return " ".join(words)


def test_query_over_tables(spark, tmp_path):
    rng = random.Random(5)
    verses = [(i, clean(rng)) for i in range(900)]
    dirty = {
        i: f(verses[i][1])
        for i, f in {
            1: lambda t: t.replace("carried", "car-\nried") + "x-\ny.", 2: lambda t: t.replace(" and ", "\nand ", 1), 3: lambda t: t.replace(" and ", "\n* DĪPAKĀṆḌA * 27\nand ", 1),
            4: lambda t: t.replace(" and ", " 415 * CANDRAMĀRGA * and ", 1), 5: lambda t: t.replace(" and ", "\n- 742 -\nand ", 1), 6: lambda t: t.replace("mother-", "m o t h e r-", 1), 7: lambda t: t.replace("mother", "mo¬ ther", 1),
            8: lambda t: "The hermit honoured the gar-  den."}.items()
    }
    dirty |= {i: misread(rng, verses[i][1]) for i in range(10, 60)}
    dirty[7] = dirty[7].replace("mo¬ ther", "mo¬ ther")
    rows = [(i, dirty.get(i, t), "x") for i, t in verses] + [(2000, None, "x"), (2001, "", "x"), (2002, "The river answered.\nThe hermit carried the garden.\n(4)", "x"), (2003, "The river\nanswered the Ä\x81rya!â€\x9d\nThe hermit carried.".replace("\na", " a"), "x")]
    spark.createDataFrame(rows, "verse_id long, translation string, field string").write.parquet(f"{tmp_path}/verse.parquet")
    titles = [(1, "The river of 1000 hermits"), (2, "The river and the hermit ...... 12"), (3, "The river and the hermit · · · 205"), (4, "The river 31"), (5, None), (6, ""), (7, "The mother- and sister-garden; the river")]
    spark.createDataFrame(titles, "entry_id long, title_raw string").write.parquet(f"{tmp_path}/toc_entry.parquet")
    queries = __spark_entry__.queries()
    got = {tuple(r) for r in queries["p4_found"](spark, str(tmp_path)).collect()}
    want = {("translation", i) for i in dirty} | {("title_raw", i) for i in (2, 3, 4)}
    assert not got - want and len(want - got) <= 3  # a confusion may be too rare here
    texts = {(r.field, r.record_id): r.repaired_value for r in queries["p4_text"](spark, str(tmp_path)).collect()}
    assert set(texts) == got
    for i in (2, 3, 4, 5, 6, 7):
        assert texts["translation", i] == verses[i][1]
    assert texts["title_raw", 2] == texts["title_raw", 3] == "The river and the hermit" and texts["translation", 8] == "The hermit honoured the garden."
    assert sum(texts.get(("translation", i)) == verses[i][1] for i in range(10, 60)) >= 45


def test_empty_tables(spark):
    df = spark.createDataFrame([], "record_id long, field string, value string, word string, n long")
    assert S.traces(df, ["record_id"], "field", "value", ["a"]).collect() == []
    assert S.repaired(df, ["record_id"], "field", "value", ["a"]).collect() == []


def test_hashes_differ_by_the_confusion():
    whole = 1 << 61
    assert (S.anagram("garclen") - S.anagram("garden")) % whole == (S.anagram("cl") - S.anagram("d")) % whole
    assert S.variants("garclcn", {"cl": [("d", 9)], "c": [("e", 5)]})["garden"] == (2, -5)


def test_long_text():
    text = "The river carried. " * 20_000
    assert S.Reading(text, True).text.strip() == text.strip() and not S.Reading(text, True).noise


def test_long_runs_take_linear_time():
    for run in ("A", "Ā", " ", ".", ". ", "·", "…", "1", "a ", "(", "-", "- ", "¬ ", "[1] ", "* ", "\n", "1\n", "A\n"):
        for end in ("", "b", " b 12"):
            S.words(S.Reading("x " + run * 60_000 + end, True))
            S.words(S.Reading("x " + run * 60_000 + end, False))
