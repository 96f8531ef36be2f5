"""p8_found: texts whose end is known, against the model."""

import random

import __spark_entry__
from folioframe.llm import truncation

WORDS = [a + b for a in ("ka", "mo", "tir", "sel", "bun", "dor") for b in ("ra", "lin", "set", "ga", "mond")]


def sentence(rng):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randrange(4, 12))).capitalize() + rng.choice([".", ".", "!", "?”"])


def corpus(seed=1, count=600):
    rng = random.Random(seed)
    rows, cut = [], set()
    for i in range(count):
        text = " ".join(sentence(rng) for _ in range(rng.randrange(3, 9)))
        if i % 9 == 0:
            words = text.split()
            text = " ".join(words[: len(words) // 2 + rng.randrange(3)]).rstrip(".!?”,") + rng.choice(["", " ", "...", "�", "…"])
            cut.add(i)
        rows.append((i, text, "en" if i % 20 else None, f"s{i % 3}", 7))
    return rows, cut


def test_query_over_a_table(spark, tmp_path):
    rows, cut = corpus()
    rows += [(9000, None, "en", "s0", 1), (9001, "", "en", "s0", 1), (9002, " \n　", None, None, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, cut int").write.parquet(f"{tmp_path}/documents.parquet")
    queries = __spark_entry__.queries()
    got = {r.doc_id for r in queries["p8_found"](spark, str(tmp_path)).collect()}
    assert len(got & cut) >= 0.9 * len(cut) and len(got - cut) <= 0.05 * len(cut)  # the corpus is small
    shares = {r.source: (r.texts, r.cut_texts) for r in queries["p8_shares"](spark, str(tmp_path)).collect()}
    assert set(shares) == {"s0", "s1", "s2"} and all(n == 200 for n, _ in shares.values()) and sum(c for _, c in shares.values()) == len(got)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert truncation.endings(df, "doc_id", "text", "lang", "source").collect() == []
    blank = spark.createDataFrame([(1, " ", "en", "s")], df.schema)
    assert truncation.endings(blank, "doc_id", "text", "lang", "source").collect() == []


def test_contexts_read_backwards():
    packed, last = truncation.Reader().contexts(["ab", "", "c7", "742"])
    low = (1 << truncation.BITS) - 1
    assert [[int(x >> truncation.BITS * k) & low for k in range(3)] for x in packed] == [[97, 0, 0], [98, 97, 0], [99, 0, 0], [48, 99, 0], [48, 0, 0]]
    assert last.tolist() == [False, True, False, True, True]
    assert [x.sum() for x in (truncation.Reader().contexts(["a\0", "\0", "a" + truncation.BETWEEN])[1],)] == [3]


def test_bare():
    assert [truncation.bare(x) for x in (None, "", "a b ", "ab...", "ab [...]", "ab.", "x" * 500 + " …")] == ["", "", "a b", "ab", "ab", "ab.", "x" * 500]


def test_long_runs_take_linear_time():
    for run in ("a", ".", " ", "…", "[", "[.", "]", "�"):
        text = truncation.bare("x" + run * 200_000)
        packed, last = truncation.Reader().contexts([text or "x"])
        assert last.sum() == 1 and len(packed) == len(text or "x")
