"""p6_ids: the ids of the library over whole texts, however they are cut into parts."""

import random
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
from folioframe.llm import transducer as T

TEXTS = [
    None, "", " ", "  \n\t ", "It's  the\n\n  end 's ''s", "<|endoftext|> is text", "धर्मक्षेत्रे कुरुक्षेत्रे ।। 1.1 ।।", "x\x1cy \x1f z\x85 \xa0w",
    "tab\t\tand　wide  line", "🙂🙂 é ½ ² ४२", "word " * 5000 + "last", "a" * 3000, " trailing   ", "क" * 2000, " " * 70_000 + "x", "=-" * 4000,
    "ab" * 50_000 + " tail", "1234567890" * 9000, "…" * 700 + "\n" * 400, "don't we'll " * 9000,
]


@pytest.fixture(scope="module")
def library():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    return lambda t: library.encode(t or "", add_special_tokens=False).ids


def test_query_over_a_table(spark, tmp_path, library):
    spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids int").write.parquet(f"{tmp_path}/documents.parquet")
    df = __spark_entry__.queries()["p6_ids"](spark, str(tmp_path))
    assert df.dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    assert {r.doc_id: r.ids for r in df.collect()} == {i: library(t) for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.text for r in T.texts(df, "doc_id", "ids").collect()} == {i: t or "" for i, t in enumerate(TEXTS)}


def test_empty_table(spark):
    assert T.token_ids(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text").collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_any_parts_give_the_same(seed, library):
    rng = random.Random(seed)
    transducer = T.Transducer()
    alphabets = ["ab", "aA'slt ", " \n\t", "०१क्षि ", "12 ", "=-_*", "é🙂x ", "the in ing er on "]
    for _ in range(60):
        text = "".join(rng.choice(rng.choice(alphabets)) * rng.choice([1, 1, 1, 2, 3, 40, 600]) for _ in range(rng.randrange(1, 60)))
        out, at = array("i"), 0
        while at < len(text):
            size = rng.choice([1, 2, 5, 40, 300, 2000])
            transducer.feed(text[at : at + size], out)
            at += size
        transducer.close(out)
        assert out.tolist() == library(text), repr(text)


def test_memory_does_not_grow_with_a_run():
    transducer, out, held = T.Transducer(), array("i"), 0
    for _ in range(300):
        transducer.feed("ab" * 500, out)
        held = max(held, len(transducer._bytes) + len(transducer._text))
    assert held <= 4 * transducer.ahead + T.LONG + 1100 and len(out) > 10_000


def test_decoder_waits_for_whole_characters(library):
    decoder, text = T.Decoder(), "क्षि 🙂é"
    parts = [decoder.feed([i]) for i in library(text)]
    assert "".join(parts) == text and "" in parts and decoder.close() == ""
