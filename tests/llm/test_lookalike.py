"""p1_found: values in one form, against cases written out by hand."""

import unicodedata

import __spark_entry__
from folioframe.llm.registry import VERSE_SCRIPTS

CLEAN = {"text_devanagari": "कृ ओम् ।। 4.28.1 ।।", "text_devanagari_alt": "कृ।।४.२८.१।।", "transliteration": "kṛ ḻam̐ 'pi || 4.28.1 ||"}
CASES = [
    ("text_devanagari", "क​ृ", "कृ"),
    ("text_devanagari", "क क", "क क"),
    ("text_devanagari", "क̇ ||", "कं ।।"),
    ("text_devanagari", "क: ǀ｜", "कः ।।"),
    ("text_devanagari", "अा अौ एे काे", "आ औ ऐ को"),
    ("text_devanagari", "４．२", "4.2"),
    ("text_devanagari", "क‍म", "कम"),
    ("text_devanagari_alt", "कृ||4.2", "कृ।।४.२"),
    ("transliteration", "kа οm ɡａ", "ka om ga"),
    ("transliteration", unicodedata.normalize("NFD", "ṝ ā ñ ś"), "ṝ ā ñ ś"),
    ("transliteration", "a͏̄ а̄ ।∣＇", "ā ā ||'"),
]
#: A joiner right after a virama and the candrabindu on a Latin m are no cases.
NONE = [("text_devanagari", "क्‍ष क्‌ष"), ("transliteration", "m̐"), ("text_devanagari", ""), ("text_devanagari", None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "verse_id long, " + ", ".join(f"{f} string" for f in VERSE_SCRIPTS))


def test_query_over_a_table(spark, tmp_path):
    values = [*CASES, *NONE, *CLEAN.items()]
    rows = [(i, *[x[1] if x[0] == f else None for f in VERSE_SCRIPTS]) for i, x in enumerate(values)]
    frame(spark, rows).write.parquet(f"{tmp_path}/verse.parquet")
    got = {tuple(r) for r in __spark_entry__.queries()["p1_found"](spark, str(tmp_path)).collect()}
    assert got == {(i, x[0]) for i, x in enumerate(CASES)}


def test_form(spark):
    from folioframe.llm.lookalike import cases

    rows = [(i, *[x[1] if x[0] == f else None for f in VERSE_SCRIPTS]) for i, x in enumerate(CASES)]
    got = {r.verse_id: r.form for r in cases(frame(spark, rows), "verse_id", VERSE_SCRIPTS).collect()}
    assert got == {i: x[2] for i, x in enumerate(CASES)}
