"""Text as column expressions: scripts, markers, leaders, escapes and escaped payloads."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# Devanagari letters and signs with their transliteration.
CONSONANTS = dict(zip("कखगघङचछजझञटठडढणतथदधनपफबभमयरलवशषसहळ", "k kh g gh ṅ c ch j jh ñ ṭ ṭh ḍ ḍh ṇ t th d dh n p ph b bh m y r l v ś ṣ s h ḻ".split()))
VOWELS = dict(zip("अआइईउऊऋॠऌएऐओऔ", "a ā i ī u ū ṛ ṝ ḷ e ai o au".split()))
VOWEL_SIGNS = dict(zip("ािीुूृॄॢेैोौ", "ā i ī u ū ṛ ṝ ḷ e ai o au".split()))
OTHER_SIGNS = {"ं": "ṃ", "ः": "ḥ", "ँ": "m̐", "ऽ": "'", "।": "|", "॥": "||"}
VIRAMA = "्"
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]


def tokens(text: Column, pattern: str = r"\S+") -> Column:
    """The matches of a pattern in a text, in order; an empty array for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), F.array().cast("array<string>"))


def is_english_word(word: Column) -> Column:
    """Not blank, at least 95 % ASCII letters and common punctuation; of single characters only
    a, A and I."""
    other = F.length(F.regexp_replace(word, r"[A-Za-z'’.,;:!?()\-]", ""))
    return F.when(F.length(word) == 1, word.isin("a", "A", "I")).otherwise((F.length(word) > 1) & (other <= 0.05 * F.length(word)))


def script_of(word: Column) -> Column:
    """`devanagari`, `latin`, `number` or `other`, by the first of these that a word holds."""
    return (
        F.when(word.rlike("[\\u0900-\\u0963\\u0970-\\u097F]"), "devanagari").when(word.rlike("\\p{IsLatin}"), "latin")
        .when(word.rlike("[0-9\\u0966-\\u096F]"), "number").otherwise("other")
    )


def verse_markers(text: Column) -> Column:
    """The numbers in brackets, `n` or `n-m`, with whatever dash and spaces they are printed."""
    bare = F.regexp_extract_all(text, F.lit(r"\(\s*(\d+(?:\s*[-–—]\s*\d+)?)\s*\)"), F.lit(1))
    return F.transform(bare, lambda m: F.regexp_replace(m, r"\s*[-–—]\s*", "-"))


def leader(line: Column) -> Column:
    """A contents line as a struct title, page: the title, dots and the page number; null for others."""
    pattern = r"^(.*?\S)\s*\.{2,}\s*(\d{1,4})\s*$"
    return F.when(line.rlike(pattern), F.struct(F.regexp_extract(line, pattern, 1).alias("title"), F.regexp_extract(line, pattern, 2).cast("long").alias("page")))


def page_reference(line: Column) -> Column:
    """The page number at a line's end: up to four digits after dots, or after six characters at
    least that are no digits; else null."""
    return F.coalesce(
        F.regexp_extract(line, r"\.\s*(\d{1,4})\W*$", 1).try_cast("long"), F.regexp_extract(line, r"^.{5,}[^\d](\d{1,4})\W*$", 1).try_cast("long")
    )


def translated(text: Column, glyphs: Sequence[tuple[str, str]], ligatures: Sequence[tuple[str, str]] = ()) -> Column:
    """A text with its ligatures resolved in order and then its single glyphs mapped at once."""
    for a, b in ligatures:
        text = F.replace(text, F.lit(a), F.lit(b))
    return F.translate(text, "".join(a for a, _ in glyphs), "".join(b for _, b in glyphs))


def danda_spaced(text: Column) -> Column:
    """Strokes set off from words: one space before and after each stroke, none at the ends."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, "\\s*(।+)\\s*", " $1 "), " +", " "))


def without_reference(text: Column) -> Column:
    """A verse without its reference number and the strokes around it."""
    return F.regexp_replace(text, "\\s*(?:।।|\\|\\|)\\s*[0-9०-९]+(?:\\.[0-9०-९]+)*\\s*(?:।।|\\|\\|)\\s*$", "")


def escaped(text: Column, quotes: bool = True) -> Column:
    """Text as HTML: & < > and, if `quotes`, both quotation marks."""
    for a, b in ESCAPES if quotes else ESCAPES[:3]:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def without_tags(text: Column) -> Column:
    """Text without markup in angle brackets."""
    return F.regexp_replace(text, "<[^>]+>", "")


def is_non_speech(line: Column) -> Column:
    """Whether a caption line is a sound in square brackets."""
    return F.trim(line).rlike(r"^\[[^\]]*\]$")


def has_root(text: Column, roots: Sequence[str]) -> Column:
    """Whether one of the roots stands anywhere in a text, whatever its case."""
    return F.exists(F.array(*map(F.lit, roots)), lambda r: F.contains(F.lower(text), F.lower(r)))


def json_field(payload: Column, name: str, following: Sequence[str]) -> Column:
    """A string field of an escaped JSON payload: from its name up to the nearest of the fields
    that may follow it, or the object's end; backslashes are removed."""
    ends = "|".join([*(f'\\\\*",\\\\*"{f}\\\\*":' for f in following), '\\\\*"\\s*\\}'])
    return F.replace(F.regexp_extract(payload, f'(?s)"{name}\\\\*":\\\\*"(.*?)(?:{ends})', 1), F.lit("\\"))


@pandas_udf(StringType())
def without_marks(texts: pd.Series) -> pd.Series:
    """Letters without combining marks (canonical decomposition); no built-in expression has it."""
    return texts.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c)))


def romanised(text: str) -> str:
    """Devanagari in transliteration: a consonant carries an a unless a vowel sign or virama follows."""
    out: list[str] = []
    for k, c in enumerate(text):
        if c in CONSONANTS:
            after = text[k + 1 : k + 2]
            out.append(CONSONANTS[c] + ("" if after in VOWEL_SIGNS or after == VIRAMA else "a"))
        elif c != VIRAMA:
            digit = ord(c) - 0x966
            out.append(VOWELS.get(c) or VOWEL_SIGNS.get(c) or OTHER_SIGNS.get(c) or (str(digit) if 0 <= digit < 10 else c))
    return "".join(out)


@pandas_udf(StringType())
def transliterated(texts: pd.Series) -> pd.Series:
    """`romanised` over Arrow batches."""
    return texts.map(lambda t: None if t is None else romanised(t))
