"""Numerals as column expressions: Roman, spelled-out and Devanagari."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}
ROMAN_STEPS = [(1000, "M"), (900, "CM"), (500, "D"), (400, "CD"), (100, "C"), (90, "XC"), (50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I")]
UNITS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
ORDINALS = {"one": "first", "two": "second", "three": "third", "five": "fifth", "eight": "eighth", "nine": "ninth", "twelve": "twelfth"}
DEVANAGARI_DIGITS = "०१२३४५६७८९"


def roman_to_int(text: Column) -> Column:
    """The value of a Roman numeral of either case, subtractive, read from the right; null for
    other text."""
    clean = F.upper(F.trim(text))
    values = F.create_map(*[F.lit(x) for pair in ROMAN.items() for x in pair])
    letters = F.reverse(F.split(clean, ""))
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last"))

    def step(acc: Column, letter: Column) -> Column:
        v = F.coalesce(F.try_element_at(values, letter), F.lit(0))
        return F.struct((acc["sum"] + F.when(v < acc["last"], -v).otherwise(v)).alias("sum"), F.greatest(v, acc["last"]).alias("last"))

    return F.when(clean.rlike("^[IVXLCDM]+$"), F.aggregate(letters, start, step)["sum"])


def int_to_roman(number: Column) -> Column:
    """The canonical Roman numeral of 1 to 3999, else null."""
    places = F.lit("")
    for digit, (one, five, ten) in enumerate([("I", "V", "X"), ("X", "L", "C"), ("C", "D", "M"), ("M", "", "")]):
        shapes = ["", one, one * 2, one * 3, one + five, five, five + one, five + one * 2, five + one * 3, one + ten]
        part = F.element_at(F.array(*map(F.lit, shapes)), (F.pmod(F.floor(number / 10**digit), F.lit(10)) + 1).cast("int"))
        places = F.concat(part, places)
    return F.when(number.between(1, 3999), places)


def repaired_roman(text: Column) -> Column:
    """A Roman numeral as printed letters: strokes that a scan reads as other signs become I."""
    return F.upper(F.translate(text, "|l!1", "IIII"))


def letter_key(text: Column) -> Column:
    """The letters of a text in alphabetical order: equal for texts of the same letters."""
    return F.array_join(F.array_sort(F.split(F.upper(text), "")), "")


def drops_one_letter(text: Column, whole: Column) -> Column:
    """Whether `text` is a Roman numeral's letters with exactly one missing, in any order."""
    few = [F.length(text) - F.length(F.replace(text, F.lit(x))) <= F.length(whole) - F.length(F.replace(whole, F.lit(x))) for x in ROMAN]
    fits = few[0]
    for f in few[1:]:
        fits = fits & f
    return (F.length(text) == F.length(whole) - 1) & fits


def number_words() -> dict[str, int]:
    """Cardinal and ordinal spellings of 1 to 199, made from the rule."""
    under = {n: [w] for n, w in enumerate(UNITS, 1)}
    for k, ten in enumerate(TENS, 2):
        under[k * 10] = [ten]
        for n in range(1, 10):
            under[k * 10 + n] = [f"{ten}-{UNITS[n - 1]}", f"{ten} {UNITS[n - 1]}"]

    def ordinal(w: str) -> str:
        head, sep, last = (w.rpartition("-") if "-" in w else w.rpartition(" "))
        return head + sep + (ORDINALS.get(last) or (last[:-1] + "ieth" if last.endswith("y") else last + "th"))

    out: dict[str, int] = {"hundred": 100, "one hundred": 100, "hundredth": 100, "one hundredth": 100}
    for n, names in under.items():
        for w in names:
            for x in (w, ordinal(w)):
                out[x] = n
                for join in ("hundred and ", "one hundred and ", "one hundred "):
                    out[join + x] = 100 + n
    return out


def word_number(text: Column) -> Column:
    """The number that words spell out, 1 to 199, cardinal or ordinal; null for other words."""
    table = F.create_map(*[F.lit(x) for pair in number_words().items() for x in pair])
    return F.try_element_at(table, F.lower(F.trim(F.regexp_replace(text, "\\s+", " "))))


def ascii_digits(text: Column) -> Column:
    """Devanagari digits as ASCII ones."""
    return F.translate(text, DEVANAGARI_DIGITS, "0123456789")


def devanagari_digits(text: Column) -> Column:
    """ASCII digits as Devanagari ones."""
    return F.translate(text, "0123456789", DEVANAGARI_DIGITS)
