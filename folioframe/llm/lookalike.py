"""Values that read alike in one form: DuckDB inside Arrow partitions.

Each Arrow batch is a table of an in-memory DuckDB of the worker, and one SQL expression per
field brings its values into the field's script. Rows are only mapped: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACES = "".join(map(chr, [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Drawn as nothing. The joiners are apart: right after a virama they belong to the text.
INVISIBLE = "".join(map(chr, [0xAD, 0x034F, 0x061C, 0x180E, 0x200B, 0x200E, 0x200F, *range(0x202A, 0x202F), *range(0x2060, 0x2065), *range(0x2066, 0x206A), *range(0xFE00, 0xFE10), 0xFEFF]))
JOINERS = chr(0x200C) + chr(0x200D)
VIRAMA = chr(0x94D)
WIDE = {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}
BARS = "ǀ∣❘⏐￨"
#: Cyrillic, Greek and phonetic letters drawn as the Latin ones; all of one drawing.
LATIN = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J",
    "ν": "v", "ο": "o", "υ": "u", "α": "a", "ι": "i", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ɡ": "g", "ɑ": "a", "ı": "i",
    "।": "|", "‘": "'", "’": "'", "ʼ": "'", "ʹ": "'", "′": "'", "ऽ": "'", "ः": "ḥ", "ं": "ṃ",
}
#: A combining dot or candrabindu, a colon and bars drawn as the Devanagari signs.
DEVANAGARI = {"̇": "ं", "̐": "ँ", ":": "ः", "꞉": "ः", "ː": "ः", "|": "।"}
#: A letter or sign with a further sign, drawn as one character that exists.
VOWELS = {
    "ाे": "ो", "ाै": "ौ", "ाॅ": "ॉ", "ाॆ": "ॊ",
    "अा": "आ", "अो": "ओ", "अौ": "औ", "अॉ": "ऑ", "अॊ": "ऒ", "अॅ": "ॲ", "अॆ": "ऄ",
    "आे": "ओ", "आै": "औ", "आॅ": "ऑ", "आॆ": "ऒ",
    "एे": "ऐ", "एॅ": "ऍ", "एॆ": "ऎ", "उु": "ऊ", "र्इ": "ई",
}
#: Letters with a nukta, which NFC takes apart although the one character exists.
NUKTA = {chr(a) + "़": chr(b) for a, b in zip([0x915, 0x916, 0x917, 0x91C, 0x921, 0x922, 0x92B, 0x92F], range(0x958, 0x960))}
ASCII_DIGITS, DEVANAGARI_DIGITS = "0123456789", "".join(map(chr, range(0x966, 0x970)))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _mapped(sql: str, table: Mapping[str, str]) -> str:
    single = {a: b for a, b in table.items() if len(a) == len(b) == 1}
    if single:
        sql = f"translate({sql}, {_quoted(''.join(single))}, {_quoted(''.join(single.values()))})"
    for a, b in table.items():
        if a not in single:
            sql = f"replace({sql}, {_quoted(a)}, {_quoted(b)})"
    return sql


def form_sql(column: str, script: str) -> str:
    """DuckDB expression: the consistent form of a column in `latin`, `devanagari` (ASCII
    digits) or `devanagari_digits`."""
    # The removed characters stand at the end of translate's list, without a counterpart.
    sql = f"translate({column}, {_quoted(SPACES + INVISIBLE)}, {_quoted(' ' * len(SPACES))})"
    if script == "latin":
        sql = f"translate({sql}, {_quoted(JOINERS)}, '')"
        sql = _mapped(sql, WIDE | dict.fromkeys(BARS, "|") | {"॥": "||", "‖": "||"} | dict(zip(DEVANAGARI_DIGITS, ASCII_DIGITS)))
        return f"nfc_normalize({_mapped(sql, LATIN)})"
    sql = f"regexp_replace({sql}, {_quoted(f'({VIRAMA}[{JOINERS}])|[{JOINERS}]')}, '\\1', 'g')"
    sql = _mapped(sql, WIDE | dict.fromkeys(BARS, "|"))
    sql = _mapped(sql, DEVANAGARI | {"॥": "।।", "‖": "।।"})
    digits = (ASCII_DIGITS, DEVANAGARI_DIGITS) if script == "devanagari_digits" else (DEVANAGARI_DIGITS, ASCII_DIGITS)
    sql = _mapped(sql, dict(zip(*digits)))
    return _mapped(f"nfc_normalize({sql})", VOWELS | NUKTA)


def cases_sql(table: str, key: str, scripts: Mapping[str, str]) -> str:
    """The values of each field that are not in the form."""
    return " union all ".join(
        f"select {key}, '{f}' as field, {f} as value, {form_sql(f, s)} as form from {table} where {f} <> '' and {f} <> {form_sql(f, s)}" for f, s in scripts.items()
    )


def cases(df: DataFrame, key: str, scripts: Mapping[str, str]) -> DataFrame:
    """Values that are not in the consistent form: key, field, value, form.

    `scripts` maps a field to its script (form_sql). Defined cases: null and empty values are
    no cases; repeated rows each count; other columns are ignored.
    """
    sql = cases_sql("batch", key, scripts)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with duckdb.connect(config={"threads": 1, "memory_limit": "400MB"}) as db:
            for batch in batches:
                db.register("batch", pa.Table.from_batches([batch]))
                yield from db.sql(sql).to_arrow_table().to_batches()
                db.unregister("batch")

    return df.select(key, *[F.col(f).cast("string") for f in scripts]).mapInArrow(run, f"{key} {kind}, field string, value string, form string")
