"""Queries over texts: lines, scripts, numerals, markers, contents lists and page furniture."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numerals as N
from ..functions import text as X
from ..operators import aggregates as A
from ..operators import lines as L
from ..operators import ordered as O
from .registered import Register

query = Register()

LINES = """select doc_id, unnest(range(1, len(a) + 1)) line_no, unnest(a) line
 from (select doc_id, string_split(regexp_replace(text, '\\n\\z', ''), chr(10)) a from documents where length(text) > 0)"""
HEAD = r"^\s*(?:\d{1,4}\s+)?\*\s.*\*(?:\s+\d{1,4})?\s*$|^\s*\d{1,4}\s*$"
LEADER = r"^(.*?\S)\s*\.{2,}\s*(\d{1,4})\s*$"


def _lines(t):
    return L.lines(t("documents"), ["doc_id"], "text")


@query("a6_pages", "select doc_id, unnest(range(1, len(a) + 1)) page, unnest(list_transform(a, lambda x: length(x)))::bigint n_chars from (select doc_id, string_split(text, chr(12)) a from documents where text is not null)")
def a6_pages(t):
    """Documents as pages, split at form feeds."""
    return L.pages(t("documents"), ["doc_id"], "text").select("doc_id", F.col("page").cast("long").alias("page"), F.length("text").cast("long").alias("n_chars"))


@query("a6_lines", f"select doc_id, count(*) n_lines, sum(length(line))::bigint n_chars, count(case when trim(line) = '' then 1 end) n_blank from ({LINES}) group by 1")
def a6_lines(t):
    """Lines of each document, and how many are blank."""
    return _lines(t).groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"), F.count_if(F.trim("line") == "").alias("n_blank"))


@query("a9_json_values", "select event_type, count(*) n, sum(json_extract_string(props, '$.k')::bigint)::bigint sum_k from events group by 1")
def a9_json_values(t):
    """A field of JSON payloads, summed by type."""
    parsed = F.from_json("props", "k long")["k"]
    return t("events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(parsed).alias("sum_k"))


_WORDS = r"regexp_extract_all(coalesce(text, ''), '\S+')"


@query(
    "c4_english_words",
    f"""select doc_id, len(w)::bigint n_words, len(list_filter(w, lambda x: case when length(x) = 1 then x in ('a', 'A', 'I')
 else length(x) > 1 and length(regexp_replace(x, '[A-Za-z''’.,;:!?()\\-]', '', 'g')) <= 0.05 * length(x) end))::bigint n_english
 from (select doc_id, {_WORDS} w from documents)""",
)
def c4_english_words(t):
    """Words of each document and those that are English by their characters."""
    words = X.tokens(F.col("text"))
    return t("documents").select("doc_id", F.size(words).cast("long").alias("n_words"), F.size(F.filter(words, X.is_english_word)).cast("long").alias("n_english"))


@query(
    "c5_scripts",
    f"""select doc_id, script, count(*) n from (select doc_id, case when regexp_matches(w, '[\\x{{0900}}-\\x{{0963}}\\x{{0970}}-\\x{{097F}}]') then 'devanagari'
 when regexp_matches(w, '\\p{{Latin}}') then 'latin' when regexp_matches(w, '[0-9\\x{{0966}}-\\x{{096F}}]') then 'number' else 'other' end script
 from (select doc_id, unnest({_WORDS}) w from documents)) group by 1, 2""",
)
def c5_scripts(t):
    """Words of each document by script."""
    words = t("documents").select("doc_id", F.explode(X.tokens(F.col("text"))).alias("w"))
    return words.groupBy("doc_id", X.script_of(F.col("w")).alias("script")).agg(F.count("*").alias("n"))


@query("c6_english_lines", f"select doc_id, count(case when regexp_matches(line, '[A-Za-z][^\\x00]*[A-Za-z]') then 1 end) n_english, count(*) n_lines from ({LINES}) group by 1")
def c6_english_lines(t):
    """Lines with two ASCII letters at least, by document."""
    return _lines(t).groupBy("doc_id").agg(F.count_if(F.length(F.regexp_replace("line", "[^A-Za-z]", "")) >= 2).alias("n_english"), F.count("*").alias("n_lines"))


@query("c8_prose_lines", f"""select doc_id, count(*) n from ({LINES}) where length(trim(line)) >= 3 and not regexp_matches(line, '{HEAD}')
 and (regexp_matches(line, '\\(\\s*\\d') or length(regexp_replace(line, '[^A-Za-z]', '', 'g')) > 0.6 * length(line)) group by 1""")
def c8_prose_lines(t):
    """Lines of prose: no heads and page numbers; most characters are letters, or a verse number stands in them."""
    letters = F.length(F.regexp_replace("line", "[^A-Za-z]", ""))
    kept = (F.length(F.trim("line")) >= 3) & ~F.col("line").rlike(HEAD) & (F.col("line").rlike(r"\(\s*\d") | (letters > 0.6 * F.length("line")))
    return _lines(t).where(kept).groupBy("doc_id").agg(F.count("*").alias("n"))


_COMMON = ["the", "and", "for", "that", "while", "before"]


@query("c9_junk_lines", f"""select doc_id, count(*) n from ({LINES}) where trim(line) <> '' and not list_has_any(
 list_filter(regexp_extract_all(lower(line), '[a-z]+'), lambda x: length(x) >= 3), {_COMMON!r}) group by 1""")
def c9_junk_lines(t):
    """Lines that hold none of the common words."""
    words = F.filter(X.tokens(F.lower("line"), "[a-z]+"), lambda w: F.length(w) >= 3)
    junk = (F.trim("line") != "") & ~F.arrays_overlap(words, F.array(*map(F.lit, _COMMON)))
    return _lines(t).where(junk).groupBy("doc_id").agg(F.count("*").alias("n"))


@query("c14_thin_texts", "select doc_id, len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]{3,}'))::bigint tokens from documents where len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]{3,}')) < 25")
def c14_thin_texts(t):
    """Documents of fewer than 25 words of three letters; a missing text has none."""
    return t("documents").select("doc_id", F.size(X.tokens(F.col("text"), "[A-Za-z]{3,}")).cast("long").alias("tokens")).where("tokens < 25")


@query("c17_contained", "select item_id, contains(coalesce(passage, ''), answer) found from evalitem where answer is not null")
def c17_contained(t):
    """Whether each answer stands in its passage; a missing passage holds nothing."""
    return t("evalitem").where("answer is not null").select("item_id", F.contains(F.coalesce("passage", F.lit("")), F.col("answer")).alias("found"))


@query("e9_glyphs", "select character, count(*) n from (select unnest(regexp_extract_all(text, '[^\\x00-\\x7F]')) \"character\" from documents) group by 1")
def e9_glyphs(t):
    """How often each character beyond ASCII occurs in all documents."""
    return A.characters(t("documents"), [], "text", "[^\\x00-\\x7F]")


_GLYPHS = [("ā", "a"), ("ī", "i"), ("ū", "u"), ("ṛ", "r"), ("ṇ", "n"), ("ṭ", "t"), ("ḍ", "d"), ("ś", "s"), ("ṣ", "s"), ("ṃ", "m"), ("ḥ", "h"), ("“", '"'), ("”", '"'), ("’", "'")]


@query("i1_glyphs_mapped", "select verse_id, translate(replace(translation, '—', ' - '), '{}', '{}') plain from verse where translation is not null".format("".join(a for a, _ in _GLYPHS), "".join(b for _, b in _GLYPHS).replace("'", "''")))
def i1_glyphs_mapped(t):
    """Translations with their glyphs mapped to ASCII, sequences first."""
    return t("verse").where("translation is not null").select("verse_id", X.translated(F.col("translation"), _GLYPHS, [("—", " - ")]).alias("plain"))


@query("i2_page_chrome", f"""select doc_id, line_no, line from (select *, min(case when not (trim(line) = '' or regexp_matches(line, '{HEAD}')) or line_no > 9 then line_no end)
 over (partition by doc_id) first_line from ({LINES})) where trim(line) <> '' and line_no < coalesce(first_line, 10) and regexp_matches(line, '{HEAD}')""")
def i2_page_chrome(t):
    """Running heads and page numbers at the tops of documents."""
    return L.without_chrome(_lines(t), ["doc_id"], F.col("line").rlike(HEAD)).where("chrome").select("doc_id", F.col("line_no").cast("long").alias("line_no"), "line")


@query("i2_body_text", f"""select doc_id, count(*) n_lines, sum(length(line))::bigint n_chars from (select *, min(case when not (trim(line) = '' or regexp_matches(line, '{HEAD}')) or line_no > 9 then line_no end)
 over (partition by doc_id) first_line from ({LINES})) where not (trim(line) <> '' and line_no < coalesce(first_line, 10) and regexp_matches(line, '{HEAD}')) group by 1""")
def i2_body_text(t):
    """What is left of documents without their heads."""
    kept = L.without_chrome(_lines(t), ["doc_id"], F.col("line").rlike(HEAD)).where("not chrome")
    return kept.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


@query("i2_repeated_lines", f"select shape, count(*) n from (select trim(regexp_replace(regexp_replace(line, '[0-9]+', '#', 'g'), '\\s+', ' ', 'g')) shape from ({LINES})) where shape <> '' group by 1 having count(*) >= 20")
def i2_repeated_lines(t):
    """Lines that, their numbers aside, stand in many documents."""
    return L.repeated_lines(_lines(t), "line", 20)


@query("i3_unmapped_words", f"""select w word, count(*) n from (select unnest({_WORDS}) w from documents) where regexp_matches(w, '[A-Za-z]{{2,}}') and not regexp_matches(w, '[\\x{{0900}}-\\x{{097F}}]')
 and regexp_matches(w, '[^\\x00-\\x7EāīūṛṝḷṇṭḍñṅśṣṃḥĀĪŪṚṆṬḌŚṢ“”‘’—–]') group by 1""")
def i3_unmapped_words(t):
    """English words with characters that no mapping should leave."""
    words = t("documents").select(F.explode(X.tokens(F.col("text"))).alias("word"))
    odd = F.col("word").rlike("[^\\x00-\\x7EāīūṛṝḷṇṭḍñṅśṣṃḥĀĪŪṚṆṬḌŚṢ“”‘’—–]")
    return words.where(F.col("word").rlike("[A-Za-z]{2,}") & ~F.col("word").rlike("[\\u0900-\\u097F]") & odd).groupBy("word").agg(F.count("*").alias("n"))


_HEADING = r"^\s*Canto\s+([IVXLCDM]+)\s*$"
# Every numeral up to the largest that the engine writes, made by the oracle itself.
_ROMANS = """(select n, list_extract(['','I','II','III','IV','V','VI','VII','VIII','IX'], n % 10 + 1) o1, list_extract(['','X','XX','XXX','XL','L','LX','LXX','LXXX','XC'], n // 10 % 10 + 1) o10,
 list_extract(['','C','CC','CCC','CD','D','DC','DCC','DCCC','CM'], n // 100 % 10 + 1) o100, repeat('M', n // 1000) o1000, o1000 || o100 || o10 || o1 roman from (select unnest(range(1, 4000)) n))"""


@query("i4_headings", f"select doc_id, line_no, regexp_extract(line, '{_HEADING}', 1) numeral, n::int number from ({LINES}) l left join {_ROMANS} r on r.roman = regexp_extract(line, '{_HEADING}', 1) where regexp_matches(line, '{_HEADING}')")
def i4_headings(t):
    """Headings with the value of their Roman numerals."""
    found = _lines(t).where(F.col("line").rlike(_HEADING)).withColumn("numeral", F.regexp_extract("line", _HEADING, 1))
    return found.select("doc_id", F.col("line_no").cast("long").alias("line_no"), "numeral", N.roman_to_int(F.col("numeral")).alias("number"))


@query("i5_roman_numbers", f"select entry_id, roman from toc_entry left join {_ROMANS} on n = canto_no")
def i5_roman_numbers(t):
    """Canto numbers as Roman numerals."""
    return t("toc_entry").select("entry_id", N.int_to_roman(F.col("canto_no")).alias("roman"))


@query("i6_repaired_numerals", f"select doc_id, line_no, upper(translate(translate(numeral, 'l!', 'II'), '|1', 'II')) repaired from (select doc_id, line_no, regexp_extract(line, '^\\s*Canto\\s+([IVXLCDMl|!1]+)', 1) numeral from ({LINES})) where numeral <> ''")
def i6_repaired_numerals(t):
    """Numerals with strokes that scans read as other signs."""
    found = _lines(t).select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.regexp_extract("line", r"^\s*Canto\s+([IVXLCDMl|!1]+)", 1).alias("numeral")).where("numeral <> ''")
    return found.select("doc_id", "line_no", N.repaired_roman(F.col("numeral")).alias("repaired"))


@query("i7_letter_keys", "select name, array_to_string(list_sort(string_split(upper(name), '')), '') key from (select distinct name from toc_entry where name is not null)")
def i7_letter_keys(t):
    """The letters of each name in order."""
    return t("toc_entry").where("name is not null").select("name").distinct().select("name", N.letter_key(F.col("name")).alias("key"))


@query("i8_dropped_letters", f"""select a.n::int seen, b.n::int meant from {_ROMANS} a join {_ROMANS} b on length(a.roman) = length(b.roman) - 1 where a.n <= 60 and b.n <= 60
 and list_bool_and([len(string_split(a.roman, x)) <= len(string_split(b.roman, x)) for x in ['I','V','X','L','C','D','M']])""")
def i8_dropped_letters(t):
    """Which numerals up to 60 may be others with one letter lost."""
    spark = t("region").sparkSession
    numbers = spark.range(1, 61, numPartitions=1).select(F.col("id").cast("int").alias("n"), N.int_to_roman(F.col("id")).alias("roman"), F.length(N.int_to_roman(F.col("id"))).alias("size"))
    a, b = numbers.select(F.col("n").alias("seen"), F.col("roman").alias("x"), (F.col("size") + 1).alias("size")), numbers.select(F.col("n").alias("meant"), F.col("roman").alias("y"), "size")
    return a.join(b, "size").where(N.drops_one_letter(F.col("x"), F.col("y"))).select("seen", "meant")


_ORDINALS = {"first": 1, "second": 2, "third": 3, "fourth": 4, "fifth": 5, "sixth": 6, "seventh": 7, "eighth": 8, "ninth": 9, "tenth": 10, "eleventh": 11, "twelfth": 12, "thirteenth": 13, "fourteenth": 14, "fifteenth": 15, "twentieth": 20, "thirtieth": 30}


@query("i9_number_words", "select number, count(*) n from (select case w " + " ".join(f"when '{w}' then {n}" for w, n in _ORDINALS.items()) + f" end number from (select unnest(regexp_extract_all(lower(text), '({'|'.join(_ORDINALS)})\\b')) w from documents)) where number is not null group by 1")
def i9_number_words(t):
    """Ordinals spelled out in documents, by value."""
    words = t("documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"({'|'.join(_ORDINALS)})\\b"), F.lit(1))).alias("w"))
    return words.select(N.word_number(F.col("w")).alias("number")).where("number is not null").groupBy("number").agg(F.count("*").alias("n"))


@query("i12_verse_markers", """select verse_id, array_to_string(list_transform(regexp_extract_all(translation, '\\(\\s*(\\d+(?:\\s*[-–—]\\s*\\d+)?)\\s*\\)', 1), lambda m: regexp_replace(m, '\\s*[-–—]\\s*', '-')), ' ') markers
 from verse where len(regexp_extract_all(translation, '\\(\\s*(\\d+(?:\\s*[-–—]\\s*\\d+)?)\\s*\\)', 1)) > 0""")
def i12_verse_markers(t):
    """The verse numbers that translations carry."""
    return t("verse").select("verse_id", F.array_join(X.verse_markers(F.col("translation")), " ").alias("markers")).where("markers <> ''")


@query("i13_page_references", f"""select doc_id, line_no, page from (select doc_id, line_no, coalesce(try_cast(regexp_extract(line, '\\.\\s*(\\d{{1,4}})\\W*$', 1) as bigint),
 try_cast(regexp_extract(line, '^.{{5,}}[^\\d](\\d{{1,4}})\\W*$', 1) as bigint)) page from ({LINES})) where page is not null""")
def i13_page_references(t):
    """Page numbers at the ends of lines."""
    return _lines(t).select("doc_id", F.col("line_no").cast("long").alias("line_no"), X.page_reference(F.col("line")).alias("page")).where("page is not null")


@query("i14_leaders", f"select doc_id, line_no, regexp_extract(line, '{LEADER}', 1) title, regexp_extract(line, '{LEADER}', 2)::bigint page from ({LINES}) where regexp_matches(line, '{LEADER}')")
def i14_leaders(t):
    """Contents lines: title and page."""
    return _lines(t).select("doc_id", F.col("line_no").cast("long").alias("line_no"), X.leader(F.col("line")).alias("l")).where("l is not null").select("doc_id", "line_no", "l.title", "l.page")


@query("i15_plain_letters", "select distinct name, strip_accents(name) plain from toc_entry where name is not null")
def i15_plain_letters(t):
    """Names without combining marks."""
    return t("toc_entry").where("name is not null").select("name").distinct().select("name", X.without_marks("name").alias("plain"))


@query("i16_transliterated")
def i16_transliterated(t):
    """Devanagari verses in transliteration."""
    return t("verse").where("text_devanagari <> ''").select("verse_id", X.transliterated("text_devanagari").alias("transliteration"))


@query("i17_danda_spacing", "select verse_id, trim(regexp_replace(regexp_replace(text_devanagari_alt, '\\s*(।+)\\s*', ' \\1 ', 'g'), ' +', ' ', 'g')) spaced from verse where text_devanagari_alt <> ''")
def i17_danda_spacing(t):
    """Verses whose strokes are set off by spaces."""
    return t("verse").where("text_devanagari_alt <> ''").select("verse_id", X.danda_spaced(F.col("text_devanagari_alt")).alias("spaced"))


@query("i18_digits", "select verse_id, translate(text_devanagari_alt, '०१२३४५६७८९', '0123456789') ascii, translate(text_devanagari, '0123456789', '०१२३४५६७८९') devanagari from verse")
def i18_digits(t):
    """Digits of one script in the other."""
    return t("verse").select("verse_id", N.ascii_digits(F.col("text_devanagari_alt")).alias("ascii"), N.devanagari_digits(F.col("text_devanagari")).alias("devanagari"))


@query("i19_without_reference", "select verse_id, regexp_replace(text_devanagari, '\\s*(?:।।|\\|\\|)\\s*[0-9०-९]+(?:\\.[0-9०-९]+)*\\s*(?:।।|\\|\\|)\\s*$', '') bare from verse where text_devanagari is not null")
def i19_without_reference(t):
    """Verses without their reference numbers."""
    return t("verse").where("text_devanagari is not null").select("verse_id", X.without_reference(F.col("text_devanagari")).alias("bare"))


@query("i20_escaped", "select doc_id, md5(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')) html from documents where text is not null")
def i20_escaped(t):
    """Documents escaped for HTML (their hashes)."""
    return t("documents").where("text is not null").select("doc_id", F.md5(X.escaped(F.col("text"))).alias("html"))


@query("i24_without_tags", "select doc_id, length(regexp_replace(text, '<[^>]+>', '', 'g'))::bigint n_chars from documents where text is not null")
def i24_without_tags(t):
    """Lengths of documents without markup."""
    return t("documents").where("text is not null").select("doc_id", F.length(X.without_tags(F.col("text"))).cast("long").alias("n_chars"))


@query("i25_roots", "select doc_id from documents where contains(lower(text), 'candra') or contains(lower(text), 'moonlit')")
def i25_roots(t):
    """Documents that hold one of some roots."""
    return t("documents").where(X.has_root(F.col("text"), ["candra", "moonlit"])).select("doc_id")


@query("i26_non_speech", f"select doc_id, count(*) n from ({LINES}) where regexp_matches(trim(line), '^\\[[^\\]]*\\]$') group by 1")
def i26_non_speech(t):
    """Caption lines that are sounds."""
    return _lines(t).where(X.is_non_speech(F.col("line"))).groupBy("doc_id").agg(F.count("*").alias("n"))


@query("i27_file_names", "select distinct scan_id, tree, page, printf('page-%04d.png', page) expected, file <> printf('page-%04d.png', page) wrong from manifest_origin where page is not null")
def i27_file_names(t):
    """Zero-padded file names of pages beside those listed."""
    name = F.format_string("page-%04d.png", "page")
    return t("manifest_origin").where("page is not null").select("scan_id", "tree", "page", name.alias("expected"), (F.col("file") != name).alias("wrong")).distinct()


@query("f4_changed_lines", f"""select doc_id, count(*) n from (select doc_id, line, lag(line) over (partition by doc_id order by line_no) before from ({LINES}) where trim(line) <> '')
 where before is null or before <> line group by 1""")
def f4_changed_lines(t):
    """Lines of each document that don't repeat the one before."""
    return O.changes(_lines(t), ["doc_id"], ["line_no"], "line").groupBy("doc_id").agg(F.count("*").alias("n"))


@query("f5_entry_blocks", f"""select doc_id, block, count(*) n_lines, min(line_no) first_line from (select doc_id, line_no, sum(case when regexp_matches(line, '^\\s{{0,8}}\\d{{1,3}}\\.\\s+\\S') then 1 else 0 end)
 over (partition by doc_id order by line_no rows unbounded preceding)::bigint block from ({LINES})) where block > 0 group by 1, 2""")
def f5_entry_blocks(t):
    """Numbered entries with the lines that continue them."""
    blocks = O.numbered_blocks(_lines(t), ["doc_id"], ["line_no"], F.col("line").rlike(r"^\s{0,8}\d{1,3}\.\s+\S"))
    return blocks.where("block > 0").groupBy("doc_id", "block").agg(F.count("*").alias("n_lines"), F.min("line_no").cast("long").alias("first_line"))


@query("j1_contents", f"""with entries as (select doc_id, block, list(line order by line_no) l, min(line_no) first_line from (select *, sum(case when regexp_matches(line, '^\\s{{0,8}}\\d{{1,3}}\\.\\s+\\S') then 1 else 0 end)
 over (partition by doc_id order by line_no rows unbounded preceding) block from ({LINES})) where block > 0 group by 1, 2),
 joined as (select doc_id, first_line, regexp_replace(regexp_replace(array_to_string(list_transform(l, lambda x: trim(x)), ' '), '- ', '-', 'g'), '\\s+', ' ', 'g') s from entries)
 select doc_id, first_line, try_cast(regexp_extract(s, '^(\\d{{1,3}})\\.\\s+(.*)$', 1) as bigint) number, trim(coalesce(nullif(regexp_extract(regexp_extract(s, '^(\\d{{1,3}})\\.\\s+(.*)$', 2), '{LEADER}', 1), ''), regexp_extract(s, '^(\\d{{1,3}})\\.\\s+(.*)$', 2))) title,
 try_cast(regexp_extract(regexp_extract(s, '^(\\d{{1,3}})\\.\\s+(.*)$', 2), '{LEADER}', 2) as bigint) page from joined""")
def j1_contents(t):
    """Tables of contents as entries: number, title with its continuation lines, page."""
    blocks = O.numbered_blocks(_lines(t), ["doc_id"], ["line_no"], F.col("line").rlike(r"^\s{0,8}\d{1,3}\.\s+\S")).where("block > 0")
    whole = A.ordered_text(blocks.withColumn("line", F.trim("line")), ["doc_id", "block"], ["line_no"], "line", " ")
    firsts = blocks.groupBy("doc_id", "block").agg(F.min("line_no").cast("long").alias("first_line"))
    s = F.regexp_replace(F.regexp_replace("text", "- ", "-"), "\\s+", " ")
    parsed = whole.join(firsts, ["doc_id", "block"]).select("doc_id", "first_line", F.regexp_extract(s, r"^(\d{1,3})\.\s+(.*)$", 1).try_cast("long").alias("number"), F.regexp_extract(s, r"^(\d{1,3})\.\s+(.*)$", 2).alias("rest"))
    found = X.leader(F.col("rest"))
    return parsed.select("doc_id", "first_line", "number", F.trim(F.coalesce(found["title"], "rest")).alias("title"), found["page"].alias("page"))


QUERIES, ORACLES = query.queries, query.oracles
