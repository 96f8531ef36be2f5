"""Queries over what the other modules leave: infos, records, zipped lists, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import aggregates as A
from ..operators import checks as C
from ..operators import folds, records
from ..operators import lines as L
from ..operators import ordered as O
from ..session import shared_folder
from ..streaming import events as E
from .pages import LINES
from .registered import Register

query = Register()


@query("a1_infos", "select edition_id, trim(regexp_extract(l, '^([^:]*):(.*)$', 1)) key, trim(regexp_extract(l, '^([^:]*):(.*)$', 2)) \"value\" from (select edition_id, unnest(['Label: ' || label, 'Lang: ' || coalesce(lang, ''), 'Pages: 12', 'Other: x']) l from edition) where starts_with(l, 'Label') or starts_with(l, 'Pages')")
def a1_infos(t):
    """Key and value lines of an info text, made from editions for the purpose: two keys are kept."""
    text = F.concat(F.lit("Label: "), F.col("label"), F.lit("\nLang: "), F.coalesce("lang", F.lit("")), F.lit("\nPages: 12\nOther: x"))
    rows = L.lines(t("edition").select("edition_id", text.alias("info")), ["edition_id"], "info")
    part = lambda g: F.trim(F.regexp_extract("line", r"^([^:]*):(.*)$", g))
    return rows.select("edition_id", part(1).alias("key"), part(2).alias("value")).where(F.col("key").isin("Label", "Pages"))


@query("a13_suffixes", "select regexp_extract(file, '\\.([A-Za-z0-9]+)$', 1) suffix, count(*) n, min(file) first_file from manifest_origin where regexp_matches(file, '\\.(png|jpg|tif)$') group by 1")
def a13_suffixes(t):
    """Files of the allowed suffixes."""
    kept = t("manifest_origin").where(F.col("file").rlike(r"\.(png|jpg|tif)$"))
    return kept.groupBy(F.regexp_extract("file", r"\.([A-Za-z0-9]+)$", 1).alias("suffix")).agg(F.count("*").alias("n"), F.min("file").alias("first_file"))


@query("c7_lines_by_script", f"select doc_id, count(case when regexp_matches(line, '[\\x{{0900}}-\\x{{0963}}]') then 1 end) devanagari, count(case when regexp_matches(line, '[A-Za-z]{{2,}}') and not regexp_matches(line, '[\\x{{0900}}-\\x{{0963}}]') then 1 end) latin from ({LINES}) group by 1")
def c7_lines_by_script(t):
    """Lines of each document with Devanagari, and those with Latin words alone."""
    deva = F.col("line").rlike("[\\u0900-\\u0963]")
    return L.lines(t("documents"), ["doc_id"], "text").groupBy("doc_id").agg(F.count_if(deva).alias("devanagari"), F.count_if(F.col("line").rlike("[A-Za-z]{2,}") & ~deva).alias("latin"))


@query("d2_both_passes", "select o.scan_id, o.page, o.n archived, coalesce(e.n, 0) enhanced from (select scan_id, page, count(*) n from manifest_origin where tree = 'archive' group by 1, 2) o left join (select scan_id, page, count(*) n from manifest_origin where tree = 'enhance' group by 1, 2) e on o.scan_id = e.scan_id and o.page is not distinct from e.page")
def d2_both_passes(t):
    """What two passes have of each page."""
    each = t("manifest_origin").groupBy("scan_id", "page").agg(F.count_if(F.col("tree") == "archive").alias("archived"), F.count_if(F.col("tree") == "enhance").alias("enhanced"))
    return each.where("archived > 0")


@query("e4_mean_confidence", "select l_orderkey page, round_even(sum(round(l_tax * 100)::bigint)::double / count(*) * 100, 0)::bigint mean from lineitem where l_tax >= 0 group by 1")
def e4_mean_confidence(t):
    """Means of pages in ten-thousandths, halves to even."""
    mean = F.bround(F.sum(F.round(F.col("l_tax") * 100).cast("long")).cast("double") / F.count("*") * 100, 0).cast("long")
    return t("lineitem").where("l_tax >= 0").groupBy(F.col("l_orderkey").alias("page")).agg(mean.alias("mean"))


@query("e6_distributions", "select tree, count(size_bytes) n, min(size_bytes) least, list_sort(list(size_bytes))[count(size_bytes) // 2 + 1] upper_median, max(size_bytes) most from manifest_origin where size_bytes is not null group by 1")
def e6_distributions(t):
    """Sizes of each tree's files."""
    return A.upper_median(t("manifest_origin"), ["tree"], "size_bytes")


@query("e19_leaves", "select part, case when title_raw is null or title_raw = '' then 'blank' else 'printed' end kind, count(*) n from toc_entry group by 1, 2")
def e19_leaves(t):
    """Leaves by kind."""
    kind = F.when(F.coalesce("title_raw", F.lit("")) == "", "blank").otherwise("printed")
    return t("toc_entry").groupBy("part", kind.alias("kind")).agg(F.count("*").alias("n"))


@query("f7_zipped", """with d as (select distinct scan_id, kanda, canto_no from toc_entry where canto_no >= 1), m as (select scan_id, kanda, unnest(range(1, max(canto_no) + 1))::int n from d group by 1, 2), miss as (select *, row_number() over (partition by scan_id, kanda order by n) k from (select * from m except select * from d)),
 rep as (select *, row_number() over (partition by scan_id, kanda order by canto_no) k from (select scan_id, kanda, canto_no from toc_entry where canto_no >= 1 group by 1, 2, 3 having count(*) > 1)) select scan_id, kanda, n missing, canto_no repeated from miss join rep using (scan_id, kanda, k)""")
def f7_zipped(t):
    """Missing canto numbers beside repeated ones, by their places in order."""
    entries = t("toc_entry").where("canto_no >= 1")
    by = Window.partitionBy("scan_id", "kanda")
    gaps = O.missing_numbers(entries, ["scan_id", "kanda"], "canto_no")
    missing = gaps.select("scan_id", "kanda", F.explode(F.sequence(F.col("first_number").cast("int"), F.col("last_number").cast("int"))).alias("missing")).withColumn("k", F.row_number().over(by.orderBy("missing")))
    repeated = C.repeated(entries, ["scan_id", "kanda", "canto_no"]).withColumn("k", F.row_number().over(by.orderBy("canto_no")))
    return missing.join(repeated, ["scan_id", "kanda", "k"]).select("scan_id", "kanda", "missing", F.col("canto_no").alias("repeated"))


@query("g8_sarga_tiling", """select scan_id, kanda, count(*) breaks from (select *, lag(e) over (partition by scan_id, kanda order by sarga, s, e) b from (select distinct scan_id, kanda, sarga, coalesce(start_page, heading_page) s, end_page e from sarga_span) where s is not null and e is not null) where s not in (b, b + 1) group by 1, 2""")
def g8_sarga_tiling(t):
    """How often a sarga starts neither on nor right after the last page of the one before."""
    spans = t("sarga_span").select("scan_id", "kanda", "sarga", F.coalesce("start_page", "heading_page").alias("s"), F.col("end_page").alias("e")).distinct().where("s is not null and e is not null")
    before = F.lag("e").over(Window.partitionBy("scan_id", "kanda").orderBy("sarga", "s", "e"))
    return spans.withColumn("b", before).where("s <> b and s <> b + 1").groupBy("scan_id", "kanda").agg(F.count("*").alias("breaks"))


@query("i10_heading_lines", f"select doc_id, line_no, trim(line) heading from ({LINES}) where regexp_matches(line, '^\\s*(?:Canto|CANTO)\\s+[IVXLCDM]+\\s*$')")
def i10_heading_lines(t):
    """Lines that are headings."""
    rows = L.lines(t("documents"), ["doc_id"], "text").where(F.col("line").rlike(r"^\s*(?:Canto|CANTO)\s+[IVXLCDM]+\s*$"))
    return rows.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.trim("line").alias("heading"))


@query("i23_last_objects", "select scan_id, kanda, sarga, verse, arg_max(verse_id, (harvested_at, verse_id)) verse_id from verse group by 1, 2, 3, 4")
def i23_last_objects(t):
    """Of verses harvested more than once the last."""
    last = F.max_by("verse_id", F.struct("harvested_at", "verse_id"))
    return t("verse").groupBy("scan_id", "kanda", "sarga", "verse").agg(last.alias("verse_id"))


@query("m2_enums", "select doc_id, unnest(list_filter([case when not coalesce(lang in ('en', 'sa', 'sa_latn', 'mul'), false) then 'lang' end, case when not coalesce(n_chars = length(text), false) then 'n_chars' end, case when not coalesce(source <> '', false) then 'source' end], lambda x: x is not null)) rule from documents")
def m2_enums(t):
    """Documents against their table's rules: known languages, lengths as stated, a source."""
    rules = {"lang": F.col("lang").isin("en", "sa", "sa_latn", "mul"), "n_chars": F.col("n_chars") == F.length("text"), "source": F.col("source") != ""}
    return C.violations(t("documents"), ["doc_id"], rules)


@query("w1_listed_pages", f"""with b as (select doc_id, line_no, line, sum(case when regexp_matches(line, '^\\s{{0,8}}\\d{{1,3}}\\.(?:\\s|$)') then 1 else 0 end) over (partition by doc_id order by line_no rows unbounded preceding) block from ({LINES})),
 p as (select *, coalesce(try_cast(regexp_extract(line, '\\.\\s*(\\d{{1,4}})\\W*$', 1) as bigint), try_cast(regexp_extract(line, '^.{{5,}}[^\\d](\\d{{1,4}})\\W*$', 1) as bigint)) page from b where block > 0)
 select doc_id, block::bigint block, try_cast(arg_min(regexp_extract(line, '^\\s{{0,8}}(\\d{{1,3}})\\.', 1), line_no) as bigint) number, arg_min(page, line_no) filter (where page is not null) page from p group by 1, 2""")
def w1_listed_pages(t):
    """Numbered entries with the first page reference in each."""
    lines = L.lines(t("documents"), ["doc_id"], "text")
    blocks = O.numbered_blocks(lines, ["doc_id"], ["line_no"], F.col("line").rlike(r"^\s{0,8}\d{1,3}\.(?:\s|$)")).where("block > 0")
    page = X.page_reference(F.col("line"))
    number = F.regexp_extract("line", r"^\s{0,8}(\d{1,3})\.", 1).try_cast("long")
    return blocks.groupBy("doc_id", "block").agg(F.min_by(number, "line_no").alias("number"), F.min_by(page, F.when(page.isNotNull(), F.col("line_no"))).alias("page"))


@query("f9_walk")
def f9_walk(t):
    """Where each sarga begins by a walk over headings, with what does not fit its contents."""
    chapters = t("toc_entry").select("scan_id", "kanda", F.col("canto_no").alias("number"), F.col("archive_page").alias("start"))
    markers = t("sarga_span").select("scan_id", "kanda", F.col("heading_page").alias("page"), F.lit(1).alias("line"), F.lit("heading").alias("kind"), F.col("sarga").alias("number"))
    return folds.walk(chapters, markers, ["scan_id", "kanda"])


@query("f12_pages")
def f12_pages(t):
    """Titles of each book on pages of 20 lines, 12 on the first, wrapped to 40 characters."""
    heights = t("toc_entry").select("scan_id", "kanda", "entry_id", folds.lines_at(40)(F.coalesce("title_raw", F.lit(""))).cast("double").alias("height"))
    return folds.pages_of(heights, ["scan_id", "kanda"], ["entry_id"], "height", 12, 20)


@query("k1_page_records")
def k1_page_records(t):
    """Records of scanned pages, whose words are laid out line by line for the purpose."""
    pages = t("documents").where("source like 'scan_page%' and length(text) > 0").select(F.col("doc_id").alias("page"), "text")
    parts = L.lines(pages, ["page"], "text").select("page", F.col("line_no").alias("line"), F.posexplode(X.tokens(F.col("line"))).alias("i", "text"))
    left, top = F.least(F.col("i") * 0.06, F.lit(0.9)), F.least(F.lit(0.02) + F.col("line") * 0.02, F.lit(0.98))
    words = parts.select(
        "page", (F.col("line") * 1000 + F.col("i")).cast("int").alias("word"), "text", F.lit(90.0).alias("conf"), left.cast("double").alias("l"), top.cast("double").alias("t"), (left + 0.05).cast("double").alias("r"), (top + 0.015).cast("double").alias("b"), "line"
    )
    boxes = pages.select("page", F.lit(0).alias("box"), F.lit("text").alias("label"), F.lit(0.0).alias("l"), F.lit(0.065).alias("t"), F.lit(1.0).alias("r"), F.lit(1.0).alias("b"))
    found = records.page_records(words, boxes)
    return found.select("page", "mean_conf", "printed_page", "heading", F.array_join("verse_numbers", ",").alias("verse_numbers"), "english_words", "other_words", F.col("english_box.b").alias("english_end"))


_STREAMED = "user_id bigint, event_id bigint, event_type string, ts timestamp_ntz"


def _stream(spark, sf_dir, name, through):
    """A stream over the events, run until all are read; its rows are written to the shared folder."""
    folder = f"{shared_folder(spark)}/stream-{name}-{uuid.uuid4().hex}"
    rows = E.files(spark, f"{sf_dir}/events.parque[t]", _STREAMED)  # as a pattern it may be one file
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    made = through(rows).writeStream.format("parquet").outputMode("append").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
    made.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def q1_stream_sessions(spark, sf_dir):
    """Sessions of events as a stream; the watermark is two hours behind the last event."""
    found = _stream(spark, sf_dir, "sessions", lambda e: E.sessions(e, ["user_id"], "ts", "6 hours", "2 hours", 2))
    return found.select("user_id", F.col("started").cast("timestamp_ntz").alias("started"), F.col("ended").cast("timestamp_ntz").alias("ended"), "n")


def q2_stream_changes(spark, sf_dir):
    """Events of another type than the user's last one, as a stream with one value of state a user."""
    return _stream(spark, sf_dir, "changes", lambda e: E.changes(e, "user_id", "ts", ["ts", "event_id"], "event_type", "2 hours", "60 days")).select("event_id")


query.queries |= {"q1_stream_sessions": q1_stream_sessions, "q2_stream_changes": q2_stream_changes}
query.oracles |= {
    "q1_stream_sessions": """select user_id, min(ts) started, max(ts) ended, count(*) n from (select *, sum(f) over (partition by user_id order by ts rows unbounded preceding) s from (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) <= interval 6 hour then 0 else 1 end f from events))
 group by user_id, s having count(*) >= 2 and max(ts) + interval 6 hour <= (select date_trunc('millisecond', max(ts)) from events) - interval 2 hour""",
    "q2_stream_changes": "select event_id from (select *, lag(event_type) over (partition by user_id order by ts, event_id) b from events) where b is null or b <> event_type",
}

QUERIES, ORACLES = query.queries, query.oracles
