"""Queries over tables: look-ups, ranges, aggregates, windows, samples and orders."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as X
from ..operators import aggregates as A
from ..operators import checks as C
from ..operators import ordered as O
from ..operators.reconcile import digest
from .registered import Register

query = Register()

_SPAN = "(select scan_id, kanda, sarga, coalesce(start_page, heading_page) s, end_page e, mapped_at from sarga_span)"
_PAGE_RUNS = """(select scan_id, tree, min(page)::bigint a, max(page)::bigint b from (select *, page - row_number() over (partition by scan_id, tree order by page) r
 from (select distinct scan_id, tree, page from manifest_origin where page is not null)) group by scan_id, tree, r)"""
_DIGEST = "regexp_replace(regexp_replace(lower({0}), '^[\\s\\x{{00a0}}]*(sha-?256[\\s\\x{{00a0}}]*[:=]|0x)', ''), '[\\s\\x{{00a0}}:._-]', '', 'g')"


def _spans(t):
    return t("sarga_span").select("scan_id", "kanda", "sarga", F.coalesce("start_page", "heading_page").alias("s"), F.col("end_page").alias("e"), "mapped_at")


@query("b5_index", "select entry_id, edition_id, scan_id, part, kanda, canto_no, printed_page, archive_page from toc_entry")
def b5_index(t):
    """Contents without their texts: only the columns needed are read."""
    return t("toc_entry").drop("name", "title_raw", "printed_as")


@query("b6_report", """select 'source ' || source || ': ' || count(*) || ' texts, ' || sum(case when trim(coalesce(text, '')) = '' then 1 else 0 end)::bigint || ' blank, languages ' ||
 coalesce(string_agg(distinct lang, ', ' order by lang), '-') line from documents group by source""")
def b6_report(t):
    """A report line for each source."""
    blank = F.sum((F.trim(F.coalesce("text", F.lit(""))) == "").cast("long"))
    langs = F.array_join(F.array_sort(F.collect_set("lang")), ", ")
    counted = t("documents").groupBy("source").agg(F.count("*").alias("n"), blank.alias("b"), F.when(langs != "", langs).alias("l"))
    return counted.select(F.format_string("source %s: %d texts, %d blank, languages %s", "source", "n", "b", F.coalesce("l", F.lit("-"))).alias("line"))


@query("b13_envelopes", "select scan_id, part, kanda, count(*) entries, count(distinct canto_no) cantos, sha256(string_agg(coalesce(title_raw, ''), chr(10) order by entry_id)) content from toc_entry group by 1, 2, 3")
def b13_envelopes(t):
    """Each book's contents with their number and a digest of all titles."""
    titles = t("toc_entry").withColumn("title", F.coalesce("title_raw", F.lit("")))
    book = ["scan_id", "part", "kanda"]
    text = A.ordered_text(titles, book, ["entry_id"], "title", "\n").select(*book, F.sha2("text", 256).alias("content"))
    return titles.groupBy(*book).agg(F.count("*").alias("entries"), F.countDistinct("canto_no").alias("cantos")).join(text, book)


@query("c1_page_range", "select tree, count(*) n from manifest_origin where page between 10 and 50 group by 1")
def c1_page_range(t):
    """Rows of a page range, both ends included; the filter is pushed to the scan."""
    return t("manifest_origin").where(F.col("page").between(10, 50)).groupBy("tree").agg(F.count("*").alias("n"))


_FIELDS = ["text_devanagari", "text_devanagari_alt", "transliteration", "translation", "explanation"]


@query("c13_gap_profile", "select * from (select verse_id, concat_ws(',', " + ", ".join(f"case when coalesce({f}, '') = '' then '{f}' end" for f in _FIELDS) + ") missing from verse) where missing <> ''")
def c13_gap_profile(t):
    """Verses with missing fields and their names; an empty text is missing."""
    names = F.concat_ws(",", *[F.when(F.coalesce(f, F.lit("")) == "", f) for f in _FIELDS])
    return t("verse").select("verse_id", names.alias("missing")).where("missing <> ''")


@query("c15_tags", f"""select * from (select scan_id, tree, page, listed_at, concat_ws(',', case when size_bytes < 1100000 then 'small' end, case when sha256 is null then 'no digest' end,
 case when length({_DIGEST.format('sha256')}) <> 64 then 'cut digest' end, case when tree = 'enhance' and source_sha256 is null then 'no source' end) tags from manifest_origin) where tags <> ''""")
def c15_tags(t):
    """Pages with what is doubtful about them."""
    tags = F.concat_ws(
        ",", F.when(F.col("size_bytes") < 1_100_000, "small"), F.when(F.col("sha256").isNull(), "no digest"), F.when(F.length(digest(F.col("sha256"))) != 64, "cut digest"),
        F.when((F.col("tree") == "enhance") & F.col("source_sha256").isNull(), "no source"),
    )
    return t("manifest_origin").select("scan_id", "tree", "page", "listed_at", tags.alias("tags")).where("tags <> ''")


@query("c16_findings", """select scan_id, case when count(distinct ext) > 1 then 'WARN mixed formats' when max(size_bytes) - min(size_bytes) < 100000 then 'INFO even sizes' else 'ok' end finding, count(*) n
 from (select scan_id, size_bytes, regexp_extract(file, '\\.([a-z0-9]+)$', 1) ext from manifest_origin) group by 1""")
def c16_findings(t):
    """One finding for each scan, by rules in order."""
    files = t("manifest_origin").withColumn("ext", F.regexp_extract("file", r"\.([a-z0-9]+)$", 1))
    rule = F.when(F.countDistinct("ext") > 1, "WARN mixed formats").when(F.max("size_bytes") - F.min("size_bytes") < 100_000, "INFO even sizes").otherwise("ok")
    return files.groupBy("scan_id").agg(rule.alias("finding"), F.count("*").alias("n"))


@query("d3_lookup", "select v.verse_id, e.label, e.edition_id is null missing from verse v left join edition e using (edition_id)")
def d3_lookup(t):
    """Verses with their edition's label, and whether the edition is unknown."""
    editions = t("edition").select("edition_id", "label", F.lit(True).alias("_in"))
    return t("verse").join(editions, "edition_id", "left").select("verse_id", "label", F.col("_in").isNull().alias("missing"))


@query("d4_as_of", "select l.event_id, r.event_id signup_id, r.ts signed_up from (select * from events where event_type = 'view') l asof left join (select * from events where event_type = 'signup') r on l.user_id = r.user_id and l.ts >= r.ts")
def d4_as_of(t):
    """Each view with its user's last signup before it."""
    e = t("events")
    signups = e.where("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("signup_id"), F.col("ts").alias("signed_up"))
    return O.as_of(e.where("event_type = 'view'").select("event_id", "user_id", "ts"), signups, ["user_id"], "ts", "signup_id", ["signup_id", "signed_up"]).select("event_id", "signup_id", "signed_up")


@query("d5_page_index", f"""select scan_id, kanda, position, arg_max(sarga, (sarga, mapped_at)) sarga from (select scan_id, kanda, sarga, mapped_at, unnest(range(s, e + 1))::int "position" from {_SPAN} where s <= e) group by 1, 2, 3""")
def d5_page_index(t):
    """The sarga of each page; of overlapping ones the later."""
    return O.page_index(_spans(t), ["scan_id", "kanda"], "s", "e", ["sarga", "mapped_at"], ["sarga"])


@query("d6_heads_above", """select entry_id, last_value(case when canto_no = 1 then name end ignore nulls) over (partition by scan_id, part order by archive_page, entry_id rows unbounded preceding) book from toc_entry where archive_page is not null""")
def d6_heads_above(t):
    """Each entry with the name of the last first canto above it."""
    order = Window.partitionBy("scan_id", "part").orderBy("archive_page", "entry_id").rowsBetween(Window.unboundedPreceding, 0)
    return t("toc_entry").where("archive_page is not null").select("entry_id", F.last(F.when(F.col("canto_no") == 1, F.col("name")), ignorenulls=True).over(order).alias("book"))


@query("d7_reconciled", """with a as (select scan_id, kanda, canto_no sarga, min(archive_page) page from toc_entry group by 1, 2, 3), b as (select scan_id, kanda, sarga, min(heading_page) page from sarga_span group by 1, 2, 3)
 select coalesce(a.scan_id, b.scan_id) scan_id, coalesce(a.kanda, b.kanda) kanda, coalesce(a.sarga, b.sarga) sarga, a.page toc_page, b.page map_page,
 case when b.scan_id is null then 'toc_only' when a.scan_id is null then 'map_only' when a.page is not distinct from b.page then 'matched' else 'mismatch' end status
 from a full join b on a.scan_id = b.scan_id and a.kanda = b.kanda and a.sarga is not distinct from b.sarga""")
def d7_reconciled(t):
    """Contents and page map side by side."""
    toc = t("toc_entry").groupBy("scan_id", "kanda", F.col("canto_no").alias("sarga")).agg(F.min("archive_page").alias("page"))
    book = t("sarga_span").groupBy("scan_id", "kanda", "sarga").agg(F.min("heading_page").alias("page"))
    return C.reconcile(toc, book, ["scan_id", "kanda", "sarga"], "page", ("toc", "map"))


@query("d8_lineage", f"""with e as (select scan_id, page, {_DIGEST.format('source_sha256')} d from manifest_origin where tree = 'enhance'), a as (select distinct scan_id, page, {_DIGEST.format('sha256')} d from manifest_origin where tree = 'archive')
 select status, count(*) n from (select case when e.d is null then 'no source' when exists (select 1 from a where a.scan_id = e.scan_id and a.page = e.page and a.d = e.d) then 'ok' else 'broken' end status from e) group by 1""")
def d8_lineage(t):
    """Whether enhanced pages name the digest of an archived one."""
    m = t("manifest_origin")
    enhanced = m.where("tree = 'enhance'").select("scan_id", "page", digest(F.col("source_sha256")).alias("d"))
    archived = m.where("tree = 'archive'").select("scan_id", "page", digest(F.col("sha256")).alias("d"), F.lit(True).alias("_in")).distinct()
    status = F.when(F.col("d").isNull(), "no source").when(F.col("_in"), "ok").otherwise("broken")
    return enhanced.join(archived, ["scan_id", "page", "d"], "left").groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@query("d10_orphans", "select o_orderkey from orders where not exists (select 1 from customer where c_custkey = o_custkey and c_acctbal > 0)")
def d10_orphans(t):
    """Orders whose customer is unknown among those in credit."""
    return C.orphans(t("orders"), ["o_orderkey"], t("customer").where("c_acctbal > 0"), "o_custkey", "c_custkey")


@query("d11_required", "select verse_id from verse semi join (select edition_id from edition where lang = 'en') using (edition_id) where coalesce(translation, '') = ''")
def d11_required(t):
    """Verses of English editions without a translation."""
    english = t("edition").where("lang = 'en'").select("edition_id")
    return t("verse").where(F.coalesce("translation", F.lit("")) == "").join(english, "edition_id", "left_semi").select("verse_id")


@query("d12_context", f"""with p as (select scan_id, page, min(file) file from manifest_origin where tree = 'archive' and page is not null group by 1, 2), i as (select scan_id, position, arg_max((kanda, sarga), (kanda, sarga, mapped_at)) v
 from (select scan_id, kanda, sarga, mapped_at, unnest(range(s, e + 1)) "position" from {_SPAN} where s <= e) group by 1, 2)
 select p.scan_id, p.page, case when v is null then 'between' else 'kanda ' || v[1] || ' sarga ' || v[2] end context from p left join i on p.scan_id = i.scan_id and p.page = i.position""")
def d12_context(t):
    """Archived pages with where in the book they are."""
    index = O.page_index(_spans(t), ["scan_id"], "s", "e", ["kanda", "sarga", "mapped_at"], ["kanda", "sarga"]).withColumnRenamed("position", "page")
    listed = t("manifest_origin").where("tree = 'archive' and page is not null").select("scan_id", "page").distinct()
    context = F.when(F.col("kanda").isNull(), "between").otherwise(F.format_string("kanda %d sarga %d", "kanda", "sarga"))
    return listed.join(index, ["scan_id", "page"], "left").select("scan_id", "page", context.alias("context"))


@query("d13_spot_checks", """with m as (select scan_id, kanda, sarga, min(start_page) s from sarga_span group by 1, 2, 3), c as (select scan_id, kanda, canto_no sarga, min(printed_page) p from toc_entry where canto_no % 5 = 0 group by 1, 2, 3)
 select scan_id, kanda, sarga, p printed_page, s start_page, s - p diff, count(distinct s - p) over (partition by scan_id, kanda) diffs from c left join m using (scan_id, kanda, sarga)""".replace("count(distinct s - p) over (partition by scan_id, kanda)", "len(list_distinct(list(s - p) over (partition by scan_id, kanda)))::bigint"))
def d13_spot_checks(t):
    """Every fifth canto's pages in contents and map, and how many offsets its book shows."""
    book = t("sarga_span").groupBy("scan_id", "kanda", "sarga").agg(F.min("start_page").alias("start_page"))
    wanted = t("toc_entry").where("canto_no % 5 = 0").groupBy("scan_id", "kanda", F.col("canto_no").alias("sarga")).agg(F.min("printed_page").alias("printed_page"))
    found = wanted.join(book, ["scan_id", "kanda", "sarga"], "left").withColumn("diff", F.col("start_page") - F.col("printed_page"))
    return found.withColumn("diffs", F.size(F.collect_set("diff").over(Window.partitionBy("scan_id", "kanda"))).cast("long"))


@query("d14_ranges_with_marker", """with v as (select verse_id, scan_id, kanda, sarga, verse from verse), r as (select verse_id marker_id, scan_id, kanda, sarga, try_cast(a as int) a, coalesce(try_cast(nullif(b, '') as int), try_cast(a as int)) b
 from (select *, regexp_extract(translation, '\\((\\d+)(?:[-–—](\\d+))?\\)\\s*$', 1) a, regexp_extract(translation, '\\((\\d+)(?:[-–—](\\d+))?\\)\\s*$', 2) b from verse where translation is not null) where a <> '')
 select v.verse_id, min(r.marker_id) marker_id from v join r on v.scan_id = r.scan_id and v.kanda = r.kanda and v.sarga = r.sarga and v.verse between r.a and r.b where r.b - r.a <= 1000 group by 1""")
def d14_ranges_with_marker(t):
    """Each verse with the first translation of its sarga whose closing numbers hold it: the
    number ranges are spread over verses, so that the join is one on equal keys."""
    pattern = r"\((\d+)(?:[-–—](\d+))?\)\s*$"
    part = lambda g: F.regexp_extract("translation", pattern, g).try_cast("int")
    ranges = t("verse").select(F.col("verse_id").alias("marker_id"), "scan_id", "kanda", "sarga", part(1).alias("a"), F.coalesce(part(2), part(1)).alias("b")).where("a <= b and b - a <= 1000")
    spread = ranges.select("marker_id", "scan_id", "kanda", "sarga", F.explode(F.sequence("a", "b")).alias("verse"))
    return t("verse").select("verse_id", "scan_id", "kanda", "sarga", "verse").join(spread, ["scan_id", "kanda", "sarga", "verse"]).groupBy("verse_id").agg(F.min("marker_id").alias("marker_id"))


@query("d16_gap_pages", f"""select distinct v.scan_id, v.kanda, v.sarga, unnest(range(greatest(m.s - 1, 1), m.e + 2))::int page from (select distinct scan_id, kanda, sarga from verse where coalesce(translation, '') = '') v
 join (select scan_id, kanda, sarga, min(s) s, max(e) e from {_SPAN} where s <= e group by 1, 2, 3) m using (scan_id, kanda, sarga)""")
def d16_gap_pages(t):
    """The pages, one more on either side, where missing translations may be found."""
    gaps = t("verse").where(F.coalesce("translation", F.lit("")) == "").select("scan_id", "kanda", "sarga").distinct()
    book = _spans(t).where("s <= e").groupBy("scan_id", "kanda", "sarga").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    return gaps.join(book, ["scan_id", "kanda", "sarga"]).select("scan_id", "kanda", "sarga", F.explode(F.sequence(F.greatest(F.col("s") - 1, F.lit(1)), F.col("e") + 1)).alias("page"))


@query("e1_labels", "select source, lang, count(*) n from documents group by 1, 2")
def e1_labels(t):
    """Documents by source and language."""
    return t("documents").groupBy("source", "lang").agg(F.count("*").alias("n"))


@query("e2_boxes", "select o_custkey % 100 page, min(o_totalprice) low, max(o_totalprice) high, round_even(sum(round(o_totalprice * 100)::bigint)::double / count(*), 0)::bigint middle from orders group by 1")
def e2_boxes(t):
    """The box around values, and their mean in hundredths, halves to even."""
    return t("orders").groupBy((F.col("o_custkey") % 100).alias("page")).agg(F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"), F.bround(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).cast("double") / F.count("*"), 0).cast("long").alias("middle"))


@query("e3_item_means", "select l_orderkey, round(coalesce(avg(l_discount) filter (where l_discount > 0.02), 0), 6) mean, bool_or(l_returnflag = 'R') any_returned from lineitem group by 1")
def e3_item_means(t):
    """A mean over some rows, 0 without any, and whether any row has a mark."""
    mean = F.round(F.coalesce(F.avg(F.when(F.col("l_discount") > 0.02, F.col("l_discount"))), F.lit(0.0)), 6)
    return t("lineitem").groupBy("l_orderkey").agg(mean.alias("mean"), F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"))


@query("e5_upper_medians", "select source, count(n_chars) n, min(n_chars) least, list_sort(list(n_chars))[count(n_chars) // 2 + 1] upper_median, max(n_chars) most from documents where n_chars is not null group by 1")
def e5_upper_medians(t):
    """Sizes of each source's documents: least, upper median, most."""
    return A.upper_median(t("documents"), ["source"], "n_chars")


@query("e7_coverage", """select scan_id, kanda, count(distinct sarga) found, max(sarga) expected, min(start_page) first_page, max(end_page) last_page, count(case when start_page is null or end_page is null then 1 end) textless from sarga_span group by 1, 2""")
def e7_coverage(t):
    """What of each book is mapped."""
    textless = F.count_if(F.col("start_page").isNull() | F.col("end_page").isNull())
    return t("sarga_span").groupBy("scan_id", "kanda").agg(F.countDistinct("sarga").alias("found"), F.max("sarga").alias("expected"), F.min("start_page").alias("first_page"), F.max("end_page").alias("last_page"), textless.alias("textless"))


@query("e7_flags", "select kanda, regexp_extract(flag, '^[^:]*') kind, count(*) n from (select kanda, unnest(flags) flag from sarga_span) group by 1, 2")
def e7_flags(t):
    """Flags by their kind."""
    return t("sarga_span").select("kanda", F.explode("flags").alias("flag")).groupBy("kanda", F.substring_index("flag", ":", 1).alias("kind")).agg(F.count("*").alias("n"))


@query("e8_offsets", """select scan_id, part, value, n from (select *, row_number() over (partition by scan_id, part order by n desc, first_seen) k from (select scan_id, part, archive_page - printed_page "value", count(*) n, min(entry_id) first_seen
 from toc_entry where archive_page - printed_page is not null group by 1, 2, 3)) where k = 1""")
def e8_offsets(t):
    """The most common offset of archived from printed pages; of equal ones the first seen."""
    return A.most_common(t("toc_entry"), ["scan_id", "part"], F.col("archive_page") - F.col("printed_page"), "entry_id")


@query("e10_sources", "select lang, regexp_extract(source, '^[^_]*') kind, count(*) n from documents group by 1, 2")
def e10_sources(t):
    """Documents by language and the first word of their source."""
    return t("documents").groupBy("lang", F.substring_index("source", "_", 1).alias("kind")).agg(F.count("*").alias("n"))


@query("e11_totals", "select tree, count(*) rows, count(case when source_sha256 is not null then 1 end) with_source, sum(size_bytes)::bigint bytes, count(distinct scan_id) scans from manifest_origin group by 1")
def e11_totals(t):
    """Totals of each tree."""
    return t("manifest_origin").groupBy("tree").agg(F.count("*").alias("rows"), F.count("source_sha256").alias("with_source"), F.sum("size_bytes").alias("bytes"), F.countDistinct("scan_id").alias("scans"))


@query("e12_one_size", "select scan_id, count(distinct (kanda, part)) = 1 one from toc_entry group by 1")
def e12_one_size(t):
    """Whether all rows of a scan agree."""
    return t("toc_entry").groupBy("scan_id").agg((F.countDistinct("kanda", "part") == 1).alias("one"))


@query("e13_sarga_texts", "select scan_id, kanda, sarga, md5(string_agg(translation, chr(10) order by verse, verse_id)) text from verse where translation is not null group by 1, 2, 3")
def e13_sarga_texts(t):
    """The translations of each sarga in order (their hash)."""
    return A.ordered_text(t("verse"), ["scan_id", "kanda", "sarga"], ["verse", "verse_id"], "translation", "\n").withColumn("text", F.md5("text"))


@query("e14_languages", "select source, array_to_string(list_sort(list_distinct(list(lang))), ',') langs from documents group by 1")
def e14_languages(t):
    """The languages of each source, sorted."""
    return t("documents").groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"))


@query("e15_page_runs", f"select scan_id, tree, string_agg(case when a = b then a::varchar else a || '-' || b end, ', ' order by a) runs from {_PAGE_RUNS} group by 1, 2")
def e15_page_runs(t):
    """The pages of each tree as runs."""
    return O.compact_runs(t("manifest_origin"), ["scan_id", "tree"], "page")


@query("e16_repeated", "select scan_id, kanda, canto_no, count(*) n from toc_entry group by 1, 2, 3 having count(*) > 1")
def e16_repeated(t):
    """Cantos listed more than once."""
    return C.repeated(t("toc_entry"), ["scan_id", "kanda", "canto_no"])


@query("e17_missing", """select scan_id, kanda, a first_number, b last_number from (select scan_id, kanda, coalesce(lag(canto_no) over w, 0)::bigint + 1 a, canto_no::bigint - 1 b from (select distinct scan_id, kanda, canto_no from toc_entry where canto_no >= 1)
 window w as (partition by scan_id, kanda order by canto_no)) where a <= b""")
def e17_missing(t):
    """Canto numbers that contents leave out."""
    return O.missing_numbers(t("toc_entry"), ["scan_id", "kanda"], "canto_no")


@query("e18_verdicts", "select scan_id, count(case when end_page < start_page then 1 end) = 0 fine from sarga_span group by 1")
def e18_verdicts(t):
    """Whether a scan has no inverted range."""
    return t("sarga_span").groupBy("scan_id").agg((F.count_if(F.col("end_page") < F.col("start_page")) == 0).alias("fine"))


@query("e20_counts", "select kanda, count(*) n, grouping(kanda)::int total from verse group by rollup(kanda)")
def e20_counts(t):
    """Verses of each kanda, and of all."""
    return t("verse").rollup("kanda").agg(F.count("*").alias("n"), F.grouping("kanda").cast("int").alias("total"))


@query("f1_range_ends", "select entry_id, archive_page, coalesce(lead(archive_page) over (partition by scan_id order by archive_page, entry_id) - 1, 2303) range_end from toc_entry where archive_page is not null")
def f1_range_ends(t):
    """Where each contents entry ends: before the next one."""
    rows = t("toc_entry").where("archive_page is not null").select("entry_id", "scan_id", "archive_page")
    return O.range_ends(rows, ["scan_id"], "archive_page", ["entry_id"], F.lit(2303)).drop("scan_id")


@query("f3_sessions", """select user_id, min(ts) started, max(ts) ended, count(*) n from (select *, sum(f) over (partition by user_id order by ts rows unbounded preceding) s from (select user_id, ts,
 case when ts - lag(ts) over (partition by user_id order by ts) <= interval 6 hour then 0 else 1 end f from events)) group by user_id, s having count(*) >= 2""")
def f3_sessions(t):
    """Clusters of each user's events at most six hours apart, of two events or more."""
    return O.sessions(t("events"), ["user_id"], "ts", 6 * 3600, 2)


@query("f4_changed_types", "select event_id from (select *, lag(event_type) over (partition by user_id order by ts, event_id) b from events) where b is null or b <> event_type")
def f4_changed_types(t):
    """Events of another type than the one before."""
    return O.changes(t("events"), ["user_id"], ["ts", "event_id"], "event_type").select("event_id")


@query("f10_constant_offsets", "select scan_id, part, len(list_distinct(list(archive_page - printed_page)))::bigint offsets from toc_entry group by 1, 2")
def f10_constant_offsets(t):
    """How many page offsets each part of a scan shows."""
    return t("toc_entry").groupBy("scan_id", "part").agg(F.countDistinct(F.col("archive_page") - F.col("printed_page")).alias("offsets"))


@query("f11_between_events", "select event_id, date_diff('microsecond', lag(ts) over (partition by user_id order by ts, event_id), ts) micros from events")
def f11_between_events(t):
    """The time between each event and the user's one before."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return t("events").select("event_id", (micros(F.col("ts")) - micros(F.lag("ts").over(order))).alias("micros"))


@query("g1_ranks", "select user_id, event_id, row_number() over (partition by user_id order by value desc, event_id) place from events qualify place <= 3")
def g1_ranks(t):
    """Each user's three largest events; equal ones by number."""
    place = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id"))
    return t("events").select("user_id", "event_id", place.cast("long").alias("place")).where("place <= 3")


@query("g2_spot_sample", """select distinct scan_id, page from (select scan_id, unnest([case when n <= 11 then i + 1 else 1 + round_even(i * (n - 1) / 10.0, 0)::bigint end for i in range(11)]) page, n from (select scan_id, max(page)::bigint n from manifest_origin
 where tree = 'archive' and page >= 1 group by 1)) where page <= n""")
def g2_spot_sample(t):
    """Eleven pages of each scan, evenly spread, the first and last among them."""
    last = t("manifest_origin").where("tree = 'archive' and page >= 1").groupBy("scan_id").agg(F.max("page").cast("long").alias("n"))
    spread = F.transform(F.sequence(F.lit(0), F.lit(10)), lambda i: F.when(F.col("n") <= 11, i + 1).otherwise(1 + F.bround(i * (F.col("n") - 1) / 10.0, 0)).cast("long"))
    return last.select("scan_id", "n", F.explode(spread).alias("page")).where("page <= n").select("scan_id", "page").distinct()


@query("g3_page_lists", """select item_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(passage, '\\d+'), lambda x: x::bigint))), ',') numbers from evalitem where len(regexp_extract_all(passage, '\\d+')) > 0""")
def g3_page_lists(t):
    """The numbers of a text, sorted, each once."""
    numbers = F.array_sort(F.array_distinct(F.transform(X.tokens(F.col("passage"), r"\d+"), lambda x: x.cast("long"))))
    return t("evalitem").select("item_id", F.array_join(numbers, ",").alias("numbers")).where("numbers <> ''")


@query("g4_first_samples", "select source, array_to_string(list(doc_id order by doc_id)[1:3], ',') samples from documents group by 1")
def g4_first_samples(t):
    """The first three documents of each source."""
    place = F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))
    first = t("documents").select("source", "doc_id", place.alias("k")).where("k <= 3")
    return first.groupBy("source").agg(F.array_join(F.array_sort(F.collect_list("doc_id")), ",").alias("samples"))


@query("g5_difference", "select distinct scan_id, page from manifest_origin where tree = 'archive' except select distinct scan_id, page from manifest_origin where tree = 'enhance'")
def g5_difference(t):
    """Archived pages that were not enhanced."""
    pages = lambda tree: t("manifest_origin").where(F.col("tree") == tree).select("scan_id", "page")
    return pages("archive").subtract(pages("enhance"))


@query("g6_blocks", "select 'title' kind, count(*) n from toc_entry where title_raw is not null union all select 'verse', count(*) from verse where translation is not null")
def g6_blocks(t):
    """Two kinds of blocks as one list, counted."""
    titles = t("toc_entry").where("title_raw is not null").select(F.lit("title").alias("kind"))
    return titles.unionByName(t("verse").where("translation is not null").select(F.lit("verse").alias("kind"))).groupBy("kind").agg(F.count("*").alias("n"))


@query("g7_tiling", f"""select * from (select scan_id, kanda, s, e, case when e < s then 'inverted' when s > b + 1 then 'gap' when s < b then 'overlap' end problem
 from (select *, lag(e) over (partition by scan_id, kanda order by s, e) b from (select distinct scan_id, kanda, s, e from {_SPAN} where s is not null and e is not null))) where problem is not null""")
def g7_tiling(t):
    """Where the sargas of a book don't follow each other, one shared page allowed."""
    return O.tiling(_spans(t).where("s is not null and e is not null"), ["scan_id", "kanda"], "s", "e", 1)


@query("g9_order", """select scan_id, page, row_number() over (partition by scan_id order by kanda, sarga, page) "position" from (select distinct scan_id, kanda, sarga, page from (select scan_id, kanda, sarga, unnest(range(s, e + 1))::int page from """ + _SPAN + """ where s <= e))""")
def g9_order(t):
    """The page order that the map gives, pages between two sargas twice."""
    each = _spans(t).where("s <= e").select("scan_id", "kanda", "sarga", F.explode(F.sequence("s", "e")).alias("page")).distinct()
    place = F.row_number().over(Window.partitionBy("scan_id").orderBy("kanda", "sarga", "page"))
    return each.select("scan_id", "page", place.cast("long").alias("position"))


@query("g10_chunks", "select scan_id, kanda, sarga, chunk, count(*) n from (select *, (row_number() over (partition by scan_id, kanda, sarga order by verse, verse_id) - 1) // 12 chunk from verse) group by 1, 2, 3, 4")
def g10_chunks(t):
    """Verses in blocks of twelve."""
    return O.chunks(t("verse"), ["scan_id", "kanda", "sarga"], ["verse", "verse_id"], 12).groupBy("scan_id", "kanda", "sarga", "chunk").agg(F.count("*").alias("n"))


# Geometry

_PAGES = "(select scan_id, count(distinct page)::bigint n from manifest_origin where tree = 'archive' and page is not null group by 1)"


def _page_counts(t):
    return t("manifest_origin").where("tree = 'archive' and page is not null").groupBy("scan_id").agg(F.countDistinct("page").alias("n"))


@query("h1_signatures", f"""select scan_id, g "position", si + 1 signature, case when l * 2 <= pad then (l - 1) // 2 else (pad - l) // 2 end depth, case when l * 2 <= pad then case when l % 2 = 1 then 'back' else 'front' end else case when (pad - l) % 2 = 0 then 'back' else 'front' end end side,
 case when l * 2 <= pad then 'top' else 'bottom' end slot, g > n blank from (select *, (least(16, n - si * 16) + 3) // 4 * 4 pad from (select scan_id, n, g, (g - 1) // 16 si, (g - 1) % 16 + 1 l from (select scan_id, n, unnest(range(1, n // 16 * 16 + (n % 16 + 3) // 4 * 4 + 1)) g from {_PAGES})))""")
def h1_signatures(t):
    """Where each page of each scan is printed, in signatures of 16 pages."""
    counts = _page_counts(t).withColumn("position", F.explode(F.sequence(F.lit(1).cast("long"), G.padded_pages(F.col("n"), 16))))
    return G.slots(counts, "position", F.col("n"), 16).drop("n")


@query("h3_creep", "select depth, round(depth * (2 * 0.1 * 72 / 25.4), 6) points from (select unnest(range(0, 8)) depth)")
def h3_creep(t):
    """How far the leaves of a signature are pushed outward."""
    return t("region").sparkSession.range(8, numPartitions=1).select(F.col("id").alias("depth"), F.round(G.creep(F.col("id"), 0.1), 6).alias("points"))


@query("h4_crops", """select p_partkey, case when r - l > 1 and 600 + p_size - 36 - 24 > 1 then round(l, 6) end "left", case when r - l > 1 and 600 + p_size - 60 > 1 then round(r, 6) end "right" from (select p_partkey, p_size,
 case when p_partkey % 2 = 1 then least(18 + p_size % 8 * 0.5, w) else 12 end l, w - case when p_partkey % 2 = 1 then 12 else least(18 + p_size % 8 * 0.5, w) end r from (select *, p_retailprice / 5 w from part))""")
def h4_crops(t):
    """Crops of pages of many sizes, recto and verso."""
    box = G.crop(F.col("p_retailprice") / 5, F.lit(600.0) + F.col("p_size"), F.col("p_partkey") % 2 == 1, (18.0, 12.0, 24.0, 36.0), F.col("p_size") % 8 * 0.5)
    return t("part").select("p_partkey", box.alias("b")).select("p_partkey", F.round("b.left", 6).alias("left"), F.round("b.right", 6).alias("right"))


@query("h5_pixels", "select p_partkey, round_even(p_retailprice * (600 / 72.0::double), 0)::bigint px from part")
def h5_pixels(t):
    """Points as pixels."""
    return t("part").select("p_partkey", G.pixels(F.col("p_retailprice"), 600).alias("px"))


@query("h7_scales", "select p_partkey, round(least((612 - 36) / p_retailprice, (396 - 36) / (p_retailprice + p_size)), 6) scale from part")
def h7_scales(t):
    """The scale at which a page fits into half a sheet."""
    return t("part").select("p_partkey", F.round(G.fit(F.col("p_retailprice"), F.col("p_retailprice") + F.col("p_size"), (612.0, 396.0), 18.0), 6).alias("scale"))


@query("h8_top_down", "select l_orderkey, l_linenumber, round(least(1 - l_tax, 1 - l_discount), 6) top, round(greatest(1 - l_tax, 1 - l_discount), 6) bottom from lineitem")
def h8_top_down(t):
    """Boxes turned from bottom-up to top-down."""
    box = G.top_down(F.col("l_discount"), F.col("l_tax"), F.lit(1.0))
    return t("lineitem").select("l_orderkey", "l_linenumber", box.alias("b")).select("l_orderkey", "l_linenumber", F.round("b.top", 6).alias("top"), F.round("b.bottom", 6).alias("bottom"))


@query("h9_printed_pages", "select entry_id, case when part = 2 then archive_page - 1167 else archive_page end printed from toc_entry")
def h9_printed_pages(t):
    """Archived as printed pages, by part."""
    return t("toc_entry").select("entry_id", F.when(F.col("part") == 2, F.col("archive_page") - 1167).otherwise(F.col("archive_page")).alias("printed"))


@query("h10_percent", "select distinct l_discount, printf('%.1f', l_discount * 100) percent from lineitem")
def h10_percent(t):
    """Shares as percent of one digit."""
    return t("lineitem").select("l_discount").distinct().select("l_discount", F.format_string("%.1f", F.col("l_discount") * 100).alias("percent"))


@query("h12_clock", "select event_id, printf('%02d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) clock from (select event_id, trunc(value * 100)::bigint s from events)")
def h12_clock(t):
    """Seconds as a clock shows them, fractions cut."""
    return t("events").select("event_id", G.clock(F.col("value") * 100).alias("clock"))


@query("m1_rules", """select verse_id, unnest(list_filter([case when not coalesce(verse >= 1, false) then 'number' end, case when not coalesce(sarga between 1 and 120, false) then 'sarga' end, case when not coalesce(translation <> '', false) then 'translation' end,
 case when not coalesce(length(transliteration) >= 10, false) then 'short' end], lambda x: x is not null)) rule from verse""")
def m1_rules(t):
    """Which verses break which rules."""
    rules = {"number": F.col("verse") >= 1, "sarga": F.col("sarga").between(1, 120), "translation": F.col("translation") != "", "short": F.length("transliteration") >= 10}
    return C.violations(t("verse"), ["verse_id"], rules)


@query("n1_verified", f"""with o as (select scan_id, tree, page, any_value({_DIGEST.format('sha256')}) d, any_value(size_bytes) s, count(distinct coalesce({_DIGEST.format('sha256')}, '')) k from manifest_origin group by 1, 2, 3),
 y as (select scan_id, tree, page, any_value({_DIGEST.format('sha256')}) d, any_value(size_bytes) s, count(distinct coalesce({_DIGEST.format('sha256')}, '')) k from manifest_synced group by 1, 2, 3)
 select verdict, count(*) n from (select case when y.scan_id is null then 'missing' when o.d is distinct from y.d then 'hash mismatch' when o.s is distinct from y.s then 'size mismatch' else 'ok' end verdict
 from o left join y on o.scan_id = y.scan_id and o.tree = y.tree and o.page = y.page where o.k = 1 and coalesce(y.k, 1) = 1 and o.page is not null) group by 1""")
def n1_verified(t):
    """The origin's pages verified against the copy: missing, digest, size, or fine."""
    def one(name):
        d = digest(F.col("sha256"))
        return t(name).groupBy("scan_id", "tree", "page").agg(F.any_value(d).alias("d"), F.any_value("size_bytes").alias("s"), F.countDistinct(F.coalesce(d, F.lit(""))).alias("k"))

    copy = one("manifest_synced").select("scan_id", "tree", "page", F.col("d").alias("yd"), F.col("s").alias("ys"), F.col("k").alias("yk"), F.lit(True).alias("_in"))
    both = one("manifest_origin").where("k = 1 and page is not null").join(copy, ["scan_id", "tree", "page"], "left").where("coalesce(yk, 1) = 1")
    verdict = F.when(F.col("_in").isNull(), "missing").when(~F.col("d").eqNullSafe(F.col("yd")), "hash mismatch").when(~F.col("s").eqNullSafe(F.col("ys")), "size mismatch").otherwise("ok")
    return both.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


@query("b1_manifest", "select doc_id, sha256(text) sha256, strlen(text)::bigint size_bytes from documents where text is not null")
def b1_manifest(t):
    """A manifest of documents: digest and size in bytes."""
    return t("documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("size_bytes"))


QUERIES, ORACLES = query.queries, query.oracles
