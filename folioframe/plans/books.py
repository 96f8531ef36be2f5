"""Queries over the structure of books: segments, bands, owners, boxes, pixels, captions, fills, views."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import numerals as N
from ..functions import text as X
from ..operators import boxes as B
from ..operators import captions, filling, folds
from ..operators import lines as L
from ..operators import ordered as O
from ..sources.files import without_done
from ..sources.sinks import provenance
from .pages import LINES
from .registered import Register

query = Register()


@query("a3_render_ranges", """select scan_id, w worker, round_even(w * n / 4.0, 0)::bigint + 1 first_page, round_even((w + 1) * n / 4.0, 0)::bigint last_page from (select scan_id, n, unnest(range(0, 4)) w from (select scan_id, max(page)::bigint n from manifest_origin group by 1))
 where round_even(w * n / 4.0, 0) < round_even((w + 1) * n / 4.0, 0)""")
def a3_render_ranges(t):
    """Each scan's pages as disjoint ranges for four workers."""
    n = t("manifest_origin").groupBy("scan_id").agg(F.max("page").cast("long").alias("n"))
    edge = lambda w: F.bround(w * F.col("n") / 4.0, 0).cast("long")
    ranges = n.select("scan_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("worker"))
    return ranges.select("scan_id", "worker", (edge(F.col("worker")) + 1).alias("first_page"), edge(F.col("worker") + 1).alias("last_page")).where("first_page <= last_page")


@query("a5_numbered_files", "select scan_id, tree, file, try_cast(regexp_extract(file, '(\\d+)\\.[A-Za-z]+$', 1) as int) number from manifest_origin")
def a5_numbered_files(t):
    """Files with the number before their suffix."""
    return t("manifest_origin").select("scan_id", "tree", "file", F.regexp_extract("file", r"(\d+)\.[A-Za-z]+$", 1).try_cast("int").alias("number"))


@query("a12_cues", f"""select doc_id, line_no cue, ((line_no - 1) * 2)::double "start", ((line_no - 1) * 2 + 1.5)::double "end", trim(line) "text" from ({LINES}) where doc_id in (select doc_id from documents where source like 'captions%') and trim(line) <> ''""")
def a12_cues(t):
    """Cues read back from caption texts, one a line, written for the purpose."""
    said = L.lines(t("documents").where("source like 'captions%'"), ["doc_id"], "text")
    at = lambda s: F.concat(G.clock(F.floor(s)), F.when(s % 1 > 0, ".500").otherwise(".000"))
    begin = (F.col("line_no") - 1) * 2
    block = F.concat(at(begin), F.lit(" --> "), at(begin + 1.5), F.lit(" align:start\n<c>"), F.col("line"), F.lit("</c>"))
    texts = said.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", block.alias("b")))).alias("l")).select("doc_id", F.concat(F.lit("WEBVTT\n\n"), F.array_join("l.b", "\n\n")).alias("vtt"))
    return captions.cues(texts, ["doc_id"], "vtt")


@query("a14_left_to_do", """select count(*) n, count(distinct scan_id) scans from (select distinct scan_id, tree, page from manifest_origin o where page is not null and not exists (select 1 from manifest_synced s where s.scan_id = o.scan_id and s.tree = o.tree and s.page = o.page))""")
def a14_left_to_do(t):
    """Pages of the origin that a resumed copy still lacks."""
    keys = ["scan_id", "tree", "page"]
    left = without_done(t("manifest_origin").where("page is not null").select(*keys).distinct(), t("manifest_synced"), keys)
    return left.agg(F.count("*").alias("n"), F.countDistinct("scan_id").alias("scans"))


@query("a17_span_texts", "select scan_id, kanda, sarga, string_agg(coalesce(translation, ''), chr(10) order by verse_id) is not null present, sum(length(coalesce(translation, '')))::bigint n_chars from verse where verse between 3 and 8 group by 1, 2, 3")
def a17_span_texts(t):
    """The texts of a span of each sarga."""
    span = t("verse").where("verse between 3 and 8").groupBy("scan_id", "kanda", "sarga")
    return span.agg(F.lit(True).alias("present"), F.sum(F.length(F.coalesce("translation", F.lit("")))).alias("n_chars"))


@query("b7_view_rows", """select suite, string_agg('<tr><td>' || item_id || '</td><td>' || replace(replace(replace(prompt, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</td></tr>', '' order by item_id) html from evalitem group by 1""")
def b7_view_rows(t):
    """Items as escaped table rows, by suite."""
    row = F.concat(F.lit("<tr><td>"), F.col("item_id").cast("string"), F.lit("</td><td>"), X.escaped(F.col("prompt"), False), F.lit("</td></tr>"))
    held = t("evalitem").groupBy("suite").agg(F.array_sort(F.collect_list(F.struct("item_id", row.alias("r")))).alias("l"))
    return held.select("suite", F.array_join("l.r", "").alias("html"))


@query("b10_archive_order", "select verse_id, row_number() over (partition by scan_id, kanda, sarga order by verse, verse_id) \"position\", sha256(translation) sha256 from verse where translation is not null")
def b10_archive_order(t):
    """Rendered texts in their order, with digests."""
    place = F.row_number().over(Window.partitionBy("scan_id", "kanda", "sarga").orderBy("verse", "verse_id"))
    return t("verse").where("translation is not null").select("verse_id", place.cast("long").alias("position"), F.sha2("translation", 256).alias("sha256"))


@query("b11_provenance", "select count(*) rows, 2 columns, sha256('edition_id int, label string') schema_sha256, 'editions' source from edition")
def b11_provenance(t):
    """Where a table comes from and what it holds."""
    return provenance(t("edition").select("edition_id", "label"), source="editions")


@query("c2_zones", "select l_orderkey, l_linenumber, case when l_discount > 0.065 and l_tax < 0.955 then 'body' when l_tax <= 0.065 then 'head' else 'margin' end zone from lineitem")
def c2_zones(t):
    """The zone of a page that a box is in."""
    zone = F.when((F.col("l_discount") > 0.065) & (F.col("l_tax") < 0.955), "body").when(F.col("l_tax") <= 0.065, "head").otherwise("margin")
    return t("lineitem").select("l_orderkey", "l_linenumber", zone.alias("zone"))


@query("c11_without_markers", "select verse_id from verse where text_devanagari is not null and not (starts_with(regexp_replace(text_devanagari, '^[\\s।|]+', ''), 'इति') or starts_with(regexp_replace(text_devanagari, '^[\\s।|]+', ''), 'ऐ'))")
def c11_without_markers(t):
    """Verses that are no marker lines."""
    bare = F.regexp_replace("text_devanagari", r"^[\s।|]+", "")
    return t("verse").where("text_devanagari is not null").where(~(F.startswith(bare, F.lit("इति")) | F.startswith(bare, F.lit("ऐ")))).select("verse_id")


@query("c12_polluted", "select doc_id from documents where contains(text, '</') or contains(text, '\\\"')")
def c12_polluted(t):
    """Documents that hold pieces of markup or of escaped payloads."""
    return t("documents").where(F.contains("text", F.lit("</")) | F.contains("text", F.lit('\\"'))).select("doc_id")


@query("d1_smallest_boxes", """with w as (select o_custkey % 50 page, o_orderkey word, (floor(o_totalprice)::bigint % 1000) / 1000.0::double x, (o_orderkey % 997) / 997.0::double y from orders), b as (select p_partkey % 50 page, p_partkey box, (p_size % 40) / 50.0::double l, (p_partkey % 37) / 50.0::double t,
 (p_size % 40) / 50.0::double + 0.1 + (p_partkey % 7) / 50.0 r, (p_partkey % 37) / 50.0::double + 0.1 + (p_partkey % 5) / 50.0 b from part),
 m as (select w.page, word, box, row_number() over (partition by w.page, word order by round((r - l) * (b - t), 9), box) k from w join b on w.page = b.page and x between l - 0.005 and r + 0.005 and y between t - 0.005 and b + 0.005)
 select w.page, w.word, m.box from w left join m on w.page = m.page and w.word = m.word and m.k = 1""")
def d1_smallest_boxes(t):
    """Words in the smallest box around them."""
    d = lambda c: c.cast("double")
    words = t("orders").select((F.col("o_custkey") % 50).alias("page"), F.col("o_orderkey").alias("word"), (d(F.floor("o_totalprice").cast("long") % 1000) / 1000.0).alias("x"), (d(F.col("o_orderkey") % 997) / 997.0).alias("y"))
    left, top = d(F.col("p_size") % 40) / 50.0, d(F.col("p_partkey") % 37) / 50.0
    boxes = t("part").select((F.col("p_partkey") % 50).alias("page"), F.col("p_partkey").alias("box"), left.alias("l"), top.alias("t"), (left + 0.1 + d(F.col("p_partkey") % 7) / 50.0).alias("r"), (top + 0.1 + d(F.col("p_partkey") % 5) / 50.0).alias("b"))
    return B.smallest_box(words, boxes, "page", "word", "box")


@query("d9_completed", "select v.verse_id, e.press from verse v join edition e using (edition_id) where e.press is not null")
def d9_completed(t):
    """Verses with their press; editions without one leave their verses out."""
    return t("verse").join(t("edition").where("press is not null").select("edition_id", "press"), "edition_id").select("verse_id", "press")


@query("f2_uncovered_runs", """with p as (select scan_id, unnest(range(1, max(page) + 1))::int page from manifest_origin where page >= 1 group by 1), c as (select distinct scan_id, unnest(range(coalesce(start_page, heading_page), end_page + 1))::int page from sarga_span where coalesce(start_page, heading_page) <= end_page),
 u as (select scan_id, page from p except select scan_id, page from c) select scan_id, min(page)::bigint first_number, max(page)::bigint last_number from (select *, page - row_number() over (partition by scan_id order by page) r from u) group by scan_id, r""")
def f2_uncovered_runs(t):
    """Runs of pages that no sarga covers."""
    last = t("manifest_origin").where("page >= 1").groupBy("scan_id").agg(F.max("page").alias("n"))
    every = last.select("scan_id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("page"))
    span = t("sarga_span").select("scan_id", F.coalesce("start_page", "heading_page").alias("s"), F.col("end_page").alias("e")).where("s <= e")
    covered = span.select("scan_id", F.explode(F.sequence("s", "e")).alias("page")).distinct()
    return O.runs(every.join(covered, ["scan_id", "page"], "left_anti"), ["scan_id"], "page")


@query("f6_bands")
def f6_bands(t):
    """Contents whose numbers are printed twice, put in order where that can be proven."""
    return folds.bands(t("toc_entry"), ["scan_id", "kanda"], "canto_no", "archive_page")


@query("f8_segments")
def f8_segments(t):
    """Contents as numbered page ranges, with what is irregular about the numerals."""
    listed = t("toc_entry").where("archive_page is not null").select("scan_id", "kanda", "archive_page", N.int_to_roman(F.col("canto_no")).alias("numeral"), "canto_no")
    return folds.segments(listed.distinct(), ["scan_id", "kanda"], "archive_page", "numeral", "canto_no", "archive_page")


@query("f9_owners", f"""with l as (select *, regexp_extract(line, '^\\s*(Canto [IVXLCDM]+)\\s*$', 1) h, contains(line, 'Thus ends') c from ({LINES})), n as (select *, max(case when h <> '' then line_no end) over (partition by doc_id order by line_no rows unbounded preceding) lh,
 max(case when c then line_no end) over (partition by doc_id order by line_no rows between unbounded preceding and 1 preceding) lc from l)
 select n.doc_id, case when lh is not null and (lc is null or lc < lh) then o.h end "owner", count(*) n from n left join l o on o.doc_id = n.doc_id and o.line_no = n.lh group by 1, 2""")
def f9_owners(t):
    """Lines by the canto that owns them."""
    heading = F.regexp_extract("line", r"^\s*(Canto [IVXLCDM]+)\s*$", 1)
    lines = L.lines(t("documents"), ["doc_id"], "text").withColumns({"heading": F.when(heading != "", heading), "closes": F.contains("line", F.lit("Thus ends"))})
    return folds.owners(lines, ["doc_id"], ["line_no"], "heading", "closes").groupBy("doc_id", "owner").agg(F.count("*").alias("n"))


@query("h6_placements", "select s.l_linenumber slot, case when s.l_linenumber % 2 = 1 then 90 else 270 end rotation, count(*) n from lineitem s group by 1, 2")
def h6_placements(t):
    """The rotation of each slot, with how often it is used."""
    return t("lineitem").groupBy(F.col("l_linenumber").alias("slot"), F.when(F.col("l_linenumber") % 2 == 1, 90).otherwise(270).alias("rotation")).agg(F.count("*").alias("n"))


@query("h11_sizes", "select p_partkey, try_cast(regexp_extract(s, '([\\d.]+) x ([\\d.]+) pts', 1) as double) width, try_cast(regexp_extract(s, '([\\d.]+) x ([\\d.]+) pts', 2) as double) height from (select p_partkey, p_size || ' x ' || p_size * 2 || '.5 pts' s from part)")
def h11_sizes(t):
    """Page sizes read from their text."""
    size = F.concat_ws("", F.col("p_size").cast("string"), F.lit(" x "), (F.col("p_size") * 2).cast("string"), F.lit(".5 pts"))
    part = lambda g: F.regexp_extract(size, r"([\d.]+) x ([\d.]+) pts", g).try_cast("double")
    return t("part").select("p_partkey", part(1).alias("width"), part(2).alias("height"))


@query("i11_closers", "select doc_id, len(regexp_extract_all(text, 'Thus ends[^.\\n]*'))::bigint n from documents where contains(text, 'Thus ends')")
def i11_closers(t):
    """Closing sentences of cantos."""
    return t("documents").where(F.contains("text", F.lit("Thus ends"))).select("doc_id", F.size(X.tokens(F.col("text"), r"Thus ends[^.\n]*")).cast("long").alias("n"))


@query("i21_seams", "select doc_id, md5(regexp_replace(text, '\\n(?:- )?\\d+(?: -)?\\n', chr(10), 'g')) joined from documents where text is not null")
def i21_seams(t):
    """Documents without the seams between their pages (their hashes)."""
    return t("documents").where("text is not null").select("doc_id", F.md5(F.regexp_replace("text", r"\n(?:- )?\d+(?: -)?\n", "\n")).alias("joined"))


@query("i22_payload_fields", "select verse_id, replace(transliteration, '\"', '') transliteration, replace(translation, '\"', '') translation from verse where transliteration <> '' and translation <> ''")
def i22_payload_fields(t):
    """Fields cut from escaped JSON payloads, made from the verses for the purpose."""
    kept = t("verse").where("transliteration <> '' and translation <> ''")
    clean = lambda c: F.replace(F.col(c), F.lit('"'), F.lit(""))
    payload = F.concat(F.lit('{"shloka\\":\\"'), clean("transliteration"), F.lit('\\",\\"translation\\":\\"'), clean("translation"), F.lit('\\"}'))
    made = kept.select("verse_id", payload.alias("p"))
    return made.select("verse_id", X.json_field(F.col("p"), "shloka", ["translation"]).alias("transliteration"), X.json_field(F.col("p"), "translation", ["explanation"]).alias("translation"))


@query("i28_wrapped")
def i28_wrapped(t):
    """Translations wrapped to 60 characters: how many lines each takes."""
    return t("verse").where("translation is not null").select("verse_id", folds.lines_at(60)("translation").alias("n_lines"))


@query("i29_flows", """select doc_id, md5(substr(text, s, case when e > 0 then e - 1 else length(text) end)) flow from (select doc_id, text, greatest(strpos(text, 'Canto '), 1) s, strpos(substr(text, greatest(strpos(text, 'Canto '), 1)), 'Thus ends') e from documents where text is not null)""")
def i29_flows(t):
    """Each document from its first heading to its first closing sentence (hashes)."""
    begin = F.greatest(F.locate("Canto ", F.col("text")), F.lit(1))
    rest = t("documents").where("text is not null").select("doc_id", F.substring(F.col("text"), begin, F.length("text")).alias("rest"))
    end = F.locate("Thus ends", F.col("rest"))
    return rest.select("doc_id", F.md5(F.substring(F.col("rest"), F.lit(1), F.when(end > 0, end - 1).otherwise(F.length("rest")))).alias("flow"))


_PIXELS = "greatest(0, least(255, (128 + floor(x * 300))::int))"


def _pixels(t):
    value = lambda x: F.greatest(F.lit(0), F.least(F.lit(255), (128 + F.floor(x.cast("double") * 300)).cast("int")))
    return t("embeddings").select("vec_id", F.transform("embedding", value).alias("pixels"))


@query("o1_levels", f"""with h as (select vec_id, v, count(*) n from (select vec_id, {_PIXELS} v from (select vec_id, unnest(embedding)::double x from embeddings)) group by 1, 2), c as (select *, sum(n) over (partition by vec_id order by v rows unbounded preceding) u, sum(n) over (partition by vec_id) a from h)
 select vec_id, min(v) filter (where u >= a * 0.005::double) black, min(v) filter (where u >= a * 0.995::double) white from c group by 1""")
def o1_levels(t):
    """Black and white points of images; vectors stand in for pixels."""
    return B.levels(B.counts_of_values(_pixels(t), ["vec_id"], "pixels"), ["vec_id"], 0.005, 0.995)


@query("o3_tones", f"""with h as (select vec_id, v, count(*) n from (select vec_id, {_PIXELS} v from (select vec_id, unnest(embedding)::double x from embeddings)) group by 1, 2), c as (select *, sum(n) over (partition by vec_id order by v rows unbounded preceding) u, sum(n) over (partition by vec_id) a from h)
 select vec_id, min(v) filter (where u >= a * 0.01::double) p1, min(v) filter (where u >= a * 0.99::double) p99 from c group by 1""")
def o3_tones(t):
    """First and last percentile of tones."""
    return B.levels(B.counts_of_values(_pixels(t), ["vec_id"], "pixels"), ["vec_id"], 0.01, 0.99).select("vec_id", F.col("black").alias("p1"), F.col("white").alias("p99"))


@query("o4_spreads", f"""select vec_id, round(greatest(list_avg(list_transform(range(1, 21), lambda i: abs(p[i] - p[i + 20])::double)), list_avg(list_transform(range(1, 21), lambda i: abs(p[i + 20] - p[i + 40])::double))), 6) spread
 from (select vec_id, list_transform(embedding, lambda y: greatest(0, least(255, (128 + floor(y::double * 300))::int))) p from embeddings)""")
def o4_spreads(t):
    """How far colour channels lie apart."""
    channels = _pixels(t).select("vec_id", F.slice("pixels", 1, 20).alias("r"), F.slice("pixels", 21, 20).alias("g"), F.slice("pixels", 41, 20).alias("b"))
    return channels.select("vec_id", F.round(B.channel_spread("r", "g", "b"), 6).alias("spread"))


@query("o5_blur")
def o5_blur(t):
    """Sharpness of images; vectors stand in for eight rows of pixels."""
    return _pixels(t).select("vec_id", F.round(B.of_image(B.laplacian_variance)("pixels", F.lit(8)), 6).alias("blur"))


@query("o6_skew")
def o6_skew(t):
    """The angle at which images are skewed."""
    return _pixels(t).select("vec_id", B.of_image(B.skew_angle)("pixels", F.lit(8)).alias("skew"))


@query("r1_contents_blocks", """select scan_id, part, kanda, string_agg(coalesce(title_raw, '(untitled)') || ' ... ' || coalesce(printed_page::varchar, '?'), chr(10) order by archive_page nulls first, entry_id) leaf from toc_entry group by 1, 2, 3""")
def r1_contents_blocks(t):
    """The contents leaf of each book."""
    row = F.concat(F.coalesce("title_raw", F.lit("(untitled)")), F.lit(" ... "), F.coalesce(F.col("printed_page").cast("string"), F.lit("?")))
    held = t("toc_entry").groupBy("scan_id", "part", "kanda").agg(F.array_sort(F.collect_list(F.struct("archive_page", "entry_id", row.alias("r")))).alias("l"))
    return held.select("scan_id", "part", "kanda", F.array_join("l.r", "\n").alias("leaf"))


@query("r2_errata_blocks", "select scan_id, kanda, case when flag = 'missing_heading' then 'heading' else 'other' end kind, array_to_string(list_sort(list_distinct(list(sarga))), ', ') places from (select scan_id, kanda, sarga, unnest(flags) flag from sarga_span where sarga is not null) group by 1, 2, 3")
def r2_errata_blocks(t):
    """Errata of each book: missing headings and other flags."""
    flags = t("sarga_span").where("sarga is not null").select("scan_id", "kanda", "sarga", F.explode("flags").alias("flag"))
    kind = F.when(F.col("flag") == "missing_heading", "heading").otherwise("other")
    return flags.groupBy("scan_id", "kanda", kind.alias("kind")).agg(F.array_join(F.array_sort(F.collect_set("sarga")), ", ").alias("places"))


_ALT = "trim(regexp_replace(regexp_replace(text_devanagari_alt, '\\s*(।+)\\s*', ' \\1 ', 'g'), ' +', ' ', 'g'))"


@query("s1_filled", f"""with a as (select verse_id, case when coalesce(text_devanagari, '') = '' then case when coalesce({_ALT}, '') <> '' then 'alternative' else 'missing' end end d, case when coalesce(transliteration, '') = '' then
 case when coalesce(text_devanagari, '') <> '' or coalesce({_ALT}, '') <> '' then 'generated' else 'missing' end end r, case when coalesce(translation, '') = '' then case when coalesce(explanation, '') <> '' then 'explanation' else 'missing' end end x from verse)
 select verse_id, 'text_devanagari' field, d source from a where d is not null union all select verse_id, 'transliteration', r from a where r is not null union all select verse_id, 'translation', x from a where x is not null""")
def s1_filled(t):
    """Missing fields of verses filled from others in order of preference: the audit."""
    ways = {
        "text_devanagari": [("alternative", X.danda_spaced(F.col("text_devanagari_alt")))],
        "transliteration": [("generated", X.transliterated("text_devanagari"))],
        "translation": [("explanation", F.col("explanation"))],
    }
    return filling.audit(filling.filled(t("verse"), ways), ["verse_id"], list(ways))


@query("t1_overlay", """select v.verse_id, case when trim(coalesce(v.explanation, '') || ' ' || coalesce(e.label, '')) = '' then null else trim(coalesce(v.explanation, '') || ' ' || coalesce(e.label, '')) end notes, 'p. ' || v.verse locator from verse v join edition e using (edition_id)""")
def t1_overlay(t):
    """Records with an overlay's notes added to their own and a locator made."""
    notes = F.trim(F.concat_ws(" ", F.coalesce("explanation", F.lit("")), F.coalesce("label", F.lit(""))))
    both = t("verse").join(t("edition").select("edition_id", "label"), "edition_id")
    return both.select("verse_id", F.when(notes != "", notes).alias("notes"), F.concat(F.lit("p. "), F.col("verse").cast("string")).alias("locator"))


@query("w2_number_ranges", "select item_id, try_cast(regexp_extract(s, '^(\\d+)(?:-(\\d+))?$', 1) as int) first_number, coalesce(try_cast(nullif(regexp_extract(s, '^(\\d+)(?:-(\\d+))?$', 2), '') as int), try_cast(regexp_extract(s, '^(\\d+)(?:-(\\d+))?$', 1) as int)) last_number from (select item_id, case when item_id % 2 = 0 then item_id || '-' || item_id + 3 else item_id::varchar end s from evalitem)")
def w2_number_ranges(t):
    """Range texts, `n` or `n-m`, as numbers."""
    spec = F.when(F.col("item_id") % 2 == 0, F.concat_ws("-", F.col("item_id").cast("string"), (F.col("item_id") + 3).cast("string"))).otherwise(F.col("item_id").cast("string"))
    part = lambda g: F.regexp_extract(spec, r"^(\d+)(?:-(\d+))?$", g).try_cast("int")
    return t("evalitem").select("item_id", part(1).alias("first_number"), F.coalesce(part(2), part(1)).alias("last_number"))


QUERIES, ORACLES = query.queries, query.oracles
