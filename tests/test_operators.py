"""Operators on the cases their docstrings define, and sources and sinks on files."""

from pyspark.sql import functions as F

from folioframe.operators import aggregates as A
from folioframe.operators import captions, checks, filling
from folioframe.operators import lines as L
from folioframe.operators import ordered as O
from folioframe.sources import files, sinks

VTT = """WEBVTT

header

00:00:01.000 --> 00:00:03.000 align:start
<c>hello</c>

more of it

00:00:03.000 --> 00:00:03.010
hello

00:00:05.000 --> 00:00:06.000
[music]

00:00:07.000 --> 00:00:09.000

"""


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_cues(spark):
    df = spark.createDataFrame([(1, VTT), (2, None), (3, "")], "k int, t string")
    assert rows(captions.cues(df, ["k"], "t")) == [(1, 1, 1.0, 3.0, "hello\nmore of it"), (1, 3, 5.0, 6.0, "[music]")]


def test_runs_and_missing_numbers(spark):
    df = spark.createDataFrame([(1, n, "x") for n in (1, 2, 2, 3, 5, 9, None)] + [(None, 4, "x"), (2, None, "y")], "k int, n int, _run string")
    assert rows(O.compact_runs(df, ["k"], "n")) == [(1, "1-3, 5, 9"), (None, "4")]
    assert rows(O.missing_numbers(df, ["k"], "n")) == [(1, 4, 4), (1, 6, 8), (None, 1, 3)]
    assert rows(O.runs(df.limit(0), ["k"], "n")) == []


def test_sessions_of_exactly_the_gap(spark):
    df = spark.sql("select 1 k, timestamp'2025-01-01 00:00:00' + make_interval(0,0,0,0,0,0,s) t from values (0), (60), (121), (121), (400) as x(s)").unionByName(spark.sql("select 1 k, cast(null as timestamp) t"))
    assert sorted(r.n for r in O.sessions(df, ["k"], "t", 60).collect()) == [1, 2, 2] and [r.n for r in O.sessions(df, ["k"], "t", 61, 3).collect()] == [4]


def test_changes_skip_blanks(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(["a", "", "a", None, "b", "a"])], "k int, i int, v string")
    assert [r.i for r in O.changes(df, ["k"], ["i"], "v").orderBy("i").collect()] == [0, 4, 5]


def test_as_of_and_index(spark):
    left = spark.createDataFrame([(1, 5), (1, 1), (2, 5), (1, None)], "k int, at int")
    right = spark.createDataFrame([(1, 5, 1, "old"), (1, 5, 2, "new"), (1, 2, 1, "early"), (1, 9, 1, "late"), (1, None, 9, "never")], "k int, at int, o int, v string")
    assert rows(O.as_of(left, right, ["k"], "at", "o", ["v"])) == rows(spark.createDataFrame([(1, 5, "new"), (1, 1, None), (2, 5, None), (1, None, None)], "k int, at int, v string"))
    spans = spark.createDataFrame([(1, 1, 3, 1), (1, 3, 4, 2), (1, 9, 8, 3), (1, None, 2, 4)], "k int, s int, e int, n int")
    assert rows(O.page_index(spans, ["k"], "s", "e", ["n"], ["n"])) == [(1, 1, 1), (1, 2, 1), (1, 3, 2), (1, 4, 2)]
    assert rows(O.tiling(spans.where("s is not null"), ["k"], "s", "e", 0)) == [(1, 3, 4, "overlap"), (1, 9, 8, "inverted")]


def test_aggregates(spark):
    df = spark.createDataFrame([(1, v, i) for i, v in enumerate([4, 1, 2, 3, None])] + [(2, None, 9)], "k int, v int, i int")
    assert rows(A.upper_median(df, ["k"], "v")) == [(1, 4, 1, 3, 4)]
    assert rows(A.most_common(df, ["k"], F.col("v") % 2, "i")) == [(1, 0, 2)]
    assert rows(A.ordered_text(df.withColumn("t", F.col("v").cast("string")), ["k"], ["i"], "t", "-")) == [(1, "4-1-2-3")]


def test_lines(spark):
    df = spark.createDataFrame([(1, "a\n\nb\n"), (2, ""), (3, None), (4, "\n")], "k int, t string")
    assert rows(L.lines(df, ["k"], "t")) == [(1, 1, "a"), (1, 2, ""), (1, 3, "b"), (4, 1, "")]
    page = spark.createDataFrame([(1, "12\n* HEAD *\ntext\n12\n")], "k int, t string")
    assert [r.chrome for r in L.without_chrome(L.lines(page, ["k"], "t"), ["k"], F.col("line").rlike(r"^\d+$|^\*")).orderBy("line_no").collect()] == [True, True, False, False]


def test_checks(spark):
    a = spark.createDataFrame([(1, 5), (2, 6), (None, 7)], "k int, v int")
    b = spark.createDataFrame([(1, 5), (2, 8), (3, None)], "k int, v int")
    assert {(r.k, r.status) for r in checks.reconcile(a, b, ["k"], "v").collect()} == {(1, "matched"), (2, "mismatch"), (3, "right_only"), (None, "left_only")}
    assert rows(checks.violations(a, ["v"], {"key": F.col("k") > 1, "small": F.col("v") < 7})) == [(5, "key"), (7, "key"), (7, "small")]
    assert rows(checks.orphans(a, ["v"], b, "k")) == [(7,)] and rows(checks.repeated(a.unionByName(a.limit(1)), ["k"]).select("n")) == [(2,)]


def test_filling(spark):
    df = spark.createDataFrame([(1, "", "b", None), (2, "a", None, ""), (3, None, None, None)], "k int, x string, y string, z string")
    out = filling.filled(df, {"x": [("of y", F.col("y"))], "z": [("of x", F.col("x"))]})
    assert rows(out.select("k", "x", "z")) == [(1, "b", "b"), (2, "a", "a"), (3, None, None)]
    assert rows(filling.audit(out, ["k"], ["x", "z"])) == [(1, "x", "of y"), (1, "z", "of x"), (2, "z", "of x"), (3, "x", "missing"), (3, "z", "missing")]


def test_files(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"a": 1,\n "b": "x"}')
    (tmp_path / "many.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    (tmp_path / "words.tsv").write_text("\t".join(files.WORD_COLUMNS) + "\n5\t1\t1\t1\t1\t1\t10\t20\t30\t5\t95.5\tword\n4\t1\t1\t1\t1\t0\t1\t1\t1\t1\t-1\t\n5\t1\t1\t1\t1\t2\t1\t1\t1\t1\t3\t \n")
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "pg-0012.png").write_bytes(b"page-12")
    (tmp_path / "pages" / "cover.png").write_bytes(b"c")
    (tmp_path / "book.toml").write_text('title = "A"\n[page]\nwidth = 3\n')
    assert files.json_documents(spark, str(tmp_path / "one.json"), "a int, b string").select("a", "b").first() == (1, "x")
    assert sorted(r.a for r in files.json_lines(spark, str(tmp_path / "many.jsonl"), "a int").collect()) == [1, 2]
    [word] = files.ocr_words(spark, str(tmp_path / "words.tsv")).collect()
    assert (word.text, word.right, word.bottom, word.conf) == ("word", 40, 25, 95.5)
    assert {(r.page, r.size_bytes) for r in files.page_files(spark, str(tmp_path / "pages")).collect()} == {(12, 7), (None, 1)}
    assert files.profile(str(tmp_path / "book.toml"), {"title": "B", "page": {"width": 1, "height": 2}}) == {"title": "A", "page": {"width": 3, "height": 2}}
    assert files.texts(spark, str(tmp_path / "one.json")).first().text.startswith("{")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x\ny"), (2, None, "z")], "k int, v string, t string")
    sinks.json_lines(df, str(tmp_path / "j"))
    assert files.json_lines(spark, str(tmp_path / "j"), "k int, v string").count() == 2
    sinks.texts_by(df, str(tmp_path / "t"), ["k"], "t")
    assert (tmp_path / "t" / "k=1").exists()
    sinks.table(df, str(tmp_path / "p"), ["k"])
    assert rows(spark.read.parquet(str(tmp_path / "p")).select("t")) == [("x\ny",), ("z",)]
    assert sinks.provenance(df, source="test").first().asDict() | {"schema_sha256": ""} == {"rows": 2, "columns": 3, "schema_sha256": "", "source": "test"}
