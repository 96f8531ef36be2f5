"""p5_found: values garbled by known encodings."""

import random

import __spark_entry__
from folioframe.llm import encoding as E

NAMES = ["Ṛkṣirūḍha", "Kuṇḍīghoṣa", "Śvetabāhu", "Jaṭīdaṃṣṭra", "Ojāṇikā", "Lohīśila", "Niśūdhara", "Caṣavega", "Bhīrumālin", "Pāṇuketu", "Udāṇikā", "Meṣapāṇi"]
KINDS = [lambda t: t.encode().decode("latin-1"), lambda t: t.encode().decode("cp437"), lambda t: t.encode().decode("mac-roman"), lambda t: t.encode("ascii", "replace").decode(), lambda t: t.encode("latin-1", "replace").decode("ascii", "replace").replace("?", "�")]


def corpus():
    rng = random.Random(9)
    rows, bad = [], {}
    for i in range(1500):
        foreign = "château" if i % 12 else "castle"
        text = f"“{rng.choice(NAMES)} followed {rng.choice(NAMES)} and {rng.choice(NAMES)}, a {foreign} of the {rng.choice(['bear', 'bird'])}!” said {rng.choice(NAMES)}. ({i % 30})"
        if i % 12 == 0:
            bad[i] = text
            text = KINDS[i // 12 % len(KINDS)](text)
        rows.append((i, text))
    return rows, bad


def test_query_over_tables(spark, tmp_path):
    rows, bad = corpus()
    rows += [(9000, None), (9001, ""), (9002, "Plain?"), (9003, "Is it?”"), (9004, "a mediæval Ågård")]
    spark.createDataFrame([(*r, "x") for r in rows], "verse_id long, translation string, core string").write.parquet(f"{tmp_path}/verse.parquet")
    spark.createDataFrame([(1, "How Ojāṇikā came"), (2, "How Oj─üß╣çik─ü came"), (3, None)], "entry_id long, title_raw string").write.parquet(f"{tmp_path}/toc_entry.parquet")
    queries = __spark_entry__.queries()
    got = {tuple(r) for r in queries["p5_found"](spark, str(tmp_path)).collect()}
    assert got == {("translation", i) for i in bad} | {("title_raw", 2)}
    texts = {(r.field, r.record_id): r.restored_value for r in queries["p5_text"](spark, str(tmp_path)).collect()}
    # Sequences that only one of the few names shows are not learned.
    whole = [i for i in bad if i // 12 % len(KINDS) < 3]
    assert sum(texts["translation", i] == bad[i] for i in whole) >= 0.6 * len(whole) and texts["title_raw", 2] == "How Ojāṇikā came"


def test_empty_table(spark):
    df = spark.createDataFrame([], "field string, record_id long, value string, restored string")
    assert E.garbled(df, ["field", "record_id"], "value").collect() == []
    assert E.restored(df, ["field", "record_id"], "value").collect() == []


def test_shapes():
    assert E.shapes("Nalµubåhu", True)[0] == ("Nalubhu", [3, 5], ["µ", "å"])
    assert ("Nalbhu", [3, 4], ["µu", "å"]) in E.shapes("Nalµubåhu", True)
    assert E.cores("Tor?n?bha, what? “Yes” plain") == ["Tor?n?bha", "“Yes”"]


def test_long_words_are_none():
    assert E.cores("a" * 300_000 + " é") == ["é"] and E.cores("é" * 300_000) == [] and E.cores("?" * 300_000 + "a") == []
