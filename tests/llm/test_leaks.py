"""p7_found: passages held whole or in part."""

import random

import numpy as np
import pyarrow as pa

import __spark_entry__
from folioframe.llm.leaks import SEED, Index, Wavelet, leaks, merged, suffixes, words

STOCK = "Lines that could not be read from the scan are marked in the list of gaps kept beside the page images."
W = [f"wörd{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
PASSAGES = {10 + i: " ".join(W[40 * i : 40 * i + 40]).capitalize() + ". " + STOCK for i in range(8)}
DEVA = "गासत् रैलिह दाणर एडभोरिः जिवेथ आनेलेः । सेताचसीं नियेनृः कया रेग्नाणिं असीज्ञुं विदुवेज्ञुं ।। धरिध्राम् नधिनोम्बें षषाविन् वायैक्त्वं डालं पादेबु ।।"


def part(i, a, b):
    return W[40 * i + a : 40 * i + b]


CASES = {
    1: (" ".join(part(0, 0, 40)), 10),
    2: ("before " + " ".join(part(1, 5, 20)) + " after", 11),
    3: ("\n".join(part(2, 0, 17)).upper().replace("Ö", "O") + "!", 12),
    4: (" ".join(w if k % 5 else "changed" for k, w in enumerate(part(3, 0, 24))), 13),
    5: (" ".join(part(4, 0, 9)) + " and between much other text " + " ".join(part(4, 20, 29)), 14),
    6: (DEVA.replace("।", " ।\n"), 99),
    7: (" ".join(x for w in part(5, 0, 20) for x in [w[:3] + "-\n" + w[3:]]), 15),
}
NONE = {
    20: " ".join(part(0, 0, 10)), 21: STOCK * 3, 22: None, 23: "", 24: " ".join(part(6, 0, 40)[::-1]),
    25: " ".join(part(6, 20, 29)) + " x y z " + " ".join(part(6, 0, 9)),
    26: " ".join(part(6, 0, 14)),
}


def test_query_over_tables(spark, tmp_path):
    documents = [(k, t) for k, (t, _) in CASES.items()] + list(NONE.items()) + [(1000 + k, f"filler {k}") for k in range(50)]
    spark.createDataFrame(documents, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([*PASSAGES.items(), (99, DEVA), (98, None)], "item_id long, passage string").write.parquet(f"{tmp_path}/evalitem.parquet")
    got = sorted(tuple(r) for r in __spark_entry__.queries()["p7_found"](spark, str(tmp_path)).collect())
    assert got == [(k, i) for k, (_, i) in CASES.items()]
    spans: dict[int, list[tuple[int, int]]] = {}
    for r in __spark_entry__.queries()["p7_spans"](spark, str(tmp_path)).collect():
        spans.setdefault(r.doc_id, []).append((r.first_word, r.last_word))
    assert set(spans) == set(CASES) and spans[1] == [(0, 39)] and spans[2] == [(1, 15)]
    assert sorted(spans[5]) == [(0, 8), (14, 22)]


def test_empty_tables(spark):
    documents = spark.createDataFrame([], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(1, " ".join(W[:40]))], "item_id long, passage string")
    one = spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, item_id int")
    assert leaks(documents, items, "doc_id", "text", "item_id", "passage").collect() == []
    assert leaks(one, items.limit(0), "doc_id", "text", "item_id", "passage").collect() == []


def test_merged():
    assert merged([(5, 9), (1, 3), (4, 4), (12, 13), (6, 7)]) == [(1, 9), (12, 13)]


def test_suffixes_and_ranks():
    rng = random.Random(8)
    for size in (1, 3, 300):
        text = np.array([rng.randrange(1, size + 1) for _ in range(300)] * 2 + [0], dtype=np.int64)
        listed = text.tolist()
        assert suffixes(text, size).tolist() == sorted(range(len(text)), key=lambda i: listed[i:])
        wavelet = Wavelet(text, size)
        rows = np.array([rng.randrange(len(text)) for _ in range(50)])
        assert wavelet.at(rows).tolist() == [listed[r] for r in rows]
        number = np.array([rng.randrange(size + 1) for _ in rows])
        assert wavelet.rank(number, rows).tolist() == [listed[:r].count(x) for x, r in zip(number.tolist(), rows)]


def test_index_against_search():
    rng = random.Random(3)
    for size in (2, 5):
        text = np.array([0] + [rng.randrange(size + 1) for _ in range(400)] + [0], dtype=np.int64)
        patterns = np.array([[1 + n // size**k % size for k in range(SEED)] for n in range(size**SEED)], dtype=np.int64)
        which, place = Index(text, size).find(patterns)
        want = {(n, i) for n, p in enumerate(patterns) for i in range(len(text) - SEED + 1) if (text[i : i + SEED] == p).all()}
        assert set(zip(which.tolist(), place.tolist())) == want and len(which) == len(want)


def test_long_runs_take_linear_time():
    for run in ("a", "-", "a-", "a-\n", "\n", " ", "́", "​", "1"):
        words("a-" + run * 100_000 + "b")


def test_shards(monkeypatch):
    from folioframe.llm import leaks as module

    monkeypatch.setattr(module, "SHARD", 3)
    monkeypatch.setattr(module, "CHARACTERS", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(["a" * 50, None, "", "bb", "b" * 9, "c", "d", "e" * 11])], ["k", "t"])
    assert [x.num_rows for x in module.shards(batch)] == [1, 3, 2, 1, 1] and pa.Table.from_batches(module.shards(batch)).num_rows == 8
