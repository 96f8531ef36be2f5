"""p5: words of any length, and all readings of a stripped word, count."""

import random

from folioframe.llm import encoding as E

VALUES = "field string, record_id long, value string"
KEYS = ["field", "record_id"]


def word(rng, pieces):
    return "".join(rng.choice(["a", "b", "ab", "é", "├⌐", "ś", "?", "�", "-", "1"]) for _ in range(pieces))


def test_runs_are_the_texts_of_all_variants():
    rng = random.Random(1)
    for _ in range(20_000):
        core = word(rng, rng.randrange(1, 14))
        assert E.runs(core) == {t for key, _, texts in E.shapes(core, True) if len(key) > 1 for t in texts}, core


def test_halves_meet_the_twins_of_all_variants(spark):
    rng = random.Random(2)
    counts = {}
    for _ in range(300):
        clean = word(rng, rng.randrange(4, 40)).replace("?", "").replace("�", "")
        counts[clean] = rng.randrange(3, 40)
        for _ in range(3):  # one character read as others, at one place a letter more; few of many pieces stay twins
            garbled = clean.replace("é", "├⌐") if rng.random() < 0.5 else clean
            at = [i for i, c in enumerate(garbled) if not c.isascii()] or [0]
            i = rng.choice(at) + 1
            counts.setdefault(garbled[:i] + rng.choice(["a", "b", "", "ś", "śb"]) + garbled[i:], rng.randrange(1, 5))
    words = spark.createDataFrame([(c, n) for c, n in counts.items() if any(not x.isascii() for x in c)], "core string, n long")
    listed, met = ({repr(tuple(r)) for r in E._twins(words, wide).collect()} for wide in (1_000, 2))
    assert listed == met and len(listed) > 300


def test_all_readings_of_a_stripped_word_are_twins(spark):
    clean = {f"r{c}s": 30 - i for i, c in enumerate("éèêëēė")}
    words = spark.createDataFrame([*clean.items(), ("r├⌐s", 1)], "core string, n long")
    assert {r.twin for r in E._twins(words).where("core = 'r├⌐s'").collect()} == set(clean)


def test_frequent_readings_with_lost_characters_hide_no_twin(spark):
    counts = {"r" + "�" * k + "s": 10 for k in (1, 2, 3, 4)} | {"rés": 9, "r�����s": 3}
    rows = [("f", i, core) for i, core in enumerate(c for c, n in counts.items() for _ in range(n))]
    got = E.garbled(spark.createDataFrame(rows, VALUES), KEYS, "value").where("core = 'r�����s'").collect()
    assert [r.restored for r in got] == ["rés"] * 3


def test_long_words_are_found_and_restored(spark):
    short = [("café", 12), ("décor", 12), ("caf├⌐", 1), ("d├⌐cor", 1)]
    # Of the two long words, one has no other reading and one has one; its first sequence took a letter along.
    alone, known = "café/décor+" * 60, "xéo/" * 20_000
    long = [(alone.replace("é", "├⌐"), 1), (known, 3), ("xéoo/".replace("éo", "├⌐o") + "xéo/".replace("é", "├⌐") * 19_999, 1)]
    rows = [("f", i, f"Of {core} he said") for i, core in enumerate(c for c, n in short + long for _ in range(n))]
    got = {r.record_id: r.restored_value for r in E.restored(spark.createDataFrame(rows, VALUES), KEYS, "value").collect()}
    assert set(got) == {24, 25, 26, 30}
    assert got[24] == "Of café he said" and got[25] == "Of décor he said" and got[26] == f"Of {alone} he said"
    assert got[30].startswith("Of xé") and got[30].endswith("xéo/ he said") and "├⌐" not in got[30]


def test_a_long_twin_takes_a_letter_along(spark):
    clean = "mśna" * 30_000
    at = 4 * 20_000 + 2
    words = spark.createDataFrame([(clean, 5), (clean[: at - 1] + "╢o" + clean[at:], 1), (clean[:at] + "o" + clean[at:], 1)], "core string, n long")
    got = E._twins(words).collect()
    assert len(got) == 2 and all(r.twin == clean and len(r.key) == 64 for r in got)
    assert {tuple(r.garbled[20_000:20_001]) for r in got} == {("╢o",), ("śo",)}
