"""Text read under a wrong encoding: found and restored by clean near-twins.

Words are joined with frequent words that are equal once all non-ASCII characters are taken
out. Aligning a garbled word with its clean twin, place by place, tells what the wrong reading
made of each character; a transformation that many different words agree on is learned, and is
applied to the words that have no twin of their own. No list of encodings is built in, so
double readings and the private encodings of fonts are learned like all others.

The words are counted over all values; only the learned transformations, whose number is
bounded by the characters in use, are sent to the workers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping, Sequence
from hashlib import blake2b

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

RATIO = 3  # times a twin is more frequent than the word that is garbled
EVIDENCE = 2  # different words that must agree on a transformation
AGREE = 0.6  # of a sequence's evidence, the share of its one reading
RARER = 4  # times the clean sequence is more frequent than the garbled one
OWN = 5  # a word without a twin, so many times as frequent as garbled words are, is a word of its own
MOST = 200_000  # transformations; an error beyond
LONGEST = 400  # characters of a common word; of a longer stripped word a digest is counted
WIDE = 16  # sequences up to which all variants of a word are listed; those of more are met by halves
COUNTED = 500_000  # distinct words that a task holds before it emits their counts
HELD = 1 << 25  # characters that a task holds before it emits them

#: A replaced character: the replacement character, or a question mark before a letter, digit or another.
LOST = r"�|\?(?=[?A-Za-z0-9�])"
_PART = re.compile(r"[^ \t\n\r]+")
_EDGE = ".,;:!()'\"-[]*"
_RUN = regex.compile(rf"(?:[^\x00-\x7F]|{LOST})+")
_LOST = regex.compile(LOST)
_CONTROL = regex.compile(r"[\x80-\x9F]")


def cores(value: str, longest: int | None = LONGEST) -> list[str]:
    """The words of a value that hold other than ASCII characters, without ASCII punctuation around
    them; those of up to `longest` characters, or of any length, as the queries take them, if None."""
    if value.isascii() and "?" not in value:
        return []
    parts = (w.strip(_EDGE).removesuffix("?") for w in _PART.findall(value) if not w.isascii() or "?" in w)
    return [c for c in parts if (longest is None or len(c) <= longest) and _RUN.search(c)]


def shapes(core: str, wide: bool) -> list[tuple[str, list[int], list[str]]]:
    """The stripped word with the places and texts of what was taken out; if `wide`, also each
    variant in which one of the sequences takes the next ASCII letter along."""
    runs = [m.span() for m in _RUN.finditer(core)]
    out = []
    for grown in range(-1, len(runs) if wide else 0):
        key, places, texts, at = "", [], [], 0
        for i, (a, b) in enumerate(runs):
            if a < at:  # the letter taken along was the whole gap
                a = at
            key += core[at:a]
            if i == grown and core[b : b + 1].isalpha():
                b += 1
            places.append(len(key))
            texts.append(core[a:b])
            at = b
        key += core[at:]
        if grown >= 0 and not texts[grown][-1:].isascii():
            continue
        out.append((key, places, texts))
    return out


def runs(core: str) -> set[str]:
    """The texts of all variants of a word whose stripped form has more than one character."""
    key, places, texts = shapes(core, False)[0]
    grown = (t + key[p] for p, t in zip(places, texts) if key[p : p + 1].isalpha()) if len(key) > 2 else ()
    return {*texts, *grown} if len(key) > 1 else set()


def halves(core: str, grown: bool) -> list[tuple[str, str]]:
    """Digests of the two halves of a stripped word. If `grown`, one sequence is to take the next
    letter along: a twin then has the same digest of the half in which it does not."""
    key, places, _ = shapes(core, False)[0]
    half, less = len(places) // 2, int(grown)
    at = places[half]
    kept = {"first": (len(places), at - less, key[at:], [p - at for p in places[half:]]), "second": (len(places), len(key) - less, key[:at], places[: half + 1])}
    return [(side, blake2b(repr(x).encode(), digest_size=16).hexdigest()) for side, x in kept.items()]


def taken_along(core: str, twin: str) -> tuple[int, str, list[str], list[str]] | None:
    """The sequence of a word that must take the next letter along for the word to have the
    stripped form of its twin, that form, and the texts of both; None if it cannot have it."""
    (key, places, texts), (bare, clean_places, clean) = shapes(core, False)[0], shapes(twin, False)[0]
    if len(places) != len(clean_places):
        return None
    i = next((j for j, (p, q) in enumerate(zip(places, clean_places)) if p != q), len(places)) - 1
    letter = key[places[i] : places[i] + 1] if i >= 0 else ""
    if not letter.isalpha() or [p - 1 for p in places[i + 1 :]] != clean_places[i + 1 :] or key[: places[i]] + key[places[i] + 1 :] != bare:
        return None
    return i, bare, [*texts[:i], texts[i] + letter, *texts[i + 1 :]], clean


def _batched(rows: Iterable[tuple], kinds: Mapping[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows, of which the first column is the longest text, as batches that bound what is held."""
    held, weight = [], 0

    def emitted() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held), kinds.values())], list(kinds))

    for row in rows:
        held.append(row)
        weight += len(row[0])
        if weight >= HELD:
            yield emitted()
            held, weight = [], 0
    if held:
        yield emitted()


_TEXTS = pa.list_(pa.string())


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(x.to_pylist() for x in batch.columns))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    long = 0

    def emitted() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["core", "n"])

    for batch in batches:
        for value in batch.column(0).to_pylist():
            if value:
                found = cores(value, None)
                counts.update(found)
                long += len(value) if len(value) > LONGEST and any(len(c) > LONGEST for c in found) else 0
                if long >= HELD:
                    yield emitted()
                    counts.clear()
                    long = 0
        if len(counts) >= COUNTED:
            yield emitted()
            counts.clear()
            long = 0
    if counts:
        yield emitted()


def _shaped(wide: int):
    """The stripped forms of words; the variants of those with up to `wide` sequences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for core, n in _rows(batches):
                found = shapes(core, False)
                if len(found[0][1]) <= wide:
                    found = shapes(core, True)
                yield from ((core, n, *s) for s in found if len(s[0]) > 1)

        yield from _batched(rows(), {"core": pa.string(), "n": pa.int64(), "key": pa.string(), "places": pa.list_(pa.int32()), "texts": _TEXTS})

    return run


_SHAPE = "core string, n long, key string, places array<int>, texts array<string>"


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batched(((r, n) for core, n in _rows(batches) for r in runs(core)), {"run": pa.string(), "n": pa.int64()})


def _halved(grown: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((core, n, *h) for core, n in _rows(batches) for h in halves(core, grown))
        yield from _batched(rows, {"core": pa.string(), "n": pa.int64(), "side": pa.string(), "half": pa.string()})

    return run


_HALF = "core string, n long, side string, half string"


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of words and twins, met by a half, that are pairs as a whole."""

    def rows() -> Iterator[tuple]:
        for core, n, side, twin, twin_n in _rows(batches):
            got = taken_along(core, twin)
            if got and (got[0] < len(got[2]) // 2) == (side == "first"):
                yield core, n, twin, twin_n, *got[1:]

    yield from _batched(rows(), {"core": pa.string(), "n": pa.int64(), "twin": pa.string(), "twin_n": pa.int64(), "key": pa.string(), "garbled": _TEXTS, "clean": _TEXTS})


def _twins(words: DataFrame, wide: int = WIDE) -> DataFrame:
    """core, n, twin, twin_n, key, garbled, clean: each word beside more frequent ones of its stripped
    form. Of words with more than `wide` sequences the variants are not listed, which would be as many
    as their length and each as long: a sequence that takes a letter along leaves one half of the word
    as it is, so that such pairs meet by the digest of a half and are then compared whole."""
    first = words.mapInArrow(_shaped(-1), _SHAPE)
    most = F.max("n").over(Window.partitionBy("key", "places"))
    # A twin is seen RATIO times at least, as its word is seen once.
    clean = first.withColumn("_most", most).where((RATIO * F.col("n") >= F.col("_most")) & (F.col("n") >= RATIO)).where(~F.col("core").rlike(LOST) & ~F.col("core").rlike("[\\x80-\\x9F]"))
    clean = clean.select("key", "places", F.col("core").alias("twin"), F.col("n").alias("twin_n"), F.col("texts").alias("clean"))
    garbled = words.mapInArrow(_shaped(wide), _SHAPE).withColumnRenamed("texts", "garbled")
    columns = ["core", "n", "twin", "twin_n", "key", "garbled", "clean"]
    listed = garbled.join(clean, ["key", "places"]).where(F.col("twin_n") >= RATIO * F.col("n")).select(*columns)
    many = F.size("places") > wide
    twin_halves = clean.where(many).select("twin", "twin_n").mapInArrow(_halved(False), _HALF).withColumnsRenamed({"core": "twin", "n": "twin_n"})
    met = first.where(many).select("core", "n").mapInArrow(_halved(True), _HALF).join(twin_halves, ["side", "half"]).where(F.col("twin_n") >= RATIO * F.col("n"))
    met = met.select("core", "n", "side", "twin", "twin_n").mapInArrow(_met, "core string, n long, twin string, twin_n long, key string, garbled array<string>, clean array<string>")
    # The keys are only told apart, once for each sequence of a word.
    key = F.when(F.length("key") > LONGEST, F.sha2("key", 256)).otherwise(F.col("key"))
    return listed.union(met).withColumn("key", key)


def transformations(words: DataFrame, twins: DataFrame) -> dict[str, str]:
    """The garbled sequences with the one clean sequence that the twins of different words show."""
    pairs = twins.select("key", F.explode(F.arrays_zip("garbled", "clean")).alias("p")).select("key", "p.garbled", "p.clean").where("garbled <> clean")
    pairs = pairs.where(~F.col("garbled").rlike(LOST))
    seen = pairs.groupBy("garbled", "clean").agg(F.countDistinct("key").alias("keys"))
    often = words.mapInArrow(_run, "run string, n long").groupBy("run").agg(F.sum("n").alias("often"))
    all_of = Window.partitionBy("garbled")
    best = (
        seen.withColumns({"all": F.sum("keys").over(all_of), "rank": F.row_number().over(all_of.orderBy(F.desc("keys"), "clean"))})
        .where((F.col("rank") == 1) & (F.col("keys") >= EVIDENCE) & (F.col("keys") >= AGREE * F.col("all")))
        .join(often.select(F.col("run").alias("garbled"), F.col("often").alias("g_often")), "garbled")
        .join(often.select(F.col("run").alias("clean"), F.col("often").alias("c_often")), "clean")
        .where(F.col("c_often") >= RARER * F.col("g_often"))
    )
    rows = best.select("garbled", "clean").limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise RuntimeError(f"more than {MOST} transformations: the values are not text with a few wrong encodings")
    learned = {r.garbled: r.clean for r in rows}
    # What consists of clean characters is no garbled sequence, and a letter belongs to one only
    # if the sequence without it has no reading of its own.
    sound = {c for x in learned.values() for c in x}
    bare = lambda g: g[:-1] if g[-1].isascii() else None
    return {g: c for g, c in learned.items() if not all(x.isascii() or x in sound for x in g) and bare(g) not in learned}


class Restorer:
    """Applies learned transformations, the longest sequences first."""

    def __init__(self, learned: Mapping[str, str]) -> None:
        self.learned = dict(learned)
        names = sorted(self.learned, key=lambda g: (-len(g), g))
        self.sequences = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.characters = {c for g in names for c in g if not c.isascii()}
        self.alone = self.characters - {c for x in self.learned.values() for c in x}

    def __call__(self, core: str) -> str:
        return self.sequences.sub(lambda m: self.learned[m[0]], core) if self.sequences else core

    def strange(self, core: str) -> bool:
        """Whether a character of garbled sequences alone is in a word."""
        return not self.alone.isdisjoint(core)

    def suspect(self, core: str) -> bool:
        return not self.characters.isdisjoint(core) or bool(_LOST.search(core) or _CONTROL.search(core))


def garbled_words(words: DataFrame) -> tuple[DataFrame, Restorer]:
    """The garbled among counted words as core, restored (null where nothing tells), and the restorer."""
    twins = durable(_twins(words))
    restorer = Restorer(transformations(words, twins))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(c, n, restorer(c), bool(_LOST.search(c) or _CONTROL.search(c)), restorer.strange(c)) for c, n in zip(*(batch.column(i).to_pylist() for i in (0, 1))) if restorer.suspect(c)]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()))], ["core", "n", "restored", "lost", "strange"])

    read = words.mapInArrow(run, "core string, n long, restored string, lost boolean, strange boolean")
    known = words.select(F.col("core").alias("restored"), F.col("n").alias("clean_n"))
    twin = twins.groupBy("core").agg(F.min_by("twin", F.struct(-F.col("twin_n"), "twin")).alias("twin"))
    joined = read.join(known, "restored", "left").join(twin, "core", "left")
    # How often a garbled word is seen, of those that have a clean reading.
    usual = joined.where((F.col("restored") != F.col("core")) & (F.col("clean_n") >= RATIO * F.col("n"))).agg(F.coalesce(F.avg("n"), F.lit(1.0)).alias("usual"))
    changed = F.col("restored") != F.col("core")
    found = joined.crossJoin(usual).where(  # one row
        F.col("lost") | (F.col("strange") & F.col("twin").isNotNull()) | (changed & ((F.coalesce("clean_n", F.lit(0)) >= RATIO * F.col("n")) | (F.col("clean_n").isNull() & (F.col("n") < OWN * F.col("usual")))))
    )
    kept = F.when(changed & F.col("clean_n").isNotNull(), F.col("restored")).otherwise(F.coalesce("twin", F.when(changed & ~F.col("lost"), F.col("restored"))))
    return found.select("core", kept.alias("restored")), restorer


def _cores_of(restorer: Restorer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, c) for i, v in enumerate(batch.column(batch.num_columns - 1).to_pylist()) if v for c in set(cores(v, None)) if restorer.suspect(c)]
            at, found = list(zip(*rows)) or ((), ())
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns[:-1], pa.array(found, pa.string())], [*batch.schema.names[:-1], "core"])

    return run


def garbled(values: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row for each garbled word of a value: keys, core, restored (null if it cannot be).

    Defined cases: null and empty values hold no words; words of any length count; words in
    which characters were lost are garbled, restorable or not; a word with accents of its own
    is none unless a far more frequent reading of it exists; repeated rows each count; an empty
    table gives no rows; other columns are ignored.
    """
    text = values.select(F.col(value).cast("string").alias("_value"))
    words = durable(text.mapInArrow(_counted, "core string, n long").groupBy("core").agg(F.sum("n").alias("n")))
    found, restorer = garbled_words(words)
    kinds = ", ".join(f"{k} {values.schema[k].dataType.simpleString()}" for k in keys)
    held = values.select(*keys, F.col(value).cast("string").alias("_value")).mapInArrow(_cores_of(restorer), f"{kinds}, core string")
    return held.join(found, "core").select(*keys, "core", "restored")


def restored(values: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, value, restored_value of each garbled value: words that cannot be restored stay as they are."""
    found = garbled(values, keys, value)
    per = found.where("restored is not null").groupBy(*keys).agg(F.map_from_entries(F.collect_set(F.struct("core", "restored"))).alias("_words"))
    cases = found.select(*keys).distinct()
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    out = values.alias("v").join(cases.alias("c"), same("v", "c")).select("v.*").alias("v").join(per.alias("p"), same("v", "p"), "left")
    out = out.select(*[F.col(f"v.{k}") for k in keys], F.col(f"v.{value}").alias("value"), F.map_entries("p._words").alias("_words"))
    # The longest words first, so that none is replaced inside another.
    ordered = F.array_sort(F.coalesce("_words", F.array().cast("array<struct<key:string,value:string>>")), lambda a, b: F.length(b["key"]) - F.length(a["key"]))
    return out.select(*keys, "value", F.aggregate(ordered, F.col("value"), lambda t, w: F.replace(t, w["key"], w["value"])).alias("restored_value"))
