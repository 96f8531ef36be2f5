"""Noise of scanned pages in text: found and repaired into continuous text.

Page furniture (running heads, page numbers, leader dots), line ends inside sentences, spaced
and divided words show in a value itself. Misread characters show in the corpus: the anagram
hash of a word is a sum over its characters, so the difference of two hashes is the difference
of the characters the words do not share. Rare words are joined with frequent ones on hashes
from which a short sequence was taken; what many such pairs agree on is a confusion, and the
ranked confusions correct rare words into frequent ones. Divided words are joined on the
evidence that the undivided word is in use.

Words are counted over all values. Workers get only the confusions and the FREQUENT most
frequent words, which need no look-up; every other word is looked up by a join.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

RATIO = 20  # times a word is more frequent than its misreadings
EVIDENCE = 3  # different words that must show a confusion
SHARE = 0.03  # of the frequent words that a sequence stands in, the part that must be seen misread
GAP = 2  # characters of the longer side of a confusion
USED = 2  # times an undivided word must be in use for its parts to be joined
FREQUENT = 20_000  # words sent to the workers
MOST = 20_000  # confusions; an error beyond
LONGEST = 64  # characters of a word; longer strings are none and have no corrections
COUNTED = 500_000  # distinct words that a task holds before it emits their counts

# Possessive throughout, and each pattern starts at the start of a run: time is linear in the text.
_CAPITALS = r"(?:[^\s\p{Ll}\p{Lu}]*+\p{Lu}){4}[^\s\p{Ll}]*+"
#: A bracketed part and a line in capitals, with a star or a page number on either side.
_HEAD = regex.compile(
    rf"(?<!\S)(?:\[\s?\p{{Lu}}\p{{Ll}}+\s[IVXLCDM]+\s?\]\s+)?(?:\d{{1,4}}\s+)?(?:\*\s+)?(?<caps>{_CAPITALS}(?:\s+{_CAPITALS})*)(?:\s+\*)?(?:\s+\d{{1,4}})?(?!\S)"
)
#: The same in letters of a wrong encoding: few of the signs around them are enough.
_MOJIBAKE_HEAD = regex.compile(r"(?<!\S)(?:\[\s?\p{Lu}\p{Ll}+\s[IVXLCDM]+\s?\](?:\s+(?:[^\sa-zA-Z]*+[A-Z]){2}\S*+)?(?:\s+\d{1,4}(?!\S))?|\d{1,4}\s+(?:\*\s+)?[A-Z]{4,}\S*)|(?<!\S)\*\s+\S{4,}\s+\*(?:\s+\d{1,4}(?!\S))?|(?<!\S)[A-Z]{5,}+\S*+(?:\s+\*)?\s+\d{1,4}(?!\S)")
#: A line of a page number, in which a scan may read letters for digits.
_NUMBER_LINE = regex.compile(r"^[\s\-–—\[\]()*]*(?:pp?\.\s*)?(?=[lIO]*\d)[\dlIO]{1,4}[\s\-–—\[\]()*]*$")
_BRACKETED = regex.compile(r"^\(\d{1,4}(?:\P{L}{1,9}?\d{1,4})?\)$")
_NUMBER_INSIDE = regex.compile(r"(?<=\s)(?:\[ \d{1,4} \]|([-–—]) \d{1,4} \1)(?=\s)|(?<=[^.!?)”\s]\s)\(\d{1,4}\)(?=\s+\S)")
_LEADERS = regex.compile(r"(?<![\s.·…])\s*+(?:(?:(?:[.·]\s?){2,}+|…++\s*+)\d{1,4}\s*+$|(?:\.{4,}+|(?:[.·] ){3,}+[.·]?|…{2,}+))")
_LAST_NUMBER = regex.compile(r"(?<=\p{L}\S*\s+)\d{1,4}\s*$")
_SENTENCE_END = regex.compile(r"[.!?)।|][^A-Za-z0-9\s]*$|[.!?][^A-Za-z0-9\s]*[”’\"][^A-Za-z0-9\s]*$")
_DIVIDED = regex.compile(r"(?<!\S)(?<lead>[“‘\"'(\[]*)(?<a>[\p{L}\p{M}@\d'’\-]*[\p{L}\p{M}@\d])(?<h>[-‐\xAD¬])(?<s> *\uE000|\s+)(?<b>[\p{L}\p{M}@\d(][\p{L}\p{M}@\d(]*(?:-[\p{L}\p{M}]+)*)")
_SPACED = regex.compile(r"(?<![\p{L}\p{M}\d'’\-])(?:[\p{L}\d@(]\p{M}* ){2,}[\p{L}\d@(]\p{M}*(?![\p{L}\p{M}\d])")
_SIGNS = r"[^\s“”‘’\".,;:!?—–\[\])*…·(]++"
_WORD = re.compile(rf"(?<!\()\(*+{_SIGNS}(?:\(++{_SIGNS})*+")
_LETTER = re.compile(r"[A-Za-z]")
#: What must be in a value for the patterns above to be worth a try.
_MAYBE_HEAD = re.compile(r"[A-Z][^a-z\s,.;:!?”)]{2}|[^\x00-\x7F][A-Z]{2}|\*")
_MAYBE_NUMBER = re.compile(r"\s[\[(\-–—]\s?\d")
_MAYBE_LEADERS = re.compile(r"\.\s?\.|[·…]")
_MAYBE_SPACED = re.compile(r"(?:^|\s)\S(?:[\u0300-\u036F])* \S(?:[\u0300-\u036F])* \S")
_MAYBE_DIVIDED = re.compile(r"[-‐\xAD¬](?:\s|\uE000)")


class Reading:
    """A value without page furniture: `noise` tells whether any trace was found, and `text` is
    continuous but for words that a hyphen may divide."""

    def __init__(self, value: str, sentences: bool) -> None:
        self.noise = False
        head = _MAYBE_HEAD.search(value) is not None
        lines = value.split("\n")
        kept = []
        for k, line in enumerate(lines if len(lines) > 1 else ()):
            bare = line.strip()
            closing = k == len(lines) - 1 and sentences and _BRACKETED.match(bare)
            if bare and (_NUMBER_LINE.match(bare) and not closing or head and any(m.span() == (0, len(bare)) for m in (_HEAD.match(bare), _MOJIBAKE_HEAD.match(bare)) if m)):
                self.noise = True
                continue
            kept.append(line)
        # A line end after a sentence belongs to the text, any other is the page's.
        kept = kept if len(lines) > 1 else lines
        text = kept[0] if kept else ""
        for before, line in zip(kept, kept[1:]):
            if not sentences or before.strip() and not _SENTENCE_END.search(before.rstrip()[-LONGEST:]):
                self.noise = True
                text = text.rstrip(" ") + ("\uE000" if text.rstrip(" ")[-1:] in "-‐\xad¬" else " ") + line.lstrip(" ")
            else:
                text += "\n" + line
        if head:
            text = self._without(_HEAD, text, lambda m: " ", lambda m: m["caps"] != m[0] or len(regex.findall(r"\p{Lu}", m["caps"])) > 5)
            text = self._without(_MOJIBAKE_HEAD, text, lambda m: " ")
        if _MAYBE_NUMBER.search(text):
            text = self._without(_NUMBER_INSIDE, text, lambda m: " ")
        if _MAYBE_LEADERS.search(text):
            text = self._without(_LEADERS, text, lambda m: "")
        if not sentences:
            text = self._without(_LAST_NUMBER, text, lambda m: "")
        text = re.sub(r"  +", " ", text).strip(" ") if self.noise else text
        if _MAYBE_SPACED.search(text):
            text = self._without(_SPACED, text, lambda m: m[0].replace(" ", ""), lambda m: not m[0].isdecimal() and bool(_LETTER.search(m[0])))
        self.text = text

    def _without(self, pattern, text: str, by, where=lambda m: True) -> str:
        def one(m):
            if not where(m):
                return m[0]
            self.noise = True
            return by(m)

        return pattern.sub(one, text)

    def joined(self, decide) -> str:
        """The text with each divided word as `decide(joined, hyphenated, how)` tells, which gives
        the word, or None to leave it as it is. `how` is "soft" for a hyphen that only divides,
        "line" for a hyphen at a line end, "plain" for one before a space, which may belong there."""

        def one(m):
            how = "soft" if m["h"] != "-" else "line" if "\uE000" in m["s"] else "plain"
            word = decide(m["a"] + m["b"], m["a"] + "-" + m["b"], how)
            return m[0] if word is None else m["lead"] + word

        if not _MAYBE_DIVIDED.search(self.text):
            return self.text.replace("\uE000", " ")
        return _DIVIDED.sub(one, self.text).replace("\uE000", " ")


def words(reading: Reading) -> tuple[list[str], set[tuple[str, int]]]:
    """The words of a value, and those that are in it only if a hyphen divides a word: with 2 the
    undivided word, with 3 the word that keeps the hyphen of a line end."""
    maybe: set[tuple[str, int]] = set()

    def decide(joined: str, hyphenated: str, how: str) -> str | None:
        if how == "soft":
            reading.noise = True
            return joined
        maybe.add((joined, 2))
        if how == "line":
            maybe.add((hyphenated, 3))
            return " "
        return None

    return _WORD.findall(reading.joined(decide)), maybe


def anagram(word: str) -> int:
    """The sum of the fifth powers of the characters, within a long."""
    return sum(pow(ord(c), 5, 1 << 61) for c in word) % (1 << 61)


def _readings(batch: pa.RecordBatch, prose: frozenset[str]) -> Iterator[tuple[int, str, Reading]]:
    for i, (field, value) in enumerate(zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())):
        if value:
            yield i, value, Reading(value, field in prose)


def _counted(prose: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def emitted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for _, _, reading in _readings(batch, prose):
                found, maybe = words(reading)
                counts.update(found)
                for w, _ in maybe:
                    counts.setdefault(w, 0)
            if len(counts) >= COUNTED:
                yield emitted()
                counts.clear()
        if counts:
            yield emitted()

    return run


def _gapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, n to (word, n, hash without a sequence, the rest of the word, the sequence)."""
    for batch in batches:
        rows = []
        for word, n in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
            whole = anagram(word)
            for size in range(1, GAP + 1):
                for i in range(len(word) - size + 1):
                    part = word[i : i + size]
                    if part.isascii() and len(word) > size:
                        rows.append((word, n, (whole - anagram(part)) % (1 << 61), word[:i] + "\t" + word[i + size :], part))
        columns = list(zip(*rows)) or [()] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], ["word", "n", "hash", "rest", "part"])


def confusions(counted: DataFrame) -> dict[str, list[tuple[str, int]]]:
    """Sequences with what they are misread from and how many different words show it."""
    gapped = counted.where(f"length(word) between 3 and {LONGEST}").mapInArrow(_gapped, "word string, n long, hash long, rest string, part string")
    often = gapped.where(F.col("n") >= RATIO).where(F.col("part").rlike("^[A-Za-z]+$"))
    pairs = gapped.alias("r").join(often.alias("f"), ["hash", "rest"]).where(F.col("f.n") >= RATIO * F.greatest(F.col("r.n"), F.lit(1)))
    # The shortest sequences only: what both sides begin or end with is no part of the confusion.
    pairs = pairs.select(F.col("r.word").alias("rare"), F.col("r.part").alias("a"), F.col("f.part").alias("b")).where(
        "left(a, 1) <> left(b, 1) and right(a, 1) <> right(b, 1) and lower(a) <> lower(b) and not a rlike '[-\\']'"
    )
    within = often.groupBy(F.col("part").alias("b")).agg(F.countDistinct("word").alias("within"))
    seen = pairs.groupBy("a", "b").agg(F.countDistinct("rare").alias("evidence"))
    kept = seen.join(within, "b").where((F.col("evidence") >= EVIDENCE) & (F.col("evidence") >= SHARE * F.col("within")))
    rows = kept.select("a", "b", "evidence").limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise RuntimeError(f"more than {MOST} confusions: the values are not words")
    out: dict[str, list[tuple[str, int]]] = {}
    for r in sorted(rows):
        out.setdefault(r.a, []).append((r.b, r.evidence))
    return out


def variants(word: str, known: Mapping[str, Sequence[tuple[str, int]]]) -> dict[str, tuple[int, int]]:
    """Corrections of one or two places of a word, each with its places and least evidence."""
    places = [(i, len(a), b, e) for size in range(1, GAP + 1) for i in range(len(word) - size + 1) for a in (word[i : i + size],) for b, e in known.get(a, ())]
    out: dict[str, tuple[int, int]] = {}

    def keep(text: str, rank: tuple[int, int]) -> None:
        if text not in out or rank < out[text]:
            out[text] = rank

    for k, (i, m, b, e) in enumerate(places):
        keep(word[:i] + b + word[i + m :], (1, -e))
        for j, n, c, d in places:
            if j >= i + m:
                keep(word[:i] + b + word[i + m : j] + c + word[j + n :], (2, -min(d, e)))
    out.pop(word, None)
    return out


def _corrected(known: Mapping[str, Sequence[tuple[str, int]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(w, n, v, anagram(v), *rank) for w, n in zip(*(batch.column(i).to_pylist() for i in (0, 1))) if len(w) > 1 for v, rank in variants(w, known).items()]
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], ["word", "n", "variant", "hash", "places", "rank"])

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([anagram(w) for w in batch.column(0).to_pylist()], pa.int64())], [*batch.schema.names, "hash"])


def corrections(counted: DataFrame) -> DataFrame:
    """word, n, correction: each counted word with the best frequent word it is misread from, or null."""
    known = confusions(counted)
    tried = counted.where(f"length(word) <= {LONGEST}").mapInArrow(_corrected(known), "word string, n long, variant string, hash long, places int, rank long")
    often = counted.where(F.col("n") >= RATIO).mapInArrow(_hashed, "word string, n long, hash long")
    found = tried.alias("t").join(often.alias("f"), (F.col("t.hash") == F.col("f.hash")) & (F.col("t.variant") == F.col("f.word")))
    found = found.where(F.col("f.n") >= RATIO * F.greatest(F.col("t.n"), F.lit(1))).select("t.*", F.col("f.n").alias("often"))
    # A word that is misread itself corrects no other.
    found = durable(found)
    found = found.alias("t").join(found.select(F.col("word").alias("variant")).distinct(), "variant", "left_anti")
    best = F.min_by("t.variant", F.struct("t.places", "t.rank", -F.col("often"), "t.variant"))
    return counted.join(found.groupBy("t.word").agg(best.alias("correction")), "word", "left")


def _items(usual: frozenset[str], prose: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, item, kind = [], [], []
            for i, _, reading in _readings(batch, prose):
                found, maybe = words(reading)
                mine = {(w, 1) for w in found if w not in usual} | maybe
                if reading.noise:
                    mine.add((None, 0))
                for w, k in mine:
                    at.append(i), item.append(w), kind.append(k)
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns[:-1], pa.array(item, pa.string()), pa.array(kind, pa.int8())], [*batch.schema.names[:-1], "word", "kind"])

    return run


def traces(values: DataFrame, keys: Sequence[str], field: str, value: str, prose: Sequence[str]) -> DataFrame:
    """One row for each trace of the page in a value: keys, field, kind (0 page furniture, line
    ends, spaced and divided words; 1 misread word; 2 word in use that a hyphen divides; 3 word
    in use with the hyphen of a line end), word and its correction.

    `prose` names the fields whose values are sentences: only there may a line end belong to
    the text and a number in brackets close it. Defined cases: null and empty values have no
    traces; repeated rows each count; an empty table gives no rows; other columns are ignored.
    """
    named = frozenset(prose)
    held = values.select(*keys, field, F.col(value).cast("string").alias("_value"))
    counted = durable(held.select(field, "_value").mapInArrow(_counted(named), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    corrected = durable(corrections(counted))
    top = corrected.where("correction is null and n > 0").orderBy(F.desc("n"), "word").limit(FREQUENT).select("word").collect()
    kinds = ", ".join(f"{k} {values.schema[k].dataType.simpleString()}" for k in [*keys, field])
    items = held.mapInArrow(_items(frozenset(r.word for r in top), named), f"{kinds}, word string, kind tinyint")
    looked = items.where("kind > 0").join(corrected, "word").where(
        F.col("correction").isNotNull() & (F.col("kind") < 3) | (F.col("kind") >= 2) & (F.col("n") >= USED)
    )
    columns = [*keys, field, "kind", "word"]
    plain = items.where("kind = 0").select(*columns, F.lit(None).cast("string").alias("correction"))
    return plain.unionByName(looked.select(*columns, F.coalesce("correction", "word").alias("correction")))


def repair(value: str, sentences: bool, fixes: Mapping[str, str], joins: Mapping[str, str], kept: Mapping[str, str]) -> str:
    """The value as continuous text, with the corrections of its words."""

    def decide(joined: str, hyphenated: str, how: str) -> str | None:
        if how == "plain" or joined in joins:
            return joins.get(joined)
        return hyphenated if how == "line" and hyphenated in kept else joined

    return _WORD.sub(lambda m: fixes.get(m[0], m[0]), Reading(value, sentences).joined(decide))


def repaired(values: DataFrame, keys: Sequence[str], field: str, value: str, prose: Sequence[str]) -> DataFrame:
    """keys, field, value, repaired_value of each value with traces of the page."""
    by = [*keys, field]
    found = traces(values, keys, field, value, prose)
    pick = lambda k: F.map_from_entries(F.collect_set(F.when(F.col("kind") == k, F.struct("word", "correction"))))
    per = found.groupBy(*by).agg(pick(1).alias("_fixes"), pick(2).alias("_joins"), pick(3).alias("_kept"))
    condition = None
    for k in by:
        one = F.col(f"v.{k}").eqNullSafe(F.col(f"p.{k}"))
        condition = one if condition is None else condition & one
    rows = values.alias("v").join(per.alias("p"), condition).select(*[F.col(f"v.{k}") for k in by], F.col(f"v.{value}").cast("string").alias("value"), "_fixes", "_joins", "_kept")
    kinds = ", ".join(f"{k} {values.schema[k].dataType.simpleString()}" for k in by)
    named = frozenset(prose)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields, texts, *maps = (batch.column(i).to_pylist() for i in range(len(by) - 1, len(by) + 4))
            out = [repair(t, f in named, *map(dict, m)) for f, t, *m in zip(fields, texts, *maps)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(by) + 1], pa.array(out, pa.string())], [*by, "value", "repaired_value"])

    return rows.mapInArrow(run, f"{kinds}, value string, repaired_value string")
