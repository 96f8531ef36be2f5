"""Texts that were cut off: a backward character n-gram model of where texts end.

For every context of up to ORDER characters, read backwards from a place in a text, the model
counts how often a text goes on after it and how often it ends there. Shorter contexts stand
behind longer ones. Only contexts in which some text ends are needed: a filter of fixed size of
them goes to the workers, which count every place but pass on only what the filter lets through.
A text counts as cut if its own final context makes an end no likelier
than at any place of its language and column; it is left out of the counts it is judged by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable

ORDER = 6  # characters of the longest context
STRENGTH = 40.0  # places that a shorter context counts for beside a longer one
MARGIN = 0.0  # log-odds above those of any place that a complete text needs
SUFFIX = 256  # ends that agree in so many characters are copies of one text and count once
DISCOUNT = 2  # ends of a context that may be other texts' cuts there
HELD = 6_000_000  # places whose contexts a task holds before it counts them
READ = 1_000_000  # characters that are read at once, or one text
FILTER = 24  # bits of a slot number in the filter of final contexts
SALTS = 16  # parts of one context's texts in the last join

BITS = 10
BETWEEN = chr(0x10FFFF)  # stands between texts
DEVANAGARI_DIGIT = 592 + 0x66  # the sign of all Devanagari digits
#: What is left behind where a text was cut; the characters before it are judged.
TRACE = regex.compile(r"(?:\s|�|…|\.{3,}|\[(?:\s|\.|…)*(?:more|truncated|cut)?\s*\])+$", regex.I)


def _alphabet() -> np.ndarray:
    """Code point to one of 1024 signs: all digits of a script are one sign, rare letters share."""
    code = np.arange(0x110000, dtype=np.int64)
    out = 832 + code % 192
    for first, last, base in ((0, 0x250, 0), (0x900, 0x980, 592), (0x2000, 0x2070, 720)):
        out[first:last] = base + np.arange(last - first)
    out[0x30:0x3A], out[0x966:0x970] = 0x30, DEVANAGARI_DIGIT
    out[out == 0] = 1
    out[ord(BETWEEN)] = 0
    return out


def bare(text: str | None) -> str:
    """The text without white space and traces of a cut at its end."""
    return TRACE.sub("", text[-400:]) if text and len(text) <= 400 else text[:-400] + TRACE.sub("", text[-400:]) if text else ""


class Reader:
    def __init__(self) -> None:
        self.alphabet = _alphabet()

    def contexts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The packed context at every place of all texts, and which of them are last places. A
        number is one place, however many digits it has."""
        pad = BETWEEN * (ORDER - 1)
        texts = [t.replace(BETWEEN, " ") if BETWEEN in t else t for t in texts]
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        whole = pad.join(["", *texts])
        sign = self.alphabet[np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        digit = (sign == 0x30) | (sign == DEVANAGARI_DIGIT)
        kept = ~digit
        kept[:1] = True
        kept[1:] |= ~digit[:-1]
        last = np.zeros(len(sign), dtype=bool)
        last[(np.cumsum(sizes + ORDER - 1) - 1)[sizes > 0]] = True
        ended = np.flatnonzero(last)
        sign, place = sign[kept], np.cumsum(kept) - 1
        last = np.zeros(len(sign), dtype=bool)
        last[place[ended]] = True
        packed = sign.copy()
        for k in range(1, ORDER):
            packed[k:] |= sign[:-k] << (BITS * k)
        inside = sign != 0
        return packed[inside], last[inside]


def _slots(parts: np.ndarray, order: int) -> np.ndarray:
    """The filter's slots of contexts of one length."""
    mixed = (parts.astype(np.uint64) + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - FILTER)).astype(np.int64)


def _mask(order: int) -> int:
    return (1 << BITS * order) - 1


def _filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Final contexts to the filter's words of 64 slots that are not empty."""
    slots = np.zeros(1 << FILTER, dtype=bool)
    for batch in batches:
        context = batch.column(0).to_numpy(zero_copy_only=False)
        for k in range(ORDER + 1):
            slots[_slots(context & _mask(k), k)] = True
    words = np.packbits(slots).view(np.int64)
    at = np.flatnonzero(words)
    for first in range(0, len(at), 100_000):
        some = at[first : first + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(words[some])], ["_word", "_bits"])


def _counts(words: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(lang, text) to (lang, order, context, n): how often a text goes on after each context that the filter lets through."""
        reader = Reader()
        packed_words = np.zeros((1 << FILTER) // 64, dtype=np.int64)
        packed_words[np.fromiter(words, np.int64)] = np.fromiter(words.values(), np.int64)
        wanted = np.unpackbits(packed_words.view(np.uint8)).view(bool)
        held: dict[str | None, list[np.ndarray]] = {}
        size = 0

        def emitted() -> Iterator[pa.RecordBatch]:
            for lang, arrays in held.items():
                codes = np.concatenate(arrays)
                n = np.ones(0)
                for k in range(ORDER, -1, -1):
                    if k == ORDER:
                        codes.sort()
                        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, dtype=np.int64)
                        n = np.diff(np.concatenate([first, [len(codes)]]))
                    else:
                        codes &= _mask(k)
                        turn = np.argsort(codes)
                        codes, n = codes[turn], n[turn]
                        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, dtype=np.int64)
                        n = np.add.reduceat(n, first) if len(first) else n
                    codes = codes[first]
                    kept = wanted[_slots(codes, k)]
                    c, m = codes[kept], n[kept].astype(np.int64)
                    for at in range(0, len(c), 100_000):
                        some = slice(at, at + 100_000)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(c[some]), pa.string()), pa.array(np.full(len(c[some]), k, dtype=np.int32)), pa.array(c[some]), pa.array(m[some])],
                            ["_lang", "_order", "_part", "_n"],
                        )

        for batch in batches:
            by: dict[str | None, list[str]] = {}
            waiting = 0
            for i in range(batch.num_rows + 1):
                if i < batch.num_rows and (text := bare(batch.column(1)[i].as_py())):
                    by.setdefault(batch.column(0)[i].as_py(), []).append(text)
                    waiting += len(text)
                if waiting < READ and i < batch.num_rows:
                    continue
                for lang, texts in by.items():
                    packed, last = reader.contexts(texts)
                    held.setdefault(lang, []).append(packed[~last])
                    size += len(packed)
                by, waiting = {}, 0
                if size >= HELD:
                    yield from emitted()
                    held.clear()
                    size = 0
        yield from emitted()

    return run


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row columns..., text) to the row columns with the final context and the suffix's hash."""
    reader = Reader()
    for batch in batches:
        texts = [bare(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
        keep = [i for i, t in enumerate(texts) if t]
        if not keep:
            continue
        packed, last = reader.contexts([texts[i][-max(SUFFIX, ORDER) :] for i in keep])
        suffix = [int.from_bytes(hashlib.blake2b(texts[i][-SUFFIX:].encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) for i in keep]
        rows = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(packed[last]), pa.array(suffix, pa.int64())], [*batch.schema.names[:-1], "_context", "_suffix"])


def endings(df: DataFrame, key: str, text: str, lang: str, source: str) -> DataFrame:
    """One row for each text that is not blank: key, source, log_odds of an end in its final
    context, log_odds_anywhere in its language and column, and cut.

    Defined cases: null, empty and blank texts give no row; texts of an unknown language are
    judged by all languages together; copies of a text count once as an end; repeated rows
    each count; an empty table gives no rows; other columns are ignored.
    """
    kinds = {c: df.schema[c].dataType.simpleString() for c in (key, lang, source)}
    rows = df.select(F.col(key).alias("_key"), F.col(source).alias("_source"), F.col(lang).cast("string").alias("_lang"), F.col(text).cast("string").alias("_text"))
    tails = rows.select("_key", "_source", "_lang", "_text").mapInArrow(
        _ends, f"_key {kinds[key]}, _source {kinds[source]}, _lang string, _context long, _suffix long"
    )
    tails = durable(tails)
    bits = tails.select("_context").mapInArrow(_filtered, "_word long, _bits long").groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    words = {r._word: r._bits for r in bits.collect()}  # at most 2**FILTER bits
    counted = rows.select("_lang", "_text").mapInArrow(_counts(words), "_lang string, _order int, _part long, _n long")
    on = durable(counted.groupBy("_lang", "_order", "_part").agg(F.sum("_n").alias("_n")))

    orders = F.explode(F.array(*[F.struct(F.lit(k).alias("_order"), F.col("_context").bitwiseAND(_mask(k)).alias("_part")) for k in range(ORDER + 1)])).alias("_o")
    ended = tails.select("_lang", "_context", "_suffix").distinct().select("_lang", orders).groupBy("_lang", "_o._order", "_o._part").agg(F.count("*").alias("_e"))

    # Texts without a language are judged by the counts of all together, under the name "".
    def with_all(counted: DataFrame, by: list[str], n: str) -> DataFrame:
        together = counted.groupBy(*by).agg(F.sum(n).alias(n)).withColumn("_lang", F.lit(""))
        return counted.where("_lang <> ''").select("_lang", *by, n).unionByName(together.select("_lang", *by, n))

    ended, on = with_all(ended, ["_order", "_part"], "_e"), with_all(on, ["_order", "_part"], "_n")
    ends = ended.join(on, ["_lang", "_order", "_part"], "left").select("_lang", "_order", "_part", "_e", F.coalesce("_n", F.lit(0)).alias("_n"))
    judged = tails.select(F.coalesce("_lang", F.lit("")).alias("_lang"), "_context").distinct()
    steps = judged.select("_lang", "_context", orders).select("_lang", "_context", "_o._order", "_o._part").join(ends, ["_lang", "_order", "_part"])
    steps = steps.groupBy("_lang", "_context").agg(F.sort_array(F.collect_list(F.struct("_order", "_e", "_n"))).alias("_steps"))
    base = F.col("_steps")[0]["_e"] / (F.col("_steps")[0]["_e"] + F.col("_steps")[0]["_n"])
    chance = F.aggregate(F.slice("_steps", 2, ORDER), base, lambda p, s: (F.greatest(s["_e"] - 1 - DISCOUNT, F.lit(0)) + STRENGTH * p) / (s["_e"] - 1 + s["_n"] + STRENGTH))
    odds = lambda p: F.log(F.greatest(p, F.lit(1e-12)) / F.greatest(1 - p, F.lit(1e-12)))
    scores = steps.select("_lang", "_context", odds(chance).alias("log_odds"), odds(base).alias("log_odds_anywhere"))

    salted = scores.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = tails.select("_key", "_source", F.coalesce("_lang", F.lit("")).alias("_lang"), "_context", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int").alias("_salt")).join(salted, ["_lang", "_context", "_salt"])
    return out.select(
        F.col("_key").alias(key), F.col("_source").alias(source), "log_odds", "log_odds_anywhere", (F.col("log_odds") < F.col("log_odds_anywhere") + MARGIN).alias("cut")
    )


def shares(judged: DataFrame, source: str) -> DataFrame:
    """How often each source cuts: source, texts, cut_texts, share; a null source is one of its own."""
    counted = judged.groupBy(source).agg(F.count("*").alias("texts"), F.sum(F.col("cut").cast("long")).alias("cut_texts"))
    return counted.withColumn("share", F.col("cut_texts") / F.col("texts"))
