"""Documents that hold passages of held-out items: an FM-index of each shard's words.

A shard is a slice of an Arrow batch, its texts one sequence of word numbers. Its index is the
Burrows-Wheeler transform in a wavelet matrix, which ranks any word before any row, and the
positions of every SAMPLE-th suffix, from which the others are located by walking backwards.
All runs of SEED words of all passages are searched backwards at once; hits on one diagonal,
bridged over single changed words, are stretches, and stretches in the passage's order are
counted in words. The spans of a document's stretches are merged over all items for removal.
Only the passages, a table of fixed size, go to every worker.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 3  # words of a seed
STRETCH = 5  # words of the shortest stretch that counts
ENOUGH = 15  # words of a case
STOCK_RUN, STOCK_ITEMS = 5, 5  # a run of so many words in so many items is a stock sentence's
SHARD, CHARACTERS = 4000, 8_000_000  # documents and characters of a shard, or one document
SAMPLE = 4  # of so many suffixes one keeps its position

_DROP = regex.compile(r"\p{Cf}|[̀-ͯ]|(?<=\p{L}\p{M}*)[-‐‑](?>\s*\n\s*)?(?=\p{L})")
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")


def words(text: str) -> list[str]:
    """Words without case, Latin marks, punctuation, invisible characters and line division."""
    return _WORD.findall(_DROP.sub("", unicodedata.normalize("NFKD", text)).casefold())


class Passages:
    """The seeds of all passages: distinct word runs and where each stands."""

    def __init__(self, items: Sequence[tuple[int, str]]) -> None:
        self.ids = [i for i, _ in items]
        texts = [words(p) for _, p in items]
        self.number = {w: n for n, w in enumerate(dict.fromkeys(w for t in texts for w in t), 1)}
        runs = Counter(r for t in texts for r in {tuple(t[k : k + STOCK_RUN]) for k in range(len(t) - STOCK_RUN + 1)})
        where: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for item, t in enumerate(texts):
            stock = [False] * len(t)
            for k in range(len(t) - STOCK_RUN + 1):
                if runs[tuple(t[k : k + STOCK_RUN])] >= STOCK_ITEMS:
                    stock[k : k + STOCK_RUN] = [True] * STOCK_RUN
            for k in range(len(t) - SEED + 1):
                if not any(stock[k : k + SEED]):
                    where.setdefault(tuple(self.number[w] for w in t[k : k + SEED]), []).append((item, k))
        self.seeds = np.array(list(where), dtype=np.int64).reshape(-1, SEED)
        self.counts = np.array([len(x) for x in where.values()], dtype=np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.places = np.array([p for x in where.values() for p in x], dtype=np.int64).reshape(-1, 2)


def suffixes(sequence: np.ndarray, size: int) -> np.ndarray:
    """The suffix array of numbers from 1 to `size` with one 0 at the end: suffixes are sorted by
    their first numbers, and those that agree again by twice as many, until none do."""
    n = len(sequence)
    width = max(1, min(4, int(62 / np.log2(size + 2))))
    key = np.zeros(n, dtype=np.int64)
    for k in range(width):
        key *= size + 1
        key[: n - k] += sequence[k:]
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    tied = np.flatnonzero(~(fresh & np.concatenate([fresh[1:], [True]])))  # places in `order`
    while len(tied):
        who = order[tied]
        first, then = rank[who], rank[who + width]  # those that agree don't reach the end
        turn = np.lexsort((then, first))
        order[tied] = who = who[turn]
        first, then = first[turn], then[turn]
        fresh = np.concatenate([[True], (first[1:] != first[:-1]) | (then[1:] != then[:-1])])
        rank[who] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(who)), 0))]
        tied = tied[~(fresh & np.concatenate([fresh[1:], [True]]))]
        width *= 2
    return order


class Wavelet:
    """Ranks of any number in a sequence: a wavelet matrix, one row of counts for each bit."""

    def __init__(self, sequence: np.ndarray, size: int) -> None:
        self.bits = max(1, int(size).bit_length())
        self.ones: list[np.ndarray] = []  # of each bit: how many ones stand before each place
        self.zeros: list[int] = []
        for level in range(self.bits - 1, -1, -1):
            bit = (sequence >> level) & 1
            ones = np.zeros(len(sequence) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(sequence) - int(ones[-1]))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])

    def place(self, number: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Where `row` comes to lie once the sequence is sorted by reading `number`'s bits."""
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            before = ones[row]
            row = np.where((number >> (self.bits - 1 - k)) & 1, zeros + before, row - before)
        return row

    def rank(self, number: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How many of `number` stand before `row`."""
        return self.place(number, row) - self.place(number, np.zeros_like(row))

    def at(self, row: np.ndarray) -> np.ndarray:
        """The number at `row`."""
        number = np.zeros_like(row)
        for ones, zeros in zip(self.ones, self.zeros):
            before = ones[row]
            bit = ones[row + 1] - before
            number = number * 2 + bit
            row = np.where(bit == 1, zeros + before, row - before)
        return number


class Index:
    """FM-index of word numbers from 0 on; 0 is a word of no passage or the end of a text."""

    def __init__(self, sequence: np.ndarray, size: int) -> None:
        sequence = np.concatenate([sequence + 1, [0]])
        self.n = len(sequence)
        order = suffixes(sequence, size + 1)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=size + 2))])
        self.wavelet = Wavelet(sequence[order - 1], size + 1)
        marked = order % SAMPLE == 0
        self.marked = np.concatenate([[0], np.cumsum(marked)])
        self.sampled = order[marked]

    def _step(self, word: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.first[word] + self.wavelet.rank(word, row)

    def find(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, place) of every occurrence of every pattern."""
        low, high = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), self.n)
        for k in range(patterns.shape[1] - 1, -1, -1):
            low, high = self._step(patterns[:, k] + 1, low), self._step(patterns[:, k] + 1, high)
        count = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(patterns)), count)
        return which, self.locate(np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + low[which])

    def locate(self, row: np.ndarray) -> np.ndarray:
        """The positions of rows: each walks back to a sampled one and adds its steps."""
        out = np.zeros(len(row), dtype=np.int64)
        left, steps = np.arange(len(row)), 0
        row = row.copy()
        while len(left):
            known = self.marked[row + 1] > self.marked[row]
            out[left[known]] = self.sampled[self.marked[row[known]]] + steps
            left, row = left[~known], row[~known]
            if len(left):
                row = self._step(self.wavelet.at(row), row)
                steps += 1
        return out


def held(hits: list[tuple[int, int]]) -> tuple[int, list[tuple[int, int]]]:
    """Words of a passage that a text holds in order, and the first and last place in the text of
    the stretches that hold them; hits are sorted (place in text, in passage)."""
    stretches: list[list[int]] = []  # first and last place in the text, first and last in the passage
    live: list[list[int]] = []
    for d, p in hits:
        live = [s for s in live if d - s[1] <= SEED + 2]
        near = [s for s in live if 1 <= d - s[1] and 1 <= p - s[3] <= SEED + 2 and abs(d - s[1] - p + s[3]) <= 1 and min(d - s[1], p - s[3]) <= SEED + 1]
        if near:
            s = min(near, key=lambda s: (abs(d - s[1] - p + s[3]), d - s[1]))
            s[1], s[3] = d, p
        else:
            live.append(s := [d, d, p, p])
            stretches.append(s)
    kept = [s for s in stretches if s[3] + SEED - s[2] >= STRETCH]
    best: list[tuple[int, int]] = []  # words up to and with each stretch, and the stretch before it
    for k, s in enumerate(kept):
        ahead = max(((best[j][0], j) for j, r in enumerate(kept[:k]) if r[1] + SEED <= s[0] and r[3] + SEED <= s[2]), default=(0, -1))
        best.append((s[3] + SEED - s[2] + ahead[0], ahead[1]))
    most, at = max(((b[0], k) for k, b in enumerate(best)), default=(0, -1))
    spans = []
    while at >= 0:
        spans.append((kept[at][0], kept[at][1] + SEED - 1))
        at = best[at][1]
    return most, spans[::-1]


def leaked(texts: Sequence[str | None], passages: Passages) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """(row of texts, item, first and last word of each stretch) of every case."""
    number, numbers, begins = passages.number, [0], []
    for t in texts:
        begins.append(len(numbers))
        numbers += [number.get(w, 0) for w in words(t or "")]
        numbers += [0]
    which, place = Index(np.array(numbers, dtype=np.int64), len(number)).find(passages.seeds)
    count = passages.counts[which]
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(passages.starts[which], count)
    place = np.repeat(place, count)
    item, spot = passages.places[at].T
    row = np.searchsorted(np.array(begins), place, side="right") - 1
    pair = row * len(passages.ids) + item
    order = np.lexsort((spot, place, pair))
    pair, place, spot = pair[order], place[order], spot[order]
    found = []
    names, start, many = np.unique(pair, return_index=True, return_counts=True)
    for name, a, n in zip(names[many >= 3], start[many >= 3], many[many >= 3]):
        count, spans = held(list(zip(place[a : a + n].tolist(), spot[a : a + n].tolist())))
        if count >= ENOUGH:
            text = int(name) // len(passages.ids)
            found.append((text, passages.ids[int(name) % len(passages.ids)], [(x - begins[text], y - begins[text]) for x, y in spans]))
    return found


def merged(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of whole numbers that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def shards(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most SHARD texts and CHARACTERS characters, one text at least."""
    upto = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        fits = int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + CHARACTERS, side="right"))
        end = max(begin + 1, min(begin + SHARD, fits))
        yield batch.slice(begin, end - begin)
        begin = end


def _searched(documents: DataFrame, items: DataFrame, key: str, text: str, item: str, passage: str, spans: bool) -> DataFrame:
    passages = Passages([tuple(r) for r in items.select(item, passage).where(F.col(passage).isNotNull()).collect()])
    kind, other = documents.schema[key].dataType.simpleString(), items.schema[item].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in shards(whole):
                found = leaked(batch.column(1).to_pylist(), passages) if len(passages.seeds) else []
                if not found:
                    continue
                if spans:
                    by: dict[int, list[tuple[int, int]]] = {}
                    for row, _, held_at in found:
                        by.setdefault(row, []).extend(held_at)
                    rows, first, last = zip(*[(row, a, b) for row, x in by.items() for a, b in merged(x)])
                    columns, names = [pa.array(first, pa.int64()), pa.array(last, pa.int64())], [key, "first_word", "last_word"]
                else:
                    rows, ids, _ = zip(*found)
                    columns, names = [pa.array(ids, pa.int64())], [key, item]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns], names)

    columns = "first_word long, last_word long" if spans else f"{item} {other}"
    return documents.select(key, F.col(text).cast("string")).mapInArrow(run, f"{key} {kind}, {columns}")


def leaks(documents: DataFrame, items: DataFrame, key: str, text: str, item: str, passage: str) -> DataFrame:
    """One row for each document and each item of whose passage it holds ENOUGH words: key, item.

    Defined cases: null texts and passages hold nothing; stock sentences do not count;
    repeated texts each count; without items there are no rows; other columns are ignored.
    """
    return _searched(documents, items, key, text, item, passage, False)


def removals(documents: DataFrame, items: DataFrame, key: str, text: str, item: str, passage: str) -> DataFrame:
    """What to take out of the same documents: key, first_word and last_word of each span, counted
    from 0 in `words` of the text; the stretches of all items are merged. Cases as in `leaks`."""
    return _searched(documents, items, key, text, item, passage, True)
