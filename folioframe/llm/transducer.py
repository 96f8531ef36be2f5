"""Token ids of whole texts: a streaming transducer with bounded lookahead.

The ids of a byte-level merge list depend on what follows only up to a bound, which `lookahead`
computes from the list itself: a token's right end moves only if a merge of higher rank takes
its last part away, whose right operand again depends on merges of still higher rank. So ids
are emitted once as many bytes follow them, and what is held does not grow with the text, not
even within one unbroken run of letters. Short pieces, which the splitting pattern ends, are
remembered with their ids.
"""

from __future__ import annotations

import codecs
import json
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# White space as Unicode has it; Python's \s also holds the separators U+001C to U+001F.
PATTERN = public_tokenizers.PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")
#: The characters that a piece without an end so far goes on with, by its last one.
RUNS = [regex.compile(x) for x in (r"\p{L}+", r"\p{N}+", r"[^\p{White_Space}\p{L}\p{N}]+", r"\p{White_Space}+")]
AHEAD = 3  # characters after a piece that decide its end
REMEMBERED = 200_000  # pieces a worker keeps; then it starts anew
LONG = 256  # characters from which a piece is no longer remembered but streamed
CHUNK = 1 << 16  # characters of a text that are read at once
ROWS = 1000  # texts whose ids are held at once


def _bytes_of_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand for
    themselves, the others for the letters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Merges:
    """A byte-level merge list: the ids of single bytes and what each pair of ids becomes."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters, vocabulary = _bytes_of_letters(), model["vocab"]
        self.bytes = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items() if all(c in letters for c in t)}
        self.single = [vocabulary[c] for c in sorted(letters, key=letters.get)]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs[vocabulary[a], vocabulary[b]] = (rank, vocabulary[a + b])

    def encode(self, piece: bytes) -> list[int]:
        """The ids of a piece: the pair of the first rank is merged everywhere, until none is left."""
        ids, pairs = [self.single[b] for b in piece], self.pairs
        while len(ids) > 1:
            best = min(((pairs[p], p) for p in set(zip(ids, ids[1:])) if p in pairs), default=None)
            if best is None:
                break
            (_, new), (left, right) = best
            out, i, last = [], 0, len(ids) - 1
            while i <= last:
                if i < last and ids[i] == left and ids[i + 1] == right:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def lookahead(self) -> int:
        """Bytes after a token's end that are enough to know that it stays an end.

        A token is made by one rule and used up by another of a later rank. Until then only a
        rule of its own as left operand can move its right end, which needs the whole right
        operand, made before that rank and safe in its turn from rules before that rank. Rules
        are taken by rank, so what a rule needs is known when a later one asks for it.
        """
        made: dict[int, tuple[int, int]] = {}  # token: rank and right part of the rule that makes it
        for (_, right), (rank, new) in self.pairs.items():
            made.setdefault(new, (rank, right))
        ranks: dict[int, list[int]] = {}  # by left operand: ranks of its rules, and the most they need
        most: dict[int, list[int]] = {}

        def needs(token: int, before: int) -> int:
            need = 0
            while True:
                if known := ranks.get(token):
                    at = bisect_left(known, before)
                    if at:
                        need = max(need, most[token][at - 1])
                if token not in made:
                    return need
                rank, right = made[token]
                before, token = min(before, rank), right

        for (left, right), (rank, _) in sorted(self.pairs.items(), key=lambda x: x[1]):
            need = len(self.bytes[right]) + needs(right, rank)
            ranks.setdefault(left, []).append(rank)
            before = most.setdefault(left, [])
            before.append(max(need, before[-1] if before else 0))
        end = len(self.pairs)
        return max((needs(token, end) for token in self.bytes), default=0)


@cache
def merges(vocabulary: str) -> Merges:
    """The merge list of a public vocabulary, read once by each process."""
    return Merges(public_tokenizers.path(vocabulary))


class Transducer:
    """Takes a text in parts and gives the ids that no further part can change."""

    def __init__(self, vocabulary: str = "byte_bpe_50k.json", ahead: int | None = None) -> None:
        self.merges = merges(vocabulary)
        self.ahead = self.merges.lookahead() if ahead is None else ahead
        self._pattern = regex.compile(PATTERN)
        self._ids: dict[str, array] = {}
        self.reset()

    def reset(self) -> None:
        self._text = ""  # characters whose piece has no end yet
        self._bytes = b""  # of a long piece: bytes whose ids aren't certain yet
        self._run: regex.Pattern | None = None  # what the long piece goes on with

    def _piece(self, piece: str, out: array) -> None:
        known = self._ids.get(piece)
        if known is None:
            if len(piece) > LONG:
                self._bytes = piece.encode("utf-8", "surrogatepass")
                self._stable(out, True)
                return
            if len(self._ids) >= REMEMBERED:
                self._ids.clear()
            known = self._ids[piece] = array("i", self.merges.encode(piece.encode("utf-8", "surrogatepass")))
        out.extend(known)

    def _stable(self, out: array, ended: bool) -> None:
        """Emit the ids of the long piece that are certain: all if it has ended, else those with
        `ahead` bytes behind them. What follows an emitted id is encoded as if it began there."""
        window = 4 * self.ahead + LONG
        while len(self._bytes) > window or ended and self._bytes:
            part = self._bytes[:window]
            whole = ended and len(part) == len(self._bytes)
            done = 0
            for i in self.merges.encode(part):
                size = len(self.merges.bytes[i])
                if not whole and done + size + self.ahead > len(part):
                    break
                out.append(i)
                done += size
            self._bytes = self._bytes[done:]

    def feed(self, part: str, out: array) -> None:
        """Append to `out` the ids that are certain after one more part of the text."""
        if self._run is not None:
            taken = self._run.match(part)
            size = taken.end() if taken else 0
            going, self._text, part = self._text + part[:size], "", part[size:]
            # The last white space of a run belongs to what follows it.
            keep = 1 if self._run is RUNS[3] else 0
            if part and keep and len(going) > 1 and not RUNS[3].match(part):
                part = going[-1:] + part
                going = going[:-1]
                keep = 0
            elif part:
                keep = 0
            self._bytes += going[: len(going) - keep].encode("utf-8", "surrogatepass")
            self._text = going[len(going) - keep :] if keep else ""
            self._stable(out, bool(part))
            if not part:
                return
            self._run = None
        text = self._text + part
        at = 0
        for piece in self._pattern.finditer(text):
            if piece.end() > len(text) - AHEAD:
                break
            self._piece(piece[0], out)
            at = piece.end()
        self._text = text[at:]
        if len(self._text) > LONG:
            head, tail = self._text[:-AHEAD], self._text[-AHEAD:]
            run = next(r for r in RUNS if r.match(head[-1]))
            if run.fullmatch(head[1:]):  # one piece, whose first character may be a space before it
                self._bytes, self._run, self._text = b"", run, ""
                if run is RUNS[3]:
                    head, self._text = head[:-1], head[-1]
                self._bytes = head.encode("utf-8", "surrogatepass")
                self.feed(tail, out)

    def close(self, out: array) -> None:
        """The text has ended: append all other ids."""
        if self._run is not None:
            self._bytes += self._text.encode("utf-8", "surrogatepass")
            self._stable(out, True)
        else:
            for piece in self._pattern.findall(self._text):
                self._piece(piece, out)
        self.reset()

    def encode(self, text: str, out: array) -> None:
        """Append the ids of a whole text."""
        if len(text) <= CHUNK:
            known = self._ids
            for piece in self._pattern.findall(text):
                if (ids := known.get(piece)) is not None:
                    out.extend(ids)
                else:
                    self._piece(piece, out)
            return
        for at in range(0, len(text), CHUNK):
            self.feed(text[at : at + CHUNK], out)
        self.close(out)


class Decoder:
    """Ids back to text, id by id: the state is the bytes of one unfinished character."""

    def __init__(self, vocabulary: str = "byte_bpe_50k.json") -> None:
        self._bytes = merges(vocabulary).bytes
        self._state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        """The characters that these ids complete."""
        return "".join(self._state.decode(self._bytes[i]) for i in ids)

    def close(self) -> str:
        return self._state.decode(b"", True)


def token_ids(df: DataFrame, key: str, text: str, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """key, ids: one row for each row of `df`, with the ids of its whole text.

    Defined cases: a null text and an empty text have the empty list; blank texts and the
    strings of special tokens are ordinary text; repeated rows each count; other columns are
    ignored.
    """
    ahead = merges(vocabulary).lookahead()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = Transducer(vocabulary, ahead)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                ids, ends = array("i"), [0]
                for value in batch.column(1).to_pylist():
                    if value:
                        transducer.encode(value, ids)
                    ends.append(len(ids))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, dtype=np.int32) if ids else [], pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], [key, "ids"])

    return df.select(key, F.col(text).cast("string")).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, ids array<int>")


def texts(df: DataFrame, key: str, ids: str, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """key, text: the text of each row's ids; null ids have a null text, and bytes that form no
    character become the replacement character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(1).to_pylist():
                decoder = Decoder(vocabulary)
                out.append(None if value is None else decoder.feed(value) + decoder.close())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], [key, "text"])

    return df.select(key, ids).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, text string")
