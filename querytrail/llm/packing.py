"""Pack tokenized documents into sequences of bounded length.

The packing is decided on the histogram of piece lengths, which has at most `capacity` rows however
many documents there are. Sets of pieces that provably dominate all others are fixed first, the rest
is packed best-fit by decreasing length; the result is a list of patterns and how often each is used.
Every piece then finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querytrail.session import ship, store

Pattern = tuple[tuple[int, ...], int]
#: Words, and their letters alone, held per worker; a full table starts anew, which changes speed only.
CACHED_WORDS, CACHED_STEMS = 1 << 18, 1 << 20
_SPLITTERS = "\x1c\x1d\x1e\x1f"  # white space to Python, but not to the tokenizer
#: Letters that lower case and composition treat one by one, then any ASCII punctuation.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


def _byte_letters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: printable ones stand for
    themselves, the others for characters from 256 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class _Stems(dict):
    """Ids of runs of lower-case letters or of punctuation, straight from the vocabulary's merges."""

    def __init__(self, model):
        super().__init__()
        self.model, self.letters = model, _byte_letters()

    def __missing__(self, stem: str) -> bytes:
        written = stem if stem.isascii() else "".join(self.letters[b] for b in stem.encode())
        ids = np.array([t.id for t in self.model.tokenize(written)], "<u4").tobytes()
        if len(self) >= CACHED_STEMS:
            self.clear()
        self[stem] = ids
        return ids


class _Words(dict):
    """Token ids of a word as bytes, computed when first asked for.

    Letters followed by punctuation are two separate pieces to the tokenizer, lower-cased one by one,
    so their ids are looked up apart; every other word goes through the tokenizer as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.stems = _Stems(self.tokenizer.model)

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if plain is None:
            ids = self.encode(word)
        else:
            ids = self.stems[plain[1].lower()]
            if plain[2]:
                ids += self.stems[plain[2]]
        if len(word) <= 64:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def document(self, text: str) -> bytes:
        """Ids of the text, then id 0, as little-endian 32-bit numbers.

        No token crosses white space, so a text's ids are its words' ids.
        """
        if any(c in text for c in _SPLITTERS):
            return self.encode(text) + bytes(4)
        return b"".join(map(self.__getitem__, text.split())) + bytes(4)


_LOADED: dict[str, _Words] = {}


def pieces(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text",
    capacity: int = 2048,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, rank) of every piece of every document.

    `rank` counts the pieces of one length within the task `part`. A null text is an empty one: a
    single id 0. Store the result before using the ranks.
    """
    ship(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from querytrail.llm import packing

        words = packing._LOADED.get(vocabulary)
        if words is None:
            words = packing._LOADED[vocabulary] = packing._Words(vocabulary)
        part = TaskContext.get().partitionId()
        ranks: Counter[int] = Counter()
        for batch in batches:
            rows, numbers, starts, lengths, crcs, places = [], [], [], [], [], []
            for row, scalar in enumerate(batch.column(1)):
                ids = words.document(scalar.as_py() or "")
                for no, at in enumerate(range(0, len(ids), 4 * capacity)):
                    held = ids[at:at + 4 * capacity]
                    length = len(held) // 4
                    rows.append(row)
                    numbers.append(no)
                    starts.append(at // 4)
                    lengths.append(length)
                    crcs.append(zlib.crc32(held))
                    places.append(ranks[length])
                    ranks[length] += 1
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()),
                 pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()),
                 pa.array([part] * n, pa.int32()), pa.array(places, pa.int64())],
                names=["id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(run, (
        f"id {kind}, piece int, start long, length long, ids_crc32 long, part int, rank long"))


class _Stock:
    """Lengths still to be packed and how many there are of each."""

    def __init__(self, counts: dict[int, int]):
        self.count = {length: n for length, n in counts.items() if n}
        self.lengths = sorted(self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            self.lengths.pop(bisect_left(self.lengths, length))

    def largest(self, room: int, without: tuple[int, ...] = ()) -> int | None:
        """Longest length up to `room`, when one of each of `without` is already used."""
        used = Counter(without)
        at = bisect_left(self.lengths, room + 1) - 1
        while at >= 0:
            length = self.lengths[at]
            if self.count[length] > used[length]:
                return length
            at -= 1
        return None

    def smallest(self, n: int, without: tuple[int, ...]) -> list[int]:
        used, found = Counter(without), []
        for length in self.lengths:
            found += [length] * min(n - len(found), self.count[length] - used[length])
            if len(found) == n:
                break
        return found


def _dominating(stock: _Stock, first: int, capacity: int) -> tuple[int, ...] | None:
    """A set with `first` that dominates every other feasible set with it, where one is proved.

    A set dominates another if the other's pieces can be grouped under its own: exchanging them never
    needs more sequences. Beside `first` stands nothing if nothing fits; one piece if it fills the
    room exactly, or the longest that fits if no two fit; two pieces if no three fit and every pair
    that fits lies below them piece by piece or below the longer one together.
    """
    room = capacity - first
    one = stock.largest(room, (first,))
    if one is None:
        return (first,)
    if one == room:
        return first, one
    least = stock.smallest(3, (first,))
    if len(least) < 2 or least[0] + least[1] > room:
        return first, one
    if len(least) > 2 and sum(least) <= room:
        return None
    two = stock.largest(room - one, (first, one))
    if two is None:
        return None
    # The shorter piece of any pair is at most half the room; none may exceed `two`.
    low = stock.largest(room // 2, (first,))
    while low is not None and low > two:
        partner = stock.largest(room - low, (first, low))
        if partner is not None and partner >= low and partner + low > one:
            return None
        low = stock.largest(low - 1, (first,))
    return first, one, two


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Patterns that some best packing uses, and what is left to pack."""
    stock, fixed, changed = _Stock(counts), [], True
    while changed and stock.lengths:
        changed = False
        for first in stock.lengths[::-1]:
            while first in stock.count:
                found = _dominating(stock, first, capacity)
                if found is None:
                    break
                # The proof holds again until one of the set's lengths runs out: taking pieces away
                # only removes alternatives.
                need = Counter(found)
                times = min(stock.count[length] // n for length, n in need.items())
                for length, n in need.items():
                    stock.take(length, n * times)
                fixed.append((found, times))
                changed = True
    return fixed, stock.count


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing over groups of equal sequences."""
    by_room: dict[int, list[list]] = defaultdict(list)
    rooms: list[int] = []

    def add(pattern: tuple[int, ...], n: int, room: int) -> None:
        if not by_room[room]:
            insort(rooms, room)
        by_room[room].append([pattern, n])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                per = capacity // length
                if left >= per:
                    add((length,) * per, left // per, capacity - per * length)
                if left % per:
                    add((length,) * (left % per), 1, capacity - left % per * length)
                break
            room = rooms[at]
            group = by_room[room][-1]
            n = min(left, group[1])
            group[1] -= n
            if not group[1]:
                by_room[room].pop()
                if not by_room[room]:
                    rooms.pop(at)
            add((*group[0], length), n, room - length)
            left -= n
    return [(pattern, n) for groups in by_room.values() for pattern, n in groups]


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    fixed, rest = reduce_by_dominance(counts, capacity)
    merged: Counter[tuple[int, ...]] = Counter()
    for pattern, n in [*fixed, *best_fit(rest, capacity)]:
        merged[pattern] += n
    return list(merged.items())


def _slots(patterns: list[Pattern]) -> tuple[np.ndarray, ...]:
    """Per slot, sorted by (length, first rank): that key, the first sequence and the offset."""
    used: Counter[int] = Counter()
    sequence, rows = 0, []
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return table[:, 0] << 46 | table[:, 1], table[:, 1], table[:, 2], table[:, 3]


def pack(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text",
    capacity: int = 2048,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) for every piece.

    Pieces of a document longer than `capacity` are cut at multiples of it; every other document is
    one piece. Offsets of a sequence leave no gap. Repeated rows and null ids are packed row by row;
    other columns are left behind; no documents give no rows.

    Only (length, count) pairs reach the driver, at most `capacity` of them. Ranks are counted inside
    the tokenizing tasks, so a length that a third of all pieces have needs no sort and no single
    task: what is summed up is one row per task and length.
    """
    cut = store(pieces(docs, vocabulary, id_column, text_column, capacity), "pieces")
    per_task = store(
        cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    patterns = plan({length: n for length, n in per_task.groupBy("length").agg(F.sum("n")).collect()}, capacity)
    keys, ranks, sequences, offsets = _slots(patterns)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = store(per_task.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "ranks")
    names = ["id", "piece", "start", "length", "ids_crc32"]
    ranked = cut.join(before, ["part", "length"]).select(
        *names, (F.col("before") + F.col("rank")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            slot = np.searchsorted(keys, length << 46 | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequences[slot] + rank - ranks[slot]),
                 pa.array(offsets[slot])], names=[*names, "sequence_id", "offset"])

    schema = T.StructType([
        *[ranked.schema[c] for c in names], T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(run, schema).withColumnRenamed("id", id_column)
