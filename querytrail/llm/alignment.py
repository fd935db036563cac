"""Alignment of two tokenizers' tokens by the bytes they cover."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from querytrail.llm.packing import _byte_letters
from querytrail.session import ship, store

#: Characters of texts that are aligned together, and of stretches given to a tokenizer at once.
TOGETHER, AT_ONCE = 1 << 20, 1 << 11
#: A text is cut before a space that ends a word, if more than white space follows.
CUT = re.compile(r"(?<=\S)(?= \s*\S)")
#: Linked pairs with at least one in so many of all links; there are no more than that, so they are broadcast.
FREQUENT = 1 << 18
SPACE = "▁"
BITS = 20

#: Tokens of A and B, groups, the groups' text, linked ids in one number each, and how often each is linked.
Part = tuple[int, int, int, str, np.ndarray, np.ndarray]


def _ends(
    spans: list[tuple[int, int]], said: np.ndarray, shift: int, place: np.ndarray
) -> np.ndarray:
    """Byte ends of tokens from their spans in characters and the sizes of their own bytes.

    A span ends with a character, and `place` is the byte at which each character starts. Where a span is
    empty or the next one starts inside it, the token ends within the character; how far is told by the
    bytes of the tokens before it and its own.
    """
    start, end = np.array(spans, np.int64).reshape(-1, 2).T
    follows = np.append(start[1:], np.iinfo(np.int64).max)
    return np.where((start == end) | (follows < end), np.cumsum(said), place[end + shift])


class _Side:
    """One tokenizer's entries: their bytes, and how they are written inside and at the end of a group."""

    def __init__(self, entries: list[bytes]):
        self.entries = np.array(entries, object)
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.written = {end: np.array([f"{i}{end}" for i in range(len(entries))], object) for end in ",|;"}

    def spells(self, ids: np.ndarray, raw: bytes) -> bool:
        return b"".join(self.entries[ids].tolist()) == raw


class _Aligner:
    """Both tokenizers; one per worker."""

    def __init__(self, byte_level: str, pieces: str):
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letter = {c: i for i, c in enumerate(_byte_letters())}
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        # An entry with other letters is a special token, which no text gives.
        self.side_a = _Side([bytes(letter[c] for c in e) if all(c in letter for c in e) else b"" for e in entries])
        self.side_b = _Side([
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(names)])
        # Tokens never reach over a cut if no piece holds a space behind another character.
        self.cuttable = not any(SPACE in p.lstrip(SPACE) for p in names)

    def segments(self, text: str) -> Iterator[list[str]]:
        """Stretches of space + text, in lists that hold no more than about TOGETHER characters."""
        text, at = " " + text, 0
        while self.cuttable and (cut := CUT.search(text, at + TOGETHER)):
            yield CUT.split(text[at:cut.start()])
            at = cut.start()
        yield CUT.split(text[at:]) if self.cuttable else [text]

    def _tokens(self, text: str) -> tuple | None:
        """Ids and byte ends of both sides, and the size in bytes; none if a side does not spell the text.

        In ASCII a token that spells its part has as many bytes as its span has characters, so spans are
        only asked for where a text has other characters."""
        raw = text.encode()
        encoding = self.a.encode(text, add_special_tokens=False)
        # The space in front is the one that sentencepiece adds.
        mapping = self.b.encode(text[1:], return_type="offset_mapping") if len(raw) > len(text) else {
            "ids": self.b.encode(text[1:])}
        ids_a, ids_b = np.array(encoding.ids, np.int64), np.array(mapping["ids"], np.int64)
        if not (self.side_a.spells(ids_a, raw) and self.side_b.spells(ids_b, raw)):
            return None
        sizes_a, sizes_b = self.side_a.sizes[ids_a], self.side_b.sizes[ids_b]
        if len(raw) == len(text):
            return ids_a, np.cumsum(sizes_a), ids_b, np.cumsum(sizes_b), len(raw)
        place = np.append(np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw))
        return (ids_a, _ends(encoding.offsets, sizes_a, 0, place),
                ids_b, _ends(mapping["offsets"], sizes_b, 1, place), len(raw))

    def align(self, lists: list[list[str]]) -> list[Part | None]:
        """A result for each list of stretches; none if the tokens of one side don't spell it. Each
        distinct stretch is tokenized once, many in a row, as stretches don't change each other's tokens."""
        distinct = dict.fromkeys(chain.from_iterable(lists))
        number = {s: i for i, s in enumerate(sorted(distinct, key=str.isascii))}
        indexes = [np.fromiter(map(number.__getitem__, held), np.int64, len(held)) for held in lists]
        found, stops, wrong, at = [], [], set(), 0

        def take(stretches: list[str]) -> None:
            nonlocal at
            tokens = self._tokens("".join(stretches)) if stretches else None
            if tokens is not None:
                ids_a, ends_a, ids_b, ends_b, size = tokens
                found.append((ids_a, ends_a + at, ids_b, ends_b + at))
                stops.extend((np.cumsum([len(s.encode()) for s in stretches]) + at).tolist())
                at += size
            elif len(stretches) == 1:
                wrong.add(number[stretches[0]])
                stops.append(at)
            else:
                for s in stretches:
                    take([s])

        row, size = [], 0
        for stretch in number:
            row.append(stretch)
            size += len(stretch)
            # Only a text's last stretch ends with white space, which would join the next one.
            if size >= AT_ONCE or stretch[-1].isspace():
                take(row)
                row, size = [], 0
        if row:
            take(row)
        parts = self._parts(indexes, np.array(stops, np.int64), found)
        if not wrong:
            return parts
        return [None if wrong.intersection(index.tolist()) else part for index, part in zip(indexes, parts, strict=True)]

    def _parts(self, indexes: list[np.ndarray], stops: np.ndarray, found: list[tuple]) -> list[Part]:
        ids_a, ends_a, ids_b, ends_b = (
            np.concatenate([np.zeros(0, np.int64), *arrays]) for arrays in (zip(*found, strict=True) if found else [()] * 4))
        of_a, of_b = np.searchsorted(stops, ends_a), np.searchsorted(stops, ends_b)
        counts_a, counts_b = np.bincount(of_a, minlength=len(stops)), np.bincount(of_b, minlength=len(stops))
        cut_a = np.isin(ends_a, ends_b, assume_unique=True)
        cut_b = np.isin(ends_b, ends_a, assume_unique=True)
        links = ids_a[cut_a] << BITS | ids_b[cut_b]
        n_links = np.bincount(of_a[cut_a], minlength=len(stops))
        first = np.cumsum(n_links) - n_links
        # A group's tokens of A, then those of B.
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        texts = np.empty(len(ids_a) + len(ids_b), object)
        for side, ids, cut, end, before in (
                (self.side_a, ids_a, cut_a, "|", np.searchsorted(group_b, group_a, "left")),
                (self.side_b, ids_b, cut_b, ";", np.searchsorted(group_a, group_b, "right"))):
            texts[np.arange(len(ids)) + before] = np.where(cut, side.written[end][ids], side.written[","][ids])
        held, last = texts.tolist(), np.cumsum(counts_a + counts_b).tolist()
        written = ["".join(held[i:j]) for i, j in zip([0, *last], last)]
        parts = []
        for index in indexes:
            which, times = np.unique(index, return_counts=True)
            n = n_links[which]
            of = np.repeat(np.arange(len(which)), n)
            inner = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            parts.append((
                int(counts_a[index].sum()), int(counts_b[index].sum()), int(n_links[index].sum()),
                "".join([written[i] for i in index.tolist()])[:-1], *_added(links[first[which][of] + inner], times[of])))
        return parts


def _added(links: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each number once, with its times added up."""
    which, place = np.unique(links, return_inverse=True)
    return which, np.bincount(place, times, len(which)).astype(np.int64)


@lru_cache(maxsize=1)
def _aligner(byte_level: str, pieces: str) -> _Aligner:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return _Aligner(byte_level, pieces)


_NOTHING: Part = (0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))


def _joined(parts: list[Part | None]) -> Part:
    if not parts or None in parts:
        return _NOTHING
    if len(parts) == 1:
        return parts[0]
    n_a, n_b, n_groups, texts, links, times = zip(*parts, strict=True)
    return (sum(n_a), sum(n_b), sum(n_groups), ";".join(texts),
            *_added(np.concatenate(links), np.concatenate(times)))


def _rows(aligner: _Aligner, texts: pa.Array) -> Iterator[list[Part]]:
    """Results of the texts in order, those of many short ones at a time."""
    waiting: list[list[list[str]]] = []
    size = 0

    def done() -> list[Part]:
        found = iter(aligner.align([s for held in waiting for s in held]))
        return [_joined([next(found) for _ in held]) for held in waiting]

    for value in texts:
        text = value.as_py() or ""
        if waiting and size + len(text) > TOGETHER:
            yield done()
            waiting, size = [], 0
        if len(text) > TOGETHER:
            yield [_joined([aligner.align([held])[0] for held in aligner.segments(text)])]
            continue
        waiting.append(list(aligner.segments(text)) if text else [])
        size += len(text)
    yield done()


def align(
    docs: DataFrame, byte_level: str, pieces: str, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(id, groups, n_a, n_b, n_groups, a, b, times) of every row.

    `byte_level` is a tokenizers file (A), given space + text, `pieces` a sentencepiece model (B) that adds
    the space itself; special tokens in a text are plain text. `groups` lists the groups of tokens
    between places where tokens of both end, as `a1,a2|b1;a3|b2,b3`. A token of A and one of B that
    end together are linked; a, b and times are the distinct linked ids and how often each pair is.

    Both tokenizers treat words alone, so texts are cut before spaces and a worker aligns a word once;
    with a piece vocabulary that does not allow this, texts stay whole. Null and empty texts, and those that
    the tokens of one side don't spell, have no tokens. Repeated rows keep their rows; other columns are
    left behind.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_level, pieces)
        for batch in batches:
            at = 0
            for rows in _rows(aligner, batch.column(1)):
                n_a, n_b, n_groups, groups, links, times = zip(*rows, strict=True) if rows else [()] * 6
                offsets = pa.array(np.cumsum([0, *map(len, links)]), pa.int32())
                every = np.concatenate([_NOTHING[4], *links])
                lists = [every >> BITS, every & (1 << BITS) - 1, np.concatenate([_NOTHING[5], *times])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(rows)), pa.array(groups, pa.string()),
                     *(pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups)),
                     *(pa.ListArray.from_arrays(offsets, pa.array(c, pa.int32())) for c in lists)],
                    names=["id", "groups", "n_a", "n_b", "n_groups", "a", "b", "times"])
                at += len(rows)

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        run, f"id {kind}, groups string, n_a long, n_b long, n_groups long,"
        " a array<int>, b array<int>, times array<int>")


def count_links(aligned: DataFrame) -> DataFrame:
    """(a, b, n, best), stored: how many links of all rows hold each pair of ids, and whether no
    other pair of the id of B holds more."""
    each = aligned.select(F.explode(F.arrays_zip("a", "b", "times")).alias("p"))
    counts = store(
        each.groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("p.times").alias("n")), "links")
    # One row per id of B: no more than its vocabulary has.
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))
    return store(counts.join(F.broadcast(highest), "b").select(
        "a", "b", "n", (F.col("n") == F.col("highest")).alias("best")), "link-counts")


def rate_links(aligned: DataFrame) -> DataFrame:
    """All rows and columns of a result of `align` with n_links, n_best (links whose pair is a best one of
    its id of B) and count_sum (the links' counts added up). Counts cover all rows.

    Frequent pairs, of which there are few whatever the input, are looked up in a broadcast table; only
    the others are shuffled to meet their counts.
    """
    rows = store(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = count_links(rows)
    links = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long")).first()[0]
    often = F.col("n") * FREQUENT >= links
    frequent, rest = F.broadcast(counts.filter(often)), counts.filter(~often)
    each = rows.select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("p")).select("row", "p.*")

    def rated(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("row").agg(
            F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"))

    seldom = store(each.join(frequent, ["a", "b"], "left_anti"), "seldom-links")
    both = rated(each.join(frequent, ["a", "b"])).union(rated(seldom.join(rest, ["a", "b"])))
    sums = ["n_links", "n_best", "count_sum"]
    found = both.groupBy("row").agg(*(F.sum(c).alias(c) for c in sums))
    return rows.join(found, "row", "left").select(
        *aligned.columns, *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in sums))
