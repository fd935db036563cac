"""Remove passages that repeat across or within documents, sentence by sentence."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.session import ship, store

LONGEST = 24
_SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*\s*|[.!?\n]+\s*")
_WORD = re.compile(r"\S+\s*")


def _cut(sentence: str) -> list[str]:
    """A sentence of more than LONGEST words ends after words picked by their own hash, so copies are
    cut alike wherever they stand, and after LONGEST words at the latest."""
    if len(sentence.split()) <= LONGEST:
        return [sentence]
    words = _WORD.findall(sentence)
    lead = len(sentence) - sum(map(len, words))
    pieces, start = [], 0
    for i, word in enumerate(words):
        if i - start + 1 >= LONGEST or zlib.crc32(word.strip().lower().encode()) % 8 == 0:
            pieces.append("".join(words[start:i + 1]))
            start = i + 1
    if start < len(words):
        pieces.append("".join(words[start:]))
    pieces[0] = sentence[:lead] + pieces[0]
    return pieces


def sentences(text: str) -> list[str]:
    """Pieces that join to the text; a piece without a letter or digit belongs to the one before."""
    found: list[str] = []
    for match in _SENTENCE.finditer(text):
        for piece in _cut(match[0]):
            if found and not any(map(str.isalnum, piece)):
                found[-1] += piece
            else:
                found.append(piece)
    return found


def spans(pieces: list[str], length: int, min_words: int) -> list[tuple[int, int, bytes]]:
    """(first sentence, number of sentences, 128-bit hash) of the run that begins at each sentence.

    A run takes `length` sentences and more until it has `min_words` words; what begins too near the
    end gives none. Case and white space don't count.
    """
    words = [piece.lower().split() for piece in pieces]
    keys = [xxhash.xxh3_128_digest(" ".join(w)) for w in words]
    n = [len(w) for w in words]
    found, stop, held = [], 0, 0
    for start in range(len(keys)):
        while stop < len(keys) and (stop - start < length or held < min_words):
            held += n[stop]
            stop += 1
        if stop - start < length or held < min_words:
            break
        found.append((start, stop - start, xxhash.xxh3_128_digest(b"".join(keys[start:stop]))))
        held -= n[start]
    return found


def _all_spans(docs: DataFrame, length: int, min_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, first, size, digests = [], [], [], []
            for row, scalar in enumerate(batch.column(1)):
                for start, n, digest in spans(sentences(scalar.as_py() or ""), length, min_words):
                    rows.append(row)
                    first.append(start)
                    size.append(n)
                    digests.append(digest)
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()),
                 batch.column(0).take(pa.array(rows, pa.int64())),
                 pa.array(first, pa.int32()), pa.array(size, pa.int32())],
                names=["high", "low", "id", "start", "size"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"high long, low long, id {kind}, start int, size int")


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 3,
    min_words: int = 20,
) -> DataFrame:
    """All rows and columns, without the sentences that a repeated span covers; adds `n_removed`.

    A span is `length` consecutive sentences, or more until it has `min_words` words. The first
    occurrence by (id, place) stays, every other one goes, also inside one document; what remains
    keeps its order and spacing, and a text may become empty. A null text stays null. Rows that share
    an id are taken as one document with one text, so repeated rows stay alike. Rows with a null id
    neither count nor change. An input column named like the added one is replaced.

    Hashes, not texts, are shuffled: once to find the first occurrence (combined before the shuffle,
    so a passage in a third of all documents is one row per task) and once to find the others, from
    a stored table of repeated hashes, so that hot hashes are split at run time.
    """
    ship(docs.sparkSession)
    from pyspark.sql import types as T

    keyed = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).filter(
        "id is not null")
    every = _all_spans(keyed, length, min_words)
    repeated = store(
        every.groupBy("high", "low")
        .agg(F.count("*").alias("n"), F.min(F.struct("id", "start")).alias("first"))
        .filter("n > 1").select("high", "low", "first"), "repeated-spans")
    later = every.join(repeated, ["high", "low"]).filter(F.struct("id", "start") != F.col("first"))
    covered = store(
        later.groupBy(F.col("id").alias("_id")).agg(
            F.collect_set(F.struct("start", "size")).alias("_spans")), "covered")
    kept_columns = [c for c in docs.columns if c != "n_removed"]
    joined = docs.select(*kept_columns).join(covered, F.col(id_column) == F.col("_id"), "left").drop("_id")
    at = kept_columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = [], []
            columns = batch.columns
            for scalar, gone in zip(columns[at], columns[-1], strict=True):
                text = scalar.as_py()
                out = {i for s in gone.as_py() or () for i in range(s["start"], s["start"] + s["size"])}
                if out:
                    text = "".join(p for i, p in enumerate(sentences(text)) if i not in out)
                texts.append(text)
                removed.append(len(out))
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(columns[:-1])]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(removed, pa.int64())], names=[*kept_columns, "n_removed"])

    schema = T.StructType([
        *[docs.schema[c] for c in kept_columns], T.StructField("n_removed", T.LongType())])
    return joined.mapInArrow(run, schema)
