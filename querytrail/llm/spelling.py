"""Spelling variants of a corpus' words, found by chunks that one edit leaves whole."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querytrail.session import ship, store

LEAST_LETTERS = 7
LEAST_COUNT = 2
#: How many times as frequent a word's form must be.
DOMINANCE = 10
#: Counts that a task holds before it hands them on, and length up to which a text's runs are listed
#: at once; the sums are the same at any size.
HELD, LISTED = 1 << 18, 1 << 20

#: For a document's id, what its runs of letters are read as.
Reading = Callable[[object], Callable[[str], str]]


def as_written(_: object) -> Callable[[str], str]:
    return lambda run: run


def with_slips(doc_id: object) -> Callable[[str], str]:
    """Runs, without one of their letters where a hash of the document and the run says so."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def read(run: str) -> str:
        h = zlib.crc32(run.encode(), start)
        if h % 31:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1:]

    return read


def word_counts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", reading: Reading = as_written,
    least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n): words of all texts with at least `least_letters` code points that occur `least_count` times.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case, as `reading` gives
    it for the document. Each text's runs are counted before they are read, each task's words before they
    are shuffled, so frequent words cost a row per task. `reading` must not lengthen a run.
    """
    ship(docs.sparkSession)
    # A shorter run can't give a word; a run this long or longer is matched whole.
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least_letters)

    def rows(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, text in zip(ids, batch.column(1).cast(pa.binary()), strict=True):
                lowered = (text.as_py() or b"").lower().decode()
                long = len(lowered) > LISTED
                found = map(re.Match.group, runs.finditer(lowered)) if long else runs.findall(lowered)
                read = reading(doc_id)
                for letters, n in Counter(found).items():
                    word = read(letters)
                    if len(word) >= least_letters:
                        held[word] += n
                if len(held) >= HELD:
                    yield rows(held)
                    held.clear()
        yield rows(held)

    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).filter("text is not null")
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= least_count)


def _keyed(words: DataFrame, name: str, lengths: list[Column]) -> DataFrame:
    """(name, key): each word under what a chunk-bringing word of each length would share with it.

    Half of that word is a chunk, its first or its last half. The rest, which holds the edit, is cut
    in the same way, so one of its two chunks is whole as well; a key names both. What lies before the
    edit starts a word and what lies behind ends it, so places are counted from the ends; in the shorter
    of two words they are then shifted by the one letter that it lacks.
    """
    word, keys = F.col("word"), []
    for no, letters in enumerate(lengths):
        half = F.floor(letters / 2).cast("int")
        quarter = F.floor((letters - half) / 2).cast("int")
        nothing = F.lit(0)
        for kind, (head, tail) in enumerate((
                (half + quarter, nothing), (half, quarter), (quarter, half), (nothing, half + quarter))):
            end = F.when(tail > 0, word.substr(F.char_length(word) - tail + 1, tail)).otherwise("")
            key = F.xxhash64(letters, F.lit(kind), word.substr(F.lit(1), head), end)
            keys.append(F.when(head + tail <= F.char_length(word), key))
    return words.select(word.alias(name), F.explode(F.array_compact(F.array(*keys))).alias("key"))


def chunks(words: DataFrame) -> DataFrame:
    """(a, key): the chunks of each word."""
    return _keyed(words, "a", [F.char_length("word")])


def positional_grams(words: DataFrame) -> DataFrame:
    """(b, key): the grams of each word at all places where a chunk of a word one edit away can lie,
    one that is as long or longer by one letter."""
    return _keyed(words, "b", [F.char_length("word"), F.char_length("word") + 1])


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): the distinct words that differ by exactly one inserted, deleted or replaced code point,
    each pair once.

    The longer word of a pair (of two equally long ones, the one that sorts first) brings two disjoint
    chunks. One edit touches one of them at most, so the other word holds a whole chunk, shifted by one
    place at most; the words meet there and are compared. Keys are hashes; words that meet by chance
    fail the comparison.
    """
    a, b = F.col("a"), F.col("b")
    longer = F.char_length("a") > F.char_length("b")
    met = chunks(words).join(positional_grams(words), "key").filter(
        (longer | (a < b)) & (F.levenshtein(a, b, 1) == 1))
    return met.select("a", "b").distinct()


def group_variants(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the distinct words and their counts (word, n).

    Words are near if they are one edit apart. A word's form is its most frequent near word (of equals
    the first in code-point order) if that is at least `dominance` times as frequent, which must be over 1;
    its root is where following the forms ends, the word itself without one. No words give no rows.
    """
    if dominance <= 1:
        raise ValueError("dominance must be over 1, or forms could lead in circles")
    counted = store(words.select("word", "n"), "words")
    pairs = store(near_pairs(counted), "near-pairs")
    ends = pairs.union(pairs.select("b", "a")).toDF("word", "near")
    known = counted.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), "near"))
    near = ends.join(known, "near").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = counted.join(near, "word", "left")
    enough = -F.col("best.rank") >= dominance * F.col("n")
    rows = store(rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.rank")).alias("form_n")),
        "forms")
    # Counts grow tenfold with each form, so paths are short and close in a few doublings.
    steps = store(rows.filter("form is not null").select("word", F.col("form").alias("root")), "steps")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = store(steps.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "steps")
        steps = further.select("word", "root")
        if further.filter("moved").isEmpty():
            break
    return rows.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", reading: Reading = as_written,
    least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, dominance: int = DOMINANCE,
) -> DataFrame:
    """`group_variants` of the words of all texts.

    Null and empty texts have no words; rows without an id count, with an empty id to `reading`. Repeated
    rows count each time. Only the two named columns are read, so others may have any names.
    """
    return group_variants(
        word_counts(docs, id_column, text_column, reading, least_letters, least_count), dominance)
