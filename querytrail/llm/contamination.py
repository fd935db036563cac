"""Benchmark passages inside documents, found by winnowing. DataFrame functions only."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querytrail.session import store

#: What separates words once A-Z are lower case: ASCII but for digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Words of a text that are looked at together; the next block starts with the words that end this one.
BLOCK = 1 << 15
ADDED = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, BETWEEN), "")


def gram_size(length: int) -> int:
    """Words of a fingerprint's k-gram for windows of this length; a window has length - k + 1 of them."""
    return max(1, 2 * length // 5)


def _with_runs(
    rows: DataFrame, column: str, name: str, size: int, join: Callable[[Column, Column], Column]
) -> DataFrame:
    """Adds `name`: for every run of `size` neighbours in the array `column`, `join` over all of it.

    Runs double: two that overlap cover a longer one. An array meets itself, moved, so no lambda reads
    another array, which the optimizer might compute anew for each element.
    """
    rows, have = rows.withColumn(name, F.col(column)), 1
    while have < size:
        grown = min(2 * have, size)
        step, held = grown - have, F.col(name)
        left = F.greatest(F.size(held) - step, F.lit(0))
        rows = rows.withColumn(name, F.zip_with(F.slice(held, 1, left), F.slice(held, step + 1, left), join))
        have = grown
    return rows


def _blocks(texts: DataFrame, window: int) -> DataFrame:
    """(k1, k2, first, words): the words of each text in blocks that overlap by a window less one."""
    rows = texts.select("k1", "k2", words(F.col("text")).alias("all_words"))
    last = F.floor(F.greatest(F.size("all_words") - 1, F.lit(0)) / BLOCK).cast("int")
    rows = rows.select("k1", "k2", "all_words", F.explode(F.sequence(F.lit(0), last)).alias("no"))
    return rows.select(
        "k1", "k2", (F.col("no") * BLOCK).alias("first"),
        F.slice("all_words", F.col("no") * BLOCK + 1, BLOCK + window - 1).alias("words"))


def _with_hashes(rows: DataFrame, name: str, seed: int) -> DataFrame:
    """Adds `name`: a hash of each word."""
    return rows.withColumn(name, F.transform("words", lambda w: F.xxhash64(F.lit(seed), w)))


def _with_minima(rows: DataFrame, length: int) -> DataFrame:
    """Adds `minima`: for every window of `length` words the smallest hash of its k-grams."""
    size = gram_size(length)
    rows = _with_runs(_with_hashes(rows, "hashes", length), "hashes", "grams", size, lambda a, b: F.xxhash64(a, b))
    return _with_runs(rows, "grams", "minima", length - size + 1, lambda a, b: F.least(a, b))


def fingerprints(blocks: DataFrame, length: int) -> DataFrame:
    """(k1, k2, print): the distinct k-gram hashes that winnowing keeps of each block."""
    return _with_minima(blocks, length).select("k1", "k2", F.explode(F.array_distinct("minima")).alias("print"))


def windows(blocks: DataFrame, length: int, *others: str) -> DataFrame:
    """(others, start, length, print, w1, w2): every window of `length` words with the k-gram hash that
    winnowing keeps of it, and 128 bits that stand for its words."""
    rows = _with_minima(blocks, length)
    for name, seed in (("w1", -1), ("w2", -2)):
        rows = _with_hashes(rows, f"{name}_words", seed)
        rows = _with_runs(rows, f"{name}_words", name, length, lambda a, b: F.xxhash64(a, b))
    each = F.posexplode(F.arrays_zip("minima", "w1", "w2")).alias("at", "w")
    return rows.select(*others, "first", each).select(
        *others, (F.col("first") + F.col("at")).alias("start"), F.lit(length).alias("length"),
        F.col("w.minima").alias("print"), "w.w1", "w.w2")


def _text_keys(text: str) -> list[Column]:
    held = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(held).alias("k1"), F.xxhash64(F.lit(1), held).alias("k2")]


def _item_windows(benchmark: DataFrame, item: str, text: str, window: int) -> tuple[DataFrame, list[int]]:
    """(item, start, length, print, w1, w2) of all items, stored, and the lengths that occur."""
    rows = store(benchmark.select(
        F.col(item).cast("string").alias("item"), words(F.col(text)).alias("words"))
        .filter(F.size("words") > 0), "items")
    of = F.least(F.size("words"), F.lit(window))
    # At most `window` numbers.
    lengths = sorted(r[0] for r in rows.select(of).distinct().collect())
    parts = [
        windows(rows.filter(of == n).withColumn("first", F.lit(0)), n, "item") for n in lengths]
    found = parts[0] if parts else None
    for part in parts[1:]:
        found = found.union(part)
    return (store(found, "item-windows") if found is not None else None), lengths


def _covered(spans: Column) -> Column:
    """Words inside any of the spans (start, length)."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("stop"))

    def cover(seen, span):
        stop = (span["start"] + span["length"]).cast("long")
        fresh = F.greatest(stop - F.greatest(seen["stop"], span["start"].cast("long")), F.lit(0).cast("long"))
        return F.struct((seen["n"] + fresh).alias("n"), F.greatest(seen["stop"], stop).alias("stop"))

    return F.aggregate(F.sort_array(spans), start, cover)["n"]


def find_passages(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
    item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """(k1, k2, n_hit, items): per distinct text that holds a window of an item, its words inside
    such windows and the ids of those items, as strings in order. k1 and k2 are two hashes of the text.

    A fingerprint is the smallest k-gram hash of a window, so a window that two texts share has the
    same fingerprint in both and no shared window is missed. Texts that share a fingerprint with an item
    are read again; their windows meet the items' windows under fingerprint and words.

    Joins start from stored tables, so a passage that very many texts hold is split at run time.
    Windows that lie in the same items are one class, so a passage shared by many items does not bring
    every pair of its windows and items into a text's group.
    """
    held, lengths = _item_windows(benchmark, item_column, item_text, window)
    spark = docs.sparkSession
    if not lengths:
        return spark.createDataFrame([], "k1 long, k2 long, n_hit long, items array<string>")
    place = ["length", "print", "w1", "w2"]
    classes = store(
        held.select(*place, "item").distinct().groupBy(*place).agg(
            F.bit_xor(F.xxhash64(F.coalesce("item", F.lit("")))).alias("c1"),
            F.bit_xor(F.xxhash64(F.lit(1), F.coalesce("item", F.lit("")))).alias("c2")), "window-classes")
    members = store(
        held.join(classes, place).filter("item is not null").select("c1", "c2", "item").distinct(),
        "class-items")
    prints = store(classes.select("print").distinct(), "item-fingerprints")

    texts = docs.select(*_text_keys(text_column), F.col(text_column).alias("text"))
    blocks = _blocks(texts, window)
    kept = fingerprints(blocks, lengths[0])
    for n in lengths[1:]:
        kept = kept.union(fingerprints(blocks, n))
    suspects = store(kept.join(prints, "print", "left_semi").select("k1", "k2").distinct(), "suspects")

    once = texts.join(suspects, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("text").alias("text"))
    again = _blocks(store(once, "suspect-texts"), window)
    met = windows(again, lengths[0], "k1", "k2")
    for n in lengths[1:]:
        met = met.union(windows(again, n, "k1", "k2"))
    hits = store(
        met.join(classes, place).select("k1", "k2", "start", "length", "c1", "c2"), "window-hits")
    covered = hits.groupBy("k1", "k2").agg(
        _covered(F.collect_set(F.struct("start", "length"))).alias("n_hit"))
    items = (
        hits.select("k1", "k2", "c1", "c2").distinct().join(members, ["c1", "c2"])
        .groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item")).alias("items")))
    return store(covered.join(items, ["k1", "k2"], "left").select(
        "k1", "k2", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items")), "passages")


def mark_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
    item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """All rows and columns with n_words, n_hit, n_items, items_sha256 and contaminated.

    Words are runs of digits, letters and whatever is not ASCII, A-Z in lower case. A window is `window`
    consecutive words of an item, or all words of a shorter one; a word of a document inside an occurrence of
    a window is hit. Items are those with an occurring window; the hash is of their ids, sorted as strings.

    A null or empty text, or one without words, has no words and no hits; the same holds for items. Rows of
    one item id are one item; items without an id make words hit but are not counted. Repeated rows
    and ids each get their text's result. Input columns named like the added ones are replaced.
    """
    found = find_passages(docs, benchmark, text_column, item_column, item_text, window)
    columns = [c for c in docs.columns if c not in ADDED]
    n_words = F.size(words(F.col(text_column))).cast("long")
    k1, k2 = _text_keys(text_column)
    # The caller's columns travel as one struct, so that no name of theirs can meet one of ours.
    rows = docs.select(F.struct(*columns).alias("row"), n_words.alias("n_words"), k1, k2)
    none = F.array().cast("array<string>")
    held = F.coalesce("items", none)
    return rows.join(found, ["k1", "k2"], "left").select(
        "row.*", "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(held).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", held), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def check_sql() -> str:
    """The same over `documents` and `benchmark`, window by window."""
    return r"""
with doc as materialized (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
item as materialized (
  select item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
part as materialized (
  select distinct item_id, least(len(w), 10) as n, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ')
    for i in range(1, len(w) - least(len(w), 10) + 2)]) as said
  from item where len(w) > 0),
place as materialized (
  select r, n, unnest(range(1, len(w) - n + 2)) as pos, unnest([array_to_string(w[i:i + n - 1], ' ')
    for i in range(1, len(w) - n + 2)]) as said
  from doc, (select distinct n from part) where len(w) >= n),
met as materialized (select r, pos, place.n, item_id from place join part using (n, said)),
hit as (select r, count(distinct k) as n_hit from (
  select distinct r, unnest(range(pos, pos + n)) as k from met) group by r),
named as (select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (
  select distinct r, cast(item_id as varchar) as item_id from met where item_id is not null) group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from doc left join hit using (r) left join named using (r)"""
