"""Quality rules: plain text measures and a hashed n-gram model, in DataFrame functions only.

The model counts whole words and pairs of neighbouring words in hash buckets, one table for each. The
tables grow with the corpus: the characters of all texts decide on the number of buckets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querytrail.session import store

WHITE = r"[\x20\x09-\x0D]"
WINDOW = 8
#: Trusted ids up to this number are broadcast (8 bytes each); more are joined by shuffle.
BROADCAST_IDS = 2_000_000
#: A model of at most this many buckets passes to the tasks as one array (4 bytes each); a larger one
#: stays a table and is joined with the buckets of each text. Both give the same scores.
ARRAY_BUCKETS = 1 << 23
#: Characters of the corpus per bucket of a word, and buckets per square root of the characters, which is
#: less in a large corpus (a vocabulary grows about so); pairs of words have half as many buckets.
CHARS_PER_BUCKET = 192
BUCKETS_PER_ROOT = 16
MIN_BUCKETS = 1 << 10


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE + "+"), "")


def _without_end(array: Column, n: int) -> Column:
    return F.slice(array, 1, F.greatest(F.size(array) - n, F.lit(0)))


def _from(array: Column, n: int) -> Column:
    return F.slice(array, n + 1, F.greatest(F.size(array) - n, F.lit(0)))


def word_buckets(docs: DataFrame, text_column: str = "text") -> int:
    """Buckets of single words, a power of two that grows with the characters of all texts."""
    chars = docs.agg(F.sum(F.char_length(text_column))).first()[0] or 0
    wanted = min(chars // CHARS_PER_BUCKET, BUCKETS_PER_ROOT * math.isqrt(chars))
    return max(MIN_BUCKETS, 1 << max(0, wanted.bit_length() - 1))


def _buckets(hashes: Column, buckets: int) -> Column:
    """Bucket of each word and, behind those, of each pair of neighbouring words."""
    kind = "int" if 2 * buckets < 1 << 31 else "long"
    single = F.transform(hashes, lambda x: x.bitwiseAND(F.lit(buckets - 1)).cast(kind))
    pair = F.zip_with(_without_end(hashes, 1), _from(hashes, 1), lambda a, b: (
        F.xxhash64(a, b).bitwiseAND(F.lit(buckets // 2 - 1)) + F.lit(buckets)).cast(kind))
    return F.concat(single, pair)


def _features(rows: DataFrame, buckets: int) -> DataFrame:
    """Adds `words`, `hashes` and `buckets`, one number per n-gram of the whole `text`."""
    rows = rows.withColumn("words", words(F.col("text")))
    # No lambda reads another array: where the optimizer merges steps, that would be computed anew
    # for every element. Neighbours meet by zipping an array with itself, moved.
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    return rows.withColumn("buckets", _buckets(F.col("hashes"), buckets))


def fit(
    docs: DataFrame, trusted: DataFrame, buckets: int, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(bucket, weight), stored: log of the n-grams of a bucket in trusted texts over those expected there.

    Expected is the bucket's share of all n-grams times the n-grams of trusted texts. One is added to
    both counts, so what is rare weighs little and an unknown n-gram nothing; without trusted texts all
    weights are zero. Counts cover every n-gram of every document; `trusted` holds the ids of the
    trusted ones. Each task sends at most one row per bucket. Buckets without n-grams have no row.
    """
    ids = store(trusted.select(F.col(id_column).alias("trusted_id")).filter(
        "trusted_id is not null").distinct(), "trusted")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    grams = _features(texts.join(ids, F.col("id") == F.col("trusted_id"), "left"), buckets)
    counts = store(
        grams.select(F.when(F.col("trusted_id").isNotNull(), 1).otherwise(0).alias("trusted"),
                     F.explode_outer("buckets").alias("bucket"))
        .filter("bucket is not null").groupBy("bucket").agg(
            F.count("*").alias("n"), F.sum("trusted").alias("k")), "ngram-counts")
    totals = counts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    share = (totals.k or 0) / (totals.n or 1)
    weight = F.log(F.col("k") + 1.0) - F.log(F.col("n") * F.lit(share) + 1.0)
    return store(counts.select("bucket", weight.cast("float").alias("weight")), "ngram-weights")


def _as_array(model: DataFrame, buckets: int) -> DataFrame:
    """One row with `weights`, a number per bucket, put together from blocks."""
    block = 1 << 12
    every = model.sparkSession.range(buckets + buckets // 2).select(F.col("id").alias("bucket"))
    known = model.select(F.col("bucket").cast("long").alias("bucket"), "weight")
    blocks = every.join(known, "bucket", "left").groupBy(
        F.floor(F.col("bucket") / block).alias("block")).agg(F.sort_array(F.collect_list(F.struct(
            "bucket", F.coalesce("weight", F.lit(0).cast("float")).alias("weight")))).alias("held"))
    blocks = blocks.select(F.struct("block", F.transform("held", lambda b: b["weight"]).alias("held")).alias("b"))
    return store(blocks.agg(F.sort_array(F.collect_list("b")).alias("b")).select(
        F.flatten(F.transform("b", lambda b: b["held"])).alias("weights")), "ngram-array")


def _text_key() -> list[Column]:
    """128 bits that stand for a text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(text).alias("key_a"), F.xxhash64(text, F.lit(1)).alias("key_b")]


def _joined_totals(rows: DataFrame, model: DataFrame, buckets: int) -> DataFrame:
    """Adds `total` as a model that no task can hold gives it: buckets of every distinct text, counted,
    meet the table by shuffle, and the sums come back by the text's key."""
    keyed = rows.withColumns({c: k for c, k in zip(("key_a", "key_b"), _text_key(), strict=True)})
    texts = rows.select(*_text_key(), F.col("text")).groupBy("key_a", "key_b").agg(F.first("text").alias("text"))
    grams = _features(texts, buckets).select("key_a", "key_b", F.explode("buckets").alias("bucket"))
    counted = grams.groupBy("key_a", "key_b", "bucket").agg(F.count("*").alias("times"))
    totals = store(counted.join(model, "bucket").groupBy("key_a", "key_b").agg(
        F.sum(F.col("times") * F.col("weight").cast("double")).alias("total")), "ngram-totals")
    return keyed.join(totals, ["key_a", "key_b"], "left").drop("key_a", "key_b")


def _repeated_words(rows: DataFrame) -> DataFrame:
    """Adds `n_repeat_words`: words inside a window of 8 words that the text holds twice or more."""
    rows = rows.withColumn("windows", F.col("hashes"))
    # Hashes of 1, 2, 4 and then 8 words.
    for width in (1, 2, 4):
        held = F.col("windows")
        rows = rows.withColumn("windows", F.zip_with(
            _without_end(held, width), _from(held, width), lambda a, b: F.xxhash64(a, b)))
    windows = F.col("windows")
    # Only texts with a repeated window are sorted; equal windows are then neighbours.
    rows = rows.withColumn("sorted", F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    found = F.col("sorted")
    twins = F.filter(
        F.zip_with(_without_end(found, 1), _from(found, 1), lambda a, b: F.when(
            a["x"] == b["x"], F.array(a["i"], b["i"]))), lambda pair: pair.isNotNull())
    rows = rows.withColumn("places", F.sort_array(F.array_distinct(F.flatten(twins))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("stop"))

    def cover(seen, at):
        fresh = WINDOW - F.greatest(seen["stop"] - at, F.lit(0))
        return F.struct((seen["n"] + fresh).alias("n"), (at + WINDOW).alias("stop"))

    covered = F.aggregate("places", start, cover)["n"]
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))


def judge(
    docs: DataFrame, model: DataFrame, buckets: int, text_column: str = "text", threshold: float = -0.2,
) -> DataFrame:
    """All rows and columns with the measures, `score`, `base_failed` and `kept`.

    Measures of the whole text (null: none): n_words, word_chars, n_symbols, n_dup_lines (lines with a
    word that equal an earlier line), n_repeat_words. `score` is the log-likelihood ratio per n-gram to
    nine places, 0 without words. Base rule: under 20 words, or over 30 % repeated words, fails. The
    rest is kept if its score reaches `threshold`; the same text gets the same verdict in every row and
    run. Input columns named like the added ones are replaced; all others keep their values.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score",
             "base_failed", "kept")
    kept_columns = [c for c in docs.columns if c not in added]
    # Input columns travel as one, so none of them meets a column of the steps.
    rows = docs.select(F.struct(*kept_columns).alias("row"), F.col(text_column).alias("text"))
    as_array = 2 * buckets <= ARRAY_BUCKETS
    if not as_array:
        rows = _joined_totals(rows, model, buckets)
    rows = _repeated_words(_features(rows, buckets))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = rows.withColumn(
        "lines", F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    if as_array:
        # A lambda can't hold a subquery, so the model passes by as a column.
        rows = rows.withColumn("weights", _as_array(model, buckets).scalar())
        rows = rows.withColumn("total", F.aggregate(
            "buckets", F.lit(0.0), lambda held, b: held + F.get("weights", b)))
    symbols = F.char_length(text) - F.char_length(F.translate(text, "#*$%&|<>", ""))
    score = F.coalesce("total", F.lit(0.0)) / F.greatest(F.size("buckets"), F.lit(1))
    rows = rows.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace(text, WHITE + "+", "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.round(score, 9).alias("score"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    verdict = F.struct(*added[:-1], (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"))
    # As generated columns: a caller's filter on them is not moved below, into every step.
    rows = rows.select("row", F.inline_outer(F.array(verdict)))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in kept_columns], *added)


def apply_rules(
    docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    threshold: float = -0.2,
) -> DataFrame:
    """`fit` on all documents, then `judge` them."""
    buckets = word_buckets(docs, text_column)
    model = fit(docs, trusted, buckets, id_column, text_column)
    return judge(docs, model, buckets, text_column, threshold)
