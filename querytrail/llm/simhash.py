"""Near duplicates by SimHash fingerprints that share enough bytes in the same positions."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querytrail.llm.graph import components
from querytrail.session import ship, store

SEED = 42
CHUNK = 1 << 16
#: Postings with more fingerprints than this are not paired off but linked through shared neighbours.
LONG_POSTING = 64
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words between space, tab and line breaks."""
    return text.lower().split()


def shingle_hashes(words: list[bytes], size: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of `size` words, in chunks, so long texts need little memory."""
    if not words:
        return
    size = min(size, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    starts, ends = starts[:len(words) - size + 1], ends[size - 1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        pairs = zip(starts[at:at + CHUNK].tolist(), ends[at:at + CHUNK].tolist(), strict=True)
        yield np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype=np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set, lowest bit first."""
    columns = hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    return np.concatenate([np.bincount(columns[:, i], minlength=256) @ _BITS for i in range(8)])


def simhash(text: bytes, size: int = 3) -> int:
    """Bit i is set if it is set in over half of the shingle hashes; zero without words."""
    total, counts = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(words_of(text), size):
        total += len(hashes)
        counts += bit_counts(hashes)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 3
) -> DataFrame:
    """(id, fingerprint) of every row; the fingerprint's 64 bits are held in a long."""
    ship(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            prints = np.array([simhash(t.as_py() or b"", size) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64))], names=["id", "fingerprint"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        run, f"id {kind}, fingerprint long")


def shared_bytes(a: Column, b: Column) -> Column:
    """Tally of the byte positions at which two fingerprints hold the same byte."""
    differing = a.bitwiseXOR(b)
    return sum(
        (F.when(F.shiftright(differing, 8 * i).bitwiseAND(F.lit(255)) == 0, 1).otherwise(0)
         for i in range(8)), F.lit(0))


def _postings(prints: DataFrame, distance: int) -> DataFrame:
    """(place, bytes, fingerprint): the inverted index.

    At most `distance` bytes differ. With the 8 positions in distance + 2 groups, at least two whole
    groups are shared, so the index holds each fingerprint once per pair of groups under the bytes
    of both: every pair that can qualify meets, and a posting names many bytes rather than one.
    """
    groups = np.array_split(np.arange(8), distance + 2)
    places = []
    for no, (one, two) in enumerate(combinations(groups, 2)):
        mask = sum(255 << (8 * int(i)) for i in (*one, *two))
        signed = mask - (1 << 64) if mask >> 63 else mask
        places.append(F.struct(
            F.lit(no).alias("place"),
            F.col("fingerprint").bitwiseAND(F.lit(signed).cast("long")).alias("bytes")))
    return prints.select("fingerprint", F.explode(F.array(*places)).alias("p")).select(
        "p.place", "p.bytes", "fingerprint")


def link_fingerprints(prints: DataFrame, distance: int = 2) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints exactly as all pairs within `distance` do.

    Candidates come from the index; a pair stays if it shares the 8 - distance byte positions that
    such pairs must share, and if its bits then differ in `distance` places at most. Postings that are
    longer than LONG_POSTING are linked without pairs: two fingerprints are at most two bits apart
    exactly if both are within one bit of a third value, and no value has more than 65 such
    fingerprints. For other distances all postings are paired.
    """
    postings = store(_postings(prints, distance), "postings")
    sizes = store(
        postings.groupBy("place", "bytes").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    met = store(postings.join(sizes, ["place", "bytes"]), "met")
    short = met if distance != 2 else met.filter(F.col("size") <= LONG_POSTING)
    left = short.select("place", "bytes", F.col("fingerprint").alias("a"))
    right = short.select("place", "bytes", F.col("fingerprint").alias("b"))
    a, b = F.col("a"), F.col("b")
    pairs = left.join(right, ["place", "bytes"]).filter(a < b)
    pairs = pairs.filter(shared_bytes(a, b) >= 8 - distance)
    links = pairs.filter(F.bit_count(a.bitwiseXOR(b)) <= distance).select("a", "b")
    if distance != 2:
        return links
    crowded = met.filter(F.col("size") > LONG_POSTING).select("fingerprint").distinct()
    flips = [F.col("fingerprint")] + [
        F.col("fingerprint").bitwiseXOR(F.lit((1 << i) if i < 63 else -(1 << 63)).cast("long"))
        for i in range(64)]
    near = crowded.select("fingerprint", F.explode(F.array(*flips)).alias("value"))
    hubs = near.groupBy("value").agg(F.collect_list("fingerprint").alias("around")).filter(
        F.size("around") > 1)
    hubs = hubs.select(F.array_min("around").alias("a"), F.explode("around").alias("b"))
    return links.union(hubs.filter("a <> b"))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 3,
    distance: int = 2,
) -> DataFrame:
    """(id, fingerprint, component_id) of every row, component_id the smallest id reachable by links.

    Texts without words have fingerprint zero and are linked like any other; a null text is an empty
    one. Repeated rows and ids keep their rows. Rows with a null id take part, but no component is
    named after them; a component of null ids only is null. Other columns are left behind.

    Equal fingerprints are one node, so copies cost nothing after the first aggregate, and hot
    fingerprints meet their class in joins that start from stored tables and are split at run time.
    """
    prints = store(fingerprints(docs, id_column, text_column, size), "fingerprints")
    classes = store(
        prints.groupBy("fingerprint").agg(F.min("id").alias("first_id")), "classes")
    group = components(link_fingerprints(classes.select("fingerprint"), distance))
    named = store(
        classes.join(group, F.col("fingerprint") == F.col("node"), "left")
        .select("fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component")),
        "named")
    smallest = store(
        named.groupBy("component").agg(F.min("first_id").alias("component_id")), "smallest")
    ids = store(named.join(smallest, "component").select("fingerprint", "component_id"), "class-ids")
    return prints.join(ids, "fingerprint").select(
        F.col("id").alias(id_column), "fingerprint", "component_id")


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
