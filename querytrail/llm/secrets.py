"""Secrets in texts: three fixed patterns, and tokens that a battery of randomness tests accepts.

A candidate is a run of 20 or more characters of `[A-Za-z0-9+/_=-]` with a letter and a digit that
touches no pattern match. Its encoding is the smallest of the known alphabets that holds all its
characters. Three tests ask whether it looks like uniform draws from that alphabet: chi-squared over
the symbol counts, runs above and below the middle symbol, and serial correlation at lag one. The
smallest of the three tail probabilities, corrected for taking the smallest of three, is its `p`.

A token is random until the battery rejects it, and the rejections are held to a false-discovery rate
(Benjamini-Hochberg) in each cell of encoding and length band: of the tokens rejected as ordinary, at
most the share `lost_share` is random. The limit below which `p` rejects never exceeds `lost_share`, so
a lone random token among any number of ordinary ones is lost with that probability at most, whatever
else its cell holds; nothing depends on a cell's size. Short tokens give the tests little power, so more ordinary strings of
20 to 32 characters are listed than of longer ones. The histogram behind the limits has a fixed number
of cells.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.session import ship, store

# The kinds in the order in which spans at one place are listed, and the patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
KEYWORD_PARTS = ("passw", "secret", "token", "api")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Alphabets by size; the first that holds all characters of a token is its encoding.
ALPHABETS = {
    "hex": DIGITS + "abcdef", "upper_hex": DIGITS + "ABCDEF", "base32": UPPER + "234567",
    "lower_alnum": DIGITS + LOWER, "upper_alnum": DIGITS + UPPER, "alnum": DIGITS + UPPER + LOWER,
    "base64": UPPER + LOWER + DIGITS + "+/", "base64url": UPPER + LOWER + DIGITS + "-_",
}
BANDS = (20, 24, 32, 48, 64, 96, 128, 256)
#: Steps in which the limits are chosen.
BINS = 512

_FOUND = (
    "array<struct<kind:string,start:int,stop:int,encoding:string,band:int,p:double>>")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the three patterns as (kind, start, end), by start and then kind."""
    spans = []
    folded = text.lower()
    if any(part in folded for part in KEYWORD_PARTS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                  if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= MIN_ACCESS]
    # A hex run of 24 lies inside one run of candidate characters.
    for run in CANDIDATE.finditer(text):
        spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text, run.start(), run.end())
                  if m.end() - m.start() >= MIN_HEX]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def infer_encoding(token: str) -> str | None:
    used = set(token)
    return next((name for name, letters in ALPHABETS.items() if used <= set(letters)), None)


def randomness(token: str, alphabet: str) -> float:
    """Probability that uniform draws from the alphabet look at least as odd as the token."""
    n, k = len(token), len(alphabet)
    place = {c: i for i, c in enumerate(alphabet)}
    x = np.array([place[c] for c in token], dtype=np.float64)
    counts = np.bincount(x.astype(np.int64), minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    freedom = k - 1
    # Wilson-Hilferty: the cube root of chi-squared is nearly normal.
    p_chi = _upper_tail(
        ((chi / freedom) ** (1 / 3) - (1 - 2 / (9 * freedom))) / math.sqrt(2 / (9 * freedom)))
    high = x >= k / 2
    n_high = int(high.sum())
    n_low = n - n_high
    if n_high == 0 or n_low == 0:
        return 0.0
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 1 + 2 * n_high * n_low / n
    spread = (mean - 1) * (mean - 2) / (n - 1)
    p_runs = 2 * _upper_tail(abs(runs - mean) / math.sqrt(spread)) if spread > 0 else 1.0
    centred = x - x.mean()
    energy = float((centred ** 2).sum())
    if energy == 0:
        return 0.0
    lagged = float((centred[1:] * centred[:-1]).sum()) / energy
    p_serial = 2 * _upper_tail(abs(lagged + 1 / n) * math.sqrt(n))
    return 1 - (1 - min(p_chi, p_runs, p_serial, 1.0)) ** 3


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple]:
    """(kind, start, end, encoding, band, p) of the tokens that the battery looks at."""
    found = []
    for m in CANDIDATE.finditer(text):
        token = m[0].rstrip("=")
        start, stop = m.start(), m.start() + len(token)
        if len(token) < BANDS[0] or any(s < stop and start < e for _, s, e in taken):
            continue
        if not any(c.isdigit() for c in token) or not any(c.isalpha() for c in token):
            continue
        encoding = infer_encoding(token)
        if encoding is not None:
            band = max(b for b in BANDS if b <= len(token))
            found.append(("random", start, stop, encoding, band,
                          randomness(token, ALPHABETS[encoding])))
    return found


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id and every base match and candidate found in its whole text."""
    ship(docs.sparkSession)
    out_type = pa.list_(pa.struct([
        ("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()),
        ("encoding", pa.string()), ("band", pa.int32()), ("p", pa.float64())]))
    names = ("kind", "start", "stop", "encoding", "band", "p")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for scalar in batch.column(1):
                text = scalar.as_py() or ""
                base = base_spans(text)
                rows = [(*s, None, None, None) for s in base] + candidates(text, base)
                found.append([dict(zip(names, r, strict=True)) for r in rows])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, out_type)], names=["id", "found"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        run, f"id {kind}, found {_FOUND}")


def acceptance_levels(scanned: DataFrame, lost_share: float = 0.05) -> dict[tuple[str, int], float]:
    """Lowest accepted `p` per (encoding, length band), from all candidates of the corpus.

    The largest limit t for which t times all tokens of the cell, the number that random ones alone
    would put below it, is at most `lost_share` of those that are below it.
    """
    counts = (
        scanned.select(F.explode("found").alias("f")).filter("f.kind = 'random'")
        .groupBy("f.encoding", "f.band",
                 F.least(F.floor(F.col("f.p") * BINS), F.lit(BINS - 1)).alias("bin")).count()
    )
    # At most encodings x bands x bins rows.
    table: dict[tuple[str, int], np.ndarray] = {}
    for encoding, band, at, n in counts.collect():
        table.setdefault((encoding, band), np.zeros(BINS))[at] = n
    limits = np.arange(1, BINS + 1) / BINS
    return {key: float(limits[limits * held.sum() <= lost_share * held.cumsum()].max(initial=0.0))
            for key, held in table.items()}


def find_secrets(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    lost_share: float = 0.05,
) -> DataFrame:
    """id and `spans`, an array of (kind, start, stop) in code points, by start and then kind.

    A null or empty text has no spans; null and repeated ids keep their rows; further columns are
    left behind. Texts are scanned whole, once; what was found is stored and read twice.
    """
    scanned = store(scan(docs, id_column, text_column), "secrets")
    levels = acceptance_levels(scanned, lost_share)
    return _accepted(scanned, levels).select(F.col("id").alias(id_column), "spans")


def _accepted(scanned: DataFrame, levels: dict[tuple[str, int], float]) -> DataFrame:
    level = F.create_map(*[F.lit(x) for (e, b), v in levels.items() for x in (f"{e}:{b}", v)]) \
        if levels else None

    def keep(f):
        base = f["kind"] != "random"
        if level is None:
            return base
        key = F.concat_ws(":", f["encoding"], f["band"].cast("string"))
        return base | F.coalesce(f["p"] >= F.try_element_at(level, key), F.lit(False))

    def order(f):
        rank = F.array_position(F.array(*map(F.lit, KINDS)), f["kind"]).cast("int")
        return F.struct(f["start"].alias("start"), rank.alias("rank"), f["stop"].alias("stop"),
                        f["kind"].alias("kind"))

    ordered = F.array_sort(F.transform(F.filter("found", keep), order))
    return scanned.withColumn("spans", F.transform(
        ordered, lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"),
                                    f["stop"].alias("stop"))))


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts per kind, hash of the base spans and all spans as text."""
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        id_column, count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), count("random").alias("n_random"))
