"""The pipeline's stages, one after the other, against plain restatements of their rules."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as cp
from querytrail.llm import mixing

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows of the documents and of each stage's result."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = [docs.collect()]
    for no, (_, stage) in enumerate(cp.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(no))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        held.append(docs.collect())
    return held


def ngrams(text, buckets):
    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORDS.findall(text or "")]
    pairs = [xxhash.xxh64_intdigest(struct.pack("<Q", b), xxhash.xxh64_intdigest(struct.pack("<Q", a), 42))
             for a, b in zip(words, words[1:], strict=False)]
    return [("word", h % buckets) for h in words] + [("pair", h % (buckets // 2)) for h in pairs]


def test_quality_rules(spark, steps):
    trusted = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 1}
    every, good = Counter(), Counter()
    buckets = 1 << int(math.log2(sum(len(r.text or "") for r in steps[0]) / 192))
    for r in steps[0]:
        grams = ngrams(r.text, buckets)
        every.update(grams)
        if r.doc_id in trusted:
            good.update(grams)
    share = sum(good.values()) / sum(every.values())
    kept = set()
    for r in steps[0]:
        words, grams = WORDS.findall(r.text or ""), ngrams(r.text, buckets)
        at = defaultdict(list)
        for i in range(len(words) - 7):
            at[tuple(words[i:i + 8])].append(i)
        repeated = {i + j for p in at.values() if len(p) > 1 for i in p for j in range(8)}
        score = sum(math.log(good[g] + 1) - math.log(every[g] * share + 1) for g in grams) / max(1, len(grams))
        if len(words) >= 20 and 100 * len(repeated) <= 30 * len(words) and score >= -0.2:
            kept.add(r.doc_id)
    assert {r.doc_id for r in steps[1]} == kept and 0 < len(kept) < len(steps[0])


def test_line_dedup(steps):
    pages, seen = Counter(r.source for r in steps[1]), Counter()
    for r in steps[1]:
        seen.update({(r.source, x.strip(" ")) for x in r.text.split("\n") if x.strip(" ")})
    common = {k for k, n in seen.items() if n >= 5 and n > 0.02 * pages[k[0]]}
    want = {r.doc_id: "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" ")) not in common)
            for r in steps[1]}
    assert {r.doc_id: r.text for r in steps[2]} == want
    assert all(r.n_chars == len(r.text) for r in steps[2])


def fingerprint(text):
    words = [w.encode() for w in WORDS.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))]
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def kept_of_groups(rows):
    """Ids that are the smallest of their component, all pairs of fingerprints compared."""
    ids = defaultdict(list)
    for doc_id, text in rows:
        ids[fingerprint(text)].append(doc_id)
    kept, left = set(), set(ids)
    while left:
        group, fresh = [], [left.pop()]
        while fresh:
            at = fresh.pop()
            group.append(at)
            near = {p for p in left if (p ^ at).bit_count() <= 2}
            left -= near
            fresh += near
        kept.add(min(i for p in group for i in ids[p]))
    return kept


def test_near_dedup(steps):
    kept = kept_of_groups([(r.doc_id, r.text) for r in steps[2]])
    assert {r.doc_id for r in steps[3]} == kept and len(kept) < len(steps[2])


def test_near_dedup_of_a_large_group(spark):
    """2 000 texts that differ from one other in one word, each a near copy of some but not of all."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(700)]
    rows = [(i, " ".join(words[:at] + [f"x{i}"] + words[at + 1:]))
            for i in range(2000) for at in [rng.randrange(700)]]
    rows += [(9000 + i, " ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(60))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_copy", F.lit(1))
    got = cp.near_dedup(spark, docs, SF)
    assert got.columns == docs.columns
    kept = kept_of_groups(rows)
    assert {r.doc_id for r in got.collect()} == kept and len(kept) < 1000


def test_mixing(steps):
    def topic(text):
        if any(x in text for x in ("icense", "ights reserved", "opyright")):
            return "legal"
        return "technical" if any(x in text for x in ("http", "@", "=")) else "general"

    cells, of = Counter(), {}
    for r in steps[3]:
        values = (r.source, r.lang, topic(r.text))
        cell = tuple(v if v in t else "*" for v, t in zip(values, mixing.TARGETS.values(), strict=True))
        of[r.doc_id] = cell
        cells[cell] += max(1, len(WORDS.findall(r.text)))
    total = sum(cells.values())
    share = {c: n / total for c, n in cells.items()}
    most = {c: s / 0.8 for c, s in share.items()}
    for _ in range(12):
        for d, targets in enumerate(mixing.TARGETS.values()):
            present = {c[d] for c in cells}
            whole = sum(w for name, w in targets.items() if name in present)
            held = Counter()
            for c, s in share.items():
                held[c[d]] += s
            share = {c: s * targets.get(c[d], 0) / whole / held[c[d]] if held[c[d]] else 0 for c, s in share.items()}
        share = {c: min(s, most[c]) for c, s in share.items()}
    rate = {c: min(1, s * 0.8 * total / cells[c]) for c, s in share.items()}
    drawn = {d for d, c in of.items()
             if int(hashlib.md5(f"mix:{d}".encode()).hexdigest()[:13], 16) / (1 << 52) < round(rate[c], 9)}
    assert {r.doc_id for r in steps[4]} == drawn and drawn


def test_packing(steps):
    assert {r.doc_id for r in steps[5]} == {r.doc_id for r in steps[4]}
    places = defaultdict(list)
    for r in steps[5]:
        places[r.sequence_id].append((r.offset, r.length))
    for placed in places.values():
        ends = [0]
        for offset, length in sorted(placed):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048
    assert len(places) <= -(-sum(r.length for r in steps[5]) // 2048) + 2


def test_run_chains_the_stages(spark, steps):
    got = cp.run(spark, SF)
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in got.collect()} == {
        (r.doc_id, r.piece, r.ids_crc32) for r in steps[5]}
    assert [c for c, _ in got.dtypes] == list(steps[5][0].asDict())
    assert cp.pipeline(spark, SF).agg(F.count("*")).first()[0] == len(steps[5])
