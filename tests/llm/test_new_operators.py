"""Alignment of tokenizers, benchmark passages and spelling variants against brute force, with odd input."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from querytrail.llm import alignment, contamination, queries, spelling

SF = "/root/testdata/sf0.001"
VOCABULARIES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


# Alignment


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(VOCABULARIES[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=VOCABULARIES[1])


def _byte_of():
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


BYTE_OF = _byte_of()


def whole_text(tokenizers, text):
    """Tokens of both sides of the whole text: (id, byte end), or none."""
    a, b = tokenizers
    if not text:
        return None
    encoded = a.encode(" " + text, add_special_tokens=False)
    tokens_a = [(i, bytes(BYTE_OF[c] for c in t)) for i, t in zip(encoded.ids, encoded.tokens, strict=True)]
    tokens_b = []
    for i in b.encode(text):
        name = b.id_to_piece(i)
        tokens_b.append((i, bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()))
    sides = []
    for tokens in (tokens_a, tokens_b):
        if b"".join(t for _, t in tokens) != (" " + text).encode():
            return None
        at, side = 0, []
        for i, t in tokens:
            at += len(t)
            side.append((i, at))
        sides.append(side)
    return sides


def expected_alignment(tokenizers, rows):
    found, counts = [], Counter()
    for doc_id, text in rows:
        sides = whole_text(tokenizers, text)
        if sides is None:
            found.append((doc_id, 0, 0, 0, "", []))
            continue
        one, two = sides
        both = {end for _, end in one} & {end for _, end in two}
        groups, last = [], 0
        for end in sorted(both):
            held = [",".join(str(i) for i, e in side if last < e <= end) for side in sides]
            groups.append("|".join(held))
            last = end
        ends = dict((end, i) for i, end in two)
        links = [(i, ends[end]) for i, end in one if end in both]
        counts.update(links)
        found.append((doc_id, len(one), len(two), len(groups), ";".join(groups), links))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (doc_id, n_a, n_b, n_groups, len(links), sum(counts[x] == best[x[1]] for x in links),
         sum(counts[x] for x in links), hashlib.sha256(groups.encode()).hexdigest() if n_a else "")
        for doc_id, n_a, n_b, n_groups, groups, links in found]


ODD = [
    (1, "aé日\U0001F600𝄞 x  y\n\t z "), (2, "literal ▁ mark"), (3, None), (4, ""), (5, " "), (6, "  \n "),
    (7, "<s>[INST] hi </s> <|endoftext|> <unk> <0x0A>"), (8, "don't  I'll we 've 12,345.67"),
    (9, "नमस्ते दुनिया 🏳️‍🌈 end"), (10, "é ́ ﻿ x\x00y \x1c z\x1d w"), (7, "<s>[INST] hi </s>"),
    (None, "no id"), (11, "ünïcödé   ...   !!!  ???\r\n\r\n  tail  "), (12, "a" * 5000 + " " + "é" * 500),
    (13, "same same same same"), (13, "same same same same"), (14, "𝄞 𝄞𝄞 日本語テキスト 中文"),
]


def _aligned(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = alignment.rate_links(alignment.align(docs, *VOCABULARIES)).collect()
    return sorted(
        ((r.id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
          hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") for r in got), key=repr)


def test_alignment_of_odd_texts(spark, tokenizers):
    assert _aligned(spark, ODD) == sorted(expected_alignment(tokenizers, ODD), key=repr)
    assert _aligned(spark, [(1, None), (2, "")]) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    assert alignment.rate_links(alignment.align(spark.createDataFrame([], SCHEMA), *VOCABULARIES)).collect() == []


def test_alignment_cut_into_stretches_is_that_of_whole_texts(tokenizers, monkeypatch):
    """Random texts of awkward characters, in small segments, rows and groups."""
    rng = random.Random(3)
    signs = [" ", " ", "  ", "\n", "\t", " ", "　", "\x1c", "a", "b", "the", "é", "日", "😀", "'s", "!", "12", "_"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(400)] + ["x ▁ y", ""]
    monkeypatch.setattr(alignment, "AT_ONCE", 40)
    aligner = alignment._Aligner(*VOCABULARIES)
    for together in (1 << 22, 50):
        monkeypatch.setattr(alignment, "TOGETHER", together)
        got = [part for rows in alignment._rows(aligner, pa.array(texts)) for part in rows]
        want = expected_alignment(tokenizers, list(enumerate(texts)))
        assert [(p[0], p[1], p[2], hashlib.sha256(p[3].encode()).hexdigest() if p[3] else "") for p in got] == [
            (w[1], w[2], w[3], w[7]) for w in want]
        assert [int(p[5].sum()) for p in got] == [w[4] for w in want]


def test_rare_links_take_the_shuffled_path(spark, tokenizers, monkeypatch):
    monkeypatch.setattr(alignment, "FREQUENT", 5)
    assert _aligned(spark, ODD) == sorted(expected_alignment(tokenizers, ODD), key=repr)


def test_op11_on_the_whole_table(spark, documents, tokenizers):
    got = sorted(tuple(r) for r in queries.op11_tokenizer_alignment(spark, SF).collect())
    assert got == sorted(expected_alignment(tokenizers, documents))


# Benchmark passages


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def expected_passages(rows, items):
    held = [(i, words_of(t)) for i, t in items]
    found = []
    for doc_id, text in rows:
        words, hit, ids = words_of(text), set(), set()
        for item, said in held:
            n = min(10, len(said))
            windows = {tuple(said[k:k + n]) for k in range(len(said) - n + 1)} if n else set()
            for at in range(len(words) - n + 1) if n else ():
                if tuple(words[at:at + n]) in windows:
                    hit |= set(range(at, at + n))
                    ids |= {str(item)} if item is not None else set()
        found.append((doc_id, len(words), len(hit), len(ids),
                      hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(found, key=repr)


def test_passages_of_every_length_and_place(spark, monkeypatch):
    rng = random.Random(11)
    said = [rng.choice("the of a to in Señor 日本 7up x".split()) for _ in range(30)]
    items = [(i, " ".join(rng.choice(said) for _ in range(n))) for i, n in enumerate([0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 25, 60])]
    items += [(100, None), (101, " \n--"), (None, "zz yy xx ww"), (12, "another text of item twelve"), (7, items[10][1]),
              (102, items[12][1]), (103, "ha " * 40)]
    rows = [(n, " ".join(rng.choice(said + ["other"]) for _ in range(n))) for n in range(1, 40)]
    for no in range(60):
        item = rng.choice([t for _, t in items if t]).split()
        a = rng.randrange(len(item)) if item else 0
        part = item[a:a + rng.randint(1, 20)]
        around = [f"w{rng.randrange(50)}" for _ in range(rng.randint(0, 60))]
        at = rng.randint(0, len(around))
        rows.append((1000 + no, ", ".join([*around[:at], *(w.upper() if rng.random() < 0.3 else w for w in part), *around[at:]])))
    rows += [(1, None), (2, ""), (3, "!!"), (None, "ZZ yy--xx ww"), (4, "ha " * 300), (4, "ha " * 300), (4, "HA " * 300)]
    docs, benchmark = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    want = expected_passages(rows, items)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    for block in (1 << 15, 16):  # texts in many blocks give the same
        monkeypatch.setattr(contamination, "BLOCK", block)
        got = contamination.mark_contaminated(docs, benchmark).select(*columns).collect()
        assert sorted((tuple(r) for r in got), key=repr) == want


def test_every_shared_window_has_a_shared_fingerprint(spark):
    """Winnowing's guarantee: whatever stands around a window, it leaves the same fingerprint."""
    rng = random.Random(2)
    shared = [f"s{i}" for i in range(10)]
    rows = [(i, " ".join([f"a{rng.randrange(9)}" for _ in range(rng.randint(0, 9))] + shared
                         + [f"b{rng.randrange(9)}" for _ in range(rng.randint(0, 9))])) for i in range(100)]
    texts = spark.createDataFrame(rows, "k1 long, text string").selectExpr("k1", "k1 as k2", "text")
    prints = contamination.fingerprints(contamination._blocks(texts, 10), 10)
    alone = texts.limit(1).selectExpr("-1L as k1", "-1L as k2", f"'{' '.join(shared)}' as text")
    own = [r.print for r in contamination.fingerprints(contamination._blocks(alone, 10), 10).collect()]
    assert len(own) == 1 and prints.filter(prints["print"] == own[0]).select("k1").distinct().count() == 100


def test_passages_edges(spark):
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    rows = spark.createDataFrame(
        [(1, "One, two; three", 5, 6, "x")], "doc_id long, text string, k1 long, n_hit long, w1 string")
    got = contamination.mark_contaminated(rows, items).collect()
    assert [(r.doc_id, r.text, r.k1, r.w1, r.n_hit) for r in got] == [(1, "One, two; three", 5, "x", 3)]
    assert contamination.mark_contaminated(rows.limit(0), items).collect() == []
    clean = contamination.mark_contaminated(rows, items.limit(0)).collect()
    assert [(r.n_words, r.n_hit, r.n_items, r.contaminated) for r in clean] == [(3, 0, 0, False)]
    assert clean[0].items_sha256 == hashlib.sha256(b"").hexdigest()


def test_op12_has_no_python_in_its_plan(spark, capsys):
    queries.op12_benchmark_decontamination(spark, SF).explain()
    shown = capsys.readouterr().out
    assert "Python" not in shown and "Arrow" not in shown


# Spelling variants


def near_words(words):
    """Pairs one edit apart, from all deletions of one code point and all places of a replacement."""
    held = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            held[w[:i] + w[i + 1:]].add(w)
            held[i, w[:i] + w[i + 1:]].add(w)
    near = {}
    for w in words:
        found = set(held.get(w, ()))
        for i in range(len(w)):
            found |= held[i, w[:i] + w[i + 1:]] | ({w[:i] + w[i + 1:]} & words.keys())
        near[w] = found - {w}
    return near


def expected_variants(words):
    near, form = near_words(words), {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= 10 * words[w]:
                form[w] = best
    rows = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(rows)


def slipped(rows):
    counts = Counter()
    for doc_id, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_op13_on_the_whole_table(spark):
    folder = SF.replace("0.001", "0.01")
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in queries.op13_spelling_variants(spark, folder).collect())
    want = expected_variants(slipped(rows))
    assert any(w[1] for w in want) and got == want


def test_variants_of_dense_words(spark):
    """Words over two letters, where nearly every pair of chunks meets, and chains of forms."""
    rng = random.Random(8)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 11))): rng.randint(1, 3000) for _ in range(900)}
    words |= {"vielleicht": 1_000_000, "viellleicht": 90_000, "viellleichtt": 800, "viellleixhtt": 7, "ähnlich": 4, "ähnlicä": 40}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = sorted(tuple(r) for r in spelling.group_variants(frame).collect())
    want = expected_variants(words)
    assert got == want and ("viellleixhtt", "viellleichtt", "vielleicht", 7, 1, 800) in got


def test_word_counts_edges(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 3)
    rows = [(1, "Straße straße STRASSE"), (1, "Straße straße STRASSE"), (2, None), (3, ""), (None, "ÀÉÎÕÜØß àéîõüøß ×÷×÷×÷×"),
            (4, "abcdefg abcdefg-abcdefg abcdef abcdefghĀabcdefgh " * 3)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", word string, n int")
    for listed in (1 << 20, 10):
        monkeypatch.setattr(spelling, "LISTED", listed)
        got = {r.word: r.n for r in spelling.word_counts(docs).collect()}
        assert got == {"abcdefg": 9, "abcdefgh": 6, "strasse": 2}
    once = spelling.word_counts(docs, least_count=1)
    assert {r.word for r in once.collect()} == {"abcdefg", "abcdefgh", "strasse", "ÀÉÎÕÜØß", "àéîõüøß", "×÷×÷×÷×"}
    assert spelling.spelling_variants(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        spelling.group_variants(once, dominance=1)
