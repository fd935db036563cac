"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from querytrail.llm import (
    chat, graph, lines, mixing, packing, quality, secrets, simhash, substrings, toxicity, vectors,
)

import public_tokenizers

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice(["an", "er", "ti", "on", "re", "th", "ou", "st"]) for _ in range(rng.randint(1, 4)))
             for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words))


LONG = prose(1, 60000)
ROWS = [
    (1, prose(2, 120), "en", "a", 1), (2, prose(2, 120), "en", "a", 1), (3, None, None, None, None),
    (4, "", "en", "a", 0), (5, " \n\t ", "en", "b", 4), (6, LONG, "de", "b", None),
    (7, LONG + " tail", "de", "b", 5), (8, "ha ha", "en", None, 5), (8, "ha ha", "en", None, 5),
    (None, prose(2, 120), "en", "a", 1), (9, prose(3, 300), "xx", "c", 2), (10, "é😀 ñ", "es", "c", 5),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_components_of_chains_hubs_and_nothing(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(1000, 1200)] + [(-5, 1100), (3, 3), (None, 4), (4, None)]
    links = spark.createDataFrame(chain + hub + hub[:3], "a long, b long")
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: -5 for i in (7, -5, *range(1000, 1200))}}
    assert graph.components(links.limit(0)).collect() == []


def test_simhash_edges(docs, none):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows}
    assert got[1] == got[2] and got[1][1] == 1 and got[None][1] == 1
    assert got[3] == got[4] == got[5] == (0, 3)
    assert got[6][1] == got[7][1] == 6 and got[8][1] == 8
    assert simhash.near_duplicates(none).collect() == []


def test_simhash_crowded_posting_gives_the_same_links(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    prints = {centre}
    for _ in range(150):  # far more than LONG_POSTING share their first bytes
        prints.add(rng.choice(sorted(prints)) ^ (1 << rng.randrange(20)) ^ (1 << rng.randrange(20)))
    prints |= {rng.getrandbits(64) for _ in range(30)}
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    links = simhash.link_fingerprints(spark.createDataFrame([(p,) for p in signed], "fingerprint long"))
    got = {r.node: r.component for r in graph.components(links).collect()}
    reach = {p: p for p in signed}
    for _ in signed:
        before = dict(reach)
        for a in signed:
            for b in signed:
                if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                    reach[a] = reach[b] = min(reach[a], reach[b])
        if before == reach:
            break
    assert {p: got.get(p, p) for p in signed} == reach


def test_substring_edges(spark, docs, none):
    extra = docs.withColumn("n_removed", F.lit("old")).withColumn("id", F.lit(0)).withColumn("start", F.lit(1))
    rows = substrings.remove_repeats(extra).collect()
    assert len(rows) == len(ROWS) and "start" in rows[0].asDict()
    got = {r.doc_id: r for r in rows}
    assert got[1].text == ROWS[0][1] and got[2].text == "" and got[None].text == ROWS[0][1]
    assert got[3].text is None and got[4].text == "" and got[5].text == " \n\t "
    assert got[6].text == LONG and len(got[7].text) < 100
    assert [r.text for r in rows if r.doc_id == 8] == ["ha ha", "ha ha"]
    assert substrings.remove_repeats(none).collect() == []


def test_substring_passage_inside_others(spark):
    passage = prose(50, 70)
    rows = [(i, f"{prose(200 + i, 60)}. {passage}. {prose(300 + i, 60)}.") for i in range(6)]
    clean = [(100 + i, prose(400 + i, 150)) for i in range(5)]
    got = {r.doc_id: r.text for r in substrings.remove_repeats(
        spark.createDataFrame(rows + clean, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1] and all(got[i] == t for i, t in clean)
    inner = " ".join(passage.split()[9:60])
    assert all(inner not in got[i] and got[i].startswith(rows[i][1][:100]) for i in range(1, 6))
    assert "".join(substrings.sentences(LONG)) == LONG


def test_chat_edges(spark):
    rows = [
        (1, 0, "user", "a\\</s>\\"), (1, 1, "assistant", "<|end|><|turn|>[INST]"), (1, 1, "assistant", None),
        (2, 5, None, ""), (None, 0, "assistant", "x😀"), (3, 0, "assistant", "y" * 200000),
        *[(4, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(9000)],
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn(
        "part", F.lit(3))
    formatted = chat.format_conversations(turns)
    assert formatted.filter("conv_id = 4").count() == 3
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    import hashlib

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert got[1].turns_sha256 == digest("user\na\\</s>\\\nassistant\n\nassistant\n<|end|><|turn|>[INST]\n")
    assert got[1].loss_sha256 == digest("<|end|><|turn|>[INST]") and got[1].n_turns == 3
    assert (got[2].n_turns, got[2].loss_chars) == (1, 0) and got[None].loss_chars == 2
    assert got[3].loss_sha256 == digest("y" * 200000)
    assert got[4].n_turns == 9000 and got[4].loss_sha256 == digest("".join(f"t{i}" for i in range(0, 9000, 2)))
    assert chat.read_back(chat.format_conversations(turns.limit(0))).collect() == []


def test_secret_edges(spark, none):
    rng = np.random.default_rng(3)
    key = "".join(rng.choice(list(secrets.ALPHABETS["alnum"]), 40))
    rows = [(1, f"see {key} there"), (2, None), (3, ""), (4, "tion" * 12 + "1"), (5, "z1" * 20),
            (6, 'Token: "abc" secret=abcdef12 AKIA' + "Z" * 16 + " " + "0" * 24), (6, "x"), (None, "api_key=abcdefg")]
    rows += [(10 + i, "".join(rng.choice(list(secrets.ALPHABETS["alnum"]), 40))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    got = [(r.doc_id, r.spans) for r in secrets.digest(secrets.find_secrets(docs)).collect()]
    found = dict(got)
    assert len(got) == len(rows) and found[1] == "random:4:44" and found[2] == found[3] == ""
    assert found[4] == found[5] == "" and found[None] == "assign:0:15"
    assert [s.split(":")[0] for s in got[5][1].split(",")] == ["assign", "access", "hex"]
    assert sum(s.startswith("random") for d, s in got if d is not None and d >= 10) >= 17
    assert secrets.find_secrets(none).collect() == []


def test_lone_random_token_among_ordinary_ones(spark):
    """One truly random token per cell beside 1 000 ordinary ones: found in 95 % of the cases."""
    rng = np.random.default_rng(8)
    found = "array<struct<kind:string,encoding:string,band:int,p:double>>"
    letters = {"alnum": 32, "base64": 40, "base32": 32, "lower_alnum": 24, "upper_alnum": 64}
    kept = tried = 0
    for encoding, length in letters.items():
        alphabet = secrets.ALPHABETS[encoding]
        ordinary = [secrets.randomness("".join(rng.choice(list(alphabet[:8]), length)), alphabet) for _ in range(1000)]
        for size in (1, 5):
            drawn = [secrets.randomness("".join(rng.choice(list(alphabet), length)), alphabet) for _ in range(40 * size)]
            cells = [drawn[i:i + size] for i in range(0, len(drawn), size)]
            # The cells of one frame differ in their band; the limits don't know what a band means.
            rows = [(["random", encoding, no, p],) for no, cell in enumerate(cells) for p in cell + ordinary]
            scanned = spark.createDataFrame(
                [([tuple(r[0])],) for r in rows], f"found {found}")
            levels = secrets.acceptance_levels(scanned)
            assert max(levels.values()) <= 0.05 and min(levels.values()) > 0
            kept += sum(p >= levels[encoding, no] for no, cell in enumerate(cells) for p in cell)
            tried += len(drawn)
    assert kept / tried >= 0.95


def test_acceptance_levels_without_ordinary_tokens(spark):
    found = "array<struct<kind:string,encoding:string,band:int,p:double>>"
    cells = [("alnum", 32, p / 100) for p in range(1, 100)] + [("hex", 24, 0.2), ("base32", 20, 0.001)]
    scanned = spark.createDataFrame([([("random", *c)],) for c in cells], f"found {found}")
    levels = secrets.acceptance_levels(scanned)
    assert levels["alnum", 32] == levels["hex", 24] == 0 and 0.001 < levels["base32", 20] <= 0.05


def test_line_edges(spark, none):
    rows = [(i, f"menu \nbody {i}\n\nfoot", "h") for i in range(10)]
    rows += [(20, None, "h"), (21, "", "h"), (22, "foot", "h"), (23, "menu\nfoot", None), (24, "menu\nmenu", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn(
        "n_lines_dropped", F.lit("x")).withColumn("host", F.lit(1)).withColumn("key", F.lit(2))
    got = {r.doc_id: (r.text, r.n_lines_dropped) for r in lines.drop_boilerplate(docs, ratio=0.3).collect()}
    assert got[3] == ("body 3\n", 2) and got[20] == (None, 0) and got[21] == ("", 0)
    assert got[22] == ("", 1) and got[23] == ("menu\nfoot", 0) and got[24] == ("menu\nmenu", 0)
    assert lines.drop_boilerplate(none).collect() == []


def test_line_dedup_of_the_pipeline_keeps_the_text_of_copies(spark):
    rows = [(i, "first line\nsecond line", "h") for i in range(40)]
    rows += [(100 + i, f"menu\nbody {i}", "h") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert {got[i] for i in range(40)} == {"first line\nsecond line"}
    assert all(got[100 + i] == f"body {i}" for i in range(60))


def test_quality_edges(spark, docs, none):
    trusted = spark.createDataFrame([(1,), (9,), (9,), (None,)], "doc_id long")
    rows = quality.apply_rules(docs.withColumn("kept", F.lit("x")).withColumns(
        {c: F.lit(1) for c in ("weights", "words", "buckets", "row", "_words", "total")}), trusted).collect()
    assert all(r.words == r.buckets == r.row == r._words == r.total == r.weights == 1 for r in rows)
    assert len(rows) == len(ROWS)
    got = {r.doc_id: r for r in rows}
    assert (got[3].n_words, got[3].base_failed, got[3].kept) == (0, True, False)
    assert got[1].score == got[2].score and got[6].n_words == 60000 and got[9].kept
    assert quality.apply_rules(none, trusted).collect() == []
    assert all(r.score == 0 for r in quality.apply_rules(docs, trusted.limit(0)).collect())


def test_quality_model_as_array_and_as_table(spark, docs, monkeypatch):
    trusted = spark.createDataFrame([(1,), (9,)], "doc_id long")
    array = sorted(map(repr, quality.apply_rules(docs, trusted).collect()))
    monkeypatch.setattr(quality, "ARRAY_BUCKETS", 1)
    assert sorted(map(repr, quality.apply_rules(docs, trusted).collect())) == array


def test_quality_model_tells_texts_by_whole_words(spark):
    """Junk made of the endings of trusted words, and a vocabulary that one small table can't hold apart."""
    rng = random.Random(11)
    good = [f"{rng.randrange(10 ** 9):09d}ing" for _ in range(20000)]
    junk = [f"{rng.randrange(10 ** 9):09d}ing" for _ in range(300)]
    rows = [(i, " ".join(rng.choices(good, k=300))) for i in range(400)]
    rows += [(1000 + i, " ".join(rng.choices(junk, k=300))) for i in range(40)]
    trusted = spark.createDataFrame([(i,) for i in range(0, 400, 2)], "doc_id long")
    got = {r.doc_id: r.kept for r in quality.apply_rules(
        spark.createDataFrame(rows, "doc_id long, text string"), trusted).collect()}
    assert all(got[i] for i in range(400)) and not any(got[1000 + i] for i in range(40))



def test_mixing_meets_its_targets(spark, docs, none):
    targets = {"source": {"a": 0.5, "b": 0.3, mixing.OTHER: 0.2}, "lang": {"en": 0.6, "de": 0.4}}
    rows = [(i, prose(i, 40), lang, source) for i in range(3000)
            for lang, source in [(["en", "de"][i % 2], ["a", "b", "z"][i % 3])]]
    many = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    classes = {"source": F.col("source"), "lang": F.col("lang")}
    mixed = mixing.mix(many, targets, classes, fraction=0.3, sweeps=30)
    total = mixed.agg(F.sum("tokens")).first()[0]
    for dimension, weights in targets.items():
        held = {r[0]: r[1] for r in mixed.groupBy(f"{dimension}_class").agg(
            F.sum(F.col("tokens") * F.col("probability"))).collect()}
        for name, weight in weights.items():
            assert held[name] / total == pytest.approx(0.3 * weight, rel=1e-4)
    drawn = mixed.filter("sampled").agg(F.sum("tokens")).first()[0]
    assert drawn / total == pytest.approx(0.3, rel=0.1)
    odd = mixing.mix(docs.withColumn("tokens", F.lit("x")), targets, classes).collect()
    assert len(odd) == len(ROWS)
    assert {r.sampled for r in odd if r.lang in (None, "xx", "es")} == {False}  # no target
    assert mixing.mix(none, targets, classes).collect() == []


def test_mixing_draws_unlisted_and_null_classes(spark):
    kinds = [("src1", "en"), ("new", "en"), (None, None), ("src2", "xx"), ("new", "xx")]
    rows = [(i, prose(i, 30), *kinds[i % 5]) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    drawn = corpus_pipeline.mixing_sources(spark, docs, "").collect()
    assert {(r.source, r.lang) for r in drawn} == set(kinds)


def test_toxicity_edges_and_held_out_accuracy(spark, docs, none):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.train(table, labels.filter("doc_id % 3 <> 0"))
    assert list(model.thresholds) == sorted(model.thresholds)
    marks = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id % 3 == 0}
    held = {r.doc_id: r.toxic for r in toxicity.score(table, model).collect() if r.doc_id in marks}
    found = [held[d] for d, m in marks.items() if m == 1]
    wrong = [held[d] for d, m in marks.items() if m == 0]
    assert np.mean(found) > 0.85 and np.mean(wrong) < 0.01
    rows = toxicity.score(docs.withColumn("id", F.lit(1)), model).collect()
    assert len(rows) == len(ROWS) and {r.severity for r in rows if r.doc_id in (3, 4, 5)} == {
        next(r.severity for r in rows if r.doc_id == 3)}
    assert toxicity.score(none, model).collect() == []
    empty = toxicity.train(none, labels.limit(0))
    assert not any(r.toxic for r in toxicity.score(docs, empty).collect())


def brute_links(rows, least=0.93):
    usable = [(i, lab, np.array(v, float)) for i, v, lab in rows
              if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, reach = {i: set() for i, _, _ in rows if i is not None}, {i: i for i, _, _ in rows if i is not None}
    for x, (a, la, u) in enumerate(usable):
        for b, lb, v in usable[x + 1:]:
            if la == lb and a != b and u @ v / np.sqrt((u @ u) * (v @ v)) >= least:
                links[a].add(b)
                links[b].add(a)
    for _ in reach:
        before = dict(reach)
        for a, held in links.items():
            reach[a] = min([reach[a], *(reach[b] for b in held)])
        if reach == before:
            break
    return {i: (len(links[i]), reach[i], reach[i] == i) for i in reach}


@pytest.mark.parametrize("shard_rows", [8192, 60])
def test_vectors_against_all_pairs(spark, shard_rows):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(60, 16))
    rows = []
    for i in range(420):
        v = base[i % 60] + rng.normal(size=16) * (0.16 if i >= 60 else 0)
        rows.append((i, [float(x) for x in v], i % 60 % 3))
    rows += [(900, rows[0][1], 0), (901, rows[0][1], 1), (902, None, 0), (903, [0.0] * 16, 0),
             (904, [float("nan")] * 16, 0), (905, [None] * 16, 0), (906, rows[1][1], None),
             (907, [float("inf")] * 16, 1), (908, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit(1))
    got = vectors.near_duplicate_vectors(frame, shard_rows=shard_rows, block_rows=32, recall=1.0, beam=64).collect()
    want = brute_links(rows)
    assert sum(n for n, _, _ in want.values()) > 500
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want
    assert vectors.near_duplicate_vectors(frame.limit(0)).collect() == []


def test_packing_edges(spark, docs, none):
    rows = packing.pack(docs.withColumn("piece", F.lit("x")), VOCABULARY).collect()
    assert sum(r.piece == 0 for r in rows) == len(ROWS)
    assert all(r.length == 1 for r in rows if r.doc_id in (3, 4, 5))
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in p) <= 2048 for p in places.values())
    assert packing.pack(none, VOCABULARY).collect() == []


def test_dominance_never_costs_a_sequence():
    rng = random.Random(4)

    def fewest(items, capacity):
        best = len(items)

        def place(rest, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if not rest:
                best = len(rooms)
                return
            for room in sorted({r for r in rooms if r >= rest[0]}):
                at = rooms.index(room)
                place(rest[1:], [*rooms[:at], room - rest[0], *rooms[at + 1:]])
            place(rest[1:], [*rooms, capacity - rest[0]])

        place(sorted(items, reverse=True), [])
        return best

    for _ in range(120):
        capacity = rng.choice([10, 17, 30])
        items = [rng.randint(capacity // 5, capacity) for _ in range(rng.randint(1, 8))]
        counts = {i: items.count(i) for i in items}
        fixed, rest = packing.reduce_by_dominance(counts, capacity)
        left = [i for i, n in rest.items() for _ in range(n)]
        used = [i for p, n in fixed for i in p for _ in range(n)]
        assert sorted(used + left) == sorted(items) and all(sum(p) <= capacity for p, _ in fixed)
        assert sum(n for _, n in fixed) + fewest(left, capacity) == fewest(items, capacity)


def test_words_alone_give_the_ids_of_the_text():
    words = packing._Words(VOCABULARY)
    texts = ["It's ÉTÉ, été… naïve!! a_b 3.14 <|endoftext|> x<|endoftext|>y", "́a é İstanbul ΣΑΣ ß",
             "a\x1cb c d\x85e", "", "don't 'tis 中文 ﬁ 😀😀 --- \"q\" `x`", prose(9, 500), "he'll've O'Neil's"]
    for text in texts:
        whole = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.document(text), "<u4").tolist() == [*whole, 0]


def test_pipeline_stages_take_edge_rows(spark, docs, none, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs, none):
            result = stage(spark, table, str(tmp_path))
            assert result.columns == docs.columns
            result.collect()
    kept = corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id for r in kept), key=repr) == sorted([1, 3, 6, 8, 8, 9, 10, None], key=repr)
