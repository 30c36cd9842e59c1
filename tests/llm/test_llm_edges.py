"""NULLs, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from wardgrid.llm import chat, decontaminate, kneser_ney, license_scan, line_dedup, ngram_join, packing, quality_cnn, quality_rules, url_filters
from wardgrid.llm.queries import VOCABULARY

rng = random.Random(5)
VOCAB = ["".join(rng.choice("abcdeio") for _ in range(rng.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return "\n".join(" ".join(r.choice(VOCAB) for _ in range(min(12, n - k))) for k in range(0, n, 12))


CLASH = ["_key", "_c", "_kept", "_d", "_t", "removed", "class_id", "a.b", "_doc", "_text", "host"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASH)


def make(spark, rows):
    extra = ["x"] * len(CLASH)
    return spark.createDataFrame([(i, t, *(r[0] if r else [None, None]), None, *extra) for i, t, *r in rows], SCHEMA)


BASE = prose(120, 1)
ROWS = [
    (1, BASE, "en", "s"), (2, BASE, "en", "s"), (2, BASE, "en", "s"), (3, BASE + " more", None, "s"), (4, None, "en", None), (5, "", None, None),
    (6, " \n\t", "en", "s"), (None, prose(60, 2), "en", "s"), (None, None, None, None), (7, "one two", "en", "s"), (7, prose(70, 3), "en", "s"),
    (8, "é" * 5000 + " " + "x" * 9000, "en", "s"), (9, prose(30_000, 4), "en", "s"), (10, prose(60, 2), "de", "s"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return make(spark, [(i, t, [lang, s]) for i, t, lang, s in ROWS]).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return make(spark, [])


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda i: (i is None, i or 0))


def test_quality_rules(docs, none):
    kept = quality_rules.filter_quality(docs)
    assert kept.columns == docs.columns
    assert ids(kept) == [1, 2, 2, 3, 7, 9, 10, None]
    assert quality_rules.filter_quality(none).count() == 0
    m = {(r.doc_id, r.text): r for r in quality_rules.measure(docs.drop("a.b", *CLASH)).collect()}
    assert m[4, None]._n_words == 0 and m[4, None]._base_failed and m[6, " \n\t"]._n_lines == 0


def test_thresholds_adapt_and_small_groups_use_their_language(spark):
    r = random.Random(3)
    rows = []
    for k in range(300):
        source = "symbols" if k < 150 else "plain"
        w = [r.choice(VOCAB) + ("#" if source == "symbols" and i % 3 == 0 else "") for i in range(80)]
        rows.append((k, " ".join(w), "en", source))
    rows += [(900, " ".join(r.choice(VOCAB) + "#" * (i % 3 == 0) for i in range(80)), "en", "plain")]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    kept = {x.doc_id for x in quality_rules.filter_quality(df).collect()}
    assert 900 not in kept and len([i for i in kept if i < 150]) == 150 and len(kept) == 300


def test_line_dedup(docs, none, spark):
    out = line_dedup.dedup_lines(docs, removed="removed")
    assert out.columns[:5] == docs.columns[:5] and out.count() == len(ROWS)
    plain = [(i, t) for i, t, *_ in ROWS]
    order = sorted(set(plain), key=lambda p: (p[0] is not None, p[0] or 0))
    hashed = spark.createDataFrame([(t,) for _, t in order], "t string").select(F.xxhash64("t")).collect()
    order = [p for p, h in sorted(zip(order, hashed, strict=True), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1][0]))]
    want = dict(zip(order, [t for _, t in brute.without_repeats(order)], strict=True))
    got = sorted((repr((r.doc_id, r.text)) for r in out.select("doc_id", "text").collect()))
    assert got == sorted(repr((i, want[i, t])) for i, t in plain)
    assert line_dedup.dedup_lines(none).count() == 0


def test_line_dedup_random_runs(spark):
    r = random.Random(11)
    lines = [" ".join(r.choice(VOCAB) for _ in range(r.randint(1, 30))) for _ in range(40)] + ["", " "]
    rows = []
    for k in range(60):
        parts = []
        for _ in range(r.randint(1, 5)):
            a = r.randrange(len(lines))
            parts += lines[a : a + r.randint(1, 8)]
        rows.append((k, "\n".join(parts)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {x.doc_id: x.text for x in line_dedup.dedup_lines(df).collect()}
    assert got == dict(brute.without_repeats(rows))


def test_line_dedup_cuts_are_bounded_by_the_text(spark):
    lines = [" ".join(f"{w}{k}" for w in VOCAB[:12]) for k in range(8)]
    rows = [(1, "\n".join(lines)), *[(None, "\n".join(["own line", *lines]))] * 200, *[(7, "\n".join(lines[:7]))] * 50]
    df = spark.createDataFrame(rows[1:], "doc_id bigint, text string").unionByName(spark.createDataFrame(rows[:1], "doc_id bigint, text string"))
    found = line_dedup.cuts(df).collect()
    assert found and all(0 < len(r._firsts) == len(r._lasts) <= 18 for r in found)
    got = sorted((x.doc_id or 0, x.text) for x in line_dedup.dedup_lines(df).collect())
    # A missing id comes first, so its text is the original.
    assert got == sorted([(0, rows[1][1])] * 200 + [(1, "")] + [(7, "")] * 50)


def test_ngram_join(docs, none):
    got = ngram_join.join_documents(docs)
    named = {(r.doc_id, r.n_shingles): r.component_id for r in got.collect()}
    assert got.count() == len(ROWS)
    assert named[2, len(brute.shingles(BASE, 4))] == 1 and named[3, len(brute.shingles(BASE + " more", 4))] == 1
    assert named[4, 0] == 4 and named[7, 1] == 7 and named[None, len(brute.shingles(prose(60, 2), 4))] == 10
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns and ids(kept) == [1, 4, 5, 6, 7, 7, 8, 9, 10, None]
    assert ngram_join.keep_one(none).count() == 0 and ngram_join.join_documents(none).count() == 0


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (2, 60)])
def test_ngram_join_finds_every_link(spark, monkeypatch, size, percent):
    monkeypatch.setattr(ngram_join, "LEAF_SHINGLES", 900)  # families are split into several leaves
    monkeypatch.setattr(ngram_join, "LEAF_POINTS", 900)
    monkeypatch.setattr(ngram_join, "BOX", 3)
    r = random.Random(percent)
    texts = {}
    for family in range(14):
        base = [r.choice(VOCAB) for _ in range(r.choice([3, 8, 25, 60, 150, 400]))]
        for _ in range(r.randint(1, 14)):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 40))):
                w[r.randrange(len(w))] = r.choice(VOCAB)
            texts[len(texts)] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {x.doc_id: x.component_id for x in ngram_join.join_documents(df, size, percent).collect()}
    assert got == brute.components(texts, size, percent)


@pytest.mark.parametrize("size,percent", [(4, 85), (2, 60)])
def test_ngram_links_are_all_given(spark, monkeypatch, size, percent):
    monkeypatch.setattr(ngram_join, "LEAF_SHINGLES", 900)
    monkeypatch.setattr(ngram_join, "LEAF_POINTS", 900)
    r, texts = random.Random(percent), {}
    for length in (25, 60, 150, 200, 300, 400):
        base = [r.choice(VOCAB) for _ in range(length)]
        for k in range(12):
            w = list(base)
            w[r.randrange(len(w))] = w[0] if k < 3 else r.choice(VOCAB)
            texts[len(texts)] = " ".join(w)
    texts |= {100: texts[0], 101: ""}
    pairs, rows = ngram_join.link_classes(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), size, percent)
    of = {x.doc_id: x.class_id for x in rows.collect()}
    sets = {i: brute.shingles(t, size) for i, t in texts.items()}
    linked = {(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    want = {tuple(sorted((of[a], of[b]))) for a, b in linked if of[a] != of[b]}
    got = [(x.class_a, x.class_b) for x in pairs.collect()]
    assert set(got) == want and len(got) == len(want) > len(set(of.values()))


def test_block_keys_meet_for_every_linked_pair():
    import numpy as np

    r = np.random.default_rng(1)
    for _ in range(400):
        n = int(r.integers(1, 300))
        base = r.integers(0, 2**63, n).astype(np.uint64)
        drop, add = (int(r.integers(0, 1 + n // 12)) for _ in range(2))
        a, b = np.unique(base), np.unique(np.concatenate([base[drop:], r.integers(0, 2**63, add).astype(np.uint64)]))
        if len(a) and len(b) and not np.array_equal(a, b) and ngram_join.linked(a, b, 85):
            assert set(ngram_join.block_keys(a, 85).tolist()) & set(ngram_join.block_keys(b, 85).tolist())


def test_decontamination(docs, none, spark):
    items = spark.createDataFrame(
        [(1, " ".join(brute.words(BASE)[10:40]), "x"), (1, None, "x"), (2, "too short", "x"), (3, prose(40, 99), "x"), (None, "", "x"),
         (4, " ".join(brute.words(prose(30_000, 4))[5000:5040]).upper(), "x"), (4, " ".join(brute.words(prose(30_000, 4))[5000:5040]).upper(), "x")],
        "item_id bigint, text string, _item string",
    )
    found = decontaminate.find_leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 1), (3, 1), (9, 4)}
    left = decontaminate.decontaminate(docs, items)
    assert left.columns == docs.columns and ids(left) == [4, 5, 6, 7, 7, 8, 10, None, None]
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == len(ROWS)
    assert decontaminate.decontaminate(none, items).count() == 0


def test_decontamination_threshold(spark):
    r = random.Random(8)
    items = [(k, " ".join(r.choice(VOCAB) for _ in range(r.randint(5, 60)))) for k in range(25)]
    docs = []
    for k in range(60):
        w = brute.words(items[k % 25][1])
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = "changed"
        docs.append((k, prose(200, k) + " " + " ".join(w) + " " + prose(100, k + 500)))
    frames = [spark.createDataFrame(x, f"{n} bigint, text string") for x, n in ((docs, "doc_id"), (items, "item_id"))]
    got = {(x.doc_id, x.item_id): x.n_shared for x in decontaminate.find_leaks(*frames).collect()}
    assert got == brute.leaks(docs, items)


def test_packing(docs, none):
    packed = packing.pack(docs, VOCABULARY, with_ids=True)
    rows = packed.collect()
    empty = [r for r in rows if r.doc_id in (4, 5, 6)]
    assert all((r.length, r.start, list(r.ids)) == (1, 0, [1]) for r in empty) and len(empty) == 3
    assert sum(r.doc_id == 2 for r in rows) == 2 and any(r.piece > 5 for r in rows if r.doc_id == 9)
    whole = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in whole) == sum(r.length for r in rows) and max(len(r.ids) for r in whole) <= 4096
    assert packing.pack(none, VOCABULARY).count() == 0


def test_packing_ids_are_those_of_the_tokenizer():
    import pyarrow as pa
    from tokenizers import Tokenizer

    texts = ["end<|endoftext|>next", "A<|startoftext|>b <|endoftext|>", "x<|<|endoftext|>|>Y", "end<|ENDOFTEXT|>next", "<|EndOfText|>!", "<|endoftext", "|>",
             "H\u0331 t\u0308 W\u030a, y\u030aJ\u030c", "I\u0307A=\u0338b", "IT'S it's'd!", "a<|endoftext|><|STARTOFTEXT|>.B"]
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", "H", "\u0331", "t", "\u0308", "W", "J\u030c", "'s", "'", "!", " ", "7", "\u00e9", "\n", "=\u0338"]
    draw = random.Random(3)
    texts += ["".join(draw.choice(parts) for _ in range(draw.randint(1, 12))) for _ in range(3000)]
    whole = Tokenizer.from_file(VOCABULARY)
    encode, added = packing.word_tokenizer(VOCABULARY)
    got = [x.tolist() for x in packing.token_ids(pa.array(texts), encode, added, {})]
    for text, ids in zip(texts, got, strict=True):
        assert ids == whole.encode(text, add_special_tokens=False).ids, text


def test_packing_plan_is_sound():
    r = random.Random(2)
    for _ in range(40):
        capacity = r.randint(1, 40)
        counts = {r.randint(1, capacity): r.randint(1, 50) for _ in range(r.randint(1, 12))}
        taken, placed = {}, {}
        for length, rank, n, first, at in packing.plan(counts, capacity):
            for k in range(n):
                taken.setdefault(first + k, []).append((at, length))
                placed.setdefault(length, []).append(rank + k)
        assert {length: sorted(x) for length, x in placed.items()} == {length: list(range(n)) for length, n in counts.items()}
        for parts in taken.values():
            end = 0
            for at, length in sorted(parts):
                assert at == end
                end += length
            assert end <= capacity


def test_kneser_ney(docs, none, spark):
    plain = docs.select("doc_id", "text")
    model = brute.KneserNey([t for _, t, *_ in ROWS])
    scored = kneser_ney.score(docs, kneser_ney.train(plain, shards=3)).collect()
    assert len(scored) == len(ROWS)
    for want, got in zip(sorted(model.score(t) for _, t, *_ in ROWS), sorted(r.score for r in scored), strict=True):
        assert got == pytest.approx(want, rel=1e-9)
    folder = kneser_ney.train(none, shards=2)
    assert kneser_ney.score(none, folder).count() == 0
    assert all(r.n_known == 0 and r.score <= 0 for r in kneser_ney.score(docs, folder).collect())


def test_license_scan(docs, none, spark):
    mit = " ".join(license_scan.TEMPLATES["MIT"].split())
    changed = mit.replace("free of charge", "gratis").replace("merge, ", "")
    rows = [(1, "é über\n# " + mit), (2, "x " * 50 + changed + " y"), (3, " ".join(mit.split()[:30])), (4, None), (5, ""), (6, "All rights reserved. " * 3), (6, "All rights reserved. " * 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("license", F.lit("mine"))
    found = license_scan.scan(df).collect()
    one = [r for r in found if r.doc_id == 1]
    assert len(one) == 1 and one[0].license == "MIT" and rows[0][1][one[0].start : one[0].end] == mit.rstrip(".")
    assert [(r.license, 0.9 < r.coverage < 1) for r in found if r.doc_id == 2] == [("MIT", True)]
    assert not [r for r in found if r.doc_id in (3, 4, 5)]
    assert sum(r.doc_id == 6 for r in found) == 6
    assert license_scan.scan(docs).count() == 0 and license_scan.scan(none).count() == 0
    assert license_scan.scan(df, {}).count() == 0


def test_license_scan_over_wide_edits(spark):
    words = [f"w{k}" for k in range(100)]
    templates = {"notice": " ".join(words), "one": "copyleft", "two": "public domain"}
    other = [f"x{k}" for k in range(2000)]
    rows = [
        ["y", *words[:50], *other[:9], *words[50:], "z"],  # a sentence added
        [*words[:15], *other[:16], *words[31:]],  # 84 % in two pieces
        [*words[:50], *other, *words[50:]],
        [*words[:90], *words[10:]],  # two copies, each with a part missing
        [*words[:40], *other[:500], *words[70:]],  # 70 % only
        [*words[:30], *other[:20], "copyleft", *other[20:40], "public", "domain", *words[30:]],
        [*[w for k, w in enumerate(words) if k % 7], "Public-Domain", "copyleft", "public"],  # single words missing
        [*words[:5], *other[:9], *words[14:60], "v", *words[61:62], "v", *words[63:]],
    ]
    df = spark.createDataFrame([(k, " ".join(r)) for k, r in enumerate(rows)], "doc_id bigint, text string")
    found = {}
    for r in license_scan.scan(df, templates).collect():
        found.setdefault(r.doc_id, []).append((r.license, r.matched_words, " ".join(rows[r.doc_id])[r.start : r.end].split(" ")[0]))
    want = {
        0: [("notice", 100, "w0")], 1: [("notice", 84, "w0")], 2: [("notice", 100, "w0")], 3: [("notice", 90, "w0"), ("notice", 90, "w10")],
        5: [("notice", 100, "w0"), ("one", 1, "copyleft"), ("two", 2, "public")], 6: [("notice", 85, "w1"), ("one", 1, "copyleft"), ("two", 2, "Public-Domain")], 7: [("notice", 89, "w0")],
    }
    assert {k: sorted(v) for k, v in found.items()} == want


def test_classifier(docs, none, spark):
    labels = spark.createDataFrame([(1, 1), (9, 0), (4, 0), (None, 1), (3, None), (1, 1)], "doc_id bigint, quality int")
    net = quality_cnn.train(docs, labels, steps=3)
    scored = quality_cnn.score(docs, net).collect()
    assert len(scored) == len(ROWS) and all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if r.doc_id in (4, 5)}) == 1
    assert quality_cnn.score(none, net).count() == 0
    lone = quality_cnn.train(docs, labels.where("quality = 1"), steps=3)
    assert all(r.score > 0.99 for r in quality_cnn.score(docs, lone).collect())
    assert all(r.score == pytest.approx(0.5) for r in quality_cnn.score(docs, quality_cnn.train(docs, labels.limit(0))).collect())


def test_classifier_covers_the_whole_document():
    import numpy as np
    import pyarrow as pa

    net = quality_cnn.start_network()
    bounds, data = np.array([0, 5000]), np.random.default_rng(0).integers(32, 127, 5000).astype(np.uint8)
    values, before = quality_cnn.cells_of(data, bounds)
    start, end, _ = quality_cnn.chunk_borders(before)
    assert start[0] == 0 and end[-1] == before[-1] and (start[1:] < end[:-1]).all()
    long = data.tobytes().decode() * 400
    alone, among = quality_cnn.score_texts(net, pa.array([long]))[0], quality_cnn.score_texts(net, pa.array(["a", long, "b", None]))
    assert among[1] == pytest.approx(alone, rel=1e-5) and len(among) == 4


def test_url_filters(spark):
    rules = spark.createDataFrame(
        [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("EXAMPLE.org", "/en/12", "allow"), (None, "/", "block"), ("dup.net", "", "allow"), ("dup.net", "", "block")],
        "host string, path string, verdict string",
    )
    urls = ["http://a.example.org/es/1", "https://Example.ORG/en/1?x", "http://example.org/en/12", "x://org", "http://notexample.org/es/", None, "nothing", "http://dup.net", "http://x.dup.net#f", "http://", "http://example.org/en/1/é"]
    pages = spark.createDataFrame([(k, u, "own") for k, u in enumerate(urls + urls[:1])], "page_id int, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.filter_urls(pages, rules).collect()}
    assert got == {
        0: ("a.example.org", "/es/1", "example.org/es/", "block"), 11: ("a.example.org", "/es/1", "example.org/es/", "block"),
        1: ("example.org", "/en/1", "example.org/en/1", "block"), 2: ("example.org", "/en/12", "example.org/en/12", "allow"),
        3: ("org", "", None, "allow"), 4: ("notexample.org", "/es/", "org/", "allow"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"),
        7: ("dup.net", "", "dup.net", "block"), 8: ("x.dup.net", "", "dup.net", "block"), 9: ("", "", None, "allow"),
        10: ("example.org", "/en/1/é", "example.org/en/1", "block"),
    }
    assert url_filters.filter_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filters.filter_urls(pages, rules.limit(0)).collect()} == {"allow"}


@pytest.mark.parametrize("budget,history", [(1024, 256), (40, 12), (30, 0), (9, 4)])
def test_chat_formatting(spark, budget, history):
    import hashlib

    r = random.Random(budget)
    rows = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (5, None, None, None), (5, 1, "assistant", "<\\/s><\\\\s>[\\INST]")]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", ""), (6, 0, "assistant", "same"), (6, 0, "assistant", "same")]
    for conv in range(8):
        n = r.randint(1, 30)
        for turn in range(n):
            role = "system" if turn == 0 and conv % 2 else ("user", "assistant")[turn % 2]
            rows.append((conv + 100, turn * 700, role, " ".join(r.choice([*VOCAB, "<s>", "[/INST]"]) for _ in range(r.choice([0, 2, 9, 40])))))
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("_turn", F.lit(1)).repartition(3)
    windows = chat.format_conversations(df, budget, history)
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    tokens = lambda text: len(brute.words(text)) + chat.FRAME_TOKENS
    for w in windows.collect():
        turns = [x[3] for x in convs[w.conv_id]]
        assert w.n_tokens <= max(budget, max(map(tokens, turns)) + history + tokens(turns[0]))
        assert w.n_new >= 1 and (w.n_repeated == 0) == (w.first_turn == 0) or history < max(map(tokens, turns))
    got = {x.conv_id: x for x in chat.digests(windows).collect()}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns = sorted(turns)
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        x = got[c]
        assert (x.n_turns, x.loss_chars) == (len(turns), len(loss)), c
        assert x.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest() and x.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_escape_is_reversible(spark):
    r = random.Random(1)
    texts = ["".join(r.choice(["<", "\\", "/", "s", ">", "[", "INST", "]", "<s>", "[/INST]"]) for _ in range(12)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for x in df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert x.t == x.u and not any(m in x.e for m in ("<s>", "</s>", "[INST]", "[/INST]"))


@pytest.mark.parametrize("percent", [50, 70, 80, 85, 90, 95])
def test_linked_sets_share_a_key(percent):
    """Random pairs at the threshold and beyond, of all sizes."""
    import numpy as np

    r = np.random.default_rng(percent)
    for _ in range(1500):
        n = int(r.choice([1, 2, 3, 5, 8, 13, 30, 60, 150, 700]))
        pool = r.integers(0, 2**64, 3 * n + 4, dtype=np.uint64)
        a = set(pool[:n].tolist())
        most = 2 * n * (100 - percent) // (100 + percent)
        gone, new = int(r.integers(0, most + 1)), int(r.integers(0, most + 1))
        b = set(sorted(a)[gone:]) | set(pool[n : n + new].tolist())
        if not b or 100 * len(a & b) < percent * len(a | b):
            continue
        one, two = (np.sort(np.array(list(x), np.uint64)) for x in (a, b))
        if a != b:
            assert len(np.intersect1d(ngram_join.block_keys(one, percent), ngram_join.block_keys(two, percent)))


def test_ngram_join_packs_and_unpacks():
    import numpy as np

    for numbers in ([], [0], [5, 5, 2**64 - 1], [1, 300, 70_000]):
        x = np.array(numbers, np.uint64)
        assert ngram_join.unpacked(ngram_join.packed(x)).tolist() == numbers and ngram_join.unpacked_sorted(ngram_join.packed_sorted(x)).tolist() == numbers


def test_close_points_miss_no_link_and_tell_other_texts_apart(monkeypatch):
    import numpy as np

    monkeypatch.setattr(ngram_join, "BOX", 4)
    rng = np.random.default_rng(11)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 2**63, int(rng.integers(40, 90)), dtype=np.uint64)
        for _ in range(3):  # three near copies of each
            other = base.copy()
            other[: int(rng.integers(0, 8))] = rng.integers(0, 2**63, 1, dtype=np.uint64)
            sets.append(np.unique(other))
    points = [ngram_join.packed(ngram_join.point_of(s)) for s in sets]
    sizes = np.array([len(s) for s in sets])
    for leaves in (np.zeros(len(sets), int), np.arange(len(sets)) % 2):
        found = ngram_join.close_points(list(range(len(sets))), leaves, sizes, points, 80)
        group = list(range(len(sets)))
        for a, b in found:
            group = [group[b] if g == group[a] else g for g in group]
        for a in range(len(sets)):
            for b in range(a):
                apart = leaves.any() and leaves[a] == leaves[b]
                if not apart and ngram_join.linked(sets[a], sets[b], 80):
                    assert group[a] == group[b]
        assert len(found) < len(sets)  # a forest
        assert max(group.count(g) for g in group) < 30  # unrelated texts of one length stay apart


def test_ngram_join_of_missing_ids_reads_each_text_once(spark):
    rows = [(None, f"{prose(60, k // 2)}{' more' * (k % 2)}") for k in range(80)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    classes = ngram_join.classes_of(ngram_join.named_sets(df, 4))
    parts = ngram_join.leaf_pairs(df, classes, ngram_join.families(df, classes, 4, 85), 4, 85)
    assert parts.count() == 80
    assert len({r.root for r in ngram_join.join_documents(df).collect()}) == 40
