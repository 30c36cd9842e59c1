"""Periodic runs, SentencePiece encoding, the Merkle manifest and the classifier's blocks against plain versions, with odd rows."""

import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_llm_edges import ROWS, make

from wardgrid.llm import merkle, periodic_runs, piece_encoding, quality_cnn, textbytes
from wardgrid.llm.columns import ascii_lower
from wardgrid.llm.queries import doc_hash, planted_periods

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BITS = ["a", "b", " ", "  ", "▁", "\n", "é", "😀", "ꙮ", "\x00", "\t", "the ", "ing", "</s>", "<0x0A>", "x" * 30, "ﬁ", "́", " " * 40, "한국", "　", ".", "!!", "Ａ", "½", "İ", "ｶﾞ", "\xa0", "\u200b", "①"]


@pytest.fixture(scope="module")
def docs(spark):
    return make(spark, [(i, t, [lang, s]) for i, t, lang, s in ROWS]).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return make(spark, [])


@pytest.mark.parametrize("least", [2, 3, 4, 12])
def test_runs_against_brute_force(least):
    r = random.Random(least)
    for _ in range(150):
        texts = []
        for _ in range(r.randint(1, 6)):
            t = [r.randrange(r.choice([1, 2, 2, 3, 5])) for _ in range(r.randint(0, 60))]
            if r.random() < 0.5 and t:
                a = r.randrange(len(t))
                p = r.randint(1, len(t) - a)
                t = [*t[:a], *(t[a + (i - a) % p] for i in range(a, len(t)))]
            texts.append(t)
        number = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        start, length, period = periodic_runs.runs_of(np.array([x for t in texts for x in t], np.uint64), number, least)
        got = [(int(s - first[number[s]]), int(n), int(p), int(number[s])) for s, n, p in zip(start, length, period, strict=True)]
        assert got == [(*x, k) for k, t in enumerate(texts) for x in brute.runs(t, least)]


@pytest.mark.parametrize("words", [["a"], ["a", "b"], ["a", "a", "b"]])
def test_one_long_run_is_found_in_time(words):
    symbols = np.array([ord(w) for w in words] * 60_000, np.uint64)
    start, length, period = periodic_runs.runs_of(symbols, np.zeros(len(symbols), np.int64))
    assert [(0, len(symbols), len(words))] == [r for r in zip(start.tolist(), length.tolist(), period.tolist(), strict=True) if r[1] > 1000]


def test_runs_of_odd_rows(docs, none):
    repeated = docs.withColumn("text", F.when(F.col("doc_id") == 1, F.repeat(F.concat("text", F.lit("\n")), 3)).otherwise(F.col("text")))
    got = periodic_runs.find_runs(repeated).collect()
    assert len(got) == len(ROWS)
    for doc, text, *_ in ROWS:
        w = brute.words(text) * (3 if doc == 1 else 1)
        found = brute.runs(w) if len(w) < 2000 else None
        same = [r for r in got if r.doc_id == doc and r.n_words == len(w)]
        assert same
        if found is not None:
            gone = {i for s, n, q in found for i in range(s + q, s + n)}
            assert any([tuple(x) for x in r.runs] == found and r.collapsed == " ".join(x for i, x in enumerate(w) if i not in gone) for r in same)
    assert {(r.n_words, r.collapsed) for r in got if r.doc_id in (4, 5, 6)} == {(0, "")}
    assert periodic_runs.find_runs(none).count() == 0
    planted = {(r.doc_id, r.text) for r in planted_periods(docs).collect()}
    assert all(any(d == doc and brute.words(t) == brute.planted(doc, text) for d, t in planted) for doc, text, *_ in ROWS)


def odd_texts(n):
    r = random.Random(2)
    return ["", " ", None, "ab" * 3000, "é" * 500 + " " + "x" * 900, *["".join(r.choice(BITS) for _ in range(r.randint(0, 40))) for _ in range(n)]]


def test_pieces_and_spans_against_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = odd_texts(800)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("own"))
    encoded = piece_encoding.encode(df, MODEL)
    got = {r.doc_id: r for r in encoded.collect()}
    decoded = {r.doc_id: r.text for r in piece_encoding.decode(encoded, MODEL).collect()}
    for k, text in enumerate(texts):
        want = library.encode(text or "", return_type="proto").pieces
        assert list(zip(got[k].ids, got[k].starts, got[k].ends, strict=True)) == [(x.id, x.begin, x.end) for x in want], text
        assert decoded[k] == library.decode([x.id for x in want])


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("squeeze,dummy", [(0, 0), (1, 0), (1, 1), (0, 1)])
def test_character_map_and_alignment_against_the_library(rule, squeeze, dummy):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=bool(dummy), remove_extra_whitespaces=bool(squeeze), escape_whitespaces=True)
    spec = dict(piece_encoding.fields(dict(piece_encoding.fields(library.serialized_model_proto()))[3]))
    model = type("Settings", (), {"map": piece_encoding.CharacterMap(spec[2]), "squeeze": squeeze, "dummy_prefix": dummy})
    for text in filter(None, odd_texts(500)):
        raw = np.frombuffer(text.encode(), np.uint8)
        out, src, _, cuts = piece_encoding.normalised(raw, np.array([0, len(raw)]), model)
        want, offsets = library.normalize(text, with_offsets=True)
        assert out.tobytes().decode().replace(" ", "▁") == want and cuts.tolist() == [0, len(out)]
        characters = [k for k, b in enumerate(out.tolist()) if b & 0xC0 != 0x80]
        assert [len(raw[: src[k]].tobytes().decode()) for k in characters] == offsets[:-1]


def test_bytes_that_are_no_text():
    encoder = piece_encoding.Encoder(MODEL)
    data = np.frombuffer(b"a\xff\xe2\x96b", np.uint8)
    ids, start, stop, cuts = encoder.block(data, np.array([0, 2, 5]))
    assert list(piece_encoding.decoded(encoder.model, ids, cuts)) == ["a\ufffd", "\ufffd\ufffdb"]
    assert start[0] == 0 and stop[-1] == 5 and all(start <= stop)


def test_pieces_of_odd_rows(docs, none):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = sorted(tuple(r)[:2] for r in piece_encoding.digests(docs.where("doc_id is not null"), MODEL).collect())
    assert got == sorted((i, len(library.encode(t or ""))) for i, t, *_ in ROWS if i is not None)
    assert piece_encoding.digests(docs, MODEL).count() == len(ROWS) and piece_encoding.digests(none, MODEL).count() == 0
    assert piece_encoding.encode(none, MODEL).count() == 0


def tampered():
    return F.when(doc_hash(3) == 0, F.when(F.col("text").isNotNull(), merkle.leaf_digest(*[F.col(c) for c in merkle.FIELDS[:-1]], ascii_lower(F.col("text")))))


def check_manifest(df):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]
    out = merkle.manifest(df, carry={"tampered": tampered()})
    out = out.withColumn("folded", merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof"))).withColumn("all", merkle.siblings(F.col("proof")))
    got = sorted(((r.doc_id or -1), r.leaf, r.subroot, r.root, r.all, r.folded) for r in out.collect())
    want = brute.merkle(rows)
    # Equal rows are leaves of their own, in any order.
    assert got == sorted(((rows[k][0] or -1), *w) for k, w in want.items())


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_of_many_rows(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    r = random.Random(levels)
    rows = [(r.choice([k, 5, None]) if k % 4 == 0 else k, r.choice(["s", None]), r.choice(["a", "a", "a", "é", "Z", None, f"x{k % 80}"]), k, r.choice(["Text Ä", "", None, f"own {k}"])) for k in range(700)]
    rows += [(9, "s", "a", 1, "Same")] * 200
    check_manifest(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5))


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65])
def test_manifest_at_full_nodes(spark, n):
    check_manifest(spark.createDataFrame([(k, "s", "en", k, f"T{k}") for k in range(n)], "doc_id long, source string, lang string, n_chars long, text string"))


def test_manifest_of_odd_rows(docs, none):
    check_manifest(docs)
    assert merkle.manifest(none).count() == 0


def plain_score(net, text):
    """The network on one text, window by window."""
    cells = -(-(len(text) + quality_cnn.WIDTH) // quality_cnn.CELL)
    padded = [*text, *[quality_cnn.PAD] * (cells * quality_cnn.CELL - len(text))]
    maxima = np.full((cells, quality_cnn.FILTERS), -np.inf)
    for at in range(0, len(padded) - quality_cnn.WIDTH + 1, quality_cnn.STRIDE):
        seen = net.embedding[padded[at : at + quality_cnn.WIDTH]].ravel() @ net.filters
        maxima[at // quality_cnn.CELL] = np.maximum(maxima[at // quality_cnn.CELL], seen)
    maxima += net.bias
    chunks = []
    for first in range(0, max(1, cells - 1), quality_cnn.CHUNK_STEP):
        chunks.append(np.tanh(maxima[first : first + quality_cnn.CHUNK_CELLS].max(0)))
    features = np.concatenate([np.max(chunks, 0), np.mean(chunks, 0)])
    return 1 / (1 + np.exp(-(features @ net.weights + net.offset)))


def test_classifier_scores_depend_on_the_text_alone():
    r = random.Random(9)
    net = quality_cnn.start_network(4)
    net.bias[:] = np.random.default_rng(1).normal(0, 0.3, quality_cnn.FILTERS)
    sizes = [0, 1, 7, 118, 119, 120, 121, 122, 127, 128, 129, 247, 248, 249, 500, 505, 1300]
    texts = ["".join(r.choice("abcdefgh é") for _ in range(r.choice(sizes))).encode()[: r.choice(sizes)].decode(errors="ignore") for _ in range(120)]
    for _ in range(3):
        r.shuffle(texts)
        got = quality_cnn.score_texts(net, pa.array(texts))
        assert got == pytest.approx([plain_score(net, list(t.encode())) for t in texts], rel=1e-4)


def test_classifier_slices_long_texts(monkeypatch):
    text = "".join(random.Random(1).choice("abcd efg") for _ in range(40_000))
    net = quality_cnn.start_network()
    want = quality_cnn.score_texts(net, pa.array([text, "abc", text]))
    monkeypatch.setattr(quality_cnn, "BLOCK_CELLS", 7)
    assert quality_cnn.score_texts(net, pa.array(["x", text, "abc"]))[1:] == pytest.approx(want[:2], rel=1e-5)


def test_classifier_gradient_is_the_slope(monkeypatch):
    monkeypatch.setattr(quality_cnn, "BLOCK_CELLS", 3)
    net = quality_cnn.start_network(2)
    net = quality_cnn.Network(*[f.astype(np.float64) for f in net.parameters()], 0.1)
    texts = [b"good words here " * 30, b"", b"xx yy zz " * 60, b"q" * 120]
    target = np.array([1, 0, 0, 1], np.float32)
    layouts = [quality_cnn.cells_of(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]

    def loss():
        p = np.array([plain_score(net, list(t)) for t in texts])
        return -np.mean(target * np.log(p) + (1 - target) * np.log(1 - p))

    gradients = quality_cnn._gradients(net, layouts, target)
    r = np.random.default_rng(0)
    for which, values in ((0, net.embedding), (1, net.filters), (2, net.bias), (3, net.weights)):
        flat, slope = values.reshape(-1), gradients[which].reshape(-1)
        for k in r.choice(np.flatnonzero(np.abs(slope) > 1e-4), 5):
            old, step = flat[k], 1e-6
            flat[k] = old + step
            up = loss()
            flat[k] = old - step
            down = loss()
            flat[k] = old
            assert (up - down) / (2 * step) == pytest.approx(slope[k], rel=1e-3)


def test_labelled_sample_keeps_whole_texts(spark):
    docs = spark.createDataFrame([(k, "w " * (100 * k)) for k in range(10)] + [(3, "w " * 300), (3, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(10)], "doc_id long, quality int")
    whole = {r.text.encode() for r in docs.collect()}
    rows = quality_cnn.labelled_sample(docs, labels, 100, 5000)
    assert sum(len(t) for t, _ in rows) <= 5000 and {t for t, _ in rows} <= whole and len(rows) >= 5
    assert len(quality_cnn.labelled_sample(docs, labels, 100, 10**6)) == 11 and len(quality_cnn.labelled_sample(docs, labels, 4, 10**6)) == 4


def test_blocks_cover_all_texts():
    texts = pa.array(["a" * k for k in range(50)])
    assert sum(end - first for first, end, *_ in textbytes.blocks(texts, 64)) == 50
