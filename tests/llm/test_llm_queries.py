"""Every registered query next to its SQL or a brute-force version, on the given tables."""

import os
import zlib

import brute
import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

TABLES = "documents pages benchmark labels conversations".split()
LLM = [n for n in queries() if n == "pipeline" or n.startswith("op")]


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def test_each_operator_has_one_query():
    assert sorted(n.split("_")[0] for n in LLM) == sorted(["pipeline", *[f"op{k}" for k in range(1, 14)]])


@pytest.mark.parametrize("name", [n for n in LLM if n in oracle_sql()])
def test_query_agrees_with_sql(spark, sf_dir, con, name):
    got = queries()[name](spark, sf_dir).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    plain = [sorted(map(repr, f[columns].astype(object).where(f[columns].notna(), None).itertuples(index=False, name=None))) for f in (got, want)]
    assert plain[0] == plain[1] and plain[0]


@pytest.fixture(scope="module")
def texts(con):
    return con.execute("select doc_id, text from documents order by doc_id").fetchall()


def test_line_dedup_query(spark, sf_dir, texts):
    got = {r.doc_id: r.text for r in queries()["op3_line_dedup"](spark, sf_dir).collect()}
    assert got == dict(brute.without_repeats(texts))


def test_ngram_join_query(spark, sf_dir, texts):
    want = brute.components(dict(texts), 4, 85)
    for r in queries()["op4_ngram_join"](spark, sf_dir).collect():
        assert r.component_id == want[r.doc_id] and r.n_shingles == len(brute.shingles(dict(texts)[r.doc_id], 4))


def test_packing_query(spark, sf_dir, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {(r.doc_id, r.piece): r for r in queries()["op6_best_fit_packing"](spark, sf_dir).collect()}
    n = 0
    for doc, text in texts:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            r = got[doc, piece]
            assert (r.start, r.length) == (start, len(part))
            assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            n += 1
    assert n == len(got)
    used = {}
    for r in sorted(got.values(), key=lambda r: (r.sequence_id, r.offset)):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 4096 and len(used) <= -(-sum(used.values()) // 4096) + 1


def test_kneser_ney_query(spark, sf_dir, texts):
    model = brute.KneserNey([t for d, t in texts if zlib.crc32(str(d).encode()) % 10])
    held, base = 0.0, 0.0
    for r in queries()["op8_kneser_ney"](spark, sf_dir).collect():
        text = dict(texts)[r.doc_id]
        tokens = model.tokens(text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(model.count[w] > 0 for w in tokens), model.n)
        assert r.score == pytest.approx(model.score(text), rel=1e-9) and r.base_score == pytest.approx(model.base(text), rel=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        held, base = held + r.held_out * r.score, base + r.held_out * r.base_score
    assert held > base


def test_license_query(spark, sf_dir, texts):
    notices = {
        "MIT-notice": "Released under the MIT License", "GPL-3.0-notice": "under the GNU General Public License, version 3",
        "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0", "all-rights-reserved": "All rights reserved",
    }
    found = queries()["op9_license_scan"](spark, sf_dir).collect()
    by_id = dict(texts)
    for name, notice in notices.items():
        assert {r.doc_id for r in found if r.license == name} == {d for d, t in texts if notice in t}
    for r in found:
        if r.license in notices and r.coverage == 1:
            assert notices[r.license] in by_id[r.doc_id][r.start : r.end]


def test_periodic_runs_query(spark, sf_dir, texts):
    got = {r.doc_id: tuple(r)[1:] for r in queries()["op11_periodic_runs"](spark, sf_dir).collect()}
    assert got == {d: brute.run_digests(d, t) for d, t in texts}
    assert sum(r[0] > 0 for r in got.values()) > len(texts) / 20


def test_sentencepiece_query(spark, sf_dir, texts):
    import hashlib

    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: tuple(r)[1:] for r in queries()["op12_sentencepiece"](spark, sf_dir).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for doc, text in texts:
        ids = library.encode(text or "")
        assert got[doc] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    assert len(got) == len(texts)


def test_classifier_query(spark):
    folder = os.environ.get("CLASSIFIER_SF_DIR", "/root/testdata/sf0.01")
    if not os.path.isdir(folder):
        pytest.skip("test tables not available")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = queries()["op1_quality_cnn"](spark, folder).collect()
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert len({r.doc_id for r in got}) == len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.93
