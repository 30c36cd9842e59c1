"""The pipeline against its brute-force version, and the guard around the package."""

import brute
import corpus_pipeline
from pyspark.sql import functions as F
from test_llm_edges import make, prose

from wardgrid.llm import quality_rules
from wardgrid.session import staged


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]


def test_pipeline_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = sorted(((r.doc_id, r.text) for r in docs.collect()))
        docs = staged(stage(spark, docs, sf_dir))
        if name == "best-fit packing":
            assert {r.doc_id for r in docs.collect()} == {d for d, _ in before}
            continue
        assert docs.columns == columns
        after = sorted((r.doc_id, r.text) for r in docs.collect())
        if name == "line dedup":
            want = [(d, t) for (d, t), (_, old) in zip(brute.without_repeats(before), before, strict=True) if t == old or brute.words(t)]
        elif name == "n-gram Jaccard join":
            root = brute.components(dict(before), 5, 80)
            want = [(d, t) for d, t in before if root[d] == d]
        elif name == "benchmark decontamination":
            gone = {d for d, _ in brute.leaks(before, items)}
            want = [(d, t) for d, t in before if d not in gone]
        else:
            assert set(after) <= set(before) and len(after) > 0.7 * len(before)
            assert all(len(brute.words(t)) >= quality_rules.MIN_WORDS for _, t in after)
            continue
        assert after == want, name


def test_pipeline_survives_odd_rows(spark, sf_dir, tmp_path):
    rows = [(1, prose(200, 1), ["en", "s"]), (1, prose(200, 1), ["en", "s"]), (2, None, [None, None]), (3, "", ["en", None]), (None, prose(90, 2), ["en", "s"]), (4, prose(90, 2), ["en", "s"])]
    for folder, given in (("odd", rows), ("none", [])):
        path = f"{tmp_path}/{folder}"
        make(spark, given).withColumn("removed lines", F.lit("own")).write.parquet(f"{path}/documents.parquet")
        spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
        docs = spark.read.parquet(f"{path}/documents.parquet")
        cut = corpus_pipeline.lines(spark, docs, path)
        assert cut.columns == docs.columns and {r["removed lines"] for r in cut.collect()} <= {"own"}
        got = {r.doc_id for r in corpus_pipeline.run(spark, path).collect()}
        assert got == ({1, None} if given else set()), got
