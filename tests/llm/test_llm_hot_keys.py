"""Equal rows, shared ids, very long hosts and clashing names."""

from wardgrid.llm import decontaminate, packing, quality_rules, url_filters
from wardgrid.session import staged


def test_url_filters_long_hosts(spark):
    host = "a." * 100_000 + "example.org"
    rules = spark.createDataFrame([("example.org", "/es/", "block"), ("org", "/", "allow"), ("a.b.c.d", "/", "block")], "host string, path string, verdict string")
    urls = [f"http://{host}/es/x", f"http://{host}./es/x", "http://c.d/", "http://x.a.b.c.d/", "http://.org/", "http://org./"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filters.filter_urls(pages, rules).select("page_id", "rule", "verdict").collect()}
    assert got == {
        0: ("example.org/es/", "block"), 1: (None, "allow"), 2: (None, "allow"),
        3: ("a.b.c.d/", "block"), 4: ("org/", "allow"), 5: (None, "allow"),
    }


def test_decontamination_judges_texts_of_one_id_apart(spark):
    item = "one two three four five six seven"
    docs = spark.createDataFrame(
        [(k, f"before {item} after {n}") for k in (None, 7) for n in range(20)] + [(k, f"clean words of text number {n} here") for k in (None, 7) for n in range(20)],
        "doc_id long, text string",
    )
    benchmark = spark.createDataFrame([(1, item), (None, "alpha beta gamma delta epsilon zeta")], "item_id long, text string")
    leaks = decontaminate.find_leaks(docs, benchmark).collect()
    assert len(leaks) == 40 and {r.item_id for r in leaks} == {1} and len({r.text_key for r in leaks}) == 20
    kept = decontaminate.decontaminate(docs, benchmark).collect()
    assert len(kept) == 40 and all(r.text.startswith("clean") for r in kept)


def test_packing_deals_equal_rows_over_cells(spark):
    rows = spark.range(5000).selectExpr("cast(null as long) doc_id", "0 piece", "0L start", "1L length", "7L ids_crc32", "id _place")
    cut = staged(rows, "equal-rows")
    found = packing.assign(cut, 4096, "_place")
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    slots = [(r.sequence_id, r.offset) for r in found.collect()]
    assert len(slots) == len(set(slots)) == 5000 and len({s for s, _ in slots}) == 2


def test_quality_filter_keeps_columns_of_any_name(spark):
    text = " ".join(f"word{k}" for k in range(60))
    docs = spark.createDataFrame([(k, text + f" {k}", "en", "web", k, k) for k in range(5)] + [(9, "short", None, None, 1, 2)], "doc_id long, text string, lang string, source string, `_n_words` int, `a.b` int")
    kept = quality_rules.filter_quality(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == sorted(tuple(r) for r in docs.collect() if r.doc_id != 9)
