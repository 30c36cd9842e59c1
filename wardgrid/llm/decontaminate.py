"""Benchmark decontamination: which documents hold a benchmark item, however long the document is.

Items are small sets of five-word shingles, documents large ones, so the question is containment: an item
is leaked if at least ``PERCENT`` per cent of its distinct shingles occur in a document.  Items are
partitioned by set size; in each partition the bottom-m MinHash sketch of an item (its m shingles with the
least hashes, rare ones in the benchmark first) has m = 1 + (shingles an item of this size may miss), so
a leaked item always shares a sketch value with the document.  Document shingles meet the sketches in one
equi-join; the pairs found are verified by intersecting the exact shingle sets.

The sketch table has m rows per item and is written first, so its true size decides whether it is
broadcast (no shuffle of documents) or both sides are shuffled.  An item that leaked into a third of all
documents gives one row per document; verification is row-local.

Words are lower-cased (A-Z) runs of characters other than space and 09-0D.  Defined results: NULL, empty
or shorter texts (fewer than five words) have no shingle, so such items leak nowhere and such documents
hold nothing; documents with the same id are judged by their own texts; repeated items are reported once
per distinct (id, text); NULL ids compare as equal; an empty table on either side gives no leak.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.llm.columns import ascii_lower, bind, null_safe, shielded, words_of
from wardgrid.session import staged

SHINGLE = 5
PERCENT = 80


def _shingles(text: Column, make, size: int) -> Column:
    """``make`` of the words of every run of ``size`` words."""

    def runs(w: Column) -> Column:
        heads = F.slice(w, 1, F.greatest(F.size(w) - (size - 1), F.lit(0)))
        return F.transform(heads, lambda x, i: make(x, *[F.get(w, i + k) for k in range(1, size)]))

    return bind(words_of(ascii_lower(text)), runs)


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    return _shingles(text, F.xxhash64, size)


def shingle_texts(text: Column, size: int = SHINGLE) -> Column:
    return F.array_distinct(_shingles(text, lambda *w: F.concat_ws(" ", *w), size))


def item_sets(benchmark: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(item, item text's hash, its distinct shingles, their number) of the distinct items that have any."""
    return (
        benchmark.select(F.col("item_id").alias("_item"), F.col("text").alias("_item_text"))
        .distinct()
        .select("_item", F.xxhash64("_item_text").alias("_item_key"), shingle_texts(F.col("_item_text"), size).alias("_item_shingles"))
        .withColumn("_item_size", F.size("_item_shingles").cast("long"))
        .where(F.col("_item_size") > 0)
    )


def sketches(items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(item, key, hash): the bottom-m sketch of every item, m by the size partition [2^j, 2^(j+1))."""
    hashed = items.select("_item", "_item_key", "_item_size", F.explode("_item_shingles").alias("_s")).withColumn(
        "_h", F.xxhash64(*[F.get(F.split("_s", " "), F.lit(k)) for k in range(SHINGLE)])
    )
    rarity = hashed.groupBy("_h").agg(F.count("*").alias("_in_items"))
    largest = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin("_item_size"))) - 1
    allowed = F.floor(largest * (100 - percent) / 100)
    order = Window.partitionBy("_item", "_item_key").orderBy("_in_items", "_h")
    ranked = hashed.join(rarity, "_h").withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= allowed + 1).select("_item", "_item_key", "_h")


def find_leaks(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text key, item_id, n_item_shingles, n_shared, containment) of every leaked item."""
    items = staged(item_sets(benchmark), "items")
    sketch = staged(sketches(items, percent), "sketches")
    # Candidates go back to their own text, not to all texts of an id: a third of all ids may be NULL or the same.
    texts = docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text"), F.xxhash64("text").alias("_text_key"))
    found = (
        texts.select("_doc", "_text_key", F.explode(shingle_hashes(F.col("_text"))).alias("_s"))
        .join(sketch.withColumnRenamed("_h", "_s"), "_s")
        .select("_doc", "_text_key", "_item", "_item_key")
        .distinct()
    )
    pairs = staged(found, "candidates").withColumnsRenamed({"_doc": "_d", "_text_key": "_t", "_item": "_i", "_item_key": "_k"})
    shared = F.size(F.array_intersect(shingle_texts(F.col("_text")), F.col("_item_shingles"))).cast("long")
    return (
        texts.join(pairs, (F.col("_text_key") == F.col("_t")) & F.col("_doc").eqNullSafe(F.col("_d")))
        .join(items, null_safe([F.col("_i"), F.col("_k")], [F.col("_item"), F.col("_item_key")]))
        .select("_doc", "_text_key", "_item", "_item_size", shared.alias("_shared"))
        .where(100 * F.col("_shared") >= percent * F.col("_item_size"))
        .select(
            F.col("_doc").alias("doc_id"), F.col("_text_key").alias("text_key"), F.col("_item").alias("item_id"),
            F.col("_item_size").alias("n_item_shingles"), F.col("_shared").alias("n_shared"),
            (F.col("_shared").cast("double") / F.col("_item_size")).alias("containment"),
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns unchanged."""
    leaks = staged(find_leaks(docs, benchmark, percent).select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t")).distinct(), "leaks")
    plain, restored = shielded(docs, ("doc_id", "text"))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_t"))
    return restored(plain.join(leaks, same, "left_anti"))
