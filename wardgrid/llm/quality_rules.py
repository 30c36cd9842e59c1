"""Quality rules with thresholds that adapt to each language and source.

Fixed base rules reject very short and mostly repeated texts.  For the other rules each group (language,
source) gets its own fences from quantile sketches: a text is rejected if a measure lies further outside
the quartiles of its group than ``reach`` times the quartile distance.

The sketch is a histogram over values rounded down to six significant bits (relative error 1/32).  Its
counters simply add up, so it merges across tasks, sources and languages in any order, is exact in its
counts and the same in every run; a group has at most a few hundred counters however many rows it has.
A group with fewer than ``min_group`` texts uses the merged sketch of its language, then that of all texts.

Measures are whole numbers (parts per million, thousandths of a character), so that every engine agrees.

Defined results: NULL or empty text has no words and fails the base rules; NULL language or source is a
group of its own; an empty table gives an empty result; repeated rows are judged alike.  Three-word windows
are compared by a 64-bit hash within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.llm.columns import SPACES, UPPER, bind, null_safe, shielded, words_of
from wardgrid.session import staged

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Measure, the least quartile distance it is judged by, and whether low values count too.
MEASURES = (
    ("word_length", 400, True),
    ("symbol_share", 8_000, False),
    ("dup_line_share", 100_000, False),
    ("repeat_share", 60_000, False),
    ("upper_share", 30_000, False),
)
REACH = 4
MIN_GROUP = 100
BITS = 6


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more, the first occurrence included."""

    def with_words(w: Column) -> Column:
        windows = F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0)))
        hashes = F.transform(windows, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return bind(hashes, with_hashes)

    def with_hashes(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        covered = bind(ordered, lambda s: bind(F.array_sort(repeats(s)), cover))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered)

    def repeats(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
        return F.transform(twice, lambda x: x["p"])

    def cover(p: Column) -> Column:
        widths = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(widths, F.lit(0), lambda a, x: a + x)

    return F.coalesce(bind(words, with_words), F.lit(0))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts, the base verdict and the measures (columns that start with ``_``)."""
    known = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(known, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    words = words_of(F.col(text))
    counts = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(known, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(known) - F.length(F.translate(known, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(words).cast("long").alias("n_repeat_words"),
        bind(lines, F.size).cast("long").alias("n_lines"),
        (F.length(known) - F.length(F.translate(known, UPPER, ""))).cast("long").alias("n_upper"),
    )
    # One element exploded: a filter on the counts then stays above, and they are computed once per row.
    out = docs.select("*", F.explode(F.array(counts)).alias("_c"))
    out = out.select(*docs.columns, *[F.col(f"_c.{c}").alias(f"_{c}") for c in COUNTS])
    failed = (F.col("_n_words") < MIN_WORDS) | (100 * F.col("_n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_n_words"))

    def share(part: str, whole: str, scale: int) -> Column:
        return F.when(F.col(whole) > 0, F.expr(f"{part} * {scale} div {whole}")).otherwise(F.lit(0)).cast("long")

    return out.select(
        "*",
        failed.alias("_base_failed"),
        share("_word_chars", "_n_words", 1000).alias("_word_length"),
        share("_n_symbols", "_word_chars", 1_000_000).alias("_symbol_share"),
        share("_n_dup_lines", "_n_lines", 1_000_000).alias("_dup_line_share"),
        share("_n_repeat_words", "_n_words", 1_000_000).alias("_repeat_share"),
        share("_n_upper", "_word_chars", 1_000_000).alias("_upper_share"),
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def cell(value: Column) -> Column:
    """``value`` rounded down to six significant bits."""
    drop = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def thresholds(measured: DataFrame, lang: str = "lang", source: str = "source", reach: int = REACH, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per (language, source): the fences of every measure, from merged sketches."""
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("m"), cell(F.col(f"_{m}")).alias("v")) for k, (m, _, _) in enumerate(MEASURES)]))
    sketch = (
        measured.where(~F.col("_base_failed"))
        .select(F.col(lang).alias("_lang"), F.col(source).alias("_source"), values.alias("_x"))
        .groupBy("_lang", "_source", F.col("_x.m").alias("_m"), F.col("_x.v").alias("_v"))
        .agg(F.count("*").alias("_n"))
    )
    # Levels of merging: 0 the group itself, 1 its language, 2 everything.
    by_lang = sketch.groupBy("_lang", "_m", "_v").agg(F.sum("_n").alias("_n"))
    by_all = by_lang.groupBy("_m", "_v").agg(F.sum("_n").alias("_n"))
    none = F.lit(None).cast("string")
    own = _fences(sketch, ["_lang", "_source"], reach)
    language = _fences(by_lang, ["_lang"], reach).select(F.col("_lang").alias("_l1"), F.col("_size").alias("_size1"), F.col("_fence").alias("_fence1"))
    overall = _fences(by_all.withColumn("_all", none), ["_all"], reach).select(F.col("_size").alias("_size2"), F.col("_fence").alias("_fence2"))
    merged = own.join(language, F.col("_lang").eqNullSafe(F.col("_l1")))
    fence2 = overall.select("_fence2").scalar()
    fence = (
        F.when(F.col("_size") >= min_group, F.col("_fence"))
        .when(F.col("_size1") >= min_group, F.col("_fence1"))
        .otherwise(fence2)
    )
    level = F.when(F.col("_size") >= min_group, 0).when(F.col("_size1") >= min_group, 1).otherwise(2)
    return merged.select("_lang", "_source", fence.alias("_fence"), level.alias("_level"))


def _fences(sketch: DataFrame, keys: list[str], reach: int) -> DataFrame:
    """Quartile fences per key: an array of (low, high) in the order of MEASURES."""
    order = Window.partitionBy(*keys, "_m").orderBy("_v")
    total = Window.partitionBy(*keys, "_m")
    ranked = sketch.withColumn("_cum", F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_size", F.sum("_n").over(total))
    quartiles = ranked.groupBy(*keys, "_m").agg(
        F.max("_size").alias("_size"),
        F.min(F.when(4 * F.col("_cum") >= F.col("_size"), F.col("_v"))).alias("_q1"),
        F.min(F.when(4 * F.col("_cum") >= 3 * F.col("_size"), F.col("_v"))).alias("_q3"),
    )
    floor = F.element_at(F.array(*[F.lit(f) for _, f, _ in MEASURES]), F.col("_m") + 1)
    both = F.element_at(F.array(*[F.lit(b) for _, _, b in MEASURES]), F.col("_m") + 1)
    width = reach * F.greatest(F.col("_q3") - F.col("_q1"), floor)
    low = F.when(both, F.col("_q1") - width).otherwise(F.lit(-1))
    fenced = quartiles.select(*keys, "_size", F.struct("_m", low.cast("long").alias("low"), (F.col("_q3") + width).cast("long").alias("high")).alias("_f"))
    return fenced.groupBy(*keys).agg(F.max("_size").alias("_size"), F.array_sort(F.collect_list("_f")).alias("_fence"))


def judge(measured: DataFrame, fences: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` with ``_kept`` and ``_broken`` (names of the adaptive rules broken).

    The fences have one row per (language, source); the join is an equi-join in which NULL equals NULL,
    whose hot source AQE may split.  A group without any text that passed the base rules has no fences.
    """
    joined = measured.join(
        fences.select(F.col("_lang").alias("_fl"), F.col("_source").alias("_fs"), "_fence"),
        null_safe([F.col(lang), F.col(source)], [F.col("_fl"), F.col("_fs")]),
        "left",
    )

    def outside(k: int, name: str) -> Column:
        fence, value = F.get("_fence", F.lit(k)), F.col(f"_{name}")
        return F.when((value < fence["low"]) | (value > fence["high"]), F.lit(name))

    broken = F.array_compact(F.array(*[outside(k, m) for k, (m, _, _) in enumerate(MEASURES)]))
    return (
        joined.withColumn("_broken", broken)
        .withColumn("_kept", ~F.col("_base_failed") & (F.size("_broken") == 0))
        .drop("_fl", "_fs", "_fence")
    )


def filter_quality(docs: DataFrame, reach: int = REACH, min_group: int = MIN_GROUP) -> DataFrame:
    """The rows of ``docs`` (text, lang, source and any others) that pass, with their columns unchanged."""
    plain, restored = shielded(docs, ("text", "lang", "source"))
    # Measuring is the dear part, so it is done once: rows are written with their measures, and read for sketches
    # (narrow columns only) and verdicts.  The fences are a small table, whose size decides how it is joined.
    measured = staged(measure(plain), "measured")
    fences = staged(thresholds(measured, reach=reach, min_group=min_group), "fences")
    return restored(judge(measured, fences).where("_kept"))
