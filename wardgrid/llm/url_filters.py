"""URL allow and block rules: host-suffix and path-prefix expressions, hash-prefix join, digest check.

A rule is a host and a path, written ``host/path``.  It fits a URL whose host is the rule's host or a
subdomain of it and whose path starts with the rule's path.  Every URL is expanded into the expressions
a rule could be written as; these meet the rules by an equi-join on a four-byte prefix of their SHA-256
digest, the full digests confirm, and the longest rule wins.

Defined results: a NULL url, or one without ``://``, has an empty host and path and fits no rule; a NULL
or empty rule table fits nothing; repeated rows each get their verdict; of rules equally long the one
with the longer host wins, and of equal rules with both verdicts ``block`` wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.llm.columns import ascii_lower

PREFIX_HEX = 8  # digits of the digest that the join compares


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"(?s)^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    known = F.coalesce(url, F.lit(""))
    at = F.locate("://", known)
    return F.when(at > 0, F.substring(known, at + 3, F.length(known))).otherwise(F.lit(""))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def prepared_rules(rules: DataFrame) -> DataFrame:
    """(rule, verdict, host/path lengths, digest and its prefix) for a table (host, path, verdict)."""
    host = ascii_lower(F.coalesce(F.col("host"), F.lit("")))
    path = F.coalesce(F.col("path"), F.lit(""))
    rule = F.concat(host, path)
    return rules.where(F.length(host) > 0).select(
        rule.alias("_rule"),
        F.col("verdict").alias("_verdict"),
        F.length(rule).alias("_length"),
        F.length(host).alias("_host_length"),
        F.length(path).alias("_path_length"),
        F.size(F.split(host, r"\.")).alias("_labels"),
        _digest(F.concat_ws("\n", host, path)).alias("_rule_digest"),
    ).withColumn("_prefix", F.substring("_rule_digest", 1, PREFIX_HEX))


def expressions(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per URL, host suffix of as many labels as some rule has, and path prefix of a length that some rule has.

    ``urls`` has distinct ``_url``.  The label counts and lengths of the rules are two short arrays (no longer than
    the longest rule), read as scalar subqueries, so a host of any number of labels is cut only where a rule may fit.
    """
    lengths = rules.agg(F.array_sort(F.collect_set("_path_length")).alias("_lengths"))
    counts = rules.agg(F.array_sort(F.collect_set("_labels")).alias("_counts"))
    suffixes = F.transform(
        F.filter("_counts", lambda n: n <= F.size(F.split("_host", r"\."))),
        lambda n: F.call_function("substring_index", F.col("_host"), F.lit("."), -n),
    )
    return (
        urls.withColumn("_host", host_of(F.col("_url")))
        .withColumn("_path", path_of(F.col("_url")))
        .where(F.length("_host") > 0)
        .withColumn("_path_size", F.length("_path"))
        .withColumn("_lengths", lengths.scalar())
        .withColumn("_counts", counts.scalar())
        .select("_url", "_path", "_path_size", "_lengths", F.explode(suffixes).alias("_suffix"))
        .where(F.length("_suffix") > 0)
        .select(
            "_url", "_path", "_suffix",
            F.explode(F.filter("_lengths", lambda n: n <= F.col("_path_size"))).alias("_cut"),
        )
        .select("_url", _digest(F.concat_ws("\n", "_suffix", F.substring(F.col("_path"), F.lit(1), F.col("_cut")))).alias("_digest"))
        .withColumn("_prefix", F.substring("_digest", 1, PREFIX_HEX))
    )


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (NULL if none fits) and ``verdict``.

    Verdicts are found per distinct URL, so a URL that fills a third of the table is expanded once;
    joining them back is an inner-to-left equi-join whose right side is unique, which AQE may split.
    """
    known = prepared_rules(rules)
    urls = pages.select(F.col(url).alias("_url")).where(F.col("_url").isNotNull()).distinct()
    found = expressions(urls, known).join(known, "_prefix").where(F.col("_digest") == F.col("_rule_digest"))
    best = found.groupBy("_url").agg(
        F.max(F.struct("_length", "_host_length", (F.col("_verdict") == "block").cast("int").alias("_block"), "_rule", "_verdict")).alias("_best")
    )
    judged = best.select("_url", F.col("_best._rule").alias("_rule"), F.col("_best._verdict").alias("_verdict"))
    own = [F.col(f"_page.`{c}`").alias(c) for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    given = F.col(f"_page.`{url}`")
    return (
        pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_page"))
        .join(judged, given == F.col("_url"), "left")
        .select(
            *own,
            host_of(given).alias("host"),
            path_of(given).alias("path"),
            F.col("_rule").alias("rule"),
            F.coalesce("_verdict", F.lit(default)).alias("verdict"),
        )
    )
